"""Operators 2 and 6 against brute force over all pairs."""

import os
import random
import re
from collections import Counter

import numpy as np
import regex
from pyspark.sql import functions as F

from ledgerlens.llm import components, hashing, jaccard, lines

from .conftest import DOC, prose


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(zip(*(words[i:] for i in range(min(k, len(words))))))


def near_copies(seed, n, length, edits):
    r, base = random.Random(seed), prose(seed, length)
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(r.randint(0, edits)):
            words[r.randrange(length)] = r.choice("abcdefgh") * 3
        out.append(" ".join(words))
    return out


def documents():
    texts = [None, "", " \t\n", "one", "ONE", "one two", "One  Two\n", "one two three", "a b c d", "É b c d", "é b c d"]
    for seed, (n, length, edits) in enumerate([(40, 60, 4), (30, 150, 9), (12, 400, 30), (8, 30, 1), (5, 12, 1), (3, 2500, 60)]):
        texts += near_copies(seed + 10, n, length, edits)
    shared = " ".join(prose(77, 60))
    texts += [" ".join(prose(100 + i, 40)) + " " + shared for i in range(30)]
    return [(1000 - i, t) for i, t in enumerate(texts)] + [(3, texts[20]), (3, texts[20]), (None, texts[21]), (None, "lonely words of no one")]


def test_jaccard_classes_equal_all_pairs(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, DOC).withColumn("key", F.lit("clash")).withColumn("sigs", F.lit(0)).repartition(4)
    for k, num in ((3, 90), (5, 80)):
        sets = [shingles(t, k) for _, t in rows]
        pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
                 and 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
        root = roots(len(rows), pairs)
        least = {}
        for i, (doc_id, _) in enumerate(rows):
            if doc_id is not None:
                least[root[i]] = min(least.get(root[i], doc_id), doc_id)
        want = [(d, len(sets[i]), least.get(root[i]) if sets[i] else d) for i, (d, _) in enumerate(rows)]
        got = jaccard.classes(docs, k, num, 100).select("doc_id", "n_shingles", "component_id").collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert jaccard.classes(docs.where("false")).count() == 0


def test_buckets_larger_than_a_block_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    rows = list(enumerate(near_copies(5, 60, 80, 5)))
    sets = [shingles(t, 3) for _, t in rows]
    root = roots(60, [(i, j) for i in range(60) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])])
    assert dict(jaccard.classes(spark.createDataFrame(rows, DOC)).select("doc_id", "component_id").collect()) == dict(enumerate(root))


def test_large_sets_part_on_their_lowest_hashes(spark):
    """Sets that met by chance are told apart without moving them whole; sets that link stay, on their lowest hashes and on all."""
    r = np.random.default_rng(5)
    sets = [np.unique(r.integers(0, 2 ** 63, 6000, dtype=np.uint64) * np.uint64(2)) for _ in range(12)]
    for share in (0.97, 0.89, 0.885, 0.8, 0.5, 0.0):
        kept = sets[0][r.random(len(sets[0])) < share]
        sets.append(np.union1d(kept, r.integers(0, 2 ** 63, 6000 - len(kept), dtype=np.uint64)))
    sets += [sets[0][:3], sets[0][1:4], sets[0][:2]]
    for num, den in ((90, 100), (80, 100), (1, 1)):
        rows = [(i, len(s), bytearray(jaccard.low_part(s, num, den).tobytes()), bytearray(s.tobytes())) for i, s in enumerate(sets)]
        frame = spark.createDataFrame(rows, "key long, n long, low binary, hashes binary")
        pairs = spark.createDataFrame([(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))], "a long, b long")
        linked = {(i, j) for i, j in map(tuple, pairs.collect())
                  if den * len(c := np.intersect1d(sets[i], sets[j])) >= num * (len(sets[i]) + len(sets[j]) - len(c))}
        possible = {tuple(x) for x in jaccard._compared(pairs, frame, "low", num, den).collect()}
        assert linked <= possible and {tuple(x) for x in jaccard._verified(pairs, frame, num, den).collect()} == linked
        if num < den:
            assert sum(len(rows[i][2]) for i in range(12)) < 0.2 * sum(len(rows[i][3]) for i in range(12))
            assert not [(i, j) for i, j in possible if j < 12]


def test_tree_bound_never_hides_a_link():
    r = np.random.default_rng(1)
    sets = []
    for base in range(12):
        pool = np.unique(r.integers(0, 2**63, size=int(r.integers(10, 300)), dtype=np.uint64))
        for _ in range(8):
            keep = pool[r.random(len(pool)) > r.random() * 0.1]
            sets.append(np.unique(np.concatenate([keep, r.integers(0, 2**63, size=3, dtype=np.uint64)])))
    points = np.array([np.frombuffer(jaccard.point(s), "<u4") for s in sets]).astype(np.int64)
    n = np.array([len(s) for s in sets])
    tree = jaccard.CountTree(points, n, 90, 100)
    sizes = jaccard.Sizes(90, 100)
    signatures = [set(jaccard.group_signatures(s, sizes).tolist()) for s in sets]
    for i in range(len(sets)):
        near = set(tree.near(points[i], int(n[i]))[0].tolist())
        for j in range(len(sets)):
            common = len(np.intersect1d(sets[i], sets[j]))
            if i != j and 100 * common >= 90 * (n[i] + n[j] - common):
                assert j in near
                assert signatures[i] & signatures[j]


def test_shingle_sets_tell_words_apart():
    for a, b in (("a bc d", "ab c d"), ("x", "x x"), ("a b c", "c b a"), ("É b", "é b")):
        assert shingles(a, 3) != shingles(b, 3)
        assert jaccard.set_key(hashing.shingle_set(a, 3)) != jaccard.set_key(hashing.shingle_set(b, 3))
    assert len(hashing.shingle_set("A b\tc\x0bD " * 50000, 3)) == 4
    assert jaccard.set_key(hashing.shingle_set("The END of", 3)) == jaccard.set_key(hashing.shingle_set(" the\nend  OF", 3))


def test_components_of_a_chain_a_star_and_nothing(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 100 + i) for i in range(1, 50)]
    links = spark.createDataFrame([(b, a) for a, b in chain] + star + star + [(7, 7)], "a long, b long")
    got = dict(map(tuple, components.connected(links).collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)}
    assert components.connected(links.where("false")).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def near_pairs(texts):
    """Pairs of distinct lines with the edit similarity, from all pairs; few shared 4-grams rule a pair out for certain."""
    grams = [Counter(t[i:i + 4] for i in range(len(t) - 3)) for t in texts]
    out = []
    for i in range(len(texts)):
        for j in range(i):
            x, y = texts[i], texts[j]
            longer = max(len(x), len(y))
            allowed = int(longer * 0.1 + 1e-9)
            if abs(len(x) - len(y)) > allowed or (grams[i] & grams[j]).total() < longer - 3 - 4 * allowed:
                continue
            start = len(os.path.commonprefix([x, y]))
            x, y = x[start:], y[start:]
            end = len(os.path.commonprefix([x[::-1], y[::-1]]))
            if edits(x[:len(x) - end], y[:len(y) - end]) <= allowed:
                out.append((i, j))
    return out


def brute_lines(rows):
    """What ``lines.dedup`` should keep, from all pairs of lines by edit similarity alone."""
    def norm(line):
        return regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).strip()

    every = [(i, p, norm(x)) for i, (_, t) in enumerate(rows) if t is not None for p, x in enumerate(t.split("\n")) if norm(x)]
    distinct = sorted({x for _, _, x in every})
    long_ = [x for x in distinct if len(x) >= lines.LEAST_CHARS or len(x.split(" ")) >= lines.LEAST_WORDS]
    pairs = near_pairs(long_)
    group = {x: x for x in distinct} | {x: long_[root] for x, root in zip(long_, roots(len(long_), pairs))}
    first = {}
    for i, p, x in every:
        at = (rows[i][0] is not None, rows[i][0] or 0, p)
        first[group[x]] = min(first.get(group[x], at), at)
    gone = {(i, p) for i, p, x in every if first[group[x]] != (rows[i][0] is not None, rows[i][0] or 0, p)}
    out = []
    for i, (d, t) in enumerate(rows):
        places = {p for j, p in gone if j == i}
        kept = [x for p, x in enumerate((t or "").split("\n")) if p not in places]
        if not places:
            out.append((d, t))
        elif any(x.strip() for x in kept):
            out.append((d, "\n".join(kept)))
    return out, len(pairs)


def test_line_dedup_equals_all_pairs(spark):
    r = random.Random(8)
    pool = [" ".join(prose(i, r.randint(3, 12))) for i in range(60)]
    for i in range(12):  # near copies: one letter or one word of a long line changes
        long = prose(500 + i, 90)
        pool.append(" ".join(long))
        for _ in range(5):
            words = list(long)
            words[r.randrange(90)] += r.choice(["s", "", "x"])
            pool.append(" ".join(words).capitalize() + r.choice(["", ".", " !!"]))
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randint(1, 8)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "...\nshort line"), (None, pool[70]), (205, pool[-1] + "\n" + pool[-1]), (206, " ".join(prose(9, 4000)))]
    want, links = brute_lines(rows)
    assert links > 20
    docs = spark.createDataFrame(rows, DOC).withColumn("n_chars", F.length("text").cast("long")).withColumn("line", F.lit("clash")).repartition(3)
    out = lines.dedup(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert sorted(str((x.doc_id, x.text)) for x in got) == sorted(map(str, want))
    assert all(x.n_chars == (None if x.text is None else len(x.text)) for x in got)


def test_line_dedup_of_repeated_rows_and_nothing(spark):
    line = " ".join(prose(1, 9))
    rows = [(5, line), (5, line), (5, "other " + line), (1, line + "\nand five more words here")]
    got = sorted(map(tuple, lines.dedup(spark.createDataFrame(rows, DOC)).collect()))
    assert (1, line + "\nand five more words here") in got and all(t != line for _, t in got)
    assert lines.dedup(spark.createDataFrame([], DOC)).count() == 0


def test_ends_part_unrelated_lines_and_hide_no_link(spark):
    """Unrelated lines are told apart on their ends, without their whole texts; lines that link stay, wherever their edits lie."""
    r, texts, linked = random.Random(3), [], []
    for size in (20, 45, 130, 600, 2500):
        base = " ".join(prose(size, size))[:size].strip()
        k = len(base) // 10
        other = "".join(r.choice("qwzy") for _ in range(k))
        variants = [base, base[k:], base[:-k], base[:len(base) // 2] + base[len(base) // 2 + k:], other[:k // 2] + base[k // 2:-(k // 2) or None] + other[k // 2:],
                    base[k // 2:] + other[:k // 2], other[:k // 2] + base[:len(base) - k // 2]]
        linked += [(len(texts), len(texts) + i) for i in range(1, len(variants))]
        texts += variants
    unrelated = [(len(texts) + 2 * i, len(texts) + 2 * i + 1) for i in range(40)]
    texts += [" ".join(prose(500 + i, 120))[:400 + i // 2].strip() for i in range(80)]
    named = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "line long, norm string, size int")
    pairs = spark.createDataFrame(linked + unrelated, "a long, b long")
    true = {tuple(x) for x in pairs.join(named.toDF("a", "x", "n"), "a").join(named.toDF("b", "y", "m"), "b").where(
        F.expr("levenshtein(x, y) <= floor(greatest(n, m) * 0.1 + 1e-9)")).select("a", "b").collect()}
    agree = {tuple(x) for x in lines._ends_agree(pairs, named).collect()}
    assert len(true) >= 20 and true <= agree
    assert len(agree & set(unrelated)) <= 4
    assert {tuple(x) for x in lines._verified(pairs, named).collect()} == true


def test_letters_part_lines_that_share_a_passage_and_hide_no_link(spark, monkeypatch):
    """Hundreds of unrelated lines with one ending, and long lines of common words, are not paired off; edited lines still link."""
    r, ending = random.Random(21), " ".join(prose(77, 12))
    hot = [" ".join(prose(9000 + i, 20)) + " " + ending for i in range(300)]
    common = [" ".join(r.choice(["the", "of", "and", "in", "to", *prose(20_000 + i, 8)]) for _ in range(70)) for i in range(150)]
    linked = []
    for base in hot[:20] + common[:20]:
        changed = list(base)
        for at in r.sample(range(len(base)), len(base) // 20):
            changed[at] = r.choice("bcdfgh") if base[at] != " " else " "
        linked.append(("".join(changed), base))
    counted, verified = [], lines._verified

    def counting(pairs, named):
        counted.append(pairs.count())
        return verified(pairs, named)

    monkeypatch.setattr(lines, "_verified", counting)
    texts = sorted({*hot, *common, *(x for x, _ in linked)})
    table = spark.createDataFrame([(t,) for t in texts], "norm string").select(F.unhex(F.md5("norm")).alias("line"), "norm")
    group = {row.norm: bytes(row.group) for row in lines.line_groups(table).join(table, "line").collect()}
    assert all(a in group and group[a] == group.get(b) for a, b in linked)
    assert len(group) == 2 * len(linked)
    assert sum(counted) < 16_000, counted  # 33,000 of the 300 lines alone if letters are not looked at


def test_letter_counts_never_exceed_the_edits(spark):
    r, rows = random.Random(4), []
    for size in (20, 60, 300, 3000):
        for _ in range(40):
            base = list(" ".join(prose(r.randrange(10 ** 6), size))[:size].strip())
            other = list(base)
            for _ in range(len(base) // 10):
                at, kind = r.randrange(len(other)), r.randrange(3)
                other[at:at + 1] = [[r.choice("etaoxq \u00e9")], [], [other[at], r.choice("etao ")]][kind]
            rows.append(("".join(base), "".join(other)))
    rows += [("z" * 400 + "e" * 400, "z" * 440 + "e" * 360), ("\u4e00" * 30, "\u4e00" * 27), ("e" * 300, "t" * 300)]
    sides = [F.struct(F.length("norm").alias("size"), *lines._letter_counts()) for _ in "ab"]
    table = spark.createDataFrame([(i, j, t) for i, pair in enumerate(rows) for j, t in enumerate(pair)], "i int, j int, norm string").withColumn("n", lines._words(F.col("norm")))
    a, b = (table.where(F.col("j") == j).select("i", F.col("norm").alias("xy"[j]), sides[j].alias("ab"[j])) for j in (0, 1))
    near = F.expr("levenshtein(x, y) <= floor(greatest(length(x), length(y)) * 0.1 + 1e-9)")
    got = a.join(b, "i").select("i", near.alias("near"), lines._letters_agree("a", "b").alias("agree")).collect()
    assert sum(x.near for x in got) > 100 and all(x.agree for x in got if x.near)
    assert not {x.i: x.agree for x in got}[len(rows) - 1]


def test_pieces_part_long_lines_of_common_words_and_hide_no_link(spark):
    """Letters say little of long lines of common words; their pieces part them, and none that links is parted."""
    r, texts = random.Random(11), []
    for _ in range(12):
        words = ["".join(r.choice("etaoinsrhld") for _ in range(r.randint(4, 9))) for _ in range(120)]
        texts.append(" ".join(r.choice(["the", "of", "and", "in", "to", *words]) for _ in range(400))[:1500].strip())
    unrelated = [(i, j) for i in range(12) for j in range(i)]
    linked = []
    for base in [texts[0], texts[1], "\u00e9" * 30 + " ab " * 40, " ".join(prose(5, 9))]:
        k = len(base) // 10
        spread = list(base)
        for at in range(0, 10 * k, 10):
            spread[at] = "\u4e00"
        for other in (base[k:], "\u4e00" * (k // 2) + base[k // 2:], "".join(spread), base[:40] + "q" * (k // 2) + base[40 + k // 2:]):
            linked.append((len(texts), len(texts) + 1))
            texts += [base, other]
    linked += [(b, a) for a, b in linked]
    named = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "line long, norm string, size int")
    agree = {tuple(x) for x in lines._ends_agree(spark.createDataFrame(unrelated + linked, "a long, b long"), named).collect()}
    assert set(linked) <= agree and not agree & set(unrelated)


def test_second_round_pairs_lines_once(spark, monkeypatch):
    """Lines that share many blocks are paired in the first of these only, without a shuffle of all pairs that tells them apart."""
    given, verified, base = [], lines._verified, prose(40, 30)
    texts = [" ".join([*base[:i % 25], f"k{i}", "qq zz", *base[i % 25 + 3:]]) for i in range(80)]
    texts += [" ".join([*base[:12], *prose(900 + i, 18)]) for i in range(20)]

    def seen(pairs, named):
        given.append((pairs.count(), pairs.distinct().count(), pairs._jdf.queryExecution().optimizedPlan().toString()))
        return verified(pairs, named)

    monkeypatch.setattr(lines, "_verified", seen)
    table = spark.createDataFrame([(t,) for t in texts], "norm string").select(F.unhex(F.md5("norm")).alias("line"), "norm")
    got = {}
    for row in lines.line_groups(table).join(table, "line").collect():
        got.setdefault(bytes(row.group), set()).add(row.norm)
    monkeypatch.setattr(lines, "_verified", verified)
    pairs = near_pairs(texts)
    want = {}
    for text, root in zip(texts, roots(len(texts), pairs)):
        want.setdefault(root, set()).add(text)
    assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in want.values() if len(g) > 1)
    (_, _, _), (n, different, plan) = given
    assert n == different > 20 and not re.match("Aggregate|Deduplicate", plan.lstrip())


def test_line_dedup_runs_no_python(spark):
    docs = spark.createDataFrame([(1, " ".join(prose(1, 9)))], DOC)
    plan = lines.dedup(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def linked_by_edits_alone(spark, texts):
    """The groups that ``line_groups`` finds, and those of all pairs by edit similarity alone."""
    distinct = sorted(set(texts))
    pairs = near_pairs(distinct)
    want = {}
    for text, root in zip(distinct, roots(len(distinct), pairs)):
        want.setdefault(root, set()).add(text)
    table = spark.createDataFrame([(t,) for t in distinct], "norm string").select(F.unhex(F.md5("norm")).alias("line"), "norm")
    found = {}
    for row in lines.line_groups(table).join(table, "line").collect():
        found.setdefault(bytes(row.group), set()).add(row.norm)
    return sorted(map(sorted, found.values())), sorted(sorted(g) for g in want.values() if len(g) > 1)


def test_line_groups_equal_all_pairs_by_edit_similarity_alone(spark):
    r, texts = random.Random(3), []
    for words in (5, 7, 9, 12, 15, 20, 25, 30, 40, 50, 60):
        for copy in range(5):
            base = prose(1000 * words + copy, words)
            texts.append(" ".join(base))
            changed, at = list(base), r.randrange(words)
            changed[at] += "s"  # one letter more
            texts.append(" ".join(changed))
            for _ in range(max(1, words // 12)):  # words replaced
                changed[r.randrange(words)] = "".join(r.choice("aeiourstn") for _ in range(r.randint(2, 6)))
            texts.append(" ".join(changed))
    got, want = linked_by_edits_alone(spark, texts)
    assert len(want) > 50 and got == want


def test_a_document_stays_while_a_line_of_its_own_is_left(spark):
    line = " ".join(prose(1, 9))
    rows = [(1, line), (2, line + "\nmy own verse"), (3, line + "\n \u00a0\n"), (4, "***\n" + line), (5, line)]
    got = sorted(map(tuple, lines.dedup(spark.createDataFrame(rows, DOC)).collect()))
    assert got == [(1, line), (2, "my own verse"), (4, "***")]


def test_short_lines_and_lines_without_spaces_take_part(spark):
    han = "".join(chr(0x4E00 + 37 * i) for i in range(40))
    rows = [(1, "read more\nown line one"), (2, "Read more!\nown line two"), (3, han), (4, han + "\nlast"), (5, han[:20] + "x" + han[21:] + "\nend"), (6, "...\n...")]
    got = sorted(map(tuple, lines.dedup(spark.createDataFrame(rows, DOC)).collect()))
    assert got == [(1, rows[0][1]), (2, "own line two"), (3, han), (4, "last"), (5, "end"), (6, "...\n...")]


def test_recall_of_letters_edited_all_over_a_line(spark):
    """Letters replaced at random places, each pair alone among the others: found by length band and share of edits."""
    r, texts, pairs = random.Random(12), set(), []
    for words in (5, 8, 12, 20, 35, 60, 120):
        for share in (0.03, 0.06, 0.1):
            for copy in range(25):
                base = " ".join(prose(10_000 * words + int(1000 * share) + copy, words))
                changed = list(base)
                for at in r.sample(range(len(base)), int(len(base) * share)):
                    changed[at] = r.choice("bcdfgh") if base[at] != " " else " "
                texts |= {base, "".join(changed)}
                pairs.append((words, share, base, "".join(changed)))
    table = spark.createDataFrame([(t,) for t in texts], "norm string").select(F.unhex(F.md5("norm")).alias("line"), "norm")
    group = {row.norm: bytes(row.group) for row in lines.line_groups(table).join(table, "line").collect()}
    found, total = Counter(), Counter()
    for words, share, a, b in pairs:
        total[words, share] += 1
        found[words, share] += a == b or (a in group and group[a] == group.get(b))
    print({k: found[k] / total[k] for k in total})
    for key in total:  # words are long here (seven letters on average), so more of them are hit than in prose
        assert found[key] / total[key] >= {0.03: 0.95, 0.06: 0.8, 0.1: 0.4}[key[1]], (key, found[key] / total[key])
    assert sum(found.values()) / sum(total.values()) >= 0.85


def test_very_long_and_hot_lines(spark):
    """Lines of 60,000 characters with a few edits, and a block that hundreds of near copies share."""
    long = prose(3, 20_000)
    edited = list(long)
    for at in (5, 9000, 19_990):
        edited[at] = "zz"
    base = prose(4, 12)
    hot = [" ".join([*base[:6], f"k{i}", *base[7:]]) for i in range(300)]
    rows = [(1, " ".join(long)), (2, " ".join(edited)), *((10 + i, t) for i, t in enumerate(hot))]
    assert {d for d, _ in map(tuple, lines.dedup(spark.createDataFrame(rows, DOC)).collect())} == {1, 10}
