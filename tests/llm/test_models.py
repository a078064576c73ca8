"""Operators 4, 5 and 8."""

import math
import re
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import decontam, quality, toxicity

from .conftest import DOC, prose


def auc(pairs):
    good, bad = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


# ---- benchmark decontamination

def test_block_max_wand_equals_scoring_everything():
    r = random.Random(1)
    index = decontam.ImpactIndex([(i, " ".join(prose(i, r.randint(5, 60)) + prose(1, r.randint(0, 9)))) for i in range(120)])
    for _ in range(800):
        terms = r.sample(range(len(index.terms)), min(len(index.terms), r.randint(1, 80)))
        threshold, scores = r.choice([0.02, 0.05, 0.1, 0.3]), {}
        for t in terms:
            for place, weight in zip(*index.postings[t][:2]):
                scores[place] = scores.get(place, 0) + weight
        want = {i for i, s in scores.items() if s >= threshold - 1e-9}
        assert {i for i, _ in index.search(terms, threshold)} == want
        assert not want or index.can_reach(np.array(sorted(terms)), threshold)


ITEMS = [(1, "What is the melting point of zorbium?\nIt melts at ninety kelvin exactly."), (2, " ".join(prose(50, 40)) + "."), (3, "tiny item"), (4, None), (5, "")]


def test_contaminated_documents(spark):
    filler = lambda seed, n=300: " ".join(prose(seed, n))
    question, answer = ITEMS[0][1].split("\n")
    rows = [
        (1, filler(1) + " " + ITEMS[0][1].upper().replace("\n", "  ") + " " + filler(2)), (2, filler(3) + question + " " + filler(4)), (3, answer),
        (4, filler(5)), (5, None), (6, ""), (7, "x " * 20000 + ITEMS[1][1] + " y" * 20000), (8, "a tiny item here"), (8, "a tiny item here"), (None, ITEMS[1][1]),
    ]
    docs = spark.createDataFrame(rows, DOC).withColumn("matches", F.lit("clash")).withColumn("item_id", F.lit(0))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert sorted(map(str, ((r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()))) == sorted(map(str, [(1, 1), (7, 2), (8, 3), (8, 3), (None, 2)]))
    kept = decontam.clean(docs.drop("matches"), items)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 6] and kept.columns == ["doc_id", "text", "item_id"]
    assert decontam.contaminated(docs.where("false"), items).count() == 0
    assert decontam.clean(docs.drop("matches"), items.where("false")).count() == len(rows)


def plain_matches(docs, items):
    """Every passage against every item: BM25 from its formula, then shingles of question and answer."""
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    known = [(i, t, words(t)) for i, t in items if words(t)]
    if not known:
        return []
    mean, longest = sum(len(w) for *_, w in known) / len(known), max(len(w) for *_, w in known)
    df = Counter(w for *_, ws in known for w in set(ws))

    def weights(ws):
        out = {w: math.log(1 + (len(known) - df[w] + 0.5) / (df[w] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(ws) / mean)) for w, n in Counter(ws).items()}
        return {w: x / sum(out.values()) for w, x in out.items()}

    def share(part, passage):
        n = min(5, len(part))
        own = {tuple(part[i:i + n]) for i in range(len(part) - n + 1)}
        return len(own & {tuple(passage[i:i + n]) for i in range(len(passage) - n + 1)}) / len(own) if part else 1.0

    out = {}
    for d, text in docs:
        ws = words(text)
        for start in range(0, max(len(ws) - longest, 1), longest):
            passage = ws[start:start + 2 * longest]
            for i, t, iw in known:
                score = sum(x for w, x in weights(iw).items() if w in set(passage))
                cut = [m.end() for m in re.finditer(r"[.!?:]\s+|\n+", t.rstrip())]
                question, answer = words(t[:cut[-1]] if cut else ""), words(t[cut[-1]:] if cut else t)
                if score >= 0.6 and share(question, passage) >= 0.8 and share(answer, passage) >= 0.8:
                    best = (score, share(question, passage), share(answer, passage))
                    out[d, i, t] = max(out.get((d, i, t), best), best)
    return sorted((str(d), str(i), round(x[0], 9), round(x[1], 9), round(x[2], 9)) for (d, i, _), x in out.items())


def test_matches_equal_every_passage_against_every_item(spark, monkeypatch):
    r = random.Random(6)
    items = [(i, " ".join(prose(i, r.randint(8, 30))) + "? " + " ".join(prose(400 + i, r.randint(2, 12)))) for i in range(20)]
    items += [(3, "short one"), (None, " ".join(prose(70, 15))), (30, None)]
    docs = []
    for d in range(30):
        text = prose(900 + d, r.randint(0, 80))
        for _ in range(r.randint(0, 2)):
            part = (r.choice(items[:-1])[1]).split(" ")
            for _ in range(r.choice([0, 0, 1, 3, 6])):  # words replaced: near the thresholds
                part[r.randrange(len(part))] = "other"
            at = r.randint(0, len(text))
            text[at:at] = part
        docs.append((d, " ".join(text)))
    docs += [(93, "x " + items[-2][1]), (90, None), (91, ""), (92, " ".join(prose(5, 3000)) + " " + items[0][1])]
    want = plain_matches(docs, items)
    assert len(want) > 15 and any(i == "None" for _, i, *_ in want)
    d, q = spark.createDataFrame(docs, DOC), spark.createDataFrame(items, "item_id long, text string")
    found = lambda: sorted((str(x.doc_id), str(x.item_id), *(round(v, 9) for v in (x.score, x.question_overlap, x.answer_overlap))) for x in decontam.contaminated(d, q).collect())
    assert found() == want
    monkeypatch.setattr(decontam, "SHARD_CHARS", 900)  # several indexes give the same scores
    assert found() == want


# ---- toxicity

@pytest.fixture(scope="module")
def restorer():
    text = ("you are such an idiot and a clown what a stupid worthless loser this is the moron of the year " * 30 + " ".join(prose(3, 3000))).lower()
    counts = np.zeros(toxicity.SYMBOLS**3)
    s = toxicity.symbols(text, toxicity._classes())
    np.add.at(counts, (s[:-2] * 27 + s[1:-1]) * 27 + s[2:], 1)
    return toxicity.Restorer(toxicity.trigram_costs(counts))


def test_disguises_are_undone(restorer):
    known = toxicity.Restored(restorer)
    for disguised, plain in (("1d10t", "idiot"), ("1diot!!", "idiot"), ("stup!d", "stupid"), ("cl0wn", "clown"), ("l0$er", "loser"), ("idiiiiot", "idiot"), ("moooooron", "moron"),
                             ("you are an i d i o t", "you are an idiot"), ("m-o-r-o-n", "moron"), ("STUUUPID", "stupid")):
        assert known.text(disguised) == plain, (disguised, known.text(disguised))
    for plain in ("letter book", "été über", "", "a b", "well-known"):
        assert toxicity.Restored(restorer).text(plain).replace(" ", "") == plain.replace("-", "").replace(" ", "") or plain == "well-known"


def test_viterbi_finds_the_cheapest_path(restorer):
    from itertools import product

    for word in ("1d10t", "c1!wn", "a55", "m00n", "b|g", "x y z", "tttt0"):
        best = None
        for path in product(*restorer._choices(word)):
            cost, x, y, out = sum(c for _, c in path), 0, 0, []
            for s in [s for letters, _ in path for s in letters] + [0]:
                if s or y:
                    cost += restorer.costs[x][y][s]
                    x, y = y, s
                    out.append(chr(s + 96) if s else " ")
            here = (cost, "".join(out).strip())
            best = min(best or here, here)
        assert restorer.decode(word) == best[1]


def test_toxicity_of_rows(spark):
    r = random.Random(5)
    bad = ["idiot", "clown", "worthless"]
    rows, labels = [], []
    for i in range(400):
        words, toxic = prose(i, r.randint(5, 80)), i % 3 == 0
        if toxic:
            words[r.randrange(len(words))] = r.choice(bad + ["1d10t", "cl0wn", "i d i o t"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(900, None), (901, ""), (902, "idiot " * 20000), (902, "idiot " * 20000), (None, "clown")]
    docs = spark.createDataFrame(rows, DOC).withColumn("score", F.lit("clash"))
    table = spark.createDataFrame(labels + [(0, None), (None, 1), (3, 1)], "doc_id long, toxic int")
    fold = quality.held_out(F.col("doc_id"), 5, 0)
    model = toxicity.fit(docs, table.where(~fold))
    out = toxicity.score(docs, model).withColumn("held", fold).collect()
    assert len(out) == len(rows) and all(0 <= x.score <= 1 for x in out)
    truth = dict(labels)
    assert auc([(x.score, truth[x.doc_id]) for x in out if x.held and x.doc_id in truth]) > 0.9
    by = {x.doc_id: x.score for x in out}
    assert by[902] > 0.5 and by[900] == by[901] and by[901] < 0.5
    none = toxicity.fit(docs.where("false"), table.where("false"))
    assert {round(x.score, 3) for x in toxicity.score(docs, none).collect()} == {0.5}
    assert toxicity.score(docs.where("false"), model).count() == 0


def test_trigram_counts_cover_every_document(spark):
    rows = [(i, "abc" * i) for i in range(50)] + [(99, None)]
    counts = toxicity.count_trigrams(spark.createDataFrame(rows, DOC).repartition(7))
    assert counts[(1 * 27 + 2) * 27 + 3] == sum(range(50))


# ---- quality

def test_quality_of_rows(spark):
    r = random.Random(6)
    rows, labels = [], []
    for i in range(300):
        good = i % 3 != 0
        words = prose(i, r.randint(30, 200))
        rows.append((i, " ".join(words) if good else "!! ".join(words).upper()))
        labels.append((i, int(good)))
    rows += [(900, None), (901, ""), (902, "word " * 60000), (None, "x"), (903, "same"), (903, "same")]
    docs = spark.createDataFrame(rows, DOC).withColumn("good_bytes", F.lit("clash"))
    table = spark.createDataFrame(labels + [(5, None), (None, 0)], "doc_id long, quality int")
    fold = quality.held_out(F.col("doc_id"), 4, 2)
    model = quality.fit(docs, table.where(~fold))
    out = quality.score(docs, model).withColumn("held", fold).collect()
    truth = dict(labels)
    assert len(out) == len(rows) and all(0 <= x.score <= 1 for x in out)
    assert auc([(x.score, truth[x.doc_id]) for x in out if x.held and x.doc_id in truth]) > 0.98
    assert quality.fit(docs, table.where(~fold)) == model  # the same model from the same rows
    none = quality.fit(docs, table.where("false"))
    assert {x.score for x in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.where("false"), model).count() == 0


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    import zlib

    ids = spark.range(200).select(F.col("id").alias("doc_id"))
    got = {x.doc_id for x in ids.where(quality.held_out(F.col("doc_id"), 4, 2)).collect()}
    assert got == {i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2}
