"""Operators 12 and 13 against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.llm import lexical, vectorcodes

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """Lloyd's rounds on Python integers; rows are (id, vector, label) in the order of the table's ids."""
    whole = [[math.floor(1024 * float(np.float32(x))) for x in v] for _, v, _ in rows]
    width = -(-len(whole[0]) // parts)
    whole = [v + [0] * (parts * width - len(v)) for v in whole]
    codes, errors, flat = [""] * len(rows), [0] * len(rows), []
    for p in range(parts):
        xs = [v[p * width:(p + 1) * width] for v in whole]
        book = [list(x) for x in xs[:entries]]

        def nearest(x, book=book):
            return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

        for _ in range(rounds):
            own = [nearest(x)[1] for x in xs]
            for i in range(len(book)):
                mine = [x for x, o in zip(xs, own) if o == i]
                if mine:
                    book[i] = [sum(c) // len(mine) for c in zip(*mine)]
        for n, x in enumerate(xs):
            d, i = nearest(x)
            codes[n] += f"{i:02x}"
            errors[n] += d
        flat += [x for e in book for x in e]
    return codes, errors, hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()


def compare_codes(spark, rows, usable):
    table = spark.createDataFrame(rows, VECTORS).withColumn("code", F.lit("clash")).withColumn("id", F.lit("clash")).withColumn("bounds", F.lit(1))
    done, books = vectorcodes.compress(table.repartition(3))
    codes, errors, digest = plain_codes(usable)
    got = sorted((r.id is None, r.id or 0, r.code, r.error, r.label or -1) for r in done.select("id", "code", "error", "label").collect())
    assert got == sorted((i is None, i or 0, c, min(e, (1 << 63) - 1), k or -1) for (i, _, k), c, e in zip(usable, codes, errors))
    assert books.digest() == digest
    totals = Counter()
    for (_, _, k), e in zip(usable, errors):
        totals[k] += min(e, (1 << 63) - 1)
    for r in vectorcodes.with_label_errors(done).collect():
        assert r.label_error == min(totals[r.label], (1 << 63) - 1)


def test_codes_equal_the_plain_algorithm(spark):
    r = random.Random(5)
    centres = [[r.gauss(0, 0.4) for _ in range(8)] for _ in range(12)]
    rows = [(i, [c + r.gauss(0, 0.05) for c in r.choice(centres)], r.choice([None, 1, 1, 2])) for i in range(700)]
    rows += [(1000 + i, rows[5][1], 1) for i in range(60)]  # copies, ties
    rows += [(None, rows[9][1], None)]
    bad = [(2000, None, 1), (2001, [None] * 8, 1), (2002, [float("nan")] * 8, 1), (2003, [float("-inf")] + [0.0] * 7, 2), (2004, [0.5] * 4, 2), (2005, [], 2)]
    compare_codes(spark, rows + bad, rows)


def test_codes_of_large_components_odd_lengths_and_small_tables(spark):
    r = random.Random(6)
    rows = [(i, [r.choice([1.0, -1.0]) * 10 ** r.uniform(-3, 14) for _ in range(6)], None) for i in range(20)] + [(30 + i, [3e38, -3e38, 1.0, 2.0, -1e30, 0.0], 7) for i in range(3)]
    compare_codes(spark, rows, rows)
    small = [(i, [0.25, -0.25, 0.5, 1.0], 0) for i in range(2)]
    compare_codes(spark, small, small)
    done, books = vectorcodes.compress(spark.createDataFrame([], VECTORS))
    assert done.count() == 0 and books.digest() == hashlib.sha256(b"").hexdigest()
    assert vectorcodes.with_label_errors(done).count() == 0
    assert vectorcodes.with_label_errors(vectorcodes.compress(spark.createDataFrame([(1, [], 1)], VECTORS))[0]).first().code == "00000000"


def test_labels_beyond_the_broadcast_bound_are_joined_salted(spark, monkeypatch):
    rows = [(i, [i / 7, 0.1, -i / 3, 0.2], i % 3 or None) for i in range(300)]
    done, _ = vectorcodes.compress(spark.createDataFrame(rows, VECTORS))
    done = done.withColumn("error", F.col("error") + 1)
    want = sorted(map(tuple, vectorcodes.with_label_errors(done).select("id", "label_error").collect()))
    monkeypatch.setattr(vectorcodes, "BROADCAST_LABELS", 1)
    assert sorted(map(tuple, vectorcodes.with_label_errors(done).select("id", "label_error").collect())) == want


def test_bounds_spare_work_and_change_nothing():
    """Rows settled without distances exist, full scans are few, and the codes are the nearest entries."""
    r = np.random.default_rng(3)
    centres = r.integers(-400, 400, size=(256, 16))
    x = centres[r.integers(0, 256, 4000)] + r.integers(-30, 30, size=(4000, 16))
    book = vectorcodes.Codebook(x[:256].tolist())
    state = vectorcodes.scan(x, book, 8)
    for b in (8, 16, 5):
        entries = [[int(v) + d for v in e] for e, d in zip(book.entries.tolist(), r.integers(-3, 4, 256).tolist())]
        moves = [float(np.sqrt(((np.array(a) - e) ** 2).sum())) + 1e-6 for a, e in zip(entries, book.entries)]
        book = vectorcodes.Codebook(entries, moves)
        state, depth = vectorcodes.moved(x, state, book, b)
        d2 = ((x[:, None, :] - book.entries[None]) ** 2).sum(axis=2)
        assert (state["code"] == d2.argmin(axis=1)).all()
        own = np.sqrt(d2[np.arange(4000), state["code"]])
        assert (state["upper"] >= own - 1e-9).all()
        roots = np.sqrt(d2)
        for row in range(0, 4000, 97):
            listed = {int(state["code"][row])} | set(state["ids"][row].tolist())
            others = [i for i in range(256) if i not in listed]
            assert all(roots[row, i] >= low for i, low in zip(state["ids"][row], state["low"][row]) if np.isfinite(low))
            assert roots[row, others].min() >= state["outer"][row]
        assert (depth == 0).mean() > 0.2 and (depth > b).mean() < 0.2


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k):
    known = [(i, Counter(words_of(t))) for i, t in docs]
    known = [(i, c, sum(c.values())) for i, c in known if c]
    total, length = len(known), sum(n for *_, n in known)
    df = Counter(t for _, c, _ in known for t in c)
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(words_of(t))
    out = []
    for item, terms in queries.items():
        scored = []
        for i, c, n in known:
            m = 10 + 90 * n * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank + 1, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(table):
    return sorted(map(tuple, table.collect()), key=str)


def test_ranking_equals_brute_force(spark, monkeypatch):
    r = random.Random(8)
    words = ["Ka", "lo-mi", "ren", "über", "Äpfel", "x1", "42", "so", "tu\x7fve", "don't", "漢字", "dor"] + [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    docs = [(i, text(r.choice([1, 3, 10, 10, 40]))) for i in range(300)]
    docs += [(400 + i, docs[7][1]) for i in range(40)]  # ties
    docs += [(7, docs[9][1]), (None, text(10)), (500, None), (501, ""), (502, " .,;\n"), (503, text(30_000))]
    items = [(i, text(8)) for i in range(12)] + [(3, text(2)), (20, None), (21, ""), (22, "no such term"), (23, "ÜBER"), (None, text(3))]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("m", F.lit("clash")).withColumn("item_id", F.lit(1))
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("score", F.lit(1))
    want = brute_search(docs, items, 10)
    assert found(lexical.search(d.repartition(5), q)) == want
    assert found(lexical.search(d, q, block_chars=60)) == want  # several blocks
    assert found(lexical.search(d, q, k=3)) == brute_search(docs, items, 3)
    monkeypatch.setattr(lexical, "CHUNK_DOCS", 3)
    assert found(lexical.search(d, q)) == want
    assert lexical.search(d.where("false"), q).count() == 0 and lexical.search(d, q.where("false")).count() == 0


def test_strata_are_skipped():
    """A stratum whose bound is below the k-th score is not read."""
    weights = np.array([100, 200, 300])
    one = lambda m, tf, docs: lexical.Stratum(m, docs, np.arange(len(docs)), np.full(len(docs), 2), np.full(len(docs), tf), weights)
    strata = [one(5000, 1, np.arange(100, 130)), one(20, 9, np.arange(12))]
    strata[0].scores = None  # reading it would fail
    best, = lexical.search_strata(strata, [[0, 2]], weights, 10)
    assert best.ids.tolist() == list(range(10)) and len(set(best.scores.tolist())) == 1
