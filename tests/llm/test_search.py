"""Operators 3 and 7 against brute force."""

import random

from pyspark.sql import functions as F

from ledgerlens.llm import topk, urls


def brute(rows, k, every):
    from math import floor, isfinite

    ok = [(i, [floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and isfinite(x) for x in v)]
    out = []
    for q, v in ok:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q and len(w) == len(v))
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    r = random.Random(1)
    unit = lambda n: [r.gauss(0, 0.3) for _ in range(n)]
    rows = [(i, unit(19)) for i in range(230)]
    rows += [(i, rows[3][1]) for i in range(300, 340)]  # ties
    rows += [(400, None), (401, [None] * 19), (402, [float("nan")] * 19), (403, [float("inf")] + [0.0] * 18), (None, unit(19)), (500, unit(4)), (501, unit(4)), (600, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).withColumn("id", F.lit(0))
    exact = [tuple(x) for x in table.select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, topk.search(table, k=10, every=20).collect())) == brute(exact, 10, 20)
    assert sorted(map(tuple, topk.search(table.where("vec_id < 8 or vec_id = 500 or vec_id = 501"), k=10, every=1).collect())) == brute(
        [x for x in exact if x[0] is not None and (x[0] < 8 or x[0] in (500, 501))], 10, 1)
    assert topk.search(table.where("false")).count() == 0


def test_components_of_any_size_are_exact(spark):
    r = random.Random(9)
    sizes = [1.0, 63.9, 64.0, 65.0, 65536.0, 65537.0, 70000.0, 70000.0, 70000.0, 2.0**31, 2.0**45, 1e20, 3e38]
    rows = [(i, [r.choice([-1, 1]) * r.choice(sizes) * r.random() for _ in range(5)]) for i in range(120)]
    rows += [(200, [70000.0, 0.0, 0.0, 0.0, 0.0]), (201, [65536.0, 1.0, 0.0, 0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    exact = [tuple(x) for x in table.collect()]
    most = (1 << 63) - 1
    want = [(q, k, i, min(max(s, -most), most)) for q, k, i, s in brute(exact, 10, 10)]
    assert sorted(map(tuple, topk.search(table, k=10, every=10).collect())) == want
    some = [x for x in exact if max(map(abs, x[1])) < 2.0**18]
    assert sorted(map(tuple, topk.search(spark.createDataFrame(some, "vec_id long, embedding array<float>"), k=3, every=1).collect())) == brute(some, 3, 1)


def test_candidates_leave_early_and_nothing_is_lost():
    import numpy as np

    r = np.random.default_rng(2)
    rows = r.integers(-600, 600, size=(5000, 64))
    found = topk.Candidates(np.arange(5000), rows)
    for q in range(0, 200, 10):
        score = rows @ rows[q]
        order = np.lexsort((np.arange(5000), -score))
        want = [i for i in order if i != q][:10]
        ids, scores = found.best(q, rows[q], 10)
        assert ids.tolist() == want and scores.tolist() == score[want].tolist()


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def judged(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[:min([path.find(c) for c in "?#" if c in path] + [len(path)])]
    fit = [(len(h + p), len(h), v, h + p) for h, p, v in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[3] if best else None, best[2] if best else default


def test_urls_equal_brute_force(spark):
    r = random.Random(3)
    urls_ = [
        None, "", "no scheme", "http://", "http:///x", "HTTP://EXAMPLE.Net/en/", "http://a.example.net/en/x", "http://example.net", "http://net/", "http://notexample.net/en/",
        "ftp://x.org/fr/?q", "https://b.example.com/de/x#f", "https://example.com/DE/", "http://a://b.net/", "x://É.NET/", "http://a.b.c.d.e.net./", "http://net:80/", "http://org/fr/a\nb",
        "http://" + "a." * 300 + "org/fr/" + "x/" * 2000, "http://evil.test/a/b", "http://evil.test/a/bc",
    ]
    hosts, paths = ["net", "example.net", "a.example.com", "ORG", "x.org", "org.x"], ["", "/", "/en/", "/en", "/de/1", "/fr/?a", "#/fr/"]
    urls_ += [f"http://{r.choice(hosts)}{r.choice(paths)}" for _ in range(200)]
    rules = RULES + [("evil.test", "/a/b", "block"), ("test", "/a/", "allow")]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls_)] + [(5, urls_[5])] * 3, "page_id long, url string").withColumn("host", F.lit("clash"))
    got = urls.judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    want = [(i, *judged(u, rules)) for i, u in enumerate(urls_)] + [(5, *judged(urls_[5], rules))] * 3
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert urls.judge(pages.where("false"), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0
    assert {r.verdict for r in urls.judge(pages, spark.createDataFrame([], "host string, path string, verdict string")).collect()} == {"allow"}


def test_urls_with_a_long_list_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(urls, "BROADCAST_RULES", 1)
    pages = spark.createDataFrame([(i, f"http://h{i % 7}.net/en/{i}") for i in range(50)], "page_id long, url string")
    got = urls.judge(pages, spark.createDataFrame(RULES, "host string, path string, verdict string")).collect()
    assert len(got) == 50 and {r.rule for r in got} == {"net/"}
