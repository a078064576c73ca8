"""Operator 11: held-out accuracy, rejection and odd texts."""

import random

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.llm import language, queries
from ledgerlens.llm.common import table

SAMPLES = {
    "aa": ["kalomi", "renso", "tuve", "mikalo", "sorenka", "vetumi"], "bb": ["schragt", "wurzeln", "krachz", "strump", "knecht", "gwurz"],
    "cc": ["αλφα", "βητα", "γαμμα", "δελτα", "θητα"],
}


def rows(n, seed):
    r = random.Random(seed)
    return [(i, " ".join(r.choice(SAMPLES[lang]) for _ in range(r.randint(1, 30))), lang)
            for i, lang in enumerate(r.choice(list(SAMPLES)) for _ in range(n))]


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = queries.op11_language_id(spark, d).join(table(spark, d, "documents").select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(got) == table(spark, d, "documents").count()
    held = [r for r in got if r.held_out and r.lang is not None and any(c.isalpha() for c in r.text or "")]
    assert len(held) > 200 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_texts_and_clashing_columns(spark):
    learnt = rows(300, 1) + [(900, None, "aa"), (901, "12 34", "aa"), (902, "kalomi tuve", None), (903, "", "zz")]
    model = language.fit(spark.createDataFrame(learnt, "doc_id long, text string, lang string").repartition(4))
    assert set(model.languages) == set(SAMPLES)
    odd = [(1, None), (2, ""), (3, " 12 .;\n"), (4, "kalomi renso"), (5, "STRUMP knecht!"), (6, "γαμμα"), (7, "kalomi " * 60_000), (4, "kalomi renso"), (None, "tuve"), (8, "漢字仮名")]
    asked = spark.createDataFrame(odd, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("lang", F.lit("bb"))
    got = language.predict(asked, model).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got if r.doc_id != 8) == sorted(
        [(1, "und"), (2, "und"), (3, "und"), (4, "aa"), (4, "aa"), (5, "bb"), (6, "cc"), (7, "aa"), (0, "aa")])
    assert {r.score for r in got if r.doc_id in (1, 2, 3)} == {0.0} and all(r.lang == "bb" for r in got)
    far, = (r for r in got if r.doc_id == 8)
    assert far.rejected and far.lang_pred in SAMPLES
    assert language.predict(asked.where("doc_id = 8"), model, reject=True).first().lang_pred == "und"
    assert language.predict(asked.where("false"), model).count() == 0


def test_a_model_without_rows_knows_nothing(spark):
    model = language.fit(spark.createDataFrame([(1, "kalomi", None)], "doc_id long, text string, lang string"))
    assert language.predict(spark.createDataFrame([(1, "kalomi")], "doc_id long, text string"), model).first().lang_pred == "und"


def test_the_nearest_centroid_wins(spark):
    """Predictions against a plain cosine with every centroid; the model does not depend on the order of rows."""
    learnt = spark.createDataFrame(rows(400, 2), "doc_id long, text string, lang string")
    model, again = language.fit(learnt.repartition(5)), language.fit(learnt.orderBy(F.desc("text")).coalesce(1))
    assert model.languages == again.languages and np.allclose(model.idf, again.idf)
    asked = rows(120, 3)
    got = {r.doc_id: r for r in language.predict(spark.createDataFrame(asked, "doc_id long, text string, lang string"), model).collect()}
    for i, text, lang in asked:
        x = np.zeros(language.BUCKETS)
        at, weights = language.vector(language.gram_counts(text), model.idf)
        x[at] = weights
        cosines = model.centroids.astype(float) @ x
        assert abs(got[i].score - min(max(cosines.max(), 0), 1)) < 1e-4
        assert cosines[[k for k, name in enumerate(model.languages) if name == got[i].lang_pred]].max() > cosines.max() - 1e-4
    counts = [list(model.languages).count(x) for x in SAMPLES]
    assert min(counts) >= 2  # several centroids of a language
