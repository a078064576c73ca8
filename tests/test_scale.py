"""Sizes and values that small tables do not have: long keys, large ids, large totals, dense values, hot keys."""

import random

from pyspark.sql import functions as F

from ledgerlens.functions import buckets, exact, keys, quantiles
from ledgerlens.operators import finance
from ledgerlens.plans import warehouse
from ledgerlens.sources import testdata


def test_long_order_keys_stay_apart(spark, tmp_path):
    orders = spark.createDataFrame([(12345678901, 1, 10.0), (12345678902, 2, 20.0), (7, 3, 5.0)], "o_orderkey long, o_custkey long, o_totalprice double").withColumns(
        {"o_orderdate": F.lit("1995-01-01").cast("date"), "o_orderstatus": F.lit("O")})
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    ids = {r.transaction_id for r in testdata.payments_raw(spark, str(tmp_path)).select("transaction_id").collect()}
    assert ids == {"TXN12345678901", "TXN12345678902", "TXN000000007"}


def test_large_person_ids_are_kept(spark):
    raw = testdata.finance_raw(spark, "/root/testdata/sf0.001").withColumn("id", F.col("id") + 3_000_000_000)
    people = finance.clean_elt(raw)
    assert people.count() > 100 and people.agg(F.min("person_id")).first()[0] > 3_000_000_000


def test_large_totals_are_not_nulled(spark):
    got = spark.createDataFrame([(1e29,), (0.005,), (2.5e27,), (None,)], "x double").select(exact.half_up(F.col("x"), 2).alias("y")).collect()
    assert [r.y for r in got] == [1e29, 0.01, 2.5e27, None]


def test_buckets_rise_with_the_values_and_stay_small(spark):
    r = random.Random(1)
    values = sorted({r.uniform(5, 25) for _ in range(20000)} | {s * 2.0**e * f for s in (1, -1) for e in range(-40, 80, 7) for f in (1, 1.5, 0.9999999999999999)} | {0.0, 1e300, -1e-300, float("inf")})
    got = [x.b for x in spark.createDataFrame([(v,) for v in values], "v double").select("v", buckets.value_bucket(F.col("v")).alias("b")).orderBy("v").collect()]
    assert got == sorted(got) and None not in got
    dense = spark.range(200_000).select((5 + F.col("id") / 10_000).alias("v"))
    largest = dense.groupBy(buckets.value_bucket(F.col("v"))).count().agg(F.max("count")).first()[0]
    assert largest <= 10
    quartiles = quantiles.exact_quantiles(dense, "v", (0.25, 0.5, 0.75)).orderBy("prob").collect()
    assert [round(q.quantile, 4) for q in quartiles] == [9.9999, 14.9999, 19.9999]


def test_row_numbers_of_a_hot_key_come_from_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keys, "new_path", lambda *_: str(tmp_path / "numbered"))
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "").otherwise(F.col("id").cast("string")).alias("k"), (F.col("id") * 7 % 1000).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = keys.row_numbers(rows, "n", ("k",))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.n for r in out.orderBy("k", "v").collect()] == list(range(1, 6001))
    written = spark.read.parquet(str(tmp_path / "numbered")).where("k = ''")
    assert written.select(F.input_file_name().alias("file")).distinct().count() > 1


def test_keys_do_not_depend_on_other_rows(spark):
    names = spark.createDataFrame([("food",), ("fuel",), (None,)], "category_name string")
    key = keys.stable_id(("category_name",))
    all_ = {r[0]: r[1] for r in names.select("category_name", key).collect()}
    one = {r[0]: r[1] for r in names.where("category_name = 'fuel'").select("category_name", key).collect()}
    assert one.items() <= all_.items() and len(set(all_.values())) == 3
    assert keys.id_collisions(names.withColumn("id", key), "id").count() == 0
    labels = spark.createDataFrame([("Seniors",)], "age_category string")

    class Pairs:
        def matched_payments(self):
            return labels

    assert warehouse.dim_age_category(Pairs()).first().age_category_id == 3
