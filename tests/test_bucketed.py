"""Bucketed writes and joins: files, plans, sizes, hot keys."""

import os
import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import keys
from ledgerlens.operators import finance, payments
from ledgerlens.plans import facts
from ledgerlens.sources import bucketed, testdata

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("bucketed"))
    people, sends = finance.clean_elt(testdata.finance_raw(spark, SMALL)), payments.clean_elt(testdata.payments_raw(spark, SMALL))
    return facts.write_star(spark, people, sends, "bucket_test", place, F.lit("2024-01-31").cast("date")), place


def files_of(folder):
    """Data files by folder and bucket."""
    out = {}
    for d, _, names in os.walk(folder):
        for n in names:
            found = re.search(r"_(\d{5})\.c\d+\..*parquet$", n)
            if found:
                out.setdefault((d, int(found[1])), []).append(n)
    return out


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_file_per_partition_and_bucket(spark, star):
    name, place = star
    for table, buckets, cells in (("fact_personal_finance", 8, 8), ("fact_upi_transaction", 16, None), ("dim_person", 8, None)):
        found = files_of(f"{place}/{table}")
        assert found and all(len(v) == 1 for v in found.values()) and {b for _, b in found} <= set(range(buckets))
        assert cells is None or len(found) == cells
        assert bucketed.bucketing(spark, f"{name}.{table}")[0] == buckets
        assert bucketed.table_bytes(spark, f"{name}.{table}") > 0


def test_joins_by_bucket_move_no_row_and_small_tables_are_broadcast(spark, star):
    name, _ = star
    pairs = ((f"{name}.fact_personal_finance", f"{name}.dim_person", "person_sk"),
             (f"{name}.clean_upi_transaction", f"{name}.fact_upi_transaction", "transaction_id"))
    for left, right, key in pairs:
        by_bucket = bucketed.join_tables(spark, left, right, key, small_bytes=-1)
        assert "SortMergeJoin" in plan(by_bucket) and "Exchange" not in plan(by_bucket)
        small = bucketed.join_tables(spark, left, right, key)
        assert "BroadcastHashJoin" in plan(small) and "SortMergeJoin" not in plan(small)
        between = (bucketed.table_bytes(spark, left) + bucketed.table_bytes(spark, right)) // 2
        one = plan(bucketed.join_tables(spark, left, right, key, small_bytes=between))  # just one side is small enough
        assert "BroadcastHashJoin" in one
        outer = plan(bucketed.join_tables(spark, left, right, key, "left", small_bytes=bucketed.table_bytes(spark, right) - 1))
        assert "SortMergeJoin" in outer and "Exchange" not in outer
        assert sorted(map(str, by_bucket.collect())) == sorted(map(str, small.collect()))


def test_a_hot_key_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(4000).select(F.when(F.col("id") < 2000, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS hot_bucket LOCATION '{tmp_path}/hot'")
    made = bucketed.save_bucketed(rows, "hot_bucket.t", 4, "k", mode="overwrite", file_rows=500)
    found = files_of(f"{tmp_path}/hot/t")
    assert len(found) == 4 and max(map(len, found.values())) >= 3
    hot = made.where("k = 7").groupBy(F.input_file_name()).count().collect()
    assert len(hot) >= 3 and max(r["count"] for r in hot) < 1500 and made.count() == 4000
    empty = bucketed.save_bucketed(rows.where("false"), "hot_bucket.e", 4, "k", mode="overwrite")
    assert empty.count() == 0


def test_no_task_writes_two_buckets_of_a_partition(spark):
    """Cells were dealt by hash before: of 16 buckets in 16 tasks some met, and one task read four of them."""
    rows = spark.range(8000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("p"))
    for by, file_rows in (((), 4000), ((), 200), (("p",), 4000), (("p",), 50)):
        dealt = bucketed.clustered(rows, 16, "k", by, file_rows).select(
            "k", *by, bucketed.bucket_of(16, "k").alias("bucket"), F.spark_partition_id().alias("task"))
        assert dealt.count() == dealt.select("k").distinct().count() == 8000
        assert dealt.groupBy("task", *by).agg(F.countDistinct("bucket").alias("n")).agg(F.max("n")).first()[0] == 1
        if not by:
            assert dealt.groupBy("task").count().agg(F.max("count")).first()[0] < 1.5 * min(file_rows, 500)


def test_surrogate_keys_do_not_collide(spark):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("~", "x"), (None, "x"), ("1:a", "b"), ("", "a"), ("a", ""), (None, None), ("~", "~"), ("", "")], "a string, b string")
    assert rows.select(keys.stable_id(("a", "b"))).distinct().count() == 10
