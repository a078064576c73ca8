"""States by month, audited writes, quarantine, changed rows, statistics and sketches."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import finance, payments, quality
from ledgerlens.plans import elt, incremental, pipeline, star
from ledgerlens.sources import readers, testdata, writers
from ledgerlens.sources.versioned import VersionedTable
from ledgerlens.streaming import jobs

SMALL = "/root/testdata/sf0.001"


def test_a_load_makes_only_its_months_anew(spark, tmp_path):
    pairs = elt.joined(payments.clean_elt(testdata.payments_raw(spark, SMALL)), finance.clean_elt(testdata.finance_raw(spark, SMALL)))
    rows = pairs.payments.select(*incremental.BY, "transaction_amount", "fraud_flag", "is_weekend")
    stored, states = str(tmp_path / "stored"), str(tmp_path / "states")
    late = (F.col("transaction_year") == 1996) & (F.col("transaction_month") <= 2) & F.coalesce(F.col("is_weekend") == 1, F.lit(False))
    first = incremental.load(spark, rows.where(~late), stored, states)
    second = incremental.store_payments(rows.where(late), stored)
    assert set(second) <= set(first) and 1 <= len(second) <= 2
    for _ in range(2):  # a refresh that is repeated changes nothing
        read = incremental.refresh_states(spark.read.parquet(stored), second, states)
        found = incremental.behavior_from_states(spark.read.parquet(states), pairs)
        assert sorted(map(str, found.collect())) == sorted(map(str, elt.fact_spending_behavior_agg(pairs).collect()))
    files = {
        "/".join(r[0].split("/")[-3:-1]) for r in read.select(F.input_file_name()).distinct().collect()}
    assert files == {f"transaction_year={y}/transaction_month={m}" for y, m in second}
    assert "PartitionFilters: [" in read._jdf.queryExecution().toString().replace("PartitionFilters: []", "")


def test_uniqueness_is_one_scan(spark, tmp_path):
    spark.createDataFrame([(1, "a", 2), (1, None, 3), (2, None, 1)], "k int, s string, w int").write.parquet(str(tmp_path / "t"))
    checked = quality.check_uniqueness(spark.read.parquet(str(tmp_path / "t")), ("k", "s", "absent"), "w")
    assert checked._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r.column: (int(r.total_count), int(r.distinct_count), r.passed) for r in checked.collect()} == {"k": (6, 2, False), "s": (6, 2, False)}
    empty = quality.check_uniqueness(spark.createDataFrame([], "k int"), ("k",)).first()
    assert (int(empty.total_count), int(empty.distinct_count), empty.passed) == (0, 0, True)


def test_writes_are_counted_as_they_happen_and_failures_are_logged(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    assert writers.audited(spark.range(7), lambda df: df.write.parquet(out), "t", "LOAD", log) == 7
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.audited(spark.range(7), lambda df: df.write.parquet(out), "t", "LOAD", log)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        writers.audited(spark.range(3).select(F.expr("1 / (id - 1)")), lambda df: df.write.parquet(out + "2"), "t", "LOAD", log)
    found = sorted((r.status, r.record_count, bool(r.error_message)) for r in spark.read.parquet(log).collect() if r.status == "SUCCESS")
    assert found == [("SUCCESS", 7, False)]
    assert [r.record_count for r in spark.read.parquet(log).where("status = 'FAILED' AND error_message IS NOT NULL").collect()] == [None, None]


def test_malformed_records_are_kept_apart(spark, tmp_path):
    values = ['{"id": 1, "age": 30}', "{oops", "", None, '{"age": 5}', "[1, 2]", '{"id": "x"}', '{"id": 2}']
    schema = "id long, age int"
    records = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, n int")
    parsed = readers.judged_records(records, spark.createDataFrame([], schema).schema, ("id",), ("n",))
    good, bad = readers.split_records(parsed, str(tmp_path / "split"))
    assert sorted(r.n for r in good.collect()) == [0, 7] and good.columns == ["id", "age", "n"]
    reasons = {r.n: r._reason for r in bad.collect()}
    assert reasons[1] == readers.MALFORMED and reasons[2] == reasons[3] == readers.EMPTY and reasons[4] == readers.NO_KEY and set(reasons) == {1, 2, 3, 4, 5, 6}
    assert {r._raw for r in bad.collect()} == {values[i] for i in reasons}
    assert "PartitionFilters: [isnotnull(_state" in good._jdf.queryExecution().toString()


def test_a_stream_keeps_malformed_records_apart(spark, tmp_path):
    topic, out = str(tmp_path / "topic"), str(tmp_path / "out")
    rows = spark.createDataFrame([('{"transaction_id": "a"}',), ("{oops",), ("{}",)], "value string")
    rows.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.lit("2024-01-01").cast("timestamp").alias("timestamp")).write.parquet(topic)
    records = readers.read_topic(spark, {}, "parquet", topic, stream=True)
    jobs.split_stream(records, readers.PAYMENTS_STREAM, out, str(tmp_path / "ckpt"), ("transaction_id",)).awaitTermination()
    found = spark.read.parquet(out)
    assert {(r._state, r._reason) for r in found.collect()} == {("good", None), ("quarantine", readers.MALFORMED), ("quarantine", readers.NO_KEY)}


def test_only_changed_persons_move(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "p"), key="k", buckets=8)
    people = spark.createDataFrame([(i, "x", i % 3 or None) for i in range(50)], "k long, a string, b int")
    assert pipeline.load_persons(table, people, "1") == 50
    second = people.withColumn("b", F.when(F.col("k") == 6, 9).otherwise(F.col("b"))).unionByName(spark.createDataFrame([(99, None, None)], "k long, a string, b int"))
    assert sorted(r.k for r in star.changed_rows(table.read(), second, "k").collect()) == [6, 99]
    before = dict(table.manifest().live)
    assert pipeline.load_persons(table, second, "2") == 2 and pipeline.load_persons(table, second, "2") == 0 and pipeline.load_persons(table, second, "3") == 0
    after = table.manifest().live
    assert sum(before.get(b) != after[b] for b in after) <= 2
    assert sorted(map(tuple, table.read().collect()), key=str) == sorted(map(tuple, second.collect()), key=str)


def test_sketches_of_partitions_merge_within_the_rank_error(spark):
    r = random.Random(5)
    values = [(g, r.choice([None, 7.0, r.lognormvariate(3, 2)])) for g in range(6) for _ in range(3000)]
    df = spark.createDataFrame(values, "g int, x double")
    kept = quality.distribution_sketches(df, ("x",), ("g",))
    assert kept.count() == 6
    present = sorted(x for _, x in values if x is not None)
    for row in quality.sketched_quantiles(kept, (0.01, 0.25, 0.5, 0.9)).collect():
        below, upto = sum(x < row.quantile for x in present) / len(present), sum(x <= row.quantile for x in present) / len(present)
        assert row["count"] == len(present) and below - quality.RANK_ERROR <= row.prob <= upto + quality.RANK_ERROR


def test_statistics_decide_the_join_order(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS order_test")
    writers.save_table(spark.range(5000).select("id", (F.col("id") % 50).alias("a"), (F.col("id") % 1000).alias("b")), "order_test.fact", "overwrite")
    writers.save_table(spark.range(1000).select(F.col("id").alias("b"), F.lit("x").alias("bx")), "order_test.wide", "overwrite")
    writers.save_table(spark.range(50).select(F.col("id").alias("a"), (F.col("id") < 1).alias("picked")), "order_test.few", "overwrite")
    found = writers.column_statistics(spark, ["order_test.fact", "order_test.wide", "order_test.few"])
    row = found.where("table_name = 'fact' AND column_name = 'a'").first()
    assert (row.row_count, row.null_count, row.min_value, row.max_value, row.histogram) == (5000, 0, "0", "49", True)
    query = "SELECT * FROM order_test.fact JOIN order_test.wide USING (b) JOIN order_test.few USING (a) WHERE picked"
    settings = {"spark.sql.cbo.enabled": "true", "spark.sql.cbo.joinReorder.enabled": "true"}

    def first_joined():
        plan = spark.sql(query)._jdf.queryExecution().optimizedPlan().toString()
        return max(("few", "wide"), key=lambda t: next(len(x) - len(x.lstrip(" :+-|")) for x in plan.split("\n") if f"order_test.{t}" in x))

    before = first_joined()
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        after = first_joined()
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert (before, after) == ("wide", "few")
