"""Bounded replays, late rows and restarts."""

import os

from pyspark.sql import functions as F

from ledgerlens.sources import readers, writers
from ledgerlens.streaming import jobs

BY = ("transaction_status", "sender_age_group")
VALUE = '{"transaction_id": "%s", "transaction_status": "SUCCESS", "sender_age_group": "18-25"}'


def put(spark, path, times):
    rows = [(VALUE % i, t) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "value string, t string")
    df.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
              F.col("t").cast("timestamp").alias("timestamp")).coalesce(1).write.mode("append").parquet(path)


def counts(spark, folder, tmp_path):
    records = readers.read_topic(spark, {"maxFilesPerTrigger": "1"}, "parquet", folder, stream=True)
    jobs.updates_to_parquet(jobs.payment_counts(records), str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    found = jobs.latest_updates(spark, str(tmp_path / "out"), BY)
    return {str(r.window.start)[11:16]: r["count"] for r in found.collect()}


def test_counts_survive_restart_and_drop_late_rows(spark, tmp_path):
    topic = str(tmp_path / "topic")
    put(spark, topic, ["2024-01-02 10:00:01", "2024-01-02 10:04:59", "2024-01-02 10:05:00"])
    assert counts(spark, topic, tmp_path) == {"10:00": 2, "10:05": 1}
    # a restart sees only the new file; the open window goes on counting
    put(spark, topic, ["2024-01-02 10:06:00", "2024-01-02 11:00:00"])
    assert counts(spark, topic, tmp_path) == {"10:00": 2, "10:05": 2, "11:00": 1}
    put(spark, topic, ["2024-01-01 10:00:00", "2024-01-02 11:01:00"])  # the first is a day late
    assert counts(spark, topic, tmp_path) == {"10:00": 2, "10:05": 2, "11:00": 2}


def test_landing_stream_and_console(spark, tmp_path):
    topic = str(tmp_path / "topic")
    put(spark, topic, ["2024-01-02 10:00:01"])
    records = readers.read_topic(spark, {}, "parquet", topic, stream=True)
    jobs.land_raw(records, str(tmp_path / "raw"), str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "raw")).select("status").first().status == "SUCCESS"
    jobs.to_console(jobs.finance_passthrough(records), str(tmp_path / "c2"), trigger=None).awaitTermination()


def test_topic_files_are_bounded_and_follow_each_other(spark, tmp_path):
    topic = str(tmp_path / "topic")
    times = [f"2024-01-02 {10 + i // 40:02d}:{i % 40:02d}:00" for i in range(200)] + ["2024-01-03 00:00:00"] * 300 + [None] * 5
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(times)], "value string, t string").select("value", F.col("t").cast("timestamp").alias("timestamp"))
    made = writers.write_in_time_order(rows.repartition(5), topic, file_rows=50)
    made += writers.write_in_time_order(rows.limit(10), topic, file_rows=50)
    files = sorted((os.stat(f"{topic}/{n}").st_mtime, f"{topic}/{n}") for n in os.listdir(topic) if n.endswith(".parquet"))
    assert len({t for t, _ in files}) == len(files) and len(files) <= made == 12
    sizes = [spark.read.parquet(f).count() for _, f in files]
    assert sum(sizes) == 515 and max(sizes) < 150  # 300 rows of one time are spread
    spans = [spark.read.parquet(f).agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).first() for _, f in files[:-1]]
    spans = [x for x in spans if x.a]
    assert all(x.b <= y.a for x, y in zip(spans, spans[1:]))


def test_a_stopped_count_goes_on_from_its_checkpoint(spark, tmp_path):
    """Stopped in the middle of a replay, with state partitions of its own; nothing is counted twice or lost."""
    topic, out, ckpt = (str(tmp_path / n) for n in ("topic", "out", "ckpt"))
    times = [f"2024-01-02 {10 + i // 60:02d}:{i % 60:02d}:30" for i in range(300)]
    for part in range(10):
        put(spark, topic, times[30 * part:30 * part + 30])
    settings, session = jobs.StreamSettings(max_files=1, state_partitions=3, batches_kept=5), spark.conf.get("spark.sql.shuffle.partitions")
    done = jobs.stopped_after(jobs.updates_to_parquet(jobs.payment_counts(jobs.replay(spark, topic, settings)), out, ckpt, settings.trigger, settings), 3)
    assert 3 <= done < 10 and spark.conf.get("spark.sql.shuffle.partitions") == session
    assert len([n for n in os.listdir(f"{ckpt}/state/0") if n.isdigit()]) == 3
    jobs.updates_to_parquet(jobs.payment_counts(jobs.replay(spark, topic, settings)), out, ckpt, None, settings).awaitTermination()
    found = jobs.latest_updates(spark, out, BY).collect()
    assert sum(r["count"] for r in found) == 300 and len(found) == 60 and {r["count"] for r in found} == {5}
    kept = sorted(int(n) for n in os.listdir(f"{ckpt}/commits") if n.isdigit())
    assert kept[-1] >= 9 and len(kept) <= 7  # of all batches the last ones


def test_late_rows_are_replayed_in_large_batches(spark, monkeypatch):
    """Two files a batch and a state partition for each shuffle partition before, whatever the topic's size."""
    import __spark_entry__ as entry

    used, start = [], jobs.updates_to_parquet
    monkeypatch.setattr(writers, "TOPIC_FILE_ROWS", 50)
    monkeypatch.setattr(jobs, "updates_to_parquet", lambda *a: used.append((a[2], start(*a))) or used[-1][1])
    late, plain = (make(spark, "/root/testdata/sf0.001").collect() for make in (entry.stream_late_drop, entry.stream_tumbling_count))
    assert sorted(late, key=str) == sorted(plain, key=str)  # no late record is counted
    for checkpoint, query in used:
        batches = [int(n) for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()]
        assert max(batches) + 1 <= 8 and len([n for n in os.listdir(f"{checkpoint}/state/0") if n.isdigit()]) == jobs.REPLAY_PARTITIONS
