"""The stream jobs: pass-through, windowed counts and raw landing.

Each query gets its own checkpoint folder, so each can restart by itself. A
``trigger`` of None drains what is there and stops (bounded replay); a text such
as '30 seconds' keeps the query running.
"""

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..sources import readers
from ..sources.writers import with_landing_keys

WATERMARK, WINDOW, TRIGGER = "10 minutes", "5 minutes", "30 seconds"
#: State partitions of a replay: a batch in order of time has few open windows, and every batch pays for each partition.
REPLAY_PARTITIONS = 8


@dataclass(frozen=True)
class StreamSettings:
    """What one query may set for itself; None leaves the session's setting."""

    trigger: str | None = "0 seconds"
    #: Files of a topic that one batch takes.
    max_files: int | None = None
    #: Partitions of the query's state. They are fixed with its first batch; a restart keeps them.
    state_partitions: int | None = None
    #: Batches whose state can be gone back to.
    batches_kept: int | None = None

    def options(self) -> dict[str, str]:
        return {} if self.max_files is None else {"maxFilesPerTrigger": str(self.max_files)}

    @contextmanager
    def applied(self, spark: SparkSession) -> Iterator[None]:
        """A query takes these from the session when it starts; the session has its own again after that."""
        wanted = {"spark.sql.shuffle.partitions": self.state_partitions, "spark.sql.streaming.minBatchesToRetain": self.batches_kept}
        before = {k: spark.conf.get(k, None) for k, v in wanted.items() if v is not None}
        for k in before:
            spark.conf.set(k, str(wanted[k]))
        try:
            yield
        finally:
            for k, v in before.items():
                if v is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)


def replay(spark: SparkSession, topic: str, settings: StreamSettings) -> DataFrame:
    """A file topic as a stream, taken as the settings say."""
    return readers.read_topic(spark, settings.options(), "parquet", topic, stream=True)


def stopped_after(query: StreamingQuery, batches: int, seconds: float = 600.0) -> int:
    """Stops a running query once it has finished so many batches; returns how many it had.

    A batch that is under way is cut off; its offsets are in the checkpoint, and the next start
    does it again. A query that fails raises its error.
    """
    end = time.monotonic() + seconds
    done = 0
    while query.isActive and time.monotonic() < end:
        progress = query.lastProgress
        done = max(done, progress["batchId"] + 1 if progress and progress["numInputRows"] else 0)
        if done >= batches:
            break
        time.sleep(0.05)
    query.stop()
    if query.exception():
        raise query.exception()
    return done


def _triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)


def parsed(records: DataFrame, schema, as_of: Column | None = None) -> DataFrame:
    """Record JSON to columns with the record time and a processing time."""
    rows = readers.parse_records(records.withColumnRenamed("timestamp", "kafka_timestamp"), schema, ("kafka_timestamp",))
    return rows.withColumn("processed_at", F.current_timestamp() if as_of is None else as_of)


def finance_passthrough(records: DataFrame) -> DataFrame:
    return parsed(records, readers.FINANCE_STREAM)


def tumbling_counts(rows: DataFrame, by: tuple[str, ...], time: str = "kafka_timestamp") -> DataFrame:
    """Rows per tumbling window and ``by``; rows older than the watermark are dropped."""
    return rows.withWatermark(time, WATERMARK).groupBy(F.window(time, WINDOW), *by).count()


def payment_counts(records: DataFrame) -> DataFrame:
    return tumbling_counts(parsed(records, readers.PAYMENTS_STREAM), ("transaction_status", "sender_age_group"))


def to_console(df: DataFrame, checkpoint: str, mode: str = "append", rows: int = 10,
               trigger: str | None = TRIGGER) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).format("console").option("truncate", "false").option("numRows", rows)
    return _triggered(writer.option("checkpointLocation", checkpoint), trigger).start()


def to_parquet(df: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = (),
               trigger: str | None = None) -> StreamingQuery:
    writer = df.writeStream.outputMode("append").format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _triggered(writer.option("checkpointLocation", checkpoint), trigger).start()


def updates_to_parquet(df: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
                       settings: StreamSettings = StreamSettings()) -> StreamingQuery:
    """Update mode to files: one folder per batch, replaced if the batch is retried."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = df.writeStream.outputMode("update").foreachBatch(write)
    with settings.applied(df.sparkSession):
        return _triggered(writer.option("checkpointLocation", checkpoint), trigger).start()


def latest_updates(spark: SparkSession, path: str, by: tuple[str, ...]) -> DataFrame:
    """The last emitted count per group."""
    rows = spark.read.parquet(path)
    return rows.groupBy("window", *by).agg(F.max_by("count", "batch").alias("count"))


def land_raw(records: DataFrame, path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Payments topic to raw parquet partitioned by year, month and status."""
    rows = readers.parse_records(records, readers.PAYMENTS_TYPED)
    return to_parquet(with_landing_keys(rows), path, checkpoint, ("year", "month", "status"), trigger)


def split_stream(records: DataFrame, schema, path: str, checkpoint: str, required: tuple[str, ...] = (), trigger: str | None = None) -> StreamingQuery:
    """Good rows and the quarantine of a topic, batch by batch; the folder of a batch is replaced if the batch is retried."""
    def write(batch: DataFrame, batch_id: int) -> None:
        readers.split_records(batch, f"{path}/batch={batch_id}", "overwrite")

    judged = readers.judged_records(records.withColumnRenamed("timestamp", "kafka_timestamp"), schema, required, ("kafka_timestamp",))
    writer = judged.writeStream.foreachBatch(write)
    return _triggered(writer.option("checkpointLocation", checkpoint), trigger).start()
