"""Sinks, catalog set-up and table statistics."""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .workspace import new_path


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> None:
    """Partitioned parquet. REBALANCE brings the rows of a partition together, and lets
    adaptive execution split a hot partition over many tasks and merge the small ones."""
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def land_raw_payments(payments: DataFrame, path: str) -> None:
    """Raw landing by year, month and status of the record; an unreadable time goes under NULL."""
    write_partitioned(with_landing_keys(payments), path, ("year", "month", "status"))


#: Rows of one file of a replay topic, and files that a replay takes at once: a batch is bounded whatever the topic's size.
TOPIC_FILE_ROWS, BATCH_FILES = 100_000, 8


def write_in_time_order(records: DataFrame, path: str, time: str = "timestamp", file_rows: int = TOPIC_FILE_ROWS) -> int:
    """A file topic whose files follow each other in time, for a replay in bounded batches; returns the number of files.

    Rows are dealt by ranges of time, and of a hash of the row where many share a time, into as
    many files as their number asks for; all are written by one job. A stream takes files by
    their age, so the files are given ages in the order of their ranges, after those that the
    folder has already: no row of a replay is late. Rows without a time go first.
    """
    spark = records.sparkSession
    files = max(-(-records.count() // file_rows), 1)
    spread = F.xxhash64(*[F.col(f"`{n}`") for n in records.columns])
    at = spark._jvm.org.apache.hadoop.fs.Path
    folder = at(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    before = {s.getPath().getName(): s.getModificationTime() for s in system.listStatus(folder)} if system.exists(folder) else {}
    records.repartitionByRange(files, F.col(time).asc_nulls_first(), spread).write.mode("append").parquet(path)
    made = sorted(n for n in (s.getPath().getName() for s in system.listStatus(folder)) if n.startswith("part-") and n not in before)
    start = max([*before.values(), 0]) + 1000
    now = spark._jvm.java.lang.System.currentTimeMillis()
    start = max(start, now - 1000 * len(made))
    for i, name in enumerate(made):  # part numbers follow the ranges
        system.setTimes(at(folder, name), start + 1000 * i, -1)
    return len(made)


def with_landing_keys(payments: DataFrame) -> DataFrame:
    when = F.col("timestamp").try_cast("timestamp")
    return payments.withColumns({
        "year": F.date_format(when, "yyyy"), "month": F.date_format(when, "MM"),
        "status": F.upper(F.trim("transaction_status")),
    })


def save_table(df: DataFrame, name: str, mode: str = "error", partition_by: Sequence[str] = (),
               bucket_by: tuple[int, str] | None = None) -> None:
    """CREATE TABLE AS SELECT. The mode is explicit: a table left from before is never silently kept.

    Rows of a partition are brought together before the write. Bucketed tables are written by
    ``bucketed.save_bucketed``, which does so for buckets, too.
    """
    writer = (df.hint("rebalance", *partition_by) if partition_by else df).write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by)
    writer.saveAsTable(name)


def insert_overwrite(df: DataFrame, name: str) -> None:
    """Full refresh of a table, columns matched by name."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.mode("overwrite").insertInto(name)


def merge_by_key(df: DataFrame, name: str, key: str) -> None:
    """Rows of ``df`` replace those of the table with their key; the other rows stay.

    For small dimension tables of the catalog: the merged table is staged and written whole. A
    large table, or one that must survive a crash in between, is a ``versioned.VersionedTable``.
    Of several rows of one key in ``df`` the greatest by the other columns counts.
    """
    spark, staged = df.sparkSession, new_path(df.sparkSession, "merged")
    names = spark.table(name).columns
    rest = [n for n in names if n != key]
    new = df.groupBy(key).agg(F.max(F.struct(*rest)).alias("_row")).select(*[F.col(n) if n == key else F.col(f"_row.{n}") for n in names])
    # read once: what is counted while it is written is counted once, too
    loaded = f"{staged}-new"
    new.write.parquet(loaded)
    new = spark.read.schema(new.schema).parquet(loaded)
    kept = spark.table(name).join(new.select(key), key, "left_anti").select(*names)
    kept.unionByName(new).write.parquet(staged)
    insert_overwrite(spark.read.parquet(staged), name)


def refresh_partitions(df: DataFrame, name: str) -> None:
    """Replace just the partitions present in ``df``: re-running a load adds nothing twice.

    ``insertInto`` takes the overwrite mode from the session, so it is set for this write only.
    """
    spark, setting = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        df.select(*spark.table(name).columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, before)


def append_rows(df: DataFrame, name: str) -> None:
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.mode("append").insertInto(name)


def create_database(spark: SparkSession, name: str, comment: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT '{comment}'{place}")


def create_table(
    spark: SparkSession, name: str, columns: Mapping[str, str], comment: str = "",
    partition_by: Sequence[str] = (), bucket_by: tuple[int, str] | None = None, location: str | None = None,
) -> None:
    """An empty parquet table with declared types, partitions and buckets."""
    body = ", ".join(f"`{n}` {t}" for n, t in columns.items())
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    buckets = f" CLUSTERED BY ({bucket_by[1]}) INTO {bucket_by[0]} BUCKETS" if bucket_by else ""
    place = f" LOCATION '{location}'" if location else ""
    note = f" COMMENT '{comment}'" if comment else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({body}) USING parquet{parts}{buckets}{place}{note}")


def external_parquet(spark: SparkSession, name: str, columns: Mapping[str, str], location: str,
                     partition_by: Sequence[str] = ()) -> None:
    """A table over landed files; finds the partitions already there."""
    create_table(spark, name, columns, partition_by=partition_by, location=location)
    if partition_by:
        spark.catalog.recoverPartitions(name)


def analyze(spark: SparkSession, names: Sequence[str]) -> None:
    for name in names:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")


def write_json_report(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def audit_rows(df: DataFrame, table_name: str, operation: str, status: str = "SUCCESS") -> DataFrame:
    """The audit entry of a load: one row with its record count."""
    return df.agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(table_name).alias("table_name"), F.lit(operation).alias("operation"), "record_count",
        F.lit(status).alias("status"), F.lit(None).cast("string").alias("error_message"),
    )


#: Columns of the audit log.
AUDIT = "table_name string, operation string, record_count long, status string, error_message string"


def audited(df: DataFrame, write: Callable[[DataFrame], None], table_name: str, operation: str, log: str) -> int:
    """Writes ``df`` and appends the load to the audit log (a Parquet folder); returns the rows written.

    Rows are counted while they are written, so there is no second scan. A write that fails is
    logged with its error, and the error goes on.
    """
    seen = Observation()
    spark = df.sparkSession

    def entry(*row) -> None:
        spark.createDataFrame([row], AUDIT).coalesce(1).write.mode("append").parquet(log)

    try:
        write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    except Exception as error:
        entry(table_name, operation, None, "FAILED", str(error).split("\n")[0][:500])
        raise
    rows = seen.get["rows"]
    entry(table_name, operation, rows, "SUCCESS", None)
    return rows


def column_statistics(spark: SparkSession, names: Sequence[str], histograms: bool = True) -> DataFrame:
    """Computes statistics of tables and all their columns for the planner; returns them, a row per column.

    Distinct counts are estimates, as the planner's are; extremes, NULLs and row counts are exact.
    """
    rows, setting = [], "spark.sql.statistics.histogram.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(histograms).lower())
    try:
        for name in names:
            spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")
            total = int(spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Statistics'").first()["data_type"].split(", ")[1].split(" ")[0])
            for field in spark.table(name).schema.fields:
                facts = dict(spark.sql(f"DESCRIBE EXTENDED {name} `{field.name}`").select("info_name", "info_value").collect())
                known = {k: None if v == "NULL" else v for k, v in facts.items()}
                rows.append((name.split(".")[-1], field.name, total, int(known["num_nulls"]) if known.get("num_nulls") else None, known.get("min"), known.get("max"),
                             int(known["distinct_count"]) if known.get("distinct_count") else None, bool(known.get("histogram"))))
    finally:
        spark.conf.set(setting, before)
    return spark.createDataFrame(
        rows, "table_name string, column_name string, row_count long, null_count long, min_value string, max_value string, distinct_estimate long, histogram boolean")


def load_check(df: DataFrame, table_name: str) -> DataFrame:
    """The post-load sanity row: count, age extremes, average income."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"), F.min("age").alias("min_age"), F.max("age").alias("max_age"),
        F.avg(F.col("income").cast("double")).alias("avg_income"),
    ).withColumn("table_name", F.lit(table_name))


def validate_tables(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Row count per table, -1 for a table that is not there."""
    out = None
    for name in names:
        if spark.catalog.tableExists(name):
            one = spark.table(name).agg(F.count(F.lit(1)).alias("row_count"))
        else:
            one = spark.range(1).select(F.lit(-1).cast("bigint").alias("row_count"))
        one = one.select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def require_rows(spark: SparkSession, names: Sequence[str]) -> None:
    """Fails if a table is missing or has no row."""
    bad = [r.table_name for r in validate_tables(spark, names).where("row_count <= 0").collect()]
    if bad:
        raise ValueError(f"tables without rows: {', '.join(sorted(bad))}")
