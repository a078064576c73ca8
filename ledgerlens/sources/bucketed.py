"""Bucketed tables written with one file per partition and bucket, and the joins they allow.

Two tables with the same number of buckets on their keys join without moving a row. A side
whose measured size allows it is broadcast instead; sizes come from the catalog, not from
the plan's guess.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import spread

#: Largest table that a join broadcasts, in bytes.
SMALL_TABLE_BYTES = 25_000_000
#: Rows of a partition and bucket that one file holds; what is beyond goes to further files, written by other tasks.
FILE_ROWS = 500_000
#: Kinds of (partition, bucket, file) whose row counts are joined as a broadcast; more are joined by shuffle.
BROADCAST_CELLS = 200_000


def bucket_of(buckets: int, key: str):
    """The bucket that Spark's writer puts a key in."""
    return F.pmod(F.hash(F.col(key)), F.lit(buckets))


def clustered(df: DataFrame, buckets: int, key: str, partition_by: Sequence[str] = (), file_rows: int = FILE_ROWS) -> DataFrame:
    """``df`` dealt so that each task writes whole files: all rows of a partition and bucket meet in one task.

    Rows are counted per partition and bucket first. A cell of more than ``file_rows`` rows, as a
    hot key or a large table makes one, is dealt to as many tasks as it needs files. No two files of
    a partition meet in one task: tasks are numbered by bucket and file, each partition from a start of its own.
    """
    cell = [*partition_by, "_bucket"]
    rows = df.withColumn("_bucket", bucket_of(buckets, key))
    counts = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_files", F.ceil(F.col("_rows") / F.lit(file_rows)).cast("int"))
    facts = counts.agg(F.count(F.lit(1)).alias("cells"), F.max("_files").alias("most"), F.sum("_files").alias("files"), F.sum("_rows").alias("rows")).first()
    if not facts.cells:
        return df
    dealt = rows.withColumn("_file", F.lit(0))
    if facts.most > 1:
        large = counts.where("_files > 1").select(*[F.col(n).alias(f"_{n}_of") for n in cell], "_files")
        on = [F.col(n).eqNullSafe(F.col(f"_{n}_of")) for n in cell]
        dealt = rows.join(F.broadcast(large) if facts.cells <= BROADCAST_CELLS else large, on, "left").withColumn(
            "_file", F.coalesce(F.pmod(spread(df.columns), F.col("_files")), F.lit(0))).drop(*[f"_{n}_of" for n in cell], "_files")
    tasks = max(buckets * facts.most, min(facts.files, 8 * df.sparkSession.sparkContext.defaultParallelism), -(-facts.rows // file_rows))
    start = F.pmod(F.xxhash64(*partition_by), F.lit(tasks)) if partition_by else F.lit(0)
    task = F.pmod(F.col("_file") * F.lit(buckets) + F.col("_bucket") + start, F.lit(tasks)).cast("int")
    return dealt.repartitionById(tasks, task).drop("_bucket", "_file")


def save_bucketed(df: DataFrame, name: str, buckets: int, key: str, partition_by: Sequence[str] = (), mode: str = "error",
                  file_rows: int = FILE_ROWS) -> DataFrame:
    """A table clustered on ``key``, one sorted file per partition and bucket, with its size in the catalog."""
    spark = df.sparkSession
    writer = clustered(df, buckets, key, partition_by, file_rows).write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
    return spark.table(name)


def table_bytes(spark: SparkSession, name: str) -> int | None:
    """Size of a table as the catalog knows it; None if it was never measured."""
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Statistics'").select("data_type").collect()
    return int(rows[0][0].split(" bytes")[0]) if rows else None


def bucketing(spark: SparkSession, name: str) -> tuple[int, tuple[str, ...]] | None:
    """Number of buckets and bucket columns of a table; None if it has none."""
    facts = dict(spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name IN ('Num Buckets', 'Bucket Columns')").select("col_name", "data_type").collect())
    if "Num Buckets" not in facts:
        return None
    return int(facts["Num Buckets"]), tuple(c.strip(" `") for c in facts["Bucket Columns"].strip("[]").split(","))


def join_tables(spark: SparkSession, left: str, right: str, on: str, how: str = "inner", small_bytes: int = SMALL_TABLE_BYTES,
                left_columns: Sequence[str] | None = None, right_columns: Sequence[str] | None = None) -> DataFrame:
    """``left`` joined with ``right``, two catalog tables, on a column both have; of each, the columns named (all if none are).

    ``right`` is broadcast if its measured size is at most ``small_bytes`` (``left``, if only it
    is, in an inner join). Otherwise both are merged bucket by bucket; tables that are not
    bucketed alike on the column are shuffled by it, as Spark does with any merge join.
    """
    for name in (left, right):
        if table_bytes(spark, name) is None:
            spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
    a, b = spark.table(left), spark.table(right)
    a = a if left_columns is None else a.select(on, *left_columns)
    b = b if right_columns is None else b.select(on, *right_columns)
    if table_bytes(spark, right) <= small_bytes:
        return a.join(F.broadcast(b), on, how)
    if how == "inner" and table_bytes(spark, left) <= small_bytes:
        return F.broadcast(a).join(b, on, how)
    return a.hint("merge").join(b, on, how)
