"""Surrogate keys that do not depend on which other rows are loaded, and row numbers."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import new_path

#: Hex digits of the digest that make a key: 60 bits, so a BIGINT holds it.
DIGITS = 15


def stable_id(key: Sequence[str]) -> Column:
    """The key of a row from its natural key alone: the same in every load, and no shuffle is needed.

    Each column goes in with its length, NULL as a sign of its own, so no two natural keys have
    one text. Two of them share an id with a chance of about n^2 / 2^61; ``id_collisions`` checks it.
    """
    def part(name: str) -> Column:
        value = F.col(name).cast("string")
        return F.coalesce(F.concat(F.length(value), F.lit(":"), value), F.lit("~"))

    return F.conv(F.substring(F.md5(F.concat(*[part(k) for k in key])), 1, DIGITS), 16, 10).cast("bigint")


def spread(columns: Sequence[str]) -> Column:
    """A hash of a whole row, to deal rows of one key over several tasks; not to name them."""
    return F.xxhash64(*[F.col(f"`{n}`") for n in columns])


def id_collisions(df: DataFrame, name: str) -> DataFrame:
    """Ids that more than one row of a dimension has."""
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def row_numbers(df: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """Add ``name``: 1..n in the order given, then of all other columns.

    Rows are range-partitioned, so a value that many rows share is spread over tasks by the
    columns after it; only rows that are equal throughout can meet in one, and their numbers
    are interchangeable. The sorted rows are written once, because the bounds of the ranges
    are sampled: numbers are then the same on every later read.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, "numbered")
    columns = [*order, *[n for n in df.columns if n not in order]]
    df.repartitionByRange(*columns).sortWithinPartitions(*columns).withColumn(
        "_at", F.monotonically_increasing_id()
    ).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    # one row per partition of the write: a bounded table that every task may hold
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    place = F.col("_at") - F.shiftleft("_part", 33)
    return rows.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + place + 1).select(*df.columns, name)
