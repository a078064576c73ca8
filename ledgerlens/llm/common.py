"""What the operators share: tables, shared-folder staging, Arrow column functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.sources.workspace import new_path

#: Rows that a Python task turns into Arrow output at once; bounds its memory whatever the batch it was given.
SLICE_ROWS = 256


#: Where the staged tables of this driver lie.
_PATHS: dict[int, tuple[DataFrame, str]] = {}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends there, and a lost executor loses nothing.

    Nobody needs the shuffle files of the job after that, so Spark is told to remove them with it.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[id(out)] = (out, path)
    return out


def discard(*tables: DataFrame) -> None:
    """Removes staged tables that nothing will read again: all that was made from them has been staged itself."""
    for df in tables:
        _, path = _PATHS.pop(id(df))
        place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def text_bytes(text: str | None) -> bytes:
    """UTF-8 of a text; a lone surrogate, which Arrow could not carry, cannot occur."""
    return (text or "").encode("utf-8")


def with_arrow_columns(
    df: DataFrame, column: str, added: T.StructType, make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
    keep: list[str] | None = None, rows: int = SLICE_ROWS,
) -> DataFrame:
    """``df`` with columns that a Python function computes from one column, in bounded slices.

    ``make`` runs once per task and returns the function. Columns of ``df`` that have
    the name of an added one are replaced by it.
    """
    kept = [n for n in (keep or df.columns) if n not in added.names]
    source = "__in" if column not in kept else column
    given = df.select(*[F.col(f"`{n}`") for n in kept], *([F.col(f"`{column}`").alias(source)] if source == "__in" else []))
    schema = T.StructType([f for f in given.schema.fields if f.name != "__in"] + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                made = compute(part.column(part.schema.get_field_index(source)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(n)) for n in kept] + made, names=kept + added.names
                )

    return given.mapInArrow(run, schema)
