"""Using a one-row result beside every row of another frame."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def beside(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """``df`` with the columns of a one-row aggregate, read as one scalar subquery.

    No join takes place: the row is computed once, and its shuffles are shared with
    those of ``df`` where the plans agree.
    """
    row = one_row.select(F.struct("*")).scalar()
    return df.select("*", row.alias("_row")).select(*df.columns, *[F.col(f"_row.{n}").alias(n) for n in one_row.columns])
