"""Casting, dividing and rounding that give the same answer in any task order."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def amount_of(name: str, kind: str = MONEY) -> Column:
    """Text or number to ``kind``; what cannot be read becomes NULL, also under ANSI."""
    return F.col(name).try_cast(kind)


def mean(name: str | Column) -> Column:
    """Average as exact sum over count.

    ``avg`` of a decimal keeps only four more digits, so a later ``round`` would
    round twice; the sum is exact and is divided once.
    """
    c = F.col(name) if isinstance(name, str) else name
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


def half_up(value: Column, digits: int) -> Column:
    """A double, rounded half up in decimal arithmetic, so that 0.005 goes to 0.01 for doubles too.

    From 1e28 on, where no decimal has room for the fraction (nor a double), the value stays as it is.
    """
    return F.coalesce(F.round(value.try_cast("decimal(38,10)"), digits).cast("double"), value.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def times_rows(total: Column, rows: Column) -> Column:
    """``total`` repeated ``rows`` times. Row products outgrow BIGINT, so decimals."""
    return total * rows.cast("decimal(15,0)")


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def sum_if(condition: Column, value: str) -> Column:
    c = F.col(value)
    return F.sum(F.when(condition, c).otherwise(F.lit(0).cast("decimal(12,2)")))
