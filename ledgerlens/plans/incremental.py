"""The spending-behaviour fact kept up to date month by month.

Payments are stored by month. For every month a small table of mergeable states is kept: one
row per category and merchant with counts, exact sums and extremes. A load makes anew the
states of the months it has payments in, from those months' partitions alone; the fact is
then made from all states, without a look at the payments.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exact import count_if
from ..operators.pairs import PAYMENTS, PairRelation
from . import elt

c = F.col

MONTH = ("transaction_year", "transaction_month")
BY = ("age_category", "merchant_category", *MONTH)
#: What a state holds; states of one group add up.
MERGED = {
    PAYMENTS: F.sum, "amounts": F.sum, "total_amount": F.sum, "min_transaction_amount": F.min, "max_transaction_amount": F.max,
    "_fraud": F.sum, "_weekend": F.sum,
}


def payment_states(payments: DataFrame) -> DataFrame:
    """One state per group of payments (``transaction_amount``, ``fraud_flag``, ``is_weekend`` and the columns of ``BY``)."""
    return payments.groupBy(*BY).agg(
        F.count(F.lit(1)).alias(PAYMENTS), F.count("transaction_amount").alias("amounts"), F.sum("transaction_amount").alias("total_amount"),
        F.min("transaction_amount").alias("min_transaction_amount"), F.max("transaction_amount").alias("max_transaction_amount"),
        count_if(c("fraud_flag") == 1).alias("_fraud"), count_if(c("is_weekend") == 1).alias("_weekend"),
    )


def merged(states: DataFrame) -> DataFrame:
    """States of one group as one, as several loads or stores may have one each."""
    return states.groupBy(*BY).agg(*[how(n).alias(n) for n, how in MERGED.items()])


def in_months(months: Iterable[tuple[int | None, int | None]]) -> Column:
    """Whether a row lies in one of the months; on partition columns it prunes partitions."""
    out = F.lit(False)
    for year, month in months:
        out = out | (c(MONTH[0]).eqNullSafe(F.lit(year).cast("int")) & c(MONTH[1]).eqNullSafe(F.lit(month).cast("int")))
    return out


def months_of(payments: DataFrame) -> list[tuple[int | None, int | None]]:
    """The months that payments lie in: a row each, as many as a load has months."""
    return sorted((tuple(r) for r in payments.select(*MONTH).distinct().collect()), key=str)


def store_payments(payments: DataFrame, path: str) -> list[tuple[int | None, int | None]]:
    """Appends payments to their months' partitions; returns the months."""
    payments.hint("rebalance", *MONTH).write.mode("append").partitionBy(*MONTH).parquet(path)
    return months_of(payments)


def refresh_states(payments: DataFrame, months: Iterable[tuple[int | None, int | None]], path: str) -> DataFrame:
    """Makes the states of ``months`` anew from stored ``payments`` and puts them in place of the old ones; returns what was read.

    Whole partitions are replaced, so a refresh that is repeated changes nothing.
    """
    read = payments.where(in_months(months))
    payment_states(read).repartition(*MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*MONTH).parquet(path)
    return read


def behavior_from_states(states: DataFrame, pairs: PairRelation) -> DataFrame:
    """``elt.fact_spending_behavior_agg`` from states and the persons of ``pairs``."""
    persons = F.broadcast(pairs.person_side((), *elt.behavior_persons()))  # six rows at most
    joined = merged(states).withColumn(
        "avg_transaction_amount", F.try_divide(c("total_amount").cast("double"), c("amounts").cast("double"))).join(persons, pairs.key)
    return elt.behavior_columns(joined)


def load(spark: SparkSession, new: DataFrame, payments_path: str, states_path: str) -> list[tuple[int | None, int | None]]:
    """One load: payments stored, states of its months refreshed; returns the months."""
    months = store_payments(new, payments_path)
    refresh_states(spark.read.parquet(payments_path), months, states_path)
    return months
