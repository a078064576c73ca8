"""How many persons can afford a payment, counted without looking at pairs.

``amount <= disposable * 0.1`` compares a payment with a person, so it does not
split into factors, but it is a rank: the number of persons whose tenth of
disposable income is at least the amount. Both sides are reduced to distinct
values first, so a hot value is one row. A running count over value
buckets, then one inside each bucket, gives every amount its rank.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.buckets import value_bucket
from .pairs import PairRelation


def affordable_persons(pairs: PairRelation) -> DataFrame:
    """Rows (key, amount, affordable_persons) for every distinct payment amount per category.

    A NULL disposable income affords nothing.
    """
    key = pairs.key
    offers = (
        pairs.persons.where(F.col("disposable_income").isNotNull())
        .groupBy(key, (F.col("disposable_income") * F.lit(0.1)).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(key, "_v", "_n", F.lit(None).cast("double").alias("amount"))
    )
    asks = (
        pairs.payments.select(key, F.col("amount").alias("_v")).distinct()
        .select(key, "_v", F.lit(0).cast("bigint").alias("_n"), F.col("_v").alias("amount"))
    )
    both = offers.unionByName(asks).withColumn("_b", value_bucket(F.col("_v")))
    # persons in the buckets above: as many rows as there are value buckets
    above = Window.partitionBy(key).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = both.groupBy(key, "_b").agg(F.sum("_n").alias("_m"))
    offsets = buckets.select(
        F.col(key), "_b", F.coalesce(F.sum("_m").over(above), F.lit(0)).alias("_above")
    )
    # RANGE, not ROWS: an offer equal to the amount affords it
    inside = Window.partitionBy(key, "_b").orderBy(F.desc("_v")).rangeBetween(Window.unboundedPreceding, 0)
    return (
        both.withColumn("_here", F.sum("_n").over(inside))
        .where(F.col("amount").isNotNull())
        .join(offsets, [key, "_b"])
        .select(key, "amount", (F.col("_above") + F.col("_here")).alias("affordable_persons"))
    )
