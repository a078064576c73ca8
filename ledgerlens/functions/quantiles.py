"""Exact quantiles that never hold a whole group in one task.

``percentile`` keeps every distinct value of a group in one buffer, and a group
can be a third of the table. Here rows are first counted per distinct value (a
partial aggregate, so repeats never travel), then two short running sums find
the rank: one over value buckets, one over the distinct values of the single
bucket that holds it. Buckets follow the size of the values, see ``value_bucket``.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .buckets import value_bucket
from .onerow import beside

_RANK = "decimal(38,0)"


def _first_rank(p: float, rows: Column) -> Column:
    """One-based rank ceil(p * rows), at least 1."""
    return F.greatest(F.ceil(rows.cast("double") * F.lit(p)).cast(_RANK), F.lit(1).cast(_RANK))


def _value_counts(df: DataFrame, value: str, by: Sequence[str], weight: str | None) -> DataFrame:
    count = F.sum(F.col(weight).cast(_RANK)) if weight else F.count(F.lit(1))
    return (
        df.groupBy(*by, F.col(value).alias("_v")).agg(count.cast(_RANK).alias("_n"))
        .withColumn("_b", value_bucket(F.col("_v")))
    )


def _pick(
    values: DataFrame, by: Sequence[str], wanted: Callable[[Column, Column], list[tuple[Column, Column]]]
) -> DataFrame:
    """Rows (by, tag, _v): the value at each wanted rank.

    ``wanted(rows, missing)`` lists (tag, rank) given the group's value and NULL counts.
    """
    by = list(by)
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    running = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    present = F.col("_b").isNotNull()
    # NULL values sit in the NULL bucket: it sorts first and adds nothing to the running sum
    buckets = (
        values.groupBy(*by, "_b").agg(F.sum("_n").cast(_RANK).alias("_m"))
        .withColumn("_bn", F.when(present, F.col("_m")).otherwise(F.lit(0).cast(_RANK)))
        .select(
            *by, "_b", "_bn",
            F.sum("_bn").over(running).alias("_end"),
            F.sum("_bn").over(group).alias("_rows"),
            F.sum(F.when(present, F.lit(0).cast(_RANK)).otherwise(F.col("_m"))).over(group).alias("_missing"),
        )
    )
    ranks = F.array(*[
        F.struct(tag.alias("tag"), rank.alias("rank"))
        for tag, rank in wanted(F.col("_rows"), F.col("_missing"))
    ])
    start = F.col("_end") - F.col("_bn")
    hits = (
        buckets.withColumn("_t", F.explode(F.array_distinct(ranks)))
        .where((F.col("_t.rank") > start) & (F.col("_t.rank") <= F.col("_end")))
        .select(*by, "_b", F.col("_t.tag").alias("tag"), (F.col("_t.rank") - start).alias("_left"))
    )
    # one bucket per (group, rank): a hot value is one row already, and a bucket is narrow
    inside = (
        Window.partitionBy(*by, "tag", "_left", "_b").orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        values.join(hits, [*by, "_b"])
        .withColumn("_upto", F.sum("_n").over(inside))
        .where((F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("_n") < F.col("_left")))
        .select(*by, "tag", "_v")
    )


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Elements of ``value`` at rank ceil(p * n) per ``by``: columns ``by``, ``prob``, ``quantile``.

    ``weight`` counts a row that many times.
    """
    def wanted(rows, missing):
        return [(F.lit(float(p)), _first_rank(p, rows)) for p in probs]

    found = _pick(_value_counts(df, value, by, weight), by, wanted)
    return found.select(*by, F.col("tag").alias("prob"), F.col("_v").cast("double").alias("quantile"))


def exact_median(df: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """Median per ``by``, the mean of the two middle values where the count is even."""
    def wanted(rows, missing):
        middle = (rows - 1).cast("double") / F.lit(2.0)
        return [(F.lit("m"), r.cast(_RANK) + 1) for r in (F.floor(middle), F.ceil(middle))]

    found = _pick(_value_counts(df, value, by, None), by, wanted)
    return found.groupBy(*by).agg(F.avg(F.col("_v").cast("double")).alias(name))


def imputation_statistics(
    df: DataFrame,
    medians: Sequence[str],
    quartiles: Sequence[str] = (),
    bounds: Sequence[str] = (),
    method: str = "exact",
) -> DataFrame:
    """One row with all that imputing, flagging and scaling need.

    Columns ``median_<c>``; ``q1_<c>`` and ``q3_<c>`` of the column *after* its gaps
    are filled with the median; ``low_<c>`` and ``high_<c>``. ``exact`` takes one pass:
    filling k gaps with the median shifts ranks by k on one side only, so quartiles of
    the filled column are ranks of the unfilled one. ``approx`` uses sketches
    (rank error 1e-4), one scan for the medians and one for the quartiles.
    """
    columns = list(dict.fromkeys([*medians, *quartiles, *bounds]))
    if method == "approx":
        middle = df.agg(*[
            F.percentile_approx(c, F.lit(0.5), 10000).cast("double").alias(f"median_{c}") for c in medians
        ], *[
            f(c).cast("double").alias(f"{k}_{c}") for c in bounds for k, f in (("low", F.min), ("high", F.max))
        ])
        if not quartiles:
            return middle
        filled = beside(df, middle)
        edges = filled.agg(*[
            F.percentile_approx(F.coalesce(c, f"median_{c}"), F.lit(p), 10000).cast("double").alias(f"{k}_{c}")
            for c in quartiles for k, p in (("q1", 0.25), ("q3", 0.75))
        ])
        return beside(middle, edges)
    if method != "exact":
        raise ValueError(f"unknown method {method!r}")

    long = df.select(
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
        ])).alias("_c")
    ).select("_c.*")

    def wanted(rows, missing):
        middle = _first_rank(0.5, rows)

        def filled(p):
            rank = _first_rank(p, rows + missing)
            return (
                F.when(rank <= middle, rank).when(rank <= middle + missing, middle)
                .otherwise(rank - missing)
            )

        one = F.lit(1).cast(_RANK)
        return [
            (F.lit("median"), middle), (F.lit("q1"), filled(0.25)), (F.lit("q3"), filled(0.75)),
            (F.lit("low"), one), (F.lit("high"), rows),
        ]

    found = _pick(_value_counts(long, "value", ["column"], None), ["column"], wanted)
    need = (
        [("median", c) for c in medians] + [(k, c) for c in quartiles for k in ("q1", "q3")]
        + [(k, c) for c in bounds for k in ("low", "high")]
    )
    return found.agg(*[
        F.max(F.when((F.col("column") == c) & (F.col("tag") == k), F.col("_v"))).alias(f"{k}_{c}")
        for k, c in need
    ])
