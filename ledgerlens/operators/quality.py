"""Data-quality checks. Each is one aggregate over all its columns and returns check rows.

``weight`` names a column that says how many table rows a row stands for, so the
joined table can be checked from its two sides.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exact import half_up, percent
from ..functions.onerow import beside
from ..functions.quantiles import exact_quantiles

c = F.col
#: Size of a quantile sketch, and the error of ranks that it keeps with near certainty, as a share of the values.
SKETCH_SIZE, RANK_ERROR = 400, 0.01
_COUNT = "decimal(38,0)"


def _rows(weight: str | None, where: Column | None = None) -> Column:
    one = F.lit(1).cast(_COUNT) if weight is None else c(weight).cast(_COUNT)
    if where is not None:
        one = F.when(where, one)
    return F.coalesce(F.sum(one), F.lit(0)).cast(_COUNT)


def _share(part: Column, whole: Column) -> Column:
    return half_up(F.coalesce(percent(part, whole), F.lit(0.0)), 2).cast("double")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _unpivot(one_row: DataFrame, items: Mapping[str, Column]) -> DataFrame:
    """A row per item from a one-row aggregate."""
    structs = [F.struct(F.lit(name).alias("column"), value.alias("found")) for name, value in items.items()]
    return one_row.select("*", F.explode(F.array(*structs)).alias("_i")).select("*", "_i.column", "_i.found")


def check_uniqueness(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """Total, distinct (NULL is one value) and repeated rows per column.

    All columns are read in one scan: every value becomes a row with the number of its column, and
    the rows are counted per value, so a value that fills a third of the table is one row after
    the combine.
    """
    names = [n for n in columns if n in df.columns]
    values = [F.struct(F.lit(i).alias("i"), c(n).cast("string").alias("value")) for i, n in enumerate(names)]
    kept = [] if weight is None else [c(weight).alias("w")]
    long = df.select(F.explode(F.array(*values)).alias("_v"), *kept).select("_v.i", "_v.value", *[c("w") for _ in kept])
    per_value = long.groupBy("i", "value").agg(_rows(None if weight is None else "w").alias("n"))
    counts = per_value.groupBy("i").agg(F.sum("n").cast(_COUNT).alias("total"), F.count(F.lit(1)).cast(_COUNT).alias("distinct"))
    none = F.lit(0).cast(_COUNT)
    # a row per column also where there is no row at all
    one_row = counts.agg(F.map_from_entries(F.collect_list(F.struct("i", F.struct("total", "distinct")))).alias("_counts"))
    items = {n: F.struct(F.coalesce(c("_counts")[i]["total"], none).alias("total"), F.coalesce(c("_counts")[i]["distinct"], none).alias("distinct"))
             for i, n in enumerate(names)}
    total, distinct = c("found.total"), c("found.distinct")
    repeated = (total - distinct).cast(_COUNT)
    return _unpivot(one_row, items).select(
        "column", total.alias("total_count"), distinct.alias("distinct_count"), repeated.alias("duplicate_count"),
        _share(distinct, total).alias("uniqueness_percentage"), (repeated == 0).alias("passed"),
    )


def check_nulls(df: DataFrame, columns: Sequence[str] | None = None, weight: str | None = None) -> DataFrame:
    names = [n for n in (columns or df.columns) if n in df.columns and n != weight]
    counts = df.agg(
        _rows(weight).alias("_rows"), *[_rows(weight, c(n).isNull()).alias(f"_{i}") for i, n in enumerate(names)]
    )
    return null_rows(counts, {n: c(f"_{i}") for i, n in enumerate(names)})


def null_rows(counts: DataFrame, items: Mapping[str, Column]) -> DataFrame:
    """Check rows from one row with the NULLs per column and ``_rows``, the rows in all."""
    return _unpivot(counts, items).select(
        "column", c("found").alias("null_count"), _share(c("found"), c("_rows")).alias("null_percentage"),
        (c("found") == 0).alias("passed"),
    )


def check_range(df: DataFrame, limits: Mapping[str, tuple[float, float]], weight: str | None = None) -> DataFrame:
    """Values outside [low, high], as a share of the values present."""
    names = [n for n in limits if n in df.columns]
    aggregates = []
    for i, n in enumerate(names):
        low, high = limits[n]
        aggregates.append(_rows(weight, (c(n) < low) | (c(n) > high)).alias(f"_out{i}"))
        aggregates.append(_rows(weight, c(n).isNotNull()).alias(f"_all{i}"))
    items = {
        n: F.struct(
            F.lit(float(limits[n][0])).alias("low"), F.lit(float(limits[n][1])).alias("high"),
            c(f"_out{i}").alias("out"), c(f"_all{i}").alias("all"),
        )
        for i, n in enumerate(names)
    }
    return _unpivot(df.agg(*aggregates), items).select(
        "column", c("found.low").alias("min_allowed"), c("found.high").alias("max_allowed"),
        c("found.out").alias("out_of_range_count"),
        _share(c("found.out"), c("found.all")).alias("out_of_range_percentage"),
        (c("found.out") == 0).alias("passed"),
    )


def check_datatypes(spark: SparkSession, df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """The expected word must occur in the column's type name. Reads the schema only."""
    rows = []
    for name, word in expected.items():
        if name in df.columns:
            actual = str(df.schema[name].dataType)
            rows.append((name, word, actual, word in actual.lower()))
    return spark.createDataFrame(rows, "column string, expected_type string, actual_type string, passed boolean")


def check_referential(child: DataFrame, child_column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct child values without a parent. A NULL child value is an orphan, as in the anti join."""
    return orphans(child, child_column, parent, parent_column).agg(
        F.count(F.lit(1)).alias("orphan_count")
    ).select(
        F.lit(parent_column).alias("parent_column"), F.lit(child_column).alias("child_column"), "orphan_count",
        (c("orphan_count") == 0).alias("passed"),
    )


def orphans(child: DataFrame, child_column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct values on both sides before the anti join, so no value is hot."""
    values = child.select(c(child_column).alias("value")).distinct()
    known = parent.select(c(parent_column).alias("value")).distinct()
    return values.join(known, "value", "left_anti")


def check_distribution(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """Eight statistics per column and a skew flag |mean - median| / stddev > 1; always passes."""
    names = [n for n in columns if n in df.columns]
    w = F.lit(1.0) if weight is None else c(weight).cast("double")
    aggregates = []
    for i, n in enumerate(names):
        x = c(n).cast("double")
        aggregates += [
            _rows(weight, c(n).isNotNull()).alias(f"_n{i}"), F.sum(x * w).alias(f"_s{i}"),
            F.min(x).alias(f"_min{i}"), F.max(x).alias(f"_max{i}"),
        ]
    first = df.agg(*aggregates)
    means = first.select(*[F.try_divide(c(f"_s{i}"), c(f"_n{i}").cast("double")).alias(f"_mean{i}") for i in range(len(names))])
    # second moment about the mean: sums of squares about zero would cancel
    second = beside(df, means).agg(*[
        F.sum((c(n).cast("double") - c(f"_mean{i}")) * (c(n).cast("double") - c(f"_mean{i}")) * w).alias(f"_ss{i}")
        for i, n in enumerate(names)
    ])
    one_row = beside(first, second)
    items = {
        n: F.struct(*[c(f"_{k}{i}").alias(k) for k in ("n", "s", "min", "max", "ss")]) for i, n in enumerate(names)
    }
    moments = _unpivot(one_row, items).select("column", "found.*")
    weighted = [] if weight is None else [c(weight).alias("w")]
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("column"), c(n).cast("double").alias("value"), *weighted) for n in names
    ])).alias("_c")).select("_c.*")
    q = exact_quantiles(long, "value", (0.25, 0.5, 0.75), ("column",), None if weight is None else "w")
    quantiles = q.groupBy("column").agg(*[
        F.max(F.when(c("prob") == p, c("quantile"))).alias(k) for k, p in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))
    ])
    n = c("n").cast("double")
    mean = F.try_divide(c("s"), n)
    stddev = F.sqrt(F.try_divide(c("ss"), n - 1.0))
    skew = F.try_divide(F.abs(mean - c("q2")), stddev) > 1
    return moments.join(F.broadcast(quantiles), "column", "left").select(  # a row per column
        "column", c("n").alias("count"), mean.alias("mean"), stddev.alias("stddev"), c("min").alias("min_value"),
        c("q1").alias("p25"), c("q2").alias("p50"), c("q3").alias("p75"), c("max").alias("max_value"),
        F.coalesce((mean != 0) & (c("q2") != 0) & skew, F.lit(False)).alias("is_skewed"), F.lit(True).alias("passed"),
    )


def distribution_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """``by``, ``column``, ``sketch``: a mergeable quantile sketch per column and group, for tables that are kept by partition.

    A sketch has a bounded size whatever the group's; NULL values count for nothing.
    """
    values = F.array(*[F.struct(F.lit(n).alias("column"), c(n).cast("double").alias("value")) for n in columns])
    long = df.select(*by, F.explode(values).alias("_v")).select(*by, "_v.column", "_v.value").where(c("value").isNotNull())
    return long.groupBy(*by, "column").agg(F.kll_sketch_agg_double("value", size).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75), size: int = SKETCH_SIZE) -> DataFrame:
    """``column, count, prob, quantile`` from the sketches of any number of partitions, merged. Ranks are right within ``RANK_ERROR``."""
    whole = sketches.groupBy("column").agg(F.kll_merge_agg_double("sketch", size).alias("sketch"))
    found = [F.struct(F.lit(float(p)).alias("prob"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("quantile")) for p in probs]
    return whole.select("column", F.kll_sketch_get_n_double("sketch").alias("count"), F.inline(F.array(*found)))


def check_rows(checks: Mapping[str, Sequence[DataFrame]]) -> DataFrame:
    """All checks as (check_type, item, passed, detail), the detail as JSON."""
    def uniform(kind: str, frame: DataFrame) -> DataFrame:
        item = c("column") if "column" in frame.columns else F.concat_ws("->", "child_column", "parent_column")
        return frame.select(
            F.lit(kind).alias("check_type"), item.alias("item"), "passed",
            F.to_json(F.struct(*frame.columns), {"ignoreNullFields": "false"}).alias("detail"),
        )

    return _union([uniform(kind, f) for kind, frames in checks.items() for f in frames])


def quality_report(rows: DataFrame) -> DataFrame:
    """Checks in total, passed and failed, and the score 100 * passed / total."""
    return rows.agg(
        F.count(F.lit(1)).alias("total_checks"), F.count(F.when(c("passed"), 1)).alias("passed_checks")
    ).select(
        "total_checks", "passed_checks", (c("total_checks") - c("passed_checks")).alias("failed_checks"),
        _share(c("passed_checks"), c("total_checks")).alias("quality_score"),
    )
