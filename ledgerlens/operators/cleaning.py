"""Cleaning steps that both profiles are composed from."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import MONEY, amount_of
from ..functions.onerow import beside
from ..functions.quantiles import imputation_statistics


def normalize_column_names(df: DataFrame, drop: str = "") -> DataFrame:
    """Strip, lower-case, blanks to underscores, and remove the characters in ``drop``."""
    names = [c.strip().lower().replace(" ", "_") for c in df.columns]
    for char in drop:
        names = [n.replace(char, "") for n in names]
    return df.toDF(*names)


def cast_numeric_safe(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns; an unreadable value becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(k) for c, k in kinds.items() if c in df.columns})


def parse_timestamp(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss"))


def standardize_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.trim(F.lower(c)) for c in columns if c in df.columns})


def strip_inner_spaces(c: Column) -> Column:
    return F.lower(F.translate(c, " ", ""))


def clamp_non_negative(name: str) -> Column:
    """Money at or above zero: negative, missing and unreadable values become 0."""
    zero = F.lit(0).cast(MONEY)
    return F.greatest(F.coalesce(amount_of(name), zero), zero)


def fill_constant(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    return df.fillna(dict(defaults))


def dedup_by_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the least in column order, so that re-runs agree.

    A plain aggregate: copies of a hot key collapse before the shuffle.
    """
    rest = [c for c in df.columns if c != key]
    kept = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return kept.select(*[F.col(c) if c == key else F.col(f"_row.{c}") for c in df.columns])


def duplicates_removed(df: DataFrame, key: str) -> DataFrame:
    """One row: rows in, rows kept (a NULL key counts as one), rows removed."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("input_rows"),
        F.count(F.lit(1)).alias("kept_rows"),
    ).withColumn("removed_rows", F.col("input_rows") - F.col("kept_rows"))


def imputed(columns: Sequence[str]) -> dict[str, Column]:
    """NULL to the column median (an element of the column, not an interpolation)."""
    return {c: F.coalesce(c, f"median_{c}") for c in columns}


def outlier_fences(statistics: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace quartiles by the fences 1.5 times their distance outside them."""
    fences = {}
    for c in columns:
        q1, q3 = F.col(f"q1_{c}"), F.col(f"q3_{c}")
        reach = (q3 - q1) * F.lit(1.5)
        fences |= {f"floor_{c}": q1 - reach, f"ceiling_{c}": q3 + reach}
    return statistics.withColumns(fences).drop(*[f"{q}_{c}" for c in columns for q in ("q1", "q3")])


def outlier_flag(c: str) -> Column:
    """Outside the fences; NULL is no outlier."""
    return F.coalesce(~F.col(c).between(F.col(f"floor_{c}"), F.col(f"ceiling_{c}")), F.lit(False))


def scaling_ranges(statistics: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``range_<c>``: high less low, NULL where all values are equal."""
    spans = {c: F.col(f"high_{c}") - F.col(f"low_{c}") for c in columns}
    return statistics.withColumns({f"range_{c}": F.when(s > 0, s) for c, s in spans.items()})


def minmax(c: str) -> Column:
    """Scaled by the bounds of the data; NULL where there is no range."""
    return (F.col(c) - F.col(f"low_{c}")) / F.col(f"range_{c}")


def impute_median(df: DataFrame, columns: Sequence[str], method: str = "exact") -> DataFrame:
    statistics = imputation_statistics(df, columns, method=method)
    return beside(df, statistics).withColumns(imputed(columns)).select(*df.columns)


def with_quality_flags(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The constant quality columns every cleaned row carries."""
    return df.withColumns({
        "data_quality_score": F.lit(100.0),
        "is_clean": F.lit(True),
        "cleaning_timestamp": F.current_timestamp() if as_of is None else as_of,
    })


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` not in ``right`` over the columns both have."""
    shared = [c for c in left.columns if c in right.columns]
    return left.select(*shared).subtract(right.select(*shared))
