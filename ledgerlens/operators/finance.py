"""Household finance profiles: raw rows to clean, feature-rich rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bands, rules, scores
from ..functions.exact import MONEY, amount_of
from ..functions.onerow import beside
from ..functions.quantiles import imputation_statistics
from . import cleaning


def required_keys(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("id").isNotNull())


def valid_people(df: DataFrame) -> DataFrame:
    """elt rule: an id, an age above 0 and an income that is not negative."""
    return df.where(F.col("person_id").isNotNull() & (F.col("age") > 0) & (F.col("income") >= 0))


def standardize_elt(raw: DataFrame) -> DataFrame:
    """Typed, trimmed, zero-filled base columns, de-duplicated as whole rows.

    All later columns are functions of these, so DISTINCT runs here, on the
    narrow rows, and gives what it would give on the wide ones.
    """
    zero = F.lit(0).cast(MONEY)
    base = required_keys(raw).select(
        F.col("id").try_cast("bigint").alias("person_id"),
        F.coalesce(amount_of("income"), zero).alias("income"),
        F.coalesce(F.col("age").try_cast("int"), F.lit(0)).alias("age"),
        F.coalesce(F.col("dependents").try_cast("int"), F.lit(0)).alias("dependents"),
        F.lower(F.trim("occupation")).alias("occupation"),
        F.lower(F.trim("city_tier")).alias("city_tier"),
        *[cleaning.clamp_non_negative(c).alias(c) for c in rules.EXPENSES],
        F.coalesce(
            amount_of("desired_savings_percentage", "decimal(5,2)"), F.lit(0).cast("decimal(5,2)")
        ).alias("desired_savings_percentage"),
        *[
            F.coalesce(amount_of(c), zero).alias(c)
            for c in ("desired_savings", "disposable_income") + rules.POTENTIAL_SAVINGS
        ],
    )
    return valid_people(base).distinct()


def _sum_of(columns, kind: str = "decimal(14,2)") -> Column:
    total = F.col(columns[0])
    for c in columns[1:]:
        total = total + F.col(c)
    return total.cast(kind)


def add_features_elt(base: DataFrame) -> DataFrame:
    first = base.select(
        "*",
        bands.age_category(F.col("age")).alias("age_category"),
        bands.age_range(F.col("age")).alias("age_range"),
        bands.case_code(F.col("occupation"), rules.OCCUPATION_CODES["elt"]).alias("occupation_code"),
        bands.occupation_category(F.col("occupation")).alias("occupation_category"),
        bands.case_code(F.col("city_tier"), rules.CITY_TIER_CODES["elt"]).alias("city_tier_code"),
        scores.fixed_minmax("income").alias("income_normalized"),
        scores.fixed_minmax("disposable_income").alias("disposable_income_normalized"),
        _sum_of(rules.EXPENSES).alias("total_expenses"),
        _sum_of(rules.POTENTIAL_SAVINGS).alias("total_potential_savings"),
    )
    return first.select(
        "*",
        bands.income_bracket(F.col("income")).alias("income_bracket"),
        scores.guarded_percent("total_expenses", "income").alias("expense_ratio"),
        scores.guarded_percent("disposable_income", "desired_savings").alias("savings_achievement_rate"),
        _sum_of(("eating_out", "entertainment")).alias("discretionary_spending"),
        _sum_of(("rent", "groceries", "utilities", "healthcare")).alias("essential_spending"),
        scores.financial_health_elt().alias("financial_health_score"),
    )


def clean_elt(raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """43 columns; with ``as_of`` a ``processed_at`` column too."""
    out = add_features_elt(standardize_elt(raw))
    return out if as_of is None else out.withColumn("processed_at", as_of)


def standardize_etl(raw: DataFrame) -> DataFrame:
    """One row per id, doubles for money, trimmed lower-case text; gaps still open."""
    df = cleaning.normalize_column_names(cleaning.dedup_by_key(raw, "id"))
    kinds = {c: "double" for c in rules.FINANCE_NUMERIC} | {"age": "int", "dependents": "int"}
    df = cleaning.fill_constant(cleaning.cast_numeric_safe(df, kinds), rules.FINANCE_TEXT_DEFAULTS)
    return cleaning.standardize_text(df, ("occupation", "city_tier"))


def encode_etl(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        bands.age_category(F.col("age")).alias("age_category"),
        bands.label_code(F.col("occupation"), rules.OCCUPATION_CODES["etl"]).alias("occupation_encoded"),
        bands.label_code(F.col("city_tier"), rules.CITY_TIER_CODES["etl"]).alias("city_tier_encoded"),
    )


def clean_etl(raw: DataFrame, method: str = "exact", as_of: Column | None = None) -> DataFrame:
    """Medians for gaps, label codes, outlier flags and data-driven 0..1 scaling.

    One statistics pass serves all three: the median lies between the extremes, so
    filling gaps moves neither bound.
    """
    base = standardize_etl(raw)
    scaled = ("income", "disposable_income")
    statistics = imputation_statistics(base, rules.FINANCE_NUMERIC, rules.OUTLIER_COLUMNS, scaled, method)
    statistics = cleaning.scaling_ranges(cleaning.outlier_fences(statistics, rules.OUTLIER_COLUMNS), scaled)
    filled = beside(base, statistics).withColumns(cleaning.imputed(rules.FINANCE_NUMERIC))
    out = encode_etl(filled).select(
        *base.columns, "age_category", "occupation_encoded", "city_tier_encoded",
        *[cleaning.outlier_flag(c).alias(f"{c}_outlier_flag") for c in rules.OUTLIER_COLUMNS],
        *[cleaning.minmax(c).alias(f"{c}_normalized") for c in scaled],
    )
    return out if as_of is None else cleaning.with_quality_flags(out, as_of)
