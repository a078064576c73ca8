"""Payment transactions: raw rows to clean, feature-rich rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bands, rules, scores
from ..functions.onerow import beside
from ..functions.quantiles import imputation_statistics
from . import cleaning


def required_keys(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("transaction_id").isNotNull() & F.col("timestamp").isNotNull())


def valid_elt(df: DataFrame) -> DataFrame:
    """elt rule: readable time, amount within limits, a final status."""
    return df.where(
        F.col("transaction_id").isNotNull()
        & F.col("transaction_timestamp").isNotNull()
        & (F.col("amount_inr") >= 0)
        & (F.col("amount_inr") <= rules.MAX_AMOUNT)
        & F.col("transaction_status").isin(*rules.STATUS_CODES)
    )


def successful(df: DataFrame) -> DataFrame:
    return df.where(F.col("transaction_status") == "SUCCESS")


def standardize_elt(raw: DataFrame) -> DataFrame:
    """Typed base columns, valid rows only, de-duplicated as whole rows (see finance)."""
    def text(name: str) -> Column:
        return F.lower(F.trim(name)).alias(name)

    def whole(name: str) -> Column:
        return F.coalesce(F.col(name).try_cast("int"), F.lit(0)).alias(name)

    base = required_keys(raw).select(
        text("transaction_id"),
        F.col("timestamp").try_cast("timestamp").alias("transaction_timestamp"),
        text("transaction_type"), text("merchant_category"),
        cleaning.clamp_non_negative("amount_inr").alias("amount_inr"),
        F.upper(F.trim("transaction_status")).alias("transaction_status"),
        cleaning.strip_inner_spaces(F.col("sender_age_group")).alias("sender_age_group"),
        cleaning.strip_inner_spaces(F.col("receiver_age_group")).alias("receiver_age_group"),
        text("sender_state"), text("sender_bank"), text("receiver_bank"),
        text("device_type"), text("network_type"),
        whole("fraud_flag"), whole("hour_of_day"), text("day_of_week"), whole("is_weekend"),
    )
    return valid_elt(base).distinct()


def add_features_elt(base: DataFrame) -> DataFrame:
    c = F.col
    return base.select(
        "*",
        bands.category_of_group(c("sender_age_group"), "elt").alias("sender_age_category"),
        bands.category_of_group(c("receiver_age_group"), "elt").alias("receiver_age_category"),
        F.year("transaction_timestamp").alias("transaction_year"),
        F.month("transaction_timestamp").alias("transaction_month"),
        F.dayofmonth("transaction_timestamp").alias("transaction_day"),
        bands.time_of_day(c("hour_of_day"), "elt").alias("time_of_day_category"),
        (c("is_weekend") == 1).alias("is_weekend_flag"),
        (c("hour_of_day").between(9, 17) & (c("is_weekend") == 0)).alias("is_business_hours"),
        bands.merchant_group(c("merchant_category")).alias("merchant_category_group"),
        bands.spending_type(c("merchant_category")).alias("spending_type"),
        bands.transaction_type_category(c("transaction_type")).alias("transaction_type_category"),
        scores.fixed_minmax("amount_inr").alias("amount_normalized"),
        bands.case_code(c("transaction_status"), rules.STATUS_CODES, -1).alias("transaction_status_code"),
        bands.case_code(c("device_type"), rules.DEVICE_CODES).alias("device_type_code"),
        bands.case_code(c("network_type"), rules.NETWORK_CODES).alias("network_type_code"),
        bands.amount_category(c("amount_inr"), "elt").alias("transaction_amount_category"),
        scores.fraud_score().alias("fraud_score"),
        (c("amount_inr") > 5000).alias("is_high_value"),
        c("hour_of_day").between(0, 5).alias("is_unusual_time"),
    )


def clean_elt(raw: DataFrame, as_of: Column | None = None) -> DataFrame:
    """36 columns; with ``as_of`` a ``processed_at`` column too."""
    out = add_features_elt(standardize_elt(raw))
    return out if as_of is None else out.withColumn("processed_at", as_of)


def standardize_etl(raw: DataFrame) -> DataFrame:
    """One row per id, normalised names and text, typed numbers; the amount gap still open."""
    df = cleaning.normalize_column_names(cleaning.dedup_by_key(raw, "transaction_id"), drop="()")
    df = df.withColumnRenamed("amount_inr", "amount")
    df = df.withColumn("timestamp", cleaning.parse_timestamp(F.col("timestamp")))
    kinds = {"amount": "double", "fraud_flag": "int", "hour_of_day": "int", "is_weekend": "int"}
    return cleaning.standardize_text(cleaning.cast_numeric_safe(df, kinds), rules.PAYMENT_TEXT)


def add_features_etl(df: DataFrame) -> DataFrame:
    c = F.col
    return df.select(
        "*",
        bands.category_of_group(c("sender_age_group"), "etl").alias("sender_age_category"),
        F.to_date("timestamp").alias("transaction_date"),
        F.year("timestamp").alias("transaction_year"),
        F.month("timestamp").alias("transaction_month"),
        F.dayofmonth("timestamp").alias("transaction_day"),
        bands.amount_category(c("amount"), "etl").alias("amount_category"),
        (c("is_weekend") == 1).alias("is_weekend_bool"),
        bands.time_of_day(c("hour_of_day"), "etl").alias("time_of_day"),
    )


def _keyed() -> Column:
    return F.col("timestamp").isNotNull() & F.col("transaction_id").isNotNull()


def _accepted() -> Column:
    return F.coalesce((F.col("amount") > 0) & _keyed(), F.lit(False))


def _statistics(base: DataFrame, method: str) -> DataFrame:
    """One row: the median amount, and the extremes of the accepted amounts once gaps are filled.

    Both come from the unfilled rows: a filled gap can only add the median itself.
    """
    extremes = base.agg(
        F.min(F.when(_accepted(), F.col("amount"))).alias("_low"),
        F.max(F.when(_accepted(), F.col("amount"))).alias("_high"),
        F.count(F.when(F.col("amount").isNull() & _keyed(), 1)).alias("_gaps"),
    )
    both = beside(extremes, imputation_statistics(base, ("amount",), method=method))
    filler = F.when((F.col("_gaps") > 0) & (F.col("median_amount") > 0), F.col("median_amount"))
    bounds = both.select(
        "median_amount", F.least("_low", filler).alias("low_amount"), F.greatest("_high", filler).alias("high_amount")
    )
    return cleaning.scaling_ranges(bounds, ("amount",))


def prepared_etl(raw: DataFrame, method: str = "exact") -> DataFrame:
    """Every de-duplicated row, good or bad: gaps filled, features and 0..1 scaling added."""
    base = standardize_etl(raw)
    df = beside(base, _statistics(base, method)).withColumns(cleaning.imputed(("amount",)))
    df = cleaning.fill_constant(df, rules.PAYMENT_TEXT_DEFAULTS)
    scaled = df.withColumn("amount_normalized", cleaning.minmax("amount"))
    return add_features_etl(scaled.select(*base.columns, "amount_normalized"))


def accepted_etl(prepared: DataFrame, as_of: Column | None = None) -> DataFrame:
    df = prepared.where(_accepted())
    return df if as_of is None else cleaning.with_quality_flags(df, as_of)


def rejected_etl(prepared: DataFrame) -> DataFrame:
    """The exact complement of the accepted rows, a NULL predicate included."""
    return prepared.where(~_accepted()).drop("amount_normalized")


def clean_etl(raw: DataFrame, method: str = "exact", as_of: Column | None = None):
    """(clean rows, rejected rows)."""
    prepared = prepared_etl(raw, method)
    return accepted_etl(prepared, as_of), rejected_etl(prepared)
