"""elt star schema: six dimensions and two facts, derived where the data allows.

Columns the inputs cannot fill (generation, region, tier, population_category,
is_holiday, description, actual_savings, savings_rate) are typed NULLs.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.exact import half_up, mean
from ..functions.keys import stable_id

c = F.col


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


#: Columns that tell two clean rows apart: cleaning leaves no two rows that agree in all of them.
FINANCE_ROW = ("person_id", *[n for n in rules.FINANCE_COLUMNS if n != "id"])
PAYMENT_ROW = ("transaction_id", "transaction_timestamp", *[n for n in rules.PAYMENT_COLUMNS if n not in ("transaction_id", "timestamp")])


def dim_age_group(clean_finance: DataFrame) -> DataFrame:
    """One row per band in use; the last band and Unknown are open."""
    bands = clean_finance.select("age_range", "age_category").distinct()  # six labels at most
    low, high = _null("int"), _null("int")
    for lo, hi, label, _ in rules.AGE_BANDS:
        low = F.when(c("age_range") == label, F.lit(lo)).otherwise(low)
        high = F.when(c("age_range") == label, F.lit(hi).cast("int")).otherwise(high)
    return bands.select(
        F.row_number().over(Window.orderBy("age_range")).alias("age_group_sk"), "age_range", "age_category",
        low.alias("min_age"), high.alias("max_age"), _null("string").alias("generation"),
    )


def scd1_latest(df: DataFrame, key: str, version: Sequence[str]) -> DataFrame:
    """Type 1: the row with the greatest version per key replaces the others.

    A maximum over structs, so versions of a hot key collapse before the shuffle.
    """
    rest = [n for n in df.columns if n != key and n not in version]
    latest = df.groupBy(key).agg(F.max(F.struct(*version, *rest)).alias("_row"))
    return latest.select(*[c(n) if n == key else c(f"_row.{n}") for n in df.columns])


def scd1_upsert(dimension: DataFrame, changes: DataFrame, key: str, version: str) -> DataFrame:
    """The dimension after the changes: new keys are added, known keys overwritten."""
    return scd1_latest(dimension.unionByName(changes), key, [version])


def changed_rows(dimension: DataFrame, load: DataFrame, key: str) -> DataFrame:
    """The rows of ``load`` that are new or differ from the dimension's row of their key in any column.

    Only keys and digests meet; rows that did not change move no further.
    """
    names = [n for n in load.columns if n != key]
    digest = F.sha2(F.to_json(F.struct(*[c(n).cast("string").alias(n) for n in names]), {"ignoreNullFields": "false"}), 256)
    known = dimension.select(c(key).alias("_key"), digest.alias("_digest"))
    same = load.withColumn("_new", digest).join(known, c(key).eqNullSafe(c("_key")) & (c("_new") == c("_digest")), "left_anti")
    return same.drop("_new")


def dim_person(clean_finance: DataFrame) -> DataFrame:
    """One row per person; the person id is the key, and serves as its surrogate too."""
    people = clean_finance.select(
        "person_id", "age", "age_category", "dependents", "occupation", "occupation_category", "city_tier",
        "income_bracket",
    )
    latest = scd1_latest(people, "person_id", ["age"])
    return latest.select(
        c("person_id").cast("bigint").alias("person_sk"), *people.columns,
        c("occupation_category").alias("occupation_type"),
    )


def dim_transaction_type(clean_payments: DataFrame) -> DataFrame:
    kinds = clean_payments.select(
        "transaction_type", c("transaction_type_category").alias("transaction_category")
    ).distinct()
    return kinds.select(
        stable_id(("transaction_type",)).alias("transaction_type_sk"), "transaction_type",
        "transaction_category", _null("string").alias("description"),
    )


def dim_merchant_category(clean_payments: DataFrame) -> DataFrame:
    merchants = clean_payments.groupBy(
        "merchant_category", c("merchant_category_group").alias("category_group"),
        (c("spending_type") == "Essential").alias("is_essential"),
    ).agg(half_up(mean("amount_inr"), 2).cast("decimal(12,2)").alias("avg_transaction_amount"))
    return merchants.select(stable_id(("merchant_category",)).alias("merchant_category_sk"), *merchants.columns)


def dim_date(clean_payments: DataFrame, fiscal_start_month: int = 4) -> DataFrame:
    """One row per date. The fiscal year is named by its first calendar year; April to March by default."""
    day = c("full_date")
    shift = F.lit(fiscal_start_month - 1)
    fiscal = F.add_months(day, -(fiscal_start_month - 1))
    return clean_payments.select(F.to_date("transaction_timestamp").alias("full_date")).distinct().select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_sk"), "full_date", F.year(day).alias("year"),
        F.quarter(day).alias("quarter"), F.month(day).alias("month"), F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"), F.dayofmonth(day).alias("day_of_month"),
        F.dayofweek(day).alias("day_of_week"), F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"), _null("boolean").alias("is_holiday"),
        F.year(fiscal).alias("fiscal_year"),
        (F.floor(F.pmod(F.month(day) - 1 - shift, F.lit(12)) / 3) + 1).cast("int").alias("fiscal_quarter"),
    )


def dim_location(clean_payments: DataFrame) -> DataFrame:
    states = clean_payments.select(c("sender_state").alias("state_name")).distinct()
    return states.select(
        stable_id(("state_name",)).alias("location_sk"), "state_name", _null("string").alias("region"),
        _null("string").alias("tier"), _null("string").alias("population_category"),
    )


def fact_personal_finance(clean_finance: DataFrame, age_groups: DataFrame, snapshot: Column) -> DataFrame:
    """One row per clean finance row, dated by ``snapshot`` (the inputs carry no date)."""
    day = F.to_date(snapshot)
    rows = clean_finance.withColumn("finance_fact_sk", stable_id(FINANCE_ROW))
    keys = F.broadcast(age_groups.select("age_group_sk", "age_range"))  # six rows at most
    return rows.join(keys, "age_range", "left").select(
        "finance_fact_sk", c("person_id").cast("bigint").alias("person_sk"), "age_group_sk",
        _null("int").alias("location_sk"), F.date_format(day, "yyyyMMdd").cast("int").alias("date_sk"),
        "income", "total_expenses", *rules.EXPENSES, *rules.SAVINGS,
        _null("decimal(12,2)").alias("actual_savings"), _null("decimal(5,2)").alias("savings_rate"),
        *rules.POTENTIAL_SAVINGS, "total_potential_savings", F.year(day).alias("year"), F.month(day).alias("month"),
    )


def fact_upi_transaction(
    clean_payments: DataFrame, types: DataFrame, merchants: DataFrame, age_groups: DataFrame, locations: DataFrame
) -> DataFrame:
    """One row per clean payment with its dimension keys.

    Age groups are six rows and broadcast. The other dimensions are joined without a
    hint, so Spark broadcasts them by measured size and splits a hot key otherwise.
    """
    rows = clean_payments.withColumn("transaction_fact_sk", stable_id(PAYMENT_ROW))
    ages = age_groups.select("age_group_sk", "age_category")
    for side in ("sender", "receiver"):
        keys = ages.select(c("age_group_sk").alias(f"{side}_age_group_sk"), c("age_category").alias(f"{side}_age_category"))
        rows = rows.join(F.broadcast(keys), f"{side}_age_category", "left")
    rows = rows.join(types.select("transaction_type_sk", "transaction_type"), "transaction_type", "left")
    merchant = merchants.select("merchant_category_sk", c("merchant_category").alias("_m"))
    rows = rows.join(merchant, c("merchant_category").eqNullSafe(c("_m")), "left")
    place = locations.select(c("location_sk").alias("sender_location_sk"), c("state_name").alias("sender_state"))
    rows = rows.join(place, "sender_state", "left")
    return rows.select(
        "transaction_fact_sk", "transaction_id", "transaction_type_sk", "merchant_category_sk",
        "sender_age_group_sk", "receiver_age_group_sk", "sender_location_sk",
        F.date_format("transaction_timestamp", "yyyyMMdd").cast("int").alias("date_sk"), "transaction_timestamp",
        "amount_inr", "transaction_status", "sender_bank", "receiver_bank", "device_type", "network_type",
        "fraud_flag", "fraud_score", "hour_of_day", "day_of_week", "is_weekend", "time_of_day_category",
        c("transaction_year").alias("year"), c("transaction_month").alias("month"),
        c("transaction_status").alias("status"),
    )
