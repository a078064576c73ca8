"""Validation queries of the elt profile."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exact import count_if, mean
from ..operators.pairs import PairRelation, pair_rows

c = F.col


def _tall(one_row: DataFrame) -> DataFrame:
    """A one-row aggregate as (check_name, value) rows."""
    structs = [F.struct(F.lit(n).alias("check_name"), c(n).cast("double").alias("value")) for n in one_row.columns]
    return one_row.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def _null_count(name: str, alias: str):
    return count_if(c(name).isNull()).alias(alias)


def finance_checks(clean_finance: DataFrame) -> DataFrame:
    return _tall(clean_finance.agg(
        F.count(F.lit(1)).alias("finance_total_records"),
        _null_count("person_id", "null_person_id"), _null_count("age", "null_age"), _null_count("income", "null_income"),
        F.min("age").alias("min_age"), F.max("age").alias("max_age"), F.min("income").alias("min_income"),
        F.max("income").alias("max_income"), mean("expense_ratio").alias("avg_expense_ratio"),
    ))


def payment_checks(clean_payments: DataFrame) -> DataFrame:
    counts = clean_payments.agg(
        F.count(F.lit(1)).alias("upi_total_records"), F.countDistinct("transaction_id").alias("unique_transactions"),
        _null_count("transaction_id", "null_transaction_id"), _null_count("amount_inr", "null_amount"),
        _null_count("transaction_status", "null_status"), F.min("amount_inr").alias("min_amount"),
        F.max("amount_inr").alias("max_amount"), mean("amount_inr").alias("avg_amount"),
        F.min("hour_of_day").alias("min_hour"), F.max("hour_of_day").alias("max_hour"),
    )
    return _tall(counts.withColumn("duplicate_count", c("upi_total_records") - c("unique_transactions")))


def join_coverage(pairs: PairRelation) -> DataFrame:
    """Per category: pair rows, distinct payments and distinct persons, in category order."""
    cells = pairs.by_payment(
        (), [F.countDistinct("transaction_id").alias("transaction_count")],
        [F.countDistinct("person_id").alias("person_count")],
    )
    return cells.select(
        c("age_category").alias("sender_age_category"), pair_rows().alias("record_count"), "transaction_count",
        "person_count",
    ).orderBy("sender_age_category")


def join_checks(pairs: PairRelation) -> DataFrame:
    """Totals over the joined table. A person or payment may sit in two categories, so ids are counted once here."""
    payments = pairs.matched_payments().agg(F.countDistinct("transaction_id").alias("joined_unique_transactions"))
    persons = pairs.matched_persons().agg(F.countDistinct("person_id").alias("joined_unique_persons"))
    rows = pairs.by_payment(()).agg(
        F.sum(pair_rows()).alias("total_integrated_records"), F.count(F.lit(1)).alias("age_categories")
    )
    return reduce(DataFrame.unionByName, [_tall(f) for f in (rows, payments, persons)])


def finance_distribution(clean_finance: DataFrame) -> DataFrame:
    return clean_finance.groupBy("age_category").agg(
        F.count(F.lit(1)).alias("record_count"), mean("income").alias("avg_income"),
        mean("total_expenses").alias("avg_expenses"),
    ).orderBy("age_category")


def payment_distribution(clean_payments: DataFrame) -> DataFrame:
    return clean_payments.groupBy("sender_age_category").agg(
        F.count(F.lit(1)).alias("transaction_count"), mean("amount_inr").alias("avg_transaction_amount"),
        count_if(c("fraud_flag") == 1).alias("fraud_count"),
    ).orderBy("sender_age_category")
