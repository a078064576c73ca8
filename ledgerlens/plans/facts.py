"""The elt facts as bucketed tables, and the results that come from joining them bucket by bucket."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exact import half_up, mean
from ..sources import bucketed, writers
from . import star

c = F.col

#: Buckets of the person tables and of the payment tables, by their entity key.
PERSON_BUCKETS, PAYMENT_BUCKETS = 8, 16


def save_person_tables(people: DataFrame, ages: DataFrame, database: str, as_of) -> None:
    """The personal-finance fact and the person dimension, clustered alike on ``person_sk``."""
    bucketed.save_bucketed(star.fact_personal_finance(people, ages, as_of), f"{database}.fact_personal_finance",
                           PERSON_BUCKETS, "person_sk", ("year", "month"), "overwrite")
    bucketed.save_bucketed(star.dim_person(people), f"{database}.dim_person", PERSON_BUCKETS, "person_sk", ("occupation_type",), "overwrite")


def save_payment_facts(sends: DataFrame, dims: dict[str, DataFrame], database: str) -> None:
    """The payment fact, clustered on ``transaction_id`` like the clean payments it is made from."""
    facts = star.fact_upi_transaction(sends, dims["types"], dims["merchants"], dims["ages"], dims["places"])
    bucketed.save_bucketed(facts, f"{database}.fact_upi_transaction", PAYMENT_BUCKETS, "transaction_id", ("year", "month", "status"), "overwrite")


def payment_dimensions(sends: DataFrame, people: DataFrame) -> dict[str, DataFrame]:
    return {"types": star.dim_transaction_type(sends), "merchants": star.dim_merchant_category(sends),
            "ages": star.dim_age_group(people), "places": star.dim_location(sends)}


def finance_by_person(spark: SparkSession, database: str, small_bytes: int = bucketed.SMALL_TABLE_BYTES) -> DataFrame:
    """Finance facts with the person they belong to, summed per occupation and tier."""
    joined = bucketed.join_tables(spark, f"{database}.fact_personal_finance", f"{database}.dim_person", "person_sk", small_bytes=small_bytes)
    return joined.groupBy("occupation", "city_tier", "age_category").agg(
        F.count(F.lit(1)).alias("persons"), F.sum("income").alias("total_income"),
        F.sum("total_potential_savings").alias("total_potential_savings"), half_up(mean("total_expenses"), 2).alias("avg_expenses"),
    )


def payments_by_group(spark: SparkSession, database: str, small_bytes: int = bucketed.SMALL_TABLE_BYTES) -> DataFrame:
    """Payment facts beside the clean payment of the same id, summed per merchant and age group of both parties."""
    joined = bucketed.join_tables(
        spark, f"{database}.clean_upi_transaction", f"{database}.fact_upi_transaction", "transaction_id", small_bytes=small_bytes,
        left_columns=("merchant_category", "sender_age_group", "receiver_age_group"), right_columns=("amount_inr", "fraud_score"))
    return joined.groupBy("merchant_category", "sender_age_group", "receiver_age_group").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("amount_inr").alias("total_amount"), F.max("fraud_score").alias("max_fraud_score"))


def write_star(spark: SparkSession, people: DataFrame, sends: DataFrame, database: str, location: str, as_of) -> str:
    """The bucketed tables of cleaned inputs in a database of its own; returns its name."""
    writers.create_database(spark, database, "Bucketed facts", location)
    bucketed.save_bucketed(sends, f"{database}.clean_upi_transaction", PAYMENT_BUCKETS, "transaction_id", mode="overwrite")
    sends = spark.table(f"{database}.clean_upi_transaction")
    dims = payment_dimensions(sends, people)
    save_person_tables(people, dims["ages"], database, as_of)
    save_payment_facts(sends, dims, database)
    return database
