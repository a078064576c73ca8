"""The quality run over the joined table, from its two weighted sides."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.exact import count_if
from ..operators import quality
from ..operators.pairs import PAYMENTS, PERSONS, PairRelation

WEIGHT = "pair_weight"


def weighted_sides(pairs: PairRelation) -> tuple[DataFrame, DataFrame]:
    """Each side's matched rows, weighted by the number of partners they are repeated for.

    The partner counts are one row per category label, six at most.
    """
    def side(rows: DataFrame, other: DataFrame) -> DataFrame:
        partners = other.groupBy(pairs.key).agg(F.count(F.lit(1)).alias(WEIGHT))
        return rows.join(F.broadcast(partners), pairs.key)

    return side(pairs.payments, pairs.persons), side(pairs.persons, pairs.payments)


def null_checks(pairs: PairRelation, payment_columns, person_columns) -> DataFrame:
    payments, persons = weighted_sides(pairs)
    return quality.check_nulls(payments, payment_columns, WEIGHT).unionByName(
        quality.check_nulls(persons, person_columns, WEIGHT)
    ).unionByName(pair_null_checks(pairs))


def pair_null_checks(pairs: PairRelation) -> DataFrame:
    """The features of a payment and a person together: whether one is NULL depends on groups of both sides alone."""
    c, potentials = F.col, rules.MERCHANT_SAVINGS
    no_base = c("disposable_income_normalized").isNull() | c("income_normalized").isNull()
    earns = F.coalesce(c("income") > 0, F.lit(False))
    cells = pairs.by_payment(
        ("merchant_category", c("amount").isNull().alias("_no_amount"), F.coalesce(c("amount") == 0, F.lit(False)).alias("_zero")), (),
        [
            count_if(earns).alias("_earning"), count_if(no_base).alias("_no_base"), count_if(no_base | earns).alias("_no_base_or_earning"),
            *[count_if(c(p).isNull()).alias(f"_null_{p}") for p in potentials.values()],
            *[count_if(c(p) > 0).alias(f"_some_{p}") for p in potentials.values()],
        ],
    )

    def of_merchant(prefix: str):
        out = F.lit(0)
        for merchant, p in potentials.items():
            out = F.when(c("merchant_category") == merchant, c(f"{prefix}_{p}")).otherwise(out)
        return out

    persons = {
        "spending_income_ratio": F.when(c("_no_amount"), c("_earning")).otherwise(0),
        "high_savings_category": of_merchant("_null"),
        "financial_health_score": F.when(c("_no_amount"), c("_no_base_or_earning")).otherwise(c("_no_base")),
        "is_affordable_transaction": F.lit(0),  # a comparison with NULL counts as false
        "savings_opportunity_score": F.when(c("_no_amount") | c("_zero"), of_merchant("_some")).otherwise(0),
    }

    def total(n):
        product = c(PAYMENTS).cast("decimal(20,0)") * n.cast("decimal(15,0)")
        return F.coalesce(F.sum(product), F.lit(0)).cast("decimal(38,0)")

    counts = cells.agg(total(c(PERSONS)).alias("_rows"), *[total(n).alias(f"_{name}") for name, n in persons.items()])
    return quality.null_rows(counts, {name: c(f"_{name}") for name in persons})


def range_checks(pairs: PairRelation) -> DataFrame:
    payments, persons = weighted_sides(pairs)
    limits = rules.QUALITY_RULES["ranges"]
    return quality.check_range(payments, limits, WEIGHT).unionByName(quality.check_range(persons, limits, WEIGHT))


def distribution_checks(pairs: PairRelation) -> DataFrame:
    payments, persons = weighted_sides(pairs)
    names = rules.QUALITY_RULES["distributions"]
    return quality.check_distribution(payments, names, WEIGHT).unionByName(
        quality.check_distribution(persons, names, WEIGHT)
    )


def uniqueness_checks(pairs: PairRelation) -> DataFrame:
    payments, _ = weighted_sides(pairs)
    return quality.check_uniqueness(payments, rules.QUALITY_RULES["unique"], WEIGHT)


def all_check_rows(spark: SparkSession, pairs: PairRelation, payment_columns, person_columns) -> DataFrame:
    """Every check of the run as uniform rows."""
    types = rules.QUALITY_RULES["types"]
    return quality.check_rows({
        "uniqueness": [uniqueness_checks(pairs)],
        "null_check": [null_checks(pairs, payment_columns, person_columns)],
        "range_check": [range_checks(pairs)],
        "datatype_check": [
            quality.check_datatypes(spark, side, types) for side in (pairs.payments, pairs.persons)
        ],
        "distribution": [distribution_checks(pairs)],
    })
