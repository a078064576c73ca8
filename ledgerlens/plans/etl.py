"""etl profile: pair features and their aggregates, computed from the two factors.

Per pair of a payment and a person, with a = amount and the person's terms
  r = 1 / income where income > 0, else 0
  h = 40 * scaled disposable income + 30 * scaled income
  p = savings potential that belongs to the payment's merchant category
the features are spending ratio a*r, health score h + 30*(1 - a*r), opportunity
100*p/a where p > 0. Each is a product of a payment and a person term, so sums
and averages over pairs are products of one-sided sums.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, scores
from ..functions.exact import count_if
from ..operators.affordability import affordable_persons
from ..operators.pairs import PAYMENTS, PERSONS, PairRelation, over_persons, pair_rows

c = F.col

PERSON_COLUMNS = (
    "age", "income", "rent", "loan_repayment", "groceries", "transport", "eating_out",
    "entertainment", "utilities", "healthcare", "education", "miscellaneous", "desired_savings",
    "disposable_income", "potential_savings_groceries", "potential_savings_transport",
    "potential_savings_eating_out", "potential_savings_entertainment", "income_normalized",
    "disposable_income_normalized", "occupation_encoded", "city_tier_encoded",
)
PAYMENT_COLUMNS = (
    "transaction_id", "transaction_timestamp", "transaction_type", "merchant_category", "amount",
    "transaction_status", "age_category", "sender_state", "device_type", "network_type", "fraud_flag",
    "is_weekend", "amount_category", "time_of_day", "transaction_month", "amount_normalized",
)

#: What the joined table has besides: labels of the person, features of the payment alone. The five others need both.
PERSON_LABELS = ("finance_id", "occupation", "city_tier")
PAYMENT_FEATURES = ("weekend_spending_impact", "age_transaction_pattern", "digital_adoption_score")
#: The columns of one side in the joined table that the null checks cover; those of both sides are checked with them.
CHECKED_COLUMNS = (*PAYMENT_COLUMNS, *PAYMENT_FEATURES), (*PERSON_LABELS, *PERSON_COLUMNS)


def joined(clean_payments: DataFrame, clean_finance: DataFrame) -> PairRelation:
    """Both sides cut to their join columns, with the one-sided features and terms added."""
    payments = clean_payments.select(
        *[n for n in PAYMENT_COLUMNS if n not in ("transaction_timestamp", "age_category")],
        c("timestamp").alias("transaction_timestamp"), c("sender_age_category").alias("age_category"),
    ).select(
        *PAYMENT_COLUMNS,
        scores.weekend_impact().alias("weekend_spending_impact"),
        F.concat("age_category", F.lit("_"), "merchant_category").alias("age_transaction_pattern"),
        scores.digital_adoption(c("device_type")).alias("digital_adoption_score"),
    )
    persons = clean_finance.select(
        c("id").alias("finance_id"), "age_category", "occupation", "city_tier", *PERSON_COLUMNS,
        F.when(c("income") > 0, F.lit(1.0) / c("income")).otherwise(F.lit(0.0)).alias("per_income"),
        (c("disposable_income_normalized") * 40 + c("income_normalized") * 30).alias("health_base"),
        (
            c("potential_savings_groceries") + c("potential_savings_transport")
            + c("potential_savings_eating_out") + c("potential_savings_entertainment")
        ).alias("four_potentials"),
    )
    return PairRelation(payments, persons)


def join_age_category_inner(pairs: PairRelation) -> DataFrame:
    """The joined table at payment grain: each payment beside its persons' averages."""
    rows = pairs.each_payment(*[F.avg(n).alias(f"avg_{n}") for n in PERSON_COLUMNS])
    return rows.select(*PAYMENT_COLUMNS, c(PERSONS).alias("person_rows"), *[f"avg_{n}" for n in PERSON_COLUMNS])


def by_merchant(prefix: str, merchant: Column) -> Column:
    """The person-side column of the potential that belongs to the merchant category, else 0."""
    out = F.lit(0.0)
    for name, column in rules.MERCHANT_SAVINGS.items():
        out = F.when(merchant == name, c(f"{prefix}_{column}").cast("double")).otherwise(out)
    return out


def _potential_measures() -> list[Column]:
    """Per potential column: average, positive part averaged, and what its positive rows hold."""
    out = []
    for p in rules.MERCHANT_SAVINGS.values():
        positive = c(p) > 0
        out += [
            F.avg(p).alias(f"mean_{p}"),
            F.avg(F.when(positive, c(p)).otherwise(F.lit(0.0))).alias(f"gain_{p}"),
            count_if(positive).alias(f"rows_{p}"),
            F.sum(F.when(positive, c(p))).alias(f"sum_{p}"),
            F.sum(F.when(positive, c("four_potentials"))).alias(f"four_{p}"),
        ]
    return out


def _person_measures() -> list[Column]:
    return [
        F.avg("per_income").alias("per_income"), F.avg("health_base").alias("health_base"),
        F.avg("income").alias("avg_income"), F.avg("disposable_income").alias("avg_disposable_income"),
        *_potential_measures(),
    ]


def _health(amount: Column) -> Column:
    return c("health_base") + (F.lit(1.0) - amount * c("per_income")) * 30


def joined_features_etl(pairs: PairRelation) -> DataFrame:
    """Each payment with its own features and the pair features summed up over its persons."""
    rows = pairs.each_payment(*_person_measures()).join(
        affordable_persons(pairs), [pairs.key, "amount"], "left"
    )
    merchant, amount = c("merchant_category"), c("amount")
    return rows.select(
        "transaction_id", "age_category", "merchant_category", "amount", "weekend_spending_impact",
        "age_transaction_pattern", "digital_adoption_score", c(PERSONS).alias("person_rows"),
        (amount * c("per_income")).alias("avg_spending_income_ratio"),
        by_merchant("mean", merchant).alias("avg_high_savings_category"),
        _health(amount).alias("avg_financial_health_score"),
        c("affordable_persons"),
        (by_merchant("gain", merchant) / amount * 100).alias("avg_savings_opportunity_score"),
    )


def merchant_cells(pairs: PairRelation, by: tuple[str, ...]) -> DataFrame:
    """Payment groups beside the person aggregate of their category."""
    return pairs.by_payment(
        by,
        [
            F.sum("amount").alias("_sum"), F.avg("amount").alias("avg_amount"),
            F.avg(F.lit(1.0) / c("amount")).alias("_per_amount"), count_if(c("fraud_flag") == 1).alias("_fraud"),
        ],
        _person_measures(),
    )


def cell_measures(merchant: Column) -> dict[str, Column]:
    """Pair measures of a merchant cell."""
    return {
        "transaction_count": pair_rows(),
        "total_amount": c("_sum") * c(PERSONS).cast("double"),
        "avg_amount": c("avg_amount"),
        "fraud_count": over_persons("_fraud"),
        "avg_financial_health": _health(c("avg_amount")),
        "avg_savings_opportunity": by_merchant("gain", merchant) * c("_per_amount") * 100,
        "avg_income": c("avg_income"),
        "avg_disposable_income": c("avg_disposable_income"),
    }


def agg_age_merchant(pairs: PairRelation) -> DataFrame:
    cells = merchant_cells(pairs, ("merchant_category",))
    measures = cell_measures(c("merchant_category"))
    return cells.select("age_category", "merchant_category", *[m.alias(n) for n, m in measures.items()])


def opportunity_cells(pairs: PairRelation, by: tuple[str, ...]) -> DataFrame:
    """Payment groups beside the positive-potential sums of their category."""
    return pairs.by_payment(by, [F.avg(F.lit(1.0) / c("amount")).alias("_per_amount")], _potential_measures())


def opportunity_measures(merchant: Column) -> dict[str, Column]:
    """Measures over the pairs with an opportunity score above 0."""
    rows = by_merchant("rows", merchant)
    return {
        "transaction_count": c(PAYMENTS).cast("decimal(20,0)") * rows.cast("decimal(15,0)"),
        "avg_savings_opportunity": F.try_divide(by_merchant("sum", merchant), rows) * c("_per_amount") * 100,
        "total_potential_savings": by_merchant("four", merchant) * c(PAYMENTS).cast("double"),
    }
