"""elt profile: joined-table summaries and the five data marts.

Every result is a function of cleaned payments and cleaned persons. Results are
those of grouping the pair table, whose totals count a payment once per person
of its category; the pair table itself is not built (see operators.pairs).
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import count_if, half_up, mean, percent, sum_if
from ..functions.quantiles import exact_median
from ..operators import payments as payment_rows
from ..operators.pairs import (
    PAYMENTS, PairRelation, over_persons, pair_rows, sample_stddev_over_persons,
)

c = F.col

# person columns the joined table carries besides its keys and labels
PERSON_MEASURES = (
    "age", "dependents", "income", "total_expenses", "expense_ratio", "rent", "groceries",
    "transport", "eating_out", "entertainment", "utilities", "healthcare", "education",
    "miscellaneous", "desired_savings", "disposable_income", "savings_achievement_rate",
    "total_potential_savings", "financial_health_score", "discretionary_spending",
    "essential_spending",
)
JOINED_PAYMENT_COLUMNS = (
    "transaction_id", "transaction_timestamp", "transaction_year", "transaction_month",
    "transaction_type", "merchant_category", "merchant_category_group", "spending_type",
    "transaction_amount", "transaction_status", "fraud_flag", "fraud_score", "is_high_value",
    "hour_of_day", "time_of_day_category", "is_weekend", "day_of_week", "sender_age_group",
    "sender_age_category", "sender_state", "device_type", "network_type", "sender_bank",
    "receiver_bank",
)


def joined(clean_payments: DataFrame, clean_finance: DataFrame) -> PairRelation:
    """Successful payments and persons, to be paired on the sender's age category.

    The left join of the original keeps only rows with a person, so it is inner.
    """
    sends = payment_rows.successful(clean_payments).withColumnRenamed("amount_inr", "transaction_amount")
    return PairRelation(
        sends.withColumn("age_category", c("sender_age_category")),
        clean_finance.where(c("person_id").isNotNull()),
    )


def integrated_spending_savings(pairs: PairRelation) -> DataFrame:
    """The joined table at payment grain: each payment beside its persons' aggregate."""
    averages = [mean(m).alias(f"avg_{m}") for m in PERSON_MEASURES]
    rows = pairs.each_payment(F.countDistinct("person_id").alias("unique_persons"), *averages)
    return rows.select(
        *JOINED_PAYMENT_COLUMNS, c("n_persons").alias("person_rows"), "unique_persons",
        *[f"avg_{m}" for m in PERSON_MEASURES],
    )


def _averages(*names: str, prefix: str = "") -> list[Column]:
    return [mean(n).alias(prefix + n) for n in names]


def _rounded(frame: DataFrame, digits: dict[str, int]) -> DataFrame:
    return frame.withColumns({n: half_up(c(n), d) for n, d in digits.items()})


def _group_sum(group: str, name: str) -> Column:
    return sum_if(c("merchant_category_group") == group, "transaction_amount").alias(name)


def _type_sum(kind: str, name: str) -> Column:
    return sum_if(c("spending_type") == kind, "transaction_amount").alias(name)


def age_category_spending_summary(pairs: PairRelation) -> DataFrame:
    by = ("transaction_year", "transaction_month")
    totals = {
        "total_transaction_value": F.sum("transaction_amount"),
        "food_groceries_spending": _group_sum("Food & Groceries", "x"),
        "leisure_spending": _group_sum("Leisure", "x"),
        "transport_spending": _group_sum("Transportation", "x"),
        "health_spending": _group_sum("Health & Insurance", "x"),
        "utilities_spending": _group_sum("Utilities & Bills", "x"),
        "essential_upi_spending": _type_sum("Essential", "x"),
        "discretionary_upi_spending": _type_sum("Discretionary", "x"),
        "fraud_transaction_count": count_if(c("fraud_flag") == 1),
        "weekend_transactions": count_if(c("is_weekend") == 1),
    }
    joined = pairs.by_payment(
        by,
        [
            F.countDistinct("transaction_id").alias("total_transactions"),
            mean("transaction_amount").alias("avg_transaction_amount"),
            F.min("transaction_amount").alias("min_transaction_amount"),
            F.max("transaction_amount").alias("max_transaction_amount"),
            F.var_pop(c("transaction_amount").cast("double")).alias("_var"),
            *[t.alias(n) for n, t in totals.items()],
        ],
        _averages(
            "income", "total_expenses", "disposable_income", "desired_savings",
            "savings_achievement_rate", "financial_health_score", "expense_ratio", prefix="avg_",
        ),
    )
    return joined.select(
        c("age_category").alias("sender_age_category"), *by, "total_transactions",
        over_persons("total_transaction_value").alias("total_transaction_value"),
        "avg_transaction_amount", "min_transaction_amount", "max_transaction_amount",
        sample_stddev_over_persons("_var").alias("stddev_transaction_amount"),
        *[over_persons(n).alias(n) for n in list(totals)[1:]],
        percent(c("fraud_transaction_count"), c(PAYMENTS)).alias("fraud_percentage"),
        percent(c("weekend_transactions"), c(PAYMENTS)).alias("weekend_transaction_percentage"),
        "avg_income", "avg_total_expenses", "avg_disposable_income", "avg_desired_savings",
        "avg_savings_achievement_rate", "avg_financial_health_score", "avg_expense_ratio",
    )


def merchant_category_analysis(pairs: PairRelation) -> DataFrame:
    by = ("merchant_category", "merchant_category_group")
    amount = c("transaction_amount")
    joined = pairs.by_payment(
        by,
        [
            F.countDistinct("transaction_id").alias("transaction_count"),
            F.sum(amount).alias("total_amount"),
            mean(amount).alias("avg_amount"),
            mean(F.when(c("is_weekend") == 1, amount)).alias("avg_weekend_amount"),
            mean(F.when(c("is_weekend") == 0, amount)).alias("avg_weekday_amount"),
            count_if(c("time_of_day_category") == "Evening").alias("_evening"),
            mean("fraud_flag").alias("fraud_rate"),
        ],
        [
            F.countDistinct("person_id").alias("unique_persons"),
            mean("financial_health_score").alias("avg_financial_health"),
            mean("savings_achievement_rate").alias("avg_savings_rate"),
            mean("disposable_income").alias("avg_disposable_income"),
        ],
    ).withColumn("merchant", F.coalesce("merchant_category", F.lit("")))
    # repeating every payment once per person leaves the median where it is
    medians = exact_median(
        pairs.payments.withColumn("merchant", F.coalesce("merchant_category", F.lit(""))),
        "transaction_amount", ("age_category", "merchant"), "median_amount",
    )
    return joined.join(medians, ["age_category", "merchant"], "left").select(
        c("age_category").alias("sender_age_category"), *by, "transaction_count", "unique_persons",
        over_persons("total_amount").alias("total_amount"), "avg_amount", "median_amount",
        "avg_weekend_amount", "avg_weekday_amount", "avg_financial_health", "avg_savings_rate",
        "avg_disposable_income",
        F.try_divide(c("_evening").cast("double"), c(PAYMENTS).cast("double")).alias("evening_transaction_ratio"),
        "fraud_rate",
    )


def occupation_spending_analysis(pairs: PairRelation) -> DataFrame:
    by = ("occupation_category", "city_tier")
    joined = pairs.by_person(
        by,
        [F.sum("transaction_amount").alias("_sent"), mean("transaction_amount").alias("avg_upi_transaction")],
        [
            F.countDistinct("person_id").alias("person_count"),
            mean("age").alias("avg_age"), mean("dependents").alias("avg_dependents"),
            mean("income").alias("avg_income"), mean("total_expenses").alias("avg_expenses"),
            mean("disposable_income").alias("avg_disposable_income"),
            mean("savings_achievement_rate").alias("avg_savings_rate"),
            *[
                mean(m).alias(f"avg_{m}_expense")
                for m in ("groceries", "eating_out", "entertainment", "transport", "utilities")
            ],
            mean("total_potential_savings").alias("avg_potential_savings"),
        ],
    )
    return joined.select(
        "occupation_category", c("age_category").alias("sender_age_category"), "city_tier",
        "person_count", "avg_age", "avg_dependents", "avg_income", "avg_expenses",
        "avg_disposable_income", "avg_savings_rate",
        pair_rows().alias("total_upi_transactions"),
        over_persons("_sent").alias("total_upi_spending"), "avg_upi_transaction",
        "avg_groceries_expense", "avg_eating_out_expense", "avg_entertainment_expense",
        "avg_transport_expense", "avg_utilities_expense", "avg_potential_savings",
        percent(c("avg_potential_savings"), c("avg_expenses")).alias("potential_savings_percentage"),
    )


def time_based_spending_patterns(pairs: PairRelation) -> DataFrame:
    """Two plain aggregates: per merchant first, which also yields the mode and the distinct count."""
    by = ("time_of_day_category", "is_weekend", "day_of_week")
    per_merchant = pairs.payment_side(
        (*by, "merchant_category"),
        F.sum("transaction_amount").alias("_sum"), F.sum("fraud_flag").alias("_fraud"),
        F.sum("fraud_score").alias("_score"),
    )
    # most frequent first, ties to the smaller name; NULL is no category
    rank = F.when(
        c("merchant_category").isNotNull(), F.struct((-c(PAYMENTS)).alias("n"), c("merchant_category").alias("m"))
    )
    slots = per_merchant.groupBy("age_category", *by).agg(
        F.sum(PAYMENTS).alias(PAYMENTS), F.sum("_sum").alias("_sum"), F.sum("_fraud").alias("_fraud"),
        F.sum("_score").alias("_score"), F.count("merchant_category").alias("distinct_categories"),
        F.min(rank).alias("_top"),
    )
    persons = pairs.person_side(
        (), mean("income").alias("avg_income"), mean("disposable_income").alias("avg_disposable_income"),
        mean("financial_health_score").alias("avg_financial_health"),
    )
    n = c(PAYMENTS).cast("double")
    return slots.join(F.broadcast(persons), "age_category").select(
        c("age_category").alias("sender_age_category"), *by,
        pair_rows().alias("transaction_count"), over_persons("_sum").alias("total_amount"),
        (c("_sum").cast("double") / n).alias("avg_amount"), "distinct_categories",
        c("_top.m").alias("most_common_category"), "avg_income", "avg_disposable_income",
        "avg_financial_health", over_persons("_fraud").alias("fraud_count"),
        (c("_score").cast("double") / n).alias("avg_fraud_score"),
    )


def mart_age_spending_behavior(pairs: PairRelation) -> DataFrame:
    digits = {
        "avg_age": 1, "avg_dependents": 1, "avg_monthly_income": 2, "avg_monthly_expenses": 2,
        "avg_expense_ratio_percent": 2, "avg_disposable_income": 2, "avg_desired_savings": 2,
        "avg_savings_achievement_percent": 2, "avg_potential_savings": 2, "avg_transaction_amount": 2,
        "avg_groceries": 2, "avg_eating_out": 2, "avg_entertainment": 2, "avg_transport": 2,
        "avg_utilities": 2, "avg_healthcare": 2, "avg_discretionary_spending": 2,
        "avg_essential_spending": 2, "avg_financial_health_score": 3, "fraud_rate_percent": 2,
        "weekend_transaction_percent": 2, "high_value_transaction_percent": 2,
    }
    person_averages = {
        "avg_age": "age", "avg_dependents": "dependents", "avg_monthly_income": "income",
        "avg_monthly_expenses": "total_expenses", "avg_expense_ratio_percent": "expense_ratio",
        "avg_disposable_income": "disposable_income", "avg_desired_savings": "desired_savings",
        "avg_savings_achievement_percent": "savings_achievement_rate",
        "avg_potential_savings": "total_potential_savings", "avg_groceries": "groceries",
        "avg_eating_out": "eating_out", "avg_entertainment": "entertainment",
        "avg_transport": "transport", "avg_utilities": "utilities", "avg_healthcare": "healthcare",
        "avg_discretionary_spending": "discretionary_spending",
        "avg_essential_spending": "essential_spending",
        "avg_financial_health_score": "financial_health_score",
    }
    joined = pairs.by_payment(
        ("transaction_year", "transaction_month"),
        [
            F.countDistinct("transaction_id").alias("total_upi_transactions"),
            F.sum("transaction_amount").alias("_sent"),
            mean("transaction_amount").alias("avg_transaction_amount"),
            _type_sum("Essential", "_essential"), _type_sum("Discretionary", "_discretionary"),
            F.sum("fraud_flag").alias("_fraud"), count_if(c("is_weekend") == 1).alias("_weekend"),
            count_if(c("is_high_value")).alias("_high"),
        ],
        [F.countDistinct("person_id").alias("total_persons")]
        + [mean(m).alias(n) for n, m in person_averages.items()],
    )
    return _rounded(joined.select(
        "age_category", c("transaction_year").alias("year"), c("transaction_month").alias("month"),
        "total_persons", *list(person_averages)[:9], "total_upi_transactions",
        over_persons("_sent").alias("total_upi_spending"), "avg_transaction_amount",
        *list(person_averages)[9:17],
        over_persons("_essential").alias("total_essential_upi"),
        over_persons("_discretionary").alias("total_discretionary_upi"),
        "avg_financial_health_score", over_persons("_fraud").alias("fraud_transaction_count"),
        percent(c("_fraud"), c(PAYMENTS)).alias("fraud_rate_percent"),
        percent(c("_weekend"), c(PAYMENTS)).alias("weekend_transaction_percent"),
        percent(c("_high"), c(PAYMENTS)).alias("high_value_transaction_percent"),
    ), digits)


def mart_merchant_performance(pairs: PairRelation) -> DataFrame:
    by = ("merchant_category", "merchant_category_group")
    amount, none = c("transaction_amount"), F.lit(0).cast("decimal(12,2)")
    joined = pairs.by_payment(
        by,
        [
            F.countDistinct("transaction_id").alias("transaction_count"), F.sum(amount).alias("_sent"),
            mean(amount).alias("avg_transaction_value"), F.min(amount).alias("min_transaction"),
            F.max(amount).alias("max_transaction"), F.var_pop(amount.cast("double")).alias("_var"),
            # here a payment outside the slot counts as 0
            mean(F.when(c("is_weekend") == 1, amount).otherwise(none)).alias("avg_weekend_value"),
            mean(F.when(c("is_weekend") == 0, amount).otherwise(none)).alias("avg_weekday_value"),
            count_if(c("time_of_day_category") == "Evening").alias("_evening"),
            count_if(c("transaction_status") == "SUCCESS").alias("_success"),
            mean("fraud_score").alias("avg_fraud_score"),
        ],
        [
            F.countDistinct("person_id").alias("unique_customers"),
            mean("income").alias("avg_customer_income"),
            mean("disposable_income").alias("avg_customer_disposable_income"),
            mean("financial_health_score").alias("avg_customer_financial_health"),
        ],
    )
    return _rounded(joined.select(
        *by, "age_category", "transaction_count", "unique_customers",
        over_persons("_sent").alias("total_revenue"), "avg_transaction_value", "min_transaction",
        "max_transaction", sample_stddev_over_persons("_var").alias("stddev_transaction"),
        "avg_customer_income", "avg_customer_disposable_income", "avg_customer_financial_health",
        "avg_weekend_value", "avg_weekday_value",
        percent(c("_evening"), c(PAYMENTS)).alias("evening_transaction_percent"),
        percent(c("_success"), c(PAYMENTS)).alias("success_rate_percent"), "avg_fraud_score",
    ), {
        "avg_transaction_value": 2, "stddev_transaction": 2, "avg_customer_income": 2,
        "avg_customer_disposable_income": 2, "avg_customer_financial_health": 3,
        "avg_weekend_value": 2, "avg_weekday_value": 2, "evening_transaction_percent": 2,
        "success_rate_percent": 2, "avg_fraud_score": 4,
    })


def mart_savings_opportunity(pairs: PairRelation) -> DataFrame:
    by = ("occupation_category", "city_tier", "income_bracket")
    joined = pairs.by_person(
        by,
        [
            F.sum("transaction_amount").alias("_sent"),
            mean("transaction_amount").alias("avg_upi_transaction"),
            _type_sum("Discretionary", "_discretionary"),
        ],
        [
            F.countDistinct("person_id").alias("person_count"), mean("age").alias("avg_age"),
            mean("income").alias("avg_income"), mean("total_expenses").alias("avg_expenses"),
            mean("disposable_income").alias("avg_disposable_income"),
            mean("savings_achievement_rate").alias("current_savings_achievement_percent"),
            mean("desired_savings").alias("avg_desired_savings"),
            mean(c("disposable_income") - c("desired_savings")).alias("avg_savings_gap"),
            mean("total_potential_savings").alias("total_potential_savings"),
            mean(c("potential_savings_groceries") + c("potential_savings_eating_out")).alias("potential_food_savings"),
            mean("potential_savings_transport").alias("potential_transport_savings"),
            mean("potential_savings_entertainment").alias("potential_entertainment_savings"),
            mean("potential_savings_utilities").alias("potential_utilities_savings"),
            mean("discretionary_spending").alias("avg_discretionary_spending_monthly"),
        ],
    )
    expenses = c("avg_expenses")
    score = (
        F.try_divide(c("total_potential_savings"), expenses) * F.lit(0.4)
        + F.try_divide(c("avg_discretionary_spending_monthly"), expenses) * F.lit(0.3)
        + (F.lit(100.0) - c("current_savings_achievement_percent")) / F.lit(100.0) * F.lit(0.3)
    )
    return _rounded(joined.select(
        "age_category", *by, "person_count", "avg_age", "avg_income", "avg_expenses",
        "avg_disposable_income", "current_savings_achievement_percent", "avg_desired_savings",
        "avg_savings_gap", "total_potential_savings", "potential_food_savings",
        "potential_transport_savings", "potential_entertainment_savings", "potential_utilities_savings",
        percent(c("total_potential_savings"), expenses).alias("potential_savings_percent"),
        "avg_upi_transaction", pair_rows().alias("total_upi_transactions"),
        over_persons("_sent").alias("total_upi_spending"), "avg_discretionary_spending_monthly",
        over_persons("_discretionary").alias("total_discretionary_upi"),
        score.alias("savings_opportunity_score"),
    ), {
        "avg_age": 1, "avg_income": 2, "avg_expenses": 2, "avg_disposable_income": 2,
        "current_savings_achievement_percent": 2, "avg_desired_savings": 2, "avg_savings_gap": 2,
        "total_potential_savings": 2, "potential_food_savings": 2, "potential_transport_savings": 2,
        "potential_entertainment_savings": 2, "potential_utilities_savings": 2,
        "potential_savings_percent": 2, "avg_upi_transaction": 2,
        "avg_discretionary_spending_monthly": 2, "savings_opportunity_score": 3,
    })


def mart_digital_payment_behavior(pairs: PairRelation) -> DataFrame:
    joined = pairs.by_payment(
        ("device_type", "network_type", "sender_state"),
        [
            F.countDistinct("transaction_id").alias("total_transactions"),
            mean("transaction_amount").alias("avg_transaction_amount"),
            count_if(c("transaction_type") == "p2p").alias("p2p_count"),
            count_if(c("transaction_type") == "p2m").alias("p2m_count"),
            count_if(c("transaction_type") == "bill payment").alias("bill_payment_count"),
            mean("hour_of_day").alias("avg_transaction_hour"),
            count_if(c("is_weekend") == 1).alias("_weekend"),
            count_if(c("transaction_status") == "SUCCESS").alias("_success"),
            mean("fraud_score").alias("avg_fraud_score"), F.sum("fraud_flag").alias("fraud_count"),
        ],
        [
            F.countDistinct("person_id").alias("unique_users"), mean("income").alias("avg_user_income"),
            mean("financial_health_score").alias("avg_financial_health"),
        ],
    )
    return _rounded(joined.select(
        "age_category", "device_type", "network_type", c("sender_state").alias("state"), "unique_users",
        "total_transactions", "avg_transaction_amount",
        *[over_persons(n).alias(n) for n in ("p2p_count", "p2m_count", "bill_payment_count")],
        "avg_transaction_hour", percent(c("_weekend"), c(PAYMENTS)).alias("weekend_usage_percent"),
        percent(c("_success"), c(PAYMENTS)).alias("success_rate_percent"), "avg_fraud_score",
        over_persons("fraud_count").alias("fraud_count"), "avg_user_income", "avg_financial_health",
    ), {
        "avg_transaction_amount": 2, "avg_transaction_hour": 1, "weekend_usage_percent": 2,
        "success_rate_percent": 2, "avg_fraud_score": 4, "avg_user_income": 2, "avg_financial_health": 3,
    })


def mart_monthly_trends(pairs: PairRelation) -> DataFrame:
    sums = {
        "total_amount": F.sum("transaction_amount"),
        "food_spending": _group_sum("Food & Groceries", "x"),
        "leisure_spending": _group_sum("Leisure", "x"),
        "transport_spending": _group_sum("Transportation", "x"),
        "utilities_spending": _group_sum("Utilities & Bills", "x"),
    }
    joined = pairs.by_payment(
        ("transaction_year", "transaction_month"),
        [
            F.countDistinct("transaction_id").alias("transactions"),
            mean("transaction_amount").alias("avg_amount"), F.sum("fraud_flag").alias("_fraud"),
            *[s.alias(n) for n, s in sums.items()],
        ],
        [
            mean("income").alias("avg_income"), mean("total_expenses").alias("avg_expenses"),
            mean("disposable_income").alias("avg_disposable_income"),
            mean("savings_achievement_rate").alias("avg_savings_rate"),
            mean("financial_health_score").alias("avg_financial_health"),
        ],
    )
    total, *pivots = [over_persons(n).alias(n) for n in sums]
    return _rounded(joined.select(
        c("transaction_year").alias("year"), c("transaction_month").alias("month"), "age_category",
        "transactions", total, "avg_amount", "avg_income", "avg_expenses", "avg_disposable_income",
        "avg_savings_rate", *pivots, "avg_financial_health",
        percent(c("_fraud"), c(PAYMENTS)).alias("fraud_rate_percent"),
    ), {
        "avg_amount": 2, "avg_income": 2, "avg_expenses": 2, "avg_disposable_income": 2,
        "avg_savings_rate": 2, "avg_financial_health": 3, "fraud_rate_percent": 2,
    })


def behavior_persons() -> list[Column]:
    """The persons' part of the spending-behaviour fact; savings are the disposable income less the desired savings."""
    return [
        mean("income").alias("avg_income"), mean(c("disposable_income") - c("desired_savings")).alias("avg_savings"),
        mean("disposable_income").alias("avg_disposable_income"),
    ]


def behavior_columns(joined: DataFrame) -> DataFrame:
    """The fact's columns from payment groups beside their persons."""
    return _rounded(joined.select(
        "age_category", "merchant_category", c("transaction_year").alias("year"),
        c("transaction_month").alias("month"), pair_rows().alias("total_transactions"),
        over_persons("total_amount").alias("total_amount"), "avg_transaction_amount",
        "min_transaction_amount", "max_transaction_amount", "avg_income", "avg_savings",
        "avg_disposable_income", over_persons("_fraud").alias("fraud_transaction_count"),
        percent(c("_fraud"), c(PAYMENTS)).alias("fraud_percentage"),
        percent(c("_weekend"), c(PAYMENTS)).alias("weekend_transaction_percentage"),
    ), {
        "avg_transaction_amount": 2, "avg_income": 2, "avg_savings": 2, "avg_disposable_income": 2,
        "fraud_percentage": 2, "weekend_transaction_percentage": 2,
    })


def fact_spending_behavior_agg(pairs: PairRelation) -> DataFrame:
    """Category, merchant and month."""
    return behavior_columns(pairs.by_payment(
        ("merchant_category", "transaction_year", "transaction_month"),
        [
            F.sum("transaction_amount").alias("total_amount"),
            mean("transaction_amount").alias("avg_transaction_amount"),
            F.min("transaction_amount").alias("min_transaction_amount"),
            F.max("transaction_amount").alias("max_transaction_amount"),
            count_if(c("fraud_flag") == 1).alias("_fraud"), count_if(c("is_weekend") == 1).alias("_weekend"),
        ],
        behavior_persons(),
    ))


SUMMARIES = {
    f.__name__: f for f in (
        age_category_spending_summary, merchant_category_analysis, occupation_spending_analysis,
        time_based_spending_patterns,
    )
}
MARTS = {
    f.__name__: f for f in (
        mart_age_spending_behavior, mart_merchant_performance, mart_savings_opportunity,
        mart_digital_payment_behavior, mart_monthly_trends,
    )
}


def mart_counts(marts: dict[str, DataFrame]) -> DataFrame:
    """One (mart_name, record_count) row per mart."""
    rows = None
    for name, frame in marts.items():
        one = frame.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("mart_name"), "record_count"
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows
