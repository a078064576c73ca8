"""etl star schema: five dimensions, the fact in two factors, four views, three reports.

A fact row is one (payment, person) pair. It is stored as the payment half
(partitioned by month) and the person half; both carry the dimension keys they
determine, and the views multiply their aggregates. A pair's location key follows
from the payment's state and the person's city tier, see ``location_cells``.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bands
from ..functions import rules
from ..functions.keys import stable_id
from ..operators.pairs import PAYMENTS, PERSONS, PairRelation, pair_rows
from . import etl

c = F.col


def dim_age_category(pairs: PairRelation) -> DataFrame:
    labels = pairs.matched_payments().select("age_category").distinct()
    # the place in the fixed list of labels, so a load that lacks one shifts no other
    known = F.array(*[F.lit(x) for x in sorted({category for *_, category in rules.AGE_BANDS} | {"Unknown"})])
    return labels.select(
        F.array_position(known, c("age_category")).cast("int").alias("age_category_id"),
        "age_category", bands.range_of_category(c("age_category")).alias("age_range"),
    ).withColumn("description", F.concat(F.lit("Age group: "), "age_range"))


def dim_occupation(pairs: PairRelation) -> DataFrame:
    names = pairs.matched_persons().select("occupation", "occupation_encoded").distinct()
    return names.select(
        c("occupation_encoded").alias("occupation_id"), c("occupation").alias("occupation_name"),
        F.lit("Primary").alias("occupation_type"),
    )


def dim_merchant_category(pairs: PairRelation) -> DataFrame:
    names = pairs.matched_payments().select(c("merchant_category").alias("category_name")).distinct()
    return names.select(
        stable_id(("category_name",)).alias("merchant_category_id"), "category_name",
        F.lit("UPI").alias("category_type"),
    )


def dim_location(pairs: PairRelation) -> DataFrame:
    """Every (state, city tier) that meets in some category: distinct values first, then their join."""
    states = pairs.payments.select("age_category", "sender_state").distinct()
    tiers = pairs.persons.select("age_category", "city_tier").distinct()
    places = states.join(tiers, "age_category").select(c("sender_state").alias("state"), "city_tier").distinct()
    return places.select(
        stable_id(("state", "city_tier")).alias("location_id"), "state", "city_tier", F.lit("India").alias("region")
    )


def dim_date(pairs: PairRelation) -> DataFrame:
    """One row per calendar date (not per timestamp, which would multiply fact rows)."""
    day = c("full_date")
    return pairs.matched_payments().select(F.to_date("transaction_timestamp").alias("full_date")).distinct().select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_id"), "full_date",
        F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"), F.date_format(day, "EEEE").alias("day_of_week"),
        F.date_format(day, "E").isin("Sat", "Sun").alias("is_weekend"), F.date_format(day, "MMMM").alias("month_name"),
    )


DIMENSIONS = {
    f.__name__: f for f in (dim_age_category, dim_occupation, dim_merchant_category, dim_location, dim_date)
}

PAYMENT_FACT_COLUMNS = (
    "transaction_id", "date_id", "age_category_id", "merchant_category_id", "sender_state",
    "transaction_amount", "transaction_status", "fraud_flag", "transaction_year", "transaction_month",
)
PERSON_FACT_COLUMNS = (
    "finance_id", "age_category_id", "occupation_id", "city_tier", "income", "disposable_income",
    "desired_savings", "groceries", "transport", "eating_out", "entertainment", "utilities", "healthcare",
    "education", "miscellaneous", "potential_savings_groceries", "potential_savings_transport",
    "potential_savings_eating_out", "potential_savings_entertainment", "per_income", "health_base",
    "four_potentials",
)


class Warehouse:
    """Dimensions and both fact halves by name, each made or opened on first use."""

    def __init__(self, open_table: Callable[[str], DataFrame]):
        self._open, self._tables = open_table, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._tables:
            self._tables[name] = self._open(name)
        return self._tables[name]

    @property
    def fact(self) -> PairRelation:
        """The fact as a pair relation on the age key."""
        payments = self.fact_payments.withColumnRenamed("transaction_amount", "amount")
        return PairRelation(payments, self.fact_persons, key="age_category_id")


def payment_half(pairs: PairRelation, age: DataFrame, merchant: DataFrame) -> DataFrame:
    """Payment half of the fact with its surrogate keys, rows without partners left out.

    ``age`` has six rows at most. ``merchant`` is joined without a hint: Spark
    broadcasts it by its measured size, or splits a hot merchant when it is large.
    """
    rows = pairs.matched_payments().withColumn(
        "date_id", F.date_format(F.to_date("transaction_timestamp"), "yyyyMMdd").cast("int")
    ).withColumns({
        "transaction_year": F.year("transaction_timestamp"), "transaction_month": F.month("transaction_timestamp"),
        "transaction_amount": c("amount"),
    })
    rows = rows.join(F.broadcast(age.select("age_category_id", "age_category")), "age_category", "left")
    names = merchant.select("merchant_category_id", c("category_name").alias("merchant_category"))
    return rows.join(names, "merchant_category", "left").select(*PAYMENT_FACT_COLUMNS)


def person_half(pairs: PairRelation, age: DataFrame) -> DataFrame:
    rows = pairs.matched_persons().withColumnRenamed("occupation_encoded", "occupation_id")
    rows = rows.join(F.broadcast(age.select("age_category_id", "age_category")), "age_category", "left")
    return rows.select(*PERSON_FACT_COLUMNS)


FACT_HALVES = ("fact_payments", "fact_persons")
TABLES = (*DIMENSIONS, *FACT_HALVES)
#: Keys by which a load merges the tables it does not refresh by partition.
TABLE_KEYS = {
    "dim_age_category": "age_category_id", "dim_occupation": "occupation_id", "dim_merchant_category": "merchant_category_id",
    "dim_location": "location_id", "dim_date": "date_id", "fact_persons": "finance_id",
}


def build(pairs: PairRelation, keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> Warehouse:
    """The warehouse over cleaned inputs. ``keep`` may write a dimension and read it back,
    after which its size is known to the planner; facts stay lazy."""
    def make(name: str) -> DataFrame:
        if name == "fact_payments":
            return payment_half(pairs, built.dim_age_category, built.dim_merchant_category)
        if name == "fact_persons":
            return person_half(pairs, built.dim_age_category)
        return keep(DIMENSIONS[name](pairs), name)

    built = Warehouse(make)
    return built


def _merchant_cells(w: Warehouse, cells: DataFrame) -> DataFrame:
    """Cells with the names of their age and merchant keys (inner, as the views join)."""
    return cells.join(F.broadcast(w.dim_age_category), "age_category_id").join(
        w.dim_merchant_category, "merchant_category_id"
    )


def v_spending_by_age(w: Warehouse) -> DataFrame:
    cells = _merchant_cells(w, etl.merchant_cells(w.fact, ("merchant_category_id",)))
    m = etl.cell_measures(c("category_name"))
    return cells.select(
        "age_category", "age_range", c("category_name").alias("merchant_category"),
        m["transaction_count"].alias("transaction_count"), m["total_amount"].alias("total_spending"),
        m["avg_amount"].alias("avg_transaction_amount"), m["avg_financial_health"].alias("avg_financial_health"),
        m["avg_savings_opportunity"].alias("avg_savings_opportunity"), m["fraud_count"].alias("fraud_transactions"),
    )


def _date_cells(w: Warehouse, by: tuple[str, ...], year: int | None = None) -> DataFrame:
    """Per date attributes: pair rows, amount over pairs and potential over pairs.

    A ``year`` is looked for in the partitions of the payment half before anything is grouped.
    """
    fact = w.fact
    if year is not None:
        fact = PairRelation(fact.payments.where(c("transaction_year") == year), fact.persons, key=fact.key)
    cells = fact.by_payment(
        ("date_id",), [F.sum("amount").alias("_sum")], [F.sum("four_potentials").alias("_four")]
    ).join(w.dim_date, "date_id")
    return cells.groupBy(*by).agg(
        F.sum(pair_rows()).cast("decimal(38,0)").alias("transaction_count"),
        F.sum(c("_sum") * c(PERSONS).cast("double")).alias("total_spending"),
        F.sum(c("_four") * c(PAYMENTS).cast("double")).alias("total_potential_savings"),
    )


def v_monthly_spending_trends(w: Warehouse, year: int | None = None) -> DataFrame:
    return _date_cells(w, ("year", "month", "month_name"), year).select(
        "year", "month", "month_name", "transaction_count", "total_spending",
        (c("total_spending") / c("transaction_count").cast("double")).alias("avg_transaction_amount"),
        "total_potential_savings",
    ).orderBy("year", "month")


def v_financial_health_analysis(w: Warehouse) -> DataFrame:
    """Persons by occupation and tier; a payment id belongs to one category, so its distinct count adds up."""
    cells = w.fact.by_person(
        ("occupation_id", "city_tier"),
        [F.countDistinct("transaction_id").alias("_ids"), F.sum("amount").alias("_sum")],
        [
            F.sum("income").alias("_income"), F.sum("disposable_income").alias("_disposable"),
            F.sum("health_base").alias("_base"), F.sum("per_income").alias("_per"),
        ],
    ).join(w.dim_occupation, "occupation_id")
    n, rows = c(PAYMENTS).cast("double"), F.sum(pair_rows()).cast("double")
    return cells.groupBy("occupation_name", "city_tier").agg(
        F.sum("_ids").alias("transaction_count"),
        (F.sum(c("_income") * n) / rows).alias("avg_income"),
        (F.sum(c("_disposable") * n) / rows).alias("avg_disposable_income"),
        (F.sum(c("_base") * n + (pair_rows().cast("double") - c("_sum") * c("_per")) * 30) / rows)
        .alias("avg_financial_health_score"),
        (F.sum(c("_sum") * c("_per")) / rows).alias("avg_spending_income_ratio"),
    )


def v_top_savings_opportunities(w: Warehouse, minimum: float = 1000) -> DataFrame:
    cells = _merchant_cells(w, etl.opportunity_cells(w.fact, ("merchant_category_id",)))
    m = etl.opportunity_measures(c("category_name"))
    # tie-break keys make the order, and a LIMIT on it, the same on every run
    return cells.select("age_category", "category_name", *[e.alias(n) for n, e in m.items()]).where(
        (c("transaction_count") > 0) & (c("total_potential_savings") > minimum)
    ).orderBy(F.desc("total_potential_savings"), "age_category", "category_name")


VIEWS = {
    f.__name__: f for f in (
        v_spending_by_age, v_monthly_spending_trends, v_financial_health_analysis, v_top_savings_opportunities,
    )
}


def avg_spending_by_age(w: Warehouse) -> DataFrame:
    cells = w.fact.by_payment((), [F.avg("amount").alias("avg_spending")])
    return cells.join(F.broadcast(w.dim_age_category), "age_category_id").select(
        "age_category", "avg_spending", pair_rows().alias("transaction_count")
    )


def top_savings_topk(w: Warehouse, above: float = 10, k: int = 10) -> DataFrame:
    ranked = v_top_savings_opportunities(w).where(c("avg_savings_opportunity") > above)
    return ranked.orderBy(F.desc("total_potential_savings"), "age_category", "category_name").limit(k)


def monthly_trends_year(w: Warehouse, year: int) -> DataFrame:
    return v_monthly_spending_trends(w, year).where(c("year") == year).orderBy("month")


def fact_spending_pattern(w: Warehouse) -> DataFrame:
    """The fact summed per month and every other dimension key it can be grouped by."""
    by_payment = ("transaction_year", "transaction_month", "merchant_category_id")
    payments = w.fact.payment_side(
        by_payment, F.sum("amount").alias("_sum"), F.sum(F.lit(1.0) / c("amount")).alias("_per_amount"),
        F.sum("fraud_flag").alias("_fraud"),
    ).join(w.dim_merchant_category.select("merchant_category_id", "category_name"), "merchant_category_id", "left")
    totals = PERSON_FACT_COLUMNS[4:19]
    gains = [
        F.sum(F.when(c(p) > 0, c(p)).otherwise(F.lit(0.0))).alias(f"gain_{p}")
        for p in etl.rules.MERCHANT_SAVINGS.values()
    ]
    persons = w.fact.person_side(
        ("occupation_id", "city_tier"), *[F.sum(t).alias(f"_{t}") for t in totals],
        F.sum("per_income").alias("_per_income"), F.sum("health_base").alias("_base"), *gains,
    )
    n, m = c(PAYMENTS).cast("double"), c(PERSONS).cast("double")
    ratio = c("_sum") * c("_per_income")
    return payments.join(persons, "age_category_id").select(
        "transaction_year", "transaction_month", "age_category_id", "occupation_id", "merchant_category_id",
        "city_tier", pair_rows().alias("fact_rows"), (c("_sum") * m).alias("transaction_amount"),
        (c("_fraud") * c(PERSONS).cast("decimal(15,0)")).alias("fraud_flag"),
        *[(c(f"_{t}") * n).alias(t) for t in totals],
        ratio.alias("spending_income_ratio"),
        (c("_base") * n + (n * m - ratio) * 30).alias("financial_health_score"),
        (etl.by_merchant("gain", c("category_name")) * c("_per_amount") * 100).alias("savings_opportunity_score"),
    )


def location_cells(w: Warehouse) -> DataFrame:
    """Fact rows and amount per (age, merchant, location) key: the three key look-ups of the load."""
    payments = w.fact.payment_side(("merchant_category_id", "sender_state"), F.sum("amount").alias("_sum"))
    persons = w.fact.person_side(("city_tier",))
    cells = payments.join(persons, "age_category_id")
    place = w.dim_location.select("location_id", c("state").alias("sender_state"), "city_tier")
    return cells.join(place, ["sender_state", "city_tier"], "left").select(
        "age_category_id", "merchant_category_id", "location_id", pair_rows().alias("fact_rows"),
        (c("_sum") * c(PERSONS).cast("double")).alias("transaction_amount"),
    )


def fact_by_age_merchant(w: Warehouse) -> DataFrame:
    cells = w.fact.by_payment(("merchant_category_id",), [F.sum("amount").alias("_sum")])
    return _merchant_cells(w, cells).select(
        "age_category", "category_name", pair_rows().alias("fact_rows"),
        (c("_sum") * c(PERSONS).cast("double")).alias("transaction_amount"),
    )


def fact_by_date(w: Warehouse) -> DataFrame:
    return _date_cells(w, ("full_date", "day_of_week", "is_weekend"))


def fact_by_occupation_location(w: Warehouse) -> DataFrame:
    payments = w.fact.payment_side(("sender_state",), F.sum("amount").alias("_sum"))
    persons = w.fact.person_side(("occupation_id", "city_tier"))
    place = w.dim_location.select("location_id", c("state").alias("sender_state"), "city_tier", "region")
    cells = payments.join(persons, "age_category_id").join(place, ["sender_state", "city_tier"]).join(
        w.dim_occupation, "occupation_id"
    )
    return cells.groupBy("occupation_name", c("sender_state").alias("state"), "city_tier", "region").agg(
        F.sum(pair_rows()).cast("decimal(38,0)").alias("fact_rows"),
        F.sum(c("_sum") * c(PERSONS).cast("double")).alias("transaction_amount"),
    )
