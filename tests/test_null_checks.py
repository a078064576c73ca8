"""The null checks of the joined table against its pairs, made one by one."""

from pyspark.sql import functions as F

import __spark_entry__ as contract
from ledgerlens.functions import rules
from ledgerlens.operators.pairs import PairRelation
from ledgerlens.plans import quality_run


def test_every_column_of_the_joined_table_is_checked(spark):
    names = [r.column for r in contract.queries()["dq_nulls"](spark, "/root/testdata/sf0.001").collect()]
    assert len(names) == len(set(names)) == 49


def test_nulls_of_pair_features_equal_all_pairs(spark):
    merchants = [*rules.MERCHANT_SAVINGS, "fuel", None]
    payments = spark.createDataFrame(
        [(k, m, a) for k in "ab" for m in merchants for a in (None, 0.0, 5.0)], "age_category string, merchant_category string, amount double")
    potentials = list(rules.MERCHANT_SAVINGS.values())
    people = [(k, i, d, n, p) for k in "abc" for i in (None, 0.0, 9.0) for d in (None, 0.5) for n in (None, 0.5) for p in (None, 0.0, 3.0)]
    persons = spark.createDataFrame(people, "age_category string, income double, disposable_income_normalized double, income_normalized double, p double")
    persons = persons.select("*", *[F.col("p").alias(n) for n in potentials])
    high = F.lit(0.0)
    for merchant, p in rules.MERCHANT_SAVINGS.items():
        high = F.when(F.col("merchant_category") == merchant, F.col(p)).otherwise(high)
    made = payments.join(persons, "age_category").withColumns({
        "spending_income_ratio": F.when(F.col("income") > 0, F.col("amount") / F.col("income")).otherwise(0.0), "high_savings_category": high,
    }).withColumns({
        "financial_health_score": F.expr("disposable_income_normalized * 40 + (1 - spending_income_ratio) * 30 + income_normalized * 30"),
        "savings_opportunity_score": F.expr("CASE WHEN high_savings_category > 0 THEN try_divide(high_savings_category, amount) * 100 ELSE 0 END"),
    })
    names = ["spending_income_ratio", "high_savings_category", "financial_health_score", "savings_opportunity_score"]
    want = made.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names]).first().asDict() | {"is_affordable_transaction": 0}
    got = quality_run.pair_null_checks(PairRelation(payments, persons)).collect()
    assert {r.column: int(r.null_count) for r in got} == want and all(want[n] for n in names)
    assert all(r.passed == (r.null_count == 0) for r in got)
