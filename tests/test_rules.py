"""Band edges, encodings and scores on literal rows."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import bands, rules, scores
from ledgerlens.functions.exact import half_up, mean
from ledgerlens.operators import cleaning, finance, payments


def apply(spark, kind, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_age_bands(spark):
    ages = [0, 17, 18, 25, 26, 35, 36, 45, 46, 55, 56, None]
    t, y, e, l, s, u = "Teenagers", "Young Adult", "Early Middle Age", "Late Middle Age", "Seniors", "Unknown"
    assert apply(spark, "int", ages, bands.age_category) == [u, u, t, t, y, y, e, e, l, l, s, u]
    assert apply(spark, "int", [17, 18, 56], bands.age_range) == ["Unknown", "18-25", "56+"]


def test_age_groups_differ_by_profile(spark):
    groups = ["56+", "over 56", "26 - 35", None]
    assert apply(spark, "string", groups, lambda c: bands.category_of_group(c, "elt")) == ["Seniors", "Seniors", "Unknown", "Unknown"]
    assert apply(spark, "string", groups, lambda c: bands.category_of_group(c, "etl")) == ["Seniors", "Unknown", "Unknown", "Unknown"]


def test_amount_bins_keep_their_gaps(spark):
    amounts = [D(x) for x in ("99.99", "100", "500", "500.50", "501", "2000", "2000.50", "2001", "10000", "10000.01")]
    got = apply(spark, "decimal(12,2)", amounts, lambda c: bands.amount_category(c, "elt"))
    assert got == ["Micro", "Small", "Small", "Very Large", "Medium", "Medium", "Very Large", "Large", "Large", "Very Large"]
    got = apply(spark, "double", [499.99, 500.0, 999.99, 1000.0, 2500.0, 5000.0, None], lambda c: bands.amount_category(c, "etl"))
    assert got == ["Very Low", "Low", "Low", "Medium", "High", "Very High", "Unknown"]


def test_income_brackets(spark):
    incomes = [D(x) for x in ("-1", "19999.99", "20000", "50000", "50000.50", "50001", "100000", "100000.01")]
    assert apply(spark, "decimal(12,2)", incomes, bands.income_bracket) == [
        "Low Income", "Low Income", "Middle Income", "Middle Income", "High Income", "Upper Middle Income",
        "Upper Middle Income", "High Income"]


def test_hours(spark):
    hours = [0, 5, 6, 11, 12, 17, 18, 21, 22, 23, None]
    assert apply(spark, "int", hours, lambda c: bands.time_of_day(c, "elt")) == [
        "Late Night", "Late Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Night", "Night", "Night"]
    assert apply(spark, "int", hours, lambda c: bands.time_of_day(c, "etl")) == [
        "Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening", "Evening", "Evening", "Unknown"]


def test_codes(spark):
    jobs = ["retired", "clown", None]
    assert apply(spark, "string", jobs, lambda c: bands.label_code(c, rules.OCCUPATION_CODES["etl"])) == [2, None, None]
    assert apply(spark, "string", jobs, lambda c: bands.case_code(c, rules.OCCUPATION_CODES["elt"])) == [3, 0, 0]


def test_unreadable_values_become_null_or_zero(spark):
    df = spark.createDataFrame([("abc",), ("-5",), ("7.255",), (None,), ("",)], "x string")
    assert [r.x for r in df.select(cleaning.clamp_non_negative("x").alias("x")).collect()] == [D("0.00"), D("0.00"), D("7.26"), D("0.00"), D("0.00")]
    assert [r.x for r in cleaning.cast_numeric_safe(df, {"x": "double"}).collect()] == [None, -5.0, 7.255, None, None]
    times = spark.createDataFrame([("2024-10-08 15:17:28",), ("2024-13-01 00:00:00",), ("",), (None,)], "t string")
    got = [r.t for r in times.select(cleaning.parse_timestamp(F.col("t")).alias("t")).collect()]
    assert got[0] is not None and got[1:] == [None, None, None]


def test_half_up_breaks_ties_upwards(spark):
    assert apply(spark, "double", [0.005, 1.545, 2.675, -1.005], lambda c: half_up(c, 2).cast("double")) == [0.01, 1.55, 2.68, -1.01]
    df = spark.createDataFrame([(D("0.01"),), (D("0.02"),), (None,)], "x decimal(12,2)")
    assert df.agg(mean("x").alias("m")).first().m == 0.015


def test_scores_guard_their_denominators(spark):
    row = dict(income=D("0"), disposable_income=D("5"), total_potential_savings=D("1"), total_expenses=D("0"), dependents=0, loan_repayment=D("0"))
    types = "income decimal(12,2), disposable_income decimal(12,2), total_potential_savings decimal(12,2), total_expenses decimal(12,2), dependents int, loan_repayment decimal(12,2)"
    rows = [tuple(row.values()), tuple((row | {"income": D("10")}).values()), tuple((row | {"income": D("10"), "total_expenses": D("4")}).values())]
    got = [r.s for r in spark.createDataFrame(rows, types).select(scores.financial_health_elt().alias("s")).collect()]
    assert got[:2] == [0.0, None] and got[2] == pytest.approx(0.2 + 0.075 + 0.15 + 0.15)


def test_names_are_normalised(spark):
    df = spark.createDataFrame([(1, 2)], "`Transaction ID ` int, `amount (INR)` int")
    assert cleaning.normalize_column_names(df, drop="()").columns == ["transaction_id", "amount_inr"]


def test_rejected_is_the_complement(spark):
    raw = spark.createDataFrame(
        [("a", "2024-01-01 10:00:00", "5"), ("b", None, "5"), ("c", "bad", "7"), (None, "2024-01-01 10:00:00", "5"),
         ("d", "2024-01-01 10:00:00", "-1"), ("e", "2024-01-01 10:00:00", None), ("a", "2024-01-01 10:00:00", "5")],
        "transaction_id string, timestamp string, `amount (INR)` string")
    for name in rules.PAYMENT_COLUMNS:
        if name not in ("transaction_id", "timestamp", "amount_inr"):
            raw = raw.withColumn(name, F.lit("1"))
    ok, bad = payments.clean_etl(raw)
    good = {r.transaction_id: r for r in ok.collect()}
    assert set(good) == {"a", "e"}  # the gap of e is filled with the median 5
    assert good["e"].amount == 5.0 and good["a"].amount_normalized is None  # one amount only: no range
    assert sorted(str(r.transaction_id) for r in bad.collect()) == ["None", "b", "c", "d"]


def test_whole_row_and_key_duplicates_differ(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (None, "z"), (None, "z")], "id int, v string")
    assert df.distinct().count() == 3
    assert sorted(map(str, cleaning.dedup_by_key(df, "id").collect())) == sorted(["Row(id=1, v='x')", "Row(id=None, v='z')"])
    assert cleaning.duplicates_removed(df, "id").first().asDict() == {"input_rows": 5, "kept_rows": 2, "removed_rows": 3}


def test_elt_keeps_zero_income_and_drops_zero_age(spark):
    df = spark.createDataFrame([(1, 30, D("0")), (2, 0, D("5")), (3, 30, D("-1"))], "person_id int, age int, income decimal(12,2)")
    assert [r.person_id for r in finance.valid_people(df).collect()] == [1]
