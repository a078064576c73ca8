"""Quantiles, ids, affordability and pair aggregates against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.keys import row_numbers
from ledgerlens.functions.quantiles import exact_median, exact_quantiles, imputation_statistics
from ledgerlens.operators.affordability import affordable_persons
from ledgerlens.operators.pairs import PairRelation
from ledgerlens.operators import quality


def element(values, p):
    return sorted(values)[max(math.ceil(p * len(values)), 1) - 1]


def test_quantiles_with_hot_values_and_weights(spark):
    rnd = random.Random(1)
    rows = [(g, rnd.choice([7.5, 7.5, rnd.uniform(-500, 5000)]), rnd.randint(1, 4)) for g in "aab" for _ in range(150)]
    rows.append(("c", None, 1))
    df = spark.createDataFrame(rows, "g string, x double, w int")
    got = {(r.g, r.prob): r.quantile for r in exact_quantiles(df, "x", (0.25, 0.5, 0.9), ("g",), "w").collect()}
    for g in "ab":
        values = [x for k, x, w in rows if k == g for _ in range(w)]
        for p in (0.25, 0.5, 0.9):
            assert got[g, p] == element(values, p)
    assert len(got) == 6
    medians = {r.g: r.m for r in exact_median(df, "x", ("g",), "m").collect()}
    for g in "ab":
        values = sorted(x for k, x, _ in rows if k == g)
        n = len(values)
        assert medians[g] == pytest.approx((values[(n - 1) // 2] + values[n // 2]) / 2)


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_quartiles_of_filled_column_come_from_the_unfilled_one(spark, method):
    rnd = random.Random(2)
    columns = {"p": [rnd.choice([None, None, rnd.uniform(0, 900)]) for _ in range(101)],
               "q": [rnd.choice([None, 5.0, rnd.uniform(0, 10)]) for _ in range(101)]}
    df = spark.createDataFrame(list(zip(*columns.values())), "p double, q double")
    got = imputation_statistics(df, ["p", "q"], ["p", "q"], ["p"], method).first()
    for c, values in columns.items():
        present = [v for v in values if v is not None]
        m = element(present, 0.5)
        filled = [m if v is None else v for v in values]
        assert got[f"median_{c}"] == m
        assert (got[f"q1_{c}"], got[f"q3_{c}"]) == (element(filled, 0.25), element(filled, 0.75))
    assert (got.low_p, got.high_p) == (min(v for v in columns["p"] if v is not None), max(v for v in columns["p"] if v is not None))


def test_row_numbers_are_dense_and_repeatable(spark):
    df = spark.range(500).select(F.concat(F.lit("k"), F.col("id") % 250).alias("k"), F.col("id").alias("v"))
    once = {(r.k, r.v): r.n for r in row_numbers(df, "n", ("k", "v")).collect()}
    again = {(r.k, r.v): r.n for r in row_numbers(df.repartition(7), "n", ("k", "v")).collect()}
    assert sorted(once.values()) == list(range(1, 501)) and once == again
    assert [k for k, _ in sorted(once.items(), key=lambda x: x[1])] == sorted(once)


def test_affordable_counts_match_brute_force(spark):
    rnd = random.Random(3)
    people = [(c, rnd.choice([None, 1000.0, 1000.0, rnd.uniform(-100, 9000)])) for c in "ab" for _ in range(60)]
    sends = [(c, rnd.choice([100.0, rnd.uniform(1, 900)])) for c in "abc" for _ in range(40)]
    pairs = PairRelation(spark.createDataFrame(sends, "age_category string, amount double"),
                         spark.createDataFrame(people, "age_category string, disposable_income double"))
    got = {(r.age_category, r.amount): r.affordable_persons for r in affordable_persons(pairs).collect()}
    for c, a in sends:
        assert got[c, a] == sum(1 for k, d in people if k == c and d is not None and a <= d * 0.1)


def test_weighted_checks_equal_checks_over_repeated_rows(spark):
    rows = [(1.0, "x", 3), (None, "x", 2), (40.0, None, 1), (7.0, "y", 5)]
    df = spark.createDataFrame(rows, "a double, s string, w int")
    wide = spark.createDataFrame([r[:2] for r in rows for _ in range(r[2])], "a double, s string")
    for check in (lambda d, w: quality.check_nulls(d, ["a", "s"], w), lambda d, w: quality.check_range(d, {"a": (2, 30)}, w),
                  lambda d, w: quality.check_uniqueness(d, ["a", "s"], w), lambda d, w: quality.check_distribution(d, ["a"], w)):
        weighted, plain = check(df, "w").orderBy("column").collect(), check(wide, None).orderBy("column").collect()
        for x, y in zip(weighted, plain, strict=True):
            for k, v in x.asDict().items():
                assert v == pytest.approx(y[k]) if isinstance(v, float) else v == y[k]


def test_quality_report_and_types(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None)], "age int, amount double")
    types = quality.check_datatypes(spark, df, {"age": "int", "amount": "string", "absent": "int"})
    assert {r.column: r.passed for r in types.collect()} == {"age": True, "amount": False}
    rows = quality.check_rows({"uniqueness": [quality.check_uniqueness(df, ["age"])], "datatype_check": [types]})
    assert quality.quality_report(rows).first().asDict() == {
        "total_checks": 3, "passed_checks": 1, "failed_checks": 2, "quality_score": 33.33}
