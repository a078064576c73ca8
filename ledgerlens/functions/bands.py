"""Banding and labelling expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules


def _case(arms, otherwise):
    """CASE over (condition, value) pairs."""
    (first, value), *rest = arms
    out = F.when(first, value)
    for condition, value in rest:
        out = out.when(condition, value)
    return out.otherwise(otherwise)


def _lookup(c: Column, codes: dict, otherwise) -> Column:
    return _case([(c == k, F.lit(v)) for k, v in codes.items()], F.lit(otherwise))


def _in_group(c: Column, groups: dict, otherwise: str) -> Column:
    return _case([(c.isin(*m), F.lit(g)) for g, m in groups.items()], F.lit(otherwise))


def _age_label(age: Column, position: int) -> Column:
    arms = [
        (age >= low if high is None else age.between(low, high), F.lit((rng, cat)[position]))
        for low, high, rng, cat in rules.AGE_BANDS
    ]
    return _case(arms, F.lit(rules.UNKNOWN))


def age_range(age: Column) -> Column:
    return _age_label(age, 0)


def age_category(age: Column) -> Column:
    return _age_label(age, 1)


def category_of_group(group: Column, profile: str) -> Column:
    """Age-group text to category. Only the elt profile reads any '56' as the top band."""
    arms = [(group == rng, F.lit(cat)) for _, _, rng, cat in rules.AGE_BANDS]
    if profile == "elt":
        arms[-1] = (group.like("%56%"), arms[-1][1])
    return _case(arms, F.lit(rules.UNKNOWN))


def range_of_category(category: Column) -> Column:
    return _lookup(category, {c: r for _, _, r, c in rules.AGE_BANDS}, rules.UNKNOWN)


def occupation_category(occupation: Column) -> Column:
    return _in_group(occupation, rules.OCCUPATION_GROUPS, "Other")


def merchant_group(merchant: Column) -> Column:
    return _in_group(merchant, rules.MERCHANT_GROUPS, "Other")


def spending_type(merchant: Column) -> Column:
    return F.when(merchant.isin(*rules.ESSENTIAL_MERCHANTS), "Essential").otherwise("Discretionary")


def transaction_type_category(kind: Column) -> Column:
    return _lookup(kind, rules.TRANSACTION_TYPES, "Other")


def case_code(c: Column, codes: dict, otherwise: int = 0) -> Column:
    """Label to code, anything else to ``otherwise``."""
    return _lookup(c, codes, otherwise)


def label_code(c: Column, codes: dict) -> Column:
    """Label to code through a literal map; an unlisted label gives NULL."""
    pairs = [F.lit(v) for item in codes.items() for v in item]
    return F.element_at(F.create_map(*pairs), c)


def income_bracket(income: Column) -> Column:
    """Whole-unit brackets. 50000.01 to 50000.99 is in no bracket and falls to the last."""
    return _case(
        [
            (income < 20000, F.lit("Low Income")),
            (income.between(20000, 50000), F.lit("Middle Income")),
            (income.between(50001, 100000), F.lit("Upper Middle Income")),
        ],
        F.lit("High Income"),
    )


def amount_category(amount: Column, profile: str) -> Column:
    if profile == "etl":
        edges = [(500, "Very Low"), (1000, "Low"), (2500, "Medium"), (5000, "High")]
        arms = [(amount < edge, F.lit(label)) for edge, label in edges]
        arms.append((amount >= 5000, F.lit("Very High")))
        return _case(arms, F.lit(rules.UNKNOWN))
    # whole-unit bins: amounts inside (500,501) and (2000,2001) fall to the last label
    return _case(
        [
            (amount < 100, F.lit("Micro")),
            (amount.between(100, 500), F.lit("Small")),
            (amount.between(501, 2000), F.lit("Medium")),
            (amount.between(2001, 10000), F.lit("Large")),
        ],
        F.lit("Very Large"),
    )


def time_of_day(hour: Column, profile: str) -> Column:
    etl = profile == "etl"
    return _case(
        [
            (hour.between(0, 5), F.lit("Night" if etl else "Late Night")),
            (hour.between(6, 11), F.lit("Morning")),
            (hour.between(12, 17), F.lit("Afternoon")),
            (hour.between(18, 23 if etl else 21), F.lit("Evening")),
        ],
        F.lit(rules.UNKNOWN if etl else "Night"),
    )
