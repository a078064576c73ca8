"""Ratios and composite scores, one expression each."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules


def fixed_minmax(name: str) -> Column:
    """(x - low) / (high - low) with published bounds; 0 unless x > 0."""
    low, high = rules.FIXED_BOUNDS[name]
    x = F.col(name).cast("double")
    return F.when(x > 0, (x - F.lit(float(low))) / F.lit(float(high - low))).otherwise(F.lit(0.0))


def guarded_percent(part: str, whole: str) -> Column:
    """100 * part / whole, 0 unless whole > 0."""
    p, w = F.col(part).cast("double"), F.col(whole).cast("double")
    return F.when(w > 0, p / w * F.lit(100.0)).otherwise(F.lit(0.0))


def financial_health_elt() -> Column:
    """Per person. NULL where income > 0 and there are no expenses to divide by."""
    income = F.col("income").cast("double")
    score = (
        F.col("disposable_income").cast("double") / income * F.lit(0.4)
        + F.try_divide(
            F.col("total_potential_savings").cast("double"), F.col("total_expenses").cast("double")
        ) * F.lit(0.3)
        + F.when(F.col("dependents") == 0, F.lit(0.15)).otherwise(F.lit(0.05))
        + F.when(F.col("loan_repayment") == 0, F.lit(0.15)).otherwise(F.lit(0.05))
    )
    return F.when(income > 0, score).otherwise(F.lit(0.0))


def fraud_score() -> Column:
    """Exact decimal, 0 to 1."""
    def weight(w: str) -> Column:
        return F.lit(w).cast("decimal(5,4)")

    none = weight("0")
    total = (
        F.col("fraud_flag").cast("decimal(3,0)") * weight("0.6")
        + F.when(F.col("amount_inr") > 10000, weight("0.15")).otherwise(none)
        + F.when(F.col("hour_of_day").between(0, 5), weight("0.1")).otherwise(none)
        + F.when(F.col("transaction_status") == "FAILED", weight("0.15")).otherwise(none)
    )
    return total.cast("decimal(5,4)")


def digital_adoption(device: Column) -> Column:
    return (
        F.when(device.isin("android", "ios"), F.lit(100.0))
        .when(device == "web", F.lit(75.0))
        .otherwise(F.lit(50.0))
    )


def weekend_impact() -> Column:
    """A weekend payment in an uplift category counts 1.2 times."""
    uplift = (F.col("is_weekend") == 1) & F.col("merchant_category").isin(
        *rules.WEEKEND_UPLIFT_MERCHANTS
    )
    return F.when(uplift, F.col("amount") * F.lit(1.2)).otherwise(F.col("amount"))
