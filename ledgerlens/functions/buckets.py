"""Value buckets that keep order and stay small whatever the values look like."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Buckets between a power of two and the next one.
STEPS = 1 << 14
_LOWEST, _BEYOND = 1100, 3000  # no double has an exponent below the one or above the other


def value_bucket(value: Column) -> Column:
    """A whole number that never falls as the value rises: a logarithmic scale with linear steps.

    A bucket spans 1/16384 of its values' size, so values between 5 and 25 spread over
    tens of thousands of buckets just as amounts up to millions do, and a few extreme
    values do not widen the buckets of the others. NULL stays NULL; NaN counts as the
    greatest value.
    """
    v = value.cast("double")
    size = F.abs(v)
    exponent = F.floor(F.log2(size))
    step = (exponent + F.lit(_LOWEST)) * STEPS + F.floor((size / F.pow(F.lit(2.0), exponent) - 1) * STEPS)
    edge = F.lit((_BEYOND + _LOWEST) * STEPS)
    return (
        F.when(F.isnan(v), edge + 1).when(v == 0, F.lit(0))
        .when(size == float("inf"), F.signum(v) * edge).otherwise(F.signum(v) * step).cast("bigint")
    )
