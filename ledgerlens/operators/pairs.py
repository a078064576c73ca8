"""The payment-person relation, kept as its two factors.

The two inputs meet on an age category, a key with six values, so the joined
table holds nearly rows x rows / 6 pairs: it cannot be written at any real size.
Every pair measure in use is a sum of products of a payment term and a person
term, so each side is aggregated on its own (with map-side partial aggregates,
which absorbs a hot category) and only the aggregates meet. No pair is ever made.

With n payments and m persons in a category:
  rows n*m; sum of a payment column: sum * m; average, extreme, median, mode and
  distinct count of a one-sided column: the same as on its own side.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import times_rows

PAYMENTS, PERSONS = "n_payments", "n_persons"


@dataclass(frozen=True)
class PairRelation:
    """Payments and persons that share ``key``, an age category on both sides."""

    payments: DataFrame
    persons: DataFrame
    key: str = "age_category"

    def payment_side(self, by: Sequence[str] = (), *measures: Column) -> DataFrame:
        return self.payments.groupBy(self.key, *by).agg(F.count(F.lit(1)).alias(PAYMENTS), *measures)

    def person_side(self, by: Sequence[str] = (), *measures: Column) -> DataFrame:
        return self.persons.groupBy(self.key, *by).agg(F.count(F.lit(1)).alias(PERSONS), *measures)

    def by_payment(self, by: Sequence[str], payment_measures=(), person_measures=()) -> DataFrame:
        """Groups of payment columns within a category; person measures per category.

        The person side has one row per category label, six at most by the closed
        CASE that makes the label, so it is broadcast.
        """
        persons = self.person_side((), *person_measures)
        return self.payment_side(by, *payment_measures).join(F.broadcast(persons), self.key)

    def by_person(self, by: Sequence[str], payment_measures=(), person_measures=()) -> DataFrame:
        """Groups of person columns within a category; payment measures per category (six rows)."""
        payments = self.payment_side((), *payment_measures)
        return self.person_side(by, *person_measures).join(F.broadcast(payments), self.key)

    def each_payment(self, *person_measures: Column) -> DataFrame:
        """Every payment that has partners, beside the aggregate of its partners."""
        persons = self.person_side((), *person_measures)
        return self.payments.join(F.broadcast(persons), self.key)

    def matched_payments(self) -> DataFrame:
        """Payments with at least one partner."""
        keys = self.persons.select(self.key).distinct()  # six rows at most
        return self.payments.join(F.broadcast(keys), self.key, "left_semi")

    def matched_persons(self) -> DataFrame:
        keys = self.payments.select(self.key).distinct()  # six rows at most
        return self.persons.join(F.broadcast(keys), self.key, "left_semi")


def pair_rows() -> Column:
    """COUNT(*) over the pairs of a group."""
    return F.col(PAYMENTS).cast("decimal(20,0)") * F.col(PERSONS).cast("decimal(15,0)")


def over_persons(total: str | Column) -> Column:
    """A payment-side total as it counts over the pairs."""
    c = F.col(total) if isinstance(total, str) else total
    return times_rows(c, F.col(PERSONS))


def over_payments(total: str | Column) -> Column:
    """A person-side total as it counts over the pairs."""
    c = F.col(total) if isinstance(total, str) else total
    return times_rows(c, F.col(PAYMENTS))


def sample_stddev_over_persons(variance: str) -> Column:
    """STDDEV of a payment column over the pairs, from its population variance."""
    n, m = F.col(PAYMENTS).cast("double"), F.col(PERSONS).cast("double")
    return F.sqrt(F.try_divide(F.col(variance) * n * m, n * m - F.lit(1.0)))
