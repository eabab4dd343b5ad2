"""Text to numbers. Every cast is ``try_cast``: bad input is null, never an ANSI error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_decimal_comma(c: Column) -> Column:
    """``14.015,05`` to 14015.05: drop whitespace and thousands dots, comma becomes point."""
    bare = F.regexp_replace(c, r"\s", "")
    pointed = F.replace(F.replace(bare, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return to_double(pointed)


def to_double(c: Column) -> Column:
    """Finite numbers only: ``NaN`` and ``Infinity`` are text, no figures."""
    value = c.try_cast("double")
    # NaN counts as larger than any number, so it fails the comparison too
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def to_long(c: Column) -> Column:
    """Via decimal, because ``52.0`` does not cast straight to bigint. Fractions are cut."""
    return c.try_cast("decimal(38,10)").try_cast("bigint")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division where a zero denominator gives null."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


#: Decimals that values are summed as: places, and the size that they stay below, so that a
#: sum of 10**12 of them has no more than 38 digits. A value takes the first that holds it.
BANDS = ((10, 1e16), (24, 1e2), (14, 1e12), (0, 1e26))


def exact_mean(c: Column) -> Column:
    """Mean of the values as they are, ignoring nulls.

    Summed as decimals, so the result does not depend on row order or partitioning: values of
    up to ten places by themselves, others in three bands of size. Values that none holds (from
    1e26 on, or with digits beyond the 24th place) are summed as doubles, in the order they
    come. No finite value ends the job.
    """
    value = c.cast("double")
    left = value.isNotNull()
    sums = []
    for places, below in BANDS:
        # casts of what is not below would overflow
        exact = F.when(F.abs(value) < below, value).try_cast(f"decimal(38,{places})")
        fits = F.coalesce(exact.cast("double") == value, F.lit(False))
        sums.append(F.try_sum(F.when(left & fits, exact)).cast("double"))
        left = left & ~fits
    sums.append(F.sum(F.when(left, value)))
    total = sums[0]
    for other in sums[1:]:
        total = F.coalesce(total + other, total, other)
    return total / F.nullif(F.count(c), F.lit(0))


def whole_to_long(c: Column, label: str) -> Column:
    """Double counts to bigint for a sink. A fraction fails the write instead of being cut."""
    return F.when(c.isNull() | (c == F.floor(c)), c.cast("bigint")).otherwise(
        F.raise_error(F.concat(F.lit(f"{label} is not a whole number: "), c.cast("string")))
    )
