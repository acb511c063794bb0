"""Scalar and aggregate column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICRO = 1_000_000
# Below this, whole parts and millionths add up as integers.
_SMALL = 1e9


def round_half_up(x: Column, digits: int = 2) -> Column:
    """Round a double; gives the same bits on every engine with IEEE doubles.

    NaN, infinity, and numbers too large to have such digits stay as they are.
    """
    scale = float(10**digits)
    rounded = F.floor(x * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)
    return F.when(F.abs(x) < F.lit(2.0**52 / scale), rounded).otherwise(x.cast("double"))


def _known(x: Column) -> Column:
    real = x.cast("double")
    return F.when(~F.isnan(real), real)


def exact_sum(x: Column) -> Column:
    """Sum of doubles; NaN counts as missing.

    Numbers with at most six decimals, as prices and times have, are added up
    as integers, so that the sum does not depend on the order of the rows.  A
    group with any other number, or one too large, is summed as doubles.
    """
    return _sum_of_parts(exact_parts(x))


def exact_parts(x: Column) -> Column:
    """What an exact sum consists of, as a struct that can be stored and merged: see ``exact_sum``."""
    real = _known(x)
    small = F.when(F.abs(real) < F.lit(_SMALL), real)
    whole = F.floor(small)
    millionths = F.floor((small - whole) * F.lit(float(_MICRO)) + F.lit(0.5))
    fits = F.coalesce((whole * F.lit(_MICRO) + millionths).cast("double") / F.lit(float(_MICRO)) == real, real.isNull())
    return F.struct(
        F.count(real).alias("n"),
        F.try_sum(whole).alias("whole"),
        F.try_sum(millionths).alias("millionths"),
        F.bool_and(fits).alias("fits"),
        F.sum(real).alias("plain"),
    )


def merged_parts(column: str) -> Column:
    """The parts of several groups together."""
    sums = [F.try_sum(f"{column}.{part}").alias(part) for part in ("whole", "millionths")]
    return F.struct(F.sum(f"{column}.n").alias("n"), *sums, F.bool_and(f"{column}.fits").alias("fits"), F.sum(f"{column}.plain").alias("plain"))


def _sum_of_parts(parts: Column) -> Column:
    total = parts["whole"].cast("decimal(20,0)") * F.lit(_MICRO) + parts["millionths"]
    return F.coalesce(F.when(parts["fits"], total.cast("double") / F.lit(float(_MICRO))), parts["plain"])


def mean_of_parts(column: str) -> Column:
    return F.try_divide(_sum_of_parts(F.col(column)), F.col(f"{column}.n").cast("double"))


def exact_mean(x: Column) -> Column:
    return F.try_divide(exact_sum(x), F.count(_known(x)).cast("double"))


def sample_std(x: Column, digits: int = 6) -> Column:
    """Sample standard deviation; 0 for a single value, NaN counts as missing."""
    return F.when(F.count(_known(x)) == 1, F.lit(0.0)).otherwise(round_half_up(F.sqrt(sample_variance(x)), digits))


def sample_variance(x: Column) -> Column:
    """Sample variance about a running mean; null below two values, NaN counts as missing.

    Its last bits depend on the order of the rows: round it for comparison.
    """
    return F.var_samp(_known(x))


def known_count(x: Column) -> Column:
    """Number of values that are neither null nor NaN."""
    return F.count(_known(x))


def true_count(flag: Column) -> Column:
    """Number of true values; null counts as false."""
    return F.count_if(F.coalesce(flag, F.lit(False)))


def ratio_true(flag: Column) -> Column:
    """Share of true values among all rows, 0 for an empty group."""
    return F.coalesce(
        F.try_divide(true_count(flag).cast("double"), F.count(F.lit(1)).cast("double")), F.lit(0.0)
    )


def first_item(items: Column) -> Column:
    """First array element; null when the array is empty or null."""
    return F.get(items, F.lit(0))
