"""Numbers far from those of the given tables."""

import math

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.scalars import exact_mean, exact_sum, round_half_up, sample_std, sample_variance
from shelfmark.operators import runstats


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize(
    "values",
    [[1e-7, 3e-7], [9e18, 9e18], [1e12, 1e12 + 1], [0.1, 0.2, 0.30000000001], [-2.5, 2.25], [1e300, -1e300], [1e18, 1e18, -1e18]],
)
def test_sums_and_means(spark, values):
    total, mean = frame(spark, values).agg(exact_sum(F.col("x")), exact_mean(F.col("x"))).first()
    assert math.isclose(total, sum(values), rel_tol=1e-12, abs_tol=1e-20)
    assert math.isclose(mean, sum(values) / len(values), rel_tol=1e-12, abs_tol=1e-20)


def test_infinity_and_nan_in_sums(spark):
    assert frame(spark, [1.0, math.inf]).agg(exact_sum(F.col("x"))).first()[0] == math.inf
    assert frame(spark, [1.0, math.nan, 3.0]).agg(exact_mean(F.col("x"))).first()[0] == 2.0
    assert frame(spark, [math.nan, None]).agg(exact_mean(F.col("x"))).first()[0] is None


@pytest.mark.parametrize("values, want", [([1e9, 1e9 + 1, 1e9 + 2], 1.0), ([1e12, 1e12 + 2], 2.0), ([1.0, math.nan, 2.0], 0.5), ([4.0], None)])
def test_variance(spark, values, want):
    assert frame(spark, values).agg(sample_variance(F.col("x"))).first()[0] == want


def test_std_of_one_known_value_is_zero(spark):
    assert frame(spark, [4.0, math.nan]).agg(sample_std(F.col("x"))).first()[0] == 0.0


def test_rounding(spark):
    df = frame(spark, [2.345, -2.375, math.inf, -math.inf, 1e18, -1e17, None, math.nan])
    got = [r[0] for r in df.select(round_half_up(F.col("x"))).collect()]
    assert got[:7] == [2.35, -2.37, math.inf, -math.inf, 1e18, -1e17, None] and math.isnan(got[7])


def test_anova_and_histogram_far_from_zero(spark):
    rows = [("t", f"e{k % 2}", k, 1e9 + k % 2 + (k // 2) / 10, True) for k in range(8)] + [("t", "e0", 9, math.nan, True)]
    log = spark.createDataFrame(rows, "test_name string, database string, run_number int, execution_time_ms double, success boolean")
    (row,) = runstats.anova_f(log).collect()
    assert (row["engines"], row["runs"]) == (2, 8) and math.isclose(row["f_statistic"], 120.0, rel_tol=1e-4)
    bins = {r["bin"]: r["values"] for r in runstats.histogram_bins(log, ["test_name"], "execution_time_ms", 2).collect()}
    assert bins == {1: 4, 2: 4}
