"""Statistics over run logs: (test_name, database, run_number, execution_time_ms,
row_count, success, error, timestamp)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.functions.scalars import (
    exact_mean, exact_parts, known_count, mean_of_parts, merged_parts, round_half_up, sample_std, sample_variance,
)
from shelfmark.operators.ordering import exact_percentiles
from shelfmark.session import BROADCAST_ROWS, materialise
from shelfmark.sources.partitioned import append_load

RUN = ("test_name", "database")


def run_log(executions: DataFrame) -> DataFrame:
    """Typed run log: success follows from the error, a failed run took no time."""
    ok = F.col("error").isNull()
    return executions.withColumns(
        {"success": ok, "execution_time_ms": F.when(ok, F.col("execution_time_ms")).otherwise(F.lit(0.0))}
    )


def step_times(steps: DataFrame) -> DataFrame:
    """Seconds per pipeline step from (step, started, ended): end minus start."""
    seconds = (F.unix_micros(F.col("ended").cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp"))) / 1e6
    return steps.groupBy("step").agg(
        F.count(F.lit(1)).alias("runs"),
        round_half_up(F.sum(seconds.cast("decimal(18,6)")).cast("double"), 6).alias("total_seconds"),
    )


def run_statistics(log: DataFrame) -> DataFrame:
    """Timing statistics per test and engine; failed runs do not enter the timings."""
    ok = F.col("success")
    ms = F.when(ok, F.col("execution_time_ms"))
    base = log.groupBy(*RUN).agg(
        F.count(F.lit(1)).alias("_n"),
        exact_mean(ms).alias("mean_ms"),
        sample_std(ms).alias("std_ms"),
        F.min(ms).alias("min_ms"),
        F.max(ms).alias("max_ms"),
        F.count_if(ok).alias("successes"),
        F.count_if(~ok).alias("failures"),
        (F.count_if(ok) / F.count(F.lit(1))).alias("success_rate"),
        F.coalesce(exact_mean(F.when(ok, F.col("row_count"))), F.lit(0.0)).alias("avg_row_count"),
    )
    base = materialise(base, "run-statistics")  # it tells the group sizes as well
    median = exact_percentiles(log.where(ok), RUN, "execution_time_ms", {"median_ms": 0.5}, sizes=base.select(*RUN, "_n"))
    return base.join(median, list(RUN), "left").select(
        *RUN, "mean_ms", "median_ms", "std_ms", "min_ms", "max_ms", "successes", "failures", "success_rate", "avg_row_count"
    )


def run_cv(log: DataFrame) -> DataFrame:
    """Coefficient of variation in percent per engine, over successful runs."""
    ms = F.col("execution_time_ms")
    stats = log.where("success").groupBy("database").agg(
        exact_mean(ms).alias("mean_ms"), F.sqrt(sample_variance(ms)).alias("_sd")
    )
    return stats.select(
        "database",
        "mean_ms",
        round_half_up(F.col("_sd"), 6).alias("std_ms"),
        round_half_up(F.try_divide(F.col("_sd"), F.col("mean_ms")) * F.lit(100.0), 6).alias("cv_percent"),
    )


def effect_size(log: DataFrame, first: str, second: str) -> DataFrame:
    """Two-sample t (pooled variance) and Cohen's d per test for two engines."""

    def moments(engine: str, tag: str) -> list:
        ms = F.when(F.col("database") == engine, F.col("execution_time_ms"))
        return [
            known_count(ms).cast("double").alias(f"n{tag}"),
            exact_mean(ms).alias(f"m{tag}"),
            sample_variance(ms).alias(f"v{tag}"),
        ]

    stats = (
        log.where("success")
        .where(F.col("database").isin(first, second))
        .groupBy("test_name")
        .agg(*moments(first, "1"), *moments(second, "2"))
    )
    n1, n2, v1, v2 = F.col("n1"), F.col("n2"), F.col("v1"), F.col("v2")
    gap = F.col("m1") - F.col("m2")
    pooled = F.try_divide((n1 - 1.0) * v1 + (n2 - 1.0) * v2, n1 + n2 - 2.0)
    error = F.sqrt(pooled * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    return stats.select(
        "test_name",
        round_half_up(F.try_divide(gap, error), 6).alias("t_statistic"),
        round_half_up(F.try_divide(gap, F.sqrt((v1 + v2) / 2.0)), 6).alias("cohens_d"),
    )


def anova_f(log: DataFrame) -> DataFrame:
    """One-way ANOVA F over the engines of each test.

    Squares are taken about means, never as differences of large sums.
    """
    ms = F.col("execution_time_ms")
    groups = log.where("success").groupBy(*RUN).agg(
        known_count(ms).cast("double").alias("n"), exact_mean(ms).alias("m"), F.coalesce(sample_variance(ms), F.lit(0.0)).alias("v")
    )
    test = Window.partitionBy("test_name")  # one row per engine
    grand = F.try_divide(F.sum(F.col("n") * F.col("m")).over(test), F.sum("n").over(test))
    gaps = groups.where("n > 0").withColumn("gap", F.col("m") - grand)
    tests = gaps.groupBy("test_name").agg(
        F.count(F.lit(1)).cast("double").alias("k"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("gap") * F.col("gap")).alias("between"),
        F.sum((F.col("n") - 1.0) * F.col("v")).alias("within"),
    )
    between = F.col("between") / (F.col("k") - 1.0)
    within = F.col("within") / (F.col("n") - F.col("k"))
    ratio = F.when((F.col("k") > 1) & (F.col("n") > F.col("k")), F.try_divide(between, within))
    return tests.select(
        "test_name",
        F.col("k").cast("bigint").alias("engines"),
        F.col("n").cast("bigint").alias("runs"),
        round_half_up(ratio, 6).alias("f_statistic"),
    )


def describe_by_group(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """count, mean, std, min, quartiles and max per group; std of one value is null.

    Interpolated quartiles are rounded to six digits, as their last bits depend
    on how an engine orders the same arithmetic.
    """
    x = F.when(~F.isnan(F.col(value).cast("double")), F.col(value))  # NaN counts as missing
    df = df.withColumn(value, x)
    x = F.col(value)
    base = df.groupBy(*keys).agg(
        F.count(x).alias("count"),
        exact_mean(x).alias("mean"),
        round_half_up(F.sqrt(sample_variance(x)), 6).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    )
    base = materialise(base, "described")  # it tells the group sizes as well
    sizes = base.select(*keys, F.col("count").alias("_n"))
    quartiles = exact_percentiles(df, keys, value, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, sizes=sizes)
    rounded = [round_half_up(F.col(c), 6).alias(c) for c in ("p25", "p50", "p75")]
    return base.join(quartiles, list(keys), "left").select(*keys, "count", "mean", "std", "min", *rounded, "max")


def histogram_bins(df: DataFrame, keys: Sequence[str], value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between a group's minimum and maximum, empty bins left out.

    The ranges are stored first, so Spark broadcasts them when they are small
    and the values are binned where they were read.
    """
    x = F.col(value)
    df = df.where(x.isNotNull() & ~F.isnan(x.cast("double")))  # NaN counts as missing
    ranges = materialise(df.groupBy(*keys).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi")), "ranges")
    width = F.col("_hi") - F.col("_lo")
    position = F.coalesce(F.try_divide((x - F.col("_lo")) * F.lit(float(bins)), width), F.lit(0.0))
    bin_no = F.least(F.floor(position), F.lit(bins - 1)) + 1
    return (
        df.join(ranges, list(keys))
        .groupBy(*keys, bin_no.cast("bigint").alias("bin"))
        .agg(F.count(F.lit(1)).alias("values"))
    )



# -- states that merge -------------------------------------------------------------

#: Size of a quantile sketch; with it a rank is off by less than this share of the values, save for rare misses.
SKETCH_SIZE, SKETCH_ERROR = 2048, 0.004


def run_states(log: DataFrame) -> DataFrame:
    """What ``run_statistics`` needs of a log, one row per test and engine; states of several logs merge.

    Numbers with up to six decimals are kept as sums of whole parts and of millionths, as in ``exact_mean``; squares are
    about the state's own mean.
    """
    ok = F.col("success")
    ms, rows = F.when(ok, F.col("execution_time_ms")), F.when(ok, F.col("row_count"))
    known = F.when(~F.isnan(ms), ms)
    return log.groupBy(*RUN).agg(
        F.count(F.lit(1)).alias("runs"),
        F.count_if(ok).alias("successes"),
        F.count_if(~ok).alias("failures"),
        exact_parts(ms).alias("ms"),
        exact_parts(rows).alias("rows"),
        (F.coalesce(F.var_pop(known), F.lit(0.0)) * F.count(known)).alias("squares"),
        F.avg(known).alias("centre"),
        F.min(ms).alias("min_ms"),
        F.max(ms).alias("max_ms"),
        F.kll_sketch_agg_double(known, F.lit(SKETCH_SIZE)).alias("sketch"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One state per test and engine from any number of them; no run is read again."""
    centres = states.groupBy(*RUN).agg(
        F.try_divide(F.sum(F.col("centre") * F.col("ms.n")), F.sum("ms.n")).alias("_centre"),
    )
    joined = states.join(centres, list(RUN))
    gap = F.coalesce(F.col("centre") - F.col("_centre"), F.lit(0.0))
    return joined.groupBy(*RUN).agg(
        F.sum("runs").alias("runs"),
        F.sum("successes").alias("successes"),
        F.sum("failures").alias("failures"),
        merged_parts("ms").alias("ms"),
        merged_parts("rows").alias("rows"),
        # Squares about each mean, and what the means are off the common one.
        F.sum(F.col("squares") + F.col("ms.n") * gap * gap).alias("squares"),
        F.max("_centre").alias("centre"),
        F.min("min_ms").alias("min_ms"),
        F.max("max_ms").alias("max_ms"),
        F.kll_merge_agg_double("sketch", F.lit(SKETCH_SIZE)).alias("sketch"),
    )


def _medians(merged: DataFrame, log: DataFrame) -> DataFrame:
    """Exact medians: the sketch says between which values they lie, and one pass counts the values there.

    The few groups whose sketch is off by more than that are ordered as a whole.
    """
    low, high = (F.kll_sketch_get_quantile_double("sketch", F.lit(0.5 + side * SKETCH_ERROR)) for side in (-1, 1))
    brackets = materialise(merged.where("ms.n > 0").select(*RUN, low.alias("_low"), high.alias("_high"), F.col("ms.n").alias("_total")), "brackets")
    few = brackets.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    ms = F.col("execution_time_ms").cast("double")
    rows = log.where("success").where(ms.isNotNull() & ~F.isnan(ms)).select(*RUN, ms.alias("_v"))
    near = rows.join(F.broadcast(brackets) if few else brackets, list(RUN)).where(F.col("_v") <= F.col("_high"))
    inside = F.when(F.col("_v") >= F.col("_low"), F.col("_v"))  # null for all that is below
    counted = near.groupBy(*RUN, inside.alias("_v"), "_total").agg(F.count(F.lit(1)).alias("_c"))
    earlier = Window.partitionBy(*RUN).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_first", F.coalesce(F.sum("_c").over(earlier), F.lit(0))).where("_v is not null")
    ranks = (F.floor((F.col("_total") - 1) / 2), F.ceil((F.col("_total") - 1) / 2))
    picks = [F.max(F.when((r >= F.col("_first")) & (r < F.col("_first") + F.col("_c")), F.col("_v"))) for r in ranks]
    found = placed.groupBy(*RUN).agg(picks[0].alias("_a"), picks[1].alias("_b"))
    half = F.when(F.col("_total") % 2 == 0, F.lit(0.5)).otherwise(F.lit(0.0))
    found = brackets.join(found, list(RUN), "left").withColumn("median_ms", F.col("_a") + (F.col("_b") - F.col("_a")) * half).select(*RUN, "median_ms")
    found = materialise(found, "bracketed-medians")
    missed = found.where("median_ms is null").select(*RUN)
    if not missed.limit(1).count():
        return found
    whole = exact_percentiles(log.where("success").join(missed, list(RUN), "left_semi"), RUN, "execution_time_ms", {"median_ms": 0.5})
    return found.where("median_ms is not null").unionByName(whole.select(*RUN, "median_ms"))


def merged_run_statistics(states: DataFrame, log: DataFrame) -> DataFrame:
    """``run_statistics`` over the logs whose states are given; ``log`` has their runs, for the medians alone."""
    merged = materialise(merge_states(states), "merged-states")
    variance = F.when(F.col("ms.n") > 1, F.col("squares") / (F.col("ms.n") - 1))
    std = F.when(F.col("ms.n") == 1, F.lit(0.0)).otherwise(round_half_up(F.sqrt(variance), 6))
    return merged.join(_medians(merged, log), list(RUN), "left").select(
        *RUN,
        mean_of_parts("ms").alias("mean_ms"),
        "median_ms",
        std.alias("std_ms"),
        "min_ms",
        "max_ms",
        "successes",
        "failures",
        (F.col("successes") / F.col("runs")).alias("success_rate"),
        F.coalesce(mean_of_parts("rows"), F.lit(0.0)).alias("avg_row_count"),
    )


def append_runs(log: DataFrame, path: str, load_id: str) -> None:
    """Store a log's runs and its states as one load; the same load again takes the place of its first copy."""
    append_load(log, f"{path}/runs", load_id)
    append_load(run_states(log), f"{path}/states", load_id)


def stored_run_statistics(spark: SparkSession, path: str) -> DataFrame:
    """The statistics over all loads: of the states, and of the runs only times next to the medians."""
    return merged_run_statistics(spark.read.parquet(f"{path}/states"), spark.read.parquet(f"{path}/runs"))
