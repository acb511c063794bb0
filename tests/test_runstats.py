import random
import statistics

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import runstats

RUNS = {
    ("t", "a"): [(10.5, None), (12.25, None), (11.0, None)],
    ("t", "b"): [(20.0, None), (0.0, "lost connection"), (24.0, None), (25.0, None)],
    ("u", "a"): [(0.0, "x"), (0.0, "y")],
    ("u", "b"): [(7.125, None)],
}


@pytest.fixture(scope="module")
def log(spark):
    data = [
        (t, d, i, ms, 100 if e is None else 0, e)
        for (t, d), runs in RUNS.items()
        for i, (ms, e) in enumerate(runs, start=1)
    ]
    raw = spark.createDataFrame(
        data, "test_name string, database string, run_number int, execution_time_ms double, row_count int, error string"
    )
    return runstats.run_log(raw)


def test_run_log(log):
    assert log.where("not success").agg(F.count("*"), F.max("execution_time_ms")).first() == (3, 0.0)


def test_statistics_leave_failures_out(log):
    got = {(r["test_name"], r["database"]): r for r in runstats.run_statistics(log).collect()}
    for key, runs in RUNS.items():
        ok = [ms for ms, e in runs if e is None]
        row = got[key]
        assert (row["successes"], row["failures"]) == (len(ok), len(runs) - len(ok))
        assert row["success_rate"] == len(ok) / len(runs)
        if not ok:
            assert row["mean_ms"] is row["median_ms"] is row["std_ms"] is row["min_ms"] is None
            assert row["avg_row_count"] == 0.0
            continue
        assert row["mean_ms"] == pytest.approx(statistics.mean(ok))
        assert row["median_ms"] == statistics.median(ok)
        assert row["std_ms"] == pytest.approx(statistics.stdev(ok) if len(ok) > 1 else 0.0, abs=1e-6)
        assert (row["min_ms"], row["max_ms"], row["avg_row_count"]) == (min(ok), max(ok), 100.0)


def test_cv(log):
    got = {r["database"]: r for r in runstats.run_cv(log).collect()}
    ok = [10.5, 12.25, 11.0]
    assert got["a"]["cv_percent"] == pytest.approx(statistics.stdev(ok) / statistics.mean(ok) * 100, abs=1e-5)


def test_effect_size(log):
    (row, other) = runstats.effect_size(log, "a", "b").orderBy("test_name").collect()
    a, b = [10.5, 12.25, 11.0], [20.0, 24.0, 25.0]
    va, vb = statistics.variance(a), statistics.variance(b)
    gap = statistics.mean(a) - statistics.mean(b)
    assert row["cohens_d"] == pytest.approx(gap / ((va + vb) / 2) ** 0.5, abs=1e-5)
    assert row["t_statistic"] == pytest.approx(gap / ((va + vb) / 2 * (2 / 3)) ** 0.5, abs=1e-5)
    assert other["t_statistic"] is None and other["cohens_d"] is None


def test_anova(log):
    (row,) = runstats.anova_f(log.where("test_name = 't'")).collect()
    a, b = [10.5, 12.25, 11.0], [20.0, 24.0, 25.0]
    m = statistics.mean(a + b)
    between = 3 * (statistics.mean(a) - m) ** 2 + 3 * (statistics.mean(b) - m) ** 2
    within = 2 * statistics.variance(a) + 2 * statistics.variance(b)
    assert row["f_statistic"] == pytest.approx(between / (within / 4), abs=1e-5)
    assert runstats.anova_f(log.where("test_name = 'u'")).first()["f_statistic"] is None


def test_describe(log):
    row = runstats.describe_by_group(log.where("success"), ["database"], "execution_time_ms").where("database = 'a'").first()
    assert tuple(row)[1:] == (3, 11.25, pytest.approx(0.901388, abs=1e-6), 10.5, 10.75, 11.0, 11.625, 12.25)


def test_histogram_puts_the_maximum_in_the_last_bin(spark, rows):
    df = spark.createDataFrame([("a", float(v)) for v in range(11)] + [("b", 3.0), ("b", 3.0), ("b", None)], "g string, v double")
    assert rows(runstats.histogram_bins(df, ["g"], "v", 5)) == [
        ("a", 1, 2), ("a", 2, 2), ("a", 3, 2), ("a", 4, 2), ("a", 5, 3), ("b", 1, 2),
    ]


def test_step_times_are_end_minus_start(spark, rows):
    df = spark.sql(
        """select * from values ('import', timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:00:01.5'),
           ('import', timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:00:02') t(step, started, ended)"""
    )
    assert rows(runstats.step_times(df)) == [("import", 2, 3.5)]


def _log(spark, rows):
    raw = spark.createDataFrame(rows, "test_name string, database string, run_number int, execution_time_ms double, row_count int, error string")
    return runstats.run_log(raw)


def _by_key(df):
    return {(r["test_name"], r["database"]): r.asDict() for r in df.collect()}


def test_merged_states_equal_one_pass_over_all_logs(spark, tmp_path):
    draw = random.Random(1)
    rows = [
        (draw.choice("tu"), draw.choice("abc"), i, draw.choice([float("nan"), draw.uniform(1, 9), 1e6 + draw.random(), 2.5]), draw.randrange(9), "x" if i % 7 == 0 else None)
        for i in range(3000)
    ]
    rows += [("none", "a", 1, 0.0, 0, "lost"), ("one", "a", 1, 4.5, 2, None), ("nan", "a", 1, float("nan"), 2, None)]
    for k in range(4):
        runstats.append_runs(_log(spark, rows[k::4]), str(tmp_path), f"load{k}")
    runstats.append_runs(_log(spark, rows[1::4]), str(tmp_path), "load1")  # once more
    got, want = _by_key(runstats.stored_run_statistics(spark, str(tmp_path))), _by_key(runstats.run_statistics(_log(spark, rows)))
    assert got.keys() == want.keys()
    for key, row in want.items():
        for name, value in row.items():
            assert got[key][name] == (pytest.approx(value, rel=1e-12, abs=2e-6, nan_ok=True) if isinstance(value, float) else value), (key, name)


def test_a_sketch_that_misses_is_made_good(spark, monkeypatch):
    monkeypatch.setattr(runstats, "SKETCH_SIZE", 8)
    monkeypatch.setattr(runstats, "SKETCH_ERROR", 1e-9)  # brackets far too narrow for so small a sketch
    draw = random.Random(2)
    log = _log(spark, [("t", draw.choice("abcd"), i, draw.random(), 1, None) for i in range(4000)])
    got = _by_key(runstats.merged_run_statistics(runstats.run_states(log), log))
    assert all(got[k]["median_ms"] == v["median_ms"] for k, v in _by_key(runstats.run_statistics(log)).items())


def test_nan_is_missing_from_medians(spark):
    log = _log(spark, [("t", "a", i, v, 1, None) for i, v in enumerate([float("nan"), 1.0, 2.0])])
    assert runstats.run_statistics(log).first()["median_ms"] == 1.5
    assert runstats.merged_run_statistics(runstats.run_states(log), log).first()["median_ms"] == 1.5
