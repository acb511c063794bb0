import random
import statistics

from pyspark.sql import functions as F

from shelfmark.operators.ordering import dense_ids, exact_percentiles, mode_per_key, with_positions


def test_dense_ids_follow_code_points(spark):
    names = ["!C", '"N"', "#12", "B", "a", "é", "zz", "\U0001f600"]
    df = spark.createDataFrame([(n,) for n in reversed(names)], ["name"]).repartition(5)
    got = {r["name"]: r["id"] for r in dense_ids(df, "name", "id").collect()}
    assert got == {n: i for i, n in enumerate(sorted(names), start=1)}


def test_dense_ids_have_no_gap_over_many_partitions(spark):
    df = spark.range(20000).select(F.sha1(F.col("id").cast("string")).alias("name"))
    ids = dense_ids(df, "name", "id")
    assert ids.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first() == (1, 20000, 20000)
    assert [r.name for r in ids.orderBy("id").select("name").collect()] == [r.name for r in df.orderBy("name").collect()]


def test_positions_count_equal_rows_separately(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 3, ["k"]).repartition(4)
    got = sorted((r["n"], r["k"]) for r in with_positions(df, ["k"], "n").collect())
    assert got == list(zip(range(8), "aaaaabbb"))


def test_positions_of_an_empty_frame(spark):
    assert with_positions(spark.range(0), ["id"], "n").count() == 0


def linear(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


def test_exact_percentiles_with_a_hot_key(spark):
    draw = random.Random(7)
    data = {0: [draw.lognormvariate(3, 2) for _ in range(20000)], 1: [5.0] * 3000, 2: [1.0, 2.0], 3: [9.0]}
    data.update({k: [round(draw.random(), 2) for _ in range(k)] for k in range(4, 40)})
    df = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs] + [(50, None), (None, 1.0)], "k int, v double")
    for group_rows, buckets in ((10**6, 1024), (0, 8), (20, 512), (5000, 64)):
        out = exact_percentiles(df, ["k"], "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99, "top": 1.0}, group_rows, buckets)
        got = {r["k"]: r for r in out.collect()}
        assert set(got) == set(data)
        for k, values in data.items():
            assert got[k]["p50"] == statistics.median(values) or abs(got[k]["p50"] - statistics.median(values)) < 1e-9
            assert abs(got[k]["p10"] - linear(values, 0.1)) < 1e-9
            assert abs(got[k]["p99"] - linear(values, 0.99)) < 1e-6
            assert got[k]["top"] == max(values)


def test_exact_percentiles_without_rows(spark):
    empty = spark.createDataFrame([], "k int, v double")
    assert exact_percentiles(empty, ["k"], "v", {"m": 0.5}).collect() == []


def test_mode_takes_the_smallest_on_ties(spark, rows):
    df = spark.createDataFrame(
        [("d", ["b"]), ("d", ["a"]), ("d", ["b"]), ("d", ["a", "c"]), ("t", ["z"]), ("t", ["a"]), ("n", None)],
        "k string, g array<string>",
    )
    assert rows(mode_per_key(df, ["k"], "g", "m")) == [("d", ["b"]), ("t", ["a"])]


def test_positions_spread_equal_rows_over_partitions(spark):
    df = spark.range(60000, numPartitions=12).select(F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(F.lit(-1)).alias("k"))
    # Keep small partitions apart, in the shuffle and in the scan after it.
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.openCostInBytes": "134217728"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        numbered = with_positions(df, ["k"], "n", start=1)
        parts = numbered.where("k = -1").select(F.spark_partition_id()).distinct().count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert parts > 1
    assert numbered.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first() == (1, 60000, 60000)
    assert numbered.where("k = -1").agg(F.min("n"), F.max("n")).first() == (1, 20000)
