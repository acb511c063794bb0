"""Range digests against the plain comparison, on literal rows and on random ones."""

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import digests, reconcile

SCHEMA = "id int, name string, price double, tags map<string,int>, parts array<int>"


def _random_rows(seed, count, changed):
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        key = draw.choice([None, i, i, i, 7])
        tags = draw.choice([None, {}, {"a": 1, "b": None}, {"b": None, "a": 1}, {"c": i}])
        rows.append((key, draw.choice(["x", "y", None, str(i)]), draw.choice([None, 0.0, 1.5, float("nan"), i / 8]), tags, draw.choice([None, [], [None, 1], [1, None]])))
    other = [r for r in rows if draw.random() > changed] + [(r[0], "new", r[2], r[3], r[4]) for r in rows if draw.random() < changed]
    draw.shuffle(other)
    return rows, other


def _cells(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("changed", [0.0, 0.05, 1.0])
def test_range_diff_equals_cell_diff(spark, changed):
    rows, other = _random_rows(3, 400, changed)
    left, right = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(other, SCHEMA)
    plain = _cells(reconcile.cell_diff(left, right, "id"))
    assert _cells(reconcile.range_diff(left, right, "id", ranges=16, fan=4)) == plain
    assert bool(plain) == (changed > 0)


def test_text_keys_other_types_and_empty_sides(spark):
    rows = [(f"user_{i:06d}", i) for i in range(300)]
    left = spark.createDataFrame(rows, "k string, v int")
    right = spark.createDataFrame([(k, float(v + (v % 50 == 0))) for k, v in rows], "k string, v double")
    got = _cells(reconcile.range_diff(left, right, "k", ranges=8, fan=4))
    assert got == _cells(reconcile.cell_diff(left, right, "k")) and len(got) == 6
    assert digests.range_report(left, right, "k", 8).where("differs").count() <= 6
    empty = left.limit(0)
    assert reconcile.range_diff(empty, empty, "k").collect() == []
    assert reconcile.range_diff(left, empty, "k").count() == 300
    assert {r["difference"] for r in reconcile.range_diff(empty, left, "k").collect()} == {"missing_left"}


def test_nulls_in_other_places_do_not_look_alike(spark):
    left = spark.createDataFrame([(1, None, 5, [None, 1])], "id int, a int, b int, c array<int>")
    for row in [(1, 5, None, [None, 1]), (1, None, 5, [1, None])]:
        right = spark.createDataFrame([row], left.schema)
        assert reconcile.range_diff(left, right, "id").count() == reconcile.cell_diff(left, right, "id").count() > 0


def test_maps_compare_by_their_entries(spark, rows):
    kind = "id int, m map<string,int>"
    left = spark.createDataFrame([(1, {"a": 1, "b": 2}), (2, {"a": 1}), (3, None)], kind)
    right = spark.createDataFrame([(1, {"b": 2, "a": 1}), (2, {"a": 2}), (3, {})], kind)
    assert rows(reconcile.cell_diff(left, right, "id"), "id", "field") == [(2, "m"), (3, "m")]


def test_equal_copies_pair_off_first(spark, rows):
    left = spark.createDataFrame([(1, v) for v in (5, 6, 7, 7)], "id int, v int")
    right = spark.createDataFrame([(1, v) for v in (6, 7, 8)], "id int, v int")
    # 6 and one 7 have equals; 5 is next to 8, and the other 7 is alone.
    assert rows(reconcile.cell_diff(left, right, "id"), "field", "left_value", "right_value", "difference") == [
        ("v", "5", "8", "value"), (None, None, None, "missing_right"),
    ]


def test_hot_key_is_numbered_by_places(spark, monkeypatch):
    left = spark.createDataFrame([(1, i) for i in range(50)] + [(None, i) for i in range(30)], "id int, v int")
    right = spark.createDataFrame([(1, i + 100) for i in range(50)] + [(None, i + 100) for i in range(29)], "id int, v int")
    usual = _cells(reconcile.cell_diff(left, right, "id"))
    monkeypatch.setattr(reconcile, "GROUP_ROWS", 10)
    assert _cells(reconcile.cell_diff(left, right, "id")) == usual and len(usual) == 80


def _shuffled(spark):
    executors = spark._jsc.sc().statusStore().executorList(True)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def test_equal_tables_shuffle_digests_only(spark):
    rows = spark.range(200_000).select("id", F.xxhash64("id").cast("string").alias("text"), F.lit(1.5).alias("price"))
    turned = rows.repartition(7)
    before = _shuffled(spark)
    assert reconcile.range_diff(rows, rows, "id", ranges=64).collect() == []
    digests_only = _shuffled(spark) - before
    assert reconcile.cell_diff(rows, rows, "id").collect() == []
    assert digests_only * 10 < _shuffled(spark) - before - digests_only
    assert turned.count() == 200_000


def test_a_change_in_one_place_moves_few_rows(spark):
    rows = spark.range(100_000).select("id", (F.col("id") % 100).alias("v"))
    changed = rows.withColumn("v", F.when(F.col("id") == 77_777, -1).otherwise(F.col("v")))
    left, right = digests.differing_rows(rows, changed, "id", ranges=64, fan=16)
    assert left.count() == right.count() <= 100_000 / 64
    assert [tuple(r) for r in reconcile.range_diff(rows, changed, "id", ranges=64).collect()] == [(77_777, "v", "77", "-1", "value")]
