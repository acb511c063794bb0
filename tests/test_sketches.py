"""Packed hashes and frequency summaries against exact counts."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import clean, sketches


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_keys_seen_twice_are_found_whatever_the_buckets(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        draw = random.Random(partitions)
        keys = [(draw.choice([None, i, -i, i, 5]), draw.choice(["a", None])) for i in range(500)]
        df = spark.createDataFrame(keys, "k long, t string").repartition(partitions)
        twice, n = sketches.hashes_seen_twice(df, ["k", "t"])
        rows = Counter(tuple(r) for r in sketches.rows_seen_twice(df, ["k", "t"], twice).collect())
        want = {k: c for k, c in Counter(keys).items() if c > 1}
        assert all(rows[k] == c for k, c in want.items()) and len(rows) == len(want) <= n
        repeated, count = clean.repeated_keys(df, ["k", "t"])
        assert {tuple(r) for r in repeated.collect()} == set(want) and count == len(want)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def _top(keys, limit):
    return sorted(((k, c) for k, c in Counter(k for k in keys if k is not None).items()), key=lambda x: (-x[1], x[0]))[:limit]


@pytest.mark.parametrize("counters", [4096, 8, 1])
def test_frequent_keys_equal_exact_counts(spark, monkeypatch, counters):
    monkeypatch.setattr(sketches, "COUNTERS", counters)
    draw = random.Random(3)
    skewed = [min(int(draw.expovariate(0.4)), 50) if draw.random() < 0.8 else 1000 + i for i in range(3000)] + [None] * 900
    for keys in (skewed, list(range(400)), [i // 2 for i in range(600)], [None] * 5, []):
        df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
        assert [tuple(r) for r in sketches.frequent_keys(df, "k", 7).collect()] == _top(keys, 7)
        removed = [(k, c - 1) for k, c in _top(keys, 7) if c > 1]
        assert [tuple(r) for r in clean.top_duplicate_keys(df, "k", 7).collect()] == removed


def _shuffled(spark):
    executors = spark._jsc.sc().statusStore().executorList(True)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


def test_unique_keys_shuffle_their_packed_hashes_only(spark):
    df = spark.range(0, 400_000, 1, 4).select(F.xxhash64("id").cast("string").alias("k"), "id")
    before = _shuffled(spark)
    assert clean.top_duplicate_keys(df, "k").collect() == []
    assert clean.dedup_keep_first(df, ["k"], ["id"]).count() == 400_000
    packed = _shuffled(spark) - before
    df.groupBy("k").count().where("count > 1").collect()
    assert packed < _shuffled(spark) - before - packed


def test_no_run_of_hashes_is_longer_than_the_buffer(monkeypatch):
    monkeypatch.setattr(sketches, "FLUSH", 10)
    batches = [pa.RecordBatch.from_arrays([pa.array([i % 4 for i in range(n)], pa.int64())], names=["h"]) for n in (25, 0, 3, 12)]
    runs = [dict(zip(own.tolist(), counts.tolist())) for own, counts in sketches._in_runs(iter(batches))]
    assert [sum(run.values()) for run in runs] == [10] * 4
    assert sum(map(Counter, runs), Counter()) == Counter(i % 4 for n in (25, 3, 12) for i in range(n))
