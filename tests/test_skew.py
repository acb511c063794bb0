"""A key with a third of all rows: the plans must be able to split it."""

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import normalize, relational

SETTINGS = {
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
}


@pytest.fixture(scope="module")
def links(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    game = F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.pmod(F.xxhash64("id"), F.lit(9000)))
    yield spark.range(900_000, numPartitions=16).select(game.alias("game"), F.xxhash64("id").alias("payload"))
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    """Number of rows and the plan adaptive execution ended with."""
    payload = [F.col(f.name) for f in df.schema]
    total = df.agg(F.count("*"), F.bit_xor(F.xxhash64(*payload)))
    rows = total.first()[0]
    total = df.agg(F.count("*"), F.bit_xor(F.xxhash64(*payload)))
    total.collect()
    return rows, total._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_left_join_splits_a_hot_key_of_the_optional_side(spark, links):
    games = spark.range(10_000).withColumnRenamed("id", "appid")
    rows, plan = final_plan(relational.left_join(games, links, "appid", "game"))
    assert rows == 901_000
    assert "SortMergeJoin(skew=true)" in plan


def test_bridge_splits_a_hot_name(spark, links):
    names = spark.range(9000).select(F.col("id").alias("genre_id"), F.concat(F.lit("n"), "id").alias("name"))
    entries = links.select(F.col("payload").alias("game_appid"), F.concat(F.lit("n"), "game").alias("name"))
    rows, plan = final_plan(normalize.bridge(entries, names, "genre_id"))
    assert rows == 900_000
    assert "SortMergeJoin(skew=true)" in plan
