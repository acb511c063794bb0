import pytest
from pyspark.sql import functions as F

from shelfmark.operators import documents


@pytest.fixture(scope="module")
def games(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "appid int, name string")


@pytest.fixture(scope="module")
def links(spark):
    return spark.createDataFrame([(1, 10), (1, 11), (2, 12), (None, 13), (9, 14)], "game int, dev int")


def test_lookup_nests_matches_and_keeps_the_unmatched(games, links):
    out = documents.lookup(games, links, "appid", "game", "devs", ["dev"]).orderBy("appid").collect()
    assert [(r["appid"], [d["dev"] for d in r["devs"]]) for r in out] == [(1, [10, 11]), (2, [12]), (3, [])]


def test_lookup_gives_one_row_per_left_row_at_every_size(spark, games, rows):
    """A key with more matches than an earlier limit of 100,000 is one row with one array."""
    hot = spark.range(120_000).select(F.lit(1).alias("game"), F.col("id").cast("int").alias("dev"))
    out = documents.lookup(games, hot, "appid", "game", "devs", ["dev"])
    assert out.columns == ["appid", "name", "devs"]
    assert rows(out.withColumn("n", F.size("devs")), "appid", "n") == [(1, 120_000), (2, 0), (3, 0)]
    summed = documents.lookup_summary(games, hot, "appid", "game", "n", "least", ["dev"])
    assert rows(summed, "appid", "n", "least.dev") == [(1, 120_000, 0), (2, 0, None), (3, 0, None)]


def test_unwind(spark, rows):
    df = spark.sql("select * from values (1, array('x', 'y')), (2, array()), (3, null) t(id, tags)")
    assert rows(documents.unwind(df, "tags")) == [(1, "x"), (1, "y")]
    assert rows(documents.unwind(df, "tags", keep_empty=True)) == [(1, "x"), (1, "y"), (2, None), (3, None)]


def test_lookup_then_unwind_is_the_fused_form(games, links, rows):
    two_steps = documents.unwind(documents.lookup(games, links, "appid", "game", "d", ["dev"]), "d", keep_empty=True)
    fused = documents.lookup_unwind(games, links, "appid", "game", "d", ["dev"], keep_empty=True)
    assert rows(two_steps, "appid", "d.dev") == rows(fused, "appid", "d.dev")


def test_array_helpers(spark, rows):
    df = spark.sql("select * from values (1, array('x', 'y')), (2, array()), (3, null) t(id, a)")
    assert rows(documents.array_first(df, "a", "f"), "id", "f") == [(1, "x"), (2, None), (3, None)]
    assert rows(documents.array_size(df, "a", "n"), "id", "n") == [(1, 2), (2, 0), (3, 0)]
