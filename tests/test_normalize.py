import pytest
from pyspark.sql import functions as F

from shelfmark.operators import normalize
from shelfmark.plans.store import build_normalised

GAMES = [
    (1, ["", "B", "a"]),
    (2, ["!C", '"N"', "#12", "é", None]),
    (3, None),
    (4, []),
    (5, ["B", "B"]),
]


@pytest.fixture(scope="module")
def games(spark):
    return spark.createDataFrame(GAMES, "appid int, developers array<string>")


def test_dimension_skips_empty_names(spark, games, rows):
    dim = normalize.dim_developers(normalize.list_entries(games, "appid", "developers"))
    assert rows(dim) == [(1, "!C"), (2, '"N"'), (3, "#12"), (4, "B"), (5, "a"), (6, "é")]


def test_genres_carry_an_empty_description(spark, games):
    dim = normalize.dim_genres(normalize.list_entries(games, "appid", "developers"))
    assert dim.columns == ["genre_id", "name", "description"]
    assert dim.where("description is not null").count() == 0


def test_bridge_keeps_repeated_pairs_unless_distinct(spark, games, rows):
    entries = normalize.list_entries(games, "appid", "developers")
    dim = normalize.dim_developers(entries).where("name <> 'a'")
    assert rows(normalize.bridge(entries, dim, "developer_id").where("game_appid in (1, 5)")) == [(1, 4), (5, 4), (5, 4)]
    assert rows(normalize.bridge(entries, dim, "developer_id", distinct=True).where("game_appid = 5")) == [(5, 4)]


def test_text_column_counts_as_a_one_element_list(spark, rows):
    df = spark.createDataFrame([(1, "Solo"), (2, ""), (3, None)], "appid int, developers string")
    assert rows(normalize.list_entries(df, "appid", "developers")) == [(1, "Solo")]


def test_tags_sum_votes_and_keep_empty_names(spark, rows):
    df = spark.sql(
        """select * from values (1, map('FPS', 12, 'Co-op', cast(null as int))), (2, map('FPS', 3, '', 4)),
           (3, null) t(appid, tags)"""
    )
    entries = normalize.map_entries(df, "appid", "tags")
    dim = normalize.dim_tags(entries)
    assert rows(dim) == [(1, "", 4), (2, "Co-op", 0), (3, "FPS", 15)]
    assert rows(normalize.bridge_tags(entries, dim)) == [(1, 2, 0), (1, 3, 12), (2, 1, 4), (2, 3, 3)]


def test_votes_as_text(spark, rows):
    df = spark.sql("select 1 appid, map('a', '7', 'b', 'x', 'c', '') tags")
    assert rows(normalize.map_entries(df, "appid", "tags")) == [(1, "a", 7), (1, "b", 0), (1, "c", 0)]


def test_game_count(spark, rows):
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "genre_id bigint, name string")
    links = spark.createDataFrame([(10, 1), (10, 1), (11, 1)], "game_appid int, genre_id bigint")
    assert rows(normalize.with_game_count(dim, links, "genre_id"), "genre_id", "game_count") == [(1, 2), (2, 0)]


def test_id_consistency(spark, rows):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (4, "w")], "id bigint, name string")
    b = a.withColumn("name", F.when(F.col("id") == 2, F.lit("Y")).otherwise(F.col("name"))).where("id <> 4")
    c = a.unionByName(spark.createDataFrame([(5, "v")], "id bigint, name string"))
    verdicts = normalize.id_consistency({"a": a, "b": b, "c": c}, "id")
    assert rows(verdicts, "id", "verdict") == [(1, "MATCH"), (2, "MISMATCH"), (3, "MATCH"), (4, "MISMATCH"), (5, "MISMATCH")]


def test_full_build_gives_the_fourteen_tables(spark):
    games = spark.sql(
        """select 1 appid, 'G' name, 9.99D price, 80 metacritic_score, 10 positive, 1 negative,
           60 average_playtime_forever, 0 discount, array('Dev') developers, array('Pub') publishers,
           array('Action') genres, array('Single') categories, map('FPS', 3) tags"""
    )
    reviews = spark.sql(
        """select 1 app_id, 7L review_id, 'english' language, 'good' review, true recommended, 2L votes_helpful,
           true steam_purchase, false written_during_early_access, timestamp'2021-01-01' timestamp_created,
           5L author_steamid, 3L author_num_games_owned, 4L author_num_reviews, 9.0D author_playtime_forever,
           8.0D author_playtime_at_review"""
    )
    tables = build_normalised(games, reviews, months_back=2)
    assert sorted(tables) == sorted(
        """developers publishers genres categories tags game_developers game_publishers game_genres game_categories
        game_tags user_profiles game_review_summary developer_stats game_price_history""".split()
    )
    counts = {name: df.count() for name, df in tables.items()}
    assert counts.pop("game_price_history") == 3
    assert set(counts.values()) == {1}
    assert tables["developer_stats"].first()["most_common_genre"] == "Action"
