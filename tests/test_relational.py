"""Report queries against the same SQL without limits, and the three forms against each other."""

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import documents, graph, relational


@pytest.fixture(scope="module")
def tables(spark):
    games = spark.range(40).select(
        F.col("id").alias("appid"), F.concat(F.lit("g"), "id").alias("name"), (F.col("id") % 7 + 18).cast("double").alias("price")
    )

    def links(n, step, id_col, hot):
        pairs = [(g, (g * step + i) % n + 1) for g in range(40) if g % 4 for i in range(g % 3)]
        pairs += [(hot, i + 1) for i in range(n)]
        return spark.createDataFrame(pairs, f"game_appid bigint, {id_col} bigint")

    def names(n, id_col, prefix):
        return spark.createDataFrame([(i + 1, f"{prefix}{i * 7 % n:02d}") for i in range(n)], f"{id_col} bigint, name string")

    return {
        "games": games,
        "bridges": [
            (links(30, 5, "developer_id", 5), names(30, "developer_id", "d"), "developer_id", "developer"),
            (links(12, 3, "genre_id", 5), names(12, "genre_id", "e"), "genre_id", "genre"),
            (links(9, 2, "category_id", 9), names(9, "category_id", "c"), "category_id", "category"),
        ],
    }


@pytest.mark.parametrize("limit", [1, 3, 17, 100, 1000, 100000])
def test_details_with_a_limit_are_a_prefix_of_all(tables, limit):
    everything = [tuple(r) for r in relational.game_details(tables["games"], tables["bridges"], 20, 23, None).collect()]
    assert len(everything) > 400
    got = [tuple(r) for r in relational.game_details(tables["games"], tables["bridges"], 20, 23, limit).collect()]
    assert got == everything[:limit]
    doc = [tuple(r) for r in documents.game_details(tables["games"], tables["bridges"], 20, 23, limit).collect()]
    assert doc == everything[:limit]


def test_the_three_forms_agree(tables, rows):
    games = tables["games"]
    patterns = [
        (graph.edges_from_bridge(b, "game_appid", key, "R", games, "appid", dim, key), dim, key, out)
        for b, dim, key, out in tables["bridges"]
    ]
    relational_rows = rows(relational.game_details(games, tables["bridges"], 20, 23, None).distinct())
    assert rows(graph.game_details(games, patterns, 20, 23, None)) == relational_rows
    bridge, dim, key, _ = tables["bridges"][1]
    assert rows(relational.count_by_genre(bridge.distinct(), dim)) == rows(graph.count_by_genre(patterns[1][0], dim))
    assert rows(relational.count_by_genre(bridge, dim)) == rows(documents.count_by_genre(bridge, dim))


def test_null_prices_never_match(spark):
    games = spark.createDataFrame([(1, "a", None), (2, "b", 60.0)], "appid int, name string, price double")
    assert [r.appid for r in relational.expensive_games(games, 50).collect()] == [2]
    assert relational.game_details(games, [], 0, 100, 10).count() == 1


def test_games_without_reviews_count_zero(spark):
    games = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "appid int, name string")
    reviews = spark.createDataFrame([(3, 10), (3, 11), (2, None)], "app_id int, review_id bigint")
    assert [tuple(r) for r in relational.most_reviewed(games, reviews).collect()] == [(3, "c", 2), (1, "a", 0), (2, "b", 0)]


def test_first_games_limit_comes_before_the_join(spark):
    games = spark.range(1, 50).select(F.col("id").alias("appid"), F.lit(1.0).alias("price"))
    reviews = spark.range(1, 50).select(F.col("id").alias("app_id"), F.lit(True).alias("recommended"), F.lit(2.345).alias("votes_helpful"))
    out = relational.review_stats_by_game(games, reviews, 100)
    assert out.count() == 20
    assert out.first()["avg_helpful_votes"] == 2.35
    assert relational.review_stats_by_game(games, reviews, 5).count() == 5


def test_a_few_games_reach_the_scan_as_a_range(spark, tmp_path):
    from shelfmark.sources.sinks import in_key_order

    games = spark.range(1000, 1050).select(F.col("id").alias("appid"), F.lit(1.0).alias("price"))
    reviews = spark.range(20000).select(
        (F.col("id") % 5000).alias("app_id"), "id", F.lit(True).alias("recommended"), F.lit(1.0).alias("votes_helpful")
    )
    in_key_order(reviews, "app_id", "id").write.parquet(str(tmp_path / "reviews"))
    stored = spark.read.parquet(str(tmp_path / "reviews"))
    out = relational.review_stats_by_game(games, stored, 100)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(app_id,1000)" in plan and "LessThanOrEqual(app_id,1019)" in plan
    assert out.agg(F.count("*"), F.sum("total_reviews")).first() == (20, 80)
    none = relational.review_stats_by_game(games.where("price > 5"), stored, 100)
    assert none.count() == 0
