"""The analytical queries as joins and aggregates over the normalised tables.

``limit`` is the size of the report; every query orders its rows totally first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.scalars import exact_mean, round_half_up, true_count
from shelfmark.session import BROADCAST_ROWS, materialise


def top(df: DataFrame, order: Sequence[Column], limit: int | None) -> DataFrame:
    """Ordered report; a limit turns the sort into a per-task top-k."""
    ordered = df.orderBy(*order)
    return ordered.limit(limit) if limit is not None else ordered


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a frame that cannot exceed ``rows``, if that is few enough."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def expensive_games(games: DataFrame, min_price: float, limit: int | None = 100) -> DataFrame:
    rows = games.where(F.col("price") > min_price).select("appid", "name", "price")
    return top(rows, [F.desc("price"), F.asc("appid")], limit)


def count_by_genre(game_genres: DataFrame, genres: DataFrame, limit: int | None = 100) -> DataFrame:
    """Links are counted per id before names are joined, so the join sees one row per genre."""
    per_id = game_genres.groupBy("genre_id").agg(F.count(F.lit(1)).alias("_links"))
    counts = (
        per_id.join(genres.select("genre_id", "name"), "genre_id")
        .groupBy(F.col("name").alias("genre"))
        .agg(F.sum("_links").alias("game_count"))
    )
    return top(counts, [F.desc("game_count"), F.asc("genre")], limit)


def games_with_developers(
    games: DataFrame, game_developers: DataFrame, developers: DataFrame, min_price: float, limit: int | None = 100
) -> DataFrame:
    chosen = games.where(F.col("price") > min_price).select("appid", F.col("name").alias("game_name"))
    rows = (
        chosen.join(game_developers, F.col("appid") == F.col("game_appid"))
        .join(developers.select("developer_id", F.col("name").alias("developer")), "developer_id")
        .select("appid", "game_name", "developer")
    )
    return top(rows, [F.asc("appid"), F.asc("developer")], limit)


def first_games(games: DataFrame, min_price: float, n: int) -> DataFrame:
    """Ids of the first ``n`` games above a price, in id order."""
    return games.where(F.col("price") > min_price).select("appid").orderBy("appid").limit(n)


def id_bounds(ids: DataFrame, key: str) -> Column:
    """Condition that ``key`` lies between the smallest and largest of a short list of ids.

    A literal range reaches the scan.  Over tables stored in key order it skips
    all files and row groups of other keys, as an index would; the exact join
    with the ids still follows.
    """
    low, high = ids.agg(F.min(ids.columns[0]), F.max(ids.columns[0])).first()
    return F.lit(False) if low is None else F.col(key).between(low, high)


# Ids that a scan may be given as a literal list.
LISTED = 1000


def restriction(chosen: DataFrame, rows: int) -> Callable[[DataFrame, str], DataFrame]:
    """How to restrict a table to the games of ``chosen``, which has at most ``rows`` of them.

    A short list of ids is fetched once and reaches every scan as literals,
    which skips files and row groups as an index would.  A longer one is
    stored once, and joined.
    """
    ids = chosen.select(F.col("appid").alias("_id"))
    if rows <= LISTED:
        listed = [r["_id"] for r in ids.collect()]
        low, high = min(listed, default=0), max(listed, default=0)
        return lambda table, key: table.where(F.col(key).between(low, high) & F.col(key).isin(listed))
    stored = materialise(ids, "chosen")

    def joined(table: DataFrame, key: str) -> DataFrame:
        return table.where(id_bounds(stored, key)).join(small(stored, rows), F.col(key) == F.col("_id"), "left_semi")

    return joined


def review_aggregates(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("app_id").agg(
        F.count(F.lit(1)).alias("total_reviews"),
        true_count(F.col("recommended")).alias("positive_reviews"),
        round_half_up(exact_mean(F.col("votes_helpful"))).alias("avg_helpful_votes"),
    )


def review_stats_by_game(
    games: DataFrame, reviews: DataFrame, limit: int | None = 100, min_price: float = 0, games_limit: int = 20
) -> DataFrame:
    n = games_limit if limit is None else min(games_limit, limit)
    only = restriction(first_games(games, min_price, n), n)
    stats = review_aggregates(only(reviews, "app_id"))
    return top(stats, [F.desc("total_reviews"), F.asc("app_id")], limit)


def semi_join_reviews(games: DataFrame, reviews: DataFrame, min_price: float = 0) -> DataFrame:
    """Reviews of all games above a price, the ids coming from a query instead of a literal list."""
    chosen = games.where(F.col("price") > min_price).select("appid")
    return reviews.join(chosen, F.col("app_id") == F.col("appid"), "left_semi")


def developer_statistics(
    stats: DataFrame, developers: DataFrame, min_games: int = 3, limit: int | None = 100
) -> DataFrame:
    rows = (
        stats.where(F.col("total_games") >= min_games)
        .join(developers.select("developer_id", F.col("name").alias("developer_name")), "developer_id")
        .select(
            "developer_id",
            "developer_name",
            "total_games",
            round_half_up(F.col("avg_game_price")).alias("avg_price"),
            "total_positive_reviews",
            "total_negative_reviews",
        )
    )
    return top(rows, [F.desc("total_games"), F.asc("developer_name")], limit)


def price_history_analysis(history: DataFrame, limit: int | None = 100) -> DataFrame:
    price = F.col("price")
    stats = history.groupBy("game_appid").agg(
        F.count(F.lit(1)).alias("price_points"),
        round_half_up(F.min(price)).alias("min_price"),
        round_half_up(F.max(price)).alias("max_price"),
        round_half_up(exact_mean(price)).alias("avg_price"),
    )
    return top(stats, [F.desc("price_points"), F.asc("game_appid")], limit)


def detail_order(*names: str) -> list[Column]:
    """Report order of game details; missing names sort as empty text."""
    return [F.asc("appid"), *[F.coalesce(F.col(n), F.lit("")).asc() for n in names]]


def left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join that leaves both sides free to be split where a key is hot.

    Adaptive execution never splits the optional side of an outer join.  The
    matches are therefore an inner join, and left rows without one are added
    by an anti join against the distinct keys.
    """
    same = F.col(left_key) == F.col(right_key)
    matched = left.join(right, same)
    alone = left.join(right.select(right_key).distinct(), same, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def game_details(
    games: DataFrame,
    bridges: Sequence[tuple[DataFrame, DataFrame, str, str]],
    low: float,
    high: float,
    limit: int | None = 100,
) -> DataFrame:
    """Games with every combination of their names, unmatched games kept.

    ``bridges`` lists (bridge, dimension, id column, output column) in sort
    order; ``appid`` must be unique in ``games``.

    Output rows are ordered by game and then by these names, and every game
    and every name of it leads to at least one row.  So the first ``limit``
    output rows can only come from the first ``limit`` games, from the first
    ``limit`` names of a game, and from the first ``limit`` rows after each
    join.  Cutting there is exact, and no fan-out larger than the report is
    ever built.
    """
    names = [out for *_, out in bridges]
    rows = games.where(F.col("price").between(low, high)).select("appid", F.col("name").alias("game_name"))
    if limit is not None:
        only = restriction(top(rows, detail_order(), limit), limit)
        rows = only(rows, "appid")
    chosen = rows.select(F.col("appid").alias("game_appid"))
    for step, (table, dimension, id_col, out) in enumerate(bridges, start=1):
        links = table.select("game_appid", id_col)
        links = links.join(chosen, "game_appid", "left_semi") if limit is None else only(links, "game_appid")
        named = links.join(dimension.select(id_col, F.col("name").alias(out)), id_col, "left").drop(id_col)
        if limit is None:
            # A null name for games without links turns the left join into an
            # inner one, whose hot keys adaptive execution can split.
            alone = chosen.join(links.select("game_appid").distinct(), "game_appid", "left_anti")
            named = named.unionByName(alone.withColumn(out, F.lit(None).cast("string")))
        else:
            per_game = Window.partitionBy("game_appid").orderBy(F.coalesce(F.col(out), F.lit("")))
            named = named.withColumn("_rank", F.row_number().over(per_game)).where(F.col("_rank") <= limit).drop("_rank")
        how = "inner" if limit is None else "left"
        rows = rows.join(named, F.col("appid") == F.col("game_appid"), how).drop("game_appid")
        if limit is not None and step < len(bridges):
            rows = top(rows, detail_order(*names[:step]), limit)
    return top(rows.select("appid", "game_name", *names), detail_order(*names), limit)


def games_by_genre_and_developer(
    games: DataFrame,
    game_genres: DataFrame,
    genres: DataFrame,
    game_developers: DataFrame,
    developers: DataFrame,
    wanted: Sequence[str],
    limit: int | None = 100,
) -> DataFrame:
    chosen = genres.where(F.col("name").isin(list(wanted))).select("genre_id", F.col("name").alias("genre"))
    tagged = game_genres.join(chosen, "genre_id")
    if limit is not None:
        # Rows come in game order: the first tagged games that have a developer hold the whole report.
        linked = tagged.join(game_developers.select("game_appid"), "game_appid", "left_semi")
        linked = linked.join(games.select(F.col("appid").alias("game_appid")), "game_appid", "left_semi")
        first = small(top(linked.select("game_appid").distinct(), [F.asc("game_appid")], limit), limit)
        tagged = tagged.join(first, "game_appid", "left_semi")
    rows = (
        tagged.join(games.select(F.col("appid").alias("game_appid"), F.col("name").alias("game_name"), "price"), "game_appid")
        .join(game_developers, "game_appid")
        .join(developers.select("developer_id", F.col("name").alias("developer")), "developer_id")
        .select("game_appid", "game_name", "genre", "developer", "price")
    )
    return top(rows, [F.asc("game_appid"), F.asc("genre"), F.asc("developer")], limit)


def games_with_summary(
    games: DataFrame, summary: DataFrame, min_reviews: int, limit: int | None = 100
) -> DataFrame:
    rows = (
        games.select("appid", "name", "price")
        .join(summary, F.col("appid") == F.col("game_appid"))
        .where(F.col("total_reviews") > min_reviews)
        .select("appid", "name", "price", "total_reviews", "positive_reviews", "negative_reviews")
    )
    return top(rows, [F.asc("appid")], limit)


def most_reviewed(games: DataFrame, reviews: DataFrame, limit: int | None = 20) -> DataFrame:
    """Reviews are counted before the join; games without any count 0."""
    counts = reviews.groupBy("app_id").agg(F.count("review_id").alias("review_count"))
    rows = (
        games.select("appid", "name")
        .join(counts, F.col("appid") == F.col("app_id"), "left")
        .select("appid", "name", F.coalesce("review_count", F.lit(0)).alias("review_count"))
    )
    return top(rows, [F.desc("review_count"), F.asc("appid")], limit)
