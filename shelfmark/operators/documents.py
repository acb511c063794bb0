"""Document-pipeline operators (lookup, unwind, group) and queries written with them.

Reports of one table need neither; they have one form, in ``relational``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.scalars import first_item, round_half_up
from shelfmark.operators.relational import left_join, top


def lookup(
    left: DataFrame, right: DataFrame, local: str, foreign: str, into: str, fields: Sequence[str] | None = None
) -> DataFrame:
    """Left nest join: one row per left row, its matches as a sorted array, empty where there are none.

    The array of a key is as large as its matches.  Where only their number or
    the first one is wanted, ``lookup_summary`` builds no array, and where they
    are unwound at once, ``lookup_unwind`` is a join.
    """
    fields = list(fields or right.columns)
    nested = (
        right.where(F.col(foreign).isNotNull())
        .select(F.col(foreign).alias("_foreign"), F.struct(*fields).alias("_item"))
        .groupBy("_foreign")
        .agg(F.sort_array(F.collect_list("_item")).alias(into))
    )
    items = F.coalesce(F.col(into), F.array().cast(nested.schema[into].dataType))
    joined = left.join(nested, F.col(local) == F.col("_foreign"), "left")
    return joined.select(*left.columns, items.alias(into))


def lookup_summary(
    left: DataFrame, right: DataFrame, local: str, foreign: str, size: str, first: str, fields: Sequence[str] | None = None
) -> DataFrame:
    """Size and first item of what ``lookup`` would nest, from aggregates that combine before the shuffle."""
    fields = list(fields or right.columns)
    summed = (
        right.where(F.col(foreign).isNotNull())
        .groupBy(F.col(foreign).alias("_foreign"))
        .agg(F.count(F.lit(1)).alias(size), F.min(F.struct(*fields)).alias(first))
    )
    joined = left.join(summed, F.col(local) == F.col("_foreign"), "left")
    return joined.select(*left.columns, F.coalesce(size, F.lit(0)).alias(size), first)


def lookup_unwind(
    left: DataFrame,
    right: DataFrame,
    local: str,
    foreign: str,
    into: str,
    fields: Sequence[str] | None = None,
    keep_empty: bool = False,
) -> DataFrame:
    """Lookup followed by unwind: a join that carries the match as a struct.

    No array is built, so hot keys are an ordinary join that adaptive
    execution can split.
    """
    match = right.select(F.col(foreign).alias("_foreign"), F.struct(*(fields or right.columns)).alias(into))
    if keep_empty:
        return left_join(left, match, local, "_foreign").drop("_foreign")
    return left.join(match, F.col(local) == F.col("_foreign")).drop("_foreign")


def unwind(df: DataFrame, path: str, keep_empty: bool = False) -> DataFrame:
    """One row per array element; rows without elements go, or stay with null."""
    explode = F.explode_outer if keep_empty else F.explode
    others = [F.col(c) for c in df.columns if c != path]
    return df.select(*others, explode(path).alias(path))


def array_first(df: DataFrame, path: str, alias: str) -> DataFrame:
    return df.withColumn(alias, first_item(F.col(path)))


def array_size(df: DataFrame, path: str, alias: str) -> DataFrame:
    """Element count as a bigint; null arrays count 0."""
    return df.withColumn(alias, F.coalesce(F.array_size(path), F.lit(0)).cast("bigint"))



def count_by_genre(game_genres: DataFrame, genres: DataFrame, limit: int | None = 100) -> DataFrame:
    links = game_genres.groupBy("genre_id").agg(F.count(F.lit(1)).alias("links"))
    rows = (
        lookup_unwind(links, genres, "genre_id", "genre_id", "genre_info", ["name"])
        .groupBy(F.col("genre_info.name").alias("genre"))
        .agg(F.sum("links").alias("game_count"))
    )
    return top(rows, [F.desc("game_count"), F.asc("genre")], limit)


def games_with_developers(
    games: DataFrame, game_developers: DataFrame, developers: DataFrame, min_price: float, limit: int | None = 100
) -> DataFrame:
    matched = games.where(F.col("price") > min_price).select("appid", "name")
    linked = lookup_unwind(matched, game_developers, "appid", "game_appid", "dev_links", ["developer_id"])
    flat = linked.select("appid", "name", "dev_links.developer_id")
    named = lookup_unwind(flat, developers, "developer_id", "developer_id", "dev_info", ["name"])
    rows = named.select("appid", F.col("name").alias("game_name"), F.col("dev_info.name").alias("developer"))
    return top(rows, [F.asc("appid"), F.asc("developer")], limit)



def developer_statistics(
    stats: DataFrame, developers: DataFrame, min_games: int = 3, limit: int | None = 100
) -> DataFrame:
    matched = stats.where(F.col("total_games") >= min_games)
    rows = lookup_unwind(matched, developers, "developer_id", "developer_id", "dev_info", ["name"]).select(
        "developer_id",
        F.col("dev_info.name").alias("developer_name"),
        "total_games",
        round_half_up(F.col("avg_game_price")).alias("avg_price"),
        "total_positive_reviews",
        "total_negative_reviews",
    )
    return top(rows, [F.desc("total_games"), F.asc("developer_name")], limit)



def game_details(
    games: DataFrame,
    bridges: Sequence[tuple[DataFrame, DataFrame, str, str]],
    low: float,
    high: float,
    limit: int | None = 100,
) -> DataFrame:
    """Links and names looked up and unwound, keeping games without any.

    Every step is lookup, unwind that keeps the empty, lookup of the name, and
    its first item; the sort fields are added last.  With a limit the games are
    cut first, as each leads to a row at least.
    """
    rows = games.where(F.col("price").between(low, high)).select("appid", F.col("name").alias("game_name"))
    if limit is not None:
        rows = top(rows, [F.asc("appid")], limit)
    for table, dimension, id_col, out in bridges:
        linked = lookup_unwind(rows, table, "appid", "game_appid", "_link", [id_col], keep_empty=True)
        flat = linked.select(*rows.columns, F.col(f"_link.{id_col}").alias("_id"))
        named = lookup_unwind(flat, dimension, "_id", id_col, "_info", ["name"], keep_empty=True)
        rows = named.select(*rows.columns, F.col("_info.name").alias(out))
        if limit is not None:
            rows = top(rows, [F.coalesce(F.col(c), F.lit("")) if c in [b[3] for b in bridges] else F.col(c) for c in rows.columns if c != "game_name"], limit)
    names = [out for *_, out in bridges]
    keyed = rows.withColumns({f"_sort_{n}": F.coalesce(F.col(n), F.lit("")) for n in names})
    return top(keyed, [F.asc("appid"), *[F.asc(f"_sort_{n}") for n in names]], limit).select("appid", "game_name", *names)
