"""Nested columns to dimension and bridge tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.ordering import dense_ids


def list_entries(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, name) per list element; a plain string counts as a one-element list.

    Null lists, null elements and empty names give no row.
    """
    items = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        items = F.array(items)
    return df.select(F.col(key).alias("game_appid"), F.explode(items).alias("name")).where("name <> ''")


def whole_number(votes: Column) -> Column:
    """Votes as an integer, fractions cut off; null where they are no number."""
    real = votes.try_cast("double")
    return F.coalesce(votes.try_cast("bigint"), F.when(F.abs(real) < F.lit(2.0**53), F.when(real < 0, F.ceil(real)).otherwise(F.floor(real))))


def map_entries(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, name, vote_count) per map entry; missing or unreadable votes count 0."""
    return df.select(F.col(key).alias("game_appid"), F.explode(F.col(column)).alias("name", "_votes")).select(
        "game_appid", "name", F.coalesce(whole_number(F.col("_votes")), F.lit(0)).alias("vote_count")
    )


def name_dimension(entries: DataFrame, id_col: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Distinct names with ids 1..n in code-point order."""
    names = entries.select("name").where("name <> ''").distinct()
    return dense_ids(names, "name", id_col).withColumns(dict(extra or {}))


def dim_developers(entries: DataFrame) -> DataFrame:
    return name_dimension(entries, "developer_id")


def dim_publishers(entries: DataFrame) -> DataFrame:
    return name_dimension(entries, "publisher_id")


def dim_genres(entries: DataFrame) -> DataFrame:
    return name_dimension(entries, "genre_id", {"description": F.lit(None).cast("string")})


def dim_categories(entries: DataFrame) -> DataFrame:
    return name_dimension(entries, "category_id", {"description": F.lit(None).cast("string")})


def dim_tags(entries: DataFrame) -> DataFrame:
    """Tags with their vote total; empty names are kept."""
    totals = entries.groupBy("name").agg(F.sum("vote_count").alias("total_votes"))
    return dense_ids(totals, "name", "tag_id").select("tag_id", "name", "total_votes")


def bridge(entries: DataFrame, dimension: DataFrame, id_col: str, distinct: bool = False) -> DataFrame:
    """(game_appid, id) per entry whose name is in the dimension.

    No broadcast is forced: the dimension is a stored table, so Spark knows its
    size and broadcasts it when small; otherwise adaptive execution splits the
    partitions of hot names.
    """
    linked = entries.join(dimension.select(id_col, "name"), "name").select("game_appid", id_col)
    return linked.distinct() if distinct else linked


def bridge_tags(entries: DataFrame, tags: DataFrame) -> DataFrame:
    return entries.join(tags.select("tag_id", "name"), "name").select("game_appid", "tag_id", "vote_count")


def with_game_count(dimension: DataFrame, bridge_table: DataFrame, id_col: str) -> DataFrame:
    """Distinct games per dimension entry, 0 where there is none."""
    counts = bridge_table.groupBy(id_col).agg(F.countDistinct("game_appid").alias("game_count"))
    return dimension.join(counts, id_col, "left").withColumn("game_count", F.coalesce("game_count", F.lit(0)))


def id_consistency(copies: Mapping[str, DataFrame], id_col: str, name: str = "name") -> DataFrame:
    """Compare every id over any number of copies of a dimension.

    One group per id instead of a chain of joins: MATCH needs exactly one row
    in every copy and the same name (nulls equal) in all of them.
    """
    rows = None
    for copy, df in copies.items():
        part = df.select(
            F.col(id_col),
            F.struct(F.col(name).alias("name")).alias("_value"),
            *[F.lit(int(copy == other)).alias(f"_in_{other}") for other in copies],
        )
        rows = part if rows is None else rows.unionByName(part)
    present = [F.sum(f"_in_{c}").alias(f"_in_{c}") for c in copies]
    once = F.lit(True)
    for c in copies:
        once = once & (F.col(f"_in_{c}") == 1)
    same = F.col("_low") == F.col("_high")
    return (
        rows.groupBy(id_col)
        .agg(F.min("_value").alias("_low"), F.max("_value").alias("_high"), *present)
        .select(
            id_col,
            F.col("_low.name").alias("name_low"),
            F.col("_high.name").alias("name_high"),
            F.when(once & same, F.lit("MATCH")).otherwise(F.lit("MISMATCH")).alias("verdict"),
        )
    )
