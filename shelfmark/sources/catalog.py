"""The catalogue-and-review model as views over the given tables.

``part`` plays the games, ``supplier`` the developers, ``lineitem`` the reviews
and the price history, ``events`` the users' reviews and the run log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Catalog:
    """Lazy views over one folder of parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._scans: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """The scan of one table; files and schema are looked up once."""
        if name not in self._scans:
            self._scans[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._scans[name]

    # -- games ---------------------------------------------------------------

    def games(self) -> DataFrame:
        return self._games().select(*self.GAME_COLUMNS)

    def games_nested(self) -> DataFrame:
        """Games with list columns: empty genres, null categories, empty publisher names."""
        return self._games()

    # Column names of the model.
    GAME_COLUMNS = (
        "appid", "name", "price", "metacritic_score", "positive", "negative", "average_playtime_forever", "discount",
    )

    def _games(self) -> DataFrame:
        size = F.col("p_size")
        words = F.split("p_name", " ")
        publisher = F.when(size % 11 == 0, F.lit("")).otherwise(F.concat_ws(" ", "p_brand", "p_type"))
        return self.table("part").select(
            F.col("p_partkey").alias("appid"),
            F.col("p_name").alias("name"),
            F.col("p_retailprice").alias("price"),
            size.alias("metacritic_score"),
            F.when(size % 3 != 0, size).alias("positive"),
            (size % 10).alias("negative"),
            (size * 60).alias("average_playtime_forever"),
            (size % 4 * 5).alias("discount"),
            F.when(size % 7 == 0, F.array().cast("array<string>")).otherwise(words).alias("genres"),
            F.when(size % 5 != 0, F.array("p_brand", "p_type")).alias("categories"),
            F.array(publisher).alias("publishers"),
        )

    def tag_map(self) -> DataFrame:
        """Games with a tag map: flag -> number of line items (three flags at most)."""
        votes = self.table("lineitem").groupBy("l_partkey", "l_returnflag").agg(F.count(F.lit(1)).cast("int").alias("n"))
        return votes.groupBy(F.col("l_partkey").alias("appid")).agg(
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("l_returnflag", "n")))).alias("tags")
        )

    def games_text(self) -> DataFrame:
        """The list columns as literal text, the way they arrive in a file."""

        def literal(items: Column) -> Column:
            return F.concat(F.lit("['"), F.array_join(items, "', '"), F.lit("']"))

        nested = self.games_nested()
        genres = F.when(F.size("genres") == 0, F.lit("[]")).otherwise(literal(F.col("genres")))
        votes = F.concat(
            F.lit("{'"), F.element_at("genres", 1), F.lit("': "), F.col("appid").cast("string"), F.lit(", 'rated': None}")
        )
        return nested.select(
            "appid",
            genres.alias("genres"),
            literal(F.col("categories")).alias("categories"),
            F.when(F.size("genres") > 0, votes).otherwise(F.lit("[]")).alias("tags"),
        )

    # -- developers ----------------------------------------------------------

    def developers(self) -> DataFrame:
        return self.table("supplier").select(F.col("s_suppkey").alias("developer_id"), F.col("s_name").alias("name"))

    def game_developers(self) -> DataFrame:
        return (
            self.table("lineitem")
            .select(F.col("l_partkey").alias("game_appid"), F.col("l_suppkey").alias("developer_id"))
            .distinct()
        )

    def developer_entries(self) -> DataFrame:
        """(game_appid, developer name), once per pair."""
        return self.game_developers().join(self.developers(), "developer_id").select("game_appid", "name")

    # -- reviews and prices --------------------------------------------------

    REVIEW_ORDER = (
        "review_id", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )

    def lines_with_review_id(self) -> DataFrame:
        """Line items with a review id that repeats, for the duplicate operators."""
        return self.table("lineitem").withColumn("review_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))

    def reviews(self) -> DataFrame:
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("review_id"),
            F.col("l_partkey").alias("app_id"),
            (F.col("l_returnflag") != "R").alias("recommended"),
            F.col("l_quantity").alias("votes_helpful"),
            F.col("l_extendedprice").alias("author_playtime_at_review"),
            F.col("l_linestatus").alias("language"),
            (F.col("l_discount") > 0).alias("steam_purchase"),
            (F.col("l_tax") == 0).alias("written_during_early_access"),
            F.col("l_shipdate").alias("timestamp_created"),
        )

    def user_reviews(self) -> DataFrame:
        k = event_number()
        known = F.when(k % 10 != 0, k)
        return self.table("events").select(
            F.col("event_id").alias("review_id"),
            F.col("user_id").alias("author_steamid"),
            F.col("ts").alias("timestamp_created"),
            F.col("event_type").isin("purchase", "signup").alias("recommended"),
            F.col("props").alias("review"),
            F.col("value").cast("bigint").alias("votes_helpful"),
            known.alias("author_num_games_owned"),
            (known + 1).alias("author_num_reviews"),
            (known * F.lit(1.5)).alias("author_playtime_forever"),
        )

    def price_history(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_partkey").alias("game_appid"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_discount").alias("discount"),
            F.col("l_shipdate").cast("date").alias("recorded_date"),
        )

    # -- run log -------------------------------------------------------------

    def executions(self) -> DataFrame:
        """Query executions: the event type is the test, the user modulo 4 the engine."""
        k = event_number()
        return self.table("events").select(
            F.col("event_type").alias("test_name"),
            F.concat(F.lit("engine_"), (F.col("user_id") % 4).cast("string")).alias("database"),
            F.col("event_id").alias("run_number"),
            F.col("value").alias("execution_time_ms"),
            k.cast("bigint").alias("row_count"),
            F.when(k % 10 == 0, F.concat(F.lit("failed with "), k.cast("string"))).alias("error"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        )


def event_number() -> Column:
    """The number ``k`` inside the JSON text of an event."""
    return F.get_json_object("props", "$.k").cast("int")
