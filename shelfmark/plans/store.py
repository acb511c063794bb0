"""The normalised tables, built once per session and folder and read back as parquet."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelfmark.operators import normalize, summaries
from shelfmark.session import bound_tasks, scratch_root, size_shuffles
from shelfmark.sources.catalog import Catalog
from shelfmark.sources.sinks import in_key_order, prepared

# Base date of the snapshot series built with the store.
SNAPSHOT_BASE = "2024-06-30"


#: Dimensions of names in list columns: id column and the function that makes them.
LISTS: Mapping[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "developers": ("developer_id", normalize.dim_developers),
    "publishers": ("publisher_id", normalize.dim_publishers),
    "genres": ("genre_id", normalize.dim_genres),
    "categories": ("category_id", normalize.dim_categories),
}

#: The derived tables, each after the ones that it reads.
DERIVED = (
    *(table for column in LISTS for table in (column, f"game_{column}")),
    "tags", "game_tags", "user_profiles", "game_review_summary", "developer_stats", "game_price_history",
)


@dataclass(frozen=True)
class Sources:
    """What the derived tables are made of, read when a table needs it."""

    entries: Callable[[str], DataFrame]  # (game_appid, name) of a list column
    tag_entries: Callable[[], DataFrame]
    games: Callable[[], DataFrame]
    reviews: Callable[[], DataFrame]
    user_reviews: Callable[[], DataFrame]


def derived_table(name: str, sources: Sources, table: Callable[[str], DataFrame], base_date: str = SNAPSHOT_BASE, months_back: int = 12) -> DataFrame:
    """One derived table; ``table`` gives the finished ones that it reads."""
    if name in LISTS:
        return LISTS[name][1](sources.entries(name))
    column = name.removeprefix("game_")
    if name != column and column in LISTS:
        return normalize.bridge(sources.entries(column), table(column), LISTS[column][0])
    build: dict[str, Callable[[], DataFrame]] = {
        "tags": lambda: normalize.dim_tags(sources.tag_entries()),
        "game_tags": lambda: normalize.bridge_tags(sources.tag_entries(), table("tags")),
        "user_profiles": lambda: summaries.user_profiles(sources.user_reviews()),
        "game_review_summary": lambda: summaries.game_review_summary(sources.reviews()),
        "developer_stats": lambda: summaries.developer_stats(sources.games(), table("game_developers")),
        "game_price_history": lambda: summaries.snapshot_spine(sources.games(), "appid", "price", base_date, months_back, discount="discount"),
    }
    return build[name]()


def build_normalised(
    games: DataFrame,
    reviews: DataFrame,
    user_reviews: DataFrame | None = None,
    base_date: str = SNAPSHOT_BASE,
    keep: Callable[[str, DataFrame], DataFrame] | None = None,
    months_back: int = 12,
) -> dict[str, DataFrame]:
    """The 14 derived tables in dependency order.

    ``games`` carries the list columns, ``reviews`` the per-game columns and
    ``user_reviews`` (``reviews`` by default) the author columns.  ``keep``
    stores a finished table and returns the stored frame; dimensions and
    bridges are used by later tables, so storing them cuts their lineage.
    """
    sources = Sources(
        entries=lambda column: normalize.list_entries(games, "appid", column),
        tag_entries=lambda: normalize.map_entries(games, "appid", "tags"),
        games=lambda: games,
        reviews=lambda: reviews,
        user_reviews=lambda: user_reviews if user_reviews is not None else reviews,
    )
    tables: dict[str, DataFrame] = {}
    for name in DERIVED:
        built = derived_table(name, sources, tables.__getitem__, base_date, months_back)
        tables[name] = keep(name, built) if keep else built
    return tables


class Store:
    """Normalised tables over a :class:`Catalog`, each built at its first use."""

    def __init__(self, spark: SparkSession, folder: str, root: str | None = None):
        self.spark = spark
        self.catalog = Catalog(spark, folder)
        tag = hashlib.sha1(self.catalog.folder.encode()).hexdigest()[:12]
        self.root = root or f"{scratch_root(spark)}/store-{tag}"
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = prepared(self.spark, self.root, name, lambda: self._build(name))
        return self._tables[name]

    # Tables that reports read for a few games are stored in game order; the
    # second key splits a game with very many rows.
    KEY_ORDER: Mapping[str, Sequence[str]] = {
        "reviews": ("app_id", "review_id"),
        "prices": ("game_appid", "recorded_date", "price"),
        "game_developers": ("game_appid", "developer_id"),
        "game_publishers": ("game_appid", "publisher_id"),
        "game_genres": ("game_appid", "genre_id"),
        "game_categories": ("game_appid", "category_id"),
        "game_tags": ("game_appid", "tag_id"),
    }

    def _build(self, name: str) -> DataFrame:
        given = {"games": self.catalog.games, "reviews": self.catalog.reviews, "prices": self.catalog.price_history}
        table = given[name]() if name in given else derived_table(name, self.sources(), self.table)
        return in_key_order(table, *self.KEY_ORDER[name]) if name in self.KEY_ORDER else table

    def sources(self) -> Sources:
        return Sources(
            entries=self._entries,
            tag_entries=lambda: normalize.map_entries(self.catalog.tag_map(), "appid", "tags"),
            games=self.catalog.games_nested,
            reviews=self.catalog.reviews,
            user_reviews=self.catalog.user_reviews,
        )

    def _entries(self, column: str) -> DataFrame:
        if column == "developers":
            return self.catalog.developer_entries()
        return normalize.list_entries(self.catalog.games_nested(), "appid", column)

    # Tables of one step do not read each other.
    STEPS: Sequence[Sequence[str]] = (
        ("games", "reviews", "prices", "developers", "publishers", "genres", "categories", "tags", "user_profiles", "game_review_summary",
         "game_price_history"),
        ("game_developers", "game_publishers", "game_genres", "game_categories", "game_tags"),
        ("developer_stats",),
    )

    def build_all(self, jobs: int = 4) -> None:
        """Build every table; small tables of a step share the cluster, ``jobs`` at a time."""
        with ThreadPoolExecutor(jobs) as pool:
            for step in self.STEPS:
                list(pool.map(self.table, step))

    def register_views(self, prefix: str = "") -> None:
        """Temporary views, so the queries can also be written as SQL text."""
        for name in (name for step in self.STEPS for name in step):
            self.table(name).createOrReplaceTempView(f"{prefix}{name}")


_stores: dict[tuple[str, str], Store] = {}


def open_store(spark: SparkSession, folder: str) -> Store:
    """The store of this application for a folder."""
    bound_tasks(spark)
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _stores:
        size_shuffles(spark, folder)
        _stores[key] = Store(spark, folder)
    return _stores[key]
