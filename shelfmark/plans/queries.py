"""One registered query per operator: (session, folder) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.scalars import round_half_up
from shelfmark.operators import clean, digests, documents, graph, normalize, reconcile, registry, relational, runstats, sketches, summaries
from shelfmark.operators.ordering import mode_per_key
from shelfmark.plans.store import DERIVED, SNAPSHOT_BASE, Store, build_normalised, open_store
from shelfmark.session import materialise, scratch_path, spread, tune
from shelfmark.sources import csv_files, partitioned, sinks
from shelfmark.sources.catalog import event_number
from shelfmark.sources.datasets import DATASETS, column_types

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

# Thresholds that suit the given tables, whose prices start at 900.
EXPENSIVE = 910
RANGE = (905, 915)
MANY_GAMES = 500
MANY_REVIEWS = 30
WANTED_GENRES = ("red", "gear")


def portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so that results compare across engines."""
    moment = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    patterns = {T.DateType: "yyyy-MM-dd", T.TimestampType: moment, T.TimestampNTZType: moment}
    return df.withColumns(
        {f.name: F.date_format(f.name, patterns[type(f.dataType)]) for f in df.schema if type(f.dataType) in patterns}
    )


def query(name: str) -> Callable[[Callable[[Store], DataFrame]], Callable[[Store], DataFrame]]:
    def register(build: Callable[[Store], DataFrame]) -> Callable[[Store], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return portable(build(open_store(tune(spark), folder)))

        run.__name__ = name
        run.__doc__ = build.__doc__
        REGISTRY[name] = run
        return build

    return register


# -- sources and sinks ---------------------------------------------------------

DOCUMENT_TYPES = column_types("doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")


@query("csv_scan")
def csv_scan(store: Store) -> DataFrame:
    """Documents as CSV with quoted line breaks, read back by the splitting scan."""
    path = scratch_path(store.spark, "documents-csv")
    sinks.write_csv(store.catalog.table("documents"), path)
    return csv_files.read_large_csv(store.spark, path, DOCUMENT_TYPES)


@query("dataset_definitions")
def dataset_definitions(store: Store) -> DataFrame:
    """Parts under the column names of the completion times, imported with that dataset's definition."""
    path = scratch_path(store.spark, "hltb-csv")
    source = store.catalog.table("part").select(
        F.col("p_partkey").alias("game_game_id"), F.col("p_name").alias("game_game_name"), F.col("p_size").alias("game_comp_main")
    )
    sinks.write_csv(source, path)
    return csv_files.read_large_csv(store.spark, path, DATASETS["hltb"].types)


def table_state(store: Store, table: str, step: str) -> DataFrame:
    """One row: whether the table exists, whether it is empty, and its row count."""
    there = store.spark.catalog.tableExists(table)
    rows = store.spark.table(table).count() if there else 0
    empty = sinks.tables_empty(store.spark, [table])
    return store.spark.createDataFrame([(step, there, empty, rows)], "step string, present boolean, is_empty boolean, row_count bigint")


@query("table_lifecycle")
def table_lifecycle(store: Store) -> DataFrame:
    """A target table before it exists, loaded, truncated and dropped."""
    table = f"lifecycle_{uuid.uuid4().hex}"
    states = [table_state(store, table, "absent")]
    sinks.append_table(store.catalog.games().select("appid", "name"), table)
    states.append(table_state(store, table, "loaded"))
    sinks.truncate_tables(store.spark, [table])
    states.append(table_state(store, table, "truncated"))
    sinks.drop_tables(store.spark, [table])
    states.append(table_state(store, table, "dropped"))
    return states[0].unionByName(states[1]).unionByName(states[2]).unionByName(states[3])


@query("targets_empty")
def targets_empty(store: Store) -> DataFrame:
    """Which document targets and node labels hold nothing."""
    path = scratch_path(store.spark, "targets")
    games = store.catalog.games()
    sinks.write_documents(games.select("appid", "name"), f"{path}/games")
    sinks.write_documents(games.where("appid < 0").select("appid", "name"), f"{path}/lost")
    documents_of = {name: f"{path}/{name}" for name in ("games", "lost", "absent")}
    found = sinks.documents_empty(store.spark, documents_of)
    return found.unionByName(sinks.labels_empty(graph_nodes(store), ["Game", "GameGenre", "GameTag"]))


@query("checkpoint_roundtrip")
def checkpoint_roundtrip(store: Store) -> DataFrame:
    root = scratch_path(store.spark, "prepared")
    sinks.prepared(store.spark, root, "reviews", store.catalog.reviews)
    return sinks.prepared(store.spark, root, "reviews", store.catalog.reviews)


@query("append_table")
def append_table(store: Store) -> DataFrame:
    """Two appends to one table; the list columns travel as JSON text."""
    table = f"appended_{uuid.uuid4().hex}"
    path = scratch_path(store.spark, "append")
    games = store.catalog.games_nested().select("appid", "name", "price", "genres")
    cheap = F.coalesce(F.col("price") <= EXPENSIVE, F.lit(False))
    for part in (games.where(cheap), games.where(~cheap)):
        sinks.append_table(part, table, json_columns=["genres"], column_types={"name": "string"}, path=path)
    sinks.drop_tables(store.spark, [table])  # the catalogue entry; the files stay
    return store.spark.read.parquet(path)


@query("append_loads")
def append_loads(store: Store) -> DataFrame:
    """Two loads into one table, the first of them written twice."""
    path = scratch_path(store.spark, "loads")
    games = store.catalog.games().select("appid", "name", "price")
    cheap = F.coalesce(F.col("price") <= EXPENSIVE, F.lit(False))
    for load, part in (("cheap", games.where(cheap)), ("other", games.where(~cheap)), ("cheap", games.where(cheap))):
        partitioned.append_load(part, path, load)
    return store.spark.read.parquet(path)


@query("checkpoint_fingerprint")
def checkpoint_fingerprint(store: Store) -> DataFrame:
    """Builds of one prepared frame: from the same files, with another parameter, and after files have come."""
    root, source = scratch_path(store.spark, "versions"), scratch_path(store.spark, "versioned-source")
    part = store.catalog.table("part").select("p_partkey", "p_name")
    built: list[str] = []

    def step(name: str, parameters: dict[str, object]) -> DataFrame:
        def build() -> DataFrame:
            built.append(name)
            return store.spark.read.parquet(source)

        known = sinks.source_fingerprint(store.spark, source, parameters)
        rows = sinks.prepared(store.spark, root, "parts", build, fingerprint=known).agg(F.count(F.lit(1)).alias("row_count"))
        return rows.select(F.lit(name).alias("step"), F.lit(name in built).alias("built"), "row_count")

    part.where("p_partkey % 2 = 0").write.parquet(source)
    steps = [step("first", {}), step("again", {}), step("parameter", {"limit": 5})]
    part.where("p_partkey % 2 = 1").write.mode("append").parquet(source)
    steps += [step("files", {}), step("files again", {})]
    out = steps[0]
    for more in steps[1:]:
        out = out.unionByName(more)
    return out


@query("document_sink")
def document_sink(store: Store) -> DataFrame:
    path = scratch_path(store.spark, "games-json")
    games = store.catalog.games_nested().select("appid", "name", "price", "genres", "categories")
    sinks.write_documents(games, path, batch_size=5000)
    back = store.spark.read.schema(games.schema).json(path)
    return back.select(
        "appid",
        "name",
        "price",
        F.array_join("genres", "|").alias("genres"),
        F.array_join("categories", "|").alias("categories"),
    )


@query("report_sink")
def report_sink(store: Store) -> DataFrame:
    log = runstats.run_log(store.catalog.executions())
    stats = runstats.run_statistics(log).select("test_name", "database", "min_ms", "max_ms", "successes", "failures")
    path = scratch_path(store.spark, "report")
    sinks.write_reports(log, stats, path)
    # All three outputs are read back: statistics, the raw log, and one document per test.
    back = store.spark.read.schema(stats.schema).csv(f"{path}/statistics", header=True)
    raw = csv_files.read_large_csv(store.spark, f"{path}/raw_results", RUN_LOG_TYPES)  # errors may have line breaks
    logged = raw.groupBy("test_name", "database").agg(F.count(F.lit(1)).alias("logged_runs"))
    results = store.spark.read.json(f"{path}/test_results").select(F.col("name").alias("test_name"), F.size("results").cast("bigint").alias("results"))
    return back.join(logged, ["test_name", "database"], "left").join(results, "test_name", "left")


@query("row_count_audit")
def row_count_audit(store: Store) -> DataFrame:
    return sinks.row_count_audit({n: store.table(n) for n in DERIVED})


@query("build_normalised")
def normalised(store: Store) -> DataFrame:
    """Row counts of the 14 tables, built from games with their lists as prepared files have them."""
    catalog = store.catalog
    developers = catalog.developer_entries().groupBy(F.col("game_appid").alias("appid")).agg(F.sort_array(F.collect_set("name")).alias("developers"))
    games = catalog.games_nested().join(developers, "appid", "left").join(catalog.tag_map(), "appid", "left")
    games = materialise(games, "games-with-lists")
    tables = build_normalised(games, catalog.reviews(), catalog.user_reviews(), keep=lambda name, df: materialise(df, name))
    return sinks.row_count_audit(tables)


# -- cleaning --------------------------------------------------------------------


@query("rename_columns")
def rename_columns(store: Store) -> DataFrame:
    raw = store.catalog.user_reviews().select(
        "review_id",
        F.col("author_steamid").alias("author.steamid"),
        F.col("author_num_games_owned").alias("author.num_games_owned"),
        F.col("author_num_reviews").alias("author.num_reviews"),
        F.col("author_playtime_forever").alias("author.playtime_forever"),
    )
    return clean.rename_columns(raw, clean.AUTHOR_COLUMNS)


@query("drop_index_column")
def drop_index_column(store: Store) -> DataFrame:
    raw = store.catalog.table("events").select(F.col("event_id").alias("_c0"), "event_id", "event_type", "value")
    return clean.drop_index_column(raw)


@query("parse_nested_columns")
def parse_nested_columns(store: Store) -> DataFrame:
    types = {"genres": "array<string>", "categories": "array<string>", "tags": "map<string,int>"}
    parsed = clean.parse_nested_columns(spread(store.catalog.games_text()), types)
    return parsed.select(
        "appid",
        F.array_join("genres", "|").alias("genres"),
        F.array_join("categories", "|").alias("categories"),
        F.array_join(F.map_keys("tags"), "|").alias("tag_names"),
        F.array_join(F.map_values("tags").cast("array<string>"), "|", "none").alias("tag_votes"),
    )


@query("parse_literal_forms")
def parse_literal_forms(store: Store) -> DataFrame:
    """The names of the parts in the many spellings of a literal, and their sizes as a dict of numbers."""
    words, size = F.split("p_name", " "), F.col("p_size").cast("string")
    escaped = F.transform(words, lambda w: F.concat(F.lit("'\\x"), F.lower(F.hex(F.substring(w, 1, 1))), F.substring(w, F.lit(2), F.length(w)), F.lit("'")))
    sided = F.transform(words, lambda w: F.concat(F.lit("'"), F.substring(w, 1, 1), F.lit("' u\""), F.substring(w, F.lit(2), F.length(w)), F.lit('"')))
    raw = F.transform(words, lambda w: F.concat(F.lit("r'''"), w, F.lit("'''")))
    form = F.col("p_partkey") % 5
    names = (
        F.when(form == 0, F.concat(F.lit("("), F.array_join(escaped, ", "), F.lit(",)")))
        .when(form == 1, F.concat(F.lit("["), F.array_join(sided, ","), F.lit(" , ]")))
        .when(form == 2, F.array_join(raw, ", "))
        .when(form == 3, F.concat(F.lit("{"), F.array_join(escaped, ","), F.lit("}")))
        .otherwise(F.concat(F.lit("["), F.array_join(words, ", "), F.lit("]")))  # no literal
    )
    numbers = F.concat(F.lit("{'tens': "), size, F.lit("_0, 'hex': 0x"), F.hex("p_size"), F.lit(", 'pair': (+"), size, F.lit(",),}"))
    parts = spread(store.catalog.table("part").select("p_partkey", "p_name", "p_size"))
    texts = parts.select("p_partkey", names.alias("words"), numbers.alias("numbers"))
    types = {"words": "array<string>", "numbers": "struct<tens:bigint,hex:bigint,pair:array<bigint>>"}
    lost = materialise(clean.unparsed_rows(texts, types, "p_partkey").select("p_partkey", F.lit(True).alias("unread")), "unread")
    read = clean.parse_nested_columns(texts, types).join(lost, "p_partkey", "left")
    return read.select(
        "p_partkey", F.array_join("words", "|").alias("words"), "numbers.tens", "numbers.hex", F.get("numbers.pair", F.lit(0)).alias("first"), F.coalesce("unread", F.lit(False)).alias("unread")
    )


@query("epoch_to_timestamp")
def epoch_to_timestamp(store: Store) -> DataFrame:
    raw = store.catalog.table("events").select(
        "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("created")
    )
    return clean.epoch_to_timestamp(raw, ["created"])


@query("sort_then_limit")
def sort_then_limit(store: Store) -> DataFrame:
    reviews = store.catalog.user_reviews().select("review_id", "author_steamid", "votes_helpful")
    return clean.limit_records(clean.sort_by_column(reviews, "review_id"), 1000)


@query("first_records")
def first_records(store: Store) -> DataFrame:
    """The 1000 reviews of the smallest ids, found by place in the global order."""
    reviews = store.catalog.user_reviews().select("review_id", "author_steamid", "votes_helpful")
    return clean.first_records(reviews, "review_id", 1000)


@query("unparsed_rows")
def unparsed_rows(store: Store) -> DataFrame:
    """Texts of the events that are no list; they are dicts all."""
    events = spread(store.catalog.table("events").select("event_id", "props")).select("*", F.lit("['a', None]").alias("fine"))
    return clean.unparsed_rows(events, {"props": "array<string>", "fine": "array<string>"}, "event_id")


PART_TYPES = column_types("p_partkey INT, p_name STRING, p_size INT, p_retailprice DOUBLE")


def parts_as_text(store: Store) -> DataFrame:
    """Parts as cells of text, with whole numbers written as 12.0 and some that are no numbers."""
    size = F.when(F.col("p_size") % 7 == 0, F.lit("n/a")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".0")))
    return store.catalog.table("part").select(F.col("p_partkey").cast("string").alias("p_partkey"), "p_name", size.alias("p_size"))


@query("csv_quarantine")
def csv_quarantine(store: Store) -> DataFrame:
    """Cells of a CSV file that are no values of their columns' types."""
    path = scratch_path(store.spark, "parts-csv")
    sinks.write_csv(parts_as_text(store), path)
    raw = csv_files.read_large_csv(store.spark, path, PART_TYPES, "place", "bad")
    return raw.select("p_partkey", "p_name", "p_size", F.get("bad", F.lit(0))["column"].alias("bad_column"), F.get("bad", F.lit(0))["text"].alias("bad_text"))


@query("dedup_file_order")
def dedup_file_order(store: Store) -> DataFrame:
    """Two folders of files with different headers; of every part the row of the first file stays, as it stands earlier."""
    path = scratch_path(store.spark, "ordered-csv")
    part = store.catalog.table("part").select("p_partkey", "p_name", "p_size")
    sinks.write_csv(part, f"{path}/a")
    sinks.write_csv(part.select((F.col("p_size") + 100).alias("p_size"), "p_partkey"), f"{path}/b")
    raw = csv_files.read_large_csv(store.spark, f"{path}/*", PART_TYPES, "place")
    return clean.dedup_keep_first(raw, ["p_partkey"], ["place"]).drop("place")


@query("duplicates_report")
def duplicates_report(store: Store) -> DataFrame:
    """The removed copies, written as CSV beside the kept rows and read back."""
    path = scratch_path(store.spark, "duplicates")
    lines = store.catalog.lines_with_review_id().select(*store.catalog.REVIEW_ORDER)
    sinks.write_csv(clean.duplicate_rows(lines, ["review_id"], lines.columns), path)
    return store.spark.read.schema(lines.schema).csv(path, header=True, escape='"')


@query("dedup_keep_first")
def dedup_keep_first(store: Store) -> DataFrame:
    lines = store.catalog.lines_with_review_id()
    return clean.dedup_keep_first(lines, ["review_id"], store.catalog.REVIEW_ORDER)


@query("duplicate_rows")
def duplicate_rows(store: Store) -> DataFrame:
    lines = store.catalog.lines_with_review_id()
    return clean.duplicate_rows(lines, ["review_id"], store.catalog.REVIEW_ORDER)


@query("top_duplicate_keys")
def top_duplicate_keys(store: Store) -> DataFrame:
    return clean.top_duplicate_keys(store.catalog.lines_with_review_id(), "review_id")


@query("frequent_keys")
def frequent_keys(store: Store) -> DataFrame:
    """The games with the most reviews, and how many."""
    return sketches.frequent_keys(store.catalog.reviews(), "app_id", 20, "review_count")


@query("nan_to_null")
def nan_to_null(store: Store) -> DataFrame:
    missing = F.when(event_number() % 10 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return clean.nan_to_null(store.catalog.table("events").select("event_id", missing.alias("value")))


@query("column_profile")
def column_profile(store: Store) -> DataFrame:
    parts = [
        clean.column_profile(store.catalog.table(t)).withColumn("table_name", F.lit(t))
        for t in ("part", "documents", "events")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("dataset_shape")
def dataset_shape(store: Store) -> DataFrame:
    return clean.dataset_shape(store.catalog.table("lineitem"), "lineitem")


@query("nested_to_json")
def nested_to_json(store: Store) -> DataFrame:
    games = store.catalog.games_nested().select(
        "appid",
        "genres",
        F.array(F.struct(F.col("name").alias("title"), F.col("discount").alias("percent"))).alias("packages"),
    )
    flat = clean.nested_to_json(games.join(store.catalog.tag_map(), "appid"))
    return flat.withColumn("genres", F.array_join("genres", "|"))


# -- normalisation -----------------------------------------------------------------


def _stored(name: str) -> None:
    @query(("bridge_" + name.removeprefix("game_")) if name.startswith("game_") else f"dim_{name}")
    def stored(store: Store) -> DataFrame:
        return store.table(name)


for _name in ("developers", "publishers", "genres", "categories", "tags"):
    _stored(_name)
    _stored(f"game_{_name}")


@query("id_consistency")
def id_consistency(store: Store) -> DataFrame:
    """Three copies: the dimension, one with some names changed, one with some ids missing."""
    ids = store.table("developers")
    changed = F.when(F.col("developer_id") % 97 == 0, F.upper("name")).otherwise(F.col("name"))
    copies = {
        "relational": ids,
        "documents": ids.withColumn("name", changed),
        "graph": ids.where("developer_id % 31 <> 0"),
    }
    return normalize.id_consistency(copies, "developer_id").select("developer_id", "verdict")


@query("id_registry")
def id_registry(store: Store) -> DataFrame:
    """Publishers in two loads: first those of the games with even ids, then all; the ids of the first load stay."""
    entries = normalize.list_entries(store.catalog.games_nested(), "appid", "publishers")
    path = scratch_path(store.spark, "registry")
    first = registry.register_names(entries.where("game_appid % 2 = 0"), path, "publisher_id", "load-1")
    both = registry.register_names(entries, path, "publisher_id", "load-2")
    again = registry.register_names(entries, path, "publisher_id", "load-3")  # nothing new
    kept = normalize.id_consistency({"both": both, "again": again}, "publisher_id").select("publisher_id", "verdict")
    early = first.select("publisher_id", F.lit(True).alias("early"))
    return again.join(early, "publisher_id", "left").join(kept, "publisher_id").select("publisher_id", "name", F.coalesce("early", F.lit(False)).alias("early"), "verdict")


@query("dim_game_count")
def dim_game_count(store: Store) -> DataFrame:
    return normalize.with_game_count(store.table("genres"), store.table("game_genres"), "genre_id").drop("description")


# -- summaries and series ------------------------------------------------------------


@query("user_profiles")
def user_profiles(store: Store) -> DataFrame:
    return summaries.user_profiles(store.catalog.user_reviews())


@query("game_review_summary")
def game_review_summary(store: Store) -> DataFrame:
    return summaries.game_review_summary(store.catalog.reviews())


@query("developer_stats")
def developer_stats(store: Store) -> DataFrame:
    return summaries.developer_stats(store.catalog.games_nested(), store.table("game_developers"))


@query("mode_language")
def mode_language(store: Store) -> DataFrame:
    return mode_per_key(store.catalog.reviews(), ["app_id"], "language", "most_common_language")


@query("snapshot_spine")
def snapshot_spine(store: Store) -> DataFrame:
    return summaries.snapshot_spine(store.catalog.games(), "appid", "price", SNAPSHOT_BASE, 12, discount="discount")


# -- the analytical queries, relational form -------------------------------------------


def detail_bridges(store: Store) -> list[tuple[DataFrame, DataFrame, str, str]]:
    return [
        (store.table("game_developers"), store.table("developers"), "developer_id", "developer"),
        (store.table("game_genres"), store.table("genres"), "genre_id", "genre"),
        (store.table("game_categories"), store.table("categories"), "category_id", "category"),
    ]


@query("simple_select")
def simple_select(store: Store, limit: int | None = 100) -> DataFrame:
    return relational.expensive_games(store.table("games"), EXPENSIVE, limit)


@query("count_by_genre")
def count_by_genre(store: Store, limit: int | None = 100) -> DataFrame:
    return relational.count_by_genre(store.table("game_genres"), store.table("genres"), limit)


@query("games_with_developers")
def games_with_developers(store: Store, limit: int | None = 100) -> DataFrame:
    return relational.games_with_developers(
        store.table("games"), store.table("game_developers"), store.table("developers"), EXPENSIVE, limit
    )


@query("review_stats_by_game")
def review_stats_by_game(store: Store, limit: int | None = 100) -> DataFrame:
    return relational.review_stats_by_game(store.table("games"), store.table("reviews"), limit)


@query("developer_statistics")
def developer_statistics(store: Store, limit: int | None = 100) -> DataFrame:
    return relational.developer_statistics(store.table("developer_stats"), store.table("developers"), MANY_GAMES, limit)


@query("price_history_analysis")
def price_history_analysis(store: Store, limit: int | None = 100) -> DataFrame:
    return relational.price_history_analysis(store.table("prices"), limit)


@query("multi_join_details")
def multi_join_details(store: Store, limit: int | None = 100) -> DataFrame:
    return relational.game_details(store.table("games"), detail_bridges(store), *RANGE, limit)


@query("multi_join_details_all")
def multi_join_details_all(store: Store) -> DataFrame:
    return multi_join_details(store, None)


@query("games_by_genre_and_dev")
def games_by_genre_and_dev(store: Store, limit: int | None = 100) -> DataFrame:
    return relational.games_by_genre_and_developer(
        store.table("games"),
        store.table("game_genres"),
        store.table("genres"),
        store.table("game_developers"),
        store.table("developers"),
        WANTED_GENRES,
        limit,
    )


@query("games_with_summary")
def games_with_summary(store: Store, limit: int | None = 100) -> DataFrame:
    return relational.games_with_summary(store.table("games"), store.table("game_review_summary"), MANY_REVIEWS, limit)


@query("most_reviewed")
def most_reviewed(store: Store, limit: int | None = 20) -> DataFrame:
    return relational.most_reviewed(store.table("games"), store.table("reviews"), limit)


@query("semi_join_reviews")
def semi_join_reviews(store: Store) -> DataFrame:
    reviews = store.table("reviews").select("review_id", "app_id", "language", "votes_helpful")
    return relational.semi_join_reviews(store.table("games"), reviews, EXPENSIVE)


@query("not_null_filter")
def not_null_filter(store: Store) -> DataFrame:
    reviews = store.catalog.user_reviews()
    return reviews.where(F.col("author_num_games_owned").isNotNull()).select(
        "review_id", "author_steamid", "author_num_games_owned"
    )


# -- document form -----------------------------------------------------------------------


@query("lookup_nest")
def lookup_nest(store: Store) -> DataFrame:
    """Genre links of every game as an array."""
    nested = documents.lookup(
        store.table("games").select("appid"), store.table("game_genres"), "appid", "game_appid", "links", ["genre_id"]
    )
    ids = F.transform("links", lambda link: link["genre_id"].cast("string"))
    return nested.select(
        "appid", F.size("links").cast("bigint").alias("link_count"), F.array_join(ids, ",").alias("genre_ids")
    )


@query("lookup_summary")
def lookup_summary(store: Store) -> DataFrame:
    """Number and smallest id of the genre links of every game, without building arrays."""
    summed = documents.lookup_summary(
        store.table("games").select("appid"), store.table("game_genres"), "appid", "game_appid", "link_count", "first", ["genre_id"]
    )
    return summed.select("appid", "link_count", F.col("first.genre_id").alias("first_genre_id"))


@query("unwind")
def unwind(store: Store) -> DataFrame:
    return documents.unwind(store.catalog.games_nested().select("appid", "genres"), "genres")


@query("unwind_outer")
def unwind_outer(store: Store) -> DataFrame:
    return documents.unwind(store.catalog.games_nested().select("appid", "categories"), "categories", keep_empty=True)


@query("array_first")
def array_first(store: Store) -> DataFrame:
    games = store.catalog.games_nested().select("appid", "genres")
    return documents.array_first(games, "genres", "main_genre").drop("genres")


@query("array_size")
def array_size(store: Store) -> DataFrame:
    games = store.catalog.games_nested().select("appid", "categories")
    return documents.array_size(games, "categories", "category_count").drop("categories")


@query("simple_select_documents")
def simple_select_documents(store: Store, limit: int | None = 100) -> DataFrame:
    return relational.expensive_games(store.table("games"), EXPENSIVE, limit)


@query("count_by_genre_documents")
def count_by_genre_documents(store: Store, limit: int | None = 100) -> DataFrame:
    return documents.count_by_genre(store.table("game_genres"), store.table("genres"), limit)


@query("games_with_developers_documents")
def games_with_developers_documents(store: Store, limit: int | None = 100) -> DataFrame:
    return documents.games_with_developers(
        store.table("games"), store.table("game_developers"), store.table("developers"), EXPENSIVE, limit
    )


@query("review_stats_by_game_documents")
def review_stats_by_game_documents(store: Store, limit: int | None = 100) -> DataFrame:
    return relational.review_stats_by_game(store.table("games"), store.table("reviews"), limit)


@query("developer_statistics_documents")
def developer_statistics_documents(store: Store, limit: int | None = 100) -> DataFrame:
    return documents.developer_statistics(store.table("developer_stats"), store.table("developers"), MANY_GAMES, limit)


@query("price_history_analysis_documents")
def price_history_analysis_documents(store: Store, limit: int | None = 100) -> DataFrame:
    return relational.price_history_analysis(store.table("prices"), limit)


@query("multi_join_details_documents")
def multi_join_details_documents(store: Store, limit: int | None = 100) -> DataFrame:
    return documents.game_details(store.table("games"), detail_bridges(store), *RANGE, limit)


# -- graph form ------------------------------------------------------------------------------


def bridge_edges(store: Store, column: str, id_col: str, rel_type: str) -> DataFrame:
    return graph.edges_from_bridge(
        store.table(f"game_{column}"), "game_appid", id_col, rel_type,
        store.table("games"), "appid", store.table(column), id_col,
    )


@query("graph_match")
def graph_match(store: Store) -> DataFrame:
    """(game)-[:HAS_GENRE_NORM]->(genre) over all games."""
    edges = bridge_edges(store, "genres", "genre_id", "HAS_GENRE_NORM")
    found = graph.match(store.table("games").select("appid"), "appid", edges, store.table("genres"), "genre_id", "ge", ["name"])
    return found.select("appid", F.col("ge.name").alias("genre"))


@query("graph_optional_match")
def graph_optional_match(store: Store) -> DataFrame:
    edges = bridge_edges(store, "categories", "category_id", "HAS_CATEGORY_NORM")
    found = graph.match(
        store.table("games").select("appid"), "appid", edges, store.table("categories"), "category_id", "c", ["name"],
        optional=True,
    )
    return found.select("appid", F.col("c.name").alias("category"))


@query("graph_group")
def graph_group(store: Store, limit: int | None = 100) -> DataFrame:
    return relational.price_history_analysis(store.table("prices"), limit)


@query("simple_select_graph")
def simple_select_graph(store: Store, limit: int | None = 100) -> DataFrame:
    return relational.expensive_games(store.table("games"), EXPENSIVE, limit)


@query("count_by_genre_graph")
def count_by_genre_graph(store: Store, limit: int | None = 100) -> DataFrame:
    return graph.count_by_genre(bridge_edges(store, "genres", "genre_id", "HAS_GENRE_NORM"), store.table("genres"), limit)


@query("games_with_developers_graph")
def games_with_developers_graph(store: Store, limit: int | None = 100) -> DataFrame:
    edges = bridge_edges(store, "developers", "developer_id", "DEVELOPED_BY_NORM")
    return graph.games_with_developers(store.table("games"), edges, store.table("developers"), EXPENSIVE, limit)


@query("review_stats_by_game_graph")
def review_stats_by_game_graph(store: Store, limit: int | None = 100) -> DataFrame:
    return relational.review_stats_by_game(store.table("games"), store.table("reviews"), limit)


@query("developer_statistics_graph")
def developer_statistics_graph(store: Store, limit: int | None = 100) -> DataFrame:
    return relational.developer_statistics(store.table("developer_stats"), store.table("developers"), MANY_GAMES, limit)


@query("multi_join_details_graph")
def multi_join_details_graph(store: Store, limit: int | None = 100) -> DataFrame:
    patterns = [
        (bridge_edges(store, "developers", "developer_id", "DEVELOPED_BY_NORM"), store.table("developers"), "developer_id", "developer"),
        (bridge_edges(store, "genres", "genre_id", "HAS_GENRE_NORM"), store.table("genres"), "genre_id", "genre"),
        (bridge_edges(store, "categories", "category_id", "HAS_CATEGORY_NORM"), store.table("categories"), "category_id", "category"),
    ]
    return graph.game_details(store.table("games"), patterns, *RANGE, limit)


# -- graph tables ------------------------------------------------------------------------------


@query("node_upsert")
def node_upsert(store: Store) -> DataFrame:
    """Two batches over existing nodes: changed prices, removed names, new keys."""
    part = store.catalog.games().select("appid", "name", "price", "metacritic_score")
    existing = part.where("appid % 3 <> 0")
    name = F.when(F.col("appid") % 10 != 0, F.upper("name"))
    first = part.where("appid % 2 = 0").select("appid", name.alias("name"), "price", F.lit(1).alias("batch"))
    second = part.where("appid % 4 = 0").select(
        "appid", name.alias("name"), F.lit(None).cast("double").alias("price"), F.lit(2).alias("batch")
    )
    return graph.upsert_nodes(existing, first.unionByName(second), "appid", order_by=["batch"])


@query("merge_partitions")
def merge_partitions(store: Store) -> DataFrame:
    """The batches of ``node_upsert`` merged one after the other into a table of key ranges."""
    part = store.catalog.games().select("appid", "name", "price", "metacritic_score")
    name = F.when(F.col("appid") % 10 != 0, F.upper("name"))
    first = part.where("appid % 2 = 0").select("appid", name.alias("name"), "price", F.lit(1).alias("batch"))
    second = part.where("appid % 4 = 0").select("appid", name.alias("name"), F.lit(None).cast("double").alias("price"), F.lit(2).alias("batch"))
    path = scratch_path(store.spark, "merged")
    partitioned.create_merge_table(part.where("appid % 3 <> 0"), path, "appid", 16)
    for batch in (first, second):
        partitioned.merge_partitions(store.spark, path, batch)
    return partitioned.read_merge_table(store.spark, path)


@query("edges_from_list")
def edges_from_list(store: Store) -> DataFrame:
    return graph.edges_from_list(store.catalog.games_nested(), "appid", "categories", "HAS_CATEGORY")


@query("edges_from_bridge")
def edges_from_bridge(store: Store) -> DataFrame:
    """All links, and as many to developers and from games that don't exist."""
    links = store.table("game_developers")
    lost = links.select("game_appid", (-F.col("developer_id")).alias("developer_id"))
    lost = lost.unionByName(links.select((-F.col("game_appid")).alias("game_appid"), "developer_id"))
    return graph.edges_from_bridge(
        links.unionByName(lost), "game_appid", "developer_id", "DEVELOPED_BY_NORM",
        store.table("games"), "appid", store.table("developers"), "developer_id",
    )


@query("edge_targets")
def edge_targets(store: Store) -> DataFrame:
    """The nodes that the edges to category names create."""
    return graph.edge_targets(edges_from_list(store))


@query("edges_with_property")
def edges_with_property(store: Store) -> DataFrame:
    """Two writes per edge, the last of which is the smaller one."""
    links = store.table("game_tags")
    first = links.withColumn("vote_count", F.col("vote_count") + 1000).withColumn("written", F.lit(1))
    return graph.edges_from_bridge(
        first.unionByName(links.withColumn("written", F.lit(2))), "game_appid", "tag_id", "HAS_TAG_NORM",
        store.table("games"), "appid", store.table("tags"), "tag_id", properties=["vote_count"], order_by=["written"],
    )


@query("edges_from_fk")
def edges_from_fk(store: Store) -> DataFrame:
    return graph.edges_from_fk(
        store.catalog.reviews(), "review_id", "app_id", "REVIEWED", store.table("games"), "appid", from_parent=False
    )


@query("name_match_link")
def name_match_link(store: Store) -> DataFrame:
    part = store.catalog.table("part")
    lower = part.select(F.lower("p_name").alias("title"))
    return graph.name_match_links(part.select(F.initcap("p_name").alias("name")), "name", lower, "title")


@query("name_match_edges")
def name_match_edges(store: Store) -> DataFrame:
    part = store.catalog.table("part")
    return graph.name_match_edges(
        part, "p_partkey", "p_name", part.withColumn("p_type", F.upper("p_name")), "p_partkey", "p_type", "HAS_PLAYTIME_DATA"
    )


def graph_nodes(store: Store) -> DataFrame:
    """(label, key) of games, developers and genres."""
    parts = {"Game": ("games", "appid"), "GameDeveloper": ("developers", "developer_id"), "GameGenre": ("genres", "genre_id")}
    frames = [store.table(t).select(F.lit(l).alias("label"), F.col(k).alias("key")) for l, (t, k) in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def graph_edges(store: Store) -> DataFrame:
    """Edges from games to developers and genres, with the labels of both ends."""

    def labelled(edges: DataFrame, dst: str) -> DataFrame:
        return edges.select(F.lit("Game").alias("src_label"), "src", "rel_type", F.lit(dst).alias("dst_label"), "dst")

    return labelled(bridge_edges(store, "developers", "developer_id", "DEVELOPED_BY_NORM"), "GameDeveloper").unionByName(
        labelled(bridge_edges(store, "genres", "genre_id", "HAS_GENRE_NORM"), "GameGenre")
    )


@query("label_counts")
def label_counts(store: Store) -> DataFrame:
    return graph.label_counts(graph_nodes(store))


@query("detach_delete")
def detach_delete(store: Store) -> DataFrame:
    """The nodes and edges that are left after the genres are deleted."""
    nodes, edges = graph.detach_delete(graph_nodes(store), graph_edges(store), ["GameGenre"])
    return nodes.select(F.col("label").alias("name"), F.col("key").alias("src"), F.lit(None).cast("bigint").alias("dst")).unionByName(
        edges.select(F.col("rel_type").alias("name"), "src", "dst")
    )


@query("dangling_edges")
def dangling_edges(store: Store) -> DataFrame:
    lost = ((F.col("label") == "Game") & (F.col("key") % 50 == 0)) | (
        (F.col("label") == "GameDeveloper") & (F.col("key") % 20 == 0)
    )
    return graph.dangling_edges(graph_edges(store), graph_nodes(store).where(~lost))


@query("uniqueness_check")
def uniqueness_check(store: Store) -> DataFrame:
    return graph.duplicate_keys(store.catalog.lines_with_review_id(), ["review_id"])


# -- reconciliation ------------------------------------------------------------------------------


@query("canonical_rows")
def canonical_rows(store: Store) -> DataFrame:
    k = event_number()
    raw = store.catalog.table("events").select(
        F.col("event_id").alias("Event_ID"),
        F.col("event_type").isin("purchase").alias("Is_Purchase"),
        (F.col("value") / 8).alias("Share"),
        F.when(k % 10 != 0, k.cast("double")).alias("Whole"),
        F.concat(F.lit(" \t"), "event_type", F.lit("\n ")).alias("Kind"),
        F.when(k % 2 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts")).alias("At"),
    )
    return reconcile.canonical_rows(raw)


@query("row_count_match")
def row_count_match(store: Store) -> DataFrame:
    return reconcile.row_count_match(
        {
            "relational": store.table("game_genres"),
            "documents": documents.unwind(store.catalog.games_nested().select("appid", "genres"), "genres"),
            "graph": bridge_edges(store, "genres", "genre_id", "HAS_GENRE_NORM"),
        }
    )


@query("field_diff")
def field_diff(store: Store) -> DataFrame:
    events = store.catalog.table("events")
    left = events.select(F.to_json(F.struct("event_id", "event_type", F.when(event_number() > 50, F.col("value")).alias("value"))).alias("row"))
    right = events.select(F.to_json(F.struct("event_id", F.col("event_type").alias("kind"), "value")).alias("row"))
    return reconcile.field_diff(left, right, "row")


@query("path_diff")
def path_diff(store: Store) -> DataFrame:
    """Nested rows of the events, with a renamed inner field, another type, and elements that have one field more."""
    events, k = spread(store.catalog.table("events").select("event_id", "event_type", "value", "props")), event_number()
    inner = F.struct(F.col("event_type").alias("kind"), F.col("value"))
    left = events.select(F.to_json(F.struct("event_id", inner.alias("detail"), F.array(F.struct(k.alias("k"))).alias("items"))).alias("row"))
    other = F.struct(F.col("event_type").alias("type"), F.col("value").cast("string").alias("value"))
    more = F.array(*[F.struct(k.alias("k"), F.when(k % 10 == late, F.lit(True)).alias("late")) for late in (-1, 3)])
    right = events.select(F.to_json(F.struct("event_id", other.alias("detail"), more.alias("items"))).alias("row"))
    return reconcile.path_diff(left, right, "row").select("path", "present_in")


def perturbed_games(store: Store) -> DataFrame:
    """Games with small and large price changes, lost names and lost rows."""
    key = F.col("appid")
    price = (
        F.when(key % 97 == 0, F.col("price") + 0.02).when(key % 89 == 0, F.col("price") + 0.009).otherwise(F.col("price"))
    )
    return (
        store.catalog.games()
        .where(key % 79 != 0)
        .select(
            F.when(key % 101 == 0, -key).otherwise(key).alias("appid"),
            F.when(key % 83 != 0, F.col("name")).alias("name"),
            round_half_up(price, 3).alias("price"),
            F.col("metacritic_score"),
        )
    )


@query("cell_diff")
def cell_diff(store: Store) -> DataFrame:
    left = store.catalog.games().select("appid", "name", "price", "metacritic_score", "discount")
    return reconcile.cell_diff(left, perturbed_games(store), "appid")


@query("range_diff")
def range_diff(store: Store) -> DataFrame:
    """The cells of ``cell_diff``, found by digests of key ranges."""
    left = store.catalog.games().select("appid", "name", "price", "metacritic_score", "discount")
    return reconcile.range_diff(left, perturbed_games(store), "appid")


@query("range_report")
def range_report(store: Store) -> DataFrame:
    """Rows per key range of the line items' reviews on both sides, one of which lacks a few; rows of all ranges are counted."""
    reviews = store.catalog.reviews()
    report = digests.range_report(reviews, reviews.where("app_id % 101 <> 0"), "app_id", 64)
    return report.agg(
        F.sum("left_rows").alias("left_rows"), F.sum("right_rows").alias("right_rows"), F.bool_or("differs").alias("differs")
    )


@query("cell_diff_by_position")
def cell_diff_by_position(store: Store) -> DataFrame:
    left = store.catalog.games().select("appid", "name", "price")
    right = perturbed_games(store).select("appid", "name", "price")
    return reconcile.cell_diff_by_position(left, right, ["appid"])


@query("compare_results")
def compare_results(store: Store) -> DataFrame:
    """A result against itself in other clothes, and against a changed one."""
    games = store.catalog.games().select("appid", "name", "price", "metacritic_score")
    loud = games.select(F.col("appid").alias("AppID"), F.concat(F.lit(" "), "name").alias("Name"), "price", "metacritic_score")
    return reconcile.compare_results({"first": games, "renamed": loud, "changed": perturbed_games(store)}, "appid")


@query("overall_verdict")
def overall_verdict(store: Store) -> DataFrame:
    checks = (
        runstats.run_log(store.catalog.executions())
        .groupBy("test_name", "database")
        .agg(F.max("row_count").alias("row_count"), F.bool_and(F.col("run_number") != 97).alias("data_match"))
    )
    return reconcile.overall_verdict(checks)


# -- run statistics ---------------------------------------------------------------------------------

RUN_LOG_TYPES = column_types(
    "test_name STRING, database STRING, run_number BIGINT, execution_time_ms DOUBLE, row_count BIGINT, "
    "error STRING, timestamp STRING"
)


def log_of(store: Store) -> DataFrame:
    return runstats.run_log(store.catalog.executions())


@query("run_log")
def run_log(store: Store) -> DataFrame:
    """Executions written as CSV logs, read back with declared types."""
    path = scratch_path(store.spark, "run-log")
    sinks.write_csv(store.catalog.executions(), path)
    return runstats.run_log(csv_files.read_large_csv(store.spark, path, RUN_LOG_TYPES))


@query("run_statistics")
def run_statistics(store: Store) -> DataFrame:
    return runstats.run_statistics(log_of(store))


@query("merged_run_statistics")
def merged_run_statistics(store: Store) -> DataFrame:
    """The statistics of the whole log, from the states of three loads, one of which arrives twice."""
    path, log = scratch_path(store.spark, "run-states"), log_of(store)
    for load in (0, 1, 2, 1):
        runstats.append_runs(log.where(F.col("run_number") % 3 == load), path, f"load_{load}")
    return runstats.stored_run_statistics(store.spark, path)


@query("run_cv")
def run_cv(store: Store) -> DataFrame:
    return runstats.run_cv(log_of(store))


@query("effect_size")
def effect_size(store: Store) -> DataFrame:
    return runstats.effect_size(log_of(store), "engine_0", "engine_1")


@query("anova_f")
def anova_f(store: Store) -> DataFrame:
    return runstats.anova_f(log_of(store))


@query("describe_by_group")
def describe_by_group(store: Store) -> DataFrame:
    return runstats.describe_by_group(log_of(store), ["test_name", "database"], "execution_time_ms")


@query("histogram_bins")
def histogram_bins(store: Store) -> DataFrame:
    return runstats.histogram_bins(log_of(store), ["test_name"], "execution_time_ms", 30)


@query("step_times")
def step_times(store: Store) -> DataFrame:
    steps = store.catalog.table("events").select(
        F.col("event_type").alias("step"),
        F.col("ts").alias("started"),
        (F.col("ts") + F.make_dt_interval(secs=F.col("value").cast("decimal(18,6)"))).alias("ended"),
    )
    return runstats.step_times(steps)
