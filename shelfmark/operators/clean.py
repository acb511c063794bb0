"""Cleaning and preparation of raw tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.literals import is_unparsed, parse_literal
from shelfmark.operators.ordering import first_per_key, with_positions
from shelfmark.operators.sketches import frequent_hashes, hashes_seen_twice, key_hash, rows_seen_twice
from shelfmark.session import BROADCAST_ROWS, materialise

# Bounds of a 32-bit signed integer.
INT32_MIN, INT32_MAX = -2147483648, 2147483647

# Author columns of the review file and the names used afterwards.
AUTHOR_COLUMNS = {
    "author.steamid": "author_steamid",
    "author.num_games_owned": "author_num_games_owned",
    "author.num_reviews": "author_num_reviews",
    "author.playtime_forever": "author_playtime_forever",
    "author.playtime_last_two_weeks": "author_playtime_last_two_weeks",
    "author.playtime_at_review": "author_playtime_at_review",
    "author.last_played": "author_last_played",
}


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def drop_index_column(df: DataFrame, names: Sequence[str] = ("_c0", "Unnamed: 0")) -> DataFrame:
    """Drop the index column an export left behind without a header."""
    return df.drop(*names)


def parse_nested_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Replace literal text columns by parsed values; columns not present are skipped."""
    return df.withColumns({c: parse_literal(F.col(c), t) for c, t in types.items() if c in df.columns})


def unparsed_rows(df: DataFrame, types: Mapping[str, str], key: str) -> DataFrame:
    """Quarantine: (key, column, text) of non-empty text that is not a literal."""
    cells = [
        F.when(
            is_unparsed(F.col(c), parse_literal(F.col(c), t)),
            F.struct(F.lit(c).alias("column"), F.col(c).alias("text")),
        )
        for c, t in types.items()
        if c in df.columns
    ]
    bad = F.filter(F.array(*cells), lambda cell: cell.isNotNull())
    return df.select(F.col(key), F.explode(bad).alias("_cell")).select(key, "_cell.column", "_cell.text")


def epoch_to_timestamp(df: DataFrame, columns: Sequence[str], unit: str | None = "s") -> DataFrame:
    """Epoch seconds (or timestamp text when ``unit`` is None) to timestamps."""

    def convert(name: str) -> Column:
        if unit is None:
            return F.to_timestamp(F.col(name))
        if unit != "s":
            raise ValueError(f"unknown unit {unit!r}")
        return F.timestamp_seconds(F.col(name).cast("double"))

    return df.withColumns({c: convert(c) for c in columns if c in df.columns})


def sort_by_column(df: DataFrame, column: str) -> DataFrame:
    """Ascending, missing values last; no change when the column is absent."""
    return df.orderBy(F.col(column).asc_nulls_last()) if column in df.columns else df


def limit_records(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows; no change unless ``n`` is positive."""
    return df.limit(n) if n > 0 else df


def first_records(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest values of a unique key, in no order; a null key comes last.

    Sorting and limiting rows would bring them into one task.  Only the key
    takes part in finding the last value to keep, by its place in the global
    order; the rows are filtered where they are.
    """
    if n <= 0:
        return df
    keys = df.select(key).where(F.col(key).isNotNull())
    kept = with_positions(keys, [key], "_n", unique=True).where(F.col("_n") < n)
    last, found = kept.agg(F.max(key), F.count(key)).first()
    return df if found < n else df.where(F.col(key) <= F.lit(last))


def repeated_keys(df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, int]:
    """Keys with more than one row, stored, and their number up to ``BROADCAST_ROWS + 1``.

    Keys are first looked at as packed hashes; while few of those repeat, only their rows are counted by key.
    """
    twice, n = hashes_seen_twice(df, key)
    rows = df.select(*key)
    if n <= BROADCAST_ROWS:
        rows = rows_seen_twice(rows, key, twice) if n else rows.limit(0)
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    stored = materialise(counts.where(F.col("_n") > 1).select(*key), "repeated-keys")
    return stored, stored.limit(BROADCAST_ROWS + 1).count()


def _with_key_in(df: DataFrame, keys: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join against a small key table; null equals null."""
    renamed = keys.select(*[F.col(c).alias(f"_key_{c}") for c in key])
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    return df.join(F.broadcast(renamed), same, how)


def dedup_keep_first(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order_by``.

    ``order_by`` must order the rows of a key totally, exact copies aside.
    Repeated keys are found from the key columns alone.  While they are few,
    only their rows are shuffled and the others stay where they are.
    """
    order = [F.col(c) for c in order_by]
    keys, n = repeated_keys(df, key)
    if n == 0:
        return df
    if n > BROADCAST_ROWS:
        return first_per_key(df, key, order)
    single = _with_key_in(df, keys, key, "left_anti")
    return single.unionByName(first_per_key(_with_key_in(df, keys, key, "left_semi"), key, order))


def duplicate_rows(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The rows ``dedup_keep_first`` removes, exact copies included.

    A row that is not the first of its key within its own input partition is
    removed for certain.  Only the partition firsts, at most one per key and
    input partition, meet in a second window; the others stay spread.
    """
    keys, n = repeated_keys(df, key)
    rows = _with_key_in(df, keys, key, "left_semi") if n <= BROADCAST_ROWS else df
    order = [F.col(c) for c in order_by]
    local = Window.partitionBy(*key, "_part").orderBy(*order)
    marked = rows.withColumn("_part", F.spark_partition_id()).withColumn("_local", F.row_number().over(local) == 1)
    spread = F.when(~F.col("_local"), F.col("_part"))
    final = Window.partitionBy(*key, "_local", "_spread").orderBy(*order, "_part")
    ranked = marked.withColumn("_spread", spread).withColumn("_rank", F.row_number().over(final))
    return ranked.where(~F.col("_local") | (F.col("_rank") > 1)).select(*df.columns)


def top_duplicate_keys(df: DataFrame, key: str, limit: int = 10) -> DataFrame:
    """Keys with the most removed rows, i.e. copies beyond the first; a null key is no key.

    A few frequent keys are found by their frequencies; where none stand out, only rows of keys that repeat are counted.
    """
    rows = df.select(key).where(F.col(key).isNotNull())
    hashes = frequent_hashes(rows, [key], limit)
    if hashes is not None and hashes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        rows = rows.withColumn("_hash", key_hash([key])).join(F.broadcast(hashes.withColumnRenamed("hash", "_hash")), "_hash", "left_semi")
    else:
        twice, n = hashes_seen_twice(rows, [key])
        if n <= BROADCAST_ROWS:
            rows = rows_seen_twice(rows, [key], twice) if n else rows.limit(0)
    removed = (F.count(F.lit(1)) - 1).alias("removed_rows")
    return rows.groupBy(key).agg(removed).where("removed_rows > 0").orderBy(F.desc("removed_rows"), F.asc(key)).limit(limit)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null in every floating column; nested columns stay as they are."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating})


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, non-null count, numeric range, int32 fit, longest text."""
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    aggregates = [F.count(F.col(c)).alias(f"n:{c}") for c in df.columns]
    for c in numeric:
        real = F.col(c).cast("double")
        known = F.when(~F.isnan(real), real)
        aggregates += [F.min(known).alias(f"lo:{c}"), F.max(known).alias(f"hi:{c}")]
    aggregates += [F.max(F.length(c)).cast("bigint").alias(f"len:{c}") for c in text]
    summary = df.agg(*aggregates)

    def entry(field: T.StructField) -> Column:
        c = field.name
        lo = F.col(f"`lo:{c}`") if c in numeric else F.lit(None).cast("double")
        hi = F.col(f"`hi:{c}`") if c in numeric else F.lit(None).cast("double")
        longest = F.col(f"`len:{c}`") if c in text else F.lit(None).cast("bigint")
        return F.struct(
            F.lit(c).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("data_type"),
            F.col(f"`n:{c}`").alias("non_null"),
            lo.alias("min_value"),
            hi.alias("max_value"),
            ((lo >= INT32_MIN) & (hi <= INT32_MAX)).alias("fits_int32"),
            longest.alias("max_length"),
        )

    return summary.select(F.inline(F.array(*[entry(f) for f in df.schema])))


def dataset_shape(df: DataFrame, name: str) -> DataFrame:
    """One row: dataset name, row count, column count, column list."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("dataset"),
        "row_count",
        F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        F.lit(",".join(df.columns)).alias("columns"),
    )


def nested_to_json(df: DataFrame) -> DataFrame:
    """Maps, structs and arrays of those become JSON text; plain arrays stay."""

    def is_nested(t: T.DataType) -> bool:
        return isinstance(t, (T.MapType, T.StructType)) or (
            isinstance(t, T.ArrayType) and isinstance(t.elementType, (T.MapType, T.StructType, T.ArrayType))
        )

    return df.withColumns({f.name: F.to_json(f.name) for f in df.schema if is_nested(f.dataType)})
