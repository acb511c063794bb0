"""From the three CSV files to prepared tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators import clean
from shelfmark.session import materialise
from shelfmark.sources import sinks
from shelfmark.sources.csv_files import read_large_csv
from shelfmark.sources.datasets import DATASETS, NESTED_GAME_COLUMNS, REVIEW_TIMES

# The nameless first column of an export: the row's place in its file.
INDEX_COLUMN = "_c0"

# Hidden columns of an import: the place of a row, and what could not be read in it.
PLACE, BAD_CELLS = "_place", "_bad_cells"


def import_csv(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """Typed rows of a CSV file with their place, stored once in a format that splits and prunes."""
    raw = read_large_csv(spark, path, DATASETS[dataset].types, PLACE, BAD_CELLS)
    return materialise(raw, f"{dataset}-raw")


def quarantine(raw: DataFrame, nested: Mapping[str, str] | None = None) -> DataFrame:
    """``(file, block, row, column, text)`` of cells that are no value of their column's type.

    That holds for the declared types and for literals of ``nested`` columns; a
    record with too few or too many cells has no column name.
    """
    place = [F.col(PLACE)[c].alias(c) for c in ("file", "block", "row")]
    cells = raw.select(*place, F.explode(BAD_CELLS).alias("_cell")).select("file", "block", "row", "_cell.column", "_cell.text")
    if not nested:
        return cells
    literals = clean.unparsed_rows(raw, nested, PLACE)
    return cells.unionByName(literals.select(*place, "column", "text"))


def file_order(df: DataFrame) -> Sequence[str]:
    """Columns that settle which of several rows comes first: the place in the files where it is known."""
    return [PLACE] if PLACE in df.columns else [INDEX_COLUMN] if INDEX_COLUMN in df.columns else df.columns


def _finished(df: DataFrame) -> DataFrame:
    return clean.drop_index_column(df).drop(PLACE, BAD_CELLS)


def without_duplicates(df: DataFrame, key: str, duplicates_path: str | None = None) -> DataFrame:
    """Keep the first row per key; the removed rows go to a CSV report if a path is given."""
    order = file_order(df)
    if duplicates_path:
        sinks.write_csv(clean.duplicate_rows(df, [key], order).drop(PLACE, BAD_CELLS), duplicates_path)
    return clean.dedup_keep_first(df, [key], order)


def prepare_games(
    spark: SparkSession,
    path: str,
    root: str,
    use_cache: bool = False,
    duplicates_path: str | None = None,
    quarantine_path: str | None = None,
) -> DataFrame:
    """Games with parsed list and dict columns, one row per ``appid``.

    With ``use_cache`` a stored version is read back if the files, parameters and types are those it was made of, or if
    there are no files any more.

    Cells and literals that can't be read are null, and go to a CSV report if a path is given.
    """

    def build() -> DataFrame:
        raw = import_csv(spark, path, "games")
        if quarantine_path:
            sinks.write_csv(quarantine(raw, NESTED_GAME_COLUMNS), quarantine_path)
        kept = without_duplicates(raw, DATASETS["games"].key, duplicates_path)
        return clean.parse_nested_columns(_finished(kept), NESTED_GAME_COLUMNS)

    known = sinks.source_fingerprint(spark, path, {"nested": sorted(NESTED_GAME_COLUMNS.items())}, DATASETS["games"].types)
    return sinks.prepared(spark, root, "games", build, use_cache=use_cache, fingerprint=known)


def prepare_reviews(
    spark: SparkSession,
    path: str,
    root: str,
    limit: int | None = None,
    use_cache: bool = False,
    duplicates_path: str | None = None,
    quarantine_path: str | None = None,
) -> DataFrame:
    """All reviews, or the first ``limit`` by id, with timestamps and plain author columns."""

    def build() -> DataFrame:
        raw = import_csv(spark, path, "reviews")
        if quarantine_path:
            sinks.write_csv(quarantine(raw), quarantine_path)
        renamed = clean.rename_columns(raw, clean.AUTHOR_COLUMNS)
        kept = without_duplicates(renamed, DATASETS["reviews"].key, duplicates_path)
        timed = clean.epoch_to_timestamp(_finished(kept), REVIEW_TIMES)
        return timed if limit is None else clean.first_records(timed, DATASETS["reviews"].key, limit)

    known = sinks.source_fingerprint(spark, path, {"limit": limit, "times": list(REVIEW_TIMES)}, DATASETS["reviews"].types)
    return sinks.prepared(spark, root, "reviews", build, limit=limit, use_cache=use_cache, fingerprint=known)


def prepare_completion_times(
    spark: SparkSession,
    path: str,
    root: str,
    use_cache: bool = False,
    duplicates_path: str | None = None,
    quarantine_path: str | None = None,
) -> DataFrame:
    def build() -> DataFrame:
        raw = import_csv(spark, path, "hltb")
        if quarantine_path:
            sinks.write_csv(quarantine(raw), quarantine_path)
        return _finished(without_duplicates(raw, DATASETS["hltb"].key, duplicates_path))

    known = sinks.source_fingerprint(spark, path, {}, DATASETS["hltb"].types)
    return sinks.prepared(spark, root, "hltb", build, use_cache=use_cache, fingerprint=known)
