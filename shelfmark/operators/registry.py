"""Ids that stay: an append-only registry of names per dimension."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.ordering import with_positions
from shelfmark.session import materialise
from shelfmark.sources.sinks import complete_folders


def read_registry(spark: SparkSession, path: str, id_col: str, name: str = "name") -> DataFrame:
    """``(<id_col>, name)`` of all complete loads; empty where nothing was registered."""
    loads = complete_folders(spark, path)
    schema = f"{id_col} bigint, {name} string"
    if not loads:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{load}" for load in loads])


def register_names(names: DataFrame, path: str, id_col: str, load_id: str, name: str = "name") -> DataFrame:
    """Give ids to the names that have none yet, and return the whole registry.

    New names follow the largest id so far in code-point order, so ids are dense from 1 and none ever changes.  Null and
    empty names get none.  A load is a folder of its own that is complete or not there: one that was cut off is written
    anew, and one that is complete isn't written again.  Loads are registered one at a time.
    """
    spark, folder = names.sparkSession, f"{path.rstrip('/')}/{load_id}"
    if load_id in complete_folders(spark, path):
        return read_registry(spark, path, id_col, name)
    known = read_registry(spark, path, id_col, name)
    last = known.agg(F.max(id_col)).first()[0] or 0
    fresh = names.select(name).where(F.col(name) != "").distinct().join(known.select(name), name, "left_anti")
    placed = with_positions(materialise(fresh, "new-names"), [name], id_col, start=last + 1, unique=True)
    placed.write.mode("overwrite").parquet(folder)
    return read_registry(spark, path, id_col, name)


def registered_dimension(entries: DataFrame, path: str, id_col: str, load_id: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """The dimension of the entries' names under their registered ids; names of earlier loads that are gone are left out."""
    registry = register_names(entries, path, id_col, load_id)
    present = entries.select("name").where("name <> ''").distinct()
    return registry.join(present, "name", "left_semi").select(id_col, "name").withColumns(dict(extra or {}))
