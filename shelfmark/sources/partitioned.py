"""Target tables in partitions: merges rewrite the key ranges that a batch touches, appends replace their own load.

Both use Spark's dynamic partition overwrite, so files of other partitions stay as they are, and a write that is repeated
leaves what one write would.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.operators.graph import upsert_nodes
from shelfmark.session import materialise

PART, LOAD = "key_part", "load_id"


def _data(path: str) -> str:
    return f"{path.rstrip('/')}/data"


def _layouts(path: str) -> str:
    return f"{path.rstrip('/')}/layout"


def _overwrite_partitions(df: DataFrame, path: str, column: str) -> None:
    """Replace the partitions that ``df`` has rows of, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def _with_part(df: DataFrame, key: str, layout: dict) -> DataFrame:
    if layout["cuts"] is None:
        return df.withColumn(PART, F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(layout["parts"])).cast("int"))
    split = Bucketizer(splits=[-math.inf, *layout["cuts"], math.inf], inputCol="_as_double", outputCol="_bucket", handleInvalid="keep")
    placed = split.transform(df.withColumn("_as_double", F.col(key).cast("double")))
    return placed.withColumn(PART, F.col("_bucket").cast("int")).drop("_as_double", "_bucket")


def _save_layout(spark: SparkSession, path: str, layout: dict) -> None:
    spark.createDataFrame([(layout["version"], json.dumps(layout))], "version int, layout string").coalesce(1).write.mode("append").parquet(_layouts(path))


def _layout(spark: SparkSession, path: str) -> dict:
    newest = spark.read.parquet(_layouts(path)).orderBy(F.desc("version")).select("layout").first()
    return json.loads(newest["layout"])


def create_merge_table(df: DataFrame, path: str, key: str, parts: int = 256) -> DataFrame:
    """Store rows with distinct keys in ``parts`` key ranges of about equal size; rows with a null key are left out.

    Keys that are no numbers are spread by a hash instead: a batch of them touches more partitions.
    """
    df = df.where(F.col(key).isNotNull())
    cuts = None
    if isinstance(df.schema[key].dataType, T.NumericType):
        shares = [i / parts for i in range(1, parts)]
        found = df.agg(F.percentile_approx(F.col(key).cast("double"), shares, 10 * parts)).first()[0] if shares else None
        cuts = sorted(set(found or [])) or [0.0]
    layout = {"version": 1, "key": key, "parts": parts, "cuts": cuts, "schema": df.schema.json()}
    placed = _with_part(df, key, layout)
    _overwrite_partitions(placed.repartition(PART), _data(path), PART)
    _save_layout(df.sparkSession, path, layout)
    return read_merge_table(df.sparkSession, path)


def read_merge_table(spark: SparkSession, path: str, with_part: bool = False) -> DataFrame:
    """The rows of the table; columns that came with a later batch are null in partitions it didn't touch."""
    schema = T.StructType.fromJson(json.loads(_layout(spark, path)["schema"]))
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.IntegerType())])).parquet(_data(path))
    return rows if with_part else rows.drop(PART)


def merge_partitions(spark: SparkSession, path: str, incoming: DataFrame, order_by: Sequence[str] | None = None) -> list[int]:
    """``upsert_nodes`` into a stored table; returns the partitions that were rewritten.

    Only partitions that the batch has keys of are read, merged and replaced.  The merged rows are stored beside the
    table first, so a write that is cut off can be repeated from the same batch with the same result.
    """
    layout = _layout(spark, path)
    key = layout["key"]
    batch = materialise(_with_part(incoming.where(F.col(key).isNotNull()), key, layout), "merge-batch")
    touched = sorted(r[PART] for r in batch.select(PART).distinct().collect())  # at most ``parts`` + 1 numbers
    if not touched:
        return []
    existing = read_merge_table(spark, path, with_part=True).where(F.col(PART).isin(touched)).drop(PART)
    merged = upsert_nodes(existing, batch.drop(PART), key, order_by)
    merged = materialise(merged, "merged-partitions")
    if merged.columns != existing.columns or merged.schema != existing.schema:
        grown = {**layout, "version": layout["version"] + 1, "schema": merged.schema.json()}
        _save_layout(spark, path, grown)
    _overwrite_partitions(_with_part(merged, key, layout).repartition(PART), _data(path), PART)
    return touched


def append_load(df: DataFrame, path: str, load_id: str) -> None:
    """Append rows as one load; the same load again takes the place of its first copy."""
    _overwrite_partitions(df.withColumn(LOAD, F.lit(load_id)), path, LOAD)
