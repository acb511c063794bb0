"""Merges and loads by partitions, and versions of prepared frames."""

import os
import time

from pyspark.sql import functions as F

from shelfmark.operators.graph import upsert_nodes
from shelfmark.sources import partitioned, sinks


def _files(path):
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                full = os.path.join(folder, name)
                found[os.path.relpath(full, path)] = os.stat(full).st_mtime_ns
    return found


def _rows(df):
    columns = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_a_small_batch_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    existing = spark.range(10_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    partitioned.create_merge_table(existing, path, "k", 50)
    before = _files(f"{path}/data")
    batch = spark.range(4_000, 4_100).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v"))  # one percent of the keys
    touched = partitioned.merge_partitions(spark, path, batch)
    after = _files(f"{path}/data")
    same = {name for name in before if after.get(name) == before[name]}
    assert len(touched) <= 2 and {n.split("/")[0] for n in before if n not in same} == {f"key_part={p}" for p in touched}
    assert _rows(partitioned.read_merge_table(spark, path)) == _rows(upsert_nodes(existing, batch, "k"))


def test_merge_equals_upsert_with_new_columns_nulls_and_repeats(spark, tmp_path):
    for keys, name in ((lambda c: c, "numbers"), (lambda c: F.concat(F.lit("key"), c.cast("string")), "texts")):
        path = str(tmp_path / name)
        existing = spark.range(200).select(keys(F.col("id")).alias("k"), F.col("id").alias("v"))
        existing = existing.unionByName(spark.createDataFrame([(None, 1)], ", ".join(f"{n} {t}" for n, t in existing.dtypes)))
        partitioned.create_merge_table(existing, path, "k", 8)
        batch = spark.range(150, 260).select(keys(F.col("id")).alias("k"), F.lit(None).cast("long").alias("v"), F.lit("new").alias("w"), F.lit(1).alias("at"))
        batch = batch.unionByName(batch.withColumns({"w": F.lit("newer"), "at": F.lit(2)}))
        partitioned.merge_partitions(spark, path, batch, order_by=["at"])
        want = _rows(upsert_nodes(existing, batch, "k", order_by=["at"]))
        assert _rows(partitioned.read_merge_table(spark, path)) == want
        partitioned.merge_partitions(spark, path, batch, order_by=["at"])  # the same batch again
        assert _rows(partitioned.read_merge_table(spark, path)) == want
        assert partitioned.merge_partitions(spark, path, batch.limit(0)) == []


def test_a_table_may_begin_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.range(10).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    partitioned.create_merge_table(batch.limit(0), path, "k")
    assert partitioned.merge_partitions(spark, path, batch)
    assert _rows(partitioned.read_merge_table(spark, path)) == _rows(batch)


def test_a_load_twice_is_one_load(spark, tmp_path):
    path = str(tmp_path / "t")
    for load, rows in (("a", 10), ("b", 5), ("a", 10)):
        partitioned.append_load(spark.range(rows), path, load)
    counts = {r["load_id"]: r["count"] for r in spark.read.parquet(path).groupBy("load_id").count().collect()}
    assert counts == {"a": 10, "b": 5}


def test_changed_source_parameter_or_types_give_other_fingerprints(spark, tmp_path):
    source = str(tmp_path / "s")
    spark.range(10).write.parquet(source)
    first = sinks.source_fingerprint(spark, source, {"limit": 1}, {"id": "BIGINT"})
    assert first == sinks.source_fingerprint(spark, source, {"limit": 1}, {"id": "BIGINT"})
    others = [sinks.source_fingerprint(spark, source, {"limit": 2}, {"id": "BIGINT"}), sinks.source_fingerprint(spark, source, {"limit": 1}, {"id": "INT"})]
    time.sleep(0.01)
    spark.range(5).write.mode("append").parquet(source)
    others.append(sinks.source_fingerprint(spark, source, {"limit": 1}, {"id": "BIGINT"}))
    assert len({first, *others}) == 4
    assert sinks.source_fingerprint(spark, str(tmp_path / "nowhere")) is None


def test_half_written_versions_are_never_read_and_old_ones_go(spark, tmp_path):
    root = str(tmp_path)
    sinks.save_prepared(spark.range(3), root, "d", fingerprint="f")
    sinks.save_prepared(spark.range(4), root, "d", fingerprint="f")
    last = sorted(os.listdir(tmp_path / "d_prepared"))[-1]
    os.rename(tmp_path / "d_prepared" / last / "_SUCCESS", tmp_path / "d_prepared" / last / "_started")
    assert sinks.load_prepared(spark, root, "d", fingerprint="f").count() == 3
    assert sinks.load_prepared(spark, root, "d", fingerprint="other") is None
    held = sinks.load_prepared(spark, root, "d")
    sinks.save_prepared(spark.range(5), root, "d", fingerprint="f")
    assert held.count() == 3  # readers keep the version they opened
    assert len(sinks.drop_old_versions(spark, root, "d")) == 2
    assert sinks.load_prepared(spark, root, "d").count() == 5
