"""What one task holds does not grow with the input."""

import pytest
from pyspark.sql import functions as F

from shelfmark import session
from shelfmark.plans.store import open_store

SCAN, SHUFFLE = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture
def conf(spark):
    before = {key: spark.conf.get(key, None) for key in (SCAN, SHUFFLE, FIRST)}
    for key in before:
        spark.conf.unset(key)
    yield spark.conf
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_store_lowers_what_one_task_scans_and_gathers(spark, conf, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "TASK_BYTES", 1 << 20)
    conf.set(FIRST, "64")
    spark.range(10).write.parquet(str(tmp_path / "part.parquet"))
    open_store(spark, str(tmp_path))
    links = spark.range(2_000_000, numPartitions=8).select(F.xxhash64("id").alias("game"), (F.col("id") % 1000).alias("dev"))
    links.distinct().write.parquet(str(tmp_path / "links"))
    stored = spark.read.parquet(str(tmp_path / "links"))
    tasks = stored.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    assert stored.count() == 2_000_000
    assert tasks.agg(F.max("n")).first()[0] <= 150_000


def test_smaller_sizes_stay(spark, conf, tmp_path):
    conf.set(SCAN, "2m")
    conf.set(SHUFFLE, "64m")
    session.bound_tasks(spark)
    assert (conf.get(SCAN), conf.get(SHUFFLE)) == ("2m", f"{session.TASK_BYTES}b")


def test_a_larger_folder_gets_more_partitions_in_the_same_session(spark, conf, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "PARTITION_BYTES", 300)
    for name, size in (("small", 1000), ("large", 4000)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "bytes").write_bytes(b"x" * size)
        session.size_shuffles(spark, str(tmp_path / name))
        assert conf.get(FIRST) == str(size // 100)
    session.size_shuffles(spark, str(tmp_path / "small"))
    assert conf.get(FIRST) == "40"
    conf.set(FIRST, "9")
    session.size_shuffles(spark, str(tmp_path / "large"))
    assert conf.get(FIRST) == "9"
