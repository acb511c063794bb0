"""Writers, prepared-data checkpoints and checks of target tables."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows per insert of a relational target.
INSERT_BATCH = 1000


def prepared_path(root: str, dataset: str, limit: int | None = None) -> str:
    return f"{root.rstrip('/')}/{dataset}{'' if limit is None else f'_{limit}'}_prepared"


#: Stands for a frame that names no source to compare with.
NO_SOURCE = "any"


def source_fingerprint(spark: SparkSession, path: str, parameters: Mapping[str, object] | None = None, types: Mapping[str, object] | None = None) -> str | None:
    """A name for what a frame is made of: the files at ``path`` (their names, lengths and times), parameters and column types.

    None if there are no files to be listed.  Only the list of files is read, and of it only a few sums come to the driver.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
        told = [F.xxhash64(F.lit(seed), "path", "length", F.unix_micros("modificationTime")) for seed in (1, 2)]
        found = files.agg(F.count(F.lit(1)), F.sum("length"), *[F.bit_xor(h) for h in told]).first()
    except AnalysisException:
        return None
    if not found[0]:
        return None
    made_of = [list(found), sorted((k, repr(v)) for k, v in (parameters or {}).items()), sorted((k, str(v)) for k, v in (types or {}).items())]
    return hashlib.sha256(json.dumps(made_of).encode()).hexdigest()[:32]


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders at ``path`` whose writing came to its end."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/*/_SUCCESS")  # written after the last file of a job
    found = marker.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marker) or []
    return sorted(status.getPath().getParent().getName() for status in found)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the complete versions of a stored frame, the newest last."""
    return sorted(complete_folders(spark, path), key=lambda name: name.split("-")[1])


def load_prepared(spark: SparkSession, root: str, dataset: str, limit: int | None = None, fingerprint: str | None = None) -> DataFrame | None:
    """The newest complete version of the stored frame, or None.

    With a fingerprint only versions that were stored under it count.
    """
    path = prepared_path(root, dataset, limit)
    fitting = [v for v in _versions(spark, path) if fingerprint is None or v.split("-")[0] == fingerprint]
    return spark.read.parquet(f"{path}/{fitting[-1]}") if fitting else None


def save_prepared(df: DataFrame, root: str, dataset: str, limit: int | None = None, fingerprint: str | None = None) -> DataFrame:
    """Store a frame as a version of its own; earlier versions stay, as others may be reading them."""
    version = f"{fingerprint or NO_SOURCE}-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    path = f"{prepared_path(root, dataset, limit)}/{version}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_old_versions(spark: SparkSession, root: str, dataset: str, limit: int | None = None, keep: int = 1) -> list[str]:
    """Delete all but the newest complete versions, and what older writers left half-written; the names deleted."""
    path = prepared_path(root, dataset, limit)
    kept = _versions(spark, path)[-keep:] if keep else []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    oldest = min((name.split("-")[1] for name in kept), default="9")
    gone = sorted(name for name in names if name not in kept and name.split("-")[1] < oldest)
    for name in gone:
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)
    return gone


def prepared(
    spark: SparkSession, root: str, dataset: str, build: Callable[[], DataFrame], limit: int | None = None,
    use_cache: bool = True, fingerprint: str | None = None,
) -> DataFrame:
    """Read a stored frame back if present, else build and store it.

    With a fingerprint, a frame made of anything else is built anew.
    """
    found = load_prepared(spark, root, dataset, limit, fingerprint) if use_cache else None
    return found if found is not None else save_prepared(build(), root, dataset, limit, fingerprint)


def _flat(df: DataFrame, json_columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.to_json(c) for c in json_columns if c in df.columns})


def _typed(df: DataFrame, column_types: Mapping[str, str] | None) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in (column_types or {}).items()})


def append_table(
    df: DataFrame,
    table: str,
    json_columns: Sequence[str] = (),
    column_types: Mapping[str, str] | None = None,
    path: str | None = None,
) -> None:
    """Append to a catalogue table; nested columns travel as JSON text."""
    writer = _typed(_flat(df, json_columns), column_types).write.mode("append").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def append_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], json_columns: Sequence[str] = (),
    column_types: Mapping[str, str] | None = None, connections: int = 16,
) -> None:
    """Append to a relational database, batched, over a bounded number of connections."""
    options = {"batchsize": str(INSERT_BATCH), "numPartitions": str(connections), **properties}
    _typed(_flat(df, json_columns), column_types).write.jdbc(url, table, mode="append", properties=options)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Store a table bucketed by its join key: later joins on it need no shuffle.

    For keys without hot values.  A bucket is read by one task, which adaptive
    execution cannot split; leave a table with a hot key unbucketed.
    """
    spread = df.hint("rebalance", buckets, key)
    writer = spread.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def in_key_order(df: DataFrame, *keys: str) -> DataFrame:
    """Rows range-partitioned and sorted by ``keys``, for tables filtered by the first key.

    The further keys split a hot value of the first one over partitions.
    """
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_documents(df: DataFrame, path: str, batch_size: int = 0) -> None:
    """One JSON document per row; ``batch_size`` caps the documents per file."""
    writer = df.write.mode("overwrite")
    (writer.option("maxRecordsPerFile", batch_size) if batch_size > 0 else writer).json(path)


def write_document_store(df: DataFrame, uri: str, database: str, collection: str) -> None:
    """Append to a document store through its Spark connector, where installed."""
    options = {"connection.uri": uri, "database": database, "collection": collection}
    df.write.format("mongodb").mode("append").options(**options).save()


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; text with quotes or line breaks is quoted."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_reports(log: DataFrame, statistics: DataFrame, path: str) -> None:
    """Run log and statistics as CSV, and one JSON document per test."""
    write_csv(log, f"{path}/raw_results")
    write_csv(statistics, f"{path}/statistics")
    entry = F.struct(*[c for c in statistics.columns if c != "test_name"])
    per_test = statistics.groupBy(F.col("test_name").alias("name")).agg(F.sort_array(F.collect_list(entry)).alias("results"))
    per_test.write.mode("overwrite").json(f"{path}/test_results")


def drop_tables(spark: SparkSession, tables: Sequence[str]) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def truncate_tables(spark: SparkSession, tables: Sequence[str]) -> None:
    for table in tables:
        if spark.catalog.tableExists(table):
            spark.sql(f"TRUNCATE TABLE {table}")


def tables_empty(spark: SparkSession, tables: Sequence[str]) -> bool:
    """True when every table is absent or has no row."""
    return all(not spark.catalog.tableExists(t) or spark.table(t).isEmpty() for t in tables)


def documents_empty(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(target, is_empty) of document targets; one that was never written is empty."""

    def empty(path: str) -> bool:
        try:
            return spark.read.text(path).isEmpty()
        except AnalysisException:
            return True

    return spark.createDataFrame([(name, empty(path)) for name, path in paths.items()], "target string, is_empty boolean")


def labels_empty(nodes: DataFrame, labels: Sequence[str]) -> DataFrame:
    """(target, is_empty) of node labels in a table with a ``label`` column."""
    wanted = nodes.sparkSession.createDataFrame([(label,) for label in labels], "target string")
    found = nodes.where(F.col("label").isin(list(labels))).select("label").distinct()
    return wanted.join(found, F.col("target") == F.col("label"), "left").select("target", F.col("label").isNull().alias("is_empty"))


def row_count_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) over many tables, in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    audit = parts[0]
    for part in parts[1:]:
        audit = audit.unionByName(part)
    return audit
