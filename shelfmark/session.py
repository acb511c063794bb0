"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings the operators rely on.  UTC keeps timestamp text stable.
# Adaptive execution may split hot join keys even when that costs one more
# exchange downstream.  "First rows per group" windows drop the other rows
# before the shuffle, also for reports of up to a million rows.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
}

# A side is only ever marked for broadcast when its construction caps it at
# this many rows (a LIMIT, one row per partition, ...).  Everything else is
# left to Spark's own size estimates and to adaptive execution.
BROADCAST_ROWS = 100_000

_local_roots: dict[str, str] = {}


def build_session(app: str = "shelfmark", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# Bytes of files that one task scans at most, and of a shuffle that adaptive execution gathers for one task at most.
# Two columns of whole numbers take four bytes a row in a stored table in key order and ten in a shuffle, and a hundred
# or more in the hash table of an aggregate: with Spark's 128 MB and 64 MB that is gigabytes in one task.
TASK_BYTES = 8 << 20
_CEILINGS = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def bound_tasks(spark: SparkSession) -> None:
    """Lower Spark's sizes of scan and shuffle partitions to ``TASK_BYTES``, so that more input makes more tasks.

    Smaller values stay.
    """
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key in _CEILINGS:
        if as_bytes(spark.conf.get(key)) > TASK_BYTES:
            spark.conf.set(key, f"{TASK_BYTES}b")


# Bytes that one shuffle partition should hold, and how much larger rows are there than in compressed files.
PARTITION_BYTES, EXPANSION = 64 << 20, 3
_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_sized: dict[str, str] = {}  # the number set here, by application


def size_shuffles(spark: SparkSession, path: str) -> None:
    """Let shuffles start with as many partitions as the files below ``path`` call for.

    Adaptive execution merges those that turn out small.  A number that the
    user has set stays; one set for a smaller folder grows.
    """
    app, known = spark.sparkContext.applicationId, spark.conf.get(_PARTITIONS, None)
    if known and known != _sized.get(app):
        return
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    total = files.agg(F.sum("length")).first()[0] or 0  # file lengths only; no content is read
    wanted = -(-total * EXPANSION // PARTITION_BYTES)
    if wanted > max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(known or 0)):
        spark.conf.set(_PARTITIONS, str(wanted))
        _sized[app] = str(wanted)


def spread(df: DataFrame) -> DataFrame:
    """The rows of ``df`` dealt evenly over a few tasks per core, before a step that computes much per row.

    A scan makes tasks by bytes and by row groups; rows that compress well come in few of either.
    """
    spark = df.sparkSession
    return df.repartition(max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get(_PARTITIONS, None) or 0)))


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local folder would not be visible to other executors.
    """
    app = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/shelfmark-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="shelfmark-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, once the results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result no longer depends on the lineage of ``df``: later readers see
    the same rows in the same partitions even when executors are lost, and
    Spark knows the true size of the data for its join choices.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
