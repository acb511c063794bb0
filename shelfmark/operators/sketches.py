"""Small summaries of large key columns: which keys repeat, and which are frequent.

Both pack what a task has seen of hashed keys before anything is shuffled, and leave the exact answer to a step that reads
only the rows that can matter.  A hash that two keys share makes that step larger, never wrong.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.session import BROADCAST_ROWS, materialise

# Hashes that a task sorts at a time, which bounds the memory of its worker, and counters that it keeps of them.
FLUSH, COUNTERS = 1_000_000, 4096


def key_hash(key: Sequence[str]) -> Column:
    """64 bits of a key; null is a value like any other, so the parts that are null take part."""
    nulls = F.concat(F.lit("n"), *[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in key])
    return F.xxhash64(nulls, *key)


def _in_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The different hashes of each run of ``FLUSH`` rows, and how often they occur; one buffer takes the rows of every run."""
    buffer, n = np.empty(FLUSH, np.int64), 0
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False)
        while len(values):
            taken = values[: FLUSH - n]
            buffer[n : n + len(taken)] = taken
            n, values = n + len(taken), values[len(taken) :]
            if n == FLUSH:
                yield _counted(buffer)
                n = 0
    if n:
        yield _counted(buffer[:n])


def _counted(run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    run.sort()
    starts = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
    return run[starts], np.diff(starts, append=len(run))


def hashes_seen_twice(df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, int]:
    """``(bucket, rest)`` of the hashes that more than one row has, stored, and their number up to ``BROADCAST_ROWS + 1``.

    A hash travels as four bytes in an array per task and bucket, and at most twice however many rows have it.
    """
    spark = df.sparkSession
    hashed = df.select(key_hash(key).alias("h"))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), hashed.rdd.getNumPartitions())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, counts in _in_runs(batches):
            own = np.repeat(own, np.minimum(counts, 2))
            bucket, rest = own % buckets, (own // buckets).astype(np.uint64).astype(np.uint32).view(np.int32)
            order = np.argsort(bucket, kind="stable")
            bucket, rest = bucket[order], rest[order]
            starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            offsets = pa.array(np.append(starts, len(rest)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[starts], pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(rest, pa.int32()))], names=["bucket", "rests"]
            )

    packed = hashed.mapInArrow(pack, "bucket long, rests array<int>").repartition(buckets, "bucket")
    seen = packed.select("bucket", F.explode("rests").alias("rest")).groupBy("bucket", "rest").agg(F.count(F.lit(1)).alias("n"))
    twice = materialise(seen.where("n > 1").select("bucket", "rest"), "seen-twice")
    return twice.withColumn("buckets", F.lit(buckets)), twice.limit(BROADCAST_ROWS + 1).count()


def rows_seen_twice(df: DataFrame, key: Sequence[str], twice: DataFrame) -> DataFrame:
    """The rows whose hash is among ``twice``, which has at most ``BROADCAST_ROWS`` of them."""
    buckets = twice.select("buckets").first()["buckets"]
    h = key_hash(key)
    bucket = F.pmod(h, F.lit(buckets).cast("bigint"))
    marked = df.withColumn("_h", h).withColumn("_bucket", bucket)
    # The last 32 bits of the quotient rounded down, as the packing task has it.
    low = F.expr(f"_h div {buckets} - if(_h % {buckets} < 0, 1, 0)").bitwiseAND(F.lit(0xFFFFFFFF))
    marked = marked.withColumn("_rest", F.when(low >= 1 << 31, low - (1 << 32)).otherwise(low).cast("int"))
    known = F.broadcast(twice.select(F.col("bucket").alias("_bucket"), F.col("rest").alias("_rest")))
    return marked.join(known, ["_bucket", "_rest"], "left_semi").select(*df.columns)


def frequent_hashes(df: DataFrame, key: Sequence[str], limit: int) -> DataFrame | None:
    """``hash`` of all keys that can be among the ``limit`` most frequent ones, ties included; None if the summary can't tell.

    Every task keeps the exact counts of its ``COUNTERS`` most frequent hashes of each run, and the largest count that it
    let go.  Added up, the kept counts bound a key's rows from below, and with all that was let go from above.
    """
    hashed = df.select(key_hash(key).alias("h"))

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, counts in _in_runs(batches):
            order = np.argsort(-counts, kind="stable")
            kept, gone = order[:COUNTERS], order[COUNTERS : COUNTERS + 1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*own[kept].tolist(), None], pa.int64()),
                    pa.array([*counts[kept].tolist(), int(counts[gone[0]]) if len(gone) else 0], pa.int64()),
                ],
                names=["hash", "least"],
            )

    summary = hashed.mapInArrow(summarise, "hash long, least long").groupBy("hash").agg(F.sum("least").alias("least"))
    summary = materialise(summary, "frequencies")
    let_go = summary.where("hash is null").select("least").first()
    if let_go is None:
        return None
    first = [r["least"] for r in summary.where("hash is not null").orderBy(F.desc("least")).limit(limit).select("least").collect()]
    if len(first) < limit or first[-1] <= let_go["least"]:
        # Too few keys, or one that was let go everywhere might be as frequent as the last of them.
        return summary.where("hash is not null").select("hash") if let_go["least"] == 0 else None
    return summary.where(F.col("least") + let_go["least"] >= first[-1]).where("hash is not null").select("hash")


def frequent_keys(df: DataFrame, key: str, limit: int, count: str = "row_count") -> DataFrame:
    """``(key, count)`` of the most frequent keys, ties by key; a null key is no key.

    Only rows of keys that can be in the result are counted one by one.  Where all keys are about equally rare, no summary
    tells them apart, and all are counted.
    """
    rows = df.select(key).where(F.col(key).isNotNull())
    hashes = frequent_hashes(rows, [key], limit)
    if hashes is not None and hashes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        rows = rows.withColumn("hash", key_hash([key])).join(F.broadcast(hashes), "hash", "left_semi").drop("hash")
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias(count))
    return counted.orderBy(F.desc(count), F.asc(key)).limit(limit)
