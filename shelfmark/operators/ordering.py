"""Global order, exact order statistics and modes without one-task sorts."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.session import BROADCAST_ROWS, materialise

_SLOT_BITS = 33  # layout of monotonically_increasing_id: partition << 33 | row


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order_by``; null keys form one group.

    Spark turns this filter into a limit per group that also runs before the
    shuffle, so a hot key sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def with_positions(
    df: DataFrame, order_by: Sequence[str], position: str, start: int = 0, unique: bool = False
) -> DataFrame:
    """Number the rows ``start, start+1, ...`` in global order.

    Rows are range-partitioned and sorted inside each partition, written once,
    and shifted by the row counts of the partitions before theirs.  The count
    table has one row per partition, so its broadcast is bounded.  Unless the
    order is ``unique``, equal rows are told apart by a hash of the row and
    their input partition, so that many equal rows spread over partitions.
    """
    keyed, order = df, [F.col(c) for c in order_by]
    if not unique:
        hashable = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]
        keyed = df.withColumn("_hash", F.xxhash64(*hashable)).withColumn("_input", F.spark_partition_id())
        order += [F.col("_hash"), F.col("_input")]
    slotted = (
        keyed.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*df.columns, F.monotonically_increasing_id().alias("_slot"))
    )
    stored = materialise(slotted, "positions").withColumn("_part", F.shiftright("_slot", _SLOT_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    row = F.col("_slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))
    return stored.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + row + F.lit(start)).cast("bigint").alias(position), *[F.col(c) for c in df.columns]
    )


def dense_ids(names: DataFrame, name: str, id_col: str) -> DataFrame:
    """Ids from 1 in code-point order of a column of distinct names."""
    return with_positions(names, [name], id_col, start=1, unique=True)


# A group of up to this many rows may be ordered inside one task.
GROUP_ROWS = 1_000_000


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    group_rows: int = GROUP_ROWS,
    buckets: int = 1024,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Exact linear-interpolated percentiles per key, one column per entry of ``probs``; NaN counts as missing.

    ``percentile`` and ``median`` hold all distinct values of a group in the
    memory of one task.  Here groups up to ``group_rows`` are ordered by a
    window, which spills.  Larger ones are never gathered: see
    :func:`_bucket_ranks`.  ``sizes`` may name a stored table of the keys with
    a row count ``_n`` each, at least that of the values, to spare a pass.
    """
    keys = list(keys)
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if sizes is None else sizes.dropna(subset=keys)
    large = counted.where(F.col("_n") > group_rows).select(*keys)
    large_keys = large.limit(BROADCAST_ROWS + 1).count()
    if not large_keys:
        return _interpolated(_window_ranks(rows, keys, probs), keys, probs)
    large = materialise(large, "large-groups")
    marked = F.broadcast(large) if large_keys <= BROADCAST_ROWS else large
    usual = _window_ranks(rows.join(marked, keys, "left_anti"), keys, probs)
    split = _bucket_ranks(rows.join(marked, keys, "left_semi"), keys, probs, buckets)
    return _interpolated(usual.unionByName(split), keys, probs)


def _ranks(p: float) -> tuple[Column, Column]:
    """Ranks from 0 next to a share of a group of ``_total`` rows."""
    exact = F.lit(float(p)) * (F.col("_total") - 1).cast("double")
    return F.floor(exact), F.ceil(exact)


def _holds(rank: Column, first: str, n: Column) -> Column:
    return (rank >= F.col(first)) & (rank < F.col(first) + n)


def _wanted(probs: Mapping[str, float], first: str, n: Column) -> Column:
    ranks = [rank for p in probs.values() for rank in _ranks(p)]
    wanted = F.lit(False)
    for rank in ranks:
        wanted = wanted | _holds(rank, first, n)
    return wanted


def _window_ranks(rows: DataFrame, keys: list[str], probs: Mapping[str, float]) -> DataFrame:
    """The rows at the wanted ranks: (keys, _v, _first, _c, _total)."""
    in_key = Window.partitionBy(*keys)
    ranked = rows.select(
        *keys,
        "_v",
        (F.row_number().over(in_key.orderBy("_v")) - 1).cast("bigint").alias("_first"),
        F.lit(1).cast("bigint").alias("_c"),
        F.count(F.lit(1)).over(in_key).alias("_total"),
    )
    return ranked.where(_wanted(probs, "_first", F.col("_c")))


def _bucket_ranks(rows: DataFrame, keys: list[str], probs: Mapping[str, float], buckets: int) -> DataFrame:
    """The same for groups too large for one task.

    Equi-depth cut points of the whole column (a fixed number of doubles)
    split every group into buckets.  Bucket counts, combined on the map side,
    tell which bucket holds each wanted rank; only the distinct values of
    those buckets are shuffled and ordered.  One task meets at most about
    1/``buckets`` of all rows, whatever the size of a group.
    """
    # One literal keeps the plan small, however many shares it lists.
    shares = F.split(F.lit(",".join(str(i / buckets) for i in range(1, buckets))), ",").cast("array<double>")
    cuts = rows.agg(F.percentile_approx("_v", shares, 10 * buckets)).first()[0] or []
    inner = sorted({c for c in cuts if math.isfinite(c)}) or [0.0]
    splits = [-math.inf, *inner, math.inf]
    bucketed = Bucketizer(splits=splits, inputCol="_v", outputCol="_b", handleInvalid="keep").transform(rows)

    in_key = Window.partitionBy(*keys)
    earlier = in_key.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        bucketed.groupBy(*keys, "_b")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *keys,
            "_b",
            "_n",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_n").over(in_key).alias("_total"),
        )
    )
    # Stored, so that Spark plans the join below with its true size.
    hit = materialise(
        placed.where(_wanted(probs, "_before", F.col("_n"))).select(*keys, "_b", "_before", "_total"), "ranks"
    )
    in_bucket = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    values = (
        bucketed.join(hit, [*keys, "_b"])
        .groupBy(*keys, "_b", "_v")
        .agg(F.count(F.lit(1)).alias("_c"), F.max("_before").alias("_before"), F.max("_total").alias("_total"))
    )
    first = F.col("_before") + F.coalesce(F.sum("_c").over(in_bucket), F.lit(0))
    return values.select(*keys, "_v", first.alias("_first"), "_c", "_total")


def _interpolated(ranked: DataFrame, keys: list[str], probs: Mapping[str, float]) -> DataFrame:
    picks, results = [], []
    for i, (name, p) in enumerate(probs.items()):
        low, high = _ranks(p)
        picks.append(F.max(F.when(_holds(low, "_first", F.col("_c")), F.col("_v"))).alias(f"_low{i}"))
        picks.append(F.max(F.when(_holds(high, "_first", F.col("_c")), F.col("_v"))).alias(f"_high{i}"))
        exact = F.lit(float(p)) * (F.col("_total") - 1).cast("double")
        step = F.col(f"_high{i}") - F.col(f"_low{i}")
        results.append((F.col(f"_low{i}") + step * (exact - F.floor(exact).cast("double"))).alias(name))
    return ranked.groupBy(*keys).agg(F.max("_total").alias("_total"), *picks).select(*keys, *results)


def mode_per_key(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """Most frequent non-null value per key, the smallest one on ties.

    Counting (key, value) pairs first means a hot key arrives at its final
    group as one row per distinct value, already combined on the map side.
    """
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    best = F.min(F.struct((-F.col("_n")).alias("_rank"), F.col("_value").alias("_value")))
    return counted.groupBy(*keys).agg(best.alias("_best")).select(*keys, F.col("_best._value").alias(alias))
