"""Order-independent digests of rows, and comparison of two tables by digests of key ranges.

Two equal tables are told to be equal from a few numbers per key range: each task adds up the hashes of the rows it reads,
and only those sums are shuffled.  Ranges whose sums differ are cut by a hash of the key and summed again; rows are
moved only for what then still differs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.session import BROADCAST_ROWS, materialise

# A row's two 64-bit hashes are added in pieces of so many bits; a sum stays below 2^63 for up to 2^33 rows of one range.
_PIECE = 30
_SUMS = ("_rows", "_s0", "_s1", "_s2", "_s3")


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType)


def comparable(value: Column, kind: T.DataType) -> Column:
    """The value with every map as the sorted array of its entries, so that it can be compared, ordered and hashed."""
    if not has_map(kind):
        return value
    if isinstance(kind, T.MapType):
        entry = F.transform(F.map_entries(value), lambda e: F.struct(comparable(e["key"], kind.keyType).alias("key"), comparable(e["value"], kind.valueType).alias("value")))
        return F.array_sort(entry)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda e: comparable(e, kind.elementType))
    return F.when(value.isNotNull(), F.struct(*[comparable(value[f.name], f.dataType).alias(f.name) for f in kind]))


def _hashed_form(value: Column, kind: T.DataType, other: T.DataType) -> Column:
    """One form for both sides: numbers as doubles, equal types as they are, nested values with their nulls as JSON."""
    if isinstance(kind, T.NumericType) and isinstance(other, T.NumericType):
        return value.cast("double")
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        # A hash passes over nulls, so [null, 1] and [1, null] would look alike.
        return F.to_json(F.struct(comparable(value, kind).alias("v")), {"ignoreNullFields": "false"})
    return value if kind == other else value.cast("string")


def row_hashes(df: DataFrame, other: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of the named columns, equal for rows of both frames that hold equal values."""
    values = [_hashed_form(F.col(f"`{c}`"), df.schema[c].dataType, other.schema[c].dataType) for c in columns]
    # Which values are null is part of the hash, as nulls themselves add nothing to it.
    nulls = F.concat(F.lit("n"), *[F.when(v.isNull(), F.lit("1")).otherwise(F.lit("0")) for v in values])
    return F.xxhash64(F.lit(11), nulls, *values), F.xxhash64(F.lit(23), nulls, *values)


def _sums() -> list[Column]:
    piece = F.lit((1 << _PIECE) - 1)
    pieces = [p for h in ("_h1", "_h2") for p in (F.col(h).bitwiseAND(piece), F.shiftrightunsigned(h, _PIECE).bitwiseAND(piece))]
    return [F.count(F.lit(1)).alias("_rows"), *[F.sum(p).alias(f"_s{k}") for k, p in enumerate(pieces)]]


def _ordinals(left: DataFrame, right: DataFrame, key: str) -> tuple[Column, Column]:
    """The key as a number that grows with it, for either side."""
    kinds = [df.schema[key].dataType for df in (left, right)]
    k = F.col(f"`{key}`")
    if all(isinstance(kind, (T.NumericType, T.BooleanType)) for kind in kinds):
        return (k.cast("double"),) * 2
    if all(isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) for kind in kinds):
        return (F.unix_micros(k.cast("timestamp")).cast("double"),) * 2
    if all(isinstance(kind, T.StringType) for kind in kinds):
        ends = [df.agg(F.min(k).alias("a"), F.max(k).alias("b")).first() for df in (left, right)]
        known = [v for row in ends for v in row if v is not None]
        low, high = (min(known, key=str.encode), max(known, key=str.encode)) if known else ("", "")
        shared = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        # Six bytes after what all keys begin with fit a double.
        tail = F.rpad(F.hex(F.substring(F.encode(F.substring(k, shared + 1, 6), "UTF-8"), 1, 6)), 12, "0")
        return (F.conv(tail, 16, 10).cast("double"),) * 2
    return (F.xxhash64(k.cast("string")).cast("double"),) * 2


def _in_ranges(df: DataFrame, ordinal: Column, cuts: list[float]) -> DataFrame:
    """Column ``_range``: the number of the key's range, -1 for the null key."""
    placed = df.withColumn("_ordinal", F.coalesce(ordinal, F.lit(0.0)))
    split = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_ordinal", outputCol="_bucket", handleInvalid="keep")
    number = F.when(ordinal.isNull(), F.lit(-1)).otherwise(F.col("_bucket").cast("int"))
    return split.transform(placed).withColumn("_range", number).drop("_bucket", "_ordinal")


def _differing(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """The groups whose sums differ between both sides, with the rows of either."""
    sides = []
    for df, sign in ((left, 1), (right, -1)):
        sums = df.groupBy(*by).agg(*_sums())
        both = [F.when(F.lit(sign == s), F.col("_rows")).otherwise(0).alias(n) for s, n in ((1, "left_rows"), (-1, "right_rows"))]
        sides.append(sums.select(*by, *both, *[(F.col(c) * sign).alias(c) for c in _SUMS]))
    merged = sides[0].unionByName(sides[1]).groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("left_rows", "right_rows", *_SUMS)])
    apart = F.lit(False)
    for c in _SUMS:
        apart = apart | (F.col(c) != 0)
    return merged.withColumn("differs", apart).drop(*_SUMS)


def _prepared(left: DataFrame, right: DataFrame, key: str, ranges: int) -> tuple[DataFrame, DataFrame]:
    common = [key, *[c for c in left.columns if c in right.columns and c != key]]
    ordinals = _ordinals(left, right, key)
    shares = F.split(F.lit(",".join(str(i / ranges) for i in range(1, ranges))), ",").cast("array<double>")
    sides, cuts = [], []
    for df, other, ordinal in ((left, right, ordinals[0]), (right, left, ordinals[1])):
        h1, h2 = row_hashes(df, other, common)
        sides.append(df.withColumns({"_h1": h1, "_h2": h2}))
    if ranges > 1:
        # Equal shares of the left table's rows; a fixed number of doubles.
        found = left.select(ordinals[0].alias("o")).agg(F.percentile_approx("o", shares, 10 * ranges)).first()[0] or []
        cuts = sorted({c for c in found if math.isfinite(c)})
    return tuple(_in_ranges(df, ordinal, cuts or [0.0]) for df, ordinal in zip(sides, ordinals))


def range_report(left: DataFrame, right: DataFrame, key: str, ranges: int = 1024) -> DataFrame:
    """``(range, left_rows, right_rows, differs)`` per key range, in the order of the keys; -1 is the null key's."""
    one, two = _prepared(left, right, key, ranges)
    return _differing(one, two, ["_range"]).withColumnRenamed("_range", "range")


def differing_rows(left: DataFrame, right: DataFrame, key: str, ranges: int = 1024, fan: int = 64) -> tuple[DataFrame, DataFrame] | None:
    """The rows of both sides that stand in differing ranges; None if there is no such range.

    Equal tables shuffle sums alone: ``ranges`` rows per task at most.  Ranges that differ are read again, cut in ``fan``
    parts by a hash of the key, and of those parts only the differing ones stay.
    """
    if ranges * fan > BROADCAST_ROWS:
        raise ValueError(f"ranges * fan must not exceed {BROADCAST_ROWS}")
    one, two = _prepared(left, right, key, ranges)
    numbers = [r["_range"] for r in _differing(one, two, ["_range"]).where("differs").collect()]  # at most ``ranges`` + 2
    if not numbers:
        return None
    numeric = all(isinstance(df.schema[key].dataType, T.NumericType) for df in (left, right))
    part = F.pmod(F.xxhash64(F.col(f"`{key}`").cast("double") if numeric else F.col(f"`{key}`").cast("string")), F.lit(fan))
    sides = [df.where(F.col("_range").isin(numbers)).withColumn("_part", part) for df in (one, two)]
    parts = _differing(*sides, ["_range", "_part"]).where("differs").select("_range", "_part")
    parts = materialise(parts, "differing-parts")  # at most ``ranges`` * ``fan`` rows
    return tuple(df.join(F.broadcast(parts), ["_range", "_part"], "left_semi").select(*original.columns) for df, original in zip(sides, (left, right)))
