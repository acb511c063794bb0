"""Mixing sources to target weights with fixed-length blocks.

The words of a source form one stream, cut into blocks.  A source's share of the output is a number of slots; slot j
takes block ``permutation(j mod blocks)``, with a permutation of its own for every pass over the source.  Every slot
falls into an output shard by a random draw, so a shard's counts per source are multinomial.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import materialise, mix64, salt_of

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_WORDS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mix:
    """``weights`` are dealt to the sources in order, again and again; no source gives more than ``most`` times its size."""

    weights: tuple[int, ...] = (1, 2, 3)
    most: int = 3
    block_words: int = 256
    shard_slots: int = 1024
    seed: int = 20240
    buckets: int = 256
    bucket_rows: int = 1_000_000


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray, back: bool = False) -> np.ndarray:
    """A pseudorandom permutation of ``range(size)`` per key: a Feistel network, walked until it is in range."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2).astype(float))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, size = index.astype(np.uint64), size.astype(np.uint64)
    key = key.astype(np.int64).view(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        left, right, h, m, k = out[todo] >> half[todo], out[todo] & mask[todo], half[todo], mask[todo], key[todo]
        for turn in range(3, -1, -1) if back else range(4):
            if back:
                left, right = right ^ (mix64(left + k * np.uint64(2 * turn + 1) + np.uint64(turn)) & m), left
            else:
                left, right = right, left ^ (mix64(right + k * np.uint64(2 * turn + 1) + np.uint64(turn)) & m)
        out[todo] = (left << h) | right
        todo[todo] = out[todo] >= size[todo]
    return out.astype(np.int64)


@F.pandas_udf(T.LongType())
def _forth(index: pd.Series, size: pd.Series, key: pd.Series) -> pd.Series:
    with np.errstate(over="ignore"):
        return pd.Series(permuted(index.to_numpy(), size.to_numpy(), key.to_numpy()))


@F.pandas_udf(T.LongType())
def _back(index: pd.Series, size: pd.Series, key: pd.Series) -> pd.Series:
    with np.errstate(over="ignore"):
        return pd.Series(permuted(index.to_numpy(), size.to_numpy(), key.to_numpy(), True))


def source_targets(sized: DataFrame, mix: Mix) -> DataFrame:
    """``(source, source_size, target)``, a row per source: shares of all words by weight, none above its limit.

    What a source can't give is shared again by weight; every turn of the loop fetches two numbers.
    """
    sizes = materialise(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source-sizes")
    # Sources in order of code points, null last; this table has one row per source, not per document.
    order = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in mix.weights]), (F.col("nth") % len(mix.weights) + 1).cast("int"))
    sizes = materialise(sizes.withColumn("nth", order).withColumn("weight", weight), "source-weights")
    total = sizes.agg(F.sum("source_size")).first()[0] or 0
    level, limit = 0.0, F.col("source_size") * mix.most
    full, capped = 0, -1
    while full != capped:
        capped = full
        above = limit <= F.lit(level) * F.col("weight")
        got = sizes.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, limit)), F.sum(F.when(~above, F.col("weight")))
        ).first() if level else (0, 0, sizes.agg(F.sum("weight")).first()[0])
        full = got[0]
        if not got[2]:
            level = float("inf")
            break
        level = (total - (got[1] or 0)) / got[2]
        if not level:
            break
        full = sizes.where(limit <= F.lit(level) * F.col("weight")).count()
    target = F.least(limit.cast("double"), F.lit(level) * F.col("weight")) if level != float("inf") else limit.cast("double")
    return sizes.select("source", "source_size", target.alias("target"))


def _streams(sized: DataFrame, mix: Mix) -> DataFrame:
    """``sized`` with the place ``begin`` of every document's first word in its source's stream.

    A source is summed in salted buckets, so that one with most of the documents is spread over many tasks.  Files, splits
    and cores have no part in the order, so that reruns agree.
    """
    buckets = max(mix.buckets, -(-sized.count() // mix.bucket_rows))
    salted = sized.withColumn("bucket", salt_of("place", buckets, mix.seed))
    shares = salted.groupBy("source", "bucket").agg(F.sum("size").alias("share"))
    before = F.sum("share").over(Window.partitionBy("source").orderBy("bucket")) - F.col("share")
    shares = materialise(shares.select(F.col("source").alias("of_source"), F.col("bucket").alias("of_bucket"), before.alias("before")), "source-shares")
    # Documents are ordered by ident, source and text; rows that are equal in these may change places.
    in_order = Window.partitionBy("source", "bucket").orderBy("place", "ident", "uid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = F.sum("size").over(in_order) - F.col("size")
    fits = F.col("source").eqNullSafe(F.col("of_source")) & (F.col("bucket") == F.col("of_bucket"))
    return salted.withColumn("inside", inside).join(shares, fits).select("uid", "source", "size", (F.col("before") + F.col("inside")).alias("begin"))


def _slots(targets: DataFrame, mix: Mix) -> DataFrame:
    """``(source, slot, pass, block, take, shard)``: which block every slot takes, and how many of its words.

    Whole passes take each block once.  The last pass ends at the word that meets the target, so a slot may take the
    beginning of a block only.
    """
    size, words, b = F.col("source_size"), F.col("words"), F.lit(mix.block_words)
    plan = targets.where("source_size > 0").withColumn("words", F.least(F.round("target").cast("long"), size * mix.most))
    plan = plan.withColumn("blocks", F.ceil(size / b)).withColumn("passes", F.floor(words / size)).withColumn("rest", words % size)
    plan = plan.withColumn("short", size - (F.col("blocks") - 1) * b).withColumn("key", F.xxhash64(F.lit(mix.seed), "source", "passes"))
    plan = materialise(plan, "mix-plan").withColumn("last", _back(F.col("blocks") - 1, F.col("blocks"), F.col("key")))
    # Slots of the last pass before the target is met; its short block, at place ``last``, shifts the count.
    plain, shifted = F.floor(F.col("rest") / b), F.col("rest") + b - F.col("short")
    over = (plain >= F.col("last")) & (F.floor(shifted / b) > F.col("last"))
    plan = plan.withColumn("whole", F.when(over, F.floor(shifted / b)).otherwise(plain))
    plan = plan.withColumn("part", F.when(over, shifted % b).otherwise(F.col("rest") % b))
    plan = plan.withColumn("slots", F.col("passes") * F.col("blocks") + F.col("whole") + F.when(F.col("part") > 0, 1).otherwise(0))
    plan = materialise(plan.where("slots > 0"), "slot-plan")
    all_slots = plan.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-all_slots // mix.shard_slots))
    chunk = 10_000
    rows = plan.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / chunk))))
    # By number, as adaptive execution would see only the few rows before the explosion.
    rows = rows.repartition(int(max(1, -(-all_slots // (10 * chunk)))), "source", "chunk")
    last = F.least((F.col("chunk") + 1) * chunk, F.col("slots")) - 1
    rows = rows.withColumn("slot", F.explode(F.sequence(F.col("chunk") * chunk, last)))
    rows = rows.withColumn("turn", F.floor(F.col("slot") / F.col("blocks")))
    place = F.col("slot") % F.col("blocks")
    rows = rows.withColumn("block", _forth(place, F.col("blocks"), F.xxhash64(F.lit(mix.seed), "source", "turn")))
    take = F.when((F.col("turn") == F.col("passes")) & (place == F.col("whole")), F.col("part")).otherwise(b)
    shard = F.pmod(F.xxhash64(F.lit(mix.seed + 1), "source", "slot"), F.lit(shards))
    return rows.select("source", "slot", "turn", "block", take.alias("take"), shard.alias("shard"))


def _place(ident: str, source: str, text: str) -> Column:
    nulls = F.concat(*[F.col(c).isNull().cast("string") for c in (ident, source, text)])
    return F.xxhash64(F.lit(5), nulls, ident, source, text).alias("place")


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORDS)), F.lit(0)).cast("long")


def spans(sized: DataFrame, mix: Mix = Mix()) -> tuple[DataFrame, DataFrame]:
    """The mix and its targets: ``(uid, shard, slot, turn, source, from_word, to_word)`` and ``source_targets``.

    ``sized`` has a row ``(uid, place, ident, source, size)`` per document and must be a written table: ``uid`` is unique and
    fixed, ``place`` a hash of all that tells documents apart, and ``ident`` decides between equal hashes.
    """
    targets = materialise(source_targets(sized, mix), "source-targets")
    b = F.lit(mix.block_words)
    streams = _streams(sized.where("size > 0"), mix)
    ends = streams.withColumn("block", F.explode(F.sequence(F.floor(F.col("begin") / b), F.floor((F.col("begin") + F.col("size") - 1) / b))))
    low = F.greatest(F.col("begin"), F.col("block") * b)
    high = F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * b)
    parts = ends.select("uid", "source", "block", "begin", low.alias("low"), high.alias("high"))
    slots = _slots(targets, mix).withColumnRenamed("source", "slot_source").withColumnRenamed("block", "slot_block")
    # Both sides come out of explosions, whose size Spark underrates: neither may be broadcast.
    met = parts.hint("merge").join(slots, F.col("source").eqNullSafe(F.col("slot_source")) & (F.col("block") == F.col("slot_block")))
    end = F.least(F.col("high"), F.col("block") * b + F.col("take"))
    met = met.withColumn("from_word", F.col("low") - F.col("begin")).withColumn("to_word", end - F.col("begin"))
    return met.where("to_word > from_word").select("uid", "shard", "slot", "turn", "source", "from_word", "to_word"), targets


def mixed_sizes(docs: DataFrame, mix: Mix = Mix(), ident: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(ident, size, source_size, target, taken)`` of every row.

    ``size`` counts words, 0 for null and empty texts; null is a source of its own, the last one.  Repeated rows and
    null idents count as documents of their own.  An empty table gives no rows.
    """
    sized = docs.select(
        F.monotonically_increasing_id().alias("uid"), _place(ident, source, text), F.col(ident).alias("ident"), F.col(source).alias("source"), word_count(text).alias("size")
    )
    sized = materialise(sized, "sized")
    taken, targets = spans(sized.select("uid", "place", "ident", "source", "size"), mix)
    taken = taken.groupBy("uid").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    of = targets.withColumnRenamed("source", "of_source")
    out = sized.join(taken, "uid", "left").join(of, F.col("source").eqNullSafe(F.col("of_source")), "left")
    return out.select(F.col("ident").alias(ident), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, mix: Mix = Mix(), ident: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the mix takes words of, with these words as their text.

    A row holds its words of every pass, pass after pass, each on a new line.  Documents without words aren't taken.
    """
    fields = docs.columns
    kept = materialise(docs.withColumn("_uid", F.monotonically_increasing_id()), "mix-documents")
    sized = kept.select(
        F.col("_uid").alias("uid"), _place(ident, source, text), F.col(ident).alias("ident"), F.col(source).alias("source"), word_count(text).alias("size")
    )
    sized = materialise(sized, "sized")
    taken, _ = spans(sized, mix)
    parts = taken.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("turn", "from_word", "to_word"))).alias("_parts"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, parts: pd.Series) -> pd.Series:
        out = []
        for value, rows in zip(texts, parts):
            places = [m.span() for m in _WORD.finditer(value)]
            pieces, last = [], None
            for row in rows:
                turn, start, end = int(row["turn"]), int(row["from_word"]), int(row["to_word"])
                if last and last[0] == turn and last[2] == start:
                    last[2] = end
                else:
                    pieces.append(last := [turn, start, end])
            out.append("\n".join(value[places[a][0] : places[z - 1][1]] for _, a, z in pieces))
        return pd.Series(out, dtype=object)

    joined = kept.join(parts, F.col("_uid") == F.col("uid")).withColumn(text, cut(F.col(text), F.col("_parts")))
    return joined.select(*fields)
