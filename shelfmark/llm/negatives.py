"""Hard negatives by a vertical scan with branch-and-bound (BOND).

Rows are stored in blocks, column by column, with the smallest and largest value of each column.  A block is scanned for
one anchor in the order of the anchor's largest components; after every few columns, what the remaining ones can still
add at least and at most bounds each row's score, and rows that can no longer matter leave the bitmap.  What is left
when no row can leave any more, or the columns end, has its exact score.

All scores are integers.  They are added as doubles where no sum can reach 2^53, and as Python integers otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import materialise
from shelfmark.operators.ordering import with_positions
from shelfmark.session import BROADCAST_ROWS


@dataclass(frozen=True)
class Mining:
    """``block`` rows are scanned for ``anchors`` anchors at a time; a task has at most ``share`` such pairs of a block.

    Scores of negatives lie between ``low`` and ``high`` percent of the positive's.  The first scan step reads ``step``
    columns, every further one twice as many as the one before.
    """

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    block: int = 4096
    anchors: int = 256
    share: int = 64
    step: int = 4


_EXACT = 2.0**53
_LEAST, _MOST = -(2**63), 2**63 - 1


def integer_rows(vectors: DataFrame, ident: str, vector: str, label: str, scale: int = 256) -> DataFrame:
    """``(ident, label, vec)``: components become ``floor(scale * x)``, kept as doubles, which hold them exactly.

    Rows without ident, label or vector, with a null or non-finite component, or with one whose multiple isn't finite,
    are left out.  Rows of one ident count once, the one with the smallest label and then the smallest vector.
    """
    vec = F.transform(F.col(vector).cast("array<double>"), lambda x: x * F.lit(float(scale)))
    rows = vectors.select(F.col(ident).cast("long").alias("ident"), F.col(label).cast("long").alias("label"), vec.alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("ident").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    rows = materialise(rows, "integer-rows")
    repeated = materialise(rows.groupBy("ident").count().where("count > 1").select("ident"), "repeated-idents")
    if not repeated.limit(1).count():
        return rows
    # Salted, so that very many rows of one ident are reduced where they are read.
    again = rows.join(repeated, "ident", "left_semi").withColumn("salt", F.pmod(F.xxhash64("label", "vec"), F.lit(256)))
    again = again.groupBy("ident", "salt").agg(F.min(F.struct("label", "vec")).alias("row")).groupBy("ident").agg(F.min("row").alias("row"))
    return materialise(rows.join(repeated, "ident", "left_anti").unionByName(again.select("ident", "row.label", "row.vec")), "distinct-idents")


_PACKED = "number long, width int, ids array<long>, labels array<long>, columns binary, lows array<double>, highs array<double>"


def _packed(rows: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of at most ``size`` rows, columns one after the other, and which blocks hold each ``(width, label)``.

    Rows are ordered by length and label, and vectors of different lengths share no block, so that the blocks of a
    length, and those of a label, have successive numbers.
    """
    placed = with_positions(rows.withColumn("width", F.size("vec")), ["width", "label", "ident"], "place", unique=True)
    starts = placed.groupBy("width").agg(F.min("place").alias("start"))
    # The blocks of a length begin anew; ``number`` leaves room for the one that this may add.
    order = Window.orderBy("start")  # one row per length of vectors
    shifts = starts.withColumn("extra", F.row_number().over(order) - 1)
    cut = placed.join(F.broadcast(shifts) if _few(shifts) else shifts, "width")
    cut = cut.withColumn("number", F.floor(F.col("start") / size) + F.col("extra") + F.floor((F.col("place") - F.col("start")) / size))
    ranges = cut.groupBy("width", "label").agg(F.min("number").alias("low"), F.max("number").alias("high"))

    def pack(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        x = np.floor(np.array(own["vec"].tolist(), float).reshape(len(own), int(key[1])))
        row = {"number": int(key[0]), "width": int(key[1]), "ids": own["ident"].to_numpy(np.int64), "labels": own["label"].to_numpy(np.int64)}
        row |= {"columns": np.ascontiguousarray(x.T).tobytes(), "lows": x.min(axis=0), "highs": x.max(axis=0)}
        return pd.DataFrame([row])

    blocks = cut.groupBy("number", "width").applyInPandas(pack, _PACKED)
    return materialise(blocks, "vector-blocks"), materialise(ranges, "label-blocks")


def _few(rows: DataFrame) -> bool:
    return rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


class Block:
    """The rows of one block as an array of columns."""

    def __init__(self, ids, labels, columns: bytes, lows, highs):
        self.ids, self.labels = np.asarray(ids, np.int64), np.asarray(labels, np.int64)
        self.lows, self.highs = np.asarray(lows, float), np.asarray(highs, float)
        self.columns = np.frombuffer(columns, float).reshape(len(self.lows), len(self.ids))
        self.largest = max(np.abs(self.lows).max(initial=0.0), np.abs(self.highs).max(initial=0.0))

    def scan(self, q: np.ndarray, alive: np.ndarray, matters: Callable, step: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows that can matter, their exact scores, and how many values were read.

        ``alive`` are the rows to begin with; ``matters(low, high, rows)`` tells from bounds of their scores which of them
        still can, or None if none can leave any more.
        """
        if np.abs(q).max(initial=0.0) * self.largest * max(len(q), 1) >= _EXACT:
            return self._plain(q, alive)
        order = np.argsort(-np.abs(q), kind="stable")
        ends = np.stack([q * self.lows, q * self.highs])[:, order]
        least, most = (np.append(np.cumsum(x[::-1])[::-1], 0.0) for x in (ends.min(axis=0), ends.max(axis=0)))
        sums, at, width, read = np.zeros(len(alive)), 0, step, 0
        while at < len(q) and len(alive):
            dims = order[at : at + width]
            part = self.columns[dims] if len(alive) == len(self.ids) else self.columns[np.ix_(dims, alive)]
            sums = sums + q[dims] @ part
            read += part.size
            at, width = at + len(dims), 2 * width
            if at < len(q):
                keep = matters(sums + least[at], sums + most[at], alive)
                if not keep.all():
                    alive, sums = alive[keep], sums[keep]
        return alive, sums, read

    def _plain(self, q: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Scores as Python integers, for values whose products leave the exact range of doubles."""
        own = [int(v) for v in q]
        sums = np.empty(len(alive), object)
        for k, row in enumerate(alive):
            sums[k] = sum(a * int(b) for a, b in zip(own, self.columns[:, row]))
        return alive, sums, len(own) * len(alive)


def _in_order(sums: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """``(score, ident)`` by descending score, then ident; scores beyond 64 bits are the nearest ones within."""
    scored = ((min(max(int(s), _LEAST), _MOST), int(i)) for s, i in zip(sums, ids))
    return sorted(scored, key=lambda x: (-x[0], x[1]))


def first_rows(block: Block, q: np.ndarray, alive: np.ndarray, count: int, step: int) -> tuple[list[tuple], int]:
    """``(score, ident)`` of the ``count`` rows of the largest scores, ties by ident."""

    def matters(low: np.ndarray, high: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if len(low) <= count:
            return np.ones(len(low), bool)
        return high >= np.partition(low, len(low) - count)[len(low) - count]

    alive, sums, read = block.scan(q, alive, matters, step)
    return _in_order(sums, block.ids[alive])[:count], read


def window_rows(block: Block, q: np.ndarray, alive: np.ndarray, windows: list[tuple[int, int]], count: int, step: int):
    """Per window of scores, its ``(score, ident)`` of the ``count`` largest ones, ties by ident."""
    edges = [(low, high) for low, high in windows if low <= high]

    def matters(low: np.ndarray, high: np.ndarray, rows: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(low), bool)
        for first, last in edges:
            can = (high >= first) & (low <= last)
            sure = low[can & (low >= first) & (high <= last)]
            if len(sure) >= count:  # so many rows are in the window for sure; only better ones matter
                can &= high >= np.partition(sure, len(sure) - count)[len(sure) - count]
            keep |= can
        return keep

    alive, sums, read = block.scan(q, alive, matters, step)
    found = _in_order(sums, block.ids[alive])
    return [[x for x in found if first <= x[0] <= last][:count] for first, last in windows], read


def window_of(score: int, low: int, high: int) -> tuple[int, int]:
    """Smallest and largest integer ``s`` with ``low * score <= 100 * s <= high * score``."""
    return -(-low * score // 100), high * score // 100


_ANCHORS = "group long, width int, anchor_label long, anchors array<long>, queries binary"


def _pairs(groups: DataFrame, blocks: DataFrame, wanted: DataFrame, settings: Mining) -> DataFrame:
    """Groups of anchors next to the blocks that ``wanted``, rows of ``(group, number)``, gives them.

    A block meets many groups in tasks of at most ``share`` groups, and is sent to each such task once.
    """
    wanted = materialise(wanted.withColumn("salt", F.floor(F.col("group") / settings.share)), "block-calls")
    salts = wanted.select("number", "salt").distinct()
    # Little data and much work: the number of tasks follows the blocks, not the bytes.
    tasks = max(1, min(salts.count(), 100_000))
    calls = wanted.join(groups.drop("width"), "group").repartition(tasks, "number", "salt")
    return blocks.join(salts, "number").repartition(tasks, "number", "salt").join(calls, ["number", "salt"])


def _anchor_groups(rows: DataFrame, is_anchor: str, size: int) -> DataFrame:
    """At most ``size`` anchors of one length and label per row."""
    own = rows.where(is_anchor).withColumn("width", F.size("vec"))
    placed = with_positions(own, ["width", "label", "ident"], "place", unique=True)
    placed = placed.withColumn("part", F.floor(F.col("place") / size))
    keys = ["width", "label", "part"]
    names = with_positions(placed.select(*keys).distinct(), keys, "group", unique=True)

    def pack(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        x = np.floor(np.array(own["vec"].tolist(), float).reshape(len(own), int(key[1])))
        row = {"group": int(key[0]), "width": int(key[1]), "anchor_label": int(key[2])}
        return pd.DataFrame([row | {"anchors": own["ident"].to_numpy(np.int64), "queries": x.tobytes()}])

    packed = placed.join(names, keys).groupBy("group", "width", "label").applyInPandas(pack, _ANCHORS)
    return materialise(packed, "anchor-groups")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: str = "ident % 50 = 0",
    settings: Mining = Mining(),
    ident: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is SQL over ``ident``.  An anchor's positives are the first rows of its label; each positive's
    negatives are the first rows of other labels in its window.  Rows come by descending inner product with the anchor,
    ties by ident; only vectors of one length have a product, and empty ones score 0.  ``integer_rows`` says which rows
    take part; an empty table, and one without anchors, positives or negatives, gives no rows.  A score beyond 64 bits
    counts as the nearest one within.
    """
    return negatives_of(integer_rows(vectors, ident, vector, label), is_anchor, settings)


def negatives_of(rows: DataFrame, is_anchor: str, settings: Mining = Mining()) -> DataFrame:
    """The same over ``(ident, label, vec)`` rows of distinct idents, whose components are floored."""
    blocks, ranges = _packed(rows, settings.block)
    groups = _anchor_groups(rows, is_anchor, settings.anchors)
    named = groups.select("group", "width", F.col("anchor_label").alias("label")).join(ranges, ["width", "label"])
    near = named.select("group", F.explode(F.sequence("low", "high")).alias("number"))

    def find_positives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r in (r for batch in batches for r in batch.itertuples(index=False)):
            block, out = Block(r.ids, r.labels, r.columns, r.lows, r.highs), []
            same = np.flatnonzero(block.labels == r.anchor_label)
            for anchor, q in zip(r.anchors, np.frombuffer(r.queries, float).reshape(len(r.anchors), -1)):
                found, _ = first_rows(block, q, same[block.ids[same] != anchor], settings.positives, settings.step)
                out += [(anchor, name, score) for score, name in found]
            yield pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score"])

    fields = ["ids", "labels", "columns", "lows", "highs", "anchor_label", "anchors", "queries"]
    positives = _pairs(groups, blocks, near, settings).select(*fields).mapInPandas(find_positives, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = positives.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= settings.positives)
    positives = materialise(positives.drop("nth"), "positives")

    # Every group of anchors with its positives, in arrays; at most ``positives`` of each anchor.
    own = groups.select("group", F.explode("anchors").alias("anchor_id")).join(positives, "anchor_id")
    own = own.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("anchor_id", "positive_id", "positive_score"))).alias("own"))
    calling = groups.join(own, "group").select("*", *[F.col(f"own.{c}").alias(f"own_{c}") for c in ("anchor_id", "positive_id", "positive_score")]).drop("own")
    widths = ranges.groupBy("width").agg(F.min("low").alias("first"), F.max("high").alias("last"))
    named = named.join(widths, "width").select("group", "low", "high", F.explode(F.sequence("first", "last")).alias("number"))
    # Between its first and its last block a label has whole blocks, without a row of another one.
    far = named.where((F.col("number") <= F.col("low")) | (F.col("number") >= F.col("high"))).select("group", "number")

    def find_negatives(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for r in (r for batch in batches for r in batch.itertuples(index=False)):
            block, out = Block(r.ids, r.labels, r.columns, r.lows, r.highs), []
            others = np.flatnonzero(block.labels != r.anchor_label)
            queries = dict(zip(r.anchors, np.frombuffer(r.queries, float).reshape(len(r.anchors), -1)))
            whose = {}
            for anchor, positive, score in zip(r.own_anchor_id, r.own_positive_id, r.own_positive_score):
                whose.setdefault(anchor, []).append((int(positive), int(score)))
            for anchor, mine in whose.items() if len(others) else ():
                windows = [window_of(score, settings.low, settings.high) for _, score in mine]
                found, _ = window_rows(block, queries[anchor], others, windows, settings.negatives, settings.step)
                out += [(anchor, positive, score, name, s) for (positive, score), near in zip(mine, found) for s, name in near]
            yield pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    fields += ["own_anchor_id", "own_positive_id", "own_positive_score"]
    kinds = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    negatives = _pairs(calling, blocks, far, settings).select(*fields).mapInPandas(find_negatives, kinds)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = negatives.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
