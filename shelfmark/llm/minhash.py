"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of sub-keys are computed, each sub-key from a few minhash values.  Every pair of one sub-key of
either collection is the key of one table: ``m * m`` tables need ``2 * m * r`` minhash values instead of
``2 * r * m * m``.  Documents that share a key are candidates; links are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import WordHashes, cased_words, materialise, mix64, rows_of
from shelfmark.llm.components import connected_components

_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Banding:
    """``subkeys`` per collection, each of ``values`` minhashes; ``subkeys ** 2`` tables.

    Documents of similarity s share a table with probability ``(1 - (1 - s ** values) ** subkeys) ** 2``: 0.997 at
    0.80 with the defaults, 0.999 at 0.85 with eight sub-keys.
    """

    words: int = 5
    percent: int = 80
    subkeys: int = 9
    values: int = 3
    block: int = 400


def shingle_set(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; the whole sequence is one shingle if it is shorter.

    ``hashes`` is the cache of a task: one of a worker's would stay with it through all later steps.
    """
    hashed = hashes.of(cased_words(text)) if text else np.empty(0, np.uint64)
    if not len(hashed):
        return hashed
    width = min(words, len(hashed))
    last = len(hashed) - width + 1
    out = np.full(last, width, np.uint64)
    for k in range(width):  # the words' hashes are random already, so a sum with odd factors spreads as well
        out += hashed[k : k + last] * _ODD ** np.uint64(k + 1)
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


_BLOCK = 4096


@lru_cache
def _factors(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of ``count`` hash functions."""
    drawn = mix64(np.arange(1, 2 * count + 1, dtype=np.uint64) * _ODD).astype(np.uint32).reshape(2, count, 1)
    return drawn[0] | np.uint32(1), drawn[1]


def sub_keys(shingles: np.ndarray, banding: Banding) -> np.ndarray:
    """Both collections, one after the other: ``2 * subkeys`` integers."""
    factor, offset = _factors(2 * banding.subkeys * banding.values)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factor), 2**32 - 1, np.uint32)
    for at in range(0, len(short), _BLOCK):
        hashed = factor * short[at : at + _BLOCK]
        hashed += offset
        np.minimum(least, hashed.min(axis=1), out=least)
    keys = np.arange(1, 2 * banding.subkeys + 1, dtype=np.uint64)
    for part in least.astype(np.uint64).reshape(-1, banding.values).T:
        keys = mix64(keys * _ODD + part)
    return keys.view(np.int64)


def signatures(docs: DataFrame, banding: Banding, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """``(ident, set_id, n_shingles, keys)``; ``set_id`` names the shingle set, null without words."""

    @F.pandas_udf("set_id binary, n_shingles long, keys array<long>")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        with np.errstate(over="ignore"):
            for texts in batches:
                out = []
                for value in texts:
                    shingles = shingle_set(value, banding.words, hashes)
                    name = xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None
                    out.append((name, len(shingles), sub_keys(shingles, banding) if len(shingles) else None))
                yield pd.DataFrame(out, columns=["set_id", "n_shingles", "keys"])

    return docs.select(F.col(ident).cast("long").alias("ident"), sign(F.col(text)).alias("signed")).select("ident", "signed.*")


def _tables(classes: DataFrame, banding: Banding) -> DataFrame:
    """``(key, rep)``: one row per class and table, keyed by a pair of sub-keys."""
    m = banding.subkeys
    pairs = F.expr(
        f"flatten(transform(slice(keys, 1, {m}), (a, i) -> transform(slice(keys, {m + 1}, {m}), (b, j) -> xxhash64(a, b, i, j))))"
    )
    return classes.select("rep", F.explode(pairs).alias("key"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough, decided in integers."""

    def similar(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in rows_of(batches):
            keep = []
            for one, two in zip(rows["one"], rows["two"]):
                a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield rows.loc[keep, ["src", "dst"]]

    left = sets.select(F.col("rep").alias("src"), F.col("shingles").alias("one"), F.col("n").alias("n_one"))
    right = sets.select(F.col("rep").alias("dst"), F.col("shingles").alias("two"), F.col("n").alias("n_two"))
    sizes = F.expr(f"100 * least(n_one, n_two) >= {percent} * greatest(n_one, n_two)")
    joined = pairs.join(left, "src").join(right, "dst").where(sizes).select("src", "dst", "one", "two")
    return joined.mapInPandas(similar, "src long, dst long")


def _linked_in_clusters(rows: DataFrame, sets: DataFrame, banding: Banding) -> DataFrame:
    """``(src, dst)`` edges that connect all similar sets among ``rows`` (``rep, hub, part``).

    Members of buckets that overlap form a cluster, and all similar pairs lie inside one.  A cluster is cut into blocks
    and every two blocks are compared in a task of their own: no pair of documents is ever a row.
    """
    clusters = connected_components(rows.where("rep <> hub").select(F.col("rep").alias("src"), F.col("hub").alias("dst")))
    clusters = materialise(clusters.withColumnsRenamed({"node": "rep", "component": "cluster"}), "clusters")
    sizes = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / banding.block).cast("int").alias("blocks"))
    placed = clusters.join(materialise(sizes, "cluster-sizes"), "cluster").join(rows.select("rep", "part").distinct(), "rep")
    placed = placed.withColumn("own", F.pmod(F.xxhash64(F.lit(9), "rep"), "blocks").cast("int"))
    placed = placed.join(sets.select("rep", "shingles"), "rep").withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    placed = placed.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))

    def compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        edges = similar_sets([np.frombuffer(x, np.uint64) for x in rows["shingles"]], rows["part"].to_numpy(), banding.percent)
        reps = rows["rep"].to_numpy()
        return pd.DataFrame({"src": reps[edges[:, 0]], "dst": reps[edges[:, 1]]})

    return placed.select("cluster", "low", "high", "rep", "part", "shingles").groupBy("cluster", "low", "high").applyInPandas(compare, "src long, dst long")


_COLUMNS = 4096


def similar_sets(sets: list[np.ndarray], parts: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of places that connect all similar sets of different parts: a forest, not all pairs.

    Sizes of intersections are products of 0/1 matrices over the elements that two sets share at least.
    """
    count = len(sets)
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(count), sizes)
    values, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.where(often > 1, np.cumsum(often > 1) - 1, -1)[place]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((count, count), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        low, high = np.searchsorted(column, [at, at + _COLUMNS])
        part = np.zeros((count, min(_COLUMNS, int(column[high - 1]) + 1 - at)), np.float32)
        part[owner[low:high], column[low:high] - at] = 1.0
        both += part @ part.T
    shared = np.rint(both).astype(np.int64)
    alike = 100 * shared >= percent * (sizes[:, None] + sizes[None] - shared)
    one, two = np.nonzero(np.triu(alike & (parts[:, None] != parts[None]), 1))
    # A forest over the parts is enough; each edge joins two trees.
    tree = {p: p for p in parts.tolist()}

    def root(p: int) -> int:
        while tree[p] != p:
            tree[p] = p = tree[tree[p]]
        return p

    keep = []
    for a, b in zip(one.tolist(), two.tolist()):
        x, y = root(int(parts[a])), root(int(parts[b]))
        if x != y:
            tree[x] = y
            keep.append((a, b))
    return np.array(keep, np.int64).reshape(-1, 2)


def near_duplicates(
    docs: DataFrame, banding: Banding = Banding(), ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``ident, set_id, n_shingles, component_id, kept``.

    Documents with ``100 * |intersection| >= percent * |union|`` of their shingle sets are linked; ``component_id`` is
    the smallest ident reachable over links, itself included, and ``kept`` marks that document.  Equal sets form one
    class before any table is built, so copies cost one row each.  In every bucket all classes are first compared
    with one member; what is connected then needs no more comparisons, and members of buckets that still hold several
    components are compared block by block.

    Null or empty texts have no shingles and link with nothing.  A row without ident never names a component, is
    linked by an equal set only, and is kept.  Repeated rows each give a row.  Other columns of ``docs`` are not read.
    An empty table gives no rows.
    """
    signed = materialise(signatures(docs, banding, ident, text), "signatures")
    # A class is named by a number: the smallest ident, or a hash of the set if all are null.
    classes = signed.where("set_id is not null").groupBy("set_id")
    classes = classes.agg(F.min("ident").alias("low"), F.first("keys").alias("keys"))
    classes = materialise(classes.withColumn("rep", F.xxhash64("set_id")), "classes")
    buckets = _tables(classes, banding)
    shared = materialise(buckets.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("far")).where("hub < far"), "shared")
    members = materialise(buckets.join(shared, "key").select("key", "rep", "hub"), "members")
    wanted = members.select("rep").distinct()

    def full(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        with np.errstate(over="ignore"):
            for rows in rows_of(batches):
                for rep, name, value in zip(rows["rep"], rows["set_id"], rows["body"]):
                    shingles = shingle_set(value, banding.words, hashes)
                    if xxhash.xxh3_128_digest(shingles.tobytes()) == bytes(name):
                        yield pd.DataFrame({"rep": [rep], "n": [len(shingles)], "shingles": [shingles.tobytes()]})

    # One text of each candidate class is read again; sets of all other documents are never moved.
    one_text = classes.join(wanted, "rep", "left_semi").select("rep", "set_id", F.col("low").alias("from_id"))
    texts = docs.select(F.col(ident).cast("long").alias("from_id"), F.col(text).alias("body"))
    sets = one_text.where("from_id is not null").join(texts, "from_id").select("rep", "set_id", "body")
    sets = sets.mapInPandas(full, "rep long, n long, shingles binary")
    sets = materialise(sets.dropDuplicates(["rep"]), "sets")  # an ident may stand in several rows

    # Stars: every member of a bucket is compared with the bucket's smallest one.
    pairs = members.where("rep > hub").select(F.col("rep").alias("src"), F.col("hub").alias("dst")).distinct()
    links = materialise(_confirmed(materialise(pairs, "pairs"), sets, banding.percent), "links")
    labels = materialise(connected_components(links), "labels")
    # What is connected needs no more comparisons; buckets that still hold several components do.
    named = members.join(labels, members["rep"] == labels["node"], "left")
    named = materialise(named.select("key", "rep", F.coalesce("component", "rep").alias("part")), "named")
    mixed = named.groupBy("key").agg(F.min("part").alias("a"), F.max("part").alias("b"), F.min("rep").alias("hub"))
    open_rows = materialise(named.join(materialise(mixed.where("a < b").select("key", "hub"), "mixed"), "key").select("rep", "hub", "part").distinct(), "open")
    if not open_rows.isEmpty():
        more = _linked_in_clusters(open_rows, sets, banding)
        labels = connected_components(links.unionByName(materialise(more, "more-links")))

    parts = classes.select("set_id", "rep", "low").join(labels, F.col("rep") == F.col("node"), "left")
    parts = materialise(parts.select("set_id", "low", F.coalesce("component", "rep").alias("part")), "parts")
    lows = materialise(parts.groupBy("part").agg(F.min("low").alias("component_id")), "part-lows")
    named = materialise(parts.join(lows, "part").select("set_id", "component_id"), "named-sets")
    out = signed.select("ident", "set_id", "n_shingles").join(named, "set_id", "left")
    out = out.withColumn("component_id", F.when(F.col("set_id").isNull(), F.col("ident")).otherwise(F.col("component_id")))
    kept = F.coalesce(F.col("ident") == F.col("component_id"), F.lit(True))
    return out.select(F.col("ident").alias(ident), "set_id", "n_shingles", "component_id", kept.alias("kept"))


def without_near_duplicates(docs: DataFrame, banding: Banding = Banding(), ident: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each component.

    Rows without ident or without words stay; rows that repeat an ident and its text leave one.
    """
    verdict = near_duplicates(docs, banding, ident, text)
    kept = verdict.where(F.col("kept") & F.col(ident).isNotNull() & F.col("set_id").isNotNull())
    kept = materialise(kept.select(F.col(ident).alias("_kept")).distinct(), "kept")
    blank = F.coalesce(~F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    stay = docs.where(F.col(ident).isNull() | blank)
    rest = docs.where(F.col(ident).isNotNull() & ~blank).withColumn("_hash", F.xxhash64(text))
    once = rest.join(kept, F.col(ident).cast("long") == F.col("_kept")).dropDuplicates([ident, "_hash"])
    return once.select(*docs.columns).unionByName(stay)
