"""What both vector operators need: usable vectors, classes of equal ones, centroids, and counted splits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import materialise


def usable(vectors: DataFrame, ident: str, vector: str) -> DataFrame:
    """``(ident, vec)`` in double precision, without null, zero, or non-finite vectors.

    Vectors of another length than the most frequent one (the longer in a tie) are left out as well.
    """
    vec = F.col(vector).cast("array<double>")
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0)
    rows = vectors.select(F.col(ident).cast("long").alias("ident"), vec.alias("vec")).where(F.col("ident").isNotNull() & F.coalesce(fine, F.lit(False)))
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return rows.where(F.size("vec") == (sizes[0]["n"] if sizes else 0))


def classes(rows: DataFrame, smallest: int) -> DataFrame:
    """``(rep, vec, copies, ids)``: a row per different vector, its smallest ident, its rows, the smallest idents.

    Copies are first reduced within salts, so that no task sorts the idents of one very common vector.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("ident"), F.lit(256)))
    part = salted.groupBy("vec", "salt").agg(F.slice(F.sort_array(F.collect_set("ident")), 1, smallest).alias("ids"), F.count("*").alias("copies"))
    whole = part.groupBy("vec").agg(F.flatten(F.collect_list("ids")).alias("ids"), F.sum("copies").alias("copies"))
    whole = whole.withColumn("ids", F.slice(F.sort_array(F.array_distinct("ids")), 1, smallest))
    return materialise(whole.select(F.col("ids")[0].alias("rep"), "vec", "copies", "ids"), "vector-classes")


def sample(rows: DataFrame, limit: int, seed: int) -> np.ndarray:
    """At most ``limit`` vectors, those of the smallest hashes."""
    got = rows.orderBy(F.xxhash64(F.lit(seed), "rep"), "rep").limit(limit).select("rep", "vec").collect()
    return np.array([r["vec"] for r in got], float).reshape(len(got), len(got[0]["vec"]) if got else 0)


def unit(x: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled by their largest part first, so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def centroids(points: np.ndarray, count: int, seed: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means of unit vectors."""
    draw = np.random.default_rng(seed)
    middle = points[draw.choice(len(points), min(count, len(points)), replace=False)]
    for _ in range(rounds):
        nearest = (points @ middle.T).argmax(axis=1)
        sums = np.zeros_like(middle)
        np.add.at(sums, nearest, points)
        norms = np.sqrt((sums * sums).sum(axis=1))
        middle = np.where(norms[:, None] > 1e-9, sums / np.maximum(norms, 1e-9)[:, None], middle)
    return middle
