"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import materialise

MAX_ROUNDS = 60


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: every node has one edge at most, and no edge leads on to another."""
    ends = edges.select(F.col("dst").alias("end"))
    twice = edges.groupBy("src").agg(F.count("*").alias("n")).where("n > 1")
    return twice.isEmpty() and edges.join(ends, F.col("src") == F.col("end"), "left_semi").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node that has an edge to another one.

    ``edges`` has the integer columns ``src`` and ``dst``; the component is its smallest node.  Nulls, loops and
    repeated edges are ignored; without edges the result is empty.  Every round is written to the shared folder, and
    its joins see written tables on both sides, so that adaptive execution can split a node with very many edges.
    """
    ordered = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    now = materialise(ordered.where("src > dst").distinct(), "edges")
    if now.isEmpty():
        return now.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = materialise(both.groupBy("src").agg(F.min("dst").alias("low")), "lows")
        least = least.select(F.col("src").alias("at"), F.least("src", "low").alias("low"))
        stars = both.join(least, F.col("src") == F.col("at")).where("dst > src and dst > low")
        stars = materialise(stars.select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct(), "stars")
        least = materialise(stars.groupBy("src").agg(F.min("dst").alias("low")), "lows")
        least = least.withColumnRenamed("src", "at")
        chains = stars.join(least, F.col("src") == F.col("at")).where("dst > low")
        chains = chains.select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        ends = least.select(F.col("at").alias("src"), F.col("low").alias("dst"))
        now = materialise(chains.unionByName(ends).distinct(), "edges")
        if _settled(now):
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    tops = now.select("dst").distinct().select(F.col("dst").alias("node"), F.col("dst").alias("component"))
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(tops)
