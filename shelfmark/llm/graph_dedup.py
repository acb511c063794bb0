"""Near-duplicate vectors by range search in a robust-pruned flat graph.

Vectors are dealt to overlapping cluster shards.  In every piece of a shard a graph is built whose edges survive robust
pruning; the adjacency lists of a vector are united over its shards.  Every vector then searches the graph of each of
its shards greedily from the medoids, and expands everything within range.  Links are confirmed in double precision;
recall is audited against brute force on a bounded sample.  Until it is met the overlap grows, then shards are compared
exactly, and in the end all vectors are one shard.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import materialise
from shelfmark.llm.components import connected_components
from shelfmark.llm.vectors import centroids, classes, sample, unit, usable


@dataclass(frozen=True)
class Graph:
    """``piece`` bounds the vectors of one graph and ``block`` the queries of one task; larger shards are cut.

    ``sample_rows``, ``most_shards``, ``audit_rows`` and ``audit_small`` bound what comes to the driver.
    """

    threshold: float = 0.95
    slack: float = 0.05  # vectors that much below the threshold are still expanded
    overlap: int = 3
    degree: int = 24
    candidates: int = 48
    alpha: float = 1.2
    beam: int = 16
    medoids: int = 8
    piece: int = 2000
    block: int = 4000
    sample_rows: int = 20_000
    most_shards: int = 2048
    audit_rows: int = 200
    audit_small: int = 800  # more of them, away from the hot groups
    least_recall: float = 0.98
    seed: int = 7


def pruned_graph(x: np.ndarray, settings: Graph) -> list[np.ndarray]:
    """Out-neighbours of every row of ``x`` (unit vectors), robustly pruned, with the edges back."""
    n = len(x)
    if n < 2:
        return [np.empty(0, np.int64) for _ in range(n)]
    draw = np.random.default_rng(n)
    near = min(settings.candidates, n - 1)
    far = draw.integers(0, n, (n, 8))  # long edges keep the graph connected
    chosen = np.full((n, settings.degree), -1)
    for at in range(0, n, 512):
        rows = np.arange(at, min(at + 512, n))
        close = x[rows] @ x.T
        close[np.arange(len(rows)), rows] = -np.inf
        found = np.argpartition(-close, near - 1, axis=1)[:, :near]
        found = np.hstack([found, far[rows]])
        dist = np.sqrt(np.maximum(0, 2 - 2 * np.take_along_axis(close, found, 1)))
        order = np.argsort(dist, axis=1, kind="stable")
        found, dist = np.take_along_axis(found, order, 1), np.take_along_axis(dist, order, 1)
        alive = np.isfinite(dist)
        for turn in range(settings.degree):
            pick = alive.argmax(axis=1)
            some = alive[np.arange(len(rows)), pick]
            if not some.any():
                break
            kept = found[np.arange(len(rows)), pick]
            chosen[rows[some], turn] = kept[some]
            alive[np.arange(len(rows)), pick] = False
            # A candidate goes if a kept neighbour is nearer to it, by a factor, than the row itself.
            between = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("rd,rcd->rc", x[kept], x[found])))
            alive &= ~(some[:, None] & (settings.alpha * between <= dist))
    source, place = np.nonzero(chosen >= 0)
    target = chosen[source, place]
    both = np.unique(np.concatenate([source * n + target, target * n + source]))
    both = both[both // n != both % n]
    out = np.split(both % n, np.searchsorted(both // n, np.arange(1, n)))
    # Edges back may crowd a vector; of those beyond twice the degree the nearest stay.
    return [v if len(v) <= 2 * settings.degree else v[np.argsort(-(x[v] @ x[k]), kind="stable")[: 2 * settings.degree]] for k, v in enumerate(out)]


def range_search(x: np.ndarray, table: np.ndarray, queries: np.ndarray, entries: np.ndarray, settings: Graph) -> list[np.ndarray]:
    """Rows of ``x`` that the search finds within the threshold less a hair, for every query.

    ``table`` holds neighbours per row, -1 where there are fewer.  Every round expands the best unexpanded rows of each
    query: its beam first, then all that lie within range.
    """
    q, n = len(queries), len(x)
    close = np.full((q, n), -np.inf, np.float32)
    fresh = np.zeros((q, n), bool)  # found, not yet expanded
    close[:, entries] = queries @ x[entries].T
    fresh[:, entries] = True
    low = settings.threshold - settings.slack
    width, wide = min(settings.beam, n), min(4, n)
    active = np.arange(q)
    while len(active):
        sims, new = close[active], fresh[active]
        beam = np.partition(sims, n - width, axis=1)[:, n - width]
        todo = np.where(new & ((sims >= beam[:, None]) | (sims >= low)), sims, -np.inf)
        best = np.argpartition(-todo, wide - 1, axis=1)[:, :wide]
        value = np.take_along_axis(todo, best, 1)
        going = np.isfinite(value).any(axis=1)
        active, best, value = active[going], best[going], value[going]
        if not len(active):
            break
        who, which = np.nonzero(np.isfinite(value))
        rows, nodes = active[who], best[who, which]
        fresh[rows, nodes] = False
        neighbours = table[nodes]
        rows = np.repeat(rows, neighbours.shape[1])
        nodes = neighbours.ravel()
        unseen = (nodes >= 0) & ~np.isfinite(close[rows, nodes])
        pairs = np.unique(rows[unseen] * n + nodes[unseen])
        rows, nodes = pairs // n, pairs % n
        close[rows, nodes] = np.einsum("kd,kd->k", queries[rows], x[nodes])
        fresh[rows, nodes] = True
    return [np.flatnonzero(row >= settings.threshold - 1e-4) for row in close]


def _local_components(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable row per row."""
    low = np.arange(count)
    while True:
        new = low.copy()
        np.minimum.at(new, a, low[b])
        np.minimum.at(new, b, low[a])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _dealt(rows: DataFrame, middle: np.ndarray, overlap: int, settings: Graph) -> DataFrame:
    """``rows`` with their unit vector and the ids of the shards they belong to, nearest first."""

    @F.pandas_udf("unit array<double>, shards array<int>")
    def deal(vectors: pd.Series) -> pd.DataFrame:
        x = unit(np.array(vectors.tolist(), float).reshape(len(vectors), -1))
        order = np.argsort(-(x @ middle.T), axis=1, kind="stable")[:, :overlap]
        return pd.DataFrame({"unit": list(x), "shards": list(order.astype(np.int32))})

    return rows.withColumn("dealt", deal("vec")).select("rep", "vec", "copies", "dealt.*")


def _links(dealt: DataFrame, settings: Graph, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(rep, found)`` with the rows linked to every class, and edges ``(src, dst)`` that connect the same classes.

    ``exact`` compares all vectors of a shard, block by block, instead of searching its graph.
    """
    members = dealt.withColumn("shard", F.explode("shards"))
    sizes = members.groupBy("shard").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("pieces", F.ceil(F.col("n") / settings.piece).cast("int")).withColumn("blocks", F.ceil(F.col("n") / settings.block).cast("int"))
    sizes = materialise(sizes.drop("n"), "shard-sizes")  # a row per shard
    members = members.join(F.broadcast(sizes), "shard")
    members = members.withColumn("piece", F.pmod(F.xxhash64(F.lit(1), "rep"), "pieces").cast("int"))
    members = materialise(members, "shard-members")

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = np.array(rows["unit"].tolist(), np.float32)
        reps = rows["rep"].to_numpy()
        return pd.DataFrame({"rep": reps, "near": [reps[v] for v in pruned_graph(x, settings)]})

    if exact:
        nodes = members.withColumn("near", F.array().cast("array<long>"))
    else:
        lists = members.select("shard", "piece", "rep", "unit").groupBy("shard", "piece").applyInPandas(build, "rep long, near array<long>")
        # A vector is in few shards, and every list is bounded: so is their union.
        united = lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
        united = materialise(united.withColumnRenamed("rep", "of"), "adjacency")
        nodes = members.join(united, F.col("rep") == F.col("of"))
    nodes = nodes.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
    nodes = nodes.select("shard", "piece", "block", "rep", "vec", "unit", "copies", "shards", "near", F.lit(True).alias("node"))
    queries = members.withColumn("piece", F.explode(F.expr("sequence(0, pieces - 1)"))).withColumn("block", F.pmod(F.xxhash64(F.lit(2), "rep"), "blocks").cast("int"))
    queries = queries.select("shard", "piece", "block", "rep", "vec", "unit", "copies", "shards", F.lit(None).cast("array<long>").alias("near"), F.lit(False).alias("node"))

    def search(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        node = rows["node"].to_numpy()
        own, asking = rows[node], rows[~node]
        if not len(own) or not len(asking):
            return pd.DataFrame({"rep": [], "found": [], "low": []})
        reps, asked = own["rep"].to_numpy(), asking["rep"].to_numpy()
        x, q = np.array(own["unit"].tolist(), np.float32), np.array(asking["unit"].tolist(), np.float32)
        exact_x, exact_q = np.array(own["vec"].tolist(), float), np.array(asking["vec"].tolist(), float)
        norm_x, norm_q = np.sqrt((exact_x**2).sum(axis=1)), np.sqrt((exact_q**2).sum(axis=1))
        if not exact:
            order = np.argsort(reps)
            near = [order[np.minimum(np.searchsorted(reps, v, sorter=order), len(reps) - 1)][np.isin(v, reps)] for v in own["near"]]
            table = np.full((len(own), max(1, max(map(len, near)))), -1)
            for k, v in enumerate(near):
                table[k, : len(v)] = v
            middle = unit(x.mean(axis=0, keepdims=True) + 1e-12)[0]
            spread = np.linspace(0, len(x) - 1, min(settings.medoids, len(x))).astype(int)
            entries = np.unique(np.concatenate([[int((x @ middle).argmax())], np.argsort(x @ middle, kind="stable")[spread]]))
        shards_x, shards_q = np.array(own["shards"].tolist()), np.array(asking["shards"].tolist())
        copies = own["copies"].to_numpy()
        total, one, two = np.zeros(len(asking), np.int64), [], []
        for at in range(0, len(q), 256):
            asks = q[at : at + 256]
            near_by = (np.flatnonzero(row >= settings.threshold - 1e-4) for row in asks @ x.T) if exact else range_search(x, table, asks, entries, settings)
            for k, hits in enumerate(near_by, at):
                hits = hits[reps[hits] != asked[k]]
                if not len(hits):
                    continue
                cosine = (exact_x[hits] * exact_q[k]).sum(axis=1) / (norm_x[hits] * norm_q[k])
                hits = hits[cosine >= settings.threshold]
                # A pair that shares several shards counts in the smallest of them.
                common = np.where((shards_x[hits][:, :, None] == shards_q[k]).any(axis=2), shards_x[hits], np.iinfo(np.int32).max).min(axis=1, initial=np.iinfo(np.int32).max)
                total[k] = copies[hits[common == key[0]]].sum()
                one.append(np.full(len(hits), asked[k]))
                two.append(reps[hits])
        if not one:
            return pd.DataFrame({"rep": asked, "found": total, "low": asked})
        a, b = np.concatenate(one), np.concatenate(two)
        names, places = np.unique(np.concatenate([asked, a, b]), return_inverse=True)
        low = _local_components(len(names), places[len(asked) : len(asked) + len(a)], places[len(asked) + len(a) :])
        extra = np.setdiff1d(names, asked)
        every = np.concatenate([asked, extra])
        lows = names[low[np.searchsorted(names, every)]]
        return pd.DataFrame({"rep": every, "found": np.concatenate([total, np.zeros(len(extra), np.int64)]), "low": lows})

    groups = nodes.unionByName(queries).groupBy("shard", "piece", "block")
    results = materialise(groups.applyInPandas(search, "rep long, found long, low long"), "graph-links")
    counts = results.groupBy("rep").agg(F.sum("found").alias("found"))
    return counts, results.where("rep <> low").select(F.col("rep").alias("src"), F.col("low").alias("dst"))


def _true_links(rows: DataFrame, asked: list, threshold: float) -> dict[int, int]:
    """Brute-force numbers of linked rows of a bounded set of classes, over all classes."""
    reps = np.array([r["rep"] for r in asked])
    q = np.array([r["vec"] for r in asked], float)
    norms = np.sqrt((q * q).sum(axis=1))

    def count(batches):
        n = np.zeros(len(reps), np.int64)
        for batch in batches:
            x = np.array(batch["vec"].tolist(), float)
            cosine = (x @ q.T) / np.sqrt((x * x).sum(axis=1))[:, None] / norms
            hit = (cosine >= threshold) & (batch["rep"].to_numpy()[:, None] != reps)
            n += (hit * batch["copies"].to_numpy()[:, None]).sum(axis=0)
        yield pd.DataFrame({"rep": reps, "n": n})

    got = rows.select("rep", "vec", "copies").mapInPandas(count, "rep long, n long").groupBy("rep").agg(F.sum("n").alias("n")).collect()
    return {r["rep"]: r["n"] for r in got}


def _linked_sample(asked: list, threshold: float) -> np.ndarray:
    """A number per class, the same for those that links inside the sample connect."""
    x = unit(np.array([r["vec"] for r in asked], float))
    return _local_components(len(x), *np.nonzero(x @ x.T >= threshold))


def _audited(rows: DataFrame, settings: Graph) -> list:
    """Classes to audit: a plain sample, and one of those that don't link with a hot group, which the first shows."""
    drawn = F.xxhash64(F.lit(settings.seed + 1), "rep")
    asked = rows.orderBy(drawn, "rep").limit(settings.audit_rows).select("rep", "vec").collect()
    group = _linked_sample(asked, settings.threshold)
    hot = np.bincount(group, minlength=len(asked))[group] > 1
    known = np.array([r["rep"] for r in asked])
    middle = unit(np.array([r["vec"] for r in asked], float))[hot]

    @F.pandas_udf("boolean")
    def apart(reps: pd.Series, vectors: pd.Series) -> pd.Series:
        x = unit(np.array(vectors.tolist(), float).reshape(len(vectors), -1))
        return pd.Series((x @ middle.T < settings.threshold).all(axis=1) & ~reps.isin(known).to_numpy())

    return asked + rows.where(apart("rep", "vec")).orderBy(drawn, "rep").limit(settings.audit_small).select("rep", "vec").collect()


def _recall(found: dict[int, int], truth: dict[int, int], groups: dict[int, int]) -> float:
    """Mean share of their links that classes find; those of one group count as one, so a hot group hides nothing."""
    shares: dict[int, list[float]] = {}
    for rep, n in truth.items():
        if n:
            shares.setdefault(groups[rep], []).append(min(found.get(rep, 0), n) / n)
    return float(np.mean([np.mean(x) for x in shares.values()])) if shares else 1.0


def near_duplicate_vectors(vectors: DataFrame, settings: Graph = Graph(), ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(ident, n_links, component_id, kept)`` of every row.

    Rows with a cosine of at least the threshold are linked; ``n_links`` counts the rows linked directly,
    ``component_id`` is the smallest ident reachable over links, itself included.  Equal vectors form one class, which
    is searched once.  Null, zero and non-finite vectors, those of an unusual length, and rows without ident link with
    nothing.  Rows that repeat an ident count as rows of their own.  An empty table gives no rows.
    """
    fine = materialise(usable(vectors, ident, vector), "usable")
    grouped = classes(fine, 1)
    total = grouped.count()
    points = sample(grouped, settings.sample_rows, settings.seed)
    counts, edges = None, None
    if total:
        asked = _audited(grouped, settings)
        groups = dict(zip((r["rep"] for r in asked), _linked_sample(asked, settings.threshold).tolist()))
        truth = _true_links(grouped, asked, settings.threshold)
        overlap, exact = settings.overlap, False
        while True:
            shards = max(1, min(settings.most_shards, -(-total * overlap // settings.piece)))
            middle = centroids(unit(points), 1 if exact and overlap >= shards else shards, settings.seed)
            overlap = min(overlap, len(middle))
            dealt = materialise(_dealt(grouped, middle, overlap, settings), "dealt")
            counts, edges = _links(dealt, settings, exact)
            found = {r["rep"]: r["found"] for r in counts.where(F.col("rep").isin(list(truth))).collect()}
            # All vectors in one shard, compared exactly, leave nothing out.
            if _recall(found, truth, groups) >= settings.least_recall or exact and len(middle) == 1:
                break
            if not exact and overlap >= min(4 * settings.overlap, len(middle)):
                exact = True
            else:
                overlap *= 2
    rows = vectors.select(F.col(ident).alias(ident), F.col(ident).cast("long").alias("_id"), F.xxhash64(F.col(vector).cast("array<double>")).alias("_hash"))
    if counts is None:
        return rows.select(ident, F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"), F.lit(True).alias("kept"))
    parts = connected_components(edges).withColumnRenamed("node", "part_rep")
    named = grouped.select("rep", "copies", "vec").join(counts.withColumnRenamed("rep", "c_rep"), F.col("rep") == F.col("c_rep"), "left")
    named = named.join(parts, F.col("rep") == F.col("part_rep"), "left")
    links = (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    named = materialise(named.select("vec", links, F.coalesce("component", "rep").alias("component")), "named-vectors")
    known = fine.join(named, "vec").select(F.col("ident").alias("k_id"), F.xxhash64("vec").alias("k_hash"), F.col("n_links"), "component").dropDuplicates(["k_id", "k_hash"])
    out = rows.join(known, (F.col("_id") == F.col("k_id")) & (F.col("_hash") == F.col("k_hash")), "left")
    component = F.coalesce("component", "_id")
    return out.select(ident, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"))
