"""Nearest neighbours by inner product with multiprobe p-stable hashing.

One more coordinate turns the largest inner product into the smallest distance.  Every table hashes a vector to the
cell of a random grid; a query visits cells in the order of their estimated success, its own first.  What the cells of
all tables hold is merged and ranked by the exact inner product.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import materialise, mix64
from shelfmark.llm.vectors import classes, sample, usable


@dataclass(frozen=True)
class Hashing:
    """``cell_rows`` is what a cell should hold on average; ``part`` and ``block`` bound the rows and queries of a task.

    ``sample_rows`` and ``fit_queries`` bound what comes to the driver.  The number of probes is the smallest power of
    two with which the sampled queries find ``recall`` of their true neighbours; if ``most_probes`` don't, every query is
    compared with all rows.
    """

    k: int = 20
    tables: int = 8
    width: float = 2.0  # of a cell, in standard deviations of a projection
    cell_rows: int = 512
    recall: float = 0.97
    most_probes: int = 4096
    part: int = 4096
    block: int = 2048
    sample_rows: int = 10_000
    fit_queries: int = 100
    seed: int = 3


class Grid:
    """The hash functions of all tables."""

    def __init__(self, points: np.ndarray, top: float, count: int, settings: Hashing):
        draw = np.random.default_rng(settings.seed)
        self.top, self.settings = top, settings
        lifted = self.lift(points)
        per_bit = 1.1  # bits that a projection tells, at this width
        self.size = int(np.clip(round(np.log2(max(count / settings.cell_rows, 1.0)) / per_bit), 1, 24))
        self.axes = draw.normal(size=(settings.tables, lifted.shape[1], self.size))
        cast = np.einsum("nd,tdm->tnm", lifted, self.axes)
        self.middle = cast.mean(axis=1)
        self.step = np.maximum(cast.std(axis=1), 1e-9) * settings.width
        self.shift = draw.uniform(size=(settings.tables, self.size))

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Rows as unit vectors: what their length lacks of the longest one's goes into one more coordinate."""
        x = x / self.top
        return np.hstack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1, keepdims=True)))])

    def places(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Grid coordinates ``(table, row, projection)``; a query has any length, so it is made a unit vector."""
        if query:
            x = np.hstack([x / np.sqrt((x * x).sum(axis=1, keepdims=True)), np.zeros((len(x), 1))])
        else:
            x = self.lift(x)
        return (np.einsum("nd,tdm->tnm", x, self.axes) - self.middle[:, None]) / self.step[:, None] + self.shift[:, None]

    def names(self, cells: np.ndarray, table: int) -> np.ndarray:
        """One integer per cell (the last axis holds its coordinates)."""
        out = np.full(cells.shape[:-1], table + 1, np.uint64)
        with np.errstate(over="ignore"):
            for axis in range(cells.shape[-1]):
                out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + cells[..., axis].astype(np.int64).view(np.uint64))
        return out.view(np.int64)

    def probes(self, place: np.ndarray, most: int) -> np.ndarray:
        """Cells to visit from one place, best first: a cell's cost is the squared distance to its borders."""
        base = np.floor(place)
        low = place - base
        steps = sorted([(d * d, axis, -1) for axis, d in enumerate(low * self.step_of)] + [(d * d, axis, 1) for axis, d in enumerate((1 - low) * self.step_of)])
        out, heap = [base], [(steps[0][0], (0,))]
        while heap and len(out) < most:
            cost, chosen = heapq.heappop(heap)
            axes = [steps[k][1] for k in chosen]
            if len(set(axes)) == len(axes):
                cell = base.copy()
                for k in chosen:
                    cell[steps[k][1]] += steps[k][2]
                out.append(cell)
            last = chosen[-1]
            if last + 1 < len(steps):
                more = steps[last + 1][0]
                heapq.heappush(heap, (cost - steps[last][0] + more, (*chosen[:-1], last + 1)))
                heapq.heappush(heap, (cost + more, (*chosen, last + 1)))
        return np.array(out)

    def visits(self, x: np.ndarray, most: int) -> list[list[np.ndarray]]:
        """Names of the cells that each query visits, per table."""
        places = self.places(x, True)
        out = []
        for row in range(len(x)):
            own = []
            for table in range(len(places)):
                self.step_of = self.step[table]
                own.append(self.names(self.probes(places[table, row], most), table))
            out.append(own)
        return out


def _exact(rows: DataFrame, asked: pd.DataFrame, k: int) -> pd.DataFrame:
    """True ``(query, rep, vec)`` of a bounded set of queries, by brute force over all rows."""
    q, names = np.array(asked["vec"].tolist(), float), asked["rep"].to_numpy()

    def best(batches):
        for batch in batches:
            x, reps = np.array(batch["vec"].tolist(), float), batch["rep"].to_numpy()
            scores = q @ x.T
            take = np.argsort(-scores, axis=1, kind="stable")[:, : k + 1]
            yield pd.DataFrame({"query": np.repeat(names, take.shape[1]), "rep": reps[take.ravel()], "score": np.take_along_axis(scores, take, 1).ravel()})

    found = rows.select("rep", "vec").mapInPandas(best, "query long, rep long, score double").where("query <> rep")
    found = found.withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "rep"))).where(F.col("nth") <= k)
    return found.select("query", "rep").join(rows.select("rep", "vec"), "rep").toPandas()


def probes_needed(grid: Grid, asked: pd.DataFrame, truth: pd.DataFrame, settings: Hashing) -> tuple[int, float]:
    """The probes that find enough of the true neighbours, and the share they find."""
    if not len(truth):
        return 1, 1.0
    rows = {name: k for k, name in enumerate(asked["rep"])}
    homes = np.floor(grid.places(np.array(truth["vec"].tolist(), float), False))
    homes = np.stack([grid.names(homes[t], t) for t in range(len(homes))])
    whose = truth["query"].map(rows).to_numpy()
    most, most_cells = 1, min(settings.most_probes, 3**grid.size)
    while True:
        visits = grid.visits(np.array(asked["vec"].tolist(), float), most)
        hit = [any(homes[t, n] in cells for t, cells in enumerate(visits[w])) for n, w in enumerate(whose)]
        if np.mean(hit) >= settings.recall or most >= most_cells:
            return most, float(np.mean(hit))
        most *= 2


def nearest(vectors: DataFrame, queries: DataFrame, settings: Hashing = Hashing(), ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, <ident>, score)``: the ``k`` rows of the largest inner product found for each query.

    ``queries`` has the columns of ``vectors``; a query's own ident is no candidate.  Ties go to the smaller ident.
    Null, zero and non-finite vectors, those of an unusual length, and rows without ident take no part.  Equal vectors
    are searched once; rows that repeat an ident and a vector are one.  Without vectors or queries there are no rows.
    """
    fine = materialise(usable(vectors, ident, vector), "usable")
    grouped = classes(fine, settings.k + 1)
    asking = materialise(usable(queries, ident, vector).dropDuplicates(["ident"]), "asking")
    empty = fine.sparkSession.createDataFrame([], f"query_id long, rank int, {ident} long, score double")
    total = grouped.count()
    if not total or not asking.limit(1).count():
        return empty
    points = sample(grouped, settings.sample_rows, settings.seed)
    top = float(np.sqrt(grouped.agg(F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))).first()[0]))
    grid = Grid(points, top, total, settings)
    asked = asking.orderBy(F.xxhash64(F.lit(settings.seed), "ident"), "ident").limit(settings.fit_queries).select(F.col("ident").alias("rep"), "vec").toPandas()
    probes, recall = probes_needed(grid, asked, _exact(grouped, asked, settings.k), settings)

    whole = recall < settings.recall  # probing finds too little: all rows are one cell, compared block by block

    @F.pandas_udf("array<long>")
    def home(rows: pd.Series) -> pd.Series:
        if whole:
            return pd.Series([[0]] * len(rows))
        places = np.floor(grid.places(np.array(rows.tolist(), float), False))
        return pd.Series(list(np.stack([grid.names(places[t], t) for t in range(len(places))], 1)))

    @F.pandas_udf("array<long>")
    def visited(rows: pd.Series) -> pd.Series:
        if whole:
            return pd.Series([[0]] * len(rows))
        return pd.Series([np.concatenate(cells) for cells in grid.visits(np.array(rows.tolist(), float), probes)])

    stored = materialise(grouped.select("rep", "vec", "ids", F.explode(home("vec")).alias("cell")), "stored")
    probing = materialise(asking.select(F.col("ident").alias("query"), "vec", F.explode(visited("vec")).alias("cell")), "probing")
    # Cells that hold rows and are visited, and into how many tasks of rows and of queries each is cut.
    held = stored.groupBy("cell").agg(F.ceil(F.count("*") / settings.part).cast("int").alias("parts"))
    calls = probing.groupBy("cell").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("blocks"))
    cells = materialise(held.join(calls, "cell"), "cells")
    here = stored.join(cells, "cell").withColumn("part", F.pmod(F.xxhash64(F.lit(1), "rep"), "parts").cast("int"))
    here = here.withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)"))).select("cell", "part", "block", "vec", "ids", F.lit(None).cast("long").alias("query"))
    calling = probing.join(cells, "cell").withColumn("block", F.pmod(F.xxhash64(F.lit(2), "query"), "blocks").cast("int"))
    calling = calling.withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).select("cell", "part", "block", "vec", F.lit(None).cast("array<long>").alias("ids"), "query")

    def rank(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own, calls_ = rows[rows["query"].isna()], rows[rows["query"].notna()]
        x, q = np.array(own["vec"].tolist(), float), np.array(calls_["vec"].tolist(), float)
        ids = own["ids"].tolist()
        if not len(x) or not len(q):
            return pd.DataFrame({"query": [], "reps": [], "scores": [], "ids": []})
        take = min(len(x), settings.k + 1)  # the query itself may be one of them
        first = np.array([i[0] for i in ids], np.int64)
        longest = np.sqrt((x * x).sum(axis=1).max())
        out = []
        for at in range(0, len(q), 256):
            scores = q[at : at + 256] @ x.T
            least = np.partition(scores, len(x) - take, axis=1)[:, len(x) - take]
            # More than rounding can move a product; whatever may tie with the last place is ranked exactly.
            margin = 4 * x.shape[1] * np.finfo(float).eps * longest * np.sqrt((q[at : at + 256] ** 2).sum(axis=1))
            for name, own_q, near, low in zip(calls_["query"].iloc[at : at + 256], q[at : at + 256], scores, least - margin):
                row = np.flatnonzero(near >= low)
                # Summed row by row, so that equal vectors score alike wherever they stand.
                values = (own_q * x[row]).sum(axis=1)
                order = np.lexsort((first[row], -values))[: settings.k + 1]
                out.append((int(name), [int(ids[row[k]][0]) for k in order], [float(values[k]) for k in order], [[int(i) for i in ids[row[k]]] for k in order]))
        return pd.DataFrame(out, columns=["query", "reps", "scores", "ids"])

    groups = here.unionByName(calling).groupBy("cell", "part", "block")
    partial = groups.applyInPandas(rank, "query long, reps array<long>, scores array<double>, ids array<array<long>>")

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Best rows of one query: a list of bounded length from each of its probes."""
        found = {}
        for scores, ids in zip(rows["scores"], rows["ids"]):
            for score, names in zip(scores, ids):
                for name in names:
                    found[int(name)] = float(score)
        found.pop(int(key[0]), None)
        best = sorted(found.items(), key=lambda item: (-item[1], item[0]))[: settings.k]
        return pd.DataFrame({"query_id": [key[0]] * len(best), "rank": range(1, len(best) + 1), "found": [x[0] for x in best], "score": [x[1] for x in best]})

    merged = partial.groupBy("query").applyInPandas(merge, "query_id long, rank int, found long, score double")
    return merged.withColumnRenamed("found", ident)
