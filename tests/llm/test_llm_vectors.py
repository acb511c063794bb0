"""Graph near-dedup and neighbour search against brute force and on awkward vectors."""

import random

import numpy as np
import pytest
from llm_helpers import components

from shelfmark.llm import graph_dedup, nearest, queries, vectors

FOLDERS = ["/root/testdata/sf0.01"]
SCHEMA = "vec_id long, embedding array<float>, label int, rep long, vec string, query long, cell int"


def frame(spark, rows):
    """Vectors with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, v, 0, 1, "v", 2, 3) for i, v in rows], SCHEMA)


def awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [1.0, 0.1, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [nan, 1.0, 0.0])]
    rows += [(6, [inf, 1.0, 0.0]), (7, [None, 1.0, 0.0]), (8, []), (9, [1.0, 1.0]), (10, [0.0, 1e-30, 0.0]), (11, [0.0, 1e30, 0.0]), (1, [2.0, 0.0, 0.0])]
    return frame(spark, rows).unionByName(frame(spark, [(None, [1.0, 0.0, 0.0])]))


def families(seed, groups, size, far=40, dim=32):
    """Groups of near-copies, and vectors on their own."""
    draw = np.random.default_rng(seed)
    rows = []
    for _ in range(groups):
        middle = draw.normal(size=dim)
        rows += [middle + draw.normal(size=dim) * np.linalg.norm(middle) * 0.02 for _ in range(size)]
    rows += list(draw.normal(size=(far, dim)))
    order = draw.permutation(len(rows))
    return [(int(k), [float(np.float32(x)) for x in rows[i]]) for k, i in enumerate(order)]


def brute_links(rows, threshold):
    x = np.array([v for _, v in rows], float)
    n = np.sqrt((x * x).sum(axis=1))
    hit = (x @ x.T) / n[:, None] / n >= threshold
    np.fill_diagonal(hit, False)
    ids = [i for i, _ in rows]
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(hit))]
    return {ids[k]: int(hit[k].sum()) for k in range(len(ids))}, components(ids, links)


@pytest.mark.parametrize("settings", [graph_dedup.Graph(), graph_dedup.Graph(piece=60, block=90, degree=8, candidates=24)])
def test_graph_finds_all_links(spark, settings):
    rows = families(1, 6, 30) + [(1000 + k, v) for k, v in families(1, 6, 30)[:5]]  # and exact copies
    counts, parts = brute_links(rows, settings.threshold)
    got = graph_dedup.near_duplicate_vectors(frame(spark, rows), settings).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (counts[i], parts[i], parts[i] == i) for i in counts}


def test_a_hot_group_hides_no_lost_pairs(spark):
    draw = np.random.default_rng(5)
    rows = families(2, 1, 400, far=0) + [(1000 + i, v) for i, v in families(3, 120, 2, far=200)]
    rows = [(i, rows[k][1]) for i, k in enumerate(draw.permutation(len(rows)))]
    counts, _ = brute_links(rows, 0.95)
    weak = graph_dedup.Graph(degree=1, candidates=1, beam=1, medoids=1)  # finds its way in a hot group only
    got = {r.vec_id: r.n_links for r in graph_dedup.near_duplicate_vectors(frame(spark, rows), weak).collect()}
    small = [i for i, n in counts.items() if 0 < n < 10]
    assert len(small) == 240 and np.mean([got[i] / counts[i] for i in small]) >= 0.98
    assert graph_dedup._recall({1: 500, 2: 0}, {1: 500, 2: 1, 3: 0}, {1: 0, 2: 1, 3: 2}) == 0.5


def test_graph_on_the_given_vectors(spark):
    for folder in FOLDERS:
        rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
        counts, parts = brute_links(rows, 0.95)
        got = {r.vec_id: (r.n_links, r.component_id) for r in queries.op3_graph_near_dedup(spark, folder).collect()}
        assert got == {i: (counts[i], parts[i]) for i in counts}


def test_graph_on_awkward_vectors(spark):
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in graph_dedup.near_duplicate_vectors(awkward(spark)).collect()]
    assert len(got) == 14 and got.count((1, 3, 0, False)) == 2
    assert (0, 3, 0, True) in got and (2, 3, 0, False) in got and (10, 1, 10, True) in got and (11, 1, 10, False) in got
    assert {(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)} <= set(got) and (None, 0, None, True) in got
    assert graph_dedup.near_duplicate_vectors(awkward(spark).limit(0)).count() == 0
    assert graph_dedup.near_duplicate_vectors(frame(spark, [(1, None), (2, [])])).count() == 2


def brute_nearest(rows, asked, k):
    x, ids = np.array([v for _, v in rows], float), np.array([i for i, _ in rows])
    out = {}
    for i, v in asked:
        scores = (x * np.array(v, float)).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_search_recall_and_scores(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = brute_nearest(rows, [x for x in rows if x[0] % 20 == 0], 20)
    of = dict(rows)
    found = {}
    for r in queries.op10_multiprobe_neighbours(spark, folder).collect():
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(want)
    hits = 0
    for q, got in found.items():
        got.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, 21))
        assert all(a.score > b.score or a.score == b.score and a.vec_id < b.vec_id for a, b in zip(got, got[1:]))
        for r in got:
            assert abs(r.score - float(np.dot(np.array(of[q], float), np.array(of[r.vec_id], float)))) < 1e-12
        hits += len({r.vec_id for r in got} & {i for i, _ in want[q]})
    assert hits / (20 * len(want)) >= 0.9


def test_search_by_inner_product_with_ties_and_hot_cells(spark):
    draw = random.Random(4)
    rows = [(i, [draw.gauss(0, 1) for _ in range(8)]) for i in range(400)] + [(i, [3.0] + [0.0] * 7) for i in range(1000, 1300)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    asked = [r for r in rows if r[0] % 50 == 0]
    settings = nearest.Hashing(k=20, cell_rows=64, part=100, block=4, recall=1.0)
    all_rows = frame(spark, rows)
    got = {}
    for r in nearest.nearest(all_rows, all_rows.where("vec_id % 50 = 0"), settings).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute_nearest(rows, asked, 20)
    found = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert set(got) == set(want) and found >= 0.95 * 20 * len(want)
    assert got[1050][:19] == want[1050][:19]  # copies of the query, by id


def test_ties_of_different_vectors_go_to_the_smaller_ident(spark):
    draw = random.Random(7)
    rows = [(i, [0.0, *(float(draw.randrange(-9, 10)) for _ in range(6)), float(i + 1)]) for i in range(600)]  # all orthogonal to the query
    draw.shuffle(rows)
    everything = frame(spark, [*rows, (5000, [1.0] + [0.0] * 7)])
    got = nearest.nearest(everything, everything.where("vec_id = 5000"), nearest.Hashing(recall=1.0)).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(i, 0.0) for i in range(20)]


def test_search_goes_on_where_probes_find_too_little(spark):
    draw = np.random.default_rng(9)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(draw.normal(size=(1500, 16)))]
    everything = frame(spark, rows)
    settings = nearest.Hashing(tables=1, cell_rows=4, most_probes=2, part=400, block=16)
    got = {}
    for r in nearest.nearest(everything, everything.where("vec_id % 50 = 0"), settings).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [i for i, _ in found] for q, found in brute_nearest(rows, [x for x in rows if x[0] % 50 == 0], 20).items()}


def test_search_on_awkward_vectors(spark):
    docs = awkward(spark)
    got = {(r.query_id, r["rank"]): r.vec_id for r in nearest.nearest(docs, docs).collect()}
    assert {q for q, _ in got} == {0, 1, 2, 10, 11}
    assert [got[0, r] for r in range(1, 5)] == [1, 2, 10, 11] and got[2, 1] == 11 and (0, 5) not in got
    assert nearest.nearest(docs.limit(0), docs).count() == 0 and nearest.nearest(docs, docs.limit(0)).count() == 0


def test_usable_vectors_and_classes(spark):
    rows = vectors.classes(vectors.usable(awkward(spark), "vec_id", "embedding"), 2).collect()
    assert sorted((r.rep, r.copies, r.ids) for r in rows) == [(0, 1, [0]), (1, 2, [1]), (2, 1, [2]), (10, 1, [10]), (11, 1, [11])]
