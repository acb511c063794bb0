import pytest
from pyspark.sql import functions as F

from shelfmark.operators import graph


def test_upsert_overwrites_removes_and_keeps(spark, rows):
    old = spark.createDataFrame([(1, "x", 10), (2, "y", 20)], "id int, name string, size int")
    new = spark.createDataFrame([(1, None, 5.0), (3, "z", 6.0)], "id int, name string, price double")
    out = graph.upsert_nodes(old, new, "id")
    assert out.columns == ["id", "name", "size", "price"]
    assert rows(out) == [(1, None, 10, 5.0), (2, "y", 20, None), (3, "z", None, 6.0)]


def test_upsert_takes_the_last_row_of_a_batch(spark, rows):
    old = spark.createDataFrame([(1, "x")], "id int, name string")
    new = spark.createDataFrame([(1, "a", 1), (1, None, 3), (1, "b", 2)], "id int, name string, seq int")
    assert rows(graph.upsert_nodes(old, new, "id", ["seq"])) == [(1, None, 3)]


def test_edges_from_list(spark, rows):
    df = spark.sql("select * from values (1, array('a', 'a', '', null)), (2, null), (3, array('a', 'b')) t(id, names)")
    edges = graph.edges_from_list(df, "id", "names", "HAS")
    assert rows(edges) == [(1, "HAS", "a"), (3, "HAS", "a"), (3, "HAS", "b")]
    assert rows(graph.edge_targets(edges)) == [("a",), ("b",)]


@pytest.fixture(scope="module")
def ends(spark):
    return spark.range(1, 4).select(F.col("id").alias("g")), spark.range(1, 4).select(F.col("id").alias("t"))


def test_edges_need_both_ends_and_are_distinct(spark, ends, rows):
    links = spark.createDataFrame([(1, 1), (1, 1), (2, 9), (9, 2), (3, 2)], "g bigint, t bigint")
    edges = graph.edges_from_bridge(links, "g", "t", "R", ends[0], "g", ends[1], "t")
    assert rows(edges) == [(1, "R", 1), (3, "R", 2)]


def test_edge_property_last_write_wins(spark, ends, rows):
    links = spark.createDataFrame([(1, 1, 5, 2), (1, 1, 9, 1), (2, 2, 3, 1)], "g bigint, t bigint, votes int, seq int")
    edges = graph.edges_from_bridge(
        links, "g", "t", "R", ends[0], "g", ends[1], "t", properties=["votes", "seq"], order_by=["seq"]
    )
    assert rows(edges, "src", "dst", "votes") == [(1, 1, 5), (2, 2, 3)]


def test_edges_from_foreign_key(spark, ends, rows):
    reviews = spark.createDataFrame([(100, 1), (101, 1), (102, 7), (None, 1)], "r bigint, g bigint")
    assert rows(graph.edges_from_fk(reviews, "r", "g", "REVIEWED", ends[0], "g", from_parent=False)) == [
        (100, "REVIEWED", 1),
        (101, "REVIEWED", 1),
    ]
    assert rows(graph.edges_from_fk(reviews, "r", "g", "HAS", ends[0], "g")) == [(1, "HAS", 100), (1, "HAS", 101)]


def test_name_links_count_pairs_without_building_them(spark, rows):
    left = spark.range(3000).select("id", F.when(F.col("id") < 2000, "Doom").otherwise("Quake").alias("name"))
    right = spark.range(2500).select("id", F.when(F.col("id") < 1500, "DOOM").otherwise("other").alias("name"))
    assert rows(graph.name_match_links(left, "name", right, "name")) == [("doom", 2000, 1500, 3_000_000)]
    edges = graph.name_match_edges(left, "id", "name", right, "id", "name", "HAS_PLAYTIME_DATA")
    assert edges.count() == 3500
    hubs = edges.groupBy("hub").agg(F.count_if(F.col("side") == "left").alias("l"), F.count_if(F.col("side") == "right").alias("r"))
    assert rows(hubs) == [("doom", 2000, 1500)]


@pytest.fixture(scope="module")
def small_graph(spark):
    nodes = spark.createDataFrame([("G", 1), ("G", 2), ("D", 1), ("T", 1)], "label string, key int")
    edges = spark.createDataFrame(
        [("G", 1, "BY", "D", 1), ("G", 2, "BY", "D", 5), ("G", 1, "TAG", "T", 1), ("G", 8, "TAG", "T", 9)],
        "src_label string, src int, rel_type string, dst_label string, dst int",
    )
    return nodes, edges


def test_label_counts(small_graph, spark):
    assert [tuple(r) for r in graph.label_counts(small_graph[0]).collect()] == [("G", 2), ("D", 1), ("T", 1)]
    per_table = graph.count_by_label({"A": spark.range(2), "B": spark.range(5)})
    assert [tuple(r) for r in per_table.collect()] == [("B", 5), ("A", 2)]


def test_detach_delete(small_graph, rows):
    nodes, edges = graph.detach_delete(*small_graph, ["T"])
    assert rows(nodes) == [("D", 1), ("G", 1), ("G", 2)]
    assert rows(edges, "rel_type", "src", "dst") == [("BY", 1, 1), ("BY", 2, 5)]
    nothing = graph.detach_delete(*small_graph, None)
    assert nothing[0].isEmpty() and nothing[1].isEmpty()


def test_dangling_edges(small_graph, rows):
    found = graph.dangling_edges(small_graph[1], small_graph[0])
    assert rows(found, "missing_end", "src", "dst") == [("dst", 2, 5), ("dst", 8, 9), ("src", 8, 9)]


def test_duplicate_keys(spark, rows):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows(graph.duplicate_keys(df, ["k"])) == [(1, 2)]


def test_match_and_optional_match(spark, rows):
    start = spark.createDataFrame([(1,), (2,)], "id int")
    ends = spark.createDataFrame([(10, "x"), (11, "y")], "k int, name string")
    edges = spark.createDataFrame([(1, "R", 10), (1, "R", 11), (2, "R", 99)], "src int, rel_type string, dst int")
    assert rows(graph.match(start, "id", edges, ends, "k", "e", ["name"]), "id", "e.name") == [(1, "x"), (1, "y")]
    optional = graph.match(start, "id", edges, ends, "k", "e", ["name"], optional=True)
    assert rows(optional, "id", "e.name") == [(1, "x"), (1, "y"), (2, None)]


def test_upsert_takes_one_row_per_key_and_no_null_key(spark, rows):
    old = spark.createDataFrame([(1, "x"), (None, "lost")], "id int, name string")
    new = spark.createDataFrame([(None, "nobody"), (2, None)], "id int, name string")
    assert rows(graph.upsert_nodes(old, new, "id")) == [(1, "x"), (2, None)]
    twice = spark.createDataFrame([(2, "a"), (2, "b")], "id int, name string")
    with pytest.raises(Exception, match="several incoming rows for node 2"):
        graph.upsert_nodes(old, twice, "id").collect()


def test_edge_properties_need_an_order_and_keep_the_last_write(spark, rows):
    links = spark.createDataFrame([(1, 2, 9, 1), (1, 2, 2, 2)], "g int, t int, votes int, seq int")
    games, tags = spark.createDataFrame([(1,)], "g int"), spark.createDataFrame([(2,)], "t int")
    with pytest.raises(ValueError):
        graph.edges_from_bridge(links, "g", "t", "R", games, "g", tags, "t", properties=["votes"])
    last = graph.edges_from_bridge(links, "g", "t", "R", games, "g", tags, "t", properties=["votes"], order_by=["seq"])
    assert rows(last) == [(1, "R", 2, 2)]


def test_detach_delete_keeps_null_labels(spark, rows):
    nodes = spark.createDataFrame([("A", 1), (None, 2)], "label string, key int")
    edges = spark.createDataFrame([(None, 2, "R", "B", 3), ("A", 1, "R", None, 2)], "src_label string, src int, rel_type string, dst_label string, dst int")
    left, kept = graph.detach_delete(nodes, edges, ["A"])
    assert rows(left, "key") == [(2,)] and rows(kept, "src", "dst") == [(2, 3)]


def test_game_details_take_edges_of_the_first_games_only(spark, rows, tmp_path):
    """The links are filtered before they are made distinct; games without an id or a link stay."""
    links = [(g, t) for g in range(1, 60) for t in (g % 3, g % 3, 7)] + [(None, 1)]
    spark.createDataFrame(links, "game bigint, dev bigint").write.parquet(str(tmp_path / "links"))
    games = spark.createDataFrame([(None, "z", 1.0), (99, "y", 1.0), *[(g, f"g{g}", 1.0) for g in range(2, 50)]], "appid bigint, name string, price double")
    devs = spark.createDataFrame([(0, "a"), (1, "b"), (2, None), (8, "c")], "dev bigint, name string")
    edges = graph.edges_from_bridge(spark.read.parquet(str(tmp_path / "links")), "game", "dev", "BY", games, "appid", devs, "dev")
    patterns = [(edges, devs, "dev", "developer"), (edges, devs, "dev", "again")]
    cut = graph.game_details(games, patterns, 0, 2, 4)
    assert [tuple(r) for r in cut.collect()] == [(None, "z", None, None), (2, "g2", None, None), (3, "g3", "a", "a"), (4, "g4", "b", "b")]
    assert [tuple(r) for r in cut.collect()] == [tuple(r) for r in graph.game_details(games, patterns, 0, 2, None).collect()[:4]]
    plan = cut._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet [game" in line]
    assert scans and all("In(game, [2,3,4])" in line for line in scans)
    assert rows(graph.game_details(games.where("appid IS NULL"), patterns, 0, 2, 4)) == [(None, "z", None, None)]
