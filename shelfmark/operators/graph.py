"""Property-graph tables: nodes and edges as DataFrames.

A node table has one row per key.  An edge table has ``src``, ``rel_type``,
``dst`` and any properties; ``src_label``/``dst_label`` where a table mixes
labels.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.normalize import list_entries
from shelfmark.operators.ordering import first_per_key
from shelfmark.operators.relational import detail_order, restriction, top


def last_per_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Last write wins."""
    return first_per_key(df, key, [F.col(c).desc() for c in order_by])


def upsert_nodes(
    existing: DataFrame, incoming: DataFrame, key: str, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Merge nodes by key; the result has one row per key.

    Incoming columns overwrite, an incoming null removes the property, and
    columns the incoming frame does not mention stay.  ``order_by`` settles
    several incoming rows for one key: the last one wins.  Without it, a
    repeated key is an error, raised when the result is computed.  Rows with a
    null key are no nodes and are left out on both sides.
    """
    incoming = incoming.where(F.col(key).isNotNull())
    if order_by:
        incoming = last_per_key(incoming, [key], order_by)
        new = incoming.select(F.col(key).alias("_new_key"), F.struct(F.lit(True).alias("_here"), *incoming.columns).alias("_new"))
    else:
        new = incoming.groupBy(F.col(key).alias("_new_key")).agg(
            F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(True).alias("_here"), *incoming.columns)).alias("_new")
        )
        single = F.when(F.col("_n") == 1, F.col("_new")).otherwise(
            F.raise_error(F.concat(F.lit("several incoming rows for node "), F.col("_new_key").cast("string")))
        )
        new = new.select("_new_key", single.alias("_new"))
    old = existing.where(F.col(key).isNotNull()).select(F.col(key).alias("_old_key"), F.struct(*existing.columns).alias("_old"))
    merged = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")
    arrived = F.coalesce(F.col("_new._here"), F.lit(False))
    columns = [F.coalesce("_new_key", "_old_key").alias(key)]
    for c in [*existing.columns, *[c for c in incoming.columns if c not in existing.columns]]:
        if c == key:
            continue
        before = F.col(f"_old.{c}") if c in existing.columns else F.lit(None)
        value = F.when(arrived, F.col(f"_new.{c}")).otherwise(before) if c in incoming.columns else before
        columns.append(value.alias(c))
    return merged.select(*columns)


def edges_from_list(df: DataFrame, key: str, column: str, rel_type: str) -> DataFrame:
    """Distinct edges from each row to the names in a list column."""
    pairs = list_entries(df.where(F.col(key).isNotNull()), key, column)
    return pairs.select(
        F.col("game_appid").alias("src"), F.lit(rel_type).alias("rel_type"), F.col("name").alias("dst")
    ).distinct()


def edge_targets(edges: DataFrame, key: str = "name") -> DataFrame:
    """Target nodes the edges create: distinct names."""
    return edges.select(F.col("dst").alias(key)).distinct()


def edges_from_bridge(
    bridge: DataFrame,
    src: str,
    dst: str,
    rel_type: str,
    src_nodes: DataFrame,
    src_key: str,
    dst_nodes: DataFrame,
    dst_key: str,
    properties: Sequence[str] = (),
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Edges whose two ends exist; with properties, the last write per edge in ``order_by`` wins."""
    if properties and not order_by:
        raise ValueError("edge properties need order_by: the order of the writes")
    written = [F.col(c).alias(f"_order_{c}") for c in order_by or ()]
    ends = [F.col(src).alias("src"), F.lit(rel_type).alias("rel_type"), F.col(dst).alias("dst")]
    links = bridge.select(*ends, *properties, *written)
    if properties:
        links = last_per_key(links, ["src", "rel_type", "dst"], [f"_order_{c}" for c in order_by])
    else:
        links = links.select("src", "rel_type", "dst").distinct()
    return links.join(src_nodes.select(F.col(src_key).alias("src")), "src", "left_semi").join(
        dst_nodes.select(F.col(dst_key).alias("dst")), "dst", "left_semi"
    ).select("src", "rel_type", "dst", *properties)


def edges_from_fk(
    child: DataFrame, child_key: str, foreign_key: str, rel_type: str, parent: DataFrame, parent_key: str,
    from_parent: bool = True,
) -> DataFrame:
    """Edges between rows and the node their foreign key names, if it exists."""
    links = child.where(F.col(child_key).isNotNull()).select(
        F.col(child_key).alias("_child"), F.col(foreign_key).alias("_parent")
    )
    kept = links.join(parent.select(F.col(parent_key).alias("_parent")), "_parent", "left_semi").distinct()
    ends = ("_parent", "_child") if from_parent else ("_child", "_parent")
    return kept.select(F.col(ends[0]).alias("src"), F.lit(rel_type).alias("rel_type"), F.col(ends[1]).alias("dst"))


def name_match_links(left: DataFrame, left_name: str, right: DataFrame, right_name: str) -> DataFrame:
    """Links between nodes with the same lower-cased name, counted per name.

    Both sides are counted per name first and the counts multiplied, so a name
    shared by many nodes on both sides never expands into its pairs.
    """

    def counted(df: DataFrame, name: str, out: str) -> DataFrame:
        return (
            df.where(F.col(name).isNotNull())
            .groupBy(F.lower(F.col(name)).alias("match_name"))
            .agg(F.count(F.lit(1)).alias(out))
        )

    return (
        counted(left, left_name, "left_nodes")
        .join(counted(right, right_name, "right_nodes"), "match_name")
        .withColumn("links", F.col("left_nodes") * F.col("right_nodes"))
    )


def name_match_edges(
    left: DataFrame, left_key: str, left_name: str, right: DataFrame, right_key: str, right_name: str, rel_type: str
) -> DataFrame:
    """The same links as edges through one hub per shared name.

    Two nodes are linked when they meet at a hub.  The table grows with the
    nodes, not with the pairs of nodes that share a name.
    """

    def spokes(df: DataFrame, key: str, name: str, side: str) -> DataFrame:
        return df.where(F.col(name).isNotNull()).select(
            F.lit(side).alias("side"), F.col(key).cast("string").alias("node"), F.lower(F.col(name)).alias("hub")
        )

    shared = name_match_links(left, left_name, right, right_name).select(F.col("match_name").alias("hub"))
    both = spokes(left, left_key, left_name, "left").unionByName(spokes(right, right_key, right_name, "right"))
    return both.join(shared, "hub", "left_semi").select("side", "node", F.lit(rel_type).alias("rel_type"), "hub")


def label_counts(nodes: DataFrame, label: str = "label") -> DataFrame:
    counts = nodes.groupBy(label).agg(F.count(F.lit(1)).alias("node_count"))
    return counts.orderBy(F.desc("node_count"), F.asc(label))


def detach_delete(nodes: DataFrame, edges: DataFrame, labels: Sequence[str] | None) -> tuple[DataFrame, DataFrame]:
    """Remove all nodes with these labels (all nodes for None) and their edges.

    Edges carry the labels of both ends, so no join is needed.
    """
    if labels is None:
        return nodes.limit(0), edges.limit(0)
    gone = list(labels)

    def stays(label: str) -> Column:
        return ~F.coalesce(F.col(label).isin(gone), F.lit(False))  # a null label is none of them

    return nodes.where(stays("label")), edges.where(stays("src_label") & stays("dst_label"))


def dangling_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with an end that is no node, and which end that is."""
    keys = nodes.select("label", "key")

    def missing(end: str) -> DataFrame:
        on = (F.col(f"{end}_label") == keys.label) & (F.col(end) == keys.key)
        return edges.join(keys, on, "left_anti").withColumn("missing_end", F.lit(end))

    return missing("src").unionByName(missing("dst"))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that break a uniqueness constraint, with their row counts."""
    for c in key:
        df = df.where(F.col(c).isNotNull())
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def match(
    start: DataFrame, start_key: str, edges: DataFrame, end: DataFrame, end_key: str, into: str,
    fields: Sequence[str], optional: bool = False,
) -> DataFrame:
    """(start)-[edge]->(end): the end node's fields arrive as a struct.

    An optional match keeps start rows without a match, with a null struct.
    """
    ends = end.select(F.col(end_key).alias("_end"), F.struct(*fields).alias(into))
    # From the start side outwards: ends are looked up for edges of start rows only.
    steps = start.join(edges.select("src", "dst"), F.col(start_key) == F.col("src"))
    found = steps.join(ends, F.col("dst") == F.col("_end")).drop("src", "dst", "_end")
    if not optional:
        return found
    linked = edges.select("src", "dst").join(ends.select("_end"), F.col("dst") == F.col("_end"), "left_semi")
    alone = start.join(linked.select("src"), F.col(start_key) == F.col("src"), "left_anti")
    return found.unionByName(alone, allowMissingColumns=True)



def count_by_genre(genre_edges: DataFrame, genres: DataFrame, limit: int | None = 100) -> DataFrame:
    """Edges counted per target first; the match then sees one row per genre."""
    per_target = genre_edges.groupBy("dst").agg(F.count("src").alias("edges"))
    rows = (
        per_target.join(genres.select(F.col("genre_id").alias("dst"), F.col("name").alias("genre")), "dst")
        .groupBy("genre")
        .agg(F.sum("edges").alias("game_count"))
    )
    return top(rows, [F.desc("game_count"), F.asc("genre")], limit)


def games_with_developers(
    games: DataFrame, developer_edges: DataFrame, developers: DataFrame, min_price: float, limit: int | None = 100
) -> DataFrame:
    start = games.where(F.col("price") > min_price).select("appid", F.col("name").alias("game_name"))
    found = match(start, "appid", developer_edges, developers, "developer_id", "d", ["name"])
    rows = found.select("appid", "game_name", F.col("d.name").alias("developer"))
    return top(rows, [F.asc("appid"), F.asc("developer")], limit)



def game_details(
    games: DataFrame,
    patterns: Sequence[tuple[DataFrame, DataFrame, str, str]],
    low: float,
    high: float,
    limit: int | None = 100,
) -> DataFrame:
    """Optional matches per pattern (edges, nodes, node key, output column), one after the other.

    With a limit the games are cut first, as each gives a row at least, and
    edges are made distinct and matched for these games only.
    """
    rows = games.where(F.col("price").between(low, high)).select("appid", F.col("name").alias("game_name"))
    names = [out for *_, out in patterns]
    if limit is not None:
        rows = top(rows, [F.asc("appid")], limit)
        only = restriction(rows.where(F.col("appid").isNotNull()), limit)
        patterns = [(only(edges, "src"), *rest) for edges, *rest in patterns]
    for step, (edges, nodes, key, out) in enumerate(patterns, start=1):
        found = match(rows, "appid", edges, nodes, key, "_node", ["name"], optional=True)
        rows = found.withColumn(out, F.col("_node.name")).drop("_node")
        if limit is not None:
            rows = top(rows, detail_order(*names[:step]), limit)
    return top(rows.select("appid", "game_name", *names), detail_order(*names), limit)


def count_by_label(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Node counts per label over separate node tables."""
    parts = [df.agg(F.count(F.lit(1)).alias("node_count")).select(F.lit(l).alias("label"), "node_count") for l, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.orderBy(F.desc("node_count"), F.asc("label"))
