"""Connected components of an undirected graph given as edges, with joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.common import discard, materialize, uses


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (``a``, ``b``; longs); the root is the smallest node reachable.

    Alternates two steps until nothing changes: each node links its larger neighbours to its smallest
    neighbour (large star), then its smaller neighbours and itself to the smallest (small star).  Both are
    a minimum by key and a join, so a node with very many links is combined before the shuffle and its
    side of the join can be split.  Rounds grow with the logarithm of the number of nodes.  Each round is
    written to the shared folder; no edge reaches the driver, not even to be broadcast.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        # large star: over edges in both directions, links to larger neighbours move to the minimum
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large)
        # small star: each node's smaller neighbours, and the node itself, move to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least.hint("merge"), "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
        after = materialize(small.select("e.a", "e.b").where("a <> b").distinct())
        # settled when every node has one link and no link's lower end has a link of its own
        links = after.count()
        same = links == now.count() and after.join(now.hint("merge"), ["a", "b"], "left_anti").isEmpty()
        discard(large, now)
        now = after
        if same:
            break
    out = now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
    return uses(out, now)


def named(rows: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` (``doc_id``, ``node``, ...) with ``root`` and ``component_id``, the smallest id of the component.

    ``nodes`` has ``node`` and ``first``, its smallest id; a node that ``roots`` lacks is alone.
    """
    linked = nodes.select("node", "first").join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(linked.join(names.hint("merge"), "root").select("node", "root", "component_id").hint("merge"), "node")


def first_of_each(docs: DataFrame, found: DataFrame, node, id_col: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each component of ``found`` (``doc_id``, ``node``, ``root``): of those that have an id the
    one with the smallest, else one without; ``node`` is the node of a row, as a Column over ``docs``.

    Rows are matched by id and node, both sides dealt by them whatever their size, so texts move once and copies
    of one text are spread by their ids.  Of rows alike in id and node the first in the order of all their columns stays
    (of those that can be ordered; by the JSON text of the others), so reruns agree.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node"))
    keep = found.groupBy("root").agg(first.alias("f")).select(F.col("f.doc_id").alias("doc_id"), F.col("f.node").alias("node"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"), node.alias("at"))
    kept = rows.join(keep.hint("merge"), rows["id"].eqNullSafe(keep["doc_id"]) & (rows["at"] == keep["node"]), "left_semi")
    order = [F.to_json(F.col("row")[c]) if "map<" in kind or "variant" in kind else F.col("row")[c] for c, kind in docs.dtypes]
    return kept.groupBy("id", "at").agg(F.min_by("row", F.struct(*order)).alias("row")).select("row.*")
