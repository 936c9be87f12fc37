"""Connected components by alternating stars, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from tickloom.llm.tables import discard, stored

MAX_ROUNDS = 60  # rounds grow as the logarithm of the longest path; this is a guard against a bug


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step. Large: every greater neighbour of a node moves to the least node it sees.
    Small: the node and its smaller neighbours move to the least of them. The minima are
    grouped before they are shuffled, and a node with very many neighbours is only ever the
    many side of a join, which adaptive execution may split."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    moved = moved.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v"))
    # A large step gives one link for each it had at most; the small step that follows makes them distinct.
    return moved if large else moved.distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every link leads to a least node: no node has two links, or is linked to and has one."""
    ends = F.expr("array(named_struct('node', u, 'links', 1, 'root', 0), named_struct('node', v, 'links', 0, 'root', 1))")
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("links").alias("links"), F.max("root").alias("root"))
    return nodes.where("links + root > 1").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v), both bigint; component is the
    least node that can be reached. Self-links and repeated links do no harm; nulls are left out.

    Every round is written to the shared folder, which cuts the lineage; the round before is removed then.
    Whether the links are settled is looked at when a round leaves their number as it was."""
    edges = edges.where("u is not null and v is not null")
    alone = edges.where("u = v").select("u")
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    count = None
    for _ in range(MAX_ROUNDS):
        # The links are counted as they are written.
        seen = Observation()
        before, edges = edges, stored(_stars(_stars(edges, True), False).observe(seen, F.count(F.lit(1)).alias("n")), "stars")
        discard(before)
        now = seen.get.get("n")
        if now == count and _settled(edges):
            break
        count = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    nodes = nodes.unionByName(roots).unionByName(alone.select(F.col("u").alias("node"), F.col("u").alias("component")))
    return nodes.groupBy("node").agg(F.min("component").alias("component"))
