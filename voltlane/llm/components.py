"""Connected components of an edge table: stars of parts of the edges, then alternating large and small stars."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlane.llm.arrow import bounded
from voltlane.scratch import discard, free_shuffles, staged_at

ROUNDS = 60
PART = 1 << 20  # edges that are made stars at once


def _roots(a: np.ndarray, b: np.ndarray, nodes: int) -> np.ndarray:
    """The least node that each node, a number below ``nodes``, reaches over the edges a to b."""
    root = np.arange(nodes)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for end in (a, b):
            np.minimum.at(new, root[end], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def star_batches(batches):
    """Edges that connect what those of ``batches`` (u, v) do: of each ``PART`` of them, from every node to the least that it
    reaches over these. What makes edges in Python passes them through here itself (``components(starred=True)``): as a
    second Python operator of its stage, this would take a second Python worker for each task."""
    waiting, rows = [], 0

    def made():
        u, v = (np.concatenate([b.column(k).to_numpy() for b in waiting]) for k in (0, 1))
        ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = _roots(at[: len(u)], at[len(u) :], len(ids))
        moved = np.flatnonzero(root != np.arange(len(ids)))
        for k in range(0, len(moved), 1 << 16):
            own = moved[k : k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(ids[root[own]])], names=["u", "v"])

    for batch in batches:
        waiting.append(batch)
        rows += batch.num_rows
        if rows >= PART:
            yield from made()
            waiting, rows = [], 0
    if rows:
        yield from made()


def _stars(edges: DataFrame) -> DataFrame:
    """``star_batches`` of the edges that each task reads. No shuffle is needed, and most groups are small, so few rounds are
    left to do."""
    return bounded(edges).select("u", "v").mapInArrow(star_batches, "u long, v long")


def _least(edges: DataFrame, least) -> DataFrame:
    """(u, m) by node. Grouped by the inverted node: so the rows are shuffled again for the join that follows, which
    Spark can then split where a node has very many edges; it doesn't split a join right behind an aggregate."""
    inverted = edges.groupBy(F.bitwise_not("u").alias("not_u")).agg(least.alias("m"))
    return inverted.select(F.bitwise_not("not_u").alias("u"), "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the least of the node and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both, F.least(F.min("v"), F.min("u")))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them."""
    least = _least(edges, F.min("v"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _ends(edges: DataFrame) -> DataFrame:
    """Per node the least and the greatest node that it has an edge to, and whether an edge leads to it."""
    ends = edges.select(F.col("u").alias("node"), "v", F.lit(False).alias("root"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("v"), F.lit(True).alias("root")))
    return ends.groupBy("node").agg(F.min("v").alias("least"), F.max("v").alias("most"), F.max("root").alias("root"))


def components(edges: DataFrame, tidy: bool = False, starred: bool = False) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (u, v), whole numbers; a component is its least node.

    Edges are table rows throughout, no list of neighbours is built, and each round is written to the shared folder.
    A task makes stars of the edges that it reads. Where these leave a node with several edges, or with one to it and one
    from it, rounds of large and small stars follow, each of which tasks make stars of again. The least neighbours are
    partial aggregates; a node with many neighbours makes a skewed join, which Spark splits. ``tidy`` deletes a round
    once the next one is written, and the shuffle files of both. ``starred``: tasks have made stars of ``edges`` already."""
    spark = edges.sparkSession

    def gone(path):
        if tidy:
            discard(spark, path)
            free_shuffles(spark)

    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges, path = staged_at(edges if starred else _stars(edges), "edges")
    for _ in range(ROUNDS):
        # Written again by few tasks, which see up to PART of the edges each.
        edges, last = staged_at(_stars(edges.coalesce(max(1, math.ceil(edges.count() / PART)))), "stars")
        gone(path)
        ends, at = staged_at(_ends(edges), "ends")
        if ends.filter("least <> most or (least is not null and root)").isEmpty():
            return ends.select("node", F.coalesce("least", "node").alias("component"))
        gone(at)
        edges, path = staged_at(_small_star(_large_star(edges)), "round")
        gone(last)
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
