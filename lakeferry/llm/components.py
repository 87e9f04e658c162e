"""Connected components by alternating large-star and small-star, on DataFrames.

Before every round each task turns its edges, an Arrow batch at a time, into the star
forest that joins the same nodes, so only a fraction of the edges is shuffled and long
paths shorten at once. The large star is a join of the edges with the least neighbour of
every node, which is in a table already: Spark's adaptive join splits the edges of a hub
once they are larger than ``skewedPartitionThresholdInBytes``. The small star is an
aggregation and a join by the larger node of an edge; behind the star forests a node has at
most one smaller neighbour from each batch.

One aggregation by node gives the labels and tells whether the edges are stars already, so
no round is spent on seeing that nothing changes. Every round is written to a scratch
table; only a count reaches the driver.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import Scratch, few_tasks, map_arrow

EDGES = 200_000  # in a task of a round, at least


def _forest(batch: pa.RecordBatch):
    up: dict = {}

    def find(x):
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x

    for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
        x, y = find(u), find(v)
        if x != y:
            up[max(x, y)] = min(x, y)
    stars = [(x, find(x)) for x in up]
    yield {"u": [x for x, r in stars if x != r], "v": [r for x, r in stars if x != r]}


def local_stars(e: DataFrame) -> DataFrame:
    """Edges (u, v), u > v, that join the same nodes: a star forest of every batch."""
    return map_arrow(e, _forest, e.schema)


def _oriented(e: DataFrame) -> DataFrame:
    """Distinct edges (u, v), u > v, with built-in functions."""
    return e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(e: DataFrame, labels: DataFrame) -> DataFrame:
    """Every larger neighbour of a node joined to the smallest of the node and its neighbours,
    which ``labels`` holds. Both sides are read from tables, so a hub's edges can be split."""
    return e.join(labels, e.v == labels.node).select("u", F.col("component").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """Of edges that point from the larger to the smaller node, as the large star's do."""
    low = e.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "mu")
    x = e.join(low, e.u == low.mu).drop("mu")
    moved = x.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(x.select("u", F.col("m").alias("v")))


def _counted(e: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    seen = Observation()
    e = scratch.table(e.observe(seen, F.count("*").alias("n")), "edges")
    return e, seen.get.get("n") or 0


def _labels(e: DataFrame, n: int, scratch: Scratch) -> tuple[DataFrame, int]:
    """(node, smallest of it and its neighbours) of ``n`` edges, the component if they are
    stars, and how many nodes show that they are not: those with two smaller neighbours, or
    with both a smaller and a larger one."""
    ends = e.select(F.col("u").alias("node"), "v").unionByName(
        e.select(F.col("v").alias("node"), F.lit(None).cast(e.schema["v"].dataType).alias("v")))
    # a centre adds rows without a neighbour
    nodes = ends.groupBy("node").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.max(F.col("v").isNull()).alias("centre"))
    bad = (F.col("lo") != F.col("hi")) | (F.col("lo").isNotNull() & F.col("centre"))
    seen = Observation()
    labels = nodes.observe(seen, F.count_if(bad).alias("bad")).select(
        "node", F.coalesce("lo", "node").alias("component"))
    labels = scratch.table(few_tasks(labels, 2 * n, EDGES), "labels")
    return labels, seen.get["bad"]


def connected_components(edges: DataFrame, scratch: Scratch, native: bool = False) -> DataFrame:
    """(node, component) for every node with an edge; the component is its smallest node.

    ``edges`` has two columns of one orderable type. Self-loops, repeated edges, either
    direction and rows with a null are allowed (nulls and loops are ignored). An empty
    input gives an empty result. Each round halves the depth of the trees at least, so
    rounds grow with the logarithm of the longest path. With ``native`` no edges are joined
    in Python before a round, only repeated ones dropped.
    """
    local = _oriented if native else local_stars
    a, b = edges.columns
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e, n = _counted(local(e), scratch)
    while True:
        labels, bad = _labels(e, n, scratch)
        if not bad:
            scratch.drop(e)
            return labels
        stars = _small_star(_large_star(e, labels))
        nxt, n = _counted(local(few_tasks(stars, n, EDGES)), scratch)
        scratch.drop(e, labels)
        e = nxt
