"""Connected components of an edge table as repeated joins (alternating stars)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (a, b) with a > b.

    Every node's neighbours are re-linked to the smallest label around it:
    the larger neighbours in the large step, the smaller ones and the node
    itself in the small step. The smallest label per node is a combining
    aggregate; the join back to the neighbours is splittable by AQE because
    the aggregate is written first.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = saved(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")), "star-min")
    linked = both.join(least, "u")
    if large:
        out = linked.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return saved(out.filter("a > b").distinct(), "star-edges")


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is
    its smallest node. Edges are undirected; loops and repeats are allowed and
    an empty table gives an empty result. Raises if ``max_rounds`` do not
    settle it, rather than return a partial answer."""
    cur = saved(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(),
        "cc-edges",
    )
    signature = None
    for _ in range(max_rounds):
        cur = _star(_star(cur, large=True), large=False)
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == signature:
            roots = cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
        signature = tuple(now)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
