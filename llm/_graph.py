"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import _common
from llm._common import forget, hot_join, materialise


def _with_least(edges: DataFrame, key: str, other: str, few: bool, scratch: list[str]) -> tuple[DataFrame, DataFrame]:
    """edges with m (the least neighbour of key, or key itself), and (key, m) alone. A table of few edges is broadcast."""
    g = edges.groupBy(key).agg(F.min(other).alias("m"), F.count("*").alias("degree")).select(key, F.least(key, "m").alias("m"), "degree")
    if few:
        return edges.join(F.broadcast(g), key), g
    g = materialise(g, "least", scratch)
    return hot_join(edges, g, [key], "degree"), g


def components(edges: DataFrame, left: list[str] | None = None) -> DataFrame:
    """(a, b) links -> (node, root): every node with a link, and the smallest node reachable from it.

    Each step is a grouped minimum (partial before the shuffle) and a join whose
    hot nodes are broadcast, so a node with very many links is no hot spot; nothing
    is collected. Self links and repeats are ignored; no links give no rows. The
    folders of a round are deleted in the next; the last one's path is added to left.
    """
    spark, scratch, older = edges.sparkSession, [], []
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = materialise(edges, "edges", scratch)
    now = mark(edges)
    while now[0]:
        few = 2 * now[0] <= _common.BROADCAST_ROWS
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large, _ = _with_least(both, "a", "b", few, scratch)
        large = materialise(large.where("b > a AND b <> m").select(F.col("m").alias("a"), "b").distinct(), "large-star", scratch)
        if (after := mark(large)) == now:  # stars stay as they are
            break
        few = after[0] <= _common.BROADCAST_ROWS
        small, low = _with_least(large.select(F.col("b").alias("u"), F.col("a").alias("v")), "u", "v", few, scratch)
        small = small.where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b")).union(low.select(F.col("m").alias("a"), F.col("u").alias("b")))
        edges = materialise(small.distinct(), "small-star", older)
        forget(spark, scratch)
        scratch, older = older, scratch
        now = mark(edges)
    if left is not None:
        left += scratch
    return edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
