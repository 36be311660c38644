"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

PART_ROWS, LEAST_PARTS = 200_000, 8  # rows of a part of a round's tables, and the fewest parts


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (columns a, b); the root is the least node.

    Alternating large-star and small-star steps: each round links neighbours to the least
    node they know, and the edge list ends as one star per component after a number of
    rounds that grows with the logarithm of its size. Every round is one written table;
    only its row count and a checksum reach the driver. Least neighbours are written before
    they are joined, so that both sides are plain exchanges and a hot node's rows are split.
    The tables of a round have as many parts as their rows ask for, whatever the number of
    shuffle partitions: a round is nine stages, and small edge lists would be mostly empty tasks.
    """
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(edges)
    while True:
        parts = max(LEAST_PARTS, -(-2 * mark[0] // PART_ROWS))
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(parts)
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = stage(least.coalesce(parts), "least")
        passed = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(passed.coalesce(parts).distinct().coalesce(parts), "large")
        lower = stage(large.groupBy("a").agg(F.min("b").alias("m")).coalesce(parts), "lower")
        # (a, b) becomes (b, m), and a itself links to m
        passed = large.join(lower, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        linked = passed.coalesce(parts).unionAll(lower.select("a", F.col("m").alias("b")))
        edges = stage(linked.distinct().coalesce(parts), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())
