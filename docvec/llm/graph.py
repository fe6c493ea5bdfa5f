"""Connected components by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docvec.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Hangs every larger neighbour of a node on the smallest of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.join(least, "a")
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours on the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    rest = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root): the smallest node reachable, for each node that has an edge.

    ``edges`` has two columns of one orderable type. Loops, nulls, repeated and
    reversed edges do no harm. Alternating large and small stars end after about
    log(n) rounds; each round is written to the shared folder, and only a count and
    a checksum come to the driver. A hub meets a one-row side in every join, which
    adaptive execution splits.
    """
    a, b = edges.columns
    now = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct()
    before = None
    while True:
        now = stored(_small_star(_large_star(now)), "stars")
        seen = now.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first()
        if seen == before:
            break
        before = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b").distinct()
    )
