"""Connected components by alternating large-star and small-star steps.

Each step replaces the neighbours of every node by links to the smallest node
that it sees. Only per-node minima are aggregated (with map-side partial
aggregation); no neighbour list is ever collected, neither in a task nor at the
driver. Edge tables are written to the shared folder after every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm import scratch


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low")).select("n", F.least("n", "low").alias("low"))
    return both.join(low, both.a == low.n).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Every edge has a > b here, as large-star leaves them."""
    low = e.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low"))
    moved = e.join(low, e.a == low.n).where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select(F.col("n").alias("a"), F.col("low").alias("b"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """Return (node, component) for every node that has an edge to another node.

    ``component`` is the smallest node reachable. Null ends and self-links are
    ignored; repeated edges and either direction are fine; an empty table gives
    an empty result.
    """
    spark = edges.sparkSession
    first = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(f"`{a}` is not null and `{b}` is not null").where("a <> b").distinct()
    path = scratch.write(first, "edges")
    now = scratch.read_back(first, path)
    seen = None
    for _ in range(max_rounds):
        stepped = _small_star(_large_star(now))
        after = scratch.write(stepped, "edges")
        now = scratch.read_back(first, after)
        scratch.drop(spark, path)
        path = after
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
