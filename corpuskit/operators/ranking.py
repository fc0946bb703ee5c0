"""Ranks in groups of any size: counts of coarse steps first, then the place within a step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _places(df: DataFrame, group: list[str], step: Column, order: list[Column], name: str) -> DataFrame:
    """Number rows from 0 along (step, order); no task holds a group, only its steps' counts or one step."""
    marked = df.withColumn("_step", step)
    counts = marked.groupBy(*group, "_step").agg(F.count("*").alias("_n"))
    ahead = F.coalesce(F.sum("_n").over(W.partitionBy(*group).orderBy("_step").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*group, "_step", ahead.alias("_ahead"))
    within = F.row_number().over(W.partitionBy(*group, "_step").orderBy(*order)) - 1
    return marked.join(counts, [*group, "_step"]).withColumn(name, (F.col("_ahead") + within).cast("bigint")).drop("_step", "_ahead")


def rank_within(df: DataFrame, group: str, score: str, tie: str, width: float, name: str = "rank") -> DataFrame:
    """Rank from 1 by falling ``score``, ties by ``tie``; ``width`` is the size of a step of scores."""
    ranked = _places(df, [group], -F.floor(F.col(score) / width), [F.col(score).desc(), F.col(tie)], "_place")
    return ranked.withColumn(name, F.col("_place") + 1).drop("_place")


def place_by_hash(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Add ``place`` (from 0) in the order of sha1 over the seed and the key: a shuffle that every run repeats."""
    mixed = F.sha1(F.concat(F.lit(str(seed)), F.col(key).cast("string")))
    hashed = df.withColumn("_all", F.lit(0)).withColumn("_mixed", mixed)
    return _places(hashed, ["_all"], F.substring("_mixed", 1, 3), [F.col("_mixed"), F.col(key)], "place").drop("_all", "_mixed")
