"""Hard negatives, splits by anchor, and retrieval and answer metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuskit.operators.ranking import place_by_hash


def hard_negatives(ranked: DataFrame, positives: DataFrame, negs_per_pair: int = 1, skip_top: int = 2, last_rank: int = 20) -> DataFrame:
    """Negatives of each (q, positive_id): near the top, but neither its very top nor the positive.

    ``ranked`` has q, doc_id and rank (from 1) of at least ``last_rank`` + 2
    documents. The last usable place, counted from 0, is ``last_rank``; where the
    positive stands there, the place after it.
    """
    pairs = ranked.join(positives.select("q", "positive_id"), "q").withColumn("place", F.col("rank") - 1)
    per = W.partitionBy("q", "positive_id")
    last = F.max(F.when((F.col("doc_id") == F.col("positive_id")) & (F.col("place") == last_rank), last_rank + 1).otherwise(last_rank)).over(per)
    usable = pairs.withColumn("last", last).where((F.col("place") >= skip_top) & (F.col("place") <= F.col("last")) & (F.col("doc_id") != F.col("positive_id")))
    return usable.withColumn("n", F.row_number().over(per.orderBy("place"))).where(F.col("n") <= negs_per_pair).select("q", "positive_id", F.col("doc_id").alias("negative_id"), "place")


def split_by_anchor(rows: DataFrame, anchor: str = "q", fraction: float = 0.2, seed: int = 13) -> DataFrame:
    """Add ``part``: max(1, int(fraction * anchors)) anchors are for evaluation, all rows of an anchor together."""
    anchors = place_by_hash(rows.select(anchor).distinct(), anchor, seed)
    size = anchors.agg(F.greatest(F.lit(1), F.floor(F.count("*") * F.lit(fraction))).alias("n_eval"))
    part = anchors.join(F.broadcast(size)).select(anchor, F.when(F.col("place") < F.col("n_eval"), "eval").otherwise("train").alias("part"))
    return rows.join(part, anchor)


def split_validation(rows: DataFrame, key: str, fraction: float = 0.05, least: int = 8, seed: int = 13) -> DataFrame:
    placed = place_by_hash(rows, key, seed)
    size = rows.agg(F.greatest(F.lit(least), F.floor(F.count("*") * F.lit(fraction))).alias("n_val"))
    return placed.join(F.broadcast(size)).withColumn("part", F.when(F.col("place") < F.col("n_val"), "val").otherwise("train")).drop("place", "n_val")


def qrels(pairs: DataFrame, anchor: str = "q", positive: str = "positive_id") -> DataFrame:
    return pairs.select(anchor, positive).distinct()


def triplet_texts(triplets: DataFrame, anchors: DataFrame, corpus: DataFrame, anchor: str = "q") -> DataFrame:
    """(anchor id, anchor, positive, negative) as texts.

    ``anchors``: anchor id, text; ``corpus``: doc_id, text and ``place``. Of rows
    that repeat a doc_id the one with the last place counts; negatives and
    positives without a text are left out.
    """
    texts = corpus.groupBy("doc_id").agg(F.max(F.struct("place", "text")).alias("last")).select("doc_id", F.col("last.text").alias("text"))
    made = triplets.join(anchors.select(anchor, F.col("text").alias("anchor")), anchor)
    for side in ("positive", "negative"):
        made = made.join(texts.select(F.col("doc_id").alias(f"{side}_id"), F.col("text").alias(side)), f"{side}_id")
    return made


def triplet_counts(triplets: DataFrame, anchor: str = "q", part: str = "part") -> DataFrame:
    """Triplets and different anchors of each part."""
    return triplets.groupBy(part).agg(F.count("*").alias("triplets"), F.count_distinct(anchor).alias("anchors"))


def mean_scores(rows: DataFrame, *scores: str, digits: int = 3) -> DataFrame:
    """Number and mean of each score over the rows that have one; one row."""
    return rows.agg(*(x for c in scores for x in (F.count(c).alias(f"n_{c}"), F.round(F.avg(c), digits).alias(f"mean_{c}"))))


def rank_metrics(ranks: DataFrame, ks: tuple[int, ...] = (1, 5, 10)) -> DataFrame:
    """Recall at each k, MRR at 10 and the median rank, cut to a whole number; one row."""
    r = F.col("rank")
    recall = [F.round(F.avg(F.when(r <= k, 1.0).otherwise(0.0)), 6).alias(f"recall_{k}") for k in ks]
    mrr = F.round(F.avg(F.when(r <= 10, 1.0 / r).otherwise(0.0)), 6).alias("mrr_10")
    return ranks.agg(F.count("*").alias("n"), *recall, mrr, F.floor(F.percentile("rank", 0.5)).cast("bigint").alias("median_rank"))


def relevant(title: Column, text: Column, keywords: Column) -> Column:
    hay = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(text, F.lit(""))))
    return F.exists(keywords, lambda k: F.contains(hay, F.lower(k)))


def keyword_recall(hits: DataFrame, queries: DataFrame, ks: tuple[int, ...] = (1, 3, 5)) -> DataFrame:
    """Hit rates and MRR over queries with keywords; ``hits``: q, rank, relevant; ``queries``: q."""
    first = hits.where("relevant").groupBy("q").agg(F.min("rank").alias("first"))
    every = queries.select("q").join(first, "q", "left")
    recall = [F.round(F.avg(F.when(F.col("first") <= k, 1.0).otherwise(0.0)), 6).alias(f"recall_{k}") for k in ks]
    return every.agg(F.count("*").alias("n"), *recall, F.round(F.avg(F.coalesce(1.0 / F.col("first"), F.lit(0.0))), 6).alias("mrr"))
