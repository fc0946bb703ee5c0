"""BM25, dense similarity in blocks, rank fusion with a title boost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuskit.functions import text as T
from corpuskit.operators.dense import counted_ahead, search, usable
from corpuskit.operators.index import Index, fused_top
from corpuskit.operators.ranking import rank_within


def document_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *keep: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), *keep, T.tokens(F.col(text_col)).alias("tokens"))


def index_tables(docs: DataFrame) -> dict[str, DataFrame]:
    """Postings, terms, document lengths and the one row of corpus statistics, to be written as tables."""
    tokens = document_tokens(docs)
    lengths = tokens.select("doc_id", F.size("tokens").alias("n"))
    postings = tokens.select("doc_id", F.explode("tokens").alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("tf"))
    return {"postings": postings, "terms": postings.groupBy("term").agg(F.count("*").alias("df")), "lengths": lengths, "corpus": corpus_statistics(lengths)}


def corpus_statistics(lengths: DataFrame) -> DataFrame:
    return lengths.agg(F.count("*").alias("n_docs"), F.coalesce(F.avg("n"), F.lit(1.0)).alias("avg_len"))


def bm25(docs: DataFrame, queries: DataFrame, k1: float = 1.5, b: float = 0.75, split: str | None = None, q_id: str = "item_id", q_text: str = "text", digits: int = 6) -> DataFrame:
    """Scores above 0 of (query, document); ``docs`` may have a column ``split``.

    Only postings of terms that occur in a query are ever grouped. A term that a
    query repeats counts each time. The split is a filter on what is scored:
    numbers and lengths of documents are always those of the whole corpus.
    """
    keep = ["split"] if split else []
    tokens = document_tokens(docs, "doc_id", "text", *keep)
    stats = corpus_statistics(tokens.select(F.size("tokens").alias("n")))
    asked = queries.select(F.col(q_id).alias("q"), F.explode(T.tokens(F.col(q_text))).alias("term")).groupBy("q", "term").agg(F.count("*").alias("times"))
    listed = tokens.select("doc_id", *keep, F.size("tokens").alias("n"), F.explode("tokens").alias("term")).join(asked.select("term").distinct(), "term", "left_semi")
    postings = listed.groupBy("term", "doc_id", "n", *keep).agg(F.count("*").alias("tf"))
    df = postings.groupBy("term").agg(F.count("*").alias("df"))
    scored = postings.where(F.col("split") == split) if split else postings
    scored = scored.join(df, "term").join(F.broadcast(stats)).join(asked, "term")
    idf = F.log((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    part = F.col("times") * idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("n") / F.col("avg_len")))
    return scored.groupBy("q", "doc_id").agg(F.round(F.sum(part), digits).alias("score")).where("score > 0")


def top_k(scores: DataFrame, k: int, group: str = "q", tie: str = "doc_id") -> DataFrame:
    """The best ``k`` of each group; each task first keeps its own best."""
    rank = F.row_number().over(W.partitionBy(group).orderBy(F.col("score").desc(), F.col(tie)))
    return scores.withColumn("rank", rank).where(F.col("rank") <= k)


def dense_top(queries: DataFrame, vectors: DataFrame, k: int | None, positive: bool = True, digits: int = 9) -> DataFrame:
    """The ``k`` most similar vectors of each query, by cosine, as (q, doc_id, score, rank).

    Without ``k``, all of them, and no rank.

    Both sides are (id, v), ids whole numbers; see ``dense.search``. Vectors that are null
    or zero, or hold null or non-finite numbers, are similar to nothing, and so
    are vectors of different dimensions.
    """
    met = search(queries, vectors, k, positive, digits)
    return top_k(met, k) if k else met


def gold_ranks(queries: DataFrame, vectors: DataFrame, digits: int = 9) -> DataFrame:
    """Rank of each query's gold vector: queries are (id, v, gold). Counted block by block, see ``dense.counted_ahead``; nothing is sorted."""
    golden = queries.where(usable(F.col("v"))).join(vectors.where(usable(F.col("v"))).select(F.col("id").alias("gold"), F.col("v").alias("g")), "gold")
    golden = golden.where(F.size("v") == F.size("g"))
    dot = F.aggregate(F.zip_with("v", "g", lambda x, y: x.cast("double") * y), F.lit(0.0), lambda a, x: a + x)
    norm = [F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double") * x)) for c in ("v", "g")]
    golden = golden.select("id", "v", "gold", F.round(dot / norm[0] / norm[1], digits).alias("gold_sim"))
    return counted_ahead(golden, vectors, digits).groupBy("q").agg((F.sum("ahead") + 1).alias("rank"))


def fuse(bm: DataFrame, dense: DataFrame, n_docs: DataFrame, rrf_k: int = 60) -> DataFrame:
    """Reciprocal ranks of two whole lists of scores; a document missing from one has the number of documents as its rank there.

    For lists that are at hand. The best of documents and queries come from
    ``index.fused_top``, which never makes such lists.
    """
    a = rank_within(bm, "q", "score", "doc_id", 0.25).select("q", "doc_id", F.col("rank").alias("bm_rank"), F.col("score").alias("bm"))
    b = rank_within(dense, "q", "score", "doc_id", 0.01).select("q", "doc_id", F.col("rank").alias("dense_rank"), F.col("score").alias("sim"))
    both = a.join(b, ["q", "doc_id"], "full").join(F.broadcast(n_docs.select("n_docs")))
    ranks = [F.coalesce(c, F.col("n_docs")) for c in (F.col("bm_rank"), F.col("dense_rank"))]
    return both.withColumn("rrf", 1 / (rrf_k + ranks[0]) + 1 / (rrf_k + ranks[1])).drop("n_docs")


def title_boost(query: Column, title: Column, each: float = 0.02) -> Column:
    """For each distinct word of the query that the title has too; punctuation belongs to words."""
    return F.lit(each) * F.size(F.array_intersect(F.array_distinct(T.words(F.lower(query))), F.array_distinct(T.words(F.lower(title)))))


def hybrid(index: Index, queries: DataFrame, vectors: DataFrame, k: int = 3, split: str | None = None) -> DataFrame:
    """The ``k`` best documents of each query by fused rank and title boost, with the score that is shown.

    ``queries``: item_id, text, v; ``vectors``: doc_id, v; see ``index.fused_top``.
    The score shown is the cosine, else BM25, to 4 places.
    """
    best = fused_top(index, queries, vectors, k, split)
    return best.withColumn("shown", F.round(F.coalesce("sim", "bm"), 4))


def with_documents(hits: DataFrame, docs: DataFrame, *columns: str) -> DataFrame:
    """Hits with columns of their documents: by default title, text, origin and split, those there are."""
    named = columns or [c for c in ("title", "text", "origin", "split") if c in docs.columns]
    return hits.join(docs.select("doc_id", *named), "doc_id")
