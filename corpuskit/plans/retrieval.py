"""Queries over documents, benchmark texts and embeddings, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuskit.functions import text as T
from corpuskit.operators import mining as M
from corpuskit.operators import retrieval as R
from corpuskit.operators.index import bm25_top, fused_top, kept_index
from corpuskit.operators.models import judge_score
from corpuskit.plans.corpus import SQL_SPLIT, sql_tokens, sql_words
from corpuskit.sources.tables import table


def titled(spark, sf_dir):
    """Documents with a title (the first line) and a split."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", "text", F.substring(F.substring_index(F.coalesce("text", F.lit("")), "\n", 1), 1, 60).alias("title"), T.split_sha1(F.col("doc_id").cast("string")).alias("split"))


def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))


def asked(spark, sf_dir):
    return vectors(spark, sf_dir).where("id % 50 = 0")


def bm25_stats(spark, sf_dir):
    tokens = R.document_tokens(table(spark, sf_dir, "documents"))
    stats = R.corpus_statistics(tokens.select(F.size("tokens").alias("n")))
    terms = R.index_tables(table(spark, sf_dir, "documents"))["terms"]
    return stats.join(F.broadcast(terms.agg(F.count("*").alias("n_terms"), F.sum("df").alias("n_postings")))).select("n_docs", F.round("avg_len", 6).alias("avg_len"), "n_terms", "n_postings")


def term_document_freq(spark, sf_dir):
    return R.index_tables(table(spark, sf_dir, "documents"))["terms"]


def index(spark, sf_dir):
    """The index of the documents; queries that need it share it."""
    return kept_index(titled(spark, sf_dir), "documents")


def bm25_topk(spark, sf_dir):
    best = bm25_top(index(spark, sf_dir), table(spark, sf_dir, "benchmark"), 3)
    return best.select(F.col("q").alias("item_id"), "doc_id", "score", "rank")


def bm25_split(spark, sf_dir):
    best = bm25_top(index(spark, sf_dir), table(spark, sf_dir, "benchmark"), 3, split="test")
    return best.select(F.col("q").alias("item_id"), "doc_id", "score", "rank")


def dense_topk(spark, sf_dir):
    return R.dense_top(asked(spark, sf_dir), vectors(spark, sf_dir), 5).select("q", "doc_id", F.round("score", 6).alias("score"), "rank")


def with_vectors(spark, sf_dir):
    """Questions with a stand-in for their encoding: the vector whose id is the question's."""
    return table(spark, sf_dir, "benchmark").join(vectors(spark, sf_dir).withColumnRenamed("id", "item_id"), "item_id", "left")


def document_vectors(spark, sf_dir):
    return vectors(spark, sf_dir).withColumnRenamed("id", "doc_id")


def rrf_fusion(spark, sf_dir):
    best = fused_top(index(spark, sf_dir), with_vectors(spark, sf_dir), document_vectors(spark, sf_dir), 5, boost=False)
    return best.select("q", "doc_id", "bm_rank", "dense_rank", "score", "rank")


def hybrid_retrieve(spark, sf_dir):
    best = R.hybrid(index(spark, sf_dir), with_vectors(spark, sf_dir), document_vectors(spark, sf_dir))
    hits = R.with_documents(best, titled(spark, sf_dir), "title")
    return hits.select("q", "doc_id", F.sha1("title").alias("title_sha1"), "score", "shown", "rank")


def hybrid_split(spark, sf_dir):
    best = R.hybrid(index(spark, sf_dir), with_vectors(spark, sf_dir), document_vectors(spark, sf_dir), split="train")
    return best.select("q", "doc_id", "score", "shown", "rank")


def ranked_with_positives(spark, sf_dir):
    ranked = R.dense_top(asked(spark, sf_dir), vectors(spark, sf_dir), 24, positive=False)
    positives = ranked.where(F.col("rank") - 1 == (F.col("q") / 50).cast("bigint") % 4 * 6 + 2).select("q", F.col("doc_id").alias("positive_id"))
    return ranked, positives


def hard_negatives(spark, sf_dir):
    return M.hard_negatives(*ranked_with_positives(spark, sf_dir), negs_per_pair=30)


def anchor_split(spark, sf_dir):
    triplets = M.hard_negatives(*ranked_with_positives(spark, sf_dir), negs_per_pair=2)
    return M.split_by_anchor(triplets).select("q", "positive_id", "negative_id", "part")


def qrel_pairs(spark, sf_dir):
    return M.qrels(M.hard_negatives(*ranked_with_positives(spark, sf_dir), negs_per_pair=2))


def triplets(spark, sf_dir):
    """Texts and counts of triplets; a document's text stands twice in the corpus, and the last one counts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    corpus = docs.withColumn("place", F.lit(1)).union(docs.where("doc_id % 3 = 0").select("doc_id", F.concat(F.lit("again "), "text"), F.lit(2)))
    mined = M.hard_negatives(*ranked_with_positives(spark, sf_dir), negs_per_pair=2)
    return M.triplet_texts(mined, docs.select(F.col("doc_id").alias("q"), "text"), corpus)


def triplet_texts(spark, sf_dir):
    return triplets(spark, sf_dir).select("q", "positive_id", "negative_id", *(F.sha1(c).alias(f"{c}_sha1") for c in ("anchor", "positive", "negative")))


def triplet_counts(spark, sf_dir):
    return M.triplet_counts(M.split_by_anchor(M.hard_negatives(*ranked_with_positives(spark, sf_dir), negs_per_pair=2)))


def judge_mean(spark, sf_dir):
    """The mean of judges' scores where there is one."""
    score = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit('```json\n{"score": '), (F.col("turn") % 5 + 1).cast("string"), F.lit("}\n```"))).otherwise("no idea")
    return M.mean_scores(answered(spark, sf_dir).select(judge_score(score).alias("judge"), F.round(T.token_f1(F.col("text"), F.col("question")), 4).alias("f1")), "judge", "f1")


def train_val_split(spark, sf_dir):
    convs = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    return M.split_validation(convs, "conv_id")


def eval_rank_metrics(spark, sf_dir):
    queries = asked(spark, sf_dir).withColumn("gold", F.col("id") + 1)
    return M.rank_metrics(R.gold_ranks(queries, vectors(spark, sf_dir)))


def eval_keyword_recall(spark, sf_dir):
    docs, queries = titled(spark, sf_dir), table(spark, sf_dir, "benchmark")
    words = queries.select(F.col("item_id").alias("q"), F.slice(F.filter(T.tokens(F.col("text")), lambda t: F.length(t) >= 6), 1, 3).alias("keywords")).where(F.size("keywords") > 0)
    hits = R.with_documents(bm25_top(index(spark, sf_dir), queries, 5), docs, "title", "text").join(words, "q").select("q", "rank", M.relevant(F.col("title"), F.col("text"), F.col("keywords")).alias("relevant"))
    return M.keyword_recall(hits, words)


def answered(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    w = W.partitionBy("conv_id").orderBy("turn")
    return turns.withColumns({"question": F.lag("text").over(w), "asker": F.lag("role").over(w)}).where("role = 'assistant' and asker = 'user'")


def token_f1(spark, sf_dir):
    return answered(spark, sf_dir).select("conv_id", "turn", F.round(T.token_f1(F.col("text"), F.col("question")), 4).alias("f1"))


def token_f1_mean(spark, sf_dir):
    return token_f1(spark, sf_dir).agg(F.count("*").alias("n"), F.round(F.avg("f1"), 3).alias("mean_f1"))


QUERIES = {f.__name__: f for f in (bm25_stats, term_document_freq, bm25_topk, bm25_split, dense_topk, rrf_fusion, hybrid_retrieve, hybrid_split, hard_negatives, anchor_split, qrel_pairs, train_val_split, eval_rank_metrics, eval_keyword_recall, token_f1, token_f1_mean, triplet_texts, triplet_counts, judge_mean)}

BM25 = f"""
    dt as (select doc_id, text, {sql_tokens('text')} as tokens, {SQL_SPLIT} as split, substr(split_part(coalesce(text, ''), chr(10), 1), 1, 60)
        as title from documents),
    stats as (select count(*) as n_docs, coalesce(avg(len(tokens)), 1.0) as avg_len from dt),
    qt as (select item_id as q, unnest({sql_tokens('text')}) as term from benchmark),
    tf as (select doc_id, term, count(*) as tf from (select doc_id, unnest(tokens) as term from dt) where term in (select term from qt)
        group by doc_id, term),
    freq as (select term, count(*) as df from tf group by term),
    bm as (select q, doc_id, split, round(sum(ln((n_docs - df + 0.5::double) / (df + 0.5::double) + 1) * tf * 2.5::double / (tf + 1.5::double *
        (0.25::double + 0.75::double * len(tokens) / avg_len))), 6) as score
           from qt join tf using (term) join freq using (term) join dt using (doc_id) cross join stats group by q, doc_id, split having score > 0)"""
DENSE = """
    vec as (select vec_id as id, embedding::double[] as v from embeddings),
    sims as (select q.id as q, d.id as doc_id, round(list_cosine_similarity(q.v, d.v), 9) as score from vec q cross join vec d {where}),
    ranked as (select q, doc_id, score, row_number() over (partition by q order by score desc, doc_id)::int as rank from sims)"""
FUSED = BM25 + "," + DENSE.format(where="where q.id in (select item_id from benchmark) and d.id in (select doc_id from documents) {more}") + """,
    b as (select q, doc_id, score as bm, row_number() over (partition by q order by score desc, doc_id) as bm_rank from bm {split}),
    d as (select q, doc_id, score as sim, row_number() over (partition by q order by score desc, doc_id) as dense_rank from sims where score > 0),
    fused as (select coalesce(b.q, d.q) as q, coalesce(b.doc_id, d.doc_id) as doc_id, bm, sim, bm_rank, dense_rank,
                     1::double / (60 + coalesce(bm_rank, n_docs)) + 1::double / (60 + coalesce(dense_rank, n_docs)) as rrf
              from b full join d on b.q = d.q and b.doc_id = d.doc_id cross join stats)"""


def _distinct_words(c: str) -> str:
    return rf"list_distinct(regexp_extract_all(lower({c}), '[^\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+'))"


HYBRID = """with {fused},
    scored as (select f.*, title, round(rrf + 0.02::double * len(list_intersect({a}, {b})), 9) as score from fused f join dt using (doc_id)
        join benchmark k on k.item_id = f.q)
    select q, doc_id, {more}score, round(coalesce(sim, bm, rrf), 4) as shown, (row_number() over (partition by q
        order by score desc, doc_id))::int as rank
    from scored qualify rank <= 3"""
POSITIVES = "with " + DENSE.format(where="where q.id % 50 = 0") + """,
    pos as (select q, doc_id as positive_id, rank - 1 as at from ranked where rank - 1 = q // 50 % 4 * 6 + 2),
    usable as (select r.q, p.positive_id, r.doc_id as negative_id, r.rank - 1 as place from ranked r join pos p using (q)
               where r.rank - 1 >= 2 and r.rank - 1 <= case when p.at = 20 then 21 else 20 end and r.doc_id <> p.positive_id),
    mined as (select *, row_number() over (partition by q order by place) as n from usable)"""
PAIRS = """turns as (select *, lag(text) over w as question, lag(role) over w as asker from conversations window w as (partition by conv_id order by turn)),
    sets as (select conv_id, turn, list_distinct(list_filter({p}, lambda x: x not in ({stop})))
        as p, list_distinct(list_filter({r}, lambda x: x not in ({stop}))) as r
             from turns where role = 'assistant' and asker = 'user'),
    f as (select conv_id, turn, len(list_intersect(p, r)) as c, len(p) as np, len(r) as nr from sets),
    scored as (select conv_id, turn, round(case when c > 0 then 2 * (c / np::double) * (c / nr::double) / ((c / np::double) + (c / nr::double)) else 0 end, 4) as f1 from f)""".format(p=sql_tokens("text"), r=sql_tokens("question"), stop=", ".join(f"'{w}'" for w in T.STOP_WORDS))

ORACLES = {
    "bm25_stats": (
        f"with dt as (select doc_id, {sql_tokens('text')} as tokens from documents), terms as (select term, count(distinct doc_id) "
        f"as df from (select doc_id, unnest(tokens) as term from dt) group by term) select (select count(*) from dt) "
        f"as n_docs, (select round(avg(len(tokens)), 6) from dt) as avg_len, count(*) as n_terms, sum(df)::bigint as n_postings "
        f"from terms"
    ),
    "term_document_freq": (
        f"with dt as (select doc_id, {sql_tokens('text')} as tokens from documents) select term, count(distinct doc_id) as df "
        f"from (select doc_id, unnest(tokens) as term from dt) group by term"
    ),
    "bm25_topk": (
        f"with {BM25} select q as item_id, doc_id, score, (row_number() over (partition by q order by score desc, doc_id))::int as rank "
        f"from bm qualify rank <= 3"
    ),
    "bm25_split": (
        f"with {BM25} select q as item_id, doc_id, score, (row_number() over (partition by q order by score desc, doc_id))::int as rank "
        f"from bm where split = 'test' qualify rank <= 3"
    ),
    "dense_topk": "with " + DENSE.format(where="where q.id % 50 = 0") + " select q, doc_id, round(score, 6) as score, rank from ranked where rank <= 5 and score > 0",
    "rrf_fusion": "with " + FUSED.replace("{split}", "").replace("{more}", "") + " select q, doc_id, bm_rank, dense_rank, round(rrf, 9) as score, (row_number() over (partition by q order by round(rrf, 9) desc, doc_id))::int as rank from fused qualify rank <= 5",
    "hybrid_retrieve": HYBRID.format(more="sha1(title) as title_sha1, ", fused=FUSED.replace("{split}", "").replace("{more}", ""), a=_distinct_words("k.text"), b=_distinct_words("dt.title")),
    "hybrid_split": HYBRID.format(more="", fused=FUSED.replace("{split}", "where split = 'train'").replace("{more}", "and d.id in (select doc_id from dt where split = 'train')"), a=_distinct_words("k.text"), b=_distinct_words("dt.title")),
    "hard_negatives": POSITIVES + " select q, positive_id, negative_id, place::int as place from mined where n <= 30",
    "anchor_split": POSITIVES + """, anchors as (select q, row_number() over (order by sha1('13' || q), q) as n, count(*) over () as total from (select distinct q from mined))
        select q, positive_id, negative_id, case when a.n <= greatest(1, floor(total * 0.2::double)) then 'eval' else 'train' end as part from mined m join anchors a using (q) where m.n <= 2""",
    "qrel_pairs": POSITIVES + " select distinct q, positive_id from mined where n <= 2",
    "train_val_split": (
        "select conv_id, case when row_number() over (order by sha1('13' || conv_id), conv_id) <= greatest(8, floor(count(*) over () * "
        "0.05::double)) then 'val' else 'train' end as part from (select distinct conv_id from conversations)"
    ),
    "eval_rank_metrics": "with " + DENSE.format(where="where q.id % 50 = 0") + """, g as (select rank from ranked where doc_id = q + 1)
        select count(*) as n, round(avg((rank <= 1)::int), 6) as recall_1, round(avg((rank <= 5)::int), 6)
            as recall_5, round(avg((rank <= 10)::int), 6) as recall_10,
               round(avg(case when rank <= 10 then 1 / rank::double else 0 end), 6) as mrr_10, floor(quantile_cont(rank, 0.5))::bigint as median_rank from g""",
    "eval_keyword_recall": f"""with {BM25},
        kw as (select item_id as q, list_filter({sql_tokens('text')}, lambda x: length(x) >= 6)[1:3] as keywords from benchmark),
        top as (select q, doc_id, row_number() over (partition by q order by score desc, doc_id) as rank from bm qualify rank <= 5),
        firsts as (select k.q, min(rank) filter (len(list_filter(k.keywords, lambda x: contains(lower(title || ' '
            || coalesce(text, '')), lower(x)))) > 0) as first
                   from kw k left join (select top.*, title, text from top join dt using (doc_id)) t on k.q = t.q where len(k.keywords) > 0 group by k.q)
        select count(*) as n, round(avg(case when first <= 1 then 1 else 0 end), 6) as recall_1, round(avg(case when first <= 3 then 1 else 0 end),
            6) as recall_3,
               round(avg(case when first <= 5 then 1 else 0 end), 6) as recall_5, round(avg(coalesce(1 / first::double, 0)), 6) as mrr from firsts""",
    "token_f1": f"with {PAIRS} select conv_id, turn, f1 from scored",
    "token_f1_mean": f"with {PAIRS} select count(*) as n, round(avg(f1), 3) as mean_f1 from scored",
    "triplet_texts": POSITIVES + """, c as (select doc_id, case when doc_id % 3 = 0 then 'again ' else '' end || coalesce(text, '') as text from documents)
        select q, positive_id, negative_id, sha1(coalesce(a.text, '')) as anchor_sha1, sha1(p.text) as positive_sha1, sha1(n.text) as negative_sha1
        from mined m join documents a on a.doc_id = m.q join c p on p.doc_id = m.positive_id join c n on n.doc_id = m.negative_id where m.n <= 2""",
    "triplet_counts": POSITIVES + """, anchors as (select q, row_number() over (order by sha1('13' || q), q) as n, count(*) over () as total from (select distinct q from mined))
        select case when a.n <= greatest(1, floor(total * 0.2::double)) then 'eval' else 'train' end as part, count(*)
            as triplets, count(distinct q) as anchors
        from mined m join anchors a using (q) where m.n <= 2 group by 1""",
    "judge_mean": (
        f"with {PAIRS} select count(*) filter (conv_id % 3 = 0) as n_judge, round(avg(case when conv_id % 3 = 0 then turn % 5 + 1 end), "
        f"3) as mean_judge, count(f1) as n_f1, round(avg(f1), 3) as mean_f1 from scored"
    ),
}
