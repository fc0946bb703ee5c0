"""Queries over conversations, documents and benchmark texts: pairs, prompts, chat."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuskit.functions import text as T
from corpuskit.operators import chat as C
from corpuskit.operators import qa as Q
from corpuskit.operators import retrieval as R
from corpuskit.operators.index import bm25_top
from corpuskit.plans.corpus import LINE_END, sql_strip, sql_words
from corpuskit.plans.retrieval import BM25, answered, index, titled
from corpuskit.sources.tables import table

SYSTEM = "You answer questions about the corpus."
STAMP = "2026-01-01T00:00:00+00:00"


def turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations")


def pairs(spark, sf_dir):
    """User and assistant turns side by side; questions of even conversations end with a question mark."""
    ask = F.when(F.col("conv_id") % 2 == 0, F.concat(T.strip(F.col("question")), F.lit("?"))).otherwise(F.col("question"))
    return answered(spark, sf_dir).select("conv_id", "turn", ask.alias("question"), F.when(F.col("conv_id") % 9 == 0, F.concat(F.col("text"), F.lit(" As stated above."))).otherwise(F.col("text")).alias("answer"))


def qa_quality(spark, sf_dir):
    return pairs(spark, sf_dir).select("conv_id", "turn", *(c.alias(n) for n, c in Q.quality(F.col("question"), F.col("answer")).items()))


def qa_dedup(spark, sf_dir):
    kept = pairs(spark, sf_dir).where(Q.quality(F.col("question"), F.col("answer"))["ok"])
    hashed = kept.select(F.sha2(F.lower("question"), 256).alias("question_hash"), F.struct("conv_id", "turn").alias("at"))
    return hashed.groupBy("question_hash").agg(F.min("at").alias("at")).select("question_hash", "at.conv_id", "at.turn")


def ngram_decontam(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return Q.decontaminate(docs, table(spark, sf_dir, "benchmark"), "doc_id", "text").select("doc_id")


def contaminated(spark, sf_dir):
    return Q.contaminated_ids(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id", "text")


def resume_antijoin(spark, sf_dir):
    return Q.pending(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


def sft_messages(spark, sf_dir):
    rows = pairs(spark, sf_dir)
    return rows.select("conv_id", "turn", F.to_json(Q.messages(SYSTEM, F.col("question"), F.col("answer"))).alias("messages"), Q.pairs_wanted(T.n_words(F.col("answer"))).alias("wanted"), F.sha1(Q.qa_prompt("R", F.col("question"), F.col("answer"), T.n_words(F.col("answer")))).alias("prompt_sha1"))


def llm_line_parse(spark, sf_dir):
    reply = F.concat(F.lit("Queries:\n- 1. "), F.regexp_replace("text", r"\. ", ".\n* \""))
    return turns(spark, sf_dir).where("role = 'assistant'").select("conv_id", "turn", F.posexplode(Q.parse_lines(reply, 3)).alias("pos", "query"))


def ranked_chunks(spark, sf_dir):
    """The three best documents of each benchmark text, as an array of (title, text, doc_id, score) by rank."""
    docs, queries = titled(spark, sf_dir), table(spark, sf_dir, "benchmark")
    best = R.with_documents(bm25_top(index(spark, sf_dir), queries, 3), docs, "title", "text")
    grouped = best.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("rank", "title", "text", "doc_id", "score"))).alias("chunks"))
    return queries.select(F.col("item_id"), F.col("text").alias("question")).join(grouped, F.col("item_id") == F.col("q"), "left").withColumn("chunks", F.coalesce("chunks", F.array().cast("array<struct<rank:int,title:string,text:string,doc_id:bigint,score:double>>")))


def rag_prompt(spark, sf_dir):
    rows = ranked_chunks(spark, sf_dir)
    return rows.select("item_id", F.sha1(Q.context_prompt(F.col("chunks"), F.col("question"))).alias("shared_sha1"), F.sha1(Q.context_prompt(F.col("chunks"), F.col("question"), share=False)).alias("cut_sha1"), Q.context_prompt(F.array().cast("array<struct<title:string,text:string>>"), F.col("question")).alias("bare"))


def chat_history_window(spark, sf_dir):
    return C.recent_history(turns(spark, sf_dir)).select("conv_id", "turn", "role", "text")


def feedback_question_lookup(spark, sf_dir):
    rated = F.when(F.col("turn") % 3 == 0, "down").otherwise("up")
    return C.with_question(turns(spark, sf_dir)).select("conv_id", "turn", F.lit(STAMP).alias("stamp"), "question", F.col("text").alias("answer"), rated.alias("rating"), F.lit(0).alias("num_sources"))


def demo_cache_lookup(spark, sf_dir):
    firsts = turns(spark, sf_dir).where("role = 'user'").groupBy(C.cache_key(F.col("text")).alias("key")).agg(F.min(F.struct("conv_id", "turn")).alias("at"), F.count("*").alias("n")).where("n > 1")
    cache = firsts.select("key", F.concat_ws(":", F.col("at.conv_id").cast("string"), F.col("at.turn").cast("string")).alias("answer"))
    asked = turns(spark, sf_dir).where("role = 'user'").withColumn("text", F.concat(F.lit("  "), T.capitals(F.col("text"))))
    return C.cached_answers(asked, cache).select("conv_id", "turn", "answer")


def session_titles(spark, sf_dir):
    first = turns(spark, sf_dir).where("role = 'user'").groupBy("conv_id").agg(F.min_by("text", "turn").alias("question"))
    return first.select("conv_id", C.session_title(F.col("question")).alias("title"))


def followups(spark, sf_dir):
    rows = ranked_chunks(spark, sf_dir)
    titles = F.flatten(F.transform("chunks", lambda c: F.array(c["title"], c["title"])))
    asked = F.array(F.lower(F.concat(F.lit('tell me more about "'), F.substring(T.strip(F.get(titles, F.lit(2))), 1, 60), F.lit('"'))))
    return rows.select("item_id", F.explode(C.followups(titles, asked)).alias("suggestion"))


def retrieval_confidence(spark, sf_dir):
    return ranked_chunks(spark, sf_dir).select("item_id", C.confidence(F.transform("chunks", lambda c: c["score"])).alias("confidence"))


def chat_export_md(spark, sf_dir):
    return C.export(turns(spark, sf_dir), "md", "Chat Export", STAMP, "ok")


def chat_export_txt(spark, sf_dir):
    return C.export(turns(spark, sf_dir), "txt", "Chat Export", STAMP, "ok")


def chat_export_json(spark, sf_dir):
    return C.export(turns(spark, sf_dir), "json", "Chat Export", STAMP, "ok")


def comparison_report(spark, sf_dir):
    sources = F.transform("chunks", lambda c: F.struct(c["title"].alias("title"), c["doc_id"].cast("string").alias("origin"), c["rank"].alias("score")))
    made = {k: C.comparison(F.col("question"), F.lit("direct"), F.lit("grounded"), sources, k, stamp=STAMP) for k in ("md", "txt", "json", "odd")}
    return ranked_chunks(spark, sf_dir).select("item_id", *(c.alias(k) for k, c in made.items()))


def query_prompts(spark, sf_dir):
    """The prompt that asks for queries about each document, and the messages of a question with what was said before."""
    docs = table(spark, sf_dir, "documents")
    prompt = Q.query_prompt("Write {n} queries.\nDocument: {doc}\nQueries:", F.col("text"), 2)
    return docs.select("doc_id", F.sha1(prompt).alias("prompt_sha1"))


def messages_with_history(spark, sf_dir):
    every = turns(spark, sf_dir)
    last = every.groupBy("conv_id").agg(F.max_by("text", "turn").alias("question"))
    before = C.recent_history(every).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("h"))
    history = F.transform(F.coalesce("h", F.array().cast("array<struct<turn:bigint,role:string,content:string>>")), lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    rows = last.join(before, "conv_id", "left")
    return rows.select("conv_id", F.sha1(F.to_json(Q.chat_messages(SYSTEM, history, F.col("question")))).alias("messages_sha1"))


QUERIES = {f.__name__: f for f in (qa_quality, qa_dedup, ngram_decontam, contaminated, resume_antijoin, sft_messages, llm_line_parse, rag_prompt, chat_history_window, feedback_question_lookup, demo_cache_lookup, session_titles, followups, retrieval_confidence, chat_export_md, chat_export_txt, chat_export_json, comparison_report, query_prompts, messages_with_history)}

PAIRS = f"""t as (select *, lag(text) over w as q, lag(role) over w as asker from conversations window w as (partition by conv_id order by turn)),
    pairs as (select conv_id, turn, case when conv_id % 2 = 0 then {sql_strip('q')} || '?' else q end as question,
        case when conv_id % 9 = 0 then text || ' As stated above.' else text end as answer
              from t where role = 'assistant' and asker = 'user'),
    rules as (select *, coalesce(question, '') <> '' and coalesce(answer, '') <> '' as filled, {sql_words("coalesce(question, '')")} >= 5
        and {sql_words("coalesce(answer, '')")} >= 3 as long_enough,
                     not regexp_matches(coalesce(question, ''), '{Q.META}') and not regexp_matches(coalesce(answer, ''), '{Q.META}') as no_meta, ends_with({sql_strip("coalesce(question, '')")}, '?') as asks from pairs)"""
GRAMS = """toks as (select id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') as t from (select doc_id as id, text from documents)),
    gold as (select distinct array_to_string(t[i:i + 7], ' ') as gram from (select t, unnest(range(1, len(t) - 6)) as i
        from (select regexp_extract_all(lower(text), '[a-z0-9]+') as t from benchmark))),
    hit as (select distinct id from (select id, array_to_string(t[i:i + 7], ' ') as gram from (select id, t, unnest(range(1, len(t) - 6)) as i from toks)) where gram in (select gram from gold))"""
TOP = f"""{BM25},
    top as (select q, doc_id, score, row_number() over (partition by q order by score desc, doc_id)::int as rank from bm qualify rank <= 3),
    chunks as (select item_id, b.text as question, coalesce(list({{'rank': rank, 'title': dt.title, 'text': dt.text, 'doc_id': dt.doc_id,
        'score': score}} order by rank) filter (rank is not null), []) as c
               from benchmark b left join top on top.q = b.item_id left join dt using (doc_id) group by item_id, b.text)"""
WANTED = f"case when {sql_words('answer')} < 200 then 2 when {sql_words('answer')} < 350 then 3 else 4 end"


def _context(text: str) -> str:
    return f"array_to_string(list_transform(c, lambda x: '--- Document [' || x.rank || ']: ' || x.title || ' ---' || chr(10) || 'Content:' || chr(10) || {text} || chr(10) || chr(10)), '')"


def _prompt(context: str) -> str:
    return f"case when len(c) > 0 then 'Context:' || chr(10) || {context} || chr(10) || chr(10) || 'Question: ' || question || chr(10) || chr(10) || 'Answer:' else question end"


ORACLES = {
    "qa_quality": (
        f"with {PAIRS} select conv_id, turn, filled, long_enough, no_meta, asks, filled and long_enough and no_meta and asks as ok "
        f"from rules"
    ),
    "qa_dedup": (
        f"with {PAIRS} select sha256(lower(question)) as question_hash, conv_id, turn from rules where filled and long_enough "
        f"and no_meta and asks qualify row_number() over (partition by lower(question) order by conv_id, turn) = 1"
    ),
    "ngram_decontam": f"with {GRAMS} select doc_id from documents where doc_id not in (select id from hit)",
    "contaminated": f"with {GRAMS} select id as doc_id from hit",
    "resume_antijoin": "select doc_id, source from documents where doc_id not in (select doc_id from labels)",
    "sft_messages": f"""with {PAIRS} select conv_id, turn, to_json([{{'role': 'system', 'content': '{SYSTEM}'}}, {{'role': 'user', 'content': question}}, {{'role': 'assistant', 'content': answer}}])::varchar as messages, {WANTED} as wanted,
        sha1('R' || chr(10) || chr(10) || 'Passage (from ' || substr(question, 1, 90) || '):' || chr(10) || '\"\"\"' || chr(10) || answer || chr(10) || '\"\"\"' || chr(10) || chr(10) || 'Produce exactly ' || {WANTED} || ' pairs.') as prompt_sha1 from rules""",
    "llm_line_parse": rf"""with r as (select conv_id, turn, 'Queries:' || chr(10) || '- 1. ' || regexp_replace(text, '\. ', '.' || chr(10) || '* "', 'g') as reply from conversations where role = 'assistant'),
        l as (select conv_id, turn, list_transform(regexp_split_to_array(reply, '{LINE_END}'), lambda x:
            {sql_strip("regexp_replace(" + sql_strip('x') + ", '^[-*0-9. ]+', '')")}) as x from r),
        k as (select conv_id, turn, list_transform(list_filter(x, lambda y: y <> '' and not starts_with(lower(y), 'queries')
            and not starts_with(lower(y), 'document') and {sql_words('y')} between 3 and 30), lambda y:
            {sql_strip("regexp_replace(y, '^" + chr(34) + "+|" + chr(34) + "+$', '', 'g')")})[1:3] as x from l)
        select conv_id, turn, (generate_subscripts(x, 1) - 1)::int as pos, unnest(x) as query from k""",
    "rag_prompt": (
        f"with {TOP} select item_id, sha1({_prompt(_context('substr(x.text, 1, (6000 // len(c))::int)'))}) "
        f"as shared_sha1, sha1({_prompt('substr(' + _context('x.text') + ', 1, 6000)')}) as cut_sha1, question as bare from chunks"
    ),
    "chat_history_window": (
        "select conv_id, turn, role, text from conversations qualify row_number() over (partition by conv_id "
        "order by turn desc) between 2 and 7"
    ),
    "feedback_question_lookup": (
        f"select conv_id, turn, '{STAMP}' as stamp, coalesce(case when asker = 'user' then q end, '') as question, text as answer, "
        f"case when turn % 3 = 0 then 'down' else 'up' end as rating, 0 as num_sources from (select *, lag(text) over w "
        f"as q, lag(role) over w as asker from conversations window w as (partition by conv_id order by turn)) where role = 'assistant'"
    ),
    "demo_cache_lookup": (
        f"with u as (select conv_id, turn, lower({sql_strip('text')}) as key, lower(upper({sql_strip('text')})) as asked "
        f"from conversations where role = 'user'), c as (select key, arg_min(conv_id || ':' || turn, (conv_id, turn)) as answer from u "
        f"group by key having count(*) > 1) select u.conv_id, u.turn, c.answer from u left join c on u.asked = c.key"
    ),
    "session_titles": (
        f"select conv_id, substr(t, 1, 40) || case when length(t) > 40 then '…' else '' end as title "
        f"from (select conv_id, {sql_strip('arg_min(text, turn)')} as t from conversations where role = 'user' group by conv_id)"
    ),
    "followups": f"""with {TOP},
        named as (select item_id, x.rank as rank, {sql_strip('x.title')} as title, {sql_strip('c[2].title')} as second
            from (select item_id, c, unnest(c) as x from chunks)),
        firsts as (select item_id, title, rank, second from named where title <> '' qualify row_number() over (partition by item_id, lower(title)
            order by rank) = 1),
        kept as (select item_id, 'Tell me more about "' || substr(title, 1, 60) || '"' as suggestion, rank from firsts
            where second is null or lower(substr(title, 1, 60)) <> lower(substr(second, 1, 60)))
        select item_id, suggestion from kept qualify row_number() over (partition by item_id order by rank) <= 3""",
    "retrieval_confidence": (
        f"with {TOP} select item_id, case when len(c) < 2 then null when c[1].score / list_avg(list_transform(c[2:], lambda x: "
        f"x.score)) >= 1.5 then 'focused' else 'close' end as confidence from chunks"
    ),
    "chat_export_md": (
        f"select conv_id, '# Chat Export' || chr(10) || chr(10) || '_Exported: {STAMP}_' || chr(10) || '_Model status: ok_' || chr(10) "
        f"|| chr(10) || string_agg(case when role = 'user' then '### 🧑 User' else '### 🤖 Assistant' end || chr(10) || text || chr(10) "
        f"|| chr(10) || '---' || chr(10), chr(10) order by turn) as document from conversations group by conv_id"
    ),
    "chat_export_txt": (
        f"select conv_id, 'CHAT EXPORT' || chr(10) || 'Exported: {STAMP}' || chr(10) || 'Model status: ok' || chr(10) "
        f"|| repeat('=', 60) || chr(10) || chr(10) || string_agg(case when role = 'user' then '[USER]' else '[ASSISTANT]' end "
        f"|| chr(10) || text || chr(10) || chr(10) || repeat('-', 60) || chr(10), chr(10) order by turn) as document from conversations "
        f"group by conv_id"
    ),
    "chat_export_json": (
        f"select conv_id, to_json({{'exported_at': '{STAMP}', 'model_status': 'ok', 'messages': list({{'role': role, 'content': text}} "
        f"order by turn)}})::varchar as document from conversations group by conv_id"
    ),
    "comparison_report": f"""with {TOP} select item_id,
        '# Comparison Report' || chr(10) || '**Question Analyzed:** "' || question || '"' || chr(10) || chr(10) || '---' || chr(10) || chr(10)
            || '### Direct Response' || chr(10) || chr(10) || 'direct'
        || chr(10) || chr(10) || '---' || chr(10) || chr(10) || '### Grounded Response' || chr(10) || chr(10) || 'grounded' || chr(10) || chr(10)
            || '---' || chr(10) || chr(10) || '### References' || chr(10)
        || case when len(c) > 0 then array_to_string(list_transform(c, lambda x: x.rank || '. [' || x.title || '](' || x.doc_id || ') - Score: '
            || x.rank || chr(10)), '') else 'No reference found.' end as md,
        'COMPARISON REPORT' || chr(10) || 'Question: ' || question || chr(10) || repeat('=', 60) || chr(10) || chr(10) || '[DIRECT RESPONSE]'
            || chr(10) || 'direct' || chr(10) || chr(10)
        || '[GROUNDED RESPONSE]' || chr(10) || 'grounded' || chr(10) || chr(10) || '[REFERENCES]' || chr(10)
        || case when len(c) > 0 then array_to_string(list_transform(c, lambda x: '  ' || x.rank || '. ' || x.title || ' - ' || x.doc_id
            || ' (score: ' || x.rank || ')' || chr(10)), '') else '  No reference found.' || chr(10) end as txt,
        to_json({{'question': question, 'direct_answer': 'direct', 'rag_answer': 'grounded', 'sources': list_transform(c, lambda x: {{'title':
            x.title, 'origin': x.doc_id::varchar, 'score': x.rank}}), 'exported_at': '{STAMP}'}})::varchar as json,
        '' as odd from chunks""",
    "query_prompts": (
        "select doc_id, sha1('Write 2 queries.' || chr(10) || 'Document: ' || substr(coalesce(text, ''), 1, 1200) || chr(10) "
        "|| 'Queries:') as prompt_sha1 from documents"
    ),
    "messages_with_history": f"""with h as (select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn desc) as back from conversations),
        m as (select conv_id, arg_max(text, turn) as question, coalesce(list({{'role': role, 'content': text}} order by turn) filter (back between 2
            and 7), []) as said from h group by conv_id)
        select conv_id, sha1(to_json(list_concat([{{'role': 'system', 'content': '{SYSTEM}'}}], said, [{{'role': 'user', 'content': question}}]))::varchar) as messages_sha1 from m""",
}
