"""Readers, writers, streams and model calls as queries: each writes a table to the shared folder and reads it back."""

from __future__ import annotations

import numpy as np
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpuskit.functions import html as H
from corpuskit.functions import text as T
from corpuskit.operators import corpus as C
from corpuskit.operators import crawl as K
from corpuskit.operators import models as M
from corpuskit.operators import qa as Q
from corpuskit.plans.corpus import LINES_CTE, SQL_SPLIT, sql_walk
from corpuskit.sources import files, npy, sinks
from corpuskit.sources.folders import name_of, write_files
from corpuskit.sources.ledger import Ledger
from corpuskit.sources.shared import materialise, new_path
from corpuskit.sources.tables import table
from corpuskit.streaming import feedback, sensor


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def text_files(spark, sf_dir):
    """Pages in the form of text files, one file for each page, and their bodies."""
    path = new_path(spark, "texts")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.lit("t").alias("title"), F.concat(F.lit("first line\n"), F.col("url")).alias("text"))
    body = sinks.page_file(F.col("url"), F.col("title"), F.col("text"))
    # An id of any length; a page without one has a file as well.
    name = F.when(F.col("page_id").isNull(), "none").otherwise(F.format_string("%06d", "page_id"))
    write_files(pages.select(name.alias("name"), body.alias("value")), path, end="\u0000")
    read = files.read_texts(spark, f"{path}/*")
    return read.select(name_of(F.col("path")).try_cast("bigint").alias("page_id"), F.array_join(T.strip_header(F.replace("raw", F.lit("\u0000"), F.lit(""))), "|").alias("body"))


def jsonl(spark, sf_dir):
    """Training messages as JSON lines, appended in two runs, of which the second does what the first left over."""
    path = new_path(spark, "jsonl")
    rows = docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("chunk_id"), F.coalesce("text", F.lit("")).alias("text"), "source")

    def made(part):
        meta = F.struct("chunk_id", "source", F.lit("t").alias("type"), F.lit("o").alias("origin"))
        return part.select(Q.messages("S", F.lit("q"), F.col("text")).alias("messages"), meta.alias("meta"))

    sinks.append_pending(made(rows.where("cast(chunk_id as bigint) % 3 <> 0")), path)
    done = files.read_jsonl(spark, path, files.SFT).select("meta.chunk_id")
    sinks.append_pending(made(Q.pending(rows, done, "chunk_id")), path)
    read = files.read_jsonl(spark, path, files.SFT, missing_ok=True)
    return read.select("meta.chunk_id", "meta.source", F.sha1(F.element_at("messages.content", 3)).alias("text_sha1"))


def corpus_split(spark, sf_dir):
    """A corpus in a folder for each split, of which one is read."""
    path = new_path(spark, "corpus")
    lined = docs(spark, sf_dir).select("doc_id", T.lines(F.col("text")).alias("lines"))
    sinks.write_corpus(C.chunks(lined).withColumn("split", T.split_sha1(F.col("doc_id").cast("string"))), path)
    return files.read_split(spark, path, "train").select("doc_id", "chunk_index", "n_words")


def report_csv(spark, sf_dir):
    """A crawl report in CSV, with quotes and commas in it, and its key figures with numbers of files."""
    path = new_path(spark, "report")
    pages = table(spark, sf_dir, "pages")
    ok = F.col("page_id") % 7 != 0
    rows = pages.select(
        F.col("page_id").cast("int").alias("page_number"), "url", F.when(ok, 200).cast("int").alias("http_status_code"), F.lit('a "b", c').alias("page_title"),
        F.when(ok, "x.html").alias("html_filename"), F.when(ok, "x.txt").alias("txt_filename"), F.lit(1).cast("bigint").alias("html_size_bytes"),
        (F.col("page_id") % 100).cast("int").alias("word_count"), F.timestamp_seconds("page_id").alias("timestamp"), F.when(ok, "SUCCESS").otherwise("FAILED").alias("status"),
    )
    sinks.write_report(rows, path)
    read = files.read_report(spark, path)
    return sinks.submission_text(K.kpis(read), sinks.file_counts(read.where("page_title = 'a \"b\", c'")))


def json_tree(spark, sf_dir):
    """JSON files in folders, but for those below a folder ``raw``."""
    path = new_path(spark, "tree")
    rows = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("doc_id") % 4 == 0, "raw").otherwise("kept").alias("folder"), F.to_json(F.struct("doc_id", "quality")).alias("value"))
    for folder in ("raw", "kept"):
        rows.where(F.col("folder") == folder).select("value").repartition(4).write.json(f"{path}/{folder}")
    read = files.read_json_tree(spark, path)
    lines = read.select(F.explode(F.split("json", "\n")).alias("line")).where("line <> ''").select(F.get_json_object("line", "$.value").alias("v"))
    return lines.select(F.get_json_object("v", "$.doc_id").cast("bigint").alias("doc_id"), F.get_json_object("v", "$.quality").cast("int").alias("quality"))


def seeds(spark, sf_dir):
    path = new_path(spark, "seeds")
    lines = table(spark, sf_dir, "pages").select(F.when(F.col("page_id") % 5 == 0, "# no").when(F.col("page_id") % 5 == 1, "  ").otherwise(F.concat(F.lit(" "), F.col("url"), F.lit(" "))).alias("value"))
    lines.write.text(path)
    return files.read_seeds(spark, path)


def pdf_blocks(spark, sf_dir):
    """Documents from text blocks by page: pages, title and text."""
    path = new_path(spark, "blocks")
    lined = docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("doc"), F.posexplode(T.lines(F.col("text"))).alias("block_no", "text"))
    lined.select("doc", (F.col("block_no") / 4).cast("int").alias("page"), F.col("block_no").cast("int").alias("block_no"), F.col("text")).write.parquet(path)
    made = files.documents_of_blocks(files.read_blocks(spark, path))
    return made.select("doc", "pages", "title", F.sha1("text").alias("text_sha1"))


def cached_map(spark, sf_dir):
    """A table that is kept: made once, and read the second time."""
    path = new_path(spark, "kept")
    make = lambda: docs(spark, sf_dir).groupBy("lang").agg(F.count("*").alias("n"))
    files.read_or_compute(spark, path, make)
    return files.read_or_compute(spark, path, lambda: make().where("false"))


def feedback_stream(spark, sf_dir):
    """Feedback that arrives as files, appended once and counted by day."""
    source, out, marks = (new_path(spark, n) for n in ("feedback", "appended", "marks"))
    turns = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    rated = F.when(F.col("turn") % 4 == 1, "down").otherwise("up")
    said = turns.select(F.timestamp_seconds(F.col("conv_id") * 40_000).alias("timestamp"), F.lit("q").alias("question"), F.col("text").alias("answer"), rated.alias("rating"), F.lit(1).alias("num_sources"))
    said.repartition(3).write.json(source)
    for _ in range(2):  # the second time nothing is new
        feedback.append_feedback(feedback.read_feedback(spark, source), out, marks).awaitTermination()
    counted = feedback.ratings_by_day(spark.read.schema(feedback.FEEDBACK).parquet(out))
    return counted.select(F.to_date("day.start").alias("day"), "up", "down")


def model_calls(spark, sf_dir):
    """Replies of a model that fails for some prompts, and vectors of an encoder with an instruction."""
    items = table(spark, sf_dir, "benchmark").select("item_id", F.col("text").alias("prompt"))

    def call(prompts: list[str]) -> list[str | None]:
        return [None if len(p) % 5 == 0 else p + "?" for p in prompts]

    def encode(texts: list[str]) -> list[list[float]]:
        return [[float(len(t)), float(np.int64(t.count("e")))] for t in texts]

    replies = M.generate(items, call, "item_id", wait=0.0)
    vectors = M.encode(items, encode, "item_id", "prompt", prefix="query: ")
    return replies.join(vectors, "item_id").select("item_id", F.sha1("reply").alias("reply_sha1"), F.get("embedding", F.lit(0)).cast("bigint").alias("n_chars"))


def html_pages(spark, sf_dir):
    """Raw pages and their text files, written and read back."""
    path = new_path(spark, "pages")
    pages = table(spark, sf_dir, "pages")
    sinks.write_pages(pages.select("url", H.title(F.col("html")).alias("title"), F.lit("body").alias("text"), "html"), path)
    return spark.read.parquet(path).select("url", F.sha1("html").alias("html_sha1"), F.element_at(F.split("file", "\n"), -1).alias("body"))


def evaluation_rows(spark, sf_dir):
    path = new_path(spark, "evaluation")
    sinks.write_evaluation(table(spark, sf_dir, "benchmark").select("item_id", F.length("text").alias("n_chars")), path)
    rows = spark.read.schema("item_id bigint, n_chars bigint").json(f"{path}/rows")
    return rows.join(F.broadcast(spark.read.schema("n bigint").json(f"{path}/summary")))  # one row


def ledger_append(spark, sf_dir):
    """Work on documents in commits; the first run dies in the middle of a chunk, the second does what is left. The number of commits as well."""
    ledger = Ledger(spark, new_path(spark, "ledger"), "doc_id bigint, text_sha1 string")
    todo = docs(spark, sf_dir).select("doc_id", "text")

    def make(part):
        return part.select("doc_id", F.sha1(F.coalesce("text", F.lit(""))).alias("text_sha1"))

    def dies(part):
        bad = F.pmod(F.xxhash64("doc_id"), F.lit(6)) == 3  # all of the fourth chunk
        return make(part.withColumn("doc_id", F.when(bad & (F.rand(1) < 0.5), F.raise_error(F.lit("planted"))).otherwise(F.col("doc_id"))))

    try:
        ledger.resume(todo, "doc_id", dies, chunks=6)
    except PySparkException as e:
        if "planted" not in str(e):
            raise
    ledger.resume(todo, "doc_id", make, chunks=6)
    ledger.resume(todo, "doc_id", make, chunks=6)  # nothing is left
    return ledger.read().withColumn("n_commits", F.lit(len(ledger.commits())).cast("bigint"))


def questions_over_runs(spark, sf_dir):
    """Questions of conversations, each once, from two runs over one output that overlap."""
    ledger = Ledger(spark, new_path(spark, "questions"), "question_hash string, conv_id bigint, turn bigint")
    asked = table(spark, sf_dir, "conversations").where("role = 'user' and text is not null")
    rows = asked.select(F.sha2(F.lower("text"), 256).alias("question_hash"), F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"))
    ledger.append_new(rows.where("conv_id % 3 <> 0"), "question_hash", ["conv_id", "turn"])
    ledger.append_new(rows, "question_hash", ["conv_id", "turn"])
    return ledger.read()


def npy_vectors(spark, sf_dir):
    """Vectors kept in ``.npy`` files: written a file for each range of ids, and read by ranges of rows."""
    path = new_path(spark, "vectors")
    made = lambda: table(spark, sf_dir, "embeddings").repartitionByRange(4, "vec_id").sortWithinPartitions("vec_id").select(F.col("embedding").alias("vector"))
    for _ in range(2):  # the second time they are there
        read = npy.read_or_compute_npy(spark, path, made, "float")
    largest = F.array_position("vector", F.array_max("vector"))
    return read.select("row", F.size("vector").alias("n"), largest.cast("bigint").alias("largest"), F.get("vector", F.lit(0)).cast("double").alias("first"))


def block_files(spark, sf_dir):
    """Files of text blocks, some of them broken, one empty: the blocks, and a row of the audit for each file without any."""
    path = new_path(spark, "blocks")
    kind = F.col("page_id") % 10
    first = F.struct(F.array(F.struct(F.lit(0).alias("type"), F.col("url").alias("text")), F.struct(F.lit(1).alias("type"), F.lit("image").alias("text"))).alias("blocks"))
    second = F.struct(F.array(F.struct(F.lit(0).alias("type"), F.lit("  ").alias("text")), F.struct(F.lit(0).alias("type"), F.lit("end\nof page").alias("text"))).alias("blocks"))
    pages = F.when(kind == 4, F.array()).otherwise(F.array(first, second))
    body = F.when(kind == 3, F.lit("%PDF-1.4 cut off")).otherwise(F.to_json(F.struct(pages.alias("pages"))))
    named = table(spark, sf_dir, "pages").where("page_id is not null").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("name"), body.alias("value"))
    write_files(named, path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    empty = hadoop.Path(f"{path}/name=none/empty.txt")
    empty.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(empty).close()
    read = materialise(files.read_block_files(spark, path, "*.txt"), "read")  # files are opened once, for the blocks and for the audit
    audit = files.audit_lines(spark, read, path, ["st1"]).select(F.lit(None).cast("string").alias("doc"), F.lit(None).cast("int").alias("page"), F.lit(None).cast("int").alias("block_no"), F.lit(None).cast("string").alias("text"), "audit")
    short = lambda c: F.regexp_replace(c, r"name=([^/]+)/[^:]*|[^/ ]+/([^/]+)\.txt", "$1$2")
    return read.where("audit is null").union(audit).select(short("doc").alias("doc"), "page", "block_no", "text", short("audit").alias("audit"))


def file_sensor(spark, sf_dir):
    """A stream that waits for a file for each nation, of which a third never comes."""
    path, root = new_path(spark, "arrivals"), new_path(spark, "sensor")
    nations = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("name"), (F.col("n_nationkey") % 3 != 0).alias("comes"))
    nations.where("comes").select("name", F.lit("x").alias("value")).repartition(4, "name").write.partitionBy("name").text(path)
    found = sensor.wait_for_files(spark, nations, f"{path}/*", root, poll=1.0, limit=5.0, named="name=([^/]*)/")
    return found.select("name", "outcome")


def audit_file(spark, sf_dir):
    """The audit of a corpus as a text file."""
    path = new_path(spark, "audit")
    sinks.write_audit(docs(spark, sf_dir).agg(F.count("*").alias("documents"), F.count_if(F.col("text").isNull()).alias("without_text"), F.count_distinct("lang").alias("languages")), path)
    return spark.read.text(path, wholetext=True).select(F.rtrim(F.translate("value", "\n", "|")).alias("value"))


def milestones_file(spark, sf_dir):
    """Milestones of a crawl, all successes and all attempts, as one row of JSON."""
    pages = table(spark, sf_dir, "pages").withColumn("ok", F.col("page_id") % 7 != 0)
    reached = pages.where("ok").groupBy((F.floor(F.col("page_id") / 100) * 100 + 100).alias("milestone")).agg(F.count("*").alias("success"))
    return sinks.milestones_json(reached, pages.agg(F.count_if(F.col("ok")).alias("success"), F.count("*").alias("total")))


def answer_cache(spark, sf_dir):
    """Answers by question, a JSON object each, written as lines and looked up again."""
    path = new_path(spark, "answers")
    made = table(spark, sf_dir, "benchmark").select(F.sha1("text").alias("key"), F.col("text").alias("question"), F.concat("text", F.lit("!")).alias("answer"), F.array(F.lit("a"), F.lit("b")).alias("sources"))
    sinks.cache_json(made).write.text(path)
    kept = spark.read.schema("key string, question string, answer string, sources array<string>").json(path)
    return kept.select("key", F.sha1("answer").alias("answer_sha1"), F.size("sources").cast("bigint").alias("n_sources"))


def attachments(spark, sf_dir):
    """Files that users attach, of two kinds; others are left alone."""
    path = new_path(spark, "attached")
    rows = table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))).alias("name"), F.col("url").alias("value"))
    write_files(rows, path)
    read = files.read_attachments(spark, f"{path}/*", "*.{txt,md}")
    return read.select(F.trim(F.translate("text", "\n", "")).alias("url"), F.endswith("name", F.lit(".txt")).alias("is_text"))


QUERIES = {f.__name__: f for f in (text_files, jsonl, corpus_split, report_csv, json_tree, seeds, pdf_blocks, cached_map, feedback_stream, model_calls, html_pages, evaluation_rows, ledger_append, questions_over_runs, npy_vectors, block_files, file_sensor, audit_file, milestones_file, answer_cache, attachments)}

ORACLES = {
    "text_files": "select page_id, 'first line|' || url as body from pages",
    "jsonl": "select doc_id::varchar as chunk_id, source, sha1(coalesce(text, '')) as text_sha1 from documents",
    "corpus_split": (
        f"with recursive {LINES_CTE}, {sql_walk('lined', 350, 450)} select doc_id, chunk_index, n_words from packed where n_words >= 50 "
        f"and {SQL_SPLIT} = 'train'"
    ),
    "report_csv": """with r as (select count(*) as total, count(*) filter (page_id % 7 <> 0) as ok, floor(avg(page_id % 100))::bigint as words from pages)
        select 'Pages attempted : ' || total || chr(10) || 'Pages downloaded: ' || ok || chr(10) || 'Success rate    : '
            || printf('%.1f', round(ok * 100::double / total, 1)) || ' %' || chr(10)
               || 'Mean words      : ' || words || chr(10) || 'HTML files      : ' || ok || chr(10) || 'Text files      : ' || ok as value from r""",
    "json_tree": "select doc_id, quality from labels where doc_id % 4 <> 0",
    "seeds": "select url from pages where page_id % 5 > 1",
    "pdf_blocks": f"""with {LINES_CTE} select doc_id::varchar as doc, ceil(len(lines) / 4::double)::bigint as pages, substr(lines[1], 1, 120) as title,
        sha1(array_to_string(lines, chr(10))) as text_sha1 from lined where len(lines) > 0""",
    "cached_map": "select lang, count(*) as n from documents group by lang",
    "feedback_stream": """select cast(to_timestamp(conv_id * 40000) at time zone 'UTC' as date) as day, count(*) filter (turn % 4 <> 1) as up, count(*) filter (turn % 4 = 1) as down
        from conversations where role = 'assistant' group by 1""",
    "model_calls": "select item_id, sha1(text || '?') as reply_sha1, length(text) + 7 as n_chars from benchmark where length(text) % 5 <> 0",
    "html_pages": "select url, sha1(html) as html_sha1, 'body' as body from pages",
    "evaluation_rows": "select item_id, length(text) as n_chars, (select count(*) from benchmark) as n from benchmark",
    "ledger_append": "select doc_id, sha1(coalesce(text, '')) as text_sha1, 6::bigint as n_commits from documents",
    "questions_over_runs": """select sha256(lower(text)) as question_hash, conv_id::bigint as conv_id, turn::bigint as turn from conversations
        where role = 'user' and text is not null qualify row_number() over (partition by lower(text) order by conv_id % 3 = 0, conv_id, turn) = 1""",
    "npy_vectors": """select row_number() over (order by vec_id) - 1 as row, len(embedding)::int as n, list_position(embedding, list_max(embedding))::bigint as largest, embedding[1]::double as first
        from embeddings""",
    "block_files": """select 'p' || page_id as doc, 0 as page, 0 as block_no, url as text, null as audit from pages where page_id % 10 not in (3, 4) and trim(url) <> ''
        union all select 'p' || page_id, 1, 1, 'end' || chr(10) || 'of page', null from pages where page_id % 10 not in (3, 4)
        union all select null, null, null, null, '[FAIL] p' || page_id || ': unreadable' from pages where page_id % 10 = 3
        union all select null, null, null, null, '[WARN] p' || page_id || ': no text extracted' from pages where page_id % 10 = 4
        union all select null, null, null, null, '[FAIL] none: 0 bytes' union all select null, null, null, null, '[WARN] missing folder: st1'""",
    "file_sensor": "select 'n' || n_nationkey as name, case when n_nationkey % 3 <> 0 then 'arrived' else 'timeout' end as outcome from nation",
    "audit_file": """select rpad('documents', 16, ' ') || ': ' || count(*) || '|' || rpad('without_text', 16, ' ') || ': ' || count(*) filter (text is null) || '|'
        || rpad('languages', 16, ' ') || ': ' || count(distinct lang) || '|' as value from documents""",
    "milestones_file": """select '{"milestones":{' || (select string_agg('"' || m || '":' || n, ',' order by m) from (select (page_id // 100 * 100 + 100)::varchar as m, count(*) as n from pages
        where page_id % 7 <> 0 group by 1)) || '},"total_success":' || count(*) filter (page_id % 7 <> 0) || ',"total_attempted":' || count(*) || '}' as value from pages""",
    "answer_cache": "select sha1(text) as key, sha1(text || '!') as answer_sha1, 2::bigint as n_sources from benchmark",
    "attachments": "select trim(url) as url, true as is_text from pages",
}
