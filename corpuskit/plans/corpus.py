"""Queries over ``documents`` that build and audit a corpus, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.functions import text as T
from corpuskit.operators import corpus as C
from corpuskit.sources.tables import table

#: DuckDB expressions.
WS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def sql_words(c: str) -> str:
    return rf"len(regexp_extract_all({c}, '[^{WS}]+'))"


def sql_strip(c: str) -> str:
    return rf"regexp_replace({c}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def sql_every_line(c: str) -> str:
    joined = rf"regexp_replace(coalesce({c}, ''), '([\p{{L}}\p{{N}}_])-\n([\p{{L}}\p{{N}}_])', '\1\2', 'g')"
    return rf"list_transform(regexp_split_to_array({joined}, '{LINE_END}'), lambda x: {sql_strip(rf'regexp_replace(x, {chr(39)}[ \t]+{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})')})"


def sql_lines(c: str) -> str:
    return f"list_filter({sql_every_line(c)}, lambda x: x <> '')"


def sql_tokens(c: str) -> str:
    return rf"list_filter(regexp_extract_all(lower(coalesce({c}, '')), '[\p{{L}}\p{{N}}_]+'), lambda x: regexp_full_match(x, '[a-z0-9]{{2,}}'))"


SQL_SPLIT = "case when ('0x' || substr(sha1(doc_id::varchar), 1, 8))::bigint % 100 < 15 then 'test' else 'train' end"


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def lined(spark, sf_dir):
    return docs(spark, sf_dir).where(T.has_text(F.col("text"))).select("doc_id", T.lines(F.col("text")).alias("lines"))


def token_counts(spark, sf_dir):
    t = T.tokens(F.col("text"))
    return docs(spark, sf_dir).select("doc_id", F.size(t).cast("bigint").alias("n_tokens"), F.size(F.array_distinct(t)).cast("bigint").alias("n_distinct"))


def word_counts(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.n_words(F.col("text")).alias("n_words"), F.substring("text", 1, 40).alias("head"))


def clean_lines(spark, sf_dir):
    hyphens = F.regexp_replace("text", r"([\p{L}]) ([\p{L}])", "$1-\n$2")
    both = docs(spark, sf_dir).select("doc_id", T.lines(F.col("text")).alias("a"), T.lines(hyphens).alias("b"))
    return both.select("doc_id", F.size("a").cast("bigint").alias("n_lines"), F.sha1(F.array_join("a", "\n")).alias("lines_sha1"), F.sha1(F.array_join("b", "\n")).alias("hyphen_sha1"))


def header_strip(spark, sf_dir):
    raw = F.concat(F.lit("URL: https://x/"), F.col("doc_id").cast("string"), F.lit("\nTitle: t\n"), F.when(F.col("doc_id") % 3 == 0, "\n").otherwise(""), F.repeat(F.lit("─"), (F.col("doc_id") % 8 + 3).cast("int")), F.lit("\n"), F.coalesce("text", F.lit("")))
    body = T.strip_header(raw)
    return docs(spark, sf_dir).select("doc_id", F.size(body).cast("bigint").alias("n_lines"), F.sha1(F.array_join(body, "\n")).alias("body_sha1"))


def line_doc_freq(spark, sf_dir):
    return C.line_document_frequency(lined(spark, sf_dir))


def boilerplate_lines(spark, sf_dir):
    return C.boilerplate_lines(lined(spark, sf_dir), 0.02)


def strip_boilerplate(spark, sf_dir):
    full = lined(spark, sf_dir)
    kept = C.strip_boilerplate(full, C.boilerplate_lines(full, 0.02))
    return kept.select("doc_id", F.size("lines").cast("bigint").alias("n_lines"), F.sha1(F.array_join("lines", "\n")).alias("body_sha1"))


def chunk_greedy(spark, sf_dir):
    return C.chunks(lined(spark, sf_dir)).select("doc_id", "chunk_index", "n_words", F.sha1("text").alias("text_sha1"))


def chunk_merge_tail(spark, sf_dir):
    made = C.chunks(lined(spark, sf_dir), low=120, high=420, least=120, merge_tail=True)
    made = made.where(~C.junk_chunk(F.col("text"), F.lit(True)))
    return made.select("doc_id", "chunk_index", "n_words", F.sha1("text").alias("text_sha1"))


def dedup_exact(spark, sf_dir):
    rows = docs(spark, sf_dir).select("doc_id", T.content_hash(T.blank_if_null(F.col("text"))).alias("content_hash"), F.length("text").alias("n"))
    return C.first_by_hash(rows, "content_hash", "doc_id")


def split_sha1(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.split_sha1(F.col("doc_id").cast("string")).alias("split"))


def split_sha256(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.split_sha256(F.col("doc_id").cast("string")).alias("split"))


def built(spark, sf_dir):
    return C.build_corpus(docs(spark, sf_dir), fraction=0.02)


def corpus_build(spark, sf_dir):
    return built(spark, sf_dir).withColumn("tags", F.array_join("tags", ","))


def corpus_audit(spark, sf_dir):
    return C.audit(docs(spark, sf_dir), built(spark, sf_dir), 0.02)


def alpha_ratio_filter(spark, sf_dir):
    t = F.col("text")
    block = (F.length(t) >= 3) & ~((T.alpha_ratio(t) < 0.45) & (F.length(t) > 60))
    return docs(spark, sf_dir).select("doc_id", F.round(T.alpha_ratio(t), 9).alias("alpha"), block.alias("keep_block"), C.junk_chunk(t, F.lit(True)).alias("junk_chunk"))


def reference_cut(spark, sf_dir):
    blocks = lined(spark, sf_dir).select("doc_id", F.posexplode("lines").alias("pos", "block"))
    marked = F.when((F.col("doc_id") % 5 == 0) & (F.col("pos") == 4), "References").when((F.col("doc_id") % 5 == 1) & (F.col("pos") == 7), F.concat("block", F.lit(" References x"))).when((F.col("doc_id") % 5 == 2), F.concat("block", F.lit(" [1] [2] [3] end"))).otherwise(F.col("block"))
    kept = C.cut_references(blocks.withColumn("block", marked))
    return kept.select("doc_id", "pos", F.sha1("block").alias("block_sha1"))


def repeated_page_lines(spark, sf_dir):
    places = F.transform("lines", lambda x, i: F.struct((i / 4).cast("int").alias("page"), x.alias("line")))
    heads = F.transform(F.filter("lines", lambda x, i: i % 4 == 0), lambda x, i: F.struct(i.alias("page"), F.when(i % 2 == 0, "Running Head").otherwise("running head").alias("line")))
    return C.repeated_lines(lined(spark, sf_dir).select("doc_id", F.inline(F.concat(places, heads))))


def line_filter(spark, sf_dir):
    lines = lined(spark, sf_dir).select("doc_id", F.posexplode("lines").alias("pos", "line")).withColumn("page", (F.col("pos") / 5).cast("int"))
    marks = F.when(F.col("pos") % 5 == 0, "About").when(F.col("pos") % 5 == 1, F.concat(F.lit("Page "), F.col("pos").cast("string"))).when(F.col("pos") % 5 == 2, " | | ")
    made = marks.when(F.col("pos") % 10 == 3, "Running Head").when(F.col("pos") % 10 == 8, "so we bring the world together").otherwise(F.col("line"))
    return C.filter_lines(lines.withColumn("line", made)).groupBy("doc_id").agg(F.count("*").alias("kept"))


def file_audit(spark, sf_dir):
    full = lined(spark, sf_dir)
    made = C.chunks(full).withColumn("content_hash", T.content_hash(F.col("text")))
    files = full.select("doc_id", F.ceil(F.size("lines") / 5).cast("int").alias("pages"), T.split_sha256(F.col("doc_id").cast("string")).alias("split"))
    return C.file_audit(made, C.first_by_hash(made.drop("text"), "content_hash", "doc_id", "chunk_index"), files).select("doc_id", "line")


LINES_CTE = f"lined as (select doc_id, {sql_lines('text')} as lines from documents)"
BOILER_CTE = f"""{LINES_CTE},
    usable as (select * from lined where len(lines) > 0),
    freq as (select line, count(*) as df from (select distinct doc_id, unnest(lines) as line from usable) group by line),
    boiler as (select line, df from freq where df >= greatest(2, floor((select count(*) from usable) * 0.02::double)) and {sql_words('line')} <= 12)"""


def sql_walk(source: str, low: int, high: int) -> str:
    """A recursive walk over lines that numbers greedy chunks: ``walked`` (doc_id, rn, line, w, chunk)."""
    return rf"""
    numbered as (select doc_id, rn, lines[rn] as line, {sql_words('lines[rn]')} as w
        from (select doc_id, lines, unnest(range(1, len(lines) + 1)) as rn from {source})),
    walked as (
        select doc_id, rn, line, w, 0 as chunk, w as total from numbered where rn = 1
        union all
        select n.doc_id, n.rn, n.line, n.w, case when p.total + n.w > {high} and p.total >= {low} then p.chunk + 1 else p.chunk end,
               case when p.total + n.w > {high} and p.total >= {low} then n.w else p.total + n.w end
        from walked p join numbered n on n.doc_id = p.doc_id and n.rn = p.rn + 1
    ),
    packed as (select doc_id, chunk::int as chunk_index, sum(w)::int as n_words, string_agg(line, ' ' order by rn) as text from walked group by doc_id, chunk)"""



def sql_alpha(c: str) -> str:
    return rf"length(regexp_replace({c}, '[^\p{{L}}]', '', 'g')) / greatest(length({c}), 1)::double"


def sql_hits(c: str) -> str:
    return f"len(regexp_extract_all({c}, '{C.CITATION}'))"


def sql_junk(c: str) -> str:
    return f"({sql_alpha(c)} < 0.35 or ({sql_hits(c)} >= 5 and {sql_hits(c)} / greatest({sql_words(c)}, 1)::double * 100 >= 2))"


SQL_BUILD = f"""with recursive {BOILER_CTE},
    stripped as (select doc_id, list_filter(lines, lambda x: x not in (select line from boiler)) as lines from usable),
    bodies as (select u.doc_id, coalesce(list(l.line order by l.rn) filter (l.line is not null), []) as lines
               from usable u left join (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as rn from usable) l
               on u.doc_id = l.doc_id and l.line not in (select line from boiler) group by u.doc_id),
    {sql_walk('bodies', 350, 450)},
    hashed as (select *, substr(sha1(text), 1, 16) as content_hash from packed where n_words >= 50),
    chosen as (select * from hashed qualify row_number() over (partition by content_hash order by doc_id, chunk_index) = 1)""".replace("    stripped as (select doc_id, list_filter(lines, lambda x: x not in (select line from boiler)) as lines from usable),\n", "")

QUERIES = {f.__name__: f for f in (token_counts, word_counts, clean_lines, header_strip, line_doc_freq, boilerplate_lines, strip_boilerplate, chunk_greedy, chunk_merge_tail, dedup_exact, split_sha1, split_sha256, corpus_build, corpus_audit, alpha_ratio_filter, reference_cut, repeated_page_lines, line_filter, file_audit)}

ORACLES = {
    "token_counts": f"select doc_id, len({sql_tokens('text')}) as n_tokens, len(list_distinct({sql_tokens('text')})) as n_distinct from documents",
    "word_counts": f"select doc_id, {sql_words('text')} as n_words, substr(text, 1, 40) as head from documents",
    "clean_lines": (
        f"select doc_id, len({sql_lines('text')}) as n_lines, sha1(array_to_string({sql_lines('text')}, chr(10))) "
        f"as lines_sha1, sha1(array_to_string({sql_lines('h')}, chr(10))) as hyphen_sha1 "
        f"from (select *, regexp_replace(text, '([\\p{{L}}]) ([\\p{{L}}])', '\\1-' || chr(10) || '\\2', 'g') as h from documents)"
    ),
    "header_strip": rf"""
        with raw as (select doc_id, 'URL: https://x/' || doc_id || chr(10) || 'Title: t' || chr(10) ||
            case when doc_id % 3 = 0 then chr(10) else '' end
                            || repeat('─', (doc_id % 8 + 3)::int) || chr(10) || coalesce(text, '') as raw from documents),
        every as (select doc_id, {sql_every_line('raw')} as e from raw),
        places as (select doc_id, e, coalesce(list_min(list_filter(range(1, len(e) + 1), lambda i: not starts_with(e[i], 'URL:')
            and not starts_with(e[i], 'Title:'))), len(e) + 1) as p from every),
        bodies as (select doc_id, list_filter(e[(p + case when regexp_full_match(coalesce(e[p], ''), '[\x{{2500}}-\x{{257f}}\-_=]{{6,}}') then 1
            else 0 end)::bigint:], lambda x: x <> '') as body from places)
        select doc_id, len(body) as n_lines, sha1(array_to_string(body, chr(10))) as body_sha1 from bodies
    """,
    "line_doc_freq": f"with {LINES_CTE} select line, count(*) as df from (select distinct doc_id, unnest(lines) as line from lined) group by line",
    "boilerplate_lines": f"with {BOILER_CTE} select line, df from boiler",
    "strip_boilerplate": f"""with {BOILER_CTE},
        bodies as (select u.doc_id, coalesce(list(l.line order by l.rn) filter (l.line is not null), []) as lines
                   from usable u left join (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as rn from usable) l
                   on u.doc_id = l.doc_id and l.line not in (select line from boiler) group by u.doc_id)
        select doc_id, len(lines) as n_lines, sha1(coalesce(array_to_string(lines, chr(10)), '')) as body_sha1 from bodies""",
    "chunk_greedy": (
        f"with recursive {LINES_CTE}, {sql_walk('lined', 350, 450)} select doc_id, chunk_index, n_words, sha1(text) as text_sha1 "
        f"from packed where n_words >= 50"
    ),
    "chunk_merge_tail": f"""with recursive {LINES_CTE}, {sql_walk('lined', 120, 420)},
        tails as (select doc_id, max(chunk_index) as last from packed group by doc_id),
        moved as (select w.doc_id, w.rn, w.line, w.w, case when w.chunk = t.last and t.last > 0
            and p.n_words < 120 then w.chunk - 1 else w.chunk end as chunk
                  from walked w join tails t on w.doc_id = t.doc_id join packed p on p.doc_id = w.doc_id and p.chunk_index = w.chunk),
        merged as (select doc_id, chunk::int as chunk_index, sum(w)::int as n_words, string_agg(line, ' ' order by rn) as text from moved
            group by doc_id, chunk)
        select doc_id, chunk_index, n_words, sha1(text) as text_sha1 from merged where not {sql_junk('text')}""",
    "dedup_exact": (
        "select doc_id, substr(sha1(coalesce(text, '')), 1, 16) as content_hash, length(text)::int as n from documents "
        "qualify row_number() over (partition by coalesce(text, '') order by doc_id) = 1"
    ),
    "split_sha1": f"select doc_id, {SQL_SPLIT} as split from documents",
    "split_sha256": (
        "select doc_id, case when list_sum(list_transform(string_split(sha256(doc_id::varchar), ''), lambda x: ('0x' "
        "|| x)::bigint)) % 5 = 0 then 'test' else 'train' end as split from documents"
    ),
    "corpus_build": f"""{SQL_BUILD}
        select 'web/' || doc_id || '#c' || lpad(chunk_index::varchar, 3, '0') as id, 'web' as source, 'webpage_text' as source_type, doc_id::varchar
            as title,
               'https://' || replace(regexp_replace(doc_id::varchar, '^\\d+_', ''), '_', '/') as origin, {SQL_SPLIT} as split, chunk_index, n_words, content_hash, 'webpage_text,web' as tags, text from chosen""",
    "corpus_audit": f"""{SQL_BUILD}
        select (select count(*) from lined) as files, (select count(*) from usable) as usable, (select count(*) from lined) - (select count(*)
            from usable) as skipped,
               (select count(*) from boiler) as boilerplate, count(*) as chunks, count(*) filter ({SQL_SPLIT} = 'train') as train, count(*) filter ({SQL_SPLIT} = 'test') as test from chosen""",
    "alpha_ratio_filter": (
        f"select doc_id, round({sql_alpha('text')}, 9) as alpha, length(text) >= 3 and not ({sql_alpha('text')} < 0.45 "
        f"and length(text) > 60) as keep_block, {sql_junk('text')} as junk_chunk from documents"
    ),
    "reference_cut": rf"""with {LINES_CTE},
        raw as (select doc_id, (generate_subscripts(lines, 1) - 1)::int as pos, unnest(lines) as line from lined),
        blocks as (select doc_id, pos, case when doc_id % 5 = 0 and pos = 4 then 'References' when doc_id % 5 = 1 and pos = 7 then line
            || ' References x'
                          when doc_id % 5 = 2 then line || ' [1] [2] [3] end' else line end as block from raw),
        marked as (select *, count(*) over (partition by doc_id) as n, regexp_matches(block, '{C.REFERENCE_HEAD}')
            as head, regexp_matches(block, '{C.REFERENCE_INLINE}') as inl from blocks),
        stops as (select *, min(pos) filter (head or (inl and pos > n * 0.4::double)) over (partition by doc_id) as stop from marked),
        heads as (select *, {sql_strip(rf"regexp_replace(block, '(?s){C.REFERENCE_INLINE}.*$', chr(92) || '1')")} as before from stops)
        select doc_id, pos, sha1(case when pos = stop then before else block end) as block_sha1 from heads
        where (stop is null or pos < stop or (pos = stop and not head and {sql_words('before')} > 15))
          and (coalesce(pos = stop, false) or not (pos > n * 0.6::double and {sql_hits('block')} >= 3))
    """.replace("chr(92) || '1'", r"'\1'"),
    "repeated_page_lines": f"""with {LINES_CTE},
        raw as (select doc_id, ((generate_subscripts(lines, 1) - 1) // 4)::int as page, unnest(lines) as line from lined),
        every as (select * from raw union all select distinct doc_id, page, case when page % 2 = 0 then 'Running Head' else 'running head' end
            from raw),
        pages as (select doc_id, count(distinct page) as pages from every group by doc_id having count(distinct page) > 1),
        counts as (select doc_id, lower(line) as key, count(*) as df from (select distinct doc_id, page, line from every)
            group by doc_id, lower(line))
        select doc_id, key, df from counts join pages using (doc_id) where df >= greatest(2, round_even(pages * 0.4::double, 0)) and length(key) > 2""",
    "line_filter": rf"""with {LINES_CTE},
        raw as (select doc_id, generate_subscripts(lines, 1) - 1 as pos, unnest(lines) as line from lined),
        made as (select doc_id, pos // 5 as page, case when pos % 5 = 0 then 'About' when pos % 5 = 1 then 'Page '
            || pos when pos % 5 = 2 then ' | | '
                        when pos % 10 = 3 then 'Running Head' when pos % 10 = 8 then 'so we bring the world together' else line end as line from raw),
        pages as (select doc_id, count(distinct page) as pages from made group by doc_id having count(distinct page) > 1),
        heads as (select doc_id, lower({sql_strip('line')}) as key from (select distinct doc_id, page, line from made
            where {sql_strip('line')} <> '') join pages using (doc_id)
                  group by doc_id, lower({sql_strip('line')}), pages having count(*) >= greatest(2, round_even(pages * 0.4::double, 0))
                      and length(lower({sql_strip('line')})) > 2)
        select doc_id, count(*) as kept from made
        where {sql_strip('line')} <> '' and lower({sql_strip('line')}) not in ({', '.join(f"'{x}'" for x in C.NAVIGATION)})
            and not regexp_matches(line, '{C.FOOTER}')
          and not regexp_matches(line, '{C.PAGE_NUMBER}') and {sql_strip("replace(line, '|', '')")} <> ''
              and (doc_id, lower({sql_strip('line')})) not in (select (doc_id, key) from heads)
        group by doc_id""",
    "file_audit": f"""with recursive {LINES_CTE}, {sql_walk('lined', 350, 450)},
        made as (select *, row_number() over (partition by text order by doc_id, chunk_index) as n from packed where n_words >= 50),
        sums as (select doc_id, count(*) filter (n = 1) as kept, count(*) filter (n > 1) as dups from made group by doc_id),
        files as (select doc_id, ceil(len(lines) / 5::double)::int as pages,
                         case when list_sum(list_transform(string_split(sha256(doc_id::varchar), ''), lambda x: ('0x'
                             || x)::bigint)) % 5 = 0 then 'test' else 'train' end as split
                  from lined where len(lines) > 0)
        select doc_id, printf('[ OK ] %s: %dp -> %d chunks (%d dups dropped) [%s]', doc_id::varchar, pages, coalesce(kept, 0), coalesce(dups, 0),
            split) as line
        from files left join sums using (doc_id)""",
}
