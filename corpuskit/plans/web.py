"""Queries over ``pages``: names, titles, links, reports; and records in JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuskit.functions import html as H
from corpuskit.functions import text as T
from corpuskit.operators import crawl as K
from corpuskit.operators import discovery as D
from corpuskit.operators.corpus_map import corpus_map as map_documents
from corpuskit.plans.corpus import WS, sql_strip
from corpuskit.sources.tables import table

DOMAINS = ("example.com", "example.org")


def pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


def crawl_safe_name(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", T.safe_name(F.col("url"), F.col("page_id")).alias("name"))


def crawl_extract_title(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", H.title(F.col("html")).alias("title"))


def crawl_text(spark, sf_dir):
    return pages(spark, sf_dir).select("page_id", H.page_text("html").alias("text"))


def crawl_links(spark, sf_dir):
    return K.links(pages(spark, sf_dir), DOMAINS).select("page_id", "link")


def crawl_frontier(spark, sf_dir):
    linked = K.links(pages(spark, sf_dir), ("example.com", "example.org", "example.net"))
    edges = linked.select(K.url_key(F.regexp_replace("url", r"[?#].*$", "")).alias("source"), K.url_key("link").alias("target")).distinct()
    seeds = pages(spark, sf_dir).where("page_id % 50 = 0").select(K.url_key(F.regexp_replace("url", r"[?#].*$", "")).alias("key"))
    return K.reachable(seeds, edges)


def report(spark, sf_dir):
    """A crawl report: every tenth page failed, every eleventh had no answer."""
    code = F.when(F.col("page_id") % 11 == 0, F.lit(None)).when(F.col("page_id") % 10 == 0, 404).otherwise(200)
    rows = pages(spark, sf_dir).select(F.col("page_id").alias("page_number"), "url", code.cast("int").alias("http_status_code"), T.n_words(F.regexp_replace("html", "(?s)<[^>]*>", " ")).alias("w"))
    return rows.withColumn("status", F.when(F.col("http_status_code") == 200, "SUCCESS").otherwise("FAILED")).withColumn("word_count", F.when(F.col("status") == "SUCCESS", F.col("w")).otherwise(0))


def crawl_kpis(spark, sf_dir):
    return K.kpis(report(spark, sf_dir))


def crawl_domains(spark, sf_dir):
    return K.by_domain(report(spark, sf_dir))


def crawl_status(spark, sf_dir):
    return K.by_status(report(spark, sf_dir))


def crawl_milestones(spark, sf_dir):
    return K.milestones(report(spark, sf_dir), (50, 100, 333, 1000))


def report_join(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    rows = labels.select(F.col("doc_id").cast("string").alias("txt_filename"), F.lit("t").alias("title"), F.lit("u").alias("url"), F.when(F.col("quality") == 1, "success ").when(F.col("toxic") == 1, "").otherwise("FAILED").alias("status"), F.lit(1).alias("page_number"))
    again = rows.where("cast(txt_filename as bigint) % 7 = 0").withColumns({"status": F.lit("FAILED"), "page_number": F.lit(2)})
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("txt_filename"), "doc_id")
    return K.usable(docs, rows.union(again)).select("doc_id", "status")


def url_and_origin(spark, sf_dir):
    stem = F.regexp_replace(T.safe_name(F.col("url"), F.col("page_id")), r"\.", "_")
    paper = F.concat(F.lit("x_"), F.format_string("%04d.%05d", F.col("page_id").cast("int"), F.col("page_id").cast("int")))
    site = F.concat(F.lit("02_ring_"), F.col("page_id").cast("string"), F.lit("_gov_about_x"))
    return pages(spark, sf_dir).select("page_id", T.url_from_stem(stem).alias("url"), T.origin_from_name(paper, F.lit(True)).alias("paper"), T.origin_from_name(site, F.lit(False)).alias("site"), T.origin_from_name(stem, F.lit(False)).alias("none"), T.slug(F.col("url")).alias("slug"), F.concat(F.lit("web/"), stem, F.lit("#c"), F.lpad((F.col("page_id") % 12).cast("string"), 3, "0")).alias("chunk_id"))


def nfkc_normalise(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", H.normalise_block(F.col("text")).alias("text"))


def latin1_safe(spark, sf_dir):
    shown = F.concat(F.lit("“"), F.col("text"), F.lit("”… — \U0001f642"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha1(T.latin1_safe(shown)).alias("sha1"))


def corpus_map(spark, sf_dir):
    return map_documents(table(spark, sf_dir, "documents"))


def records(spark, sf_dir):
    """Documents, whole, as JSON records of the three kinds, and some that are none; titles are first lines."""
    c, text = F.col("doc_id"), F.coalesce("text", F.lit(""))
    first, name = F.substring_index(text, "\n", 1), F.concat(F.lit("r"), c.cast("string"))
    patent = F.struct(
        first.alias("title"),
        F.concat(F.lit("In one embodiment, FLT3.sup.ITD "), text).alias("abstract"),
        F.concat(F.lit("1. "), text, F.lit("\n2 . "), first, F.lit("\n3. third\n4. fourth")).alias("claims"),
        F.array(F.lit("A61K31/00"), F.lit("A61K9/00"), F.lit("zz"), F.lit("C12N1/00")).alias("cpc_codes"),
        F.when(c % 2 == 0, name).alias("document_id"),
        F.array(name, F.lit("b")).alias("assignees"),
    )
    made = (("DIETARY_SUPPLEMENT", name), ("DRUG-ELUTING", F.lit("x")), ("DRUG", F.lit("")))
    arms = F.array(*(F.struct(F.lit(kind).alias("type"), called.alias("name")) for kind, called in made))
    trial = F.struct(
        F.struct(
            F.struct(F.when(c % 5 != 0, name).alias("nctId"), first.alias("briefTitle")).alias("identificationModule"),
            F.struct(text.alias("briefSummary")).alias("descriptionModule"),
            F.struct(F.array(F.lit("a"), F.lit("b")).alias("conditions")).alias("conditionsModule"),
            F.struct(arms.alias("interventions")).alias("armsInterventionsModule"),
            F.struct(F.array(F.lit("PHASE2")).alias("phases")).alias("designModule"),
        ).alias("protocolSection")
    )
    listing = F.struct(
        first.alias("title"),
        F.lit("As used herein, x").alias("excerpt"),
        text.alias("body"),
        F.concat(F.lit("https://x/"), name).alias("url"),
        F.lit("s").alias("site"),
        F.lit("page").alias("content_type"),
        (c % 10).cast("double").alias("topic_score"),
    )
    kinds = F.when(c % 4 == 0, F.to_json(patent)).when(c % 4 == 1, F.to_json(trial)).when(c % 4 == 2, F.to_json(listing))
    json = kinds.when(c % 8 == 3, "[1, 2]").otherwise('{"x": ')
    return table(spark, sf_dir, "documents").select(json.alias("json"))


def discovery_normalise(spark, sf_dir):
    found = D.parse_records(records(spark, sf_dir))
    lists = [F.array_join(c, ",") for c in ("cpc_codes", "assignees", "conditions", "phases")]
    return found.select(
        "doc_id", "source", "side", F.sha1("title").alias("title_sha1"), "embedding_text", "source_url",
        F.coalesce("topic_score", F.lit(-1.0)).alias("topic_score"), F.concat_ws("|", *lists, "content_type").alias("extra"),
    )


def discovery_for_queries(spark, sf_dir):
    return D.for_queries(D.parse_records(records(spark, sf_dir))).groupBy("source", "side").agg(F.count("*").alias("docs"))


def discovery_summary(spark, sf_dir):
    first = F.substring_index(F.coalesce("text", F.lit("")), "\n", 1)
    return D.summary(table(spark, sf_dir, "documents").withColumn("title", first), "lang", "text", "doc_id", "title")


QUERIES = {f.__name__: f for f in (crawl_safe_name, crawl_extract_title, crawl_text, crawl_links, crawl_frontier, crawl_kpis, crawl_domains, crawl_status, crawl_milestones, report_join, url_and_origin, nfkc_normalise, latin1_safe, corpus_map, discovery_normalise, discovery_for_queries, discovery_summary)}


def sql_name(url: str, n: str) -> str:
    return rf"lpad({n}::varchar, 4, '0') || '_' || substr(regexp_replace(regexp_replace(regexp_replace({url}, '^https?://', ''), '[^A-Za-z0-9.\-]', '_', 'g'), '^_+|_+$', '', 'g'), 1, 55)"


def sql_host(url: str) -> str:
    return rf"lower(regexp_extract({url}, '^[A-Za-z]+://([^/?#:]*)', 1))"


def sql_shown(c: str) -> str:
    """Without comments, scripts, styles and templates."""
    shown = f"regexp_replace(coalesce({c}, ''), '<!--.*?(-->|$)', ' ', 'gs')"
    for tag in ("script", "style", "template"):
        shown = rf"regexp_replace({shown}, '(?i)<{tag}\b[^>]*>.*?(</{tag}\s*>|$)', ' ', 'gs')"
    return shown


def sql_decode(c: str) -> str:
    """Character references by the common names; the pages have none by number."""
    for name, character in H.ENTITIES:
        c = f"replace({c}, '&{name};', '{character.replace(chr(39), chr(39) * 2)}')"
    return f"replace({c}, '&amp;', '&')"


SQL_HREF = r"""'(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>][^\s>]*)'"""
SQL_UNQUOTED = """case when left(href, 1) in ('"', '''') then substr(href, 2, length(href) - 2) else href end"""
LINKS = rf"""raw as (select page_id, url, unnest(regexp_extract_all({sql_shown('html')}, {SQL_HREF}, 1)) as href from pages),
    plain as (select page_id, url, {sql_decode(SQL_UNQUOTED)} as href from raw),
    hrefs as (select page_id, url, regexp_replace(regexp_replace(href, '#.*$', '', 's'), '\?.*$', '', 's') as href from plain),
    joined as (select page_id, url, regexp_replace(case when starts_with(href, '/') then regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1)
        || href else href end, '/+$', '/') as link
               from hrefs where href <> '')"""
REPORT = r"""report as (select page_id as page_number, url, case when page_id % 11 = 0 then null when page_id % 10 = 0 then 404 else 200 end as http_status_code,
    case when page_id % 11 <> 0 and page_id % 10 <> 0 then len(regexp_extract_all(regexp_replace(html, '(?s)<[^>]*>', ' ', 'g'), '[^""" + WS + r"""]+')) else 0 end as word_count from pages)"""


def sql_clean(c: str) -> str:
    return sql_strip(rf"regexp_replace(regexp_replace(regexp_replace({c}, '\.su[bp]\.', '', 'g'), '(?i){'|'.join(D.SCAFFOLD)}', ' ', 'g'), '[{WS}]+', ' ', 'g')")


def sql_paragraphs(*parts: str) -> str:
    return f"array_to_string(list_filter([{', '.join(sql_strip(p) for p in parts)}], lambda x: x <> ''), chr(10) || chr(10))"


#: The first three claims of the records' text.
SQL_CLAIMS = "'1. ' || t || chr(10) || '2 . ' || line || chr(10) || '3. third' || chr(10) || '4. fourth'"
SQL_CLAIMS = rf"list_transform(regexp_split_to_array({SQL_CLAIMS}, '(?m)^\s*\d+\s*\.\s*'), lambda x: {sql_strip('x')})"
SQL_CLAIMS = f"(select array_to_string(list_filter({SQL_CLAIMS}, lambda x: x <> '')[1:3], ' '))"
SQL_GLOSS = "'Technical field: preparations for medical purposes; microorganisms, enzymes, mutation, genetic engineering.'"
SQL_ABSTRACT = "'In one embodiment, FLT3.sup.ITD ' || t"
SQL_ARMS = "'Interventions: Dietary_Supplement: ' || name || '; Drug-Eluting: x'"
RECORDS = f"""d as (select doc_id as n, 'r' || doc_id as name, coalesce(text, '') as t, split_part(coalesce(text, ''), chr(10), 1) as line from documents),
    parsed as (
        select case when n % 2 = 0 then name end as doc_id, 'uspto_patent' as source, 'document' as side, {sql_strip('line')} as title,
               {sql_paragraphs('line', sql_clean(SQL_ABSTRACT), "substr(" + sql_clean(SQL_CLAIMS) + ", 1, 1800)", SQL_GLOSS)} as embedding_text,
               '' as source_url, null::double as topic_score, 'A61K31/00,A61K9/00,zz,C12N1/00|' || name || ',b' as extra from d where n % 4 = 0
        union all
        select case when n % 5 <> 0 then name else substr({sql_strip('line')}, 1, 40) end, 'clinicaltrials', 'query', {sql_strip('line')},
               {sql_paragraphs('line', sql_clean('t'), "'Conditions: a, b'", SQL_ARMS)},
               case when n % 5 <> 0 then 'https://clinicaltrials.gov/study/' || name else '' end, null, 'a,b|PHASE2' from d where n % 4 = 1
        union all
        select substr('https://x/' || name, 1, 80), 'listing', 'document', {sql_strip('line')},
               {sql_paragraphs('line', sql_clean("'As used herein, x'"), "substr(" + sql_clean('t') + ", 1, 1500)")},
               'https://x/' || name, (n % 10)::double, 'page' from d where n % 4 = 2)"""

ORACLES = {
    "crawl_safe_name": f"select page_id, {sql_name('url', 'page_id')} as name from pages",
    "crawl_extract_title": "select page_id, case when t = '' then '(no title)' else t end as title from (select page_id, "
    + sql_strip(sql_decode(f"regexp_extract({sql_shown('html')}, '(?is)<title[^>]*>(.*?)</title>', 1)"))
    + " as t from pages)",
    "crawl_links": (
        f"with {LINKS} select distinct page_id, link from joined where starts_with(link, 'http') "
        f"and regexp_matches({sql_host('link')}, '(^|\\.)example\\.(com|org)$')"
    ),
    "crawl_frontier": f"""with recursive {LINKS},
        edges as (select distinct regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') as source, regexp_replace(link, '/+$', '') as target
            from joined where starts_with(link, 'http') and regexp_matches({sql_host('link')}, '(^|\\.)example\\.(com|org|net)$')),
        walk(key, level) using key (key) as (
            select distinct regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), 0 from pages where page_id % 50 = 0
            union
            select e.target, min(w.level + 1) from walk w join edges e on e.source = w.key
            where e.target not in (select key from recurring.walk) group by e.target)
        select key, level from walk""",
    "crawl_kpis": (
        f"with {REPORT} select count(*) as total, count(*) filter (http_status_code = 200) "
        f"as success, round(count(*) filter (http_status_code = 200) * 100::double / count(*), 1) "
        f"as rate, floor(avg(word_count))::bigint as mean_words from report"
    ),
    "crawl_domains": f"select coalesce(nullif({sql_host('url')}, ''), 'Unknown') as domain, count(*) as pages from pages group by 1",
    "crawl_status": f"with {REPORT} select http_status_code, count(*) as pages from report where http_status_code is not null group by 1",
    "crawl_milestones": (
        f"with {REPORT} select m.m as milestone, count(*) filter (page_number <= m.m and http_status_code = 200) as success "
        f"from report, (select unnest([50, 100, 333, 1000])::bigint as m) m where m.m <= (select max(page_number) from report) "
        f"group by m.m"
    ),
    "report_join": (
        "with s as (select doc_id, case when doc_id % 7 = 0 then 'FAILED' when quality = 1 then 'SUCCESS' when toxic = 1 then '' else "
        "'FAILED' end as status from labels) select d.doc_id, s.status from documents d left join s using (doc_id) "
        "where s.status is null or s.status <> 'FAILED'"
    ),
    "url_and_origin": rf"""with s as (select page_id, url, replace({sql_name('url', 'page_id')}, '.', '_') as stem from pages)
        select page_id, 'https://' || replace(regexp_replace(stem, '^\d+_', ''), '_', '/') as url, 'https://arxiv.org/abs/'
            || printf('%04d.%05d', page_id, page_id) as paper,
               'https://ring.' || page_id || '.gov/about/x' as site, null::varchar as none,
               coalesce(nullif(regexp_replace(replace(substr(url, 1, 20), ' ', '_'), '[^A-Za-z0-9_-]', '', 'g'), ''), 'query') as slug,
               'web/' || stem || '#c' || lpad((page_id % 12)::varchar, 3, '0') as chunk_id from s""",
    "latin1_safe": r"select doc_id, sha1(regexp_replace(replace(replace(replace(replace(replace(replace(replace('“' || text || '”… — 🙂', '—', '-'), '–', '-'), '‘', ''''), '’', ''''), '“', '\"'), '”', '\"'), '…', '...'), '[^\x{00}-\x{FF}]', '', 'g')) as sha1 from documents".replace('\\"', '"'),
    "discovery_normalise": (
        f"with {RECORDS} select coalesce(doc_id, substr(title, 1, 40)) as doc_id, source, side, sha1(title) "
        f"as title_sha1, embedding_text, source_url, coalesce(topic_score, -1) as topic_score, extra from parsed "
        f"where embedding_text <> ''"
    ),
    "discovery_for_queries": (
        f"with {RECORDS} select source, side, count(*) as docs from parsed where embedding_text <> '' and side = 'document' "
        f"and (source <> 'listing' or topic_score >= 5) group by source, side"
    ),
    "discovery_summary": (
        "select lang, count(*) as docs, min(length(text)) as least, (list(length(text) order by length(text)))[count(*) // 2 + 1] "
        "as median, max(length(text)) as most, min(doc_id) as first_id, arg_min(split_part(coalesce(text, ''), chr(10), 1), doc_id) "
        "as first_title from documents group by lang"
    ),
}
