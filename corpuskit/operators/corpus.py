"""From raw texts to chunks: boilerplate, packing, deduplication, splits, audit."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuskit.functions import text as T
from corpuskit.sources.shared import materialise


def line_document_frequency(docs: DataFrame, lines_col: str = "lines") -> DataFrame:
    """How many documents have each line (once a document)."""
    return docs.select(F.explode(F.array_distinct(lines_col)).alias("line")).groupBy("line").agg(F.count("*").alias("df"))


def frequent_candidates(docs: DataFrame, lines: Column, share: float, at_once: int = 4096) -> DataFrame:
    """Hashes ``h`` of all lines that at least this share of the documents has, and some more.

    A line that is in the share of all documents is in the share of one of any parts
    that make up the whole. So each task counts its documents ``at_once`` at a time,
    and only what is frequent among those leaves it: at most (lines of a document) /
    share for each such part.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def frequent() -> pa.RecordBatch:
            values, times = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values[times >= share * n - 1e-6], pa.int64())], names=["h"])

        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                some = batch.column(0).slice(start, at_once)
                held.append(some.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
                n += len(some)
                if n >= at_once:
                    yield frequent()
                    held, n = [], 0
        if held:
            yield frequent()

    return docs.select(F.transform(F.array_distinct(lines), lambda x: F.xxhash64(x)).alias("hs")).mapInArrow(local, "h bigint").distinct()


def boilerplate_lines(docs: DataFrame, fraction: float = 0.30, most_words: int = 12, lines_col: str = "lines", at_once: int = 4096, most: int = 1 << 21) -> DataFrame:
    """Short lines of many documents, (line, df): at least max(2, int(n * fraction)) of the n documents.

    Only candidates are counted (see ``frequent_candidates``), so lines that are rare
    aren't shuffled; with more than ``most`` candidates, which very few documents in a
    task can give, all lines are.
    """
    n_docs = docs.count()
    cutoff = max(2, math.floor(n_docs * float(fraction)))
    short = F.filter(F.coalesce(lines_col, F.array().cast("array<string>")), lambda x: T.n_words(x) <= most_words)
    lines = docs.select(F.explode(F.array_distinct(short)).alias("line"))
    candidates = materialise(frequent_candidates(docs, short, cutoff / max(n_docs, 1), at_once), "candidates")
    if candidates.count() <= most:
        lines = lines.withColumn("h", F.xxhash64("line")).join(F.broadcast(candidates), "h", "left_semi")
    return lines.groupBy("line").agg(F.count("*").alias("df")).where(F.col("df") >= cutoff)


def strip_boilerplate(docs: DataFrame, boiler: DataFrame, lines_col: str = "lines") -> DataFrame:
    """Take the boilerplate lines out of each document's ``lines``, in place.

    Every such line is in a given share of all documents, so there are no more
    of them than a document has lines on average, divided by that share; the one
    row with all of them is small whatever the corpus, and documents don't move.
    """
    one = boiler.agg(F.collect_set("line").alias("boiler"))
    return docs.join(F.broadcast(one)).withColumn(lines_col, F.filter(lines_col, lambda x: ~F.array_contains("boiler", x))).drop("boiler")


def pack_lines(lines: Column, low: int = 350, high: int = 450, least: int = 50, merge_tail: bool = False) -> Column:
    """Greedy chunks (chunk_index, n_words, text) on line borders.

    A chunk is closed before a line that would take it over ``high`` words, once
    it has ``low``. A last chunk of fewer than ``least`` words is dropped or,
    with ``merge_tail``, joined to the one before. The fold keeps only where
    chunks begin.
    """
    sizes = F.transform(lines, lambda x: T.n_words(x).cast("int"))
    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("w"), F.array(F.lit(0)).alias("starts"))

    def step(s: Column, w: Column) -> Column:
        new = (s["w"] + w > high) & (s["w"] >= low)
        return F.struct((s["i"] + 1).alias("i"), F.when(new, w).otherwise(s["w"] + w).alias("w"), F.when(new, F.array_append(s["starts"], s["i"])).otherwise(s["starts"]).alias("starts"))

    def cut_all(state: Column) -> Column:
        starts = state["starts"]
        if merge_tail:
            starts = F.when((state["w"] < least) & (F.size(starts) > 1), F.slice(starts, F.lit(1), F.size(starts) - 1)).otherwise(starts)

        def cut(s: Column, k: Column) -> Column:
            part = F.slice(lines, s + 1, F.coalesce(F.get(starts, k + 1), F.size(lines)) - s)
            return F.struct(k.alias("chunk_index"), F.array_join(part, " ").alias("text"))

        return F.transform(starts, cut)

    made = F.filter(T.let(F.aggregate(sizes, zero, step), cut_all), lambda c: c["text"] != "")
    return made if merge_tail else F.filter(made, lambda c: T.n_words(c["text"]) >= least)


def chunks(docs: DataFrame, id_col: str = "doc_id", lines_col: str = "lines", **options) -> DataFrame:
    packed = docs.select(id_col, F.posexplode(pack_lines(F.col(lines_col), **options)).alias("pos", "c"))
    return packed.select(id_col, F.col("c.chunk_index").alias("chunk_index"), T.n_words(F.col("c.text")).cast("int").alias("n_words"), F.col("c.text").alias("text"))


def first_by_hash(rows: DataFrame, hash_col: str, *order: str) -> DataFrame:
    """Of rows with equal hashes the first in order stays.

    The aggregation meets copies before the shuffle; no window holds a group.
    """
    others = [c for c in rows.columns if c not in (hash_col, *order)]
    best = rows.groupBy(hash_col).agg(F.min(F.struct(*order, *others)).alias("best"))
    return best.select(*(F.col(hash_col) if c == hash_col else F.col(f"best.{c}") for c in rows.columns))


def junk_chunk(c: Column, paper: Column) -> Column:
    """Tables (few letters), and bibliographies of papers."""
    hits = F.regexp_count(c, F.lit(CITATION))
    return (T.alpha_ratio(c) < 0.35) | (paper & (hits >= 5) & (hits / F.greatest(T.n_words(c), F.lit(1)) * 100 >= 2))


#: What marks a citation, a reference heading and a page number (fixed values).
CITATION = r"\[\d{1,3}\]\s|arXiv:\d|\(\d{4}\)[,.]|Phys\.\s?Rev|JHEP\s"
REFERENCE_HEAD = r"(?i)^\s*(references|bibliography|literature\s+cited)\s*$"
REFERENCE_INLINE = r"(^|[^\p{L}\p{N}_])(References|REFERENCES|Bibliography|Literature\s+Cited|LITERATURE\s+CITED)($|[^\p{L}\p{N}_])"
PAGE_NUMBER = r"(?i)^\s*(page\s*)?\d{1,4}\s*$"
#: Navigation entries and footers of web sites, by whole line and by expression (fixed values). A site's own names are the caller's to add.
NAVIGATION = (
    "subscribe to our newsletters", "about", "community", "newsroom", "contact", "resources", "for employees", "for industry", "jobs", "science", "home", "phone book",
    "people", "news", "how it works", "for neighbors and businesses", "for the teams", "particle physics 101", "particle physics", "particle accelerators",
    "security, privacy, legal | use of cookies", "detectors, computing,", "quantum",
)
FOOTER = r"(?i)we bring the world together"


def cut_references(blocks: DataFrame, id_col: str = "doc_id", pos_col: str = "pos", text_col: str = "block") -> DataFrame:
    """Cut papers at their references; blocks are numbered from 0 within each document.

    A block that is the heading ends the text. So does a heading inside a block
    past 40 % of the blocks, of which the text before it stays if it has more
    than 15 words. Past 60 %, blocks of 3 or more citations are dropped.
    """
    w = W.partitionBy(id_col)
    b, pos = F.col(text_col), F.col(pos_col)
    n = F.count("*").over(w)
    inline = b.rlike(REFERENCE_INLINE) & (pos > n * F.lit(0.4))
    head = b.rlike(REFERENCE_HEAD)
    marked = blocks.withColumn("n_blocks", n).withColumn("ends", head | inline)
    stop = F.min(F.when(F.col("ends"), pos)).over(w)
    before = T.strip(F.substring_index(F.regexp_replace(b, "(?s)" + REFERENCE_INLINE + ".*$", "$1\u0000"), "\u0000", 1))
    marked = marked.withColumn("stop", stop)
    cut = (pos == F.col("stop")) & ~head
    kept = marked.where(F.col("stop").isNull() | (pos < F.col("stop")) | (cut & (T.n_words(before) > 15)))
    kept = kept.where(cut | ~((pos > F.col("n_blocks") * F.lit(0.6)) & (F.regexp_count(b, F.lit(CITATION)) >= 3)))
    return kept.select(id_col, pos_col, F.when(cut, before).otherwise(b).alias(text_col))


def repeated_lines(lines: DataFrame, id_col: str = "doc_id", page_col: str = "page", line_col: str = "line") -> DataFrame:
    """Running heads: lines on at least max(2, 40 % of the pages, rounded half to even) of a document of several pages.

    Lines count once a page as they stand, and are then put together in lower case.
    """
    # One shuffle, by document; all that follows stays inside its partition, and lines are made once. Pages of blank lines count as pages.
    seen = lines.select(id_col, page_col, F.col(line_col).alias("_line")).where(F.col(id_col).isNotNull()).repartition(id_col).distinct()
    numbered = seen.withColumn("_page", F.dense_rank().over(W.partitionBy(id_col).orderBy(page_col)))
    # A document whose pages have no number has none.
    numbered = numbered.withColumn("_page", F.when(F.col(page_col).isNotNull(), F.col("_page")))
    unnumbered = F.max(F.col(page_col).isNull()).over(W.partitionBy(id_col)).cast("int")
    numbered = numbered.withColumn("pages", F.max("_page").over(W.partitionBy(id_col)) - unnumbered).where("pages > 1")
    counts = numbered.where(T.strip(F.col("_line")) != "").groupBy(id_col, F.lower(T.strip(F.col("_line"))).alias("key")).agg(F.count("*").alias("df"), F.first("pages").alias("pages"))
    return counts.where((F.col("df") >= F.greatest(F.lit(2), F.bround(F.col("pages") * F.lit(0.4)))) & (F.length("key") > 2)).select(id_col, "key", "df")


def keep_line(line: Column, navigation=NAVIGATION, footer: str = FOOTER) -> Column:
    """Whether a line is no navigation entry, footer, page number or strip of separators."""
    low = F.lower(T.strip(line))
    return (low != "") & ~low.isin(*navigation) & ~low.rlike(footer) & ~line.rlike(PAGE_NUMBER) & (T.strip(F.replace(low, F.lit("|"), F.lit(""))) != "")


def filter_lines(lines: DataFrame, id_col: str = "doc_id", page_col: str = "page", line_col: str = "line", **rules) -> DataFrame:
    """Lines of pages without those that ``keep_line`` refuses and those repeated on many pages of their document."""
    heads = repeated_lines(lines, id_col, page_col, line_col).select(F.col(id_col).alias("_doc"), F.col("key").alias("_key"))
    kept = lines.where(keep_line(F.col(line_col), **rules))
    return kept.join(heads, (F.col(id_col) == F.col("_doc")) & (F.lower(T.strip(F.col(line_col))) == F.col("_key")), "left_anti")


def file_audit(made: DataFrame, kept: DataFrame, files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A row for each file: ``pages``, ``kept`` and ``dups`` (chunks that stayed, and that were copies), ``split``, and a line of text.

    ``made`` and ``kept`` are chunks before and after copies went (by id);
    ``files`` has the id, ``pages`` and ``split``. Files without chunks have a row.
    """
    both = made.select(F.col(id_col).alias("_doc"), F.lit(1).alias("m"), F.lit(0).alias("k")).union(kept.select(id_col, F.lit(0), F.lit(1)))
    sums = both.groupBy("_doc").agg(F.sum("m").alias("m"), F.sum("k").alias("k"))
    rows = files.join(sums, F.col(id_col) == F.col("_doc"), "left").select(id_col, "pages", "split", F.coalesce("k", F.lit(0)).alias("kept"), F.coalesce(F.col("m") - F.col("k"), F.lit(0)).alias("dups"))
    shown = F.format_string("[ OK ] %s: %dp -> %d chunks (%d dups dropped) [%s]", F.col(id_col).cast("string"), "pages", "kept", "dups", "split")
    return rows.withColumn("line", shown)


def build_corpus(docs: DataFrame, source: str = "web", source_type: str = "webpage_text", fraction: float = 0.30, id_col: str = "doc_id", text_col: str = "text", title: Column | None = None, origin: Column | None = None) -> DataFrame:
    """Chunks with ids, hashes and a leakage-safe split, exact copies removed.

    Lines of many documents go first; a chunk stays where it stands first by
    document and place, and keeps its number there.
    """
    stem = F.col(id_col).cast("string")
    # The condition is on the text, so that lines are taken once where they are needed and not at all to count documents.
    lined = docs.where(T.has_text(F.col(text_col))).select(F.col(id_col).alias("doc_id"), T.lines(F.col(text_col)).alias("lines"), (stem if title is None else title).alias("title"), (T.url_from_stem(stem) if origin is None else origin).alias("origin"))
    body = strip_boilerplate(lined, boilerplate_lines(lined, fraction))
    packed = body.select("doc_id", "title", "origin", F.explode(pack_lines(F.col("lines"))).alias("c"))
    rows = packed.select("doc_id", F.col("c.chunk_index").alias("chunk_index"), "title", "origin", F.col("c.text").alias("text"))
    rows = rows.withColumn("content_hash", T.content_hash(F.col("text")))
    rows = first_by_hash(rows, "content_hash", "doc_id", "chunk_index")
    name = F.col("doc_id").cast("string")
    return rows.select(
        F.concat(F.lit(f"{source}/"), name, F.lit("#c"), F.lpad(F.col("chunk_index").cast("string"), 3, "0")).alias("id"),
        F.lit(source).alias("source"), F.lit(source_type).alias("source_type"), "title", "origin", T.split_sha1(name).alias("split"),
        "chunk_index", T.n_words(F.col("text")).cast("int").alias("n_words"), "content_hash", F.array(F.lit(source_type), F.lit(source)).alias("tags"), "text",
    )


def audit(docs: DataFrame, corpus: DataFrame, fraction: float = 0.30, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row: files, usable, skipped, boilerplate lines, chunks, and chunks of each split."""
    filled = T.has_text(F.col(text_col))
    usable = docs.where(filled).select(F.col(id_col).alias("doc_id"), T.lines(F.col(text_col)).alias("lines"))
    files = docs.agg(F.count("*").alias("files"), F.count_if(filled).alias("usable"))
    boiler = boilerplate_lines(usable, fraction).agg(F.count("*").alias("boilerplate"))
    made = corpus.agg(F.count("*").alias("chunks"), F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "test").alias("test"))
    return files.join(F.broadcast(boiler)).join(F.broadcast(made)).withColumn("skipped", F.col("files") - F.col("usable"))
