"""Readers for text folders, crawl reports, JSON lines, JSON trees and seed lists; all lazy, with fixed schemas."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.sources.folders import open_files
from corpuskit.sources.shared import drop, exists

REPORT = "page_number int, url string, http_status_code int, page_title string, html_filename string, txt_filename string, html_size_bytes bigint, word_count int, timestamp timestamp, status string"
CHUNK = "id string, source string, source_type string, title string, origin string, split string, chunk_index int, n_words int, content_hash string, tags array<string>, text string"
PAIR = "anchor string, positive_id string, positive string, source string"
GOLD = "id string, question string, reference_answer string, keywords array<string>"
SFT = "messages array<struct<role:string,content:string>>, meta struct<chunk_id:string,source:string,type:string,origin:string>"
BLOCKS = "doc string, page int, block_no int, text string"


def _address(path: str) -> Column:
    """A local path as ``input_file_name`` has it, with what an address can't hold escaped."""
    escaped = F.replace(path, F.lit("%"), F.lit("%25"))
    for c in ' "#<>?[\\]^`{|}':
        escaped = F.replace(escaped, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return F.regexp_replace(escaped, "^file:/+", "file:///")


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Text files as (path, stem, raw); order by path where order counts. Bad UTF-8 becomes replacement characters, which are dropped."""
    clean = lambda c: F.replace(F.make_valid_utf8(c), F.lit("�"), F.lit(""))
    opened = open_files(spark, folder, "*.txt")
    if opened is None:
        raw = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt").select(F.input_file_name().alias("path"), clean("value").alias("raw"))
    else:
        raw = opened.where("length > 0").select(_address("path").alias("path"), clean(F.col("content").cast("string")).alias("raw"))
    return raw.withColumn("stem", F.regexp_extract("path", r"([^/]*)\.txt$", 1))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A crawl report in CSV; a missing file is an empty report."""
    if not exists(spark, path):
        return spark.createDataFrame([], REPORT)
    return spark.read.schema(REPORT).option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").option("multiLine", True).option("escape", '"').csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: str, missing_ok: bool = False) -> DataFrame:
    """JSON lines; blank lines are skipped, lines that can't be read are left out."""
    if missing_ok and not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_json_tree(spark: SparkSession, folder: str) -> DataFrame:
    """All ``.json`` files below a folder as (path, json), but for those in a folder ``raw``."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    return files.select(F.input_file_name().alias("path"), F.col("value").alias("json")).where(~F.col("path").contains("/raw/"))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Text blocks taken from PDF files beforehand, in Parquet."""
    return spark.read.schema(BLOCKS).parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of a corpus that was written in a folder for each; the others' files are not read."""
    return spark.read.parquet(path).where(F.col("split") == split)


def read_attachments(spark: SparkSession, folder: str, kinds: str = "*.{txt,md}") -> DataFrame:
    """Files that a user attached, as (name, text); bytes that are no UTF-8 become replacement characters."""
    files = open_files(spark, folder, kinds)
    files = spark.read.format("binaryFile").option("pathGlobFilter", kinds).load(folder) if files is None else files.where("length > 0")
    return files.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), F.make_valid_utf8(F.col("content").cast("string")).alias("text"))


def lines_of_blocks(blocks: DataFrame) -> DataFrame:
    """(doc, page, block_no, line_no, line): the lines of each block of each page."""
    return blocks.select("doc", "page", "block_no", F.posexplode(F.split("text", "\r\n|[\n\r]")).alias("line_no", "line"))


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Addresses, one a line; blank lines and lines after ``#`` are left out."""
    line = F.trim("value")
    return spark.read.text(path).select(line.alias("url")).where((F.col("url") != "") & ~F.col("url").startswith("#"))


def read_or_compute(spark: SparkSession, path: str, make) -> DataFrame:
    """A table kept at ``path``, made and written there if it is missing or can't be read."""
    if exists(spark, path):
        try:
            kept = spark.read.parquet(path)
            kept.limit(1).collect()
            return kept
        except (AnalysisException, SparkRuntimeException, Py4JJavaError):
            drop(spark, path)
    make().write.parquet(path)
    return spark.read.parquet(path)


def documents_of_blocks(blocks: DataFrame, name: Column | None = None) -> DataFrame:
    """(doc, pages, title, text) of documents from their text blocks, in the order of page and block.

    The title is the first block, 120 characters at most; of a document without
    any text it is ``name`` (by default the document's).
    """
    filled = F.trim(F.coalesce("text", F.lit(""))) != ""
    ordered = F.sort_array(F.collect_list(F.when(filled, F.struct("page", "block_no", "text"))))
    rows = blocks.groupBy("doc").agg(F.count_distinct("page").alias("pages"), ordered.alias("b"))
    text = F.array_join("b.text", "\n")
    return rows.select("doc", "pages", F.coalesce(F.substring(F.get("b.text", F.lit(0)), 1, 120), F.col("doc") if name is None else name).alias("title"), text.alias("text"))


#: A document's file: pages of blocks, of which those of kind 0 hold text.
PAGES = "pages array<struct<blocks:array<struct<type:int,text:string>>>>"


def read_block_files(spark: SparkSession, folder: str, glob: str = "*.json") -> DataFrame:
    """Text blocks of documents' files, and a row for each file that has none, as (doc, page, block_no, text, audit).

    A file holds JSON with ``pages``, each with ``blocks`` of ``type`` and ``text``; blocks
    of type 0 with text count, numbered from 0 among the blocks of their page. A file
    without bytes, one that can't be read and one without text are a row with only
    ``doc`` (folder and name) and ``audit``; they stop nothing. Files that are not local are read by Spark, so any
    store will do; a file is read by one task.
    """
    files = open_files(spark, folder, glob, deep=True)
    if files is None:
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(folder)
        # Spark lists files without bytes, but hands them to no task.
        listed = spark.createDataFrame([(name,) for name in files.inputFiles()], "uri string")
        plain = F.regexp_replace(F.url_decode(F.replace("uri", F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
        empty = listed.select(plain.alias("path")).join(files.select(F.regexp_replace("path", "^file:/+", "file:/").alias("path")), "path", "left_anti")
        files = files.select("path", "length", "content").union(empty.select("path", F.lit(0).cast("bigint"), F.lit(None).cast("binary")))
    doc = lambda path: F.regexp_extract(path, r"([^/]*/[^/]*)$", 1)
    parsed = files.select(doc("path").alias("doc"), "length", F.from_json(F.make_valid_utf8(F.col("content").cast("string")), PAGES).alias("d"))
    blocks = F.flatten(
        F.transform(F.coalesce("d.pages", F.array()), lambda p, i: F.transform(F.coalesce(p["blocks"], F.array()), lambda b, j: F.struct(i.alias("page"), j.alias("block_no"), b["type"].alias("type"), b["text"].alias("text"))))
    )
    filled = F.filter(blocks, lambda b: (b["type"] == 0) & (F.trim(b["text"]) != ""))
    why = F.when(F.col("length") == 0, F.concat(F.lit("[FAIL] "), "doc", F.lit(": 0 bytes")))
    why = why.when(F.col("d.pages").isNull(), F.concat(F.lit("[FAIL] "), "doc", F.lit(": unreadable"))).when(F.size("filled") == 0, F.concat(F.lit("[WARN] "), "doc", F.lit(": no text extracted")))
    rows = parsed.withColumn("filled", filled).select("doc", why.alias("audit"), F.explode_outer("filled").alias("b"))
    return rows.select("doc", "b.page", "b.block_no", "b.text", "audit")


def audit_lines(spark: SparkSession, blocks: DataFrame, root: str, folders: list[str]) -> DataFrame:
    """The lines of an audit, in order: folders that are missing, and what ``read_block_files`` says of files."""
    lines = [f"[WARN] missing folder: {f}" for f in folders if not exists(spark, f"{root}/{f}")]
    missing = spark.createDataFrame([(x,) for x in lines], "audit string")
    return blocks.where("audit is not null").select("audit").union(missing).orderBy("audit")
