"""Writers: corpora, JSON lines, reports and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULE = "─" * 60


def write_corpus(chunks: DataFrame, path: str) -> None:
    """Parquet in a folder for each split, so that a split is read alone."""
    chunks.write.partitionBy("split").parquet(path)


def write_jsonl(rows: DataFrame, path: str, append: bool = False) -> None:
    rows.write.mode("append" if append else "errorifexists").json(path)


def append_pending(made: DataFrame, path: str) -> None:
    """Adds to what earlier runs wrote; with ``qa.pending`` a run goes on where the last one ended."""
    write_jsonl(made, path, append=True)


def page_file(url: Column, title: Column, text: Column) -> Column:
    """A crawled page as a text file: address, title, a ruler, the text."""
    return F.concat(F.lit("URL: "), url, F.lit("\nTitle: "), title, F.lit(f"\n{RULE}\n"), text)


def write_pages(pages: DataFrame, path: str) -> None:
    """Pages (url, title, text and, as it came, html) in Parquet: the page as a text file, and the raw page, one row each."""
    raw = [F.col("html")] if "html" in pages.columns else []
    pages.select("url", page_file(F.col("url"), F.col("title"), F.col("text")).alias("file"), *raw).write.parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    report.write.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").option("escape", '"').csv(path)


def audit_text(audit: DataFrame) -> DataFrame:
    """The one row of an audit as a line for each number."""
    lines = [F.concat(F.lit(f"{name:<16}: "), F.col(name).cast("string")) for name in audit.columns]
    return audit.select(F.array_join(F.array(*lines), "\n").alias("value"))


def write_audit(audit: DataFrame, path: str) -> None:
    audit_text(audit).write.text(path)


def milestones_json(milestones: DataFrame, kpis: DataFrame) -> DataFrame:
    """One row of JSON: successes at each milestone, all successes, all attempts."""
    one = milestones.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("milestone").cast("string"), "success")))).alias("milestones"))
    return one.join(F.broadcast(kpis)).select(F.to_json(F.struct("milestones", F.col("success").alias("total_success"), F.col("total").alias("total_attempted"))).alias("value"))


def submission_text(kpis: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """The one row of key figures as text; with ``files`` (one row: html, txt), how many files were kept of each form."""
    lines = [
        F.format_string("Pages attempted : %d", F.col("total")),
        F.format_string("Pages downloaded: %d", F.col("success")),
        F.format_string("Success rate    : %.1f %%", F.col("rate")),
        F.format_string("Mean words      : %d", F.coalesce("mean_words", F.lit(0))),
    ]
    if files is not None:
        kpis = kpis.join(F.broadcast(files.select("html", "txt")))  # one row
        lines += [F.format_string("HTML files      : %d", F.col("html")), F.format_string("Text files      : %d", F.col("txt"))]
    return kpis.select(F.array_join(F.array(*lines), "\n").alias("value"))


def file_counts(report: DataFrame) -> DataFrame:
    """How many pages of a crawl report have a file of each form; one row."""
    named = lambda c: F.count_if(F.trim(F.coalesce(c, F.lit(""))) != "")
    return report.agg(named("html_filename").alias("html"), named("txt_filename").alias("txt"))


def write_evaluation(rows: DataFrame, path: str) -> None:
    """The rows of an evaluation as JSON lines in ``rows``, and their number, alone, in ``summary``."""
    rows.write.json(f"{path}/rows")
    rows.agg(F.count("*").alias("n")).write.json(f"{path}/summary")


def cache_json(answers: DataFrame) -> DataFrame:
    """Answers kept by question, a JSON object for each; ``answers``: key, question, answer, sources."""
    return answers.select(F.to_json(F.struct(*answers.columns)).alias("value"))
