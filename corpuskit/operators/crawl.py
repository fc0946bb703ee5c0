"""Crawled pages: links, reachable addresses, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.functions import html as H
from corpuskit.functions import text as T
from corpuskit.sources.shared import new_path


def links(pages: DataFrame, domains: tuple[str, ...], id_col: str = "page_id") -> DataFrame:
    """Distinct allowed links of each page, (page id, url, link)."""
    found = pages.select(id_col, "url", F.explode(H.hrefs(F.col("html"))).alias("href")).withColumn("link", H.one_slash(H.resolve(F.col("url"), F.col("href"))))
    return found.where(F.col("link").startswith("http") & H.allowed(T.host(F.col("link")), domains)).select(id_col, "url", "link").distinct()


def url_key(c) -> object:
    return F.regexp_replace(c, "/+$", "")


def reachable(seeds: DataFrame, edges: DataFrame, hops: int = 16, deep: int = 8, narrow: int = 100_000) -> DataFrame:
    """All addresses reachable from seeds (column ``key``) over edges (source, target), with the level at which each is met first.

    Goes on until no new address is met, however many levels that takes. A round
    is one level, joined against what was visited. From level ``deep`` on, while
    few addresses are new, as in long chains, a round takes ``hops`` levels at
    once. Rounds are written as parts of one table, so that the plan doesn't grow
    with them. Null keys and ends are left out.
    """
    spark, root = seeds.sparkSession, new_path(seeds.sparkSession, "visited")
    edges = edges.where("source is not null and target is not null").select("source", "target")
    schema = f"key {seeds.schema['key'].dataType.simpleString()}, level int"

    def step(reached: DataFrame, level: int) -> DataFrame:
        """``reached`` and the neighbours of those at ``level``, each with its first level."""
        met = reached.join(edges, (reached.key == edges.source) & (reached.level == level), "left")
        both = F.array(F.struct("key", "level"), F.struct(F.col("target").alias("key"), F.lit(level + 1).alias("level")))
        return met.select(F.explode(both).alias("met")).select("met.*").where("key is not null").groupBy("key").agg(F.min("level").alias("level"))

    seeds.where("key is not null").select("key").distinct().withColumn("level", F.lit(0)).write.parquet(f"{root}/round-0")
    level, n = 0, 0
    while True:
        visited = spark.read.schema(schema).parquet(f"{root}/*")
        fresh = spark.read.schema(schema).parquet(f"{root}/round-{n}").where(F.col("level") == level)
        count = fresh.count()
        if not count:
            return visited
        if level < deep or count > narrow:
            found = fresh.join(edges, fresh.key == edges.source).select(F.col("target").alias("key")).distinct().withColumn("level", F.lit(level + 1))
            level += 1
        else:
            found = fresh
            for _ in range(hops):
                found = step(found, level)
                level += 1
        n += 1
        found.join(visited.select("key"), "key", "left_anti").write.parquet(f"{root}/round-{n}")


def latest_report(report: DataFrame, key: str = "txt_filename", order: str = "page_number") -> DataFrame:
    """One row for each file name, the last; blank names dropped. The aggregation needs no sort of a name's rows.

    Of rows with the same ``order`` the one whose other columns sort last counts.
    """
    named = report.where(F.trim(F.coalesce(F.col(key), F.lit(""))) != "")
    others = [c for c in report.columns if c != key]
    last = named.groupBy(F.trim(key).alias(key)).agg(F.max(F.struct(order, *(c for c in others if c != order))).alias("r"))
    return last.select(key, *(F.col(f"r.{c}").alias(c) for c in others))


def usable(docs: DataFrame, report: DataFrame, key: str = "txt_filename") -> DataFrame:
    """Documents but for those whose report has a status that isn't SUCCESS; those without a report stay."""
    status = F.upper(F.trim(F.coalesce("status", F.lit(""))))
    return docs.join(latest_report(report, key).select(key, "title", "url", status.alias("status")), key, "left").where(F.col("status").isNull() | F.col("status").isin("", "SUCCESS"))


def kpis(report: DataFrame) -> DataFrame:
    ok = F.count_if(F.col("status") == "SUCCESS")
    return report.agg(F.count("*").alias("total"), ok.alias("success"), F.round(F.coalesce(F.try_divide(ok * 100.0, F.count("*")), F.lit(0.0)), 1).alias("rate"), F.floor(F.avg("word_count")).cast("bigint").alias("mean_words"))


def by_domain(report: DataFrame) -> DataFrame:
    return report.groupBy(F.coalesce(T.host(F.col("url")), F.lit("Unknown")).alias("domain")).agg(F.count("*").alias("pages"))


def by_status(report: DataFrame) -> DataFrame:
    return report.where("http_status_code is not null").groupBy("http_status_code").agg(F.count("*").alias("pages"))


def milestones(report: DataFrame, at: tuple[int, ...] = (333, 666, 1000)) -> DataFrame:
    """Successes among the first m pages, for each m that was reached; one pass, no window."""
    counts = [F.struct(F.lit(m).cast("bigint").alias("milestone"), F.count_if((F.col("page_number") <= m) & (F.col("status") == "SUCCESS")).alias("success"), (F.max("page_number") >= m).alias("met")) for m in at]
    return report.agg(F.array(*counts).alias("all")).select(F.explode("all").alias("m")).where("m.met").select("m.milestone", "m.success")
