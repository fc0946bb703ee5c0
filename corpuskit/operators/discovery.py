"""Three kinds of JSON records (patents, clinical trials, listings) as one schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuskit.functions.text import blank_if_null, strip

#: Phrases that nearly every patent has (fixed values).
SCAFFOLD = (
    "the present invention relates to",
    "in one embodiment",
    "in another embodiment",
    "in a preferred embodiment",
    "according to (?:the|one|an) (?:aspect|embodiment)",
    "cross[- ]reference to related applications?",
    "field of the invention",
    "background of the invention",
    "brief description of the drawings?",
    "detailed description of the (?:invention|embodiments?)",
    "it (?:is|will be) (?:understood|appreciated) that",
    "as used herein,?",
    "without departing from the (?:scope|spirit)",
)
#: What classes of patents are about (fixed values).
CPC = {
    "A61K": "preparations for medical purposes",
    "A61P": "therapeutic activity of compounds",
    "A61B": "diagnosis, surgery, identification",
    "C07K": "peptides",
    "C07D": "heterocyclic compounds",
    "C12N": "microorganisms, enzymes, mutation, genetic engineering",
    "C12Q": "measuring or testing involving nucleic acids",
    "G01N": "investigating or analysing materials",
    "A01K": "animal husbandry; model organisms",
    "C12P": "fermentation or enzyme processes",
}
PATENT = (
    "struct<title:string,abstract:string,claims:string,claims_excerpt:string,cpc_codes:array<string>,document_id:string,patent_number:string,"
    "source_url:string,retrieved_date:string,assignees:array<string>,pharma_label_type:string,publication_date:string>"
)
TRIAL = (
    "struct<protocolSection:struct<identificationModule:struct<nctId:string,briefTitle:string,officialTitle:string>,"
    "descriptionModule:struct<briefSummary:string>,conditionsModule:struct<conditions:array<string>,keywords:array<string>>,"
    "armsInterventionsModule:struct<interventions:array<struct<type:string,name:string>>>,designModule:struct<phases:array<string>>>,"
    "derivedSection:struct<miscInfoModule:struct<versionHolder:string>>>"
)
LISTING = "struct<title:string,excerpt:string,body:string,url:string,date:string,site:string,content_type:string,topic_score:double>"


def clean(text: Column) -> Column:
    t = F.regexp_replace(blank_if_null(text), r"\.su[bp]\.", "")
    t = F.regexp_replace(t, "(?i)" + "|".join(SCAFFOLD), " ")
    return strip(F.regexp_replace(t, r"[\s\x0b\x1c-\x1f\x85\p{Z}]+", " "))


def first_claims(text: Column, n: int = 3, most_chars: int = 1800) -> Column:
    parts = F.filter(F.transform(F.split(blank_if_null(text), r"(?m)^\s*\d+\s*\.\s*"), strip), lambda p: p != "")
    return F.substring(clean(F.when(F.size(parts) > 0, F.array_join(F.slice(parts, 1, n), " ")).otherwise(blank_if_null(text))), 1, most_chars)


def join_filled(*parts: Column) -> Column:
    return F.array_join(F.filter(F.transform(F.array(*parts), lambda p: strip(blank_if_null(p))), lambda p: p != ""), "\n\n")


def cpc_gloss(codes: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in CPC.items() for x in pair))
    found = F.array_distinct(F.array_compact(F.transform(codes, lambda c: F.try_element_at(table, F.regexp_extract(blank_if_null(c), r"^([A-Z]\d{2}[A-Z])", 1)))))
    return F.when(F.size(F.coalesce(found, F.array().cast("array<string>"))) > 0, F.concat(F.lit("Technical field: "), F.array_join(found, "; "), F.lit("."))).otherwise("")


def title_case(word: Column) -> Column:
    """Every run of letters with a capital first, after whatever isn't a letter, as in ``DRUG-ELUTING_2nd``: ``Drug-Eluting_2Nd``."""
    runs = F.regexp_extract_all(F.lower(blank_if_null(word)), F.lit(r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 30))), "")


def _first_filled(*options: Column) -> Column:
    return F.coalesce(*(F.when(o != "", o) for o in options), F.lit(""))


def parse_records(raw: DataFrame, json_col: str = "json") -> DataFrame:
    """One row for each record that can be read, in one schema.

    doc_id, source, side, title, embedding_text, source_url, retrieved_date and
    topic_score; of patents also cpc_codes, assignees, label_type and
    publication_date, of trials conditions and phases, of listings content_type
    (null for the others).

    A record with ``protocolSection`` is a trial, else with ``claims`` or
    ``cpc_codes`` a patent, else with ``body`` and ``site`` a listing; others,
    broken JSON, what isn't an object, and records without text are left out.
    A record is parsed once; each kind then takes its own fields from the result.
    """
    c = F.col
    has = lambda k: F.try_variant_get("v", f"$.{k}", "variant").isNotNull()
    kind = F.when(has("protocolSection"), "clinicaltrials").when(has("claims") | has("cpc_codes"), "uspto_patent").when(has("body") & has("site"), "listing")
    # Filters on what an explode makes stay above it, so that nothing is computed once for the filter and once more for the result.
    rows = raw.select(F.explode(F.array(F.try_parse_json(json_col))).alias("v")).where("v is not null")
    rows = rows.select("v", F.explode(F.array(kind)).alias("source")).where("source is not null")
    taken = lambda source, schema: F.when(c("source") == source, F.try_variant_get("v", "$", schema))
    kinds = [taken("uspto_patent", PATENT).alias("p"), taken("clinicaltrials", TRIAL).alias("t"), taken("listing", LISTING).alias("l")]
    rows = rows.select("source", *kinds, has("url").alias("has_url"))
    p_title, l_title = strip(blank_if_null(c("p.title"))), strip(blank_if_null(c("l.title")))
    claims = first_claims(_first_filled(c("p.claims"), c("p.claims_excerpt")))
    patent = join_filled(p_title, clean(c("p.abstract")), claims, cpc_gloss(c("p.cpc_codes")))
    s = "t.protocolSection."
    conditions, keywords = c(s + "conditionsModule.conditions"), c(s + "conditionsModule.keywords")
    nct = blank_if_null(c(s + "identificationModule.nctId"))
    t_title = strip(_first_filled(c(s + "identificationModule.briefTitle"), c(s + "identificationModule.officialTitle")))

    def listed(label: str, values: Column) -> Column:
        said = F.coalesce(F.array_join(values, ", "), F.lit(""))
        return F.when(said != "", F.concat(F.lit(label), said)).otherwise("")

    def arm(i: Column) -> Column:
        return F.regexp_replace(F.concat(title_case(i["type"]), F.lit(": "), i["name"]), "^[: ]+|[: ]+$", "")

    named = F.filter(c(s + "armsInterventionsModule.interventions"), lambda i: blank_if_null(i["name"]) != "")
    arms = F.array_join(F.transform(named, arm), "; ")
    arms = F.when(blank_if_null(arms) != "", F.concat(F.lit("Interventions: "), arms)).otherwise("")
    summary_text = clean(c(s + "descriptionModule.briefSummary"))
    trial = join_filled(t_title, summary_text, listed("Conditions: ", conditions), listed("Keywords: ", keywords), arms)
    listing = join_filled(l_title, clean(c("l.excerpt")), F.substring(clean(c("l.body")), 1, 1500))
    pick = lambda a, b, d: F.when(c("source") == "uspto_patent", a).when(c("source") == "clinicaltrials", b).otherwise(d)
    patent_id = _first_filled(c("p.document_id"), c("p.patent_number"), F.substring(p_title, 1, 40))
    listing_id = F.substring(F.when(c("has_url"), blank_if_null(c("l.url"))).otherwise(blank_if_null(c("l.title"))), 1, 80)
    trial_url = F.when(nct != "", F.concat(F.lit("https://clinicaltrials.gov/study/"), nct)).otherwise("")
    version = blank_if_null(c("t.derivedSection.miscInfoModule.versionHolder"))
    made = F.struct(
        pick(patent_id, _first_filled(nct, F.substring(t_title, 1, 40)), listing_id).alias("doc_id"),
        F.col("source"),
        pick(F.lit("document"), F.lit("query"), F.lit("document")).alias("side"),
        pick(p_title, t_title, l_title).alias("title"),
        pick(patent, trial, listing).alias("embedding_text"),
        pick(blank_if_null(c("p.source_url")), trial_url, blank_if_null(c("l.url"))).alias("source_url"),
        pick(blank_if_null(c("p.retrieved_date")), version, blank_if_null(c("l.date"))).alias("retrieved_date"),
        F.when(c("source") == "listing", F.coalesce(c("l.topic_score"), F.lit(0.0))).alias("topic_score"),
        c("p.cpc_codes").alias("cpc_codes"),
        c("p.assignees").alias("assignees"),
        c("p.pharma_label_type").alias("label_type"),
        c("p.publication_date").alias("publication_date"),
        conditions.alias("conditions"),
        c(s + "designModule.phases").alias("phases"),
        c("l.content_type").alias("content_type"),
    )
    made = rows.select(F.explode(F.array(made)).alias("made")).select("made.*")
    return made.where(strip(F.col("embedding_text")) != "")


def for_queries(docs: DataFrame, side: str = "document", least_score: float = 5) -> DataFrame:
    """Records of a side; listings only from a topic score on."""
    return docs.where((F.col("side") == side) & ((F.col("source") != "listing") | (F.col("topic_score") >= least_score)))


def summary(docs: DataFrame, group: str, text_col: str, id_col: str, title_col: str | None = None) -> DataFrame:
    """Counts, lengths (least, upper median, most) and the first record of each group by id: its id and, if named, its title.

    The median is read off counts of lengths, which are few; no group is collected.
    """
    title = F.lit(None).cast("string") if title_col is None else F.col(title_col)
    first = F.min(F.struct(id_col, title.alias("title")))
    lengths = docs.groupBy(group, F.length(text_col).cast("bigint").alias("n")).agg(F.count("*").alias("c"), first.alias("first"))
    run = F.sum("c").over(W.partitionBy(group).orderBy("n"))
    total = F.sum("c").over(W.partitionBy(group))
    marked = lengths.withColumn("run", run).withColumn("total", total)
    median = F.min(F.when(F.col("run") > F.floor(F.col("total") / 2), F.col("n")))
    lengths = [F.min("n").alias("least"), median.alias("median"), F.max("n").alias("most")]
    made = marked.groupBy(group).agg(F.sum("c").alias("docs"), *lengths, F.min("first").alias("first"))
    named = [F.col(f"first.{id_col}").alias("first_id")] + ([] if title_col is None else [F.col("first.title").alias("first_title")])
    return made.select(group, "docs", "least", "median", "most", *named)
