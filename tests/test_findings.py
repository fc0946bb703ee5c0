"""Faults that a review found on larger tables and odd rows, one test for each."""

import unicodedata

import pytest

from corpuskit.functions import html as H
from corpuskit.functions import text as T
from corpuskit.llm import queries
from corpuskit.operators import corpus, discovery
from corpuskit.plans import dialogue


def test_cached_answers_of_words_with_a_sharp_s(spark, tmp_path):
    """Capitals of ß are two letters, so the question in capitals missed its answer."""
    rows = [(c, 0, "user", text) for c, text in enumerate(("Große Straße", " große straße", "Été ñ", "été Ñ", "once", None))]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r["answer"] for r in dialogue.demo_cache_lookup(spark, str(tmp_path)).collect()}
    assert got == {0: "0:0", 1: "0:0", 2: "2:0", 3: "2:0", 4: None, 5: None}


@pytest.mark.parametrize("text", ["", "aß", "ŉ ﬁ É🙂é\n"])
def test_capitals_lead_back(spark, text):
    made = spark.createDataFrame([(text,)], "t string").select(T.capitals("t").alias("c")).first()["c"]
    assert made.lower() == text.lower() and made == "".join(c.upper() if len(c.upper()) == 1 else c for c in text)


#: The contract's rules as they are written there, and addresses with the rule that fits and its word.
CONTRACT = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
JUDGED = {
    "http://a.com/en/1": ("com/en/", "block"), "http://example.com/en/71": ("example.com/en/7", "allow"), "http://x.net/de/8": ("net/de/", "allow"),
    "https://spam.net/de/": ("net/de/", "allow"), "http://example.net/de/7": ("net/de/", "allow"), "http://b.example.net/de/81": ("example.net/de/8", "block"),
    "http://a.org/es/": ("org/es/", "block"), "http://a.org/de/": (None, "allow"), "http://spam.net/en/": (None, "block"),
}


def test_rules_are_those_of_the_contract(spark, tmp_path):
    assert tuple((v, h + p) for v, h, p in queries.URL_RULES) == CONTRACT
    spark.createDataFrame(list(enumerate(JUDGED)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op9_url_filter(spark, str(tmp_path)).collect()
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in got} == dict(enumerate(JUDGED.values()))


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_record_is_parsed_once(spark):
    """Filters on the parsed record and on its text had all of it computed for the filter and again for the result."""
    raw = spark.createDataFrame([('{"body": "b", "site": "s"}',), ("[1]",), (None,)], "json string").repartition(2)
    made = discovery.parse_records(raw)
    plan = optimized(made)
    assert plan.lower().count("parsejson") + plan.lower().count("parse_json") == 1, plan
    assert [r["embedding_text"] for r in made.collect()] == ["b"]


def test_compatibility_forms_of_many_rows(spark):
    """A batch is taken a few rows at a time; nulls and plain texts among them."""
    said = [None, "", "plain", "ﬁ Å ２", "x" * 3] * 150
    rows = spark.createDataFrame(list(enumerate(said)), "i int, t string").coalesce(1).select("i", H.nfkc("t").alias("n"))
    assert [r["n"] for r in rows.orderBy("i").collect()] == [t and unicodedata.normalize("NFKC", t) for t in said]
    assert "Pandas" not in optimized(rows) and H.NORMALISED < len(said)


def test_running_heads_are_found_in_one_pass(spark):
    """Lines were made four times and moved six times; now once each, for pages of blank lines and without a number as before."""
    rows = [(1, p, "Head") for p in (0, 1, None)] + [(1, p, " ") for p in range(2, 6)] + [(2, None, "Head"), (2, None, "head"), (2, 0, "head"), (3, 0, "Head"), (3, 1, "HEAD "), (3, 1, "Head"), (None, 0, "Head"), (None, 1, "Head"), (3, 1, None)]
    lines = spark.createDataFrame(rows, "doc_id long, page int, line string")
    found = corpus.repeated_lines(lines)
    assert sorted(map(tuple, found.collect())) == [(1, "head", 3), (3, "head", 3)]
    plan = optimized(found)
    assert "Join" not in plan and plan.count("LogicalRDD") + plan.count("LocalRelation") == 1, plan
