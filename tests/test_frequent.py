"""Frequent lines and shared grams against plain counting, on tables made to defeat what finds them."""

import random

import pytest
from pyspark.sql import functions as F

from corpuskit.operators import corpus as C
from corpuskit.operators import qa


def plain_boilerplate(docs, fraction, most_words):
    counts = {}
    for lines in docs:
        for x in {x for x in lines or () if len(x.split()) <= most_words}:
            counts[x] = counts.get(x, 0) + 1
    cutoff = max(2, int(len(docs) * fraction))
    return {x: n for x, n in counts.items() if n >= cutoff}


@pytest.mark.parametrize("at_once, most, fraction", [(1, 1 << 21, 0.3), (3, 1 << 21, 0.3), (7, 1 << 21, 0.05), (4096, 1 << 21, 0.3), (3, 1, 0.3), (5, 1 << 21, 1.0)])
def test_boilerplate_lines_are_those_of_the_full_count(spark, at_once, most, fraction):
    """Lines at the share and one below it, all in one part or one in each, with repeats, nulls and long lines among them."""
    rng = random.Random(at_once)
    docs = [[f"own {i}", *rng.sample([f"line {k}" for k in range(12)], rng.randint(0, 12))] for i in range(50)]
    cutoff = max(2, int(60 * fraction))
    for i in range(cutoff):  # exactly enough, in neighbours; one fewer; spread
        docs[i % 50].append("at the share")
        docs[-1 - i % 50].append("spread" if i % 2 else "at the share again")
        if i:
            docs[i % 50].append("one too few")
    docs = [[*d, d[0]] for d in docs] + [[], None, ["x " * 13] * 2] + [["the same line"] * 3] * 7
    table = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "doc_id long, lines array<string>").repartition(3)
    found = {r["line"]: r["df"] for r in C.boilerplate_lines(table, fraction, 12, at_once=at_once, most=most).collect()}
    assert found == plain_boilerplate(docs, fraction, 12)


def test_boilerplate_lines_of_nothing(spark):
    assert C.boilerplate_lines(spark.createDataFrame([], "doc_id long, lines array<string>")).count() == 0


def test_rare_lines_are_not_candidates(spark):
    """Of 3000 documents with 20 lines of their own each, only the common line leaves the tasks."""
    docs = spark.range(0, 3000, 1, 2).select(F.concat(F.array(F.lit("common")), F.transform(F.sequence(F.lit(1), F.lit(20)), lambda k: F.concat_ws(" ", "id", k))).alias("lines"))
    assert C.frequent_candidates(docs, F.col("lines"), 0.3, 500).count() == 1
    assert [tuple(r) for r in C.boilerplate_lines(docs).collect()] == [("common", 3000)]


HASHES = {"xxhash64": F.xxhash64, "three values": lambda c: F.pmod(F.xxhash64(c), F.lit(3)), "one value": lambda c: F.lit(7).cast("bigint") + F.length(c) * 0}


@pytest.mark.parametrize("hashed", HASHES)
@pytest.mark.parametrize("most", [1 << 21, 0])
def test_contamination_with_collisions(spark, hashed, most):
    rng = random.Random(29)
    words = [f"w{k}" for k in range(6)]
    said = lambda n: " ".join(rng.choices(words, k=n))
    rows = [(i, said(rng.randint(0, 30))) for i in range(60)] + [(60, None), (61, ""), (None, said(20)), (5, said(9))]
    gold = [(said(12),) for _ in range(6)] + [(None,), ("too short",), (rows[3][1],)]
    grams = lambda t: {tuple(w[i : i + 4]) for w in [(t or "").split()] for i in range(len(w) - 3)}
    wanted = set().union(*(grams(t) for (t,) in gold))
    left = spark.createDataFrame(rows, "id long, text string").repartition(3)
    found = qa.contaminated_ids(left, spark.createDataFrame(gold, "text string"), "id", "text", n=4, hashed=HASHES[hashed], most=most)
    want = {i for i, t in rows if grams(t) & wanted}
    assert {r["id"] for r in found.collect()} == want and 0 < len(want) < len(rows)


def test_only_hits_leave_the_scan(spark):
    """Grams of rows are not shuffled, whatever the threshold of broadcasts; hits are as many as the grams that are shared."""
    text = F.concat_ws(" ", *(F.concat(F.lit(f"t{k}x"), "id") for k in range(30)))
    rows = spark.range(0, 500, 1, 3).select("id", text.alias("text"))
    gold = rows.where("id in (3, 77)")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits, _ = qa.gram_hits(rows, gold, "id", "text")
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert hits.count() == 2 * 23 and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
