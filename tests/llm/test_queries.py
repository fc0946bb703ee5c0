"""The registered queries, with their parameters, against their SQL or brute force, at the smallest scale; the pipeline stage by stage."""

import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from corpuskit.llm import queries, quality
from tests.llm.test_operators import plain_print, plain_spans
from tests.llm.test_shingles import brute

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))


def test_all_are_registered():
    names = {f"op{n}" for n in range(1, 11)}
    assert {k.split("_")[0] for k in queries.QUERIES} == names and set(queries.ORACLES) < set(queries.QUERIES)
    assert set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, DATA)
    found = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted((tuple(r[names.index(c)] for c in sorted(names)) for r in found.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in sorted(names)) for r in df.collect()), key=repr) == want


def test_op2_packing(spark, texts, library):
    ids = {i: library.encode(t, add_special_tokens=False).ids + [0] for i, t in texts.items()}
    sums, pieces = {}, {}
    for p in queries.op2_packing(spark, DATA).collect():
        part = np.array(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]], "<u4")
        assert p["ids_crc32"] == zlib.crc32(part.tobytes()) and p["doc_tokens"] == len(ids[p["doc_id"]])
        sums.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        pieces.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
    for parts in (*sums.values(), *pieces.values()):
        parts.sort()
        assert [a for a, _ in parts] == list(np.cumsum([0] + [n for _, n in parts[:-1]]))
    assert {i: sum(n for _, n in parts) for i, parts in pieces.items()} == {i: len(t) for i, t in ids.items()}
    lengths = [sum(n for _, n in parts) for parts in sums.values()]
    partitions = len({s >> 40 for s in sums})
    assert max(lengths) == 1024 and sum(n < 1024 for n in lengths) <= partitions and len(lengths) <= sum(lengths) // 1024 + partitions


def test_op3_pii(spark, texts):
    for r in queries.op3_pii(spark, DATA).collect():
        base = plain_spans(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(k == x[0] for x in base) for k in ("email", "ip", "card", "phone")]
        every = [tuple(s.split(":")) for s in filter(None, r["spans"].split(","))]
        assert {(k, str(a), str(b)) for k, a, b in base} <= set(every) and len(every) == r["n_spans"] == len(base) + r["n_added"]


def test_op4_quality(spark, texts):
    rows = queries.op4_quality(spark, DATA).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)


def components(ids, linked):
    label = {i: i for i in ids}
    for a in ids:
        for b in ids:
            if a < b and label[a] != label[b] and linked(a, b):
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    return label


def test_op7_simhash(spark, texts):
    prints = {i: plain_print(t) for i, t in texts.items()}
    want = components(sorted(texts), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    got = queries.op7_simhash(spark, DATA).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{prints[i]:016x}", want[i]) for i in texts}


def test_op10_token_counts(spark, texts, library):
    rows = queries.op10_token_counts(spark, DATA).collect()
    assert len(rows) == len(texts)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for r in rows:
        t = texts[r["doc_id"]]
        n = count(t)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"], r["cut_tokens"]) == (len(t.encode()), n, n > 1024, count(t[:4096]))
        cut = r["limit_chars"]
        assert cut == len(t) if n <= 1024 else count(t[:cut]) <= 1024 < count(t[: cut + 1])


def test_pipeline_stage_by_stage(spark, library):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").cache()
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    model = quality.train(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    now = {r["doc_id"]: r for r in docs.collect()}

    def after(name, table):
        made = steps[name](spark, table, DATA)
        assert made.columns == docs.columns
        made = made.cache()
        return made, made.collect()

    table, rows = after("quality", docs)
    good = {i: r for i, r in now.items() if model is None or model.score(quality.ngrams(r["text"])) >= 0.7}
    assert {r["doc_id"]: r for r in rows} == good and len(rows) == len(good) < len(now)
    table, rows = after("exact_dedup", table)
    last = {}
    for i in sorted(good):
        last[good[i]["text"] or ""] = i
    assert {r["doc_id"]: r for r in rows} == {i: good[i] for i in last.values()}
    table, rows = after("near_dedup", table)
    sets = {i: brute(good[i]["text"]) for i in last.values()}
    roots = components(sorted(sets), lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    assert {r["doc_id"] for r in rows} == set(roots.values())
    kept = {r["doc_id"]: r for r in rows}
    table, rows = after("mixing", table)
    words = lambda t: len((t or "").encode().split())
    sizes, taken = {}, {}
    for i, r in kept.items():
        sizes[r["source"]] = sizes.get(r["source"], 0) + words(r["text"])
    for r in rows:
        taken[r["source"]] = taken.get(r["source"], 0) + words(r["text"])
        assert (kept[r["doc_id"]]["text"] or "").startswith(r["text"])
    assert abs(sum(taken.values()) - sum(sizes.values())) <= len(sizes) and all(n <= 3 * sizes[s] + 1 for s, n in taken.items())
    packed = steps["packing"](spark, table, DATA).collect()
    want = sorted((r["doc_id"], len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in rows)
    assert sorted((p["doc_id"], p["doc_tokens"]) for p in packed if p["start"] == 0) == want
    assert sum(p["length"] for p in packed) == sum(n for _, n in want)
