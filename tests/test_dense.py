"""Dense search on the grid against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskit.operators import dense, retrieval

ROW = "id bigint, v array<double>"


def frame(spark, m, first=0):
    return spark.createDataFrame([(first + i, [float(x) for x in r]) for i, r in enumerate(m)], ROW)


def clumps(rng, n, dim, spots=6, by=0.05):
    return rng.normal(size=(spots, dim))[rng.integers(0, spots, n)] + rng.normal(size=(n, dim)) * by


@pytest.mark.parametrize("dim", [1, 2, 16, 64])
@pytest.mark.parametrize("positive", [True, False])
def test_best_as_over_all_pairs(spark, dim, positive):
    rng = np.random.default_rng(dim)
    m, q = clumps(rng, 700, dim), rng.normal(size=(40, dim))
    m[5] = m[3] * 2  # ties
    sims = np.round((q / np.linalg.norm(q, axis=1)[:, None]) @ (m / np.linalg.norm(m, axis=1)[:, None]).T, 6)
    got = {}
    for r in retrieval.dense_top(frame(spark, q), frame(spark, m), 7, positive, digits=6).collect():
        got.setdefault(r["q"], []).append((r["rank"], r["score"], r["doc_id"]))
    for i in range(40):
        want = [(s, j) for s, j in sorted(zip(sims[i], range(700)), key=lambda x: (-x[0], x[1])) if s > 0 or not positive][:7]
        mine = sorted(got.get(i, []))
        assert [round(s, 6) for _, s, _ in mine] == pytest.approx([s for s, _ in want], abs=2e-6)
        if dim > 1:
            assert {j for _, s, j in mine if s > want[-1][0] + 1e-5} == {j for s, j in want if s > want[-1][0] + 1e-5}


def test_blocks_are_skipped_and_tasks_grow(spark):
    rng = np.random.default_rng(1)
    m = clumps(rng, 3000, 32, spots=40, by=0.01)
    near = m[::100] + rng.normal(size=(30, 32)) * 0.001
    cells = dense.search(frame(spark, near), frame(spark, m), 3, counts=True, block_bytes=32 * 8 * 20).collect()
    assert sum(r["pairs"] for r in cells) == 30 * 3000 and sum(r["compared"] for r in cells) < 0.5 * 30 * 3000
    assert len(cells) >= 4  # one dimension, one block of queries, yet many cells
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = dense.search(frame(spark, near), frame(spark, m), 3, block_bytes=32 * 8 * 20)
        assert "CartesianProduct" not in found._jdf.queryExecution().toString() and "NestedLoop" not in found._jdf.queryExecution().toString()
        assert found.where("score > 0.99").select("q").distinct().count() == 30
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("by", [0.01, 1.0])
def test_gold_ranks_as_counted(spark, by):
    rng = np.random.default_rng(4)
    m, q = clumps(rng, 500, 8, by=by), rng.normal(size=(25, 8))
    m[7] = m[11]
    gold = rng.integers(0, 500, 25)
    gold[:2] = 7, 11
    sims = np.round((q / np.linalg.norm(q, axis=1)[:, None]) @ (m / np.linalg.norm(m, axis=1)[:, None]).T, 9)
    asked = frame(spark, q).join(spark.createDataFrame([(i, int(g)) for i, g in enumerate(gold)], "id bigint, gold bigint"), "id")
    got = {r["q"]: r["rank"] for r in retrieval.gold_ranks(asked, frame(spark, m)).collect()}
    for i, g in enumerate(gold):
        assert got[i] == 1 + sum(s > sims[i, g] or s == sims[i, g] and j < g for j, s in enumerate(sims[i]) if j != g)


def test_odd_vectors_and_empty_sides(spark):
    nan = float("nan")
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [1.0, None]), (7, [1.0, 1.0, 1.0]), (8, [1e200, 1e200]), (9, [1e-200, 0.0])], ROW)
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [1.0, 1.0, 1.0]), (4, [1.0])], ROW)
    got = sorted((r["q"], r["doc_id"], round(r["score"], 6)) for r in retrieval.dense_top(q, v, 5).collect())
    assert got == [(1, 1, 1.0), (1, 8, round(0.5**0.5, 6)), (1, 9, 1.0), (3, 7, 1.0)]
    assert retrieval.dense_top(q.where("false"), v, 5).count() == 0 and retrieval.dense_top(q, v.where(F.lit(False)), 5).count() == 0
    assert retrieval.dense_top(q, v, None).count() == 4
