"""Centroids, toxicity and spelling variants against brute force, held-out rows and odd input."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskit.llm import centroids, queries, spelling, toxicity

SMALL = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- centroids


def lloyd(ids, rows, k, rounds, seed=3):
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), tuple(r)) for i, r in zip(ids, rows) if i is not None)[:k]
    centres = np.array([c for _, c in order], dtype=object)
    for turn in range(rounds + 1):
        far = np.array([[sum((a - b) ** 2 for a, b in zip(r, c)) for c in centres] for r in rows])
        found = far.argmin(1)
        if turn < rounds:
            for c in range(len(centres)):
                mine = [r for r, f in zip(rows, found) if f == c]
                if mine:
                    centres[c] = [sum(x) // len(mine) for x in zip(*mine)]
    return found, far[np.arange(len(rows)), found], centres


@pytest.mark.parametrize("block, leaf, clumps", [(32, 2, 5), (2048, 16, 3), (50, 1, 40)])
def test_clusters_as_over_all_pairs(spark, block, leaf, clumps):
    rng = np.random.default_rng(clumps)
    spots = rng.normal(size=(clumps, 6))
    rows = [(spots[i % clumps] + rng.normal(size=6) * (0.02 if i % 3 else 0)).tolist() for i in range(300)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "vec_id long, embedding array<double>").repartition(3)
    got = {r["vec_id"]: r for r in centroids.cluster(df, k=7, rounds=4, dimension=6, block=block, leaf=leaf).collect()}
    whole = [[int(np.floor(1024 * x)) for x in r] for r in rows]
    found, far, centres = lloyd(range(300), whole, 7, 4)
    assert [got[i]["cluster"] for i in range(300)] == found.tolist()
    assert [got[i]["distance"] for i in range(300)] == far.tolist()
    assert got[0]["inertia"] == sum(far) and got[5]["cluster_inertia"] == sum(d for d, f in zip(far, found) if f == found[5])
    assert got[0]["centroid_sha256"] == hashlib.sha256(",".join(map(str, centres[found[0]])).encode()).hexdigest()


def test_tree_covers_its_rows_and_search_prunes():
    rng = np.random.default_rng(0)
    spots = rng.integers(-2000, 2000, (12, 8))
    rows = spots[rng.integers(0, 12, 1500)] + rng.integers(-20, 20, (1500, 8))
    tree = centroids.CoverTree.build(rows, 4)
    assert sorted(tree.order) == list(range(1500))
    for i in range(len(tree.centre)):
        own = rows[tree.order[tree.first[i] : tree.last[i]]]
        assert np.sqrt(centroids.squared(own, rows[tree.centre[i]][None])).max() <= tree.radius[i] + 1e-9
        kids = range(tree.kid[i], tree.end[i])
        assert all(tree.radius[k] <= tree.radius[i] / 2 for k in kids)
        middle = rows[tree.centre[list(kids)]]
        assert all(np.sqrt(((a - b) ** 2).sum()) > tree.radius[i] / 2 for n, a in enumerate(middle) for b in middle[:n])
    found, compared = centroids.search(tree, rows, spots, centroids.CoverTree.build(spots, 1))
    far = ((rows[:, None] - spots[None]) ** 2).sum(2)
    assert (found == far.argmin(1)[tree.order]).all()
    assert compared < 0.05 * far.size  # clumps are assigned as nodes


def test_ties_go_to_the_smaller_centroid():
    rows = np.array([[0, 0], [10, 0], [5, 0], [5, 3], [5, 0]] * 4)
    centres = np.array([[10, 0], [0, 0], [0, 0], [10, 0]])
    found, _ = centroids.search(centroids.CoverTree.build(rows, 1), rows, centres, centroids.CoverTree.build(centres, 1))
    order = centroids.CoverTree.build(rows, 1).order
    assert (found == ((rows[:, None] - centres[None]) ** 2).sum(2).argmin(1)[order]).all()


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.5], 7), (2, None, 7), (3, [], 7), (4, [1.0], 7), (5, [1.0, None], 7), (6, [nan, 0.0], 7), (7, [inf, 0.0], 7), (8, [-inf, 0.0], 7), (None, [0.25, 0.5], 7), (1, [0.5, 0.5], 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int")
    got = centroids.cluster(df, dimension=2).collect()
    assert sorted((str(r["vec_id"]), r["cluster"]) for r in got) == [("1", 1), ("1", 1), ("None", 0)]  # two equal centroids at first
    assert centroids.cluster(df.where("vec_id > 8"), dimension=2).count() == 0
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>"), dimension=2).collect()


# ---------------------------------------------------------------- toxicity


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    net = toxicity.Network.start(3)
    found = toxicity.places([f"w{i}x{i * 7}" for i in range(40)])
    at, length = rng.integers(0, 40, (5, toxicity.SPAN)), np.array([toxicity.SPAN, 5, 0, 17, toxicity.SPAN])
    y = np.array([1.0, 0, 1, 0, 1])

    def loss():
        logit, _ = net.read(net.project(net.embed(found)), at, length)
        return float((np.log1p(np.exp(logit.astype(float))) - y * logit).sum())

    x = net.embed(found)
    gates = net.project(x)
    logit, kept = net.read(gates, at, length, keep=True)
    g, d_gates = net.back(gates, at, kept, (toxicity.sigmoid(logit) - y).astype(np.float32))
    g["input"], g["gate"] = np.matmul(x.T, d_gates), d_gates.sum(1, keepdims=True)
    for name, grad in g.items():
        whole, step = net.p[name], 0.02
        direction = grad / max(np.abs(grad).max(), 1e-12)
        net.p[name] = whole + step * direction
        up = loss()
        net.p[name] = whole - step * direction
        down = loss()
        net.p[name] = whole
        assert (up - down) / 2 / step == pytest.approx(float((grad * direction).sum()), rel=0.03, abs=2e-4), name


def test_windows_cover_every_word_and_overlap():
    counts = np.array([0, 1, toxicity.SPAN, toxicity.SPAN + 1, 500])
    text, start, length = toxicity.windows(counts)
    ends = np.cumsum(counts)
    for k, n in enumerate(counts):
        own = np.flatnonzero(text == k)
        seen = Counter(w for i in own for w in range(start[i], start[i] + length[i]))
        assert sorted(seen) == list(range(ends[k] - n, ends[k])) and len(own) >= 1
        assert all(start[b] < start[a] + toxicity.SPAN for a, b in zip(own, own[1:]))


def test_scores_as_window_by_window():
    """One window at a time, word by word, in plain loops."""
    net = toxicity.Network.start(5)
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "ünï", "x" * 70]) for _ in range(n)) for n in (0, 3, 40, 131)] + [None, "...", "😀 a"]
    fast = toxicity.Reader(net).score(texts)
    sig = lambda v: 1 / (1 + np.exp(-v))

    def gru(xs, d):
        h, out, n = np.zeros(toxicity.STATES), [], toxicity.STATES
        for x in xs:
            a, u = x @ net.p["input"][d] + net.p["gate"][d][0], h @ net.p["state"][d]
            z, r = sig(a[:n] + u[:n]), sig(a[n : 2 * n] + u[n : 2 * n])
            h = (1 - z) * np.tanh(a[2 * n :] + r * u[2 * n :]) + z * h
            out.append(h)
        return out

    for text, got in zip(texts, fast):
        words, best = toxicity.words_of(text), -np.inf
        for a in range(0, max(1, len(words)), toxicity.STRIDE):
            part = words[a : a + toxicity.SPAN]
            logit = net.p["rest"][0]
            if part:
                xs = [net.embed(toxicity.places([w]))[0] for w in part]
                hs = np.hstack((gru(xs, 0), gru(xs[::-1], 1)[::-1]))
                e = np.tanh(hs @ net.p["seen"] + net.p["bias"]) @ net.p["look"]
                weight = np.exp(e - e.max())
                logit = logit + (weight / weight.sum()) @ hs @ net.p["out"]
            best = max(best, logit)
            if a + toxicity.SPAN >= len(words):
                break
        assert got == pytest.approx(sig(best), abs=1e-4)


def test_toxic_words_are_found_in_long_texts(spark):
    rng = random.Random(0)
    plain = ["house", "river", "music", "garden", "window", "table", "morning", "letter", "winter", "music"]
    rows = []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 400))]
        if i % 3 == 0:
            words[rng.randrange(len(words))] = rng.choice(["vile", "wretch", "dolt"])
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = df.select("doc_id", F.col("score").alias("toxic"), F.lit("x").alias("text"))
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(df, labels).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert all(got[i]["held_out"] for i, _, _ in held) and sum(r["held_out"] for r in got.values()) == len(held)
    right = sum(got[i]["predicted"] == y for i, _, y in held)
    assert right >= 0.9 * len(held)


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    upset = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.score_toxicity(docs, x).orderBy("doc_id").collect() for x in (labels, upset))
    assert one == two


def test_toxicity_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, "", 2), (None, "a", 3)], "doc_id long, text string, held_out int")
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert sorted(toxicity.score_toxicity(docs, none).select("score", "predicted").collect()) == [(0.5, 0)] * 3
    assert toxicity.score_toxicity(docs.where("doc_id > 5"), none).count() == 0


# ---------------------------------------------------------------- spelling


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i:] == b[i + 1 :] or len(a) == len(b) and a[i + 1 :] == b[i + 1 :]


def test_errata_pairs_are_all_pairs_once():
    rng = random.Random(4)
    for _ in range(200):
        words = sorted({"".join(rng.choice("abñ") for _ in range(rng.randrange(0, 7))) for _ in range(60)})
        want = [(a, b) for a in range(len(words)) for b in range(a + 1, len(words)) if near(words[a], words[b])]
        assert sorted(tuple(sorted(p)) for p in spelling.errata_pairs(words)) == want


@pytest.mark.parametrize("group", [2, 10, 4096])
def test_variants_as_by_brute_force(spark, group):
    rng = random.Random(group)
    words = {"".join(rng.choice("abcé") for _ in range(rng.randrange(1, 9))): rng.choice([1, 2, 5, 30, 200, 2000]) for _ in range(250)}
    df = spark.createDataFrame([*words.items(), (None, 4)], "word string, n int")
    got = {r["word"]: r for r in spelling.group_variants(df, group=group).collect()}
    assert set(got) == set(words)
    forms = {}
    for w, n in words.items():
        others = sorted(((-m, v) for v, m in words.items() if near(w, v)))
        assert got[w]["n_near"] == len(others) and got[w]["n"] == n
        forms[w] = others[0][1] if others and -others[0][0] >= 5 * n else None
        assert (got[w]["form"], got[w]["form_n"]) == ((forms[w], words[forms[w]]) if forms[w] else (None, None))
    for w in words:
        last = w
        while forms[last]:
            last = forms[last]
        assert got[w]["root"] == last


def test_words_are_counted_with_their_slips(spark):
    rng = random.Random(9)
    lexicon = ["Garden", "WINDOW", "pequeño", "straße", "Überall", "abc", "fünfzehn"]
    rows = [(i, "1,".join(rng.choice(lexicon) for _ in range(60)), "x") for i in range(80)] + [(None, "garden-garden", "x"), (3, None, "x"), (4, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want, slipped = Counter(), 0
    import re

    for i, text, _ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 7 == 0:
                w, slipped = w[: h % len(w)] + w[h % len(w) + 1 :], slipped + 1
            want[w] += 1
    got = {r["word"]: r["n"] for r in spelling.count_words(df, slips=7).collect()}
    assert slipped and got == {w: n for w, n in want.items() if n >= 5 and len(w) >= 6}
    assert spelling.find_variants(df.where("doc_id > 900")).count() == 0


@pytest.mark.parametrize("name", ["op11_centroids", "op12_toxicity", "op13_spelling"])
def test_queries_have_the_columns_of_their_contract(spark, name):
    want = {
        "op11_centroids": ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
        "op12_toxicity": ["doc_id", "held_out", "score", "predicted"],
        "op13_spelling": ["word", "form", "root", "n", "n_near", "form_n"],
    }
    assert queries.QUERIES[name](spark, SMALL).columns == want[name]
