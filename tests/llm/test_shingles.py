"""Near copies by shingle sets against brute-force Jaccard."""

import random

import numpy as np
import pytest

import corpus_pipeline
from corpuskit.llm import shingles
from corpuskit.sources import shared

DOCS = "doc_id long, text string, source string, kept string, hit string"


def brute(text, width=5):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def test_stage_against_brute_force(spark):
    rng = random.Random(12)
    texts = [None, "", " \n", "a b", "A  b", "a b c d e", "日本語 x y z w v"]
    for _ in range(8):
        base = [f"w{rng.randint(0, 9999)}" for _ in range(rng.randint(30, 300))]
        texts.append(" ".join(base))
        for _ in range(12):  # copies of the base and copies of copies, near and beyond 0.8
            words = list(base)
            for _ in range(rng.randint(1, 6)):
                words[rng.randrange(len(words))] = f"v{rng.randint(0, 9999)}"
            texts.append(" ".join(words))
            base = words if rng.random() < 0.4 else base
    rows = [(1000 - i, t, "s", "k", "h") for i, t in enumerate(texts)]
    sets, label = [brute(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both, either = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if 5 * both >= 4 * either and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    want = {r[0]: min(x[0] for x, g in zip(rows, label) if g == label[i]) for i, r in enumerate(rows)}
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    assert {r["doc_id"]: r["component_id"] for r in shingles.find_near_copies(docs).collect()} == want
    left = corpus_pipeline.near_copies(spark, docs, "")
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == sorted(set(want.values()))


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(3, text), (3, text), (None, text + " x"), (None, "only"), (None, "only"), (7, "b")], "doc_id long, text string")
    left = [tuple(r) for r in shingles.drop_near_copies(docs).collect()]
    assert sorted(left, key=repr) == sorted([(3, text), (None, "only"), (7, "b")], key=repr)
    assert shingles.find_near_copies(docs.limit(0)).count() == 0 and shingles.drop_near_copies(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        shingles.find_near_copies(docs, 0.5)


def test_bands_come_from_the_anchors_of_simhash(spark):
    """Fingerprints one bit apart are one band, also over others; those two bits apart are not."""
    rng = random.Random(7)
    rows = []  # (row, k, fp)
    for k in range(12):
        x = rng.getrandbits(63)
        rows += [(10 * k, k, x), (10 * k + 1, k, x ^ 1 << rng.randrange(63)), (10 * k + 2, k, x ^ 3 << 20), (10 * k + 3, k, x)]
        y = rng.getrandbits(63)
        rows += [(1000 + 10 * k + j, k, y ^ (1 << j) - 1) for j in range(5)] + [(5000 + k, k, rng.getrandbits(63))]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][2] ^ rows[j][2]).bit_count() <= 1 and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    groups = {}
    for (row, _, _), g in zip(rows, label):
        groups.setdefault(g, []).append(row)
    want = {row: min(g) for g in groups.values() for row in g if row != min(g)}
    keyed = spark.createDataFrame(rows, "row long, k int, fp long").repartition(3)
    got = shingles.find_bands(keyed).collect()
    assert len(got) == len(want) == 12 * 6 and {r["row"]: r["first"] for r in got} == want
    assert len({r["band"] for r in got}) == 24


def test_fingerprints_meet_at_the_similarity():
    """At 0.8 a third of the fingerprints meets, some of them unequal; what is far apart does not meet."""
    rng = np.random.default_rng(3)
    for n, shared in ((9, 8), (90, 80), (900, 800)):
        near = equal = 0
        for _ in range(100):
            h = rng.integers(0, 1 << 64, 2 * n - shared, dtype=np.uint64)
            a, b = (shingles.fingerprints(np.sort(x)) for x in (h[:n], np.concatenate((h[:shared], h[n:]))))
            bits = np.bitwise_count(a ^ b)
            near, equal = near + (bits <= shingles.BITS).sum(), equal + (bits == 0).sum()
            assert (bits <= shingles.BITS).any()
            same = (shingles.signature(a).view(np.uint8) == shingles.signature(b).view(np.uint8)).sum()
            assert same >= shingles.AGREE
        assert 0.31 < near / 3200 < 0.40 and equal < 0.9 * near
    a, b = (shingles.fingerprints(rng.integers(0, 1 << 64, 200, dtype=np.uint64)) for _ in range(2))
    assert np.bitwise_count(a ^ b).min() > 8 and len(set(a.tolist())) > 24
    assert shingles.fingerprints(np.empty(0, np.uint64)).tolist() == [0] * shingles.PRINTS


def test_pairs_meet_in_their_largest_band(spark):
    rng = random.Random(9)
    placed = [(band, row, row % 7) for band in range(20) for row in rng.sample(range(30), rng.randint(2, 20))] + [(50, 1, 1), (50, 8, 1)]
    bands = {}
    for band, row, part in placed:
        bands.setdefault(band, {})[row] = part
    bands = {b: rows for b, rows in bands.items() if len(set(rows.values())) > 1}
    got = {(r["band"], r["row"]): (r["part"], set(r["larger"])) for r in shingles.larger_bands(spark.createDataFrame(placed, "band long, row long, part long")).collect()}
    assert {k: v[0] for k, v in got.items()} == {(b, row): part for b, rows in bands.items() for row, part in rows.items()}
    for i in range(30):
        for j in range(i):
            common = [b for b, rows in bands.items() if i in rows and j in rows]
            met = [b for b in common if not got[b, i][1] & got[b, j][1]]
            assert met == ([min(common, key=lambda b: (-len(bands[b]), b))] if common else [])


def test_a_family_moves_its_sets_for_few_bands_and_leaves_one_table(spark, monkeypatch):
    """Texts near each other, but not at 0.8, share half of their bands: most pairs have met in a larger one."""
    rng = random.Random(5)
    rows = []
    for i in range(100):
        words = [f"w{j}" for j in range(300)]
        for j in rng.sample(range(300), 8):
            words[j] = f"v{i}x{j}"
        rows += [(i, " ".join(words))] + ([(1000 + i, " ".join(words[:-1] + ["end"]))] if i >= 95 else [])
    counts, materialise = {}, shingles.scratch.materialise

    def counted(df, name):
        out = materialise(df, name)
        if name in ("rest", "close"):
            counts[name] = out.count()
        return out

    monkeypatch.setattr(shingles.scratch, "materialise", counted)
    before = len(shared._written)
    got = {r["doc_id"]: r["component_id"] for r in shingles.find_near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert got == {i: i % 1000 if i >= 1000 else i for i, _ in rows}
    assert counts["rest"] > 1000 and counts["close"] < 0.65 * counts["rest"]
    left = [p.split("/")[-1].split("-")[0] for p in shared._written[before:]]
    assert left == ["named"]
