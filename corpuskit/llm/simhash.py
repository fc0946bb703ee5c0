"""Near-duplicates by SimHash, with a covering code as anchor points.

The anchors are a covering code of the fingerprints: 46 of the 64 bits, in two
blocks of 23, are covered by the binary Golay code, which is perfect with
covering radius 3. The codeword pair nearest to a fingerprint is its home. Two
fingerprints that differ in d bits of a block lie within 3 + d of each other's
nearest codeword there. So every fingerprint is replicated to all anchors within
the covering radius plus its share of the threshold in each block (68 anchors at
threshold 2, fewer for some), and each anchor compares its residents with its
visitors. A pair meets exactly once so: at the home of the smaller fingerprint.

With very many fingerprints an anchor has many residents. Then 15 of the other
18 bits are a third block, covered by the Hamming code of radius 1: 2048 times
as many anchors for some 2.5 times as many visits. The links are the same.
Anchors that still have many residents are split: their residents are dealt to
parts, and visitors go to each part.

Copies share a fingerprint and are compared once. What is emitted are links
between different fingerprints only, of which a fingerprint has at most
64 + 2016 at threshold 2, however large a group of near copies is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm import scratch
from corpuskit.llm.components import connected_components
from corpuskit.llm.rows import without

#: A-Z to a-z over bytes.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: The generator polynomial of the binary Golay code (fixed value): x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101
BLOCK, MASK = 23, (1 << 23) - 1
#: The third block: 15 bits and the generator polynomial of the Hamming code (fixed value): x^4 + x + 1.
THIRD, HAMMING = 15, 0b10011
#: From so many different fingerprints on, the third block pays.
MANY = 1 << 29
#: Anchors with more residents are split into parts of about so many.
RESIDENTS = 1 << 16


def fingerprint(text: str | None, width: int = 3, seed: int = 42, at_once: int = 65_280) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included; no word: 0.

    A bit is 1 if more than half the shingles' XXH64 hashes have it. Memory for
    hashes is bounded by ``at_once`` shingles.
    """
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    hashed = partial(xxhash.xxh64_intdigest, seed=seed)
    if len(words) < width:
        return hashed(b" ".join(words))
    n, total = len(words) - width + 1, np.zeros(64, np.int64)
    shingles = map(hashed, map(b" ".join, zip(*(words[k:] for k in range(width)))))
    for start in range(0, n, at_once):
        size = min(at_once, n - start)
        h = np.fromiter(shingles, np.uint64, size)
        # Eight counters of a byte each in a word: sums of up to 255 rows can't overflow.
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
        for a in range(0, size, 255 * 64):
            rows = bits[a : a + 255 * 64]
            full = len(rows) // 255 * 255
            for part in (rows[:full].reshape(-1, 255, 8).sum(1, dtype=np.uint64), rows[full:].sum(0, dtype=np.uint64).reshape(1, 8)):
                total += np.ascontiguousarray(part).view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def _remainder(y: np.ndarray) -> np.ndarray:
    """Of polynomials of degree 22 at most, modulo the generator: the syndrome."""
    y = y.copy()
    for bit in range(BLOCK - 1, 10, -1):
        y ^= np.where(y >> bit & 1, GOLAY << (bit - 11), 0)
    return y


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes by the upper 12 bits; the coset leader of each syndrome; codewords at distance 4, and 5, from each leader.

    The last two are padded with -1 and don't hold the nearest codeword itself.
    """
    ones = np.array([1 << i for i in range(BLOCK)], np.int64)
    two = np.array([a | b for i, a in enumerate(ones) for b in ones[:i]], np.int64)
    three = np.unique(np.array([a | b for a in two for b in ones if not a & b], np.int64))
    errors = np.concatenate(([0], ones, two, three))
    leader = np.zeros(2048, np.int64)
    leader[_remainder(errors)] = errors
    messages = np.arange(4096, dtype=np.int64) << 11
    upper = _remainder(messages)
    words = messages ^ upper
    near = []
    for distance in (4, 5):
        at = np.bitwise_count(words[None, :] ^ leader[:, None]) == distance
        table = np.full((2048, at.sum(1).max()), -1, np.int64)
        for s in range(2048):
            table[s, : at[s].sum()] = words[at[s]]
        near.append(table)
    return upper, leader, *near


@lru_cache(maxsize=1)
def hamming() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of all 15-bit words; the coset leader of each syndrome; codewords at distance 2 or 3 from words with each syndrome.

    As with ``golay``, the last two are those that one, and two, more bits of
    distance reach: within radius 2, and exactly at 3. Padded with -1.
    """
    words = np.arange(1 << THIRD, dtype=np.int64)
    syndrome = words.copy()
    for bit in range(THIRD - 1, 3, -1):
        syndrome ^= np.where(syndrome >> bit & 1, HAMMING << (bit - 4), 0)
    leader = np.zeros(16, np.int64)
    for bit in range(THIRD):
        leader[syndrome[1 << bit]] = 1 << bit
    code = words[syndrome == 0]
    near = []
    for distance in (2, 3):
        at = np.bitwise_count(code[None, :] ^ leader[:, None]) == distance
        table = np.full((16, at.sum(1).max()), -1, np.int64)
        for s in range(16):
            table[s, : at[s].sum()] = code[at[s]]
        near.append(table)
    return syndrome, leader, *near


def _blocks(fps: np.ndarray, blocks: int) -> list[tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...], int]]:
    """For each block the nearest codewords, the syndromes, the tables of the code, and the place of its bits."""
    u, out = fps.astype(np.uint64), []
    upper, leader, *tables = golay()
    for k in (0, 1):
        y = (u >> np.uint64(BLOCK * k) & np.uint64(MASK)).astype(np.int64)
        syndrome = upper[y >> 11] ^ (y & 2047)
        out.append((y ^ leader[syndrome], syndrome, tuple(tables), BLOCK * k))
    if blocks == 3:
        every, leader, *tables = hamming()
        y = (u >> np.uint64(2 * BLOCK) & np.uint64((1 << THIRD) - 1)).astype(np.int64)
        syndrome = every[y]
        out.append((y ^ leader[syndrome], syndrome, tuple(tables), 2 * BLOCK))
    return out


def home(fps: np.ndarray, blocks: int = 2) -> np.ndarray:
    """The nearest anchor of each fingerprint (as int64)."""
    anchor = np.zeros(len(fps), np.int64)
    for word, _, _, place in _blocks(fps, blocks):
        anchor |= word << place
    return anchor


def visits(fps: np.ndarray, threshold: int, blocks: int = 2) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of (index, anchor) for all anchors within the covering radius plus the threshold, shared between the blocks."""
    if not 0 <= threshold <= 2:
        raise ValueError("the anchors serve thresholds up to 2")
    options = []
    for word, syndrome, tables, place in _blocks(fps, blocks):
        far = [np.where((t := table[syndrome]) >= 0, t ^ word[:, None], -1) for table in tables[:threshold]]
        options.append([np.where(x >= 0, x << place, -1) for x in (word[:, None], *far)])
    for share in product(range(threshold + 1), repeat=blocks):
        if sum(share) <= threshold:
            both = options[0][share[0]]
            for option, n in zip(options[1:], share[1:]):
                two = option[n]
                both = np.where((both[:, :, None] >= 0) & (two[:, None, :] >= 0), both[:, :, None] | two[:, None, :], -1).reshape(len(fps), -1)
            row, col = np.nonzero(both >= 0)
            yield row, both[row, col]


def link_fingerprints(distinct: DataFrame, threshold: int = 2, blocks: int | None = None, residents_at_once: int = RESIDENTS) -> DataFrame:
    """Links (a, b) between different fingerprints (column ``fp``, distinct) at ``threshold`` or fewer bits.

    ``blocks`` is 2 or 3, by default by the number of fingerprints; the links are the same.
    """
    if blocks is None:
        blocks = 3 if distinct.count() > MANY else 2

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(home(fps, blocks)), pa.array(fps)], names=["anchor", "fp"])

    def travel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            for start in range(0, len(fps), 4096):
                part = fps[start : start + 4096]
                for row, anchor in visits(part, threshold, blocks):
                    yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(part[row])], names=["anchor", "fp"])

    residents = distinct.select("fp").mapInArrow(settle, "anchor bigint, fp bigint").select("anchor", F.col("fp").alias("a"))
    visitors = distinct.select("fp").mapInArrow(travel, "anchor bigint, fp bigint").select("anchor", F.col("fp").alias("b"))
    counts = residents.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > residents_at_once)
    full = scratch.materialise(counts.select("anchor", F.ceil(F.col("n") / residents_at_once).cast("int").alias("parts")), "full")
    keys = ["anchor"]
    if not full.isEmpty():
        keys = ["anchor", "part"]
        parts = F.coalesce("parts", F.lit(1))
        residents = residents.join(full, "anchor", "left").select("anchor", F.pmod(F.xxhash64("a"), parts).cast("int").alias("part"), "a")
        visitors = visitors.join(full, "anchor", "left").select("anchor", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "b")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold
    # Spark takes visitors, dozens a fingerprint, for as many rows as there are fingerprints, and would broadcast them.
    return residents.join(visitors.hint("merge"), keys).where((F.col("a") < F.col("b")) & close).select("a", "b")


def find_near_copies(docs: DataFrame, threshold: int = 2, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """Group documents whose fingerprints are linked, directly or over others.

    Returns a row for each row of ``docs``: the id, ``fp`` (the fingerprint as a
    signed long) and ``component_id``, the smallest id reachable.

    Null and empty texts, and those of white space, have fingerprint 0 and are
    linked like any other. Rows that repeat an id or a text are in one group by
    their fingerprints. Null ids pass through; a group of null ids only has a
    null component. An empty table gives an empty result. Only the two named
    columns are read, so others may have any names.
    """

    @F.pandas_udf("bigint")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64))

    hashed = scratch.materialise(docs.select(F.col(id_col).alias("id"), prints(text_col).alias("fp")), "prints")
    classes = scratch.materialise(hashed.groupBy("fp").agg(F.min("id").alias("low"), F.count("*").alias("n")), "classes")
    links = connected_components(link_fingerprints(classes, threshold), "a", "b")
    rooted = classes.join(links, classes.fp == links.node, "left").select("fp", F.coalesce("component", "fp").alias("root"), "low", "n")
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = scratch.materialise(rooted.select("fp", "root", "n").join(lows, "root").select(F.col("fp").alias("print"), "component_id", "n"), "named")
    # Fingerprints that more than a thousandth of all rows have are fewer than a thousand; their rows stay where they are.
    common = named.where(F.col("n") > F.lit(max(1000, hashed.count() // 1000))).select(F.col("print").alias("common"), F.col("component_id").alias("its"))
    marked = hashed.join(F.broadcast(common), F.col("fp") == F.col("common"), "left")
    here = marked.where("common is not null").select("id", "fp", F.col("its").alias("component_id"))
    rest = marked.where("common is null").select("id", "fp").join(named, F.col("fp") == F.col("print")).select("id", "fp", "component_id")
    return here.union(rest).select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_copies(docs: DataFrame, threshold: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group, that of the smallest id, with all its columns.

    Of rows that repeat this id, and of groups whose ids are all null, one row stays.
    """
    key = F.struct(F.col(id_col).isNull().alias("unknown"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("hash"))
    found = find_near_copies(docs.select(key.alias("key"), F.col(text_col).alias("text")), threshold, "key", "text")
    # Rows that repeat an id and a text have one key.
    keys = scratch.materialise(found.groupBy("key").agg(F.min("component_id").alias("low"), F.count("*").alias("n")), "keys")
    return without(docs, key, keys.where("key <> low").select("key"), keys.where("key = low and n > 1").select("key"))
