"""Near-duplicates by the Jaccard similarity of word shingles, checked exactly.

Candidates come from the method of ``simhash``: fingerprints at the anchors of a
covering code, linked at ``BITS`` or fewer differing bits. Two sets at similarity
0.8 differ in some ten of the 64 bits of a plain SimHash, far beyond what anchors
reach. So a document has ``PRINTS`` fingerprints, whose sums weigh the shingles by
powers of a hash of them: a few shingles, others for each fingerprint and for each
block of the code, settle most of the bits, and the rest of the set some. Two sets
at 0.8 have a fingerprint within ``BITS`` of the other's in 0.34 to 0.36 of the cases
(0.31 where five shingles meet four; equal ones in 0.26 to 0.29), so that they have
none once in 600,000 times (150,000); sets at 0.2 do in 0.005. Fingerprints linked, directly or over others, are one band.

A band that many documents have would give a square of pairs. So every
document is compared with the first of its band only, and components of these
links are found. Where the others of a band are in more than one component, all
their pairs between components are compared too, inside the join, so that only
what may be a link becomes a row. Pairs inside a component need no comparison.
Rows of a family share many bands; a pair is compared in the largest of its own, so
that few bands have pairs left that no larger one has, and a set moves for these only.
The others are dealt by band and size, as sets of similar texts are of the same or
of neighbouring size classes, and where a band and class have many, one side is
split into parts of ``PART`` rows and the other side meets each of them.

Whole sets are large, so they are never written, and pairs are looked at twice: first by their sizes and by a
byte of each block of the fingerprints, of which two sets at 0.8 share fewer than ``AGREE`` once in
10^9 times; then those left, not many more than there are links, by their sets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from corpuskit.llm import scratch
from corpuskit.llm.components import connected_components
from corpuskit.llm.rows import Bitmap, without
from corpuskit.llm.simhash import LOWER, link_fingerprints

PRINTS, BITS = 32, 1
#: The two blocks of the code, and what the anchors leave out; each has weights of its own.
BLOCKS = (0, 23, 46, 64)
#: Of the 96 bytes two sets at similarity 0.8 share 66 to 69 on average, with a deviation of 4.6.
AGREE = 38
#: Fingerprints are linked in so many parts, as each goes to 11 anchors.
ROUNDS = 4
#: Rows of one band and size class that a task compares with others in one part.
PART = 512
RANDOM = np.random.default_rng(42)
#: Odd factors: each is a permutation of 64-bit hashes.
FACTORS = RANDOM.integers(0, 1 << 63, 3 * PRINTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Tell the fingerprints of a document from each other: links between different ones don't come about.
MASKS = RANDOM.integers(0, 1 << 63, PRINTS, dtype=np.uint64)


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted, different 64-bit hashes of the word shingles; fewer words than ``width``: one shingle; no word: none."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    n = max(1, len(words) - width + 1)
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, zip(*(words[k:] for k in range(width))) if n > 1 else [words])), np.uint64, n))


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    """The 64-bit SimHashes of a set; a shingle weighs u^-2, where u is uniform by its hash, another for each fingerprint and block. Empty: 0."""
    total = np.zeros((PRINTS, 64), np.float32)
    for start in range(0, len(hashes), 512):
        h = hashes[start : start + 512]
        u = np.ascontiguousarray((h[:, None] * FACTORS).view(np.uint32)[:, 1::2]).astype(np.float32) + np.float32(1)
        weights = 1 / (u * u)
        signs = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32) * 2 - 1
        for k, (low, high) in enumerate(pairwise(BLOCKS)):
            total[:, low:high] += weights[:, k * PRINTS : (k + 1) * PRINTS].T @ signs[:, low:high]
    return np.packbits(total > 0, axis=1, bitorder="little").view(np.uint64)[:, 0]


def keys(prints: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints as they are linked; all empty sets have one only."""
    return (prints ^ MASKS).view(np.int64) if n else np.zeros(1, np.int64)


def signature(prints: np.ndarray) -> np.ndarray:
    """A byte of each block of each fingerprint, eight to a long."""
    return np.stack([prints >> np.uint64(low) for low in BLOCKS[:-1]]).astype(np.uint8).reshape(-1).view(np.int64)


def alike(a: Column, b: Column, n_a: Column, n_b: Column, similarity: float) -> Column:
    """Whether sizes and signatures leave it possible that two sets are as similar."""

    def same_bytes(x: Column, y: Column) -> Column:
        # A byte of the difference is 0 where both agree; its bits are gathered in the lowest one.
        d = x.bitwiseXOR(y)
        for shift in (4, 2, 1):
            d = d.bitwiseOR(F.shiftrightunsigned(d, shift))
        return 8 - F.bit_count(d.bitwiseAND(F.lit(0x0101010101010101)))

    agree = F.aggregate(F.zip_with(a, b, same_bytes), F.lit(0), lambda total, n: total + n)
    return (F.least(n_a, n_b) >= F.greatest(n_a, n_b) * similarity - 1e-9) & (agree >= AGREE)


def similar(a: Column, b: Column, similarity: float) -> Column:
    """Whether sets without repeats are as similar; two empty ones are."""
    # The sizes alone rule out most. What both hold is n of n_a + n_b - n, and asked for once, as it is counted anew each time.
    enough = (F.size(a) + F.size(b)) * (similarity / (1 + similarity)) - 1e-9
    return (F.least(F.size(a), F.size(b)) >= F.greatest(F.size(a), F.size(b)) * similarity - 1e-9) & (F.size(F.array_intersect(a, b)) >= enough)


def find_bands(keyed: DataFrame) -> DataFrame:
    """Rows that share a band, as (band, row, first): the band's first row has none. ``keyed`` has row, k and fp, and is read twice.

    A band is a component of the links between fingerprints, or what shares a fingerprint without links.
    """
    classes = keyed.groupBy("fp").agg(F.min("k").alias("k"), F.min("row").alias("first"), F.max("row").alias("last"))
    classes = scratch.materialise(classes, "prints")
    rounds = (link_fingerprints(classes.where(F.col("k") % ROUNDS == r), BITS) for r in range(ROUNDS))
    links = reduce(DataFrame.union, [scratch.materialise(found, "links") for found in rounds])
    placed = classes.join(connected_components(links, "a", "b"), F.col("fp") == F.col("node"), "left")
    shared = placed.where("node is not null or first <> last").select("fp", F.coalesce("component", "fp").alias("band"), "first")
    shared = scratch.materialise(shared, "shared")
    firsts = shared.groupBy("band").agg(F.min("first").alias("first"))
    return keyed.join(shared.select("fp", "band"), "fp").select("band", "row").join(firsts, "band").where("row <> first")


def larger_bands(placed: DataFrame) -> DataFrame:
    """The rows (band, row, part) of bands with several parts, with ``larger``: the row's bands of more rows, or as many and a smaller number.

    Two rows of a band meet in it first of all that they share if their ``larger`` have none in common.
    """
    bands = placed.groupBy("band").agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("members"))
    held = placed.join(bands.where("low <> high").select("band", "members"), "band")
    ordered = F.transform(F.array_sort(F.collect_set(F.struct((-F.col("members")).alias("order"), "band"))), lambda x: x["band"])
    lists = held.groupBy("row").agg(ordered.alias("bands"))
    return held.join(lists, "row").select("band", "row", "part", F.expr("slice(bands, 1, cast(array_position(bands, band) as int) - 1)").alias("larger"))


def find_near_copies(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """Group documents whose shingle sets are linked, directly or over others, at ``similarity`` or more.

    Returns a row for each row of ``docs``: the id and ``component_id``, the
    smallest id reachable. Texts without words are one group. Null ids pass
    through; a group of null ids only has a null component. An empty table gives
    an empty result. Only the two named columns are read. Recall is that of the
    fingerprints at 0.8, so ``similarity`` can't be lower.
    """
    if not 0.8 <= similarity <= 1:
        raise ValueError("the fingerprints serve similarities from 0.8")
    named = _written(lambda: _rooted(docs, similarity, id_col, text_col, width), docs.sparkSession, "named")
    lows = named.groupBy("root").agg(F.min("id").alias("component_id"))
    return named.join(lows, "root").select(F.col("id").alias(id_col), "component_id")


def _written(make: Callable[[], DataFrame], spark: SparkSession, name: str) -> DataFrame:
    """What ``make`` returns, written and read back; the tables that it wrote on its way are deleted."""
    with scratch.dropping(spark) as kept:
        made = make()
        kept.append(path := scratch.write(made, name))
    return scratch.read_back(made, path)


def _rooted(docs: DataFrame, similarity: float, id_col: str, text_col: str, width: int) -> DataFrame:
    """A row for each row of ``docs``: the id, and ``root``, by which its group is known."""

    def listed(parts: list[np.ndarray]) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]).astype(np.int32)), pa.array(np.concatenate(parts)))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 1000):
                batch = whole.slice(at, 1000)
                sets = [shingle_set(t.as_py(), width) for t in batch.column(2)]
                prints = list(map(fingerprints, sets))
                lists = listed(list(map(keys, prints, map(len, sets)))), listed(list(map(signature, prints)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(len, sets), pa.int32()), *lists], names=["id", "digest", "n", "prints", "sig"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 1000):
                batch = whole.slice(at, 1000)
                yield pa.RecordBatch.from_arrays([batch.column(0), listed([shingle_set(t.as_py(), width).view(np.int64) for t in batch.column(1)])], names=["digest", "hashes"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("digest"), text.alias("text"))
    longs = ArrayType(LongType())
    kept = [StructField("id", rows.schema["id"].dataType), StructField("digest", BinaryType()), StructField("n", IntegerType()), StructField("prints", longs), StructField("sig", longs)]
    sketched = rows.mapInArrow(sketch, StructType(kept))
    sketched = scratch.materialise(sketched.withColumn("row", F.monotonically_increasing_id()), "shingles")
    members = _written(lambda: find_bands(sketched.select("row", F.posexplode("prints").alias("k", "fp"))), docs.sparkSession, "members")
    pairs = scratch.materialise(members.select(F.col("first").alias("a"), F.col("row").alias("b")).distinct(), "pairs")
    marks = sketched.select("row", "n", "sig")

    def sets_of(some: DataFrame) -> DataFrame:
        """(row, hashes) of different rows. Sets are made anew of the texts, which a bitmap finds, so that no set is kept and no other text moves."""
        wanted = scratch.materialise(some.join(sketched.select("row", "digest"), "row"), "wanted")
        texts = scratch.materialise(wanted.select("digest").distinct(), "digests")
        held = Bitmap(texts, "digest").mark(rows.select("digest", "text"), "digest").where("hit").join(texts, "digest", "left_semi")
        made = held.groupBy("digest").agg(F.first("text").alias("text")).mapInArrow(sets, StructType([kept[1], StructField("hashes", longs)]))
        return wanted.join(made, "digest").select("row", "hashes")

    def marked(pairs: DataFrame, c: str) -> DataFrame:
        return pairs.join(marks.select(F.col("row").alias(c), F.col("n").alias(f"{c}_n"), F.col("sig").alias(f"{c}_sig")), c)

    near = alike(F.col("a_sig"), F.col("b_sig"), F.col("a_n"), F.col("b_n"), similarity)
    few = scratch.materialise(marked(marked(pairs, "a"), "b").where(near).select("a", "b"), "direct")
    held = sets_of(few.select(F.col("a").alias("row")).union(few.select("b")).distinct())
    one, two = (held.select(F.col("row").alias(c), F.col("hashes").alias(f"{c}_set")) for c in ("a", "b"))
    direct = few.join(one, "a").join(two, "b").where(similar(F.col("a_set"), F.col("b_set"), similarity)).select("a", "b")
    groups = connected_components(direct, "a", "b")
    # What is left are pairs of two others of a key that are in different components.
    placed = scratch.materialise(members.join(groups, members.row == groups.node, "left").select("band", "row", F.coalesce("component", "row").alias("part")), "placed")
    rest = scratch.materialise(larger_bands(placed).join(marks, "row"), "rest")

    # Sizes of sets at the similarity differ by less than one step of this scale.
    step = math.log(1 / similarity * (1 + 1e-9))
    rest = rest.withColumn("size_class", F.floor(F.log(F.greatest(F.col("n"), F.lit(1)).cast("double")) / step))

    def met(rows: DataFrame, condition: Column, how: str, *more: str) -> DataFrame:
        """Rows of a key in neighbouring size classes, as sides a and b."""
        names = ("part", "row", "n", "sig", "larger", *more)
        parts = rows.groupBy("band", "size_class").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
        left = rows.select("band", F.explode(F.array(*(F.col("size_class") + d for d in (-1, 0, 1)))).alias("size_class"), *(F.col(x).alias(f"a_{x}") for x in names))
        left = left.join(parts, ["band", "size_class"]).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        right = rows.join(parts, ["band", "size_class"]).select("band", "size_class", F.pmod(F.xxhash64("row"), "parts").cast("int").alias("salt"), *(F.col(x).alias(f"b_{x}") for x in names))
        same = (left.band == right.band) & (left.size_class == right.size_class) & (left.salt == right.salt)
        return left.join(right, same & condition, how)

    # Rows with any partner that may be similar, each once; only they bring their sets, and pairs stay inside the join.
    # Two rows can share many bands, and are compared in the largest of them only.
    once = ~F.arrays_overlap("a_larger", "b_larger")
    partner = (F.col("a_part") != F.col("b_part")) & once & near
    found = met(rest, partner, "left_semi").select("band", F.col("a_row").alias("row")).distinct()
    close = scratch.materialise(rest.join(found, ["band", "row"], "left_semi"), "close")
    linked = (F.col("a_part") < F.col("b_part")) & once & near & similar(F.col("a_hashes"), F.col("b_hashes"), similarity)
    whole = close.join(sets_of(close.select("row").distinct()), "row")
    between = met(whole, linked, "inner", "hashes").select(F.col("a_part").alias("a"), F.col("b_part").alias("b"))
    merged = connected_components(between, "a", "b").select(F.col("node").alias("part"), F.col("component").alias("root"))
    roots = groups.select(F.col("node").alias("row"), F.col("component").alias("part")).join(merged, "part", "left").select("row", F.coalesce("root", "part").alias("root"))
    # Rows without a direct link can have one of the second kind.
    alone = merged.join(groups.select(F.col("node").alias("part")), "part", "left_anti").select(F.col("part").alias("row"), "root")
    return sketched.select("id", "row").join(roots.union(alone), "row", "left").select("id", F.coalesce("root", "row").alias("root"))


def drop_near_copies(docs: DataFrame, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group, that of the smallest id, with all its columns.

    Of rows that repeat this id, and of groups whose ids are all null, one row stays.
    """
    key = F.struct(F.col(id_col).isNull().alias("unknown"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("hash"))
    found = find_near_copies(docs.select(key.alias("key"), F.col(text_col).alias("text")), similarity, "key", "text")
    # Rows that repeat an id and a text have one key.
    keys = scratch.materialise(found.groupBy("key").agg(F.min("component_id").alias("low"), F.count("*").alias("n")), "keys")
    return without(docs, key, keys.where("key <> low").select("key"), keys.where("key = low and n > 1").select("key"))
