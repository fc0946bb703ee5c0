"""Spelling variants: words at one edit, found by merging errata tries, and the forms that they lead to.

Words and their counts come from whole texts in Spark. Two words at one edit share
what stands before the edit and what stands after it. So words are grouped by
length (of the shorter word of a pair) and the first half, and by length and the
last half: every pair meets in one of the groups. A group that is too large is
split anew by halves of what its words don't share, until at most one character
is open; so no group is cut and none grows beyond the alphabet. Each group is one
trie. At each of its branches the heaviest subtree stays; the lighter ones are
merged into an errata trie, their first character replaced or skipped, and looked
up in the heavy one. Terminals that coincide are words at one edit. A word moves
only as part of a lighter subtree, so at most log2(group) times.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm import scratch

RUNS = "([A-Za-zÀ-ÿ]+)"
#: Words of a group beyond which it is split.
GROUP = 4096


def count_words(docs: DataFrame, least_length: int = 6, least: int = 5, slips: int = 199, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words of at least ``least_length`` code points that occur at least ``least`` times.

    With ``slips``, an occurrence loses one code point where ``slips`` divides the
    crc32 of ``<id>:<word>``, at the place of that hash modulo the length; 0: none does.
    """
    runs = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUNS), F.lit(1))).alias("run"))
    runs = runs.where(F.length("run") >= least_length).select("id", F.translate("run", ascii_uppercase, ascii_lowercase).alias("word"))
    if slips:
        h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
        at = F.pmod(F.col("h"), F.length("word")).cast("int")
        rest = F.concat(F.col("word").substr(F.lit(1), at), F.col("word").substr(at + 2, F.length("word")))
        runs = runs.withColumn("h", h).select(F.when(F.col("h") % slips == 0, rest).otherwise(F.col("word")).alias("word"))
    return runs.groupBy("word").agg(F.count("*").alias("n")).where((F.col("n") >= least) & (F.length("word") >= least_length))


def errata_pairs(words: list[str]) -> Iterator[tuple[int, int]]:
    """The places of all pairs of words at one edit, each pair once; ``words`` are sorted by code points and differ.

    A node of the trie is a run of the sorted words and the length of what they share.
    """
    place = {w: i for i, w in enumerate(words)}
    nodes = [(0, len(words), 0)]
    while nodes:
        a, b, depth = nodes.pop()
        if b - a < 2:
            continue
        first, last = words[a], words[b - 1]
        while depth < len(first) and first[depth] == last[depth]:
            depth += 1
        path, i, children = first[:depth], a, []
        ends = len(first) == depth
        if ends:
            i += 1
        while i < b:
            j = bisect_right(words, words[i][: depth + 1] + "\U0010ffff", i, b)
            children.append((i, j))
            i = j
        children.sort(key=lambda c: c[0] - c[1])
        (i, j), *light = children
        heavy = path + words[i][depth]
        if ends and heavy in place:
            yield a, place[heavy]
        errata: dict[str, list[int]] = {}  # of the light subtrees: what follows the replaced character
        for i, j in reversed(light):
            for x in range(i, j):
                word = words[x]
                after = word[depth + 1 :]
                same = errata.setdefault(after, [])
                for y in same:  # replaced, both light
                    yield y, x
                same.append(x)
                if (y := place.get(heavy + after)) is not None:  # replaced, the other heavy
                    yield x, y
                if after[:1] != word[depth] and (y := place.get(path + after)) is not None:  # skipped
                    yield x, y
                if (y := place.get(heavy + word[depth:])) is not None:  # the heavy one's skipped
                    yield x, y
        nodes += [(i, j, depth + 1) for i, j in children]


def _halves(rows: DataFrame) -> DataFrame:
    """Each row of a group in the two groups into which it is split; ``open`` is what is left between the shared ends."""
    room = F.col("short") - F.col("head") - F.col("tail")
    half = F.floor(room / 2).cast("int")
    either = F.array(
        F.struct((F.col("head") + half).alias("head"), F.col("tail")),
        F.struct(F.col("head"), (F.col("tail") + room - half).cast("int").alias("tail")),
    )
    split = rows.select("word", "n", "short", F.explode(either).alias("ends")).select("word", "n", "short", "ends.*")
    shared = [F.col("word").substr(F.lit(1), F.col("head")), F.col("word").substr(F.length("word") - F.col("tail") + 1, F.col("tail"))]
    # Groups whose hashes are equal are searched as one, which finds the same pairs.
    return split.withColumn("key", F.xxhash64("short", "head", "tail", *shared)).withColumn("open", F.col("short") - F.col("head") - F.col("tail"))


def one_edit_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(word, near, near_n): both directions of all pairs at one edit among the different words of (word, n)."""
    length = F.length("word")
    classes = F.array(length, length - 1)  # of pairs of equal length, or with a longer word; and with a shorter one
    rows = words.select("word", "n", F.explode(classes).alias("short")).where("short >= 0")
    rows = rows.select("*", F.lit(0).alias("head"), F.lit(0).alias("tail"))
    small = None
    while True:
        rows = scratch.materialise(_halves(rows), "halves")
        sizes = rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        sized = rows.join(sizes, "key")
        fits = (F.col("size") <= group) | (F.col("open") <= 1)
        part = sized.where(fits).select("key", "short", "word", "n")
        small = part if small is None else small.union(part)
        rows = sized.where(~fits).drop("size", "key", "open")
        if rows.isEmpty():
            break

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[str, str, int]] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out)) or [(), (), ()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], names=["word", "near", "near_n"])

        def found(short: int, held: dict[str, int]) -> None:
            names = list(held)
            for i, j in errata_pairs(names):
                a, b = names[i], names[j]
                if min(len(a), len(b)) == short:  # longer ones meet in a group of their own
                    out.append((a, b, held[b]))
                    out.append((b, a, held[a]))

        key, short, held = None, 0, {}
        for batch in batches:
            for k, s, w, n in zip(*(c.to_pylist() for c in batch.columns)):
                if (k, s) != (key, short):
                    if len(held) > 1:
                        found(short, held)
                        if len(out) >= 10_000:
                            yield flush()
                    key, short, held = k, s, {}
                held[w] = n
        if len(held) > 1:
            found(short, held)
        yield flush()

    dealt = small.repartition("key").sortWithinPartitions("key", "short", "word")
    return dealt.mapInArrow(pairs, "word string, near string, near_n bigint").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last form that following them leads to. A form is never rarer than its word, so there are no cycles."""
    spark = forms.sparkSession
    path = scratch.write(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    now = spark.read.parquet(path)
    while not now.where("moved").isEmpty():
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = now.select("word", "root").join(onward, "root", "left")
        after = scratch.write(stepped.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        scratch.drop(spark, path)
        path, now = after, spark.read.parquet(after)
    return now.select("word", "root")


def group_variants(words: DataFrame, ratio: int = 5, group: int = GROUP) -> DataFrame:
    """Lead rare words to the frequent ones at one edit.

    Takes (word, n), each word once; a null word is left out. Returns for each
    word ``form`` (its near word of largest n, ties to the smallest in code-point
    order, if that n is at least ``ratio`` times its own; else null), ``root``
    (the last form that following them leads to, or the word), ``n``, ``n_near``
    and ``form_n``. An empty table gives an empty result.
    """
    if ratio < 2 or group < 2:
        raise ValueError("ratio and group must be 2 at least")
    words = scratch.materialise(words.where("word is not null").select("word", F.col("n").cast("bigint").alias("n")), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), "near"))
    near = one_edit_pairs(words, group).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    fits = -F.col("best.rank") >= F.col("n") * ratio
    joined = joined.select("word", F.when(fits, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(fits, -F.col("best.rank")).alias("form_n"))
    joined = scratch.materialise(joined, "forms")
    lasts = roots(joined.where("form is not null"))
    return joined.join(lasts, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def find_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``group_variants`` over the words of whole texts; ``options`` are those of ``count_words``.

    Null texts have no words; a null id counts as an empty one; rows that repeat
    an id or a text count like others. Only the two named columns are read.
    """
    return group_variants(count_words(docs, id_col=id_col, text_col=text_col, **options))
