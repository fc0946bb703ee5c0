"""Mixing sources to target weights along a time-varying curriculum.

Every source has a target in words. Its weight changes over training time t from
0 to 1 along a schedule; the integral of the schedule, scaled to the target, is
the source's cumulative demand. Documents stand in a fixed pseudo-random order
that repeats as often as the target needs. The words before a document in this
order, the cumulative supply, give its training position by the inverse of the
demand. Documents are then range-sorted by position: as the demand of all sources
until any time is known, the bounds of the ranges are computed, not sampled.

Cumulative sums are in two levels: sums of hash buckets of each source, and
running sums within a bucket, so that no task holds a source. The number of
buckets grows with the table; the order, and so the result, doesn't depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpuskit.llm import scratch

WORDS = r"[^\x20\x09-\x0D]+"
#: First and last weight over training of the sources at each place of the order, repeating: falling, level, rising.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def words(text: Column) -> Column:
    """Runs of other characters than ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word."""
    pieces = F.regexp_extract_all(text, F.lit(rf"([\x20\x09-\x0D]*{WORDS})"), F.lit(1))
    return F.array_join(F.slice(pieces, F.lit(1), F.greatest(n, F.lit(0)).cast("int")), "")


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """Add the sum of each column over all rows before, along a total order, without moving all rows to one task.

    As many sums as partitions come to the driver. Returns the sums over all rows as well.
    """
    ranged = scratch.materialise(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranged")
    found = sorted(ranged.groupBy("part").agg(*(F.sum(c).alias(n) for n, c in sums.items())).collect(), key=lambda r: r["part"])
    within = W.partitionBy("part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    totals = {}
    for name, column in sums.items():
        before, run = [F.lit(-1), F.lit(0)], 0
        for r in found:
            before += [F.lit(r["part"]), F.lit(run)]
            run += r[name]
        totals[name] = run
        ranged = ranged.withColumn(name, F.coalesce(F.sum(column).over(within), F.lit(0)) + F.element_at(F.create_map(*before), F.col("part")))
    return ranged.drop("part"), totals


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3, share: float = 1.0) -> DataFrame:
    """Targets of sources (columns ``source``, ``source_size``).

    Sources in order of code points, null last, have ``weights``, repeating, and
    share ``share`` of all sizes by them. A target stops at ``cap`` times the
    source's size, and what is above is shared again by weight until none is.
    Adds ``place``, ``weight``, ``target``.

    In closed form: sources stop in the order of size by weight. The words for a
    unit of weight are those that the sources stopped before a place leave over;
    the first place at which its source doesn't stop gives the unit.
    """
    placed, _ = running_sums(sizes, [F.col("source").asc_nulls_last()], {"place": F.lit(1)})
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    placed = placed.withColumn("weight", weight).withColumn("ratio", F.col("source_size") / F.col("weight").cast("double"))
    table, sums = running_sums(placed, [F.col("ratio"), F.col("place")], {"closed_size": F.col("source_size"), "closed_weight": F.col("weight")})
    size, weight = F.col("source_size"), F.col("weight").cast("double")
    if not sums["closed_weight"]:
        return table.drop("ratio", "closed_size", "closed_weight").withColumn("target", F.lit(0.0))
    unit = (F.lit(sums["closed_size"]) * share - F.col("closed_size") * cap).cast("double") / (F.lit(sums["closed_weight"]) - F.col("closed_weight"))
    free = weight * unit <= size * cap
    found = table.agg(F.min_by(F.when(free, unit), F.when(free, F.struct("ratio", "place"))).alias("unit"), F.max(size * cap / weight).alias("most")).first()
    level = F.lit(float(found["most"] if found["unit"] is None else found["unit"]))
    return table.withColumn("target", F.least(weight * level, size.cast("double") * cap)).drop("ratio", "closed_size", "closed_weight")


def invert_demand(share: Column, first: Column, last: Column) -> Column:
    """The time t at which a weight that goes from ``first`` to ``last`` in a line has this share of its integral.

    Solves first * t + (last - first) * t^2 / 2 = share * (first + last) / 2.
    """
    bend, wanted = (last - first) / 2, share * (first + last) / 2
    root = F.sqrt(F.greatest(first * first + bend * 4 * wanted, F.lit(0.0)))
    # In this form nothing cancels, and a level weight needs no case of its own.
    return F.least(F.greatest(F.when(first + root > 0, wanted * 2 / (first + root)).otherwise(F.lit(0.0)), F.lit(0.0)), F.lit(1.0))


def plan_mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    cap: float = 3,
    share: float = 1.0,
    schedules=SCHEDULES,
    buckets: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    payload: bool = False,
) -> DataFrame:
    """Which words of which documents the mix takes, and when.

    Returns a row for each row of ``docs``: ``id``, ``source``, ``size``,
    ``source_size``, ``target``, ``taken`` (words taken, repeats counted) and
    ``copies``, an array of (``position``, ``words``, ``demand``) for each time it
    is taken, by position; ``demand`` is the part of all words that the mix takes
    before that position. With ``payload`` also ``doc``, a struct of all columns.
    A source's taken words sum to its target, rounded: its last document may be
    taken in part. No document is taken more than ``cap`` times its size.

    Null texts have no words; documents without words are never taken. A null
    source is a source of its own, the last in order. The order of a source's
    documents is that of digests of id and text, so that null and repeated ids
    spread like others and runs agree; rows that repeat an id and a text are
    alike. An empty table gives an empty result. Clashing names are no matter.
    """
    if cap < 0 or not weights or min(weights) <= 0 or any(min(s) < 0 or sum(s) <= 0 for s in schedules):
        raise ValueError("weights must be positive, cap and schedules not negative")
    if buckets is None:
        buckets = max(4096, 1 << (docs.count() >> 16).bit_length())
    text = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    mixed = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), text).cast("binary"))
    # A key that isn't null, so that the join and the window after it share one partitioning.
    name = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))
    whole = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")] if payload else []
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), name.alias("name"), words(F.col(text_col)).alias("size"), mixed.alias("mixed"), *whole)
    rows = rows.withColumn("bucket", (F.conv(F.substring("mixed", 1, 8), 16, 10).cast("bigint") * buckets / (1 << 32)).cast("int"))
    sums = scratch.materialise(rows.groupBy("source", "name", "bucket").agg(F.sum("size").alias("bucket_size")), "buckets")
    targets = source_targets(sums.groupBy("source", "name").agg(F.sum("bucket_size").alias("source_size")), weights, cap, share)
    targets = scratch.materialise(targets.withColumn("kind", (F.col("place") % len(schedules) + 1).cast("int")), "targets")
    goal = F.floor(F.col("target") + 0.5)
    goals = {r["kind"]: int(r["goal"]) for r in targets.groupBy("kind").agg(F.sum(goal).alias("goal")).collect()}  # one for each schedule
    earlier = F.coalesce(F.sum("bucket_size").over(W.partitionBy("name").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sums.withColumn("start", earlier).join(targets.drop("source"), "name")
    joined = rows.join(starts.select("name", "bucket", "start", "source_size", "target", "kind"), ["name", "bucket"])
    order = W.partitionBy("name", "bucket").orderBy("mixed", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    joined = joined.withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(order), F.lit(0))).withColumn("goal", goal)
    kinds = F.array(*(F.struct(F.lit(float(a)).alias("first"), F.lit(float(b)).alias("last")) for a, b in schedules))
    joined = joined.withColumn("schedule", F.element_at(kinds, F.col("kind")))
    copies = []
    for k in range(max(1, -int(-cap // 1))):
        at = F.col("before") + F.col("source_size") * k
        got = F.least(F.greatest(F.col("goal") - at, F.lit(0)), F.col("size"))
        spot = invert_demand((at + got / 2) / F.greatest(F.col("goal"), F.lit(1)), F.col("schedule.first"), F.col("schedule.last"))
        copies.append(F.struct(spot.alias("position"), got.cast("bigint").alias("words")))
    planned = joined.withColumn("copies", F.filter(F.array(*copies), lambda c: c["words"] > 0))
    taken = F.aggregate("copies", F.lit(0).cast("bigint"), lambda a, c: a + c["words"])
    timed = F.transform("copies", lambda c: c.withField("demand", demand(c["position"], schedules, goals)))
    return planned.select("id", "source", "size", "source_size", "target", taken.alias("taken"), timed.alias("copies"), *(["doc"] if payload else []))


def demand(time: Column, schedules, goals: dict[int, int]) -> Column:
    """The part of all words that is wanted until a time; ``goals``: those of all sources of each schedule, from 1."""
    parts = []
    for kind, goal in goals.items():
        first, last = map(float, schedules[kind - 1])
        parts.append((time * first + time * time * ((last - first) / 2)) * (goal / ((first + last) / 2) / max(sum(goals.values()), 1)))
    total = F.lit(0.0)
    for part in parts:
        total = total + part
    return F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0))


def in_training_order(planned: DataFrame) -> DataFrame:
    """Rows of ``plan_mix`` range-sorted by their first position; those that are never taken come last."""
    order = [F.get("copies.position", F.lit(0)).asc_nulls_last(), F.xxhash64("id")]
    return planned.repartitionByRange(*order).sortWithinPartitions(*order)


def mix_documents(docs: DataFrame, partitions: int | None = None, text_col: str = "text", **options) -> DataFrame:
    """The mixed corpus in training order: all columns of ``docs``, a row for each time a document is taken.

    A document taken in part has the text up to its last taken word. A partition
    holds an equal part of the words, those between two times, and is sorted by
    position; there are ``partitions`` or else ``spark.sql.shuffle.partitions``. Takes
    the options of ``plan_mix`` and nulls and repeats as it does.
    """
    planned = plan_mix(docs, text_col=text_col, payload=True, **options)
    partitions = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = planned.select("doc", "size", F.explode("copies").alias("copy"))
    part = F.least(F.floor(F.col("copy.demand") * partitions), F.lit(partitions - 1)).cast("int")
    ranged = rows.withColumn("part", part).repartitionById(partitions, "part").sortWithinPartitions("copy.position", F.xxhash64("doc"))
    text = F.col(f"doc.`{text_col}`")
    cut = F.when(F.col("copy.words") < F.col("size"), first_words(text, F.col("copy.words"))).otherwise(text)
    return ranged.select(*((cut if c == text_col else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))
