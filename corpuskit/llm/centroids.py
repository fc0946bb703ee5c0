"""Centroid clustering: Lloyd's rounds in exact integers, each by a dual-tree search.

Vectors are rounded to integers. Every partition cuts its vectors into blocks of
bounded size and builds a cover tree over each: the rows of a node lie within its
radius of its centre, itself a row; its children's radius is at most half as
large and their centres are further apart than that. The blocks are written once.
In a round the centroids, k of them whatever the table, get a tree of the same
kind. Pairs of a node of vectors and a node of centroids are dropped where their
distance bounds rule the centroids out for every vector of the node; a node with
one centroid left is assigned as a whole, by sums over its rows. Leaf pairs are
compared exactly. Bounds are in floating point with a margin, so that ties are
always left to the comparison in integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from corpuskit.llm import scratch

#: Vectors of a tree, and of a leaf at most.
BLOCK, LEAF = 2048, 16
#: Pairs whose distances are computed in one step; they bound a task's memory.
PAIRS = 1 << 16


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def paired(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows ``at_a`` and ``at_b``, a bounded number at a time."""
    parts = [squared(a[at_a[i : i + PAIRS]], b[at_b[i : i + PAIRS]]) for i in range(0, len(at_a), PAIRS)]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


@dataclass
class CoverTree:
    """``order`` lists the rows so that those of node i are ``order[first[i]:last[i]]``; its children are nodes ``kid[i]`` to ``end[i]``."""

    order: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    last: np.ndarray
    kid: np.ndarray
    end: np.ndarray

    @classmethod
    def build(cls, rows: np.ndarray, leaf: int = LEAF) -> CoverTree:
        """Nodes are made breadth first. Equal rows are in one leaf, however many there are."""
        order = np.arange(len(rows))
        gap = np.sqrt(squared(rows, rows[:1]).astype(float))
        nodes = [[0, float(gap.max()), 0, len(rows), 0, 0]]
        at = 0
        while at < len(nodes):
            centre, radius, first, last, _, _ = nodes[at]
            if last - first > leaf and radius > 0:
                mine = order[first:last]
                points = rows[mine]
                near = np.sqrt(squared(points, rows[centre][None]).astype(float))
                owner, centres = np.zeros(len(mine), np.int64), [centre]
                # The farthest row is the next centre until all rows are within half the radius of one.
                while near[far := int(near.argmax())] > radius / 2:
                    centres.append(int(mine[far]))
                    there = np.sqrt(squared(points, points[far][None]).astype(float))
                    closer = there < near
                    near[closer], owner[closer] = there[closer], len(centres) - 1
                by = np.argsort(owner, kind="stable")
                order[first:last] = mine[by]
                bounds = np.searchsorted(owner[by], np.arange(len(centres) + 1))
                reach = np.maximum.reduceat(near[by], bounds[:-1])
                nodes[at][4:] = [len(nodes), len(nodes) + len(centres)]
                nodes += [[c, float(r), first + int(a), first + int(b), 0, 0] for c, r, a, b in zip(centres, reach, bounds, bounds[1:])]
            at += 1
        table = list(zip(*nodes))
        return cls(order, np.array(table[0]), np.array(table[1], float), *(np.array(c) for c in table[2:]))


def search(tree: CoverTree, rows: np.ndarray, centres: np.ndarray, over: CoverTree) -> tuple[np.ndarray, int]:
    """The nearest centroid of each place of ``tree.order``, ties to the smaller number, and how many rows were compared one by one.

    ``over`` is the tree of the centroids, with leaves of one centroid or of equal ones.
    """
    found, compared = np.empty(len(rows), np.int64), 0
    number = np.array([over.order[a:b].min() for a, b in zip(over.first, over.last)])  # of a leaf: the smallest of equal centroids
    front, own, cand = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(front):
        gap = np.sqrt(paired(rows, tree.centre[front[own]], centres, over.centre[cand]).astype(float))
        mine, theirs = tree.radius[front[own]], over.radius[cand]
        upper = np.full(len(front), np.inf)
        np.minimum.at(upper, own, gap + mine)  # the centre of a node of centroids is a centroid
        keep = gap - mine - theirs <= upper[own] * (1 + 1e-9) + 1e-9
        own, cand, theirs, mine = own[keep], cand[keep], theirs[keep], mine[keep]
        left = np.bincount(own, minlength=len(front))
        sure = (left[own] == 1) & (theirs == 0)
        for node, c in zip(front[own[sure]], number[cand[sure]]):
            found[tree.first[node] : tree.last[node]] = c
        own, cand, theirs, mine = own[~sure], cand[~sure], theirs[~sure], mine[~sure]
        leaf = tree.kid[front] == tree.end[front]
        # The larger of two nodes is opened; beside leaves of vectors, every node of centroids.
        opens = (theirs > 0) & (leaf[own] | (theirs >= mine))
        opened = np.zeros(len(front), bool)
        opened[own[opens]] = True
        ready = ~opened[own]
        at_leaf = ready & leaf[own]
        compared += compare(tree, rows, centres, front, own[at_leaf], number[cand[at_leaf]], found)
        # Nodes of vectors that are opened hand all their candidates down.
        down = ready & ~leaf[own]
        kids = (tree.end - tree.kid)[front[own[down]]]
        child = np.repeat(tree.kid[front[own[down]]], kids) + within(kids)
        next_cand = [np.repeat(cand[down], kids)]
        next_node = [child]
        stay = opened[own] & ~opens
        next_node.append(front[own[stay]])
        next_cand.append(cand[stay])
        grown = (over.end - over.kid)[cand[opens]]
        next_node.append(np.repeat(front[own[opens]], grown))
        next_cand.append(np.repeat(over.kid[cand[opens]], grown) + within(grown))
        front, own = np.unique(np.concatenate(next_node), return_inverse=True)
        cand = np.concatenate(next_cand)
    return found, compared


def within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def compare(tree: CoverTree, rows: np.ndarray, centres: np.ndarray, front: np.ndarray, own: np.ndarray, numbers: np.ndarray, found: np.ndarray) -> int:
    """Fill ``found`` for the rows of leaves from their candidates; returns the number of pairs."""
    total = 0
    order = np.lexsort((numbers, own))
    own, numbers = own[order], numbers[order]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.empty(0, np.int64)
    for a, b in zip(starts, np.r_[starts[1:], len(own)]):
        node, some = front[own[a]], numbers[a:b]
        at = np.arange(tree.first[node], tree.last[node])
        step = max(1, PAIRS // len(some))
        for i in range(0, len(at), step):
            part = rows[tree.order[at[i : i + step]]]
            far = paired(part, np.repeat(np.arange(len(part)), len(some)), centres, np.tile(some, len(part))).reshape(len(part), len(some))
            found[at[i : i + step]] = some[far.argmin(1)]  # the first of equal ones
            total += far.size
    return total


def digits(vectors, scale: int) -> np.ndarray:
    """floor(scale * x) of each component, or an error where squared distances wouldn't fit into 64 bits."""
    raised = np.floor(np.asarray(vectors, np.float64) * scale)
    if raised.size and np.abs(raised).max() > (2**61 / raised.shape[1]) ** 0.5:
        raise ValueError("components are too large for exact distances of 64 bits")
    return raised.astype(np.int64)


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dimension: int = 64,
    scale: int = 1024,
    seed: int = 3,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block: int = BLOCK,
    leaf: int = LEAF,
) -> DataFrame:
    """Assign every vector to one of ``k`` centroids after ``rounds`` of Lloyd's algorithm in integers.

    A component x becomes floor(``scale`` * x). The first centroids are the k
    vectors with the smallest sha256 of ``<seed>:<id>``, in that order; ties of
    repeated ids go by components. A round assigns each vector to the nearest
    centroid, ties to the smaller number, and moves each centroid that has
    vectors to their floored mean. Vectors are assigned once more at the end.

    Returns a row for each vector kept: the id, ``cluster``, ``distance``
    (squared), ``cluster_inertia`` and ``inertia`` (sums of distances over the
    cluster and over all) and ``centroid_sha256`` (of the final centroid's
    components in decimal, joined by commas).

    Vectors that are null, have another number of components, or hold null or
    non-finite ones are left out. Vectors with a null id take part but never
    start a centroid; repeated ids are rows of their own. With fewer than k
    vectors there are fewer centroids. An empty table gives an empty result.
    Only the two named columns are read. The driver holds k centroids.
    """
    if min(k, dimension, block, leaf) < 1 or rounds < 0:
        raise ValueError("k, dimension, block and leaf must be positive, rounds not negative")
    spark, kind = vectors.sparkSession, vectors.schema[id_col].dataType
    arrow_id = to_arrow_type(kind)
    # Not a number counts as the largest number; a null component makes the comparison null.
    finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    kept = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    kept = kept.where(F.col("v").isNotNull() & (F.size("v") == dimension) & finite)
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    seeds = kept.where("id is not null").orderBy(name, "v").limit(k).select("v").collect()  # k rows
    centres = digits([r["v"] for r in seeds], scale) if seeds else np.empty((0, dimension), np.int64)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_ids, held = [], []

        def pack(ids: pa.Array, rows: np.ndarray) -> pa.RecordBatch:
            tree = CoverTree.build(rows, leaf)
            rows = rows[tree.order].astype(np.int32) if np.abs(rows).max() < 2**31 else rows[tree.order]
            place = np.empty(len(rows), np.int64)
            place[tree.order] = np.arange(len(rows))
            nodes = np.stack([place[tree.centre], tree.first, tree.last, tree.kid, tree.end]).astype(np.int64)
            ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(tree.order)))
            return pa.RecordBatch.from_arrays([ids, pa.array([rows.dtype.itemsize], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (rows, nodes, tree.radius))], names=["ids", "width", "rows", "nodes", "radius"])

        for batch in batches:
            held_ids.append(batch.column(0))
            held.append(digits(np.asarray(batch.column(1).flatten()).reshape(-1, dimension), scale))
            while sum(map(len, held)) >= block:
                ids, rows = pa.concat_arrays(held_ids), np.concatenate(held)
                yield pack(ids[:block], rows[:block])
                held_ids, held = [ids[block:]], [rows[block:]]
        if sum(map(len, held)):
            yield pack(pa.concat_arrays(held_ids), np.concatenate(held))

    packed = [StructField("ids", ArrayType(kind)), StructField("width", IntegerType()), *(StructField(n, BinaryType()) for n in ("rows", "nodes", "radius"))]
    blocks = scratch.materialise(kept.mapInArrow(build, StructType(packed)), "trees")

    def opened(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, CoverTree]]:
        for i in range(len(batch)):
            ids, width, rows, nodes, radius = (batch.column(c)[i] for c in range(5))
            rows = np.frombuffer(rows.as_py(), f"<i{width.as_py()}").reshape(-1, dimension).astype(np.int64)
            nodes = np.frombuffer(nodes.as_py(), np.int64).reshape(5, -1)
            yield ids.values, rows, CoverTree(np.arange(len(rows)), nodes[0], np.frombuffer(radius.as_py(), float), *nodes[1:])

    def moved(now: np.ndarray) -> np.ndarray:
        """The centroids after a round; k rows of sums come to the driver."""

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            over = CoverTree.build(now, 1)
            total, n = np.zeros_like(now), np.zeros(len(now), np.int64)
            for batch in batches:
                for _, rows, tree in opened(batch):
                    found, _ = search(tree, rows, now, over)
                    by = np.argsort(found, kind="stable")
                    present, starts = np.unique(found[by], return_index=True)
                    total[present] += np.add.reduceat(rows[by], starts)
                    n += np.bincount(found, minlength=len(now))
            full = np.flatnonzero(n)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1) * dimension, pa.int32()), pa.array(total[full].ravel(), pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(n[full]), lists], names=["cluster", "n", "sums"])

        parts = blocks.mapInArrow(sums, "cluster int, n bigint, sums array<bigint>")
        each = parts.select("cluster", "n", F.posexplode("sums").alias("at", "part"))
        after = now.copy()
        for r in each.groupBy("cluster", "at").agg(F.sum("part").alias("sum"), F.sum("n").alias("n")).collect():
            after[r["cluster"], r["at"]] = r["sum"] // r["n"]
        return after

    for _ in range(rounds if len(centres) else 0):
        centres = moved(centres)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over = CoverTree.build(centres, 1)
        for batch in batches:
            for ids, rows, tree in opened(batch):
                found, _ = search(tree, rows, centres, over)
                yield pa.RecordBatch.from_arrays([ids.cast(arrow_id), pa.array(found, pa.int32()), pa.array(squared(rows, centres[found]))], names=["id", "cluster", "distance"])

    placed = StructType([StructField("id", kind), StructField("cluster", IntegerType()), StructField("distance", LongType())])
    if len(centres):
        assigned = scratch.materialise(blocks.mapInArrow(last, placed), "assigned")
    else:
        assigned = spark.createDataFrame([], placed)
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sums = sums.crossJoin(F.broadcast(sums.agg(F.sum("cluster_inertia").alias("inertia"))))  # k rows and one
    names = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centres.tolist())]
    about = sums.join(F.broadcast(spark.createDataFrame(names, "cluster int, centroid_sha256 string")), "cluster")
    found = assigned.join(F.broadcast(about), "cluster")
    return found.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
