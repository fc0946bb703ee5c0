"""Near-duplicate embeddings by lattice hashing.

Each of several tables projects the unit vectors to two blocks of eight random
orthonormal directions and decodes every block to the nearest point of the
lattice E8. The pair of lattice points is the vector's home cell; the cells that
are nearest after it are probed as well. In each cell, those at home are compared
with all members by their cosine in double precision.

Equal vectors are one class with a count and are compared once. A cell of many
members is split into blocks, and pairs of blocks are separate tasks; many small
cells are compared in one step. A pair counts where it meets first in the order
of tables, which the cells that come with each vector tell, so that no list of
pairs is needed: a step returns a sum for each member and a forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm import scratch
from corpuskit.llm.components import connected_components


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest points with whole coordinates of even sum."""
    point = np.rint(x)
    off = x - point
    odd = np.flatnonzero(point.sum(1).astype(np.int64) & 1)
    worst = np.abs(off[odd]).argmax(1)
    point[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest lattice points; E8 is the points of even sum and the same moved by a half."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None], whole, half)


@lru_cache(maxsize=1)
def shortest_e8() -> np.ndarray:
    """The 240 shortest vectors: from a lattice point to its neighbours."""
    out = []
    for i in range(8):
        for j in range(i):
            for a, b in product((1, -1), repeat=2):
                v = np.zeros(8)
                v[i], v[j] = a, b
                out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def _least(cost: np.ndarray, n: int) -> np.ndarray:
    """The places of the ``n`` smallest of each row, by rising cost."""
    few = np.argpartition(cost, min(n, cost.shape[1]) - 1, axis=1)[:, :n] if n else np.zeros((len(cost), 0), np.int64)
    return np.take_along_axis(few, np.argsort(np.take_along_axis(cost, few, 1), axis=1, kind="stable"), 1)


class Lattice:
    """The cells of unit vectors of one dimension, in all tables."""

    def __init__(self, dim: int, tables: int, blocks: int, probes: int, scale: float, seed: int):
        rng = np.random.default_rng([seed, dim])
        self.dim, self.blocks, self.probes = dim, blocks, probes
        self.wide = max(dim, 8 * blocks)
        # A block holds 8 of the directions, so that distances in it shrink with the root of their number.
        scale *= np.sqrt(self.wide / 64)
        self.turns = [np.linalg.qr(rng.standard_normal((self.wide, 8 * blocks)))[0] * scale for _ in range(tables)]
        self.mix = rng.integers(1, 1 << 62, (tables, 8 * blocks), dtype=np.int64) * 2 + 1
        self.salt = rng.integers(1, 1 << 62, tables, dtype=np.int64)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """Keys by (vector, table, cell); the first cell is the home."""
        if self.wide > self.dim:
            unit = np.pad(unit, ((0, 0), (0, self.wide - self.dim)))
        near = shortest_e8()
        length = (near**2).sum(1)
        out = np.empty((len(unit), len(self.turns), 1 + self.probes), np.int64)
        for t, turn in enumerate(self.turns):
            x = unit @ turn
            homes, moves, costs = [], [], []
            for b in range(self.blocks):
                y = x[:, 8 * b : 8 * b + 8]
                home = nearest_e8(y)
                cost = length - 2 * ((y - home) @ near.T)
                pick = _least(cost, self.probes)
                homes.append((2 * home).astype(np.int64))
                # A move adds the same to a key wherever it starts, as keys are sums.
                moves.append(((2 * near).astype(np.int64) @ self.mix[t, 8 * b : 8 * b + 8])[pick])
                costs.append(np.take_along_axis(cost, pick, 1))
            home = np.concatenate(homes, 1) @ self.mix[t] + self.salt[t]
            cost, move = np.concatenate(costs, 1), np.concatenate(moves, 1)
            pick = _least(cost, self.probes)
            out[:, t, 0] = home
            out[:, t, 1:] = home[:, None] + np.take_along_axis(move, pick, 1)
        return out


def _matrices(column: pa.Array, kind=np.float64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of one dimension each: their places and their values, in double precision."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(kind)
    sizes = np.diff(offsets)
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield at, values[offsets[at][:, None] + np.arange(dim)]


def _unit(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(1, keepdims=True)
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def find_near_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    tables: int = 6,
    blocks: int = 2,
    probes: int = 4,
    scale: float = 3.0,
    seed: int = 7,
    block_rows: int = 2048,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Link vectors of cosine ``threshold`` or more that meet in a cell.

    Returns a row for each row of ``vectors``: the id, ``n_links`` (other rows
    linked directly), ``component_id`` (the smallest id reachable) and ``kept``
    (the id is the component's). With the defaults a pair at cosine 0.9 meets
    with a probability of 0.99, at 0.96 of 0.9999, in 16 dimensions and more;
    ``scale`` is that for 64 and grows with the root of the dimension. All links
    are verified. For far more than 10^8 different vectors take ``blocks=3`` and
    more tables.

    Vectors that are null, empty, zero, or hold null or non-finite numbers link
    with nothing and are components of their own; so do vectors of different
    dimensions with each other. Equal vectors, also of repeated ids, are linked.
    Null ids pass through and never name a component that has another id. An
    empty table gives an empty result. Only the two named columns are read.
    """
    v = F.col("v")
    usable = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).withColumn("usable", usable)
    good = rows.where("usable").select("id", "v")
    classes = good.groupBy("v").agg(F.min("id").alias("low"), F.count("*").alias("n")).withColumn("cid", F.monotonically_increasing_id())
    classes = scratch.materialise(classes, "classes")

    lattices: dict[int, Lattice] = {}

    def lattice(dim: int) -> Lattice:
        if dim not in lattices:
            lattices[dim] = Lattice(dim, tables, blocks, probes, scale, seed)
        return lattices[dim]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cid = batch.column(0).to_numpy()
            for at, m in _matrices(batch.column(1)):
                for a in range(0, len(at), 2048):
                    cells = lattice(m.shape[1]).cells(_unit(m[a : a + 2048]))
                    ends = pa.array(np.arange(len(cells) + 1) * cells[0].size, pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(cid[at[a : a + 2048]]), pa.ListArray.from_arrays(ends, pa.array(cells.ravel()))], names=["cid", "cells"])

    placed = scratch.materialise(classes.select("cid", "v").mapInArrow(place, "cid bigint, cells array<bigint>"), "cells")
    members = placed.select("cid", F.posexplode("cells").alias("at", "key"))
    members = members.select("key", F.floor(F.col("at") / (1 + probes)).cast("int").alias("part"), (F.col("at") % (1 + probes) == 0).alias("home"), "cid")
    busy = members.groupBy("key", "part").agg(F.count("*").alias("many"), F.count_if("home").alias("homes")).where("many > 1 and homes > 0")
    busy = busy.select("key", "part", F.ceil(F.col("many") / block_rows).cast("int").alias("split"))
    # Every member goes to all blocks of those at home, and those at home to all blocks of members.
    mine = F.pmod(F.xxhash64("cid"), F.col("split")).cast("int")
    each = F.sequence(F.lit(0), F.col("split") - 1)
    meet = members.join(busy, ["key", "part"]).withColumn("mine", mine)
    guest = meet.select("key", "part", "cid", F.explode(each).alias("a"), F.col("mine").alias("b"), F.lit(False).alias("host"))
    host = meet.where("home").select("key", "part", "cid", F.col("mine").alias("a"), F.explode(each).alias("b"), F.lit(True).alias("host"))
    whole = classes.select("cid", "n", "v").join(placed, "cid")
    dealt = guest.union(host).join(whole, "cid").select("key", "part", "a", "b", "host", "cid", "n", "cells", "v")
    dealt = dealt.repartition("key", "part", "a", "b").sortWithinPartitions("key", "part", "a", "b")

    def pairs_of(cell: np.ndarray, host: np.ndarray, unit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (host, guest) at the threshold; rows are by cell, hosts first."""
        n_cells = int(cell[-1]) + 1
        hosts, guests = np.flatnonzero(host), np.flatnonzero(~host)
        first = np.searchsorted(cell[guests], np.arange(n_cells))
        many = np.bincount(cell[guests], minlength=n_cells)
        each = many[cell[hosts]]
        large = np.bincount(cell[hosts], minlength=n_cells) * many > 20_000
        for c in np.flatnonzero(large):  # by products of matrices
            mine, others = hosts[cell[hosts] == c], guests[first[c] : first[c] + many[c]]
            for a in range(0, len(mine), 1024):
                i, j = np.nonzero(unit[mine[a : a + 1024]] @ unit[others].T >= threshold)
                yield mine[a : a + 1024][i], others[j]
        each = np.where(large[cell[hosts]], 0, each)
        ends = np.cumsum(each)
        start = 0
        while start < len(hosts):  # pair by pair, a bounded number at once
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + 40_000, "right")))
            n = each[start:stop]
            i = np.repeat(hosts[start:stop], n)
            j = guests[np.repeat(first[cell[hosts[start:stop]]] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            near = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
            yield i[near], j[near]
            start = stop

    def settle(cell: np.ndarray, part: np.ndarray, host: np.ndarray, cid: np.ndarray, n: np.ndarray, cells: np.ndarray, unit: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Sums of links and a forest, of whole cells of vectors of one dimension."""
        order = np.lexsort((~host, cell))
        cell, part, host, cid, n, cells, unit = (x[order] for x in (cell, part, host, cid, n, cells, unit))
        cells = cells.reshape(len(cells), -1, 1 + probes)
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        for i, j in pairs_of(cell, host, unit):
            other = cid[i] != cid[j]
            i, j = i[other], j[other]
            for a in range(0, len(i), 20_000):
                x, y = i[a : a + 20_000], j[a : a + 20_000]
                swap = cid[x] > cid[y]
                low, high = np.where(swap, y, x), np.where(swap, x, y)
                # Meetings in order: at the home of the smaller id, at that of the larger, table after table.
                met = np.stack(((cells[high] == cells[low][:, :, :1]).any(2), (cells[low] == cells[high][:, :, :1]).any(2)), 2).reshape(len(x), -1)
                here = met.argmax(1) == 2 * part[x] + swap
                kept.append((x[here], y[here]))
        if not kept or not sum(len(k[0]) for k in kept):
            return
        i, j = np.concatenate([k[0] for k in kept]), np.concatenate([k[1] for k in kept])
        ids, back = np.unique(cid[np.concatenate((i, j))], return_inverse=True)
        x, y = back[: len(i)], back[len(i) :]
        links = np.bincount(x, n[j], len(ids)) + np.bincount(y, n[i], len(ids))
        root = np.arange(len(ids))
        while True:
            before = root.copy()
            np.minimum.at(root, x, before[y])
            np.minimum.at(root, y, before[x])
            root = np.minimum(root, root[root])
            if (root == before).all():
                break
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links.astype(np.int64)), pa.array(ids[root])], names=["cid", "links", "low"])

    def step(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        keys = np.stack([rows.column(k).to_numpy() for k in range(4)])
        cell = np.concatenate(([0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(0))))
        part, host, cid, n = (rows.column(k).to_numpy(zero_copy_only=False) for k in (1, 4, 5, 6))
        ((_, cells),) = _matrices(rows.column(7), np.int64)
        for at, m in _matrices(rows.column(8)):  # vectors of different dimensions never link
            own = np.unique(cell[at], return_inverse=True)[1]
            yield from settle(own, part[at], host[at], cid[at], n[at], cells[at], _unit(m))

    def compare(batches: Iterator[pa.RecordBatch], at_once: int = 8192) -> Iterator[pa.RecordBatch]:
        """Whole cells, about ``at_once`` rows in a step; a single cell has ``block_rows`` hosts and guests or some more."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < at_once:
                continue
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            keys = np.stack([rows.column(k).to_numpy() for k in range(4)])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
            if len(edges):  # the last cell may go on
                yield from step([rows.slice(0, int(edges[-1]))])
                rows = rows.slice(int(edges[-1]))
            held = [rows]
        if held:
            yield from step(held)

    found = scratch.materialise(dealt.mapInArrow(compare, "cid bigint, links bigint, low bigint"), "links")
    sums = found.groupBy("cid").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select("cid", "low"), "cid", "low").withColumnRenamed("node", "cid")
    named = classes.join(sums, "cid", "left").join(parts, "cid", "left")
    named = named.select("v", "low", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "cid").alias("root"))
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = named.join(lows, "root").select("v", "n_links", "component_id")
    linked = good.join(named, "v").select("id", "n_links", "component_id")
    alone = rows.where("not usable").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
