"""Exact dense search on a grid of blocks, by bounds on angles.

Vectors are dealt to the nearest of a bounded number of pivots, salted by the size
of the table, and packed into blocks of bounded bytes; a block has a centre and the
largest angle from it. Blocks of vectors are columns and blocks of queries rows of a
grid, whose cells, a bounded number of blocks each, are separate tasks: their number
grows with the blocks, whatever the keys are. In a cell the angle between a query and
a centre bounds the similarity of all of a block's vectors. Blocks come by falling
bound, and a query skips those that can't reach its k-th best.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Pivots at most, bytes of a block of vectors, queries of a block, and blocks of either kind in a cell.
PIVOTS, BYTES, QUERIES, CELL_VECTORS, CELL_QUERIES = 64, 2 << 20, 512, 16, 8
#: By how much a bound may be beaten by rounding.
SLACK = 1e-8


def usable(v: Column) -> Column:
    """Whether a vector has numbers only, and any that isn't 0."""
    return F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(rows: list) -> np.ndarray:
    m = np.array(rows, np.float64)
    m /= np.abs(m).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))


def _dealt(vectors: DataFrame, salts: int) -> DataFrame:
    """Rows (id, v) with the number of the nearest pivot of their dimension, those of one number and salt together."""
    picked = vectors.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).select("v").collect()  # PIVOTS rows
    pivots: dict[int, list] = {}
    for r in picked:
        pivots.setdefault(len(r["v"]), []).append(r["v"])
    units = {dim: unit(vs) for dim, vs in pivots.items()}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vs = batch.column(1).to_pylist()
            near = np.zeros(len(vs), np.int32)
            for dim in {len(v) for v in vs} & set(units):
                at = [i for i, v in enumerate(vs) if len(v) == dim]
                near[at] = (unit([vs[i] for i in at]) @ units[dim].T).argmax(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near)], names=["id", "v", "pivot"])

    marked = vectors.select("id", "v").mapInArrow(deal, vectors.select("id", "v", F.lit(0).alias("pivot")).schema)
    marked = marked.select("id", "v", F.size("v").alias("dim"), "pivot", F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"))
    keys = ["dim", "pivot", "salt"]
    return marked.repartition(*keys).sortWithinPartitions(*keys, "id").select("id", "v", "dim", F.xxhash64(*keys).alias("place"))


def _packed(rows: DataFrame, most: Callable[[int], int], extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows (id, v, dim, place, extra) as blocks of rows that follow each other with one place: their ids, unit vectors, centre and reach."""
    kinds = [to_arrow_type(rows.schema[c].dataType) for c in ("id", *extra)]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None

        def block() -> pa.RecordBatch:
            m = unit([h[1] for h in held])
            middle = m.sum(0)
            size = np.sqrt(middle @ middle)
            middle = middle / size if size > 1e-9 else m[0]
            reach = float(angles(m, middle[None]).max())
            lists = [pa.array([[h[c] for h in held]], pa.list_(k)) for c, k in zip((0, *range(4, 4 + len(extra))), kinds)]
            return pa.RecordBatch.from_arrays([pa.array([m.shape[1]], pa.int32()), pa.array([m.tobytes()]), pa.array([middle.tobytes()]), pa.array([reach]), *lists], names=["dim", "m", "centre", "reach", "ids", *extra])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (row[2:4] != now or len(held) >= most(row[2])):
                    yield block()
                    held = []
                held.append(row)
                now = row[2:4]
        if held:
            yield block()

    listed = "".join(f", {n} array<{rows.schema[c].dataType.simpleString()}>" for n, c in (("ids", "id"), *zip(extra, extra)))
    packed = rows.select("id", "v", "dim", "place", *extra).mapInArrow(pack, "dim int, m binary, centre binary, reach double" + listed)
    return packed.withColumn("block", F.monotonically_increasing_id())


def _grid(queries: DataFrame, vectors: DataFrame, meet: Callable[[list, list], dict], schema: str, extra: tuple[str, ...] = (), block_bytes: int = BYTES) -> DataFrame:
    """What ``meet`` makes of the blocks of queries and of vectors of each cell; rows that aren't usable are left out."""
    vectors, queries = (t.where(usable(F.col("v"))) for t in (vectors.select("id", "v"), queries.select("id", "v", *extra)))
    size = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim")).first()
    per_block = max(16, block_bytes // (8 * (size["dim"] or 1)))
    most = lambda dim: max(16, block_bytes // (8 * dim))
    v = _packed(_dealt(vectors, -(-size["n"] // (PIVOTS * per_block)) or 1), most)
    q = _packed(queries.select("id", "v", F.size("v").alias("dim"), F.lit(0).cast("bigint").alias("place"), *extra), lambda dim: QUERIES, extra)
    columns, rows = max(1, -(-size["n"] // (CELL_VECTORS * per_block))), max(1, -(-queries.count() // (CELL_QUERIES * QUERIES)))
    at = lambda n: F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")
    left = v.withColumn("col", at(columns)).withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
    right = q.withColumn("row", at(rows)).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))

    def blocks(table: pa.Table) -> list[dict]:
        found = sorted(table.to_pylist(), key=lambda b: b["block"])
        for b in found:
            b["m"], b["centre"] = np.frombuffer(b["m"], np.float64).reshape(-1, b["dim"]), np.frombuffer(b["centre"], np.float64)
        return found

    def run(one: pa.Table, two: pa.Table) -> pa.Table:
        return pa.table(meet(blocks(two), blocks(one)))

    return left.groupBy("dim", "row", "col").cogroup(right.groupBy("dim", "row", "col")).applyInArrow(run, schema)


def _gathered(parts: list[tuple], kinds: dict[str, str]) -> dict:
    """Columns of parts, each a tuple of arrays; without any, empty ones."""
    if not parts:
        return {n: np.empty(0, k) for n, k in kinds.items()}
    return {n: np.concatenate(c).astype(k) for (n, k), c in zip(kinds.items(), zip(*parts))}


def search(queries: DataFrame, vectors: DataFrame, k: int | None, positive: bool = True, digits: int = 9, counts: bool = False, block_bytes: int = BYTES) -> DataFrame:
    """The ``k`` best vectors of each cell for its queries, by cosine, ties by id, as (q, doc_id, score); without ``k`` all.

    With ``counts`` instead (pairs, compared): how many pairs a cell has, and of how many the similarity was computed.
    """

    def meet(asked: list[dict], blocks: list[dict]) -> dict:
        out, pairs, compared = [], 0, 0
        for a in asked if blocks else []:
            n, qs = len(a["ids"]), np.array(a["ids"])
            bounds = np.cos(np.maximum(0, angles(a["m"], np.stack([b["centre"] for b in blocks])) - np.array([b["reach"] for b in blocks])))
            best, names = np.full((n, k or 0), -2.0), np.zeros((n, k or 0), np.int64)
            for j in np.argsort(-bounds.max(0), kind="stable"):
                b = blocks[j]
                ids = np.array(b["ids"])
                at = np.arange(n) if k is None else np.flatnonzero(bounds[:, j] >= np.maximum(best[:, -1], 0.0 if positive else -2.0) - SLACK)
                pairs, compared = pairs + n * len(ids), compared + len(at) * len(ids)
                if not len(at):
                    continue
                sims = np.round(a["m"][at] @ b["m"].T, digits)
                if k is None:
                    row, col = np.nonzero(sims > 0 if positive else sims > -9)
                    out.append((qs[at[row]], ids[col], sims[row, col]))
                    continue
                both = np.hstack((best[at], sims))
                named = np.hstack((names[at], np.broadcast_to(ids, sims.shape)))
                order = np.lexsort((named, -both), axis=1)[:, :k]
                best[at], names[at] = np.take_along_axis(both, order, 1), np.take_along_axis(named, order, 1)
            row, col = np.nonzero(best > (0 if positive else -1.5))
            out.append((qs[row], names[row, col], best[row, col]))
        if counts:
            return {"pairs": np.array([pairs]), "compared": np.array([compared])}
        return _gathered(out, {"q": "i8", "doc_id": "i8", "score": "f8"})

    return _grid(queries, vectors, meet, "pairs bigint, compared bigint" if counts else "q bigint, doc_id bigint, score double", (), block_bytes)


def counted_ahead(queries: DataFrame, vectors: DataFrame, digits: int = 9, block_bytes: int = BYTES) -> DataFrame:
    """For queries (id, v, gold, gold_sim): how many vectors of each cell stand before the gold one, as (q, ahead).

    Blocks that are surely all before it or all behind it are not compared.
    """

    def meet(asked: list[dict], blocks: list[dict]) -> dict:
        out = []
        for a in asked if blocks else []:
            g, own, ahead = np.array(a["gold_sim"])[:, None], np.array(a["gold"])[:, None], np.zeros(len(a["ids"]), np.int64)
            away = angles(a["m"], np.stack([b["centre"] for b in blocks]))
            for j, b in enumerate(blocks):
                high, low = np.cos(np.maximum(0, away[:, j] - b["reach"])), np.cos(np.minimum(np.pi, away[:, j] + b["reach"]))
                ahead[low > g[:, 0] + SLACK] += len(b["ids"])
                at = np.flatnonzero((low <= g[:, 0] + SLACK) & (high >= g[:, 0] - SLACK))
                ids = np.array(b["ids"])[None]
                s = np.round(a["m"][at] @ b["m"].T, digits)
                ahead[at] += (((s > g[at]) | (s == g[at]) & (ids < own[at])) & (ids != own[at])).sum(1)
            out.append((np.array(a["ids"]), ahead))
        return _gathered(out, {"q": "i8", "ahead": "i8"})

    return _grid(queries, vectors, meet, "q bigint, ahead bigint", ("gold", "gold_sim"), block_bytes)
