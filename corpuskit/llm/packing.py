"""Packing token pieces into windows by Karmarkar-Karp multiway differencing.

Every partition packs its own documents, a group of bounded size at a time, so
nothing is shuffled and a lost task repeats alone. Whole windows are cut from
long documents first. What is left of each document, shorter than a window,
goes to a group; the group's pieces are dealt to windows by differencing:
partial partitions with opposing imbalances are merged, the largest sums of one
with the smallest of the other, until one partition with nearly equal sums is
left. The number of windows is at first what the group's tokens fill at least;
it rises whenever a sum exceeds the capacity, until every piece fits uncut.

The near-equal windows that come out leave a little room each. With
``cut=True`` the emptiest of them are then taken apart, token by token, to fill
the fullest, so that all windows but one hold exactly the capacity. That one
waits for the next group; at the end of a partition it is the only short one.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpuskit.llm.tokens import unit_tokenizer


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Deal the items to ``k`` parts by multiway differencing; returns the items of each part.

    A partial partition lists its parts by falling sum and leaves out empty
    ones. The two with the largest spread are merged next, ties by the age of
    the partition, so that the result depends on the sizes and their order only.
    """
    if k == 1:
        return [list(range(len(sizes)))]
    heap = [(-size, i, [(size, (i,))]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    age = len(sizes)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        over = len(one) + len(two) - k
        if over > 0:
            # Only the ``over`` smallest parts of each meet; all others meet an empty part.
            small, large = one[len(one) - over :], two[len(two) - over :]
            met = [(a[0] + b[0], (a[1], b[1])) for a, b in zip(small, reversed(large))]
            merged = one[: len(one) - over] + two[: len(two) - over] + met
        else:
            merged = one + two
        merged.sort(key=lambda part: -part[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == k else 0)
        heapq.heappush(heap, (-spread, age, merged))
        age += 1

    def flat(tree) -> list[int]:
        out, stack = [], [tree]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack.extend(x)
            else:
                out.append(x)
        return sorted(out)

    return [flat(part[1]) for part in heap[0][2]] if heap else []


def deal(sizes: list[int], capacity: int) -> list[list[int]]:
    """The items of each window, whole, none of more than ``capacity`` tokens; each item must fit alone."""
    total = sum(sizes)
    k = -(-total // capacity)
    while k:
        parts = difference(sizes, k)
        sums = [sum(sizes[i] for i in p) for p in parts]
        if max(sums) <= capacity:
            return [p for p, n in zip(parts, sums) if n]
        # The largest sum stays about as far above the mean, so this many windows are needed at least.
        k = max(k + 1, int(total / max(capacity - (max(sums) - total / k), capacity / 2)))
    return []


def fill(windows: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Windows of (item, first token, tokens), by falling sum: all hold the capacity but the last, which may hold less.

    The emptiest windows are taken apart from their last token on and fill the fullest.
    """
    order = sorted(([sum(p[2] for p in w), list(w)] for w in windows), key=lambda w: -w[0])
    last = len(order) - 1
    for place, (size, window) in enumerate(order):
        while size < capacity and place < last:
            item, start, n = order[last][1].pop()
            take = min(n, capacity - size)
            window.append((item, start + n - take, take))
            size += take
            order[last][0] -= take
            if take < n:
                order[last][1].append((item, start, n - take))
            elif not order[last][1]:
                last -= 1
    return [w for _, w in order[: last + 1] if w]


def written_order(docs: DataFrame) -> dict[str, int]:
    """The place of each file split (``file:first byte``) in the order in which the table was written; not from files: none.

    Spark numbers its output files by partition, but deals splits to tasks by
    size when it reads. As many names as splits come to the driver.
    """
    try:
        splits = docs.select("_metadata.file_name", "_metadata.file_block_start").distinct().collect()
    except AnalysisException:
        return {}
    number = lambda name: int(m[1]) if (m := re.match(r"part-(\d+)", name)) else -1
    splits = sorted(splits, key=lambda r: (number(r[0]), *r))
    return {f"{name}:{start}": k for k, (name, start) in enumerate(splits)}


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, separator: int = 0, cut: bool = True, group: int = 384, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, in_order: bool = False) -> DataFrame:
    """Pack the tokens of all documents into sequences of at most ``capacity`` tokens.

    A document is its tokens, without added special tokens, and then the id
    ``separator``. Returns a row for each piece: the id, ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``, ``padded_to``
    and, with ``with_ids``, ``ids``. Sequence ids are unique and, for the same
    input partitions, the same in every run; their upper bits are the partition.

    With ``cut``, at most one sequence of a partition is shorter than the
    capacity. Without, what is left of a document stays in one piece, and a
    sequence has as much room as the differencing left. Null and empty texts are
    the separator alone. Null and repeated ids pass through as documents of
    their own. An empty table gives no rows. Only the two named columns are read.
    One call of the differencing deals with ``group`` pieces of documents, and
    with those of the one window that waits.

    With ``in_order``, documents that come from files are packed split by split,
    and the upper bits are the split's place in the written order, however Spark
    deals the splits to tasks. So sequence ids follow the rows' order, but for
    the up to ``group`` documents among which the differencing deals.
    """
    if capacity < 1 or group < 1:
        raise ValueError("capacity and group must be positive")
    kind = docs.schema[id_col].dataType.simpleString()
    arrow_id = to_arrow_type(docs.schema[id_col].dataType)
    fields = [("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("padded_to", pa.int64())]

    places = written_order(docs) if in_order else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, split = unit_tokenizer(tokenizer), None
        end = np.array([separator], "<u4").tobytes()
        next_id = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        rests: list[tuple] = []  # (id, ids as bytes, tokens before, tokens of the document)
        out: list[tuple] = []
        held = 0  # pieces of the window that waits

        def emit(pieces: list[tuple]) -> None:
            nonlocal next_id
            offset, total = 0, sum(len(p[1]) for p in pieces) // 4
            padded = total if total & (total - 1) == 0 else capacity
            for i, raw, start, whole in pieces:
                out.append((i, start, len(raw) // 4, zlib.crc32(raw), whole, next_id, offset, padded, raw if with_ids else None))
                offset += len(raw) // 4
            next_id += 1

        def sequences(last: bool) -> None:
            """Deal what is left over; but for the last time, a window that isn't full waits for the next group."""
            nonlocal rests
            windows = [[(i, 0, len(rests[i][1]) // 4) for i in w] for w in deal([len(r[1]) // 4 for r in rests], capacity)]
            waiting = []
            for window in fill(windows, capacity) if cut else windows:
                pieces = [(rests[i][0], rests[i][1][4 * a : 4 * (a + n)], rests[i][2] + a, rests[i][3]) for i, a, n in window]
                if cut and not last and sum(n for _, _, n in window) < capacity:
                    waiting += pieces
                else:
                    emit(pieces)
            rests = waiting

        def flush() -> Iterator[pa.RecordBatch]:
            for a in range(0, len(out), 5_000):
                rows = list(zip(*out[a : a + 5_000]))
                arrays = [pa.array(rows[0], arrow_id)] + [pa.array(c, pa.int64()) for c in rows[1:8]]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(r, "<u4").astype(np.int32) for r in rows[8]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=["id", *(n for n, _ in fields), *(["ids"] if with_ids else [])])
            out.clear()

        for batch in batches:
            splits = batch.column(2).to_pylist() if places else [None] * len(batch)
            for i, value, now in zip(batch.column(0).to_pylist(), batch.column(1), splits):
                if now != split:
                    sequences(last=True)
                    split, next_id, held = now, places[now] << 40, 0
                raw = units.packed_ids(value.as_py() or "") + end
                whole, full = len(raw) // 4, len(raw) // 4 // capacity * capacity
                for start in range(0, full, capacity):
                    emit([(i, raw[4 * start : 4 * (start + capacity)], start, whole)])
                if full < whole:
                    rests.append((i, raw[4 * full :], full, whole))
                if len(rests) >= group + held:
                    sequences(last=False)
                    held = len(rests)
                if len(out) >= 5_000:
                    yield from flush()
        sequences(last=True)
        yield from flush()

    schema = f"id {kind}, " + ", ".join(f"{n} bigint" for n, _ in fields) + (", ids array<int>" if with_ids else "")
    split = [F.concat_ws(":", "_metadata.file_name", F.col("_metadata.file_block_start").cast("string")).alias("split")] if places else []
    packed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *split).mapInArrow(run, schema)
    return packed.withColumnRenamed("id", id_col)
