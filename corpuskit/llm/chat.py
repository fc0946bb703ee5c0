r"""Chat formatting over prefix trees.

Conversations that begin with the same turns share the nodes of a tree. A node's
key is a digest of its turn and its parent's key, so that the keys along a
conversation, one after the other, sort conversations into depth-first order.
Sorted conversations are dealt out by range and turned into sequences one after
the other: a sequence holds every node of its trees once. A sequence of bounded
size is closed and the next one starts with the path that it goes on with, so a
first turn that very many conversations share is repeated once a sequence and no
task holds a tree.

Each node has the place of its text in the sequence, the position of its first
unit on its own path (the position id), and the intervals of the sequence that
its ancestors take up (what it attends to besides itself).

A turn is ``<|im_start|>role\ntext<|im_end|>\n``. In roles and texts every ``<``,
backslashes, ``|`` gets one more backslash, so that no control string is left in
them; in roles, backslashes and line ends are escaped before that. Both can be
undone. The loss mask covers the assistants' texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpuskit.llm import scratch
from corpuskit.llm.tokens import unit_tokenizer

START, END = "<|im_start|>", "<|im_end|>"
KEY = 12
#: Longer conversations come in parts; a part goes on where the one before ended.
PART_TURNS, PART_CHARS = 4096, 4_000_000

_RAISE, _LOWER = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + "\n", re.S)


def escape(text: str) -> str:
    return _RAISE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _LOWER.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn's text, and where the loss mask begins and ends in it."""
    head, body = f"{START}{escape_role(role)}\n", escape(text)
    inside = len(body) if role == "assistant" else 0
    return f"{head}{body}{END}\n", len(head), len(head) + inside


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of formatted turns."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        turns.append((unescape_role(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def merged(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in intervals:
        if out and out[-1][1] == a:
            out[-1] = (out[-1][0], b)
        elif b > a:
            out.append((a, b))
    return out


NODE = pa.struct([("parent", pa.int32()), ("depth", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("position", pa.int64()), ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("token_start", pa.int64()), ("token_length", pa.int64()), ("token_position", pa.int64()), ("visible", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
NODE_SQL = "struct<parent:int,depth:bigint,start:bigint,length:bigint,position:bigint,loss_start:bigint,loss_end:bigint,token_start:bigint,token_length:bigint,token_position:bigint,visible:array<struct<start:bigint,end:bigint>>>"


def format_conversations(turns: DataFrame, tokenizer: str | None = None, most_chars: int = 65_536, most_conversations: int = 1024, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Format all conversations (a row for each turn) as sequences over prefix trees.

    Returns a row for each sequence: ``sequence_id``, ``text``, ``ids`` (with a
    ``tokenizer``, else null), ``nodes`` in depth-first order and
    ``conversations``: (``id``, ``part``, ``whole``, ``leaf``), the node that the
    conversation's part ends with; ``whole`` if it has one part only. A node's
    ``visible`` are the intervals of its ancestors in the unit of positions:
    tokens with a tokenizer, else characters.

    Turns of a conversation are in the order of turn, role, text (nulls first);
    rows that repeat a turn are turns of their own. Null roles and texts are
    empty. A null id is a conversation of its own. An empty table gives an empty
    result. Only the four named columns are read. A conversation of any length
    streams through in parts; ``most_chars`` only bounds what is put beside it.
    """
    id_type = to_arrow_type(turns.schema[id_col].dataType)
    kind = turns.schema[id_col].dataType.simpleString()

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts of conversations, with the keys of their nodes in a row."""
        state: dict = {"id": None, "begun": False}
        out: list[tuple] = []

        def close(whole: bool) -> None:
            out.append((state["id"], state["part"], whole and state["part"] == 0, b"".join(state["keys"]), state["depth"], state["roles"], state["texts"]))

        def pack() -> pa.RecordBatch:
            cols = list(zip(*out))
            out.clear()
            kinds = (id_type, pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["id", "part", "whole", "path", "depth", "roles", "texts"])

        size = 0
        for batch in batches:
            ids, roles = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, role, value in zip(ids, roles, batch.column(2)):
                role, text = role or "", value.as_py() or ""
                if not state["begun"] or i != state["id"]:
                    if state["begun"]:
                        close(True)
                    state.update(id=i, begun=True, part=0, depth=0, key=b"", keys=[], roles=[], texts=[], chars=0)
                elif len(state["keys"]) >= PART_TURNS or state["chars"] >= PART_CHARS:
                    close(False)
                    state.update(part=state["part"] + 1, depth=state["depth"] + len(state["keys"]), keys=[], roles=[], texts=[], chars=0)
                turn = f"{len(role)}:{role}{text}".encode()
                state["key"] = hashlib.blake2b(state["key"] + turn, digest_size=KEY).digest()
                state["keys"].append(state["key"])
                state["roles"].append(role)
                state["texts"].append(text)
                state["chars"] += len(text)
                size += len(text)
                if len(out) >= 1000 or size > 8_000_000 and out:
                    yield pack()
                    size = 0
        if state["begun"]:
            close(True)
        if out:
            yield pack()

    rows = turns.select(F.col(id_col).alias("id"), F.col(role_col).alias("role"), F.col(text_col).alias("text"), F.col(turn_col).alias("turn"))
    rows = rows.repartition("id").sortWithinPartitions("id", "turn", "role", "text").select("id", "role", "text")
    parts = rows.mapInArrow(chain, f"id {kind}, part bigint, whole boolean, path binary, depth bigint, roles array<string>, texts array<string>")
    parts = scratch.materialise(parts, "parts")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = unit_tokenizer(tokenizer) if tokenizer else None
        next_id = TaskContext.get().partitionId() << 40
        stack: list[tuple] = []  # (key, place in nodes)
        nodes: list[dict] = []
        texts: list[str] = []
        ids: list[bytes] = []
        convs: list[dict] = []
        length = tokens = 0

        def close() -> pa.RecordBatch:
            nonlocal next_id, length, tokens
            row = [[next_id], ["".join(texts)], [np.frombuffer(b"".join(ids), "<u4").astype(np.int32) if units else None], [list(nodes)], [list(convs)]]
            next_id += 1
            length = tokens = 0
            for x in (stack, nodes, texts, ids, convs):
                x.clear()
            conv = pa.struct([("id", id_type), ("part", pa.int64()), ("whole", pa.bool_()), ("leaf", pa.int32())])
            kinds = (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(NODE), pa.list_(conv))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names=["sequence_id", "text", "ids", "nodes", "conversations"])

        for batch in batches:
            for i, part, whole, path, depth, roles, said in zip(*(batch.column(k).to_pylist() for k in range(7))):
                keys = [path[a : a + KEY] for a in range(0, len(path), KEY)]
                shared = 0
                while shared < min(len(stack), len(keys)) and stack[shared][0] == keys[shared]:
                    shared += 1
                fresh = sum(len(t) for t in said[shared:])
                if convs and (len(convs) >= most_conversations or fresh and length + fresh > most_chars):
                    yield close()
                    shared = 0
                del stack[shared:]
                for d in range(shared, len(keys)):
                    shown, a, b = format_turn(roles[d], said[d])
                    parent = nodes[stack[-1][1]] if stack else None
                    packed = units.packed_ids(shown) if units else b""
                    size, at, where = (len(packed) // 4, tokens, "token_") if units else (len(shown), length, "")
                    visible = []
                    if parent:
                        visible = [(v["start"], v["end"]) for v in parent["visible"]] + [(parent[where + "start"], parent[where + "start"] + parent[where + "length"])]
                    node = {"parent": stack[-1][1] if stack else None, "depth": depth + d, "start": length, "length": len(shown), "position": parent["position"] + parent["length"] if parent else 0, "loss_start": length + a, "loss_end": length + b}
                    node |= {"token_start": tokens, "token_length": len(packed) // 4, "token_position": parent["token_position"] + parent["token_length"] if parent else 0}
                    node["visible"] = [{"start": x, "end": y} for x, y in merged(visible)]
                    stack.append((keys[d], len(nodes)))
                    nodes.append(node)
                    texts.append(shown)
                    ids.append(packed)
                    length += len(shown)
                    tokens += len(packed) // 4
                convs.append({"id": i, "part": part, "whole": whole, "leaf": stack[-1][1] if stack else None})
        if convs:
            yield close()

    ordered = parts.repartitionByRange("path", "id", "part").sortWithinPartitions("path", "id", "part").select("id", "part", "whole", "path", "depth", "roles", "texts")
    return ordered.mapInArrow(grow, f"sequence_id bigint, text string, ids array<int>, nodes array<{NODE_SQL}>, conversations array<struct<id:{kind},part:bigint,whole:boolean,leaf:int>>")


def read_back(sequences: DataFrame) -> DataFrame:
    """What formatted sequences say of each conversation, from their text, nodes and loss masks alone.

    Returns ``id``, ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``
    and ``formatted_chars``. The parts of conversations that have several are put
    through the digests one after the other.
    """
    kind = sequences.schema["conversations"].dataType.elementType["id"].dataType
    id_type, id_sql = to_arrow_type(kind), kind.simpleString()

    def paths(batch: pa.RecordBatch, whole: bool) -> Iterator[tuple]:
        for text, nodes, convs in zip(*(batch.column(k).to_pylist() for k in range(3))):
            known: dict[int, tuple] = {}
            for c in convs:
                if c["whole"] == whole:
                    if c["leaf"] not in known:
                        way, n = [], c["leaf"]
                        while n is not None:
                            way.append(nodes[n])
                            n = nodes[n]["parent"]
                        turns, loss = [], []
                        for node in reversed(way):
                            ((role, said),) = parse(text[node["start"] : node["start"] + node["length"]])
                            turns.append(f"{role}\n{said}\n")
                            loss.append(unescape(text[node["loss_start"] : node["loss_end"]]))
                        known[c["leaf"]] = len(way), "".join(turns), "".join(loss), sum(n["length"] for n in way)
                    yield (c["id"], c["part"], *known[c["leaf"]])

    names = ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = (id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    schema = f"id {id_sql}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(batch.num_rows):
                rows = [(i, n, hashlib.sha256(t.encode()).hexdigest(), len(s), hashlib.sha256(s.encode()).hexdigest(), f) for i, _, n, t, s, f in paths(batch.slice(a, 1), True)]
                if rows:
                    yield table(rows)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(batch.num_rows):
                for row in paths(batch.slice(a, 1), False):
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, (id_type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))], names=["id", "part", "n", "turns", "loss", "chars"])

    def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        for batch in batches:
            for i, _, n, turns, loss, chars in zip(*(batch.column(k).to_pylist() for k in range(6))):
                if now is None or now[0] != i:
                    if now:
                        yield table([(now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5])])
                    now = (i, 0, hashlib.sha256(), 0, hashlib.sha256(), 0)
                now[2].update(turns.encode())
                now[4].update(loss.encode())
                now = (i, now[1] + n, now[2], now[3] + len(loss), now[4], now[5] + chars)
        if now:
            yield table([(now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5])])

    seen = sequences.select("text", "nodes", "conversations")
    whole = seen.mapInArrow(at_once, schema)
    split = seen.where(F.exists("conversations", lambda c: ~c["whole"])).mapInArrow(pieces, f"id {id_sql}, part bigint, n bigint, turns string, loss string, chars bigint")
    split = split.repartition("id").sortWithinPartitions("id", "part").mapInArrow(one_by_one, schema)
    return whole.union(split)
