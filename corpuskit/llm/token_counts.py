"""Token counts of every prefix, by dynamic programming over prefixes.

The byte-pair encoding of a prefix that ends at byte i has one possible last
token t, and what stands before t is the encoding of the prefix that ends at
i - len(t). So count[i] = count[i - len(t)] + 1, where t is the one token that
ends at i and stays apart from the last token of the shorter prefix when the two
are encoded together. The step needs only pairs of tokens, which repeat and are
kept; a text is never encoded again for one of its prefixes.

A special token's string cuts a text. What stands before it is counted as if it
went on with the string but for its last character, which gives the prefixes
that end inside the string, and the string itself is one token.

The table of a text is the running sum of one small signed number a character,
stored as bytes. It answers how many tokens any prefix has and where a text has
to end to fit a budget.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.tokens import LONGEST_KEPT, SPACE, SPLIT, Recent, split_words, unit_tokenizer

#: Pieces that the split pattern takes whole though their prefixes are two pieces (fixed values).
CONTRACTIONS = frozenset(("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"))
#: From this many bytes on, the tokens that end at each byte come from an automaton.
LONG_PIECE = 64


def small(deltas: np.ndarray) -> bytes:
    """Differences as signed bytes."""
    if len(deltas) and (deltas.min() < -128 or deltas.max() > 127):
        raise OverflowError("one more character changes the token count by more than a signed byte holds")
    return deltas.astype(np.int8).tobytes()


def large(deltas: bytes) -> np.ndarray:
    return np.frombuffer(deltas, np.int8)


class PrefixCounter:
    """Differences of the token count from one prefix of a text to the next, a signed byte a character."""

    def __init__(self, path: str, kept: int = 400_000):
        self.tokenizer = unit_tokenizer(path)
        self.split = regex.compile(SPLIT)
        self.lead = regex.compile(rf"[{SPACE}]*")
        self.apart: dict[int, bool] = {}
        specials = self.tokenizer.specials
        # A special string inside another one would end in the middle of it.
        self.exact = self.tokenizer.core is not None and not any(a != b and a in b for a in specials for b in specials)
        self.tokens = {i: t for t, i in self.tokenizer.ranks.items()} if self.exact else {}
        self.before: tuple[bytes, list[int], list[int], list[int]] = (b"", [0], [0], [0])
        self.pieces = Recent(self._piece, kept // 4)
        self.cache = Recent(self._unit, kept // 4)
        self.words = Recent(self._word, kept)
        self._automaton = None

    @property
    def automaton(self):
        """Finds all tokens in a text of one character a byte; made when it is first asked."""
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for token in self.tokenizer.ranks:
                self._automaton.add_word(token.decode("latin-1"), len(token))
            self._automaton.make_automaton()
        return self._automaton

    def _stays_apart(self, pair: int) -> bool:
        """Whether two tokens (the first one's id in the upper bits) are two when they are encoded together."""
        found = self.apart.get(pair)
        if found is None:
            first, second = pair >> 32, pair & 0xFFFFFFFF
            joined = self.tokens[first] + self.tokens[second]
            found = joined not in self.tokenizer.ranks and self.tokenizer.core._core_bpe._encode_bytes(joined) == [first, second]
            if len(self.apart) >= 1_000_000:
                self.apart.clear()
            self.apart[pair] = found
        return found

    def piece_counts(self, piece: str) -> list[int]:
        """Token counts of the prefixes of what the split pattern leaves whole, one a character.

        The steps for the bytes that it shares with the piece before are not repeated.
        """
        if piece in CONTRACTIONS:
            return [len(self.tokenizer.encode(piece[: k + 1])) for k in range(len(piece))]
        raw = piece.encode()
        counts = self._long(raw) if len(raw) > LONG_PIECE else self._short(raw)
        return counts[1:] if len(raw) == len(piece) else [counts[i] for i in range(1, len(raw) + 1) if i == len(raw) or raw[i] & 0xC0 != 0x80]

    def _short(self, raw: bytes) -> list[int]:
        rank, apart, stays = self.tokenizer.ranks.get, self.apart.get, self._stays_apart
        before, counts, last, sizes = self.before  # of each prefix: tokens, and the id and the length of the last one
        shared, most = 0, min(len(raw), len(before))
        while shared < most and raw[shared] == before[shared]:
            shared += 1
        del counts[shared + 1 :], last[shared + 1 :], sizes[shared + 1 :]
        for i in range(shared + 1, len(raw) + 1):
            # There is but one token that fits, so the order is free. Most often it is the last one grown by a byte, or a short one.
            start = i - 1 - sizes[-1]
            token = rank(raw[start:i])
            if token is None or start and not ((known := apart(pair := last[start] << 32 | token)) or known is None and stays(pair)):
                for start in range(i - 1, -1, -1):
                    token = rank(raw[start:i])
                    if token is not None and (not start or (known := apart(pair := last[start] << 32 | token)) or known is None and stays(pair)):
                        break
            counts.append(counts[start] + 1)
            last.append(token)
            sizes.append(i - start)
        self.before = raw, counts, last, sizes
        return counts

    def _long(self, raw: bytes) -> list[int]:
        counts, last, ranks = [0], [0], self.tokenizer.ranks
        for end, size in self.automaton.iter(raw.decode("latin-1")):
            if end + 2 == len(counts):
                continue  # the token that ends here is known
            start = end + 1 - size
            token = ranks[raw[start : end + 1]]
            if not start or self._stays_apart(last[start] << 32 | token):
                counts.append(counts[start] + 1)
                last.append(token)
        return counts

    def _piece(self, piece: str) -> bytes:
        counts = self.piece_counts(piece)
        if len(counts) < 128:  # no difference is larger than the piece
            return bytes([(b - a) & 255 for a, b in zip([0, *counts], counts)])
        return small(np.diff(np.array(counts, np.int64), prepend=0))

    def _unit(self, unit: str) -> bytes:
        joined = b"".join(map(self.pieces.__getitem__, self.split.findall(unit)))
        if not unit[:2].isspace() or (spaces := self.lead.match(unit).end()) < 2 or spaces == len(unit):
            return joined
        # Until the first other character comes, the white space before it is one piece.
        counts = large(joined).cumsum(dtype=np.int64)
        counts[:spaces] = large(self.pieces[unit[:spaces]]).cumsum(dtype=np.int64)
        return small(np.diff(counts, prepend=0))

    def _word(self, word: str) -> bytes:
        """Of a word with the blank before it."""
        if word.isalpha():
            return self._piece(" " + word)
        return (self._unit if word.split() == [word] else self._units)(" " + word)

    def _units(self, text: str) -> bytes:
        return b"".join(map(self.cache.__getitem__, self.tokenizer.units.findall(text)))

    def deltas_of(self, texts: list[str]) -> list[bytes]:
        """For each text one signed byte a character; their running sum is the table."""
        if not self.exact:
            return list(map(self._other, texts))
        specials = self.tokenizer.specials
        words = [None if any(s in t for s in specials) else split_words(t) for t in texts]
        known, old = self.words, self.words.old
        fresh = {w for said in words if said for w in said[1:] if len(w) <= LONGEST_KEPT and w not in known and w not in old}
        for word in sorted(fresh):  # in this order most of a word's prefixes were just seen
            known[word]
        return [self._parts(t) if w is None else self._units(w[0]) + b"".join(map(self.words.__getitem__, w[1:])) for t, w in zip(texts, words)]

    def _parts(self, text: str) -> bytes:
        """Of a text that may hold special tokens, part by part."""
        parts, out = self.tokenizer.at_specials.split(text) if self.tokenizer.specials else [text], []
        for part, special in zip(parts[::2], [*parts[1::2], ""]):
            deltas = self._units(part + special[:-1])
            if special:
                deltas += small(np.array([1 - large(deltas[len(part) :]).sum(dtype=np.int64)]))
            out.append(deltas)
        return b"".join(out)

    def _other(self, text: str) -> bytes:
        """Without such a vocabulary each prefix goes through the library: of every unit alone, if that gives the whole text's ids."""
        encode, units = self.tokenizer.encode, self.tokenizer.units.findall(text)
        if [i for u in units for i in encode(u)] != encode(text):
            units = [text]
        counts = [[len(encode(u[: k + 1])) for k in range(len(u))] for u in units]
        return b"".join(small(np.diff(np.array(c, np.int64), prepend=0)) for c in counts)


def parts(column: pa.Array, most: int = 4_000_000) -> Iterator[list[str]]:
    """The texts (null: empty) in lists of about ``most`` characters."""
    texts, size = [], 0
    for value in column:
        texts.append(value.as_py() or "")
        size += len(texts[-1])
        if size >= most:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


@lru_cache(maxsize=2)
def prefix_counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def open_table(stored: bytes) -> np.ndarray:
    """Token counts of the prefixes of 0, 1, 2, ... characters."""
    return np.concatenate(([0], large(zstandard.decompress(stored)).cumsum(dtype=np.int64)))


def tokens_before(stored: bytes, n_chars: int) -> int:
    """Tokens of the first ``n_chars`` characters (of the whole text, if it is shorter)."""
    table = open_table(stored)
    return int(table[min(max(n_chars, 0), len(table) - 1)])


def longest_within(stored: bytes, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    fits = np.flatnonzero(open_table(stored) <= budget)
    return int(fits[-1]) if len(fits) else 0


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, cut: int = 4096, id_col: str = "doc_id", text_col: str = "text", store: bool = True) -> DataFrame:
    """Count the tokens of every whole text, and of all its prefixes.

    Returns the id, ``n_bytes``, ``n_tokens``, ``over_limit``; from the table of
    prefixes ``limit_chars`` (the characters of the longest prefix of at most
    ``limit`` tokens) and ``cut_tokens`` (the tokens of a text that is cut to
    ``cut`` characters); and, with ``store``, ``prefix_counts``, the compressed
    table, for ``tokens_before`` and ``longest_within``. No begin, end or other
    token is added; strings of special tokens inside a text count as the library
    counts them by default.

    Null texts count as empty: 0 bytes, 0 tokens. Null and repeated ids pass
    through, one row out for each row in. Only the two named columns are read,
    so other columns may have any names. A text of any length takes memory and
    time in proportion to its own length. That holds for byte-level vocabularies
    whose merges are in the order of their ids; for others the library counts
    every prefix, of each unit alone where that is exact, which takes time with
    the square of a unit's or else the text's length.
    """
    numbers = ["n_bytes", "n_tokens", "limit_chars", "cut_tokens"]
    schema = ", ".join(f"{n} bigint" for n in numbers) + (", prefix_counts binary" if store else "")
    kind = docs.schema[id_col].dataType.simpleString()

    def answers(text: str, deltas: bytes) -> tuple[int, int, int, int]:
        table = large(deltas).cumsum(dtype=np.int64)
        n_tokens = int(table[-1]) if len(table) else 0
        # Counts can fall by a few, so the last prefix that fits is looked for.
        within = len(table) if n_tokens <= limit else int(np.flatnonzero(table <= limit)[-1:].sum() + (table <= limit).any())
        return len(text.encode()), n_tokens, within, int(table[min(cut, len(table)) - 1]) if len(table) and cut > 0 else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, pack = prefix_counter(tokenizer), zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            found, tables = [], []
            for texts in parts(batch.column(1)):
                for text, deltas in zip(texts, counter.deltas_of(texts)):
                    found.append(answers(text, deltas))
                    if store:
                        tables.append(pack(deltas))
            made = [pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * len(numbers))]
            made += [pa.array(tables, pa.binary())] if store else []
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["id", *numbers, *(["prefix_counts"] if store else [])])

    counted = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, {schema}")
    over = (F.col("n_tokens") > limit).alias("over_limit")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", over, "limit_chars", "cut_tokens", *(["prefix_counts"] if store else []))
