"""Exact byte-level BPE, unit by unit.

A *unit* is a run of white space with the run of other characters after it. The
pre-tokenizer never joins a character with white space that follows it, so the
tokens of a text are those of its units, one after the other.

Where no blank of a text comes after white space, each blank begins a unit, so
the text can be split at blanks, which is many times as fast as the expression
for units. A *word* is then what stands between two blanks; it can hold several
units, by its other white space.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: White space as Unicode's property White_Space has it (fixed values).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The split pattern of the byte-level pre-tokenizer (fixed value), its white space spelt out.
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: Units are kept in a cache up to this many characters.
LONGEST_KEPT = 48
#: A blank that comes after white space, so that it begins no unit.
INNER_BLANK = re.compile(rf"[{SPACE}] ")
#: Characters that go through the merge loop at once, unless a single unit is longer.
PORTION = 100_000


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Recent(dict):
    """A cache of two generations: what was not asked for during one is dropped."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > LONGEST_KEPT:
                return value
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def split_words(text: str) -> list[str] | None:
    """What stands between blanks (all but the first have a blank before them), or None where a blank begins no unit."""
    return None if INNER_BLANK.search(text) else text.split(" ")


class UnitTokenizer:
    """Token ids of whole texts, as ``tokenizers`` gives them for the file at ``path``.

    Where the merges of the file are in the order of their ids, as ranks, a text
    goes through the faster merge loop of tiktoken with that same vocabulary, a
    portion of units at a time, cut at special tokens; a unit longer than a
    portion, and any other file, goes through ``tokenizers`` itself.
    """

    def __init__(self, path: str, kept: int = 120_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, self._library = path, None
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = list(self.added)
        longest_first = sorted(self.specials, key=len, reverse=True)
        self.at_specials = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.specials else None
        self.units = re.compile(rf"[{SPACE}]*[^{SPACE}]++|[{SPACE}]++")
        self.core = None
        model, before = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (
            spec.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex")
            and not before.get("add_prefix_space")
            and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
            and model.get("type") == "BPE"
        )
        self.by_unit = bool(plain)
        if plain:
            vocabulary, alphabet = model["vocab"], byte_alphabet()
            pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
            if all(vocabulary[a + b] == 256 + k for k, (a, b) in enumerate(pairs)):
                ranks = {bytes(alphabet[c] for c in token): i for token, i in vocabulary.items() if token not in self.added}
                self.ranks = ranks
                self.core = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=self.added)
        self.cache = Recent(lambda unit: np.array(self.encode(unit), dtype="<u4").tobytes(), kept)

    @property
    def library(self) -> Tokenizer:
        """``tokenizers`` itself, read when it is first asked."""
        if self._library is None:
            self._library = Tokenizer.from_file(self.path)
        return self._library

    def portions(self, text: str, most: int = PORTION) -> Iterator[str]:
        """The text in portions of whole units, of ``most`` characters at most unless a single unit is longer."""
        start = end = 0
        if len(text) > most:
            for unit in self.units.finditer(text):
                if unit.end() - start > most and end > start:
                    yield text[start:end]
                    start = end
                end = unit.end()
        yield text[start:]

    def _plain(self, text: str) -> list[int]:
        """Of a text in which no special token counts."""
        ids: list[int] = []
        for part in self.portions(text):
            if len(part) > PORTION:
                ids += self.library.encode(part, add_special_tokens=False).ids
            else:
                ids += self.core.encode_ordinary(part)
        return ids

    def encode(self, text: str) -> list[int]:
        if self.core is None:
            return self.library.encode(text, add_special_tokens=False).ids
        if not any(s in text for s in self.specials):
            return self._plain(text)
        ids: list[int] = []
        for k, part in enumerate(self.at_specials.split(text)):
            ids += [self.added[part]] if k % 2 else self._plain(part)
        return ids

    def packed_ids(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.core is None and self.by_unit:
            return b"".join(map(self.cache.__getitem__, self.units.findall(text)))
        return np.array(self.encode(text), dtype="<u4").tobytes()


@lru_cache(maxsize=2)
def unit_tokenizer(path: str) -> UnitTokenizer:
    """One for each Python worker, so that its cache outlives a task."""
    return UnitTokenizer(path)
