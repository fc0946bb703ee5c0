"""A toxicity classifier: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is cut into words, and words into overlapping windows. A word's input is
the embedding of the word plus the means of the embeddings of its character 3- to
5-grams and of its beginnings, all hashed to fixed numbers of places. Two gated recurrent layers read a
window forwards and backwards; attention weighs the states of its words; the
weighed sum gives the window's logit. A text has the logit of its highest window,
so that a short passage counts in a long text.

Labels are of texts, not of windows. Training therefore takes of every text the
window that scores highest at that moment, and of clean texts another at random,
and sends the loss back through time for these. The first component of the
embeddings starts as the log-count ratio of word and parts in the two classes;
all others at random. A logistic curve, fitted to texts that the network hasn't
seen, turns logits into probabilities.

The options were chosen by ``cross_validate`` over training rows alone.

The network is fitted at the driver on a bounded sample of labelled rows:
``per_class`` rows of each class and ``most_chars`` characters at most. Scoring reads
all rows and every window of the whole texts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.llm.centroids import within
from corpuskit.llm.quality import fit_curve, held_out

#: Hashed places of words and of their parts; the size of embeddings, of the states of a direction and of the attention.
WORDS, PARTS, SIZE, STATES, ATTENTION = 1 << 14, 1 << 17, 10, 8, 8
#: Characters of the longest part.
LONGEST = 8
#: Words of a window, and from one window's start to the next one's.
SPAN, STRIDE = 32, 24
#: Longer runs of letters and digits are cut, so that no word is long.
WORD = re.compile(r"\w{1,32}")
#: Windows, and new words, that are read in one step, and words whose inputs a process keeps.
AT_ONCE, SOME, KEPT = 1024, 4096, 200_000


@dataclass
class Places:
    """Of words: the place of each, those of its parts one word after the other, how many parts it has, and each part's weight in its input."""

    own: np.ndarray
    parts: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray

    def of(self, words: np.ndarray) -> Places:
        """Of these words only."""
        at = np.repeat((np.cumsum(self.sizes) - self.sizes)[words], self.sizes[words]) + within(self.sizes[words])
        return Places(self.own[words], self.parts[at], self.sizes[words], self.weights[at])

    @classmethod
    def of_many(cls, words: list[str]) -> Places:
        """As ``places``, some words at a time, so that nothing but the result is large."""
        some = [places(words[i : i + SOME]) for i in range(0, max(len(words), 1), SOME)]
        return cls(*(np.concatenate([getattr(x, name) for x in some]) for name in ("own", "parts", "sizes", "weights")))


def places(words: list[str]) -> Places:
    """Parts are character n-grams of 3 to 5, with both ends marked, and beginnings of 3 to 8; each kind weighs 1 together."""
    marked = [f"<{w}>" for w in words]
    raw = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(m) for m in marked], np.int64)
    ahead = within(sizes)
    left, word_of = np.repeat(sizes, sizes) - ahead, np.repeat(np.arange(len(words)), sizes)
    code, found, owner, kind = raw.copy(), [], [], []
    raw = np.concatenate((raw, np.zeros(LONGEST, np.uint64)))
    for k in range(2, LONGEST + 1):
        code = code * np.uint64(1_114_117) + raw[k - 1 : k - 1 + len(code)]
        for begins in (False, True):
            fits = (left >= k) & (ahead == 0) if begins else left >= k
            if k > 2 and (begins or k < 6):
                hashed = (code[fits] + np.uint64(begins)) * np.uint64(0x9E3779B97F4A7C15)
                found.append((hashed >> np.uint64(40)).astype(np.int64) % PARTS)
                owner.append(word_of[fits])
                kind.append(np.full(len(owner[-1]), begins))
    owner, kind, found = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owner, kind, found))
    order = np.argsort(owner, kind="stable")
    group = owner * 2 + kind
    weights = 1 / np.bincount(group, minlength=2 * len(words))[group]
    own = np.array([zlib.crc32(m.encode("utf-8", "surrogatepass")) % WORDS for m in marked], np.int64)
    return Places(own.astype(np.int32), found[order].astype(np.int32), np.bincount(owner, minlength=len(words)), weights[order].astype(np.float32))


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows over texts of so many words that stand one after the other.

    Returns each window's text, first word and length. A text of n words has windows
    at every multiple of the stride until one reaches its end; without words, one of length 0.
    """
    each = 1 + np.maximum(0, -(-(counts - SPAN) // STRIDE))
    text = np.repeat(np.arange(len(counts)), each)
    start = (np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)) * STRIDE
    return text, start + np.repeat(np.cumsum(counts) - counts, each), np.minimum(SPAN, counts[text] - start)


def sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):  # an infinite power gives 0, as it should
        return 1 / (1 + np.exp(-x))


def tanh(x: np.ndarray) -> np.ndarray:
    """By a power, which numpy computes faster than its own function."""
    return 2 * sigmoid(2 * x) - 1


@dataclass
class Network:
    """Arrays by name. Gates: update, reset, candidate. ``input``, ``state`` and ``gate`` begin with the direction."""

    p: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0

    @classmethod
    def start(cls, seed: int = 0) -> Network:
        rng = np.random.default_rng(seed)
        some = lambda *shape, by=1.0: (rng.standard_normal(shape) * by).astype(np.float32)
        p = {"word": some(WORDS, SIZE, by=0.05), "part": some(PARTS, SIZE, by=0.05)}
        p |= {"input": some(2, SIZE, 3 * STATES, by=0.4), "state": some(2, STATES, 3 * STATES, by=0.3), "gate": np.zeros((2, 1, 3 * STATES), np.float32)}
        p |= {"seen": some(2 * STATES, ATTENTION, by=0.3), "bias": np.zeros(ATTENTION, np.float32), "look": some(ATTENTION, by=0.3)}
        return cls(p | {"out": some(2 * STATES, by=0.3), "rest": np.zeros(1, np.float32)})

    def embed(self, at: Places) -> np.ndarray:
        """The inputs of words; every word has a part at least."""
        parts = np.add.reduceat(self.p["part"][at.parts] * at.weights[:, None], np.cumsum(at.sizes) - at.sizes)
        return self.p["word"][at.own] + parts

    def embed_all(self, at: Places) -> np.ndarray:
        return np.concatenate([self.embed(at.of(np.arange(i, min(i + SOME, len(at.own))))) for i in range(0, len(at.own), SOME)])

    def project(self, x: np.ndarray) -> np.ndarray:
        """What the inputs add to the gates, for both directions: (direction, word, gates)."""
        return np.matmul(x, self.p["input"]) + self.p["gate"]

    def read(self, gates: np.ndarray, at: np.ndarray, length: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """The logits of windows: ``at`` (window, word) are places in ``gates``. ``keep``: all that the way back needs."""
        n, h2 = len(at), 2 * STATES
        inside = np.arange(SPAN) < length[:, None]
        there = at.T
        h = np.zeros((2, n, STATES), np.float32)
        states, trace = np.zeros((SPAN, n, h2), np.float32), []
        for t in range(SPAN):
            back = SPAN - 1 - t
            x = np.stack((gates[0][there[t]], gates[1][there[back]]))
            u = np.matmul(h, self.p["state"])
            zr = sigmoid(x[..., :h2] + u[..., :h2])
            z, r = zr[..., :STATES], zr[..., STATES:]
            c = tanh(x[..., h2:] + r * u[..., h2:])
            new = c + z * (h - c)
            live = np.stack((inside[:, t], inside[:, back]))[..., None]
            if not live.all():
                new = np.where(live, new, h)
            if keep:
                trace.append((h, z, r, c, u[..., h2:], live))
            h = new
            states[t, :, :STATES], states[back, :, STATES:] = h[0], h[1]
        shown = tanh(states @ self.p["seen"] + self.p["bias"])
        weight = np.where(inside.T, shown @ self.p["look"], np.float32(-1e9))
        weight = np.exp(weight - weight.max(0)) * inside.T
        weight /= np.maximum(weight.sum(0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        return pooled @ self.p["out"] + self.p["rest"][0], {"states": states, "shown": shown, "weight": weight, "pooled": pooled, "trace": trace} if keep else {}

    def back(self, gates: np.ndarray, at: np.ndarray, kept: dict, error: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """The gradients for the loss's gradients by window, and those of ``gates``."""
        p, h2, states, shown, weight = self.p, 2 * STATES, kept["states"], kept["shown"], kept["weight"]
        g = {"out": kept["pooled"].T @ error, "rest": error.sum(keepdims=True)}
        d_pooled = error[:, None] * p["out"]
        d_weight = np.einsum("nh,tnh->tn", d_pooled, states)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        g["look"] = np.einsum("tna,tn->a", shown, d_score)
        d_shown = d_score[..., None] * p["look"] * (1 - shown**2)
        g["seen"], g["bias"] = np.einsum("tnh,tna->ha", states, d_shown), d_shown.sum((0, 1))
        d_states = weight[..., None] * d_pooled + d_shown @ p["seen"].T
        d_gates, g["state"] = np.zeros_like(gates), np.zeros_like(p["state"])
        d_h = np.zeros((2, len(at), STATES), np.float32)
        for t in range(SPAN - 1, -1, -1):
            back = SPAN - 1 - t
            h, z, r, c, uc, live = kept["trace"][t]
            d_h = d_h + np.stack((d_states[t, :, :STATES], d_states[back, :, STATES:]))
            d_new = d_h * live
            d_c = d_new * (1 - z) * (1 - c**2)
            d_z, d_r = d_new * (h - c) * z * (1 - z), d_c * uc * r * (1 - r)
            d_u = np.concatenate((d_z, d_r, d_c * r), -1)
            d_x = np.concatenate((d_z, d_r, d_c), -1)
            g["state"] += np.matmul(h.transpose(0, 2, 1), d_u)
            np.add.at(d_gates[0], at[:, t], d_x[0])
            np.add.at(d_gates[1], at[:, back], d_x[1])
            d_h = d_h * ~live + d_new * z + np.matmul(d_u, p["state"].transpose(0, 2, 1))
        return g, d_gates

    def highest(self, text: np.ndarray, start: np.ndarray, length: np.ndarray, flat: np.ndarray, gates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text the highest logit of its windows, and that window; ``flat``: the places of all words in ``gates``."""
        flat = np.append(flat, 0)  # a window without words needs a place too
        scores = np.empty(len(text), np.float32)
        for a in range(0, len(text), AT_ONCE):
            part = slice(a, a + AT_ONCE)
            at = flat[np.minimum(start[part, None] + np.arange(SPAN), len(flat) - 1)]
            scores[part] = self.read(gates, at, length[part])[0]
        order = np.lexsort((scores, text))
        last = np.append(np.flatnonzero(np.diff(text[order])), len(order) - 1)
        return scores[order[last]], order[last]


class _Numbers(dict):
    """Numbers new keys as they are looked up."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


class Reader:
    """Scores texts; keeps the inputs of up to ``KEPT`` words."""

    def __init__(self, network: Network):
        self.network = network
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = _Numbers()
        self.gates = np.empty((2, 1 << 14, 3 * STATES), np.float32)

    def look_up(self, words: list[str]) -> np.ndarray:
        """The words' rows in ``gates``."""
        if len(self.known) > KEPT:
            self.forget()
        have = len(self.known)
        found = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        fresh = list(islice(reversed(self.known), len(self.known) - have))[::-1]
        if len(self.known) > self.gates.shape[1]:
            grown = np.empty((2, 2 * len(self.known), 3 * STATES), np.float32)
            grown[:, :have] = self.gates[:, :have]
            self.gates = grown
        for i in range(0, len(fresh), SOME):
            part = fresh[i : i + SOME]
            self.gates[:, have + i : have + i + len(part)] = self.network.project(self.network.embed(places(part)))
        return found

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities, for a bounded number of words at a time."""
        out, held, size = [], [], 0
        for k, text in enumerate(texts):
            held.append(words_of(text))
            size += len(held[-1])
            if size > 100_000 or k == len(texts) - 1:
                counts = np.array([len(w) for w in held], np.int64)
                flat = self.look_up([w for words in held for w in words])
                out.append(self.network.highest(*windows(counts), flat, self.gates)[0])
                held, size = [], 0
        z = self.network.slope * np.concatenate(out).astype(float) + self.network.shift if out else np.empty(0)
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def log_count_ratios(texts: list[np.ndarray], y: np.ndarray, found: Places, smooth: float, few: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Of words and parts: the log of the ratio of the shares of either class's texts that hold them.

    ``smooth`` texts spread over both classes by their sizes are added, so that what was
    never seen has a ratio of 1; so has what fewer than ``few`` texts hold.
    """
    share = np.bincount(y.astype(int), minlength=2) / len(y)
    counts = [np.tile(smooth * share[:, None], (1, n)) for n in (WORDS, PARTS)]
    for text, label in zip(texts, y.astype(int)):
        mine = found.of(np.unique(text))
        counts[0][label, np.unique(mine.own)] += 1
        counts[1][label, np.unique(mine.parts)] += 1
    return tuple(np.where(c.sum(0) >= smooth + few, np.log(c[1] / share[1]) - np.log(c[0] / share[0]), 0) for c in counts)


def descend(network: Network, texts: list[np.ndarray], y: np.ndarray, found: Places, rounds: int, passes: int, rate: float, pace: float, drop: float, group: int, seed: int) -> None:
    """A round picks windows, at first those of the highest ratio, later those of the highest logit, and goes over them ``passes`` times.

    Adam for the layers; Adagrad, at ``pace`` times the rate, for the rows of the
    embeddings that a step touches. In every step each word is hidden with
    probability ``drop``, so that no rare word alone can explain a text.
    """
    rng, p = np.random.default_rng(seed), network.p
    dense = [k for k in p if k not in ("word", "part")]
    first, second = ({k: np.zeros_like(p[k]) for k in dense} for _ in range(2))
    gone = {k: np.full((len(p[k]), 1), 1e-2, np.float32) for k in ("word", "part")}
    text, start, length = windows(np.array([len(t) for t in texts], np.int64))
    flat = np.append(np.concatenate(texts), 0)
    if len(flat) == 1:
        return
    span, clean, step = np.bincount(text), np.flatnonzero(~y), 0
    for turn in range(rounds):
        best = network.highest(text, start, length, flat[:-1], network.project(network.embed_all(found)))[1] if turn else richest(network.embed_all(found)[:, 0], flat, text, start, length)
        other = np.searchsorted(text, clean) + (rng.random(len(clean)) * span[clean]).astype(int)
        chosen = np.concatenate((best, other))
        each = len(chosen) / 2 / np.maximum(np.bincount(y[text[chosen]].astype(int), minlength=2), 1)
        for turned in range(passes):
            order = rng.permutation(chosen)
            slow = rate * (1 - (turn * passes + turned) / (rounds * passes))
            for some in (order[i : i + group] for i in range(0, len(order), group)):
                at = flat[np.minimum(start[some, None] + np.arange(SPAN), len(flat) - 1)]
                words, at = np.unique(at, return_inverse=True)
                at, its = at.reshape(len(some), SPAN), found.of(words)
                x = network.embed(its) * (rng.random((len(words), 1)) >= drop).astype(np.float32)
                gates = network.project(x)
                logit, kept = network.read(gates, at, length[some], keep=True)
                label = y[text[some]]
                error = (sigmoid(logit) - label) * each[label.astype(int)] / len(some)
                g, d_gates = network.back(gates, at, kept, error.astype(np.float32))
                g["input"], g["gate"] = np.matmul(x.T, d_gates), d_gates.sum(1, keepdims=True)
                d_x = np.einsum("dwg,dsg->ws", d_gates, p["input"])
                step += 1
                for k in dense:
                    first[k] += 0.1 * (g[k] - first[k])
                    second[k] += 0.01 * (g[k] ** 2 - second[k])
                    p[k] -= slow * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
                if not pace:
                    continue
                rows = {"word": (its.own, d_x), "part": (its.parts, np.repeat(d_x, its.sizes, 0) * its.weights[:, None])}
                for k, (where, grad) in rows.items():
                    hit, back = np.unique(where, return_inverse=True)
                    total = np.stack([np.bincount(back, grad[:, j], len(hit)) for j in range(SIZE)], 1).astype(np.float32)
                    gone[k][hit] += (total**2).mean(1, keepdims=True)
                    p[k][hit] -= pace * slow * total / np.sqrt(gone[k][hit])


def richest(ratios: np.ndarray, flat: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The window of each text whose highest ratio of a word is highest."""
    inside = np.arange(SPAN) < length[:, None]
    top = np.where(inside, ratios[flat[np.minimum(start[:, None] + np.arange(SPAN), len(flat) - 1)]], -np.inf).max(1)
    order = np.lexsort((top, text))
    return order[np.append(np.flatnonzero(np.diff(text[order])), len(order) - 1)]


def fit(texts: list[str | None], labels: list[int], rounds: int = 2, passes: int = 3, rate: float = 0.04, pace: float = 0.5, drop: float = 0.0, smooth: float = 60.0, few: int = 6, group: int = 64, seed: int = 0) -> Network | None:
    """None if there aren't two texts of each class at least. A fifth of either class is for the curve."""
    y = np.array(labels, bool)
    if min(y.sum(), len(y) - y.sum()) < 2:
        return None
    late = np.zeros(len(y), bool)
    for side in (np.flatnonzero(y), np.flatnonzero(~y)):
        late[side[::5]] = True
    early = np.flatnonzero(~late)
    known = _Numbers()
    rows = [np.fromiter(map(known.__getitem__, words_of(texts[i])), np.int64) for i in early]
    found = Places.of_many(list(known))
    network = Network.start(seed)
    word, part = log_count_ratios(rows, y[early], found, smooth, few)
    network.p["word"][:, 0], network.p["part"][:, 0] = word, part
    descend(network, rows, y[early], found, rounds, passes, rate, pace, drop, group, seed)
    raw = Reader(network)
    score = raw.score([texts[i] for i in np.flatnonzero(late)])
    margins = np.log(np.maximum(score, 1e-300)) - np.log(np.maximum(1 - score, 1e-16))
    network.slope, network.shift = fit_curve(margins, y[late])
    return network


def cross_validate(texts: list[str | None], labels: list[int], folds: int = 4, threshold: float = 0.7, **options) -> tuple[int, float]:
    """Errors and mean log loss of rows that networks fitted on the other folds score; for choices among options of ``fit``."""
    errors, loss = 0, 0.0
    for fold in range(folds):
        network = fit([t for i, t in enumerate(texts) if i % folds != fold], [y for i, y in enumerate(labels) if i % folds != fold], **options)
        y = np.array(labels[fold::folds], bool)
        score = np.full(len(y), 0.5) if network is None else Reader(network).score(texts[fold::folds])
        errors += int(((score >= threshold) != y).sum())
        loss -= float(np.log(np.clip(np.where(y, score, 1 - score), 1e-9, 1)).sum())
    return errors, loss / max(len(texts), 1)


def sample(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", per_class: int = 1500, most_chars: int = 20_000_000) -> tuple[list[str], list[int]]:
    """Texts and labels of training rows, never of those held out, in the order of their ids' hashes.

    ``per_class`` labelled documents of each class at most, and of each class as
    many as have ``most_chars`` / 2 characters together. Null labels and ids are left
    out. Of an id with several labels the largest counts, of one with several texts
    the first in order.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label is not null")
    known = known.where(~held_out(F.col("id"), 3, 1)).groupBy("id").agg(F.max("label").alias("label"))
    picked = [known.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(per_class) for y in (0, 1)]
    picked = picked[0].union(picked[1])  # 2 * per_class rows at most
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(picked), "id")
    texts = texts.groupBy("id", "label").agg(F.min("text").alias("text"))
    # A window of per_class rows at most.
    order = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0)
    rows = texts.withColumn("run", F.sum(F.length("text")).over(order)).where(F.col("run") <= most_chars // 2)
    rows = sorted(rows.select(F.xxhash64("id").alias("hash"), "id", "label", "text").collect(), key=lambda r: (r["hash"], str(r["id"])))
    return [r["text"] for r in rows], [r["label"] for r in rows]


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", **sample_options) -> DataFrame:
    """Score every whole text by all its overlapping windows.

    Returns the id, ``held_out``, ``score`` (0 to 1, higher: label 1 likelier) and
    ``predicted`` (1 if the score is at least ``threshold``).

    Null texts count as empty; a text without words has the score of one window
    without words. Null and repeated ids pass through, one row out for each row
    in. Without two labelled documents of each class every score is 0.5. An empty
    table gives an empty result. Labels and other columns are no input of a score.
    """
    network = fit(*sample(docs, labels, id_col=id_col, text_col=text_col, **sample_options))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = None if network is None else Reader(network)
        for texts in batches:
            yield pd.Series(0.5 if reader is None else reader.score(list(texts)), index=range(len(texts)), dtype="float64")

    scored = docs.select(F.col(id_col).alias("id"), score(F.col(text_col)).alias("score"))
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id"), 3, 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
