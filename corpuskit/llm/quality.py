"""A quality classifier: naive Bayes log-count ratios as the scale of a linear support vector machine.

Features are indicators of the byte 1- to 3-grams that a text holds, hashed to a
fixed number of places, and of n-grams that repeat one word. Each is scaled by the log ratio of its smoothed counts in
the two classes; a linear model with hinge loss is then fitted to the scaled
indicators by dual coordinate descent, and its margins are turned into
probabilities by a logistic curve fitted to rows that the model has not seen.

The model is fitted at the driver on a bounded sample of labelled rows:
``per_class`` rows of each class at most, those of the smallest hash of their
ids, and of these as many as hold ``most_places`` n-grams together. Its size
doesn't depend on the data. Scoring reads all rows.

The features, the constant and the cost were chosen by ``cross_validate`` over
training rows alone; labels of held-out rows were no part of any choice.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Places of hashed n-grams, and after them those of n-grams of one word: it stands 2, 3, 4, 6, 8 or 12 times in a row.
HASHED = 1 << 18
RUNS = (2, 3, 4, 6, 8, 12)
PLACES = HASHED + len(RUNS)
#: The value of the constant feature, beside ratios of some tenths to a few units, and the cost of a row's loss.
CONSTANT, COST = 1.0, 1.0


def ngrams(text: str | None, at_once: int = 1 << 20) -> np.ndarray:
    """The places of all byte 1-, 2- and 3-grams of a text and of its runs of one word, each once, in order."""
    whole = (text or "").encode()
    raw, words = np.frombuffer(whole, np.uint8), whole.split()
    found = np.zeros(0, np.uint32)
    for start in range(0, len(raw), at_once):
        b = raw[start : start + at_once + 2].astype(np.uint32)
        codes = [b, (b[:-1] << 8 | b[1:]) + 256, (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) + 65_792]
        found = np.union1d(found, np.concatenate(codes)) if start else np.unique(np.concatenate(codes))
    hashed = np.unique((found * np.uint32(2_654_435_761)) >> np.uint32(14))
    longest = 1 + max(map(len, bytes(map(eq, words, words[1:])).split(b"\0")), default=0)
    return np.concatenate((hashed, np.array([HASHED + k for k, n in enumerate(RUNS) if longest >= n], np.uint32)))


@dataclass
class Model:
    """``weights`` hold the product of ratio and linear weight of each place, ``squares`` that of the ratio with itself."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    constant: float = CONSTANT
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, places: np.ndarray) -> float:
        """Of the row scaled to unit length, as in the fit."""
        return (float(self.weights[places].sum()) + self.bias * self.constant) / math.sqrt(float(self.squares[places].sum()) + self.constant**2)

    def score(self, places: np.ndarray) -> float:
        z = self.slope * self.margin(places) + self.shift
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    p, q = np.full(PLACES, smooth), np.full(PLACES, smooth)
    for places, label in zip(rows, y):
        (p if label else q)[places] += 1
    return np.log(p / p.sum()) - np.log(q / q.sum())


def fit_hinge(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, constant: float = CONSTANT, cost: float = COST, rounds: int = 20, seed: int = 0, enough: float = 1e-3) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the linear hinge loss; rows are scaled to unit length."""
    rng, n = np.random.default_rng(seed), len(rows)
    squares = ratios * ratios
    scale = [1 / math.sqrt(float(squares[r].sum()) + constant**2) for r in rows]
    sign = np.where(y, 1.0, -1.0)
    most = np.full(n, cost)
    alpha, w, bias = np.zeros(n), np.zeros(PLACES), 0.0
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(n):
            value = ratios[rows[i]] * scale[i]  # not kept, as all rows' values are several times as large as the rows
            gradient = sign[i] * (w[rows[i]] @ value + bias * constant * scale[i]) - 1
            new = min(max(alpha[i] - gradient, 0.0), most[i])  # the rows' squared length is 1
            step = (new - alpha[i]) * sign[i]
            if step:
                w[rows[i]] += step * value
                bias += step * constant * scale[i]
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < enough:
            break
    return w * ratios, bias


def fit_curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """A logistic curve over margins, with the smoothed targets of Platt, by Newton steps."""
    pos, neg = int(y.sum()), int(len(y) - y.sum())
    target = np.where(y, (pos + 1) / (pos + 2), 1 / (neg + 2))
    weight = np.full(len(y), 1 / len(y))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g, h = weight * (p - target), weight * p * (1 - p)
        ga, gb = g @ margins + 1e-4 * a, g.sum()
        haa, hab, hbb = h @ margins**2 + 1e-4 + 1e-9, h @ margins, h.sum() + 1e-9
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(1.0, abs(da), abs(db))
        a, b = a - da / size, b - db / size
        if max(abs(da), abs(db)) < 1e-8:
            break
    return max(a, 1e-6), b


def fit(rows: list[np.ndarray], labels: list[int], constant: float = CONSTANT, cost: float = COST) -> Model | None:
    """None if there aren't two rows of each class at least."""
    y = np.array(labels, bool)
    if min(y.sum(), len(y) - y.sum()) < 2:
        return None
    order = np.concatenate([np.flatnonzero(y), np.flatnonzero(~y)])
    late = np.zeros(len(y), bool)
    late[order[::5]] = True  # a fifth of either class is for the curve
    if not 0 < y[late].sum() < late.sum():
        late[np.flatnonzero(y)[0]] = late[np.flatnonzero(~y)[0]] = True
    early = np.flatnonzero(~late)
    seen = [rows[i] for i in early]
    ratios = log_count_ratios(seen, y[early])
    weights, bias = fit_hinge(seen, y[early], ratios, constant, cost)
    model = Model(weights, ratios * ratios, bias, constant)
    margins = np.array([model.margin(rows[i]) for i in np.flatnonzero(late)])
    model.slope, model.shift = fit_curve(margins, y[late])
    return model


def cross_validate(rows: list[np.ndarray], labels: list[int], folds: int = 4, threshold: float = 0.7, **options) -> tuple[int, float]:
    """Errors, and the mean log loss, of rows that models fitted on the other folds score; for choices among options of ``fit``."""
    errors, loss = 0, 0.0
    for fold in range(folds):
        model = fit([r for i, r in enumerate(rows) if i % folds != fold], [y for i, y in enumerate(labels) if i % folds != fold], **options)
        for r, y in zip(rows[fold::folds], labels[fold::folds]):
            score = 0.5 if model is None else min(max(model.score(r), 1e-9), 1 - 1e-9)
            errors += (score >= threshold) != bool(y)
            loss -= math.log(score if y else 1 - score)
    return errors, loss / max(len(rows), 1)


def held_out(id_col: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", per_class: int = 4000, most_places: int = 40_000_000) -> tuple[list[np.ndarray], list[int]]:
    """The features and labels of the training rows, never of those held out, in the order of their ids' hashes.

    ``per_class`` labelled documents of each class at most, and of each class as
    many as have ``most_places`` / 2 places together (80 MB). Null labels and ids
    are left out. Of an id with several labels the largest counts, of one with
    several texts the one with the most places.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label is not null").where(~held_out(F.col("id")))
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    picked = [known.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(per_class) for y in (0, 1)]
    picked = picked[0].union(picked[1])  # 2 * per_class rows at most

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 100):
                part = batch.slice(a, 100)
                places = [ngrams(t.as_py()) for t in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([len(p) for p in places], pa.int32()), pa.array([p.astype(np.uint32).tobytes() for p in places], pa.binary())], names=["id", "label", "n", "places"])

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id").select("id", "label", "text")
    rows = texts.mapInArrow(grams, f"id {kind}, label int, n int, places binary")
    rows = rows.groupBy("id", "label").agg(F.max(F.struct("n", "places")).alias("best")).select("id", "label", "best.*")
    # A window of per_class rows at most.
    order = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("run", F.sum("n").over(order)).where(F.col("run") <= most_places // 2).select(F.xxhash64("id").alias("hash"), "id", "label", "places").collect()
    rows = sorted(rows, key=lambda r: (r["hash"], str(r["id"])))
    return [np.frombuffer(r["places"], np.uint32) for r in rows], [r["label"] for r in rows]


def train(docs: DataFrame, labels: DataFrame, **options) -> Model | None:
    """Fit on ``sample``, whose options this takes."""
    return fit(*sample(docs, labels, **options))


def scorer(model: Model | None):
    """A column function from texts to scores; without a model, a half."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([0.5 if model is None else model.score(ngrams(t)) for t in texts], dtype="float64")

    return score


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", **fit_options) -> DataFrame:
    """Score every whole text.

    Returns the id, ``held_out``, ``score`` (0 to 1, higher: label 1 likelier) and
    ``predicted`` (1 if the score is at least ``threshold``).

    Null texts count as empty; an empty text has the score of the model without
    any feature. Null and repeated ids pass through, one row out for each row
    in. Without two labelled documents of each class every score is 0.5. An empty
    table gives an empty result. Labels, and other columns, are no input.
    """
    score = scorer(train(docs, labels, id_col=id_col, text_col=text_col, **fit_options))
    scored = docs.select(F.col(id_col).alias("id"), score(F.col(text_col)).alias("score"))
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", **fit_options) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is at least ``threshold``; all rows where nothing could be learnt."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **fit_options)
    if model is None:
        return docs
    return docs.where(scorer(model)(F.col(text_col)) >= threshold)
