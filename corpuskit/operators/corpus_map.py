"""A map of a corpus in two dimensions: TF-IDF over the commonest words, and its two largest singular directions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.functions import text as T
from corpuskit.sources.shared import materialise


def _vocabulary(tokens: DataFrame, words: int) -> tuple[dict[str, int], list[float]]:
    """The commonest words and their inverse document frequencies, ln((1 + n) / (1 + df)) + 1; ``words`` rows come back."""
    counts = tokens.select("id", F.explode("tokens").alias("w")).groupBy("w", "id").agg(F.count("*").alias("tf")).groupBy("w").agg(F.sum("tf").alias("all"), F.count("*").alias("df"))
    best = counts.orderBy(F.col("all").desc(), "w").limit(words).collect()
    n = tokens.count()
    return {r["w"]: i for i, r in enumerate(best)}, [float(np.log((1 + n) / (1 + r["df"])) + 1) for r in best]


def _flat(batch: pa.RecordBatch, places: str, values: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All entries of a batch of sparse rows: the row, the place and the value of each."""
    row = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(places).offsets.to_numpy()))
    return row, batch.column(places).flatten().to_numpy().astype(np.int64), batch.column(values).flatten().to_numpy()


def corpus_map(docs: DataFrame, words: int = 1000, rounds: int = 12, id_col: str = "doc_id", text_col: str = "text", seed: int = 42) -> DataFrame:
    """(id, x, y) for each document. The directions' signs are free, so that maps agree up to reflection.

    The directions come from a block power iteration: a round sends one small
    matrix to the tasks and sums one for each, whatever the number of documents.
    """
    tokens = docs.select(F.col(id_col).alias("id"), T.tokens(F.col(text_col)).alias("every"))
    tokens = StopWordsRemover(inputCol="every", outputCol="tokens").transform(tokens).select("id", "tokens")
    vocabulary, idf = _vocabulary(tokens, words)
    kind = docs.schema[id_col].dataType.simpleString()

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            places, values = [], []
            for said in batch["tokens"]:
                p, n = np.unique([vocabulary[t] for t in said if t in vocabulary], return_counts=True)
                v = n * np.array(idf)[p.astype(int)] if len(p) else np.zeros(0)
                places.append(p.astype(int).tolist())
                values.append((v / max(np.sqrt((v * v).sum()), 1e-300)).tolist())
            yield pd.DataFrame({"id": batch["id"], "places": places, "values": values})

    rows = materialise(tokens.mapInPandas(weigh, f"id {kind}, places array<int>, values array<double>"), "weighed")
    size = len(vocabulary)
    wide = min(8, size)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, wide)))[0]

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((size, wide))
        for batch in batches:
            row, p, v = _flat(batch, "places", "values")
            # For each entry of a row, its value times the row's product with each direction.
            products = v[:, None] * q[p]
            sums = np.stack([np.bincount(row, products[:, k], batch.num_rows) for k in range(wide)], axis=1)
            weighted = v[:, None] * sums[row]
            out += np.stack([np.bincount(p, weighted[:, k], size) for k in range(wide)], axis=1)
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(size), pa.int32()), "y": pa.array(out.tolist(), pa.list_(pa.float64()))})

    for _ in range(rounds if size else 0):
        parts = rows.select("places", "values").mapInArrow(turn, "i int, y array<double>")
        sums = parts.groupBy("i").agg(*(F.sum(F.get("y", F.lit(k))).alias(f"y{k}") for k in range(wide))).orderBy("i").collect()
        q, r = np.linalg.qr(np.array([tuple(s)[1:] for s in sums]))
    if size:
        q = q @ np.linalg.svd(r)[0]
    q = np.pad(q, ((0, 0), (0, max(0, 2 - wide))))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, p, v = _flat(batch, "places", "values")
            xy = [pa.array(np.bincount(row, v * q[p, k], batch.num_rows)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *xy], names=["id", "x", "y"])

    return rows.mapInArrow(project, f"id {kind}, x double, y double").withColumnRenamed("id", id_col)
