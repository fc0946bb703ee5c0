"""Calls of models, as functions that the caller gives: this library has no model and no network.

``call`` maps a list of prompts to a list of replies, None for one that failed.
It runs on the executors, a batch at a time.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Call = Callable[[list[str]], list[str | None]]


def generate(prompts: DataFrame, call: Call, key: str, prompt_col: str = "prompt", retries: int = 1, wait: float = 5.0) -> DataFrame:
    """(key, reply) for each prompt; prompts that still fail after the retries, ``wait`` seconds apart, are left out."""
    kind = prompts.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            replies: list[str | None] = [None] * len(batch)
            left = list(range(len(batch)))
            for attempt in range(1 + retries):
                if attempt and left:
                    time.sleep(wait)
                asked = call([batch[prompt_col].iloc[i] for i in left]) if left else []
                for i, reply in zip(left, asked):
                    replies[i] = reply
                left = [i for i in left if replies[i] is None]
            yield pd.DataFrame({key: batch[key], "reply": replies})

    return prompts.select(key, prompt_col).mapInPandas(run, f"{key} {kind}, reply string").where("reply is not null")


def judge_score(reply: Column) -> Column:
    """The number in a judge's reply, in JSON with or without a code fence; else null."""
    return F.try_to_number(F.get_json_object(F.replace(F.replace(reply, F.lit("```json"), F.lit("")), F.lit("```"), F.lit("")), "$.score"), F.lit("9")).cast("int")


def encode(texts: DataFrame, call: Callable[[list[str]], list[list[float]]], key: str, text_col: str = "text", prefix: str = "") -> DataFrame:
    """(key, embedding) by an encoder; ``prefix`` is an instruction before queries."""
    kind = texts.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "embedding": call([prefix + (t or "") for t in batch[text_col]])})

    return texts.select(key, text_col).mapInPandas(run, f"{key} {kind}, embedding array<float>")
