"""A corpus pipeline of five stages over ``documents``.

Every stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and is the next stage's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpuskit.llm import exact_dedup, mixing, packing, quality, scratch, shingles
from corpuskit.llm.queries import TOKENIZER


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones, rejects go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at a similarity of 0.8 of their five-word shingles, the one with the smallest id stays."""
    return shingles.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, in training order; a document comes as often as it is taken."""
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens at most; their ids follow the order in which the mix was written."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), in_order=True)


STAGES = [("quality", good_quality), ("exact_dedup", exact_copies), ("near_dedup", near_copies), ("mixing", mix), ("packing", pack)]

#: Tokens and fingerprints are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``. What a stage wrote on its way is deleted when its result is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with scratch.dropping(spark) as kept:
            made = stage(spark, docs, sf_dir)
            kept.append(path := scratch.write(made, name))
        docs = scratch.read_back(made, path)
        if before:
            scratch.drop(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
