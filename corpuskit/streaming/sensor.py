"""Waiting for files: a stream with a timer for each file, which reports that it arrived or that time ran out."""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

WANTED = "name string, seconds double"
ARRIVED = "path string, modificationTime timestamp, length bigint, content binary"
OUTCOME = "name string, outcome string, waited double"
WATCH = "since double, until double, ended boolean, arrived boolean"


def watch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One file: a row when both the wish and the file are there, or when the wish's time is over. Either may come first."""
    now = state.getCurrentProcessingTimeMs() / 1000
    since, until, ended, arrived = state.get if state.exists else (None, None, False, False)
    for rows in () if state.hasTimedOut else batches:
        arrived = arrived or bool(rows["seconds"].isna().any())
        wish = rows["seconds"].dropna()
        if len(wish) and since is None:
            since, until = now, now + float(wish.min())
    outcome = None
    if since is not None and not ended:
        outcome = "arrived" if arrived else "timeout" if state.hasTimedOut or now >= until else None
    state.update((since, until, ended or outcome is not None, arrived))  # what comes later is no second outcome
    if outcome:
        yield pd.DataFrame({"name": [key[0]], "outcome": [outcome], "waited": [max(0.0, now - since)]})
    elif since is not None and not ended:
        state.setTimeoutDuration(max(1, int((until - now) * 1000)))  # every call ends the timer that was set


def outcomes(spark: SparkSession, wishes: str, folder: str, glob: str = "*", named: str = r"([^/]*)$") -> DataFrame:
    """A stream of (name, outcome, waited): for each wish, JSON lines (name, seconds) that arrive in ``wishes``, whether its file arrived in ``folder`` in time.

    ``named`` finds a file's name in its path.
    """
    wanted = spark.readStream.schema(WANTED).json(wishes).where("name is not null and seconds is not null")
    files = spark.readStream.format("binaryFile").schema(ARRIVED).option("pathGlobFilter", glob).load(folder)
    names = files.select(F.regexp_extract("path", named, 1).alias("name"), F.lit(None).cast("double").alias("seconds"))
    return wanted.union(names).groupBy("name").applyInPandasWithState(watch, OUTCOME, WATCH, "append", GroupStateTimeout.ProcessingTimeTimeout)


def start_sensor(spark: SparkSession, wishes: str, folder: str, out: str, checkpoint: str, poll: float = 5.0, glob: str = "*", named: str = r"([^/]*)$") -> StreamingQuery:
    """Look every ``poll`` seconds and append outcomes to the table ``out``, each once, also over restarts with the same checkpoint."""
    found = outcomes(spark, wishes, folder, glob, named)
    return found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(processingTime=f"{int(poll * 1000)} milliseconds").start()


def wait_for_files(spark: SparkSession, names: DataFrame, folder: str, root: str, poll: float = 5.0, limit: float = 7200.0, glob: str = "*", named: str = r"([^/]*)$") -> DataFrame:
    """Wait until each file of ``names`` (name) has arrived in ``folder`` or ``limit`` seconds are over; (name, outcome, waited).

    ``root`` is a folder for the wishes, the outcomes and the checkpoint. Names that
    repeat are one wish; null ones are left out. The driver asks only how many outcomes there are.
    """
    wishes = names.select("name").where("name is not null").distinct().withColumn("seconds", F.lit(float(limit)))
    wishes.write.mode("overwrite").json(f"{root}/wishes")
    n = spark.read.schema(WANTED).json(f"{root}/wishes").count()
    query = start_sensor(spark, f"{root}/wishes", folder, f"{root}/outcomes", f"{root}/checkpoint", poll, glob, named)
    read = lambda: spark.read.schema(OUTCOME).parquet(f"{root}/outcomes")
    end = time.time() + limit + 10 * poll + 60
    try:
        while n:
            query.awaitTermination(poll)
            if query.exception() is not None:
                raise query.exception()
            if query.lastProgress and any(p["numInputRows"] or p["stateOperators"] for p in query.recentProgress) and read().count() >= n:
                break
            if time.time() > end:
                raise TimeoutError("the stream reported no outcome in time")
    finally:
        query.stop()
    return read().join(spark.read.schema(WANTED).json(f"{root}/wishes").select("name"), "name", "left_semi") if n else spark.createDataFrame([], OUTCOME)
