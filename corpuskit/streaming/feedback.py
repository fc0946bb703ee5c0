"""Feedback as a stream: JSON files that arrive in a folder, appended to a table and counted by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

FEEDBACK = "timestamp timestamp, question string, answer string, rating string, num_sources int"


def read_feedback(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    return spark.readStream.schema(FEEDBACK).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def append_feedback(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all that has arrived, each event once, and end."""
    return events.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def ratings_by_day(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Ratings up and down in each day; events later than ``late`` are left out in a stream."""
    return events.withWatermark("timestamp", late).groupBy(F.window("timestamp", "1 day").alias("day")).agg(F.count_if(F.col("rating") == "up").alias("up"), F.count_if(F.col("rating") == "down").alias("down"))


def wait_for_file(spark: SparkSession, folder: str, name: str, checkpoint: str) -> bool:
    """Whether a file of this name has arrived in the folder; one look, as a stream that reads what is there and ends."""
    seen: list[int] = []
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", name).load(folder)
    query = files.select("path").writeStream.foreachBatch(lambda df, _: seen.append(df.count())).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(seen) > 0
