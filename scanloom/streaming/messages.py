"""Extension, not part of the batch pipeline: messages that arrive in files, as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def arriving(spark: SparkSession, path: str, schema: str, files_at_once: int = 100) -> DataFrame:
    """Parquet files of messages (…, topic, ts) as they appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def once(messages: DataFrame, ts: str, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """The first message of each key; state older than ``late`` behind the latest time is forgotten."""
    return messages.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def rates(messages: DataFrame, ts: str, topic: str, window: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Messages of each topic by window of time, final once the watermark has passed it."""
    return messages.withWatermark(ts, late).groupBy(F.window(ts, window), topic).agg(F.count("*").alias("messages"))
