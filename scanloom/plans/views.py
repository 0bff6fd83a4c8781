"""The driver's tables seen as sensor data.

A vector of 64 numbers is a frame of 16 points with 4 channels, times 50, or an
image of 64 pixels. Events are messages, their types topics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCALE = 50.0

#: Fixed inputs of the catalogue: detections, camera, boxes.
BBOX = (200.0, 100.0, 450.0, 400.0)
CAMERA = {"fx": 500.0, "fy": 500.0, "cx": 320.0, "cy": 240.0}
BOXES = ((1.0, 2.0, 0.0, 8.0, 4.0, 6.0, 0.3), (-3.0, 1.0, 1.0, 6.0, 6.0, 8.0, 0.0), (0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(frame_id, point_idx, x, y, z, intensity) as doubles."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("frame_id"), "embedding")
    value = lambda k: F.col("embedding")[F.col("point_idx") * 4 + k].cast("double") * SCALE
    rows = e.withColumn("point_idx", F.explode(F.sequence(F.lit(0), F.lit(15))))
    return rows.select("frame_id", F.col("point_idx").cast("bigint").alias("point_idx"), *(value(k).alias(n) for k, n in enumerate(("x", "y", "z", "intensity"))))


def messages(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """(event_id, ts) of one topic, ts in microseconds."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == topic)
    return e.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"))
