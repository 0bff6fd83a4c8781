"""Files of a recording kept as rows, in any store that Spark reads and writes.

Writers give rows (path, bytes). Kept as Parquet they are committed by Spark: a
lost executor leaves nothing half written, no folder has to be mounted, and
readers take the rows in place of a folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, on one machine else the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def write_packed(files: DataFrame, folder: str) -> None:
    """Keep rows (path, bytes) below ``folder``."""
    files.select("path", F.col("bytes").alias("content")).write.mode("overwrite").parquet(folder)


def packed(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content) of kept files, as readers take them."""
    return spark.read.schema("path string, content binary").parquet(folder)


def round_trip(files: DataFrame, name: str) -> DataFrame:
    """Keep rows (path, bytes) in a new folder of the shared one, and read them from there."""
    folder = f"{shared_folder(files.sparkSession)}/{name}-{uuid.uuid4().hex}"
    write_packed(files, folder)
    return packed(files.sparkSession, folder)
