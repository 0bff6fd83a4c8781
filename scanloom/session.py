"""Session settings that the operators of this package expect."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Sizes follow the cluster; these are what results hang on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "scanloom", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()
