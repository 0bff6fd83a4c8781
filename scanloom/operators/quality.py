"""Checks of clouds, labels, times, residual folders and masks, as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scanloom.operators import windows


def cloud_stats(points: DataFrame, by: Sequence[str] = (), axes: Sequence[str] = ("x", "y", "z", "intensity")) -> DataFrame:
    """Number of points and the range of each axis."""
    return points.groupBy(*by).agg(F.count("*").alias("points"), *(f(c).alias(f"{n}_{c}") for c in axes for n, f in (("min", F.min), ("max", F.max))))


def label_audit(labels: DataFrame, label: str, valid: Sequence[int]) -> DataFrame:
    """Each label with its count, its share of all in percent, and whether it is valid."""
    counts = labels.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    share = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())
    return counts.select("label", "n", share.alias("percent"), F.coalesce(F.col("label").isin(*valid), F.lit(False)).alias("valid"))


def equal_counts(*tables: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups of which the tables don't have equally many rows, with the counts."""
    out = None
    for k, t in enumerate(tables):
        part = t.groupBy(*by).agg(F.count("*").alias(f"n{k}"))
        out = part if out is None else out.join(part, list(by), "full_outer")
    names = [f"n{k}" for k in range(len(tables))]
    out = out.fillna(0, names)
    return out.filter(F.least(*names) != F.greatest(*names)) if len(names) > 1 else out.limit(0)


def times_quality(times: DataFrame, seq: str, ts: str, tie: str, block: int | None = None) -> DataFrame:
    """Count, order, range, mean interval and rate of each sequence's times, in the order of ``tie``; ``block`` as in ``windows.lagged``."""
    rows = windows.lagged(times, [seq], tie, ts, 1, block)
    rows = rows.withColumn("_d", F.col(ts) - F.col("previous"))
    mean = F.avg("_d")
    return rows.groupBy(seq).agg(
        F.count("*").alias("n"), F.coalesce(F.bool_and(F.col("_d") >= 0), F.lit(True)).alias("monotone"), F.min(ts).alias("first"), F.max(ts).alias("last"),
        mean.alias("mean_interval"), F.when(mean > 0, 1.0 / mean).alias("fps"),
    )


def folder_counts(files: DataFrame, seq: str, kind: str, kinds: Sequence[str]) -> DataFrame:
    """Files of each kind by sequence, and whether all kinds have equally many."""
    out = files.groupBy(seq).agg(*(F.count_if(F.col(kind) == k).alias(k) for k in kinds))
    return out.withColumn("consistent", F.least(*kinds) == F.greatest(*kinds))


def instance_boxes(pixels: DataFrame, by: Sequence[str], instance: str, row: str, column: str) -> DataFrame:
    """The box of each instance; 0 is background."""
    return pixels.filter(F.col(instance) != 0).groupBy(*by, instance).agg(F.min(row).alias("y1"), F.min(column).alias("x1"), F.max(row).alias("y2"), F.max(column).alias("x2"))


def missing(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return wanted.join(present.select(key).distinct(), key, "left_anti")


def available(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return wanted.join(present.select(key).distinct(), key, "left_semi")


def cloud_sizes(files: DataFrame, width: int = 16) -> DataFrame:
    """(path, length, points, whole): point files by size alone; ``whole`` is false where the last point is cut."""
    return files.select("path", "length", F.expr(f"length div {width}").alias("points"), (F.col("length") % width == 0).alias("whole"))


def label_sizes(labels: DataFrame, points: DataFrame, key: str) -> DataFrame:
    """Label files (key, length) that don't hold four bytes for each of the cloud's points (key, points)."""
    rows = labels.join(points, key)
    return rows.filter(F.col("length") != F.col("points") * 4).select(key, "length", (F.col("points") * 4).alias("expected"))


def times_problems(lines: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """(key, lines, expected, unreadable, plain, backwards) of times files whose lines aren't as they should be.

    ``lines`` has (key, line, value). Unreadable lines are no numbers, plain ones
    aren't in scientific form, backward ones are less than the one before.
    """
    t = F.col("value").try_cast("double")
    rows = lines.withColumn("t", t).withColumn("before", F.lag("t").over(Window.partitionBy(key).orderBy("line")))
    found = rows.groupBy(key).agg(
        F.count("*").alias("lines"), F.count_if(F.col("t").isNull()).alias("unreadable"),
        F.count_if(F.col("t").isNotNull() & ~F.lower("value").contains("e")).alias("plain"), F.count_if(F.col("t") < F.col("before")).alias("backwards"),
    )
    out = expected.join(found, key, "left").fillna(0, ["lines", "unreadable", "plain", "backwards"])
    return out.filter((F.col("lines") != F.col("expected")) | (F.col("unreadable") > 0) | (F.col("plain") > 0) | (F.col("backwards") > 0))
