"""Training samples out of clouds, labels and poses that belong together by place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.functions import names
from scanloom.operators import windows


def labelled(points: DataFrame, labels: DataFrame, keys: Sequence[str] = ("frame",)) -> DataFrame:
    """Points (keys, point_idx, …) with the label of the same place in their frame's labels (keys, point_idx, label).

    Frames whose clouds and labels differ in length are left out; see ``unequal``.
    """
    wrong = unequal(points, labels, keys).select(*keys)
    return points.join(labels.select(*keys, "point_idx", "label"), [*keys, "point_idx"]).join(wrong, list(keys), "left_anti")


def unequal(points: DataFrame, labels: DataFrame, keys: Sequence[str] = ("frame",)) -> DataFrame:
    """(keys, points, labels) of frames that have both in different numbers."""
    n = [t.groupBy(*keys).agg(F.count("*").alias(c)) for t, c in ((points, "points"), (labels, "labels"))]
    return n[0].join(n[1], list(keys)).filter(F.col("points") != F.col("labels"))


def by_place(clouds: DataFrame, labels: DataFrame, poses: DataFrame, seq: str = "seq") -> DataFrame:
    """(seq, index, cloud, label, pose): the k-th cloud and label file of each sequence in name order with its k-th pose.

    ``clouds`` and ``labels`` have (seq, path), ``poses`` (seq, line, pose).
    Sequences in which the three aren't equally many are left out.
    """
    files = [names.indexed(t.select(seq, "path"), [seq], "path").select(seq, "index", F.col("path").alias(c)) for t, c in ((clouds, "cloud"), (labels, "label"))]
    numbered = names.indexed(poses.select(seq, "line", "pose"), [seq], "line").select(seq, "index", "pose")
    parts = [*files, numbered]
    counts = None
    for k, t in enumerate(parts):
        c = t.groupBy(seq).agg(F.count("*").alias(f"n{k}"))
        counts = c if counts is None else counts.join(c, seq)
    whole = counts.filter((F.col("n0") == F.col("n1")) & (F.col("n0") == F.col("n2"))).select(seq)
    return files[0].join(files[1], [seq, "index"]).join(numbered, [seq, "index"]).join(whole, seq, "left_semi")


def collated(points: DataFrame, sample: str, frame: str) -> tuple[DataFrame, DataFrame]:
    """Clouds of samples as one: points with ``batch_id`` and their place ``at``, and the end offset of every cloud.

    Samples are numbered in order; clouds follow by sample and frame, points by
    ``point_idx``. Order is made inside samples and clouds only.
    """
    clouds = points.groupBy(sample, frame).agg(F.count("*").alias("n"))
    totals = windows.offsets(clouds.groupBy(sample).agg(F.sum("n").alias("n")), sample, "n").select(sample, F.col("start").alias("_base"))
    ends = windows.offsets(clouds, frame, "n", by=[sample]).join(totals, sample)
    ends = windows.batch_ids(ends, sample).select(sample, frame, "batch_id", "n", (F.col("_base") + F.col("start")).alias("start"), (F.col("_base") + F.col("end")).alias("end"))
    out = windows.ranked(points, [sample, frame], "point_idx", "_k").join(ends.select(sample, frame, "batch_id", "start"), [sample, frame])
    return out.withColumn("at", F.col("start") + F.col("_k")).drop("_k", "start"), ends


def latest(points: DataFrame, time: str = "t") -> DataFrame:
    """Points of the last frame of their window: those at relative time 1."""
    return points.filter(F.col(time) == 1)


def camera_ready(has: Column, image: Column, intrinsic: Column) -> Column:
    """Whether a frame's camera can be used: flagged, with an image and intrinsics."""
    named = lambda c: c.isNotNull() & (c != "")
    return F.coalesce(has, F.lit(False)) & named(image) & named(intrinsic)


def present(frames: DataFrame, files: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frames whose files in all of ``columns`` are among ``files`` (path)."""
    for c in columns:
        frames = frames.join(files.select(F.col("path").alias(c)).distinct(), c, "left_semi")
    return frames
