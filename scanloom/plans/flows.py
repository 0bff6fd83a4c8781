"""Whole jobs put together from operators: each is one lazy plan from inputs to a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanloom.functions import names
from scanloom.operators import geometry, labeling, quality, sync, windows
from scanloom.sources import readers, writers

SECOND = 1_000_000_000


def aligned_recording(spark: SparkSession, path: str, lidar: str, cameras: dict[str, str], tolerance_s: float = 0.1, kind: str = "db3", bucket_s: int = 60) -> DataFrame:
    """LiDAR messages with the nearest message of each camera, (path, ts_ns, camera, ts_ns_right).

    Only times are aligned; payloads are decoded later, for matched messages.
    Each recording is a key of its own.
    """
    rows = readers.messages(spark, path, kind, (lidar, *cameras.values())).filter("error is null").select("path", "topic", "ts_ns")
    one = lambda topic: rows.filter(F.col("topic") == topic).select("path", "ts_ns").distinct().withColumn("id", F.col("ts_ns"))
    rights = {camera: one(topic) for camera, topic in cameras.items()}
    return sync.cameras(one(lidar).drop("id"), rights, "ts_ns", "id", bucket_s * SECOND, keys=["path"], tolerance=int(tolerance_s * SECOND)).drop("id_right")


def matched_payloads(messages: DataFrame, aligned: DataFrame, topic: str, ts: str = "ts_ns") -> DataFrame:
    """The payloads of ``topic`` at the matched times, once each."""
    wanted = aligned.select("path", F.col(ts).alias("ts_ns")).distinct()
    return messages.filter(F.col("topic") == topic).join(wanted, ["path", "ts_ns"], "left_semi")


def assets(spark: SparkSession, root: str) -> DataFrame:
    """(kind, timestamp, path) of an asset folder's files."""
    folders = {"lidar": ("lidar", "*.pcd"), "camera1_image": ("camera1_images", "*.png"), "camera1_intrinsic": ("camera1_intrinsics", "*.npz"), "camera2_image": ("camera2_images", "*.png"), "camera2_intrinsic": ("camera2_intrinsics", "*.npz")}
    out = None
    for kind, (folder, pattern) in folders.items():
        part = readers.listing(spark, f"{root}/{folder}", pattern).select(F.lit(kind).alias("kind"), names.stem_timestamp(F.col("path")).alias("timestamp"), "path")
        out = part if out is None else out.unionByName(part)
    return out


def annotated(frames: DataFrame, points: DataFrame, detections: DataFrame, camera: dict[str, float], threshold: float = 0.3, limit: int | None = None) -> DataFrame:
    """Summary rows of frames with points: detections, counts and the moving share.

    ``frames`` is a sync map, ``points`` (frame_id, point_idx, x, y, z),
    ``detections`` (frame_id, class_name, bbox, confidence, …).
    """
    frames = frames.filter(F.col("frame_id") < limit) if limit else frames
    found = labeling.valid_detections(detections, threshold)
    stats = labeling.frame_stats(labeling.label_by_detections(geometry.finite_xyz(points.join(frames.select("frame_id"), "frame_id", "left_semi")), found, camera))
    lists = found.groupBy("frame_id").agg(F.collect_list(F.struct(*(c for c in found.columns if c != "frame_id"))).alias("detections_2d"))
    return frames.join(stats, "frame_id").join(lists, "frame_id", "left")


def box_labels(points: DataFrame, boxes: DataFrame, scheme: str = "taxonomy") -> DataFrame:
    """Labels of points by frame, from boxes as ``readers.boxes`` gives them; frames without boxes rest."""
    moving = boxes.filter("error IS NULL" if "error" in boxes.columns else "true").select(
        F.col("frame").alias("frame_id"), labeling.is_moving(F.col("actions"), F.col("social")).alias("is_moving"),
        F.struct("cx", "cy", "cz", "l", "w", "h", "rot_z").alias("box"),
    )
    return labeling.label_by_boxes(points, moving).withColumn("label", labeling.encode(F.col("is_moving"), scheme))


def sequence_times(files: DataFrame, fps: float | None = None, duration: float | None = None, seq: Column | None = None) -> DataFrame:
    """(seq, frame, time) of point files of the extension that comes first; ``writers.times_files`` writes them."""
    rows = readers.best_points(files).select((F.lit("0") if seq is None else seq).alias("seq"), names.frame_number(F.col("path")).alias("frame")).filter("frame is not null")
    if fps is None and duration:
        n = rows.groupBy("seq").agg((F.count("*") / F.lit(duration)).alias("fps"))
        return names.frame_times(rows.join(n, "seq"), "seq", "frame", F.col("fps")).drop("fps")
    return names.frame_times(rows, "seq", "frame", fps or 15.0)


def training_windows(points: DataFrame, poses: DataFrame, n: int = 4, limit: float = 10.0, most: int = 20_000, seed: int = 42, augment: bool = False) -> DataFrame:
    """Points of every window of ``n`` frames in its last frame's coordinates, with relative time.

    Points (seq, frame, point_idx, x, y, z, raw label) are cropped and sampled
    before frames are repeated over windows; poses alone go through the window.
    """
    kept = geometry.crop_square(points, limit)
    kept = windows.sample_fixed(kept, ["seq", "frame"], F.xxhash64(F.lit(seed), "point_idx"), most)
    w = windows.relative_time(windows.frame_windows(poses.select("seq", "frame", "pose"), "seq", "frame", n, ["pose"]), ["seq", "first"], n)
    w = w.select("seq", "first", "pos", "t", F.col("frame.frame").alias("frame"), F.col("frame.pose").alias("pose"))
    out = geometry.canonical(kept.join(w.select("seq", "first", "frame", "t", "pos"), ["seq", "frame"]), w.select("seq", "first", "frame", "pose"), ["seq", "first"], "frame", "frame")
    out = geometry.augment(out, ["seq", "first"], seed) if augment else out
    return out.withColumn("moving", labeling.decode(F.col("label")).cast("int"))


def evaluation(predictions: DataFrame, by: list[str]) -> DataFrame:
    """Metrics of (prediction, truth) rows: pooled, and as means over the groups ``by``."""
    return labeling.segmentation_metrics(labeling.confusion(predictions, F.col("prediction"), F.col("truth"), by))


def layout_problems(clouds: DataFrame, labels: DataFrame, poses: DataFrame, seq: str = "seq") -> DataFrame:
    """Sequences whose clouds, labels and poses aren't equally many."""
    return quality.equal_counts(clouds, labels, poses, by=[seq])


def kitti_layout(spark: SparkSession, path: str | DataFrame, root: str, sequence: str = "00") -> int:
    """Every label file below ``path`` under its number in name order below ``root``, all or none; the number written."""
    kept = readers.contents(spark, path, "*.label")
    plan = writers.kitti_plan(kept if isinstance(path, DataFrame) else readers.listing(spark, path, "*.label"), sequence)
    return writers.write_files(writers.relaid(kept, plan), root)


def convert_clouds(spark: SparkSession, path: str, root: str, prefix: str = "") -> int:
    """Every PCD file below ``path`` as ``.bin`` below ``root``; the number written."""
    rows = readers.clouds(spark, path, "pcd").filter("error is null")
    name = F.concat(names.prefixed(prefix, names.stem(F.col("path"))), F.lit(".bin"))
    return writers.write_files(writers.cloud_files(rows, name), root)
