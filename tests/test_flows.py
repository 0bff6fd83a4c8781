"""Whole jobs on small inputs."""

import sqlite3

from pyspark.sql import functions as F

from scanloom.operators import windows
from scanloom.plans import flows
from scanloom.sources import readers, writers


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_recording(spark, tmp_path):
    base = sqlite3.connect(tmp_path / "a.db3")
    base.execute("CREATE TABLE topics(id INTEGER, name TEXT, type TEXT)")
    base.execute("CREATE TABLE messages(topic_id INTEGER, timestamp INTEGER, data BLOB)")
    base.executemany("INSERT INTO topics VALUES (?, ?, ?)", [(1, "/l", "P"), (2, "/c", "I"), (3, "/d", "I")])
    s = flows.SECOND
    base.executemany("INSERT INTO messages VALUES (?, ?, ?)", [(1, 0, b"p0"), (1, s, b"p1"), (1, 90 * s, b"p2"), (2, s // 20, b"c"), (2, 90 * s - s // 10, b"d"), (3, s + 1, b"e")])
    base.commit()
    base.close()
    got = flows.aligned_recording(spark, str(tmp_path), "/l", {"camera1": "/c", "camera2": "/d"})
    assert rows(got, "camera", "ts_ns", "ts_ns_right") == [("camera1", 0, s // 20), ("camera1", 90 * s, 90 * s - s // 10), ("camera2", s, s + 1)]
    paid = flows.matched_payloads(readers.messages(spark, str(tmp_path)), got.filter("camera = 'camera1'"), "/l")
    assert rows(paid, "ts_ns", "data") == [(0, bytearray(b"p0")), (90 * s, bytearray(b"p2"))]


def test_assets(spark, tmp_path):
    for name in ("lidar/5.pcd", "camera1_images/5.png", "camera2_images/7.png", "camera1_intrinsics/5.npz", "camera2_intrinsics/x.npz"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    assert rows(flows.assets(spark, str(tmp_path)), "kind", "timestamp") == [("camera1_image", 5), ("camera1_intrinsic", 5), ("camera2_image", 7), ("camera2_intrinsic", 0), ("lidar", 5)]


def test_annotation(spark):
    frames = spark.createDataFrame([(0, 10), (1, 20), (2, 30)], "frame_id long, timestamp long")
    points = spark.createDataFrame([(0, 0, 0.0, 0.0, 1.0), (0, 1, 9.0, 9.0, -1.0), (1, 0, 0.0, 0.0, 1.0)], "frame_id long, point_idx long, x double, y double, z double")
    det = spark.createDataFrame([(0, "car", [300.0, 200.0, 340.0, 280.0], 0.9), (1, "car", [300.0, 200.0, 340.0, 280.0], 0.1)], "frame_id long, class_name string, bbox array<double>, confidence double")
    got = flows.annotated(frames, points, det, {"fx": 500.0, "fy": 500.0, "cx": 320.0, "cy": 240.0})
    assert rows(got.withColumn("n", F.size("detections_2d")), "frame_id", "num_points", "moving_points", "n") == [(0, 2, 1, 1), (1, 1, 0, None)]
    assert flows.annotated(frames, points, det, {"fx": 500.0, "fy": 500.0, "cx": 320.0, "cy": 240.0}, limit=1).count() == 1
    assert "num_detections" in writers.summary_rows(got, reduced=True).columns


def test_boxes(spark, tmp_path):
    (tmp_path / "b.json").write_text('{"labels": {"0.pcd": [{"box": {"l": 2, "w": 2, "h": 2}, "action_label": {"walking": 0.9}}, {"box": {"cx": 9, "l": 2, "w": 2, "h": 2}, "social_activity": {"sitting": 0.9, "walking": 0.9}}]}}')
    points = spark.createDataFrame([("0.pcd", 0, 0.0, 0.0, 0.0), ("0.pcd", 1, 9.0, 0.0, 0.0), ("1.pcd", 0, 0.0, 0.0, 0.0)], "frame_id string, point_idx long, x double, y double, z double")
    got = flows.box_labels(points, readers.boxes(spark, str(tmp_path)))
    assert rows(got, "frame_id", "point_idx", "label") == [("0.pcd", 0, 251), ("0.pcd", 1, 9), ("1.pcd", 0, 9)]


def test_times(spark):
    files = spark.createDataFrame([(f"a/{k:06d}.bin",) for k in range(4)] + [("a/note.txt",)], "path string")
    assert [round(t[0], 6) for t in rows(flows.sequence_times(files), "time")] == [0.0, 0.066667, 0.133333, 0.2]
    assert [t[0] for t in rows(flows.sequence_times(files, duration=2.0), "time")] == [0.0, 0.5, 1.0, 1.5]


def test_training_windows(spark):
    kind = "struct<tx: double, ty: double, tz: double, qx: double, qy: double, qz: double, qw: double>"
    poses = spark.createDataFrame([("s", f, (float(f), 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)) for f in range(3)], f"seq string, frame long, pose {kind}")
    points = spark.createDataFrame([("s", f, k, float(k), 0.0, 0.0, 251 if k else 9) for f in range(3) for k in (0, 1, 10)], "seq string, frame long, point_idx long, x double, y double, z double, label long")
    got = flows.training_windows(points, poses, n=2)
    assert rows(got, "first", "frame", "t", "x", "moving") == sorted((w, w + p, float(p), float(k + p - 1), int(k > 0)) for w in (0, 1) for p in (0, 1) for k in (0, 1))
    assert flows.training_windows(points, poses, n=2, most=1, augment=True).count() == 4
    assert flows.layout_problems(poses, poses, poses.limit(2)).count() == 1


def test_evaluation(spark):
    df = spark.createDataFrame([("a", 0.9, 1), ("a", 0.9, 0), ("b", 0.1, 1)], "w string, prediction double, truth int")
    m = flows.evaluation(df, ["w"]).first()
    assert round(m.micro_iou, 6) == 0.333333 and m.macro_iou == 0.25


def test_convert(spark, tmp_path):
    points = spark.createDataFrame([(1, 0, 1.0, 2.0, 3.0, 0.5)], "frame_id long, point_idx long, x float, y float, z float, intensity float")
    writers.write_files(writers.cloud_files(points, F.lit("7.pcd"), "pcd"), f"{tmp_path}/in")
    assert flows.convert_clouds(spark, f"{tmp_path}/in", f"{tmp_path}/out", "hall") == 1
    assert rows(readers.clouds(spark, f"{tmp_path}/out"), "x", "intensity") == [(1.0, 0.5)]


def test_resize(spark):
    df = spark.createDataFrame([(2, 2, [0.0, 1.0, 2.0, 3.0], 4, 4), (1, 2, [1.0, 3.0], 1, 1)], "h int, w int, px array<double>, m int, n int")
    got = sorted(windows.resized(df, "m", "n").collect(), key=lambda r: -r.m)
    assert got[0].px[:4] == [0.0, 0.25, 0.75, 1.0] and got[0].px[-1] == 3.0 and got[1].px == [2.0]
    assert windows.shuffled(df, 1, "h").count() == 2
