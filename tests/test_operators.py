"""Operators on hand-made rows, edges included, and against small independent rules."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanloom.functions import names
from scanloom.operators import geometry, labeling, quality, sync, windows


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def pointer(left, right, strict):
    """The greedy pointer (strict), or plain nearest with ties to the earlier."""
    out, j = [], 0
    for t in left:
        if not strict:
            out.append(min(right, key=lambda r: (abs(r - t), r)) if right else None)
            continue
        while j + 1 < len(right) and abs(right[j + 1] - t) < abs(right[j] - t):
            j += 1
        out.append(right[j] if right else None)
    return out


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("seed", range(4))
def test_nearest(spark, strict, seed):
    random.seed(seed)
    left = sorted(random.sample(range(200), 25))
    right = sorted(random.choice(range(0, 200, 3)) for _ in range(12)) if strict else sorted(random.sample(range(200), 12))
    a = spark.createDataFrame([(k, t) for k, t in enumerate(left)], "id long, ts long")
    b = spark.createDataFrame([(k, t) for k, t in enumerate(right)], "v long, ts long")
    got = [r[1] for r in rows(sync.nearest(a, b, "ts", "v", 16, strict_pointer=strict), "id", "ts_right")]
    assert got == pointer(left, right, strict)


def test_nearest_edges(spark):
    a = spark.createDataFrame([(0, 10), (1, 50), (2, 100)], "id long, ts long")
    b = spark.createDataFrame([(7, 8), (8, 12), (9, 45)], "v long, ts long")
    assert rows(sync.nearest(a, b, "ts", "v", 1000, tolerance=5), "id", "v_right") == [(0, 7), (1, 9)]  # a tie, and just inside
    assert rows(sync.nearest(a, b, "ts", "v", 1000, tolerance=4), "id", "v_right") == [(0, 7)]
    none = b.limit(0)
    assert sync.nearest(a, none, "ts", "v", 1000, tolerance=5).count() == 0
    assert rows(sync.nearest(a, none, "ts", "v", 1000), "id", "v_right") == [(0, None), (1, None), (2, None)]


def test_nearest_by_key(spark):
    a = spark.createDataFrame([("x", 0, 10), ("y", 1, 10)], "bag string, id long, ts long")
    b = spark.createDataFrame([("x", 5, 11), ("y", 6, 1)], "bag string, v long, ts long")
    assert rows(sync.nearest(a, b, "ts", "v", 4, keys=["bag"]), "id", "v_right") == [(0, 5), (1, 6)]


def test_sync_map(spark):
    files = [("lidar", 5, "l5"), ("lidar", 3, "l3"), ("camera1_image", 5, "a"), ("camera1_image", 5, "b"), ("camera2_image", 5, "c"), ("camera1_image", 9, "z")]
    out = sync.sync_map(spark.createDataFrame(files, "kind string, timestamp long, path string"))
    assert rows(out, "frame_id", "timestamp", "camera1_image", "complete_frame") == [(0, 3, None, False), (1, 5, "b", True)]


def test_topics(spark):
    t = spark.createDataFrame([(1, "/a", "X"), (2, "/a", "Y"), (3, "/b", "Z")], "id long, name string, type string")
    assert rows(sync.topic_types(t), "name", "type") == [("/a", "Y"), ("/b", "Z")]


def cloud(spark, points):
    return spark.createDataFrame([(0, k, float(x), float(y), float(z)) for k, (x, y, z) in enumerate(points)], "frame_id long, point_idx long, x double, y double, z double")


def test_crop_and_nan(spark):
    nan = float("nan")
    p = cloud(spark, [(10, 0, 0), (9.99, 0, 0), (nan, 0, 0), (-10, 1, 1), (math.inf, 0, 0)])
    assert rows(geometry.crop_square(p), "point_idx") == [(1,)]
    assert rows(geometry.finite_xyz(p), "point_idx") == [(0,), (1,), (3,), (4,)]


def test_rotated_box(spark):
    box = lambda *v: F.struct(*(F.lit(float(x)).alias(n) for x, n in zip(v, ("cx", "cy", "cz", "l", "w", "h", "rot_z"))))
    p = cloud(spark, [(1, 0, 0), (1.01, 0, 0), (0, 2, 0), (0, 0, 0), (0, 0, 0.6)])
    inside = lambda b: [r[0] for r in rows(p.filter(geometry.in_rotated_box(b)), "point_idx")]
    assert inside(box(0, 0, 0, 2, 4, 1, 0)) == [0, 2, 3]
    assert inside(box(0, 0, 0, 4.0001, 2, 1, math.pi / 2)) == [0, 2, 3]
    assert inside(box(0, 0, 0, 0, 0, 0, 0)) == [3]


def test_labels_by_shapes(spark):
    p = cloud(spark, [(0, 0, 1), (0, 0, 60), (30, 0, 1)])
    det = spark.createDataFrame([(0, [0.0, 0.0, 640.0, 480.0]), (0, [300.0, 200.0, 340.0, 280.0])], "frame_id long, bbox array<double>")
    out = labeling.label_by_detections(p, det, {"fx": 500.0, "fy": 500.0, "cx": 320.0, "cy": 240.0})
    assert rows(out, "point_idx", "is_moving") == [(0, True), (1, False), (2, True)]
    assert rows(labeling.frame_stats(out), "num_points", "moving_points", "static_points") == [(3, 2, 1)]
    assert rows(p.filter(geometry.in_frustum(F.array(*(F.lit(float(v)) for v in (0, 0, 640, 480))), 500, 500, 320, 240)), "point_idx") == [(0,)]


def motion(actions, social):
    motion_keys, static_keys = labeling.MOTION_KEYS, labeling.STATIC_KEYS
    if any(k in a.lower() and c >= t for a, c in actions for k, t in motion_keys.items()):
        return True
    for a, c in social:
        if any(k in a.lower() and c >= t for k, t in motion_keys.items()):
            return True
        if any(k in a.lower() and c >= t for k, t in static_keys.items()):
            return False
    return False


def test_motion(spark):
    random.seed(1)
    pool = ["Walking to", "running", "sitting down", "Standing", "lying", "talking", "playing"]
    cases = [([(random.choice(pool), random.random()) for _ in range(random.randint(0, 2))], [(random.choice(pool), random.random()) for _ in range(random.randint(0, 3))]) for _ in range(300)]
    df = spark.createDataFrame([(k, a, s) for k, (a, s) in enumerate(cases)] + [(300, None, None)], "id long, a array<struct<key: string, value: double>>, s array<struct<key: string, value: double>>")
    got = rows(df.select("id", labeling.is_moving(F.col("a"), F.col("s")).alias("m")), "id", "m")
    assert got == [(k, motion(a, s)) for k, (a, s) in enumerate(cases)] + [(300, False)]


def test_label_schemes(spark):
    df = spark.createDataFrame([(0,), (8,), (9,), (250,), (251,), (259,), ((7 << 16) + 9,)], "l long")
    got = rows(df.select("l", labeling.decode(F.col("l")).alias("a"), labeling.decode(F.col("l"), strip_high_bits=True).alias("b"), labeling.encode(F.col("l") > 250, "boxes").alias("c")), "l", "a", "b", "c")
    assert got == [(0, False, False, 251), (8, False, False, 251), (9, False, False, 251), (250, False, False, 251), (251, True, True, 9), (259, True, True, 9), ((7 << 16) + 9, True, False, 9)]


def test_windows(spark):
    df = spark.createDataFrame([("a", k) for k in range(3)] + [("b", k) for k in range(5)], "seq string, frame long")
    assert [w.count() for w in (windows.frame_windows(df, "seq", "frame", n, []) for n in (3, 4, 5, 6))] == [4, 2, 1, 0]
    one = windows.relative_time(windows.frame_windows(df, "seq", "frame", 1, []), ["seq"], 1)
    assert one.filter("t is not null").count() == 0
    off = windows.offsets(spark.createDataFrame([(k, k + 1) for k in range(10)], "id long, n long"), "id", "n", block=3)
    assert rows(off, "id", "start", "end") == [(k, k * (k + 1) // 2, (k + 1) * (k + 2) // 2) for k in range(10)]
    assert rows(windows.batch_ids(df, "seq").select("seq", "batch_id").distinct(), "seq", "batch_id") == [("a", 0), ("b", 1)]
    assert rows(windows.pad(df, "seq", "frame", 4, {"frame": -1}), "seq", "slot", "frame") == [("a", 0, 0), ("a", 1, 1), ("a", 2, 2), ("a", 3, -1), ("b", 0, 0), ("b", 1, 1), ("b", 2, 2), ("b", 3, 3)]
    assert windows.sample_fixed(df, ["seq"], F.xxhash64("frame"), 2).groupBy("seq").count().filter("count = 2").count() == 2


def test_residual(spark):
    df = spark.createDataFrame([(0, [0.0, 2.0, 50.0]), (1, [1.0, 4.0, 5.0])], "k long, px array<double>").withColumn("s", F.lit(0))
    out = windows.lagged(df, ["s"], "k", "px", 1).select("k", windows.residual(F.col("px"), F.col("previous"), 0.0, 10.0).alias("d"))
    assert rows(out, "k", "d") == [(0, [0.0, 0.0, 0.0]), (1, [1.0, 0.5, 0.0])]


def numpy_pose(p):
    t, (x, y, z, w) = np.array(p[:3]), np.array(p[3:]) / np.linalg.norm(p[3:])
    r = np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])
    m = np.eye(4)
    m[:3, :3], m[:3, 3] = r, t
    return m


def test_canonical(spark):
    rng = np.random.default_rng(0)
    poses, pts = rng.normal(size=(3, 7)) * 5, rng.normal(size=(3, 4, 3)) * 10
    kind = "w long, f long, pose struct<tx: double, ty: double, tz: double, qx: double, qy: double, qz: double, qw: double>"
    a = spark.createDataFrame([(0, k, tuple(map(float, p))) for k, p in enumerate(poses)], kind)
    b = spark.createDataFrame([(0, f, k, *map(float, pts[f, k])) for f in range(3) for k in range(4)], "w long, f long, point_idx long, x double, y double, z double")
    got = {(r.f, r.point_idx): (r.x, r.y, r.z) for r in geometry.canonical(b, a, ["w"], "f", "f").collect()}
    ref = np.linalg.inv(numpy_pose(poses[2]))
    for f in range(3):
        for k in range(4):
            want = (ref @ numpy_pose(poses[f]) @ np.append(pts[f, k], 1))[:3]
            assert np.allclose(got[f, k], want, atol=1e-9)
            if f == 2:
                assert np.allclose(got[f, k], pts[f, k], atol=1e-9)


def test_augment(spark):
    p = spark.createDataFrame([(s, k, 1.0, 2.0, 3.0) for s in range(20) for k in range(3)], "s long, point_idx long, x double, y double, z double")
    out = geometry.augment(p, ["s"], seed=3)
    again = geometry.augment(p, ["s"], seed=3)
    assert rows(out, "s", "point_idx", "x", "y", "z") == rows(again, "s", "point_idx", "x", "y", "z")
    assert all(0.8 * 3 - 0.06 <= r.z <= 1.25 * 3 + 0.06 for r in out.collect())


def test_calibration(spark):
    df = spark.range(1).select(geometry.matrix_from(F.lit("[1.5 2; 3\n-4e1]")).alias("m"))
    assert df.first().m == [1.5, 2.0, 3.0, -40.0]
    rig = spark.createDataFrame([("sensor_0", 0, [0.0, 0.0, 0.0]), ("sensor_10", 1, [3.0, 4.0, 0.0]), ("sensor_2", 2, [3.0, 4.0, 1.0])], "sensor_id string, position int, t array<double>")
    assert geometry.baseline(rig).first()[0] == 3.0
    assert geometry.baseline(rig.limit(1)).first()[0] == 0.06
    assert geometry.reference_camera(rig, "sensor_2").first().sensor_id == "sensor_2"
    assert geometry.reference_camera(rig, "none").first().sensor_id == "sensor_0"


def test_names(spark):
    df = spark.createDataFrame([("/a/12.pcd",), ("/a/x7_9.bin",), ("/a/none.png",), ("/a/9999999999999999999.pcd",)], "p string")
    got = rows(df.select("p", names.stem_timestamp(F.col("p")).alias("t"), names.frame_number(F.col("p")).alias("n"), names.extension_rank(F.col("p")).alias("r")), "p", "t", "n", "r")
    assert got == [("/a/12.pcd", 12, 12, 0), ("/a/9999999999999999999.pcd", 0, None, 0), ("/a/none.png", 0, None, None), ("/a/x7_9.bin", 0, 7, 1)]
    assert spark.range(1).select(names.padded(F.lit(1234567), 6)).first()[0] == "1234567"


def test_frame_times(spark):
    df = spark.createDataFrame([("even", 0), ("even", 1), ("gap0", 0), ("gap0", 4), ("gap", 3), ("gap", 6), ("twice", 0), ("twice", 0), ("one", 5)], "s string, n long")
    got = rows(names.frame_times(df, "s", "n", 10.0).withColumn("time", F.round("time", 6)), "s", "n", "time")
    assert got == [("even", 0, 0.0), ("even", 1, 0.1), ("gap", 3, 0.0), ("gap", 6, 0.3), ("gap0", 0, 0.0), ("gap0", 4, 0.1), ("one", 5, 0.0), ("twice", 0, 0.0), ("twice", 0, 0.0)]
    rate = lambda given, n, d: spark.range(1).select(names.frame_rate(given, F.lit(n), None if d is None else F.lit(d))).first()[0]
    assert [rate(20.0, 5, 1.0), rate(None, 30, 2.0), rate(None, 1, 0.0), rate(None, 1, None)] == [20.0, 15.0, 15.0, 15.0]


def test_metrics(spark):
    c = spark.createDataFrame([(2, 1, 1), (0, 0, 0)], "tp long, fp long, fn long")
    m = labeling.segmentation_metrics(c).first()
    assert (m.micro_iou, m.macro_iou, round(m.micro_f1, 6)) == (0.5, 0.25, 0.666667)
    assert labeling.detection_stats(spark.createDataFrame([([(5,), (None,)],), ([],)], "detections_2d array<struct<mask_area: bigint>>")).first() == (2, 1, 2, 1, 1)


def test_quality(spark):
    t = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 3.0), ("b", 0, 5.0)], "s string, k long, t double")
    assert rows(quality.times_quality(t, "s", "t", "k"), "s", "n", "monotone", "fps") == [("a", 2, True, 0.5), ("b", 1, True, None)]
    px = spark.createDataFrame([(0, 0, 0), (1, 2, 3), (1, 4, 1)], "id long, r long, c long")
    assert rows(quality.instance_boxes(px, [], "id", "r", "c"), "id", "y1", "x1", "y2", "x2") == [(1, 2, 1, 4, 3)]


def test_remap(spark):
    df = spark.createDataFrame([(0,), (8,), (250,), (251,)], "l long")
    assert rows(labeling.remap(df, "l", {0: 0, 251: 2}, "c"), "l", "c") == [(0, 0), (8, None), (250, None), (251, 2)]


def test_nearest_reads_rows_once(spark):
    """no frame that ends at the last row of a partition, whose cost is the square of its rows; matches over many empty buckets and spans."""
    left = [(k, t) for k, t in enumerate([0, 5, 5, 40, 9_000, 25_000, 25_001, 70_000])]
    right = [(100 + k, t) for k, t in enumerate([5, 5, 30, 50, 8_000, 10_000, 31_000])]
    frame = lambda data: spark.createDataFrame(data, "event_id long, ts long")
    want = [(e, t, *min((abs(t - u), u, v) for v, u in right)[1:]) for e, t in left]
    for bucket in (1, 7, 1_000, 100_000):
        found = sync.nearest(frame(left), frame(right), "ts", "event_id", bucket)
        assert sorted(tuple(r) for r in found.select("event_id", "ts", "ts_right", "event_id_right").collect()) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "window" in plan and "unboundedfollowing" not in plan
