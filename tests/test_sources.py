"""Round trips of the file formats, built in a temporary folder."""

import bz2
import io
import json
import sqlite3
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanloom.functions import names
from scanloom.sources import decode, readers, writers
from scanloom.streaming import messages as stream


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.fixture
def points(spark):
    data = [(f, k, float(k), float(f), -1.5, 0.25) for f in (1, 2) for k in range(5)]
    return spark.createDataFrame(data, "frame_id long, point_idx long, x float, y float, z float, intensity float")


@pytest.mark.parametrize("kind", ["bin", "pcd"])
def test_clouds(spark, points, tmp_path, kind):
    path = F.concat(F.lit("velodyne/"), names.padded(F.col("frame_id"), 6), F.lit(f".{kind}"))
    assert writers.write_files(writers.cloud_files(points.orderBy(F.desc("point_idx")), path, kind), str(tmp_path)) == 2
    assert (tmp_path / f"velodyne/000001.{kind}").exists()
    back = readers.clouds(spark, f"{tmp_path}/velodyne", kind).withColumn("frame_id", names.stem_timestamp(F.col("path")))
    assert rows(back, "frame_id", "point_idx", "x", "y", "z", "intensity", "error") == [(*r, None) for r in rows(points, *points.columns)]


def lzf_literal(data):
    return b"".join(bytes([len(data[k : k + 32]) - 1]) + data[k : k + 32] for k in range(0, len(data), 32))


def test_pcd_kinds():
    a = np.arange(12, dtype="<f4").reshape(3, 4)
    head = "# c\nVERSION .7\nFIELDS x y z reflectance\nSIZE 4 4 4 4\nTYPE F F F F\nCOUNT 1 1 1 1\nWIDTH 3\nHEIGHT 1\nPOINTS 3\nDATA "
    text = "\n".join(" ".join(map(str, r)) for r in a.tolist())
    assert np.array_equal(decode.cloud_pcd((head + "ascii\n" + text + "\n").encode()), a)
    body = np.ascontiguousarray(a.T).tobytes()
    packed = lzf_literal(body)
    assert np.array_equal(decode.cloud_pcd((head + "binary_compressed\n").encode() + struct.pack("<II", len(packed), len(body)) + packed), a)
    assert decode.lzf(bytes([2]) + b"abc" + bytes([(7 << 5), 1, 2]), 13) == b"abcabcabcabca"
    bare = head.replace(" reflectance", "").replace("4 4 4 4", "4 4 4").replace("F F F F", "F F F").replace("1 1 1 1", "1 1 1")
    assert decode.cloud_pcd((bare + "ascii\n1 2 3\n4 5 6\n7 8 9\n").encode())[:, 3].tolist() == [0, 0, 0]


def test_labels_and_errors(spark, tmp_path):
    df = spark.createDataFrame([(7, 1, 251), (7, 0, (5 << 16) + 9)], "ts long, point_idx long, label long")
    writers.write_files(writers.label_files(df, F.concat(names.padded(F.col("ts"), 19), F.lit(".label"))), str(tmp_path))
    (tmp_path / "bad.label").write_bytes(b"12345")
    (tmp_path / "empty.label").write_bytes(b"")
    got = readers.labels(spark, str(tmp_path))
    assert rows(got.filter("error is null"), "point_idx", "label") == [(0, (5 << 16) + 9), (1, 251)]
    assert got.filter("error is not null").count() == 1
    plan = writers.kitti_plan(readers.listing(spark, str(tmp_path), "*7.label"))
    assert rows(plan, "target") == [("sequences/00/labels/000000.label",)]


def test_intrinsics(spark, tmp_path):
    k = [500.0, 0.0, 320.0, 0.0, 501.0, 240.0, 0.0, 0.0, 1.0]
    cams = spark.createDataFrame([("9.npz", k, [0.1] * 5, 480, 640)], "path string, K array<double>, D array<double>, height int, width int")
    writers.write_files(writers.intrinsics_files(cams, F.col("path")), str(tmp_path))
    np.savez(tmp_path / "bare.npz", height=3)
    got = {r.path.rsplit("/", 1)[-1]: r for r in readers.intrinsics(spark, str(tmp_path)).collect()}
    assert (got["9.npz"].fx, got["9.npz"].fy, got["9.npz"].cx, got["9.npz"].cy, got["9.npz"].width) == (500, 501, 320, 240, 640)
    assert (got["bare.npz"].D, got["bare.npz"].fx, got["bare.npz"].width) == ([0.0] * 5, 1.0, None)
    assert readers.intrinsics(spark, str(tmp_path), strict=True).filter("error is not null").count() == 1


def test_rasters_and_images(spark, tmp_path):
    px = spark.createDataFrame([("a", 0, 0, 1.0), ("a", 1, 2, 7.0)], "f string, r long, c long, v double")
    writers.write_files(writers.raster_files(px, F.concat("f", F.lit(".npy"))), str(tmp_path))
    got = readers.rasters(spark, str(tmp_path))
    assert got.count() == 6 and rows(got.filter("v <> 0"), "r", "c", "v") == [(0, 0, 1.0), (1, 2, 7.0)]
    img = spark.createDataFrame([("i.png", 1, 2, bytearray([1, 2, 3, 4, 5, 6]))], "p string, height int, width int, pixels binary")
    writers.write_files(writers.image_files(img, F.col("p")), str(tmp_path))
    assert (tmp_path / "i.png").read_bytes().startswith(b"\x89PNG")


def test_text(spark, tmp_path):
    t = spark.createDataFrame([("s", k, k / 15) for k in range(12)], "seq string, line long, time double")
    writers.write_files(writers.times_files(t, F.lit("times.txt")), str(tmp_path))
    assert (tmp_path / "times.txt").read_text().split("\n")[:2] == ["0.000000e+00", "6.666667e-02"]
    assert rows(readers.times(spark, f"{tmp_path}/times.txt"), "line") == [(k,) for k in range(12)]
    (tmp_path / "poses.txt").write_text("0 1 2 3 0 0 0 1\n\n1 2 3\n")
    p = readers.poses(spark, f"{tmp_path}/poses.txt").orderBy("line").collect()
    assert p[0].pose.tz == 3.0 and p[0].error is None and p[1].pose is None and p[1].error == "columns: 3"
    m = spark.createDataFrame([("P0", [float(k) for k in range(12)]), ("Tr", [0.5] * 12)], "name string, m array<double>")
    writers.write_files(writers.calibration_files(m, F.lit("calib.txt")), str(tmp_path))
    assert rows(readers.calibration(spark, f"{tmp_path}/calib.txt"), "name", "m") == rows(m, "name", "m")


def test_json(spark, tmp_path):
    (tmp_path / "boxes.json").write_text(json.dumps({"labels": {"1.pcd": [{"box": {"cx": 1, "rot_z": 2}, "action_label": {"walking": 0.9, "a": 0.1}}, {}]}}))
    got = readers.boxes(spark, str(tmp_path)).orderBy("box_id").collect()
    assert [(b.cx, b.l, b.rot_z) for b in got] == [(1.0, 0.0, 2.0), (0.0, 0.0, 0.0)] and [a.key for a in got[0].actions] == ["walking", "a"] and got[1].social == []
    (tmp_path / "map").mkdir()
    (tmp_path / "map/m.json").write_text(json.dumps([{"frame_id": 0, "timestamp": 12345678901234567, "lidar": "l", "has_camera1": False}]))
    m = readers.sync_map(spark, f"{tmp_path}/map")
    assert rows(m, "timestamp", "camera1_image", "has_camera1") == [(12345678901234567, None, False)]
    writers.write_json(m, f"{tmp_path}/out")
    assert any('"camera1_image":null' in f.read_text() for f in (tmp_path / "out").glob("*.json"))


def test_cameras(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text("cameras:\n  sensor_0:\n    K: '[1 0 2; 0 3 4; 0 0 1]'\n    R: [[1,0,0],[0,1,0],[0,0,1]]\n    T: [1,2,3]\n  sensor_1: {K: x}\n  other: {}\n")
    got = readers.cameras(spark, f"{tmp_path}/c.yaml").collect()
    assert [(c.sensor_id, c.K[4], c.width, c.D) for c in got] == [("sensor_0", 3.0, 752, [0.0] * 5)]


def cdr(parts):
    """Fields (kind, value) in the aligned format, little-endian."""
    out = bytearray()
    for kind, value in parts:
        if kind == "s":
            out += b"\0" * (-len(out) % 4) + struct.pack("<I", len(value) + 1) + value.encode() + b"\0"
        elif kind == "b":
            out += value
        else:
            size = struct.calcsize(kind)
            out += b"\0" * (-len(out) % size) + struct.pack("<" + kind, value)
    return b"\0\1\0\0" + bytes(out)


def cloud_message(points):
    head = [("I", 1), ("I", 2), ("s", "map"), ("I", 1), ("I", len(points)), ("I", 3)]
    for k, n in enumerate("xyz"):
        head += [("s", n), ("I", 4 * k), ("B", 7), ("I", 1)]
    body = np.array(points, "<f4").tobytes()
    return cdr([*head, ("B", 0), ("I", 12), ("I", len(body)), ("I", len(body)), ("b", body), ("B", 1)])


def test_recordings(spark, tmp_path):
    base = sqlite3.connect(tmp_path / "a.db3")
    base.execute("CREATE TABLE topics(id INTEGER, name TEXT, type TEXT)")
    base.execute("CREATE TABLE messages(topic_id INTEGER, timestamp INTEGER, data BLOB)")
    base.executemany("INSERT INTO topics VALUES (?, ?, ?)", [(1, "/points", "PointCloud2"), (2, "/image", "Image"), (3, "/info", "CameraInfo"), (4, "/jpg", "CompressedImage")])
    image = cdr([("I", 0), ("I", 0), ("s", ""), ("I", 1), ("I", 2), ("s", "rgb8"), ("B", 0), ("I", 6), ("I", 6), ("b", bytes([1, 2, 3, 4, 5, 6]))])
    info = cdr([("I", 0), ("I", 0), ("s", "c"), ("I", 480), ("I", 640), ("s", "plumb"), ("I", 2), ("d", 0.1), ("d", 0.2), *(("d", float(v)) for v in range(9))])
    jpg = cdr([("I", 0), ("I", 0), ("s", ""), ("s", "jpeg"), ("I", 3), ("b", b"abc")])
    base.executemany("INSERT INTO messages VALUES (?, ?, ?)", [(1, 20, cloud_message([(1, 2, 3), (4, 5, 6)])), (2, 10, image), (3, 11, info), (4, 12, jpg), (2, 13, b"\0\1\0\0broken")])
    base.commit()
    base.close()
    every = readers.messages(spark, str(tmp_path))
    assert rows(every, "topic", "ts_ns")[0] == ("/image", 10) and every.count() == 5
    assert rows(readers.topics(spark, str(tmp_path)), "id", "name")[0] == (1, "/points")
    own = lambda t: readers.messages(spark, str(tmp_path), topics=(t,))
    assert rows(readers.message_points(own("/points")), "ts_ns", "point_idx", "x", "z") == [(20, 0, 1.0, 3.0), (20, 1, 4.0, 6.0)]
    images = readers.message_images(own("/image"))
    assert [bytes(r.pixels) for r in images.filter("error is null").collect()] == [bytes([3, 2, 1, 6, 5, 4])] and images.filter("error is not null").count() == 1
    assert rows(readers.message_cameras(own("/info")), "height", "width", "D") == [(480, 640, [0.1, 0.2])]
    import pyarrow as pa

    sized = readers.with_model(readers.message_files(own("/jpg")), "file", "n", "bigint", lambda: len, pa.int64())
    assert rows(sized, "n") == [(3,)]


def record(head, body):
    packed = b"".join(struct.pack("<I", len(k) + 1 + len(v)) + k + b"=" + v for k, v in head.items())
    return struct.pack("<I", len(packed)) + packed + struct.pack("<I", len(body)) + body


@pytest.mark.parametrize("packing", [b"none", b"bz2"])
def test_bag(spark, tmp_path, packing):
    link = struct.pack("<I", len(b"type=T")) + b"type=T"
    body = record({b"op": b"\7", b"conn": b"\0\0\0\0", b"topic": b"/p"}, link) + record({b"op": b"\2", b"conn": b"\0\0\0\0", b"time": struct.pack("<II", 3, 7)}, b"data")
    chunk = record({b"op": b"\5", b"compression": packing, b"size": struct.pack("<I", len(body))}, bz2.compress(body) if packing == b"bz2" else body)
    (tmp_path / "a.bag").write_bytes(b"#ROSBAG V2.0\n" + record({b"op": b"\3"}, b" " * 10) + chunk)
    (tmp_path / "b.orig.bag").write_bytes(b"x")
    assert rows(readers.messages(spark, str(tmp_path), "bag"), "topic", "msg_type", "ts_ns", "data") == [("/p", "T", 3_000_000_007, bytearray(b"data"))]


def test_masks_and_colours(spark):
    px = spark.createDataFrame([("f", 0, 0, 0), ("f", 0, 0, 9), ("f", 1, 1, 2)], "frame string, r long, c long, instance int")
    assert rows(writers.combined_masks(px, ["frame"]), "r", "c", "colour") == [(0, 0, [0, 255, 0]), (1, 1, [0, 0, 255])]
    det = spark.createDataFrame([(0, "a", 3, b"m"), (0, "a", 1, None), (0, "a", 2, b"n")], "frame_id long, camera string, det_idx int, mask binary")
    assert rows(writers.numbered_masks(det), "det_idx", "instance") == [(2, 0), (3, 1)]
    assert rows(writers.cloud_colours(spark.createDataFrame([(True,), (False,)], "is_moving boolean")), "colour") == [([0.5, 0.5, 0.5],), ([1.0, 0.0, 0.0],)]


def test_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, "/a", 0), (1, "/a", 5), (2, "/b", 61)], "id long, topic string, s long").select("id", "topic", F.timestamp_seconds("s").alias("ts"))
    df.write.parquet(f"{tmp_path}/in")
    out = stream.once(stream.arriving(spark, f"{tmp_path}/in", "id long, topic string, ts timestamp"), "ts", ["id"])
    q = out.writeStream.format("memory").queryName("seen").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("seen").count() == 2


def test_folders(spark, tmp_path):
    (tmp_path / "lidar").mkdir()
    (tmp_path / "lidar/1.pcd").write_bytes(b"x")
    assert readers.missing_folders(spark, str(tmp_path), ("lidar", "camera1_images")) == ["camera1_images"]
    files = spark.createDataFrame([("a/1.bin",), ("a/2.pcd",), ("a/3.txt",)], "path string")
    assert rows(readers.best_points(files), "path") == [("a/2.pcd",)]
