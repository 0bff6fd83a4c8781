"""Samples by place, kept files, messages and pictures, and checks of files, on hand-made rows."""

import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scanloom.functions import names
from scanloom.operators import labeling, quality, samples, windows
from scanloom.sources import decode, encode, readers, store, writers


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_labelled(spark):
    points = spark.createDataFrame([(f, k, float(k)) for f in (1, 2, 3) for k in range(3)], "frame long, point_idx long, x double")
    labels = spark.createDataFrame([(1, k, 251 + k) for k in range(3)] + [(2, 0, 9), (2, 1, 9)], "frame long, point_idx long, label long")
    assert rows(samples.labelled(points, labels), "frame", "point_idx", "label") == [(1, 0, 251), (1, 1, 252), (1, 2, 253)]
    assert rows(samples.unequal(points, labels), "frame", "points", "labels") == [(2, 3, 2)]
    assert samples.labelled(points.limit(0), labels).count() == 0


def test_by_place(spark):
    files = lambda n: spark.createDataFrame([(s, f"{s}/{9 - k:03d}") for s, m in n.items() for k in range(m)], "seq string, path string")
    poses = spark.createDataFrame([(s, k, k * 10) for s in "ab" for k in range(2)], "seq string, line long, pose long")
    got = samples.by_place(files({"a": 2, "b": 2}), files({"a": 2, "b": 1}), poses)
    assert rows(got, "seq", "index", "cloud", "label", "pose") == [("a", 0, "a/008", "a/008", 0), ("a", 1, "a/009", "a/009", 10)]


def test_collated(spark):
    sizes = {(3, 0): 2, (3, 1): 1, (7, 0): 3}
    points = spark.createDataFrame([(s, f, k) for (s, f), n in sizes.items() for k in range(n)], "sample long, frame long, point_idx long")
    out, ends = samples.collated(points, "sample", "frame")
    assert rows(out, "at", "sample", "frame", "point_idx", "batch_id") == [(0, 3, 0, 0, 0), (1, 3, 0, 1, 0), (2, 3, 1, 0, 0), (3, 7, 0, 0, 1), (4, 7, 0, 1, 1), (5, 7, 0, 2, 1)]
    assert rows(ends, "sample", "frame", "end") == [(3, 0, 2), (3, 1, 3), (7, 0, 6)]


def test_lagged_in_blocks(spark):
    ids = [0, 1, 2, 9, 10, 35, 36, 70]
    df = spark.createDataFrame([(s, i, i * 2) for s in "ab" for i in ids], "seq string, i long, v long")
    for n in (1, 2, 3):
        got = {(r.seq, r.i): r.previous for r in windows.lagged(df, ["seq"], "i", "v", n, block=10).collect()}
        assert got == {(s, i): ids[k - n] * 2 if k >= n else None for s in "ab" for k, i in enumerate(ids)}


def test_guards(spark):
    df = spark.createDataFrame([(1, True, "a", "b"), (2, True, "", "b"), (3, None, "a", "b"), (4, True, "a", None)], "k long, has boolean, image string, info string")
    assert [r.k for r in df.filter(samples.camera_ready(F.col("has"), F.col("image"), F.col("info"))).collect()] == [1]
    assert [r.k for r in samples.present(df, spark.createDataFrame([("b",)], "path string"), ["info"]).orderBy("k").collect()] == [1, 2, 3]


def test_kept_files(spark, tmp_path):
    files = spark.createDataFrame([("a/1.bin", bytearray(np.arange(8, dtype="<f4").tobytes())), ("a/2.bin", bytearray(b"odd")), ("a/3.txt", bytearray(b"x"))], "path string, bytes binary")
    got = readers.clouds(spark, store.round_trip(files, "test"))
    assert rows(got.filter("error is null"), "path", "point_idx", "x") == [("a/1.bin", 0, 0.0), ("a/1.bin", 1, 4.0)]
    assert [r.path for r in got.filter("error is not null").collect()] == ["a/2.bin"]


def test_small_files_share_batches():
    arrow = pa.schema([("path", pa.string()), ("k", pa.int64()), ("error", pa.string())])
    read = lambda data: iter([{"k": np.arange(len(data))}] if data != b"no" else [{"k": np.arange(1)}, {"k": ["x"]}])
    made = lambda paths, data: list(readers.decoded(pa.RecordBatch.from_pydict({"path": paths, "content": pa.array(data, pa.binary())}), "content", ["path"], arrow, read))
    many = made([f"{k}" for k in range(500)], [b"abc"] * 500)
    assert len(many) == 1 and many[0].to_pydict() == {"path": [f"{k // 3}" for k in range(1500)], "k": [0, 1, 2] * 500, "error": [None] * 1500}
    odd = made(["a", None, "a", "b", "c", None], [b"xy", b"z", None, b"no", b"", b"u"])
    assert [(r["path"], r["k"], (r["error"] or "")[:5]) for b in odd for r in b.to_pylist()] == [("a", 0, ""), ("a", 1, ""), (None, 0, ""), ("a", None, "TypeE"), ("b", 0, ""), ("b", None, "Arrow"), (None, 0, "")]
    assert made([], []) == [] and sum(map(len, made(["a"], [b""]))) == 0
    assert [len(b) for b in made(list("abc"), [bytes(readers.ROWS - 1), b"x", b"y"])] == [readers.ROWS, 1]
    assert len(made(["a"] * 3, [bytes(readers.BYTES // 8)] * 3)) == 3


@pytest.mark.parametrize("kind", ["db3", "bag"])
def test_recordings(spark, kind):
    sent = [("a", "/p", "T", 5, bytearray(b"x")), ("a", "/q", "U", 3, bytearray(b"")), ("b", "/p", "T", 2_000_000_001, bytearray(b"yz"))]
    files = encode.recording_files(spark.createDataFrame([(f"{p}.{kind}", *r) for p, *r in sent], "path string, topic string, msg_type string, ts_ns long, data binary"), kind)
    got = readers.messages(spark, store.round_trip(files, "test"), kind)
    assert rows(got, "path", "topic", "msg_type", "ts_ns", "data") == sorted((f"{p}.{kind}", *r) for p, *r in sent)


def filtered(pixels, kind):
    """A PNG whose lines all use one filter."""
    h, w, c = pixels.shape
    flat, lines = pixels.reshape(h, w * c).astype(int), []
    for y in range(h):
        line = []
        for x in range(w * c):
            a, b, d = flat[y, x - c] if x >= c else 0, flat[y - 1, x] if y else 0, flat[y - 1, x - c] if y and x >= c else 0
            p = a + b - d
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - d), 2, d))[2]
            line.append((flat[y, x] - (0, a, b, (a + b) // 2, paeth)[kind]) % 256)
        lines.append(bytes([kind, *line]))
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2, 4: 6}[c], 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")


@pytest.mark.parametrize("kind", range(5))
@pytest.mark.parametrize("channels", [1, 3, 4])
def test_png(kind, channels):
    pixels = np.random.default_rng(kind).integers(0, 256, (5, 7, channels), np.uint8)
    assert np.array_equal(decode.png_pixels(filtered(pixels, kind)), pixels)


def test_pictures(spark):
    pixels = np.zeros((2, 3, 3), np.uint8)
    pixels[0, 0] = (255, 255, 255)
    df = spark.createDataFrame([("a.png", bytearray(decode.png(pixels))), ("b.png", bytearray(b"no"))], "path string, file binary")
    got = {r.path: r for r in readers.pictures(df).collect()}
    assert got["a.png"].grey == [1.0] + [0.0] * 5 and (got["a.png"].height, got["a.png"].width) == (2, 3)
    assert got["b.png"].error and got["b.png"].grey is None


def test_point_files(spark):
    names_ = ["r1/a.bin", "r1/b.pcd", "r1/velodyne/c.pcd", "r2/velodyne/a.bin", "r2/lower_velodyne/b.pcd", "r2/pointclouds/x.txt", "r3/else/a.pcd"]
    df = spark.createDataFrame([(n[:2], n[3:]) for n in names_], "seq string, path string")
    assert rows(readers.point_files(df, by=("seq",)), "seq", "path") == [("r1", "b.pcd"), ("r2", "velodyne/a.bin")]
    assert rows(readers.point_files(df.filter("seq = 'r1'").withColumn("path", F.concat(F.lit("/root/"), "path")), "/root"), "path") == [("/root/b.pcd",)]


def test_file_checks(spark):
    lines = spark.createDataFrame([("a", 0, "0.0e+00"), ("a", 1, "1.0e+00"), ("b", 0, "1.0e+00"), ("b", 1, "0.5"), ("c", 0, "x")], "key string, line long, value string")
    expected = spark.createDataFrame([("a", 2), ("b", 2), ("c", 1), ("d", 1)], "key string, expected long")
    assert rows(quality.times_problems(lines, expected, "key"), "key", "lines", "unreadable", "plain", "backwards") == [("b", 2, 0, 1, 1), ("c", 1, 1, 0, 0), ("d", 0, 0, 0, 0)]
    sizes = spark.createDataFrame([("a", 32), ("b", 33)], "path string, length long")
    assert rows(quality.cloud_sizes(sizes), "path", "points", "whole") == [("a", 2, True), ("b", 2, False)]


def test_colours_and_names(spark):
    df = spark.createDataFrame([("car", 1, 0), ("boat", 0, 1), (None, 0, 0)], "c string, p int, t int")
    assert [list(r[0]) for r in df.select(labeling.class_colour(F.col("c"))).collect()] == [[255, 0, 0], [0, 255, 0], [0, 255, 0]]
    both = df.select(*(c.alias(n) for c, n in zip(labeling.outcome_colours(F.col("p"), F.col("t")), "ot"))).collect()
    assert [(list(r.o), list(r.t)) for r in both] == [([255, 0, 0], [128, 128, 128]), ([0, 0, 255], [0, 255, 255]), ([128, 128, 128], [128, 128, 128])]
    assert names.hue_palette(3) == [(1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0)]
    assert df.limit(1).select(names.swap_extension(F.lit("a.pcd"), ".pcd", ".bin")).first()[0] == "a.bin"
    assert df.limit(1).select(labeling.mask_area(F.array(F.lit(1), F.lit(0), F.lit(1)))).first()[0] == 2
    long = spark.createDataFrame([("s", k) for k in (0, 3, 10, 11, 25)], "s string, k long")
    assert rows(names.indexed(long, ["s"], "k", F.floor(F.col("k") / 10)), "k", "index", "kitti_name") == [(k, i, f"{i:06d}") for i, k in enumerate((0, 3, 10, 11, 25))]


def test_shared_folder(spark):
    assert store.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert writers.COLOURS[0] == (255, 0, 0)
