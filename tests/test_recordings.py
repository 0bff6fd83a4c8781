"""Recordings in pieces, with conditions pushed down, and files that are committed."""

import io
import json
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scanloom.operators import samples  # noqa: F401  the package imports as a whole
from scanloom.sources import decode, encode, framefiles, readers, recordings, stores, writers

SECOND = 10**9


def sent(n=400):
    """Messages of two topics that take turns, and a third one late in the recording."""
    return [("/points" if k % 2 else "/image", "T" if k % 2 else "U", k * SECOND + k, bytes([k % 251]) * (200 + k)) for k in range(n)] + [("/late", "V", n * SECOND, b"")]


class Counting(io.BytesIO):
    """A file that counts the bytes that are read."""

    total = 0

    def read(self, n=-1):
        out = super().read(n)
        self.total += len(out)
        return out


@pytest.mark.parametrize("packing", ["none", "bz2", "lz4"])
def test_bag_pieces(spark, tmp_path, packing):
    data = encode.indexed_bag(sent(), 4_096, packing)
    (tmp_path / "a.bag").write_bytes(data)
    (tmp_path / "b.orig.bag").write_bytes(b"x")
    got = recordings.messages(spark, str(tmp_path), "bag", split=len(data) // 7 + 1)
    assert got.rdd.getNumPartitions() == 7
    want = sorted((t, k, ts, bytearray(b)) for t, k, ts, b in sent())
    assert sorted((r.topic, r.msg_type, r.ts_ns, r.data) for r in got.collect()) == want
    few = got.filter("topic IN ('/points', '/late') AND ts_ns >= 390000000390 AND ts_ns < 400000000000")
    assert sorted(r.ts_ns for r in few.collect()) == [k * SECOND + k for k in range(391, 400, 2)]
    assert sorted((t, k, ts) for t, k, ts, _ in decode.bag_messages(data)) == [w[:3] for w in want]


def test_only_wanted_pieces_are_tasks(spark, tmp_path):
    data = encode.indexed_bag(sent(), 4_096)
    (tmp_path / "a.bag").write_bytes(data)
    (tmp_path / "plain.bag").write_bytes(encode.bag_recording(sent(20)))
    (tmp_path / "bad.bag").write_bytes(b"#ROSBAG V1.2\n" * 20)
    read = lambda at: recordings.messages(spark, str(tmp_path / at), split=100)
    late = read("").filter("topic = '/late'")
    assert late.rdd.getNumPartitions() < read("").rdd.getNumPartitions() - len(data) // 200
    assert sorted((os.path.basename(r.path), r.ts_ns) for r in late.filter("error IS NULL").collect()) == [("a.bag", 400 * SECOND), ("plain.bag", 20 * SECOND)]
    none = read("a.bag").filter("topic = '/none'")
    assert none.rdd.getNumPartitions() == 1 and none.collect() == []
    assert read("bad.bag").filter("error IS NOT NULL").count() == read("bad.bag").count() == 3


def test_pieces_of_chunks(tmp_path):
    data = encode.indexed_bag(sent(), 1_024)
    (tmp_path / "a.bag").write_bytes(data)
    for split in (50, 333, 1_000, 4_096, len(data) - 1, len(data)):
        r = recordings.RecordingReader({"path": str(tmp_path), "split": split})
        every = r.partitions()
        r.wanted = recordings.Wanted({"/points"}, 90 * SECOND, 300 * SECOND)
        some = [p for p in every if list(r.messages(p))]
        assert some == [p for p in r.partitions() if list(r.messages(p))] and len(some) <= len(r.partitions()) <= len(some) + 2


def test_only_wanted_chunks_are_read():
    data = encode.indexed_bag(sent(), 4_096)
    chunks, links = recordings.bag_index(io.BytesIO(data))
    assert len(chunks) > 30 and {t for t, _ in links.values()} == {"/points", "/image", "/late"} and sum(sum(c.counts.values()) for c in chunks) == 401
    index = Counting(data)
    recordings.bag_index(index)
    late = Counting(data)
    found = list(recordings.bag_messages(late, len(data), 0, len(data), recordings.Wanted({"/late"})))
    assert [m[0] for m in found] == ["/late"] and late.total < index.total + 10_000 < len(data) / 4
    early = Counting(data)
    assert len(list(recordings.bag_messages(early, len(data), 0, len(data), recordings.Wanted(None, 0, 3 * SECOND)))) == 3
    assert early.total < index.total + 10_000
    pieces = [list(recordings.bag_messages(io.BytesIO(data), len(data), a, a + 9_000, recordings.Wanted())) for a in range(0, len(data), 9_000)]
    assert sum(map(len, pieces)) == 401 and sum(map(bool, pieces)) > 10


def test_no_index(spark, tmp_path):
    (tmp_path / "plain.bag").write_bytes(encode.bag_recording(sent(20)))
    whole = encode.indexed_bag(sent(40), 2_048)
    cut = decode.BAG + encode._record({b"op": b"\3", b"index_pos": bytes(8)}, b" " * 10) + whole[len(decode.BAG) + 4096 : len(whole) // 2]
    (tmp_path / "cut.bag").write_bytes(cut)
    got = recordings.messages(spark, str(tmp_path), "bag", split=1_000).filter("error IS NULL").groupBy(F.element_at(F.split("path", "/"), -1).alias("f")).count()
    found = {r.f: r["count"] for r in got.collect()}
    assert found["plain.bag"] == 21 and 5 < found["cut.bag"] < 40


def checked_frame(body):
    """An lz4 frame of stored blocks with a checksum of its content."""
    import xxhash

    about = bytes([0x64, 0x40])
    blocks = b"".join((len(b) | 1 << 31).to_bytes(4, "little") + b for b in (body[k : k + 60_000] for k in range(0, len(body), 60_000)))
    return b"\x04\x22\x4d\x18" + about + bytes([xxhash.xxh32_intdigest(about) >> 8 & 255]) + blocks + bytes(4) + xxhash.xxh32_intdigest(body).to_bytes(4, "little")


@pytest.mark.parametrize("kind", ["packed", "random", "several", "checked"])
def test_lz4(kind):
    body = {"packed": b"abc" * 5_000, "random": np.random.default_rng(1).bytes(9_000), "several": b"xy" * (4 << 20), "checked": np.random.default_rng(2).bytes(150_000)}[kind]
    head = {b"compression": b"lz4", b"size": len(body).to_bytes(4, "little")}
    packed = checked_frame(body) if kind == "checked" else pa.compress(body, "lz4", asbytes=True)
    assert decode.chunk_body(head, packed) == body
    for bad in (packed[: len(packed) // 2], b"abcd" + packed[4:], *([packed[:70_000] + bytes([packed[70_000] ^ 1]) + packed[70_001:]] if kind == "checked" else [])):
        with pytest.raises(Exception):
            decode.chunk_body(head, bad)
    with pytest.raises(ValueError):
        decode.chunk_body({b"compression": b"zip", b"size": bytes(4)}, packed)


def test_damaged(spark, tmp_path):
    data = bytearray(encode.indexed_bag(sent(40), 2_048, "lz4"))
    at = recordings.bag_index(io.BytesIO(bytes(data)))[0][3].at
    data[data.index(b"\x04\x22\x4d\x18", at)] ^= 255
    (tmp_path / "a.bag").write_bytes(bytes(data))
    (tmp_path / "b.bag").write_bytes(b"#ROSBAG V1.2\n")
    (tmp_path / "c.bag").write_bytes(encode.indexed_bag(sent(40)))
    (tmp_path / "d.bag").write_bytes(b"")
    got = recordings.messages(spark, str(tmp_path)).collect()
    name = lambda r: os.path.basename(r.path)
    assert {name(r) for r in got if r.error} == {"a.bag", "b.bag", "d.bag"}
    assert sum(name(r) == "c.bag" for r in got) == 41 and any(name(r) == "a.bag" and not r.error for r in got)


def test_sqlite_pieces(spark, tmp_path):
    data = encode.sqlite_recording(sent())
    (tmp_path / "a b?.db3").write_bytes(data)
    (tmp_path / "empty.db3").write_bytes(encode.sqlite_recording([]))
    got = recordings.messages(spark, f"file://{tmp_path}", "db3", split=len(data) // 5 + 1)
    assert got.rdd.getNumPartitions() == 6
    assert sorted((r.topic, r.msg_type, r.ts_ns, r.data) for r in got.collect()) == sorted((t, k, ts, bytearray(b)) for t, k, ts, b in sent())
    few = got.filter((F.col("topic") == "/image") & (F.col("ts_ns") <= 10 * SECOND + 10))
    assert [r.ts_ns for r in few.orderBy("ts_ns").collect()] == [k * SECOND + k for k in range(0, 11, 2)]
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan or "/image" not in plan.split("Filter")[1].split("\n")[0]


def test_payloads_of_pieces(spark, tmp_path):
    points = np.arange(12, dtype=np.float32).reshape(4, 3)
    rows = [("/points", "PointCloud2", k, encode.cloud_message(k, points + k)) for k in range(50)]
    (tmp_path / "a.bag").write_bytes(encode.indexed_bag(rows, 512))
    m = recordings.messages(spark, str(tmp_path), split=2_000).filter("topic = '/points' AND ts_ns BETWEEN 10 AND 12")
    assert sorted((r.ts_ns, r.point_idx, r.x) for r in readers.message_points(m).collect()) == [(k, p, float(3 * p + k)) for k in (10, 11, 12) for p in range(4)]


# --- files that are committed -------------------------------------------------------------


def files(spark, n=30, size=100):
    return spark.createDataFrame([(f"seq/{k % 3}/{k:06d}.bin", bytearray([k % 256]) * size) for k in range(n)], "path string, bytes binary")


def found(root):
    return {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f), "rb").read() for d, _, names in os.walk(root) for f in names}


def test_committed(spark, tmp_path):
    root = f"file://{tmp_path}/out"  # open() doesn't see such a path
    assert writers.write_files(files(spark).repartition(4), root) == 30
    want = {f"seq/{k % 3}/{k:06d}.bin": bytes([k % 256]) * 100 for k in range(30)}
    assert found(tmp_path / "out") == want
    assert writers.write_files(files(spark, 10, 7), root) == 10  # others stay, these are replaced
    assert found(tmp_path / "out") == want | {f"seq/{k % 3}/{k:06d}.bin": bytes([k % 256]) * 7 for k in range(10)}
    assert writers.write_files(files(spark).limit(0), root) == 0 and len(found(tmp_path / "out")) == 30


def test_failed_tasks_leave_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    broken = files(spark).repartition(4).withColumn("bytes", F.expr("IF(path LIKE '%000017.bin', CAST(raise_error('broken') AS BINARY), bytes)"))
    with pytest.raises(Exception, match="broken"):
        writers.write_files(broken, root)
    assert found(root) == {}


def test_attempts_off_the_manifest_are_not_moved(spark, tmp_path):
    """A task that wrote half a file and was tried again, and a move that was tried again."""
    root = str(tmp_path / "out")
    w = framefiles.FrameFilesWriter({"path": root, "job": "j"})
    batch = pa.RecordBatch.from_pydict({"path": ["a/1.bin", "a/2.bin"], "bytes": pa.array([b"one", b"two"], pa.binary())})

    def dies():
        yield batch
        raise OSError("executor lost")

    with pytest.raises(OSError):
        w.write(dies())
    half = [d for d in os.listdir(f"{root}/_staged-j")]
    done = w.write(iter([batch.slice(1)]))
    w.commit([done, None])
    assert json.load(open(f"{root}/_staged-j/{framefiles.MANIFEST}")) == [[done.folder.rsplit("/", 1)[1], 1]] and len(half) == 1
    store, _ = stores.opened(root)
    framefiles.moved(store, f"{done.folder}/a/2.bin", f"{root}/a/2.bin", set())  # a first try moved this one and was lost
    assert framefiles.publish(spark, root, "j") == 1
    assert found(root) == {"a/2.bin": b"two"}
    w.abort([])  # nothing there any more
