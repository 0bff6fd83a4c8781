"""Messages and recordings as bytes, in the formats that ``decode`` reads."""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def message(fields: Iterable[tuple[str, object]]) -> bytes:
    """Fields (kind, value), little-endian and aligned: ``s`` a string, ``b`` bytes, else a struct code."""
    out = bytearray()
    for kind, value in fields:
        if kind == "s":
            out += b"\0" * (-len(out) % 4) + struct.pack("<I", len(value) + 1) + value.encode() + b"\0"
        elif kind == "b":
            out += value
        else:
            out += b"\0" * (-len(out) % struct.calcsize(kind)) + struct.pack("<" + kind, value)
    return b"\0\1\0\0" + bytes(out)


def _head(ts_ns: int, frame: str) -> list[tuple[str, object]]:
    return [("I", ts_ns // 10**9), ("I", ts_ns % 10**9), ("s", frame)]


def cloud_message(ts_ns: int, points: np.ndarray) -> bytes:
    """A point cloud of N x 3 float32."""
    fields = [f for k, n in enumerate("xyz") for f in (("s", n), ("I", 4 * k), ("B", 7), ("I", 1))]
    body = points.astype("<f4").tobytes()
    return message([*_head(ts_ns, "lidar"), ("I", 1), ("I", len(points)), ("I", 3), *fields, ("B", 0), ("I", 12), ("I", len(body)), ("I", len(body)), ("b", body), ("B", 1)])


def image_message(ts_ns: int, pixels: np.ndarray, encoding: str = "rgb8") -> bytes:
    """A raw image of H x W x 3 bytes."""
    h, w = pixels.shape[:2]
    body = pixels.astype(np.uint8).tobytes()
    return message([*_head(ts_ns, "camera"), ("I", h), ("I", w), ("s", encoding), ("B", 0), ("I", len(body) // h), ("I", len(body)), ("b", body)])


def compressed_message(ts_ns: int, file: bytes, kind: str = "png") -> bytes:
    return message([*_head(ts_ns, "camera"), ("s", kind), ("I", len(file)), ("b", file)])


def camera_message(ts_ns: int, k: Iterable[float], d: Iterable[float], height: int, width: int) -> bytes:
    d = list(d)
    return message([*_head(ts_ns, "camera"), ("I", height), ("I", width), ("s", "plumb_bob"), ("I", len(d)), *(("d", float(x)) for x in (*d, *k))])


def sqlite_recording(messages: Iterable[tuple[str, str, int, bytes]]) -> bytes:
    """A ``db3`` file of (topic, type, time, data)."""
    base = sqlite3.connect(":memory:")
    base.execute("CREATE TABLE topics(id INTEGER PRIMARY KEY, name TEXT, type TEXT)")
    base.execute("CREATE TABLE messages(id INTEGER PRIMARY KEY, topic_id INTEGER, timestamp INTEGER, data BLOB)")
    ids: dict[tuple[str, str], int] = {}
    for topic, kind, ts, data in messages:
        known = ids.setdefault((topic, kind), len(ids) + 1)
        base.execute("INSERT INTO messages(topic_id, timestamp, data) VALUES (?, ?, ?)", (known, ts, data))
    base.executemany("INSERT INTO topics VALUES (?, ?, ?)", [(i, *t) for t, i in ids.items()])
    base.commit()
    out = base.serialize()
    base.close()
    return out


def _record(head: dict[bytes, bytes], body: bytes) -> bytes:
    packed = b"".join(struct.pack("<I", len(k) + 1 + len(v)) + k + b"=" + v for k, v in head.items())
    return struct.pack("<I", len(packed)) + packed + struct.pack("<I", len(body)) + body


def bag_recording(messages: Iterable[tuple[str, str, int, bytes]]) -> bytes:
    """A ``bag`` file of (topic, type, time, data), in one plain chunk."""
    ids: dict[tuple[str, str], int] = {}
    body = b""
    for topic, kind, ts, data in messages:
        if (topic, kind) not in ids:
            ids[topic, kind] = len(ids)
            named = b"type=" + kind.encode()
            body += _record({b"op": b"\7", b"conn": struct.pack("<I", ids[topic, kind]), b"topic": topic.encode()}, struct.pack("<I", len(named)) + named)
        body += _record({b"op": b"\2", b"conn": struct.pack("<I", ids[topic, kind]), b"time": struct.pack("<II", ts // 10**9, ts % 10**9)}, data)
    return b"#ROSBAG V2.0\n" + _record({b"op": b"\3"}, b" " * 10) + _record({b"op": b"\5", b"compression": b"none", b"size": struct.pack("<I", len(body))}, body)


def indexed_bag(messages: Iterable[tuple[str, str, int, bytes]], chunk: int = 1 << 16, packing: str = "none") -> bytes:
    """A ``bag`` file of (topic, type, time, data) in chunks of about ``chunk`` bytes, with the index of them at its end."""
    import bz2

    pack = {"none": bytes, "bz2": bz2.compress, "lz4": lambda b: pa.compress(b, "lz4", asbytes=True)}[packing]
    number = lambda v, n=4: int(v).to_bytes(n, "little")
    stamp = lambda ts: number(ts // 10**9) + number(ts % 10**9)
    links: dict[tuple[str, str], bytes] = {}
    known = lambda topic, kind: _record({b"op": b"\7", b"conn": links[topic, kind], b"topic": topic.encode()}, number(5 + len(kind.encode())) + b"type=" + kind.encode())
    chunks, infos, start, body, held = b"", [], len(b"#ROSBAG V2.0\n") + 4096, b"", []

    def close() -> None:
        nonlocal chunks, body, held
        if not held:
            return
        counts: dict[bytes, list[bytes]] = {}
        for conn, ts, at in held:
            counts.setdefault(conn, []).append(stamp(ts) + number(at))
        times = [ts for _, ts, _ in held]
        infos.append(_record({b"op": b"\6", b"ver": number(1), b"chunk_pos": number(start + len(chunks), 8), b"start_time": stamp(min(times)), b"end_time": stamp(max(times)), b"count": number(len(counts))}, b"".join(c + number(len(p)) for c, p in counts.items())))
        chunks += _record({b"op": b"\5", b"compression": packing.encode(), b"size": number(len(body))}, pack(body))
        for conn, places in counts.items():
            chunks += _record({b"op": b"\4", b"ver": number(1), b"conn": conn, b"count": number(len(places))}, b"".join(places))
        body, held = b"", []

    for topic, kind, ts, data in messages:
        if (topic, kind) not in links:
            links[topic, kind] = number(len(links))
            body += known(topic, kind)
        held.append((links[topic, kind], ts, len(body)))
        body += _record({b"op": b"\2", b"conn": links[topic, kind], b"time": stamp(ts)}, data)
        if len(body) >= chunk:
            close()
    close()
    head = {b"op": b"\3", b"index_pos": number(start + len(chunks), 8), b"conn_count": number(len(links)), b"chunk_count": number(len(infos))}
    plain = len(_record(head, b""))
    return b"#ROSBAG V2.0\n" + _record(head, b" " * (4096 - plain)) + chunks + b"".join(known(*k) for k in links) + b"".join(infos)


def recording_files(messages: DataFrame, kind: str = "db3") -> DataFrame:
    """(path, bytes) of the recordings of rows (path, topic, msg_type, ts_ns, data); a recording is one task's work.

    ``kind`` is ``db3``, ``bag`` (one chunk) or ``indexed`` (a ``bag`` of many chunks and their index).
    """
    write = {"db3": sqlite_recording, "bag": bag_recording, "indexed": indexed_bag}[kind]

    def one(t: pa.Table) -> pa.Table:
        order = t.sort_by([("ts_ns", "ascending"), ("topic", "ascending")])
        rows = zip(*(order.column(c).to_pylist() for c in ("topic", "msg_type", "ts_ns", "data")))
        return pa.table({"path": [t.column("path")[0].as_py()], "bytes": pa.array([write(rows)], pa.binary())})

    return messages.select("path", "topic", "msg_type", "ts_ns", "data").groupBy("path").applyInArrow(one, "path string, bytes binary")
