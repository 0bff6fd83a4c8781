"""Bytes of single files and messages to arrays and dictionaries; used inside tasks."""

from __future__ import annotations

import bz2
import io
import json
import sqlite3
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from scanloom.sources import jpeg

#: NumPy types of the point cloud file format: TYPE letter and SIZE.
PCD_TYPES = {"F4": "<f4", "F8": "<f8", "U1": "<u1", "U2": "<u2", "U4": "<u4", "U8": "<u8", "I1": "<i1", "I2": "<i2", "I4": "<i4", "I8": "<i8"}
#: NumPy types of point fields in messages, by their datatype number.
FIELD_TYPES = {1: "i1", 2: "u1", 3: "i2", 4: "u2", 5: "i4", 6: "u4", 7: "f4", 8: "f8"}
INTENSITY_NAMES = ("intensity", "i", "reflectance")


def cloud_bin(data: bytes) -> np.ndarray:
    """N x 4 float32: x, y, z, intensity."""
    if len(data) % 16:
        raise ValueError("length is not a whole number of points")
    return np.frombuffer(data, "<f4").reshape(-1, 4)


def label_words(data: bytes) -> np.ndarray:
    if len(data) % 4:
        raise ValueError("length is not a whole number of labels")
    return np.frombuffer(data, "<u4").astype(np.int64)


def lzf(data: bytes, size: int) -> bytes:
    """Decompress LZF: literal runs and back references."""
    out, at = bytearray(), 0
    while at < len(data):
        c = data[at]
        at += 1
        if c < 32:
            out += data[at : at + c + 1]
            at += c + 1
            continue
        length = c >> 5
        if length == 7:
            length += data[at]
            at += 1
        start = len(out) - ((c & 31) << 8 | data[at]) - 1
        at += 1
        for k in range(length + 2):
            out.append(out[start + k])
    if len(out) != size:
        raise ValueError("wrong size after decompression")
    return bytes(out)


def cloud_pcd(data: bytes) -> np.ndarray:
    """N x 4 float32 of an ASCII, binary or compressed file; intensity 0 if the file has none."""
    head, at = {}, 0
    while "DATA" not in head:
        end = data.index(b"\n", at)
        line = data[at:end].decode("ascii").strip()
        at = end + 1
        if line and not line.startswith("#"):
            key, *rest = line.split()
            head[key.upper()] = rest
    names = [n.lower() for n in head["FIELDS"]]
    counts = list(map(int, head.get("COUNT", ["1"] * len(names))))
    kinds = [PCD_TYPES[t + s] for t, s in zip(head["TYPE"], head["SIZE"])]
    n = int(head["POINTS"][0]) if "POINTS" in head else int(head["WIDTH"][0]) * int(head["HEIGHT"][0])
    dtype = np.dtype([(f"{name}#{k}", kind, (c,)) for k, (name, kind, c) in enumerate(zip(names, kinds, counts))])
    mode = head["DATA"][0].lower()
    if mode == "ascii":
        first = np.cumsum([0, *counts])
        table = np.array(data[at:].split(), np.float64).reshape(n, -1)
        get = lambda k: table[:, first[k]]
    elif mode == "binary":
        rows = np.frombuffer(data, dtype, n, at)
        get = lambda k: rows[dtype.names[k]][:, 0]
    else:
        packed, size = struct.unpack_from("<II", data, at)
        body, starts = lzf(data[at + 8 : at + 8 + packed], size), np.cumsum([0, *(n * np.dtype(t).itemsize * c for t, c in zip(kinds, counts))])
        get = lambda k: np.frombuffer(body, kinds[k], n * counts[k], starts[k]).reshape(n, -1)[:, 0]
    out = np.zeros((n, 4), np.float32)
    for k, axis in enumerate("xyz"):
        out[:, k] = get(names.index(axis))
    bright = next((x for x in INTENSITY_NAMES if x in names), None)
    if bright:
        out[:, 3] = get(names.index(bright))
    return out


def pcd_bytes(points: np.ndarray) -> bytes:
    n = len(points)
    head = f"VERSION .7\nFIELDS x y z intensity\nSIZE 4 4 4 4\nTYPE F F F F\nCOUNT 1 1 1 1\nWIDTH {n}\nHEIGHT 1\nVIEWPOINT 0 0 0 1 0 0 0\nPOINTS {n}\nDATA binary\n"
    return head.encode() + points.astype("<f4").tobytes()


def intrinsics(data: bytes, strict: bool = False) -> dict:
    """K, D, height and width; without ``strict`` a missing D is five zeros and K the identity."""
    with np.load(io.BytesIO(data)) as f:
        names = set(f.files)
        if strict and not {"K", "D", "height", "width"} <= names:
            raise ValueError("missing arrays")
        k = f["K"] if "K" in names else np.eye(3)
        d = f["D"] if "D" in names else np.zeros(5)
        return {"K": k.astype(float).ravel().tolist(), "D": d.astype(float).ravel().tolist(), **{x: int(f[x]) if x in names else None for x in ("height", "width")}}


def array(data: bytes) -> np.ndarray:
    return np.load(io.BytesIO(data))


def array_bytes(a: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, a)
    return out.getvalue()


def png(pixels: np.ndarray) -> bytes:
    """Grey (H x W) or RGB (H x W x 3) bytes as PNG."""
    h, w = pixels.shape[:2]
    colour = 2 if pixels.ndim == 3 else 0
    rows = np.concatenate((np.zeros((h, 1), np.uint8), pixels.astype(np.uint8).reshape(h, -1)), axis=1)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def png_pixels(data: bytes) -> np.ndarray:
    """H x W x channels of a PNG of eight bits a channel that isn't interlaced."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, head, body = 8, b"", b""
    while at < len(data):
        n, kind = struct.unpack_from(">I4s", data, at)
        if kind == b"IHDR":
            head = data[at + 8 : at + 8 + n]
        elif kind == b"IDAT":
            body += data[at + 8 : at + 8 + n]
        at += 12 + n
    w, h, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", head)
    if depth != 8 or interlaced or colour not in (0, 2, 4, 6):
        raise ValueError("only eight bits a channel, without palette or interlacing")
    step = {0: 1, 2: 3, 4: 2, 6: 4}[colour]
    rows = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * step)
    out = np.zeros((h, w * step), np.uint8)
    for y in range(h):
        kind, line, up = rows[y, 0], rows[y, 1:], out[y - 1] if y else np.zeros(w * step, np.uint8)
        if kind in (0, 2):
            out[y] = line + up if kind else line
            continue
        for x in range(w * step):
            a, b, c = (int(out[y, x - step]) if x >= step else 0), int(up[x]), (int(up[x - step]) if x >= step else 0)
            near = min((a, b, c), key=lambda v: abs(a + b - c - v))
            out[y, x] = (int(line[x]) + {1: a, 3: (a + b) // 2, 4: near}[int(kind)]) & 255
    return out.reshape(h, w, step)


def picture(data: bytes) -> np.ndarray:
    """H x W x channels of a PNG or a sequential JPEG."""
    return jpeg.pixels(data) if data[:2] == b"\xff\xd8" else png_pixels(data)


def grey(pixels: np.ndarray) -> np.ndarray:
    """H x W in [0, 1]: the luma of the first three channels, in whole steps of 1 / 255."""
    a = pixels.astype(np.int64)
    luma = a[:, :, 0] if a.shape[2] < 3 else (a[:, :, 0] * 19595 + a[:, :, 1] * 38470 + a[:, :, 2] * 7471 + 0x8000) >> 16
    return luma / 255.0


def box_frames(data: bytes) -> Iterator[dict]:
    """Boxes of an annotation file, frame by frame; what is missing is 0 or empty, activities keep their order."""
    for frame, boxes in json.loads(data).get("labels", {}).items():
        for k, one in enumerate(boxes):
            box = one.get("box", {})
            pairs = lambda name: [{"key": a, "value": float(b)} for a, b in (one.get(name) or {}).items()]  # noqa: E731, B023
            yield {"frame": frame, "box_id": k, **{x: float(box.get(x, 0)) for x in ("cx", "cy", "cz", "l", "w", "h", "rot_z")}, "actions": pairs("action_label"), "social": pairs("social_activity")}


# --- recordings -----------------------------------------------------------------------


def sqlite_rows(data: bytes, statement: str) -> Iterator[tuple]:
    """Rows of a statement on an SQLite file that is held in memory."""
    base = sqlite3.connect(":memory:")
    try:
        base.deserialize(data)
        yield from base.execute(statement)
    finally:
        base.close()


BAG = b"#ROSBAG V2.0\n"


def fields(data: bytes) -> dict[bytes, bytes]:
    out, at = {}, 0
    while at < len(data):
        n = struct.unpack_from("<I", data, at)[0]
        name, _, value = data[at + 4 : at + 4 + n].partition(b"=")
        out[name] = value
        at += 4 + n
    return out


def records(data: bytes, at: int = 0) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    while at < len(data):
        n = struct.unpack_from("<I", data, at)[0]
        head = fields(data[at + 4 : at + 4 + n])
        at += 4 + n
        n = struct.unpack_from("<I", data, at)[0]
        yield head, data[at + 4 : at + 4 + n]
        at += 4 + n


def connection(head: dict[bytes, bytes], body: bytes) -> tuple[str, str]:
    """Topic and type of a connection record."""
    return head[b"topic"].decode(), fields(body).get(b"type", b"").decode()


def chunk_body(head: dict[bytes, bytes], body: bytes) -> bytes:
    """The records of a chunk, unpacked; lz4 frames are checked against their checksums."""
    kind, size = head[b"compression"], struct.unpack("<I", head[b"size"])[0]
    if kind == b"none":
        return body
    if kind not in (b"bz2", b"lz4"):
        raise ValueError(f"chunks compressed by {kind.decode()} are not supported")
    out = bz2.decompress(body) if kind == b"bz2" else pa.decompress(body, size, "lz4", asbytes=True)
    if len(out) != size:
        raise ValueError("wrong size after decompression")
    return out


def chunk_messages(head: dict[bytes, bytes], body: bytes, links: dict[bytes, tuple[str, str]]) -> Iterator[tuple[str, str, int, bytes]]:
    """(topic, type, time in ns, payload) of a chunk; connections that it names are added to ``links``."""
    for own, data in records(chunk_body(head, body)):
        if own[b"op"][0] == 7:
            links[own[b"conn"]] = connection(own, data)
        elif own[b"op"][0] == 2:
            s, ns = struct.unpack("<II", own[b"time"])
            yield *links[own[b"conn"]], s * 1_000_000_000 + ns, data


def bag_messages(data: bytes) -> Iterator[tuple[str, str, int, bytes]]:
    """(topic, type, time in ns, payload) of a version 2.0 recording, in file order."""
    if not data.startswith(BAG):
        raise ValueError("not a version 2.0 recording")
    links: dict[bytes, tuple[str, str]] = {}
    for head, body in records(data, len(BAG)):
        if head[b"op"][0] == 5:
            yield from chunk_messages(head, body, links)
        elif head[b"op"][0] == 7:
            links[head[b"conn"]] = connection(head, body)


class Message:
    """Fields of a serialised message, in the first or second version of the format."""

    def __init__(self, data: bytes, version: int):
        self.data, self.version, self.at = data, version, 0
        self.base, self.order = 0, "<"
        if version == 2:  # an encapsulation header gives the byte order; fields are aligned behind it
            self.base = self.at = 4
            self.order = "<" if data[1] & 1 else ">"

    def number(self, kind: str):
        size = struct.calcsize(kind)
        if self.version == 2:
            self.at += -(self.at - self.base) % size
        value = struct.unpack_from(self.order + kind, self.data, self.at)[0]
        self.at += size
        return value

    def block(self, n: int) -> bytes:
        out = self.data[self.at : self.at + n]
        if len(out) < n:
            raise ValueError("message ends early")
        self.at += n
        return out

    def string(self) -> str:
        return self.block(self.number("I")).rstrip(b"\0").decode()

    def numbers(self, n: int) -> list[float]:
        return [self.number("d") for _ in range(n)]

    def header(self) -> None:
        if self.version == 1:
            self.number("I")
        self.number("I"), self.number("I"), self.string()


def points_of(data: bytes, version: int) -> np.ndarray:
    """N x 3 float32 of a point cloud message, by the offsets of its fields x, y and z."""
    m = Message(data, version)
    m.header()
    height, width = m.number("I"), m.number("I")
    fields = {}
    for _ in range(m.number("I")):
        name, offset, kind, _ = m.string(), m.number("I"), m.number("B"), m.number("I")
        fields[name] = offset, kind
    big, step, _ = m.number("B"), m.number("I"), m.number("I")
    body = m.block(m.number("I"))
    n = min(height * width, len(body) // step) if step else 0
    out = np.empty((n, 3), np.float32)
    for k, axis in enumerate("xyz"):
        offset, kind = fields[axis]
        out[:, k] = np.ndarray((n,), (">" if big else "<") + FIELD_TYPES[kind], body, offset, (step,))
    return out


def image_of(data: bytes, version: int) -> np.ndarray:
    """H x W x 3 bytes in the order blue, green, red."""
    m = Message(data, version)
    m.header()
    height, width, encoding = m.number("I"), m.number("I"), m.string()
    m.number("B")
    step = m.number("I")
    body = np.frombuffer(m.block(m.number("I")), np.uint8)
    channels = {"bgr8": 3, "rgb8": 3, "mono8": 1}.get(encoding)
    if channels is None:
        raise ValueError(f"encoding {encoding} is not supported")
    rows = body.reshape(height, step or width * channels)[:, : width * channels].reshape(height, width, channels)
    return np.repeat(rows, 3, axis=2) if channels == 1 else rows[:, :, ::-1] if encoding == "rgb8" else rows


def compressed_of(data: bytes, version: int) -> bytes:
    """The file inside a compressed image message; a codec is the caller's."""
    m = Message(data, version)
    m.header()
    m.string()
    return m.block(m.number("I"))


def camera_info_of(data: bytes, version: int) -> dict:
    m = Message(data, version)
    m.header()
    height, width = m.number("I"), m.number("I")
    m.string()
    d = m.numbers(m.number("I"))
    return {"K": m.numbers(9), "D": d, "height": height, "width": width}
