"""Sequential JPEG, as cameras send it: bytes to pixels and, for fixtures and packed files, planes to bytes.

Baseline and extended sequential files of eight bits a sample, Huffman coded, in one
scan or several, with any sampling of components and with restart markers. Files of
other kinds (progressive, lossless, arithmetic) are an error that names the kind.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

SOI, EOI, SOS, DQT, DHT, DRI, ADOBE = 0xD8, 0xD9, 0xDA, 0xDB, 0xC4, 0xDD, 0xEE
SEQUENTIAL = (0xC0, 0xC1)
OTHER_FRAMES = {0xC2: "progressive", 0xC3: "lossless", 0xC9: "arithmetic", 0xCA: "arithmetic progressive"}


@lru_cache(maxsize=1)
def zigzag() -> np.ndarray:
    """Row-major place of each coefficient in the order of the stream: along diagonals, up and down in turn."""
    order = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda p: (p[0] + p[1], p[0] if (p[0] + p[1]) % 2 else p[1]))
    return np.array([8 * r + c for r, c in order])


@lru_cache(maxsize=1)
def cosines() -> np.ndarray:
    """The orthonormal transform: row k is the wave of frequency k."""
    k, x = np.mgrid[:8, :8]
    return np.cos((2 * x + 1) * k * np.pi / 16) * np.where(k == 0, np.sqrt(1 / 8), 0.5)


@dataclass
class Component:
    id: int
    h: int
    v: int
    quant: int
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros(0))


def huffman(counts: bytes, symbols: bytes) -> list[int]:
    """For each 16 bits that a code may begin: its length times 256, plus its symbol; 0 where no code does."""
    table, code, at = [0] * (1 << 16), 0, 0
    for length, n in enumerate(counts, 1):
        for s in symbols[at : at + n]:
            first = code << 16 - length
            table[first : first + (1 << 16 - length)] = [length << 8 | s] * (1 << 16 - length)
            code += 1
        at += n
        code <<= 1
    return table


class Bits:
    """A stretch of entropy-coded bytes without its stuffing."""

    def __init__(self, data: bytes):
        self.data, self.size, self.at = data + bytes(8), 8 * len(data), 0

    def symbol(self, table: list[int]) -> tuple[int, int]:
        """A code's symbol, and the signed value of the bits behind it, as many as the symbol's lower half says."""
        byte, bit = self.at >> 3, self.at & 7
        window = int.from_bytes(self.data[byte : byte + 5], "big")
        entry = table[window >> 24 - bit & 0xFFFF]
        length, symbol = entry >> 8, entry & 255
        size = symbol & 15
        self.at += length + size
        if not length or self.at > self.size:
            raise ValueError("picture data end early or are damaged")
        if not size:
            return symbol, 0
        value = window >> 40 - bit - length - size & (1 << size) - 1
        return symbol, value if value >> size - 1 else value - (1 << size) + 1


def _block(bits: Bits, out: np.ndarray, dc: list[int], ac: list[int], before: int) -> int:
    """Read one block's coefficients into ``out``; the new predictor."""
    before += bits.symbol(dc)[1]
    out[0] = before
    k = 1
    while k < 64:
        symbol, value = bits.symbol(ac)
        if symbol & 15:
            k += symbol >> 4
            if k > 63:
                raise ValueError("a block has too many coefficients")
            out[k] = value
            k += 1
        elif symbol == 0xF0:
            k += 16
        else:
            break
    return before


def _stretches(data: bytes, at: int) -> tuple[list[bytes], int]:
    """Entropy-coded data from ``at`` on, cut at restart markers, and where they end."""
    out, start = [], at
    while True:
        at = data.find(b"\xff", at)
        kind = data[at + 1] if 0 <= at < len(data) - 1 else None
        if kind == 0:
            at += 2
            continue
        if kind == 0xFF:
            at += 1
            continue
        end = len(data) if kind is None else at
        out.append(data[start:end].replace(b"\xff\x00", b"\xff"))
        if kind is None or not 0xD0 <= kind <= 0xD7:
            return out, end
        start = at = at + 2


def _scan(data: bytes, at: int, size: tuple[int, int], frame: list[Component], scanned: list[tuple[Component, list, list]], restart: int) -> int:
    """Read the scan whose data begin at ``at``; where they end."""
    height, width = size
    stretches, end = _stretches(data, at)
    tall, wide = max(c.v for c in frame), max(c.h for c in frame)
    if len(scanned) == 1:  # blocks of one component, those that hold a part of the picture
        c = scanned[0][0]
        rows, columns = (-(-(-(-n * s // most)) // 8) for n, s, most in ((height, c.v, tall), (width, c.h, wide)))
        cells = [(c, *scanned[0][1:], 0, 0)]
        steps = {id(c): (1, 1)}
    else:
        rows, columns = -(-height // (8 * tall)), -(-width // (8 * wide))
        cells = [(c, dc, ac, y, x) for c, dc, ac in scanned for y in range(c.v) for x in range(c.h)]
        steps = {id(c): (c.v, c.h) for c, _, _ in scanned}
    per = restart or rows * columns
    if len(stretches) < -(-rows * columns // per):
        raise ValueError("picture data end early")
    for k, stretch in enumerate(stretches[: -(-rows * columns // per)]):
        bits, before = Bits(stretch), dict.fromkeys(steps, 0)
        for unit in range(k * per, min((k + 1) * per, rows * columns)):
            r, q = divmod(unit, columns)
            for c, dc, ac, y, x in cells:
                v, h = steps[id(c)]
                before[id(c)] = _block(bits, c.coefficients[r * v + y, q * h + x], dc, ac, before[id(c)])
    return end


def pixels(data: bytes) -> np.ndarray:
    """H x W x 1 grey or H x W x 3 red, green, blue bytes of a sequential file."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    quants: dict[int, np.ndarray] = {}
    tables: dict[int, list[int]] = {}
    frame: list[Component] = []
    at, size, restart, transform, seen = 2, (0, 0), 0, None, 0
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            raise ValueError("a marker is missing")
        kind = data[at + 1]
        if kind in (0xFF, 0x01) or 0xD0 <= kind <= 0xD7:
            at += 1 if kind == 0xFF else 2
            continue
        if kind == EOI:
            break
        n = struct.unpack_from(">H", data, at + 2)[0]
        body, at = data[at + 4 : at + 2 + n], at + 2 + n
        if kind == DQT:
            while body:
                wide = body[0] >> 4
                quants[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else "u1").astype(np.int64)
                body = body[65 + 64 * wide :]
        elif kind == DHT:
            while body:
                total = sum(body[1:17])
                tables[body[0]] = huffman(body[1:17], body[17 : 17 + total])
                body = body[17 + total :]
        elif kind in SEQUENTIAL:
            depth, *size, count = struct.unpack_from(">BHHB", body)
            if depth != 8 or not all(size):
                raise ValueError("only eight bits a sample, and a height in the frame's header")
            frame = [Component(i, hv >> 4, hv & 15, q) for i, hv, q in (body[6 + 3 * k : 9 + 3 * k] for k in range(count))]
            across, down = -(-size[1] // (8 * max(c.h for c in frame))), -(-size[0] // (8 * max(c.v for c in frame)))
            for c in frame:
                c.coefficients = np.zeros((down * c.v, across * c.h, 64), np.int32)
        elif kind in OTHER_FRAMES:
            raise ValueError(f"{OTHER_FRAMES[kind]} JPEG is not supported")
        elif kind == DRI:
            restart = struct.unpack(">H", body[:2])[0]
        elif kind == ADOBE and body[:5] == b"Adobe":
            transform = body[11]
        elif kind == SOS:
            by_id = {c.id: c for c in frame}
            scanned = [(by_id[body[1 + 2 * k]], tables[body[2 + 2 * k] >> 4], tables[16 | body[2 + 2 * k] & 15]) for k in range(body[0])]
            at = _scan(data, at, tuple(size), frame, scanned, restart)
            seen += len(scanned)
    if not frame or seen < len(frame):
        raise ValueError("picture data end early")
    planes = [_plane(c, quants[c.quant], tuple(size), frame) for c in frame]
    if len(planes) == 1:
        return planes[0][:, :, None]
    if len(planes) != 3:
        raise ValueError("only one or three components")
    rgb = np.stack(planes, axis=2) if transform == 0 else to_rgb(*planes)
    return rgb


def _plane(c: Component, quant: np.ndarray, size: tuple[int, int], frame: list[Component]) -> np.ndarray:
    """The samples of a component in the picture's size."""
    rows, columns, _ = c.coefficients.shape
    blocks = np.zeros((rows, columns, 64))
    blocks[:, :, zigzag()] = c.coefficients * quant
    samples = cosines().T @ blocks.reshape(rows, columns, 8, 8) @ cosines()
    plane = np.clip(np.rint(samples + 128), 0, 255).astype(np.uint8).transpose(0, 2, 1, 3).reshape(8 * rows, 8 * columns)
    y, x = (np.arange(n) * s // most for n, s, most in ((size[0], c.v, max(f.v for f in frame)), (size[1], c.h, max(f.h for f in frame))))
    return plane[y][:, x]


def to_rgb(y: np.ndarray, cb: np.ndarray, cr: np.ndarray) -> np.ndarray:
    y, b, r = y.astype(float), cb.astype(float) - 128, cr.astype(float) - 128
    out = np.stack((y + 1.402 * r, y - 0.344136 * b - 0.714136 * r, y + 1.772 * b), axis=2)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


# --- writing ----------------------------------------------------------------------------

#: Symbols of equally long codes: sizes of first coefficients, and runs with sizes, end of block and sixteen zeros.
DC_SYMBOLS = bytes(range(12))
AC_SYMBOLS = bytes([0x00, 0xF0, *(run << 4 | size for run in range(16) for size in range(1, 11))])


def _even(symbols: bytes) -> bytes:
    """Counts by length of codes that all are equally long; the code of ones alone stays free."""
    length = len(symbols).bit_length()
    return bytes(len(symbols) if k == length else 0 for k in range(1, 17))


def codes(counts: bytes, symbols: bytes) -> dict[int, tuple[int, int]]:
    """(code, length) of each symbol."""
    out, code, at = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for s in symbols[at : at + n]:
            out[s] = code, length
            code += 1
        at += n
        code <<= 1
    return out


def _coded(block: np.ndarray, before: int, dc: dict, ac: dict) -> str:
    """A block of coefficients in the stream's order as a string of bits."""
    def put(table: dict, run: int, value: int) -> str:
        size = abs(value).bit_length()
        code, length = table[run << 4 | size]
        return f"{code:0{length}b}" + (f"{value if value > 0 else value + (1 << size) - 1:0{size}b}" if size else "")

    out, last = put(dc, 0, int(block[0]) - before), 0
    for k in np.flatnonzero(block[1:]) + 1:
        run = int(k) - last - 1
        out += put(ac, 15, 0) * (run // 16) + put(ac, run % 16, int(block[k]))
        last = int(k)
    return out + (put(ac, 0, 0) if last < 63 else "")


def _bytes(bits: str) -> bytes:
    bits += "1" * (-len(bits) % 8)
    return int(bits, 2).to_bytes(len(bits) // 8, "big").replace(b"\xff", b"\xff\x00") if bits else b""


def file(planes: list[np.ndarray], size: tuple[int, int], sampling: list[tuple[int, int]], quant: np.ndarray | int = 1, restart: int = 0, tables: dict[str, tuple[bytes, bytes]] | None = None, apart: bool = False) -> bytes:
    """A baseline file of planes of bytes, each of its own size by ``sampling`` (vertical, horizontal).

    Planes are given up to whole blocks. ``apart`` makes a scan of each component.
    """
    tables = tables or {"dc": (_even(DC_SYMBOLS), DC_SYMBOLS), "ac": (_even(AC_SYMBOLS), AC_SYMBOLS)}
    dc, ac = codes(*tables["dc"]), codes(*tables["ac"])
    q = np.broadcast_to(np.asarray(quant), (64,))
    tall, wide = max(v for v, _ in sampling), max(h for _, h in sampling)
    down, across = -(-size[0] // (8 * tall)), -(-size[1] // (8 * wide))
    blocks = []
    for plane, (v, h) in zip(planes, sampling):
        full = np.pad(plane.astype(float), ((0, 8 * down * v - plane.shape[0]), (0, 8 * across * h - plane.shape[1])), mode="edge") - 128
        cut = full.reshape(down * v, 8, across * h, 8).transpose(0, 2, 1, 3)
        blocks.append(np.rint((cosines() @ cut @ cosines().T).reshape(down * v, across * h, 64)[:, :, zigzag()] / q).astype(int))

    def scan(own: list[int]) -> bytes:
        alone = len(own) == 1
        v, h = sampling[own[0]]
        rows, columns = (-(-(-(-size[0] * v // tall)) // 8), -(-(-(-size[1] * h // wide)) // 8)) if alone else (down, across)
        out, bits, before = b"", "", dict.fromkeys(own, 0)
        for unit in range(rows * columns):
            if restart and unit and unit % restart == 0:
                out += _bytes(bits) + bytes([0xFF, 0xD0 + (unit // restart - 1) % 8])
                bits, before = "", dict.fromkeys(own, 0)
            r, c = divmod(unit, columns)
            for k in own:
                v, h = (1, 1) if alone else sampling[k]
                for y in range(v):
                    for x in range(h):
                        block = blocks[k][r * v + y, c * h + x]
                        bits += _coded(block, before[k], dc, ac)
                        before[k] = int(block[0])
        head = bytes([len(own), *(b for k in own for b in (k + 1, 0)), 0, 63, 0])
        return _segment(SOS, head) + out + _bytes(bits)

    frame = struct.pack(">BHHB", 8, *size, len(planes)) + b"".join(bytes([k + 1, h << 4 | v, 0]) for k, (v, h) in enumerate(sampling))
    out = b"\xff\xd8" + _segment(DQT, b"\0" + bytes(q.astype(np.uint8))) + _segment(SEQUENTIAL[0], frame)
    out += b"".join(_segment(DHT, bytes([n]) + c + s) for n, (c, s) in ((0, tables["dc"]), (16, tables["ac"])))
    out += _segment(DRI, struct.pack(">H", restart)) if restart else b""
    scans = [[k] for k in range(len(planes))] if apart else [list(range(len(planes)))]
    return out + b"".join(map(scan, scans)) + b"\xff\xd9"


def _segment(kind: int, body: bytes) -> bytes:
    return bytes([0xFF, kind]) + struct.pack(">H", len(body) + 2) + body
