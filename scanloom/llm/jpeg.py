"""Progressive JPEG: scans into coefficients, coefficients into RGB tensors.

``decode`` reads baseline-free progressive files: it accumulates the scans of
spectral selection and successive approximation into coefficient arrays,
inverse-transforms them in numpy, repeats chroma up to full resolution and
returns RGB. ``encode_payload`` stores bytes losslessly as such a file.

Payload layout. A byte b becomes the quantised coefficient whose eight magnitude
bits in JPEG's code are b itself: b - 255 below 128 and b from there on. All
coefficients then have size category 8, so the first pass over an AC band
(Al = 1) has one symbol, run 0 and size 7, with a code of one bit: eight bits a
coefficient. The refinement pass has one end-of-band run for all blocks, then one
bit a coefficient. Such scans, recognised by their own tables, are read as arrays
of bits; any other scan is read symbol by symbol.

Blocks of 64 bytes fill Y, then Cb, then Cr of a 4:2:0 image, padded with zeros.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import settled, slices

# --- fixed values of the JPEG format: zigzag order of an 8 x 8 block -----------
ZIGZAG = np.array(sorted(range(64), key=lambda k: (k // 8 + k % 8, k // 8 if (k // 8 + k % 8) % 2 else k % 8)), np.int64)
# -------------------------------------------------------------------------------

#: MCUs in a row of the image, as long as its rows fit; and rows or columns of MCUs that sixteen bits of pixels can name.
WIDE, MOST = 32, 4095

#: Bytes of text that are handled at once.
BATCH_BYTES = 8 << 20

#: Parts of the files, by the task that made them, whose tensors are on disk one after the other.
PARTS = 8

#: What is known of a file when it is decoded.
FIGURES = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "height", "width")


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _stuffed(data: bytes) -> bytes:
    return data.replace(b"\xff", b"\xff\x00")


def _packed(values: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Bits of ``values``, each ``widths`` long, most significant first, as an array of bits."""
    n = int(widths.sum())
    ends = np.cumsum(widths)
    shift = np.repeat(ends, widths) - 1 - np.arange(n)
    return ((np.repeat(values, widths) >> shift) & 1).astype(np.uint8)


def _bytes_of(parts: Iterable[np.ndarray]) -> bytes:
    """Arrays of bits as whole bytes, the last filled up with ones, FF stuffed; one array at a time is packed."""
    out, rest = [], np.zeros(0, np.uint8)
    for part in parts:
        bits = np.concatenate((rest, part)) if len(rest) else part
        whole = len(bits) & -8
        out.append(np.packbits(bits[:whole]).tobytes())
        rest = bits[whole:]
    if len(rest):
        out.append(np.packbits(np.concatenate((rest, np.ones(8 - len(rest), np.uint8)))).tobytes())
    return _stuffed(b"".join(out))


def _table(kind: int, symbols: dict[int, list[int]]) -> bytes:
    """DHT body: symbols by code length."""
    return bytes([kind]) + bytes(len(symbols.get(k, [])) for k in range(1, 17)) + bytes(s for k in range(1, 17) for s in symbols.get(k, []))


#: DC sizes 0 to 9 in codes of four bits.
DC_TABLE = {4: list(range(10))}


def layout(blocks: int) -> tuple[int, int]:
    """MCU columns and rows that hold so many blocks, six in an MCU.

    Above ``WIDE * MOST`` MCUs (50,319,360 bytes of text) the image gets wider;
    ``MOST`` by ``MOST`` ones hold 6.4 GB, more than a value of a table can.
    """
    mcus = max(1, -(-blocks // 6))
    wide = max(min(WIDE, mcus), -(-mcus // MOST))
    if wide > MOST:
        raise ValueError(f"a JPEG holds {MOST * MOST * 6} blocks at most")
    return wide, -(-mcus // wide)


#: The size category of each magnitude that a difference of halved DC values has.
SIZES = np.array([m.bit_length() for m in range(256)])


def _dc_first(data: np.ndarray) -> bytes:
    """The DC scan of one component at Al = 1, of its blocks' first bytes: differences, category then bits."""
    v = data.astype(np.int64)
    v -= 255 * (v < 128)
    v >>= 1
    diff = v.copy()
    diff[1:] -= v[:-1]
    size = SIZES[np.abs(diff)]
    extra = diff + ((1 << size) - 1) * (diff < 0)
    return _bytes_of([_packed((size << size) | extra, size + 4)])


def encode_payload(payload: bytes) -> bytes:
    """A progressive 4:2:0 JPEG that holds ``payload`` (a multiple of 64 bytes)."""
    blocks = len(payload) // 64
    wide, high = layout(blocks)
    data = np.frombuffer(payload, np.uint8).reshape(-1, 64)
    n = wide * high
    parts = [(0, 4 * n), (4 * n, 5 * n), (5 * n, 6 * n)]

    def runs_of(part: tuple[int, int]) -> Iterator[np.ndarray]:
        """Bytes of a component's blocks, ``LONGEST_RUN`` blocks at a time; blocks past the payload are zeros."""
        for k in range(*part, LONGEST_RUN):
            own = data[k : min(k + LONGEST_RUN, part[1])]
            lack = min(LONGEST_RUN, part[1] - k) - len(own)
            yield np.concatenate((own, np.zeros((lack, 64), np.uint8))) if lack else own

    runs = sorted({min(LONGEST_RUN, m - k).bit_length() - 1 for m in (4 * n, n) for k in range(0, m, LONGEST_RUN)})
    scans = {}
    for c, part in enumerate(parts):
        dc, low_dc, low = [], [], []
        bands = {(1, 5): [], (6, 63): []}

        def refinement() -> Iterator[np.ndarray]:
            """One end-of-band run of 2 ** r + extra blocks, then a correction bit for each coefficient; fills the lists on its way."""
            for block in runs_of(part):  # noqa: B023
                # Of magnitude b from 128 on and 255 - b below, the code's upper seven bits are b >> 1; a code bit of 0 goes before them.
                half, odd = block >> 1, block & 1 ^ (block < 128)
                dc.append(block[:, 0])  # noqa: B023
                low_dc.append(odd[:, 0])  # noqa: B023
                for (first, last), out in bands.items():  # noqa: B023
                    out.append(half[:, first : last + 1].tobytes())
                r = len(block).bit_length() - 1
                head = f"{runs.index(r):02b}" + (f"{len(block) - (1 << r):0{r}b}" if r else "")
                yield np.frombuffer(head.encode(), np.uint8) - 48
                yield odd[:, 1:].ravel()

        scans[c, 1, 63, 0x10] = [_bytes_of(refinement())]
        scans[c, 0, 0, 0x01] = [_dc_first(np.concatenate(dc))]
        # The point transform of DC is an arithmetic shift, so its last bit is that of the two's complement: the same.
        scans[c, 0, 0, 0x10] = [_bytes_of([np.concatenate(low_dc)])]
        scans |= {(c, *band, 0x01): own for band, own in bands.items()}
    out = [*START, _segment(0xFE, struct.pack(">Q", blocks)), _segment(0xC2, struct.pack(">BHHB", 8, high * 16, wide * 16, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0]))]
    for key in [(c, 0, 0, 0x01) for c in range(3)] + [(c, *band, 0x01) for c in range(3) for band in ((1, 5), (6, 63))]:
        out += [SCANS[key], *scans[key]]
    out.append(_segment(0xC4, _table(0x10, {2: [r << 4 for r in runs]})))
    for key in [(c, 1, 63, 0x10) for c in range(3)] + [(c, 0, 0, 0x10) for c in range(3)]:
        out += [SCANS[key], *scans[key]]
    out.append(b"\xff\xd9")
    return b"".join(out)


#: What every file starts with: quantisers of one, DC sizes, and the one symbol of the first AC passes.
START = [b"\xff\xd8", _segment(0xDB, b"\x00" + b"\x01" * 64), _segment(0xC4, _table(0x00, DC_TABLE)), _segment(0xC4, _table(0x10, {1: [0x07]}))]

#: Scan headers by component, band and approximation.
SCANS = {(c, *band): _segment(0xDA, bytes([1, c + 1, 0x00, *band])) for c in range(3) for band in ((0, 0, 0x01), (1, 5, 0x01), (6, 63, 0x01), (1, 63, 0x10), (0, 0, 0x10))}

#: Blocks in an end-of-band run, at most.
LONGEST_RUN = 32767


class _Bits:
    """Entropy-coded data of one scan, read bit by bit."""

    def __init__(self, data: bytes):
        self.raw = data
        self.at = 0

    @cached_property
    def text(self) -> bytes:
        """All bits, a byte each: for scans of DC, which are short."""
        return np.unpackbits(np.frombuffer(self.raw, np.uint8)).tobytes()

    def span(self, n: int) -> np.ndarray:
        """The next ``n`` bits as an array."""
        part = np.frombuffer(self.raw, np.uint8)[self.at >> 3 : self.at + n + 7 >> 3]
        out = np.unpackbits(part)[self.at & 7 :][:n]
        self.at += n
        return out

    def take(self, n: int) -> int:
        start, end = self.at >> 3, self.at + n + 7 >> 3
        self.at += n
        part = self.raw[start:end].ljust(end - start, b"\0")  # past the end there are zeros
        return int.from_bytes(part) >> (8 * end - self.at) & ((1 << n) - 1)

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        v = 0
        for n in range(1, 17):
            v = v << 1 | self.take(1)
            if (n, v) in codes:
                return codes[n, v]
        raise ValueError("no such code")


def _codes(lengths: bytes, symbols: bytes) -> dict[tuple[int, int], int]:
    out, code, k = {}, 0, 0
    for n, count in enumerate(lengths, 1):
        for _ in range(count):
            out[n, code] = symbols[k]
            code, k = code + 1, k + 1
        code <<= 1
    return out


def _extended(v: int, n: int) -> int:
    return v if not n or v >> (n - 1) else v - (1 << n) + 1


@lru_cache(maxsize=64)
def _by_bits(codes: tuple[tuple[tuple[int, int], int], ...]) -> dict[bytes, int]:
    """Symbols by their codes' bits, a byte each."""
    return {bytes(code >> (n - 1 - k) & 1 for k in range(n)): s for (n, code), s in codes}


def _dc_scan(coef: list[np.ndarray], bits: _Bits, tables: list[dict], al: int) -> None:
    """First DC scan; ``coef`` has the DC values of each component in scan order."""
    # All codes alike in length: sizes are found by lookup instead of bit by bit.
    text = bits.text
    each = np.frombuffer(text, np.uint8)
    for values, codes in zip(coef, tables):
        width = {n for n, _ in codes}
        if len(width) == 1:
            n = width.pop()
            by_code = _by_bits(tuple(codes.items()))
            at, size, place = bits.at, [], []
            for _ in range(len(values)):
                s = by_code[text[at : at + n]]
                size.append(s)
                place.append(at + n)
                at += n + s
            bits.at = at
            size, place = np.array(size, np.int64), np.array(place, np.int64)
            extra, k = np.zeros(len(size), np.int64), np.arange(int(size.max(initial=0)))
            for a in range(0, len(size), LONGEST_RUN):
                s, p = size[a : a + LONGEST_RUN, None], place[a : a + LONGEST_RUN, None]
                bit = each[np.minimum(p + k, len(each) - 1)]
                extra[a : a + LONGEST_RUN] = (np.where(k < s, bit, 0) << np.maximum(s - 1 - k, 0)).sum(axis=1)
            low = (size > 0) & (extra < (1 << np.maximum(size, 1) >> 1))
            values[:] = np.cumsum(np.where(low, extra - (1 << size) + 1, extra)) << al
        else:
            before = 0
            for k in range(len(values)):
                s = bits.symbol(codes)
                before += _extended(bits.take(s), s)
                values[k] = before << al


def _ac_first(coef: np.ndarray, bits: _Bits, codes: dict, first: int, last: int, al: int) -> None:
    if len(codes) == 1 and (symbol := next(iter(codes.values()))) >> 4 == 0 and symbol & 15:
        n, s = next(iter(codes))[0], symbol & 15
        wide = n + s
        for k in range(0, len(coef), LONGEST_RUN):  # as many blocks at once as keep the arrays small
            part = coef[k : k + LONGEST_RUN, first : last + 1]
            if wide == 8:
                v = np.frombuffer(bits.raw, np.uint8, part.size, k * (last - first + 1)).astype(coef.dtype) & ((1 << s) - 1)
            else:
                fields = bits.span(part.size * wide).reshape(-1, wide)[:, n:]
                v = (fields.astype(coef.dtype) << np.arange(s - 1, -1, -1, dtype=coef.dtype)).sum(axis=1, dtype=coef.dtype)
            part[:] = (np.where(v >> (s - 1), v, v - (1 << s) + 1) << al).reshape(part.shape)
        return
    run = 0
    for block in coef:
        if run:
            run -= 1
            continue
        k = first
        while k <= last:
            r, s = divmod(bits.symbol(codes), 16)
            if s:
                k += r
                block[k] = _extended(bits.take(s), s) * (1 << al)
                k += 1
            elif r == 15:
                k += 16
            else:
                run = (1 << r) + bits.take(r) - 1
                break


def _ac_refine(coef: np.ndarray, bits: _Bits, codes: dict, first: int, last: int, al: int) -> None:
    one, at = 1 << al, 0
    while at < len(coef):
        mark, k, block = bits.at, first, coef[at]
        r, s = divmod(bits.symbol(codes), 16)
        if s == 0 and r < 15:  # a run of blocks without new coefficients: correction bits only
            run = (1 << r) + bits.take(r)
            part = coef[at : at + run, first : last + 1]
            known = part != 0
            n = int(np.count_nonzero(known))
            add = bits.span(n).astype(coef.dtype) * one
            if n == part.size:
                add = add.reshape(part.shape)
                part += np.where(part < 0, -add, add)
            else:
                part[known] += np.sign(part[known]) * add
            at += run
            continue
        bits.at = mark
        while k <= last:
            r, s = divmod(bits.symbol(codes), 16)
            if s == 0 and r < 15:
                run = (1 << r) + bits.take(r)
                rest = block[k : last + 1]
                for j in np.flatnonzero(rest):
                    rest[j] += np.sign(rest[j]) * one * bits.take(1)
                tail = coef[at + 1 : at + run, first : last + 1]
                known = tail != 0
                n = int(known.sum())
                tail[known] += np.sign(tail[known]) * bits.span(n).astype(coef.dtype) * one
                at += run - 1
                break
            value = (1 if bits.take(1) else -1) * one if s else 0
            while k <= last:
                if block[k]:
                    block[k] += np.sign(block[k]) * one * bits.take(1)
                elif r == 0:
                    if value:
                        block[k] = value
                    k += 1
                    break
                else:
                    r -= 1
                k += 1
        at += 1


def read_coefficients(data: bytes) -> dict:
    """Size, sampling, quantisers, comment and coefficients (zigzag order) of a progressive file."""
    at, tables, out = 2, {}, {"quant": {}, "comment": b"", "restart": 0}
    while at < len(data):
        marker = data[at + 1]
        if marker == 0xD9:
            break
        n = struct.unpack_from(">H", data, at + 2)[0]
        body, at = data[at + 4 : at + 2 + n], at + 2 + n
        if marker == 0xFE:
            out["comment"] = body
        elif marker == 0xDB:
            while body:
                wide = 64 * (1 + (body[0] >> 4))
                out["quant"][body[0] & 15] = np.frombuffer(body[1 : 1 + wide], ">u2" if body[0] >> 4 else np.uint8).astype(np.int64)
                body = body[1 + wide :]
        elif marker == 0xC4:
            while body:
                count = sum(body[1:17])
                tables[body[0]] = _codes(body[1:17], body[17 : 17 + count])
                body = body[17 + count :]
        elif marker == 0xDD and struct.unpack(">H", body)[0]:
            raise ValueError("restart intervals are not supported")
        elif marker == 0xC2:
            _, out["height"], out["width"], count = struct.unpack_from(">BHHB", body)
            out["parts"] = {body[6 + 3 * k]: (body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(count)}
            hm, vm = (max(p[k] for p in out["parts"].values()) for k in (0, 1))
            out["mcus"] = -(-out["width"] // (8 * hm)), -(-out["height"] // (8 * vm))
            out["most"] = hm, vm
            out["coef"] = {c: np.zeros((out["mcus"][1] * v, out["mcus"][0] * h, 64), np.int16) for c, (h, v, _) in out["parts"].items()}
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            raise ValueError("only progressive files with Huffman codes")
        elif marker == 0xDA:
            end = at
            while True:  # the scan ends at a marker that is not a stuffed FF
                end = data.index(b"\xff", end)
                if data[end + 1]:
                    break
                end += 2
            _scan(out, tables, body, _Bits(data[at:end].replace(b"\xff\x00", b"\xff")))
            at = end
    return out


def _scan(image: dict, tables: dict, head: bytes, bits: _Bits) -> None:
    ids = [(head[1 + 2 * k], head[2 + 2 * k]) for k in range(head[0])]
    first, last, high, low = *head[-3:-1], head[-1] >> 4, head[-1] & 15
    hm, vm = image["most"]

    def own(c: int) -> np.ndarray:
        """A view of the blocks that a scan of this component alone visits."""
        h, v, _ = image["parts"][c]
        return image["coef"][c][: -(-(-(-image["height"] * v // vm)) // 8), : -(-(-(-image["width"] * h // hm)) // 8)]

    if first == 0:
        if len(ids) == 1:
            view = own(ids[0][0])
            values = view[:, :, 0].ravel().astype(np.int64)
            if high:
                values |= bits.span(len(values)).astype(np.int64) << low
            else:
                _dc_scan([values], bits, [tables[ids[0][1] >> 4]], low)
            view[:, :, 0] = values.reshape(view.shape[:2])
            return
        before = dict.fromkeys((c for c, _ in ids), 0)
        for y in range(image["mcus"][1]):
            for x in range(image["mcus"][0]):
                for c, t in ids:
                    h, v, _ = image["parts"][c]
                    for j in range(v):
                        for i in range(h):
                            block = image["coef"][c][y * v + j, x * h + i]
                            if high:
                                block[0] |= bits.take(1) << low
                            else:
                                s = bits.symbol(tables[t >> 4])
                                before[c] += _extended(bits.take(s), s)
                                block[0] = before[c] << low
        return
    c, t = ids[0]
    view = own(c)
    flat = np.ascontiguousarray(view).reshape(-1, 64)
    (_ac_refine if high else _ac_first)(flat, bits, tables[0x10 | (t & 15)], first, last, low)
    view[:] = flat.reshape(view.shape)


@lru_cache(maxsize=1)
def _inverse() -> np.ndarray:
    """The matrix from zigzag coefficients to the samples of a block."""
    k = np.arange(8)
    basis = np.cos((2 * k[:, None] + 1) * k[None, :] * np.pi / 16) * np.where(k == 0, np.sqrt(1 / 8), 0.5)
    return np.einsum("yu,xv->uvyx", basis, basis).reshape(64, 64)[ZIGZAG]


#: Blocks that are turned into pixels at once.
STRIP_BLOCKS = 6144


def strips(image: dict) -> Iterator[np.ndarray]:
    """RGB (rows, width, 3) as uint8 at full resolution, some rows of MCUs at a time, of what ``read_coefficients`` gives."""
    hm, vm = image["most"]
    wide, high = image["mcus"]
    step = max(1, STRIP_BLOCKS // (wide * sum(h * v for h, v, _ in image["parts"].values())))
    for top in range(0, high, step):
        rows = min(8 * vm * step, image["height"] - 8 * vm * top)
        planes = []
        for c, (h, v, q) in image["parts"].items():
            coef = image["coef"][c][top * v : (top + step) * v]
            samples = (coef.reshape(-1, 64) * image["quant"][q].astype(np.float64)) @ _inverse()
            samples += 128.0
            np.clip(np.rint(samples, out=samples), 0, 255, out=samples)
            plane = samples.reshape(*coef.shape[:2], 8, 8).transpose(0, 2, 1, 3).reshape(8 * coef.shape[0], -1)
            planes.append(plane.repeat(vm // v, axis=0).repeat(hm // h, axis=1)[:rows, : image["width"]])
        if len(planes) == 1:
            rgb = np.repeat(planes[0][:, :, None], 3, axis=2)
        else:
            y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
            rgb = np.stack((y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb), axis=2)
        yield np.clip(np.rint(rgb, out=rgb), 0, 255, out=rgb).astype(np.uint8)


def decode(data: bytes) -> tuple[np.ndarray, dict]:
    """RGB (height, width, 3) as uint8 at full resolution, and what ``read_coefficients`` gives."""
    image = read_coefficients(data)
    rgb = np.empty((image["height"], image["width"], 3), np.uint8)
    at = 0
    for strip in strips(image):
        rgb[at : at + len(strip)] = strip
        at += len(strip)
    return rgb, image


def payload_pieces(image: dict) -> Iterator[bytes]:
    """The payload that ``encode_payload`` stored, from the coefficients, in pieces."""
    left = struct.unpack(">Q", image["comment"])[0]
    for coef in image["coef"].values():
        flat = coef.reshape(-1, 64)[:left]
        left -= len(flat)
        for k in range(0, len(flat), LONGEST_RUN):
            v = flat[k : k + LONGEST_RUN]
            yield np.where(v < 0, v + 255, v).astype(np.uint8).tobytes()


def payload_of(image: dict) -> bytes:
    return b"".join(payload_pieces(image))


def features(rgb: Iterator[np.ndarray]) -> str:
    """Mean and deviation of each channel in hundredths, of exact integer sums over an image's strips."""
    counts = np.zeros((3, 256), np.int64)
    for strip in rgb:
        counts += [np.bincount(strip[:, :, k].ravel(), minlength=256) for k in range(3)]
    level = np.arange(256, dtype=np.int64)
    n = int(counts[0].sum())
    sums = [(int(h @ level), int(h @ level**2)) for h in counts]
    return ",".join(f"{100 * a // n}:{int(100 * max(0, n * b - a * a) ** 0.5 / n)}" for a, b in sums)


def media(docs: DataFrame, tensors: bool = False) -> DataFrame:
    """Each whole text stored as a progressive JPEG, read back and described.

    The files are written to the shared folder first, as Parquet rows that Spark
    commits; every figure but n_bytes is of what is read from there.

    Gives doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32,
    media_bytes, media_sha256 and feature (mean and deviation of each RGB
    channel, each in hundredths), and with ``tensors`` also media, height, width
    and rgb (height x width x 3 bytes at full resolution).

    Height, width and the RGB tensor settle as columns of a table, and features
    are computed from the tensors that are read back. Without ``tensors`` in the
    result this is done for a part of the files after the other, as tensors take
    twice the room of the text: of ``PARTS`` parts one has its tensors on disk.

    Defined cases: a null text is empty; an empty one is a block of zeros. Extra
    columns are not read. Equal texts, and repeated rows, give equal values; an
    empty table gives none. A very long text is encoded, decoded and described in
    runs of blocks: about eight bytes of memory a byte of text, two of them for ``rgb``.
    """

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            sizes = [len(t) for t in texts]
            files = []
            while texts:
                t = texts.pop(0)
                files.append(encode_payload(t.ljust(max(64, -(-len(t) // 64) * 64), b"\0")))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_bytes": pa.array(sizes, pa.int64()), "media": pa.array(files, pa.binary())})

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media", BATCH_BYTES):
            rows, tensors_of = [], []
            for file in batch.column("media"):
                file = file.as_py()
                rgb, image = decode(file)
                whole, size, tail = hashlib.sha256(), 0, b""
                for piece in payload_pieces(image):
                    whole.update(piece)
                    size, tail = size + len(piece), piece[-64:]
                rows.append((size, whole.hexdigest(), zlib.crc32(tail), len(file), hashlib.sha256(file).hexdigest(), *rgb.shape[:2]))
                tensors_of.append(rgb.ravel())
            ends = pa.array(np.cumsum([0, *map(len, tensors_of)]), pa.int64())
            data = pa.py_buffer(tensors_of[0] if len(tensors_of) == 1 else np.concatenate(tensors_of))
            own = dict(zip(FIGURES, zip(*rows))) | {"rgb": pa.Array.from_buffers(pa.large_binary(), len(rows), [None, ends.buffers()[1], data]).cast(pa.binary())}
            yield of_batch(batch, own, settles)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "rgb", BATCH_BYTES):
            sizes = zip(*(batch.column(c).to_pylist() for c in ("height", "width")))
            found = [features(iter([np.frombuffer(rgb.as_buffer(), np.uint8).reshape(*size, 3)])) for rgb, size in zip(batch.column("rgb"), sizes)]
            yield of_batch(batch, {"feature": found}, gives)

    def of_batch(batch: pa.RecordBatch, own: dict, schema: pa.Schema) -> pa.RecordBatch:
        columns = {n: batch.column(n) if n in batch.schema.names else own[n] if isinstance(own[n], pa.Array) else pa.array(own[n], schema.field(n).type) for n in schema.names}
        return pa.RecordBatch.from_pydict(columns, schema=schema)

    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}
    schema = lambda text: pa.schema([(n, kinds[t]) for n, t in (x.split() for x in text.split(", "))])
    figures = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string"
    tensor = "height int, width int, rgb binary"
    kept = f"{figures}{', media binary' if tensors else ''}, {tensor}"
    out = f"{figures}, feature string{f', media binary, {tensor}' if tensors else ''}"
    settles, gives = schema(kept), schema(out)

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(stored, "doc_id long, n_bytes long, media binary")
    if tensors:
        files = settled(rows, "media")
        return settled(files.mapInArrow(decoded, kept), "tensors", files).mapInArrow(described, out)
    files = settled(rows.withColumn("part", F.spark_partition_id() % PARTS), "media", by="part")
    found = []
    for k in range(PARTS):
        table = settled(files.filter(F.col("part") == k).select("doc_id", "n_bytes", "media").mapInArrow(decoded, kept), "tensors")
        found.append(settled(table.mapInArrow(described, out), "described", table))
    return reduce(DataFrame.unionByName, found)
