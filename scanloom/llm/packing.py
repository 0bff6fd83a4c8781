"""Packing documents into fixed sequences by patterns and least squares.

Every document becomes pieces of at most ``window`` tokens. Lengths are counted
in one histogram over the corpus. Patterns are sets of up to three length bins
that fill a sequence exactly; non-negative least squares fits how often to use
each so that together they use up the histogram; counts are rounded; pieces left
over are packed best fit, on the histogram of exact lengths, one repeated
pattern at a time. All of that works on counts alone, whose size hangs on
``window`` and not on the corpus. The plan then says which ranks of each length
go to which sequences, and the pieces find their places where they are.

Defined cases. A null or empty text is its end id alone. Repeated rows are
packed each. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scanloom.llm.common import settled, slices
from scanloom.llm.tokens import END_ID, default_tokenizer, encoded

#: Bins in a sequence: patterns are made of lengths rounded up to a bin.
BINS = 512

#: Bytes of text that are encoded at once.
BATCH_BYTES = 4 << 20


def pieces_of(docs: DataFrame, window: int, tokenizer: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            offsets, ids = encoded(batch.column("text"), tokenizer, END_ID)
            n = np.diff(offsets)
            count = -(-n // window)
            row = np.repeat(np.arange(len(n)), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * window
            length = np.minimum(window, n[row] - start)
            data = memoryview(ids.tobytes())
            at = offsets[row] + start
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").take(pa.array(row)), "piece": piece.astype(np.int32), "start": start,
                "length": length, "ids_crc32": np.array(crc, np.int64),
            })

    return docs.select("doc_id", "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


@lru_cache(maxsize=4)
def patterns(bins: int) -> np.ndarray:
    """All sets of one to three bins (0: none) that add up to ``bins``, largest first."""
    a, b = np.meshgrid(np.arange(1, bins + 1), np.arange(0, bins + 1), indexing="ij")
    c = bins - a - b
    ok = (a >= b) & (b >= c) & (c >= 0)
    return np.stack((a[ok], b[ok], c[ok]), axis=1)


def fitted(wanted: np.ndarray, bins: int, rounds: int = 300, tolerance: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Patterns and how often to use each, by non-negative least squares.

    ``wanted[k]`` counts pieces of bin k (1 to bins). The active set grows by
    the columns with the steepest gradients; a column that would go negative
    leaves it. Errors at long lengths weigh more, as short pieces fill gaps.
    """
    table = patterns(bins)
    weight = np.minimum(1.0, np.arange(bins + 1) / (bins / 8)) + 0.05
    weight[0] = 0.0
    goal = wanted * weight
    usable = np.flatnonzero(np.all((table == 0) | (wanted[table] > 0), axis=1))
    table = table[usable]
    inside, x = np.zeros(len(table), bool), np.zeros(len(table))
    scale = max(1.0, goal.max(initial=0))

    def matrix(cols: np.ndarray) -> np.ndarray:
        m = np.zeros((bins + 1, len(cols)))
        for k in range(3):
            np.add.at(m, (table[cols, k], np.arange(len(cols))), 1.0)
        return m * weight[:, None]

    for _ in range(rounds if len(table) else 0):
        used = np.flatnonzero(inside)
        rest = goal - (matrix(used) @ x[used] if len(used) else 0)
        pull = (rest * weight)[table].sum(axis=1)
        pull[inside] = -np.inf
        best = np.argsort(-pull)[:8]
        best = best[pull[best] > tolerance * scale]
        if not len(best):
            break
        inside[best] = True
        while True:
            used = np.flatnonzero(inside)
            m = matrix(used)
            y = np.linalg.solve(m.T @ m + 1e-9 * np.eye(len(used)), m.T @ goal)
            low = y <= 0
            if not low.any():
                x[:] = 0
                x[used] = y
                break
            now = x[used]
            step = np.min(now[low] / np.maximum(now[low] - y[low], 1e-300))
            now = now + step * (y - now)
            gone = low & (now <= 1e-9)
            x[used] = np.where(gone, 0, now)
            if not gone.any():
                gone = low
                x[used[gone]] = 0
            inside[used[gone]] = False
    kept = x > 0.5
    return table[kept], x[kept]


def plan(histogram: np.ndarray, window: int, bins: int = BINS) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, end rank, first sequence, slot), and the number of sequences.

    ``histogram[n]`` counts pieces of n tokens. Pieces of one length are
    interchangeable: ranks [first, end) of a length take the same slot of
    consecutive sequences.
    """
    bins = min(bins, window)
    unit = -(-window // bins)
    bins = window // unit
    left = histogram.astype(np.int64).copy()
    taken = np.zeros(window + 1, np.int64)
    out: list[tuple[int, int, int, int, int]] = []

    def place(length: int, count: int, sequence: int, slot: int) -> None:
        out.append((length, int(taken[length]), int(taken[length]) + count, sequence, slot))
        taken[length] += count
        left[length] -= count

    top = np.minimum(-(-np.arange(window + 1) // unit), bins + 1)  # a length's bin, its upper end
    wanted = np.bincount(top, weights=left, minlength=bins + 2)[: bins + 1]
    sequences = 0
    table, repeats = fitted(wanted, bins)
    have = wanted.astype(np.int64)
    for k in np.argsort(-repeats):
        parts, n = np.unique(table[k][table[k] > 0], return_counts=True)
        count = int(min(round(repeats[k]), (have[parts] // n).min()))
        if count <= 0:
            continue
        have[parts] -= n * count
        for slot, part in enumerate(x for x in table[k].tolist() if x):
            at, need = sequences, count
            for length in range(part * unit, (part - 1) * unit, -1):
                if need and (some := int(min(need, left[length]))):
                    place(length, some, at, slot)
                    at, need = at + some, need - some
        sequences += count
    # What is left, best fit: the longest piece that still fits, again and again.
    while left.any():
        space, chosen, counts = window, [], {}
        while space > 0:
            fits = np.flatnonzero(left[: space + 1] > 0)
            fits = next((int(n) for n in fits[::-1] if left[n] > counts.get(int(n), 0)), 0)
            if not fits:
                break
            chosen.append(fits)
            counts[fits] = counts.get(fits, 0) + 1
            space -= fits
        count = int(min(left[n] // k for n, k in counts.items()))
        for slot, length in enumerate(chosen):
            place(length, count, sequences, slot)
        sequences += count
    return np.array(out, np.int64).reshape(-1, 5), sequences


def pack(docs: DataFrame, window: int = 4096, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    Sequences are gapless and at most ``window`` long.
    """
    pieces = settled(pieces_of(docs, window, tokenizer or default_tokenizer()), "pieces")
    counted = pieces.groupBy("length").count().collect()  # at most ``window`` rows
    histogram = np.zeros(window + 1, np.int64)
    for n, count in counted:
        histogram[n] = count
    slots, _ = plan(histogram, window)
    slots = slots[np.lexsort((slots[:, 1], slots[:, 0]))]

    # Ranks within a length, dealt over buckets so that no length is ordered by one task.
    buckets = int(1 + histogram.max(initial=0) // 50_000)
    rows = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    counts = rows.groupBy("length", "bucket").count()
    base = counts.select("length", "bucket", (F.sum("count").over(Window.partitionBy("length").orderBy("bucket")) - F.col("count")).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    rows = rows.withColumn("rank", F.row_number().over(within)).join(base, ["length", "bucket"]).withColumn("rank", F.col("base") + F.col("rank") - 1)
    far = int(histogram.max(initial=0)) + 1
    keys = slots[:, 0] * far + slots[:, 1]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            k = np.searchsorted(keys, length * far + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(slots[k, 3] + rank - slots[k, 1]), pa.array(slots[k, 4])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "slot"],
            )

    rows = rows.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("long").alias("rank"))
    rows = rows.mapInArrow(placed, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, slot long")
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("slot")
