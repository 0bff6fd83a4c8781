"""Removal of word windows that an earlier document has, by difference-cover anchors.

A window of ``window`` words is a repeat if its sequence also starts in a document
with a smaller id. Anchors are shorter windows, hashed only where the position in
the document, modulo a period, is in a difference cover: for any two positions
there is a shift below the period that takes both into the cover. So two equal
windows share an anchor at the same place inside both, with ``window - period + 1``
words; a window none of whose anchors occurs elsewhere repeats nowhere.

Anchors that only one row holds are dropped; the others extend to the
windows that hold them, and those windows' hashes and the least id that has each
tell which repeat. A window is told from all others by two polynomials of its
words' 64-bit hashes, of 64 bits each, so that no two of a large corpus meet by chance.

Exact copies of an earlier document are settled by a digest of their words
beforehand, and have neither anchors nor windows. Anchors are counted where rows
are before they meet. Of the ids that share a window inside a batch only the least
meets those of other batches, as the others repeat it in any case; so no passage or
group of copies, however common, is one task's work.

Defined cases. A null or empty text has no words. Texts of fewer words than a
window lose none. A row without an id loses nothing and is no source. Rows of one
id don't repeat each other. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scanloom.llm.common import bitmap, drop_finished_shuffles, hashed_words, in_bitmap, likely, mix, settled, slices

#: Bases of the windows' polynomial hashes, modulo 2 ** 64.
BASE, SECOND_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F

#: Bytes of text that are hashed at a time: arrays of eight bytes for each of them stay in a core's cache.
BATCH_BYTES = 1 << 18


def difference_cover(period: int) -> tuple[int, ...]:
    """A smallest set of residues whose differences are all residues."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    raise ValueError("no period")


def best_period(window: int) -> int:
    """The period that hashes the fewest positions, with anchors of half a window at least."""
    return min(range(1, window // 2 + 2), key=lambda p: (len(difference_cover(p)) / p, p))


def window_hashes(word: np.ndarray, width: int, base: int = BASE) -> np.ndarray:
    """Hash (not yet mixed) of the ``width`` words from each position on, by joining halves; the last ones wrap and don't count."""

    def joined(n: int) -> np.ndarray:
        if n == 1:
            return word
        half = n // 2
        left, right = joined(half), joined(n - half) if n % 2 else None
        right = left if right is None else right
        return left * np.uint64(pow(base, n - half, 1 << 64)) + np.roll(right, -half)

    return joined(width)


def _starts(offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window of ``width`` words starts, and their documents."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.arange(len(doc))
    ok = at + width <= offsets[doc + 1]
    return at[ok], doc[ok]


def _rows_with(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes, and how many rows have each; ``doc`` never falls."""
    order = np.argsort(h, kind="stable")
    doc, h = doc[order], h[order]
    other = np.ones(len(h), bool)
    other[1:] = h[1:] != h[:-1]
    own = other.copy()
    own[1:] |= doc[1:] != doc[:-1]
    ends = np.append(np.flatnonzero(other), len(h))
    return h[other], np.diff(np.concatenate(([0], np.cumsum(own)))[ends])


def _by_id(h: np.ndarray, g: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct windows of each id, and whether a smaller id among ``ids`` has the same."""
    order = np.lexsort((ids, g, h))
    h, g, ids = h[order], g[order], ids[order]
    later = np.zeros(len(h), bool)
    later[1:] = (h[1:] == h[:-1]) & (g[1:] == g[:-1])
    new = ~later
    new[1:] |= ids[1:] != ids[:-1]
    return h[new], g[new], ids[new], later[new]


def _marked(offsets: np.ndarray, at: np.ndarray, doc: np.ndarray, h: np.ndarray, wanted: list) -> np.ndarray:
    """Which of the hashes ``h`` (grouped by document) their document's list holds."""
    out = np.zeros(len(h), bool)
    edges = np.searchsorted(doc, np.arange(len(offsets)))
    for d, own in enumerate(wanted):
        if own is not None and len(own):
            part = slice(edges[d], edges[d + 1])
            out[part] = np.isin(h[part], own)
    return out


def _lists(column: pa.Array) -> list:
    flat, ends = column.values.to_numpy(zero_copy_only=False).view(np.uint64), column.offsets.to_numpy()
    return [flat[a:b] if ok else None for a, b, ok in zip(ends[:-1].tolist(), ends[1:].tolist(), column.is_valid().to_pylist())]


def _spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The words of each row joined by single spaces; what stands so in ``data`` already is taken in one piece."""
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] != ends[:-1] + 1) | (data[ends[:-1]] != 32)
    new[offsets[:-1][np.diff(offsets) > 0]] = True
    first = np.flatnonzero(new)
    last = np.append(first, len(starts))[1:] - 1
    flat = memoryview(data)
    pieces = [flat[a:b] for a, b in zip(starts[first].tolist(), ends[last].tolist())]
    at = np.searchsorted(first, offsets).tolist()
    return [b" ".join(pieces[i:j]) for i, j in zip(at[:-1], at[1:])]


def deduplicate(docs: DataFrame, window: int = 13, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row; ``keep_text`` adds the kept words, joined by spaces."""
    period = best_period(window)
    width, cover = window - period + 1, np.array(difference_cover(period))
    in_cover = np.isin(np.arange(period), cover)
    texts = docs.select("doc_id", "text")
    named = texts.filter(F.col("doc_id").isNotNull())

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            words = hashed_words(batch.column("text"))
            offsets, word = words.offsets, words.hashes
            data = memoryview(word.tobytes())
            d = [hashlib.blake2b(data[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n": np.diff(offsets), "digest": pa.array(d, pa.binary())})

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            words = hashed_words(batch.column("text"))
            offsets, word = words.offsets, words.hashes
            at, doc = _anchor_places(offsets)
            h, rows = _rows_with(doc, mix(window_hashes(word, width)[at]))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(rows)], names=["h", "rows"])

    def _anchor_places(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, doc = _starts(offsets, width)
        # A document without a whole window has nothing to share.
        ok = in_cover[(at - offsets[doc]) % period] & (offsets[doc + 1] - offsets[doc] >= window)
        return at[ok], doc[ok]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            words = hashed_words(batch.column("text"))
            offsets, word = words.offsets, words.hashes
            at, doc = _anchor_places(offsets)
            hit = at[in_bitmap(shared.value, mix(window_hashes(word, width)[at]))]
            # Extend each anchor to the windows that hold it.
            near = np.zeros(len(word) + 1, np.int64)
            np.add.at(near, np.maximum(hit - period + 1, 0), 1)
            np.add.at(near, hit + 1, -1)
            near = np.cumsum(near)[:-1] > 0
            start, doc = _starts(offsets, window)
            ok = near[start]
            start, ids = start[ok], batch.column("doc_id").to_numpy()[doc[ok]]
            h, g, ids, later = _by_id(mix(window_hashes(word, window)[start]), window_hashes(word, window, SECOND_BASE)[start], ids)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(g.view(np.int64)), pa.array(ids), pa.array(later)], names=["h", "g", "doc_id", "later"])

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            words = hashed_words(batch.column("text"))
            offsets, word = words.offsets, words.hashes
            n = np.diff(offsets)
            repeats = _lists(batch.column("repeats"))
            gone = np.zeros(len(word) + 1, np.int64)
            if any(r is not None for r in repeats):
                start, doc = _starts(offsets, window)
                ok = np.array([r is not None for r in repeats], bool)[doc]
                start, doc = start[ok], doc[ok]
                hit = start[_marked(offsets, start, doc, mix(window_hashes(word, window)[start]), repeats)]
                np.add.at(gone, hit, 1)
                np.add.at(gone, hit + window, -1)
            gone = np.cumsum(gone)[:-1] > 0
            copy = batch.column("copy").to_numpy(zero_copy_only=False).astype(bool) & (n >= window)
            gone |= np.repeat(copy, n)
            ends = np.concatenate(([0], np.cumsum(~gone)))[offsets]
            texts = _spaced(words.data, words.starts[~gone], words.ends[~gone], ends)
            out = {"doc_id": batch.column("doc_id"), "n_words": n, "n_removed": n - np.diff(ends), "kept_sha256": [hashlib.sha256(t).hexdigest() for t in texts]}
            yield pa.RecordBatch.from_pydict(out | ({"text": [str(t, "utf-8") for t in texts]} if keep_text else {}))

    # Which rows copy a document of smaller id, word for word.
    known = settled(named.mapInArrow(digests, "doc_id long, n long, digest binary"), "digests")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("first"))
    known = settled(known.filter(F.col("n") >= window).join(first, "digest").select("doc_id", "digest", (F.col("doc_id") > F.col("first")).alias("copy")), "copies")
    # An id whose rows are all copies is done.
    done = settled(known.groupBy("doc_id").agg(F.min("copy").alias("copy")), "done")

    # Copies need neither anchors nor windows. Rows that may be copies, by hashes, are looked up.
    copied = done.filter("copy").select("doc_id")
    rest = settled(likely(named, copied, "doc_id").join(copied, "doc_id", "left_anti").select("doc_id", "text"), "rest")
    sources = likely(named, copied, "doc_id", "left_anti").select("doc_id", "text").unionByName(rest)

    # Which anchors other rows have goes to the tasks as bits of bounded size; the few others
    # that pass only make windows that turn out to have no second document.
    pieces = sources.select("text").mapInArrow(anchors, "h long, rows long")
    several = pieces.groupBy("h").agg(F.sum("rows").alias("rows")).filter(F.col("rows") > 1)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(several, "h"))
    drop_finished_shuffles(docs.sparkSession)
    found = settled(sources.mapInArrow(windows, "h long, g long, doc_id long, later boolean"), "windows", rest)
    least = Window.partitionBy("h", "g").orderBy("doc_id")
    met = found.filter(~F.col("later")).withColumn("place", F.rank().over(least)).filter(F.col("place") > 1)
    repeats = met.select("doc_id", "h").unionByName(found.filter("later").select("doc_id", "h")).groupBy("doc_id").agg(F.collect_set("h").alias("repeats"))
    repeats = settled(repeats, "repeats")

    copies = done.filter("copy").select("doc_id", F.lit(True).alias("copy"))
    marks = settled(repeats.join(copies, "doc_id", "full_outer").select("doc_id", "repeats", F.coalesce("copy", F.lit(False)).alias("copy")), "marks")
    # Texts that surely have no marks, by hashes of ids, go round the join.
    none = {"repeats": F.lit(None).cast("array<bigint>"), "copy": F.lit(False)}
    marked = likely(texts, marks, "doc_id").join(marks, "doc_id", "left").select("doc_id", "text", "repeats", F.coalesce("copy", F.lit(False)).alias("copy"))
    out = marked.unionByName(likely(texts, marks, "doc_id", "left_anti").withColumns(none).select("doc_id", "text", "repeats", "copy"))
    return out.mapInArrow(kept, "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", text string" if keep_text else ""))
