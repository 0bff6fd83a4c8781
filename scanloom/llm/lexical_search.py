"""Ranked search over words: Block-Max WAND on shards of an inverted index.

Tasks cut their documents into shards of ``SHARD_BYTES`` of text and build each
shard's index where the texts are; no posting is shuffled. A term's postings in a
shard are in order of the shard's documents and in blocks of ``BLOCK``: gaps and
counts as variable-length bytes, beside each block's last document and the
greatest impact in it. The index is a table (shard, term, block metadata, body).

A shard is searched in windows of ``WINDOW`` documents, in order. What a term can
still give in a window is the greatest impact of its blocks there times its weight:
metadata alone, so moving on to the next window is shallow. Where all terms together
stay below the threshold, the k-th best score so far, a window is passed over with
nothing decompressed. Elsewhere terms go by falling bound: while those still to come
could lift a document from nothing to the threshold (up to the pivot) their blocks
are decompressed; behind the pivot only blocks that hold a document which can still
reach it. Blocks below the threshold so stay packed. Each shard gives its k best to
a merge in two steps.

Queries are dealt to blocks of ``QUERY_ROWS``; a block of queries and a shard meet
in one task. Only postings of terms that queries hold are sent there.

Defined cases. A null text has no terms, as an empty one; documents without terms
count nowhere. A document without an id counts in all statistics and is ranked,
behind the others of its score. A repeated id is a document a row, and ranked each.
An item without an id or terms, or whose terms no document holds, has no rows; rows
of items with one id are one item of all their terms. Empty tables give no rows.
Texts are read whole: one that is longer than a shard is a shard of its own, and has
to fit in a task's memory about ten times over. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scanloom.llm.common import gathered, likely, settled, slices, small_batches

#: Bytes of text in a shard, postings in a block, documents in a window, queries that go to a task.
SHARD_BYTES = 16 << 20
BLOCK = 64
WINDOW = 1_024
QUERY_ROWS = 512

#: Tasks that shards and blocks of queries are dealt to, at most.
TASKS = 50_000

#: Groups of shards whose answers are merged first.
PARTS = 64

#: Terms of documents and queries: all but these characters, in SQL and in Python.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_INSIDE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

INDEX = "shard string, term binary, postings int, last array<int>, greatest array<bigint>, starts array<int>, body binary"
_INDEX = pa.schema([("shard", pa.string()), ("term", pa.binary()), ("postings", pa.int32()), ("last", pa.list_(pa.int32())), ("greatest", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32())), ("body", pa.binary())])

#: The row of a shard that holds its documents goes by the term that no document has.
DOCUMENTS = b""


def terms_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Term offsets by text (one more than texts) and all terms in order, ASCII letters lowered."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, ends, data = texts.buffers()
    rows = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)[rows[0] : rows[-1]]
    rows = rows - rows[0]
    inside = _INSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[rows] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(first)
    packed = np.append(np.cumsum(inside) - inside, inside.sum()).astype(np.int64)  # where a byte goes when only terms are kept
    bounds = np.append(packed[starts], packed[-1])
    values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(_LOWER[data[inside]].tobytes())])
    return np.searchsorted(starts, rows), values


def packed_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2 ** 35 as bytes of seven bits, the last one of each marked; and where each number starts."""
    size = 1 + sum((values >= 1 << bits).astype(np.int64) for bits in (7, 14, 21, 28))
    starts = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        own = size > k
        out[starts[own] + k] = values[own] >> 7 * k & 127
    out[starts + size - 1] |= 128
    return out, starts


def unpacked_numbers(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data & 128)
    starts = np.append(0, last[:-1] + 1)[: len(last)]
    place = np.arange(len(data)) - np.repeat(starts, last - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * place, starts) if len(last) else np.zeros(0, np.int64)


def impacts(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * counts // (1000 * counts + 20 * m)


def document_norms(sizes: np.ndarray, documents: int, words: int) -> np.ndarray:
    """m of each document: half fixed, half its size over the mean size, in hundredths."""
    return 100 - 50 + 50 * sizes * documents // max(words, 1)


def shard_index(name: str, ids: np.ndarray, missing: np.ndarray, offsets: np.ndarray, terms: pa.Array, documents: int, words: int) -> pa.RecordBatch:
    """Index rows of a shard: one for each term, and one of its documents."""
    coded = terms.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = len(ids)
    m = document_norms(np.diff(offsets), documents, words)
    key, count = np.unique(code * n + np.repeat(np.arange(n), np.diff(offsets)), return_counts=True)
    term, doc = key // n, key % n
    start = np.flatnonzero(np.diff(term, prepend=-1))  # of each term, in its postings
    place = np.arange(len(key)) - np.repeat(start, np.diff(np.append(start, len(key))))
    begins = place % BLOCK == 0
    gap = np.where(begins, doc, np.diff(doc, prepend=0))  # a block's first document is whole
    data, at = packed_numbers(np.stack((gap, count), axis=1).ravel())
    block = np.flatnonzero(begins)
    ends = np.append(block[1:], len(key))
    greatest = np.maximum.reduceat(impacts(count, m[doc]), block) if len(block) else np.zeros(0, np.int64)
    first = np.searchsorted(block, start)  # blocks before each term
    sizes = np.append(at[::2], len(data))
    bounds = np.append(sizes[start], len(data))
    own = np.repeat(bounds[:-1], np.diff(np.append(first, len(block))))
    lists = pa.array(np.append(first, len(block)).astype(np.int32))
    arrays = [
        pa.array([name] * len(start), pa.string()), coded.dictionary.cast(pa.binary()), pa.array(np.diff(np.append(start, len(key))).astype(np.int32)),
        pa.ListArray.from_arrays(lists, pa.array(doc[ends - 1].astype(np.int32))), pa.ListArray.from_arrays(lists, pa.array(greatest)),
        pa.ListArray.from_arrays(lists, pa.array((sizes[block] - own).astype(np.int32))),
        pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]),
    ]
    whole = np.stack((ids, missing.astype(np.int64), m), axis=1).astype("<i8").tobytes()
    head = [[name], [DOCUMENTS], [n], [[]], [[]], [[]], [whole]]
    return pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(h, f.type), a]) for h, a, f in zip(head, arrays, _INDEX)], schema=_INDEX)


def corpus_counts(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """The number of documents that hold a term, and of all terms."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, SHARD_BYTES):
            n = np.diff(terms_of(batch.column(text))[0])
            yield pa.RecordBatch.from_pydict({"documents": pa.array([int((n > 0).sum())], pa.int64()), "words": pa.array([int(n.sum())], pa.int64())})

    found = docs.select(text).mapInArrow(counted, "documents long, words long").agg(F.sum("documents"), F.sum("words")).first()
    return found[0] or 0, found[1] or 0


def build(docs: DataFrame, documents: int, words: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of (id, text), every term of every document in it."""
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = number = 0
        for batch in slices(batches, text, SHARD_BYTES):
            offsets, terms = terms_of(batch.column(text))
            some = np.flatnonzero(np.diff(offsets))
            own = batch.column(id)
            held.append((pc.fill_null(own, 0).to_numpy()[some], own.is_null().to_numpy(zero_copy_only=False)[some], np.diff(offsets)[some], terms))
            size += batch.column(text).nbytes
            if size >= SHARD_BYTES:
                yield joined(held, number := number + 1)
                held, size = [], 0
        if held:
            yield joined(held, number + 1)

    def joined(held: list[tuple], number: int) -> pa.RecordBatch:
        ids, missing, sizes = (np.concatenate([h[k] for h in held]) for k in range(3))
        return shard_index(f"{TaskContext.get().partitionId()}-{number}", ids, missing, np.append(0, np.cumsum(sizes)), pa.concat_arrays([h[3] for h in held]), documents, words)

    return docs.select(F.col(id).cast("long").alias(id), text).mapInArrow(shards, INDEX)


class Shard:
    """One shard's documents, and its postings of the terms that queries hold."""

    def __init__(self, head: bytes, rows: pa.Table):
        self.ids, self.missing, self.m = np.frombuffer(head, "<i8").reshape(-1, 3).T
        self.windows = -(-len(self.m) // WINDOW)
        self.row = {t: k for k, t in enumerate(rows.column("term").to_pylist())}
        lists = {c: rows.column(c).combine_chunks() for c in ("last", "greatest", "starts")}
        self.at = lists["last"].offsets.to_numpy()
        self.flat = {c: x.values.to_numpy(zero_copy_only=False).astype(np.int64) for c, x in lists.items()}
        self.body = rows.column("body")
        self.postings_of = rows.column("postings").to_numpy()
        self.ready: dict[int, tuple] = {}
        self.open: dict[int, tuple] = {}  # what has been decompressed; 16 bytes a posting at most
        self.read = self.blocks = 0

    def postings(self, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A term's last documents, where its blocks start, its packed body, and its greatest impact by window."""
        if row not in self.ready:
            last, greatest, starts = (self.flat[c][self.at[row] : self.at[row + 1]] for c in ("last", "greatest", "starts"))
            body = np.frombuffer(self.body[row].as_py(), np.uint8)
            bound = np.zeros(self.windows, np.int64)
            first = np.append(0, last[:-1] + 1) // WINDOW  # a block reaches from behind the one before it
            spread = last // WINDOW - first + 1
            np.maximum.at(bound, gathered(first, spread), np.repeat(greatest, spread))
            self.ready[row] = last, np.append(starts, len(body)), body, bound
        return self.ready[row]

    def scored(self, row: int, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of some of a term's blocks, in order; a block is decompressed when it is first asked for."""
        n = int(self.postings_of[row])
        if row not in self.open:
            self.open[row] = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(-(-n // BLOCK), bool)
        docs, impact, have = self.open[row]
        places = lambda b: gathered(b * BLOCK, np.minimum(BLOCK, n - b * BLOCK))  # noqa: E731  all blocks but the last one are full
        new = blocks[~have[blocks]]
        if len(new):
            _, starts, body, _ = self.ready[row]
            self.read += len(new)
            numbers = unpacked_numbers(body[gathered(starts[new], starts[new + 1] - starts[new])])
            gaps, begins, at = numbers[::2], np.arange(len(new)) * BLOCK, places(new)
            run = np.cumsum(gaps)
            docs[at] = run - np.repeat(run[begins] - gaps[begins], np.diff(np.append(begins, len(gaps))))
            impact[at] = impacts(numbers[1::2], self.m[docs[at]])
            have[new] = True
        if blocks[-1] - blocks[0] + 1 == len(blocks):
            one = slice(blocks[0] * BLOCK, min((blocks[-1] + 1) * BLOCK, n))
            return docs[one], impact[one]
        at = places(blocks)
        return docs[at], impact[at]

    def search(self, query: list[tuple[bytes, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents, by place, and scores of the ``k`` best for (term, weight), ties to smaller ids."""
        own = [(self.row[t], w) for t, w in query if t in self.row]
        best, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not own:
            return best, score
        lists = [self.postings(r) for r, _ in own]
        self.blocks += sum(len(x[0]) for x in lists)
        bounds = np.array([x[3] * w for x, (_, w) in zip(lists, own)])
        reach, least = bounds.sum(axis=0), 1  # a score of 0 is no answer
        for w in np.flatnonzero(reach).tolist():
            if reach[w] < least:
                continue
            low, high = w * WINDOW, min((w + 1) * WINDOW, len(self.m))
            acc = np.zeros(high - low, np.int64)
            to_come = int(reach[w])
            for t in np.argsort(-bounds[:, w], kind="stable").tolist():
                last, (row, weight) = lists[t][0], own[t]
                if to_come >= least:  # up to the pivot: a document may be new here
                    a, b = np.searchsorted(last, (low, high - 1))
                    blocks = np.arange(a, min(b + 1, len(last)))
                else:
                    alive = np.flatnonzero((acc > 0) & (acc + to_come >= least)) + low
                    if not len(alive):
                        break
                    blocks = np.unique(np.searchsorted(last, alive))
                    blocks = blocks[blocks < len(last)]
                if len(blocks) and bounds[t, w]:
                    docs, impact = self.scored(row, blocks)
                    a, b = np.searchsorted(docs, (low, high))
                    acc[docs[a:b] - low] += weight * impact[a:b]
                to_come -= int(bounds[t, w])
            found = np.flatnonzero(acc >= least) + low
            if len(found):
                best, score = np.append(best, found), np.append(score, acc[found - low])
                kept = np.lexsort((self.ids[best], self.missing[best], -score))[:k]
                best, score = best[kept], score[kept]
                if len(best) == k:
                    least = int(score[-1])
        return best, score


def query_terms(items: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """(id, term) of the items, each term once; ASCII letters lowered."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    found = F.regexp_extract_all(F.translate(F.col(text), upper, lower), F.lit(f"({TERM})"), F.lit(1))
    return items.filter(F.col(id).isNotNull()).select(F.col(id).cast("long").alias("item"), F.explode(found.cast("array<binary>")).alias("term")).distinct()


def search(docs: DataFrame, items: DataFrame, k: int = 50, id: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, rank, id, score): the ``k`` best documents of each item, all scores above 0."""
    small_batches(docs.sparkSession)
    documents, words = corpus_counts(docs, text)
    index = settled(build(docs, documents, words, id, text), "lexical-index")
    asked = query_terms(items, item, text)
    kept = likely(index.filter(F.col("term") != F.lit(DOCUMENTS)), asked, "term")
    frequency = kept.groupBy("term").agg(F.sum("postings").alias("df"))
    # The logarithm's argument is made of two doubles, as all of a weight is.
    weight = F.floor(1000 * F.log(F.lit(float(2 * documents + 2)) / (2 * F.col("df") + 1).cast("double")))
    weighed = asked.join(frequency, "term").select("item", "term", weight.alias("weight")).filter("weight > 0")
    count = max(1, -(-weighed.select("item").distinct().count() // QUERY_ROWS))
    queries = weighed.groupBy("item").agg(F.collect_list(F.struct("term", "weight")).alias("terms"))
    return merged(matched(kept, index.filter(F.col("term") == F.lit(DOCUMENTS)), queries, count, k), k, item, id)


def matched(rows: DataFrame, heads: DataFrame, queries: DataFrame, count: int, k: int) -> DataFrame:
    """(item, part, id, score): the ``k`` best of each shard; shards are dealt to as many cells."""
    cells = max(1, heads.count())
    whole = lambda n: F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    block, cell = F.pmod(F.xxhash64("item"), F.lit(count)), F.pmod(F.xxhash64("shard"), F.lit(cells))
    base = rows.unionByName(heads).select("*", cell.alias("cell"), F.explode(whole(count)).alias("block"))
    asked = queries.select("item", "terms", block.alias("block"), F.explode(whole(cells)).alias("cell"))

    def best(a: pa.Table, b: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("item", "part", "id", "none", "score")}
        if a.num_rows and b.num_rows:
            wanted = [(i, [(t["term"], t["weight"]) for t in q]) for i, q in zip(b.column("item").to_pylist(), b.column("terms").to_pylist())]
            is_head = pc.equal(a.column("term"), pa.scalar(DOCUMENTS, pa.binary()))
            for head in a.filter(is_head).select(["shard", "body"]).to_pylist():
                shard = Shard(head["body"], a.filter(pc.and_(pc.equal(a.column("shard"), head["shard"]), pc.invert(is_head))))
                for i, query in wanted:
                    found, score = shard.search(query, k)
                    out["item"].append(np.full(len(found), i))
                    out["part"].append(np.full(len(found), a.column("cell")[0].as_py() % PARTS))
                    out["id"].append(shard.ids[found])
                    out["none"].append(shard.missing[found])
                    out["score"].append(score)
        flat = {c: np.concatenate(v) if v else np.zeros(0, np.int64) for c, v in out.items()}
        none = flat.pop("none") > 0
        return pa.table({c: pa.array(v, pa.int64(), mask=none if c == "id" else None) for c, v in flat.items()})

    # Small rows, but long work: a number of partitions that is named is one that Spark doesn't lower for their size.
    dealt = lambda df: df.repartition(min(cells * count, TASKS), "cell", "block").groupBy("cell", "block")
    return dealt(base).cogroup(dealt(asked)).applyInArrow(best, "item long, part long, id long, score long")


def merged(found: DataFrame, k: int, item: str, id: str) -> DataFrame:
    """The ``k`` best of each item, among groups of shards first."""
    score = [F.desc("score"), F.asc_nulls_last("id")]
    part = F.row_number().over(Window.partitionBy("item", "part").orderBy(*score))
    first = found.withColumn("rank", part).filter(F.col("rank") <= k).drop("rank")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*score))
    return first.withColumn("rank", rank).filter(F.col("rank") <= k).select(F.col("item").alias(item), "rank", F.col("id").alias(id), "score")
