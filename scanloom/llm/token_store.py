"""Token ids of whole documents in a bit-plane shuffled binary format.

Format. A store is a folder of Parquet files without a codec of their own. A row
is a chunk: whole documents in ascending id order, with ``doc_ids``, their
``lengths`` in ids, and ``blocks`` of at most ``BLOCK`` ids. A block is transposed
into planes: plane k holds byte k of every id (or bit k, packed, for
``plane="bit"``); each is a zstandard frame of its own, and planes above the
block's highest id are left out. ``shard``, ``chunk``, ``n_ids`` and
``shard_start`` are the chunk index, which a reader can scan by itself. Spark's
committer writes the files, so a lost executor leaves nothing half done.

Defined cases. A null text is empty and still has its end id. A null id comes
first. Repeated ids stay, in order of their texts' hashes. An empty table makes
an empty store. Extra columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scanloom.llm.common import parts_for, shared_dir, slices
from scanloom.llm.tokens import END_ID, default_tokenizer, encoded

#: Ids in a block, and about how many in a chunk.
BLOCK = 1 << 16
CHUNK = 1 << 18

#: Bytes of text in a shard, which one task writes in order, and of those encoded at once.
SHARD_BYTES = 16 << 20
BATCH_BYTES = 4 << 20

SCHEMA = (
    "shard int, chunk int, n_ids long, shard_start long, doc_ids array<bigint>, lengths array<bigint>, "
    "blocks array<struct<n: int, planes: array<binary>>>"
)


def to_planes(ids: np.ndarray, plane: str = "byte") -> list[bytes]:
    """The planes of one block of uint32 ids, lowest first, each compressed."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    data = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if plane == "byte":
        rows = np.ascontiguousarray(data.T)[: -(-top // 8)]
    else:
        rows = np.packbits(np.ascontiguousarray(np.unpackbits(data, axis=1, bitorder="little").T)[:top], axis=1)
    pack = zstandard.ZstdCompressor(level=3)
    return [pack.compress(row.tobytes()) for row in rows]


def from_planes(planes: list[bytes], n: int, plane: str = "byte") -> np.ndarray:
    unpack = zstandard.ZstdDecompressor()
    if plane == "byte":
        data = np.zeros((n, 4), np.uint8)
        for k, p in enumerate(planes):
            data[:, k] = np.frombuffer(unpack.decompress(p, max_output_size=n), np.uint8)
        return data.view("<u4").ravel()
    bits = np.zeros((32, n), np.uint8)
    for k, p in enumerate(planes):
        bits[k] = np.unpackbits(np.frombuffer(unpack.decompress(p, max_output_size=-(-n // 8)), np.uint8), count=n)
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u4").ravel()


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, plane: str = "byte") -> None:
    """Encode every whole text of (doc_id, text) and write the store to ``path``."""
    tokenizer = tokenizer or default_tokenizer()

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk, before = TaskContext.get().partitionId(), 0, 0
        for batch in slices(batches, "text", BATCH_BYTES):
            offsets, ids = encoded(batch.column("text"), tokenizer, end_id)
            keys = batch.column("doc_id").to_pylist()
            group = (offsets[1:] - 1) // CHUNK  # documents by where they end
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(keys)]
            for a, b in zip(edges, edges[1:]):
                own = ids[offsets[a] : offsets[b]]
                blocks = [{"n": len(x), "planes": to_planes(x, plane)} for x in (own[k : k + BLOCK] for k in range(0, len(own), BLOCK))]
                yield pa.RecordBatch.from_pylist(
                    [{"shard": shard, "chunk": chunk, "n_ids": len(own), "shard_start": before, "doc_ids": keys[a:b], "lengths": np.diff(offsets[a : b + 1]).tolist(), "blocks": blocks}],
                    schema=ARROW,
                )
                chunk, before = chunk + 1, before + len(own)

    rows = docs.select("doc_id", "text")
    # The hash also parts rows that share an id, or have none.
    order = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(parts_for(rows, "text", SHARD_BYTES), *order).sortWithinPartitions(*order)
    rows.mapInArrow(chunks, SCHEMA).write.option("compression", "uncompressed").parquet(path)


#: SCHEMA as Arrow has it.
ARROW = pa.schema([
    ("shard", pa.int32()), ("chunk", pa.int32()), ("n_ids", pa.int64()), ("shard_start", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
    ("blocks", pa.list_(pa.struct([("n", pa.int32()), ("planes", pa.list_(pa.binary()))]))),
])


def read_store(spark, path: str, plane: str = "byte") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    Chunks are decoded where they are read. Only the totals of shards meet in
    one place, a row for each.
    """
    chunks = spark.read.schema(SCHEMA).parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for k in range(batch.num_rows) for r in batch.slice(k, 1).to_pylist()):
                ids = np.concatenate([from_planes(b["planes"], b["n"], plane) for b in row["blocks"]])
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                data = memoryview(ids.tobytes())
                yield pa.RecordBatch.from_pydict({
                    "shard": np.full(len(ends), row["shard"], np.int32), "doc_id": pa.array(row["doc_ids"], pa.int64()), "at": starts + row["shard_start"],
                    "n_tokens": ends - starts, "ids_crc32": np.array([zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], np.int64),
                })

    found = chunks.mapInArrow(documents, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    base = totals.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    return found.join(base, "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def stored_tokens(docs: DataFrame, tokenizer: str | None = None, plane: str = "byte") -> DataFrame:
    """Write a store into the shared folder and describe its documents as read back."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/token-store-{uuid.uuid4().hex}"
    write_store(docs, path, tokenizer, plane=plane)
    return read_store(spark, path, plane)
