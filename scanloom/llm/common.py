"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word everywhere in this package: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Used only where the session names no ``spark.checkpoint.dir`` and all work is done on one machine, as in tests.
LOCAL_SHARED = "/tmp/scanloom-shared"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return named or LOCAL_SHARED


#: Rows of an Arrow batch, as Spark's own 10,000 whole texts are too much for small workers; and its bytes, but for one row.
BATCH_ROWS, BATCH_BYTES = 2000, 64 << 20


def small_batches(spark: SparkSession) -> None:
    """Let batches of this session hold ``BATCH_ROWS`` rows and, as Spark does by itself, ``BATCH_BYTES`` bytes at most."""
    most = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < most <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").strip() in ("-1", "-1b"):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


#: With this set, Spark deletes the shuffle files of a statement when it ends, and not when its plan is garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame, name: str, *done: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Lineage ends here: what follows survives the loss of any executor without
    repeating the work above, and every later use reads the same rows. Shuffle files
    of the write go with it. Settled
    tables that nothing but ``df`` needs, ``done``, are deleted afterwards. Rows
    of each value of ``by`` lie in a folder of their own.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    to = df.write.option("compression", "zstd")
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        (to.partitionBy(by) if by else to).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_path = path
    drop_finished_shuffles(spark)
    for old in done:
        gone = spark._jvm.org.apache.hadoop.fs.Path(old.settled_path)
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return out


def drop_finished_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete shuffle files that no live plan refers to.

    The cleaner acts when the driver's JVM collects its garbage, which on a
    quiet driver may be long after a step has ended.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Hash values that ``likely`` tells apart, and so the most rows that it broadcasts.
LIKELY = 1 << 20


def likely(rows: DataFrame, ids: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """The rows whose ``column`` may be among ``ids``: all that are, and few others.

    A join of wide rows with few ids need not shuffle them all: what is broadcast
    is the set of the ids' hash values below ``LIKELY``, which has that many rows
    at most, however many ids there are. An exact join follows. With ``left_anti``
    it is the other rows, which are surely not among them.
    """
    value = F.pmod(F.xxhash64(column), F.lit(LIKELY))
    values = ids.select(value.alias("_hash")).distinct()
    return rows.withColumn("_hash", value).join(F.broadcast(values), "_hash", how).drop("_hash")


#: Bits of ``bitmap``, and so the most that it sends: 16 MB.
BITMAP = 1 << 27


def bitmap(hashes: DataFrame, column: str, bits: int = BITMAP) -> np.ndarray:
    """A filter of hash values that passes all of them and few others, as bytes of ``bits`` bits; built where the rows are.

    Each value sets the bits that its lower and its upper half name.
    """
    halves = F.explode(F.array(F.col(column), F.shiftrightunsigned(F.col(column), 32)))
    value = F.col("v").bitwiseAND(F.lit(bits - 1)) + 1  # Spark's bitmap functions count from 1
    rows = hashes.select(halves.alias("v")).groupBy(F.bitmap_bucket_number(value).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("b"))
    out = np.zeros(bits // 8, np.uint8)
    for k, b in rows.toLocalIterator():  # rows of 4 KB, ``bits`` / 32768 of them at most
        out[(k - 1) * len(b) : k * len(b)] = np.frombuffer(bytes(b), np.uint8)
    return out


def in_bitmap(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    last, values = np.uint64(len(bits) * 8 - 1), values.view(np.uint64)
    out = np.ones(len(values), bool)
    for v in (values & last, values >> np.uint64(32) & last):
        out &= (bits[v >> np.uint64(3)] >> (v & np.uint64(7)).astype(np.uint8)) & 1 > 0
    return out


def parts_for(df: DataFrame, column: str, bytes_each: int) -> int:
    """A number of partitions that follows the bytes of a text column."""
    total = df.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0
    return max(1, -(-int(total) // bytes_each))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``most`` bytes in each.

    A single longer value makes a slice of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(size.astype(np.int64)) - size) // most
        edges = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows]):
            yield batch.slice(int(a), int(b - a))


def words_of(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Word offsets by row (one more than rows) and all words in order; null has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(column, ""))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    full = pc.not_equal(pc.binary_length(flat), 0)
    kept = full.to_numpy(zero_copy_only=False)
    if not kept.all():  # leading or trailing white space leaves empty strings
        offsets = np.concatenate(([0], np.cumsum(kept)))[offsets]
        flat = flat.filter(full)
    return offsets, flat


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """For each word its place in the list of distinct words, and that list."""
    d = words.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over unsigned integers."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(distinct: pa.Array) -> np.ndarray:
    """A 64-bit hash of each distinct word, alike on every machine."""
    import xxhash

    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(w) for w in distinct.to_pylist()), np.uint64, len(distinct))


#: What bytes count for in hashes of words, plain and with ASCII letters lowered.
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64)
_LOWERED = _BYTES[np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)])]
_SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
_BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2 ** 64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


@dataclass
class Words:
    """The words of some texts: ``offsets`` by text, each word's hash, and where its bytes are."""

    offsets: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray


def hashed_words(texts: pa.Array, lower: bool = False) -> Words:
    """Words of each text by their bytes, with 64-bit hashes alike on every machine; null has none.

    A word's hash is a polynomial in its bytes, read off running sums.
    """
    texts = pc.fill_null(texts, "")
    _, ends, data = texts.buffers()
    rows = np.frombuffer(ends, np.int32 if pa.types.is_string(texts.type) else np.int64)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data or b"", np.uint8)[rows[0] : rows[-1]]
    rows = rows - rows[0]
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[rows] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    power, inverse = _powers(1 << max(20, (len(data) + 1).bit_length()))
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWERED if lower else _BYTES)[data] * power[: len(data)], out=run[1:])
    h = (run[ends] - run[starts]) * inverse[starts]
    return Words(np.searchsorted(starts, rows), mix(h), starts, ends, data)


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, run after run."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
