"""Recordings as a source that Spark splits: ``spark.read.format("recording")``.

A recording is cut by its bytes into pieces of ``split``, as other files are, and
each piece is a task of its own, however long the recording is. A task reads the
index of a ``bag`` (where its chunks are, which topics and times they hold) and of
these the chunks that begin in its piece; of a ``db3`` it takes its share of the
messages' row numbers. Conditions on ``topic`` and ``ts_ns`` are pushed down: chunks
without a wanted message are never read, nor rows fetched, and pieces of a ``bag`` in
which no wanted chunk begins are no tasks.

Paths are opened by tasks themselves (see ``stores``). A ``db3`` outside of local
and mounted folders, which SQLite can't open, is one piece that is held in memory,
and so is a ``bag`` that was cut off before its index was written: its chunks are
found one after another, none held but the one that is read. What can't be read is
a row with ``error`` set, as ``readers`` has it.
"""

from __future__ import annotations

import sqlite3
import struct
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from scanloom.sources import decode, stores

#: Bytes of a recording that a task reads, and of messages that go into one batch.
SPLIT = 64 << 20
BATCH = 8 << 20

MESSAGES = "path string, topic string, msg_type string, ts_ns bigint, data binary, error string"
_ARROW = pa.schema([("path", pa.string()), ("topic", pa.string()), ("msg_type", pa.string()), ("ts_ns", pa.int64()), ("data", pa.binary()), ("error", pa.string())])

Message = tuple[str, str, int, bytes]


@dataclass
class Wanted:
    """Which messages are asked for; None stands for all topics."""

    topics: set[str] | None = None
    first: int = -(1 << 63)
    last: int = (1 << 63) - 1

    def topic(self, name: str) -> bool:
        return self.topics is None or name in self.topics

    def time(self, ts: int) -> bool:
        return self.first <= ts <= self.last

    def narrowed(self, f: Filter) -> bool:
        """Take a condition over, if it is one on topic or time."""
        if f.attribute == ("topic",) and isinstance(f, (EqualTo, In)):
            names = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.topics = names if self.topics is None else self.topics & names
        elif f.attribute == ("ts_ns",) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                self.first = max(self.first, f.value + isinstance(f, GreaterThan))
            if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                self.last = min(self.last, f.value - isinstance(f, LessThan))
        else:
            return False
        return True


@dataclass
class Chunk:
    """A chunk as the index of a ``bag`` describes it."""

    at: int
    first: int
    last: int
    counts: dict[bytes, int] = field(default_factory=dict)


def _time(value: bytes) -> int:
    s, ns = struct.unpack("<II", value)
    return s * 1_000_000_000 + ns


def _record(f, at: int) -> tuple[dict[bytes, bytes], int, int]:
    """Header of the record at a place, and the place and length of its body."""
    f.seek(at)
    n = struct.unpack("<I", f.read(4))[0]
    head = decode.fields(f.read(n))
    return head, at + 8 + n, struct.unpack("<I", f.read(4))[0]


def bag_index(f) -> tuple[list[Chunk], dict[bytes, tuple[str, str]]] | None:
    """Chunks and connections (topic, type) of an open ``bag``, or None where it has no index."""
    f.seek(0)
    if f.read(len(decode.BAG)) != decode.BAG:
        raise ValueError("not a version 2.0 recording")
    head, _, _ = _record(f, len(decode.BAG))
    at = struct.unpack("<Q", head[b"index_pos"])[0] if b"index_pos" in head else 0
    if not at:
        return None
    f.seek(at)
    chunks, links = [], {}
    for head, body in decode.records(f.read()):
        if head[b"op"][0] == 7:
            links[head[b"conn"]] = decode.connection(head, body)
        elif head[b"op"][0] == 6:
            pairs = [(body[k : k + 4], struct.unpack_from("<I", body, k + 4)[0]) for k in range(0, len(body), 8)]
            chunks.append(Chunk(struct.unpack("<Q", head[b"chunk_pos"])[0], _time(head[b"start_time"]), _time(head[b"end_time"]), dict(pairs)))
    return chunks, links


def wanted_chunks(chunks: list[Chunk], links: dict[bytes, tuple[str, str]], wanted: Wanted) -> Iterator[int]:
    """Places of the chunks that by the index hold wanted messages."""
    own = {c for c, (topic, _) in links.items() if wanted.topic(topic)}
    return (c.at for c in chunks if c.first <= wanted.last and c.last >= wanted.first and own & c.counts.keys())


def bag_messages(f, size: int, low: int, high: int, wanted: Wanted) -> Iterator[Message]:
    """Wanted messages of the chunks that begin in [low, high); without an index all, where low is 0."""
    index = bag_index(f)
    links = {} if index is None else dict(index[1])
    if index is None:
        places = _unindexed(f, size) if low == 0 else iter(())
    else:
        places = (at for at in wanted_chunks(*index, wanted) if low <= at < high)
    for at in places:
        head, body, n = _record(f, at)
        f.seek(body)
        for topic, kind, ts, data in decode.chunk_messages(head, f.read(n), links):
            if wanted.topic(topic) and wanted.time(ts):
                yield topic, kind, ts, data


def _unindexed(f, size: int) -> Iterator[int]:
    at = len(decode.BAG)
    while at < size:
        head, body, n = _record(f, at)
        if head[b"op"][0] == 5 and body + n <= size:
            yield at
        at = body + n


def sqlite_messages(base: sqlite3.Connection, part: int, parts: int, wanted: Wanted) -> Iterator[Message]:
    """Wanted messages of one of ``parts`` equal ranges of row numbers."""
    names = {i: (n, t) for i, n, t in base.execute("SELECT id, name, type FROM topics") if wanted.topic(n)}
    low, high = base.execute("SELECT min(rowid), max(rowid) FROM messages").fetchone()
    if low is None or not names:
        return
    a, b = (low + (high - low + 1) * k // parts for k in (part, part + 1))
    ask = f"SELECT topic_id, timestamp, data FROM messages WHERE rowid >= ? AND rowid < ? AND timestamp BETWEEN ? AND ? AND topic_id IN ({', '.join(map(str, names))})"
    yield from ((*names[i], ts, data) for i, ts, data in base.execute(ask, (a, b, wanted.first, wanted.last)))


@dataclass
class Piece(InputPartition):
    """A part of a recording: one of ``parts`` equal ranges of its bytes."""

    path: str
    size: int
    part: int
    parts: int


class RecordingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.kind, self.split = options["path"], options.get("kind", "bag"), int(options.get("split", SPLIT))
        self.wanted = Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802  the name is Spark's
        return [f for f in filters if not self.wanted.narrowed(f)]

    def partitions(self) -> list[Piece]:
        files = [f for f in stores.files_below(self.path, f".{self.kind}") if not f[0].endswith(".orig.bag")]
        with ThreadPoolExecutor() as pool:
            out = [p for pieces in pool.map(lambda f: self.pieces(*f), files) for p in pieces]
        return out or [Piece(*f, 0, 1) for f in files[:1]]  # Spark wants one, and this has nothing that is wanted

    def pieces(self, path: str, size: int) -> list[Piece]:
        """The pieces of a recording; under a condition only those of a ``bag`` in which a wanted chunk begins."""
        whole = self.kind == "db3" and not isinstance(stores.opened(path)[0], fs.LocalFileSystem)
        parts = 1 if whole else max(1, -(-size // self.split))
        own = range(parts)
        if self.kind == "bag" and parts > 1 and self.wanted != Wanted():
            try:
                store, at = stores.opened(path)
                with store.open_input_file(at) as f:
                    index = bag_index(f)
                if index is not None:
                    own = sorted({((at + 1) * parts - 1) // size for at in wanted_chunks(*index, self.wanted) if at < size})
            except Exception:  # noqa: BLE001  the file's tasks say what is wrong with it
                pass
        return [Piece(path, size, k, parts) for k in own]

    def messages(self, piece: Piece) -> Iterator[Message]:
        store, path = stores.opened(piece.path)
        if self.kind == "bag":
            with store.open_input_file(path) as f:
                low, high = (piece.size * k // piece.parts for k in (piece.part, piece.part + 1))
                yield from bag_messages(f, piece.size, low, high, self.wanted)
            return
        local = isinstance(store, fs.LocalFileSystem)
        base = sqlite3.connect(f"file:{quote(path)}?mode=ro&immutable=1" if local else ":memory:", uri=local)
        try:
            if not local:
                with store.open_input_file(path) as f:
                    base.deserialize(f.read())
            yield from sqlite_messages(base, piece.part, piece.parts, self.wanted)
        finally:
            base.close()

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        held: list[Message] = []
        size = 0

        def batch() -> pa.RecordBatch:
            columns = list(zip(*held))
            own = [pa.array(c, f.type) for c, f in zip(columns, list(_ARROW)[1:5])]
            return pa.RecordBatch.from_arrays([pa.array([partition.path] * len(held)), *own, pa.nulls(len(held), pa.string())], schema=_ARROW)

        try:
            for m in self.messages(partition):
                held.append(m)
                size += len(m[3] or b"")
                if size > BATCH:
                    yield batch()
                    held, size = [], 0
            if held:
                yield batch()
        except Exception as e:  # noqa: BLE001  the row says so
            if held:
                yield batch()
            yield pa.RecordBatch.from_pylist([{"path": partition.path, "error": f"{type(e).__name__}: {e}"}], schema=_ARROW)


class RecordingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recording"

    def schema(self) -> str:
        return MESSAGES

    def reader(self, schema) -> RecordingReader:
        return RecordingReader(dict(self.options))


def messages(spark: SparkSession, path: str, kind: str = "bag", split: int = SPLIT) -> DataFrame:
    """(path, topic, msg_type, ts_ns, data, error) of the recordings below a path; filter it by topic and time."""
    spark.dataSource.register(RecordingSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("recording").option("kind", kind).option("split", split).load(path)
