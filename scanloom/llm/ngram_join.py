"""Near-duplicate join on word n-grams by an index of count vectors.

A document is the set of its distinct shingles. Two sets of sizes p and q link at
Jaccard similarity t if they differ in at most ``(p + q) * (1 - t) / (1 + t)``
shingles. Shingles are hashed into groups, and a document is the point of its
group counts. The index is a tree of such points: slabs by the sum of the
coordinates (bands of set sizes, a document near a slab's end lies in both), cells
by blocks of coordinates, and in a cell boxes of points.

A query box at radius D around a point can't be cut into few cells in all
coordinates at once, for at these thresholds all points of a slab lie in each
other's boxes; but with more than D blocks, two points within D agree in some
block, so a document is filed under the exact counts of its blocks. Blocks are put
in one order, the rarest first, by a sketch of how often each occurs; of two
documents that link both have the first block on which they agree among their
first D + 1, so only these are filed, and none that occurs once.

In each cell the members are first paired with one of them, the one that shares
most. Those that stay apart from their cell's largest component are compared with
it, and then with each other, in tasks of bounded chunks: a tree of a chunk's
points halves the coordinate of greatest spread, with the greatest counts of each
branch as the corner of its box; summed coordinate minima with a corner bound the
overlap with all points below, those with a point that with it alone, and pairs
that survive are verified on the sets there. Only links that join two components
leave a task, so that groups of near copies don't make all their pairs; no link
between different components is skipped.

Sets are told apart by 64-bit digests of 64-bit shingle hashes.

Defined cases. A null or empty text is an empty set without links. With fewer
words than ``n`` the sequence is one shingle. Rows without an id have no links
and no component. Rows of one id are one document: what any of its texts links to
is linked through it. A row without words is linked with nothing, whatever its id.
Repeated rows give repeated results. Extra columns are not read. Results don't hang on the order of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import bitmap, gathered, hashed_words, in_bitmap, likely, mix, settled, slices
from scanloom.llm.components import components

BATCH_BYTES = 1 << 20

#: Ratio of a band's ends, coordinates of a block, blocks for each one needed.
BAND, COORDINATES, SPARE = 1.5, 1 << 16, 1.3

#: Shingles in a group of the bound, at most on average; there are a power of two of groups, and 64 at least.
EACH = 2

#: Levels of a block's frequency: occurrences from which on, bits of the sketch, weight.
LEVELS = ((2, 1 << 27, 1), (8, 1 << 25, 8), (64, 1 << 23, 64))

#: Parts in which blocks are counted, one after the other, so that a part's rows alone are on disk.
PARTS = 4

#: Repeated blocks that one sketch is for; where there are more, slabs are dealt to up to so many sketches. Where a key has its slab's number modulo that.
SKETCHED, SKETCHES, SLAB_BIT = 1 << 24, 8, 28

#: Members of a cell that one task compares with as many others, and those of a leaf.
CHUNK, LEAF = 512, 16


@dataclass(frozen=True)
class Similarity:
    """Links at ``den * |A & B| >= num * |A | B|``, sets of ``n``-word shingles.

    Not below 2/3: sets that differ more in size lie further apart than in
    neighbouring bands, where they wouldn't meet.
    """

    n: int = 5
    num: int = 80
    den: int = 100

    def __post_init__(self):
        if self.num * BAND < self.den or self.num > self.den or self.n < 1:
            raise ValueError(f"a similarity from {1 / BAND:.3f} to 1, of shingles of one word at least")

    def most(self, total):
        """The most shingles in which two sets of ``total`` shingles together may differ."""
        return total * (self.den - self.num) // (self.den + self.num)

    def bands(self) -> np.ndarray:
        """Lower ends of the bands of set sizes; below the first only equal sets link."""
        low = 1
        while self.most(2 * low + 1) == 0:
            low += 1
        ends = [low]
        while ends[-1] < 1 << 40:
            ends.append(max(ends[-1] + 1, int(ends[-1] * BAND)))
        return np.array(ends, np.int64)


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets by text and, text by text, its distinct shingles as ascending 64-bit hashes."""
    words = hashed_words(texts, lower=True)
    offsets, word = words.offsets, words.hashes
    size = np.diff(offsets)
    count = np.where(size == 0, 0, np.maximum(size - n + 1, 1))
    at = gathered(offsets[:-1], count)
    length = np.minimum(np.repeat(size, count), n)
    h = length.astype(np.uint64)
    for k in range(n):
        nxt = mix(h * np.uint64(0x9E3779B97F4A7C15) + word[np.minimum(at + k, max(len(word) - 1, 0))]) if len(word) else h
        h = np.where(k < length, nxt, h)
    doc = np.repeat(np.arange(len(size)), count)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return np.concatenate(([0], np.cumsum(np.bincount(doc[new], minlength=len(size))))), h[new]


def _blocks(like: Similarity, top: np.ndarray) -> np.ndarray:
    """Blocks in the slab that ends at size ``top``."""
    return np.ceil((like.most(2 * top) + 1) * SPARE).astype(np.int64) + 1


def _needed(like: Similarity, size: np.ndarray, top: np.ndarray) -> np.ndarray:
    """How many blocks a set of ``size`` files in that slab: one more than it may differ in."""
    return like.most(size + np.minimum(size * like.den // like.num, top)) + 1


def _cells(like: Similarity, offsets: np.ndarray, sets: np.ndarray, docs: np.ndarray, band: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many blocks each of ``docs`` has in the slab ``band``, and the cell key of every block."""
    blocks = _blocks(like, ends[band + 1] - 1)
    size = np.diff(offsets)[docs]
    h = sets[gathered(offsets[docs], size)]
    row = np.repeat(np.arange(len(docs)), size)
    first = np.cumsum(blocks) - blocks
    place = first[row] + (mix(h ^ np.uint64(0x5851F42D4C957F2D)) % blocks.astype(np.uint64)[row]).astype(np.int64)
    total = int(blocks.sum())
    counts = np.bincount(place, minlength=total)
    # A linear hash of the block's count vector: each coordinate adds its own random number.
    coordinate = mix(mix(h ^ np.uint64(0x14057B7EF767814F)) % np.uint64(COORDINATES) + np.uint64(77))
    vector = np.zeros(total, np.uint64)
    np.add.at(vector, place, coordinate)
    owner = np.repeat(np.arange(len(docs)), blocks)
    number = np.arange(total) - first[owner]
    key = mix(vector + mix(np.uint64(1 << 50) * band.astype(np.uint64)[owner] + number.astype(np.uint64)) + counts.astype(np.uint64))
    key = key & ~np.uint64(SKETCHES - 1 << SLAB_BIT) | (band % SKETCHES).astype(np.uint64)[owner] << np.uint64(SLAB_BIT)
    return blocks, key.view(np.int64)


def digests(offsets: np.ndarray, sets: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each set: the sum of its shingles' second hashes."""
    n = np.diff(offsets)
    d = np.zeros(len(n), np.uint64)
    np.add.at(d, np.repeat(np.arange(len(n)), n), mix(sets + np.uint64(0xD1B54A32D192ED03)))
    return mix(d + n.astype(np.uint64)).view(np.int64)


def points(docs: DataFrame, like: Similarity) -> DataFrame:
    """(doc_id, n, node, own, up): set size, digest of the set, and cells of all blocks in its slab and in the next."""
    ends = like.bands()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()  # sets whose cells this task has given already
        for batch in slices(batches, "text", BATCH_BYTES):
            offsets, sets = shingle_sets(batch.column("text"), like.n)
            n, rows = np.diff(offsets), batch.num_rows
            node = digests(offsets, sets)
            band = np.searchsorted(ends, n, side="right") - 1
            new = np.zeros(rows, bool)
            # Rows without an id stand for no set.
            for k in np.flatnonzero(batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False) & (n > 0)).tolist():
                if int(node[k]) not in met:
                    met.add(int(node[k]))
                    new[k] = True
            lists = []
            # Near its upper end a document lies in the next slab too, and just below the first slab in the first.
            for which, up in ((new & (band >= 0), 0), (new & (n * like.den >= ends[band + 1] * like.num), 1)):
                own = np.flatnonzero(which)
                blocks, key = _cells(like, offsets, sets, own, band[own] + up, ends)
                size = np.zeros(rows + 1, np.int32)
                size[own + 1] = blocks
                lists.append(pa.ListArray.from_arrays(pa.array(np.cumsum(size, dtype=np.int32)), pa.array(key)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(node), *lists], names=["doc_id", "n", "node", "own", "up"])

    return docs.select("doc_id", "text").mapInArrow(found, "doc_id long, n long, node long, own array<bigint>, up array<bigint>")


def slab_of(key):
    """The number of a key's slab modulo ``SKETCHES``; of a column."""
    return F.shiftright(key, SLAB_BIT).bitwiseAND(F.lit(SKETCHES - 1))


def frequencies(every: DataFrame) -> list[DataFrame]:
    """(key, c) of the blocks that occur again, settled part by part."""
    key = every.select(F.explode(F.concat("own", "up")).alias("key"))
    found = []
    for k in range(PARTS):
        part = key.filter(F.pmod(F.shiftright("key", 48), F.lit(PARTS)) == k)
        found.append(settled(part.groupBy("key").agg(F.count("*").alias("c")).filter(F.col("c") > 1), "frequencies"))
    return found


def filed(every: DataFrame, counted: DataFrame, like: Similarity, group: int = 0, groups: int = 1) -> DataFrame:
    """(key, node, weight) of the blocks that each set files: of its rarest ones those that occur again.

    How often blocks occur, ``counted`` (key, c), goes to the tasks as maps of bits of bounded size, one
    for each level. Where they fill up, blocks only pass as more frequent ones;
    any order that is alike for all documents finds every link. Only slabs of ``group``
    are filed, one of ``groups`` (a divisor of ``SKETCHES``), and the maps are theirs.
    """
    ends = like.bands()
    mine = lambda key: slab_of(key) % groups == group
    counted = counted.filter(mine(F.col("key")))
    # A list is of one slab, as its first key says.
    known = every.select("n", "node", *(F.when(mine(F.get(c, F.lit(0))), F.col(c)).alias(c) for c in ("own", "up"))).filter(F.col("own").isNotNull() | F.col("up").isNotNull())
    sketch = every.sparkSession.sparkContext.broadcast([bitmap(counted.filter(F.col("c") >= least), "key", bits) for least, bits, _ in LEVELS])
    weights = np.cumsum([0, *(w for _, _, w in LEVELS)])

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, node = (batch.column(c).to_numpy() for c in ("n", "node"))
            band = np.searchsorted(ends, size, side="right") - 1
            weight, parts = np.zeros(len(size), np.int64), []
            for name, up in (("own", 0), ("up", 1)):
                lists = batch.column(name)
                edges = lists.offsets.to_numpy()
                key, row = lists.values.to_numpy()[edges[0] : edges[-1]], np.repeat(np.arange(len(size)), np.diff(edges))
                left = _needed(like, size, ends[band + 1 + up] - 1)
                again = np.flatnonzero(in_bitmap(sketch.value[0], key))
                # Blocks that occur once come first in the order, and nobody else files them.
                left -= np.diff(edges) - np.bincount(row[again], minlength=len(size))
                key, row = key[again], row[again]
                level = np.ones(len(key), np.int64)
                for k, bits in enumerate(sketch.value[1:], 2):
                    some = np.flatnonzero(level == k - 1)
                    level[some[in_bitmap(bits, key[some])]] = k
                np.add.at(weight, row, weights[level])
                some = np.flatnonzero(left[row] > 0)
                key, row, level = key[some], row[some], level[some]
                order = np.lexsort((key, level, row))
                key, row = key[order], row[order]
                kept = np.arange(len(row)) - np.searchsorted(row, row) < left[row]
                parts.append((key[kept], row[kept]))
            key, row = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(node[row]), pa.array(weight[row])], names=["key", "node", "weight"])

    return known.mapInArrow(passing, "key long, node long, weight long").distinct()


def sets_of(docs: DataFrame, ids: DataFrame, nodes: DataFrame, like: Similarity) -> DataFrame:
    """(node, groups, s) of the sets ``nodes``: counts for the bound and ascending shingles. The texts of ``ids`` alone are read again."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            offsets, sets = shingle_sets(batch.column("text"), like.n)
            n = np.diff(offsets)
            size = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(n, 1) / EACH)).astype(np.int64).clip(0))
            first, row = np.cumsum(size) - size, np.repeat(np.arange(len(n)), n)
            group = first[row] + (mix(sets ^ np.uint64(0x2545F4914F6CDD1D)) & (size[row] - 1).astype(np.uint64)).astype(np.int64)
            data = np.bincount(group, minlength=int(size.sum())).astype("<u2")
            yield pa.RecordBatch.from_pydict({
                "node": digests(offsets, sets), "groups": pa.array([data[a : a + m].tobytes() for a, m in zip(first.tolist(), size.tolist())], pa.binary()),
                "s": pa.array([sets[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], pa.binary()),
            })

    texts = likely(docs.select("doc_id", "text"), ids, "doc_id").join(ids, "doc_id", "left_semi")
    # An id may have several texts, and other rows the same set.
    return texts.mapInArrow(found, "node long, groups binary, s binary").join(nodes, "node", "left_semi").groupBy("node").agg(F.first("groups").alias("groups"), F.first("s").alias("s"))


def folded(counts: bytes, size: int) -> np.ndarray:
    """Counts of ``size`` groups from those of a multiple: groups are hashes modulo a power of two."""
    return np.frombuffer(counts, "<u2").reshape(-1, size).sum(axis=0, dtype=np.int32)


def linked(x: bytes, y: bytes, like: Similarity) -> bool:
    """Whether two sets link, by their ascending shingles."""
    both = np.concatenate((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)))
    both.sort(kind="stable")
    same = int(np.count_nonzero(both[1:] == both[:-1]))
    return like.den * same >= like.num * (len(both) - same)


def starred(members: DataFrame, sets: DataFrame, like: Similarity) -> DataFrame:
    """Links (a, b) of each cell's members to the one of most weight."""
    best = members.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("best")).select("key", F.col("best.node").alias("hub"))
    pairs = members.join(best, "key").filter(F.col("node") != F.col("hub")).select("hub", "node").distinct()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for g, x, h, y in zip(*(batch.column(c).to_pylist() for c in ("groups", "s", "h", "t"))):
                size, both = min(len(g), len(h)) // 2, (len(x) + len(y)) // 8
                bound = int(np.minimum(folded(g, size), folded(h, size)).sum())
                ok.append(like.den * bound >= like.num * (both - bound) and linked(x, y, like))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    of_hub = sets.select(F.col("node").alias("hub"), F.col("groups").alias("h"), F.col("s").alias("t"))
    rows = pairs.join(of_hub, "hub").join(sets, "node").select(F.col("node").alias("a"), F.col("hub").alias("b"), "groups", "s", "h", "t")
    return rows.mapInArrow(check, "a long, b long")


class Boxes:
    """A tree over points of group counts: branches halve the coordinate of greatest spread."""

    def __init__(self, counts: np.ndarray, size: np.ndarray):
        self.counts, self.size = counts, size
        self.corner: list[np.ndarray] = []
        self.least: list[int] = []
        self.below: list[tuple[int, int] | np.ndarray] = []
        self._grow(np.arange(len(counts)))

    def _grow(self, rows: np.ndarray) -> int:
        at, c = len(self.below), self.counts[rows]
        self.corner.append(c.max(axis=0))
        self.least.append(int(self.size[rows].min()))
        self.below.append(rows)
        if len(rows) > LEAF and (spread := self.corner[at] - c.min(axis=0)).any():
            order = rows[np.argsort(c[:, int(spread.argmax())], kind="stable")]
            self.below[at] = (self._grow(order[: len(order) // 2]), self._grow(order[len(order) // 2 :]))
        return at

    def near(self, counts: np.ndarray, size: int, like: Similarity) -> np.ndarray:
        """The points whose summed coordinate minima with ``counts`` allow a link."""
        out, todo = [], [0]
        while todo:
            # |A & B| is at most the summed minima, and |A | B| the rest of both.
            bound = np.minimum(np.stack([self.corner[k] for k in todo]), counts).sum(axis=1)
            ok = like.den * bound >= like.num * (size + np.array([self.least[k] for k in todo]) - bound)
            kept = [self.below[k] for k, yes in zip(todo, ok.tolist()) if yes]
            out += [x for x in kept if isinstance(x, np.ndarray)]
            todo = [c for x in kept if isinstance(x, tuple) for c in x]
        rows = np.concatenate(out) if out else np.zeros(0, np.int64)
        bound = np.minimum(self.counts[rows], counts).sum(axis=1)
        return rows[like.den * bound >= like.num * (size + self.size[rows] - bound)]


def spanning(node: np.ndarray, component: np.ndarray, groups: list[bytes], sets: list[bytes], left: np.ndarray, right: np.ndarray, like: Similarity) -> list[tuple[int, int]]:
    """Links between members ``left`` and ``right`` (which may be alike) that join different components."""
    size = min(map(len, groups)) // 2
    counts, n = np.stack([folded(g, size) for g in groups]), np.array([len(s) // 8 for s in sets])
    tree, parent = Boxes(counts[right], n[right]), {c: c for c in component.tolist()}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    out = []
    for x in left.tolist():
        near = right[tree.near(counts[x], int(n[x]), like)]
        near = near[(component[near] != component[x]) & ((near > x) | (left is not right))]
        for y in near.tolist():
            a, b = root(int(component[x])), root(int(component[y]))
            if a != b and linked(sets[x], sets[y], like):
                parent[a] = b
                out.append((int(node[x]), int(node[y])))
    return out


def compared(rows: DataFrame, sets: DataFrame, like: Similarity) -> DataFrame:
    """Links (a, b) between members of a group (key, node, component, inner) of different components.

    Those that aren't ``inner`` are compared with all that are, or with each other
    where none is. Groups of any size are dealt into chunks; each pair of chunks
    that has to meet is one task's work.
    """
    chunks = {n: F.ceil(F.count_if(c) / F.lit(CHUNK)).cast("long").alias(n) for n, c in (("of_x", ~F.col("inner")), ("of_y", F.col("inner")))}
    rows = rows.join(rows.groupBy("key").agg(*chunks.values()), "key")
    c = F.pmod(F.xxhash64("node"), F.when(F.col("inner"), F.col("of_y")).otherwise(F.col("of_x")))
    over = lambda n, cell: F.transform(F.sequence(F.lit(0).cast("long"), F.col(n) - 1), lambda k: F.struct(*(x.alias(n) for x, n in zip(cell(k), "ij"))))
    cells = F.when(F.col("inner"), over("of_x", lambda k: (k, F.col("of_x") + F.col("chunk")))).when(F.col("of_y") > 0, over("of_y", lambda k: (F.col("chunk"), F.col("of_x") + k)))
    cells = cells.otherwise(over("of_x", lambda k: (F.least(k, "chunk"), F.greatest(k, "chunk"))))
    rows = rows.withColumn("chunk", c).select("key", "node", "component", (F.col("chunk") + F.when(F.col("inner"), F.col("of_x")).otherwise(0)).alias("part"), cells.alias("cells"))
    rows = rows.select("key", "node", "component", "part", F.explode("cells").alias("cell")).select("key", "node", "component", "part", "cell.i", "cell.j")

    def compare(t: pa.Table) -> pa.Table:
        node, component, part = (t.column(x).to_numpy() for x in ("node", "component", "part"))
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        left = np.flatnonzero(part == i)
        right = left if i == j else np.flatnonzero(part == j)
        found = spanning(node, component, t.column("groups").to_pylist(), t.column("s").to_pylist(), left, right, like) if len(left) and len(right) else []
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return rows.join(sets, "node").groupBy("key", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def cells(every: DataFrame, like: Similarity) -> DataFrame:
    """(key, node, weight) of the members of each cell that has several; settled.

    No more is on disk at once than ``every``, the repeated blocks, and a part's rows.
    """
    parts = frequencies(every)
    counted = reduce(DataFrame.unionByName, parts)
    groups, number = 1, counted.count()
    while groups < SKETCHES and number > groups * SKETCHED:
        groups *= 2
    found = []
    for k in range(groups):
        own = settled(filed(every, counted, like, k, groups), "filed", *(parts if k == groups - 1 else ()))
        shared = own.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > 1).select("key")
        found.append(settled(own.join(shared, "key"), "cells", own))
    return found[0] if groups == 1 else settled(reduce(DataFrame.unionByName, found), "cells", *found)


def links(docs: DataFrame, every: DataFrame, members: DataFrame, like: Similarity) -> DataFrame:
    """(a, b): links between different sets, enough of them to join all that hang together, by the ``members`` of cells."""
    nodes = members.select("node").distinct()
    ids = every.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    ids = settled(ids, "ids")
    sets = settled(sets_of(docs, ids, nodes, like), "sets", ids)
    star = settled(starred(members, sets, like), "links-found")
    parts = components(star)

    # Cells whose members are still apart: all but those of the cell's largest component are compared
    # with that component, which is one group for all its cells, ...
    apart = members.join(parts, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    mixed = apart.groupBy("key", "component").agg(F.count("*").alias("c")).groupBy("key").agg(F.max(F.struct("c", "component")).alias("most"), F.count("*").alias("parts"))
    mixed = mixed.filter(F.col("parts") > 1).select("key", F.col("most.component").alias("large"))
    apart_rows = rest = settled(apart.join(mixed, "key").filter(F.col("component") != F.col("large")), "rest")
    asked = rest.select(F.col("large").alias("key"), "node", "component", F.lit(False).alias("inner")).distinct()
    whole = apart.select(F.col("component").alias("key"), "node", "component", F.lit(True).alias("inner")).distinct().join(asked.select("key").distinct(), "key", "left_semi")
    with_large = settled(compared(asked.unionByName(whole), sets, like), "links-found")
    parts = components(star.unionByName(with_large))

    # ... and then with each other. Near copies share many cells with the same members; one of those cells is enough.
    rest = rest.select("key", "node").join(parts, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    same = [F.bit_xor(F.xxhash64("node", F.lit(k))).alias(f"s{k}") for k in range(2)]
    mixed = rest.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("c"), *same)
    mixed = mixed.filter(F.col("low") < F.col("high")).groupBy("c", "s0", "s1").agg(F.min("key").alias("key")).select("key")
    among = settled(compared(rest.join(mixed, "key").withColumn("inner", F.lit(False)), sets, like), "links-found", apart_rows, members, sets, star, with_large)
    return parts.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(among)


def near_duplicates(docs: DataFrame, like: Similarity = Similarity()) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of (doc_id, text)."""
    every = settled(points(docs, like), "points")
    members = cells(every, like)
    # The keys of all blocks are most of what is on disk, and nothing needs them any more.
    every = settled(every.select("doc_id", "n", "node"), "digests", every)
    known = every.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0)).select("doc_id", "node")
    found = links(docs, every, members, like)
    # Where an id has several texts, they hang together through it.
    several = known.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("high")).filter(F.col("b") < F.col("high"))
    found = components(found.unionByName(known.join(several.select("doc_id", "b"), "doc_id").select(F.col("node").alias("a"), "b")))
    found = found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
    classes = known.groupBy("node").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last"))
    classes = classes.join(found, "node", "left").filter((F.col("least") < F.col("last")) | F.col("component").isNotNull())
    classes = classes.select("node", "least", F.coalesce("component", "node").alias("component"))
    label = classes.join(classes.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("node", "component_id")
    # A set that many rows share meets its label in a join of two tables, which Spark can split.
    label = settled(label, "labels")
    out = every.select("doc_id", F.col("n").alias("n_shingles"), "node").join(label, "node", "left")
    # A row without an id is in nobody's component.
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
