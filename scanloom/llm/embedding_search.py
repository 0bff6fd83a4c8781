"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors of integers are split into shards. In a shard every dimension's values
are shifted to non-negative impacts, for a query's sign by the dimension's least
or greatest value, and kept as planes of bits: the postings of a segment (a
dimension and a plane) are the vectors whose impact has that bit. Segments are
processed by descending impact, one plane of all dimensions at a time, into
accumulators; the topmost planes, which alone prove nothing, go in one product.
After a plane the impact still to come is at most the sum of
``|q| * (2 ** planes left - 1)``. Each query stops by itself, and only on proof:
when the vectors whose accumulator plus that bound reaches the k-th accumulator
are few. Those are scored exactly from their whole vectors.

How many planes that takes hangs on the data. Components of like size leave every
row possible until the bound is less than what sets the best apart, which is late;
``Shard.processed`` over ``Shard.whole`` is the share of impacts that was needed.

Defined cases. A vector that is null, or has a null or non-finite component,
takes no part. Shorter vectors count as filled up with zeros. Ties go to the
smaller id. A repeated id is a row of its own, and a query of its own where its
vector differs, but no row is a candidate for a query of its own id. Scores beyond a long stop at its ends, and tie there. An empty table gives
no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows in a shard of the index, and queries in a block.
SHARD_ROWS = 16_384
QUERY_ROWS = 2_048

#: Queries that share one pass over a shard.
TOGETHER = 128

#: Planes that are left when queries may stop for the first time.
FIRST = 4

#: Whole products stay exact in doubles below this.
EXACT = float(1 << 53)


def integers(vector: Column) -> Column:
    """floor(64 * x) of each component, or null for a vector that takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * 64).cast("double")))


def _matrix(column: pa.Array, wide: int) -> np.ndarray:
    out = np.zeros((len(column), wide))
    size = np.diff(column.offsets.to_numpy())
    flat = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()]
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


class Shard:
    """The impact-ordered index over some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.low, self.high = self.vectors.min(axis=0), self.vectors.max(axis=0)
        self.top = int((self.high - self.low).max(initial=0)).bit_length()
        self.processed = self.whole = 0  # planes of queries
        small = np.uint64 if self.top > 32 else np.uint32
        # Planes of the impacts for queries that are positive in a dimension, and for negative ones.
        self.up, self.down = (self.vectors - self.low).astype(small), (self.high - self.vectors).astype(small)

    def planes(self, first: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        """The part of the impacts in planes first, first + 1, ..., as numbers."""
        mask = self.up.dtype.type(((1 << count) - 1) << first)
        return (self.up & mask).astype(np.float64), (self.down & mask).astype(np.float64)

    def search(self, own: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query number, ids, scores) of each query's k best rows of the shard."""
        pos, neg = np.maximum(queries, 0), np.maximum(-queries, 0)
        n, active = len(self.ids), np.arange(len(queries) if len(self.ids) > k else 0)
        acc = np.zeros((len(active), n))
        candidates: list[np.ndarray | None] = [None] * len(queries)
        left, step = self.top, max(1, self.top - FIRST)
        while left > 0 and len(active):
            count = min(step, left)
            left -= count
            step = 1
            up, down = self.planes(left, count)
            acc += pos[active] @ up.T + neg[active] @ down.T
            self.processed += len(active) * count
            acc[own[active][:, None] == self.ids[None, :]] = -np.inf
            to_come = (pos[active] + neg[active]).sum(axis=1) * ((1 << left) - 1)
            possible = acc + to_come[:, None] >= np.partition(acc, n - k, axis=1)[:, [n - k]]
            few = (possible.sum(axis=1) <= max(4 * k, n // 64)) | (left == 0)
            for m in np.flatnonzero(few).tolist():
                candidates[active[m]] = np.flatnonzero(possible[m])
            active, acc = active[~few], acc[~few]
        self.whole += len(queries) * self.top
        for q in range(len(queries)):
            rows = np.arange(n) if candidates[q] is None else candidates[q]
            rows = rows[self.ids[rows] != own[q]]
            score = self.vectors[rows] @ queries[q]
            best = np.lexsort((self.ids[rows], -score))[:k]
            yield q, self.ids[rows[best]], score[best]


def _plain_search(ids: np.ndarray, vectors: np.ndarray, own: np.ndarray, queries: np.ndarray, k: int):
    """The same for components so large that doubles don't hold their products: whole numbers in Python."""
    rows = [[int(x) for x in v] for v in vectors]
    for q in range(len(queries)):
        query = [int(x) for x in queries[q]]
        stopped = ((min(max(sum(a * b for a, b in zip(query, v)), -(1 << 63)), (1 << 63) - 1), int(i)) for i, v in zip(ids, rows) if i != own[q])
        scores = sorted(stopped, key=lambda s: (-s[0], s[1]))[:k]
        yield q, [i for _, i in scores], [s for s, _ in scores]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query (vec_id, v) its k best rows of (vec_id, v) but itself.

    ``v`` are whole numbers as doubles. Each pair of a query block and a shard
    meets in one task of bounded size; the best of all shards are merged.
    """
    n, wide, q = *vectors.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first(), queries.count()
    wide = max(int(wide), int(queries.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]), 1)
    shards, blocks = max(1, -(-n // SHARD_ROWS)), max(1, -(-q // QUERY_ROWS))
    deal = lambda of, count: F.pmod(F.xxhash64("vec_id", "v"), F.lit(count)).alias(of)
    everywhere = lambda of, count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))).alias(of)
    rows = vectors.select(deal("shard", shards), everywhere("block", blocks), "vec_id", "v")
    asked = queries.select(everywhere("shard", shards), deal("block", blocks), "vec_id", "v", F.xxhash64("v").alias("key"))

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "key": [], "vec_id": [], "score": []}
        if a.num_rows and b.num_rows:
            ids, own, keys = a.column("vec_id").to_numpy(), b.column("vec_id").to_numpy(), b.column("key").to_numpy()
            base, query = (_matrix(t.column("v").combine_chunks(), wide) for t in (a, b))
            far = 2 * np.abs(base).max(initial=0) * np.abs(query).max(initial=0) * wide
            index = Shard(ids, base) if far < EXACT else None
            for at in range(0, len(own), TOGETHER):
                part = own[at : at + TOGETHER], query[at : at + TOGETHER]
                for m, found, score in index.search(*part, k) if index else _plain_search(ids, base, *part, k):
                    out["query_id"].append(np.full(len(found), part[0][m]))
                    out["key"].append(np.full(len(found), keys[at + m]))
                    out["vec_id"].append(np.asarray(found, np.int64))
                    out["score"].append(np.asarray(score, np.int64))
        return pa.table({c: pa.array(np.concatenate(v) if v else [], pa.int64()) for c, v in out.items()})

    best = rows.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(cell, "query_id long, key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(table: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """Queries are the rows of (vec_id, embedding) whose id ``every`` divides; candidates are all rows."""
    v = table.select("vec_id", integers(F.col("embedding")).alias("v")).filter(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
    return top_k(v, v.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"]), k)
