"""Sliding frame windows, samples of fixed size, padding and offsets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType
from pyspark.sql.window import Window


#: Frame numbers in a block of a sequence.
BLOCK = 1 << 16


def frame_windows(frames: DataFrame, seq: str, order: str, n: int, carry: Sequence[str], block: int = BLOCK) -> DataFrame:
    """Every ``n`` consecutive frames of a sequence, one row a window, as an array of structs.

    A sequence whose frames are numbers is cut into blocks of ``block`` numbers.
    Each block gets the ``n`` - 1 frames that follow it, be they in the next block
    or, where that has fewer, in those behind, and makes its windows by itself;
    what goes over edges is a short list a block.
    """
    kind = frames.schema[order].dataType
    own = frames.select(seq, order, *(c for c in carry if c not in (seq, order)))
    frame = F.struct(order, *carry)
    by = [seq]
    if n > 1 and isinstance(kind, NumericType):
        own = own.withColumn("_b", F.floor(F.col(order) / F.lit(block))).withColumn("_halo", F.lit(False))
        place = F.row_number().over(Window.partitionBy(seq, "_b").orderBy(order))
        heads = own.withColumn("_k", place).filter(F.col("_k") < n).groupBy(seq, "_b").agg(F.collect_list(F.struct("_k", F.struct(*own.columns).alias("f"))).alias("_h"))
        heads = heads.withColumn("_h", F.array_sort("_h", lambda a, b: a["_k"] - b["_k"]))
        following = heads.select("_b", F.collect_list("_h").over(Window.partitionBy(seq).orderBy("_b").rowsBetween(1, n - 1)).alias("_n"))
        halo = following.select("_b", F.explode(F.slice(F.flatten("_n"), 1, n - 1)).alias("_h"))
        edge = halo.select(*(F.col("_b") if c == "_b" else F.lit(True).alias(c) if c == "_halo" else F.col(f"_h.f.{c}").alias(c) for c in own.columns))
        own, by = own.unionByName(edge), [seq, "_b"]
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(0, n - 1)
    rows = own.withColumn("window", F.collect_list(frame).over(w)).filter(F.size("window") == n)
    return (rows.filter(~F.col("_halo")) if "_halo" in rows.columns else rows).select(seq, F.col(order).alias("first"), "window")


def relative_time(windows: DataFrame, keep: Sequence[str], n: int) -> DataFrame:
    """Frames of windows with their position and time in [0, 1]; null for windows of one frame."""
    out = windows.select(*keep, F.posexplode("window").alias("pos", "frame"))
    return out.withColumn("t", F.try_divide(F.col("pos").cast("double"), F.lit(float(n - 1))))


def offsets(counts: DataFrame, order: str, count: str, by: Sequence[str] = (), block: int | Column = 1 << 16) -> DataFrame:
    """Exclusive (start) and inclusive (end) running sums of counts, in blocks of ``order``'s values.

    A block is that many whole numbers, or a column that never falls as ``order`` rises.
    """
    rows = counts.withColumn("_b", block if isinstance(block, Column) else F.floor(F.col(order) / F.lit(block)))
    sums = rows.groupBy(*by, "_b").agg(F.sum(count).alias("_s"))
    base = sums.select(*by, "_b", (F.sum("_s").over(Window.partitionBy(*by).orderBy("_b")) - F.col("_s")).alias("_base"))
    run = F.sum(count).over(Window.partitionBy(*by, "_b").orderBy(order))
    rows = rows.withColumn("_run", run).join(base, [*by, "_b"])
    return rows.withColumn("end", F.col("_base") + F.col("_run")).withColumn("start", F.col("end") - F.col(count)).drop("_b", "_run", "_base")


def sample_fixed(rows: DataFrame, by: Sequence[str], key: Column, n: int) -> DataFrame:
    """At most ``n`` rows of each group, those of the least ``key``."""
    w = Window.partitionBy(*by).orderBy(key)
    return rows.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def ranked(rows: DataFrame, by: Sequence[str], order: str, name: str) -> DataFrame:
    """Add the place of each row in its group, from 0."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1)


def pad(rows: DataFrame, by: str, order: str, n: int, fill: dict[str, object]) -> DataFrame:
    """Exactly ``n`` rows of each group: the first ones in order, then filled ones."""
    place = rows.withColumn("slot", F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1).filter(F.col("slot") < n)
    slots = rows.select(by).distinct().withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    out = slots.join(place.select(by, "slot", *fill), [by, "slot"], "left")
    return out.select(by, "slot", *(F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in fill.items()))


def batch_ids(rows: DataFrame, by: str, block: int = 1 << 16) -> DataFrame:
    """Dense number of each group in the order of its key; groups are ordered in blocks of keys, strings by their first two letters."""
    groups = rows.select(by).distinct().withColumn("_one", F.lit(1))
    blocks = F.substring(by, 1, 2) if rows.schema[by].dataType.simpleString() == "string" else block
    return rows.join(offsets(groups, by, "_one", block=blocks).select(by, F.col("start").alias("batch_id")), by)


def lagged(rows: DataFrame, by: Sequence[str], order: str, value: str, n: int, block: int | None = None) -> DataFrame:
    """``value`` of the frame ``n`` before, null for the first ``n``.

    With ``block``, for a sequence too long for one task, rows are ordered in
    blocks of that many values of the whole number ``order``; a block's last
    ``n`` rows are handed on, through blocks that have fewer.
    """
    if block is None:
        return rows.withColumn("previous", F.lag(value, n).over(Window.partitionBy(*by).orderBy(order)))
    dealt = rows.withColumn("_block", F.floor(F.col(order) / F.lit(block)))
    count = dealt.groupBy(*by, "_block").agg(F.count("*").alias("_n"))
    start = count.withColumn("_start", F.sum("_n").over(Window.partitionBy(*by).orderBy("_block")) - F.col("_n")).drop("_n")
    place = F.col("_start") + F.row_number().over(Window.partitionBy(*by, "_block").orderBy(order))
    placed = dealt.join(start, [*by, "_block"]).withColumn("_at", place).drop("_start", "_block")
    before = placed.select(*by, (F.col("_at") + n).alias("_at"), F.col(value).alias("previous"))
    return placed.join(before, [*by, "_at"], "left").drop("_at")


def residual(current: Column, previous: Column, low: float, high: float) -> Column:
    """|c - p| / c of two pixel arrays where both are in range, else 0; all 0 without a previous frame."""
    def one(c: Column, p: Column) -> Column:
        ok = c.between(low, high) & p.between(low, high)
        return F.when(ok, F.abs(c - p) / F.when(c == 0, F.lit(1e-8)).otherwise(c)).otherwise(F.lit(0.0))

    return F.when(previous.isNull(), F.transform(current, lambda c: F.lit(0.0))).otherwise(F.zip_with(current, previous, one))


def shuffled(rows: DataFrame, seed: int, *keys: str) -> DataFrame:
    """Rows in an order that hangs on the seed and their keys alone."""
    return rows.orderBy(F.xxhash64(F.lit(seed), *keys), *keys)


def resized(images: DataFrame, height: str, width: str) -> DataFrame:
    """Images (h, w, px array) at the sizes in the columns named, by bilinear interpolation between pixel centres."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for h, w, px, m, n in zip(*(batch.column(c).to_pylist() for c in ("h", "w", "px", height, width))):
                a = np.array(px, float).reshape(h, w)
                y, x = (np.clip((np.arange(k) + 0.5) * size / k - 0.5, 0, size - 1) for k, size in ((m, h), (n, w)))
                i, j = np.minimum(y.astype(int), max(h - 2, 0)), np.minimum(x.astype(int), max(w - 2, 0))
                u, v = (y - i)[:, None], (x - j)[None, :]
                k, l = np.minimum(i + 1, h - 1), np.minimum(j + 1, w - 1)
                out.append(((a[i][:, j] * (1 - v) + a[i][:, l] * v) * (1 - u) + (a[k][:, j] * (1 - v) + a[k][:, l] * v) * u).ravel().tolist())
            yield batch.set_column(batch.schema.get_field_index("px"), "px", pa.array(out, pa.list_(pa.float64())))

    return images.mapInArrow(each, images.schema)
