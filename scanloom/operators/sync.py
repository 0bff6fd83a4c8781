"""Aligning message streams in time, and the per-timestamp map of assets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def before_plateau(right: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    """Drop what follows the first member of the first pair of equal times.

    A pointer that moves only to strictly closer messages can't pass such a pair.
    """
    twice = right.groupBy(*keys, ts).count().filter("count > 1")
    first = twice.groupBy(*keys).agg(F.min(ts).alias("_stop"))
    joined = right.join(first, list(keys), "left") if keys else right.crossJoin(F.broadcast(first))
    return joined.filter(F.col("_stop").isNull() | (F.col(ts) <= F.col("_stop"))).drop("_stop")


#: Buckets that are ordered together.
SPAN = 1024


def carried_over(marks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each bucket (keys, _b) with the ``last`` of an earlier and the ``first`` of a later one, as (_before, _after).

    Buckets are ordered within spans of ``SPAN``, and spans among themselves.
    Rows that follow are read in falling order: a frame that ends at the last
    row is made anew for each row, one that begins at the first only grows.
    """
    def around(rows: DataFrame, by: Sequence[str], at: str) -> DataFrame:
        seen = lambda c, order: F.last(c, ignorenulls=True).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
        return rows.select(*keys, "_s", *([at] if at != "_s" else []), seen("last", F.col(at)).alias("_before"), seen("first", F.col(at).desc()).alias("_after"))

    marks = marks.withColumn("_s", F.floor(F.col("_b") / F.lit(SPAN)))
    spans = marks.groupBy(*keys, "_s").agg(F.max("last").alias("last"), F.min("first").alias("first"))
    outer = around(spans, keys, "_s").select(*keys, "_s", F.col("_before").alias("_earlier"), F.col("_after").alias("_later"))
    own = around(marks, [*keys, "_s"], "_b").join(outer, [*keys, "_s"])
    return own.select(*keys, "_b", F.coalesce("_before", "_earlier").alias("_before"), F.coalesce("_after", "_later").alias("_after"))


def nearest(
    left: DataFrame, right: DataFrame, ts: str, value: str, bucket: int, keys: Sequence[str] = (),
    tolerance: int | None = None, strict_pointer: bool = False,
) -> DataFrame:
    """For each row of ``left`` the row of ``right`` nearest in time, as (…, ts_right, value_right).

    Times are whole numbers. Ties go to the earlier row, equal times on the right
    to the least ``value``. With ``tolerance`` (inclusive) rows without a match
    go; without it they stay with nulls.

    No pairs are made. Both sides are cut into buckets of ``bucket`` time units;
    inside one, windows find the neighbours on both sides, and where the bucket
    has none, the last of an earlier and the first of a later bucket are carried
    in from a table with one row a bucket. So one long recording is many tasks.
    """
    if strict_pointer:
        right = before_plateau(right, ts, keys)
    right = right.groupBy(*keys, ts).agg(F.min(value).alias("_v"))
    at = F.floor(F.col(ts) / F.lit(bucket))
    entry = F.struct(F.col(ts).alias("t"), F.col("_v").alias("v"))
    right = right.withColumn("_b", at).withColumn("_e", entry)
    left = left.withColumn("_b", at)

    summary = right.groupBy(*keys, "_b").agg(F.max("_e").alias("last"), F.min("_e").alias("first"))
    marks = summary.unionByName(left.select(*keys, "_b").distinct(), allowMissingColumns=True).groupBy(*keys, "_b").agg(F.max("last").alias("last"), F.max("first").alias("first"))
    carried = carried_over(marks, keys)

    both = left.withColumn("_left", F.lit(1)).unionByName(right.select(*keys, ts, "_b", "_e").withColumn("_left", F.lit(0)), allowMissingColumns=True)
    inside = Window.partitionBy(*keys, "_b")
    back = F.last("_e", ignorenulls=True).over(inside.orderBy(ts, "_left").rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.last("_e", ignorenulls=True).over(inside.orderBy(F.col(ts).desc(), F.col("_left").desc()).rowsBetween(Window.unboundedPreceding, -1))
    rows = both.withColumn("_back", back).withColumn("_ahead", ahead).filter("_left = 1").drop("_e", "_left")
    rows = rows.join(carried, [*keys, "_b"])
    back, ahead = F.coalesce("_back", "_before"), F.coalesce("_ahead", "_after")
    pick = F.when(back.isNull(), ahead).when(ahead.isNull(), back).when(F.col(ts) - back["t"] <= ahead["t"] - F.col(ts), back).otherwise(ahead)
    rows = rows.withColumn("_pick", pick).withColumn(f"{ts}_right", F.col("_pick.t")).withColumn(f"{value}_right", F.col("_pick.v"))
    rows = rows.drop("_b", "_back", "_ahead", "_before", "_after", "_pick")
    return rows if tolerance is None else rows.filter(F.abs(F.col(ts) - F.col(f"{ts}_right")) <= tolerance)


def cameras(left: DataFrame, rights: dict[str, DataFrame], ts: str, value: str, bucket: int, **options) -> DataFrame:
    """``nearest`` for several cameras, one row a match, with its ``camera``."""
    out = None
    for camera, right in rights.items():
        part = nearest(left, right, ts, value, bucket, **options).withColumn("camera", F.lit(camera))
        out = part if out is None else out.unionByName(part)
    return out


def first_of(messages: DataFrame, ts: str, keys: Sequence[str], value: str) -> DataFrame:
    """One row a key and time: the one of the least ``value``."""
    return messages.groupBy(*keys, ts).agg(F.min(value).alias(value))


#: Kinds of assets of a sync map, in its column order.
KINDS = ("lidar", "camera1_image", "camera1_intrinsic", "camera2_image", "camera2_intrinsic")


def sync_map(assets: DataFrame) -> DataFrame:
    """The map from (kind, timestamp, path): one row a timestamp that has a LiDAR file.

    Where a kind repeats at a timestamp the last path in name order wins. Frames
    are numbered by time; numbers come from counts by range of time, so that
    no task has to order all of them.
    """
    kinds = [F.max(F.when(F.col("kind") == k, F.col("path"))).alias(k) for k in KINDS]
    rows = assets.groupBy("timestamp").agg(*kinds).filter(F.col("lidar").isNotNull())
    flags = rows.select(
        "timestamp", *KINDS,
        F.col("camera1_image").isNotNull().alias("has_camera1"), F.col("camera2_image").isNotNull().alias("has_camera2"),
        (F.col("camera1_image").isNotNull() & F.col("camera2_image").isNotNull()).alias("complete_frame"),
    )
    return numbered(flags, "timestamp", "frame_id")


def numbered(rows: DataFrame, by: str, name: str, width: int = 1 << 20) -> DataFrame:
    """Add the place of each row in the order of the whole number ``by``, from 0, in blocks of ``width`` values."""
    blocks = rows.withColumn("_block", F.floor(F.col(by) / F.lit(width)))
    sizes = blocks.groupBy("_block").agg(F.count("*").alias("_n"))
    start = sizes.select("_block", (F.sum("_n").over(Window.orderBy("_block")) - F.col("_n")).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_block").orderBy(by))
    return blocks.withColumn("_at", inside).join(start, "_block").withColumn(name, (F.col("_start") + F.col("_at") - 1).cast("bigint")).drop("_block", "_at", "_start")


def summary(synced: DataFrame) -> DataFrame:
    """Frames, complete frames and frames by camera of a sync map."""
    count = lambda c: F.count_if(F.col(c)).alias(c)
    return synced.agg(F.count("*").alias("frames"), count("complete_frame"), count("has_camera1"), count("has_camera2"))


def routed(messages: DataFrame, topics: dict[str, str]) -> DataFrame:
    """Messages of the named topics, with the role that each plays."""
    role: Column | None = None
    for name, topic in topics.items():
        hit = F.col("topic") == topic
        role = F.when(hit, name) if role is None else role.when(hit, name)
    return messages.filter(F.col("topic").isin(*topics.values())).withColumn("role", role)


def topic_types(topics: DataFrame) -> DataFrame:
    """Topic to type; of repeated names the row of the last id counts."""
    return topics.groupBy("name").agg(F.max_by("type", "id").alias("type"), F.max("id").alias("id"))
