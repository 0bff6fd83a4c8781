"""File names, frame numbers and times as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def stem_timestamp(path: Column) -> Column:
    """The stem as a whole number, 0 where it isn't one."""
    s = stem(path)
    return F.coalesce(F.when(s.rlike(r"^\d+$"), s.try_cast("bigint")), F.lit(0).cast("bigint"))


def frame_number(path: Column) -> Column:
    """The first run of digits in the base name, null without one."""
    digits = F.regexp_extract(base_name(path), r"(\d+)", 1)
    return F.when(digits != "", digits.try_cast("bigint"))


def swap_extension(name: Column, old: str, new: str) -> Column:
    return F.replace(name, F.lit(old), F.lit(new))


def prefixed(prefix: str, base: Column) -> Column:
    return F.concat_ws("_", F.lit(prefix), base) if prefix else base


def padded(number: Column, width: int) -> Column:
    """Zeros in front; longer numbers stay whole."""
    return F.format_string(f"%0{width}d", number.cast("bigint"))


def scientific(x: Column) -> Column:
    return F.format_string("%.6e", x.cast("double"))


def placed(rows: DataFrame, by: list[str], order: str, block: Column | None, name: str) -> DataFrame:
    """Add ``name``: the place of each row in its group, from 0.

    ``block``, a column that never falls as ``order`` rises, cuts groups that are too long for one task.
    """
    if block is None:
        return rows.withColumn(name, (F.row_number().over(Window.partitionBy(*by).orderBy(order)) - 1).cast("bigint"))
    dealt = rows.withColumn("_b", block)
    count = dealt.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    start = count.select(*by, "_b", (F.sum("_n").over(Window.partitionBy(*by).orderBy("_b")) - F.col("_n")).alias("_start"))
    inner = dealt.withColumn("_at", F.row_number().over(Window.partitionBy(*by, "_b").orderBy(order)))
    same = [inner[c].eqNullSafe(start[c]) for c in (*by, "_b")]
    return inner.join(start, same).select(*(inner[c] for c in rows.columns), (F.col("_start") + F.col("_at") - 1).cast("bigint").alias(name))


def indexed(files: DataFrame, by: list[str], name: str, block: Column | None = None) -> DataFrame:
    """Place of each file in its group's name order, in blocks as ``placed`` has them, and the six-digit name of it."""
    return placed(files, by, name, block, "index").withColumn("kitti_name", padded(F.col("index"), 6))


def frame_rate(given: float | None, frames: Column, duration: Column | None) -> Column:
    """The given rate, else frames over duration, else 15."""
    measured = F.lit(None).cast("double") if duration is None else F.when(duration > 0, frames / duration)
    return F.coalesce(F.lit(given).cast("double"), measured, F.lit(15.0))


#: Frame numbers of a sequence that one task puts in order.
FRAMES = 1 << 16


def frame_times(frames: DataFrame, seq: str, number: str, fps: Column | float = 15.0) -> DataFrame:
    """Seconds of each frame of a sequence, from its number.

    Unique numbers from 0 count as consecutive: the place in order gives the
    time. Otherwise the distance from the least number does, gaps included.
    """
    each = frames.groupBy(seq).agg(F.count(number).alias("_n"), F.count_distinct(number).alias("_d"), F.min(number).alias("_low"))
    rows = placed(frames.join(each, seq), [seq], number, F.floor(F.col(number) / F.lit(FRAMES)), "_place")
    even = (F.col("_n") == F.col("_d")) & (F.col("_low") == 0)
    step = F.lit(1.0) / (fps if isinstance(fps, Column) else F.lit(float(fps)))
    return rows.withColumn("time", F.when(even, F.col("_place") * step).otherwise((F.col(number) - F.col("_low")) * step)).drop("_n", "_d", "_low", "_place")


def overlay(class_name: Column, confidence: Column, mask_score: Column | None = None) -> Column:
    """Text of a detection, and of its mask after a bar."""
    head = F.format_string("%s: %.2f", class_name, confidence)
    return head if mask_score is None else F.concat_ws(" | ", head, F.when(mask_score.isNotNull(), F.format_string("mask: %.2f", mask_score)))


def complete_frame(camera1: Column, camera2: Column, lidar: Column) -> Column:
    return lidar.isNotNull() & camera1.isNotNull() & camera2.isNotNull()


#: Point files by extension, the first ones first.
POINT_FILES = (".pcd", ".bin", ".ply")


def extension_rank(path: Column, extensions: tuple[str, ...] = POINT_FILES) -> Column:
    """Priority of a point file by its extension, null for others."""
    out = F.lit(None).cast("int")
    for k, e in reversed(list(enumerate(extensions))):
        out = F.when(F.endswith(F.lower(path), F.lit(e)), k).otherwise(out)
    return out


def hue_palette(n: int) -> list[tuple[float, float, float]]:
    """``n`` evenly spaced hues of full saturation and value."""
    import colorsys

    return [colorsys.hsv_to_rgb(k / n, 1.0, 1.0) for k in range(n)]
