"""Writers of the sensor file layouts.

Parquet is the native form. Small files are made as rows (path, bytes), which
``store.write_packed`` keeps in any store that Spark writes to. For tools that want
one file a frame, ``write_files`` writes and commits them below a folder or URI.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scanloom.functions import names
from scanloom.sources import decode, framefiles

# --- fixed values: colours of instances in combined masks, blue, green, red -----
COLOURS = [(255, 0, 0), (0, 255, 0), (0, 0, 255), (255, 255, 0), (255, 0, 255), (0, 255, 255), (128, 0, 128), (255, 165, 0)]
# --------------------------------------------------------------------------------


def write_files(rows: DataFrame, root: str) -> int:
    """Write each (path, bytes) below ``root``, committed as ``framefiles`` says; the number of files."""
    return framefiles.write(rows, root)


def _encoded(points: DataFrame, path: Column, columns: list[str], encode) -> DataFrame:
    """One file a frame, of its points in index order; a frame is one scan."""
    def one(t: pa.Table) -> pa.Table:
        order = np.argsort(t.column("point_idx").to_numpy(), kind="stable")
        data = [t.column(c).to_numpy()[order] for c in columns]
        return pa.table({"path": [t.column("path")[0].as_py()], "bytes": pa.array([encode(data)], pa.binary())})

    return points.select(path.alias("path"), "point_idx", *columns).groupBy("path").applyInArrow(one, "path string, bytes binary")


def cloud_files(points: DataFrame, path: Column, kind: str = "bin") -> DataFrame:
    stack = lambda d: np.stack(d, axis=1).astype("<f4")
    encode = (lambda d: stack(d).tobytes()) if kind == "bin" else (lambda d: decode.pcd_bytes(stack(d)))
    return _encoded(points, path, ["x", "y", "z", "intensity"], encode)


def label_files(labels: DataFrame, path: Column) -> DataFrame:
    return _encoded(labels, path, ["label"], lambda d: d[0].astype("<u4").tobytes())


def raster_files(pixels: DataFrame, path: Column, kind: str = "npy") -> DataFrame:
    """Rows (r, c, v) of each frame as ``npy`` (float32) or ``png`` (grey)."""
    def one(t: pa.Table) -> pa.Table:
        r, c, v = (t.column(x).to_numpy() for x in ("r", "c", "v"))
        a = np.zeros((r.max() + 1, c.max() + 1), np.float32)
        a[r, c] = v
        data = decode.array_bytes(a) if kind == "npy" else decode.png(a.astype(np.uint8))
        return pa.table({"path": [t.column("path")[0].as_py()], "bytes": pa.array([data], pa.binary())})

    return pixels.select(path.alias("path"), "r", "c", "v").groupBy("path").applyInArrow(one, "path string, bytes binary")


def image_files(images: DataFrame, path: Column) -> DataFrame:
    """(height, width, pixels as blue, green, red) as PNG, a row at a time."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [decode.png(np.frombuffer(p, np.uint8).reshape(h, w, 3)[:, :, ::-1]) for h, w, p in zip(*(batch.column(c).to_pylist() for c in ("height", "width", "pixels")))]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(out, pa.binary())], names=["path", "bytes"])

    return images.select(path.alias("path"), "height", "width", "pixels").mapInArrow(each, "path string, bytes binary")


def intrinsics_files(cameras: DataFrame, path: Column) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                f = io.BytesIO()
                np.savez(f, K=np.array(row["K"]).reshape(3, 3), D=np.array(row["D"]), height=row["height"], width=row["width"])
                out.append(f.getvalue())
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(out, pa.binary())], names=["path", "bytes"])

    return cameras.select(path.alias("path"), "K", "D", "height", "width").mapInArrow(each, "path string, bytes binary")


def _text(rows: DataFrame, path: Column, order: str, line: Column) -> DataFrame:
    """One text file a path, of its lines in order."""
    lines = rows.select(path.alias("path"), F.struct(F.col(order).alias("k"), line.alias("v")).alias("l"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["v"]), "\n")
    return lines.groupBy("path").agg(F.concat(text, F.lit("\n")).cast("binary").alias("bytes"))


def times_files(times: DataFrame, path: Column, order: str = "line", time: str = "time") -> DataFrame:
    return _text(times, path, order, names.scientific(F.col(time)))


def pose_files(poses: DataFrame, path: Column, order: str = "line", time: str = "time") -> DataFrame:
    values = [F.col(time), *(F.col(f"pose.{n}") for n in ("tx", "ty", "tz", "qx", "qy", "qz", "qw"))]
    return _text(poses, path, order, F.concat_ws(" ", *(names.scientific(v) for v in values)))


def calibration_files(matrices: DataFrame, path: Column, order: str = "name") -> DataFrame:
    """Rows (name, m array of 12) as lines ``P0: …``."""
    return _text(matrices, path, order, F.concat(F.col("name"), F.lit(": "), F.array_join(F.transform("m", names.scientific), " ")))


def write_json(rows: DataFrame, path: str) -> None:
    """Objects with their nulls, as a reader of the map expects all its keys."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def summary_rows(annotations: DataFrame, reduced: bool = False) -> DataFrame:
    """Annotation rows without masks, or with the number of detections in their place."""
    if reduced:
        return annotations.withColumn("num_detections", F.size("detections_2d")).drop("detections_2d")
    kind = annotations.schema["detections_2d"].dataType.elementType
    return annotations.withColumn("detections_2d", F.transform("detections_2d", lambda d: d.dropFields("mask"))) if "mask" in kind.names else annotations


#: Names that are sampled to part a folder, and files in a part.
SAMPLE, PART = 20_000, 1 << 17


def parts_by_name(files: DataFrame, column: str, each: int = PART) -> Column | None:
    """A column that rises with the names, for about ``each`` files a value; None where one part will do.

    Bounds are names of a sample, 256 at most.
    """
    n = files.count()
    if n <= each:
        return None
    sample = sorted(r[0] for r in files.sample(min(1.0, SAMPLE / n), seed=1).select(column).limit(2 * SAMPLE).collect())
    parts = min(256, -(-n // each))
    bounds = sorted({sample[len(sample) * k // parts] for k in range(1, parts)}) if sample else []
    return F.size(F.filter(F.array(*(F.lit(b) for b in bounds)), lambda b: b <= F.col(column))) if bounds else None


def kitti_plan(labels: DataFrame, sequence: str = "00", each: int = PART) -> DataFrame:
    """(source, target) of label files: numbered in name order below ``sequences``, a part of the names at a time."""
    numbered = names.indexed(labels.select("path").withColumn("all", F.lit(0)), ["all"], "path", parts_by_name(labels, "path", each))
    return numbered.select(F.col("path").alias("source"), F.concat(F.lit(f"sequences/{sequence}/labels/"), F.col("kitti_name"), F.lit(".label")).alias("target"))


def relaid(files: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows (path, bytes) of the files (path, content) of a plan, under their new names; ``write_files`` commits them."""
    return files.select(F.col("path").alias("source"), F.col("content").alias("bytes")).join(plan, "source").select(F.col("target").alias("path"), "bytes")


def cloud_colours(points: DataFrame) -> DataFrame:
    """Red for moving points, grey for others, in [0, 1]."""
    red, grey = F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0)), F.array(F.lit(0.5), F.lit(0.5), F.lit(0.5))
    return points.withColumn("colour", F.when(F.col("is_moving"), red).otherwise(grey))


def combined_masks(pixels: DataFrame, by: list[str]) -> DataFrame:
    """Colour of each masked pixel (instance, r, c): of the last instance that has it."""
    last = pixels.groupBy(*by, "r", "c").agg(F.max("instance").alias("instance"))
    table = F.array(*(F.array(*(F.lit(v) for v in c)) for c in COLOURS))
    return last.withColumn("colour", table[F.pmod("instance", F.lit(len(COLOURS)))])


def numbered_masks(detections: DataFrame, frame: str = "frame_id") -> DataFrame:
    """Detections that have a mask, with their place among those of their frame and camera."""
    return detections.filter("mask is not null").withColumn("instance", F.row_number().over(Window.partitionBy(frame, "camera").orderBy("det_idx")) - 1)
