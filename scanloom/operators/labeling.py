"""Labels of points from detections and boxes, statistics over frames, and the motion rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scanloom.operators import geometry, grid

# --- fixed values -------------------------------------------------------------
MOVING_CLASSES = ("person", "bicycle", "car", "motorcycle", "bus", "truck", "bird", "cat", "dog")
#: Activities that mean motion or rest, with the least confidence of each.
MOTION_KEYS = {"walking": 0.5, "running": 0.3, "cycling": 0.3, "moving": 0.5, "dancing": 0.5, "playing": 0.4}
STATIC_KEYS = {"sitting": 0.7, "standing": 0.6, "lying": 0.8, "sleeping": 0.8}
#: Label values of (static, moving) by scheme: the taxonomy's, the box labeller's, and 0 / 1.
SCHEMES = {"taxonomy": (9, 251), "boxes": (251, 9), "binary": (0, 1)}
#: Colours of classes, blue, green, red; others are green.
CLASS_COLOURS = {
    "person": (0, 255, 0), "car": (255, 0, 0), "bicycle": (0, 255, 255), "motorcycle": (255, 0, 255), "bus": (0, 165, 255), "truck": (128, 0, 128),
    "bird": (255, 255, 0), "cat": (255, 192, 203), "dog": (165, 42, 42),
}
#: Colours of outcomes and of truths, red, green, blue.
OUTCOME_COLOURS = {"TP": (0, 255, 0), "FP": (255, 0, 0), "FN": (0, 0, 255), "TN": (128, 128, 128)}
TRUTH_COLOURS = {True: (0, 255, 255), False: (128, 128, 128)}
# ------------------------------------------------------------------------------


def valid_detections(detections: DataFrame, threshold: float, classes: Sequence[str] = MOVING_CLASSES) -> DataFrame:
    """Detections of the classes, at the confidence or above, with a box of positive size."""
    b = F.col("bbox")
    return detections.filter(F.col("class_name").isin(*classes) & (F.col("confidence") >= threshold) & (b[2] > b[0]) & (b[3] > b[1]))


def label_by(points: DataFrame, shapes: DataFrame, keys: Sequence[str], point_id: Sequence[str], test: Column) -> DataFrame:
    """Add ``is_moving``: whether any of the frame's shapes, whose bounds are ``_bounds``, holds the point.

    Points meet shapes by cells of a grid; hits are reduced to distinct points
    before they are joined back.
    """
    hits = grid.candidates(points.select(*point_id, "x", "y", "z"), shapes, keys).filter(test).select(*point_id).distinct().withColumn("is_moving", F.lit(True))
    return points.join(hits, list(point_id), "left").withColumn("is_moving", F.coalesce("is_moving", F.lit(False)))


def label_by_detections(points: DataFrame, detections: DataFrame, camera: dict[str, float], near: float = 0.5, far: float = 50.0) -> DataFrame:
    """Points (frame_id, point_idx, x, y, z) by the hulls of their frame's detections (frame_id, bbox)."""
    shapes = detections.select("frame_id", geometry.frustum_bounds(F.col("bbox"), **camera, near=near, far=far).alias("bounds"))
    return label_by(points, shapes.withColumn("_bounds", F.col("bounds")), ["frame_id"], ["frame_id", "point_idx"], geometry.in_bounds(F.col("bounds")))


def label_by_boxes(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """Points by their frame's moving boxes (frame_id, box struct, is_moving); static boxes go before the join."""
    shapes = boxes.filter("is_moving").select("frame_id", "box", geometry.box_bounds(F.col("box")).alias("_bounds"))
    return label_by(points, shapes, ["frame_id"], ["frame_id", "point_idx"], geometry.in_rotated_box(F.col("box")))


#: Pixels of a row that runs of masks are filed by.
RUN_TILE = 64


def mask_runs(pixels: DataFrame, by: Sequence[str]) -> DataFrame:
    """Runs (by, r, first, end) of masked pixels (by, r, c), ``end`` being the pixel behind; a row of an image is ordered at a time."""
    row = Window.partitionBy(*by, "r").orderBy("c")
    runs = pixels.select(*by, "r", "c").distinct().withColumn("_run", F.col("c") - F.row_number().over(row))
    return runs.groupBy(*by, "r", "_run").agg(F.min("c").alias("first"), (F.max("c") + 1).alias("end")).drop("_run")


def _rows_in_use(masks: DataFrame, seen: DataFrame) -> DataFrame:
    """Runs (frame_id, r, first, end) of masks (frame_id, runs) in the rows of the image that points of the frame fall on."""
    used = seen.groupBy("frame_id").agg(F.collect_set("r").alias("_used"))
    met = used.join(masks.select("frame_id", "runs").hint("merge"), "frame_id")
    return met.select("frame_id", F.inline(F.filter("runs", lambda x: F.array_contains("_used", x["r"].cast("long")))))


def label_by_masks(points: DataFrame, runs: DataFrame, camera: dict[str, float], width: int, height: int, unmasked: DataFrame | None = None, near: float = 0.5, far: float = 50.0) -> DataFrame:
    """Add ``is_moving``: whether a point (frame_id, point_idx, x, y, z) falls on a masked pixel of its frame.

    Points are projected to pixels and looked up in the mask's runs
    (frame_id, r, first, end) of that row, which are filed by tiles of
    ``RUN_TILE`` pixels. Whole masks (frame_id, runs as an array of r, first and
    end) may be given instead; only their rows that points fall on become rows of
    a table. Both sides are shuffled: Spark's estimate of exploded rows is that
    of the rows before, and would let it send them all through the driver.
    Detections without a mask, ``unmasked`` (frame_id, bbox), label the points in
    the hulls of their frustums instead.
    """
    tile = lambda c: F.floor(c / RUN_TILE).cast("long")
    at = points.select("frame_id", "point_idx", geometry.pixel(**camera, width=width, height=height).alias("_p")).filter("_p IS NOT NULL")
    seen = at.select("frame_id", "point_idx", F.col("_p.v").alias("r"), F.col("_p.u").alias("u"), tile(F.col("_p.u")).alias("_tile"))
    if "runs" in runs.columns:
        runs = _rows_in_use(runs, seen)
    filed = runs.filter("first < end").select("frame_id", F.col("r").cast("long").alias("r"), "first", "end", F.explode(F.sequence(tile(F.col("first")), tile(F.col("end") - 1))).alias("_tile"))
    hits = seen.join(filed.hint("merge"), ["frame_id", "r", "_tile"]).filter("u >= first AND u < end").select("frame_id", "point_idx")
    if unmasked is not None:
        hits = hits.unionByName(label_by_detections(points.select("frame_id", "point_idx", "x", "y", "z"), unmasked, camera, near, far).filter("is_moving").select("frame_id", "point_idx"))
    return points.join(hits.distinct().withColumn("is_moving", F.lit(True)), ["frame_id", "point_idx"], "left").withColumn("is_moving", F.coalesce("is_moving", F.lit(False)))


def hits_per_box(points: DataFrame, boxes: DataFrame) -> DataFrame:
    """Points in each box; a point in two boxes counts for both."""
    shapes = boxes.select("frame_id", "box_id", "box", geometry.box_bounds(F.col("box")).alias("_bounds"))
    found = grid.candidates(points, shapes, ["frame_id"]).filter(geometry.in_rotated_box(F.col("box")))
    counts = found.groupBy("frame_id", "box_id").agg(F.count("*").alias("points"))
    return boxes.select("frame_id", "box_id").join(counts, ["frame_id", "box_id"], "left").withColumn("points", F.coalesce("points", F.lit(0)))


def frame_stats(points: DataFrame, frame: str = "frame_id") -> DataFrame:
    """Points, moving and static ones, and the moving share of each frame."""
    n = points.groupBy(frame).agg(F.count("*").alias("num_points"), F.count_if("is_moving").alias("moving_points"))
    ratio = F.when(F.col("num_points") > 0, F.col("moving_points") / F.col("num_points")).otherwise(0.0)
    return n.withColumn("static_points", F.col("num_points") - F.col("moving_points")).withColumn("moving_ratio", ratio)


def run_stats(frames: DataFrame) -> DataFrame:
    """Totals of ``frame_stats``: the share of all points, and the mean of the frames' shares."""
    total = F.sum("num_points")
    return frames.agg(
        F.count("*").alias("frames"), total.alias("points"), F.sum("moving_points").alias("moving"), F.sum("static_points").alias("static"),
        F.try_divide(F.sum("moving_points").cast("double"), total.cast("double")).alias("micro_ratio"), F.avg("moving_ratio").alias("macro_ratio"),
    )


def detection_stats(frames: DataFrame) -> DataFrame:
    """Frames with detections and with masks, detections and masks, of annotation rows."""
    area = F.transform("detections_2d", lambda d: F.coalesce(d["mask_area"], F.lit(0)))
    n = frames.select(F.size("detections_2d").alias("d"), F.size(F.filter(area, lambda a: a > 0)).alias("m"))
    return n.agg(
        F.count("*").alias("frames"), F.count_if(F.col("d") > 0).alias("frames_with_detections"), F.sum("d").alias("detections"),
        F.count_if(F.col("m") > 0).alias("frames_with_masks"), F.sum("m").alias("masks"),
    )


def encode(is_moving: Column, scheme: str = "taxonomy") -> Column:
    static, moving = SCHEMES[scheme]
    return F.when(is_moving, moving).otherwise(static).cast("bigint")


def decode(label: Column, scheme: str = "taxonomy", strip_high_bits: bool = False) -> Column:
    """The canonical flag; the taxonomy's rule is any label above 250."""
    label = label.bitwiseAND(F.lit(0xFFFF)) if strip_high_bits else label
    return label > 250 if scheme == "taxonomy" else label == SCHEMES[scheme][1]


def remap(rows: DataFrame, label: str, mapping: dict[int, int], name: str) -> DataFrame:
    """Map label ids to classes; ids outside of the map give null."""
    table = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
    return rows.withColumn(name, F.try_element_at(table, F.col(label).cast("int")))


def remap_by(rows: DataFrame, label: str, taxonomy: DataFrame, name: str, version: Sequence[str] = ()) -> DataFrame:
    """Map label ids to classes by a table (from, to), of the row's own ``version`` where it has several; ids outside of it give null."""
    table = taxonomy.select(*version, F.col("from").cast("bigint").alias("_from"), F.col("to").alias(name)).dropDuplicates([*version, "_from"])
    return rows.withColumn("_from", F.col(label).cast("bigint")).join(table, [*version, "_from"], "left").drop("_from")


def _hit(keys: dict[str, float]):
    def test(entry: Column) -> Column:
        name = F.lower(entry["key"])
        out = F.lit(False)
        for k, least in keys.items():
            out = out | (name.contains(k) & (entry["value"] >= least))
        return F.coalesce(out, F.lit(False))

    return test


def is_moving(actions: Column, social: Column) -> Column:
    """Whether an object moves, from ordered lists of activities with confidences.

    Any action that means motion decides; else the first social activity that
    means motion or rest; else it rests. Null lists are empty.
    """
    motion, static = _hit(MOTION_KEYS), _hit(STATIC_KEYS)
    codes = F.filter(F.transform(social, lambda e: F.when(motion(e), 1).when(static(e), 2).otherwise(0)), lambda c: c != 0)
    first = F.coalesce(F.try_element_at(codes, F.lit(1)) == 1, F.lit(False))
    return F.coalesce(F.exists(actions, motion), F.lit(False)) | first


def normalised_mask(value: Column) -> Column:
    """1 where a mask's value is above 0, else 0; null and NaN are no part of it."""
    return F.when((value > 0) & ~F.isnan(value.cast("double")), 1.0).otherwise(0.0)


def outcome(predicted: Column, truth: Column, threshold: float = 0.5) -> Column:
    """TP, FP, FN or TN of a prediction above the threshold against a positive truth."""
    p, t = predicted > threshold, normalised_mask(truth) > 0
    return F.when(p & t, "TP").when(p & ~t, "FP").when(~p & t, "FN").otherwise("TN")


def confusion(rows: DataFrame, predicted: Column, truth: Column, by: Sequence[str] = ()) -> DataFrame:
    o = outcome(predicted, truth)
    return rows.groupBy(*by).agg(*(F.count_if(o == k).alias(k.lower()) for k in ("TP", "FP", "FN", "TN")))


def segmentation_metrics(counts: DataFrame) -> DataFrame:
    """IoU, precision, recall and F1 of rows (tp, fp, fn): of the sums (micro) and as means over rows (macro)."""
    def ratios(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
        div = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
        return {"iou": div(tp, tp + fp + fn), "precision": div(tp, tp + fp), "recall": div(tp, tp + fn), "f1": div(2 * tp, 2 * tp + fp + fn)}

    c = [F.col(k) for k in ("tp", "fp", "fn")]
    micro = ratios(*(F.sum(x) for x in c))
    macro = ratios(*c)
    return counts.agg(*(v.alias(f"micro_{k}") for k, v in micro.items()), *(F.avg(v).alias(f"macro_{k}") for k, v in macro.items()))


def _colour(key: Column, table: dict, default: tuple[int, int, int]) -> Column:
    cells = F.create_map(*(x for k, v in table.items() for x in (F.lit(k), F.array(*(F.lit(c) for c in v)))))
    return F.coalesce(F.try_element_at(cells, key), F.array(*(F.lit(c) for c in default)))


def class_colour(name: Column) -> Column:
    return _colour(name, CLASS_COLOURS, (0, 255, 0))


def outcome_colours(predicted: Column, truth: Column) -> tuple[Column, Column]:
    """Colours of a point by its outcome, and by its truth alone."""
    return _colour(outcome(predicted, truth), OUTCOME_COLOURS, OUTCOME_COLOURS["TN"]), _colour(truth > 0, TRUTH_COLOURS, TRUTH_COLOURS[False])


def mask_area(mask: Column) -> Column:
    """Pixels of a mask of zeros and ones."""
    return F.aggregate(mask, F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x.cast("bigint"), F.lit(0)))


def best(rows: DataFrame, value: str, *metric: str, by: Sequence[str] = ()) -> DataFrame:
    """The ``value`` of each group's row of the greatest metric."""
    return rows.groupBy(*by).agg(F.max_by(value, F.struct(*metric)).alias(value))
