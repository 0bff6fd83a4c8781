"""Points against shapes by cells, masks as runs, and windows over blocks, against plain rules."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scanloom.operators import geometry, grid, labeling, windows

BOX = ("cx", "cy", "cz", "l", "w", "h", "rot_z")


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def inside(p, b):
    dx, dy, dz = p[0] - b[0], p[1] - b[1], p[2] - b[2]
    c, s = math.cos(b[6]), math.sin(b[6])
    return abs(dx * c + dy * s) <= b[3] / 2 and abs(dy * c - dx * s) <= b[4] / 2 and abs(dz) <= b[5] / 2


def boxes_of(spark, data):
    schema = "frame_id long, box_id long, is_moving boolean, box struct<" + ", ".join(f"{n}: double" for n in BOX) + ">"
    return spark.createDataFrame(data, schema)


def points_of(spark, data):
    return spark.createDataFrame(data, "frame_id long, point_idx long, x double, y double, z double")


@pytest.mark.parametrize("seed", range(2))
def test_boxes_of_all_sizes(spark, seed):
    random.seed(seed)
    size = lambda: random.choice([0.0, 0.3, 2.0, 9.0, 40.0, 500.0, 9_000.0])
    far = lambda: random.choice([random.uniform(-5, 5), random.uniform(-60, 60), random.uniform(-30_000, 30_000)])
    boxes = [(k % 3, k, k % 4 != 0, tuple(float(v) for v in (far(), far(), 0.0, size(), size(), 4.0, random.uniform(-4, 4)))) for k in range(60)]
    points = [(k % 4, k, far(), far(), random.uniform(-3, 3)) for k in range(1500)]
    points += [(f, 5000 + k, b[0] + b[3] / 2 * math.cos(b[6]), b[1] + b[3] / 2 * math.sin(b[6]), 0.0) for k, (f, _, _, b) in enumerate(boxes)]  # on edges
    points += [(0, 9000, float("nan"), 0.0, 0.0), (0, 9001, None, 0.0, 0.0), (0, 9002, math.inf, -math.inf, 0.0)]
    p, b = points_of(spark, points), boxes_of(spark, boxes)
    good = [q for q in points if q[2] is not None]
    assert rows(labeling.label_by_boxes(p, b).filter("is_moving"), "point_idx") == sorted((q[1],) for q in good if any(m and f == q[0] and inside(q[2:], x) for f, _, m, x in boxes))
    assert rows(labeling.hits_per_box(p, b), "box_id", "points") == sorted((i, sum(f == q[0] and inside(q[2:], x) for q in good)) for f, i, _, x in boxes)


def test_odd_boxes(spark):
    nan = float("nan")
    boxes = [(0, 0, True, (0.0, 0.0, 0.0, -1.0, 2.0, 2.0, 0.0)), (0, 1, True, (nan, 0.0, 0.0, 1.0, 1.0, 1.0, 0.0)), (0, 2, True, (0.0, 0.0, 0.0, 1.0, 1.0, 1.0, None)), (0, 3, True, None), (0, 4, None, (5.0, 0.0, 0.0, 1.0, 1.0, 1.0, 0.0))]
    p, b = points_of(spark, [(0, 0, 0.0, 0.0, 0.0), (1, 1, 0.0, 0.0, 0.0)]), boxes_of(spark, boxes)
    assert labeling.label_by_boxes(p, b).filter("is_moving").count() == 0 and labeling.label_by_boxes(p, b).count() == 2
    assert rows(labeling.hits_per_box(p, b), "box_id", "points") == [(k, 0) for k in range(5)]
    assert labeling.label_by_boxes(p.limit(0), b).count() == 0 and labeling.hits_per_box(p, b.limit(0)).count() == 0


def test_a_crowded_frame(spark):
    """A thousand boxes and 20,000 points in one frame: what meets follows what is hit."""
    boxes = [(0, k, True, (float(k % 40) * 5, float(k // 40) * 5, 0.0, 2.0, 1.0, 2.0, k * 0.1)) for k in range(1000)]
    rng = np.random.default_rng(3)
    points = [(0, k, *map(float, v)) for k, v in enumerate(np.column_stack((rng.uniform(0, 200, 20_000), rng.uniform(0, 125, 20_000), np.zeros(20_000))))]
    p, b = points_of(spark, points), boxes_of(spark, boxes)
    shapes = b.select("frame_id", "box", geometry.box_bounds(F.col("box")).alias("_bounds"))
    met = grid.candidates(p, shapes, ["frame_id"]).count()
    hits = sum(r.points for r in labeling.hits_per_box(p, b).collect())
    assert hits > 1000 and met < 40 * hits < 20_000 * 1000 / 20
    assert grid.candidates(p, shapes, ["frame_id"]).filter(geometry.in_rotated_box(F.col("box"))).count() == hits


def test_frustums(spark):
    camera = {"fx": 500.0, "fy": 500.0, "cx": 320.0, "cy": 240.0}
    bbox = F.array(*(F.lit(float(v)) for v in (200, 100, 450, 400)))
    v = spark.range(1).select(geometry.frustum_vertices(bbox, **camera).alias("v"), geometry.frustum_bounds(bbox, **camera).alias("b")).first()
    assert len(v.v) == 8 and [c.z for c in v.v] == [0.5] * 4 + [50.0] * 4
    assert (v.v[0].x, v.v[0].y) == (-0.12, -0.14) and (v.v[6].x, v.v[6].y) == (13.0, 16.0)
    assert (v.b.x0, v.b.x1, v.b.y0, v.b.y1) == (min(c.x for c in v.v), max(c.x for c in v.v), min(c.y for c in v.v), max(c.y for c in v.v))


def test_masks(spark):
    """A mask given by pixels labels the points that fall on them, and no others; frames without one go by their boxes."""
    camera = {"fx": 50.0, "fy": 50.0, "cx": 100.0, "cy": 40.0}
    random.seed(4)
    mask = {(f, random.randint(0, 79), c) for f in (0, 1) for c in range(200) for _ in range(30)}
    pixels = spark.createDataFrame([*mask, *list(mask)[:50]], "frame_id long, r long, c long")
    runs = labeling.mask_runs(pixels, ["frame_id"])
    back = {(r.frame_id, r.r, c) for r in runs.collect() for c in range(r.first, r.end)}
    assert back == mask and runs.count() < len(mask)
    points = [(k % 3, k, random.uniform(-30, 30), random.uniform(-12, 12), random.uniform(-2, 20)) for k in range(3000)] + [(0, 9000, 0.0, 0.0, 0.0), (0, 9001, float("nan"), 0.0, 1.0)]
    boxes = spark.createDataFrame([(2, [50.0, 10.0, 150.0, 70.0])], "frame_id long, bbox array<double>")
    p = points_of(spark, points)
    want = set()
    for f, k, x, y, z in points:
        u, v = (x * 50 / z + 100, y * 50 / z + 40) if z > 0 else (-1, -1)
        if f < 2 and 0 <= u < 200 and 0 <= v < 80 and (f, math.floor(v), math.floor(u)) in mask:
            want.add((k,))
    hull = {(r.point_idx,) for r in labeling.label_by_detections(p, boxes, camera).filter("is_moving").collect()}
    assert want and hull
    assert rows(labeling.label_by_masks(p, runs, camera, 200, 80).filter("is_moving"), "point_idx") == sorted(want)
    assert rows(labeling.label_by_masks(p, runs, camera, 200, 80, boxes).filter("is_moving"), "point_idx") == sorted(want | hull)
    assert labeling.label_by_masks(p, runs.limit(0), camera, 200, 80).filter("is_moving").count() == 0
    assert spark.createDataFrame([(v,) for v in (0.0, 0.4, -1.0, None, float("nan"))], "v double").select(labeling.normalised_mask(F.col("v")).alias("m")).collect() == [(0.0,), (1.0,), (0.0,), (0.0,), (0.0,)]


@pytest.mark.parametrize("n, block", [(1, 3), (2, 1), (4, 3), (9, 1), (9, 10), (4, 1 << 16)])
def test_windows_over_blocks(spark, n, block):
    """As over the whole sequence, where blocks hold fewer frames than a window, or none at all."""
    random.seed(n * block)
    frames = sorted(random.sample(range(200), 40))
    data = [("a", f, f * 2) for f in frames] + [("b", f, f) for f in (3, 4, 90)] + [("c", -5, 1)]
    df = spark.createDataFrame(data, "seq string, frame long, v long").repartition(3)
    got = {(r.seq, r.first): [(x.frame, x.v) for x in r.window] for r in windows.frame_windows(df, "seq", "frame", n, ["v"], block).collect()}
    want = {}
    for s in "abc":
        own = sorted((f, v) for q, f, v in data if q == s)
        want |= {(s, own[k][0]): own[k : k + n] for k in range(len(own) - n + 1)}
    assert got == want
    names = df.withColumn("frame", F.format_string("%04d", F.col("frame") + 500))
    assert windows.frame_windows(names, "seq", "frame", n, ["v"], block).count() == len(want)


def test_masks_are_not_broadcast(spark):
    """exploded masks and cells, which Spark takes for a few rows, don't go through the driver; whole masks give what their runs give."""
    p = spark.range(0, 40).select(F.lit(0).cast("long").alias("frame_id"), F.col("id").alias("point_idx"), (F.col("id") * 5 - 100).cast("double").alias("x"), (F.col("id") - 20).cast("double").alias("y"), F.lit(10.0).alias("z"))
    runs = spark.range(0, 80).select(F.lit(0).cast("long").alias("frame_id"), F.col("id").alias("r"), F.explode(F.array(F.struct((F.col("id") % 7).alias("first"), (F.col("id") + 20).alias("end")), F.struct(F.lit(100).cast("long").alias("first"), F.lit(150).cast("long").alias("end")))).alias("run")).select("frame_id", "r", "run.*")
    masks = runs.groupBy("frame_id").agg(F.collect_list(F.struct("r", "first", "end")).alias("runs"))
    boxes = spark.createDataFrame([(0, [20.0, 10.0, 60.0, 50.0])], "frame_id long, bbox array<double>")
    camera = {"fx": 10.0, "fy": 10.0, "cx": 100.0, "cy": 40.0}
    found = [labeling.label_by_masks(p, r, camera, 200, 80, boxes) for r in (runs, masks)]
    got = [sorted(r.point_idx for r in f.filter("is_moving").collect()) for f in found]
    assert got[0] == got[1] and 0 < len(got[0]) < 40
    for f in found:
        plan = f._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("SortMergeJoin") >= 2 and not any("_tile" in line or "level" in line and "i#" in line for line in plan.splitlines() if "BroadcastHashJoin" in line)
