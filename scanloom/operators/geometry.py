"""Points, boxes, poses and projections as column arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def col(x: str | float | Column) -> Column:
    return F.col(x).cast("double") if isinstance(x, str) else F.lit(float(x)) if isinstance(x, (int, float)) else x


def finite_xyz(points: DataFrame) -> DataFrame:
    """Rows without NaN in x, y or z; infinities stay."""
    return points.filter(~(F.isnan("x") | F.isnan("y") | F.isnan("z")))


def crop_square(points: DataFrame, limit: float = 10.0) -> DataFrame:
    """Points strictly inside the square; NaN, which Spark orders last, is outside."""
    return points.filter((F.abs(col("x")) < limit) & (F.abs(col("y")) < limit))


def intrinsics(k: Column) -> dict[str, Column]:
    """fx, fy, cx, cy of a row-major 3 x 3 matrix."""
    return {"fx": k[0], "fy": k[4], "cx": k[2], "cy": k[5]}


def frustum_vertices(bbox: Column, fx, fy, cx, cy, near: float = 0.5, far: float = 50.0) -> Column:
    """The eight corners of a bounding box's frustum as structs (x, y, z): the near plane before the far one, each from top left clockwise."""
    ray = lambda k, f, c: (bbox[k] - col(c)) / col(f)
    left, top, right, bottom = ray(0, fx, cx), ray(1, fy, cy), ray(2, fx, cx), ray(3, fy, cy)
    depth = lambda d: F.lit(float(d))
    corner = lambda x, y, d: F.struct((x * depth(d)).alias("x"), (y * depth(d)).alias("y"), depth(d).alias("z"))
    return F.array(*(corner(x, y, d) for d in (near, far) for x, y in ((left, top), (right, top), (right, bottom), (left, bottom))))


def pixel(fx, fy, cx, cy, width: int, height: int, x="x", y="y", z="z") -> Column:
    """(u, v): the pixel that a point in front of the camera falls on; null behind it and outside of the image."""
    x, y, z = col(x), col(y), col(z)
    at = F.when(z > 0, F.struct((x * col(fx) / z + col(cx)).alias("u"), (y * col(fy) / z + col(cy)).alias("v")))
    inside = (at["u"] >= 0) & (at["u"] < width) & (at["v"] >= 0) & (at["v"] < height)
    return F.when(inside, F.struct(F.floor(at["u"]).cast("long").alias("u"), F.floor(at["v"]).cast("long").alias("v")))


def frustum_bounds(bbox: Column, fx, fy, cx, cy, near: float = 0.5, far: float = 50.0) -> Column:
    """The axis-aligned hull of a bounding box's frustum between two depths, as a struct."""
    sides = {}
    for axis, lo, hi, f, c in (("x", 0, 2, fx, cx), ("y", 1, 3, fy, cy)):
        rays = [(bbox[k] - col(c)) / col(f) for k in (lo, hi)]
        corners = [r * F.lit(float(d)) for r in rays for d in (near, far)]
        sides[axis] = F.least(*corners), F.greatest(*corners)
    return F.struct(
        sides["x"][0].alias("x0"), sides["x"][1].alias("x1"), sides["y"][0].alias("y0"), sides["y"][1].alias("y1"),
        F.lit(float(near)).alias("z0"), F.lit(float(far)).alias("z1"),
    )


def in_bounds(b: Column, x="x", y="y", z="z") -> Column:
    """Inclusive test against ``frustum_bounds``, in front of the camera."""
    x, y, z = col(x), col(y), col(z)
    return x.between(b["x0"], b["x1"]) & y.between(b["y0"], b["y1"]) & z.between(b["z0"], b["z1"]) & (z > 0)


def in_frustum(bbox: Column, fx, fy, cx, cy, near: float = 0.5, far: float = 50.0, x="x", y="y", z="z") -> Column:
    """Extension: inside the frustum itself, not its hull."""
    x, y, z = col(x), col(y), col(z)
    u, v = x * col(fx) / z + col(cx), y * col(fy) / z + col(cy)
    return z.between(near, far) & u.between(bbox[0], bbox[2]) & v.between(bbox[1], bbox[3])


def in_rotated_box(box: Column, x="x", y="y", z="z") -> Column:
    """Inclusive test against a box turned about z: struct (cx, cy, cz, l, w, h, rot_z)."""
    dx, dy, dz = col(x) - box["cx"], col(y) - box["cy"], col(z) - box["cz"]
    c, s = F.cos(box["rot_z"]), F.sin(box["rot_z"])
    return (F.abs(dx * c + dy * s) <= box["l"] / 2) & (F.abs(dy * c - dx * s) <= box["w"] / 2) & (F.abs(dz) <= box["h"] / 2)


def box_bounds(box: Column) -> Column:
    """The ground rectangle around a turned box, a hair wider so that rounding loses no point on an edge."""
    c, s = F.abs(F.cos(box["rot_z"])), F.abs(F.sin(box["rot_z"]))
    half = {"x": box["l"] / 2 * c + box["w"] / 2 * s, "y": box["l"] / 2 * s + box["w"] / 2 * c}
    slack = {k: h * 1e-9 + F.abs(box[f"c{k}"]) * 1e-12 + 1e-9 for k, h in half.items()}
    good = (box["l"] >= 0) & (box["w"] >= 0)
    side = lambda k, sign: F.when(good, box[f"c{k}"] + sign * (half[k] + slack[k])).alias(f"{k}{int(sign > 0)}")
    return F.struct(side("x", -1), side("x", 1), side("y", -1), side("y", 1))


def rotation(qx: Column, qy: Column, qz: Column, qw: Column) -> list[Column]:
    """Row-major rotation of a quaternion, normalised first; null for a zero one."""
    n = F.sqrt(qx * qx + qy * qy + qz * qz + qw * qw)
    x, y, z, w = (F.when(n > 0, q / n) for q in (qx, qy, qz, qw))
    return [
        1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w),
        2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w),
        2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y),
    ]


def pose_matrix(p: Column) -> Column:
    """(r array of 9, t array of 3) of a pose struct (tx, ty, tz, qx, qy, qz, qw)."""
    r = rotation(p["qx"], p["qy"], p["qz"], p["qw"])
    return F.struct(F.array(*r).alias("r"), F.array(p["tx"], p["ty"], p["tz"]).alias("t"))


def relative(m: Column, ref: Column) -> Column:
    """The pose matrix ``inverse(ref) * m``, by the rigid inverse."""
    rt = lambda i, k: ref["r"][3 * k + i]
    r = [sum((rt(i, k) * m["r"][3 * k + j] for k in range(1, 3)), rt(i, 0) * m["r"][j]) for i in range(3) for j in range(3)]
    t = [sum((rt(i, k) * (m["t"][k] - ref["t"][k]) for k in range(1, 3)), rt(i, 0) * (m["t"][0] - ref["t"][0])) for i in range(3)]
    return F.struct(F.array(*r).alias("r"), F.array(*t).alias("t"))


def apply_pose(m: Column, x="x", y="y", z="z") -> list[Column]:
    p = [col(x), col(y), col(z)]
    return [m["r"][3 * i] * p[0] + m["r"][3 * i + 1] * p[1] + m["r"][3 * i + 2] * p[2] + m["t"][i] for i in range(3)]


def canonical(points: DataFrame, poses: DataFrame, window: list[str], frame: str, order: str) -> DataFrame:
    """Points of each window in the coordinates of its last frame.

    ``poses`` has a struct ``pose`` for each (window, frame, order). Only poses
    meet in the window; points are joined to twelve coefficients.
    """
    w = Window.partitionBy(*window).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    m = poses.withColumn("_m", pose_matrix(F.col("pose")))
    m = m.withColumn("_rel", relative(F.col("_m"), F.last("_m").over(w))).select(*window, frame, "_rel")
    out = points.join(m, [*window, frame])
    moved = apply_pose(F.col("_rel"))
    return out.withColumns(dict(zip("xyz", moved))).drop("_rel")


def augment(points: DataFrame, sample: list[str], seed: int = 0, sigma: float = 0.01, clip: float = 0.05) -> DataFrame:
    """One turn about z, scale in [0.8, 1.25] and flip a sample; clipped jitter a coordinate.

    A sample's draws hang on its key, a point's on key and index, so that reruns agree.
    """
    def draw(name: str, *of: str) -> Column:
        return (F.pmod(F.xxhash64(F.lit(seed), F.lit(name), *of), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)

    turn, scale = draw("turn", *sample) * 2 * F.pi(), draw("scale", *sample) * 0.45 + 0.8
    flip = F.when(draw("flip", *sample) < 0.5, -1.0).otherwise(1.0)
    def noise(axis: str) -> Column:
        u, v = draw(f"u{axis}", *sample, "point_idx"), draw(f"v{axis}", *sample, "point_idx")
        return F.greatest(F.lit(-clip), F.least(F.lit(clip), F.sqrt(F.log(u) * -2) * F.cos(v * 2 * F.pi()) * sigma))
    x, y, z = col("x"), col("y"), col("z")
    moved = {"x": (x * F.cos(turn) - y * F.sin(turn)) * scale * flip, "y": (x * F.sin(turn) + y * F.cos(turn)) * scale, "z": z * scale}
    return points.withColumns({k: v + noise(k) for k, v in moved.items()})


def projection(k: Column, r: Column, t: Column, bx: Column | float = 0.0, by: Column | float = 0.0) -> Column:
    """Row-major 3 x 4 matrix ``K [R, T]``, less fx * bx and fy * by in the last column."""
    cells = []
    for i in range(3):
        for j in range(4):
            side = (lambda n, j=j: r[3 * n + j]) if j < 3 else (lambda n: t[n])
            v = k[3 * i] * side(0) + k[3 * i + 1] * side(1) + k[3 * i + 2] * side(2)
            cells.append(v - k[4 * i] * col((bx, by)[i]) if j == 3 and i < 2 else v)
    return F.array(*cells)


def matrix_from(text: Column) -> Column:
    """Numbers of a matrix written as text."""
    return F.transform(F.filter(F.split(F.regexp_replace(text, r"[\[\],;]", " "), r"\s+"), lambda x: x != ""), lambda x: x.cast("double"))


def norm(*parts: Column) -> Column:
    return F.sqrt(sum((p * p for p in parts[1:]), parts[0] * parts[0]))


def baseline(cameras: DataFrame, default: float = 0.06, by: Sequence[str] = ()) -> DataFrame:
    """Median distance of cameras next to each other in name order, ``default`` for fewer than two; one row a rig.

    ``cameras`` has (sensor_id, t array of 3) and the columns ``by`` that name
    its rig; without them all rows are one rig, which one task orders.
    """
    before = F.lag("t").over(Window.partitionBy(*by).orderBy("sensor_id"))
    step = cameras.withColumn("_p", before).select(*by, norm(*(F.col("t")[k] - F.col("_p")[k] for k in range(3))).alias("_d"))
    return step.groupBy(*by).agg(F.coalesce(F.median("_d"), F.lit(default)).alias("baseline"))


def cylindrical(cameras: DataFrame, height: int = 480, width: int = 3760, by: Sequence[str] = ()) -> DataFrame:
    """f, y0 and size of the stitched view from (fy, cy) of all cameras of a rig."""
    out = cameras.groupBy(*by).agg(F.median("fy").alias("f"), (F.median("cy") / 480 * height).alias("y0"))
    return out.select(*by, "f", "y0", F.lit(width).alias("width"), F.lit(height).alias("height"))


def reference_camera(cameras: DataFrame, preferred: str = "sensor_0", by: Sequence[str] = ()) -> DataFrame:
    """The preferred camera of each rig, else its first by position."""
    order = F.struct((F.col("sensor_id") != preferred).alias("other"), "position")
    return cameras.groupBy(*by).agg(F.min_by(F.struct(*cameras.columns), order).alias("c")).select("c.*")


def calibration_rows(k: Column, r: Column, t: Column, base: Column | float) -> dict[str, Column]:
    """P0 to P3 and Tr of a layout with two equal pairs of cameras."""
    p0, p1 = projection(k, r, t), projection(k, r, t, base)
    tr = F.array(*(r[3 * (i // 4) + i % 4] if i % 4 < 3 else t[i // 4] for i in range(12)))
    return {"P0": p0, "P1": p1, "P2": p0, "P3": p1, "Tr": tr}
