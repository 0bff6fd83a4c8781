"""Points against shapes by cells: a join whose rows follow hits, not points times shapes.

The ground plane of each frame is a grid on ``LEVELS`` levels, each ``STEP`` times
as coarse as the one before. A shape is filed under the cells of its bounds, on the
finest level where these are ``STEP`` + 1 by ``STEP`` + 1 cells at most; a point is
looked up in its one cell of each level that shapes use. What meets has the frame, the level
and the cell in common, so that a crowded frame is dealt over tasks by its cells, and
is tested exactly afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Edge of the finest cells in metres, ratio of levels, and number of levels.
CELL = 2.0
STEP = 8
LEVELS = 5

#: Coordinates beyond this count as being there, for the grid alone.
FAR = 16_000.0


def _edge(level: Column) -> Column:
    return F.lit(CELL) * F.pow(F.lit(float(STEP)), level)


def _cell(v: Column, level: Column) -> Column:
    return F.floor(F.least(F.greatest(v, F.lit(-FAR)), F.lit(FAR)) / _edge(level)).cast("long")


def _side(bounds: Column) -> Column:
    return F.greatest(bounds["x1"] - bounds["x0"], bounds["y1"] - bounds["y0"])


def level_of(bounds: Column) -> Column:
    """The finest level on which bounds are short enough."""
    steps = F.ceil(F.log(float(STEP), F.greatest(_side(bounds), F.lit(1e-9)) / (CELL * STEP)))
    return F.least(F.greatest(steps, F.lit(0)), F.lit(LEVELS - 1)).cast("long")


def tiles(bounds: Column) -> Column:
    """The cells of bounds (x0, x1, y0, y1) as an array of (level, i, j); none where a bound is null, NaN or the wrong way round."""
    level = level_of(bounds)
    span = lambda a: F.sequence(_cell(bounds[f"{a}0"], level), _cell(bounds[f"{a}1"], level))
    every = F.flatten(F.transform(span("x"), lambda i: F.transform(span("y"), lambda j: F.struct(level.alias("level"), i.alias("i"), j.alias("j")))))
    good = ~F.isnan(_side(bounds)) & (bounds["x0"] <= bounds["x1"]) & (bounds["y0"] <= bounds["y1"])
    return F.when(good, every)


def candidates(points: DataFrame, shapes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``points`` (x, y) with those of ``shapes`` (_bounds) of the same ``keys`` whose bounds share a cell with them.

    A pair comes once. The levels in use are at most ``LEVELS`` rows, and known
    before points are repeated for them. Cells are shuffled, however few rows Spark
    takes them for before they are exploded.
    """
    filed = shapes.select("*", F.explode(tiles(F.col("_bounds"))).alias("_cell")).select(*shapes.columns, "_cell.*").drop("_bounds")
    level = F.explode(F.array(*(F.lit(k).cast("long") for k in range(LEVELS)))).alias("level")
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    at = points.filter(~F.isnan(x) & ~F.isnan(y)).select("*", level).join(F.broadcast(shapes.select(level_of(F.col("_bounds")).alias("level")).distinct()), "level")
    return at.select("*", _cell(x, F.col("level")).alias("i"), _cell(y, F.col("level")).alias("j")).join(filed.hint("merge"), [*keys, "level", "i", "j"]).drop("level", "i", "j")
