"""Whitening of vectors: covariance by generated column aggregates, components by LAPACK.

Components of a vector become whole numbers x. Spark SQL is generated that adds
up the centred products of every pair of dimensions in the upper triangle, all of
them in one aggregation over the distinct vectors; what reaches the driver is one
row of numbers, however many vectors there are. There it is put together to the
covariance and decomposed, and what comes back to the rows are expressions again.
A triangle of more than ``PAIRS`` pairs takes one aggregation for each ``PAIRS``.

Sums of whole numbers are exact, and the mean is taken off before anything is
multiplied, so that large means cost no digits.

Defined cases. A vector that is null, or has a null or non-finite component, takes
no part. Shorter vectors count as filled up with zeros, also where distinct ones
are told apart; components too large for a long stop at its ends. Repeated vectors
count once in the fit and are whitened each; ids are only handed on, null or
repeated ones too. Components are at most as many as dimensions. One whose
variance is no more than ``RANK`` of all is no direction that the vectors spread
in: it is whitened to 0 and left out of the error. ``deviation`` is null where it
doesn't fit in a long. A table without vectors gives no rows. Other columns are
not read. Ties don't arise, as no order decides; equal variances share a plane in
which any two directions at right angles will do.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import settled

#: Products that one aggregation adds up: all pairs of 90 dimensions.
PAIRS = 4_096

#: Share of all variance from which a component counts.
RANK = 1e-12

LONG = 1 << 63


def integers(vector: Column) -> Column:
    """floor(256 * x) of each component, or null for a vector that takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * 256)))


def total(terms: list[Column]) -> Column:
    """The sum of columns as a tree of even depth, so that wide vectors make no deep expressions."""
    while len(terms) > 1:
        terms = [a[0] + a[1] if len(a) > 1 else a[0] for a in (terms[k : k + 2] for k in range(0, len(terms), 2))]
    return terms[0]


def centred_products(fit: DataFrame, mean: list[float]) -> np.ndarray:
    """Sums over ``fit`` of the centred products of each pair of dimensions, as a symmetric matrix."""
    wide = len(mean)
    pairs = [(i, j) for i in range(wide) for j in range(i, wide)]
    # Columns that can't be null make sums whose code is half as long, and there are thousands of them.
    centred = fit.selectExpr(*(f"coalesce(x[{k}] - {m!r}D, 0D) AS c{k}" for k, m in enumerate(mean)))
    out = np.zeros((wide, wide))
    for at in range(0, len(pairs), PAIRS):
        part = pairs[at : at + PAIRS]
        for (i, j), v in zip(part, centred.selectExpr(*(f"sum(c{i} * c{j}) AS p{i}_{j}" for i, j in part)).first()):
            out[i, j] = out[j, i] = v
    return out


@dataclass
class Whitening:
    """What a fit found: ``n`` distinct vectors of sums ``sums``, and by component its unit direction and variance."""

    n: int
    sums: list[int]
    far: int
    directions: np.ndarray
    values: np.ndarray
    trace: float
    error: float = 0.0

    @property
    def mean(self) -> list[float]:
        return [s / self.n for s in self.sums]

    def used(self, k: int) -> bool:
        return bool(self.values[k] > RANK * self.trace)

    def whitened(self, k: int) -> Column:
        """Component ``k`` of the column ``x``, of variance 1 over the fit."""
        if not self.used(k):
            return F.lit(0.0)
        scaled = (self.directions[k] / np.sqrt(self.values[k])).tolist()
        return total([(F.col("x")[d] - F.lit(m)) * F.lit(w) for d, (m, w) in enumerate(zip(self.mean, scaled))])

    def deviation(self) -> Column:
        """Sum over dimensions of (n * x - S) ** 2, exactly."""
        if len(self.sums) * self.far**2 < LONG:  # no term and no sum leaves the range of a long
            return total([(F.col("x")[d] * self.n - s) * (F.col("x")[d] * self.n - s) for d, s in enumerate(self.sums)])
        number = partial("CAST({} AS DECIMAL(38, 0))".format)
        terms = []
        for d, s in enumerate(self.sums):
            off = f"try_subtract(try_multiply({number(f'x[{d}]')}, {number(self.n)}), {number(s)})"
            terms.append(f"try_cast(try_multiply({off}, {off}) AS BIGINT)")
        return F.expr(f"aggregate(array({', '.join(terms)}), 0L, (a, b) -> try_add(a, b))")


def vectors(table: DataFrame, id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """(id, x) of the rows that take part, and the number of dimensions."""
    rows = table.select(F.col(id), integers(F.col(vector)).alias("x")).filter("x IS NOT NULL")
    wide = int(rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0])
    return rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(wide) - F.size("x")))), wide


def fit(rows: DataFrame, wide: int, components: int = 4) -> Whitening | None:
    """The whitening of the distinct vectors of (x), or None where there are none."""
    distinct = settled(rows.select("x").distinct(), "whitening")
    exact = [f"CAST(sum(CAST(x[{k}] AS DECIMAL(20, 0))) AS STRING) AS s{k}" for k in range(wide)]
    n, low, high, *sums = distinct.selectExpr("count(*)", "min(array_min(x))", "max(array_max(x))", *exact).first()
    if not n or not wide:
        return None
    sums = [int(s) for s in sums]
    far = 2 * n * max(abs(low), abs(high))
    out = Whitening(n, sums, far, np.zeros((0, wide)), np.zeros(0), 0.0)
    covariance = centred_products(distinct, out.mean) / n
    values, directions = np.linalg.eigh(covariance)
    count = min(components, wide)
    out.values, out.directions, out.trace = values[::-1][:count], directions.T[::-1][:count], float(np.trace(covariance))
    own = [k for k in range(count) if out.used(k)]
    white = distinct.select(*(out.whitened(k).alias(f"w{k}") for k in own))
    pairs = [(a, b) for a in own for b in own if a <= b]
    found = white.agg(*(F.covar_pop(f"w{a}", f"w{b}") for a, b in pairs)).first() if pairs else []
    out.error = max((abs(v - (a == b)) for (a, b), v in zip(pairs, found)), default=0.0)
    return out


def whiten(table: DataFrame, components: int = 4, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of each vector and component from 1."""
    rows, wide = vectors(table, id, vector)
    w = fit(rows, wide, components)
    columns = [F.col(id), *(F.col(f"c.{c}").alias(c) for c in ("component", "n")), "deviation", *(F.col(f"c.{c}").alias(c) for c in ("whitened", "explained")), F.lit(w.error if w else 0.0).alias("identity_error")]
    if w is None:
        nothing = F.struct(F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("whitened"), F.lit(0.0).alias("explained"))
        return rows.filter("false").select(id, nothing.alias("c"), F.lit(0).cast("long").alias("deviation")).select(*columns)
    share = [float(v / w.trace) if w.trace else 0.0 for v in w.values]
    each = [F.struct(F.lit(k + 1).alias("component"), F.lit(w.n).cast("long").alias("n"), w.whitened(k).alias("whitened"), F.lit(share[k]).alias("explained")) for k in range(len(share))]
    return rows.select(id, w.deviation().alias("deviation"), F.array(*each).alias("cs")).select(id, "deviation", F.explode("cs").alias("c")).select(*columns)
