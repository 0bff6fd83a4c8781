"""Mixing sources to target weights by Pareto order sampling.

Sources get targets in words from weights; no target passes ``cap`` times its
source. Where a target is ``r`` times its source, a document is due ``r`` copies:
the whole part of ``r`` is certain, and the rest, ``f``, is its inclusion
probability in a sample of fixed size. Pareto order sampling draws it: each
document gets a uniform number ``u`` from a hash of its id, documents are ranked
by the ratio of odds ``u / (1 - u)`` over ``f / (1 - f)``, and the head of the
ranking is taken as far as its words stay within what the target still lacks; a
gap left by a long document is filled in ranking order by shorter ones. Inclusion
odds may differ inside a source too: ``weight`` scales each document's share.

Only DataFrame functions are used. A source may hold any share of the rows: its
ranking is cut by a histogram of ranks, summed where the rows are, and only the
rows of the one bin that the cut falls into are put in order.

Defined cases. A null text has size 0 and takes 0 words. A null source is a
source of its own, after all others. An empty table gives no rows. Extra columns
stay out of the result. Rows with equal ids tie; equal rows are interchangeable,
others go by size, then text hash. Reruns agree, as the draw hangs on ids alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scanloom.llm.common import WORD, settled

#: Bins of the histogram of ranks; one bin of a source is ordered by one task.
BINS = 1 << 14

#: Sources whose table of one row each is sent to all tasks; more are joined by shuffles.
FEW = 10_000

#: How often a gap before a long document is filled by shorter ones.
FILLS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """Targets of sources (source, source_size): one row a source, aggregated before.

    Shares go by weight; a target above ``cap`` times its source is set to that
    and the excess is shared again by weight. The fixed point is the level ``c``
    with ``sum(min(cap * size, c * weight)) = sum(size)``, found on running sums
    over sources in the order in which they reach their caps.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = sizes.withColumn("w", w).withColumn("most", F.col("source_size") * F.lit(cap))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    from_here = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    t = t.withColumn("level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(from_here))
    # The first source in that order that stays below its cap settles the level for all.
    first = F.when(F.col("most") >= F.col("level") * F.col("w"), F.struct((F.col("most") / F.col("w")).alias("at"), "level"))
    t = t.withColumn("level", F.min(first).over(everything)["level"])
    return t.select("source", "source_size", F.coalesce(F.least("most", F.col("level") * F.col("w")), F.lit(0.0)).alias("target"))


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5 hash of seed and key."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def _head(rows: DataFrame, eligible: Column, limit: str, name: str, few: bool) -> DataFrame:
    """Add the flag ``name`` to the eligible rows that head their source's ranking.

    The head is as long as its words stay within the column ``limit``, which is
    alike on all rows of a source.
    """
    binned = rows.filter(eligible).groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first(limit).alias("limit"))
    run = Window.partitionBy("source").orderBy("bin")
    cut = binned.withColumn("upto", F.sum("words").over(run)).filter(F.col("upto") > F.col("limit"))
    cut = cut.groupBy(F.col("source").alias("of")).agg(F.min("bin").alias("cut_bin"), F.min(F.col("upto") - F.col("words")).alias("before"))
    rows = rows.join(F.broadcast(cut) if few else cut, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    edge = eligible & (F.col("bin") == F.col("cut_bin"))
    within = Window.partitionBy("source", "bin").orderBy("q", "doc_id", "size", "tie").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.filter(edge).withColumn(name, F.col("before") + F.sum("size").over(within) <= F.col(limit))
    # A source without a cut fits its limit as a whole.
    rest = rows.filter(~F.coalesce(edge, F.lit(False))).withColumn(name, eligible & (F.col("cut_bin").isNull() | (F.col("bin") < F.col("cut_bin"))))
    return inside.unionByName(rest).drop("cut_bin", "before")


def _beside(rows: DataFrame, by_source: DataFrame, few: bool) -> DataFrame:
    """Each row with its source's row; ``few`` says that the number of sources has been checked."""
    by_source = by_source.withColumnRenamed("source", "of")
    return rows.join(F.broadcast(by_source) if few else by_source, F.col("source").eqNullSafe(F.col("of"))).drop("of")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: float = 3.0, seed: int = 7, weight: Column | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, copies, tie) of every row of (doc_id, text, source).

    ``taken`` is ``copies`` times ``size``, ``copies`` at most ``cap``; ``tie`` is the text's hash.
    """
    rows = settled(docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"),
        # Rows without an id draw by their text, each by its own.
        F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce("text", F.lit(""))))).alias("draws_by"),
        (F.lit(1.0) if weight is None else weight.cast("double")).alias("share"),
    ), "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.coalesce(F.try_divide(F.sum(F.col("size") * F.col("share")), F.sum("size")), F.lit(1.0)).alias("mean"))
    sizes = settled(sizes, "mix-sources")
    few = sizes.count() <= FEW
    rows = _beside(_beside(rows, targets(sizes.drop("mean"), weights, cap), few), sizes.select("source", "mean"), few)
    due = F.when(F.col("source_size") > 0, F.least(F.lit(cap), F.try_divide(F.col("target") / F.col("source_size") * F.col("share"), F.col("mean")))).otherwise(0.0)
    rows = rows.withColumn("due", due).withColumn("whole", F.floor(F.col("due") + 1e-12)).withColumn("f", F.greatest(F.col("due") - F.col("whole"), F.lit(0.0)))
    u = uniform(F.col("draws_by"), seed)
    odds = (u / (1 - u)) / (F.col("f") / (1 - F.col("f")))
    # q / (1 + q) has the order of q and lies in (0, 1), so that bins of equal width can count it.
    rows = rows.withColumn("open", (F.col("f") > 1e-12) & (F.col("size") > 0)).withColumn("q", F.when(F.col("open"), odds / (1 + odds)).otherwise(1.0))
    rows = rows.withColumn("bin", F.least(F.floor(F.col("q") * BINS), F.lit(BINS - 1)))

    sure = rows.groupBy("source").agg((F.first("target") - F.sum(F.col("size") * F.col("whole"))).alias("lack"))
    rows = _beside(rows, sure, few).withColumn("lack", F.greatest(F.col("lack"), F.lit(0.0))).withColumn("drawn", F.lit(False))
    rows = settled(rows, "mix-ranks")
    for again in range(1 + FILLS):
        # From the second time on: where the next document in the ranking is too
        # long for what is left, shorter ones after it fill the gap.
        fits = F.col("open") & ~F.col("drawn") & (F.col("size") <= F.col("lack")) if again else F.col("open")
        head = _head(rows, fits, "lack", "more", few)
        rows = settled(head.withColumn("drawn", F.col("drawn") | F.col("more")).drop("more"), "mix-drawn")
        left = rows.groupBy("source").agg((F.first("target") - F.sum(F.col("size") * (F.col("whole") + F.col("drawn").cast("long")))).alias("lack"))
        rows = _beside(rows.drop("lack"), left, few)
    copies = F.col("whole") + F.col("drawn").cast("long")
    copies = F.least(copies, F.lit(int(cap))).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"), "tie")
