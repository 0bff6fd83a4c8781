"""Toxic spans by a linear-chain conditional random field, and document scores.

Labels mark whole documents. Labelled tokens are made from them: a feature of
words (the word, or its first letters) that toxic documents hold far more often
than clean ones marks its tokens as toxic where the document is labelled so.
A chain over the states clean and toxic is fitted to those tokens by gradient
ascent on the conditional likelihood. Forward-backward marginals of each token
add up to features of the document (expected toxic tokens, the highest marginal,
the share), which a logistic fit turns into a score. Spans are runs of tokens
that are more likely toxic than not.

The fit uses a bounded sample of labelled rows (``FIT_TOXIC`` and ``FIT_CLEAN``
different texts of at most ``FIT_CHARS`` characters, in the order of a hash of
their least ids); scoring reads every whole text, with the texts alone as input.

Away from words that carry a learned feature the chain is at rest: beyond
``MARGIN`` tokens from the next such word a token has the resting marginal, and
messages start there from their resting values.

Defined cases. A null or empty text has no tokens and gets the score of a text
without any evidence. Without labels of both kinds every score is 0. Rows with a
null id count as not held out and never train. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.llm.common import WORD, coded, mix, settled, slices, word_hashes, words_of

#: Bounds of the sample that the model is fitted to.
FIT_TOXIC, FIT_CLEAN, FIT_CHARS = 3_000, 4_000, 50_000

#: A feature needs this many toxic training texts, and this ratio of document rates.
SUPPORT, RATIO = 5, 8.0

PREFIXES = (3, 4, 5, 6)

#: Characters of a word that tells near copies from other texts.
LONG_WORD = 8

MARGIN = 12
BATCH_BYTES = 4 << 20
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_WORD = re.compile(WORD)


def features(word: str) -> list[str]:
    core = _EDGES.sub("", word).lower()
    return [f"={core}", *(core[:n] for n in PREFIXES if len(core) > n)] if core else []


@dataclass
class Chain:
    """weights: of features, toward toxic; bias of any token; step[a, b]: from state a to b."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -6.0
    step: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(4))  # constant, log1p(sum), highest, share
    fitted: bool = False

    def resting(self) -> tuple[np.ndarray, np.ndarray, float]:
        """Forward and backward messages, and the marginal, far from any feature."""
        m = np.exp(self.step) * np.exp([0.0, self.bias])
        f, b = np.ones(2) / 2, np.ones(2) / 2
        for _ in range(200):
            f = f @ m
            f /= f.sum()
            b = m @ b
            b /= b.sum()
        p = f * b
        return f, b, float(p[1] / p.sum())

    def marginals(self, emission: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """P(toxic) of tokens: rows are stretches of text, padded where not ``inside``."""
        start, end, _ = self.resting()
        rows, n = emission.shape
        pot = np.exp(np.stack((np.zeros_like(emission), np.clip(emission, -40, 40)), axis=2))
        step = np.exp(self.step)
        f = np.empty((rows, n, 2))
        m = np.tile(start, (rows, 1))
        for t in range(n):
            m = (m @ step) * pot[:, t]
            m /= m.sum(axis=1, keepdims=True)
            f[:, t] = m
        b = np.tile(end, (rows, 1))
        out = np.empty((rows, n))
        for t in range(n - 1, -1, -1):
            b = np.where(inside[:, t, None], b, end)
            p = f[:, t] * b
            out[:, t] = p[:, 1] / p.sum(axis=1)
            b = (pot[:, t] * b) @ step.T
            b /= b.sum(axis=1, keepdims=True)
        return np.where(inside, out, 0.0)


def _stretches(hot: np.ndarray, ends: np.ndarray, margin: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of tokens within ``margin`` of a hot one, inside documents."""
    doc = np.searchsorted(ends, hot, side="right") - 1
    a, b = np.maximum(hot - margin, ends[doc]), np.minimum(hot + margin + 1, ends[doc + 1])
    new = np.ones(len(hot), bool)
    new[1:] = (a[1:] > b[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return a[first], np.append(b[first[1:] - 1], b[-1:])[: len(first)] - a[first]


def _padded(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = int(lengths.max())
    at = starts[:, None] + np.arange(n)
    inside = np.arange(n) < lengths[:, None]
    return np.where(inside, at, 0), inside


def token_marginals(chain: Chain, emission: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens near evidence and their P(toxic); all others have the resting marginal."""
    hot = np.flatnonzero(emission != 0)
    if not len(hot):
        return np.zeros(0, np.int64), np.zeros(0)
    starts, lengths = _stretches(hot, offsets, MARGIN)
    order = np.argsort(lengths, kind="stable")  # stretches of like length share a block
    where, found = [], []
    for k in range(0, len(order), 256):
        part = order[k : k + 256]
        at, inside = _padded(starts[part], lengths[part])
        p = chain.marginals(emission[at] + chain.bias, inside)
        where.append(at[inside])
        found.append(p[inside])
    where, found = np.concatenate(where), np.concatenate(found)
    order = np.argsort(where, kind="stable")
    return where[order], found[order]


def document_features(chain: Chain, offsets: np.ndarray, where: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Rows of (1, log1p(expected toxic tokens), highest marginal, share of toxic tokens).

    Expected tokens are those beyond rest, so that length alone is no evidence.
    """
    rest = chain.resting()[2]
    n = np.diff(offsets)
    doc = np.searchsorted(offsets, where, side="right") - 1
    total = np.bincount(doc, weights=np.maximum(p - rest, 0.0), minlength=len(n))
    highest = np.where(n > 0, rest, 0.0)
    np.maximum.at(highest, doc, p)
    return np.stack((np.ones(len(n)), np.log1p(total), highest, total / np.maximum(n, 1)), axis=1)


def emissions(chain: Chain, words: pa.Array) -> np.ndarray:
    """The weight of each word's features, 0 for a word without any."""
    code, distinct = coded(words)
    get = chain.weights.get
    own = np.fromiter((sum(get(x, 0.0) for x in features(w)) for w in distinct.to_pylist()), np.float64, len(distinct))
    return own[code]


def sampled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, float]:
    """(doc_id, text, toxic) of the rows to fit to, settled, and the share of toxic ones among all labelled rows."""
    # One label a document: the highest, so that repeated rows can't disagree.
    marked = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marked = marked.filter(~held_out(F.col("doc_id")))
    count = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    # Texts alike count once, so that many copies of one don't fill the sample.
    texts = docs.select("doc_id", "text").filter(F.length("text") <= FIT_CHARS).withColumn("h", F.xxhash64("text"))
    once = texts.select("doc_id", "h").join(marked, "doc_id").groupBy("toxic", "h").agg(F.min("doc_id").alias("doc_id"))
    pick = [once.filter(F.col("toxic") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for v, most in ((1, FIT_TOXIC), (0, FIT_CLEAN))]
    chosen = pick[0].unionByName(pick[1])  # FIT_TOXIC + FIT_CLEAN rows at most, so small enough to broadcast
    rows = texts.join(F.broadcast(chosen), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"])
    return settled(rows.select("doc_id", "text", "toxic").repartition(16), "sample"), count.get(1, 0) / max(1, sum(count.values()))


def _first_of_copies(sample: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the sampled rows without near copies.

    Near copies share a label and all their words: of those with an equal least
    hash over long words, by either of two hashes, one is counted.
    """

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far = np.iinfo(np.uint64).max
        for batch in slices(batches, "text", BATCH_BYTES):
            offsets, words = words_of(batch.column("text"))
            code, distinct = coded(words)
            rank = word_hashes(distinct)
            rank[pc.less(pc.utf8_length(distinct), LONG_WORD).to_numpy(zero_copy_only=False)] = far
            found = [np.where(np.diff(offsets) > 0, np.minimum.reduceat(np.append(h[code], far), offsets[:-1]), far) for h in (rank, np.where(rank == far, rank, mix(rank)))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *(pa.array(f.view(np.int64)) for f in found)], names=["doc_id", "toxic", "p", "q"])

    rows = sample.mapInArrow(least, "doc_id long, toxic int, p long, q long")
    for of in ("p", "q"):
        alone = F.when(F.col(of) == -1, F.col("doc_id")).otherwise(F.col(of))  # -1: all bits, no long word
        rows = rows.withColumn("of", alone).groupBy("toxic", "of").agg(F.min(F.struct("doc_id", "p", "q")).alias("r")).select("r.*", "toxic")
    return rows.select("doc_id", "toxic")


def _marks(sample: DataFrame) -> dict[str, int]:
    """Features that toxic texts hold far more often than clean ones, numbered."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            offsets, words = words_of(batch.column("text"))
            code, distinct = coded(words)
            own, out = [features(w) for w in distinct.to_pylist()], {"f": [], "toxic": []}
            for k, y in enumerate(batch.column("toxic").to_pylist()):
                found = {f for w in np.unique(code[offsets[k] : offsets[k + 1]]).tolist() for f in own[w]}
                out["f"] += found
                out["toxic"] += [y] * len(found)
            yield pa.RecordBatch.from_pydict({"f": pa.array(out["f"], pa.string()), "toxic": pa.array(out["toxic"], pa.int32())})

    counted = settled(_first_of_copies(sample), "counted")
    many = {r["toxic"]: r["count"] for r in counted.groupBy("toxic").count().collect()}
    bad, clean = many.get(1, 0), many.get(0, 0)
    if not bad or not clean:
        return {}
    of = sample.join(F.broadcast(counted.select("doc_id")), "doc_id").select("text", "toxic").mapInArrow(held, "f string, toxic int")
    of = settled(of.groupBy("f").agg(F.sum("toxic").alias("t"), F.count_if(F.col("toxic") == 0).alias("c")).filter(F.col("t") > 0), "features")
    # Among so many features some differ by chance; the likelihood ratio must beat what so many of them reach.
    tested = of.count()
    often = of.filter((F.col("t") >= SUPPORT) & (F.col("t") / bad >= RATIO * (F.col("c") + 0.5) / clean)).orderBy("f").collect()
    return {r.f: k for k, r in enumerate(r for r in often if _ratio(r.t, r.c, bad, clean) >= 2 * np.log(tested))}


def _examples(sample: DataFrame, marks: dict[str, int]) -> list:
    """Rows (toxic, marks of each token) of the stretches to fit to."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            offsets, words = words_of(batch.column("text"))
            code, distinct = coded(words)
            own = [[marks[f] for f in features(w) if f in marks] for w in distinct.to_pylist()]
            y = np.array(batch.column("toxic").to_pylist(), bool)
            starts, lengths = _stretches(np.flatnonzero(np.array([bool(x) for x in own], bool)[code]), offsets, 4)
            # The first words of clean texts teach the other side.
            calm = np.flatnonzero((np.diff(offsets) >= 9) & ~y)
            starts, lengths = np.concatenate((starts, offsets[calm])), np.concatenate((lengths, np.full(len(calm), 9)))
            doc = np.searchsorted(offsets, starts, side="right") - 1
            tokens = [[own[w] for w in code[a : a + n].tolist()] for a, n in zip(starts.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(doc)), pa.array(starts - offsets[doc]), pa.array(y[doc]), pa.array(tokens, pa.list_(pa.list_(pa.int32())))], names=["doc_id", "at", "y", "tokens"])

    found = sample.mapInArrow(cut, "doc_id long, at long, y boolean, tokens array<array<int>>")
    return [(r.y, r.tokens) for r in found.orderBy("doc_id", "at").toLocalIterator()]


def fit_chain(examples: list, marks: dict[str, int]) -> Chain:
    """Weights of a chain by gradient ascent on the likelihood of labelled tokens: those with a mark in a toxic text."""
    blocks, order = [], np.argsort([len(t) for _, t in examples], kind="stable")
    for k in range(0, len(order), 1024):
        part = [examples[x] for x in order[k : k + 1024].tolist()]
        n = max(len(t) for _, t in part)
        inside = np.arange(n) < np.array([len(t) for _, t in part])[:, None]
        has = np.array([[bool(m) for m in t] + [False] * (n - len(t)) for _, t in part], bool)
        goal = has & np.array([y for y, _ in part], bool)[:, None]
        mine = [m for _, t in part for m in t if m]
        cell = np.repeat(np.flatnonzero(has), [len(m) for m in mine])
        blocks.append((inside, goal, cell, np.array([f for m in mine for f in m], np.int64)))
    weight, bias, step = np.zeros(len(marks)), -4.0, np.zeros((2, 2))
    memory = [np.full(len(marks), 1e-8), 1e-8, np.full((2, 2), 1e-8)]
    for _ in range(60):
        grad, g_bias, g_step = -0.02 * weight, -0.001 * bias, -0.02 * step
        for inside, goal, cell, mark in blocks:
            e = np.bincount(cell, weights=weight[mark], minlength=inside.size).reshape(inside.shape) + bias
            p, pairs = _posterior(e, step, inside)
            miss = np.where(inside, goal - p, 0.0)
            grad = grad + np.bincount(mark, weights=miss.ravel()[cell], minlength=len(marks))
            g_bias += miss.sum()
            both = inside[:, 1:]
            state = goal.astype(int)
            g_step = g_step + np.bincount((2 * state[:, :-1] + state[:, 1:])[both], minlength=4).reshape(2, 2) - pairs
        new = []
        for x, g, m, rate in zip((weight, bias, step), (grad, g_bias, g_step), memory, (0.5, 0.3, 0.3)):
            m += g * g
            new.append(x + rate * g / np.sqrt(m))
        memory[1] = memory[1] + g_bias * g_bias
        weight, bias, step = new
    return Chain({f: float(weight[k]) for f, k in marks.items() if weight[k]}, float(bias), step, fitted=True)


def fit_scale(x: np.ndarray, y: np.ndarray, prior: float) -> np.ndarray:
    """A logistic fit of document features, both kinds weighed by their share among labelled rows, by Newton steps."""
    balance = np.where(y, prior / y.sum(), (1 - prior) / (~y).sum()) * len(y)
    theta = np.zeros(4)
    for _ in range(50):
        s = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        h = (x * (balance * s * (1 - s))[:, None]).T @ x + 0.05 * np.eye(4)
        theta += np.linalg.solve(h, x.T @ (balance * (y - s)) - 0.05 * theta)
    return theta


def train(docs: DataFrame, labels: DataFrame) -> Chain:
    """Fit to a bounded sample of the labelled rows that are not held out.

    Counts of features, stretches of tokens and features of documents are made
    where the rows are; the driver gets the marks, the stretches around them and
    four numbers a sampled row.
    """
    sample, prior = sampled(docs, labels)
    marks = _marks(sample)
    if not marks:
        return Chain()
    chain = fit_chain(_examples(sample, marks), marks)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            offsets, words = words_of(batch.column("text"))
            x = document_features(chain, offsets, *token_marginals(chain, emissions(chain, words), offsets))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *(pa.array(c) for c in x.T)], names=["doc_id", "toxic", *"abcd"])

    rows = np.array(sample.mapInArrow(described, "doc_id long, toxic int, a double, b double, c double, d double").orderBy("doc_id").collect(), np.float64)
    chain.scale = fit_scale(rows[:, 2:], rows[:, 1] > 0, prior)
    return chain


def _ratio(t: int, c: int, bad: int, clean: int) -> float:
    """Twice the log likelihood ratio that a feature's rates differ between the two kinds."""
    p = bad / (bad + clean)
    return 2 * (t * np.log(t / ((t + c) * p)) + (c * np.log(c / ((t + c) * (1 - p))) if c else 0.0))


def _posterior(e: np.ndarray, step: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) of tokens and expected transitions of chains that begin and end freely."""
    rows, n = e.shape
    pot = np.exp(np.stack((np.zeros_like(e), np.clip(e, -40, 40)), axis=2))
    k = np.exp(step)
    f, b = np.empty((rows, n, 2)), np.ones((rows, n, 2))
    f[:, 0] = pot[:, 0] / pot[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, n):
        m = (f[:, t - 1] @ k) * pot[:, t]
        f[:, t] = m / m.sum(axis=1, keepdims=True)
    for t in range(n - 2, -1, -1):
        m = (pot[:, t + 1] * b[:, t + 1]) @ k.T
        b[:, t] = np.where(inside[:, t + 1, None], m / m.sum(axis=1, keepdims=True), 1.0)
    p = f * b
    p /= p.sum(axis=2, keepdims=True)
    pair = f[:, :-1, :, None] * k * (pot * b)[:, 1:, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    return p[:, :, 1], pair[inside[:, 1:]].sum(axis=0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score(docs: DataFrame, chain: Chain, keep: bool = False) -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) of every row; ``keep`` adds the other columns of ``docs``."""
    rest = [f for f in docs.schema.fields if f.name != "doc_id" and keep]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            texts = batch.column("text")
            offsets, words = words_of(texts)
            if chain.fitted:
                where, p = token_marginals(chain, emissions(chain, words), offsets)
                z = document_features(chain, offsets, where, p) @ chain.scale
                value = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            else:
                where, p, value = np.zeros(0, np.int64), np.zeros(0), np.zeros(batch.num_rows)
            spans = [""] * batch.num_rows
            toxic = where[p >= 0.5]
            doc = np.searchsorted(offsets, toxic, side="right") - 1
            for d in np.unique(doc).tolist():
                spans[d] = _spans(texts[d].as_py(), (toxic[doc == d] - offsets[d]).tolist())
            out = {"doc_id": batch.column("doc_id"), "score": value, "predicted": (value >= 0.5).astype(np.int32), "spans": spans}
            yield pa.RecordBatch.from_pydict(out | {f.name: batch.column(f.name) for f in rest})

    cols = ["doc_id", *(f.name for f in rest)] if keep else ["doc_id", "text"]
    more = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rest)
    out = docs.select(*cols).mapInArrow(scored, f"doc_id long, score double, predicted int, spans string{more}")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "spans", *(f.name for f in rest))


def _spans(text: str, tokens: list[int]) -> str:
    """start:end of runs of neighbouring tokens, in code points."""
    at = [m.span() for m in _WORD.finditer(text)]
    runs: list[list[int]] = []
    for t in tokens:
        if runs and t == runs[-1][1] + 1:
            runs[-1][1] = t
        else:
            runs.append([t, t])
    return ",".join(f"{at[a][0]}:{at[b][1]}" for a, b in runs)
