"""Operators of documents, pages and vectors: brute force, round trips, and odd rows."""

import hashlib
import math
import os
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scanloom.llm import common, components, embedding_search, jpeg, main_text, mixing, ngram_join, packing, pii, substring_dedup, token_store, tokens, toxicity

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, size long, h long, keys string, length string"

#: Nulls, empties, white space, repeated rows, one id with two texts, a very long text, odd characters.
ODD = [
    (None, "some words without an id here", "a"), (1, None, "a"), (2, "", None), (3, " \t\n ", None), (4, "One two three four", "b"), (4, "One two three four", "b"),
    (5, "one TWO three four", ""), (6, "un mot", "c"), (6, "another text of the same id", "c"), (7, "w " * 30_000, "b"), (8, "é x   \U0001f600 ́ z\x00", "d"),
    (9, " ".join(f"k{n}" for n in range(40)), "e"), (10, " ".join(f"k{n}" for n in range(41)), "e"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, None, 5, "x", "y") for r in ODD], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return WORD.findall(text or "")


# --- shared helpers ------------------------------------------------------------------


def test_words_by_bytes():
    texts = ["", None, "a b", " a  b ", "b\x0bA\x0c", "é   é", "x", "a b c"]
    w = common.hashed_words(pa.array(texts))
    assert np.diff(w.offsets).tolist() == [len(words(t)) for t in texts]
    flat = [x for t in texts for x in words(t)]
    assert [bytes(w.data[a:b]).decode() for a, b in zip(w.starts, w.ends)] == flat
    assert len({(x, h) for x, h in zip(flat, w.hashes.tolist())}) == len(set(flat)) == len(set(w.hashes.tolist()))
    assert common.hashed_words(pa.array(["A b"]), lower=True).hashes.tolist() == common.hashed_words(pa.array(["a B"]), lower=True).hashes.tolist()
    assert common.hashed_words(pa.array(texts).slice(2, 3)).hashes.tolist() == w.hashes[w.offsets[2] : w.offsets[5]].tolist()
    random.seed(0)
    many = {"".join(random.choice("abcdefgh") for _ in range(random.randint(1, 9))) for _ in range(200_000)}
    assert len(set(common.hashed_words(pa.array([" ".join(sorted(many))])).hashes.tolist())) == len(many)


def test_components(spark):
    random.seed(2)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1040)]
    group = {}
    root = lambda x: x if group.setdefault(x, x) == x else root(group[x])
    for a, b in links:
        a, b = root(a), root(b)
        group[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got.get(x, x) == root(x) for x in group)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1: n-gram join --------------------------------------------------------------------


def shingles(text, n):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def linked(rows, like):
    """Component of each id by comparing all pairs; rows of one id are one document."""
    sets = [(i, shingles(t, like.n)) for i, t in rows if i is not None]
    group = {i: i for i, _ in sets}
    root = lambda x: x if group[x] == x else root(group[x])
    for k, (a, s) in enumerate(sets):
        for b, t in sets[:k]:
            if s and t and like.den * len(s & t) >= like.num * len(s | t):
                x, y = root(a), root(b)
                group[max(x, y)] = min(x, y)
    return {i: root(i) for i in group}


@pytest.mark.parametrize("like", [ngram_join.Similarity(3, 90, 100), ngram_join.Similarity(), ngram_join.Similarity(1, 70, 100)])
def test_ngram_join(spark, like):
    random.seed(like.n)
    base = [[random.choice("abcdefghijklmnopqrstuvwxyz") + str(random.randrange(50)) for _ in range(n)] for n in (3, 9, 10, 11, 12, 20, 60, 61, 200) for _ in range(3)]
    texts = []
    for b in base:
        for edits in (0, 0, 1, 1, 2, 3, 5):
            w = list(b)
            for _ in range(edits):
                w[random.randrange(len(w))] = f"new{random.randrange(10**6)}"
            texts.append(" ".join(w[: len(w) - random.randrange(2)]))
    rows = list(enumerate(texts)) + [(None, texts[0]), (500, None), (501, ""), (502, "Solo"), (503, "solo")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in ngram_join.near_duplicates(df, like).collect()}
    want = linked(rows, like)
    assert {i: r.component_id for i, r in got.items()} == want | {None: None}
    assert all(got[i].n_shingles == len(shingles(t, like.n)) for i, t in rows)


def test_ngram_join_odd(odd, none):
    like = ngram_join.Similarity(3, 90, 100)
    got = ngram_join.near_duplicates(odd, like).collect()
    want = linked([r[:2] for r in ODD], like)
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in got) == sorted((i or -1, len(shingles(t, 3)), want.get(i, -1) or -1) for i, t, _ in ODD)
    assert ngram_join.near_duplicates(none, like).count() == 0


def test_ngram_join_ids_come_later(spark):
    """Rows without an id, first in the task, file nothing for those with one."""
    like, rng = ngram_join.Similarity(), random.Random(4)
    rows, near = [], []
    for k in range(12):
        w = [f"w{rng.randrange(10**6)}" for _ in range(80)]
        rows += [(None, " ".join(w)), (2 * k, " ".join(w))]
        near.append((2 * k + 1, " ".join(w[:-1] + ["other"])))
    df = spark.createDataFrame([r for r in rows if r[0] is None] + [r for r in rows if r[0] is not None] + near, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(df, like).collect()}
    assert got == {i: i - i % 2 for i in range(24)} | {None: None}


def test_bound_and_cells():
    """Two sets that link share a cell, whatever their sizes."""
    like, rng = ngram_join.Similarity(3, 90, 100), np.random.default_rng(1)
    ends = like.bands()
    for n in [*range(9, 40), 90, 91, 135, 136, 500, 2000]:
        a = rng.integers(0, 1 << 63, n, np.uint64)
        cut = like.most(2 * n) // 2
        gone = rng.permutation(n)[:cut]
        b = np.concatenate((np.delete(a, gone), rng.integers(0, 1 << 63, max(0, like.most(2 * n - cut) - cut), np.uint64)))
        if like.den * len(np.intersect1d(a, b)) < like.num * len(np.union1d(a, b)):
            continue
        keys = []
        for s in (a, b):
            m = np.array([len(s)])
            band = np.searchsorted(ends, m, side="right") - 1
            offsets = np.array([0, len(s)])
            own = ngram_join._cells(like, offsets, s, np.array([0]), band, ends)[1].tolist() if band[0] >= 0 else []
            up = ngram_join._cells(like, offsets, s, np.array([0]), band + 1, ends)[1].tolist() if m[0] * like.den >= ends[band[0] + 1] * like.num else []
            # In any order alike for both, the first ones that each files share one.
            top = [ends[band[0] + 1 + k] - 1 for k in (0, 1)]
            order = lambda k: (k * 0x9E3779B1 >> 7) % 4
            keys.append({k for part, t in zip((own, up), top) for k in sorted(part, key=lambda k: (order(k), k))[: int(ngram_join._needed(like, m[0], t))]})
        assert keys[0] & keys[1], n


@pytest.mark.parametrize("shuffled", [False, True])
def test_ngram_join_in_any_order(spark, shuffled):
    """Rows without an id, other texts of an id, and texts of one id that link to different documents."""
    like, rng = ngram_join.Similarity(3, 90, 100), random.Random(7)

    def pair():
        w = [f"w{rng.randrange(10**6)}" for _ in range(400)]
        return " ".join(w), " ".join(w[:-1] + ["other"])

    (t, n), (u, v), (x, y), (p, q), (r, _) = (pair() for _ in range(5))
    rows = [(None, t), (5, t), (9, n), (15, "other text"), (15, u), (19, v), (25, x), (25, p), (29, y), (31, q), (41, r), (42, "other text"), (15, None)]
    df = spark.createDataFrame(rows[::-1] if shuffled else rows, "doc_id long, text string").coalesce(1)
    got = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.near_duplicates(df, like).collect()}
    assert got == {(None, 398): None, (5, 398): 5, (9, 398): 5, (15, 1): 15, (15, 398): 15, (15, 0): 15, (19, 398): 15, (25, 398): 25, (29, 398): 25, (31, 398): 25, (41, 398): 41, (42, 1): 15}


def test_ngram_join_of_large_groups(spark, monkeypatch):
    """Chains of near copies in which each links to few others, in chunks and boxes of a few members."""
    monkeypatch.setattr(ngram_join, "CHUNK", 6)
    monkeypatch.setattr(ngram_join, "LEAF", 2)
    like, rng, rows = ngram_join.Similarity(), random.Random(9), []
    for group in range(3):
        w = [f"w{rng.randrange(10**6)}" for _ in range(90)]
        for k in range(30):
            if k % 5 == 0:
                now = list(w)
            now[rng.randrange(90)] = f"new{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(now)))
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), like).collect()}
    assert got == linked(rows, like)


def near_rows(sizes, seed):
    """Rows of a random text of each size, and of two that are nearer and nearer to it."""
    rng, texts = random.Random(seed), []
    for n in sizes:
        w = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        texts += [w, w[:-1] + ["other"], w[: n - n // 20]]
    return [(k, " ".join(w)) for k, w in enumerate(texts)]


def test_ngram_join_in_groups_of_slabs(spark, monkeypatch):
    """More repeated blocks than a sketch is for: slabs are dealt to several, and nothing is lost."""
    like, rows = ngram_join.Similarity(), near_rows([*range(5, 60, 4), 90, 135, 200, 310, 450, 700, 1000], 3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    every = common.settled(ngram_join.points(df, like), "points")
    parts = ngram_join.frequencies(every)
    counted = every.select(F.explode(F.concat("own", "up")).alias("key")).groupBy("key").count().filter("count > 1")
    assert sum(p.count() for p in parts) == counted.count() and all(p.exceptAll(counted).count() == 0 for p in parts)
    counted = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    whole = {(r.key, r.node) for r in ngram_join.filed(every, counted, like).collect()}
    groups = [{(r.key, r.node) for r in ngram_join.filed(every, counted, like, k, 8).collect()} for k in range(8)]
    assert set().union(*groups) == whole and sum(map(len, groups)) == len(whole) and sum(map(bool, groups)) > 4
    used, filed = [], ngram_join.filed
    monkeypatch.setattr(ngram_join, "SKETCHED", 10)
    monkeypatch.setattr(ngram_join, "filed", lambda *a: used.append(a[3:]) or filed(*a))
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(df, like).collect()}
    assert got == linked(rows, like) and used == [(k, 8) for k in range(8)]


def test_ngram_join_drops_the_blocks(spark, monkeypatch):
    """The keys of all blocks, most of what is settled, are gone when sets are, and their counts are made in parts."""
    steps, made, settled = [], {}, ngram_join.settled

    def watched(df, name, *done, **how):
        out = settled(df, name, *done, **how)
        made[out.settled_path.removeprefix("file://")] = name
        steps.append((name, sorted(n for p, n in made.items() if os.path.isdir(p))))
        return out

    monkeypatch.setattr(ngram_join, "settled", watched)
    rows = near_rows((30, 60, 90), 5)
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == linked(rows, ngram_join.Similarity())
    there = dict(steps)
    assert "points" in there["frequencies"] and not {"points", "frequencies", "filed"} & set(there["sets"])
    assert [n for n, _ in steps].count("frequencies") == ngram_join.PARTS


def test_shuffles_end_with_their_write(spark, monkeypatch):
    """Shuffle files of a settled table go at once, though nothing collects the driver's garbage."""
    import time

    monkeypatch.setattr(common, "drop_finished_shuffles", lambda spark: None)
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    before, rows = files(), spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    out = common.settled(rows, "counts")
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.2)
    assert files() <= before and out.count() == rows.count() == 7
    assert spark.conf.get(common.CLEANUP, "false") == "false"


def test_boxes():
    like, rng = ngram_join.Similarity(), np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, 120).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(60)]
    sets += [np.unique(np.concatenate((s[:-4], rng.integers(0, 1 << 63, 4, np.uint64)))) for s in sets]
    counts = np.stack([np.bincount((common.mix(s) & np.uint64(63)).astype(np.int64), minlength=64) for s in sets])
    size = np.array([len(s) for s in sets])
    tree = ngram_join.Boxes(counts, size)
    for k, s in enumerate(sets):
        want = [j for j, t in enumerate(sets) if like.den * len(np.intersect1d(s, t)) >= like.num * len(np.union1d(s, t))]
        near = tree.near(counts[k], int(size[k]), like).tolist()
        assert set(want) <= set(near) and len(near) < len(sets)
    nodes = [i for i in range(120)]
    found = ngram_join.spanning(np.array(nodes), np.array(nodes), [c.astype("<u2").tobytes() for c in counts], [s.tobytes() for s in sets], np.array(nodes), np.array(nodes), like)
    assert {(min(a, b), max(a, b)) for a, b in found} >= {(k, k + 60) for k in range(60)} and len(found) == 60


# --- 2: pages ------------------------------------------------------------------------


PAGE = (
    '<html><head><title>t</title></head><body><header><h1>Site</h1></header><nav><ul><li>Home<li>News</ul></nav><main><div class="sidebar">side</div>'
    "<article><h1>T &amp; U</h1><p>a  b<br>c<p>d <b>e</p><p>f</b>&nbsp;g<script>x<y</script></p><aside>n</aside><ul><li>one<li>two</ul></article>"
    '<div id="comments"><article>reader</article></div></main><form>q</form><footer>x</footer>'
)


def test_page():
    assert main_text.main_text(PAGE, {}) == "T & U\n\na b c\n\nd e\n\nf g\n\none\n\ntwo"
    branches = main_text.branches_of(main_text.parsed(PAGE))
    assert sum(b["own"] for b in branches) == len(main_text.parsed(PAGE).out) and max(b["below"] for b in branches) >= 6
    assert main_text.main_text(None, {}) == main_text.main_text("", {}) == "" and main_text.branches_of(main_text.parsed(None)) == []
    assert main_text.main_text("plain &lt;text&gt;<p>unclosed", {}) == "plain <text>\n\nunclosed"
    assert main_text.main_text("<nav>all noise</nav>", {}) == ""


@pytest.mark.parametrize("html", ["<div>" * 20_000 + "deep" + "</div>" * 20_000, "<div>" * 20_000 + "deep", "<p>deep" * 60_000, "<ul>" + "<li>deep" * 60_000, "<b>" * 30_000 + "deep" + "</i>" * 30_000])
def test_long_and_deep_pages(html):
    import time

    began = time.process_time()
    assert set(main_text.main_text(html, {}).split("\n\n")) == {"deep"} and main_text.branches_of(main_text.parsed(html))
    assert time.process_time() - began < 10


def test_site_tree(spark):
    rows = [(k, f"http://h.org/{k}", f'<div class="box"><p>same on all pages</p></div><div class="body"><p>text number {k}</p><p>and more of {k}</p></div>') for k in range(5)]
    rows += [(8, "http://other.org/", '<div class="box"><p>same on all pages</p></div>'), (9, None, None), (10, "nonsense", "")]
    rows += [(20 + k, f"http://copies.org/{k}", "<article><h1>t</h1><p>copy</p></article>") for k in range(6)]
    # The same article on pages of different menus, and a form of words that all pages fill in.
    rows += [(30 + k, f"http://menus.org/{k}", f"<div><p>menu {k}</p></div><article><h1>t</h1><p>copy</p></article>") for k in range(6)]
    rows += [(40 + k, f"http://forms.org/{k}", f"<div>{k} readers</div><div>" + "".join(f"<p>{k} says {j}</p>" for j in range(k + 1)) + "</div>") for k in range(6)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "page_id long, url string, html string, host string, tree long, branches string")
    got = {r.page_id: r for r in main_text.extract(df).collect()}
    assert [got[k].text for k in range(5)] == [f"text number {k}\n\nand more of {k}" for k in range(5)]
    assert got[8].text == "same on all pages" and got[9].text == got[10].text == "" and got[9].n_chars == 0
    assert {got[20 + k].text for k in range(6)} == {got[30 + k].text for k in range(6)} == {"t\n\ncopy"}
    assert [got[40 + k].text for k in range(6)] == ["\n\n".join(f"{k} says {j}" for j in range(k + 1)) for k in range(6)]
    assert main_text.extract(df.limit(0)).count() == 0


def marked(page):
    """Blocks of the article that a page of the table marks."""
    import html as h

    art = page[page.index("<article>") : page.index("</article>")]
    parts = [re.sub(r"\s+", " ", h.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " ")))).strip() for x in re.split(r"</?p>|</?h1>", art)]
    return "\n\n".join(p for p in parts if p)


def test_pages_of_the_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in main_text.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        assert r.text == marked(r.html) and r.n_chars == len(r.text)


def test_tree_without_marks(spark):
    """Of pages whose elements and names say nothing, the tree alone removes menus, adverts and footers."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    mute = F.regexp_replace(F.regexp_replace("html", '<div class="ad">', "<div>"), "<(/?)(nav|footer|article)>", "<$1div>")
    got = main_text.extract(pages.withColumn("html", mute)).select("page_id", "text").join(pages.select("page_id", "html"), "page_id").collect()
    assert sum(r.text == marked(r.html) for r in got) >= 0.99 * len(got)


# --- 3: toxicity -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def toxic_rows(spark):
    random.seed(5)
    good, bad = [f"word{k}" for k in range(200)], ["vile", "nasty", "awful"]
    rows = []
    for i in range(1500):
        y = i % 5 == 0
        t = [random.choice(good) for _ in range(random.randint(5, 60))]
        for _ in range(random.randint(1, 3) if y else 0):
            t.insert(random.randrange(len(t)), random.choice(bad) + random.choice(["", ",", "!"]))
        rows.append((i, " ".join(t), int(y)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_toxicity(spark, toxic_rows):
    chain = toxicity.train(toxic_rows, toxic_rows.select("doc_id", "toxic", F.lit(1).alias("quality")))
    out = toxicity.score(toxic_rows.withColumn("score", F.lit(9)), chain).join(toxic_rows, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert 200 < len(held) < 400 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.98
    assert all((r.score >= 0.5) == bool(r.predicted) and 0 <= r.score <= 1 for r in out)
    for r in out:
        if r.predicted:
            spans = [tuple(map(int, s.split(":"))) for s in r.spans.split(",")]
            assert any(re.match("vile|nasty|awful", r.text[a:b]) for a, b in spans)


def test_toxicity_odd(spark, toxic_rows, odd, none):
    chain = toxicity.train(toxic_rows, toxic_rows)
    got = toxicity.score(odd, chain).collect()
    assert len(got) == len(ODD) and all(r.predicted == 0 for r in got) and [r.held_out for r in got if r.doc_id is None] == [False]
    assert toxicity.score(none, chain).count() == 0
    unlabelled = toxicity.train(toxic_rows, toxic_rows.limit(0))
    assert {r.score for r in toxicity.score(odd, unlabelled).collect()} == {0.0}
    assert toxicity.score(odd, chain, keep=True).columns == ["doc_id", "held_out", "score", "predicted", "spans", *SCHEMA.replace(" long", "").replace(" string", "").split(", ")[1:]]


def test_marginals():
    """Forward-backward against the sum over all paths, between messages at rest."""
    rng = np.random.default_rng(0)
    chain = toxicity.Chain(bias=-1.0, step=rng.normal(size=(2, 2)))
    e = rng.normal(size=(1, 5))
    start, end, _ = chain.resting()
    total, hot = 0.0, np.zeros(5)
    for path in range(32):
        s = [path >> k & 1 for k in range(5)]
        p = sum(start[a] * np.exp(chain.step[a, s[0]]) for a in (0, 1)) * np.prod([np.exp(e[0, k] * s[k]) for k in range(5)])
        p *= np.prod([np.exp(chain.step[s[k], s[k + 1]]) for k in range(4)]) * end[s[4]]
        total += p
        hot += p * np.array(s)
    assert np.allclose(chain.marginals(e, np.ones((1, 5), bool))[0], hot / total)


# --- 4: personal data --------------------------------------------------------------------


def base_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(x) for x in m[0] if x.isdigit()][::-1]
        if 12 <= len(d) <= 19 and sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d)) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_plain_spans(docs):
    random.seed(3)
    for _ in range(20_000):
        t = "".join(random.choice(["a", "b.", "@", "@", "1", "22", "333", ".", ".", "-", " ", "+", "(", "é", "_", "255", "٣"]) for _ in range(random.randint(0, 40)))
        assert pii.plain_spans(t) == base_spans(t), t
    for r in docs.collect():
        assert pii.plain_spans(r.text) == base_spans(r.text)


@pytest.mark.parametrize("text, found", [
    ("mail john [at] example [dot] com now", ["john [at] example [dot] com"]),
    ("mail john at mail dot example dot com now", ["john at mail dot example dot com"]),
    ("john.doe(AT)mail.example.org!", ["john.doe(AT)mail.example.org"]),
    ("card four one one one 1111 1111 1111 x", ["four one one one 1111 1111 1111"]),
    ("ip one nine two dot one six eight dot one dot one.", ["one nine two dot one six eight dot one dot one"]),
    ("call plus one five five five one two three four five six seven", ["plus one five five five one two three four five six seven"]),
    ("jоhn@exаmple.com", ["jоhn@exаmple.com"]),
    ("４１１１ １１１１ １１１１ １１１１", ["４１１１ １１１１ １１１１ １１１１"]),
    ("correo: ana (arroba) sitio (punto) es", ["ana (arroba) sitio (punto) es"]), ("max klammeraffe web punkt de", ["max klammeraffe web punkt de"]),
    ("luc [arobase] site [point] fr", ["luc [arobase] site [point] fr"]), ("mail jane at example.com now", ["jane at example.com"]),
    ("ask jane.doe at example.com", ["jane.doe at example.com"]), ("tel más tres cuatro nueve uno dos tres cuatro cinco seis", ["más tres cuatro nueve uno dos tres cuatro cinco seis"]),
    ("mail me at the dot com", []), ("we met at noon.com and left", []), ("un homme neuf", []),
    ("look at that, one of two dots at the end", []), ("été à Noël. Ein Wort.", []), ("", []),
])
def test_disguises(text, found):
    assert [text[a:b] for _, a, b in pii.all_spans(text)[1]] == found


def test_planted_disguises():
    """Recall on disguises of all languages between words of the corpus, and precision on these words alone."""
    rng, found, total, wrong = random.Random(5), 0, 0, 0
    said = {v: [w for w, d in pii.DIGIT_WORDS.items() if d == v] for v in "0123456789"}
    fill = "the of rend and that ing tion edonth enhaou les des que para con der die und nicht".split()
    for _ in range(600):
        at, dot = rng.choice(pii.AT_WORDS), rng.choice(pii.DOT_WORDS)
        left, right = (" ".join(rng.choice(fill) for _ in range(rng.randint(3, 30))) for _ in range(2))
        digits = lambda n: " ".join(rng.choice(said[str(rng.randrange(10))]) for _ in range(n))
        hidden = rng.choice([
            f"user{rng.randrange(99)} ({at}) host{rng.randrange(99)} ({dot}) org", f"user{rng.randrange(99)} {at} host {dot} example {dot} org", f"+1 {digits(9)}",
            "j\u043ehn@ex\u0430mple.com", f"user.{rng.randrange(99)} at example{rng.randrange(9)}.com",
        ])
        text = f"{left} {hidden} {right}"
        spans = [text[a:b] for k, a, b in pii.all_spans(text)[1]]
        total += 1
        found += any(hidden in s or s in hidden and len(s) > 0.8 * len(hidden) for s in spans)
        wrong += len(pii.all_spans(f"{left} {right}")[1])
    assert found >= 0.98 * total and wrong == 0, (found, total, wrong)


@pytest.mark.parametrize("text", ["at" + " " * 10**6, "( " * 500_000 + "at dot", "one " * 250_000, "a at b dot " * 90_000, "+1" + " " * 10**6, "at (" + " " * 10**6 + "dot", "1.1." * 250_000, "x at " * 200_000, "a@b.cd " * 140_000])
def test_long_texts(text):
    import time

    began = time.process_time()
    pii.all_spans(text)
    assert time.process_time() - began < 15


def test_pii_rows(odd, none):
    got = pii.find(odd).collect()
    assert len(got) == len(ODD) and {r.base_sha256 for r in got} == {hashlib.sha256(b"").hexdigest()} and {r.spans for r in got} == {""}
    assert pii.find(none).count() == 0
    assert sorted(map(tuple, pii.mask(odd).collect()), key=repr) == sorted(map(tuple, odd.collect()), key=repr)
    assert pii.masked("a b@c.de, 1.2.3.4", pii.all_spans("a b@c.de, 1.2.3.4")[1]) == "a [EMAIL], [IP]"


# --- 5 and 8: tokens ----------------------------------------------------------------------


def ids_of(text):
    from tokenizers import Tokenizer

    global _TOKENIZER
    try:
        t = _TOKENIZER
    except NameError:
        t = _TOKENIZER = Tokenizer.from_file(tokens.default_tokenizer())
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], np.uint32)


def test_ids(docs):
    odd_texts = [
        "Ab, ab. AB!! É. éÉ, ẖ. H̱x, x12, 5. İ. İx, ab,, .a. %%% <|EndOfText|>. <|endoftext|>., x́. Å, KK.", "", None, " a  b ", "́ x",
        "a b c d\x1ce\x85g", "<|endoftext|> x<|startoftext|>y", "I'm don't 'S ΑΣ ΣΑΣ.", "é 가", "a\x0bb\x0cc\rd", "\U0001f600x 12 345", "\x00a \x00", "'s 't re",
    ]
    texts = odd_texts + [r.text for r in docs.collect()]
    offsets, ids = tokens.encoded(pa.array(texts), tokens.default_tokenizer())
    for k, t in enumerate(texts):
        assert np.array_equal(ids[offsets[k] : offsets[k + 1]], ids_of(t)), t


@pytest.mark.parametrize("plane", ["byte", "bit"])
def test_planes(plane):
    rng = np.random.default_rng(0)
    for a in (np.zeros(1, np.uint32), np.array([1, 2, 49407], np.uint32), rng.integers(0, 1 << 32, 1000, np.uint32), np.arange(65536, dtype=np.uint32)):
        assert np.array_equal(token_store.from_planes(token_store.to_planes(a, plane), len(a), plane), a)


@pytest.mark.parametrize("plane", ["byte", "bit"])
def test_store(docs, plane):
    at = 0
    got = sorted(token_store.stored_tokens(docs, plane=plane).collect())
    for r, d in zip(got, sorted(docs.collect(), key=lambda d: d.doc_id), strict=True):
        e = ids_of(d.text)
        assert tuple(r) == (d.doc_id, at, len(e), zlib.crc32(e.tobytes()))
        at += len(e)


def test_store_odd(odd, none):
    got = token_store.stored_tokens(odd).collect()
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == sorted((i or -1, len(ids_of(t)), zlib.crc32(ids_of(t).tobytes())) for i, t, _ in ODD)
    ends = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    assert token_store.stored_tokens(none).count() == 0


def check_packing(rows, texts, window):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for s in by.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    want = []
    for i, t in texts:
        e = ids_of(t)
        want += [(i, k, k * window, len(e[k * window : (k + 1) * window]), zlib.crc32(e[k * window : (k + 1) * window].tobytes())) for k in range(-(-len(e) // window))]
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(want, key=repr)
    return len(by), -(-sum(r.length for r in rows) // window)


@pytest.mark.parametrize("window", [4096, 512, 100])
def test_packing(docs, window):
    used, least = check_packing(packing.pack(docs, window).collect(), [(d.doc_id, d.text) for d in docs.collect()], window)
    assert used <= 1.02 * least + 1


def test_packing_odd(odd, none):
    check_packing(packing.pack(odd).collect(), [(i, t) for i, t, _ in ODD], 4096)
    assert packing.pack(none).count() == 0


def test_plan():
    rng = np.random.default_rng(4)
    for counts in (rng.integers(0, 4, 4097), np.bincount(rng.integers(1300, 1500, 3000), minlength=4097), np.bincount([2049] * 50, minlength=4097), np.zeros(4097, int)):
        counts[0] = 0
        slots, n = packing.plan(counts, 4096)
        placed, fill = np.zeros(4097, int), np.zeros(n, int)
        for length, a, b, first, _ in slots:
            placed[length] += b - a
            fill[first : first + b - a] += length
        assert np.array_equal(placed, counts) and fill.max(initial=0) <= 4096


# --- 6: mixing -----------------------------------------------------------------------------


def test_targets(spark):
    random.seed(6)
    for _ in range(5):
        sizes = [(f"s{k}", random.choice([0, 1, 10, 100, 10_000])) for k in range(random.randint(1, 9))] + [(None, 50)]
        got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
        order = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
        w = {s: (5, 2, 1)[k % 3] for k, (s, _) in enumerate(order)}
        total, capped = sum(n for _, n in sizes), {}
        while True:
            free = [(s, n) for s, n in sizes if s not in capped]
            share = {s: (total - sum(capped.values())) * w[s] / sum(w[x] for x, _ in free) for s, _ in free}
            over = {s: 3 * n for s, n in free if share[s] > 3 * n}
            if not over:
                break
            capped |= over
        assert all(abs(got[s] - (capped | share)[s]) < 1e-6 for s, _ in sizes)


def test_mixing(docs, odd, none):
    got = mixing.mix_sources(docs).collect()
    assert sorted(got) == sorted(mixing.mix_sources(docs.repartition(7)).collect())
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(0.05 * own[0].target, max(r.size for r in own))
    assert all(r.taken == r.copies * r.size <= 3 * r.size for r in got)
    rows = mixing.mix_sources(odd).collect()
    assert len(rows) == len(ODD) and sorted(r.size for r in rows) == sorted(len(words(t)) for _, t, _ in ODD)
    assert all(r.taken <= 3 * r.size for r in rows) and mixing.mix_sources(none).count() == 0
    heavy = mixing.mix_sources(docs, weight=F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0)).collect()
    assert sum(r.copies for r in heavy if r.doc_id % 2 == 0) > 1.2 * sum(r.copies for r in heavy if r.doc_id % 2)


def test_mixing_without_ids(spark, tmp_path):
    """A third of all rows has no id: they are drawn by chance, not by size, as by SQL."""
    import duckdb

    from scanloom.llm import sql

    random.seed(66)
    rows = [(None if k % 3 == 0 else k, " ".join(f"w{k}" for _ in range(random.randint(1, 30))), "abc"[k // 3 % 3]) for k in range(1800)]
    rows += [(None, "the same text", "a")] * 5 + [(5, "one id", "b"), (5, "with two texts", "b"), (None, None, "c")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = mixing.mix_sources(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect()
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = c.execute(sql.mixing(mixing.FILLS))
    names = [d[0] for d in found.description]
    assert sorted(repr(tuple(r[n] for n in names)) for r in got) == sorted(map(repr, found.fetchall()))
    for s in "abc":
        own = [r for r in got if r.source == s and r.doc_id is None and r.size]
        due = own[0].target / own[0].source_size
        short, long = ([r.copies for r in own if keep(r.size)] for keep in (lambda n: n <= 12, lambda n: n >= 18))
        assert all(abs(sum(x) / len(x) - due) < 0.2 for x in (short, long)), (s, due)


# --- 7: search ----------------------------------------------------------------------------


def brute(rows, k, every):
    v = {i: [int(np.floor(np.float64(64) * np.float64(x))) for x in e] for i, e in rows if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)}
    out = []
    for q in sorted(v):
        if q % every == 0:
            stop = lambda x: max(min(x, (1 << 63) - 1), -(1 << 63))
            s = sorted((-stop(sum(a * b for a, b in zip(v[q], v[i]))), i) for i in v if i != q)[:k]
            out += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s)]
    return out


@pytest.mark.parametrize("case", ["many", "ties", "odd", "large"])
def test_search(spark, case):
    rng = np.random.default_rng(7)
    if case == "many":
        rows = [(i, rng.normal(size=16).tolist()) for i in range(900)]
    elif case == "ties":
        rows = [(i, rng.integers(-1, 2, 4).astype(float).tolist()) for i in range(300)]
    elif case == "odd":
        rows = [(0, [1.0, -2.0]), (20, [1.0]), (3, None), (40, [None, 1.0]), (60, [float("nan"), 1.0]), (80, [float("inf"), 0.0]), (5, []), (None, [1.0, 1.0]), (7, [0.4, 0.4])]
    else:
        rows = [(i, (rng.normal(size=3) * 1e12).tolist()) for i in range(50)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    assert sorted(map(tuple, embedding_search.search(df).collect())) == brute(rows, 20, 20)
    assert embedding_search.search(df.limit(0)).count() == 0


def test_queries_of_one_id(spark):
    rows = [(20, [1.0, 0.0]), (20, [-1.0, 0.0]), (20, [1.0, 0.0]), (1, [2.0, 1.0]), (2, [-3.0, 1.0]), (3, [0.5, 0.0])]
    got = embedding_search.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=2)
    assert sorted(map(tuple, got.collect())) == sorted([(20, 1, 1, 8192), (20, 2, 3, 2048), (20, 1, 2, 12288), (20, 2, 3, -2048)])


# --- 9: repeated windows -------------------------------------------------------------------


def removed(rows, window=13):
    first, out = {}, []
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1 if i is not None else 0):
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, i), i)
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_dedup(spark, docs, odd, none):
    got = lambda df: sorted(map(tuple, substring_dedup.deduplicate(df).collect()), key=repr)
    assert got(docs) == removed([(d.doc_id, d.text) for d in docs.collect()])
    assert got(odd) == removed([(i, t) for i, t, _ in ODD])
    assert substring_dedup.deduplicate(none).count() == 0
    random.seed(9)
    rows = []
    for i in range(120):  # passages of 11 to 15 words at all shifts
        w = [f"u{i}x{k}" for k in range(random.randint(0, 30))]
        n, p = random.randint(11, 15), random.randint(0, 3)
        at = random.randint(0, len(w))
        rows.append((i, " ".join(w[:at] + [f"p{p}y{k}" for k in range(n)] + w[at:])))
    rows += [(7, rows[3][1]), (300, rows[3][1]), (301, "z " * 50), (302, "z " * 13), (303, "z " * 12)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == removed(rows)


def test_dedup_of_few_windows(spark, monkeypatch):
    """Copies and lines that repeat inside one row make no windows, and a common passage few that meet those of others."""
    kept, settled = {}, substring_dedup.settled

    def seen(df, name, *done):
        kept[name] = settled(df, name, *done)
        return kept[name]

    monkeypatch.setattr(substring_dedup, "settled", seen)
    got = lambda rows: sorted(map(tuple, substring_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()), key=repr)
    own = lambda i, n: " ".join(f"u{i}x{k}" for k in range(n))
    rows = [(1, own(1, 40)), (2, own(1, 40)), (2, own(1, 40)), (3, f"{own(3, 20)} and {own(3, 20)}"), (4, None), (None, own(1, 40)), (5, ""), (2, "short")]
    assert got(rows) == removed(rows)
    assert kept["windows"].count() == 0
    line = own("p", 14)
    rows = [(i // 2, f"{own(i, 9)} {line} {own(i, 5)}") for i in range(200)] + [(None, line), (150, line), (150, line), (151, None)]
    assert got(rows) == removed(rows)
    met = kept["windows"].filter("not later").groupBy("h", "g").count()
    assert met.agg(F.max("count")).first()[0] == 1


def test_dedup_of_a_batch():
    h, rows = substring_dedup._rows_with(np.array([0, 0, 0, 1, 1, 2]), np.array([5, 3, 5, 3, 4, 3], np.uint64))
    assert (h.tolist(), rows.tolist()) == ([3, 4, 5], [3, 1, 1])
    assert [len(x) for x in substring_dedup._rows_with(np.array([], int), np.array([], np.uint64))] == [0, 0]
    h, g, ids = (np.array(x) for x in zip((1, 1, 8), (1, 2, 7), (1, 1, 8), (1, 1, 9), (2, 1, 5)))
    assert [x.tolist() for x in substring_dedup._by_id(h, g, ids)] == [[1, 1, 1, 2], [1, 1, 2, 1], [8, 9, 7, 5], [False, True, False, False]]


def test_words_by_single_spaces():
    texts = ["a b  c", "", None, "\td e\nf ", "g", " ", "h i j k", "l\x0bm", "n"]
    w = common.hashed_words(pa.array(texts))
    assert substring_dedup._spaced(w.data, w.starts, w.ends, w.offsets) == [" ".join(words(t)).encode() for t in texts]
    kept = np.arange(len(w.starts)) % 3 > 0
    offsets = np.concatenate(([0], np.cumsum(kept)))[w.offsets]
    flat = [bytes(w.data[a:b]) for a, b in zip(w.starts, w.ends)]
    want = [b" ".join(flat[k] for k in range(a, b) if kept[k]) for a, b in zip(w.offsets[:-1], w.offsets[1:])]
    assert substring_dedup._spaced(w.data, w.starts[kept], w.ends[kept], offsets) == want
    none = common.hashed_words(pa.array([None, ""], pa.string()))
    assert substring_dedup._spaced(none.data, none.starts, none.ends, none.offsets) == [b"", b""]
    assert substring_dedup._spaced(w.data, w.starts[:0], w.ends[:0], 0 * w.offsets) == [b""] * len(texts)


def test_dedup_takes_little_text_at_a_time(spark, monkeypatch):
    """Batches in which all is removed or nothing has words, and texts in slices of a quarter of a MB at most."""
    assert substring_dedup.BATCH_BYTES <= 1 << 18
    monkeypatch.setattr(substring_dedup, "BATCH_BYTES", 1)
    rows = [(i, t) for i in (1, 2, 3, None) for t in (" ".join(f"w{k}" for k in range(30)), "", None, " \t ")]
    got = substring_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=repr) == removed(rows)


@pytest.mark.parametrize("period", range(1, 14))
def test_cover(period):
    cover = substring_dedup.difference_cover(period)
    for i in range(period):
        for j in range(period):
            assert any((i + s) % period in cover and (j + s) % period in cover for s in range(period))
    assert substring_dedup.best_period(13) == 7


# --- 10: media -------------------------------------------------------------------------------


def test_payloads():
    for n in (64, 128, 384, 448, 64 * 37, 64 * 3000, 64 * 40_000):
        p = os.urandom(n) if n < 1e6 else bytes(n)
        rgb, image = jpeg.decode(jpeg.encode_payload(p))
        assert jpeg.payload_of(image) == p and rgb.shape == (image["height"], image["width"], 3)


def slow_file(coef, script):
    """A one-component progressive file of small coefficients (zigzag), scan by scan, by the format's rules."""
    def seg(m, b):
        return bytes([0xFF, m]) + (len(b) + 2).to_bytes(2, "big") + b

    out = b"\xff\xd8" + seg(0xDB, b"\0" + b"\1" * 64) + seg(0xC2, bytes([8, 0, 8, 0, 8 * len(coef), 1, 1, 0x11, 0]))
    every = [r << 4 | s for r in range(16) for s in range(11)]
    for kind in (0, 0x10):
        out += seg(0xC4, bytes([kind]) + bytes([0] * 7 + [len(every)] + [0] * 8) + bytes(every))
    code = lambda sym: f"{every.index(sym):08b}"
    number = lambda v: "" if v == 0 else f"{v if v > 0 else v + (1 << int(abs(v)).bit_length()) - 1:0{int(abs(v)).bit_length()}b}"
    for first, last, high, low in script:
        bits, before = "", 0
        for block in coef:
            if first == 0:
                v = int(block[0]) >> low
                if high:
                    bits += str(v & 1)
                else:
                    bits += code(int(abs(v - before)).bit_length()) + number(v - before)
                    before = v
                continue
            half = lambda x: int(abs(x)) >> low  # noqa: E731, B023
            run, fixes = 0, ""
            new = [k for k in range(first, last + 1) if (half(block[k]) if not high else half(block[k]) == 1)]
            for k in range(first, last + 1):
                m = half(block[k])
                if high and m > 1:
                    fixes += str(m & 1)
                    continue
                if m == 0:
                    run += 1
                    if run == 16 and any(x > k for x in new):
                        bits, fixes, run = bits + code(0xF0) + fixes, "", 0
                    continue
                v = m if block[k] > 0 else -m
                bits += code(run << 4 | (1 if high else m.bit_length())) + (("1" if v > 0 else "0") if high else number(v)) + fixes
                run, fixes = 0, ""
            if run or fixes:
                bits += code(0) + fixes
        bits += "1" * (-len(bits) % 8)
        data = bytes(int(bits[k : k + 8], 2) for k in range(0, len(bits), 8))
        out += seg(0xDA, bytes([1, 1, 0, first, last, high << 4 | low])) + data.replace(b"\xff", b"\xff\0")
    return out + b"\xff\xd9"


def test_other_progressive_files():
    """Sparse coefficients, several bands, two refinements: the general symbol by symbol path."""
    rng = np.random.default_rng(8)
    coef = (rng.normal(size=(5, 64)) * 6 * (rng.random((5, 64)) < 0.4)).astype(int)
    script = [(0, 0, 0, 1), (1, 5, 0, 2), (6, 63, 0, 2), (1, 63, 2, 1), (0, 0, 1, 0), (1, 63, 1, 0)]
    rgb, image = jpeg.decode(slow_file(coef, script))
    assert np.array_equal(image["coef"][1].reshape(5, 64), coef)
    k = np.arange(8)
    basis = np.cos((2 * k[:, None] + 1) * k[None] * np.pi / 16) * np.where(k == 0, np.sqrt(1 / 8), 0.5)
    square = np.zeros((8, 8))
    square.ravel()[jpeg.ZIGZAG] = coef[2]
    assert np.array_equal(rgb[:, 16:24, 0], np.clip(np.rint(basis @ square @ basis.T + 128), 0, 255).astype(np.uint8))


def test_media(odd, none):
    got = jpeg.media(odd, tensors=True).collect()
    by = {(i, t): t for i, t, _ in ODD}
    assert len(got) == len(ODD)
    sizes = sorted(len((t or "").encode()) for _, t, _ in ODD)
    assert sorted(r.n_bytes for r in got) == sizes and by
    for r in got:
        assert r.payload_bytes == max(64, -(-r.n_bytes // 64) * 64) and len(r.rgb) == r.height * r.width * 3
        back = jpeg.payload_of(jpeg.read_coefficients(bytes(r.media)))
        assert hashlib.sha256(back).hexdigest() == r.payload_sha256 and zlib.crc32(back[-64:]) == r.tail_crc32
        assert hashlib.sha256(bytes(r.media)).hexdigest() == r.media_sha256 and r.media_bytes == len(r.media)
        assert back[: r.n_bytes].decode() in {t or "" for _, t, _ in ODD}
    assert len({r.feature for r in got if r.doc_id == 4}) == 1 and jpeg.media(none).count() == 0
    plain = {(r.doc_id, r.media_sha256): r.feature for r in jpeg.media(odd).collect()}
    assert all(plain[r.doc_id, r.media_sha256] == r.feature == jpeg.features(iter([np.frombuffer(r.rgb, np.uint8).reshape(r.height, r.width, 3)])) for r in got)
    assert jpeg.media(none, tensors=True).count() == 0


def test_long_payload_in_little_memory():
    """Encoding, decoding and features hold a few bytes a byte of payload at a time; strips are the whole picture's rows."""
    payload = random.Random(10).randbytes(16 << 20)
    tracemalloc.start()
    try:
        image = jpeg.read_coefficients(jpeg.encode_payload(payload))
        assert b"".join(jpeg.payload_pieces(image)) == payload
        text = jpeg.features(jpeg.strips(image))
        assert tracemalloc.get_traced_memory()[1] < 8 * len(payload)
    finally:
        tracemalloc.stop()
    rgb, image = jpeg.decode(jpeg.encode_payload(payload[: 1 << 20]))
    assert np.array_equal(np.concatenate(list(jpeg.strips(image))), rgb) and len(list(jpeg.strips(image))) > 1
    assert re.fullmatch(r"(\d+:\d+,?){3}", text) and jpeg.features(iter([rgb])) == jpeg.features(jpeg.strips(image))


def test_features_of_a_picture():
    """Means and deviations in hundredths against plain arithmetic."""
    rgb = np.random.default_rng(4).integers(0, 256, (24, 40, 3), np.uint8)
    want = [f"{100 * int(c.sum()) // c.size}:{int(100 * math.sqrt(c.size * int((c.astype(int) ** 2).sum()) - int(c.sum()) ** 2) / c.size)}" for c in (rgb[:, :, k] for k in range(3))]
    assert jpeg.features(iter(np.split(rgb, 3))) == ",".join(want)


def test_batches_of_wide_texts(spark):
    """Whole texts come to the workers in batches of bounded bytes, not of rows alone."""
    common.small_batches(spark)
    wide = spark.range(0, 200, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 1_000_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    assert wide.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0] <= common.BATCH_BYTES + 2_000_000


def test_layout():
    """Sides stay within the format's sixteen bits, and the image within a row of the blocks."""
    for blocks in (0, 1, 6, 7, 193, 6 * 32 * 4095, 6 * 32 * 4095 + 1, 6 * 33 * 4095 + 1, 1 << 25):
        wide, high = jpeg.layout(blocks)
        assert max(wide, high) * 16 < 1 << 16 and 6 * wide * (high - 1) < max(1, blocks) <= 6 * wide * high
    assert jpeg.layout(6 * 32 * 4095) == (32, 4095) and jpeg.layout(6 * 32 * 4095 + 1)[0] == 33
    with pytest.raises(ValueError):
        jpeg.layout(6 * 4095 * 4095 + 1)


def test_media_files(spark, odd):
    """What media() describes lies in the shared folder."""
    top = common.shared_dir(spark).removeprefix("file://")
    before = {d for d in os.listdir(top) if d.startswith("media-")} if os.path.isdir(top) else set()
    got = jpeg.media(odd).collect()
    (new,) = {d for d in os.listdir(top) if d.startswith("media-")} - before
    files = [bytes(r.media) for r in spark.read.parquet(f"{top}/{new}").collect()]
    assert sorted(hashlib.sha256(f).hexdigest() for f in files) == sorted(r.media_sha256 for r in got)


def test_media_features_come_from_settled_tensors(odd, monkeypatch):
    """without tensors in the result, too, features are of RGB columns that were settled and read back, and tensors don't stay."""
    kept, plain = {}, jpeg.settled

    def watched(df, name, *done, **options):
        out = plain(df, name, *done, **options)
        if name == "tensors":
            kept.update({(r.doc_id, r.media_sha256): jpeg.features(iter([np.frombuffer(r.rgb, np.uint8).reshape(r.height, r.width, 3)])) for r in out.collect()})
        return out

    monkeypatch.setattr(jpeg, "settled", watched)
    before = set(os.listdir(top)) if os.path.isdir(top := common.shared_dir(odd.sparkSession).removeprefix("file://")) else set()
    got = jpeg.media(odd).collect()
    assert len(got) == len(ODD) and all(kept[r.doc_id, r.media_sha256] == r.feature for r in got)
    assert not any(d.startswith("tensors-") for d in set(os.listdir(top)) - before)
