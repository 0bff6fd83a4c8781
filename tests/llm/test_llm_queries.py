"""Queries against their SQL on the smallest tables, and the pipeline's stages on their own inputs."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from scanloom.llm import ngram_join, pii, queries, toxicity
from scanloom.llm.common import settled

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    import duckdb

    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = queries.queries()[name](spark, SF)
    found = c.execute(queries.oracle_sql()[name])
    names = [d[0] for d in found.description]
    columns = sorted(df.columns)
    assert sorted(names) == columns
    want = sorted(repr(tuple(row[names.index(x)] for x in columns)) for row in found.fetchall())
    assert sorted(repr(tuple(row[x] for x in columns)) for row in df.collect()) == want


def test_names():
    found = queries.queries()
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in found if k != "pipeline") == list(range(1, 14)) and "pipeline" in found
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        docs = settled(stage(spark, docs, SF), "test-stage")
        if k < 4:
            assert docs.columns == columns
        kept.append((before, docs.collect()))
    # Toxic documents go, others stay.
    before, after = kept[0]
    chain = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    bad = {r.doc_id for r in toxicity.score(spark.read.parquet(f"{SF}/documents.parquet"), chain).filter("predicted = 1").collect()}
    assert {r.doc_id for r in after} == set(before) - bad
    # Of each group of near duplicates the least id stays.
    before, after = kept[1]
    sets, group = {i: shingles(r.text) for i, r in before.items()}, {i: i for i in before}
    def root(x):
        while group[x] != x:
            x = group[x]
        return x
    ids = sorted(before)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                group[max(x, y)] = min(x, y)
    assert {r.doc_id for r in after} == {i for i in ids if root(i) == i}
    # Personal data is masked in place.
    before, after = kept[2]
    assert all(r.text == pii.masked(before[r.doc_id].text, pii.all_spans(before[r.doc_id].text)[1]) and r.n_chars == len(r.text) for r in after)
    # The mix repeats whole documents, three times at most.
    before, after = kept[3]
    assert all(r == before[r.doc_id] for r in after) and max(map([r.doc_id for r in after].count, {r.doc_id for r in after})) <= 3
    # Every copy is packed.
    assert sum(r.piece == 0 for r in kept[4][1]) == len(after)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).filter(F.col("offset") + F.col("length") > 4096).count() == 0


def test_stages_on_odd_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = [(None, "x y z " * 20, None, None, None), (None, None, "en", "s", 3), (1, "", None, "s", 0), (2, "a b c d e f g", "en", None, 13), (2, "a b c d e f g", "en", None, 13), (3, "A b c d e f g", "de", "t", 13)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("size", F.lit("clash"))
    sizes = []
    for _, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, SF), "test-odd")
        sizes.append(docs.count())
    assert sizes[0] == 6 and sizes[1] == 4 and sizes[2] == 4 and labels.count() > 0
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        empty = settled(stage(spark, empty, SF), "test-empty")
        assert empty.count() == 0


def test_a_row_without_words_saves_no_near_duplicate(spark):
    t = " ".join(f"w{k}" for k in range(60))
    n = t.replace("w59", "other")
    rows = [(5, t), (9, n), (9, ""), (9, None), (7, " "), (11, "else " * 9), (11, ""), (11, "")]
    docs = spark.createDataFrame([(i, x, "en", "s", 1) for i, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted([(5, t), (9, ""), (9, None), (7, " "), (11, "else " * 9), (11, "")], key=repr)


def test_join_default():
    assert ngram_join.Similarity() == ngram_join.Similarity(5, 80, 100)
    assert ngram_join.Similarity(1, 2, 3).num == 2
    for wrong in ((1, 50, 100), (3, 66, 100), (3, 101, 100), (0, 90, 100)):
        with pytest.raises(ValueError):
            ngram_join.Similarity(*wrong)
