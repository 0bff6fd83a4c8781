"""Each query against its SQL, on the smallest tables."""

import glob
import os

import pytest

from scanloom.plans import catalog, files, scans  # noqa: F401  files and scans add their queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def base():
    import duckdb

    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, base, name):
    df = catalog.queries()[name](spark, SF)
    found = base.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in found.description]
    columns = sorted(df.columns)
    assert sorted(names) == columns
    want = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in found.fetchall())
    assert sorted(repr(tuple(row[c] for c in columns)) for row in df.collect()) == want


def test_whole_tables(spark, tmp_path):
    """Rigs without a seventh camera or with one alone; turns with gaps, odd starts and repeats, in odd conversations too."""
    from statistics import median

    ids = [k for k in range(34) if k not in (7, 13, 17)] + [49]
    vec = {k: [((k * 37 + j * 11) % 23) / 7 for j in range(4)] for k in ids}
    spark.createDataFrame(list(vec.items()), "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    turns = {1: [0, 1, 2, 3], 2: [3, 4, 7], 3: [1, 4, 5], 4: [0, 4], 5: [0, 0, 1], 6: [5]}
    spark.createDataFrame([(c, t) for c, ts in turns.items() for t in ts], "conv_id long, turn long").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {n: catalog.queries()[n](spark, str(tmp_path)).collect() for n in ("rig_baselines", "rig_ranges", "rig_cylinders", "rig_references", "turn_times")}

    rigs = {g: [vec[k] for k in ids if k // 10 == g] for g in {k // 10 for k in ids}}
    far = {g: [sum((p - q) ** 2 for p, q in zip(a[:3], b[:3])) ** 0.5 for a, b in zip(v, v[1:])] for g, v in rigs.items()}
    near = lambda x: pytest.approx(x, abs=1e-6)
    assert {r.rig: r.baseline for r in got["rig_baselines"]} == {g: near(median(d) if d else 0.06) for g, d in far.items()}
    assert {r.rig: (r.points, r.min_fx, r.max_cy) for r in got["rig_ranges"]} == {g: (len(v), near(min(x[2] for x in v)), near(max(x[1] for x in v))) for g, v in rigs.items()}
    assert {r.rig: (r.f, r.y0) for r in got["rig_cylinders"]} == {g: (near(median(x[0] for x in v)), near(median(x[1] for x in v))) for g, v in rigs.items()}
    assert {r.rig: r.sensor_id for r in got["rig_references"]} == {0: "0", 1: "0", 2: "7", 3: "0", 4: "9"}
    times = {c: [round((t - min(ts)) / 15, 6) for t in ts] for c, ts in turns.items()} | {4: [0.0, 0.066667]}  # unique ones from 0 are places
    assert {c: sorted(r.time for r in got["turn_times"] if r.conv_id == c) for c in turns} == {c: near(v) for c, v in times.items()}


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 21
    assert set(catalog.queries()) <= set(__spark_entry__.queries())
