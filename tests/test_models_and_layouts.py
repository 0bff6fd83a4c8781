"""Batched models, settings in YAML, layouts in name order, and files by pattern."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scanloom.functions import names
from scanloom.operators import labeling
from scanloom.plans import flows
from scanloom.sources import readers, store, writers


def test_batches_of_like_sizes(spark):
    """How often the model is called, what with, and what becomes of rows that it can't do."""
    def load(weights):
        calls = [0]

        def model(part):
            calls[0] += 1
            n, longest = part["v"].shape
            assert part["v_length"].max(initial=0) == longest and len(part["name"]) == n
            if "bad" in part["name"]:
                raise ValueError("bad row")
            return [f"{calls[0]}:{n}x{longest}:{int(s) * weights}" for s in part["v"].sum(axis=1)]

        return model

    rows = [(k, str(k), [1.0] * (k % 50 + 1)) for k in range(100)] + [(100, "bad", [1.0] * 50), (101, "x", None), (102, None, [1.0])]
    df = spark.createDataFrame(rows, "id long, name string, v array<double>").coalesce(1).withColumn("n", F.size("v"))
    weights = spark.sparkContext.broadcast(3)
    got = {r.id: r for r in readers.infer(df, ["v", "name"], "out", "string", pa.string(), load, weights, batch=10, size="n").collect()}
    assert got[100].out is None and "bad row" in got[100].out_error and (got[101].out, got[101].out_error, got[102].out) == (None, None, None)
    assert all(got[k].out.endswith(f":{3 * (k % 50 + 1)}") and got[k].out_error is None for k in range(100))
    shapes = {k: tuple(map(int, got[k].out.split(":")[1].split("x"))) for k in range(100)}
    assert all(longest - (k % 50 + 1) < 6 for k, (n, longest) in shapes.items() if n > 1)  # little is filled up
    assert len({r.out.split(":")[0] for r in got.values() if r.out}) < 30  # ten to a call, but for the one that failed
    tight = readers.infer(df.filter("id < 100"), ["v", "name"], "out", "string", pa.string(), load, weights, batch=100, size="n", padded=60).collect()
    assert all(np.prod(list(map(int, r.out.split(":")[1].split("x")))) <= 60 or r.out.split(":")[1].startswith("1x") for r in tight)
    wrong = readers.infer(df.limit(3), ["name"], "out", "string", pa.string(), lambda w: lambda part: ["one"] * 2).collect()
    assert all("2 results for 1 rows" in r.out_error for r in wrong)
    assert readers.infer(df.limit(0), ["v", "name"], "out", "string", pa.string(), load, weights).count() == 0


def test_settings(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("name: x\nmap: {1: 10, 2: 20, other: 7, 3: none}\nlist: [a, {b: true}]\nempty: {}\nnothing:\n")
    (tmp_path / "b.yml").write_text("map:\n  1: 11\n")
    (tmp_path / "c.yaml").write_text("a: [1\n")
    got = readers.settings(spark, str(tmp_path))
    leaves = {(os.path.basename(r.path), r.key): r.value for r in got.filter("error IS NULL").collect()}
    assert leaves == {("a.yaml", k): v for k, v in {"name": "x", "map/1": "10", "map/2": "20", "map/other": "7", "map/3": "none", "list/0": "a", "list/1/b": "true", "empty": None, "nothing": None}.items()} | {("b.yml", "map/1"): "11"}
    assert [os.path.basename(r.path) for r in got.filter("error IS NOT NULL").collect()] == ["c.yaml"]
    table = readers.mapping(got, "map").withColumn("file", F.element_at(F.split("path", "/"), -1))
    labels = spark.createDataFrame([(1, "a.yaml"), (1, "b.yml"), (2, "b.yml"), (3, "a.yaml"), (None, "a.yaml")], "label long, file string")
    out = labeling.remap_by(labels, "label", table, "class", ["file"])
    assert sorted(((r.label, r.file), r["class"]) for r in out.collect() if r.label) == [((1, "a.yaml"), 10), ((1, "b.yml"), 11), ((2, "b.yml"), None), ((3, "a.yaml"), None)]
    assert out.count() == 5


@pytest.mark.parametrize("each", [7, 1 << 17])
def test_layout_in_parts(spark, tmp_path, each, monkeypatch):
    monkeypatch.setattr(writers, "PART", each)
    data = [(f"x/{k * 7919 % 1009}_{k}.label", bytearray(np.array([k], "<u4").tobytes())) for k in range(60)]
    kept = store.round_trip(spark.createDataFrame(data, "path string, bytes binary").repartition(3), "layout")
    plan = writers.kitti_plan(kept, "08", each)
    want = {p: f"sequences/08/labels/{k:06d}.label" for k, p in enumerate(sorted(p for p, _ in data))}
    assert {r.source: r.target for r in plan.collect()} == want
    if each == 7:
        assert kept.select(writers.parts_by_name(kept, "path", each)).distinct().count() > 3
    assert flows.kitti_layout(spark, kept, str(tmp_path), "08") == 60
    names_ = sorted(os.listdir(tmp_path / "sequences/08/labels"))
    assert names_ == [f"{k:06d}.label" for k in range(60)]
    first = min(data)
    assert (tmp_path / "sequences/08/labels/000000.label").read_bytes() == bytes(first[1])
    assert flows.kitti_layout(spark, f"{tmp_path}/sequences/08/labels", f"{tmp_path}/again") == 60
    assert flows.kitti_layout(spark, kept.limit(0), f"{tmp_path}/none") == 0


def test_patterns(spark):
    rows = [("a/x_1.bin", b""), ("a/xy1.bin", b""), ("x_1.bin", b""), ("a/x_1.binary", b""), ("a/x_1xbin", b""), ("x_/1.bin", b"")]
    df = spark.createDataFrame([(p, bytearray(c)) for p, c in rows], "path string, content binary")
    found = lambda pattern: sorted(r.path for r in readers.contents(spark, df, pattern).collect())
    assert found("x_*.bin") == ["a/x_1.bin", "x_1.bin"] and len(found("*.bin")) == 4


def test_broken_boxes(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"labels": {"f": [{"box": {"cx": 1, "l": 2, "w": 2, "h": 2}, "action_label": {"walking": 0.9}}]}}')
    (tmp_path / "b.json").write_text('{"labels": ')
    got = readers.boxes(spark, str(tmp_path))
    assert [r.cx for r in got.filter("error IS NULL").collect()] == [1.0] and got.filter("error IS NOT NULL").count() == 1
    points = spark.createDataFrame([("f", 0, 1.5, 0.5, 0.0), ("f", 1, 5.0, 0.0, 0.0)], "frame_id string, point_idx long, x double, y double, z double")
    assert sorted((r.point_idx, r.label) for r in flows.box_labels(points, got).collect()) == [(0, 251), (1, 9)]


def test_times_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(names, "FRAMES", 3)
    data = [("a", k) for k in range(10)] + [("b", k) for k in (0, 4, 5, 11)] + [("c", k) for k in (2, 3, 9)] + [("d", k) for k in (0, 0, 7)]
    got = names.frame_times(spark.createDataFrame(data, "seq string, n long").repartition(3), "seq", "n", 2.0)
    want = [("a", k, k / 2) for k in range(10)] + [("b", n, k / 2) for k, n in enumerate((0, 4, 5, 11))] + [("c", n, (n - 2) / 2) for n in (2, 3, 9)] + [("d", 0, 0.0), ("d", 0, 0.0), ("d", 7, 3.5)]
    assert sorted((r.seq, r.n, r.time) for r in got.collect()) == want and got.columns == ["seq", "n", "time"]
