"""Queries of recordings in pieces, committed files, crowded frames, masks and long sequences."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.functions import names
from scanloom.operators import geometry, labeling, painting, windows
from scanloom.plans import flows
from scanloom.plans.catalog import BOUNDS, POINTS, query
from scanloom.plans.files import STORED, _doubles, _labels, _path, _recording_rows
from scanloom.plans.views import BBOX, CAMERA, points, table
from scanloom.sources import encode, framefiles, jpeg, readers, recordings, store, writers

# --- recordings in pieces, and files that are committed ------------------------------

#: Vectors of a recording, and bytes of a piece of it: several pieces to each.
TOGETHER, PIECE = 200, 1 << 15


def _folder(spark, name: str) -> str:
    return f"{store.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _kept_recordings(spark, d, kind: str, ending: str) -> str:
    """A recording for each ``TOGETHER`` vectors, as files in a folder."""
    rows = _recording_rows(spark, d, F.format_string(f"%d.{ending}", F.expr(f"vec_id div {TOGETHER}")))
    folder = _folder(spark, f"pieces-{kind}")
    framefiles.write(encode.recording_files(rows, kind), folder)
    return folder


def _per_topic(messages: DataFrame) -> DataFrame:
    rows = messages.groupBy(names.frame_number(F.col("path")).alias("recording"), "topic", "msg_type")
    return rows.agg(F.count("*").alias("messages"), F.min("ts_ns").alias("first"), F.max("ts_ns").alias("last"), F.count("error").alias("errors"))


_TIMES = "count(*) AS messages, min(vec_id*1000003+17) AS first, max(vec_id*1000003+17) AS last, 0::BIGINT AS errors FROM embeddings"


@query(f"SELECT vec_id//{TOGETHER} AS recording, '/info' AS topic, 'CameraInfo' AS msg_type, {_TIMES} GROUP BY 1")
def pieces_of_topic(spark, d):
    m = recordings.messages(spark, _kept_recordings(spark, d, "indexed", "bag"), "bag", PIECE)
    return _per_topic(m.filter("topic = '/info'"))


@query(f"SELECT vec_id//{TOGETHER} AS recording, t.k AS topic, t.v AS msg_type, {_TIMES}, (VALUES ('/points','PointCloud2'),('/image','Image')) t(k,v) WHERE vec_id*1000003+17 BETWEEN 100000000 AND 250000000 GROUP BY 1, 2, 3")
def pieces_of_time(spark, d):
    m = recordings.messages(spark, _kept_recordings(spark, d, "db3", "db3"), "db3", PIECE)
    return _per_topic(m.filter("topic IN ('/points', '/image') AND ts_ns >= 100000000 AND ts_ns <= 250000000"))


@query("SELECT (vec_id*1000003+17) AS ts_ns, i AS point_idx, embedding[i*4+1]::float::double AS x, embedding[i*4+3]::float::double AS z FROM embeddings, (SELECT unnest(range(16)) AS i)")
def pieces_of_points(spark, d):
    m = recordings.messages(spark, _kept_recordings(spark, d, "indexed", "bag"), "bag", PIECE)
    return readers.message_points(m.filter("topic = '/points'")).select("ts_ns", "point_idx", *_doubles("x", "z"))


@query(f"WITH {STORED} SELECT frame//20 AS scan, frame%20*16+point_idx AS point_idx, x, y, z, intensity FROM s")
def frame_files(spark, d):
    scan = F.expr("frame_id div 20").alias("frame_id")
    rows = points(spark, d).select(scan, (F.col("frame_id") % 20 * 16 + F.col("point_idx")).alias("point_idx"), "x", "y", "z", "intensity")
    folder = _folder(spark, "frame-files")
    writers.write_files(writers.cloud_files(rows, _path("velodyne/%06d.bin", "frame_id")), folder)
    got = readers.clouds(spark, folder).filter("error IS NULL")
    return got.groupBy(names.frame_number(names.base_name(F.col("path"))).alias("scan"), "point_idx").agg(*(F.first(c).cast("double").alias(c) for c in ("x", "y", "z", "intensity")))


# --- crowded frames, masks, frustums -------------------------------------------------

#: Vectors of a crowded frame: sixteen points each, and a box around each first point.
CROWD = 100


def _crowd(spark, d) -> tuple[DataFrame, DataFrame]:
    p = points(spark, d).withColumn("vec_id", F.col("frame_id")).withColumn("frame_id", F.expr(f"vec_id div {CROWD}"))
    v = F.col("vec_id")
    box = {"cx": F.col("x"), "cy": F.col("y"), "cz": F.col("z"), "l": 1.0 + v % 3, "w": 1.0 + v % 5, "h": F.lit(8.0), "rot_z": v % 7 * 0.5}
    boxes = p.filter("point_idx = 0").select("frame_id", v.alias("box_id"), (v % 4 != 0).alias("is_moving"), F.struct(*(c.cast("double").alias(k) for k, c in box.items())).alias("box"))
    return p.withColumn("point_idx", v * 16 + F.col("point_idx")), boxes


CROWDED = f"""{POINTS}, q AS (SELECT frame_id//{CROWD} AS frame_id, frame_id AS v, frame_id*16+point_idx AS point_idx, point_idx AS k, x, y, z FROM p),
 b AS (SELECT frame_id, v AS box_id, x AS cx, y AS cy, z AS cz, (1+v%3)::double AS l, (1+v%5)::double AS w, 8::double AS h, v%7*0.5::double AS a FROM q WHERE k=0),
 hit AS (SELECT q.frame_id, q.point_idx, b.box_id FROM q JOIN b ON q.frame_id=b.frame_id AND abs((x-cx)*cos(a)+(y-cy)*sin(a))<=l/2 AND abs((y-cy)*cos(a)-(x-cx)*sin(a))<=w/2 AND abs(z-cz)<=h/2)"""


@query(f"WITH {CROWDED} SELECT frame_id, point_idx, point_idx IN (SELECT point_idx FROM hit WHERE box_id%4<>0) AS is_moving FROM q")
def crowded_boxes(spark, d):
    p, boxes = _crowd(spark, d)
    return labeling.label_by_boxes(p, boxes).select("frame_id", "point_idx", "is_moving")


@query(f"WITH {CROWDED} SELECT frame_id, box_id, count(point_idx) AS points FROM b LEFT JOIN hit USING (frame_id, box_id) GROUP BY 1, 2")
def crowded_box_counts(spark, d):
    return labeling.hits_per_box(*_crowd(spark, d))


@query(
    "SELECT vec_id, k AS corner, round((CASE WHEN k%4 IN (0,3) THEN 200+vec_id%50-320 ELSE 450-320 END)/500.0::double*z,9) AS x, round((CASE WHEN k%4<2 THEN 100-240 ELSE 400+vec_id%30-240 END)/500.0::double*z,9) AS y, z "
    "FROM (SELECT vec_id, k, CASE WHEN k<4 THEN 0.5 ELSE 50.0 END::double AS z FROM embeddings, (SELECT unnest(range(8)) AS k))"
)
def frustum_vertices(spark, d):
    v = F.col("vec_id")
    bbox = F.array(F.lit(200.0) + v % 50, F.lit(100.0), F.lit(450.0), F.lit(400.0) + v % 30)
    found = table(spark, d, "embeddings").select("vec_id", F.posexplode(geometry.frustum_vertices(bbox, **CAMERA)).alias("corner", "c"))
    return found.select("vec_id", F.col("corner").cast("long").alias("corner"), F.round("c.x", 9).alias("x"), F.round("c.y", 9).alias("y"), "c.z")


#: Masks of the frames that have one: a run of 200 pixels in every row of 640, which goes on to the right from row to row.
_MASKED = "z>0 AND floor(x*500/z+320) BETWEEN 0 AND 639 AND floor(y*500/z+240) BETWEEN 0 AND 479"


@query(
    f"WITH {POINTS}, u AS (SELECT *, floor(x*500/z+320) AS u, floor(y*500/z+240) AS v FROM p) "
    f"SELECT frame_id, point_idx, CASE WHEN frame_id%3=0 THEN ({BOUNDS}) ELSE coalesce({_MASKED} AND u>=(frame_id*13+v)%440 AND u<(frame_id*13+v)%440+200,false) END AS is_moving FROM u"
)
def mask_projection(spark, d):
    frames = table(spark, d, "embeddings").select(F.col("vec_id").alias("frame_id"))
    # Masks are made where their frames are shuffled and ordered to, as they are a hundred times as wide.
    dealt = frames.filter("frame_id % 3 <> 0").repartition("frame_id").sortWithinPartitions("frame_id")
    first = lambda r: (F.col("frame_id") * 13 + r) % 440
    runs = F.transform(F.sequence(F.lit(0), F.lit(479)), lambda r: F.struct(r.alias("r"), first(r).alias("first"), (first(r) + 200).alias("end")))
    boxes = frames.filter("frame_id % 3 = 0").select("frame_id", F.array(*(F.lit(v) for v in BBOX)).alias("bbox"))
    return labeling.label_by_masks(points(spark, d), dealt.select("frame_id", runs.alias("runs")), CAMERA, 640, 480, boxes).select("frame_id", "point_idx", "is_moving")


@query(
    "WITH m AS (SELECT vec_id, i//8 AS r, i%8 AS c FROM embeddings, (SELECT unnest(range(64)) AS i) WHERE embedding[i+1]>0), g AS (SELECT *, c-row_number() OVER (PARTITION BY vec_id, r ORDER BY c) AS k FROM m) "
    "SELECT vec_id, r, min(c) AS first, max(c)+1 AS end FROM g GROUP BY vec_id, r, k"
)
def mask_runs(spark, d):
    px = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v")).filter(labeling.normalised_mask(F.col("v")) > 0)
    return labeling.mask_runs(px.select("vec_id", F.expr("i div 8").alias("r"), (F.col("i") % 8).cast("long").alias("c")), ["vec_id"])


# --- long sequences ------------------------------------------------------------------


@query(
    "WITH s AS (SELECT event_type, event_id, lead(event_id) OVER w AS b, lead(event_id,2) OVER w AS c, lead(event_id,3) OVER w AS e, lead(value,3) OVER w AS v FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id)) "
    "SELECT event_type, event_id AS first, b AS second, c AS third, e AS last, v::double AS value FROM s WHERE e IS NOT NULL"
)
def long_windows(spark, d):
    """Sequences that are a fifth of all events each, in blocks of 500 numbers."""
    w = windows.frame_windows(table(spark, d, "events"), "event_type", "event_id", 4, ["value"], block=500)
    at = lambda k: F.col("window")[k]
    return w.select("event_type", "first", at(1)["event_id"].alias("second"), at(2)["event_id"].alias("third"), at(3)["event_id"].alias("last"), at(3)["value"].cast("double").alias("value"))


# --- pictures, models, taxonomies, layouts -------------------------------------------


def _jpegs(spark, d) -> DataFrame:
    """A 16 x 32 picture of each vector, even in blocks of 8 x 8: grey for even ids, else in colour at half the resolution."""
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = lambda a: np.repeat(np.repeat(a.astype(np.uint8), 8, 0), 8, 1)
        for batch in batches:
            out = []
            for i in batch.column("vec_id").to_pylist():
                luma = tiles((i * 31 + np.arange(8) * 17).reshape(2, 4) % 256)
                chroma = [tiles((i * m + np.arange(2) * 29).reshape(1, 2) % 256) for m in (7, 13)]
                planes, sampling = ([luma, *chroma], [(2, 2), (1, 1), (1, 1)]) if i % 2 else ([luma], [(1, 1)])
                out.append(jpeg.file(planes, (16, 32), sampling, restart=i % 3))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(out, pa.binary())], names=["path", "bytes"])

    return table(spark, d, "embeddings").select(_path("camera1_images/%08d.jpg", "vec_id").alias("path"), "vec_id").mapInArrow(encoded, "path string, bytes binary")


_TILES = """t AS (SELECT vec_id, (vec_id*31+k*17)%256::double AS y, (vec_id*7+k%4//2*29)%256-128::double AS b, (vec_id*13+k%4//2*29)%256-128::double AS r FROM embeddings, (SELECT unnest(range(8)) AS k)),
 c AS (SELECT vec_id, CASE WHEN vec_id%2=0 THEN [y,y,y] ELSE [round(y+1.402*r),round(y-0.344136*b-0.714136*r),round(y+1.772*b)] END AS p FROM t),
 g AS (SELECT vec_id, list_transform(p, lambda v: least(greatest(v,0),255)::bigint) AS p FROM c), h AS (SELECT vec_id, CASE WHEN vec_id%2=0 THEN p[1] ELSE (p[1]*19595+p[2]*38470+p[3]*7471+32768)//65536 END AS v FROM g)"""


@query(f"WITH {_TILES} SELECT vec_id AS frame, 16 AS height, 32 AS width, (sum(v)*64)::bigint AS total, max(v) AS peak FROM h GROUP BY 1")
def file_jpegs(spark, d):
    kept = store.round_trip(_jpegs(spark, d), "jpegs")
    got = readers.pictures(readers.image_paths(kept).withColumnRenamed("content", "file")).filter("error IS NULL")
    whole = F.transform("grey", lambda v: F.round(v * 255).cast("bigint"))
    return got.select(names.frame_number(names.base_name(F.col("path"))).alias("frame"), "height", "width", F.aggregate(whole, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"), F.array_max(whole).alias("peak"))


@query(
    "SELECT vec_id, CASE WHEN vec_id%11<>5 THEN list_sum(list_transform(embedding[1:vec_id%64+1], lambda x: floor(64*x::double)))::bigint END AS score, vec_id%11=5 AS failed FROM embeddings"
)
def model_batches(spark, d):
    """A stand-in model on vectors of unlike lengths, in batches of like ones; it can't do with lengths that it is told to fail on."""
    def load(weights):
        def model(part: dict) -> list[int]:
            if (np.array(part["vec_id"]) % 11 == 5).any():
                raise ValueError("not this one")
            return (np.floor(part["v"] * weights["scale"]).sum(axis=1)).astype(int).tolist()

        return model

    rows = table(spark, d, "embeddings").select("vec_id", F.slice(F.transform("embedding", lambda x: x.cast("double")), F.lit(1), (F.col("vec_id") % 64 + 1).cast("int")).alias("v"))
    weights = spark.sparkContext.broadcast({"scale": 64.0})
    got = readers.infer(rows.withColumn("n", F.size("v")), ["vec_id", "v"], "score", "bigint", pa.int64(), load, weights, batch=16, size="n")
    return got.select("vec_id", "score", F.col("score_error").isNotNull().alias("failed"))


@query("SELECT vec_id AS frame_id, i AS point_idx, CASE WHEN (vec_id*7+i*37)%300%9<>4 THEN (vec_id*7+i*37)%300%20+vec_id%2*100 END AS class FROM embeddings, (SELECT unnest(range(16)) AS i)")
def taxonomy_remap(spark, d):
    """Labels to classes by the taxonomies of two versions, read from YAML with other settings beside the map."""
    labels = _labels(spark, d)
    known = labels.select("label").distinct().filter("label % 9 <> 4")
    version = F.explode(F.array(F.lit(0), F.lit(1))).alias("version")
    line = F.format_string("  %d: %d\n", F.col("label"), F.col("label") % 20 + F.col("version") * 100)
    text = known.select("label", version).withColumn("line", line).groupBy("version").agg(F.array_join(F.array_sort(F.collect_list("line")), "").alias("map"))
    head = F.lit("name: stand-in\nlabels:\n  0: unlabeled\n  9: {moving: false}\nsplit: {train: [0, 1], valid: []}\nlearning_map:\n")
    files = store.round_trip(text.select(_path("configs/v%d.yaml", "version").alias("path"), F.concat(head, "map").cast("binary").alias("bytes")), "taxonomies")
    maps = readers.mapping(readers.settings(spark, files), "learning_map")
    maps = maps.withColumn("version", F.regexp_extract("path", r"v(\d+)\.yaml$", 1).cast("bigint"))
    return labeling.remap_by(labels.withColumn("version", F.col("frame_id") % 2), "label", maps, "class", ["version"]).select("frame_id", "point_idx", "class")


@query(
    "WITH f AS (SELECT frame_id, row_number() OVER (ORDER BY 'run_'||(frame_id*7919%100003)||'_'||frame_id)-1 AS k FROM (SELECT vec_id//4 AS frame_id, min(vec_id) AS v FROM embeddings GROUP BY 1)) "
    "SELECT k AS file, (vec_id%4)*16+i AS point_idx, (vec_id*7+i*37)%300 AS label FROM embeddings JOIN f ON f.frame_id=vec_id//4, (SELECT unnest(range(16)) AS i)"
)
def kitti_layout(spark, d):
    """Label files of four vectors each, under names out of order; read back under their new names."""
    frame = F.expr("frame_id div 4")
    rows = _labels(spark, d).select(frame.alias("frame"), (F.col("frame_id") % 4 * 16 + F.col("point_idx")).alias("point_idx"), "label")
    name = F.format_string("run_%d_%d.label", F.col("frame") * 7919 % 100003, F.col("frame"))
    folder = _folder(spark, "kitti")
    flows.kitti_layout(spark, store.round_trip(writers.label_files(rows, name), "labels"), folder)
    return readers.labels(spark, folder).filter("error IS NULL").select(names.frame_number(names.base_name(F.col("path"))).alias("file"), "point_idx", "label")


# --- drawn frames --------------------------------------------------------------------

#: Rows and columns of the pictures, and the classes of their detections.
DRAWN, DRAWN_CLASSES = (24, 32), ("person", "bicycle", "car", "motorcycle", "bus", "truck", "dog", "tree")


def _detected(spark, d) -> DataFrame:
    """Three detections of each vector but one in seven, of which the first and the last have a mask."""
    e = table(spark, d, "embeddings").filter("vec_id % 7 <> 3").select("vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("det_idx"))
    place = lambda k, n: F.floor(F.abs(F.col("embedding")[F.col("det_idx") + k].cast("double")) * 1000) % n
    e = e.withColumn("x", place(0, 20)).withColumn("y", place(8, 12)).withColumn("s", F.col("det_idx") + 6)
    name = F.array(*(F.lit(c) for c in DRAWN_CLASSES))[((F.col("vec_id") + F.col("det_idx")) % 8).cast("int")]
    runs = F.transform(F.sequence("y", F.col("y") + F.col("s")), lambda r: F.struct(r.alias("r"), F.col("x").alias("first"), (F.col("x") + F.col("s") + 1).alias("end")))
    box = F.array(*(c.cast("double") for c in (F.col("x"), F.col("y"), F.col("x") + F.col("s"), F.col("y") + F.col("s"))))
    return e.select(F.col("vec_id").alias("frame_id"), F.lit("camera1").alias("camera"), "det_idx", name.alias("class_name"), F.lit(0.5).alias("confidence"), box.alias("bbox"), F.lit(None).cast("string").alias("label"), F.when(F.col("det_idx") != 1, runs).alias("runs"))


def _plain_pictures(spark, d) -> DataFrame:
    """A picture of one colour for each vector."""
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from scanloom.sources import decode

        for batch in batches:
            files = [decode.png(np.broadcast_to((np.array([31, 17, 7]) * i % 256).astype(np.uint8), (*DRAWN, 3))) for i in batch.column("frame_id").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("frame_id"), batch.column("camera"), pa.array(files, pa.binary())], names=["frame_id", "camera", "file"])

    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("frame_id"), F.lit("camera1").alias("camera"))
    return rows.mapInArrow(encoded, "frame_id long, camera string, file binary")


_DRAWN_COLOURS = ", ".join(str(list(painting.CAMERA_COLOURS.get(c, painting.OTHER_COLOUR)[::-1])) for c in DRAWN_CLASSES)
_DETECTED = f"""d AS (SELECT vec_id, k, floor(abs(embedding[k+1]::double)*1000)::bigint%20 AS x1, floor(abs(embedding[k+9]::double)*1000)::bigint%12 AS y1, 6+k AS s,
 ([{_DRAWN_COLOURS}])[(vec_id+k)%8+1] AS c FROM embeddings, (SELECT unnest(range(3)) AS k) WHERE vec_id%7<>3)"""

_MASK_SUMS = ", ".join(f"sum((4*c[{i}]+5)//10) FILTER (WHERE k<>1 AND x BETWEEN x1 AND x1+s AND y BETWEEN y1 AND y1+s)" for i in (1, 2, 3))


@query(f"""WITH {_DETECTED},
 p AS (SELECT vec_id, x, y, [vec_id*31%256, vec_id*17%256, vec_id*7%256] AS bg FROM embeddings, (SELECT unnest(range({DRAWN[1]})) AS x), (SELECT unnest(range({DRAWN[0]})) AS y)),
 h AS (SELECT p.vec_id, x, y, arg_max(c, k) FILTER (WHERE NOT (x BETWEEN x1+2 AND x1+s-2 AND y BETWEEN y1+2 AND y1+s-2)) AS edge,
  [{_MASK_SUMS}] AS o
  FROM p JOIN d ON p.vec_id=d.vec_id AND x BETWEEN x1-1 AND x1+s+1 AND y BETWEEN y1-1 AND y1+s+1 GROUP BY 1, 2, 3),
 m AS (SELECT p.vec_id, p.x, p.y, coalesce(edge, bg) AS v, o FROM p LEFT JOIN h ON p.vec_id=h.vec_id AND p.x=h.x AND p.y=h.y),
 f AS (SELECT vec_id, CASE WHEN vec_id%7<>3 AND (x<3 OR y<3 OR x>={DRAWN[1] - 3} OR y>={DRAWN[0] - 3}) THEN [255,255,0] ELSE [(7*v[i]+3*least(coalesce(o[i],0),255)+5)//10 FOR i IN [1,2,3]] END AS c FROM m)
 SELECT vec_id, c[1]::bigint AS red, c[2]::bigint AS green, c[3]::bigint AS blue, count(*) AS pixels FROM f GROUP BY ALL""")
def drawn_frames(spark, d):
    """Pixels of each colour in pictures with boxes, masks and borders, read back from their files."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from scanloom.sources import decode

        for batch in batches:
            out = []
            for path, file in zip(*(batch.column(c).to_pylist() for c in ("path", "content"))):
                colours, n = np.unique(decode.picture(file).reshape(-1, 3), axis=0, return_counts=True)
                out += [(path, *c, k) for c, k in zip(colours.tolist(), n.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), [pa.string()] + 4 * [pa.int64()])], names=["path", "red", "green", "blue", "pixels"])

    drawn = painting.annotated_pictures(_plain_pictures(spark, d), _detected(spark, d), texts=False).filter("error IS NULL")
    kept = store.round_trip(drawn.select(_path("visualization_camera1/%019d.png", "frame_id").alias("path"), F.col("content").alias("bytes")), "drawn")
    got = readers.image_paths(kept).mapInArrow(counted, "path string, red long, green long, blue long, pixels long")
    return got.select(names.frame_number(names.base_name(F.col("path"))).alias("vec_id"), "red", "green", "blue", "pixels")


@query(f"""WITH {_DETECTED}, r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY k)-1 AS i FROM d WHERE k<>1)
 SELECT vec_id, i::bigint AS instance, ((least(x1+s+1,{DRAWN[1]})-x1)*(least(y1+s+1,{DRAWN[0]})-y1)*255)::bigint AS total FROM r""")
def mask_files(spark, d):
    """Masks as files of their own, read back: the sum of their pixels."""
    masks = writers.numbered_masks(_detected(spark, d).withColumn("mask", F.col("runs")))
    kept = store.round_trip(painting.mask_pictures(masks, *DRAWN), "mask-files")
    got = readers.pictures(readers.image_paths(kept).withColumnRenamed("content", "file")).filter("error IS NULL")
    part = F.split(names.base_name(F.col("path")), "_")
    return got.select(part[0].cast("long").alias("vec_id"), part[1].cast("long").alias("instance"), F.aggregate(F.transform("grey", lambda v: F.round(v * 255).cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))
