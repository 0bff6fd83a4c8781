"""Queries that write the driver's tables as sensor files, keep them in the shared folder and read them back.

Each is compared with SQL over the table that the files came from, so that
writers, store and readers are held to give what went in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanloom.functions import names
from scanloom.operators import geometry, labeling, quality, samples, sync, windows
from scanloom.plans import flows
from scanloom.plans.catalog import BOUNDS, POINTS, SYNC_MAP, _assets, _in_box, _labelled, query
from scanloom.plans.views import BBOX, BOXES, CAMERA, points, table
from scanloom.sources import encode, readers, store, writers

#: Points as float32 files hold them.
STORED = (
    "s AS (SELECT frame_id AS frame, i AS point_idx, x::float::double AS x, y::float::double AS y, z::float::double AS z, intensity::float::double AS intensity FROM "
    "(SELECT vec_id AS frame_id, i, embedding[i*4+1]::double*50 AS x, embedding[i*4+2]::double*50 AS y, embedding[i*4+3]::double*50 AS z, embedding[i*4+4]::double*50 AS intensity FROM embeddings, (SELECT unnest(range(16)) AS i)))"
)


def _path(pattern: str, *of: str) -> Column:
    return F.format_string(pattern, *of)


def _doubles(*columns: str) -> list[Column]:
    return [F.col(c).cast("double").alias(c) for c in columns]


def _labels(spark, d) -> DataFrame:
    """A label for each point: (frame_id, point_idx, label)."""
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("frame_id"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: k.cast("bigint"))).alias("point_idx"))
    return rows.withColumn("label", (F.col("frame_id") * 7 + F.col("point_idx") * 37) % 300)


LABELS = "l AS (SELECT vec_id AS frame, i AS point_idx, (vec_id*7+i*37)%300 AS label FROM embeddings, (SELECT unnest(range(16)) AS i))"


# --- clouds, labels, rasters, pictures -------------------------------------------------


def _clouds(spark, d, kind: str) -> DataFrame:
    files = store.round_trip(writers.cloud_files(points(spark, d), _path(f"lidar/%08d.{kind}", "frame_id"), kind), f"clouds-{kind}")
    return readers.clouds(spark, files, kind).filter("error is null").withColumn("frame", names.frame_number(F.col("path")))


@query(f"WITH {STORED} SELECT frame, point_idx, x, y, z, intensity FROM s")
def file_clouds_bin(spark, d):
    return _clouds(spark, d, "bin").select("frame", "point_idx", *_doubles("x", "y", "z", "intensity"))


@query(f"WITH {STORED} SELECT frame, point_idx, x, y, z, intensity FROM s")
def file_clouds_pcd(spark, d):
    return _clouds(spark, d, "pcd").select("frame", "point_idx", *_doubles("x", "y", "z", "intensity"))


@query(f"WITH {LABELS} SELECT frame, point_idx, label FROM l")
def file_labels(spark, d):
    files = store.round_trip(writers.label_files(_labels(spark, d), _path("labels/%08d.label", "frame_id")), "labels")
    return readers.labels(spark, files).select(names.frame_number(F.col("path")).alias("frame"), "point_idx", "label")


@query("SELECT vec_id AS frame, i//8 AS r, i%8 AS c, embedding[i+1]::double AS v FROM embeddings, (SELECT unnest(range(64)) AS i)")
def file_rasters(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v"))
    px = e.select("vec_id", F.expr("i div 8").alias("r"), (F.col("i") % 8).cast("bigint").alias("c"), "v")
    files = store.round_trip(writers.raster_files(px, _path("residual/%06d.npy", "vec_id")), "rasters")
    return readers.rasters(spark, files).select(names.frame_number(F.col("path")).alias("frame"), "r", "c", "v")


def _images(spark, d) -> DataFrame:
    """A 4 x 5 picture of each vector: blue, green, red bytes out of its id."""
    px = F.transform(F.sequence(F.lit(0), F.lit(59)), lambda k: F.pmod(F.col("vec_id") * 31 + k * 17, F.lit(256)))
    hexed = F.array_join(F.transform(px, lambda v: F.lpad(F.hex(v), 2, "0")), "")
    return table(spark, d, "embeddings").select("vec_id", F.lit(4).alias("height"), F.lit(5).alias("width"), F.unhex(hexed).alias("pixels"))


GREY = """g AS (SELECT vec_id AS frame, k//5 AS r, k%5 AS c, (((vec_id*31+(3*k+2)*17)%256)*19595+((vec_id*31+(3*k+1)*17)%256)*38470+((vec_id*31+3*k*17)%256)*7471+32768)//65536 AS v
 FROM embeddings, (SELECT unnest(range(20)) AS k))"""


@query(f"WITH {GREY} SELECT frame, 4 AS height, 5 AS width, sum(v)::bigint AS total, max(v)::bigint AS peak FROM g GROUP BY 1")
def file_pictures(spark, d):
    kept = store.round_trip(writers.image_files(_images(spark, d), _path("camera1_images/%08d.PNG", "vec_id")), "pictures")
    got = readers.pictures(readers.image_paths(kept).withColumnRenamed("content", "file")).filter("error is null")
    whole = F.transform("grey", lambda v: F.round(v * 255).cast("bigint"))
    return got.select(names.frame_number(names.base_name(F.col("path"))).alias("frame"), "height", "width", F.aggregate(whole, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"), F.array_max(whole).alias("peak"))


@query("SELECT vec_id AS frame, e[1] AS fx, e[5] AS fy, e[3] AS cx, e[6] AS cy, e[10] AS d0, 480+vec_id%3 AS height, 640 AS width FROM (SELECT vec_id, embedding::double[] AS e FROM embeddings)")
def file_intrinsics(spark, d):
    v = F.transform("embedding", lambda x: x.cast("double"))
    cameras = table(spark, d, "embeddings").select("vec_id", F.slice(v, 1, 9).alias("K"), F.slice(v, 10, 5).alias("D"), (F.col("vec_id") % 3 + 480).cast("int").alias("height"), F.lit(640).alias("width"))
    files = store.round_trip(writers.intrinsics_files(cameras, _path("camera1_intrinsics/%08d.npz", "vec_id")), "intrinsics")
    got = readers.intrinsics(spark, files, strict=True)
    return got.select(names.frame_number(names.base_name(F.col("path"))).alias("frame"), "fx", "fy", "cx", "cy", F.col("D")[0].alias("d0"), F.col("height").cast("bigint").alias("height"), "width")


# --- text and JSON -----------------------------------------------------------------------


@query("SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn)-1 AS line, turn/8.0::double AS time FROM conversations")
def file_times(spark, d):
    t = table(spark, d, "conversations").select("conv_id", "turn", (F.col("turn") / 8.0).alias("time"))
    files = store.round_trip(writers.times_files(t, _path("sequences/%d/times.txt", "conv_id"), "turn"), "times")
    return readers.times(spark, files).select(F.element_at(F.split("path", "/"), -2).cast("bigint").alias("conv_id"), F.col("line").cast("bigint").alias("line"), "time")


@query(
    "SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn)-1 AS line, turn/4.0::double AS tx, -turn::double AS ty, 0.5::double AS tz, conv_id%8/8.0::double AS qz, 1.0::double AS qw FROM conversations"
)
def file_poses(spark, d):
    zero = F.lit(0.0)
    pose = {"tx": F.col("turn") / 4.0, "ty": -F.col("turn").cast("double"), "tz": F.lit(0.5), "qx": zero, "qy": zero, "qz": F.col("conv_id") % 8 / 8.0, "qw": F.lit(1.0)}
    p = table(spark, d, "conversations").select("conv_id", "turn", (F.col("turn") / 8.0).alias("time"), F.struct(*(v.alias(k) for k, v in pose.items())).alias("pose"))
    files = store.round_trip(writers.pose_files(p, _path("sequences/%d/poses.txt", "conv_id"), "turn"), "poses")
    got = readers.poses(spark, files).filter("error is null")
    return got.select(F.element_at(F.split("path", "/"), -2).cast("bigint").alias("conv_id"), F.col("line").cast("bigint").alias("line"), *(F.col(f"pose.{c}") for c in ("tx", "ty", "tz", "qz", "qw")))


CALIBRATION = """c AS (SELECT vec_id, vec_id%7+1.0 AS f, vec_id%5/4.0 AS t0, vec_id%3/2.0 AS t1 FROM embeddings), m AS (
 SELECT vec_id, 'P0' AS name, f*t0+3.0*1 AS last, f AS first FROM c UNION ALL SELECT vec_id, 'P1', f*t0+3.0*1-f*0.5, f FROM c UNION ALL
 SELECT vec_id, 'P2', f*t0+3.0*1, f FROM c UNION ALL SELECT vec_id, 'P3', f*t0+3.0*1-f*0.5, f FROM c UNION ALL SELECT vec_id, 'Tr', t0, 1.0 FROM c)"""


@query(f"WITH {CALIBRATION} SELECT vec_id AS frame, name, first::double AS first, last::double AS last FROM m")
def file_calibration(spark, d):
    f, t0, t1 = (F.col("vec_id") % 7 + 1).cast("double"), F.col("vec_id") % 5 / 4.0, F.col("vec_id") % 3 / 2.0
    k = F.array(f, F.lit(0.0), F.lit(3.0), F.lit(0.0), f, F.lit(2.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))
    r, t = F.array(*(F.lit(float(i % 4 == 0)) for i in range(9))), F.array(t0, t1, F.lit(1.0))
    parts = geometry.calibration_rows(k, r, t, 0.5)
    rows = table(spark, d, "embeddings").select("vec_id", F.explode(F.array(*(F.struct(F.lit(n).alias("name"), m.alias("m")) for n, m in parts.items()))).alias("x")).select("vec_id", "x.*")
    files = store.round_trip(writers.calibration_files(rows, _path("%d/calib.txt", "vec_id")), "calibration")
    got = readers.calibration(spark, files)
    return got.select(F.element_at(F.split("path", "/"), -2).cast("bigint").alias("frame"), "name", F.col("m")[0].alias("first"), F.col("m")[3].alias("last"))


@query(f"WITH {SYNC_MAP} SELECT * FROM s")
def file_sync_map(spark, d):
    folder = f"{store.shared_folder(spark)}/sync-map"
    writers.write_json(sync.sync_map(_assets(spark, d)), folder)
    return readers.sync_map(spark, folder, lines=True)


def _annotations(spark, d) -> DataFrame:
    """Events of a user as the detections of a frame; errors have a mask."""
    e = table(spark, d, "events")
    mask = F.when(F.col("event_type") == "error", F.transform(F.sequence(F.lit(1), F.lit(9)), lambda k: (k <= F.col("user_id") % 10).cast("int")))
    one = F.struct(
        F.lit(0).alias("class_id"), F.col("event_type").alias("class_name"), F.array(*(F.lit(v) for v in BBOX)).alias("bbox"), F.col("value").cast("double").alias("confidence"),
        labeling.mask_area(mask).alias("mask_area"), F.lit(0.5).alias("mask_score"), mask.alias("mask"), F.lit("camera1").alias("camera"), F.lit("").alias("image_file"),
    )
    return e.groupBy(F.col("user_id").alias("frame_id")).agg(F.collect_list(one).alias("detections_2d"))


AREA = "least(user_id%10,9)"


@query(f"SELECT user_id AS frame_id, count(*) AS detections, coalesce(sum({AREA}) FILTER (event_type='error'),0)::bigint AS area FROM events GROUP BY 1")
def file_summary(spark, d):
    folder = f"{store.shared_folder(spark)}/summary"
    writers.write_json(writers.summary_rows(_annotations(spark, d)), folder)
    got = readers.annotations(spark, folder, lines=True)
    area = F.aggregate("detections_2d", F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x["mask_area"], F.lit(0)))
    return got.select("frame_id", F.size("detections_2d").cast("bigint").alias("detections"), area.alias("area"))


@query("SELECT user_id AS frame_id, count(*) AS num_detections FROM events GROUP BY 1")
def file_reduced_summary(spark, d):
    folder = f"{store.shared_folder(spark)}/summary-reduced"
    writers.write_json(writers.summary_rows(_annotations(spark, d), reduced=True), folder)
    return spark.read.schema("frame_id bigint, num_detections bigint").json(folder)


@query(
    f"""WITH e AS (SELECT user_id, coalesce({AREA},0)*(event_type='error')::int AS a FROM events), f AS (SELECT user_id, count(*) AS n, count(*) FILTER (a>0) AS m FROM e GROUP BY 1)
 SELECT count(*) AS frames, count(*) FILTER (n>0) AS frames_with_detections, sum(n)::bigint AS detections, count(*) FILTER (m>0) AS frames_with_masks, sum(m)::bigint AS masks FROM f"""
)
def detection_stats(spark, d):
    return labeling.detection_stats(_annotations(spark, d))


def _box_files(spark, d) -> DataFrame:
    """Annotation files of ten frames each; a box moves where its frame's number says so."""
    box = lambda b: F.struct(*(F.lit(v).alias(n) for v, n in zip(b, ("cx", "cy", "cz", "l", "w", "h", "rot_z"))))
    odd = F.col("vec_id") % 2 == 1
    act = lambda moves: F.create_map(F.when(moves, "Walking").otherwise("sitting"), F.lit(0.9))
    boxes = F.array(*(F.struct(box(b).alias("box"), act(odd if k == 0 else ~odd).alias("action_label")) for k, b in enumerate(BOXES[:2])))
    rows = table(spark, d, "embeddings").select(F.expr("vec_id div 10").alias("file"), F.struct(F.col("vec_id").cast("string").alias("k"), boxes.alias("v")).alias("e"))
    rows = rows.groupBy("file").agg(F.to_json(F.struct(F.map_from_entries(F.collect_list("e")).alias("labels"))).cast("binary").alias("bytes"))
    return store.round_trip(rows.select(_path("annotations/%d.json", "file").alias("path"), "bytes"), "boxes")


@query(
    f"WITH {POINTS} SELECT frame_id, point_idx, CASE WHEN (frame_id%2=1 AND {_in_box(BOXES[0])}) OR (frame_id%2=0 AND {_in_box(BOXES[1])}) THEN 251 ELSE 9 END::bigint AS label FROM p"
)
def file_boxes(spark, d):
    boxes = readers.boxes(spark, _box_files(spark, d)).withColumn("frame", F.col("frame").cast("bigint"))
    return flows.box_labels(points(spark, d), boxes).select("frame_id", "point_idx", "label")


@query(
    "SELECT vec_id//4 AS rig, 'sensor_'||vec_id AS sensor_id, (500+vec_id)::double AS fx, (vec_id%7/2.0)::double AS t0, CASE WHEN vec_id%3=1 THEN 640 ELSE 752 END AS width, 480 AS height FROM embeddings WHERE vec_id%5<>2"
)
def file_cameras(spark, d):
    """A rig of four vectors: matrices as text and as lists, defaults filled in; sensors without a matrix and entries of another name go."""
    v = F.col("vec_id")
    k = F.when(v % 5 != 2, F.format_string("    K: '%d 0 320; 0 500 240; 0 0 1'\n", v + 500)).otherwise("    K: none\n")
    rest = F.concat(F.format_string("    R: [[1, 0, 0], [0, 1, 0], [0, 0, 1]]\n    T: [%s, 0, 0]\n", (v % 7 / 2.0).cast("string")), F.when(v % 3 == 1, F.lit("    width: 640\n")).otherwise(F.lit("")))
    sensors = table(spark, d, "embeddings").select(F.expr("vec_id div 4").alias("rig"), F.concat(F.format_string("  sensor_%d:\n", v), k, rest).alias("text"))
    text = F.concat(F.lit("cameras:\n  other:\n    K: [1]\n"), F.array_join(F.collect_list("text"), "")).cast("binary")
    files = store.round_trip(sensors.groupBy("rig").agg(text.alias("bytes")).select(_path("rigs/%d.yaml", "rig").alias("path"), "bytes"), "cameras")
    got = readers.cameras(spark, files).filter("error IS NULL")
    return got.select(names.frame_number(names.base_name(F.col("path"))).alias("rig"), "sensor_id", F.col("K")[0].alias("fx"), F.col("T")[0].alias("t0"), "width", "height")


# --- recordings ----------------------------------------------------------------------------


def _recording_rows(spark, d, path: Column) -> DataFrame:
    """Messages of each vector in the recording ``path``: a cloud, a picture, a camera and a packed picture, by its id in nanoseconds."""
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from scanloom.sources import decode

        for batch in batches:
            out = []
            for name, i, v in zip(*(batch.column(c).to_pylist() for c in ("path", "vec_id", "embedding"))):
                p = np.array(v, np.float64).reshape(16, 4)[:, :3].astype(np.float32)
                image = ((i * 31 + np.arange(60) * 17) % 256).astype(np.uint8).reshape(4, 5, 3)
                ts = i * 1_000_003 + 17
                out += [(name, "/points", "PointCloud2", ts, encode.cloud_message(ts, p)), (name, "/image", "Image", ts, encode.image_message(ts, image, "bgr8"))]
                out += [(name, "/info", "CameraInfo", ts, encode.camera_message(ts, v[:9], v[9:14], 480, 640)), (name, "/packed", "CompressedImage", ts, encode.compressed_message(ts, decode.png(image[:, :, ::-1])))]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary()))], names=["path", "topic", "msg_type", "ts_ns", "data"])

    return table(spark, d, "embeddings").select(path.alias("path"), "vec_id", "embedding").mapInArrow(encoded, "path string, topic string, msg_type string, ts_ns long, data binary")


def _recording(spark, d, kind: str) -> DataFrame:
    """Ten vectors to a recording."""
    rows = _recording_rows(spark, d, F.format_string(f"%d.{kind}", F.expr("vec_id div 10")))
    return store.round_trip(encode.recording_files(rows, kind), f"recordings-{kind}")


TOPICS = "(SELECT unnest(['/points','/image','/info','/packed']) AS topic)"


@query(f"SELECT vec_id//10 AS recording, topic, count(*) AS messages, min(vec_id*1000003+17) AS first, max(vec_id*1000003+17) AS last FROM embeddings, {TOPICS} GROUP BY 1, 2")
def file_messages_db3(spark, d):
    return _listed(readers.messages(spark, _recording(spark, d, "db3"), "db3"))


@query(f"SELECT vec_id//10 AS recording, topic, count(*) AS messages, min(vec_id*1000003+17) AS first, max(vec_id*1000003+17) AS last FROM embeddings, {TOPICS} WHERE topic<>'/packed' GROUP BY 1, 2")
def file_messages_bag(spark, d):
    return _listed(readers.messages(spark, _recording(spark, d, "bag"), "bag", topics=("/points", "/image", "/info")))


def _listed(messages: DataFrame) -> DataFrame:
    rows = messages.filter("error is null").groupBy(names.frame_number(F.col("path")).alias("recording"), "topic")
    return rows.agg(F.count("*").alias("messages"), F.min("ts_ns").alias("first"), F.max("ts_ns").alias("last"))


@query("SELECT DISTINCT vec_id//10 AS recording, t.k AS name, t.v AS type FROM embeddings, (VALUES ('/points','PointCloud2'),('/image','Image'),('/info','CameraInfo'),('/packed','CompressedImage')) t(k,v)")
def file_topics(spark, d):
    got = readers.topics(spark, _recording(spark, d, "db3"))
    return sync.topic_types(got.withColumn("name", F.concat("path", F.lit("|"), "name"))).select(names.frame_number(F.split("name", r"\|")[0]).alias("recording"), F.split("name", r"\|")[1].alias("name"), "type")


def _topic(spark, d, name: str) -> DataFrame:
    return readers.messages(spark, _recording(spark, d, "db3"), "db3", topics=(name,))


@query("SELECT (vec_id*1000003+17) AS ts_ns, i AS point_idx, embedding[i*4+1]::float::double AS x, embedding[i*4+2]::float::double AS y, embedding[i*4+3]::float::double AS z FROM embeddings, (SELECT unnest(range(16)) AS i)")
def message_points(spark, d):
    return readers.message_points(_topic(spark, d, "/points")).filter("error is null").select("ts_ns", "point_idx", *_doubles("x", "y", "z"))


@query("SELECT (vec_id*1000003+17) AS ts_ns, 4 AS height, 5 AS width, lpad(to_hex(vec_id*31%256),2,'0')||lpad(to_hex((vec_id*31+17)%256),2,'0') AS head FROM embeddings")
def message_images(spark, d):
    got = readers.message_images(_topic(spark, d, "/image")).filter("error is null")
    return got.select("ts_ns", "height", "width", F.substring(F.hex("pixels"), 1, 4).alias("head"))


@query("SELECT (vec_id*1000003+17) AS ts_ns, embedding[1]::double AS fx, embedding[10]::double AS d0, 480 AS height, 640 AS width FROM embeddings")
def message_cameras(spark, d):
    got = readers.message_cameras(_topic(spark, d, "/info")).filter("error is null")
    return got.select("ts_ns", F.col("K")[0].alias("fx"), F.col("D")[0].alias("d0"), "height", "width")


@query(f"WITH {GREY} SELECT frame*1000003+17 AS ts_ns, 4 AS height, sum(v)::bigint AS total FROM g GROUP BY 1")
def message_pictures(spark, d):
    files = readers.message_files(_topic(spark, d, "/packed")).filter("error is null").select(F.col("ts_ns").cast("string").alias("path"), "file")
    got = readers.pictures(files).filter("error is null")
    return got.select(F.col("path").cast("bigint").alias("ts_ns"), "height", F.aggregate(F.transform("grey", lambda v: F.round(v * 255).cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


# --- discovery and checks of files -----------------------------------------------------------


def _listing(spark, d) -> DataFrame:
    """Files of a user's recording, some in folders, of several kinds: (seq, path, length)."""
    e = table(spark, d, "events")
    folder = F.element_at(F.array(*(F.lit(f) for f in ("", "pointclouds/", "velodyne/", "else/"))), (F.col("user_id") % 4 + 1).cast("int"))
    kind = F.element_at(F.array(*(F.lit(k) for k in ("pcd", "bin", "PNG", "jpeg", "txt"))), (F.col("event_id") % 5 + 1).cast("int"))
    return e.select(F.col("user_id").alias("seq"), F.concat(folder, F.col("event_id").cast("string"), F.lit("."), kind).alias("path"), (F.col("event_id") * 8).alias("length"))


FILES = "f AS (SELECT user_id AS seq, ['','pointclouds/','velodyne/','else/'][user_id%4+1]||event_id||'.'||['pcd','bin','PNG','jpeg','txt'][event_id%5+1] AS path, event_id*8 AS length, event_id%5 AS k, user_id%4 AS place FROM events)"


@query(f"WITH {FILES}, r AS (SELECT seq, min(k) AS least FROM f WHERE k<2 AND place<3 GROUP BY 1) SELECT f.seq, f.path, f.length FROM f JOIN r ON f.seq=r.seq AND f.k=r.least AND f.place<3")
def point_files(spark, d):
    return readers.point_files(_listing(spark, d), by=("seq",))


@query(f"WITH {FILES} SELECT seq, path, length FROM f WHERE k IN (2,3)")
def image_paths(spark, d):
    return readers.image_paths(_listing(spark, d))


@query(f"WITH {FILES} SELECT path, length, length//16 AS points, length%16=0 AS whole FROM f WHERE k=1")
def cloud_sizes(spark, d):
    return quality.cloud_sizes(_listing(spark, d).filter(F.endswith("path", F.lit(".bin"))))


@query("SELECT event_id, event_id%7*4 AS length, event_id%5*4 AS expected FROM events WHERE event_id%7<>event_id%5")
def label_sizes(spark, d):
    e = table(spark, d, "events")
    return quality.label_sizes(e.select("event_id", (F.col("event_id") % 7 * 4).alias("length")), e.select("event_id", (F.col("event_id") % 5).alias("points")), "event_id")


@query(
    """WITH l AS (SELECT user_id, event_id, CASE WHEN event_id%11=0 THEN 'x' WHEN event_id%7=0 THEN event_id::varchar ELSE printf('%.6e',event_id::double) END AS v FROM events),
 t AS (SELECT user_id, v, try_cast(v AS double) AS t, lag(try_cast(v AS double)) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM l),
 c AS (SELECT user_id, count(*) AS lines, count(*) FILTER (t IS NULL) AS unreadable, count(*) FILTER (t IS NOT NULL AND v NOT LIKE '%e%') AS plain, count(*) FILTER (t<b) AS backwards FROM t GROUP BY 1),
 x AS (SELECT DISTINCT user_id, user_id%40 AS expected FROM events) SELECT user_id, x.expected, lines, unreadable, plain, backwards FROM x JOIN c USING (user_id) WHERE lines<>expected OR unreadable>0 OR plain>0 OR backwards>0"""
)
def times_problems(spark, d):
    e = table(spark, d, "events")
    text = F.when(F.col("event_id") % 11 == 0, "x").when(F.col("event_id") % 7 == 0, F.col("event_id").cast("string")).otherwise(names.scientific(F.col("event_id")))
    expected = e.select("user_id", (F.col("user_id") % 40).cast("bigint").alias("expected")).distinct()
    return quality.times_problems(e.select("user_id", F.col("event_id").alias("line"), text.alias("value")), expected, "user_id")


# --- samples ---------------------------------------------------------------------------------


@query(f"WITH {STORED}, {LABELS} SELECT s.frame, s.point_idx, s.x, label>250 AS moving FROM s JOIN l USING (frame, point_idx) WHERE s.frame%9<>0")
def labelled_points(spark, d):
    """Clouds and labels of the same place, both from files; every ninth frame's labels lack one and go."""
    clouds = _clouds(spark, d, "bin").select("frame", "point_idx", *_doubles("x"))
    cut = _labels(spark, d).filter("NOT (frame_id % 9 = 0 AND point_idx = 15)")
    files = store.round_trip(writers.label_files(cut, _path("labels/%08d.label", "frame_id")), "labels")
    labels = readers.labels(spark, files).withColumn("frame", names.frame_number(F.col("path")))
    return samples.labelled(clouds, labels).select("frame", "point_idx", "x", labeling.decode(F.col("label")).alias("moving"))


@query(
    """WITH c AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn)-1 AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
 SELECT conv_id AS seq, k AS index, printf('%06d.bin',turn) AS cloud, printf('%06d.label',turn) AS label, turn AS pose FROM c WHERE NOT (conv_id%5=0 AND n>1)"""
)
def sequence_samples(spark, d):
    """The k-th cloud, label and pose of each sequence; every fifth sequence of several lacks a label and goes."""
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("seq"), "turn")
    named = lambda kind: c.select("seq", "turn", F.format_string(f"%06d.{kind}", "turn").alias("path"))
    last = c.groupBy("seq").agg(F.max("turn").alias("last"), F.count("*").alias("n"))
    labels = named("label").join(last, "seq").filter("NOT (seq % 5 = 0 AND n > 1 AND turn = last)")
    return samples.by_place(named("bin"), labels, c.select("seq", F.col("turn").alias("line"), F.col("turn").alias("pose")))


@query(
    """WITH b AS (SELECT l_suppkey, dense_rank() OVER (ORDER BY l_suppkey)-1 AS batch_id, l_linenumber, l_orderkey*8+l_linenumber AS k FROM lineitem)
 SELECT l_suppkey, l_linenumber, k AS point_idx, batch_id, row_number() OVER (ORDER BY l_suppkey, l_linenumber, k)-1 AS at FROM b"""
)
def collated_points(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_linenumber", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("point_idx"))
    return samples.collated(rows, "l_suppkey", "l_linenumber")[0]


@query(
    """WITH c AS (SELECT l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
 SELECT l_suppkey, l_linenumber, n, dense_rank() OVER (ORDER BY l_suppkey)-1 AS batch_id, (sum(n) OVER (ORDER BY l_suppkey, l_linenumber)-n)::bigint AS start, (sum(n) OVER (ORDER BY l_suppkey, l_linenumber))::bigint AS "end" FROM c"""
)
def collated_offsets(spark, d):
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_linenumber", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("point_idx"))
    return samples.collated(rows, "l_suppkey", "l_linenumber")[1]


@query("SELECT c.conv_id, c.turn AS first, c.turn+3 AS turn FROM conversations c JOIN conversations e ON e.conv_id=c.conv_id AND e.turn=c.turn+3")
def latest_frames(spark, d):
    w = windows.frame_windows(table(spark, d, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn", 4, ["role"])
    return samples.latest(windows.relative_time(w, ["conv_id", "first"], 4)).select("conv_id", "first", "frame.turn")


@query(f"WITH {SYNC_MAP} SELECT frame_id, has_camera1 AND camera1_image<>'' AND camera1_intrinsic IS NOT NULL AS camera1, has_camera2 AND camera2_intrinsic IS NOT NULL AS camera2 FROM s")
def cameras_ready(spark, d):
    ready = lambda c: samples.camera_ready(F.col(f"has_{c}"), F.col(f"{c}_image"), F.col(f"{c}_intrinsic")).alias(c)
    return sync.sync_map(_assets(spark, d)).select("frame_id", ready("camera1"), ready("camera2"))


@query(f"WITH {SYNC_MAP}, e AS (SELECT event_id::varchar AS path FROM events WHERE event_id%10<>3) SELECT frame_id FROM s WHERE lidar IN (SELECT path FROM e) AND camera1_image IN (SELECT path FROM e)")
def frames_present(spark, d):
    files = table(spark, d, "events").filter("event_id % 10 <> 3").select(F.col("event_id").cast("string").alias("path"))
    return samples.present(sync.sync_map(_assets(spark, d)), files, ["lidar", "camera1_image"]).select("frame_id")


# --- colours, names and shapes -----------------------------------------------------------------

COLOURS = ", ".join(f"('{k}','{','.join(map(str, v))}')" for k, v in labeling.CLASS_COLOURS.items())


def _text(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda v: v.cast("string")), ",")


@query(f"WITH e AS (SELECT event_id, ['person','car','bicycle','motorcycle','bus','truck','bird','cat','dog','boat'][event_id%10+1] AS c FROM events) SELECT event_id, coalesce(t.v,'0,255,0') AS colour FROM e LEFT JOIN (VALUES {COLOURS}) t(k,v) ON c=t.k")
def class_colours(spark, d):
    order = ("person", "car", "bicycle", "motorcycle", "bus", "truck", "bird", "cat", "dog", "boat")
    name = F.element_at(F.array(*(F.lit(c) for c in order)), (F.col("event_id") % 10 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", _text(labeling.class_colour(name)).alias("colour"))


@query(
    "SELECT doc_id, CASE WHEN toxic=1 AND quality=1 THEN '0,255,0' WHEN toxic=1 THEN '255,0,0' WHEN quality=1 THEN '0,0,255' ELSE '128,128,128' END AS outcome, "
    "CASE WHEN quality=1 THEN '0,255,255' ELSE '128,128,128' END AS truth FROM labels"
)
def outcome_colours(spark, d):
    outcome, truth = labeling.outcome_colours(F.col("toxic"), F.col("quality"))
    return table(spark, d, "labels").select("doc_id", _text(outcome).alias("outcome"), _text(truth).alias("truth"))


@query(f"WITH {POINTS} SELECT frame_id, point_idx, CASE WHEN {BOUNDS} THEN '1.0,0.0,0.0' ELSE '0.5,0.5,0.5' END AS colour FROM p")
def cloud_colours(spark, d):
    return writers.cloud_colours(_labelled(spark, d)).select("frame_id", "point_idx", _text(F.col("colour")).alias("colour"))


@query(
    "WITH p AS (SELECT l_suppkey, l_linenumber AS r, (l_quantity%7)::int AS c, max(l_orderkey) AS instance FROM lineitem GROUP BY 1, 2, 3) SELECT l_suppkey, r, c, instance, "
    "['255,0,0','0,255,0','0,0,255','255,255,0','255,0,255','0,255,255','128,0,128','255,165,0'][instance%8+1] AS colour FROM p"
)
def mask_colours(spark, d):
    px = table(spark, d, "lineitem").select("l_suppkey", F.col("l_linenumber").alias("r"), (F.col("l_quantity") % 7).cast("int").alias("c"), F.col("l_orderkey").alias("instance"))
    return writers.combined_masks(px, ["l_suppkey"]).withColumn("colour", _text(F.col("colour")))


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id)-1 AS instance FROM events WHERE value>=50")
def mask_numbers(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.col("event_type").alias("camera"), F.col("event_id").alias("det_idx"), F.when(F.col("value") >= 50, 1).alias("mask"))
    return writers.numbered_masks(e, "user_id").select("user_id", "event_id", F.col("instance").cast("bigint").alias("instance"))


@query("SELECT event_id, replace('scan_'||event_id||'.pcd','.pcd','.bin') AS swapped, 'run_'||event_id AS prefixed FROM events")
def renamed_files(spark, d):
    base = F.concat(F.lit("scan_"), F.col("event_id").cast("string"), F.lit(".pcd"))
    return table(spark, d, "events").select("event_id", names.swap_extension(base, ".pcd", ".bin").alias("swapped"), names.prefixed("run", F.col("event_id").cast("string")).alias("prefixed"))


@query("SELECT user_id, round(CASE WHEN max(value)>50 THEN count(*)/max(value)::double ELSE 15 END,9) AS fps FROM events GROUP BY 1")
def frame_rates(spark, d):
    e = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.max("value").cast("double").alias("m"))
    return e.select("user_id", F.round(names.frame_rate(None, F.col("n"), F.when(F.col("m") > 50, F.col("m"))), 9).alias("fps"))


@query(
    f"WITH {POINTS} SELECT frame_id, point_idx FROM p WHERE z BETWEEN 0.5 AND 50 AND x*500/z+320 BETWEEN {BBOX[0]} AND {BBOX[2]} AND y*500/z+240 BETWEEN {BBOX[1]} AND {BBOX[3]}"
)
def points_in_frustum(spark, d):
    box = F.array(*(F.lit(v) for v in BBOX))
    return points(spark, d).filter(F.col("z") != 0).filter(geometry.in_frustum(box, **CAMERA)).select("frame_id", "point_idx")


@query(
    "SELECT vec_id, r, c, round((embedding[16*r+2*c+1]::double+embedding[16*r+2*c+2]::double+embedding[16*r+2*c+9]::double+embedding[16*r+2*c+10]::double)*0.25,6)+0.0 AS v "
    "FROM embeddings, (SELECT unnest(range(4)) AS r), (SELECT unnest(range(4)) AS c)"
)
def resized_images(spark, d):
    px = F.transform("embedding", lambda x: x.cast("double"))
    e = table(spark, d, "embeddings").select("vec_id", F.lit(8).alias("h"), F.lit(8).alias("w"), px.alias("px"), F.lit(4).alias("m"), F.lit(4).alias("n"))
    out = windows.resized(e, "m", "n").select("vec_id", F.posexplode("px").alias("k", "v"))
    return out.select("vec_id", F.expr("k div 4").alias("r"), (F.col("k") % 4).cast("bigint").alias("c"), (F.round("v", 6) + 0.0).alias("v"))


@query(
    f"""WITH {SYNC_MAP}, {POINTS}, t AS (SELECT frame_id, count(*) AS num_points, count(*) FILTER ({BOUNDS}) AS moving_points FROM p WHERE frame_id%3<>0 GROUP BY 1),
 u AS (SELECT frame_id, count(*) AS num_points FROM p WHERE frame_id%3=0 GROUP BY 1)
 SELECT s.frame_id, coalesce(t.num_points,u.num_points) AS num_points, coalesce(t.moving_points,0) AS moving_points, (t.frame_id IS NOT NULL) AS detected FROM s LEFT JOIN t USING (frame_id) LEFT JOIN u USING (frame_id)
 WHERE s.frame_id<200 AND (t.frame_id IS NOT NULL OR u.frame_id IS NOT NULL)"""
)
def annotated_frames(spark, d):
    """The first two hundred frames of the sync map, annotated; in every third the detection lacks confidence."""
    frames = table(spark, d, "embeddings").select(F.col("vec_id").alias("frame_id"))
    confidence = F.when(F.col("frame_id") % 3 == 0, 0.1).otherwise(0.9)
    found = frames.select("frame_id", F.lit("person").alias("class_name"), F.array(*(F.lit(v) for v in BBOX)).alias("bbox"), confidence.alias("confidence"))
    out = flows.annotated(sync.sync_map(_assets(spark, d)), points(spark, d), found, CAMERA, limit=200)
    return out.select("frame_id", "num_points", "moving_points", F.col("detections_2d").isNotNull().alias("detected"))


@query(f"WITH {FILES}, r AS (SELECT seq, min(k) AS least FROM f WHERE k<2 AND place<3 GROUP BY 1), g AS (SELECT f.seq, regexp_extract(path,'(\\d+)\\.',1)::bigint AS frame FROM f JOIN r ON f.seq=r.seq AND f.k=r.least WHERE f.place<3), h AS (SELECT *, min(frame) OVER (PARTITION BY seq) AS lo, row_number() OVER (PARTITION BY seq ORDER BY frame)-1 AS k FROM g) SELECT seq, frame, round(CASE WHEN lo=0 THEN k ELSE frame-lo END/10.0::double,6) AS time FROM h")
def sequence_times(spark, d):
    files = readers.point_files(_listing(spark, d), by=("seq",))
    rows = files.select("seq", names.frame_number(names.base_name(F.col("path"))).alias("frame"))
    return names.frame_times(rows, "seq", "frame", 10.0).withColumn("time", F.round("time", 6))
