"""Queries over the driver's tables, and the same in SQL.

``QUERIES`` maps a name to a pair: a function of (spark, sf_dir), and SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanloom.functions import names
from scanloom.operators import geometry, labeling, quality, sync, windows
from scanloom.plans.views import BBOX, BOXES, CAMERA, messages, points, table

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {}

#: Microseconds: tolerance, and buckets of the time join.
SECOND, BUCKET = 1_000_000, 3_600 * 1_000_000


def query(sql: str) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f, sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, (f, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in QUERIES.items()}


# --- SQL shared by several queries ---------------------------------------------------

POINTS = """p AS (SELECT vec_id AS frame_id, i AS point_idx, embedding[i*4+1]::double*50 AS x, embedding[i*4+2]::double*50 AS y,
 embedding[i*4+3]::double*50 AS z, embedding[i*4+4]::double*50 AS intensity FROM embeddings, (SELECT unnest(range(16)) AS i))"""


def _stream(topic: str) -> str:
    return f"(SELECT event_id, epoch_us(ts) AS ts FROM events WHERE event_type='{topic}')"


def _nearest(right: str, name: str, left: str = "click") -> str:
    return f"""{name} AS (SELECT * EXCLUDE (k) FROM (SELECT l.event_id, l.ts, r.ts AS ts_right, r.event_id AS event_id_right,
 row_number() OVER (PARTITION BY l.event_id ORDER BY abs(l.ts-r.ts), r.ts, r.event_id) AS k FROM {_stream(left)} l LEFT JOIN {_stream(right)} r ON true) WHERE k=1)"""


BOUNDS = "x BETWEEN least(-0.24*0.5,-0.24*50,0.26*0.5,0.26*50)::double AND greatest(-0.24*0.5,-0.24*50,0.26*0.5,0.26*50)::double AND y BETWEEN least(-0.28*0.5,-0.28*50,0.32*0.5,0.32*50)::double AND greatest(-0.28*0.5,-0.28*50,0.32*0.5,0.32*50)::double AND z BETWEEN 0.5 AND 50 AND z>0"


def _in_box(b: tuple) -> str:
    cx, cy, cz, l, w, h, r = (f"({v})::double" for v in b)
    return f"(abs((x-{cx})*cos({r})+(y-{cy})*sin({r}))<={l}/2 AND abs((y-{cy})*cos({r})-(x-{cx})*sin({r}))<={w}/2 AND abs(z-{cz})<={h}/2)"


STATS = f"""WITH {POINTS}, f AS (SELECT frame_id, count(*) AS num_points, count(*) FILTER ({BOUNDS}) AS moving_points FROM p GROUP BY 1)"""


# --- time ----------------------------------------------------------------------------


@query(f"WITH {_nearest('view', 'n')} SELECT event_id, ts, ts_right, event_id_right, ts-ts_right AS offset_us FROM n WHERE abs(ts-ts_right)<=600000000")
def sync_nearest_tol(spark, d):
    out = sync.nearest(messages(spark, d, "click"), messages(spark, d, "view"), "ts", "event_id", BUCKET, tolerance=600 * SECOND)
    return out.withColumn("offset_us", F.col("ts") - F.col("ts_right"))


@query(f"WITH {_nearest('error', 'n', 'view')} SELECT * FROM n")
def sync_caminfo_nearest(spark, d):
    return sync.nearest(messages(spark, d, "view"), messages(spark, d, "error"), "ts", "event_id", BUCKET)


@query(
    f"WITH {_nearest('view', 'a')}, {_nearest('purchase', 'b')} SELECT *, 'camera1' AS camera FROM a WHERE abs(ts-ts_right)<=600000000 "
    "UNION ALL SELECT *, 'camera2' AS camera FROM b WHERE abs(ts-ts_right)<=600000000"
)
def sync_dual_camera(spark, d):
    rights = {"camera1": messages(spark, d, "view"), "camera2": messages(spark, d, "purchase")}
    return sync.cameras(messages(spark, d, "click"), rights, "ts", "event_id", BUCKET, tolerance=600 * SECOND)


#: Event types as the assets of a sync map.
ASSETS = dict(zip(("click", "view", "purchase", "error", "signup"), sync.KINDS))

SYNC_MAP = """m AS (SELECT epoch_us(ts)//3600000000 AS timestamp, max(CASE event_type WHEN 'click' THEN event_id::varchar END) AS lidar,
 max(CASE event_type WHEN 'view' THEN event_id::varchar END) AS camera1_image, max(CASE event_type WHEN 'purchase' THEN event_id::varchar END) AS camera1_intrinsic,
 max(CASE event_type WHEN 'error' THEN event_id::varchar END) AS camera2_image, max(CASE event_type WHEN 'signup' THEN event_id::varchar END) AS camera2_intrinsic
 FROM events GROUP BY 1), s AS (SELECT *, camera1_image IS NOT NULL AS has_camera1, camera2_image IS NOT NULL AS has_camera2,
 camera1_image IS NOT NULL AND camera2_image IS NOT NULL AS complete_frame, row_number() OVER (ORDER BY timestamp)-1 AS frame_id FROM m WHERE lidar IS NOT NULL)"""


def _assets(spark, d):
    e = table(spark, d, "events")
    kind = F.element_at(F.create_map(*(F.lit(x) for pair in ASSETS.items() for x in pair)), F.col("event_type"))
    hour = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(3600 * SECOND)).cast("bigint")
    return e.select(kind.alias("kind"), hour.alias("timestamp"), F.col("event_id").cast("string").alias("path"))


@query(f"WITH {SYNC_MAP} SELECT * FROM s")
def sync_map(spark, d):
    return sync.sync_map(_assets(spark, d))


@query(
    f"WITH {SYNC_MAP} SELECT count(*) AS frames, count(*) FILTER (complete_frame) AS complete_frame, count(*) FILTER (has_camera1) AS has_camera1, "
    "count(*) FILTER (has_camera2) AS has_camera2 FROM s"
)
def sync_map_summary(spark, d):
    return sync.summary(sync.sync_map(_assets(spark, d)))


@query("SELECT event_type AS topic, count(*) AS messages, min(epoch_us(ts)) AS first_ts, max(epoch_us(ts)) AS last_ts FROM events GROUP BY 1")
def topic_catalog(spark, d):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").groupBy(F.col("event_type").alias("topic")).agg(F.count("*").alias("messages"), F.min(us).alias("first_ts"), F.max(us).alias("last_ts"))


@query("SELECT user_id, epoch_us(ts)//60000000 AS minute, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def message_dedupe(spark, d):
    minute = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(60 * SECOND)).cast("bigint")
    return sync.first_of(table(spark, d, "events").withColumn("minute", minute), "minute", ["user_id"], "event_id")


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 'lidar' ELSE 'camera1' END AS role FROM events WHERE event_type IN ('click','view')")
def topic_routing(spark, d):
    e = table(spark, d, "events").withColumnRenamed("event_type", "topic")
    return sync.routed(e, {"lidar": "click", "camera1": "view"}).select("event_id", "role")


# --- points --------------------------------------------------------------------------


@query(f"WITH {POINTS} SELECT frame_id, count(*) AS n FROM p WHERE abs(x)<10 AND abs(y)<10 GROUP BY 1")
def crop_square(spark, d):
    return geometry.crop_square(points(spark, d)).groupBy("frame_id").agg(F.count("*").alias("n"))


@query(f"WITH {POINTS} SELECT frame_id, point_idx FROM p WHERE NOT (isnan(x) OR isnan(y) OR isnan(z) OR point_idx%5=0)")
def nan_filter(spark, d):
    p = points(spark, d).withColumn("x", F.when(F.col("point_idx") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("x")))
    return geometry.finite_xyz(p).select("frame_id", "point_idx")


def _labelled(spark, d):
    p = points(spark, d)
    detections = table(spark, d, "embeddings").select(F.col("vec_id").alias("frame_id"), F.array(*(F.lit(v) for v in BBOX)).alias("bbox"))
    return labeling.label_by_detections(p, detections, CAMERA)


@query(f"WITH {POINTS} SELECT frame_id, point_idx, ({BOUNDS}) AS is_moving FROM p")
def frustum_label(spark, d):
    return _labelled(spark, d).select("frame_id", "point_idx", "is_moving")


@query(f"{STATS} SELECT *, num_points-moving_points AS static_points, round(moving_points/num_points::double,6) AS moving_ratio FROM f")
def frame_moving_stats(spark, d):
    return labeling.frame_stats(_labelled(spark, d)).withColumn("moving_ratio", F.round("moving_ratio", 6))


@query(
    f"{STATS} SELECT count(*) AS frames, sum(num_points)::bigint AS points, sum(moving_points)::bigint AS moving, sum(num_points-moving_points)::bigint AS static, "
    "round(sum(moving_points)::double/sum(num_points)::double,6) AS micro_ratio, round(avg(moving_points/num_points::double),6) AS macro_ratio FROM f"
)
def run_stats(spark, d):
    return labeling.run_stats(labeling.frame_stats(_labelled(spark, d))).withColumns({c: F.round(c, 6) for c in ("micro_ratio", "macro_ratio")})


def _boxes(spark, d):
    """Three boxes a frame; the second one rests."""
    one = lambda k, b: F.struct(F.lit(k).alias("box_id"), F.lit(k != 1).alias("is_moving"), F.struct(*(F.lit(v).alias(n) for v, n in zip(b, ("cx", "cy", "cz", "l", "w", "h", "rot_z")))).alias("box"))
    frames = table(spark, d, "embeddings").select(F.col("vec_id").alias("frame_id"))
    return frames.select("frame_id", F.explode(F.array(*(one(k, b) for k, b in enumerate(BOXES)))).alias("b")).select("frame_id", "b.*")


@query(f"WITH {POINTS} SELECT frame_id, point_idx, ({_in_box(BOXES[0])} OR {_in_box(BOXES[2])}) AS is_moving FROM p")
def rotated_box_label(spark, d):
    return labeling.label_by_boxes(points(spark, d), _boxes(spark, d)).select("frame_id", "point_idx", "is_moving")


@query(f"WITH {POINTS} " + " UNION ALL ".join(f"SELECT frame_id, {k} AS box_id, count(*) FILTER ({_in_box(b)}) AS points FROM p GROUP BY 1" for k, b in enumerate(BOXES)))
def box_point_counts(spark, d):
    return labeling.hits_per_box(points(spark, d), _boxes(spark, d))


@query(
    f"WITH {POINTS} SELECT count(*) AS points, " + ", ".join(f"round({f}({c}),6) AS {f}_{c}" for c in ("x", "y", "z", "intensity") for f in ("min", "max")) + " FROM p"
)
def cloud_stats(spark, d):
    out = quality.cloud_stats(points(spark, d))
    return out.select("points", *(F.round(c, 6).alias(c) for c in out.columns if c != "points"))


POSE = "ps AS (SELECT frame_id, min(x) FILTER (point_idx=0) AS tx, min(y) FILTER (point_idx=0) AS ty, min(z) FILTER (point_idx=0) AS tz, sin(frame_id*0.1) AS qz, cos(frame_id*0.1) AS qw FROM p GROUP BY 1)"


@query(
    f"""WITH {POINTS}, {POSE}, m AS (SELECT frame_id, frame_id//4 AS w, tx, ty, tz, 1-2*qz*qz AS c, 2*qz*qw AS s FROM ps),
 r AS (SELECT w, arg_max(tx,frame_id) AS rx, arg_max(ty,frame_id) AS ry, arg_max(tz,frame_id) AS rz, arg_max(c,frame_id) AS rc, arg_max(s,frame_id) AS rs FROM m GROUP BY 1),
 g AS (SELECT frame_id, point_idx, c*x-s*y+tx-rx AS gx, s*x+c*y+ty-ry AS gy, z+tz-rz AS gz, rc, rs FROM p JOIN m USING (frame_id) JOIN r USING (w))
 SELECT frame_id, point_idx, round(rc*gx+rs*gy,5)+0.0 AS x, round(rc*gy-rs*gx,5)+0.0 AS y, round(gz,5)+0.0 AS z FROM g"""
)
def canonical_transform(spark, d):
    p = points(spark, d)
    first = F.min(F.when(F.col("point_idx") == 0, F.struct("x", "y", "z")))
    pose = p.groupBy("frame_id").agg(first.alias("t"))
    angle = F.col("frame_id") * 0.1
    parts = {"tx": F.col("t.x"), "ty": F.col("t.y"), "tz": F.col("t.z"), "qx": F.lit(0.0), "qy": F.lit(0.0), "qz": F.sin(angle), "qw": F.cos(angle)}
    pose = pose.select("frame_id", F.floor(F.col("frame_id") / 4).alias("w"), F.struct(*(v.alias(k) for k, v in parts.items())).alias("pose"))
    p = p.withColumn("w", F.floor(F.col("frame_id") / 4))
    out = geometry.canonical(p, pose, ["w"], "frame_id", "frame_id")
    return out.select("frame_id", "point_idx", *((F.round(c, 5) + 0.0).alias(c) for c in "xyz"))


# --- detections, labels ----------------------------------------------------------------


@query(
    "SELECT event_id FROM events WHERE event_type IN ('click','view','purchase') AND value>=50 AND user_id%7>user_id%3"
)
def detection_filter(spark, d):
    e = table(spark, d, "events")
    box = F.array((F.col("user_id") % 3).cast("double"), F.lit(0.0), (F.col("user_id") % 7).cast("double"), F.lit(1.0))
    det = e.select("event_id", F.col("event_type").alias("class_name"), F.col("value").alias("confidence"), box.alias("bbox"))
    return labeling.valid_detections(det, 50.0, ("click", "view", "purchase")).select("event_id")


@query("SELECT doc_id FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id=documents.doc_id)")
def frames_missing_labels(spark, d):
    return quality.missing(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("SELECT doc_id FROM documents WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id=documents.doc_id)")
def frames_with_labels(spark, d):
    return quality.available(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("SELECT d.doc_id, CASE WHEN l.toxic=1 THEN 9 ELSE 251 END::bigint AS label FROM documents d LEFT JOIN labels l USING (doc_id)")
def labels_default_static(spark, d):
    out = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id", "toxic"), "doc_id", "left")
    return out.select("doc_id", labeling.encode(F.coalesce(F.col("toxic") == 1, F.lit(False)), "boxes").alias("label"))


@query("SELECT vec_id, label*50>250 AS is_moving FROM embeddings")
def binary_label(spark, d):
    return table(spark, d, "embeddings").select("vec_id", labeling.decode(F.col("label") * 50).alias("is_moving"))


REMAP = {0: 0, 1: 0, 2: 1, 3: 1, 4: 2, 5: 2, 6: 1, 7: 0, 9: 2}


@query(f"SELECT vec_id, m.v AS class FROM embeddings LEFT JOIN (VALUES {', '.join(map(str, REMAP.items()))}) m(k,v) ON label=m.k")
def label_remap(spark, d):
    return labeling.remap(table(spark, d, "embeddings"), "label", REMAP, "class").select("vec_id", "class")


@query(
    "WITH l AS (SELECT quality*2+toxic AS label, count(*) AS n FROM labels GROUP BY 1) SELECT label::int AS label, n, round(n*100.0::double/sum(n) OVER (),6) AS percent, label IN (0,2) AS valid FROM l"
)
def label_audit(spark, d):
    rows = table(spark, d, "labels").select((F.col("quality") * 2 + F.col("toxic")).cast("int").alias("l"))
    return quality.label_audit(rows, "l", (0, 2)).withColumn("percent", F.round(F.col("percent").cast("double"), 6))


@query(
    """WITH e AS (SELECT user_id, event_id, event_type, value/100.0 AS c FROM events), a AS (SELECT user_id, bool_or(event_type='purchase' AND c>=0.5) AS act FROM e GROUP BY 1),
 h AS (SELECT user_id, event_id, CASE WHEN event_type='click' AND c>=0.5 THEN 1 WHEN event_type='error' AND c>=0.6 THEN 2 END AS code FROM e),
 f AS (SELECT user_id, arg_min(code,event_id) AS code FROM h WHERE code IS NOT NULL GROUP BY 1)
 SELECT user_id, (act OR coalesce(code=1,false)) AS is_moving FROM a LEFT JOIN f USING (user_id)"""
)
def motion_state(spark, d):
    e = table(spark, d, "events").withColumn("c", F.col("value") / 100.0)
    as_name = F.when(F.col("event_type") == "click", "Walking slowly").when(F.col("event_type") == "error", "standing").otherwise("other")
    entry = F.struct("event_id", as_name.alias("key"), F.col("c").alias("value"))
    act = F.struct("event_id", F.when(F.col("event_type") == "purchase", "walking").otherwise("none").alias("key"), F.col("c").alias("value"))
    lists = e.groupBy("user_id").agg(F.array_sort(F.collect_list(act)).alias("a"), F.array_sort(F.collect_list(entry)).alias("s"))
    pairs = lambda c: F.transform(c, lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value")))
    return lists.select("user_id", labeling.is_moving(pairs(F.col("a")), pairs(F.col("s"))).alias("is_moving"))


@query(
    "SELECT doc_id%10 AS g, count(*) FILTER (toxic=1 AND quality=1) AS tp, count(*) FILTER (toxic=1 AND quality=0) AS fp, count(*) FILTER (toxic=0 AND quality=1) AS fn, "
    "count(*) FILTER (toxic=0 AND quality=0) AS tn FROM labels GROUP BY 1"
)
def confusion_counts(spark, d):
    return labeling.confusion(table(spark, d, "labels").withColumn("g", F.col("doc_id") % 10), F.col("toxic"), F.col("quality"), ["g"])


@query(
    """WITH c AS (SELECT doc_id%10 AS g, count(*) FILTER (toxic=1 AND quality=1)::double AS tp, count(*) FILTER (toxic=1 AND quality=0)::double AS fp,
 count(*) FILTER (toxic=0 AND quality=1)::double AS fn FROM labels GROUP BY 1), r AS (SELECT *, tp+fp+fn AS u FROM c)
 SELECT round(sum(tp)/sum(u),6) AS micro_iou, round(sum(tp)/sum(tp+fp),6) AS micro_precision, round(sum(tp)/sum(tp+fn),6) AS micro_recall, round(2*sum(tp)/sum(2*tp+fp+fn),6) AS micro_f1,
 round(avg(coalesce(tp/nullif(u,0),0)),6) AS macro_iou, round(avg(coalesce(tp/nullif(tp+fp,0),0)),6) AS macro_precision, round(avg(coalesce(tp/nullif(tp+fn,0),0)),6) AS macro_recall,
 round(avg(coalesce(2*tp/nullif(2*tp+fp+fn,0),0)),6) AS macro_f1 FROM r"""
)
def segmentation_metrics(spark, d):
    out = labeling.segmentation_metrics(confusion_counts(spark, d))
    return out.select(*(F.round(c, 6).alias(c) for c in out.columns))


@query("SELECT p_type, arg_max(p_name, {'a': p_retailprice, 'b': p_partkey}) AS p_name FROM part GROUP BY 1")
def best_checkpoint(spark, d):
    return labeling.best(table(spark, d, "part"), "p_name", "p_retailprice", "p_partkey", by=["p_type"])


# --- windows, samples --------------------------------------------------------------------


@query(
    "SELECT conv_id, turn AS first, array_to_string([turn,t1,t2,t3],',') AS turns FROM (SELECT conv_id, turn, lead(turn,1) OVER w AS t1, lead(turn,2) OVER w AS t2, "
    "lead(turn,3) OVER w AS t3 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) WHERE t3 IS NOT NULL"
)
def frame_windows(spark, d):
    w = windows.frame_windows(table(spark, d, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn", 4, ["role"])
    return w.select("conv_id", "first", F.array_join(F.transform("window", lambda s: s["turn"].cast("string")), ",").alias("turns"))


@query(
    "SELECT c.conv_id, c.turn AS first, k AS pos, n.turn, round(k/3.0::double,6) AS t FROM conversations c, (SELECT unnest(range(4))::int AS k), conversations n "
    "WHERE n.conv_id=c.conv_id AND n.turn=c.turn+k AND EXISTS (SELECT 1 FROM conversations e WHERE e.conv_id=c.conv_id AND e.turn=c.turn+3)"
)
def window_relative_time(spark, d):
    w = windows.frame_windows(table(spark, d, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn", 4, ["role"])
    return windows.relative_time(w, ["conv_id", "first"], 4).select("conv_id", "first", "pos", "frame.turn", F.round("t", 6).alias("t"))


@query(
    'WITH c AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) SELECT l_orderkey, n, sum(n) OVER (ORDER BY l_orderkey)::bigint AS "end", (sum(n) OVER (ORDER BY l_orderkey)-n)::bigint AS start FROM c'
)
def point_offsets(spark, d):
    counts = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return windows.offsets(counts, "l_orderkey", "n", block=1 << 12)


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY md5(o_orderkey::varchar)) AS k FROM orders) WHERE k<=5")
def sample_fixed_n(spark, d):
    return windows.sample_fixed(table(spark, d, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], F.md5(F.col("o_orderkey").cast("string")), 5)


@query(
    "WITH c AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn)-1 AS slot FROM conversations) "
    "SELECT s.conv_id, s.slot, coalesce(c.turn,-1) AS turn FROM (SELECT DISTINCT conv_id, unnest(range(5))::int AS slot FROM conversations) s LEFT JOIN c ON c.conv_id=s.conv_id AND c.slot=s.slot"
)
def pad_or_truncate(spark, d):
    return windows.pad(table(spark, d, "conversations"), "conv_id", "turn", 5, {"turn": -1})


@query(
    """WITH px AS (SELECT vec_id, i, embedding[i+1]::double AS v, lag(embedding[i+1]::double) OVER (PARTITION BY i ORDER BY vec_id) AS p FROM embeddings, (SELECT unnest(range(64)) AS i)),
 r AS (SELECT vec_id, CASE WHEN p BETWEEN 0 AND 1 AND v BETWEEN 0 AND 1 THEN abs(v-p)/CASE WHEN v=0 THEN 1e-8 ELSE v END ELSE 0 END AS d FROM px)
 SELECT vec_id, count(*) FILTER (d>0) AS changed, round(max(d),4) AS peak FROM r GROUP BY 1"""
)
def residual_lag(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("px"), F.lit("all").alias("seq"))
    r = windows.residual(F.col("px"), F.col("previous"), 0.0, 1.0)
    out = windows.lagged(e, ["seq"], "vec_id", "px", 1, block=1 << 12).select("vec_id", r.alias("d"))
    return out.select("vec_id", F.size(F.filter("d", lambda x: x > 0)).cast("bigint").alias("changed"), F.round(F.array_max("d"), 4).alias("peak"))


@query(
    "WITH c AS (SELECT user_id, " + ", ".join(f"count(*) FILTER (event_type='{k}') AS {k}" for k in ASSETS) + " FROM events GROUP BY 1) "
    f"SELECT *, least({', '.join(ASSETS)})=greatest({', '.join(ASSETS)}) AS consistent FROM c"
)
def residual_counts_pivot(spark, d):
    return quality.folder_counts(table(spark, d, "events"), "user_id", "event_type", list(ASSETS))


@query(
    """WITH f AS (SELECT conv_id, turn, turn*(1+conv_id%2)+conv_id%3 AS n FROM conversations), g AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n)-1 AS k,
 min(n) OVER w AS lo, count(n) OVER w=count(DISTINCT n) OVER w AS once FROM f WINDOW w AS (PARTITION BY conv_id)) SELECT conv_id, turn, n, round(CASE WHEN lo=0 AND once THEN k ELSE n-lo END*(1.0/15)::double,6) AS time FROM g"""
)
def frame_times(spark, d):
    """Every turn as a frame; numbers of odd conversations have gaps, and only every third conversation begins at 0."""
    n = F.col("turn") * (F.col("conv_id") % 2 + 1) + F.col("conv_id") % 3
    c = table(spark, d, "conversations").select("conv_id", "turn", n.cast("bigint").alias("n"))
    return names.frame_times(c, "conv_id", "n").withColumn("time", F.round("time", 6))


@query(
    """WITH g AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn)-1 AS k, min(turn) OVER w AS lo, count(turn) OVER w=count(DISTINCT turn) OVER w AS once
 FROM conversations WINDOW w AS (PARTITION BY conv_id)) SELECT conv_id, turn, round(CASE WHEN lo=0 AND once THEN k ELSE turn-lo END*(1.0/15)::double,6) AS time FROM g"""
)
def turn_times(spark, d):
    c = table(spark, d, "conversations").select("conv_id", "turn")
    return names.frame_times(c, "conv_id", "turn").withColumn("time", F.round("time", 6))


@query(
    """WITH s AS (SELECT event_type, epoch_us(ts) AS t, epoch_us(ts)-lag(epoch_us(ts)) OVER (PARTITION BY event_type ORDER BY event_id) AS d FROM events)
 SELECT event_type, count(*) AS n, coalesce(bool_and(d>=0),true) AS monotone, min(t) AS first, max(t) AS last, round(avg(d),3) AS mean_interval,
 round(CASE WHEN avg(d)>0 THEN 1/avg(d) END,9) AS fps FROM s GROUP BY 1"""
)
def times_quality(spark, d):
    e = table(spark, d, "events").select("event_type", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    out = quality.times_quality(e, "event_type", "t", "event_id", block=1 << 16)
    return out.withColumns({"mean_interval": F.round("mean_interval", 3), "fps": F.round("fps", 9)})


# --- calibration ---------------------------------------------------------------------------

#: All vectors, sixty-four to a rig.
RIG = (
    "c AS (SELECT vec_id//64 AS rig, (vec_id%64)::varchar AS sensor_id, embedding[1]::double AS a, embedding[2]::double AS b, "
    "embedding[3]::double AS e, embedding[4]::double AS f FROM embeddings)"
)


def _cameras(spark, d, size: int):
    """Every vector as a camera, ``size`` to a rig."""
    v = F.col("embedding")
    return table(spark, d, "embeddings").select(
        F.expr(f"vec_id div {size}").alias("rig"), (F.col("vec_id") % size).cast("string").alias("sensor_id"), F.col("vec_id").alias("position"),
        F.array(*(v[k].cast("double") for k in range(3))).alias("t"),
        v[0].cast("double").alias("fy"), v[1].cast("double").alias("cy"), v[2].cast("double").alias("fx"), v[3].cast("double").alias("cx"),
    )


def _rig(spark, d):
    return _cameras(spark, d, 64)


@query(
    f"WITH {RIG}, s AS (SELECT rig, a-lag(a) OVER w AS x, b-lag(b) OVER w AS y, e-lag(e) OVER w AS z FROM c WINDOW w AS (PARTITION BY rig ORDER BY sensor_id)) "
    "SELECT rig, round(coalesce(median(sqrt(x*x+y*y+z*z)),0.06),9) AS baseline FROM s GROUP BY 1"
)
def camera_baseline(spark, d):
    return geometry.baseline(_rig(spark, d), by=["rig"]).select("rig", F.round("baseline", 9).alias("baseline"))


@query(f"WITH {RIG} SELECT rig, count(*) AS points, " + ", ".join(f"round({f}({v}),9) AS {f}_{c}" for v, c in (("e", "fx"), ("a", "fy"), ("f", "cx"), ("b", "cy")) for f in ("min", "max")) + " FROM c GROUP BY 1")
def camera_ranges(spark, d):
    out = quality.cloud_stats(_rig(spark, d), by=["rig"], axes=("fx", "fy", "cx", "cy"))
    return out.select("rig", "points", *(F.round(c, 9).alias(c) for c in out.columns if c not in ("rig", "points")))


@query(f"WITH {RIG} SELECT rig, round(median(a),9) AS f, round(median(b)/480*480,9) AS y0, 3760 AS width, 480 AS height FROM c GROUP BY 1")
def cylindrical_params(spark, d):
    return geometry.cylindrical(_rig(spark, d), by=["rig"]).withColumns({"f": F.round("f", 9), "y0": F.round("y0", 9)})


@query(f"WITH {RIG} SELECT rig, CASE WHEN bool_or(sensor_id='7') THEN '7' ELSE min(sensor_id) END AS sensor_id FROM c GROUP BY 1")
def reference_camera(spark, d):
    return geometry.reference_camera(_rig(spark, d), "7", by=["rig"]).select("rig", "sensor_id")


#: All vectors, ten to a rig.
RIGS = (
    "c AS (SELECT vec_id//10 AS rig, (vec_id%10)::varchar AS sensor_id, embedding[1]::double AS a, embedding[2]::double AS b, "
    "embedding[3]::double AS e, embedding[4]::double AS f FROM embeddings)"
)


def _rigs(spark, d):
    return _cameras(spark, d, 10)


@query(
    f"WITH {RIGS}, s AS (SELECT rig, a-lag(a) OVER w AS x, b-lag(b) OVER w AS y, e-lag(e) OVER w AS z FROM c WINDOW w AS (PARTITION BY rig ORDER BY sensor_id)) "
    "SELECT rig, round(coalesce(median(sqrt(x*x+y*y+z*z)),0.06),9) AS baseline FROM s GROUP BY 1"
)
def rig_baselines(spark, d):
    return geometry.baseline(_rigs(spark, d), by=["rig"]).select("rig", F.round("baseline", 9).alias("baseline"))


@query(f"WITH {RIGS} SELECT rig, count(*) AS points, " + ", ".join(f"round({f}({v}),9) AS {f}_{c}" for v, c in (("e", "fx"), ("a", "fy"), ("f", "cx"), ("b", "cy")) for f in ("min", "max")) + " FROM c GROUP BY 1")
def rig_ranges(spark, d):
    out = quality.cloud_stats(_rigs(spark, d), by=["rig"], axes=("fx", "fy", "cx", "cy"))
    return out.select("rig", "points", *(F.round(c, 9).alias(c) for c in out.columns if c not in ("rig", "points")))


@query(f"WITH {RIGS} SELECT rig, round(median(a),9) AS f, round(median(b)/480*480,9) AS y0, 3760 AS width, 480 AS height FROM c GROUP BY 1")
def rig_cylinders(spark, d):
    return geometry.cylindrical(_rigs(spark, d), by=["rig"]).withColumns({"f": F.round("f", 9), "y0": F.round("y0", 9)})


@query(f"WITH {RIGS} SELECT rig, CASE WHEN bool_or(sensor_id='7') THEN '7' ELSE min(sensor_id) END AS sensor_id FROM c GROUP BY 1")
def rig_references(spark, d):
    return geometry.reference_camera(_rigs(spark, d), "7", by=["rig"]).select("rig", "sensor_id")


@query(
    "SELECT vec_id, round(500*e1+320*e3-500*0.06::double,6)+0.0 AS p03, round(500*e2+240*e3,6)+0.0 AS p13, round(e3,6)+0.0 AS p23 FROM "
    "(SELECT vec_id, embedding[1]::double AS e1, embedding[2]::double AS e2, embedding[3]::double AS e3 FROM embeddings)"
)
def projection_matrix(spark, d):
    v = F.col("embedding")
    arr = lambda *x: F.array(*(F.lit(float(y)) for y in x))
    p = geometry.projection(arr(500, 0, 320, 0, 500, 240, 0, 0, 1), arr(1, 0, 0, 0, 1, 0, 0, 0, 1), F.array(*(v[k].cast("double") for k in range(3))), 0.06)
    return table(spark, d, "embeddings").select("vec_id", *((F.round(p[k], 6) + 0.0).alias(n) for k, n in ((3, "p03"), (7, "p13"), (11, "p23"))))


@query(
    "SELECT vec_id, 'P0: '||" + "||' '||".join(f"printf('%.6e',({v})::double)" for v in ("vec_id%97/8.0", 0, 320, "-(vec_id%13)", 0, "vec_id%97/8.0", 240, 0, 0, 0, 1, 0.5)) + " AS line FROM embeddings"
)
def calib_text(spark, d):
    f, t = (F.col("vec_id") % 97 / 8.0).cast("string"), (-(F.col("vec_id") % 13)).cast("string")
    text = F.concat_ws(" ", f, F.lit("0 320"), t, F.lit("\n0"), f, F.lit("240 0\n[0, 0; 1 0.5]"))
    rows = table(spark, d, "embeddings").withColumn("p", geometry.matrix_from(text))
    return rows.select("vec_id", F.concat(F.lit("P0: "), F.concat_ws(" ", F.transform("p", names.scientific))).alias("line"))


# --- names, masks ----------------------------------------------------------------------------


@query(
    "SELECT l_suppkey, l_linenumber, min(l_quantity) AS y1, min(l_partkey) AS x1, max(l_quantity) AS y2, max(l_partkey) AS x2 FROM lineitem WHERE l_linenumber<>0 GROUP BY 1, 2"
)
def instance_bboxes(spark, d):
    return quality.instance_boxes(table(spark, d, "lineitem"), ["l_suppkey"], "l_linenumber", "l_quantity", "l_partkey")


@query("SELECT page_id, CASE WHEN n<>'' THEN try_cast(n AS bigint) END AS frame FROM (SELECT page_id, regexp_extract(string_split(url,'/')[-1],'(\\d+)',1) AS n FROM pages)")
def frame_number_regex(spark, d):
    return table(spark, d, "pages").select("page_id", names.frame_number(F.col("url")).alias("frame"))


@query(
    "SELECT page_id, coalesce(CASE WHEN regexp_full_match(s,'\\d+') THEN try_cast(s AS bigint) END,0) AS ts FROM (SELECT page_id, regexp_replace(string_split(url,'/')[-1],'^(.+)\\.[^.]*$','\\1') AS s FROM pages)"
)
def stem_timestamp(spark, d):
    return table(spark, d, "pages").select("page_id", names.stem_timestamp(F.col("url")).alias("ts"))


@query("SELECT doc_id, source, k AS index, printf('%06d',k) AS kitti_name FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id)-1 AS k FROM documents)")
def kitti_index_names(spark, d):
    return names.indexed(table(spark, d, "documents").select("doc_id", "source"), ["source"], "doc_id", block=F.floor(F.col("doc_id") / F.lit(1 << 16)))


@query("SELECT event_id, printf('%s: %.2f', event_type, value) AS text FROM events")
def overlay_text(spark, d):
    return table(spark, d, "events").select("event_id", names.overlay(F.col("event_type"), F.col("value")).alias("text"))


@query(
    "WITH a AS (SELECT user_id, count(*) AS n0 FROM events WHERE event_type='click' GROUP BY 1), b AS (SELECT user_id, count(*) AS n1 FROM events WHERE event_type='view' GROUP BY 1) "
    "SELECT user_id, coalesce(n0,0) AS n0, coalesce(n1,0) AS n1 FROM a FULL JOIN b USING (user_id) WHERE coalesce(n0,0)<>coalesce(n1,0)"
)
def equal_count_check(spark, d):
    e = table(spark, d, "events")
    return quality.equal_counts(e.filter("event_type = 'click'"), e.filter("event_type = 'view'"), by=["user_id"])
