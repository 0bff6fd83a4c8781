"""Readers of sensor files as DataFrames.

Files come through Spark's ``binaryFile`` and ``text`` readers, so any store that
Spark reads will do, a file is one row and files are dealt over tasks. A file
that can't be read gives one row with ``error`` set, and the run goes on; files
are at most 2 GB, as a row is. Columns are declared, never inferred.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanloom import schemas
from scanloom.functions import names
from scanloom.sources import decode

#: Rows of one Arrow batch made from files or messages; small ones share a batch of so many rows and bytes at most.
ROWS, BYTES = 1 << 16, 8 << 20

_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "float": pa.float32(), "double": pa.float64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64())}


def listing(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Paths and sizes of files below ``path``; their contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", names.stem(F.col("path")).alias("stem"))


def contents(spark: SparkSession, path: str | DataFrame, pattern: str) -> DataFrame:
    """(path, content) of the files below a folder, or of those kept as rows, whose names match."""
    if isinstance(path, DataFrame):
        named = "[^/]*".join(re.escape(part) for part in pattern.split("*"))
        return path.filter(F.col("path").rlike(f"(?s)^(?:.*/)?{named}$")).select("path", "content")
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content")


def decoded(batch: pa.RecordBatch, column: str, kept: Sequence[str], arrow: pa.Schema, read: Callable[[bytes], Iterator[dict]]) -> Iterator[pa.RecordBatch]:
    """Rows that ``read`` makes of each value of ``column`` as dictionaries of columns, with ``kept`` of its row, and error.

    What is made of small values shares batches, in the order of the rows.
    """
    made = [f for f in arrow if f.name not in (*kept, "error")]
    kinds = [np.dtype(f.type.to_pandas_dtype()) if pa.types.is_primitive(f.type) else None for f in made]

    def rows(k: Sequence[int], columns: list[pa.Array], error: str | None = None) -> pa.RecordBatch:
        whole = {c: batch.column(c).take(pa.array(k, pa.int64())).cast(arrow.field(c).type) for c in kept}
        whole |= dict(zip((f.name for f in made), columns)) | {"error": pa.array([error] * len(k), pa.string())}
        return pa.RecordBatch.from_arrays([whole[f.name] for f in arrow], schema=arrow)

    def together(parts: list[tuple[int, list]]) -> pa.RecordBatch:
        whole = lambda f, c: pa.array(np.concatenate(c)) if all(isinstance(v, np.ndarray) for v in c) else pa.concat_arrays([pa.array(v, f.type) if isinstance(v, np.ndarray) else v for v in c])
        joined = [whole(f, c) for f, c in zip(made, zip(*(p for _, p in parts)))]
        return rows(np.repeat([k for k, _ in parts], [len(p[0]) for _, p in parts]), joined)

    parts: list[tuple[int, list]] = []
    n = size = 0
    for k, data in enumerate(batch.column(column)):
        try:
            for columns in read(data.as_py()):
                # Numbers stay in numpy until their batch is full, as an Arrow array costs more than a small file's decoding.
                part = [v if isinstance(v, np.ndarray) and v.dtype == t else pa.array(v, f.type) for f, t, v in zip(made, kinds, (columns[f.name] for f in made))]
                if len({len(c) for c in part}) > 1:
                    raise ValueError("columns of different lengths")
                bytes_ = sum(c.nbytes for c in part)
                if parts and (n + len(part[0]) > ROWS or size + bytes_ > BYTES):
                    yield together(parts)
                    parts, n, size = [], 0, 0
                parts.append((k, part))
                n, size = n + len(part[0]), size + bytes_
        except Exception as e:  # noqa: BLE001  the row says so
            if parts:
                yield together(parts)
                parts, n, size = [], 0, 0
            yield rows([k], [pa.nulls(1, f.type) for f in made], f"{type(e).__name__}: {e}")
    if parts:
        yield together(parts)


def each_file(spark: SparkSession, path: str | DataFrame, pattern: str, schema: str, read: Callable[[bytes], Iterator[dict]]) -> DataFrame:
    """Rows that ``read`` makes of each file's bytes as dictionaries of columns, with path and error."""
    fields = [x.strip().split(" ") for x in ("path string, " + schema + ", error string").split(", ")]
    arrow = pa.schema([(n, _ARROW[t]) for n, t in fields])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from decoded(batch, "content", ["path"], arrow, read)

    return contents(spark, path, pattern).mapInArrow(rows, ", ".join(f"`{n}` {t}" for n, t in fields))


def _cloud_rows(points: np.ndarray) -> Iterator[dict]:
    for at in range(0, len(points), ROWS):
        part = points[at : at + ROWS]
        yield {"point_idx": np.arange(at, at + len(part))} | {c: part[:, k].astype(np.float32) for k, c in enumerate(("x", "y", "z", "intensity"))}


CLOUD = "point_idx bigint, x float, y float, z float, intensity float"


def clouds(spark: SparkSession, path: str | DataFrame, kind: str = "bin") -> DataFrame:
    """Points of ``.bin`` or ``.pcd`` files: (path, point_idx, x, y, z, intensity, error)."""
    read = {"bin": decode.cloud_bin, "pcd": decode.cloud_pcd}[kind]
    return each_file(spark, path, f"*.{kind}", CLOUD, lambda data: _cloud_rows(read(data)))


def labels(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    def read(data: bytes) -> Iterator[dict]:
        words = decode.label_words(data)
        for at in range(0, len(words), ROWS):
            yield {"point_idx": np.arange(at, min(at + ROWS, len(words))), "label": words[at : at + ROWS]}

    return each_file(spark, path, "*.label", "point_idx bigint, label bigint", read)


def intrinsics(spark: SparkSession, path: str | DataFrame, strict: bool = False) -> DataFrame:
    def read(data: bytes) -> Iterator[dict]:
        v = decode.intrinsics(data, strict)
        yield {k: [x] for k, x in v.items()}

    rows = each_file(spark, path, "*.npz", "K array<double>, D array<double>, height int, width int", read)
    k = F.col("K")
    return rows.select("*", k[0].alias("fx"), k[4].alias("fy"), k[2].alias("cx"), k[5].alias("cy"))


def rasters(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    """Pixels of ``.npy`` files: (path, r, c, v, error)."""
    def read(data: bytes) -> Iterator[dict]:
        a = decode.array(data)
        wide = a.shape[1]
        flat = a.ravel()
        for at in range(0, len(flat), ROWS):
            k = np.arange(at, min(at + ROWS, len(flat)))
            yield {"r": k // wide, "c": k % wide, "v": flat[k].astype(np.float64)}

    return each_file(spark, path, "*.npy", "r bigint, c bigint, v double", read)


def boxes(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    """Boxes of annotation files, with ordered activities; a file that can't be read is a row with ``error``."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                try:
                    found = [{"path": name, **b} for b in decode.box_frames(data.as_py())]
                except Exception as e:  # noqa: BLE001  the row says so
                    found = [{"path": name, "error": f"{type(e).__name__}: {e}"}]
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=arrow)

    pair = pa.list_(pa.struct([("key", pa.string()), ("value", pa.float64())]))
    arrow = pa.schema([("path", pa.string()), ("frame", pa.string()), ("box_id", pa.int32()), *((x, pa.float64()) for x in ("cx", "cy", "cz", "l", "w", "h", "rot_z")), ("actions", pair), ("social", pair), ("error", pa.string())])
    schema = f"path string, frame string, box_id int, cx double, cy double, cz double, l double, w double, h double, rot_z double, actions {schemas.ACTIVITIES}, social {schemas.ACTIVITIES}, error string"
    return contents(spark, path, "*.json").mapInArrow(rows, schema)


def sync_map(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """A sync map: one JSON list, or with ``lines`` an object a line, as ``writers.write_json`` writes it."""
    return spark.read.schema(schemas.SYNC_MAP).option("multiLine", not lines).json(path)


def annotations(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return spark.read.schema(schemas.ANNOTATIONS).option("multiLine", not lines).json(path)


def _lines(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    """(path, line, value) of text files, lines numbered from 0 and blank ones left out."""
    if isinstance(path, DataFrame):
        files = path.select("path", F.decode("content", "UTF-8").alias("value"))
    else:
        files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    files = files.select("path", F.split("value", r"\r?\n").alias("lines"))
    lines = files.select("path", F.posexplode(F.filter("lines", lambda x: F.trim(x) != "")).alias("line", "value"))
    return lines.withColumn("parts", F.split(F.trim("value"), r"\s+"))


def times(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    return _lines(spark, path).select("path", "line", F.col("parts")[0].try_cast("double").alias("time"))


def poses(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    """Pose structs of files with a time and seven numbers a line; other widths are an error."""
    p = F.transform("parts", lambda x: x.try_cast("double"))
    rows = _lines(spark, path).withColumn("p", p)
    pose = F.struct(*(F.col("p")[k + 1].alias(n) for k, n in enumerate(("tx", "ty", "tz", "qx", "qy", "qz", "qw"))))
    wrong = F.when(F.size("p") != 8, F.concat(F.lit("columns: "), F.size("p").cast("string")))
    return rows.select("path", "line", F.when(wrong.isNull(), pose).alias("pose"), wrong.alias("error"))


def calibration(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    """(path, name, m) of ``calib.txt`` lines, twelve numbers each."""
    rows = _lines(spark, path)
    return rows.select("path", F.regexp_replace(F.col("parts")[0], ":$", "").alias("name"), F.transform(F.slice("parts", 2, 12), lambda x: x.try_cast("double")).alias("m"))


#: The size of a camera that doesn't give its own.
CAMERA_WIDTH, CAMERA_HEIGHT = 752, 480


def _numbers(value) -> list[float]:
    if isinstance(value, str):
        value = value.replace("[", " ").replace("]", " ").replace(",", " ").replace(";", " ").split()
    return [float(x) for x in np.array(value, float).ravel()]


def cameras(spark: SparkSession, path: str | DataFrame, pattern: str = "*.y*ml") -> DataFrame:
    """Cameras of YAML files: (path, sensor_id, position, K, D, R, T, width, height, error), defaults filled in.

    Every file is read, by the task that holds it. A sensor whose matrices can't
    be read is left out, and a file that can't be is a row with ``error``.
    """
    def read(data: bytes) -> Iterator[dict]:
        import yaml

        rows = []
        for k, (name, c) in enumerate((yaml.safe_load(data).get("cameras") or {}).items()):
            if name.startswith("sensor_"):
                try:
                    rows.append((name, k, _numbers(c["K"]), _numbers(c.get("D", [0.0] * 5)), _numbers(c["R"]), _numbers(c["T"]), int(c.get("width", CAMERA_WIDTH)), int(c.get("height", CAMERA_HEIGHT))))
                except (KeyError, TypeError, ValueError):
                    continue
        if rows:
            yield dict(zip(("sensor_id", "position", "K", "D", "R", "T", "width", "height"), zip(*rows)))

    return each_file(spark, path, pattern, "sensor_id string, position int, K array<double>, D array<double>, R array<double>, T array<double>, width int, height int", read)


def flattened(value, key: str = "") -> Iterator[tuple[str, str | None]]:
    """(key, value) of all leaves of nested maps and lists, keys joined by a slash; an empty one is a leaf without a value."""
    inner = value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ()
    if not inner:
        yield key, None if value is None or isinstance(value, (dict, list)) else str(value).lower() if isinstance(value, bool) else str(value)
    for k, v in inner:
        yield from flattened(v, f"{key}/{k}" if key else str(k))


def settings(spark: SparkSession, path: str | DataFrame, pattern: str = "*.y*ml") -> DataFrame:
    """(path, key, value, error) of configuration and taxonomy files in YAML, a row a leaf: ``learning_map/252`` is ``20``."""
    def read(data: bytes) -> Iterator[dict]:
        import yaml

        leaves = list(flattened(yaml.safe_load(data)))
        yield {"key": [k for k, _ in leaves], "value": [v for _, v in leaves]}

    return each_file(spark, path, pattern, "key string, value string", read)


def mapping(settings: DataFrame, name: str) -> DataFrame:
    """(path, from, to) of the numbers of one map in ``settings``, such as ``learning_map``."""
    parts = F.split("key", "/")
    rows = settings.filter(F.startswith("key", F.lit(f"{name}/")) & (F.size(parts) == 2))
    return rows.select("path", parts[1].try_cast("bigint").alias("from"), F.col("value").try_cast("bigint").alias("to")).filter("from IS NOT NULL")


def messages(spark: SparkSession, path: str | DataFrame, kind: str = "db3", topics: tuple[str, ...] | None = None) -> DataFrame:
    """Messages of recordings, ``db3`` or ``bag``: (path, topic, msg_type, ts_ns, data, error).

    Only messages of ``topics`` leave the file; copies named ``*.orig.bag`` are skipped.
    """
    def from_sqlite(data: bytes) -> Iterator[tuple]:
        names_ = {i: (n, t) for i, n, t in decode.sqlite_rows(data, "SELECT id, name, type FROM topics")}
        own = [i for i, (n, _) in names_.items() if topics is None or n in topics]
        ask = f"SELECT topic_id, timestamp, data FROM messages WHERE topic_id IN ({', '.join(map(str, own)) or 'NULL'}) ORDER BY timestamp"
        yield from ((*names_[i], ts, body) for i, ts, body in decode.sqlite_rows(data, ask))

    def read(data: bytes) -> Iterator[dict]:
        found = from_sqlite(data) if kind == "db3" else (m for m in decode.bag_messages(data) if topics is None or m[0] in topics)
        part: list[tuple] = []
        size = 0
        for m in found:
            part.append(m)
            size += len(m[3])
            if size > 8 << 20:
                yield dict(zip(("topic", "msg_type", "ts_ns", "data"), zip(*part)))
                part, size = [], 0
        if part:
            yield dict(zip(("topic", "msg_type", "ts_ns", "data"), zip(*part)))

    rows = each_file(spark, path, f"*.{kind}", "topic string, msg_type string, ts_ns bigint, data binary", read)
    return rows.filter(~F.endswith("path", F.lit(".orig.bag")))


def topics(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    """(path, id, name, type) of the topics of ``db3`` recordings."""
    def read(data: bytes) -> Iterator[dict]:
        rows = list(decode.sqlite_rows(data, "SELECT id, name, type FROM topics"))
        if rows:
            yield dict(zip(("id", "name", "type"), zip(*rows)))

    return each_file(spark, path, "*.db3", "id bigint, name string, type string", read)


def _each_message(rows: DataFrame, schema: str, read: Callable[[bytes], Iterator[dict]]) -> DataFrame:
    fields = [x.split(" ") for x in f"path string, topic string, ts_ns bigint, {schema}, error string".split(", ")]
    arrow = pa.schema([(n, _ARROW[t]) for n, t in fields])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from decoded(batch, "data", ["path", "topic", "ts_ns"], arrow, read)

    return rows.select("path", "topic", "ts_ns", "data").mapInArrow(made, ", ".join(f"`{n}` {t}" for n, t in fields))


def message_points(rows: DataFrame, version: int = 2) -> DataFrame:
    """Points of cloud messages; decode after alignment, so that only matched messages are."""
    def read(data: bytes) -> Iterator[dict]:
        p = decode.points_of(data, version)
        for at in range(0, len(p), ROWS):
            part = p[at : at + ROWS]
            yield {"point_idx": np.arange(at, at + len(part))} | {c: part[:, k] for k, c in enumerate("xyz")}

    return _each_message(rows, "point_idx bigint, x float, y float, z float", read)


def message_images(rows: DataFrame, version: int = 2) -> DataFrame:
    """Raw images as blue, green, red bytes: (…, height, width, pixels)."""
    def read(data: bytes) -> Iterator[dict]:
        a = decode.image_of(data, version)
        yield {"height": [a.shape[0]], "width": [a.shape[1]], "pixels": [np.ascontiguousarray(a).tobytes()]}

    return _each_message(rows, "height int, width int, pixels binary", read)


def message_files(rows: DataFrame, version: int = 2) -> DataFrame:
    """The compressed files inside image messages; ``pictures`` decodes PNG and sequential JPEG, ``with_model`` takes a codec for others."""
    return _each_message(rows, "file binary", lambda data: iter([{"file": [decode.compressed_of(data, version)]}]))


def message_cameras(rows: DataFrame, version: int = 2) -> DataFrame:
    def read(data: bytes) -> Iterator[dict]:
        yield {k: [v] for k, v in decode.camera_info_of(data, version).items()}

    return _each_message(rows, "K array<double>, D array<double>, height int, width int", read)


def with_model(rows: DataFrame, column: str, name: str, schema: str, load: Callable[[], Callable], arrow: pa.DataType) -> DataFrame:
    """Add ``name``: what a model or codec makes of ``column``. ``load`` runs once a task and gives the function."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load()
        for batch in batches:
            yield batch.append_column(name, pa.array([None if x is None else model(x) for x in batch.column(column).to_pylist()], arrow))

    return rows.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), f"`{name}` {schema}"]))


def infer(
    rows: DataFrame, columns: Sequence[str], name: str, schema: str, arrow: pa.DataType, load: Callable[[object], Callable], weights=None, batch: int = 32,
    size: str | None = None, padded: int = 1 << 24, profile=None,
) -> DataFrame:
    """Add ``name``, what a model makes of ``columns``, and ``<name>_error``; the model gets batches.

    ``load(weights)`` runs once a task, ``weights`` being what a broadcast
    variable holds, sent to each executor once. The model takes a dictionary of
    columns with ``batch`` rows at most: lists of numbers as one array, filled
    up with zeros to the longest, with their lengths under ``<column>_length``;
    other columns as lists. ``size`` names a column of sizes: rows of like sizes
    then go together, and no batch has more than ``padded`` numbers in a column.
    It gives as many results as rows. Where it fails on a batch, its rows are
    tried one by one, and those that fail again have ``error`` set. Rows with a
    null in a column have no result. ``profile`` is a resource profile, for
    stages that need GPUs.
    """
    def stacked(part: pa.RecordBatch) -> dict[str, object]:
        out: dict[str, object] = {}
        for c in columns:
            values = part.column(c)
            if pa.types.is_list(values.type):
                lists = [np.asarray(v, np.float64) for v in values.to_pylist()]
                lengths = np.array([len(v) for v in lists], np.int64)
                whole = np.zeros((len(lists), lengths.max(initial=0)))
                for k, v in enumerate(lists):
                    whole[k, : len(v)] = v
                out |= {c: whole, f"{c}_length": lengths}
            else:
                out[c] = values.to_pylist()
        return out

    def groups(whole: pa.RecordBatch) -> Iterator[np.ndarray]:
        good = np.flatnonzero(np.logical_and.reduce([whole.column(c).is_valid().to_numpy(zero_copy_only=False) for c in columns]))
        if size is None:
            yield from (good[k : k + batch] for k in range(0, len(good), batch))
            return
        sizes = whole.column(size).fill_null(0).to_numpy()
        order, at = good[np.argsort(sizes[good], kind="stable")], 0
        while at < len(order):
            end = at + 1
            while end < min(at + batch, len(order)) and int(sizes[order[end]]) * (end - at + 1) <= padded:
                end += 1
            yield order[at:end]
            at = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(weights.value if weights is not None else None)
        for whole in batches:
            results, errors = [None] * whole.num_rows, [None] * whole.num_rows

            def put(own: np.ndarray) -> None:
                found = model(stacked(whole.take(pa.array(own))))
                if len(found) != len(own):
                    raise ValueError(f"{len(found)} results for {len(own)} rows")
                for k, v in zip(own.tolist(), found):
                    results[k] = v

            for own in groups(whole):
                try:
                    put(own)
                except Exception:  # noqa: BLE001  one of its rows, or more
                    for k in own:
                        try:
                            put(np.array([k]))
                        except Exception as e:  # noqa: BLE001  the row says so
                            errors[k] = f"{type(e).__name__}: {e}"
            yield whole.append_column(name, pa.array(results, arrow)).append_column(f"{name}_error", pa.array(errors, pa.string()))

    out = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), f"`{name}` {schema}", f"`{name}_error` string"]
    return rows.mapInArrow(run, ", ".join(out), profile=profile)


def pictures(files: DataFrame) -> DataFrame:
    """Rows (path, file) of PNG and sequential JPEG files with height, width, grey (an array in [0, 1], row by row) and error."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("file")):
                row = {"path": name, "height": None, "width": None, "grey": None, "error": None}
                try:
                    a = decode.grey(decode.picture(data.as_py()))
                    row |= {"height": a.shape[0], "width": a.shape[1], "grey": a.ravel().tolist()}
                except Exception as e:  # noqa: BLE001  the row says so
                    row["error"] = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_pylist([row], schema=arrow)

    arrow = pa.schema([("path", pa.string()), ("height", pa.int32()), ("width", pa.int32()), ("grey", pa.list_(pa.float64())), ("error", pa.string())])
    return files.select("path", "file").mapInArrow(read, "path string, height int, width int, grey array<double>, error string")


#: Extensions of image files, in any case of letters.
IMAGES = (".png", ".jpg", ".jpeg", ".bmp", ".tiff", ".tif")


def image_paths(files: DataFrame) -> DataFrame:
    """The rows of ``files`` whose path names an image."""
    hit = F.lit(False)
    for e in IMAGES:
        hit = hit | F.endswith(F.lower("path"), F.lit(e))
    return files.filter(hit)


def missing_folders(spark: SparkSession, root: str, wanted: tuple[str, ...]) -> list[str]:
    """Which of the wanted folders hold no files."""
    folder = F.element_at(F.split("path", "/"), -2)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    found = {r[0] for r in files.select(folder.alias("f")).filter(F.col("f").isin(*wanted)).distinct().collect()}  # as many as are wanted
    return [w for w in wanted if w not in found]


#: Folders that may hold a recording's point files, where it has none itself, the first ones first.
FOLDERS = ("", "pointclouds", "velodyne", "upper_velodyne", "lower_velodyne")


def point_files(files: DataFrame, root: str = "", by: tuple[str, ...] = ()) -> DataFrame:
    """Point files of a recording's first folder that has any, and there of the first extension.

    ``by`` names columns that tell recordings apart; ``root`` is their common path.
    """
    below = F.regexp_extract(F.substring("path", len(root) + 1, 1 << 20), r"^/?(?:(.*)/)?[^/]*$", 1)
    place = F.array_position(F.array(*(F.lit(f) for f in FOLDERS)), below)
    rank = F.when(place > 0, place * 8 + names.extension_rank(F.col("path")))
    ranked = files.withColumn("rank", rank).filter("rank is not null")
    least = ranked.groupBy(*by).agg(F.min("rank").alias("least"))
    return (ranked.join(least, list(by)) if by else ranked.crossJoin(F.broadcast(least))).filter("rank = least").drop("rank", "least")  # without ``by`` one row


def best_points(files: DataFrame) -> DataFrame:
    """Point files of the extension that comes first: (path, rank)."""
    ranked = files.withColumn("rank", names.extension_rank(F.col("path"))).filter("rank is not null")
    return ranked.join(F.broadcast(ranked.agg(F.min("rank").alias("rank"))), "rank", "left_semi")  # one row
