"""One file a frame, committed: ``df.write.format("frame-files")`` of rows (path, bytes).

Tasks write to folders of their own below ``_staged-<job>`` of the root. When all
have ended, the driver keeps a manifest of the folders whose tasks Spark counts as
done; of a task that failed, was tried again or ran twice, no other attempt is on it.
Then a second job moves the files of these folders to their names, each one whole in
one step, and may itself be tried again: what has been moved is no longer there. A
job that is given up deletes its folder. So readers never see half a file.

The root is any URI that ``stores`` opens; no executor needs it mounted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from scanloom.sources import stores

MANIFEST = "_manifest.json"


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: its folder, and how many files."""

    folder: str
    files: int


class FrameFilesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.staged = f"{options['path'].rstrip('/')}/_staged-{options['job']}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        folder = f"{self.staged}/{uuid.uuid4().hex}"
        store, at = stores.opened(folder)
        made, files = set(), 0
        for batch in iterator:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("bytes")):
                name = f"{at}/{path}"
                parent = name.rsplit("/", 1)[0]
                if parent not in made:
                    store.create_dir(parent, recursive=True)
                    made.add(parent)
                with store.open_output_stream(name) as f:
                    f.write(data.as_buffer())
                files += 1
        return Written(folder, files)

    def commit(self, messages: list[Written | None]) -> None:
        store, at = stores.opened(self.staged)
        store.create_dir(at, recursive=True)
        kept = [[m.folder.rsplit("/", 1)[1], m.files] for m in messages if m is not None and m.files]
        with store.open_output_stream(f"{at}/{MANIFEST}") as f:
            f.write(json.dumps(kept).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, at = stores.opened(self.staged)
        if store.get_file_info(at).type != fs.FileType.NotFound:
            store.delete_dir(at)


class FrameFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "frame-files"

    def writer(self, schema, overwrite: bool) -> FrameFilesWriter:
        return FrameFilesWriter(dict(self.options))


def moved(store: fs.FileSystem, source: str, target: str, made: set[str]) -> None:
    """One file to its name; one of that name goes."""
    parent = target.rsplit("/", 1)[0]
    if parent not in made:
        store.create_dir(parent, recursive=True)
        made.add(parent)
    if not isinstance(store, fs.LocalFileSystem) and store.get_file_info(target).type == fs.FileType.File:
        store.delete_file(target)  # other stores don't move onto a file
    store.move(source, target)


def publish(spark: SparkSession, root: str, job: str) -> int:
    """Move the files of a job's manifest to their names, and delete its folder; the number of files of the job."""
    root = root.rstrip("/")
    store, at = stores.opened(f"{root}/_staged-{job}")
    with store.open_input_stream(f"{at}/{MANIFEST}") as f:
        folders = json.loads(f.read())

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = 0
            for name in batch.column("folder").to_pylist():
                own, base = stores.opened(f"{root}/_staged-{job}/{name}")
                top, made = stores.opened(root)[1], set()
                for info in own.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True)):
                    if info.type == fs.FileType.File:
                        moved(own, info.path, f"{top}/{info.path[len(base) + 1 :]}", made)
                        n += 1
            yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    if folders:  # a row a task of the first job
        tasks = spark.createDataFrame([(name,) for name, _ in folders], "folder string").repartition(min(len(folders), 1000), "folder")
        tasks.mapInArrow(move, "n long").agg(F.sum("n")).first()
    store.delete_dir(at)
    return sum(n for _, n in folders)


def write(rows: DataFrame, root: str) -> int:
    """Write each (path, bytes) below ``root``, all or none; the number of files."""
    spark = rows.sparkSession
    spark.dataSource.register(FrameFiles)
    job = uuid.uuid4().hex
    rows.select("path", "bytes").write.format("frame-files").mode("append").option("job", job).save(root)
    return publish(spark, root, job)
