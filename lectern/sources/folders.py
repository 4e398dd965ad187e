"""Folders listed, and files read and written, by tasks.

Spark's own scans leave out names that begin with ``_`` or ``.`` and files of no bytes, and its text
writer makes no file for an empty text. Here tasks use pyarrow's file systems (local, HDFS, object
stores); a path without a scheme is local and has to be shared by all executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from lectern.session import write_and_read

FORMAT = "lectern_files"
_ENTRY = "rel_path STRING, folder BOOLEAN, bytes BIGINT, modified TIMESTAMP"


def opened(root: str) -> tuple[fs.FileSystem, str]:
    plain = root.removeprefix("file://").removeprefix("file:") if root.startswith("file:") else root
    system, path = fs.FileSystem.from_uri(plain)
    return system, path.rstrip("/")


def walk(spark: SparkSession, root: str, *, tasks: int | None = None) -> DataFrame:
    """(rel_path, bytes, modified) of every file under ``root``, hidden and empty ones too.

    The folders of one depth are a table, and tasks list them; what they find is the table of the next
    depth. The driver sees only whether there is one. A root that does not exist raises.
    """
    width = tasks or spark.sparkContext.defaultParallelism

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(root)
        for batch in batches:
            for folder in batch.column("rel_path").to_pylist():
                found = system.get_file_info(fs.FileSelector(f"{base}/{folder}" if folder else base))
                yield pa.record_batch({
                    "rel_path": pa.array([f.path[len(base) + 1:] for f in found], pa.string()),
                    "folder": pa.array([f.type == fs.FileType.Directory for f in found], pa.bool_()),
                    "bytes": pa.array([f.size for f in found], pa.int64()),
                    "modified": pa.array([None if f.mtime_ns is None else f.mtime_ns // 1_000_000 * 1000 for f in found], pa.timestamp("us", "UTC")),
                })

    frontier, found = spark.createDataFrame([("",)], "rel_path STRING"), None
    while found is None or not frontier.isEmpty():
        level = write_and_read(frontier.repartition(width, "rel_path").mapInArrow(listed, _ENTRY), "listing")
        frontier = level.filter("folder").select("rel_path")
        files = level.filter("NOT folder").drop("folder")
        found = files if found is None else found.unionByName(files)
    return found


def full_path(root: str, rel_path: Column) -> Column:
    scheme = "" if "://" in root else "file:"
    return F.concat(F.lit(scheme + root.removeprefix("file://").removeprefix("file:").rstrip("/") + "/"), rel_path)


def contents(files: DataFrame, root: str) -> DataFrame:
    """``files`` (rel_path and other columns) with the ``content`` of each, read by tasks."""
    schema = ", ".join(f"`{k}` {t}" for k, t in files.dtypes) + ", content BINARY"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(root)
        for batch in batches:
            for i in range(batch.num_rows):  # one file at a time in memory
                row = batch.slice(i, 1)
                with system.open_input_stream(f"{base}/{row.column('rel_path')[0].as_py()}", compression=None) as stream:
                    yield row.append_column("content", pa.array([stream.read()], pa.binary()))

    return files.mapInArrow(read, schema)


@dataclass
class Written(WriterCommitMessage):
    files: int
    bytes: int
    paths: list[str]


class FileSink(DataSource):
    """Rows (path, content) in order of path -> one file per path, the contents of its rows one after the other."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return FileWriter(self.options["path"])


class FileWriter(DataSourceWriter):
    """A task writes each file under a name of its own beside the place and moves it there when it is whole, so a
    task that is run again leaves the same files. The job is done when its messages are in: the driver notes
    counts in ``_SUCCESS``, and makes no file of the output itself. A job that fails takes its files away."""

    def __init__(self, root: str):
        self.root = root

    def write(self, iterator) -> Written:
        system, base = opened(self.root)
        done, size, held, stream, part = [], 0, None, None, None
        folders = set()

        def close() -> None:
            if stream is not None:
                stream.close()
                system.move(part, f"{base}/{held}")
                done.append(held)

        try:
            for row in iterator:
                if row["path"] != held or stream is None:
                    close()
                    held, stream = row["path"], None
                    folder, _, name = f"{base}/{held}".rpartition("/")
                    if folder not in folders:
                        system.create_dir(folder, recursive=True)
                        folders.add(folder)
                    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
                    stream = system.open_output_stream(part, compression=None)
                data = (row["content"] or "").encode()
                stream.write(data)
                size += len(data)
            close()
        except BaseException:
            if stream is not None and not stream.closed:
                stream.close()
                system.delete_file(part)
            raise
        return Written(len(done), size, done)

    def commit(self, messages) -> None:
        system, base = opened(self.root)
        system.create_dir(base, recursive=True)
        told = [m for m in messages if m is not None]
        with system.open_output_stream(f"{base}/_SUCCESS") as out:
            out.write(f"{sum(m.files for m in told)} files, {sum(m.bytes for m in told)} bytes\n".encode())

    def abort(self, messages) -> None:
        system, base = opened(self.root)
        for message in messages:
            for path in message.paths if message is not None else []:
                system.delete_file(f"{base}/{path}")


def write_files(rows: DataFrame, root: str, *order: str) -> None:
    """Write rows (path, content) as files under ``root``; several rows of one path stand in ``order``."""
    rows.sparkSession.dataSource.register(FileSink)
    sorted_ = rows.repartition("path").sortWithinPartitions("path", *order)
    sorted_.select("path", "content").write.format(FORMAT).mode("append").option("path", root).save()
