"""A connector for tables that are a list of files: a Python data source, registered with ``register``.

Each task writes one Arrow file and reports its name and rows; the commit writes the next manifest, which names the files of
all tasks, so that a table changes at once or not at all. A write that fails deletes the files it has made, and readers
see the manifest before. Paths are those of any file system that pyarrow knows and all executors reach.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "manifest_table"


def _place(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


def _manifests(path: str) -> list[str]:
    from pyarrow.fs import FileSelector

    files, root = _place(path)
    found = files.get_file_info(FileSelector(root, allow_not_found=True))
    return sorted(i.path for i in found if i.base_name.startswith("manifest-") and i.base_name.endswith(".json"))


def current(path: str) -> dict | None:
    """The last manifest: schema, files and their rows; None if there is no table."""
    found = _manifests(path)
    if not found:
        return None
    files, _ = _place(path)
    with files.open_input_stream(found[-1]) as stream:
        return json.loads(stream.read())


@dataclass
class Wrote(WriterCommitMessage):
    name: str | None
    n_rows: int


@dataclass
class File(InputPartition):
    name: str


class ManifestWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema.json(), overwrite
        self.before, self.prefix = current(path), f"part-{uuid4().hex}-"
        if self.before and not overwrite and json.loads(self.before["schema"]) != json.loads(self.schema):
            raise ValueError(f"{path} has other columns: {self.before['schema']}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Wrote:
        name, writer, n = f"{self.prefix}{uuid4().hex}.arrow", None, 0
        files, root = _place(self.path)
        files.create_dir(root, recursive=True)
        try:
            for batch in iterator:
                if writer is None:
                    stream = files.open_output_stream(f"{root}/{name}")
                    writer = pa.ipc.new_stream(stream, batch.schema)
                writer.write_batch(batch)
                n += batch.num_rows
        except BaseException:
            if writer is not None:
                stream.close()
                files.delete_file(f"{root}/{name}")
            raise
        if writer is None:
            return Wrote(None, 0)
        writer.close()
        stream.close()
        return Wrote(name, n)

    def commit(self, messages: list[Wrote | None]) -> None:
        files, root = _place(self.path)
        files.create_dir(root, recursive=True)
        kept = self.before["files"] if self.before and not self.overwrite else []
        wrote = [[m.name, m.n_rows] for m in messages if m is not None and m.name]
        manifest = {"schema": self.schema, "files": kept + wrote}
        beside = f"{root}/.{uuid4().hex}.tmp"
        with files.open_output_stream(beside) as stream:
            stream.write(json.dumps(manifest).encode())
        number = len(_manifests(self.path))
        files.move(beside, f"{root}/manifest-{number:08d}.json")
        self._delete_but({m[0] for m in wrote})  # of tasks that ran twice

    def abort(self, messages: list[Wrote | None]) -> None:
        """Tasks that were stopped have no message; their files are told by the name that all of a write's files share."""
        self._delete_but(set())

    def _delete_but(self, kept: set[str]) -> None:
        from pyarrow.fs import FileSelector

        files, root = _place(self.path)
        for found in files.get_file_info(FileSelector(root, allow_not_found=True)):
            if found.base_name.startswith(self.prefix) and found.base_name not in kept:
                files.delete_file(found.path)


class ManifestReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[File]:
        return [File(name) for name, _ in current(self.path)["files"]]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, File):  # a table without files has one partition without a name
            return
        files, root = _place(self.path)
        with files.open_input_stream(f"{root}/{partition.name}") as stream:
            yield from pa.ipc.open_stream(stream)


class ManifestTable(DataSource):
    """``path`` is the folder. Modes append and overwrite; old files stay for readers of the manifest before."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        found = current(self.options["path"])
        if found is None:
            raise ValueError(f"there is no table in {self.options['path']}")
        return StructType.fromJson(json.loads(found["schema"]))

    def reader(self, schema: StructType) -> ManifestReader:
        return ManifestReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> ManifestWriter:
        return ManifestWriter(self.options["path"], schema, overwrite)


def register(spark: SparkSession) -> str:
    """Makes the format known to the session; returns its name, for a ``Sink``."""
    spark.dataSource.register(ManifestTable)
    return NAME
