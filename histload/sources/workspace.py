"""Where jobs keep what they write between steps."""

from __future__ import annotations

import json
import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``.

    A local session without that setting, which has no other machines, gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="histload-")


def work_folder(spark: SparkSession) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/histload-{uuid4().hex}"


def _located(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder on any filesystem; whether there was one."""
    files, where = _located(spark, path)
    return files.delete(where, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder; none if it is not there."""
    files, where = _located(spark, path)
    if not files.exists(where):
        return []
    return [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()]


def names(spark: SparkSession, path: str) -> list[str]:
    """The names of the files in a folder, in order; none if it is not there."""
    files, where = _located(spark, path)
    if not files.exists(where):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(where) if s.isFile())


def write_record(spark: SparkSession, path: str, record: dict) -> None:
    """A small JSON file, there as a whole or not at all: written beside its place, then renamed. One that is there
    already is replaced."""
    files, where = _located(spark, path)
    beside = where.suffix(f".{uuid4().hex}.tmp")
    out = files.create(beside, True)
    try:
        out.write(bytearray(json.dumps(record).encode()))
    finally:
        out.close()
    files.delete(where, False)
    if not files.rename(beside, where):
        raise OSError(f"{beside} cannot be renamed to {path}")


def read_record(spark: SparkSession, path: str) -> dict | None:
    files, where = _located(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
