"""The connector for tables that are a list of files."""

import itertools
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from histload.config import Sink
from histload.sources import manifest_table, readers, writers

SCHEMA = "id BIGINT, name STRING, at TIMESTAMP_NTZ, xs ARRAY<INT>"


@pytest.fixture(scope="module")
def fmt(spark):
    return manifest_table.register(spark)


def rows(spark, a, b):
    name = F.when(F.col("id") % 3 > 0, F.concat(F.lit("é"), "id"))
    return spark.range(a, b, numPartitions=3).select("id", name.alias("name"), F.lit("2020-01-02 03:04:05").cast("timestamp_ntz").alias("at"), F.array(F.col("id").cast("int")).alias("xs"))


def content(df):
    return Counter(map(str, df.collect()))


def test_overwrite_append_and_read(spark, tmp_path, fmt):
    sink = Sink(str(tmp_path / "t"), fmt)
    assert writers.write_sink(rows(spark, 0, 10), sink) == {"rows": 10}
    assert content(readers.read_table(spark, sink.path, fmt)) == content(rows(spark, 0, 10))
    rows(spark, 10, 12).write.format(fmt).mode("append").save(sink.path)
    found = readers.read_table(spark, sink.path, fmt)
    assert content(found) == content(rows(spark, 0, 12)) and found.dtypes == rows(spark, 0, 1).dtypes
    writers.write_sink(rows(spark, 5, 6), sink)
    assert content(readers.read_table(spark, sink.path, fmt)) == content(rows(spark, 5, 6))
    assert manifest_table.current(sink.path)["files"][0][1] == 1
    writers.write_sink(rows(spark, 0, 0), sink)
    assert readers.read_table(spark, sink.path, fmt).isEmpty()


def test_a_write_that_fails_leaves_the_old_table(spark, tmp_path, fmt):
    sink = Sink(str(tmp_path / "t"), fmt)
    writers.write_sink(rows(spark, 0, 10), sink)
    broken = rows(spark, 0, 30).withColumn("name", F.when(F.col("id") < 29, F.col("name")).otherwise(F.raise_error("lost").cast("string")))
    with pytest.raises(Exception, match="lost"):
        writers.write_sink(broken, sink)
    assert content(readers.read_table(spark, sink.path, fmt)) == content(rows(spark, 0, 10))


def test_files_of_tasks_without_a_message_are_deleted(tmp_path):
    schema = StructType().add("id", LongType())
    batches = lambda: iter([pa.RecordBatch.from_pydict({"id": [1, 2]})])
    first, second = (manifest_table.ManifestWriter(str(tmp_path / "t"), schema, True) for _ in range(2))
    first.commit([first.write(batches())])
    told, _ = second.write(batches()), second.write(batches())
    second.abort([told, None])
    assert len(list((tmp_path / "t").iterdir())) == 2 and manifest_table.current(str(tmp_path / "t"))["files"][0][1] == 2
    again = manifest_table.ManifestWriter(str(tmp_path / "t"), schema, False)
    again.write(batches())  # an attempt that was lost after it had written
    again.commit([again.write(batches()), None])
    assert len(list((tmp_path / "t").glob("*.arrow"))) == 2 == len(manifest_table.current(str(tmp_path / "t"))["files"])
    with pytest.raises(RuntimeError):
        again.write(itertools.chain(batches(), _lost()))
    assert len(list((tmp_path / "t").glob("*.arrow"))) == 2


def _lost():
    raise RuntimeError("lost")
    yield


def test_other_columns_and_absent_tables_are_refused(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="no table"):
        readers.read_table(spark, path, fmt).collect()
    writers.write_sink(rows(spark, 0, 3), Sink(path, fmt))
    with pytest.raises(Exception, match="other columns"):
        spark.range(3).write.format(fmt).mode("append").save(path)
    assert readers.read_table(spark, path, fmt).count() == 3
