"""Sinks: snapshots, landing of text extracts, published tables and published histories."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from datetime import datetime
from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from histload.config import MergeConfig, Sink
from histload.functions import all_named, named
from histload.operators.history import check_one_row_per_key
from histload.sources.readers import read_csv_typed, read_parquet
from histload.sources.workspace import folders, names, read_record, remove, write_record


class Written(NamedTuple):
    data: DataFrame
    n_rows: int


#: A partition folder cannot tell empty text from null, so text is partitioned by a copy named like this, and
#: the value itself is in the files.
_COPY = "__folder_{}"


def write_snapshot(
    df: DataFrame,
    path: str | None = None,
    partition_by: Iterable[str] = (),
    sort_by: Iterable[str] = (),
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    measures: Mapping[str, Column] | None = None,
) -> dict[str, object]:
    """Overwrite a table, and return how many ``rows`` were written, with the aggregates in ``measures``.

    Rows are gathered by partition value before the write, so that each value gets few files. Spark
    splits a value that holds much of the table over several tasks again. Partition only by columns
    with few values. Parquet partitioned by text is read back with ``read_snapshot``. Connector settings, such as a
    staging area, go in ``options``.
    """
    partition_by, sort_by = list(partition_by), list(sort_by)
    by = list(partition_by)
    if fmt == "parquet":
        text = [c for c in partition_by if isinstance(df.schema[c].dataType, StringType)]
        df = df.withColumns({_COPY.format(c): F.concat(F.lit("="), named(c)) for c in text})
        by = [_COPY.format(c) if c in text else c for c in partition_by]
    if by:
        df = df.hint("rebalance", *all_named(by))
    if by or sort_by:
        df = df.sortWithinPartitions(*all_named(by + sort_by))
    counted = Observation()
    df = df.observe(counted, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (measures or {}).items()])
    writer = df.write.format(fmt).options(**(options or {})).mode("overwrite")
    if by:
        writer = writer.partitionBy(*by)
    writer.save(path)
    return counted.get


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet that ``write_snapshot`` wrote, empty text and nulls in partition columns included."""
    return read_parquet(spark, path, schema).select(*all_named(schema.names))


def write_sink(df: DataFrame, sink: Sink, **how) -> dict[str, object]:
    return write_snapshot(df, sink.path, sink.partition_by, fmt=sink.fmt, options=sink.options, **how)


def land_csv(
    spark: SparkSession,
    csv_path: str,
    parquet_path: str,
    schema: StructType | str | None = None,
    audit: Iterable[str] = (),
    options: Mapping[str, str] | None = None,
) -> Written:
    """Copy a text extract to parquet, and read it back without its audit columns."""
    extract = read_csv_typed(spark, csv_path, schema, options)
    n_rows = write_snapshot(extract, parquet_path)["rows"]
    return Written(read_parquet(spark, parquet_path, extract.schema).drop(*audit), n_rows)


# ---------------------------------------------------------------- records

# A record says that what it names is whole. It is one small file with a number for a name.


def _record(number: int) -> str:
    return f"{number:010d}.json"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return [int(n.removesuffix(".json")) for n in names(spark, folder) if n.endswith(".json")]


# ---------------------------------------------------------------- published tables

# A table that is replaced as a whole: each load writes folders of its own, and becomes visible with its record.


def publish_table(df: DataFrame, sink: Sink, beside: Mapping[str, DataFrame] | None = None) -> int:
    """Replace a table. Parquet is written next to the old rows, which stay until the new ones are whole, and so are the
    rows ``beside`` it, by name; other formats are overwritten by their connector."""
    if sink.fmt != "parquet":
        return write_sink(df, sink)["rows"]
    spark = df.sparkSession
    marks = f"{sink.path}/published"
    before = _numbers(spark, marks)[-1:]
    number = 1 + max(before, default=0)
    unique = f"{number}-{uuid4().hex}"
    record = {"rows": f"rows-{unique}", "n_rows": write_snapshot(df, f"{sink.path}/rows-{unique}", sink.partition_by, options=sink.options)["rows"]}
    for name, other in (beside or {}).items():
        record[name] = f"{name}-{unique}"
        write_snapshot(other, f"{sink.path}/{name}-{unique}")
    write_record(spark, f"{marks}/{_record(number)}", record)
    kept = {f"-{n}-" for n in [number, *before]}  # the rows before stay for their readers
    for old in folders(spark, sink.path):
        if old.split("-")[0] in record and not any(k in old for k in kept):
            remove(spark, f"{sink.path}/{old}")
    return record["n_rows"]


def read_table_published(spark: SparkSession, path: str, schema: StructType, name: str = "rows") -> DataFrame:
    """The rows of a published table, or those ``name`` beside them."""
    marks = _numbers(spark, f"{path}/published")
    if not marks:
        raise ValueError(f"nothing is published in {path}")
    return read_snapshot(spark, f"{path}/{read_record(spark, f'{path}/published/{_record(marks[-1])}')[name]}", schema)


# ---------------------------------------------------------------- published histories

# A published history lies below its root:
#   loads/version=N/is_open=1/bucket=B    the open versions of a bucket of keys, as of load N
#   loads/version=N/is_open=0/bucket=-1   the versions that load N closed
#   closed/level=L/until=N                closed versions of several loads, joined
#   left_out/, reports/version=N          what load N did not load, and its gates' reports
#   intents/N.json                        all folders of load N are whole
#   published/N.json                      load N is visible; names the folders that are the history as of then
#   done/N.json                           load N's sink is written
# A load reads and writes the buckets that its delta touches. It writes new folders only, so readers of the
# version before are not disturbed, and a load that breaks off leaves nothing they would see. Closed versions are
# joined level by level, so that each is written again once for every JOINED-fold of loads, and folders stay few. One load at a
# time may write.

#: So many folders of closed versions of a level become one of the next.
JOINED = 8


class Mark(NamedTuple):
    """A complete load: the load that last wrote each bucket (-1: it is empty), the folders of closed versions, the greatest
    start of an open version, the columns, what was loaded with which settings, and what its columns looked like."""

    version: int
    n_rows: int
    buckets: list[int]
    closed: list[str]
    greatest_start: datetime | None
    schema: str
    extracts: list[dict] = []
    settings: dict = {}
    profile: dict = {}


def _to_record(mark: Mark) -> dict:
    return mark._asdict() | {"greatest_start": mark.greatest_start and mark.greatest_start.isoformat()}


def _from_record(record: dict | None) -> Mark | None:
    if record is None:
        return None
    start = record["greatest_start"]
    return Mark(**(record | {"greatest_start": start and datetime.fromisoformat(start)}))


def bucket_of(key: Iterable[str], n_buckets: int) -> Column:
    """The bucket of a key, from its text, so that integer types don't matter."""
    return F.pmod(F.xxhash64(*[named(c).cast("string") for c in key]), F.lit(n_buckets)).cast("int")


def buckets_seen(key: Iterable[str], n_buckets: int) -> Column:
    """The buckets of all keys as an aggregate, a bitmap; ``in_bitmap`` reads it."""
    return F.bitmap_construct_agg(bucket_of(key, n_buckets).cast("long"))


def in_bitmap(bits: bytes | None) -> list[int]:
    return [8 * i + j for i, byte in enumerate(bits or b"") for j in range(8) if byte >> j & 1]


def touched_buckets(delta: DataFrame, config: MergeConfig, n_buckets: int) -> list[int]:
    return in_bitmap(delta.agg(buckets_seen(config.key, n_buckets)).first()[0])


def published(spark: SparkSession, root: str, version: int | None = None) -> Mark | None:
    """The last complete load, or the one asked for; None if there is none."""
    if version is None:
        version = max(_numbers(spark, f"{root}/published"), default=-1)
    return _from_record(read_record(spark, f"{root}/published/{_record(version)}"))


def published_version(spark: SparkSession, root: str) -> int | None:
    mark = published(spark, root)
    return mark.version if mark else None


def intended(spark: SparkSession, root: str, version: int) -> Mark | None:
    """The mark of a load whose folders are whole; it may not be visible yet."""
    return _from_record(read_record(spark, f"{root}/intents/{_record(version)}"))


def intend(spark: SparkSession, root: str, mark: Mark) -> None:
    write_record(spark, f"{root}/intents/{_record(mark.version)}", _to_record(mark))


def forget_intent(spark: SparkSession, root: str, version: int) -> None:
    """Before a load's folders are written again."""
    remove(spark, f"{root}/intents/{_record(version)}")


def _mark(spark: SparkSession, root: str, mark: Mark) -> None:
    write_record(spark, f"{root}/published/{_record(mark.version)}", _to_record(mark))


def make_visible(spark: SparkSession, root: str, mark: Mark) -> None:
    _mark(spark, root, mark)


def is_done(spark: SparkSession, root: str, version: int) -> bool:
    return read_record(spark, f"{root}/done/{_record(version)}") is not None


def set_done(spark: SparkSession, root: str, version: int) -> None:
    write_record(spark, f"{root}/done/{_record(version)}", {"version": version})


def write_version(
    changes: DataFrame,
    root: str,
    version: int,
    config: MergeConfig,
    n_buckets: int = 64,
    touched: list[int] | None = None,
    sound: bool = False,
) -> Mark:
    """Write open versions and those closed by this load, check them, and return the mark that makes them visible.

    ``changes`` holds all open versions of the ``touched`` buckets (all buckets without it) and what this load
    closes. One pass writes both; rows are gathered by bucket before it. Unless they are known to be ``sound``, as a merge of
    a settled delta into a sound history is, an error tells keys with two open versions.
    """
    spark, load = changes.sparkSession, f"{root}/loads/version={version}"
    before = published(spark, root)
    if before and (before.version != version - 1 or len(before.buckets) != n_buckets):
        raise ValueError(f"version {version} with {n_buckets} buckets cannot follow {before.version} with {len(before.buckets)}")
    is_open = named(config.end).isNull()
    bucket = F.when(is_open, bucket_of(config.key, n_buckets)).otherwise(-1)
    flagged = changes.withColumns({"is_open": is_open.cast("int"), "bucket": bucket}).hint("rebalance", "is_open", "bucket")
    seen = Observation()
    start = F.max(F.when(F.col("is_open") == 1, named(config.start)))
    flagged.observe(seen, F.count(F.lit(1)).alias("rows"), start.alias("start")).write.mode("overwrite").partitionBy("is_open", "bucket").parquet(load)

    if not sound:
        written = spark.read.schema(_with(changes.schema, "is_open", "bucket")).parquet(load).where("is_open = 1")
        check_one_row_per_key(written, config, "several open versions of a key")
    filled = {int(f.removeprefix("bucket=")) for f in folders(spark, f"{load}/is_open=1")}
    buckets = list(before.buckets) if before else [-1] * n_buckets
    wanted = range(n_buckets) if touched is None else touched
    for b in wanted:
        buckets[b] = version if b in filled else -1
    if not filled <= set(wanted):
        raise ValueError("the changes hold open versions of other buckets than those named")
    closed = list(before.closed) if before else []
    if folders(spark, f"{load}/is_open=0"):
        closed.append(f"loads/version={version}/is_open=0/bucket=-1")
    starts = [s for s in (seen.get["start"], before.greatest_start if before else None) if s]
    return Mark(version, seen.get["rows"], buckets, _joined(spark, root, version, closed, changes.schema), max(starts, default=None), changes.schema.json())


def _level(folder: str) -> int:
    return int(folder.split("/")[1].removeprefix("level=")) if folder.startswith("closed/") else 0


def _joined(spark: SparkSession, root: str, version: int, closed: list[str], schema: StructType) -> list[str]:
    """The folders of closed versions after those of a full level have become one of the next. The old ones stay for readers
    of the loads before, until ``drop_superseded``."""
    level = 0
    while any(_level(f) >= level for f in closed):
        full = [f for f in closed if _level(f) == level]
        if len(full) >= JOINED:
            folder = f"closed/level={level + 1}/until={version}"
            rows = spark.read.schema(schema).parquet(*(f"{root}/{f}" for f in full))
            rows.hint("rebalance").write.mode("overwrite").parquet(f"{root}/{folder}")
            closed = [f for f in closed if f not in full] + [folder]
        level += 1
    return closed


def publish(
    changes: DataFrame,
    root: str,
    version: int,
    config: MergeConfig,
    n_buckets: int = 64,
    touched: list[int] | None = None,
) -> Mark:
    """Write a load with ``write_version`` and make it visible."""
    mark = write_version(changes, root, version, config, n_buckets, touched)
    _mark(changes.sparkSession, root, mark)
    return mark


def _with(schema: StructType, *partitions: str) -> StructType:
    fields = StructType([*schema.fields])
    for p in partitions:
        fields = fields.add(p, IntegerType())
    return fields


def columns_of(mark: Mark) -> StructType:
    return StructType.fromJson(json.loads(mark.schema))


def _of_folders(spark: SparkSession, mark: Mark, paths: list[str]) -> DataFrame:
    """Rows of folders that loads up to the mark's wrote; a column that came later is null."""
    reader = spark.read.schema(columns_of(mark))
    return reader.parquet(*paths) if paths else spark.createDataFrame([], columns_of(mark))


def read_open(spark: SparkSession, root: str, mark: Mark, buckets: Iterable[int] | None = None) -> DataFrame:
    """The open versions as of one load, of some buckets or all; only their folders are opened."""
    wanted = range(len(mark.buckets)) if buckets is None else buckets
    return _of_folders(spark, mark, [f"{root}/loads/version={mark.buckets[b]}/is_open=1/bucket={b}" for b in wanted if mark.buckets[b] >= 0])


def read_published(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The history as of one load, the last without a number: its open versions, and all closed up to it."""
    mark = published(spark, root, version)
    if mark is None:
        raise ValueError(f"no such load is published in {root}: {version}")
    return read_open(spark, root, mark).unionByName(_of_folders(spark, mark, [f"{root}/{f}" for f in mark.closed]))


def drop_superseded(spark: SparkSession, root: str) -> int:
    """Delete what only loads before the last complete one name: open versions, and closed ones that are joined with others
    since; their readers must be done. Returns how many folders went."""
    mark, n = published(spark, root), 0
    if mark is None:
        return 0
    for name in folders(spark, f"{root}/loads"):
        load = int(name.removeprefix("version="))
        if load > mark.version:
            continue
        for bucket in folders(spark, f"{root}/loads/{name}/is_open=1"):
            if mark.buckets[int(bucket.removeprefix("bucket="))] != load:
                n += remove(spark, f"{root}/loads/{name}/is_open=1/{bucket}")
        own = f"loads/{name}/is_open=0"
        if f"{own}/bucket=-1" not in mark.closed and folders(spark, f"{root}/{own}"):
            n += remove(spark, f"{root}/{own}")
    for level in folders(spark, f"{root}/closed"):
        for until in folders(spark, f"{root}/closed/{level}"):
            if f"closed/{level}/{until}" not in mark.closed and int(until.removeprefix("until=")) <= mark.version:
                n += remove(spark, f"{root}/closed/{level}/{until}")
    return n
