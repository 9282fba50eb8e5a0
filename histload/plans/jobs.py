"""Load jobs from a text extract to a published table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from datetime import datetime
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from histload.config import BROADCAST_BYTES, DimensionLoadConfig, DriftConfig, ExtractConfig, HistoryLoadConfig, MergeConfig
from histload.functions import all_named, all_not_null, any_null, load_time, named
from histload.operators.dedup import latest_per_key
from histload.operators.drift import drift_row, profile_aggregates, profile_of
from histload.operators.evolution import SchemaChange, conformed, reconciled
from histload.operators.history import (
    check_one_row_per_key,
    decode_open,
    encode_open,
    merge_changed_only,
    merge_reversion_all,
    stamp_open,
    text_bytes,
)
from histload.operators.quality import check_schema, duplicates_row, gate_counts, gate_report, gate_rows, not_null_all, pass_gates
from histload.sources.readers import csv_header, read_csv_typed, read_parquet, read_table
from histload.sources.workspace import folders, remove, work_folder
from histload.sources.writers import (
    Mark,
    buckets_seen,
    forget_intent,
    in_bitmap,
    intend,
    intended,
    is_done,
    make_visible,
    publish,
    publish_table,
    published,
    read_open,
    read_published,
    read_table_published,
    set_done,
    write_sink,
    write_snapshot,
    write_version,
)


class Loaded(NamedTuple):
    """What a load did. ``table`` is the result; ``reports`` the gates' reports, one row each, of every extract, None without
    gates; ``left_out`` the landed rows that were not loaded, with their ``fate``: "null", a required column is; "copy", an equal
    row is loaded; "superseded", a newer row of the key is, or passed a gate in its place. A load that had been done before gives the same, but
    counts nothing."""

    table: DataFrame
    rows_landed: int = 0
    rows_loaded: int = 0
    reports: DataFrame | None = None
    left_out: DataFrame | None = None


class _Prepared(NamedTuple):
    rows: DataFrame
    rows_landed: int
    rows_loaded: int
    bytes: int
    buckets: list[int]
    digest: dict
    reports: list[tuple]
    left_out: DataFrame
    profile: dict


#: Numbers landed rows, which tells equal ones apart.
_ROW = "__row"


def _internal(merge: MergeConfig) -> MergeConfig:
    """Inside a job an open version ends with null; the configured encoding is for its result."""
    return replace(merge, open_end="null")


# ---------------------------------------------------------------- extracts


def _extract(spark: SparkSession, csv: str, config: ExtractConfig) -> DataFrame:
    """The extract's rows. Its header is held against the schema and the schema gate before they are read."""
    if config.schema is not None:
        declared = StructType.fromDDL(config.schema)
        header = csv_header(spark, csv, config.csv)
        if config.gates:
            types = {f.name: f.dataType.simpleString() for f in declared.fields}
            check_schema({c: types.get(c, "string") for c in header}, config.gates)
        if header != declared.names:
            raise ValueError(f"the extract has the columns {header}, the schema {declared.names}")
    return read_csv_typed(spark, csv, config.schema, config.csv)


def _digest(df: DataFrame) -> dict[str, Column]:
    """What tells the rows of an extract from others, whatever their order, as aggregates: their number and two sums of
    64-bit hashes. A null is hashed as one."""
    columns = [named(c) for c in df.columns]
    nulls = F.array(*[c.isNull() for c in columns])
    sums = {f"sum_{i}": F.sum(F.xxhash64(F.lit(i), nulls, *columns).cast("decimal(38,0)")) for i in range(2)}
    return {"n": F.count(F.lit(1)), **sums}


def _told(seen: dict) -> dict:
    return {"n": seen["n"], "sums": [str(seen["sum_0"]), str(seen["sum_1"])]}


def identity(spark: SparkSession, csv: str, config: ExtractConfig) -> dict:
    """What ``_digest`` says of an extract, from one pass over it."""
    rows = _extract(spark, csv, config)
    aggregates = _digest(rows)
    return _told(rows.agg(*[c.alias(n) for n, c in aggregates.items()]).first().asDict())


def _prepare(spark: SparkSession, csv: str, folder: str, config: ExtractConfig, keep, key: Iterable[str], buckets: MergeConfig | None = None, n_buckets: int = 1, broadcast_bytes: int = BROADCAST_BYTES, drift: DriftConfig | None = None, before: dict | None = None) -> _Prepared:
    """Land, gate and de-duplicate an extract, and write what is left, without its audit columns.

    The gates see all columns; ``keep`` chooses a row for each ``key`` and may order them by the audit columns. What gates, reports,
    the merge and later loads need to know is measured by the two passes that write: landing, and what is kept. An extract
    that is too far from the profile ``before`` goes no further than landing.
    """
    rows = _extract(spark, csv, config)
    gates, digest = config.gates, _digest(rows)
    counts = {f"gate_{n}": c for n, c in gate_counts(rows, gates).items()} if gates else {}
    seen = write_snapshot(rows.withColumn(_ROW, F.monotonically_increasing_id()), f"{folder}/landed", measures=digest | counts | (profile_aggregates(rows, drift.columns) if drift else {}))
    profile = profile_of(seen, drift.columns) if drift else {}
    drifted = [drift_row(spark, before, profile, drift, seen["rows"])] if drift else []
    landed = read_parquet(spark, f"{folder}/landed", rows.withColumn(_ROW, F.lit(0).cast("long")).schema)
    reports, passed, gated = [], landed, Observation()
    if gates:
        reports = gate_rows(rows, gates, seen["gate_n"], seen["gate_n_kept"])
        passed = pass_gates(landed, gates)
        if gates.duplicate_check:
            passed = passed.observe(gated, F.count(F.lit(1)).alias("n"))
    kept = keep(not_null_all(passed, config.required))
    stored = kept.drop(*config.audit)
    content = [c for c in stored.columns if c != _ROW]
    measures = {"bytes": text_bytes(content)}
    if buckets:
        measures["buckets"] = buckets_seen(buckets.key, n_buckets)
    wrote = write_snapshot(stored, f"{folder}/prepared", measures=measures)
    if gates:
        reports.append(duplicates_row(gates, seen["gate_n_kept"], gated.get["n"] if gates.duplicate_check else seen["gate_n_kept"]))
    reports += drifted
    prepared = read_parquet(spark, f"{folder}/prepared", stored.schema)
    null_columns = [*config.required, *(gates.null_columns if gates and gates.null_check else ())]
    small = wrote["bytes"] <= broadcast_bytes
    left_out = _left_out(landed, prepared, null_columns, list(key), content, small) if wrote["rows"] < seen["rows"] else landed.limit(0).withColumn("fate", F.lit(""))
    return _Prepared(prepared.drop(_ROW), seen["rows"], wrote["rows"], wrote["bytes"], in_bitmap(wrote.get("buckets")), _told(seen), reports, left_out.drop(_ROW), profile)


def _left_out(landed: DataFrame, kept: DataFrame, null_columns: list[str], key: list[str], content: list[str], small: bool) -> DataFrame:
    """The landed rows that were not kept, each with its fate.

    The others of a key meet the one that was kept, which is one row, so that Spark can split a hot key; or is broadcast, if
    what was kept is small. Rows with a null in their way do not take part."""
    whole = all_not_null(null_columns)
    known = F.struct(*all_named(content))
    winners = kept.select(F.col(_ROW).alias("__kept"), known.alias("__of"), *[named(c).alias(f"__key_{i}") for i, c in enumerate(key)])
    winners = F.broadcast(winners) if small else winners
    met = reduce(and_, [named(c).eqNullSafe(F.col(f"__key_{i}")) for i, c in enumerate(key)])
    rows = landed.where(whole).join(winners, met, "left").where(~F.col("__kept").eqNullSafe(F.col(_ROW)))
    fate = F.when(known.eqNullSafe(F.col("__of")), "copy").otherwise("superseded")
    rows = rows.withColumn("fate", fate).select(*all_named(landed.columns), "fate")
    return landed.where(~whole).withColumn("fate", F.lit("null")).unionByName(rows)


def _versions(spark: SparkSession, csv: str, folder: str, config: HistoryLoadConfig, as_of: datetime, n_buckets: int = 1, before: dict | None = None) -> _Prepared:
    """An extract as open versions, one per key."""
    merge = _internal(config.merge)
    latest = lambda rows: latest_per_key(rows, merge.key, config.latest_order)
    prepared = _prepare(spark, csv, folder, config.extract, latest, merge.key, merge, n_buckets, merge.broadcast_bytes, config.drift, before)
    return prepared._replace(rows=stamp_open(prepared.rows, replace(merge, as_of=as_of)))


# ---------------------------------------------------------------- history loads

# A load becomes visible in this order: its folders, rows left out and reports are whole; its intent says so; its mark is
# published; its sink is written; it is done. A load that broke off anywhere is finished by its repetition: from its
# intent on without reading the extract's rows into the history again.


def _settings(config: HistoryLoadConfig, *times: datetime) -> dict:
    """What a repeated load must have in common with the one before."""
    merge, extract = config.merge, config.extract
    return {
        "as_of": [t.isoformat() for t in times],
        "mode": config.mode,
        "key": list(merge.key),
        "tracked": list(merge.tracked),
        "null_safe": merge.null_safe,
        "trim": merge.trim,
        "start": merge.start,
        "end": merge.end,
        "latest_order": list(config.latest_order),
        "required": list(extract.required),
        "audit": list(extract.audit),
    }


def _merged(hist: DataFrame, delta: _Prepared, config: HistoryLoadConfig) -> DataFrame:
    operator = merge_reversion_all if config.mode == "reversion_all" else merge_changed_only
    return operator(hist, delta.rows, _internal(config.merge), delta.bytes)


def _evolved(hist: DataFrame, delta: _Prepared, config: HistoryLoadConfig) -> tuple[DataFrame, _Prepared]:
    """History and delta with the columns of both."""
    if hist.schema.simpleString() == delta.rows.schema.simpleString():
        return hist, delta
    if not config.evolve:
        raise SchemaChange(f"the history has {hist.schema.simpleString()}, the extract {delta.rows.schema.simpleString()}")
    absent = {*config.merge.key, *config.merge.tracked} - set(delta.rows.columns)
    if absent:
        raise SchemaChange(f"the extract has no {', '.join(sorted(absent))}")
    schema = reconciled(hist.schema, delta.rows.schema)
    return conformed(hist, schema), delta._replace(rows=conformed(delta.rows, schema))


def _aside(spark: SparkSession, root: str, version: int, name: str) -> DataFrame | None:
    folder = f"version={version}"
    return read_parquet(spark, f"{root}/{name}/{folder}") if folder in folders(spark, f"{root}/{name}") else None


def _finished(spark: SparkSession, root: str, mark: Mark, config: HistoryLoadConfig, loads: Iterable[_Prepared] = ()) -> Loaded:
    """What is left to do once a load's folders are whole: the mark, the sink and the end of the load."""
    last = published(spark, root)
    if last is None or last.version < mark.version:
        make_visible(spark, root, mark)
        last = mark
    table = encode_open(read_published(spark, root, mark.version), config.merge)
    # a sink holds the last version; that of an earlier load, finished late, is not written over it
    if not is_done(spark, root, mark.version):
        if config.sink and last.version == mark.version:
            write_sink(table, config.sink)
        set_done(spark, root, mark.version)
    loads = list(loads)
    return Loaded(table, sum(p.rows_landed for p in loads), sum(p.rows_loaded for p in loads), _aside(spark, root, mark.version, "reports"), _aside(spark, root, mark.version, "left_out"))


def _completed(spark: SparkSession, root: str, mark: Mark, config: HistoryLoadConfig, loads: list[_Prepared], settings: dict) -> Loaded:
    """Rows left out and reports are written, then nothing is missing but what ``_finished`` does."""
    left_out = loads[0].left_out
    for other in loads[1:]:
        left_out = left_out.unionByName(other.left_out, allowMissingColumns=True)
    write_snapshot(left_out, f"{root}/left_out/version={mark.version}")
    reports = [row for p in loads for row in p.reports]
    if reports:
        write_snapshot(gate_report(spark, reports), f"{root}/reports/version={mark.version}")
    mark = mark._replace(extracts=[p.digest for p in loads], settings=settings, profile=loads[-1].profile)
    intend(spark, root, mark)
    return _finished(spark, root, mark, config, loads)


def _again(spark: SparkSession, root: str, mark: Mark, config: HistoryLoadConfig, csvs: list[str], settings: dict) -> Loaded:
    """A load whose folders are whole already."""
    found = [identity(spark, csv, config.extract) for csv in csvs]
    if mark.extracts != found:
        raise ValueError(f"version {mark.version} is published from another extract: {mark.extracts}, not {found}")
    other = sorted(k for k in settings if settings[k] != mark.settings.get(k))
    if other:
        raise ValueError(f"version {mark.version} is published with other settings: {', '.join(f'{k} {mark.settings.get(k)}' for k in other)}")
    return _finished(spark, root, mark, config)


def _resumed(spark: SparkSession, root: str, version: int, config: HistoryLoadConfig, csvs: list[str], settings: dict) -> Loaded | None:
    """Finishes a load that is not visible yet but whole, if it is this one; another one is forgotten."""
    mark = intended(spark, root, version)
    if mark is None:
        return None
    if mark.settings == settings and mark.extracts == [identity(spark, csv, config.extract) for csv in csvs]:
        return _finished(spark, root, mark, config)
    forget_intent(spark, root, version)
    return None


def first_history_load(
    spark: SparkSession,
    base_csv: str,
    delta_csv: str,
    root: str,
    config: HistoryLoadConfig,
    base_as_of: datetime,
) -> Loaded:
    """Start a history from a base extract, merge the first delta into it, and publish version 1.

    The same extracts with the same settings again finish a load that broke off, or return what is published; others
    raise. So does a base not before its delta. The drift gate has nothing to compare with yet, as a base is whole and a
    delta is not; it notes the delta's profile for the next load.
    """
    base_as_of = load_time(base_as_of)
    if base_as_of >= config.merge.as_of:
        raise ValueError(f"the base ({base_as_of}) must be before its delta ({config.merge.as_of})")
    csvs, settings = [base_csv, delta_csv], _settings(config, base_as_of, config.merge.as_of)
    before = published(spark, root, 1)
    if before:
        return _again(spark, root, before, config, csvs, settings)
    resumed = _resumed(spark, root, 1, config, csvs, settings)
    if resumed:
        return resumed
    folder = work_folder(spark)
    try:
        base = _versions(spark, base_csv, f"{folder}/base", config, base_as_of)
        delta = _versions(spark, delta_csv, f"{folder}/delta", config, config.merge.as_of)
        rows, delta = _evolved(base.rows, delta, config)
        mark = write_version(_merged(rows, delta, config), root, 1, _internal(config.merge), config.buckets, sound=True)
        return _completed(spark, root, mark, config, [base, delta], settings)
    finally:
        remove(spark, folder)


def incremental_history_load(
    spark: SparkSession, delta_csv: str, root: str, config: HistoryLoadConfig, version: int
) -> Loaded:
    """Merge a delta into the published history and publish the result as ``version``.

    Only the buckets of open versions that the delta touches are read and rewritten. A load may be repeated after a failure at
    any point: what is missing is done, down to the sink, and a version that is complete is returned as it is. Rows are
    compared, not paths: the same version from other rows, or with other settings, raises. So does a load time that is not after every
    open version's start. Columns may come, go and widen, see ``reconciled``. With ``config.drift``, an extract too far from the last one
    raises ``GateFailure`` before anything is merged; load it without ``drift``, or with wider limits, if it is right.
    """
    settings, last = _settings(config, config.merge.as_of), published(spark, root)
    if last is None or last.version < version - 1:
        raise ValueError(f"version {version} follows {version - 1}, but {last and last.version} is published")
    if last.version >= version:
        return _again(spark, root, published(spark, root, version), config, [delta_csv], settings)
    if last.greatest_start and config.merge.as_of <= last.greatest_start:
        raise ValueError(f"the load time {config.merge.as_of} is not after {last.greatest_start}, when an open version starts")
    resumed = _resumed(spark, root, version, config, [delta_csv], settings)
    if resumed:
        return resumed
    folder, merge = work_folder(spark), _internal(config.merge)
    try:
        delta = _versions(spark, delta_csv, folder, config, merge.as_of, len(last.buckets), last.profile)
        hist, delta = _evolved(read_open(spark, root, last, delta.buckets), delta, config)
        mark = write_version(_merged(hist, delta, config), root, version, merge, len(last.buckets), delta.buckets, sound=True)
        return _completed(spark, root, mark, config, [delta], settings)
    finally:
        remove(spark, folder)


def adopt_history(table: DataFrame, root: str, config: HistoryLoadConfig) -> Mark:
    """Take over an existing history, with its ends in the configured encoding, as version 0.

    Refused if a key has two open versions, if an open version has no whole key, or if a version ends
    before it starts. Loads go on with version 1, incremental.
    """
    merge = _internal(config.merge)
    if published(table.sparkSession, root):
        raise ValueError(f"{root} holds a published history")
    rows = decode_open(table, config.merge)
    is_open = named(merge.end).isNull()
    keyless, reversed_ = rows.agg(
        F.count_if(is_open & any_null(merge.key)), F.count_if(named(merge.end) < named(merge.start))
    ).first()
    if keyless or reversed_:
        raise ValueError(f"{keyless} open versions have no whole key, {reversed_} versions end before they start")
    check_one_row_per_key(rows.where(is_open), merge, "several open versions of a key")
    return publish(rows, root, 0, merge, config.buckets)


# ---------------------------------------------------------------- loads without history


def dimension_load(spark: SparkSession, csv: str, config: DimensionLoadConfig) -> Loaded:
    """Gate and cleanse an extract, stamp it with an open range and replace a table. No history is kept.

    Rows left out and reports are whole before the table is replaced. Beside a parquet table they are readable until the load
    after the next; a connector's table is read back through the connector.
    """
    folder = work_folder(spark)
    latest = config.dedup == "latest"

    def keep(rows: DataFrame) -> DataFrame:
        if latest:
            return latest_per_key(rows, config.latest_key, config.latest_order)
        audit = [c for c in config.extract.audit if c in rows.columns]
        # equal rows but for their audit columns; which one is kept must not depend on their order
        return latest_per_key(rows, [c for c in rows.columns if c not in (*audit, _ROW)], [*audit, _ROW])

    try:
        columns = [c for c in csv_header(spark, csv, config.extract.csv) if c not in config.extract.audit]
        prepared = _prepare(spark, csv, folder, config.extract, keep, config.latest_key if latest else columns)
        stamped = stamp_open(prepared.rows, config.stamp)
        beside = {"left_out": prepared.left_out}
        if config.extract.gates:
            beside["reports"] = gate_report(spark, prepared.reports)
        sink, aside = config.sink, config.aside
        if sink.fmt != "parquet" or aside:
            aside = aside or f"{work_folder(spark)}-kept"
            for name, rows in beside.items():
                write_snapshot(rows, f"{aside}/{name}")
            n = publish_table(stamped, sink)
            of = lambda name: read_parquet(spark, f"{aside}/{name}", beside[name].schema)
        else:
            n = publish_table(stamped, sink, beside)
            of = lambda name: read_table_published(spark, sink.path, beside[name].schema, name)
        if sink.fmt == "parquet":
            table = read_table_published(spark, sink.path, stamped.schema)
        else:
            table = read_table(spark, sink.path, sink.fmt, sink.options)
        return Loaded(table, prepared.rows_landed, n, of("reports") if "reports" in beside else None, of("left_out"))
    finally:
        remove(spark, folder)
