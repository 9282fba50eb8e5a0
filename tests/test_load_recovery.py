"""Loads that break off and are repeated, extracts told by their rows, columns that change, closed versions that are joined."""

from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from histload.config import DimensionLoadConfig, ExtractConfig, GateConfig, HistoryLoadConfig, MergeConfig, Sink, StampConfig
from histload.operators import history
from histload.operators.evolution import SchemaChange
from histload.plans import fixtures, jobs, queries
from histload.sources import readers, workspace, writers

# The audit columns that extracts have.
AUDIT = "CreatedTimestamp,UpdatedTimestamp"
FIRST, SECOND, THIRD = (datetime(2020, m, 1) for m in (1, 2, 3))


def schema_of(columns):
    return f"{columns}, CreatedTimestamp STRING, UpdatedTimestamp STRING"


def config_of(as_of, columns="id STRING, name STRING", tracked="name", **more):
    gates = GateConfig(columns="id,name", null_check=True, null_columns="id", duplicate_check=True, duplicate_columns="id,name", duplicate_order="UpdatedTimestamp")
    extract = ExtractConfig("id,name", schema_of(columns), AUDIT, gates)
    return HistoryLoadConfig(extract, MergeConfig("id", tracked, as_of), "UpdatedTimestamp", buckets=2, **more)


def extract(path: Path, *rows: str, header="id,name") -> str:
    """Rows without audit columns; a second number after a blank is the day of the update."""
    path.mkdir()
    lines = [f"{header},{AUDIT}"]
    for row in rows:
        row, day = (*row.split(" "), "1")[:2]
        lines.append(f"{row},2020-01-01,2020-01-0{day}")
    (path / "part.csv").write_text("\n".join(lines) + "\n")
    return str(path)


def content(df):
    return None if df is None else Counter(map(str, df.collect()))


@pytest.fixture
def extracts(tmp_path):
    base = extract(tmp_path / "base", "1,elm", "2,ash", "3,", "4,oak", "4,oak", ",fir")
    first = extract(tmp_path / "first", "2,yew 2", "2,old 1", "5,box")
    second = extract(tmp_path / "second", "1,elm", "5,may 3", "5,bay 2", "6,", "7,ivy", "7,ivy")
    return base, first, second


def both_loads(spark, root, extracts, sink):
    base, first, second = extracts
    config = config_of(SECOND, sink=sink)
    one = jobs.first_history_load(spark, base, first, root, config, FIRST)
    two = jobs.incremental_history_load(spark, second, root, replace(config, merge=replace(config.merge, as_of=THIRD)), 2)
    return one, two


def state(spark, root, loads, sink):
    found = [content(writers.read_snapshot(spark, sink.path, loads[1].table.schema))]
    for loaded in loads:
        found += [content(loaded.table), content(loaded.left_out), content(loaded.reports)]
    return found, [p for p in Path(root).rglob("*.json")].__len__()


@pytest.fixture
def one_partition(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_a_load_broken_off_after_any_write_is_finished_by_its_repetition(spark, tmp_path, extracts, monkeypatch, one_partition):
    sink = Sink(str(tmp_path / "sink"))
    want = state(spark, str(tmp_path / "whole"), both_loads(spark, str(tmp_path / "whole"), extracts, sink), sink)
    assert want[0][0] and want[0][2] and want[0][3]
    shared = Path(workspace.shared_folder(spark).removeprefix("file://"))
    before, broken = set(shared.glob("histload-*")), 0
    for stop in range(1, 100):
        root, sink, left = str(tmp_path / f"h{stop}"), Sink(str(tmp_path / f"sink{stop}")), [stop]

        def breaking(function, left=left):
            def run(*args, **kwargs):
                out = function(*args, **kwargs)
                left[0] -= 1
                if left[0] == 0:
                    raise RuntimeError("lost")
                return out

            return run

        with monkeypatch.context() as m:
            for name in ("save", "parquet"):
                m.setattr(DataFrameWriter, name, breaking(getattr(DataFrameWriter, name)))
            m.setattr(writers, "write_record", breaking(writers.write_record))
            try:
                both_loads(spark, root, extracts, sink)
            except RuntimeError:
                broken += 1
            else:
                break
        # whatever a reader sees now is one of the loads as a whole
        seen = writers.published_version(spark, root)
        assert seen in (None, 1, 2)
        if seen:
            assert content(writers.read_published(spark, root)) == want[0][1 if seen == 1 else 4]
        assert state(spark, root, both_loads(spark, root, extracts, sink), sink) == want
    assert broken == stop - 1 >= 15
    assert set(shared.glob("histload-*")) == before


def test_an_earlier_load_finished_late_does_not_replace_the_sink(spark, tmp_path, extracts):
    root, sink = str(tmp_path / "h"), Sink(str(tmp_path / "sink"))
    loads = both_loads(spark, root, extracts, sink)
    workspace.remove(spark, f"{root}/done")
    first = jobs.first_history_load(spark, *extracts[:2], root, config_of(SECOND, sink=sink), FIRST)
    assert content(first.table) == content(loads[0].table) != content(loads[1].table)
    assert content(writers.read_snapshot(spark, sink.path, first.table.schema)) == content(loads[1].table)


def test_fates_of_landed_rows(spark, tmp_path, extracts):
    one, two = both_loads(spark, str(tmp_path / "h"), extracts, None)
    fates = [Counter((r.id, r.name, r.fate) for r in loaded.left_out.collect()) for loaded in (one, two)]
    assert fates[0] == Counter([("3", None, "null"), (None, "fir", "null"), ("4", "oak", "copy"), ("2", "old", "superseded")])
    assert fates[1] == Counter([("6", None, "null"), ("5", "bay", "superseded"), ("7", "ivy", "copy")])
    assert (two.rows_landed, two.rows_loaded) == (6, 3)
    reports = {r.gate: (r.rows_in, r.rows_out) for r in two.reports.collect()}
    assert reports == {"count": (6, 6), "schema": (6, 6), "nulls": (6, 6), "duplicates": (6, 5)}


def test_extracts_are_told_by_their_rows(spark, tmp_path, extracts):
    root = str(tmp_path / "h")
    both_loads(spark, root, extracts, None)
    later = config_of(THIRD)
    moved = extract(tmp_path / "moved", "7,ivy", "7,ivy", "5,bay 2", "1,elm", "6,", "5,may 3")  # other path and order
    assert content(jobs.incremental_history_load(spark, moved, root, later, 2).table) == content(writers.read_published(spark, root))
    same_size = extract(tmp_path / "same", "1,elm", "5,may 3", "5,bay 2", "6,", "7,ivy", "7,iwy")
    with pytest.raises(ValueError, match="another extract"):
        jobs.incremental_history_load(spark, same_size, root, later, 2)
    nulls = extract(tmp_path / "nulls", "1,elm", "5,may 3", "5,bay 2", ",6", "7,ivy", "7,ivy")
    with pytest.raises(ValueError, match="another extract"):
        jobs.incremental_history_load(spark, nulls, root, later, 2)
    for other in (config_of(THIRD + timedelta(days=1)), replace(later, mode="reversion_all"), replace(later, merge=replace(later.merge, trim=True))):
        with pytest.raises(ValueError, match="other settings"):
            jobs.incremental_history_load(spark, extracts[2], root, other, 2)


def test_an_unpublished_load_gives_way_to_another_one(spark, tmp_path, extracts, monkeypatch):
    root = str(tmp_path / "h")
    config = config_of(SECOND)
    with monkeypatch.context() as m:
        m.setattr(jobs, "make_visible", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            jobs.first_history_load(spark, *extracts[:2], root, config, FIRST)
    assert writers.intended(spark, root, 1) and writers.published(spark, root) is None
    other = extract(tmp_path / "other", "1,new")
    loaded = jobs.first_history_load(spark, extracts[0], other, root, config, FIRST)
    assert ("1", "new") in {(r.id, r.name) for r in loaded.table.collect()}


# ---------------------------------------------------------------- columns that come, go and widen


def test_columns_come_and_go(spark, tmp_path, extracts):
    root = str(tmp_path / "h")
    one = jobs.first_history_load(spark, *extracts[:2], root, config_of(SECOND), FIRST).table
    wide = extract(tmp_path / "wide", "1,elm,7", "9,fig,", header="id,name,w")
    config = config_of(THIRD, "id STRING, name STRING, w INT", "name,w")
    with pytest.raises(SchemaChange):
        jobs.incremental_history_load(spark, wide, root, replace(config, evolve=False), 2)
    two = jobs.incremental_history_load(spark, wide, root, config, 2).table
    found = Counter((r.id, r.name, r.w, r.start_date, r.end_date) for r in two.collect())
    was = Counter((r.id, r.name, None, r.start_date, r.end_date) for r in one.collect())
    assert found - was == Counter([("1", "elm", None, FIRST, THIRD), ("1", "elm", 7, THIRD, None), ("9", "fig", None, THIRD, None)])
    assert was - found == Counter([("1", "elm", None, FIRST, None)])
    assert content(writers.read_published(spark, root, 1)) == content(one)  # its columns are those it had
    # the column goes again, and the next extract is wider
    narrow = extract(tmp_path / "narrow", "1,elm", "2,yew")
    three = jobs.incremental_history_load(spark, narrow, root, config_of(datetime(2020, 4, 1)), 3).table
    assert Counter(map(str, three.collect())) == Counter(map(str, two.collect()))  # nothing tracked has changed
    long = extract(tmp_path / "long", f"1,elm,{1 << 40}", header="id,name,w")
    config = config_of(datetime(2020, 5, 1), "id STRING, name STRING, w BIGINT", "name,w")
    four = jobs.incremental_history_load(spark, long, root, config, 4).table
    assert dict(four.dtypes)["w"] == "bigint" and {r.w for r in four.collect()} == {None, 7, 1 << 40}
    assert dict(writers.read_published(spark, root, 3).dtypes)["w"] == "int"


@pytest.mark.parametrize("columns, tracked, message", [("id STRING, name STRING, w INT", "name,w", "narrows w"), ("id STRING, name INT, w BIGINT", "name,w", "changes name"), ("id STRING, name STRING", "name,w", "has no w")])
def test_columns_that_cannot_follow_are_refused(spark, tmp_path, extracts, columns, tracked, message):
    root = str(tmp_path / "h")
    wide = extract(tmp_path / "wide", "1,5,7", header="id,name,w")
    config = config_of(SECOND, "id STRING, name STRING, w BIGINT", "name,w")
    before = content(jobs.first_history_load(spark, wide, wide, root, config, FIRST).table)
    header = "id,name,w" if "w " in columns else "id,name"
    bad = extract(tmp_path / "bad", "1,5,8" if "w " in columns else "1,5", header=header)
    with pytest.raises(SchemaChange, match=message):
        jobs.incremental_history_load(spark, bad, root, config_of(THIRD, columns, tracked), 2)
    assert content(writers.read_published(spark, root)) == before and writers.intended(spark, root, 2) is None


# ---------------------------------------------------------------- many loads


def test_closed_versions_of_many_loads_stay_in_few_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "JOINED", 3)
    root, n = str(tmp_path / "h"), 20
    start = datetime(2020, 1, 1)
    row = lambda i: readers.rows(spark, [("k", f"v{i}", start + timedelta(days=i), None)], "id STRING, name STRING, start_date TIMESTAMP_NTZ, end_date TIMESTAMP_NTZ")
    mark = writers.publish(row(0), root, 1, MergeConfig("id", "name", start), 2)
    for i in range(1, n):
        merge = MergeConfig("id", "name", start + timedelta(days=i))
        mark = writers.publish(history.merge_changed_only(writers.read_open(spark, root, mark), row(i), merge), root, i + 1, merge, 2)
        assert len(mark.closed) <= 2 * 3
    assert len(mark.closed) < n / 3
    for version in (1, 5, n):
        found = {(r.name, r.end_date) for r in writers.read_published(spark, root, version).collect()}
        assert found == {(f"v{i}", start + timedelta(days=i + 1) if i < version - 1 else None) for i in range(version)}
    whole = content(writers.read_published(spark, root))
    assert writers.drop_superseded(spark, root) >= n - 1
    assert content(writers.read_published(spark, root)) == whole
    assert len([p for p in (tmp_path / "h/loads").glob("*/is_open=0")]) <= 2


# ---------------------------------------------------------------- deltas between broadcast and shuffle


@pytest.mark.parametrize("merge", [history.merge_changed_only, history.merge_reversion_all])
def test_a_filter_of_keys_keeps_most_of_the_history_out_of_the_join(spark, sf_dir, merge):
    hist, delta = queries._hist(spark, sf_dir), queries._delta(spark, sf_dir).where("k % 10 = 3")
    size = history.delta_size(delta)
    between = replace(queries.MERGE, broadcast_bytes=size // 2)
    assert history._filter_bits(delta, between, size)
    want = merge(hist, delta, queries.MERGE)
    found = merge(hist, delta, between, size)
    assert found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()
    open_rows = history.current_rows(hist, queries.MERGE)
    meets, passes = history._thinned(open_rows, delta, between, size)
    assert meets.unionByName(passes).exceptAll(open_rows).isEmpty()
    hits = history._met(open_rows, delta, queries.MERGE).count()
    assert hits <= meets.count() <= hits + open_rows.count() // 8
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "bitmap_construct_agg" in plan.lower() and "BroadcastExchange" in plan


def test_no_filter_where_it_would_be_wrong_or_too_large():
    config = MergeConfig("id", "name", FIRST, broadcast_bytes=1000)
    frame = type("Frame", (), {"dtypes": [("id", "string"), ("name", "string")]})
    assert history._filter_bits(frame, config, None) == history._filter_bits(frame, config, 900) == 0
    assert history._filter_bits(frame, config, 10**9) == 0
    assert history._filter_bits(frame, replace(config, broadcast_bytes=10**8), 2 * 10**8)
    frame.dtypes = [("id", "double"), ("name", "string")]
    assert history._filter_bits(frame, replace(config, broadcast_bytes=10**8), 2 * 10**8) == 0


# ---------------------------------------------------------------- work of a load


def test_a_load_reads_the_extract_once_and_shuffles_what_it_keeps(spark, tmp_path, extracts):
    config = config_of(SECOND)
    folder = str(tmp_path / "work")
    prepared = jobs._versions(spark, extracts[0], folder, config, FIRST)
    left_out = prepared.left_out._jdf.queryExecution().toString()
    assert "csv" not in left_out.lower()  # the extract itself is not read again
    physical = prepared.left_out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in physical and "Exchange hashpartitioning" not in physical


# ---------------------------------------------------------------- connectors


def test_dimension_load_into_a_connector_returns_its_rows(spark, tmp_path):
    csv = extract(tmp_path / "in", "1,elm", "1,elm", "2,")
    sink = Sink(str(tmp_path / "orc"), "orc")
    gates = GateConfig(columns="id,name", schema_check=True)
    config = DimensionLoadConfig(ExtractConfig("id,name", schema_of("id STRING, name STRING"), AUDIT, gates), StampConfig(FIRST), sink)
    for aside in (None, str(tmp_path / "aside")):
        loaded = jobs.dimension_load(spark, csv, replace(config, aside=aside))
        assert [(r.id, r.name, r.start_date) for r in loaded.table.collect()] == [("1", "elm", FIRST)]
        assert Counter(r.fate for r in loaded.left_out.collect()) == {"copy": 1, "null": 1}
        assert (loaded.rows_landed, loaded.rows_loaded, loaded.reports.count()) == (3, 1, 4)


def test_a_dimension_load_that_breaks_off_leaves_table_reports_and_left_out_rows(spark, tmp_path, monkeypatch):
    sink = Sink(str(tmp_path / "t"))
    config = DimensionLoadConfig(ExtractConfig("id,name", schema_of("id STRING, name STRING"), AUDIT), StampConfig(FIRST), sink)
    before = jobs.dimension_load(spark, extract(tmp_path / "one", "1,elm", "2,"), config)
    was = content(before.table), content(before.left_out)
    with monkeypatch.context() as m:
        m.setattr(writers, "write_record", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            jobs.dimension_load(spark, extract(tmp_path / "two", "3,ash", "4,"), config)
    assert content(writers.read_table_published(spark, sink.path, before.table.schema)) == was[0]
    assert content(before.left_out) == was[1]
