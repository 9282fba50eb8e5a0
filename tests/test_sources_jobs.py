"""Sources, sinks, published versions and load jobs."""

from collections import Counter
from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from histload.config import (
    DimensionLoadConfig,
    ExtractConfig,
    GateConfig,
    HistoryLoadConfig,
    MergeConfig,
    Sink,
    StampConfig,
)
from histload.functions import parse_timestamp
from histload.operators import history, ordering, quality
from histload.plans import fixtures, jobs, queries
from histload.sources import readers, workspace, writers

# The audit columns that extracts have.
AUDIT = "CreatedTimestamp,UpdatedTimestamp"
MERGE = MergeConfig("id", "name", datetime(2019, 6, 1))
EXTRACT = ExtractConfig("id,name", "id STRING, name STRING, CreatedTimestamp STRING, UpdatedTimestamp STRING", AUDIT)
CONFIG = HistoryLoadConfig(EXTRACT, MERGE, "UpdatedTimestamp", buckets=8)
BASE_AS_OF, LATER = datetime(2019, 4, 3, 2, 1), datetime(2019, 8, 1)
LATER_CONFIG = replace(CONFIG, merge=replace(MERGE, as_of=LATER))


def write_lines(path: Path, *lines: str) -> str:
    path.mkdir()
    (path / "part.csv").write_text("\n".join(lines) + "\n")
    return str(path)


def extract(path: Path, *rows: str) -> str:
    """Rows as "id,name" or "id,name,day of the update"."""
    full = [r if r.count(",") > 1 else f"{r},2019-01-05" for r in rows]
    return write_lines(path, f"id,name,{AUDIT}", *[r.replace(",2019", ",2018-12-31,2019") for r in full])


def test_typed_csv(spark, tmp_path):
    path = write_lines(tmp_path / "in", "a,b,t", "1, x ,2022-01-01 10:00:00", "2,,")
    schema = "a INT, b STRING, t TIMESTAMP_NTZ"
    rows = readers.read_csv_typed(spark, path, schema).collect()
    assert [tuple(r) for r in rows] == [(1, " x ", datetime(2022, 1, 1, 10)), (2, None, None)]
    inferred = readers.read_csv_typed(spark, path)
    assert inferred.dtypes == [("a", "int"), ("b", "string"), ("t", "timestamp")]
    text = readers.read_csv_text(spark, path)
    assert {t for _, t in text.dtypes} == {"string"}


def test_typed_csv_refuses_bad_input(spark, tmp_path):
    bad = write_lines(tmp_path / "bad", "a,b", "one,x")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv_typed(spark, bad, "a INT, b STRING").collect()
    swapped = write_lines(tmp_path / "swapped", "b,a", "x,1")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv_typed(spark, swapped, "a STRING, b STRING").collect()


def test_short_lines(spark, tmp_path):
    path = write_lines(tmp_path / "in", "a,b", "1,x", "2")
    assert [tuple(r) for r in readers.read_csv_typed(spark, path).collect()] == [(1, "x"), (2, None)]
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv_typed(spark, path, "a INT, b STRING").collect()
    kept = readers.read_csv_typed(spark, path, "a INT, b STRING", {"mode": "DROPMALFORMED"})
    assert [tuple(r) for r in kept.collect()] == [(1, "x")]


def test_csv_options(spark, tmp_path):
    path = write_lines(tmp_path / "in", "a|b", '1|"say ""hi"" now"', '2|"two', 'lines"')
    options = {"delimiter": "|", "multiLine": "true"}
    rows = readers.read_csv_typed(spark, path, "a INT, b STRING", options).collect()
    assert [tuple(r) for r in rows] == [(1, 'say "hi" now'), (2, "two\nlines")]
    assert readers.csv_header(spark, path, options) == ["a", "b"]


def test_table_formats(spark, tmp_path):
    path = str(tmp_path / "orc")
    seen = writers.write_snapshot(spark.range(5), path, fmt="orc", options={"compression": "zlib"})
    assert seen == {"rows": 5}
    assert readers.read_table(spark, path, fmt="orc").count() == 5


def test_snapshot_folders_keep_blanks_and_nulls(spark, tmp_path):
    path = tmp_path / "t"
    rows = readers.rows(spark, [(1, "x"), (2, ""), (3, None), (4, "x")], "n INT, s STRING")
    seen = writers.write_snapshot(rows, str(path), ["s"], measures={"top": F.max("n")})
    assert seen == {"rows": 4, "top": 4}
    assert len([p for p in path.iterdir() if p.is_dir()]) == 3
    assert Counter(writers.read_snapshot(spark, str(path), rows.schema).collect()) == Counter(rows.collect())
    # Overwriting leaves the new rows only.
    writers.write_snapshot(rows.where("s = 'x'"), str(path), ["s"])
    assert {r.n for r in writers.read_snapshot(spark, str(path), rows.schema).collect()} == {1, 4}


def test_parse_timestamp(spark):
    rows = readers.rows(spark, [("2021-03-14 02:30:00",), ("31.12.2021",), (None,)], "t STRING")
    lenient = rows.select(parse_timestamp("t", "yyyy-MM-dd HH:mm:ss", strict=False).alias("p"))
    assert [r.p for r in lenient.collect()] == [datetime(2021, 3, 14, 2, 30), None, None]
    with pytest.raises(Exception, match="(?i)parse"):
        rows.select(parse_timestamp("t", "yyyy-MM-dd HH:mm:ss")).collect()


def test_null_profile(spark):
    rows = readers.rows(
        spark, [(1.0, "x", None), (float("nan"), " ", None), (None, None, None)], "f DOUBLE, s STRING, i INT"
    )
    found = [tuple(r) for r in quality.null_profile(rows).collect()]
    assert found == [("f", 3, 1, 1, 0), ("s", 3, 1, 0, 1), ("i", 3, 3, 0, 0)]


def test_schema_gate_types(spark):
    rows = readers.rows(spark, [(1, "x")], "a INT, b STRING")
    config = GateConfig(columns="a,b", types={"a": "bigint"}, schema_check=True)
    report = quality.gate_schema(rows, config).report.first()
    assert not report.passed and "mistyped: a" in report.detail


def test_number_rows(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    numbered = ordering.number_rows(rows.orderBy("v"), "position", str(tmp_path / "n"))
    assert numbered.where("position <> v + 1").isEmpty() and numbered.count() == 1000
    empty = ordering.number_rows(rows.where("v < 0").orderBy("v"), "position", str(tmp_path / "e"))
    assert empty.isEmpty()


def test_shared_folder(spark):
    assert workspace.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert workspace.work_folder(spark) != workspace.work_folder(spark)


# ---------------------------------------------------------------- history loads


def versions(df):
    return Counter((r.id, r.name, r.start_date, r.end_date) for r in df.collect())


@pytest.fixture
def started(spark, tmp_path):
    """A history after its first load: id 3 has no name, one row no id, id 2 an older and a newer row."""
    root = str(tmp_path / "history")
    base = extract(tmp_path / "base", "1,elm", "2,ash", "3,", ",oak", "2,ash")
    first = extract(tmp_path / "first", "1,elm", "2,yew,2019-05-09", "2,zelkova,2019-05-01")
    loaded = jobs.first_history_load(spark, base, first, root, CONFIG, BASE_AS_OF)
    return root, base, first, loaded


FIRST = Counter(
    [("1", "elm", BASE_AS_OF, None), ("2", "ash", BASE_AS_OF, MERGE.as_of), ("2", "yew", MERGE.as_of, None)]
)
SECOND = Counter(
    [
        ("1", "elm", BASE_AS_OF, None),
        ("2", "ash", BASE_AS_OF, MERGE.as_of),
        ("2", "yew", MERGE.as_of, LATER),
        ("2", "fir", LATER, None),
        ("7", "box", LATER, None),
    ]
)


def test_first_load_keeps_the_newest_rows_and_tells_of_the_others(started):
    _, _, _, loaded = started
    assert versions(loaded.table) == FIRST
    assert (loaded.rows_landed, loaded.rows_loaded, loaded.reports) == (8, 4, None)
    left_out = Counter((r.id, r.name) for r in loaded.left_out.collect())
    assert left_out == Counter([("3", None), (None, "oak"), ("2", "ash"), ("2", "zelkova")])


def test_incremental_load_and_its_repetition(spark, started, tmp_path):
    root, base, first, _ = started
    second = extract(tmp_path / "second", "2,fir", "7,box")
    assert versions(jobs.incremental_history_load(spark, second, root, LATER_CONFIG, 2).table) == SECOND
    # The same loads again, and readers of the first version, see what they saw.
    again = jobs.incremental_history_load(spark, second, root, LATER_CONFIG, 2)
    assert versions(again.table) == SECOND and again.rows_loaded == 0
    assert versions(jobs.first_history_load(spark, base, first, root, CONFIG, BASE_AS_OF).table) == FIRST
    assert versions(writers.read_published(spark, root, 1)) == FIRST
    other = extract(tmp_path / "other", "9,may")
    with pytest.raises(ValueError, match="another extract"):
        jobs.incremental_history_load(spark, other, root, LATER_CONFIG, 2)


@pytest.mark.parametrize("limit", [1, 128 << 20])
def test_result_does_not_depend_on_the_broadcast_limit(spark, started, tmp_path, limit):
    root, *_ = started
    config = replace(LATER_CONFIG, merge=replace(LATER_CONFIG.merge, broadcast_bytes=limit))
    second = extract(tmp_path / "second", "2,fir", "7,box")
    assert versions(jobs.incremental_history_load(spark, second, root, config, 2).table) == SECOND


def test_a_history_with_two_open_versions_of_a_key_is_not_published(spark, tmp_path):
    schema = "id STRING, name STRING, start_date TIMESTAMP_NTZ, end_date TIMESTAMP_NTZ"
    rows = readers.rows(spark, [("1", "elm", BASE_AS_OF, None), ("1", "ash", BASE_AS_OF, None)], schema)
    with pytest.raises(history.Unsound):
        writers.publish(rows, str(tmp_path / "h"), 1, MERGE)
    assert writers.published_version(spark, str(tmp_path / "h")) is None


def test_loads_that_would_corrupt_are_refused(spark, started, tmp_path):
    root, base, first, _ = started
    second = extract(tmp_path / "second", "2,fir")
    with pytest.raises(ValueError, match="follows"):
        jobs.incremental_history_load(spark, second, root, LATER_CONFIG, 3)
    with pytest.raises(ValueError, match="not after"):
        jobs.incremental_history_load(spark, second, root, CONFIG, 2)
    with pytest.raises(ValueError, match="before its delta"):
        jobs.first_history_load(spark, base, first, str(tmp_path / "new"), CONFIG, LATER)
    assert writers.published_version(spark, root) == 1


def test_load_that_broke_off_is_repeated(spark, started, tmp_path, monkeypatch):
    root, *_ = started
    second = extract(tmp_path / "second", "2,fir", "7,box")
    shared = Path(workspace.shared_folder(spark).removeprefix("file://"))
    work_folders = set(shared.glob("histload-*"))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(writers, "_mark", lost)
        with pytest.raises(RuntimeError):
            jobs.incremental_history_load(spark, second, root, LATER_CONFIG, 2)
    assert writers.published_version(spark, root) == 1
    assert versions(writers.read_published(spark, root)) == FIRST
    assert versions(jobs.incremental_history_load(spark, second, root, LATER_CONFIG, 2).table) == SECOND
    assert set(shared.glob("histload-*")) == work_folders  # neither load has left one


def test_a_load_rewrites_only_the_buckets_it_touches(spark, sf_dir, tmp_path):
    root = str(tmp_path / "h")
    hist = queries._hist(spark, sf_dir)
    mark = writers.publish(hist, root, 1, queries.MERGE, 16)
    one = queries._delta(spark, sf_dir).where("seg = 'REVISED'").orderBy("k").limit(1)
    touched = writers.touched_buckets(one, queries.MERGE, 16)
    current = writers.read_open(spark, root, mark, touched)
    assert {r.f.split("/is_open=1/")[1].split("/")[0] for r in current.select(F.input_file_name().alias("f")).collect()} == {f"bucket={touched[0]}"}
    after = writers.publish(history.merge_changed_only(current, one, queries.MERGE), root, 2, queries.MERGE, 16, touched)
    assert [b for b, v in enumerate(after.buckets) if v == 2] == touched and len(touched) == 1
    written = [p.name for p in (tmp_path / "h/loads/version=2/is_open=1").iterdir() if p.is_dir()]
    assert written == [f"bucket={touched[0]}"]
    whole = history.merge_changed_only(hist, one, queries.MERGE)
    found = writers.read_published(spark, root)
    assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty()
    # Superseded folders go, and nothing changes for readers of the last load.
    assert writers.drop_superseded(spark, root) == 1
    assert writers.read_published(spark, root).exceptAll(whole).isEmpty()


def test_published_history_keeps_hot_past(spark, sf_dir, tmp_path):
    root = str(tmp_path / "history")
    hist, delta = fixtures.order_hist(spark, sf_dir), queries._settled_orders(spark, sf_dir)
    mark = writers.publish(hist, root, 1, queries.MERGE, 4)
    merged = history.merge_changed_only(writers.read_open(spark, root, mark), delta, queries.MERGE)
    writers.publish(merged, root, 2, queries.MERGE, 4)
    after = writers.read_published(spark, root)
    whole = history.merge_changed_only(hist, delta, queries.MERGE)
    assert after.exceptAll(whole).isEmpty() and whole.exceptAll(after).isEmpty()


def test_encoded_result_goes_to_a_partitioned_sink(spark, tmp_path):
    sink = Sink(str(tmp_path / "out"), partition_by="name")
    config = replace(CONFIG, merge=replace(MERGE, open_end="sentinel"), mode="reversion_all", sink=sink)
    base, first = extract(tmp_path / "base", "1,elm", "2,ash"), extract(tmp_path / "first", "2,ash")
    table = jobs.first_history_load(spark, base, first, str(tmp_path / "h"), config, BASE_AS_OF).table
    written = writers.read_snapshot(spark, sink.path, table.schema)
    for df in (table, written):
        ends = [r.e for r in df.select(F.col("end_date").cast("string").alias("e")).collect()]
        assert sorted(ends) == ["2019-06-01 00:00:00", "9999-12-31 23:59:59", "9999-12-31 23:59:59"]


def test_gates_and_inference_in_a_load(spark, tmp_path):
    gates = GateConfig(columns="id,name", schema_check=True, null_check=True, null_columns="name")
    config = replace(CONFIG, extract=replace(EXTRACT, schema=None, gates=gates, csv={"delimiter": ","}))
    base, first = extract(tmp_path / "base", "1,elm", "2,"), extract(tmp_path / "first", "1,ash")
    loaded = jobs.first_history_load(spark, base, first, str(tmp_path / "h"), config, BASE_AS_OF)
    assert dict(loaded.table.dtypes)["id"] == "int"
    assert Counter((r.gate, r.rows_in, r.rows_out) for r in loaded.reports.collect())[("nulls", 2, 1)] == 1
    named = write_lines(tmp_path / "named", "id,title,CreatedTimestamp,UpdatedTimestamp", "1,elm,a,b")
    strict = replace(CONFIG, extract=replace(EXTRACT, gates=gates))
    with pytest.raises(quality.GateFailure, match="missing: name"):
        jobs.first_history_load(spark, named, first, str(tmp_path / "h2"), strict, BASE_AS_OF)
    with pytest.raises(ValueError, match="title"):
        jobs.first_history_load(spark, named, first, str(tmp_path / "h2"), CONFIG, BASE_AS_OF)


def test_adopted_history(spark, tmp_path):
    config = replace(LATER_CONFIG, merge=replace(LATER_CONFIG.merge, open_end="sentinel"))
    schema = "id STRING, name STRING, start_date TIMESTAMP_NTZ, end_date TIMESTAMP_NTZ"
    table = history.encode_open(readers.rows(spark, list(FIRST.elements()), schema), config.merge)
    root = str(tmp_path / "h")
    jobs.adopt_history(table, root, config)
    second = extract(tmp_path / "second", "2,fir", "7,box")
    result = jobs.incremental_history_load(spark, second, root, config, 1).table
    assert versions(history.decode_open(result, config.merge)) == SECOND
    reversed_ = readers.rows(spark, [("1", "elm", LATER, BASE_AS_OF)], schema)
    with pytest.raises(ValueError, match="end before"):
        jobs.adopt_history(reversed_, str(tmp_path / "h2"), config)
    with pytest.raises(history.Unsound):
        jobs.adopt_history(table.unionByName(table.where("id = '1'")), str(tmp_path / "h3"), config)
    with pytest.raises(ValueError, match="holds"):
        jobs.adopt_history(table, root, config)


# ---------------------------------------------------------------- loads without history


def test_dimension_load(spark, tmp_path):
    csv = extract(tmp_path / "in", "1,elm", "1,elm", "1,yew,2019-02-02", "2,")
    sink, stamp = Sink(str(tmp_path / "out"), partition_by="id"), StampConfig(MERGE.as_of, open_end="horizon")
    loaded = jobs.dimension_load(spark, csv, DimensionLoadConfig(EXTRACT, stamp, sink))
    assert (loaded.rows_landed, loaded.rows_loaded, loaded.table.count()) == (4, 2, 2)
    assert Counter(r.name for r in loaded.left_out.collect()) == Counter(["elm", None])
    latest = DimensionLoadConfig(EXTRACT, StampConfig(MERGE.as_of), sink, "latest", "id", "UpdatedTimestamp")
    row = jobs.dimension_load(spark, csv, latest).table.collect()
    assert [(r.id, r.name, r.start_date, r.end_date) for r in row] == [("1", "yew", MERGE.as_of, None)]


def test_dimension_load_of_one_column_and_with_gates(spark, tmp_path):
    csv = write_lines(tmp_path / "in", "id", "4", "5", "4")
    gates = GateConfig(columns="id", schema_check=True)
    config = DimensionLoadConfig(ExtractConfig("id", "id INT", gates=gates), StampConfig(MERGE.as_of), Sink(str(tmp_path / "out")))
    loaded = jobs.dimension_load(spark, csv, config)
    assert sorted(r.id for r in loaded.table.collect()) == [4, 5] and loaded.reports.count() == 4
    empty = write_lines(tmp_path / "empty", "id")
    with pytest.raises(quality.GateFailure, match="no rows"):
        jobs.dimension_load(spark, empty, config)
    assert loaded.table.count() == 2


def test_a_load_that_breaks_off_leaves_the_old_table(spark, tmp_path):
    sink = Sink(str(tmp_path / "out"))
    writers.publish_table(spark.range(5), sink)
    broken = spark.range(8, numPartitions=4).select(F.when(F.col("id") < 6, F.col("id")).otherwise(F.raise_error("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        writers.publish_table(broken, sink)
    assert writers.read_table_published(spark, sink.path, spark.range(1).schema).count() == 5
    with pytest.raises(ValueError, match="nothing"):
        writers.read_table_published(spark, str(tmp_path / "none"), spark.range(1).schema)
