"""The plans that matter at scale: what is shuffled, pruned, split and kept out of Python."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from histload.operators import dedup, history, quality
from histload.plans import fixtures, queries
from histload.sources import writers


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan as it ran, with what Spark changed at run time."""
    df._jdf.collectToPython()
    return plan(df).split("Initial Plan")[0]


def shuffle_joins(spark):
    return settings(spark, spark__sql__autoBroadcastJoinThreshold="-1")


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """A published history's open versions, its whole, and a delta, all on disk."""
    folder = tmp_path_factory.mktemp("stored")
    root = str(folder / "h")
    mark = writers.publish(queries._hist(spark, sf_dir), root, 1, queries.MERGE, 4)
    writers.write_snapshot(queries._delta(spark, sf_dir), str(folder / "delta"))
    return writers.read_open(spark, root, mark), spark.read.parquet(str(folder / "delta"))


NO_PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_python_and_no_cross_join(name, spark, sf_dir):
    text = plan(queries.QUERIES[name](spark, sf_dir))
    assert not [word for word in NO_PYTHON if word in text]


def counted(text: str) -> tuple[int, int, int]:
    """Scans, hash exchanges, and joins."""
    return text.count("FileScan"), text.count("Exchange hashpartitioning"), text.count("Join")


def test_merges_and_change_detection_read_and_move_little(spark, stored):
    hist, delta = stored
    with shuffle_joins(spark):
        # the filters on openness and on whole keys make two scans of each side, with other folders or few rows
        assert counted(plan(history.merge_changed_only(hist, delta, queries.MERGE))) == (4, 2, 1)
        assert counted(plan(history.merge_reversion_all(hist, delta, queries.MERGE)))[1:] == (2, 1)
        assert counted(plan(history.changed_rows(delta, hist, queries.MERGE))) == (2, 2, 1)
        assert counted(plan(history.rows_to_close(hist, delta, queries.MERGE, True))) == (2, 2, 1)
        assert counted(plan(history.new_keys(delta, hist, queries.MERGE))) == (2, 2, 1)


def test_small_delta_leaves_history_in_place(spark, stored):
    hist, delta = stored
    size = history.delta_size(delta)
    with shuffle_joins(spark):
        merged = plan(history.merge_changed_only(hist, delta, queries.MERGE, size))
        again = plan(history.merge_reversion_all(hist, delta, queries.MERGE, size))
    assert "BroadcastHashJoin" in merged and "LeftOuter" in merged
    assert "SortMergeJoin" not in again
    # the second look at the history reads its keys only
    assert "ReadSchema: struct<k:bigint,end_date:timestamp_ntz>" in merged


def test_large_delta_is_not_broadcast(spark, stored):
    config = queries.replace(queries.MERGE, broadcast_bytes=10)
    size = history.delta_size(stored[1])
    with shuffle_joins(spark):
        for merge in (history.merge_changed_only, history.merge_reversion_all):
            assert "Broadcast" not in plan(merge(*stored, config, size))


def test_latest_per_key_keeps_one_row_before_the_shuffle(spark, sf_dir):
    lines = fixtures.dirty_lines(spark, sf_dir)
    text = plan(dedup.latest_per_key(lines, ["k"], ["l_shipdate"]))
    partial = text.index("row_number(), 1, Partial")
    assert text.index("Exchange hashpartitioning") < partial and text.count("Exchange") == 1


def test_hot_key_is_split_at_run_time(spark, sf_dir, tmp_path):
    # A third of the delta's rows, in many map outputs as on a cluster, with limits to fit their size.
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="200",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2k",
    ):
        # Stored: Spark moves a semi join below a mere repartition, to where there are few map outputs.
        for name, rows in (("h", fixtures.order_hist(spark, sf_dir)), ("d", fixtures.order_delta(spark, sf_dir))):
            rows.repartition(16).write.parquet(str(tmp_path / name))
        hist, delta = (spark.read.parquet(str(tmp_path / name)) for name in ("h", "d"))
        assert "SortMergeJoin(skew=true)" in final_plan(history.changed_rows(delta, hist, queries.MERGE))


def test_hot_key_meets_an_open_version(spark, sf_dir):
    hist = fixtures.order_hist(spark, sf_dir)
    delta = queries._settled_orders(spark, sf_dir)
    merged = history.merge_changed_only(hist, delta, queries.MERGE).where("k = '0'")
    closed_now = merged.where(F.col("end_date") == F.lit(fixtures.AS_OF).cast("timestamp_ntz"))
    assert closed_now.count() == 1 and merged.where("end_date is null").count() == 1


def test_hot_partition_value_is_written_by_several_tasks(spark, sf_dir, tmp_path):
    lines = fixtures.dirty_lines(spark, sf_dir).repartition(16).withColumn("hot", F.col("k") == 0)
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="64k"):
        writers.write_snapshot(lines, str(tmp_path / "t"), ["hot"])
    files = list((tmp_path / "t" / "hot=true").glob("*.parquet"))
    assert len(files) > 2


def test_published_reads_only_the_folders_it_needs(spark, sf_dir, tmp_path):
    root, hist = tmp_path / "h", queries._hist(spark, sf_dir)
    for version in (1, 2, 3):
        mark = writers.publish(hist, str(root), version, queries.MERGE, 2)

    def folders(df):
        names = df.select(F.input_file_name().alias("f")).distinct().collect()
        return {r.f.split(f"{root}/loads/")[1].rsplit("/", 1)[0] for r in names}

    assert folders(writers.read_open(spark, str(root), mark)) == {f"version=3/is_open=1/bucket={b}" for b in (0, 1)}
    whole = writers.read_published(spark, str(root), 2)
    closed = {f"version={v}/is_open=0/bucket=-1" for v in (1, 2)}
    assert folders(whole) == closed | {f"version=2/is_open=1/bucket={b}" for b in (0, 1)}
    opened = {f.split(f"{root}/loads/")[1].rsplit("/", 1)[0] for f in whole.inputFiles()}
    assert opened == closed | {f"version=2/is_open=1/bucket={b}" for b in (0, 1)}  # no other folder is even listed


def test_few_files_however_many_tasks(spark, sf_dir, tmp_path):
    hist = queries._hist(spark, sf_dir).repartition(40)
    writers.publish(hist, str(tmp_path), 1, queries.MERGE, 2)
    assert len(list((tmp_path / "loads").rglob("*.parquet"))) == 3


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders")
    text = plan(quality.not_null_all(orders, ["o_orderkey", "o_custkey"]).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderkey), IsNotNull(o_custkey)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


@pytest.mark.parametrize("gate", ["gate_count", "gate_schema", "gate_nulls", "gate_chain_report"])
def test_gate_reports_take_one_pass(gate, spark, sf_dir):
    # the chain has counted its rows by then; the report reads them once more, for duplicates
    text = plan(queries.QUERIES[gate](spark, sf_dir))
    assert text.count("FileScan") == 1
