"""One query per operator, over whole test tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histload.config import (
    DimensionLoadConfig,
    DriftConfig,
    ExtractConfig,
    GateConfig,
    HistoryLoadConfig,
    MergeConfig,
    Sink,
    StampConfig,
)
from histload.functions import (
    TIMESTAMP_FORMAT,
    all_not_null,
    load_date,
    load_date_text,
    parse_timestamp,
    sentinel,
)
from histload.operators import dedup, drift, history, ordering, quality
from histload.plans import fixtures, jobs
from histload.sources import readers, writers
from histload.sources.workspace import work_folder

MERGE = MergeConfig(key="k", tracked="seg,nat", as_of=fixtures.AS_OF)
STORED = replace(MERGE, open_end="sentinel")
GATES = GateConfig(
    columns="k,nm,seg,nat,bal",
    types={"k": "bigint", "bal": "double"},
    schema_check=True,
    null_check=True,
    null_columns="k,seg,nat",
    duplicate_check=True,
    duplicate_columns="k",
    duplicate_order="bal",
)
DRIFT = DriftConfig("k,nm,seg,nat,bal")
OPTIONS = {
    # The option names users have in their settings files.
    "count_check": "Y",
    "ccColumns_schema_validation_flag": "Y",
    "ccColumns_schema_validation": "k,nm,seg,nat,bal",
    "null_check": "Y",
    "null_check_columns": "k, seg, nat",
    "duplicate_check": "Y",
    "duplicate_check_columns": "k",
    "duplicate_check_columns_order_by_column": "bal",
}
DIRTY_SCHEMA = "k BIGINT, nm STRING, seg STRING, nat STRING, bal DOUBLE"
# The audit columns that extracts have.
AUDIT_SCHEMA = "CreatedTimestamp TIMESTAMP_NTZ, UpdatedTimestamp TIMESTAMP_NTZ"
VERSION = "k BIGINT, seg STRING, nat INT"
SECOND_AS_OF = datetime(2022, 3, 1)


def _hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.decode_open(fixtures.hist(spark, sf_dir), STORED)


def _whole_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.decode_open(fixtures.whole_hist(spark, sf_dir), STORED)


def _delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.decode_open(fixtures.delta(spark, sf_dir), STORED)


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("nat")
    )


# ---------------------------------------------------------------- sources and sinks


def rows_scan_codes(spark, sf_dir):
    codes = readers.rows(
        spark,
        [
            ("1-URGENT", "due today", "U"),
            ("2-HIGH", "due this week", None),
            ("3-MEDIUM", "", "M"),
            ("4-NOT SPECIFIED", None, "N"),
            ("5-LOW", "no date", "L"),
        ],
        "code STRING, description STRING, short STRING",
    )
    known = quality.not_null_all(codes, ["code", "description"])
    orders = fixtures.table(spark, sf_dir, "orders")
    return (
        orders.join(F.broadcast(known), orders.o_orderpriority == known.code)  # five rows at most
        .groupBy("code", "description")
        .agg(F.count(F.lit(1)).alias("n_orders"))
    )


def csv_typed_landing(spark, sf_dir):
    """Texts with line breaks and quotes."""
    folder = work_folder(spark)
    documents = fixtures.table(spark, sf_dir, "documents")
    extract = fixtures.write_extract(documents, f"{folder}/extract")
    schema = f"doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, {AUDIT_SCHEMA}"
    return writers.land_csv(spark, extract, f"{folder}/landed", schema, fixtures.AUDIT, {"multiLine": "true"}).data


def csv_blank_fields(spark, sf_dir):
    folder = work_folder(spark)
    extract = fixtures.write_extract(fixtures.dirty(spark, sf_dir), f"{folder}/extract")
    schema = f"{DIRTY_SCHEMA}, {AUDIT_SCHEMA}"
    return writers.land_csv(spark, extract, f"{folder}/landed", schema, fixtures.AUDIT).data


def csv_inferred_landing(spark, sf_dir):
    folder = work_folder(spark)
    orders = fixtures.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    extract = fixtures.write_extract(orders, f"{folder}/extract")
    landed = writers.land_csv(spark, extract, f"{folder}/landed", None, fixtures.AUDIT).data
    return landed.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_totalprice", "o_orderpriority")


def csv_string_scan(spark, sf_dir):
    seg, nat = F.col("seg"), F.col("nat")
    padded = F.when(nat.isin(7, 8), F.concat(F.lit(" "), seg, F.lit(" "))).when(nat != 3, seg)
    rows = _customers(spark, sf_dir).withColumn("seg", padded)
    extract = fixtures.write_extract(rows, f"{work_folder(spark)}/extract")
    return readers.read_csv_text(spark, extract).drop(*fixtures.AUDIT)


def parquet_roundtrip(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events")
    path = f"{work_folder(spark)}/events"
    writers.write_snapshot(events, path)
    return readers.read_parquet(spark, path, events.schema)


def table_scan_view(spark, sf_dir):
    customer = readers.read_table(spark, f"{sf_dir}/customer.parquet")
    nation = readers.read_table(spark, f"{sf_dir}/nation.parquet", fmt="parquet", options={})
    readers.register_view(customer, "histload_customer")
    readers.register_view(nation, "histload_nation")
    return spark.sql(
        "SELECT c.* FROM histload_customer c JOIN histload_nation n ON c.c_nationkey = n.n_nationkey "
        "WHERE n.n_name IS NOT NULL"
    )


def sink_partitioned_snapshot(spark, sf_dir):
    rows = fixtures.dirty(spark, sf_dir)
    path = f"{work_folder(spark)}/dirty"
    writers.write_snapshot(rows, path, partition_by=["seg", "nat"], sort_by=["k"], options={"compression": "zstd"})
    return writers.read_snapshot(spark, path, rows.schema)


def sink_plain_snapshot(spark, sf_dir):
    sums = sum_by_key(spark, sf_dir)
    path = f"{work_folder(spark)}/words"
    writers.write_snapshot(sums, path)
    return readers.read_parquet(spark, path, sums.schema)


def staged_republish(spark, sf_dir):
    root = f"{work_folder(spark)}/history"
    first, delta = _hist(spark, sf_dir), _delta(spark, sf_dir)
    mark = writers.publish(first, root, 1, MERGE, 16)
    touched = writers.touched_buckets(delta, MERGE, 16)
    merged = history.merge_changed_only(writers.read_open(spark, root, mark, touched), delta, MERGE)
    writers.publish(merged, root, 2, MERGE, 16, touched)
    return writers.read_published(spark, root)


# ---------------------------------------------------------------- filters, profiles, scalars


def not_null_all(spark, sf_dir):
    return quality.not_null_all(fixtures.dirty(spark, sf_dir), ["k", "seg", "nat"])


def rejected_rows(spark, sf_dir):
    return quality.rejected_rows(fixtures.dirty(spark, sf_dir), ["k", "seg", "nat"])


def not_blank_all(spark, sf_dir):
    return quality.not_blank_all(fixtures.dirty(spark, sf_dir), ["k", "nm", "seg", "nat"])


def drop_audit_columns(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders")
    audited = orders.withColumns({"CreatedTimestamp": F.col("o_orderdate"), "n_days": F.lit(1)})
    return quality.drop_audit_columns(audited, fixtures.AUDIT)


def null_profile(spark, sf_dir):
    rows = fixtures.dirty(spark, sf_dir)
    nan = F.when(F.col("nat") == "", float("nan")).otherwise(F.col("bal"))
    return quality.null_profile(rows.withColumn("bal", nan))


def row_count_before_after(spark, sf_dir):
    return quality.row_counts(fixtures.dirty(spark, sf_dir), all_not_null(["k", "seg", "nat"]))


def sum_by_key(spark, sf_dir):
    return quality.sum_by_key(fixtures.words(spark, sf_dir), ["word"], "word_count", "word_count")


def sum_by_key_hot_key(spark, sf_dir):
    lines = fixtures.dirty_lines(spark, sf_dir).select("k", F.col("l_quantity").cast("long").alias("qty"))
    return quality.sum_by_key(lines, ["k"], "qty", "sum_qty")


def fill_nulls(spark, sf_dir):
    return quality.fill_nulls(fixtures.dirty(spark, sf_dir), {"seg": "UNKNOWN", "bal": 0.0})


def load_dates(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        load_date_text(fixtures.AS_OF, "dd.MM.yyyy").alias("load_date"),
        F.datediff(load_date(fixtures.AS_OF), "o_orderdate").cast("long").alias("age_days"),
        F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd").alias("order_date"),
    )


def parse_timestamps(spark, sf_dir):
    orders = fixtures.table(spark, sf_dir, "orders")
    status, text = F.col("o_orderstatus"), F.col("o_orderdate").cast("string")
    written = orders.select(
        "o_orderkey",
        "o_orderdate",
        F.when(status == "P", "unknown").when(status == "F", "9999-12-31 23:59:59").otherwise(text).alias("t"),
    )
    strict = parse_timestamp(F.col("o_orderdate").cast("string"), TIMESTAMP_FORMAT)
    lenient = parse_timestamp("t", TIMESTAMP_FORMAT, strict=False)
    return written.select(
        "o_orderkey",
        strict.alias("parsed"),
        (strict == parse_timestamp("o_orderdate")).alias("unchanged"),
        F.nullif(lenient, sentinel()).alias("finite"),
        F.coalesce(lenient == sentinel(), F.lit(False)).alias("is_open"),
        F.coalesce(parse_timestamp("t", strict=False) < sentinel(), F.lit(False)).alias("is_closed"),
    )


# ---------------------------------------------------------------- de-duplication


def dedup_rows(spark, sf_dir):
    return dedup.dedup_rows(fixtures.dirty(spark, sf_dir))


def dedup_keys(spark, sf_dir):
    return dedup.dedup_keys(fixtures.dirty(spark, sf_dir), ["k", "seg"])


def latest_per_key(spark, sf_dir):
    return dedup.latest_per_key(fixtures.dirty(spark, sf_dir), ["k"], ["bal"])


def latest_per_key_hot_key(spark, sf_dir):
    return dedup.latest_per_key(fixtures.dirty_lines(spark, sf_dir), ["k"], ["l_shipdate"])


# ---------------------------------------------------------------- gates


def gate_count(spark, sf_dir):
    return quality.gate_count(fixtures.dirty(spark, sf_dir), GATES).report


def gate_schema(spark, sf_dir):
    stamped = history.stamp_open(fixtures.dirty(spark, sf_dir).drop("nm"), MERGE)
    return quality.gate_schema(stamped, GATES).report


def gate_nulls(spark, sf_dir):
    return quality.gate_nulls(fixtures.dirty(spark, sf_dir), GATES).report


def gate_duplicates(spark, sf_dir):
    return quality.gate_duplicates(fixtures.dirty(spark, sf_dir), GATES).report


def gate_chain(spark, sf_dir):
    return quality.gate_chain(fixtures.dirty(spark, sf_dir), GATES).data


def gate_chain_report(spark, sf_dir):
    return quality.gate_chain(fixtures.dirty(spark, sf_dir), GATES).report


def gate_chain_from_options(spark, sf_dir):
    return quality.gate_chain(fixtures.dirty(spark, sf_dir), GateConfig.from_options(OPTIONS)).data


def gate_drift_differences(spark, sf_dir):
    """Customers against themselves a load later: balances grown, most segments lost, long names."""
    before = fixtures.dirty(spark, sf_dir)
    now = before.withColumns(
        {
            "bal": F.col("bal") * 3,
            "seg": F.when(F.col("k") % 4 == 0, F.col("seg")),
            "nm": F.concat("nm", F.lit(" and heirs")),
        }
    )
    found = drift.differences(spark, drift.profile(before, DRIFT.columns), drift.profile(now, DRIFT.columns), DRIFT)
    return drift.difference_table(spark, found).select("column_name", "n_before", "n_now", "null_before", "null_now", "passed")


def gate_drift_report(spark, sf_dir):
    """The order lines of one half of the suppliers against those of the other half."""
    lines = fixtures.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_shipdate", "l_returnflag")
    config = DriftConfig("l_quantity,l_shipdate,l_returnflag")
    half = lambda i: lines.where(F.col("l_suppkey") % 2 == i)
    return drift.gate_drift(half(1), drift.profile(half(0), config.columns), config).report


# ---------------------------------------------------------------- versioned rows


def _stamp(open_end):
    def query(spark, sf_dir):
        config = replace(MERGE, open_end=open_end)
        stamped = history.stamp_open(_customers(spark, sf_dir), config)
        # As text: the sentinel is beyond what pandas can hold.
        return stamped.withColumn("end_text", F.col("end_date").cast("string")).drop("end_date")

    return query


def _encode(open_end):
    def query(spark, sf_dir):
        config = replace(MERGE, open_end=open_end)
        encoded = history.encode_open(_whole_hist(spark, sf_dir), config)
        decoded = history.decode_open(encoded, config)
        return decoded.withColumn("was_open", F.col("end_date").isNull())

    return query


def current_rows(spark, sf_dir):
    return history.current_rows(_whole_hist(spark, sf_dir), MERGE)


def closed_rows(spark, sf_dir):
    return history.closed_rows(_whole_hist(spark, sf_dir), MERGE)


def new_keys(spark, sf_dir):
    return history.new_keys(_delta(spark, sf_dir), _hist(spark, sf_dir), MERGE)


def new_keys_hot_key(spark, sf_dir):
    hist, delta = fixtures.order_hist(spark, sf_dir), fixtures.order_delta(spark, sf_dir)
    # without its own past and open version, the hot key is new
    return history.new_keys(delta, hist.where("k <> '0'"), MERGE, hot=history.frequent_keys(delta, MERGE))


def changed_rows_strict(spark, sf_dir):
    config = replace(MERGE, null_safe=False)
    return history.changed_rows(_delta(spark, sf_dir), _hist(spark, sf_dir), config)


def changed_rows_null_safe(spark, sf_dir):
    return history.changed_rows(_delta(spark, sf_dir), _hist(spark, sf_dir), MERGE)


def changed_rows_trimmed(spark, sf_dir):
    config = replace(MERGE, tracked=("seg",), null_safe=False, trim=True)
    return history.changed_rows(_delta(spark, sf_dir), _hist(spark, sf_dir), config)


def rows_to_close(spark, sf_dir):
    return history.rows_to_close(_hist(spark, sf_dir), _delta(spark, sf_dir), MERGE)


def rows_to_close_changed(spark, sf_dir):
    return history.rows_to_close(_hist(spark, sf_dir), _delta(spark, sf_dir), MERGE, only_changed=True)


def carry_forward(spark, sf_dir):
    return history.carry_forward(_hist(spark, sf_dir), _delta(spark, sf_dir), MERGE)


def union_by_position(spark, sf_dir):
    hist = _whole_hist(spark, sf_dir)
    current, closed = history.current_rows(hist, MERGE), history.closed_rows(hist, MERGE)
    return history.union_by_position([current, closed, _delta(spark, sf_dir), new_keys(spark, sf_dir)])


def union_by_name(spark, sf_dir):
    hist, delta = _whole_hist(spark, sf_dir), _delta(spark, sf_dir)
    current, closed = history.current_rows(hist, MERGE), history.closed_rows(hist, MERGE)
    return history.union_by_name([current, closed, delta.select(*reversed(delta.columns))])


def _numbered(spark, hist):
    ordered = history.order_history(hist, MERGE)
    return ordering.number_rows(ordered, "position", f"{work_folder(spark)}/ordered")


def history_order(spark, sf_dir):
    return _numbered(spark, _whole_hist(spark, sf_dir))


def history_order_hot_key(spark, sf_dir):
    return _numbered(spark, fixtures.order_hist(spark, sf_dir))


def scd2_changed_only(spark, sf_dir):
    hist, delta = _hist(spark, sf_dir), _delta(spark, sf_dir)
    return history.merge_changed_only(hist, delta, MERGE)


def scd2_changed_only_small_delta(spark, sf_dir):
    hist, delta = _hist(spark, sf_dir), _delta(spark, sf_dir)
    return history.merge_changed_only(hist, delta, MERGE, delta_bytes=history.delta_size(delta))


def _settled_orders(spark, sf_dir):
    return history.settle(fixtures.order_delta(spark, sf_dir), MERGE, ["start_date"])


def scd2_changed_only_hot_key(spark, sf_dir):
    hist, delta = fixtures.order_hist(spark, sf_dir), _settled_orders(spark, sf_dir)
    return history.merge_changed_only(hist, delta, MERGE)


def scd2_reversion_all(spark, sf_dir):
    return history.merge_reversion_all(_hist(spark, sf_dir), _delta(spark, sf_dir), MERGE)


def scd2_reversion_all_hot_key(spark, sf_dir):
    hist, delta = fixtures.order_hist(spark, sf_dir), _settled_orders(spark, sf_dir)
    return history.merge_reversion_all(hist, delta, MERGE)


def open_key_violations(spark, sf_dir):
    added = fixtures.order_hist(spark, sf_dir).unionByName(fixtures.order_delta(spark, sf_dir))
    return history.open_key_violations(added, MERGE)


# ---------------------------------------------------------------- jobs


def airline_style_load(spark, sf_dir):
    folder = work_folder(spark)
    extract = fixtures.write_extract(fixtures.dirty(spark, sf_dir), f"{folder}/extract")
    config = DimensionLoadConfig(
        extract=ExtractConfig("k,nm,seg,nat", f"{DIRTY_SCHEMA}, {AUDIT_SCHEMA}", fixtures.AUDIT),
        stamp=StampConfig(fixtures.AS_OF, open_end="horizon"),
        sink=Sink(f"{folder}/customer", partition_by="seg"),
    )
    return jobs.dimension_load(spark, extract, config).table


def _base_extract(spark, sf_dir):
    return history.current_rows(_hist(spark, sf_dir), MERGE).select("k", "seg", "nat")


def _first_extract(spark, sf_dir):
    """The delta, and an older row for one nation's customers, which the load must leave out."""
    updated = F.to_timestamp_ntz(F.lit(fixtures.AS_OF))
    rows = fixtures.delta(spark, sf_dir).select("k", "seg", "nat").withColumn(fixtures.AUDIT[1], updated)
    older = rows.where("nat = 7").withColumns({"seg": F.lit("ZZZ"), fixtures.AUDIT[1]: updated - F.expr("INTERVAL '1' DAY")})
    return rows.unionByName(older).withColumn(fixtures.AUDIT[0], updated).select("k", "seg", "nat", *fixtures.AUDIT)


def _second_extract(spark, sf_dir):
    customers = _customers(spark, sf_dir)
    return customers.withColumn("seg", F.when(F.col("nat") < 12, "SECOND").otherwise(F.col("seg")))


def _load_config(mode):
    gates = GateConfig(columns="k,seg,nat", schema_check=True)
    return HistoryLoadConfig(
        extract=ExtractConfig("k,nat", f"{VERSION}, {AUDIT_SCHEMA}", fixtures.AUDIT, gates),
        merge=MERGE,
        latest_order=fixtures.AUDIT[1],
        mode=mode,
        buckets=16,
    )


def _first_load(spark, sf_dir, folder, config):
    base = fixtures.write_extract(_base_extract(spark, sf_dir), f"{folder}/base")
    delta = fixtures.write_extract(_first_extract(spark, sf_dir), f"{folder}/first")
    base_as_of = datetime.fromisoformat(fixtures.BASE_AS_OF)
    return jobs.first_history_load(spark, base, delta, f"{folder}/history", config, base_as_of).table


def first_history_load(spark, sf_dir):
    return _first_load(spark, sf_dir, work_folder(spark), _load_config("reversion_all"))


def first_changed_only_load(spark, sf_dir):
    return _first_load(spark, sf_dir, work_folder(spark), _load_config("changed_only"))


def _both_loads(spark, sf_dir, mode):
    folder, config = work_folder(spark), _load_config(mode)
    _first_load(spark, sf_dir, folder, config)
    second = fixtures.write_extract(_second_extract(spark, sf_dir), f"{folder}/second")
    later = replace(config, merge=replace(MERGE, as_of=SECOND_AS_OF))
    root = f"{folder}/history"
    jobs.incremental_history_load(spark, second, root, later, 2)
    # The same load again finds its version published and changes nothing.
    return jobs.incremental_history_load(spark, second, root, later, 2).table


def incremental_history_load(spark, sf_dir):
    return _both_loads(spark, sf_dir, "changed_only")


def incremental_reversion_load(spark, sf_dir):
    return _both_loads(spark, sf_dir, "reversion_all")


def _later(config, **more):
    return replace(config, merge=replace(MERGE, as_of=SECOND_AS_OF), **more)


def history_load_into_connector(spark, sf_dir):
    """Both loads write their result through a connector, the second over the first."""
    from histload.sources import manifest_table

    folder = work_folder(spark)
    sink = Sink(f"{folder}/sink", manifest_table.register(spark))
    config = replace(_load_config("changed_only"), sink=sink)
    _first_load(spark, sf_dir, folder, config)
    second = fixtures.write_extract(_second_extract(spark, sf_dir), f"{folder}/second")
    jobs.incremental_history_load(spark, second, f"{folder}/history", _later(config), 2)
    return readers.read_table(spark, sink.path, sink.fmt)


def adopted_history_load(spark, sf_dir):
    """A load that goes on from a history taken over, sentinels included."""
    folder = work_folder(spark)
    config = replace(_load_config("changed_only"), merge=STORED)
    jobs.adopt_history(fixtures.whole_hist(spark, sf_dir), f"{folder}/history", config)
    second = fixtures.write_extract(_second_extract(spark, sf_dir), f"{folder}/second")
    later = replace(config, merge=replace(STORED, as_of=SECOND_AS_OF))
    return history.decode_open(jobs.incremental_history_load(spark, second, f"{folder}/history", later, 1).table, STORED)


def evolved_history_load(spark, sf_dir):
    """The second extract has a column more, and a wider one."""
    folder, config = work_folder(spark), _load_config("changed_only")
    _first_load(spark, sf_dir, folder, config)
    names = fixtures.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("nm"))
    second = fixtures.write_extract(_second_extract(spark, sf_dir).join(names, "k"), f"{folder}/second")
    wider = replace(config.extract, schema=f"k BIGINT, seg STRING, nat BIGINT, nm STRING, {AUDIT_SCHEMA}")
    return jobs.incremental_history_load(spark, second, f"{folder}/history", _later(config, extract=wider), 2).table


def left_out_fates(spark, sf_dir):
    """What a load leaves out, and why."""
    folder = work_folder(spark)
    extract = fixtures.write_extract(fixtures.dirty(spark, sf_dir), f"{folder}/extract")
    config = DimensionLoadConfig(
        extract=ExtractConfig("k,nm,seg,nat", f"{DIRTY_SCHEMA}, {AUDIT_SCHEMA}", fixtures.AUDIT),
        stamp=StampConfig(fixtures.AS_OF),
        sink=Sink(f"{folder}/customer"),
        dedup="latest",
        latest_key="k",
        latest_order="bal",
    )
    return jobs.dimension_load(spark, extract, config).left_out.drop(*fixtures.AUDIT)


def scd2_changed_only_filtered_delta(spark, sf_dir):
    """A delta too large to broadcast, whose keys' filter is not."""
    delta = _delta(spark, sf_dir)
    size = history.delta_size(delta)
    return history.merge_changed_only(_whole_hist(spark, sf_dir), delta, replace(MERGE, broadcast_bytes=size // 2), size)


def stamp_open_now(spark, sf_dir):
    """Rows stamped without a load time start at the query's own."""
    asked = F.lit(str(datetime.now())).cast("timestamp_ntz")
    stamped = history.stamp_open(_customers(spark, sf_dir), StampConfig())
    start = F.col("start_date")
    return stamped.groupBy(F.col("nat")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(start).alias("n_starts"),
        F.every(start >= asked).alias("not_before"),
        F.every(start == F.localtimestamp()).alias("is_now"),
    )


QUERIES = {
    q.__name__: q
    for q in (
        rows_scan_codes,
        csv_typed_landing,
        csv_blank_fields,
        csv_inferred_landing,
        csv_string_scan,
        parquet_roundtrip,
        table_scan_view,
        sink_partitioned_snapshot,
        sink_plain_snapshot,
        staged_republish,
        not_null_all,
        rejected_rows,
        not_blank_all,
        drop_audit_columns,
        dedup_rows,
        dedup_keys,
        latest_per_key,
        latest_per_key_hot_key,
        null_profile,
        row_count_before_after,
        sum_by_key,
        sum_by_key_hot_key,
        fill_nulls,
        current_rows,
        closed_rows,
        new_keys,
        new_keys_hot_key,
        changed_rows_strict,
        changed_rows_null_safe,
        changed_rows_trimmed,
        rows_to_close,
        rows_to_close_changed,
        carry_forward,
        union_by_position,
        union_by_name,
        history_order,
        history_order_hot_key,
        scd2_changed_only,
        scd2_changed_only_small_delta,
        scd2_changed_only_hot_key,
        scd2_reversion_all,
        scd2_reversion_all_hot_key,
        open_key_violations,
        gate_count,
        gate_schema,
        gate_nulls,
        gate_duplicates,
        gate_chain,
        gate_chain_report,
        gate_chain_from_options,
        gate_drift_differences,
        gate_drift_report,
        airline_style_load,
        first_history_load,
        first_changed_only_load,
        incremental_history_load,
        incremental_reversion_load,
        history_load_into_connector,
        adopted_history_load,
        evolved_history_load,
        left_out_fates,
        scd2_changed_only_filtered_delta,
        stamp_open_now,
    )
}
QUERIES["load_date_text"] = load_dates
QUERIES["parse_timestamp"] = parse_timestamps
for _end in ("null", "sentinel", "horizon"):
    QUERIES[f"stamp_open_{_end}"] = _stamp(_end)
for _end in ("sentinel", "horizon"):
    QUERIES[f"encode_open_{_end}"] = _encode(_end)
