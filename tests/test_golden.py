"""Small cases whose results are worked out by hand: berths of harbours, the ships in them and their dues."""

from datetime import datetime

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
from histload.operators import dedup, history, quality
from histload.sources import readers

CALLS = "ship STRING, flag STRING, tons BIGINT, eta STRING"
# Every pattern of a null, a blank or neither in flag and eta, and a tie that tons must break.
EXPECTED_CALLS = [
    ("Auk", "NO", 900, "06:10"),
    ("Brent", None, 40, "06:10"),
    ("Coot", "", 40, "07:00"),
    ("Dunlin", "DK", 310, None),
    ("Eider", None, 75, None),
    ("Fulmar", "  ", None, "23:59"),
    ("Gannet", "IS", 12, "11:45"),
    ("Gannet", "IS", 15, "11:45"),
    ("Gannet", "IS", 15, "11:45"),
]

BERTHS = "harbour STRING, berth INT, ship STRING, dues INT, start_date TIMESTAMP_NTZ, end_date TIMESTAMP_NTZ"
MAY, JUNE, JULY = datetime(2019, 5, 4, 6), datetime(2019, 6, 1, 18, 30), datetime(2019, 7, 9, 12)
BERTH = MergeConfig("harbour,berth", "ship,dues", JULY)


@pytest.fixture(scope="module")
def calls(spark):
    return readers.rows(spark, EXPECTED_CALLS, CALLS)


def test_null_and_blank_filters(calls):
    whole = quality.not_null_all(calls, ["flag", "eta"])
    assert sorted(r.ship for r in whole.collect()) == ["Auk", "Coot", "Fulmar", "Gannet", "Gannet", "Gannet"]
    assert sorted(r.ship for r in quality.rejected_rows(calls, ["flag", "eta"]).collect()) == ["Brent", "Dunlin", "Eider"]
    written = quality.not_blank_all(calls, ["flag", "eta"])
    assert sorted(r.ship for r in written.collect()) == ["Auk", "Gannet", "Gannet", "Gannet"]


def test_three_ways_to_drop_copies(calls):
    assert dedup.dedup_rows(calls).count() == 8
    assert dedup.dedup_keys(calls, ["flag", "eta"]).count() == 7
    latest = {(r.eta, r.ship, r.tons) for r in dedup.latest_per_key(calls, ["eta"], ["tons"]).collect()}
    assert latest == {
        ("06:10", "Auk", 900),
        ("07:00", "Coot", 40),
        (None, "Dunlin", 310),
        ("23:59", "Fulmar", None),
        ("11:45", "Gannet", 15),
    }
    with pytest.raises(ValueError):
        dedup.latest_per_key(calls, [], ["tons"])


def berths(spark, *rows):
    return readers.rows(spark, rows, BERTHS)


@pytest.fixture
def history_and_delta(spark):
    hist = berths(
        spark,
        ("Leith", 1, "Auk", 50, MAY, None),
        ("Leith", 2, "Brent", 20, MAY, JUNE),
        ("Leith", 2, "Coot", 20, JUNE, None),
        ("Leith", 3, "Dunlin", None, JUNE, None),
        ("Oban", 1, "Eider", 35, MAY, None),
        ("Oban", 2, "Fulmar", 5, MAY, JUNE),  # closed only
        ("Oban", None, "Gannet", 9, MAY, None),
    )
    delta = berths(
        spark,
        ("Leith", 1, "Auk", 50, JULY, None),  # as it was
        ("Leith", 2, "Coot", None, JULY, None),  # dues become null
        ("Leith", 3, "Dunlin", 8, JULY, None),  # and appear
        ("Oban", 2, "Fulmar", 5, JULY, None),  # comes back
        ("Wick", 2, "Heron", 7, JULY, None),
        (None, 2, "Ibis", 7, JULY, None),
    )
    return hist, delta


def places(df):
    return sorted(((r.harbour or "", r.berth or 0, r.ship) for r in df.collect()))


def test_change_detection(history_and_delta):
    hist, delta = history_and_delta
    assert places(history.new_keys(delta, hist, BERTH)) == [("", 2, "Ibis"), ("Wick", 2, "Heron")]
    assert places(history.changed_rows(delta, hist, BERTH)) == [("Leith", 2, "Coot"), ("Leith", 3, "Dunlin")]
    strict = MergeConfig("harbour,berth", "ship,dues", JULY, null_safe=False)
    assert places(history.changed_rows(delta, hist, strict)) == []
    closing = history.rows_to_close(hist, delta, BERTH)
    assert places(closing) == [("Leith", 1, "Auk"), ("Leith", 2, "Coot"), ("Leith", 3, "Dunlin")]
    assert {r.end_date for r in closing.collect()} == {JULY}
    assert len(places(history.carry_forward(hist, delta, BERTH))) == 5


@pytest.mark.parametrize("how", [{}, {"delta_bytes": 1000}])
def test_merges(history_and_delta, how):
    hist, delta = history_and_delta
    merged = history.merge_changed_only(hist, delta, BERTH, **how)
    found = [(r.harbour, r.berth, r.ship, r.dues, r.start_date, r.end_date) for r in history.order_history(merged, BERTH).collect()]
    assert found == [
        ("Leith", 1, "Auk", 50, MAY, None),
        ("Leith", 2, "Brent", 20, MAY, JUNE),
        ("Leith", 2, "Coot", 20, JUNE, JULY),
        ("Leith", 2, "Coot", None, JULY, None),
        ("Leith", 3, "Dunlin", None, JUNE, JULY),
        ("Leith", 3, "Dunlin", 8, JULY, None),
        ("Oban", 1, "Eider", 35, MAY, None),
        ("Oban", 2, "Fulmar", 5, MAY, JUNE),
        ("Oban", 2, "Fulmar", 5, JULY, None),
        ("Oban", None, "Gannet", 9, MAY, None),
        ("Wick", 2, "Heron", 7, JULY, None),
        (None, 2, "Ibis", 7, JULY, None),
    ]
    everything = history.merge_reversion_all(hist, delta, BERTH, **how)
    assert everything.count() == 13
    assert places(everything.where(F.col("end_date") == JULY)) == [("Leith", 1, "Auk"), ("Leith", 2, "Coot"), ("Leith", 3, "Dunlin")]


SETTINGS = {
    # The option names users have in their settings files.
    "count_check": "Y",
    "ccColumns_schema_validation_flag": "y",
    "ccColumns_schema_validation": "ship,flag,tons,eta",
    "null_check": "Y",
    "null_check_columns": "FLAG, eta",
    "duplicate_check": "Y",
    "duplicate_check_columns": "eta",
    "duplicate_check_columns_order_by_column": "tons",
}


def test_gate_chain(calls):
    gated = quality.gate_chain(calls, GateConfig.from_options(SETTINGS))
    assert sorted(r.ship for r in gated.data.collect()) == ["Auk", "Coot", "Fulmar", "Gannet"]
    assert [(r.gate, r.passed, r.rows_in, r.rows_out) for r in gated.report.collect()] == [
        ("count", True, 9, 9),
        ("schema", True, 9, 9),
        ("nulls", True, 9, 6),
        ("duplicates", True, 6, 4),
    ]


def test_each_failed_gate_stops(calls):
    def run(df, **other):
        return quality.gate_chain(df, GateConfig.from_options(SETTINGS | other))

    with pytest.raises(quality.GateFailure, match="count"):
        run(calls.where(F.lit(False)))
    with pytest.raises(quality.GateFailure, match="schema: missing: tons"):
        run(calls.drop("tons"))
    with pytest.raises(quality.GateFailure, match="nulls: none of 2 rows"):
        run(calls.where("ship in ('Brent', 'Eider')"))
    for setting in ("null_check_columns", "duplicate_check_columns", "duplicate_check_columns_order_by_column"):
        with pytest.raises(quality.GateFailure, match="no such column: flagg"):
            run(calls, **{setting: "flagg"})


def test_gates_off(calls):
    off = GateConfig.from_options({"count_check": "N"})
    assert quality.gate_chain(calls.where(F.lit(False)), off).data.isEmpty()
    assert [r.detail for r in quality.gate_chain(calls, off).report.collect()] == ["off"] * 4


def test_config_is_checked():
    extract = ExtractConfig("a", "a INT, b INT")
    merge = MergeConfig("a", "b", JULY)
    for wrong in (
        lambda: GateConfig(null_check=True),
        lambda: MergeConfig("", "a"),
        lambda: MergeConfig("a", "a"),
        lambda: MergeConfig("a", "b", open_end="never"),
        lambda: StampConfig(JULY, start="x", end="x"),
        lambda: HistoryLoadConfig(extract, MergeConfig("a", "b"), "a"),  # no as_of
        lambda: HistoryLoadConfig(ExtractConfig("b", "a INT, b INT"), merge, "a"),  # key may be null
        lambda: HistoryLoadConfig(extract, merge, ""),  # no order
        lambda: HistoryLoadConfig(extract, merge, "a", mode="all"),
        lambda: HistoryLoadConfig(extract, merge, "a", buckets=0),
        lambda: DimensionLoadConfig(extract, StampConfig(), Sink("x")),  # no as_of
        lambda: DimensionLoadConfig(extract, StampConfig(JULY), Sink("x"), dedup="latest"),
        lambda: DimensionLoadConfig(extract, StampConfig(JULY), Sink("x"), latest_key="a", latest_order="b"),
    ):
        with pytest.raises(ValueError):
            wrong()
