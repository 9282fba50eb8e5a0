"""What every merge must keep true, and merges against a plain computation over repeating keys."""

from collections import Counter
from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from histload.config import MergeConfig
from histload.functions import as_of_column
from histload.operators import history
from histload.plans import fixtures, queries
from histload.sources import readers

SCHEMA = "k BIGINT, seg STRING, nat INT, start_date TIMESTAMP_NTZ, end_date TIMESTAMP_NTZ"
AS_OF = datetime(2022, 2, 1)
OLD, OLDER = datetime(2021, 12, 31), datetime(2020, 12, 31)
MERGE = MergeConfig("k", "seg,nat", AS_OF)
WAYS = {
    "one join": {},
    "small delta": {"delta_bytes": 0},
}


# The history and delta of FIXTURES.md, section 4, whose results are known for sf0.01.
FIXTURE_HIST = """
SELECT c_custkey AS k, c_mktsegment AS seg, c_nationkey AS nat,
       TIMESTAMP_NTZ '2021-10-10 07:15:00' AS start_date, TIMESTAMP_NTZ '9999-12-31 23:59:59' AS end_date
FROM {customer} WHERE c_custkey % 10 <> 9
UNION ALL
SELECT c_custkey, 'LEGACY', c_nationkey,
       TIMESTAMP_NTZ '2020-03-03 03:30:00', TIMESTAMP_NTZ '2021-10-10 07:15:00'
FROM {customer} WHERE c_custkey % 4 = 1"""
FIXTURE_DELTA = """
SELECT c_custkey AS k,
       CASE WHEN c_custkey % 3 = 0 THEN 'REVISED'
            WHEN c_custkey % 5 = 0 THEN NULL
            WHEN c_custkey % 11 = 0 THEN concat(' ', c_mktsegment, ' ')
            ELSE c_mktsegment END AS seg,
       c_nationkey AS nat,
       TIMESTAMP_NTZ '2022-02-01 00:00:00' AS start_date, TIMESTAMP_NTZ '9999-12-31 23:59:59' AS end_date
FROM {customer} WHERE c_custkey % 2 = 1"""


@pytest.fixture(scope="module")
def known(spark, sf_dir):
    folder = Path(sf_dir).parent / "sf0.01"  # the size the counts below are known for
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    tables = [spark.sql(text, customer=customer) for text in (FIXTURE_HIST, FIXTURE_DELTA)]
    return [history.decode_open(t, queries.STORED) for t in tables]


@pytest.fixture(scope="module", params=["known", "registered"])
def inputs(request, known, spark, sf_dir):
    if request.param == "known":
        return known
    return queries._hist(spark, sf_dir), queries._delta(spark, sf_dir)


def test_known_counts(known):
    hist, delta = known
    strict = replace(MERGE, null_safe=False)
    trimming = replace(strict, tracked=("seg",), trim=True)
    assert hist.count() == 1725 and delta.count() == 750
    assert history.new_keys(delta, hist, MERGE).count() == 75
    assert history.changed_rows(delta, hist, strict).count() == 228
    assert history.changed_rows(delta, hist, trimming).count() == 200
    assert history.changed_rows(delta, hist, MERGE).count() == 328
    assert history.rows_to_close(hist, delta, MERGE).count() == 600
    changed = history.merge_changed_only(hist, delta, MERGE)
    everything = history.merge_reversion_all(hist, delta, MERGE)
    assert changed.count() == 2203 and everything.count() == 2475
    assert history.merge_changed_only(changed, delta, MERGE).count() == 2203
    assert history.merge_reversion_all(everything, delta, MERGE).count() == 3225


@pytest.mark.parametrize("merge", [history.merge_changed_only, history.merge_reversion_all])
def test_at_most_one_open_version_and_no_overlap(inputs, merge):
    merged = merge(*inputs, MERGE)
    assert history.open_key_violations(merged, MERGE).isEmpty()
    a, b = merged.alias("a"), merged.alias("b")
    overlap = a.join(b, "k").where(
        (F.col("a.start_date") < F.col("b.start_date"))
        & (F.coalesce("a.end_date", F.lit("9999-12-31").cast("timestamp_ntz")) > F.col("b.start_date"))
    )
    assert overlap.isEmpty()


def test_ways_to_merge_agree(inputs):
    hist, delta = inputs
    results = [
        Counter(map(tuple, history.merge_changed_only(hist, delta, MERGE, **way).collect()))
        for way in WAYS.values()
    ]
    assert results[0] == results[1]


def test_change_detection_with_a_small_delta_agrees(inputs):
    hist, delta = inputs
    size = history.delta_size(delta)

    def detected(n_bytes):
        return [
            history.new_keys(delta, hist, MERGE, n_bytes),
            history.changed_rows(delta, hist, MERGE, n_bytes),
            history.rows_to_close(hist, delta, MERGE, False, n_bytes),
            history.rows_to_close(hist, delta, MERGE, True, n_bytes),
            history.carry_forward(hist, delta, MERGE, n_bytes),
        ]

    for plain, small in zip(detected(None), detected(size)):
        assert Counter(map(tuple, plain.collect())) == Counter(map(tuple, small.collect()))


@pytest.mark.parametrize("way", WAYS)
def test_replay_changes_nothing(inputs, way):
    hist, delta = inputs
    once = history.merge_changed_only(hist, delta, MERGE, **WAYS[way])
    twice = history.merge_changed_only(once, delta, MERGE, **WAYS[way])
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_carried_closed_and_added_make_up_the_merge(inputs):
    hist, delta = inputs
    opened = delta.join(history.current_rows(hist, MERGE), "k", "left_anti")
    parts = [
        history.carry_forward(hist, delta, MERGE),
        history.rows_to_close(hist, delta, MERGE, only_changed=True),
        history.changed_rows(delta, hist, MERGE),
        opened.select(*delta.columns),
    ]
    whole = history.union_by_name(parts)
    merged = history.merge_changed_only(hist, delta, MERGE)
    assert whole.exceptAll(merged).isEmpty() and merged.exceptAll(whole).isEmpty()


@pytest.mark.parametrize("open_end", ["null", "sentinel", "horizon"])
def test_encodings_round_trip(inputs, open_end):
    hist, _ = inputs
    config = replace(MERGE, open_end=open_end)
    encoded = history.encode_open(hist, config)
    assert encoded.where("end_date IS NULL").isEmpty() == (open_end != "null")
    decoded = history.decode_open(encoded, config)
    assert decoded.exceptAll(hist).isEmpty() and decoded.count() == hist.count()


def test_union_by_name_refuses_drift(inputs):
    hist, delta = inputs
    with pytest.raises(Exception, match="(?i)column"):
        history.union_by_name([hist, delta.drop("nat")]).count()


# ---------------------------------------------------------------- against a plain computation


def _differs(a, b, null_safe):
    pairs = list(zip(a[1:3], b[1:3]))
    if null_safe:
        return any(x != y for x, y in pairs)
    return any(x is not None and y is not None and x != y for x, y in pairs)


def _meets(h, d):
    return h[4] is None and h[0] is not None and h[0] == d[0]


def plain_changed_only(hist, delta, null_safe):
    out = []
    for h in hist:
        hit = any(_meets(h, d) and _differs(h, d, null_safe) for d in delta)
        out.append((*h[:4], AS_OF if hit else h[4]))
    for d in delta:
        met = [h for h in hist if _meets(h, d)]
        if not met or any(_differs(h, d, null_safe) for h in met):
            out.append(d)
    return Counter(out)


def plain_reversion_all(hist, delta):
    closed = [(*h[:4], AS_OF if any(_meets(h, d) for d in delta) else h[4]) for h in hist]
    return Counter(closed + delta)


keys = st.one_of(st.none(), st.integers(0, 3))
texts = st.sampled_from([None, "", "x", "y"])
numbers = st.sampled_from([None, 1, 2])
ends = st.sampled_from([None, None, OLD])
hist_rows = st.lists(st.tuples(keys, texts, numbers, st.just(OLDER), ends), max_size=8)
delta_rows = st.lists(st.tuples(keys, texts, numbers, st.just(AS_OF), st.none()), max_size=8)
slow = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def _sound(rows):
    """Rows with at most one open version of each whole key."""
    seen, out = set(), []
    for r in rows:
        if r[4] is None and r[0] is not None:
            if r[0] in seen:
                continue
            seen.add(r[0])
        out.append(r)
    return out


@slow
@given(hist=hist_rows, delta=delta_rows, null_safe=st.booleans(), small=st.booleans())
def test_merges_against_a_plain_computation(spark, hist, delta, null_safe, small):
    hist, delta = _sound(hist), _sound(delta)
    config = replace(MERGE, null_safe=null_safe)
    h, d = readers.rows(spark, hist, SCHEMA), readers.rows(spark, delta, SCHEMA)
    size = 0 if small else None
    changed = history.merge_changed_only(h, d, config, size)
    assert Counter(map(tuple, changed.collect())) == plain_changed_only(hist, delta, null_safe)
    everything = history.merge_reversion_all(h, d, config, size)
    assert Counter(map(tuple, everything.collect())) == plain_reversion_all(hist, delta)


@slow
@given(hist=hist_rows, delta=delta_rows, null_safe=st.booleans())
def test_change_detection_with_repeating_and_missing_keys(spark, hist, delta, null_safe):
    config = replace(MERGE, null_safe=null_safe)
    h, d = readers.rows(spark, hist, SCHEMA), readers.rows(spark, delta, SCHEMA)
    differing = [x for x in delta if any(_meets(y, x) and _differs(y, x, null_safe) for y in hist)]
    assert Counter(map(tuple, history.changed_rows(d, h, config).collect())) == Counter(differing)
    new = [x for x in delta if not any(y[0] is not None and y[0] == x[0] for y in hist)]
    assert Counter(map(tuple, history.new_keys(d, h, config).collect())) == Counter(new)


def test_settled_delta_and_repeated_keys(spark):
    rows = [(1, "a", 1, OLD, None), (1, "b", 2, OLDER, None), (None, "c", 1, OLD, None), (None, "c", 1, OLD, None)]
    delta = readers.rows(spark, rows, SCHEMA)
    with pytest.raises(history.Unsound, match="delta"):
        history.check_one_row_per_key(delta, MERGE, "delta")
    settled = history.settle(delta, MERGE, ["start_date"])
    history.check_one_row_per_key(settled, MERGE, "delta")
    assert Counter(map(tuple, settled.collect())) == Counter([rows[0], rows[2], rows[3]])


def test_trimmed_text_is_no_change(spark):
    hist = readers.rows(spark, [(1, "rain", 1, OLD, None)], SCHEMA)
    delta = readers.rows(spark, [(1, " rain ", 1, AS_OF, None)], SCHEMA)
    assert history.changed_rows(delta, hist, MERGE).count() == 1
    trimming = MergeConfig("k", "seg", AS_OF, trim=True)
    assert history.changed_rows(delta, hist, trimming).isEmpty()
    for way in WAYS.values():
        assert history.merge_changed_only(hist, delta, trimming, **way).count() == 1


def test_two_part_key(spark):
    schema = "a STRING, b INT, v STRING, start_date TIMESTAMP_NTZ, end_date TIMESTAMP_NTZ"
    config = MergeConfig("a,b", "v", AS_OF)
    hist = readers.rows(spark, [("x", 1, "p", OLD, None), ("x", 2, "p", OLD, None)], schema)
    delta = readers.rows(spark, [("x", 1, "q", AS_OF, None), ("x", None, "q", AS_OF, None)], schema)
    for way in WAYS.values():
        merged = history.merge_changed_only(hist, delta, config, **way)
        assert Counter((r.a, r.b, r.v, r.end_date) for r in merged.collect()) == Counter(
            [("x", 1, "p", AS_OF), ("x", 1, "q", None), ("x", 2, "p", None), ("x", None, "q", None)]
        )


def test_keys_and_values_of_other_integer_types(spark):
    narrow = SCHEMA.replace("k BIGINT", "k INT").replace("nat INT", "nat SMALLINT")
    hist_rows, delta_rows = [(1, "x", 1, OLD, None), (2, "x", 1, OLD, None)], [(1, "x", 2, AS_OF, None)]
    expected = Counter(
        [(1, "x", 1, OLD, AS_OF), (1, "x", 2, AS_OF, None), (2, "x", 1, OLD, None)]
    )
    for one, other in ((SCHEMA, narrow), (narrow, SCHEMA)):
        hist, delta = readers.rows(spark, hist_rows, one), readers.rows(spark, delta_rows, other)
        for way in WAYS.values():
            merged = history.merge_changed_only(hist, delta, MERGE, **way)
            assert Counter(map(tuple, merged.collect())) == expected
            merged = history.merge_reversion_all(hist, delta, MERGE, **way)
            assert Counter(map(tuple, merged.collect())) == expected


def test_zoned_timestamps_with_the_sentinel(spark):
    zoned = SCHEMA.replace("TIMESTAMP_NTZ", "TIMESTAMP")
    config = replace(MERGE, open_end="sentinel")
    ends = "TIMESTAMP '9999-12-31 23:59:59'"
    hist = readers.rows(spark, [(1, "x", 1, OLD, None), (2, "x", 1, OLDER, OLD)], zoned)
    hist = hist.withColumn("end_date", F.coalesce("end_date", F.expr(ends)))
    delta = readers.rows(spark, [(1, "y", 1, None, None)], SCHEMA).select("k", "seg", "nat")
    decoded = history.decode_open(hist, config)
    assert [r.k for r in history.current_rows(decoded, config).collect()] == [1]
    opened = history.decode_open(history.stamp_open(delta, config), config)
    for way in WAYS.values():
        merged = history.merge_changed_only(decoded, opened, config, **way)
        assert dict(merged.dtypes)["end_date"] == "timestamp"
        encoded = history.encode_open(merged, config)
        found = encoded.select("k", "seg", F.col("end_date").cast("string").alias("e")).collect()
        assert Counter(map(tuple, found)) == Counter(
            [
                (1, "x", "2022-02-01 00:00:00"),
                (1, "y", "9999-12-31 23:59:59"),
                (2, "x", "2021-12-31 00:00:00"),
            ]
        )


def test_delta_size_bounds_the_texts(spark, sf_dir):
    delta = fixtures.delta(spark, sf_dir)
    text = delta.agg(F.sum(F.octet_length("seg"))).first()[0]
    assert history.delta_size(delta) > text
    assert history.delta_size(delta.where(F.lit(False))) == 0


def test_names_with_dots(spark):
    schema = "`a.k` BIGINT, `v.1` STRING, start_date TIMESTAMP_NTZ, end_date TIMESTAMP_NTZ"
    config = MergeConfig("a.k", "v.1", AS_OF)
    hist = readers.rows(spark, [(1, "x", OLD, None)], schema)
    delta = readers.rows(spark, [(1, "y", AS_OF, None)], schema)
    for way in WAYS.values():
        assert history.merge_changed_only(hist, delta, config, **way).count() == 2
    assert history.changed_rows(delta, hist, config).count() == 1


def test_load_time_without_zone_or_given(spark):
    with pytest.raises(ValueError, match="zone"):
        MergeConfig("k", "seg", "2022-02-01 00:00:00+05:00")
    with pytest.raises(ValueError, match="zone"):
        as_of_column("2022-02-01T00:00:00+00:00")
    stamped = history.stamp_open(spark.range(3), replace(MERGE, as_of=None))
    before = datetime.now()
    starts = {r.start_date for r in stamped.collect()}
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone in ("UTC", "Etc/UTC"):
        assert len(starts) == 1 and abs((starts.pop() - before).total_seconds()) < 60
    assert [f.dataType.simpleString() for f in stamped.schema.fields[1:]] == ["timestamp_ntz", "timestamp_ntz"]
