"""The same results as the queries, in plain SQL over the test tables."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2022-02-01 00:00:00'"
SECOND_AS_OF = "TIMESTAMP '2022-03-01 00:00:00'"
BASE_AS_OF = "TIMESTAMP '2021-11-15 08:30:00'"
LEGACY_AS_OF = "TIMESTAMP '2020-05-20 06:00:00'"
NO_END = "CAST(NULL AS TIMESTAMP)"

DIRTY = """
dirty_once AS (
  SELECT CAST(floor(c_acctbal / 25) AS BIGINT) AS k, c_name AS nm,
         nullif(c_mktsegment, 'MACHINERY') AS seg,
         CASE WHEN c_nationkey < 5 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS nat,
         c_acctbal AS bal
  FROM customer),
dirty AS (
  SELECT * FROM dirty_once
  UNION ALL
  SELECT * FROM dirty_once WHERE bal < 0)"""

LINES = """
lines AS (
  SELECT CASE WHEN l_returnflag = 'A' THEN 0 ELSE l_orderkey END AS k,
         l_partkey, l_linenumber, l_quantity, l_shipdate
  FROM lineitem)"""

WORDS = """
words AS (SELECT unnest(string_split(text, ' ')) AS word, 1 AS word_count FROM documents)"""

HIST = f"""
hist AS (
  SELECT c_custkey AS k, c_mktsegment AS seg, c_nationkey AS nat,
         {BASE_AS_OF} AS start_date, {NO_END} AS end_date
  FROM customer WHERE c_acctbal >= 0
  UNION ALL
  SELECT c_custkey, 'LEGACY', c_nationkey, {LEGACY_AS_OF}, {BASE_AS_OF}
  FROM customer WHERE c_nationkey < 6)"""

WHOLE = HIST.replace("WHERE c_acctbal >= 0", "")
DELTA = f"""
delta AS (
  SELECT c_custkey AS k,
         CASE WHEN c_acctbal > 6500 THEN 'REVISED'
              WHEN c_nationkey = 3 THEN NULL
              WHEN c_nationkey IN (7, 8) THEN concat(' ', c_mktsegment, ' ')
              ELSE c_mktsegment END AS seg,
         c_nationkey AS nat, {AS_OF} AS start_date, {NO_END} AS end_date
  FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')"""

BOTH = f"{HIST},{DELTA}"

ORDERS = f"""
hist AS (
  SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_orderkey AS VARCHAR) END AS k,
         o_orderpriority AS seg, o_custkey AS nat, o_orderdate AS start_date, {NO_END} AS end_date
  FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL
  SELECT CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderkey AS VARCHAR) ELSE '0' END, o_orderpriority, o_custkey,
         o_orderdate - INTERVAL 1 DAY, o_orderdate
  FROM orders
  UNION ALL
  SELECT '0', 'HOT', 0, min(o_orderdate), {NO_END} FROM orders),
delta_rows AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS k, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS seg,
         o_custkey AS nat, {AS_OF} AS start_date, {NO_END} AS end_date
  FROM orders
  UNION ALL
  SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN '0' END, o_orderpriority, o_custkey, {AS_OF}, {NO_END}
  FROM orders WHERE o_orderstatus = 'F'),
delta AS (
  SELECT k, seg, nat, start_date, end_date FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY start_date DESC, seg NULLS LAST, nat NULLS LAST) AS rn
    FROM delta_rows WHERE k IS NOT NULL) WHERE rn = 1
  UNION ALL
  SELECT * FROM delta_rows WHERE k IS NULL)"""

DIFFERS = "(h.seg IS DISTINCT FROM d.seg OR h.nat IS DISTINCT FROM d.nat)"
VERSION = "k, seg, nat, start_date, end_date"


def changed_only(hist: str, delta: str, as_of: str = AS_OF) -> str:
    return f"""
  SELECT h.k, h.seg, h.nat, h.start_date,
         CASE WHEN h.end_date IS NULL
               AND EXISTS (SELECT 1 FROM {delta} d WHERE d.k = h.k AND {DIFFERS})
              THEN {as_of} ELSE h.end_date END AS end_date
  FROM {hist} h
  UNION ALL
  SELECT d.k, d.seg, d.nat, d.start_date, d.end_date
  FROM {delta} d
  WHERE NOT EXISTS (SELECT 1 FROM {hist} h WHERE h.k = d.k AND h.end_date IS NULL)
     OR EXISTS (SELECT 1 FROM {hist} h WHERE h.k = d.k AND h.end_date IS NULL AND {DIFFERS})"""


def reversion_all(hist: str, delta: str, as_of: str = AS_OF) -> str:
    return f"""
  SELECT h.k, h.seg, h.nat, h.start_date,
         CASE WHEN h.end_date IS NULL AND EXISTS (SELECT 1 FROM {delta} d WHERE d.k = h.k)
              THEN {as_of} ELSE h.end_date END AS end_date
  FROM {hist} h
  UNION ALL
  SELECT {VERSION} FROM {delta}"""


def latest(relation: str, columns: str, key: str, order: str) -> str:
    return f"""
  SELECT {columns} FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {relation})
  WHERE rn = 1"""


LATEST_DIRTY = "bal DESC NULLS LAST, nm NULLS LAST, seg NULLS LAST, nat NULLS LAST"
DIRTY_COLUMNS = "k, nm, seg, nat, bal"
NOT_NULL = "k IS NOT NULL AND seg IS NOT NULL AND nat IS NOT NULL"
POSITION = (
    "row_number() OVER (ORDER BY k NULLS LAST, end_date NULLS LAST, start_date NULLS LAST, "
    "seg NULLS LAST, nat NULLS LAST) AS position"
)


def differing(condition: str) -> str:
    return f"""WITH {BOTH}
SELECT d.* FROM delta d WHERE EXISTS (
  SELECT 1 FROM hist h WHERE h.k = d.k AND h.end_date IS NULL AND ({condition}))"""


def profile(column: str, nan: str = "0", blank: str = "0") -> str:
    return f"""
  SELECT '{column}' AS column_name, count(*) AS n_rows, count(*) - count({column}) AS n_null,
         CAST({nan} AS BIGINT) AS n_nan, CAST({blank} AS BIGINT) AS n_blank FROM noisy"""


def blank(column: str) -> str:
    return f"count(*) FILTER (trim({column}) = '')"


def gate(name: str, passed: str, rows_in: str, rows_out: str, detail: str, relation: str) -> str:
    return f"""
  SELECT '{name}' AS gate, {passed} AS passed, {rows_in} AS rows_in, {rows_out} AS rows_out,
         '{detail}' AS detail FROM {relation}"""


def drifted(relations: str, before: str, now: str, columns: dict[str, str]) -> str:
    """Each column's shares of nulls and whether it passes the drift gate, from exact cumulative shares."""
    values = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {side} AS side, CAST({value} AS DOUBLE) AS v FROM {relation}"
        for c, value in columns.items() for side, relation in enumerate((before, now)))
    return f"""WITH {relations}, vals AS ({values}),
totals AS (
  SELECT column_name, count(*) FILTER (side = 0) AS n_before, count(*) FILTER (side = 1) AS n_now,
         count(v) FILTER (side = 0) AS v_before, count(v) FILTER (side = 1) AS v_now
  FROM vals GROUP BY column_name),
points AS (SELECT column_name, v, count(*) FILTER (side = 0) AS a, count(*) FILTER (side = 1) AS b
       FROM vals WHERE v IS NOT NULL GROUP BY column_name, v),
cumulative AS (
  SELECT column_name, sum(a) OVER w AS a, sum(b) OVER w AS b FROM points
  WINDOW w AS (PARTITION BY column_name ORDER BY v)),
distances AS (
  SELECT column_name, max(abs(a / v_before - b / v_now)) AS d FROM cumulative JOIN totals USING (column_name) GROUP BY column_name),
shares AS (
  SELECT *, 1 - v_before / n_before AS null_before, 1 - v_now / n_now AS null_now,
         1 - (v_before + v_now) / (n_before + n_now) AS pooled FROM totals)
SELECT column_name, n_before, n_now, null_before, null_now,
       abs(null_now - null_before) <= 0.1 + 2.576 * sqrt(pooled * (1 - pooled) * (1 / n_before + 1 / n_now))
       AND d <= 0.2 + 1.628 * sqrt(1 / v_before + 1 / v_now) AS passed
FROM shares JOIN distances USING (column_name)"""


def stamped(end_text: str) -> str:
    return f"""SELECT c_custkey AS k, c_mktsegment AS seg, c_nationkey AS nat, {AS_OF} AS start_date,
       {end_text} AS end_text FROM customer"""


HORIZON = f"({AS_OF} + INTERVAL 999999999 SECOND)"
ENCODED = f"WITH {WHOLE} SELECT {VERSION}, end_date IS NULL AS was_open FROM hist"
KEPT = f"count(*) FILTER ({NOT_NULL})"
WORD_SUMS = f"""WITH {WORDS}
SELECT word, CAST(sum(word_count) AS BIGINT) AS word_count FROM words GROUP BY word"""
DISTINCT_KEPT = f"(SELECT count(*) FROM (SELECT DISTINCT k FROM dirty WHERE {NOT_NULL}))"
SCHEMA_DETAIL = "missing: nm; unexpected: end_date,start_date; mistyped: "

# What the load jobs read: extracts, from which they keep the newest row of each key. Older rows are left out.
EXTRACTS = f"""{BOTH},
base AS (SELECT {VERSION} FROM hist WHERE end_date IS NULL),
first_delta AS (SELECT {VERSION} FROM delta),
second_delta AS (
  SELECT c_custkey AS k, CASE WHEN c_nationkey < 12 THEN 'SECOND' ELSE c_mktsegment END AS seg,
         c_nationkey AS nat, {SECOND_AS_OF} AS start_date, {NO_END} AS end_date
  FROM customer)"""

WITH_BOTH = f"""WITH {EXTRACTS},
first_history AS ({changed_only('base', 'first_delta')}),
both_loads AS ({changed_only('first_history', 'second_delta', SECOND_AS_OF)})"""

ORACLES = {
    "history_load_into_connector": f"{WITH_BOTH} SELECT * FROM both_loads",
    "evolved_history_load": f"""{WITH_BOTH}
SELECT k, seg, CAST(nat AS BIGINT) AS nat, start_date, end_date,
  CASE WHEN start_date = {SECOND_AS_OF} THEN c_name END AS nm
FROM both_loads JOIN customer ON c_custkey = k""",
    "adopted_history_load": f"""WITH {WHOLE}, {EXTRACTS.replace("hist AS", "unused AS")}
{changed_only('hist', 'second_delta', SECOND_AS_OF)}""",
    "scd2_changed_only_filtered_delta": f"WITH {WHOLE},{DELTA} {changed_only('hist', 'delta')}",
    "stamp_open_now": """SELECT c_nationkey AS nat, count(*) AS n_rows, 1 AS n_starts, true AS not_before, true AS is_now
FROM customer GROUP BY c_nationkey""",
    "left_out_fates": f"""WITH {DIRTY}, filled AS (
  SELECT k, nm, seg, nullif(nat, '') AS nat, bal FROM dirty
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY {LATEST_DIRTY}) AS rn,
    first_value(nm) OVER (PARTITION BY k ORDER BY {LATEST_DIRTY}) AS its_nm
  FROM filled WHERE {NOT_NULL} AND nm IS NOT NULL
)
SELECT k, nm, seg, nat, bal, CASE WHEN nm = its_nm THEN 'copy' ELSE 'superseded' END AS fate FROM numbered WHERE rn > 1
UNION ALL
SELECT k, nm, seg, nat, bal, 'null' FROM filled WHERE NOT ({NOT_NULL} AND nm IS NOT NULL)""",
    "rows_scan_codes": """
SELECT code, description, count(*) AS n_orders
FROM orders JOIN (VALUES ('1-URGENT', 'due today'), ('2-HIGH', 'due this week'), ('3-MEDIUM', ''),
                         ('5-LOW', 'no date')) AS codes(code, description) ON o_orderpriority = code
GROUP BY code, description""",
    "csv_typed_landing": "SELECT * FROM documents",
    "csv_inferred_landing": "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders",
    # A blank field of an extract is read as null.
    "csv_blank_fields": f"WITH {DIRTY} SELECT k, nm, seg, nullif(nat, '') AS nat, bal FROM dirty",
    "csv_string_scan": """
SELECT CAST(c_custkey AS VARCHAR) AS k,
       CASE WHEN c_nationkey IN (7, 8) THEN concat(' ', c_mktsegment, ' ')
            WHEN c_nationkey <> 3 THEN c_mktsegment END AS seg,
       CAST(c_nationkey AS VARCHAR) AS nat FROM customer""",
    "parquet_roundtrip": "SELECT * FROM events",
    "table_scan_view": "SELECT c.* FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey",
    "sink_partitioned_snapshot": f"WITH {DIRTY} SELECT * FROM dirty",
    "sink_plain_snapshot": WORD_SUMS,
    "staged_republish": f"WITH {BOTH} {changed_only('hist', 'delta')}",
    "not_null_all": f"WITH {DIRTY} SELECT * FROM dirty WHERE {NOT_NULL}",
    "rejected_rows": f"WITH {DIRTY} SELECT * FROM dirty WHERE NOT ({NOT_NULL})",
    "not_blank_all": f"""WITH {DIRTY} SELECT * FROM dirty
WHERE k IS NOT NULL AND trim(nm) <> '' AND trim(seg) <> '' AND trim(nat) <> ''""",
    "drop_audit_columns": "SELECT *, 1 AS n_days FROM orders",
    "dedup_rows": f"WITH {DIRTY} SELECT DISTINCT * FROM dirty",
    "dedup_keys": f"WITH {DIRTY} SELECT DISTINCT k, seg FROM dirty",
    "latest_per_key": f"WITH {DIRTY} {latest('dirty', DIRTY_COLUMNS, 'k', LATEST_DIRTY)}",
    "latest_per_key_hot_key": f"""WITH {LINES} {latest(
        'lines', 'k, l_partkey, l_linenumber, l_quantity, l_shipdate', 'k',
        'l_shipdate DESC NULLS LAST, l_partkey NULLS LAST, l_linenumber NULLS LAST, l_quantity NULLS LAST')}""",
    "null_profile": f"""WITH {DIRTY},
noisy AS (SELECT k, nm, seg, nat, CASE WHEN nat = '' THEN CAST('NaN' AS DOUBLE) ELSE bal END AS bal FROM dirty)
{profile('k')} UNION ALL {profile('nm', blank=blank('nm'))} UNION ALL {profile('seg', blank=blank('seg'))}
UNION ALL {profile('nat', blank=blank('nat'))} UNION ALL {profile('bal', nan='count(*) FILTER (isnan(bal))')}""",
    "row_count_before_after": f"""WITH {DIRTY}
SELECT count(*) AS rows_before, count(*) FILTER ({NOT_NULL}) AS rows_after FROM dirty""",
    "sum_by_key": WORD_SUMS,
    "sum_by_key_hot_key": f"""WITH {LINES}
SELECT k, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_qty FROM lines GROUP BY k""",
    "fill_nulls": f"""WITH {DIRTY}
SELECT k, nm, coalesce(seg, 'UNKNOWN') AS seg, nat, coalesce(bal, 0.0) AS bal FROM dirty""",
    "load_date_text": """
SELECT o_orderkey, '01.02.2022' AS load_date,
       date_diff('day', CAST(o_orderdate AS DATE), DATE '2022-02-01') AS age_days,
       strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders""",
    "parse_timestamp": """
SELECT o_orderkey, o_orderdate AS parsed, true AS unchanged,
       CASE WHEN o_orderstatus NOT IN ('P', 'F') THEN o_orderdate END AS finite,
       o_orderstatus = 'F' AS is_open, o_orderstatus NOT IN ('P', 'F') AS is_closed
FROM orders""",
    "current_rows": f"WITH {WHOLE} SELECT * FROM hist WHERE end_date IS NULL",
    "closed_rows": f"WITH {WHOLE} SELECT * FROM hist WHERE end_date IS NOT NULL",
    "new_keys": f"WITH {BOTH} SELECT * FROM delta d WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.k = d.k)",
    "new_keys_hot_key": f"""WITH {ORDERS}
SELECT * FROM delta_rows d WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.k <> '0' AND h.k = d.k)""",
    "changed_rows_strict": differing("h.seg <> d.seg OR h.nat <> d.nat"),
    "changed_rows_null_safe": differing(DIFFERS),
    "changed_rows_trimmed": differing("trim(h.seg) <> trim(d.seg)"),
    "rows_to_close": f"""WITH {BOTH}
SELECT k, seg, nat, start_date, {AS_OF} AS end_date FROM hist
WHERE end_date IS NULL AND k IN (SELECT k FROM delta)""",
    "rows_to_close_changed": f"""WITH {BOTH}
SELECT h.k, h.seg, h.nat, h.start_date, {AS_OF} AS end_date FROM hist h
WHERE h.end_date IS NULL AND EXISTS (SELECT 1 FROM delta d WHERE d.k = h.k AND {DIFFERS})""",
    "carry_forward": f"""WITH {BOTH}
SELECT * FROM hist h WHERE h.end_date IS NOT NULL
   OR NOT EXISTS (SELECT 1 FROM delta d WHERE d.k = h.k AND {DIFFERS})""",
    "union_by_position": f"""WITH {BOTH}, {WHOLE.replace("hist AS", "whole AS")}
SELECT * FROM whole UNION ALL SELECT * FROM delta
UNION ALL SELECT * FROM delta d WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.k = d.k)""",
    "union_by_name": f"WITH {WHOLE},{DELTA} SELECT * FROM hist UNION ALL SELECT * FROM delta",
    "history_order": f"WITH {WHOLE} SELECT {VERSION}, {POSITION} FROM hist",
    "history_order_hot_key": f"WITH {ORDERS} SELECT {VERSION}, {POSITION} FROM hist",
    "scd2_changed_only": f"WITH {BOTH} {changed_only('hist', 'delta')}",
    "scd2_changed_only_small_delta": f"WITH {BOTH} {changed_only('hist', 'delta')}",
    "scd2_changed_only_hot_key": f"WITH {ORDERS} {changed_only('hist', 'delta')}",
    "scd2_reversion_all": f"WITH {BOTH} {reversion_all('hist', 'delta')}",
    "scd2_reversion_all_hot_key": f"WITH {ORDERS} {reversion_all('hist', 'delta')}",
    "open_key_violations": f"""WITH {ORDERS}, added AS (SELECT * FROM hist UNION ALL SELECT * FROM delta_rows)
SELECT k, count(*) AS n_open FROM added WHERE end_date IS NULL GROUP BY k HAVING count(*) > 1""",
    "gate_count": f"WITH {DIRTY} {gate('count', 'count(*) > 0', 'count(*)', 'count(*)', 'on', 'dirty')}",
    "gate_schema": f"WITH {DIRTY} {gate('schema', 'false', 'count(*)', 'count(*)', SCHEMA_DETAIL, 'dirty')}",
    "gate_nulls": f"""WITH {DIRTY} {gate(
        'nulls', f'{KEPT} > 0', 'count(*)', KEPT, 'k,seg,nat', 'dirty')}""",
    "gate_duplicates": f"""WITH {DIRTY}
{gate('duplicates', 'count(*) > 0', 'count(*)', 'count(DISTINCT k)', 'k', 'dirty')}""",
    "gate_chain": f"""WITH {DIRTY}, kept AS (SELECT * FROM dirty WHERE {NOT_NULL})
{latest('kept', DIRTY_COLUMNS, 'k', LATEST_DIRTY)}""",
    "gate_chain_from_options": f"""WITH {DIRTY}, kept AS (SELECT * FROM dirty WHERE {NOT_NULL})
{latest('kept', DIRTY_COLUMNS, 'k', LATEST_DIRTY)}""",
    "gate_drift_differences": drifted(
        f"""{DIRTY},
later AS (SELECT k, nm || ' and heirs' AS nm, CASE WHEN k % 4 = 0 THEN seg END AS seg, nat, bal * 3 AS bal FROM dirty)""",
        "dirty", "later", {"k": "k", "nm": "length(nm)", "seg": "length(seg)", "nat": "length(nat)", "bal": "bal"}),
    "gate_drift_report": """
SELECT 'drift' AS gate, true AS passed, count(*) AS rows_in, count(*) AS rows_out,
       'l_quantity,l_shipdate,l_returnflag' AS detail
FROM lineitem WHERE l_suppkey % 2 = 1""",
    "gate_chain_report": f"""WITH {DIRTY}
{gate('count', 'true', 'count(*)', 'count(*)', 'on', 'dirty')} UNION ALL
{gate('schema', 'true', 'count(*)', 'count(*)', 'missing: ; unexpected: ; mistyped: ', 'dirty')} UNION ALL
{gate('nulls', 'true', 'count(*)', KEPT, 'k,seg,nat', 'dirty')} UNION ALL
{gate('duplicates', 'true', KEPT, DISTINCT_KEPT, 'k', 'dirty')}""",
    "airline_style_load": f"""WITH {DIRTY}
SELECT DISTINCT k, nm, seg, nat, bal, {AS_OF} AS start_date, {HORIZON} AS end_date
FROM dirty WHERE {NOT_NULL} AND nm IS NOT NULL AND nat <> ''""",
    "first_changed_only_load": f"WITH {EXTRACTS} {changed_only('base', 'first_delta')}",
    "incremental_reversion_load": f"""WITH {EXTRACTS},
first_history AS ({reversion_all('base', 'first_delta')})
{reversion_all('first_history', 'second_delta', SECOND_AS_OF)}""",
    "first_history_load": f"WITH {EXTRACTS} {reversion_all('base', 'first_delta')}",
    "incremental_history_load": f"""WITH {EXTRACTS},
first_history AS ({changed_only('base', 'first_delta')})
{changed_only('first_history', 'second_delta', SECOND_AS_OF)}""",
    "stamp_open_null": stamped("CAST(NULL AS VARCHAR)"),
    "stamp_open_sentinel": stamped("'9999-12-31 23:59:59'"),
    "stamp_open_horizon": stamped(f"strftime({HORIZON}, '%Y-%m-%d %H:%M:%S')"),
    "encode_open_sentinel": ENCODED,
    "encode_open_horizon": ENCODED,
}
