"""Filters, profiles and quality gates. A gate returns the rows that pass and a one-row report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histload.config import GateConfig
from histload.functions import all_named, all_not_null, named, none_blank
from histload.operators.dedup import latest_per_key


class Gated(NamedTuple):
    data: DataFrame
    report: DataFrame


def not_null_all(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.where(all_not_null(columns))


def not_blank_all(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.where(none_blank(columns))


def rejected_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """What ``not_null_all`` leaves out."""
    return df.where(~all_not_null(columns))


def drop_audit_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop the named columns; absent ones are ignored."""
    return df.drop(*columns)


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(values))


def sum_by_key(df: DataFrame, keys: Iterable[str], value: str, name: str) -> DataFrame:
    """Sum per key; each input partition adds up its own rows first."""
    return df.groupBy(*all_named(keys)).agg(F.sum(named(value)).alias(name))


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls, NaNs and blanks of every column, from one pass over the table."""

    def counts(field: T.StructField) -> Column:
        c = named(field.name)
        floating = isinstance(field.dataType, (T.FloatType, T.DoubleType))
        text = isinstance(field.dataType, T.StringType)
        return F.struct(
            F.lit(field.name).alias("column_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(c.isNull()).alias("n_null"),
            (F.count_if(F.isnan(c)) if floating else F.lit(0).cast("long")).alias("n_nan"),
            (F.count_if(F.trim(c) == "") if text else F.lit(0).cast("long")).alias("n_blank"),
        )

    profile = df.agg(F.array(*[counts(f) for f in df.schema.fields]).alias("__columns"))
    return profile.select(F.inline("__columns"))


def row_counts(df: DataFrame, kept: Column) -> DataFrame:
    """Rows before and after a filter, from one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(kept).alias("rows_after"),
    )


# ---------------------------------------------------------------- gates


class GateFailure(Exception):
    """The input must not be loaded."""


_REPORT = "gate STRING, passed BOOLEAN, rows_in BIGINT, rows_out BIGINT, detail STRING"


def _report(df: DataFrame, gate: str, passed: Column, rows_in: Column, rows_out: Column, detail: str):
    return df.agg(
        F.lit(gate).alias("gate"),
        passed.alias("passed"),
        rows_in.alias("rows_in"),
        rows_out.alias("rows_out"),
        F.lit(detail).alias("detail"),
    )


def _all_rows(df: DataFrame, gate: str, passed: Column, detail: str) -> DataFrame:
    n = F.count(F.lit(1))
    return _report(df, gate, passed, n, n, detail)


def resolved(df: DataFrame, columns: Iterable[str], gate: str) -> list[str]:
    """The columns' names as the table writes them; upper and lower case are the same unless the session
    says otherwise. A name that is not there is a setting that checks nothing, so it stops the gate."""
    strict = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    known = {c if strict else c.lower(): c for c in df.columns}
    missing = [c for c in columns if (c if strict else c.lower()) not in known]
    if missing:
        raise GateFailure(f"{gate}: no such column: {', '.join(missing)}")
    return [known[c if strict else c.lower()] for c in columns]


def gate_count(df: DataFrame, config: GateConfig) -> Gated:
    """Pass when there is a row."""
    if not config.count_check:
        return Gated(df, _all_rows(df, "count", F.lit(True), "off"))
    return Gated(df, _all_rows(df, "count", F.count(F.lit(1)) > 0, "on"))


def schema_differences(types: Mapping[str, str], config: GateConfig) -> dict[str, list[str]]:
    """Columns that are missing, not expected, or of another type than expected."""
    return {
        "missing": sorted(set(config.columns) - set(types)),
        "unexpected": sorted(set(types) - set(config.columns)),
        "mistyped": sorted(c for c, t in config.types.items() if c in types and types[c] != t),
    }


def _schema_passes(differences: Mapping[str, list[str]]) -> bool:
    """More columns than expected are reported, but do no harm."""
    return not differences["missing"] and not differences["mistyped"]


def _schema_detail(differences: Mapping[str, list[str]]) -> str:
    return "; ".join(f"{kind}: {','.join(names)}" for kind, names in differences.items())


def check_schema(types: Mapping[str, str], config: GateConfig) -> None:
    """Raise unless every expected column is there with its type."""
    found = schema_differences(types, config)
    if config.schema_check and not _schema_passes(found):
        raise GateFailure(f"schema: {_schema_detail(found)}")


def gate_schema(df: DataFrame, config: GateConfig) -> Gated:
    """Pass when every expected column is there with its type."""
    if not config.schema_check:
        return Gated(df, _all_rows(df, "schema", F.lit(True), "off"))
    found = schema_differences(dict(df.dtypes), config)
    return Gated(df, _all_rows(df, "schema", F.lit(_schema_passes(found)), _schema_detail(found)))


def gate_nulls(df: DataFrame, config: GateConfig) -> Gated:
    """Leave out rows with a null in any configured column. Fails if no row is left of some."""
    if not config.null_check:
        return Gated(df, _all_rows(df, "nulls", F.lit(True), "off"))
    columns = resolved(df, config.null_columns, "nulls")
    n, kept = F.count(F.lit(1)), F.count_if(all_not_null(columns))
    report = _report(df, "nulls", (kept > 0) | (n == 0), n, kept, ",".join(config.null_columns))
    return Gated(not_null_all(df, columns), report)


def gate_duplicates(df: DataFrame, config: GateConfig) -> Gated:
    """Keep the latest row of each configured key."""
    if not config.duplicate_check:
        return Gated(df, _all_rows(df, "duplicates", F.lit(True), "off"))
    keys = resolved(df, config.duplicate_columns, "duplicates")
    order_by = resolved(df, config.duplicate_order, "duplicates")
    # One row per key with its count: both totals come from one shuffle of partial counts.
    sizes = df.groupBy(*all_named(keys)).agg(F.count(F.lit(1)).alias("__n"))
    rows_in = F.coalesce(F.sum("__n"), F.lit(0).cast("long"))
    report = _report(sizes, "duplicates", F.lit(True), rows_in, F.count(F.lit(1)), ",".join(config.duplicate_columns))
    return Gated(latest_per_key(df, keys, order_by), report)


def gate_counts(df: DataFrame, config: GateConfig) -> dict[str, Column]:
    """Aggregates that the first three gates need, to be measured by whatever pass reads the rows."""
    columns = resolved(df, config.null_columns, "nulls") if config.null_check else []
    return {"n": F.count(F.lit(1)), "n_kept": F.count_if(all_not_null(columns)) if columns else F.count(F.lit(1))}


def gate_rows(df: DataFrame, config: GateConfig, n: int, n_kept: int) -> list[tuple]:
    """The reports of count, schema and null gate, from what ``gate_counts`` measured; raises if one fails."""
    check_schema(dict(df.dtypes), config)
    if config.count_check and not n:
        raise GateFailure("count: no rows")
    if n and not n_kept:
        raise GateFailure(f"nulls: none of {n} rows has all of {', '.join(config.null_columns)}")
    schema_detail = _schema_detail(schema_differences(dict(df.dtypes), config)) if config.schema_check else "off"
    return [
        ("count", True, n, n, "on" if config.count_check else "off"),
        ("schema", True, n, n, schema_detail),
        ("nulls", True, n, n_kept, ",".join(config.null_columns) if config.null_check else "off"),
    ]


def duplicates_row(config: GateConfig, rows_in: int, rows_out: int) -> tuple:
    """The report of the duplicate gate."""
    return ("duplicates", True, rows_in, rows_out, ",".join(config.duplicate_columns) if config.duplicate_check else "off")


def gate_report(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Reports as a table, from literals: there is nothing to distribute."""
    names = [part.split()[0] for part in _REPORT.split(", ")]
    values = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    table = spark.range(1, numPartitions=1).select(F.inline(F.array(*values)))
    return table.select(*[F.col(part.split()[0]).cast(part.split()[1]).alias(part.split()[0]) for part in _REPORT.split(", ")])


def pass_gates(df: DataFrame, config: GateConfig) -> DataFrame:
    """The rows that null and duplicate gate let through."""
    if config.null_check:
        df = not_null_all(df, resolved(df, config.null_columns, "nulls"))
    return gate_duplicates(df, config).data


def gate_chain(df: DataFrame, config: GateConfig) -> Gated:
    """Count, schema, null and duplicate gate, each on what the one before let through.

    A gate that fails stops the chain with an error: no rows, a wrong schema, no row without nulls, a
    configured column that is not there. One pass counts rows for the first three; the report of the fourth is
    computed when it is read.
    """
    check_schema(dict(df.dtypes), config)
    n, n_kept = df.agg(*gate_counts(df, config).values()).first()
    rows = gate_rows(df, config, n, n_kept)
    passed = not_null_all(df, resolved(df, config.null_columns, "nulls")) if config.null_check else df
    last = gate_duplicates(passed, config)
    return Gated(last.data, gate_report(df.sparkSession, rows).unionByName(last.report))
