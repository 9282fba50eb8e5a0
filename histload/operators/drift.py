"""What the columns of a load look like, and a gate that holds that against the load before.

A profile of a column is its number of rows and nulls and two mergeable sketches: a HyperLogLog sketch of its distinct
values and a KLL sketch of the distribution of its values. Both have a bounded size (some 8 KB together) however many
rows there are, are aggregated before the shuffle, and can be kept as text beside a load. Two profiles are compared
without reading the rows again.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Mapping
from math import sqrt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histload.config import DriftConfig
from histload.functions import named
from histload.operators.quality import GateFailure, Gated, gate_report, resolved

#: Shares at which two distributions are compared, taken from both.
POINTS = 100
# 1 % critical values of the two-sample Kolmogorov-Smirnov test and of the normal distribution.
KS_CRITICAL, NORMAL_CRITICAL = 1.628, 2.576


class Difference(NamedTuple):
    """A column before and now. Shares are null where a side has no rows, and ``distance`` and ``new_share`` also where it
    has no values, or where text became numbers or times."""

    column_name: str
    n_before: int
    n_now: int
    null_before: float | None
    null_now: float | None
    distance: float | None
    new_share: float | None
    passed: bool


_DIFFERENCES = "column_name STRING, n_before BIGINT, n_now BIGINT, null_before DOUBLE, null_now DOUBLE, distance DOUBLE, new_share DOUBLE, passed BOOLEAN"


def _number(df: DataFrame, name: str) -> tuple[str, Column]:
    """What kind of column it is, and its value as a number: the length of a text, seconds of a time. NaN counts as null."""
    kind, c = df.schema[name].dataType, named(name)
    if isinstance(kind, T.StringType):
        return "text", F.char_length(c).cast("double")
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "time", F.unix_micros(c.cast("timestamp")) / 1e6
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "number", F.when(~F.isnan(c), c).cast("double")
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return "number", c.cast("double")
    raise ValueError(f"{name}: a profile of {kind.simpleString()} is not defined")


def profile_aggregates(df: DataFrame, columns: Iterable[str]) -> dict[str, Column]:
    """What ``profile_of`` reads, as aggregates for whatever pass reads the rows. An absent column stops the gate."""
    out = {"drift_rows": F.count(F.lit(1))}
    for i, name in enumerate(resolved(df, columns, "drift")):
        kind, number = _number(df, name)
        value = F.when(number.isNotNull(), named(name).cast("string"))
        out[f"drift_{i}_kind"] = F.first(F.lit(kind))
        out[f"drift_{i}_values"] = F.count(number)
        out[f"drift_{i}_distinct"] = F.hll_sketch_agg(value)
        out[f"drift_{i}_sketch"] = F.kll_sketch_agg_double(number)
    return out


def profile_of(seen: Mapping[str, object], columns: Iterable[str]) -> dict:
    """A profile that can be kept as JSON, from what ``profile_aggregates`` measured."""
    text = lambda b: base64.b64encode(bytes(b)).decode() if b else ""
    return {
        name: {
            "kind": seen[f"drift_{i}_kind"],
            "rows": seen["drift_rows"],
            "values": seen[f"drift_{i}_values"],
            "distinct": text(seen[f"drift_{i}_distinct"]),
            "sketch": text(seen[f"drift_{i}_sketch"]),
        }
        for i, name in enumerate(columns)
    }


def profile(df: DataFrame, columns: Iterable[str]) -> dict:
    """The profile of a table's columns, from one pass over it."""
    columns = list(columns)
    aggregates = profile_aggregates(df, columns)
    return profile_of(df.agg(*[c.alias(n) for n, c in aggregates.items()]).first().asDict(), columns)


def _compared(before: dict, now: dict) -> list[Column]:
    """Distance of two distributions and share of new values, from the sketches of two profiles with values."""
    kept = lambda of, what: F.lit(base64.b64decode(of[what]))
    sketches = kept(before, "sketch"), kept(now, "sketch")
    shares = F.array(*[F.lit(i / POINTS) for i in range(POINTS + 1)])
    at = F.concat(*[F.kll_sketch_get_quantile_double(s, shares) for s in sketches])
    ranks = [F.kll_sketch_get_rank_double(s, at) for s in sketches]
    distance = F.array_max(F.zip_with(*ranks, lambda a, b: F.abs(a - b)))
    old, new = kept(before, "distinct"), kept(now, "distinct")
    unseen = F.hll_sketch_estimate(F.hll_union(old, new)) - F.hll_sketch_estimate(old)
    new_share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), unseen / F.hll_sketch_estimate(new)))
    return [distance, new_share]


def differences(spark: SparkSession, before: dict, now: dict, config: DriftConfig) -> list[Difference]:
    """How the configured columns of two profiles differ; columns that were not there before are left out.

    What chance makes of two samples of that many rows (one in a hundred) is allowed on top of the configured limits, so
    that a small extract is not refused for being small. A side without rows is never refused: the count gate is for
    that. The sketches' own error is below 0.03 for ``distance`` and a few hundredths of all distinct values for
    ``new_share``; as KLL sketches draw lots, a distance may differ by that from run to run.
    """
    names = [c for c in config.columns if c in before]
    whole = [c for c in names if before[c]["values"] and now[c]["values"] and before[c]["kind"] == now[c]["kind"]]
    measured = {}
    if whole:
        columns = [F.struct(*[x.alias(f"v{i}") for i, x in enumerate(_compared(before[c], now[c]))]).alias(f"c{i}") for i, c in enumerate(whole)]
        measured = dict(zip(whole, spark.range(1, numPartitions=1).select(*columns).first()))
    out = []
    for c in names:
        n, m = before[c]["rows"], now[c]["rows"]
        shares = [1 - p[c]["values"] / p[c]["rows"] if p[c]["rows"] else None for p in (before, now)]
        distance, new_share = measured.get(c, (None, None))
        passed = True
        if n and m:
            pooled = (n * shares[0] + m * shares[1]) / (n + m)
            chance = NORMAL_CRITICAL * sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))
            passed = abs(shares[1] - shares[0]) <= config.null_share + chance
        if distance is not None:
            passed &= distance <= config.distance + KS_CRITICAL * sqrt(1 / before[c]["values"] + 1 / now[c]["values"])
            passed &= new_share <= config.new_share
        out.append(Difference(c, n, m, *shares, distance, new_share, passed))
    return out


def difference_table(spark: SparkSession, found: list[Difference]) -> DataFrame:
    """Differences as rows, from literals: there are as many as configured columns."""
    names, types = zip(*[part.split() for part in _DIFFERENCES.split(", ")])
    rows = [F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(d, names, types)]) for d in found]
    table = spark.range(1 if rows else 0, numPartitions=1)
    return table.select(F.inline(F.array(*rows) if rows else F.from_json(F.lit("[]"), f"array<struct<{','.join(f'{n}:{t}' for n, t in zip(names, types))}>>")))


def _said(d: Difference) -> str:
    of = lambda x: "none" if x is None else f"{x:.3f}"
    return f"{d.column_name}: null share {of(d.null_before)} to {of(d.null_now)}, distance {of(d.distance)}, new values {of(d.new_share)}"


def drift_row(spark: SparkSession, before: dict | None, now: dict, config: DriftConfig, n: int) -> tuple:
    """The report of the gate; raises if a column is too far from what it was."""
    if not before:
        return ("drift", True, n, n, "nothing to compare with")
    bad = [d for d in differences(spark, before, now, config) if not d.passed]
    if bad:
        raise GateFailure("drift: " + "; ".join(map(_said, bad)))
    return ("drift", True, n, n, ",".join(config.columns))


def gate_drift(df: DataFrame, before: dict | None, config: DriftConfig) -> Gated:
    """Pass all rows if every configured column is close enough to its profile ``before``, none if one is not."""
    spark, now = df.sparkSession, profile(df, config.columns)
    n = next(iter(now.values()))["rows"]
    try:
        return Gated(df, gate_report(spark, [drift_row(spark, before, now, config, n)]))
    except GateFailure as failure:
        return Gated(df.limit(0), gate_report(spark, [("drift", False, n, 0, str(failure))]))
