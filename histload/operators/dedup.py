"""Whole-row, key and latest-per-key de-duplication."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histload.functions import all_named, named


def dedup_rows(df: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows; nulls are equal. Copies collapse before the shuffle."""
    return df.dropDuplicates()


def dedup_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """The distinct keys. Other columns are left out, as the row they came from would be arbitrary."""
    return df.select(*all_named(keys)).distinct()


def total_order(df: DataFrame, keys: Iterable[str], order_by: Iterable[str]) -> list[Column]:
    """``order_by`` descending, then every other column, so that only equal rows can tie."""
    keys, order_by = list(keys), list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    return [named(c).desc_nulls_last() for c in order_by] + [named(c).asc_nulls_last() for c in rest]


def latest_per_key(df: DataFrame, keys: Iterable[str], order_by: Iterable[str]) -> DataFrame:
    """Keep the row of each key that is last by ``order_by``.

    With the filter directly on the row number, Spark keeps one row per key in each input partition
    before it shuffles, so a key with very many rows does not burden one task.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("without keys, all rows would be one group in one task")
    window = Window.partitionBy(*all_named(keys)).orderBy(*total_order(df, keys, order_by))
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")
