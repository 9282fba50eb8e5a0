"""Scans: rows in memory, delimited text, parquet and tables of any format."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def rows(spark: SparkSession, data: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """A short list held by the caller, with a declared schema."""
    return spark.createDataFrame(list(data), schema)


#: Quotes inside a quoted field are doubled, as most writers of delimited text do it.
_CSV = {"header": True, "escape": '"'}


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Delimited text with a header line.

    An empty field is null, quoted or not. With a schema, the header must match it and a value that
    does not parse stops the read. Without one, Spark infers it, which reads the whole input once
    more, and fills short lines with nulls. ``options`` go to the reader: delimiter, quote, escape, multiLine
    for fields with line breaks (a file is then read by one task), mode for how bad lines are treated.
    """
    given = dict(options or {})
    if schema is None:
        return spark.read.options(**(_CSV | {"inferSchema": True, "mode": "PERMISSIVE"} | given)).csv(path)
    return spark.read.options(**(_CSV | {"enforceSchema": False, "mode": "FAILFAST"} | given)).schema(schema).csv(path)


def read_csv_text(spark: SparkSession, path: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Delimited text with a header line, every column as text, spaces kept, empty fields null."""
    return spark.read.options(**(_CSV | dict(options or {}))).csv(path)


def csv_header(spark: SparkSession, path: str, options: Mapping[str, str] | None = None) -> list[str]:
    """The columns that an extract names, from its first line."""
    return read_csv_text(spark, path, options).columns


def read_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_table(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A table of any format Spark has a connector for; its options go through unchanged."""
    return spark.read.format(fmt).options(**(options or {})).load(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df
