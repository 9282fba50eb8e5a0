"""Columns that come, go or widen between the extracts of one history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histload.functions import named

_INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())


class SchemaChange(ValueError):
    """An extract's columns cannot become part of the history."""


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Every value of ``old`` is one of ``new``, and parquet files of ``old`` can be read as ``new``."""
    if old in _INTEGERS and new in _INTEGERS:
        return _INTEGERS.index(old) < _INTEGERS.index(new)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return old.scale == new.scale and old.precision < new.precision
    return isinstance(old, T.FloatType) and isinstance(new, T.DoubleType)


def reconciled(history: T.StructType, extract: T.StructType) -> T.StructType:
    """The columns of a history after an extract: its own, wider where the extract's are, then those that are new.

    Versions from before hold null in new columns, versions of the extract in columns that it has not. A column that the
    extract narrows, or makes another type of, raises.
    """
    incoming = {f.name: f.dataType for f in extract.fields}
    fields = []
    for field in history.fields:
        new = incoming.pop(field.name, field.dataType)
        if new != field.dataType and not widens(field.dataType, new):
            how = "narrows" if widens(new, field.dataType) else "changes"
            raise SchemaChange(f"the extract {how} {field.name} from {field.dataType.simpleString()} to {new.simpleString()}")
        fields.append(T.StructField(field.name, new))
    return T.StructType(fields + [T.StructField(name, kind) for name, kind in incoming.items()])


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``: cast where they widen, null where it has none."""
    columns = []
    for field in schema.fields:
        there = named(field.name) if field.name in df.columns else F.lit(None)
        columns.append(there.cast(field.dataType).alias(field.name))
    return df.select(*columns)
