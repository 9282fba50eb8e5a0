"""Positions in a global order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from histload.sources.readers import read_parquet
from histload.sources.writers import write_snapshot

# Fixed value: monotonically_increasing_id keeps the partition above, and the row below, this bit.
ROW_BITS = 33


def number_rows(ordered: DataFrame, name: str, path: str) -> DataFrame:
    """Number the rows of a sorted table from 1, without bringing them to one task.

    The sorted rows are written once with their partition and place in it, so that counting and
    numbering see the same partitions. The only rows gathered are one count per partition.
    """
    schema = StructType([*ordered.schema.fields]).add("__id", LongType())
    write_snapshot(ordered.withColumn("__id", F.monotonically_increasing_id()), path)
    placed = read_parquet(ordered.sparkSession, path, schema)
    part = F.shiftright("__id", ROW_BITS)
    place = F.col("__id").bitwiseAND((1 << ROW_BITS) - 1)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("__part"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    )
    # One row per partition of the sort, which spark.sql.shuffle.partitions bounds.
    numbered = placed.join(F.broadcast(offsets), part == F.col("__part"))
    return numbered.withColumn(name, F.col("__offset") + place + 1).drop("__id", "__part", "__offset")
