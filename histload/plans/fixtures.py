"""Inputs with dirt and history, derived from whole test tables.

The tables are clean and hold no history, so nulls, blanks, copies, earlier versions and revisions
are worked into them. A row's own values decide which of these it gets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histload.functions import as_of_column, sentinel

AS_OF = "2022-02-01 00:00:00"
BASE_AS_OF = "2021-11-15 08:30:00"
LEGACY_AS_OF = "2020-05-20 06:00:00"
# The audit columns that extracts have.
AUDIT = ("CreatedTimestamp", "UpdatedTimestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by balance band, with null segments, blank nations and debtors listed twice."""
    nation, balance = F.col("c_nationkey"), F.col("c_acctbal")
    return (
        table(spark, sf_dir, "customer")
        .select(
            F.floor(balance / 25).alias("k"),
            F.col("c_name").alias("nm"),
            F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("seg"),
            F.when(nation < 5, "").otherwise(nation.cast("string")).alias("nat"),
            balance.alias("bal"),
            F.explode(F.array_repeat(F.lit(1), F.when(balance < 0, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of which a third share one key."""
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", 0).otherwise(F.col("l_orderkey")).alias("k"),
        "l_partkey",
        "l_linenumber",
        "l_quantity",
        "l_shipdate",
    )


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, each occurrence counting one."""
    return table(spark, sf_dir, "documents").select(
        F.explode(F.split("text", " ")).alias("word"), F.lit(1).cast("long").alias("word_count")
    )


def _version(key: Column, seg: Column, nat: Column, start: Column, end: Column) -> list[Column]:
    return [
        key.alias("k"), seg.alias("seg"), nat.alias("nat"), start.alias("start_date"), end.alias("end_date")
    ]


def hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open versions, with the sentinel, and an earlier closed one for the customers of six nations.

    Debtors have no open version, so some keys have closed ones only and some are not there at all.
    """
    customer = table(spark, sf_dir, "customer")
    key, seg, nat = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey")
    current = customer.where("c_acctbal >= 0").select(
        *_version(key, seg, nat, as_of_column(BASE_AS_OF), sentinel())
    )
    earlier = customer.where("c_nationkey < 6").select(
        *_version(key, F.lit("LEGACY"), nat, as_of_column(LEGACY_AS_OF), as_of_column(BASE_AS_OF))
    )
    return current.unionByName(earlier)


def whole_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like ``hist``, with an open version for every customer."""
    key, seg, nat = F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey")
    debtors = table(spark, sf_dir, "customer").where("c_acctbal < 0 or c_acctbal is null")
    return hist(spark, sf_dir).unionByName(debtors.select(*_version(key, seg, nat, as_of_column(BASE_AS_OF), sentinel())))


def delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revised, nulled, padded, unchanged and new rows; households are not in the extract."""
    seg, nat = F.col("c_mktsegment"), F.col("c_nationkey")
    revised = (
        F.when(F.col("c_acctbal") > 6500, "REVISED")
        .when(nat == 3, None)
        .when(nat.isin(7, 8), F.concat(F.lit(" "), seg, F.lit(" ")))
        .otherwise(seg)
    )
    return table(spark, sf_dir, "customer").where(seg != "HOUSEHOLD").select(
        *_version(F.col("c_custkey"), revised, nat, as_of_column(AS_OF), sentinel())
    )


def _no_end() -> Column:
    return F.lit(None).cast("timestamp_ntz")


def order_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as open versions, and a past in which key 0, open too, has a version for most of the orders.

    Pending orders are not loaded yet. A version without a key is there for each urgent order.
    """
    orders = table(spark, sf_dir, "orders")
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    seg, nat, placed = F.col("o_orderpriority"), F.col("o_custkey"), F.col("o_orderdate")
    open_key = F.when(seg != "1-URGENT", key)
    current = orders.where(status != "P").select(*_version(open_key, seg, nat, placed, _no_end()))
    past_key = F.when(status == "P", key).otherwise("0")
    past = orders.select(
        *_version(past_key, seg, nat, placed - F.expr("INTERVAL '1' DAY"), placed)
    )
    hot = orders.agg(F.min("o_orderdate").alias("o_orderdate"))
    hot = hot.select(*_version(F.lit("0"), F.lit("HOT"), F.lit(0).cast("long"), placed, _no_end()))
    return current.unionByName(past).unionByName(hot)


def order_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, low-priority ones revised; key 0 comes again for a third of them, or without key."""
    orders = table(spark, sf_dir, "orders")
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    seg, nat = F.col("o_orderpriority"), F.col("o_custkey")
    starts = as_of_column(AS_OF)
    revised = F.when(seg != "5-LOW", seg)
    once = orders.select(*_version(key, revised, nat, starts, _no_end()))
    again_key = F.when(seg != "1-URGENT", "0")
    again = orders.where(status == "F").select(*_version(again_key, seg, nat, starts, _no_end()))
    return once.unionByName(again)


def write_extract(df: DataFrame, path: str) -> str:
    """Write rows as a delimited extract with audit columns, as a source system would deliver it."""
    stamped = df.withColumns({c: as_of_column(AS_OF) for c in AUDIT if c not in df.columns})
    # The CSV writer strips padding unless told not to. Quotes in a field are doubled.
    stamped.write.mode("overwrite").options(
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return path
