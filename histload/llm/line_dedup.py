"""Line dedup by distinct-site spread.

For every line hash a HyperLogLog sketch of the sites that have the line; sketches of a hash merge by aggregation,
before rows are moved. Lines whose estimate is well above or below the threshold are settled by it; for
those near it, sites are counted exactly. A line on as many sites or more is boilerplate: it stays in the first
document that has it and goes from all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histload.llm.tables import stored, tasks_after

#: Logarithm of the registers of a sketch. Its estimates stray by 1.04 / sqrt(2^LG), 3.3 %.
LG = 10
#: Estimates within this part of the threshold, six times that, are counted exactly.
NEAR = 0.2

_BLANK = " \t\r"


def _key(line: Column) -> Column:
    """A line without the blanks around it; a line of blanks has the empty key."""
    return F.btrim(line, F.lit(_BLANK))


def _lines(docs: DataFrame, site: str) -> DataFrame:
    """(doc_id, nameless, row, site, h, g): the two hashes of each line that is not blank, and hashes of its row and site;
    ``nameless`` orders the texts that have no doc_id."""
    where = F.xxhash64(F.coalesce(F.col(site).cast("string"), F.lit("\0")))
    lines = F.transform(F.split("text", "\n", -1), lambda x: _key(x))
    each = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("doc_id").isNull(), F.md5("text")).alias("nameless"),
        _row_key().alias("row"),
        where.alias("site"),
        F.explode(lines).alias("line"),
    )
    return each.where("line <> ''").select("doc_id", "nameless", "row", "site", F.xxhash64("line").alias("h"), F.hash("line").alias("g"))


def _row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def spread(lines: DataFrame, least: int, tasks: int | None = None) -> DataFrame:
    """The lines on at least ``least`` sites: (h, g, first, first_nameless), first the smallest doc_id that has the line.
    Lines without ``nameless`` all have a doc_id. ``tasks`` goes to `stored`."""
    if "nameless" not in lines.columns:
        lines = lines.withColumn("nameless", F.lit(None).cast("string"))
    sketched = lines.groupBy("h", "g").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG))).alias("sites"), F.min("doc_id").alias("first"), F.min("nameless").alias("first_nameless")
    )
    likely = stored(sketched.where(F.col("sites") >= least * (1 - NEAR)), "likely", tasks)
    near = likely.where(F.col("sites") <= least * (1 + NEAR))
    sites = lines.join(near.select("h", "g"), ["h", "g"], "left_semi").groupBy("h", "g", "site").agg(F.lit(1).alias("one"))
    exact = sites.groupBy("h", "g").agg(F.count("*").alias("exact"))
    settled = likely.join(exact, ["h", "g"], "left").where(F.coalesce("exact", "sites") >= least)
    return settled.select("h", "g", "first", "first_nameless")


def dedup(docs: DataFrame, least: int = 10, site: str = "source") -> DataFrame:
    """``docs`` without boilerplate: all its columns, ``text`` with the lines that stay, and n_lines and n_removed.

    Lines are told apart by their text without blanks around it. A line on at least ``least`` sites stays in the
    document with the smallest doc_id that has it, as often as it is there, and goes from the others. Blank lines
    stay. A null text stays null and has no lines; an empty text has one, which is blank. A null site is a
    site of its own. A null doc_id is after all others: its lines go if a document with one has them; a line that none has stays in
    the text with the smallest MD5. Rows that repeat a doc_id, or have none and the same text, are the same document. Columns named n_lines and n_removed are replaced.
    """
    docs = docs.drop("n_lines", "n_removed")
    lines = stored(_lines(docs, site), "lines")
    tasks = tasks_after(lines)
    boilerplate = stored(spread(lines, least, tasks), "boilerplate", tasks)
    hit = lines.join(boilerplate, ["h", "g"]).where("doc_id > first or nameless > first_nameless or (doc_id is null and first is not null)")
    # of a row, its own boilerplate lines; never more than it has lines
    gone = hit.groupBy("row").agg(F.collect_set(F.struct("h", "g")).alias("__gone")).withColumnRenamed("row", "__gone_row")

    with_gone = docs.join(gone, _row_key() == F.col("__gone_row"), "left")
    parts = F.split("text", "\n", -1)
    stays = F.filter(
        parts,
        lambda x: F.col("__gone").isNull()
        | (_key(x) == "")
        | ~F.array_contains(F.col("__gone"), F.struct(F.xxhash64(_key(x)).alias("h"), F.hash(_key(x)).alias("g"))),
    )
    kept = F.when(F.col("__gone").isNull(), parts).otherwise(stays)
    return with_gone.withColumns({"__kept": kept}).select(
        *(F.array_join("__kept", "\n").alias("text") if c == "text" else F.col(c) for c in docs.columns),
        F.coalesce(F.size(parts), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(parts) - F.size("__kept"), F.lit(0)).cast("long").alias("n_removed"),
    )
