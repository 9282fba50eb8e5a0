"""A Merkle manifest of a dataset: one root over all rows, and for every row what proves that it is under it.

Rows are leaves of one tree per group; the groups' roots are the leaves of the last tree. A node is the hash of up to
FAN children. The position of a leaf in its tree, written in base FAN, is its path: the lowest DIGITS digits name its
place in a block of FAN ** DIGITS leaves, which is gathered by its number. Within a block the digit columns are grouped
away one after the other, each time nesting the children in a struct, until the block is one row that holds its tree.
The block rows are the leaves of the next pass, so that no row ever holds more than a block, however many rows a
group has. Back down, a block's row is unfolded again: each level adds what stands before and after a node to the path
of its children, so that the proofs of a block need no joins; a pass is joined to the one above by one row per block.

All of it is DataFrame functions. Passes are written to the shared folder: FAN ** DIGITS rows become one in each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histload.llm.tables import stored
from histload.operators.ordering import ROW_BITS

#: Children of a node, and levels in a block.
FAN, DIGITS = 8, 3
BLOCK = FAN**DIGITS

_STEP = "struct<before: string, after: string>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts) if parts else F.lit(""), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes, so that no two lists of fields have the same text; null is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with their position in their group from 0, ``rank``, and the group's size, ``n``.

    Rows are sorted by ranges and written with their place in the partition; a number per partition and group, few for
    all rows as sorted groups follow one another, makes it one in the group. Spark broadcasts these numbers if
    they are small. A group, or a key, with most of the rows is split over many ranges.
    """
    keys = [group, *order]
    placed = rows.withColumn("__salt", F.monotonically_increasing_id()).repartitionByRange(*keys, "__salt").sortWithinPartitions(*keys).drop("__salt")
    placed = stored(placed.withColumn("__id", F.monotonically_increasing_id()), "sorted").withColumn("__part", F.shiftright("__id", ROW_BITS))
    each = placed.groupBy("__part", F.col(group).alias("__group")).agg(F.count("*").alias("__here"), F.min("__id").alias("__first"))
    of_group = Window.partitionBy("__group")
    # one row per partition that has rows of the group
    before = F.sum("__here").over(of_group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = each.select(
        F.col("__part").alias("__in"), "__group", "__first", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__here").over(of_group).alias("n")
    )
    met = (F.col("__part") == F.col("__in")) & F.col(group).eqNullSafe(F.col("__group"))
    rank = F.col("__id") - F.col("__first") + F.col("__before")
    return placed.join(sizes, met).select(*rows.columns, rank.alias("rank"), "n")


def _blocks(nodes: DataFrame, group: str, payload: list[str]) -> DataFrame:
    """Nodes (group, rank, n, hash, payload) as one row per block: (group, block, n, hash, tree)."""
    digits = [f"d{k}" for k in reversed(range(DIGITS))]
    low = {f"d{k}": F.pmod(F.floor(F.col("rank") / F.lit(FAN**k)), F.lit(FAN)).cast("int") for k in range(DIGITS)}
    block = F.expr(f"rank div {BLOCK}")
    node = F.struct(F.col("d0").alias("d"), "hash", *payload)
    rows = nodes.withColumns(low | {"block": block}).select(group, "block", "n", *digits, node.alias("node")).repartition(group, "block")
    for k in range(DIGITS):
        keys = [group, "block", "n", *digits[: DIGITS - 1 - k]]
        # one shuffle, on group and block, serves all levels
        rows = rows.groupBy(*keys).agg(F.array_sort(F.collect_list("node")).alias("children"))
        whole = F.array_join(F.transform("children", lambda c: c["hash"]), "")
        # a level is there if several nodes are below it; without it a node passes as it is
        there = F.col("n") > FAN**k
        hashed = F.when(there, digest(whole)).otherwise(F.col("children")[0]["hash"])
        place = [F.col(digits[DIGITS - 2 - k]).alias("d")] if k < DIGITS - 1 else []
        rows = rows.select(*keys, F.struct(*place, hashed.alias("hash"), there.alias("there"), "children").alias("node"))
    return rows.select(group, "block", "n", F.col("node.hash").alias("hash"), F.col("node").alias("tree"))


def _leaves(blocks: DataFrame, keep: list[str], payload: list[str]) -> DataFrame:
    """Blocks unfolded again, each node with its path within the block, the lowest level first: (keep, rank, hash,
    payload, path)."""
    rows = blocks.select(*keep, (F.col("block") * BLOCK).alias("rank"), F.col("tree").alias("node"), F.array().cast(f"array<{_STEP}>").alias("path"))
    for k in reversed(range(DIGITS)):
        hashes = F.transform("node.children", lambda c: c["hash"])
        child = rows.select(*keep, "rank", "path", F.col("node.there").alias("there"), hashes.alias("hashes"), F.posexplode("node.children").alias("at", "child"))
        step = F.struct(
            F.array_join(F.slice("hashes", F.lit(1), F.col("at")), "").alias("before"),
            F.array_join(F.slice("hashes", F.col("at") + 2, F.lit(FAN)), "").alias("after"),
        ).cast(_STEP)
        path = F.when(F.col("there"), F.concat(F.array(step), F.col("path"))).otherwise(F.col("path"))
        rows = child.select(*keep, (F.col("rank") + F.col("at") * FAN**k).alias("rank"), F.col("child").alias("node"), path.alias("path"))
    return rows.select(*keep, "rank", "node.hash", *(f"node.{c}" for c in payload), "path")


def _passes(nodes: DataFrame, group: str, payload: list[str]) -> list[DataFrame]:
    """The blocks of nodes, those of these blocks and so on, until each group is one row."""
    passes = [stored(_blocks(nodes, group, payload), "blocks")]
    while passes[-1].agg(F.max("block")).first()[0]:
        above = passes[-1].select(group, F.col("block").alias("rank"), F.expr(f"cast((n + {BLOCK - 1}) div {BLOCK} as bigint)").alias("n"), "hash")
        passes.append(stored(_blocks(above, group, []), "blocks"))
    return passes


def _paths(passes: list[DataFrame], group: str, payload: list[str], above: DataFrame, more: list[str]) -> DataFrame:
    """Of all nodes of the first pass the path to the top: that within the group, then that of ``above``: (group, path,
    and the columns ``more``), which has a row per group."""
    upper = above.select(F.col(group).alias("__group"), F.lit(0).cast("long").alias("__block"), F.col("path").alias("__path"), *more)
    for number, blocks in reversed(list(enumerate(passes))):
        # one row per block on either side
        met = (F.col("block") == F.col("__block")) & F.col(group).eqNullSafe(F.col("__group"))
        carried = blocks.join(upper, met).select(group, "block", "tree", "__path", *more)
        keep = [group, "__path", *more]
        leaves = _leaves(carried, keep, [] if number else payload)
        whole = leaves.withColumn("path", F.concat("path", "__path")).drop("__path")
        if number:
            upper = stored(whole.select(F.col(group).alias("__group"), F.col("rank").alias("__block"), F.col("path").alias("__path"), *more), "paths")
    return whole


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with what stands beside it on its path."""
    return F.aggregate(path, leaf, lambda h, s: digest(s["before"], h, s["after"]))


def manifest(rows: DataFrame, group: str, order: list[str], payload: list[str]) -> DataFrame:
    """Takes a group column, columns that order a group, ``leaf`` (a digest) and ``payload``. Gives the payload, leaf,
    subroot, root, path: an array of (before, after), what is beside the leaf on each level, the lowest first.

    A row is a leaf, repeated rows too. Rows that are equal in ``order`` stand by their digests. Nulls come first, a null
    group is a group. Without rows there is no root and no row.
    """
    clash = {c: f"__{i}" for i, c in enumerate(dict.fromkeys([group, *order, *payload]))}
    names = [F.col(c).alias(a) for c, a in clash.items()]
    leaves = stored(rows.select(*names, F.col("leaf").alias("hash")), "leaves")
    key, carried = clash[group], [clash[c] for c in payload]
    nodes = ranked(leaves, key, [*(clash[c] for c in order), "hash"])
    nodes = nodes.select(key, "rank", "n", "hash", *(c for c in carried if c != key))
    carried = [c for c in carried if c != key]
    passes = _passes(nodes, key, carried)

    subroots = ranked(passes[-1].select(F.lit(0).alias("all"), F.col(key), F.col("hash")), "all", [key])
    above = _passes(subroots, "all", [key])
    top = above[-1].select("all", F.lit(0).alias("rank"), F.col("hash").alias("root"), F.array().cast(f"array<{_STEP}>").alias("path"))
    upper = _paths(above, "all", [key], top, ["root"]).select(key, F.col("hash").alias("subroot"), "root", "path")
    out = _paths(passes, key, carried, upper, ["subroot", "root"])
    return out.select(*(F.col(clash[c]).alias(c) for c in payload), F.col("hash").alias("leaf"), "subroot", "root", "path")


#: Fields of a document, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def documents(docs: DataFrame) -> DataFrame:
    """The manifest of documents, by language, with a check of tampered copies: (doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified).

    Takes the FIELDS; other columns are ignored. ``proof_sha256`` is the digest of all that stands beside a leaf, from below.
    ``folded_root`` is the root that the tampered row gives; rows whose id has a CRC-32 that 3 divides have the letters A-Z
    of their text in lower case, the others, and null ids, are as they are. A null text stays null.
    """
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hashed = lambda text: digest(*(field(text if c == "text" else F.col(c)) for c in FIELDS))
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    rows = docs.select("doc_id", "lang", hashed(F.col("text")).alias("leaf"), F.when(chosen, hashed(F.translate("text", letters, letters.lower()))).alias("tampered"))
    whole = manifest(rows, "lang", ["doc_id"], ["doc_id", "tampered"])
    beside = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    root = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    found = whole.select("doc_id", "leaf", "subroot", "root", digest(beside).alias("proof_sha256"), root.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
