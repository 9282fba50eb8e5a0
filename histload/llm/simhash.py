"""Document fingerprints: SimHash over weighted words, and the search for near fingerprints.

All of it is DataFrame and SQL functions. Each word's 64-bit hash votes on the signed bits with the word's
weight; long words, which are rarer, weigh more. Two bits share one sum: adding ``(hash >> i) & 0x100000001``
counts bit i in the lower half of a 64-bit sum and bit i + 32 in the upper one.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from histload.llm.tables import stored

#: A word weighs its length less two, from 1 to this. The weights of a text add up to less than 2^31.
MOST = 10
#: Rows whose order is settled by one task.
ORDERED_ROWS = 500_000

_PAIR = 0x100000001


def words(text: Column) -> Column:
    """The words of a text in lower case, as an array; it may hold empty strings."""
    return F.split(F.lower(text), r"[ \t-\r]+")


def _votes() -> list[Column]:
    weight = F.greatest(F.lit(1), F.least(F.lit(MOST + 2), F.length("word")) - 2).cast("long")
    hashed = F.xxhash64("word")
    return [F.sum(weight).alias("weight")] + [
        F.sum(F.shiftrightunsigned(hashed, i).bitwiseAND(F.lit(_PAIR)) * weight).alias(f"v{i}") for i in range(32)
    ]


def _bits() -> Column:
    """The fingerprint from the votes: a bit is set if more than half of the weight has it."""
    bits = F.lit(0).cast("long")
    for i in range(32):
        low, high = F.col(f"v{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(F.col(f"v{i}"), 32)
        for place, votes in ((i, low), (i + 32, high)):
            bit = F.lit(1 << place if place < 63 else -(1 << 63)).cast("long")
            bits = bits.bitwiseOR(F.when(2 * votes > F.col("weight"), bit).otherwise(F.lit(0).cast("long")))
    return bits


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, bits): the fingerprint of each text, a long. A text without words, null or empty, has no row.

    Votes are added before rows are moved, so rows with the same keys may be anywhere; they count as one text.
    """
    each = texts.select(*keys, F.explode(words(F.col("text"))).alias("word")).where("word <> ''")
    return each.groupBy(*keys).agg(*_votes()).select(*keys, _bits().alias("bits"))


def as_text(bits: Column) -> Column:
    """Sixteen hexadecimal digits."""
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


def likeness(a: Column, b: Column) -> Column:
    """The part of the bits that are equal, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / 64


def _differing(x: str, y: str) -> str:
    return f"bit_count({x} ^ {y})"


def within(prints: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """Pairs of different fingerprints at most ``radius`` bits apart: (a, b) with a < b. ``prints`` has bits.

    The 64 bits are cut into blocks. Fingerprints within the radius agree in at least ``blocks - radius`` of them,
    so there is a table for each choice of so many blocks, keyed by these; each holds every distinct
    fingerprint once. A pair is kept only in the table of its first equal blocks, so it comes up once.
    """
    if not 0 <= radius < blocks <= 64:
        raise ValueError("there must be more blocks than bits that may differ")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    chosen = list(combinations(range(blocks), blocks - radius))

    def key(choice: tuple[int, ...]) -> Column:
        whole = sum(masks[i] for i in choice)
        return F.col("bits").bitwiseAND(F.lit(whole - (1 << 64) if whole >> 63 else whole))

    keyed = prints.select("bits").where("bits is not null").distinct()
    keyed = keyed.select("bits", F.posexplode(F.array(*(key(c) for c in chosen))).alias("number", "key"))
    x, y = keyed.alias("x"), keyed.alias("y")
    pairs = x.join(
        y,
        (F.col("x.number") == F.col("y.number"))
        & (F.col("x.key") == F.col("y.key"))
        & (F.col("x.bits") < F.col("y.bits"))
        & F.expr(f"{_differing('x.bits', 'y.bits')} <= {radius}"),
    )
    equal = F.filter(
        F.array(*(F.when((F.col("x.bits").bitwiseXOR(F.col("y.bits"))).bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(signed))),
        lambda i: i.isNotNull(),
    )
    first = F.slice(equal, 1, blocks - radius)
    own = F.element_at(F.array(*(F.array(*map(F.lit, c)) for c in chosen)), F.col("x.number") + 1)
    return pairs.where(first == own).select(F.col("x.bits").alias("a"), F.col("y.bits").alias("b"))


#: What names a document: rows that are equal in both are copies of one.
_KEY = ["doc_id", "digest"]


def _key_is(row: str) -> Column:
    return F.expr(f"doc_id = {row}_id and digest = {row}_digest")


def _neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, n_chars, copies, next_id, next_digest, before_id, before_digest, before_chars): for each document the one
    after and the one before it in descending order of both, as a ring, with the length of the text before.

    Documents are ordered by ranges; only the first and last of each range are compared across ranges.
    """
    ids = stored(docs.groupBy(*_KEY).agg(F.any_value("n_chars").alias("n_chars"), F.count("*").alias("copies")), "ids")
    order = [F.col(c).desc() for c in _KEY]
    parts = 1 + ids.count() // ORDERED_ROWS
    ranged = stored(ids.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranges")
    own = Window.partitionBy("part").orderBy(*order)
    row = F.struct(*_KEY, "n_chars")
    near = ranged.withColumns({"next": F.lead(row).over(own), "before": F.lag(row).over(own)})
    last = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = (
        ranged.select("part", F.first(row).over(last).alias("head"), F.last(row).over(last).alias("tail")).distinct()
    )  # one row for each range
    line = Window.orderBy("part")
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "part",
        F.coalesce(F.lead("head").over(line), F.first("head").over(whole)).alias("next_head"),
        F.coalesce(F.lag("tail").over(line), F.last("tail").over(whole)).alias("before_tail"),
    )
    near = near.join(ends, "part").withColumns({"next": F.coalesce("next", "next_head"), "before": F.coalesce("before", "before_tail")})
    of = lambda side, c, name: F.col(f"{side}.{c}").alias(f"{side}_{name}")
    sides = [of(side, c, name) for side in ("next", "before") for c, name in (("doc_id", "id"), ("digest", "digest"), ("n_chars", "chars"))]
    return near.select(*_KEY, "n_chars", "copies", *sides)


def edited_fingerprints(docs: DataFrame, radius: int = 3) -> DataFrame:
    """The fingerprint of every text and of its edited text: (doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, n_near).

    In the edited text the last third of the code points (rounded down) gives way to the first as many, or all,
    of the next document by descending doc_id; after the last comes the first. ``n_near`` counts the other
    fingerprints of the table within the radius.

    Takes doc_id and text; other columns are ignored. One row for each input row. Rows that share a doc_id follow one another by
    the hash of their text, equal rows one after the other, so that all but one of them are followed by a copy. A null doc_id counts as the smallest long, and is returned as null. A
    null text is empty; a text without words has the fingerprint zero.
    """
    least = F.lit(-(1 << 63)).cast("long")
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), least).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumns({"digest": F.xxhash64("text"), "n_chars": F.length("text").cast("long")})
    ring = stored(_neighbours(docs), "ring")

    # texts are moved once, by their key; what follows by the key finds them in place
    kept = ("n_chars", "copies", "next_id", "next_digest", "before_id", "before_digest", "before_chars")
    own = docs.select(*_KEY, "text").join(ring, _KEY).groupBy(*_KEY).agg(*(F.any_value(c).alias(c) for c in ("text", *kept)))
    heads = own.select("before_id", "before_digest", F.expr("substring(text, 1, cast(before_chars div 3 as int))").alias("head"))
    pairs = own.join(heads.withColumnsRenamed({"before_id": "its_id", "before_digest": "its_digest"}), _key_is("its"))
    third = "substring(text, 1, cast(n_chars {} as int))"
    before = F.expr(third.format("- n_chars div 3"))
    # a text, as the next document edits it; and, of copies, as a copy does
    texts = F.array("text", F.concat(before, "head"), F.when(F.col("copies") > 1, F.concat(before, F.expr(third.format("div 3")))))
    pairs = pairs.select(*_KEY, "n_chars", "copies", "next_id", "next_digest", texts.alias("texts"))

    both = pairs.select(*_KEY, F.posexplode("texts").alias("kind", "text")).where("text is not null")
    prints = fingerprints(both, [*_KEY, "kind"])
    of_kind = lambda k: F.max(F.when(F.col("kind") == k, F.col("bits")))
    prints = prints.groupBy(*_KEY).agg(of_kind(0).alias("bits"), of_kind(1).alias("edited"), of_kind(2).alias("by_copy"))
    zero = F.lit(0).cast("long")
    digests = [F.sha2(F.col("texts")[k], 256).alias(n) for k, n in ((1, "edited_sha256"), (2, "by_copy_sha256"))]
    known = pairs.select(*_KEY, "n_chars", "copies", "next_id", "next_digest", *digests)
    known = known.join(prints.withColumnsRenamed({"doc_id": "its_id", "digest": "its_digest"}), _key_is("its"), "left").drop("its_id", "its_digest")
    known = stored(known.withColumns({c: F.coalesce(c, zero) for c in ("bits", "edited", "by_copy")}), "fingerprints")

    near = within(known, radius)
    near = near.select(F.explode(F.array("a", "b")).alias("bits")).groupBy("bits").agg(F.count("*").alias("n_near"))
    after = known.select(F.col("doc_id").alias("its_id"), F.col("digest").alias("its_digest"), F.col("bits").alias("next_bits"))
    placed = known.join(after, F.expr("next_id = its_id and next_digest = its_digest")).join(near, "bits", "left")
    each = lambda times, sha, edited, following: F.array_repeat(F.struct(F.col(sha).alias("sha"), F.col(edited).alias("edited"), F.col(following).alias("following")), times)
    rows = F.concat(each(F.lit(1), "edited_sha256", "edited", "next_bits"), each((F.col("copies") - 1).cast("int"), "by_copy_sha256", "by_copy", "bits"))
    return placed.select("doc_id", "n_chars", "bits", "n_near", F.explode(rows).alias("row")).select(
        F.nullif("doc_id", least).alias("doc_id"),
        "n_chars",
        F.col("row.sha").alias("edited_sha256"),
        as_text(F.col("bits")).alias("fingerprint"),
        as_text(F.col("row.edited")).alias("edited_fingerprint"),
        likeness(F.col("bits"), F.col("row.edited")).alias("near_edited"),
        likeness(F.col("bits"), F.col("row.following")).alias("near_next"),
        F.coalesce("n_near", zero).alias("n_near"),
    )
