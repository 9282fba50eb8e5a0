"""N-gram Jaccard join by PartEnum signatures.

Two texts link when ``den * |A & B| >= num * |A | B|`` for their sets of word shingles. With sizes r
and s that bounds the number of shingles which only one has by ``(r + s) * (den - num) / (den + num)``.

Sets meet in instances: one for each band of sizes, and one for each edge between bands, for the sets
near enough to the edge to link across it, from whichever band. Each instance has one bound k on the difference. It cuts the
domain of shingles into parts and enumerates subsets of them, so that a difference of k leaves at least
one subset untouched; the shingles in a subset, hashed, are a signature. Linked sets share one.

* Larger sets: k + 1 + e parts, each a subset. A difference of k leaves e + 1 untouched, so one of them
  is not empty unless a set has more than e empty parts; the few such sets share one more signature.
* Small sets: first-level parts, each cut again; subsets of the second-level parts.

Sets with a signature in common are candidates. They are not all paired: each first meets the smallest of
its group, the links found are joined into components, and only sets of different components that still
share a signature are paired after that. So no link between components is lost, and a group of near
copies needs about one comparison for each. Where many unlike sets share a signature, for the sake of a passage
that all of them have, pairs are not made by signature: linked sets have one of their rarest shingles in
common. A parity sketch, a lower bound of the difference, drops most pairs of unlike sets before their
shingles are fetched. What remains is compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histload.llm.tables import components, stored
from histload.llm.words import mixed, shingle_sets, steps

#: Characters of text for which one more bucket of signatures is opened.
BUCKET_CHARS = 16_000_000
#: Characters of text for which one more task writes intermediate tables.
TASK_CHARS = 4_000_000
#: Signatures that a task gathers before it hands them on, so that buckets get few large pieces.
GATHERED = 2_000_000
#: Bits of the sketch that a join compares; sets of any size have it beside the sketch that fits their size.
PARITY = 512
#: Single comparisons within groups go on until the pairs that are left number no more than this for each row.
PAIRS_PER_ROW = 30
#: They also end when a turn finds fewer links than one for so many sets; the pairs then come by rare shingles.
FEW = 50
#: Classes of shingles that are counted, by the first bits of their hash, to tell rare ones from frequent ones.
CLASS_BITS = 18

SET_SCHEMA = "doc_id long, text_hash long, n_shingles long, vertex long"
GROUP_SCHEMA = "sig long, vertex long"


@lru_cache(maxsize=None)
def _edges() -> list[int]:
    """Sizes at which bands begin: powers of the square root of two."""
    return sorted({math.ceil(2 ** (j / 2)) for j in range(1, 120)})


@lru_cache(maxsize=100_000)
def instances(size: int, num: int, den: int) -> list[tuple[int, int, int, int, int]]:
    """The instances a set of this size joins, as (number, smallest size, first-level parts,
    second-level parts, second-level parts left out). Sets of an instance that differ by at most its
    k share a signature; k covers every linked pair that meets in it."""
    edges, found = _edges(), []
    band = int(np.searchsorted(edges, size, "right"))
    low, high = (edges[band - 1] if band else 1), edges[band] - 1
    found.append((2 * band, low, *_parts(low, high, 2 * high * (den - num) // (den + num))))
    for j, edge in enumerate(edges):  # far edges too, as a linked pair may span whole bands
        least, most = -(-num * edge // den), (edge - 1) * den // num
        if least <= size <= most and most >= edge:
            k = (edge - 1 + most) * (den - num) // (den + num)
            found.append((2 * j + 1, least, *_parts(least, most, k)))
    return found


@lru_cache(maxsize=None)
def _parts(low: int, high: int, k: int) -> tuple[int, int, int]:
    if high > 64:
        n = k + 1
        for _ in range(60):
            empty = n * math.exp(-low / n)
            wanted = k + 2 + math.ceil(empty + 3 * math.sqrt(empty))
            if wanted == n:
                break
            n = wanted
        if n <= 1.7 * (k + 1):
            return n, 1, k
    if k == 0:
        return 1, 1, 0
    out = min(k, 2)
    if k <= 3:
        return 1, k + 3, k
    return -(-(k + 1) // (out + 1)), 5, out


def signatures(values: np.ndarray, size: int, num: int, den: int) -> np.ndarray:
    """All signatures of one sorted set."""
    out = []
    elements = mixed(values ^ np.uint64(0x7F4A7C15F39CC060))
    for number, _, first, second, left_out in instances(size, num, den):
        tag = np.uint64((number + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        if second == 1:
            part = ((values >> np.uint64(32)) * np.uint64(first) >> np.uint64(32)).astype(np.int64)
            heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            sums = np.add.reduceat(elements, heads) + np.diff(np.append(heads, size)).astype(np.uint64)
            out.append(mixed(mixed(sums) + tag + part[heads].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
            # so few parts hold something that a linked set may differ in all of them
            if len(heads) <= min(left_out, size * (den - num) // num):
                out.append(mixed(np.array([tag ^ np.uint64(0xABCD)], np.uint64)))
            continue
        cells = first * second
        part = ((values >> np.uint64(32)) * np.uint64(cells) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(cells, np.uint64)
        np.add.at(sums, part, elements)
        counts = np.bincount(part, minlength=cells).astype(np.uint64)
        sums = mixed(sums + counts).reshape(first, second) * np.arange(1, 2 * second, 2, dtype=np.uint64)
        subsets = list(combinations(range(second), second - left_out))
        chosen = sums[:, np.array(subsets)].sum(axis=2, dtype=np.uint64)
        name = np.arange(first * len(subsets), dtype=np.uint64).reshape(first, -1) * np.uint64(0xD6E8FEB86659FD93)
        out.append(mixed(mixed(chosen) + tag + name).ravel())
    return np.concatenate(out)


def sketch(values: np.ndarray) -> bytes:
    """One bit for each class of shingles: whether the set has an odd number of them. Each shingle that
    only one of two sets has changes one bit, so no more bits differ than shingles."""
    bits = 64
    while bits < 2 * len(values):
        bits *= 2
    return _parity(values, bits).tobytes()


def _parity(values: np.ndarray, bits: int) -> np.ndarray:
    odd = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def least_difference(a: bytes, b: bytes) -> int:
    """A lower bound of the number of shingles that only one has, from two sketches."""
    if len(a) > len(b):
        a, b = b, a
    y = int.from_bytes(b, "little")
    for half in range(len(b).bit_length() - len(a).bit_length(), 0, -1):
        bits = 8 * len(a) << half - 1
        y = (y >> bits) ^ (y & (1 << bits) - 1)
    return (int.from_bytes(a, "little") ^ y).bit_count()


def _vertex(values: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A hash of each whole set; 0 for an empty one."""
    if not len(values):
        return np.zeros(len(place) - 1, np.int64)
    full = place[:-1] < place[1:]
    out = np.zeros(len(full), np.uint64)
    sizes = np.diff(place)[full].astype(np.uint64)
    out[full] = mixed(np.add.reduceat(mixed(values ^ np.uint64(0x1B873593CC9E2D51)), place[:-1][full]) ^ sizes)
    return out.view(np.int64)


def shingled(docs: DataFrame, words: int) -> DataFrame:
    """Per document the hash of its text, the size of its shingle set and the set's hash, null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            values, place = shingle_sets(batch.column("text"), words)
            sizes = np.diff(place)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(sizes),
                    pa.array(_vertex(values, place), mask=sizes == 0),
                ],
                ["doc_id", "text_hash", "n_shingles", "vertex"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, SET_SCHEMA)


def _gather(words: int, num: int, den: int, buckets: int) -> Callable:
    """Map side: the signatures of a task's sets, by bucket.

    A signature goes on once for each piece of a task, with the smallest vertex; its other vertices in
    the piece are known not to be alone and go on as group rows, so that a hot group is not gathered.
    """

    def hand_on(sigs: list[np.ndarray], vertices: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        sig, vertex = np.concatenate(sigs), np.concatenate(vertices)
        order = np.lexsort((vertex, sig))
        sig, vertex = sig[order], vertex[order]
        head = np.concatenate([[True], sig[1:] != sig[:-1]])
        new = head | np.concatenate([[True], vertex[1:] != vertex[:-1]])
        sig, vertex, head = sig[new], vertex[new], head[new]
        more = ~head
        more[:-1] |= ~head[1:]  # and the smallest of a group
        for a in range(0, int(more.sum()), 1 << 16):
            yield _row(None, sig[more][a : a + (1 << 16)], vertex[more][a : a + (1 << 16)])
        sig, vertex = sig[head], vertex[head]
        bucket = (sig >> np.uint64(33)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(ends)).tolist():
            at = order[ends[b] : ends[b + 1]]
            yield _row(b, sig[at], vertex[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, vertices, held = [], [], 0
        for batch in steps(batches):
            values, place = shingle_sets(batch.column("text"), words)
            sets = _vertex(values, place).view(np.uint64)
            for i, (a, b) in enumerate(zip(place[:-1].tolist(), place[1:].tolist())):
                if a < b:
                    sigs.append(signatures(values[a:b], b - a, num, den))
                    vertices.append(np.full(len(sigs[-1]), sets[i]))
                    held += len(sigs[-1])
            if held > GATHERED:
                yield from hand_on(sigs, vertices)
                sigs, vertices, held = [], [], 0
        if held:
            yield from hand_on(sigs, vertices)

    return run


def _row(bucket: int | None, sig: np.ndarray, vertex: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int32()), pa.array([sig.tobytes()], pa.binary()), pa.array([vertex.tobytes()], pa.binary())],
        ["bucket", "sigs", "vertices"],
    )


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce side: rows (sig, vertex) of the signatures that more than one set has."""
    by_bucket: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def rows(sig: np.ndarray, vertex: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(vertex.view(np.int64))], ["sig", "vertex"])

    for batch in batches:
        for bucket, sigs, vertices in zip(*(batch.column(i).to_pylist() for i in range(3))):
            sig, vertex = np.frombuffer(sigs, np.uint64), np.frombuffer(vertices, np.uint64)
            if bucket is None:
                yield rows(sig, vertex)
            else:
                by_bucket.setdefault(bucket, []).append((sig, vertex))
    for bucket in sorted(by_bucket):
        pieces = by_bucket.pop(bucket)
        sig, vertex = (np.concatenate([p[i] for p in pieces]) for i in (0, 1))
        order = np.lexsort((vertex, sig))
        sig, vertex = sig[order], vertex[order]
        same = sig[1:] == sig[:-1]
        new = ~(same & (vertex[1:] == vertex[:-1]))
        keep = np.concatenate([[True], new])
        sig, vertex = sig[keep], vertex[keep]
        same = sig[1:] == sig[:-1]
        shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        if shared.any():
            yield rows(sig[shared], vertex[shared])


def signature_groups(docs: DataFrame, words: int, num: int, den: int, chars: int) -> DataFrame:
    """Rows (sig, vertex) of every signature that more than one set has; rows may repeat. The texts have
    ``chars`` characters."""
    buckets = 1 + chars // BUCKET_CHARS
    blobs = docs.select("text").mapInArrow(_gather(words, num, den, buckets), "bucket int, sigs binary, vertices binary")
    key = F.coalesce("bucket", (F.rand(7) * buckets).cast("int"))
    return blobs.repartition(buckets, key).mapInArrow(_meet, GROUP_SCHEMA)


def _not_apart(x: str, y: str, num: int, den: int) -> str:
    """SQL condition that sizes and parities of two sides don't rule out a link."""
    differ = " + ".join(f"bit_count({x}.parity[{i}] ^ {y}.parity[{i}])" for i in range(PARITY // 64))
    sizes = f"{den} * least({x}.n_shingles, {y}.n_shingles) >= {num} * greatest({x}.n_shingles, {y}.n_shingles)"
    return f"{sizes} and ({differ}) * {den + num} <= ({x}.n_shingles + {y}.n_shingles) * {den - num}"


def _possible(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches don't rule out."""
    pairs = (
        pairs.join(sets.select(F.col("vertex").alias("a"), F.struct("n_shingles", "sketch", "parity").alias("x")), "a")
        .join(sets.select(F.col("vertex").alias("b"), F.struct("n_shingles", "sketch", "parity").alias("y")), "b")
        .where(_not_apart("x", "y", num, den))
        .selectExpr("a", "b", "x.n_shingles as na", "y.n_shingles as nb", "x.sketch as sa", "y.sketch as sb")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb, sa, sb = (batch.column(c).to_pylist() for c in ("na", "nb", "sa", "sb"))
            near = [least_difference(x, y) * (den + num) <= (m + n) * (den - num) for m, n, x, y in zip(na, nb, sa, sb)]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return pairs.mapInArrow(run, "a long, b long")


def _compared(docs: DataFrame, chosen: DataFrame, words: int) -> DataFrame:
    """What comparisons need of each vertex, (vertex, n_shingles, sketch, parity, shingles), from one of its documents,
    which ``chosen`` names by doc_id, null or not, and the hash of its text."""
    chosen = chosen.withColumnsRenamed({"doc_id": "id", "text_hash": "hash"})
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(chosen, F.expr("doc_id <=> id and xxhash64(text) = hash")).select("text", "vertex")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            values, place = shingle_sets(batch.column("text"), words)
            at = np.flatnonzero((_vertex(values, place) == batch.column("vertex").to_numpy()) & (np.diff(place) > 0))
            own = [values[place[i] : place[i + 1]] for i in at]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vertex").take(pa.array(at)),
                    pa.array([len(v) for v in own], pa.int64()),
                    pa.array([sketch(v) for v in own], pa.binary()),
                    pa.array([_parity(v, PARITY).view(np.int64) for v in own], pa.list_(pa.int64())),
                    pa.array([v.tobytes() for v in own], pa.binary()),
                ],
                ["vertex", "n_shingles", "sketch", "parity", "shingles"],
            )

    # a row may come again
    return texts.mapInArrow(run, "vertex long, n_shingles long, sketch binary, parity array<long>, shingles binary").dropDuplicates(["vertex"])


def _linked(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose sets link, compared shingle by shingle."""
    both = pairs.join(sets.select(F.col("vertex").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("vertex").alias("b"), F.col("shingles").alias("sb")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(x, y)
                common = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                near.append(den * common >= num * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _star(rest: DataFrame, turn: int) -> DataFrame:
    """Pairs (a, b): of the components in a signature's group, one set of each with one of the first.
    Another turn takes other sets."""
    order = F.xxhash64("vertex", F.lit(turn)) if turn else F.col("vertex")
    one = rest.groupBy("sig", "label").agg(F.min(F.struct(order.alias("o"), "vertex")).alias("m"))
    lead = one.groupBy("sig").agg(F.min("m").alias("lead"))
    return one.join(lead, "sig").where("m <> lead").select(F.col("lead.vertex").alias("a"), F.col("m.vertex").alias("b")).distinct()


def _open(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """The groups that still hold sets of several components, as (sig, vertex, label)."""
    labelled = groups.join(labels.withColumnRenamed("v", "vertex"), "vertex", "left").select(
        "sig", "vertex", F.coalesce("label", "vertex").alias("label")
    )
    several = labelled.groupBy("sig").agg(F.min("label").alias("l"), F.max("label").alias("m")).where("l < m").select("sig")
    return labelled.join(several, "sig")


def _cross_pairs(rest: DataFrame) -> tuple[int, int]:
    """How many rows there are, and pairs of sets of different components within a group."""
    by_label = rest.groupBy("sig", "label").agg(F.count("*").alias("n"))
    by_sig = by_label.groupBy("sig").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"))
    rows, pairs = by_sig.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("own")) / 2)).first()
    return rows or 0, int(pairs or 0)


def _pairs_within(rest: DataFrame, known: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of sets of different components that share a signature, if sizes and parities don't rule them out."""
    return _unlike(rest.join(known.select("vertex", "n_shingles", "parity"), "vertex"), "sig", num, den)


def _pairs_by_rare(rest: DataFrame, known: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of sets of different components, among them all that link, by rare shingles.

    Put in one order, the same for all sets, each set's first ones, all but ``num / den`` of it and one more, hold a
    shingle of every linked set's first ones. The order is by the count of a shingle's class over the sets of
    ``rest``, so that a passage that many of them have comes last.
    """
    sets = known.join(rest.select("vertex", "label").distinct(), "vertex").select("vertex", "label", "n_shingles", "parity", "shingles")
    shift = np.uint64(64 - CLASS_BITS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << CLASS_BITS, np.int64)
        for batch in batches:
            for blob in batch.column("shingles"):
                total += np.bincount((np.frombuffer(blob.as_buffer(), np.uint64) >> shift).astype(np.int64), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["class", "n"])

    # as many rows as there are classes, at most
    counted = sets.select("shingles").mapInArrow(count, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(1 << CLASS_BITS, np.int64)
    frequency[counted["class"].to_numpy()] = counted["n"].to_numpy()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "shingles"):
            chosen = []
            for blob in batch.column("shingles"):
                values = np.frombuffer(blob.as_buffer(), np.uint64)
                order = np.lexsort((values, frequency[(values >> shift).astype(np.int64)]))
                chosen.append(values[order[: len(values) + num * len(values) // -den + 1]].view(np.int64))
            rows = pa.array(np.repeat(np.arange(len(chosen)), [len(c) for c in chosen]))
            key = pa.array(np.concatenate(chosen) if chosen else np.zeros(0, np.int64))
            yield batch.select(["vertex", "label", "n_shingles", "parity"]).take(rows).append_column("key", key)

    keyed = sets.mapInArrow(first, "vertex long, label long, n_shingles long, parity array<long>, key long")
    return _unlike(keyed, "key", num, den)


def _unlike(sets: DataFrame, key: str, num: int, den: int) -> DataFrame:
    met = F.expr(f"x.{key} = y.{key} and x.label < y.label and {_not_apart('x', 'y', num, den)}")
    vertices = F.least("x.vertex", "y.vertex").alias("a"), F.greatest("x.vertex", "y.vertex").alias("b")
    return sets.alias("x").join(sets.alias("y"), met).select(*vertices).distinct()


def labelled(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Rows as `near_components` gives them, with text_hash and the label of their component, null for an empty set."""
    sets = stored(shingled(docs, words), "shingled")
    full = sets.where("n_shingles > 0")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    tasks = 1 + chars // TASK_CHARS
    groups = stored(signature_groups(docs, words, num, den, chars).distinct(), "groups", tasks)
    # a set's copies are a few rows before they are moved
    least = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")).alias("m")
    firsts = full.groupBy("vertex").agg(least).select("vertex", "m.doc_id", "m.text_hash")
    chosen = firsts.join(groups.select("vertex").distinct(), "vertex")
    known = stored(_compared(docs, chosen, words), "known", tasks)
    distinct = known.count()
    rest, links, labels = groups.withColumn("label", F.col("vertex")), None, None
    for turn in range(1_000_000):
        star = _possible(_star(rest, turn), known, num, den)
        if not turn:  # one comparison for each set to begin with
            star = star.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        found = stored(_linked(stored(star, "star", tasks), known, num, den), "links_star", tasks)
        links = found if links is None else links.union(found)
        labels = stored(components(links, tasks=tasks), "labels", tasks)
        rest = stored(_open(groups, labels), "rest", tasks)
        rows, left = _cross_pairs(rest)
        pairs_of = _pairs_within if left <= PAIRS_PER_ROW * rows else _pairs_by_rare
        if pairs_of is _pairs_within or found.count() * FEW < distinct:
            break
    pairs = pairs_of(rest, known, num, den)
    links = links.union(_linked(stored(_possible(pairs, known, num, den), "pairs", tasks), known, num, den))

    labels = components(links, tasks=tasks)
    named = firsts.join(labels.withColumnRenamed("v", "vertex"), "vertex", "left").withColumn("label", F.coalesce("label", "vertex"))
    smallest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = named.join(smallest, "label").select("vertex", "label", "component_id")
    return sets.join(named, "vertex", "left").select(
        "doc_id", "text_hash", "n_shingles", "label", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def near_components(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Documents linked by shingle sets with a Jaccard similarity of ``num / den`` or more.

    Takes doc_id and text; other columns are ignored. Returns one row for each input row: doc_id,
    n_shingles, component_id (the smallest doc_id reachable by links, its own included).

    Null and empty texts, and texts without words, have no shingles and link with nothing. Rows that
    repeat a text count as linked copies; rows that repeat a doc_id only if their texts link, so a doc_id may
    be in several components. A null doc_id takes part, but names no component: one of null doc_ids only has none.
    Sets are told apart by a 64-bit hash of their shingles, themselves 64-bit hashes of their words.
    """
    return labelled(docs, words, num, den).select("doc_id", "n_shingles", "component_id")
