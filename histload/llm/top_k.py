"""Exact top-k search by inner product, in buckets of vectors of like length.

Vectors are grouped by length: the shortest of a bucket has at least nine tenths of the longest's. A query's k-th best
score among some of the longest vectors is a floor for its results. For a bucket the floor turns into a local
threshold on the cosine: no vector below it can be a result. If it is above 1, the bucket is left out. If it
is high, the bucket is pruned by coordinates: where the query is largest, a vector at least that close to it lies in a
known interval. Else it is pruned by length: vectors sorted by length, the short ones cannot reach the
floor. What is left is verified by exact integer products.

Where lengths leave much, as they do if all vectors are nearly of one length, the longest of a block are scored first, which
raises the floor to what the block itself holds, and then ever larger parts. For these the product over the leading coordinates, with the lengths of
what remains, bounds the whole product; only pairs whose bound reaches the floor are multiplied out. How many coordinates lead,
or all, is decided for each part by what that would cost on a sample of its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from histload.llm.tables import stored

RATIO = 0.9
#: Rows of a bucket that one task compares with so many queries; larger buckets are cut by a hash.
BLOCK, GROUP = 16384, 8192
#: Longest vectors whose scores set the floors: one in SEED_SHARE, no more than SEEDS.
SEEDS, SEED_SHARE = 2048, 16
#: Vectors of a block that are scored first, to raise its floors, and how the share grows that is scored with these floors.
LEAD, GROWTH = 1024, 4
#: Shares of the coordinates that may lead, and what a pair costs that is multiplied out alone, in products within a matrix.
SHARES, PAIR = (0.125, 0.25, 0.5, 0.75, 0.875), 10
#: Queries and vectors on which that is measured; pairs that are multiplied out at once.
SAMPLE, PAIRS = (32, 256), 1 << 16
#: Local thresholds from which coordinates prune more than lengths.
CLOSE = 0.7
#: Coordinates that prune.
FOCUS = 3
#: Queries that are multiplied at once.
AT_ONCE = 128

_RESULT = "query_id long, vec_id long, score long"


def scaled(embedding: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each component as a double; null if one is null or not finite."""
    doubles = embedding.cast("array<double>")
    usable = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(usable, F.transform(doubles, lambda x: F.floor(x * factor).cast("long")))


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones get zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(column)), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = column.flatten().to_numpy()
    return out


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer products: by floating point where that is exact, else by integers."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if most >= 2**63:
        raise OverflowError("inner products do not fit into 64 bits")
    return (q.astype(float) @ c.T.astype(float)).astype(np.int64) if most < 2**53 else q @ c.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties to smaller ids."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= least)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m.astype(float) ** 2).sum(axis=1))


def _exact_in_floats(q: np.ndarray, c: np.ndarray) -> bool:
    return float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1]) < 2**53


class _Leading:
    """A block's coordinates in order of their part in its products, for products that are whole numbers as floats."""

    def __init__(self, q: np.ndarray, c: np.ndarray):
        order = np.argsort(-((q.astype(float) ** 2).mean(axis=0) * (c.astype(float) ** 2).mean(axis=0)), kind="stable")
        self.q, self.c = q[:, order].astype(float), c[:, order].astype(float)
        # rounding of bounds, against the lengths of the vectors
        self.slack = 1e-9 * _norms(q) * _norms(c).max(initial=0)

    def _bounds(self, rows: np.ndarray, columns: np.ndarray | slice, floors: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        q, c = self.q[rows], self.c[columns]
        known = q[:, :size] @ c[:, :size].T
        rest = np.outer(_norms(q[:, size:]), _norms(c[:, size:])) + self.slack[rows][:, None]
        return known, known + rest >= floors[rows][:, None]

    def best_size(self, floors: np.ndarray, start: int, end: int) -> int:
        """How many coordinates to multiply first between two rows of the block, by cost on a sample; all, if nothing is gained."""
        rows = np.linspace(0, len(self.q) - 1, min(SAMPLE[0], len(self.q))).astype(int)
        columns = np.linspace(start, end - 1, min(SAMPLE[1], end - start)).astype(int)
        width = self.c.shape[1]
        least, best = 1.0, width
        for size in (int(share * width) for share in SHARES):
            left = self._bounds(rows, columns, floors, size)[1].mean()
            cost = size / width + left * PAIR * (1 + width - size) / (1 + width)
            if cost < least:
                least, best = cost, size
        return best

    def scores(self, rows: np.ndarray, start: int, end: int, floors: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in rows, row of the block, product) wherever a product may reach the floor."""
        known, reaching = self._bounds(rows, slice(start, end), floors, size)
        left, right = np.nonzero(reaching)
        parts = [np.zeros(0)]
        for a in range(0, len(left), PAIRS):
            i, j = left[a : a + PAIRS], right[a : a + PAIRS]
            parts.append(known[i, j] + np.einsum("ij,ij->i", self.q[rows[i], size:], self.c[start + j, size:]))
        return left, start + right, np.concatenate(parts).astype(np.int64)


def search_block(query_ids: np.ndarray, q: np.ndarray, floors: np.ndarray, ids: np.ndarray, c: np.ndarray, k: int, counted: dict | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best k of a block for each query, as far as they can be among all: (query_id, vec_id, score). ``counted`` takes how
    many pairs were bounded by their leading coordinates, and how many of these were multiplied out."""
    lengths = _norms(c)
    order = np.argsort(-lengths, kind="stable")
    ids, c, lengths = ids[order], c[order], lengths[order]
    own_lengths = _norms(q)
    # slack for rounding, so that no vector at the floor is left out
    floors = np.where(np.isfinite(floors), floors - 1e-9 * np.abs(floors) - 1e-6, -np.inf)
    longest = lengths[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(floors > 0, floors / (own_lengths * longest), -np.inf)
        shortest = np.where(floors > 0, floors / own_lengths, -np.inf)
    counted = {} if counted is None else counted
    counted.update(bounded=0, multiplied=0)
    kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def keep(i: int, scores: np.ndarray, at: np.ndarray) -> None:
        """The best so far; the k-th of them is a floor for what follows."""
        other = ids[at] != query_ids[i]
        known = kept.get(i, (np.zeros(0, np.int64),) * 2)
        at, scores = np.concatenate([known[0], ids[at][other]]), np.concatenate([known[1], scores[other]])
        best = _best(scores, at, k)
        kept[i] = at[best], scores[best]
        if len(best) == k:
            floors[i] = max(floors[i], scores[best[-1]] - 1e-9 * abs(scores[best[-1]]) - 1e-6)

    unit = c / np.maximum(lengths, 1e-300)[:, None]
    by_length = []
    for i in np.flatnonzero(~(local > 1)):
        if local[i] < CLOSE:
            by_length.append(i)
            continue
        direction, t = q[i] / own_lengths[i], local[i]
        inside = np.arange(int(np.searchsorted(-lengths, -shortest[i], "right")))
        for f in np.argsort(-np.abs(direction))[:FOCUS]:
            middle = direction[f] * t
            reach = math.sqrt(max(0.0, (1 - direction[f] ** 2) * (1 - t * t))) + 1e-9
            # closer than t: the interval widens towards the query's own coordinate
            low = middle - reach if -direction[f] < t else -1.0
            high = middle + reach if direction[f] < t else 1.0
            x = unit[inside, f]
            inside = inside[(x >= low) & (x <= high)]
        if len(inside):
            keep(i, _exact(q[i : i + 1], c[inside])[0], inside)
    def reach(some: np.ndarray) -> int:
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(floors[some] > 0, floors[some] / own_lengths[some], -np.inf).min()
        return int(np.searchsorted(-lengths, -least, "right"))

    groups = [np.array(by_length[a : a + AT_ONCE]) for a in range(0, len(by_length), AT_ONCE)]
    leading = _Leading(q, c) if groups and len(c) > LEAD and q.shape[1] and _exact_in_floats(q, c) else None
    start, end = 0, min(LEAD, len(c))
    while groups and start < end:
        size = leading.best_size(floors, start, end) if leading and start else q.shape[1]
        for some in groups:
            stop = min(end, reach(some))
            if stop <= start:
                continue
            if size == q.shape[1]:
                at = np.arange(start, stop)
                for i, row in zip(some, _exact(q[some], c[start:stop])):
                    keep(i, row, at)
            else:
                rows, at, scores = leading.scores(some, start, stop, floors, size)
                counted["bounded"] += len(some) * (stop - start)
                counted["multiplied"] += len(rows)
                cuts = np.searchsorted(rows, np.arange(len(some) + 1))
                for j, i in enumerate(some):
                    part = slice(cuts[j], cuts[j + 1])
                    keep(i, scores[part], at[part])
        start, end = end, min(GROWTH * end, len(c))
    found = [(np.full(len(at), query_ids[i]), at, scores) for i, (at, scores) in kept.items()]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """Of each query, the k vectors with the highest inner products: (query_id, rank, vec_id, score).

    Both take vec_id (long) and v (array of longs); other columns are ignored. A vector is no candidate for a query of
    its own vec_id. Ties go to the smaller vec_id; a query with fewer candidates gets fewer rows. Rows
    whose vec_id or v is null take no part; of rows that repeat a vec_id, the smallest v counts. Vectors of
    different sizes are compared as if the shorter ended with zeros. Products that do not fit into 64 bits raise.
    """
    one = lambda df: df.where("vec_id is not null and v is not null").groupBy("vec_id").agg(F.min("v").alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    length = F.sqrt(squares)
    bucket = F.when(length > 0, F.floor(F.log(length) / -math.log(RATIO))).otherwise(-1).cast("int")
    own = stored(one(vectors).withColumns({"length": length, "bucket": bucket}), "vectors")
    asked = one(queries)

    # lengths are doubles, so there are some thousand buckets at most, whatever the number of vectors
    stats = own.groupBy("bucket").agg(F.count("*").alias("n"), F.max("length").alias("longest"), F.max(F.size("v")).alias("width")).orderBy(F.desc("bucket")).collect()
    if not stats:
        return asked.selectExpr("vec_id as query_id", "0 as rank", "vec_id", "0L as score").limit(0)
    width = max([r["width"] for r in stats] + [asked.agg(F.max(F.size("v"))).first()[0] or 0])

    n_seeds = min(SEEDS, max(k + 1, sum(r["n"] for r in stats) // SEED_SHARE))
    seeds = own.orderBy(F.desc("length"), "vec_id").limit(n_seeds).select("vec_id", "v").toArrow()
    seed_ids, seed_rows = seeds["vec_id"].to_numpy(), _matrix(seeds["v"], width)

    def floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, q = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"), width)
            floors = np.full(len(ids), -np.inf)
            for a in range(0, len(ids), AT_ONCE):
                for i, scores in enumerate(_exact(q[a : a + AT_ONCE], seed_rows), a):
                    scores = scores[seed_ids != ids[i]]
                    if len(scores) >= k:
                        floors[i] = np.partition(scores, len(scores) - k)[len(scores) - k]
            yield batch.append_column("floor", pa.array(floors)).append_column("length", pa.array(_norms(q)))

    asked = stored(asked.select("vec_id", "v").mapInArrow(floor, "vec_id long, v array<long>, floor double, length double"), "queries")
    groups = 1 + asked.count() // GROUP
    blocks = {r["bucket"]: 1 + r["n"] // BLOCK for r in stats}
    longest = {r["bucket"]: r["longest"] for r in stats}

    # a query goes to the buckets where it can reach its floor, once for each of their blocks
    def reachable(b: int) -> Column:
        fits = F.col("floor") <= F.col("length") * longest[b] * (1 + 1e-9) + 1e-6
        return F.when(fits, F.transform(F.sequence(F.lit(0), F.lit(blocks[b] - 1)), lambda i: F.struct(F.lit(b).alias("bucket"), i.alias("block"))))

    places = F.flatten(F.filter(F.array(*map(reachable, blocks)), lambda x: x.isNotNull()))
    group = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups)).cast("int")
    left = asked.select("vec_id", "v", "floor", group.alias("team"), F.explode(places).alias("p")).select("vec_id", "v", "floor", "team", "p.bucket", "p.block")
    n_blocks = F.element_at(F.create_map(*(F.lit(x) for b in blocks.items() for x in b)), F.col("bucket"))
    block = F.pmod(F.xxhash64("vec_id"), n_blocks).cast("int")
    right = own.select("vec_id", "v", "bucket", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("team"))

    def compare(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if queries.num_rows and candidates.num_rows:
            columns = search_block(
                queries["vec_id"].to_numpy(), _matrix(queries["v"], width), queries["floor"].to_numpy(), candidates["vec_id"].to_numpy(), _matrix(candidates["v"], width), k
            )
        else:
            columns = (np.zeros(0, np.int64),) * 3
        return pa.table([pa.array(x, pa.int64()) for x in columns], ["query_id", "vec_id", "score"])

    keys = ("bucket", "block", "team")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, _RESULT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
