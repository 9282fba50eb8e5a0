"""Best-fit packing of token sequences by a grouping genetic algorithm.

Documents of the same length are interchangeable, so a solution is a list of bins written as (lengths,
how often): its size depends on the capacity, not on the corpus, and the search covers all documents at once.
A gene is such a bin. Crossover takes well-filled bins of one parent whole, drops the other parent's bins whose
documents are placed by then (as often as they are), and puts the displaced documents where they fit best. Mutation
empties bins that are not full and some others. What it displaces is, every other time, first packed anew into bins as tight as a
short search finds, which best fit, that only ever adds a document to a bin, cannot. The search ends when no fewer bins are possible.

Islands, one task each, evolve populations of their own; between epochs each sends its best solution to the
next. The best of all is handed out: each document takes the place of its rank among those of its length.
"""

from __future__ import annotations

import json
import random
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from histload.llm.bpe import Finish, encode_rows
from histload.llm.tables import stored, tasks_after

Bin = tuple[int, ...]
Solution = dict[Bin, int]

ISLANDS, POPULATION, EPOCHS, GENERATIONS = 6, 6, 3, 12
#: A bin is well filled if it leaves no more than this part of its capacity free.
WELL_FILLED = 0.01

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, place long"


def best_fit(counts: dict[int, int], capacity: int, order: list[int], bins: Solution | None = None) -> Solution:
    """Places ``counts[length]`` documents of each length, in the given order of lengths, each in the
    bin that it fills best, or in a new one. Like bins are filled together."""
    room: dict[int, Solution] = {}
    free = 0  # a bit for each amount of room that some bin has

    def put(b: Bin, left: int, n: int) -> None:
        nonlocal free
        room.setdefault(left, {})
        room[left][b] = room[left].get(b, 0) + n
        free |= 1 << left

    for b, n in (bins or {}).items():
        put(b, capacity - sum(b), n)
    for length in order:
        n = counts.get(length, 0)
        while n:
            fitting = free >> length
            if not fitting:
                each = capacity // length
                if n // each:
                    put((length,) * each, capacity - each * length, n // each)
                if n % each:
                    put((length,) * (n % each), capacity - n % each * length, 1)
                break
            left = length + (fitting & -fitting).bit_length() - 1
            b, m = room[left].popitem()
            if m > n:
                room[left][b] = m - n
            if not room[left]:
                free &= ~(1 << left)
            put((*b, length), left - length, min(m, n))
            n -= min(m, n)
    out: Solution = {}
    for bins_of in room.values():
        for b, m in bins_of.items():
            key = tuple(sorted(b, reverse=True))
            out[key] = out.get(key, 0) + m
    return out


#: Documents that a search for one tight bin looks at, and lengths up to which tight bins are searched for.
LOOKS, MOST_LENGTHS = 400, 1024


def tightest(counts: dict[int, int], lengths: list[int], capacity: int, first: int, rng: random.Random) -> Bin:
    """A bin with ``first`` that leaves as little room as a short search finds. ``lengths`` rise and are those left."""
    best, looks = (first,), LOOKS

    def extend(held: Bin, room: int, top: int) -> bool:
        """Adds lengths from lengths[:top]; whether the bin is full."""
        nonlocal best, looks
        top = bisect_right(lengths, room, 0, top)
        start = rng.randrange(top) if top else 0
        for i in [*range(start, -1, -1), *range(top - 1, start, -1)] if top else ():
            looks -= 1
            x = lengths[i]
            if held.count(x) >= counts[x]:
                continue
            grown, left = (*held, x), room - x
            if capacity - left > sum(best):
                best = grown
            if not left:
                return True
            closing = bisect_right(lengths, left, 0, i + 1) - 1
            if closing >= 0 and lengths[closing] == left and grown.count(left) < counts[left]:
                best = (*grown, left)
                return True
            if looks < 0:
                return False
            if closing >= 0 and extend(grown, left, i + 1):
                return True
        return False

    extend((first,), capacity - first, len(lengths))
    return best


def tight_bins(counts: dict[int, int], capacity: int, rng: random.Random) -> Solution:
    """All documents in bins, one as tight as possible after the other, for the longest document that is left; as often as there
    are documents for it."""
    left, out = {x: n for x, n in counts.items() if n}, {}
    lengths = sorted(left)
    while lengths:
        b = tightest(left, lengths, capacity, lengths[-1], rng)
        held = Counter(b)
        n = min(left[x] // k for x, k in held.items())
        key = tuple(sorted(b, reverse=True))
        out[key] = out.get(key, 0) + n
        for x, k in held.items():
            left[x] -= n * k
            if not left[x]:
                lengths.remove(x)
    return out


def quality(solution: Solution) -> tuple[int, int]:
    """Fewer bins are better, then fuller ones beside emptier ones. Smaller is better."""
    return sum(solution.values()), -sum(n * sum(b) ** 2 for b, n in solution.items())


def crossover(first: Solution, second: Solution, counts: dict[int, int], capacity: int, rng: random.Random) -> Solution:
    """Some well-filled bins of the second, what fits beside them of the first, the rest by best fit."""
    least = capacity - int(capacity * WELL_FILLED)
    child = {b: n for b, n in second.items() if sum(b) >= least and rng.random() < 0.5}
    return _completed(child, first, counts, capacity, rng)


def mutation(solution: Solution, counts: dict[int, int], capacity: int, rng: random.Random) -> Solution:
    """Empties many of the bins that are not full, and some others."""
    often = rng.choice((0.1, 0.5, 1.0))
    lost = {b for b in solution if rng.random() < (often if sum(b) < capacity else 0.1 * often)}
    lost |= set(sorted(solution, key=sum)[:1])
    return _completed({}, {b: n for b, n in solution.items() if b not in lost}, counts, capacity, rng)


def _completed(child: Solution, others: Solution, counts: dict[int, int], capacity: int, rng: random.Random) -> Solution:
    left = dict(counts)
    for b, n in child.items():
        for length in b:
            left[length] -= n
    child = dict(child)
    for b in sorted(others, key=lambda b: (-sum(b), rng.random())):
        n = min(others[b], *(left[length] // k for length, k in Counter(b).items()))
        if n > 0:
            child[b] = child.get(b, 0) + n
            for length in b:
                left[length] -= n
    displaced = sorted((x for x, n in left.items() if n), reverse=True)
    if rng.random() < 0.5 and len(displaced) <= MOST_LENGTHS:
        for b, n in tight_bins(left, capacity, rng).items():
            child[b] = child.get(b, 0) + n
        return child
    return best_fit(left, capacity, displaced, child)


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer bins."""
    return -(-sum(x * n for x, n in counts.items()) // capacity)


def evolve(population: list[Solution], counts: dict[int, int], capacity: int, generations: int, rng: random.Random) -> list[Solution]:
    """The population after some generations; each child replaces the worst if it is better and new."""
    while len(population) < POPULATION:
        noise = 0.03 * len(population)
        order = sorted(counts, key=lambda x: -x * (1 + noise * rng.uniform(-1, 1)))
        tight = len(population) % 2 and len(counts) <= MOST_LENGTHS
        population.append(tight_bins(counts, capacity, rng) if tight else best_fit(counts, capacity, order))
    population = sorted(population, key=quality)
    for _ in range(generations):
        if quality(population[0])[0] <= least_bins(counts, capacity):
            break
        first, second = sorted(rng.sample(range(len(population)), 2))
        if rng.random() < 0.5:
            first, second = second, first
        child = crossover(population[first], population[second], counts, capacity, rng)
        if rng.random() < 0.4:
            child = mutation(child, counts, capacity, rng)
        if quality(child) < quality(population[-1]) and child not in population:
            population = sorted([*population[:-1], child], key=quality)
    return population


def _written(population: list[Solution]) -> str:
    return json.dumps([[[list(b), n] for b, n in s.items()] for s in population])


def _read(text: str) -> list[Solution]:
    return [{tuple(b): n for b, n in s} for s in json.loads(text)]


def search(spark, counts: dict[int, int], capacity: int, islands: int = ISLANDS, epochs: int = EPOCHS, generations: int = GENERATIONS) -> Solution:
    """The best bins found for ``counts[length]`` documents of each length. ``counts`` has at most one
    entry for each length up to the capacity; it goes to each island as it is."""

    def run(epoch: int):
        def step(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for island, population, guest in zip(frame["island"], frame["population"], frame["guest"]):
                    own = _read(population)
                    own += [s for s in _read(guest) if s not in own]
                    own = evolve(own, counts, capacity, generations, random.Random(1000 * epoch + int(island)))[:POPULATION]
                    yield pd.DataFrame({"island": [island], "population": [_written(own)], "elite": [_written(own[:1])], "bins": [quality(own[0])[0]], "fill": [float(quality(own[0])[1])]})

        return step

    state = spark.range(islands).selectExpr("id as island", "'[]' as population", "'[]' as elite")
    for epoch in range(epochs):
        sent = state.select(((F.col("island") + 1) % islands).alias("island"), F.col("elite").alias("guest"))
        state = stored(
            state.select("island", "population").join(sent, "island").repartition(islands, "island").mapInPandas(run(epoch), "island long, population string, elite string, bins long, fill double"),
            f"islands_{epoch}",
        )
    return _read(state.orderBy("bins", "fill", "island").select("elite").first()[0])[0]


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """Every document's ids with ``end_id`` after them, cut if longer than the capacity: (doc_id, piece, start,
    length, ids_crc32, part, place). The first piece is the shorter one. ``place`` numbers the pieces of a
    length within ``part``, a task's rows."""

    def finish(kind: int) -> Finish:
        part = 2 * TaskContext.get().partitionId() + kind
        seen = np.zeros(capacity + 1, np.int64)

        def make(doc_ids: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
            rows: list[list] = [[] for _ in range(6)]
            which = []
            for i, own in enumerate(ids):
                own = np.append(own, end_id).astype("<u4")
                cuts = [0, *range(len(own) % capacity or capacity, len(own) + 1, capacity)]
                for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    which.append(i)
                    for column, value in zip(rows, (n, a, b - a, zlib.crc32(own[a:b].tobytes()), part, int(seen[b - a]))):
                        column.append(value)
                    seen[b - a] += 1
            types = (pa.int32(), *[pa.int64()] * 5)
            return pa.RecordBatch.from_arrays(
                [doc_ids.take(pa.array(which, pa.int64())), *(pa.array(c, t) for c, t in zip(rows, types))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"],
            )

        return make

    return encode_rows(docs, path, finish, PIECES)


def pack(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2, **how: int) -> DataFrame:
    """All documents, as pieces in sequences of at most ``capacity`` tokens: (doc_id, piece, start, length,
    ids_crc32, sequence_id, offset).

    Takes doc_id and text; other columns are ignored. Only documents longer than the capacity are cut. A null
    or empty text is one piece with ``end_id`` alone; repeated rows are packed as often as they are there. Places
    within a sequence are gapless from 0. ``how`` goes to `search`.
    """
    spark = docs.sparkSession
    items = stored(pieces(docs, path, capacity, end_id), "pieces")
    per_part = stored(items.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths", tasks_after(items))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    best = search(spark, {x: n for x, n in counts.items() if x < capacity}, capacity, **how) if set(counts) - {capacity} else {}
    if capacity in counts:
        best[(capacity,)] = counts[capacity]

    # one slot for each place in a bin; a slot of n like bins takes the next n documents of its length
    slots, at, used = [], 0, Counter()
    for b, n in sorted(best.items()):
        offset = 0
        for length in b:
            slots.append((length, used[length], at, offset))
            used[length] += n
            offset += length
        at += n
    table = np.array(sorted(slots), np.int64).reshape(-1, 4)
    keys = (table[:, 0] << 44) + table[:, 1]

    def hand_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            slot = np.searchsorted(keys, (batch.column("length").to_numpy() << 44) + rank, "right") - 1
            sequence = table[slot, 2] + rank - table[slot, 1]
            own = batch.select(["doc_id", "piece", "start", "length", "ids_crc32"])
            yield own.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(table[slot, 3]))

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    # the offsets grow with the tasks that found the pieces, so they are not broadcast
    ranked = items.join(starts.hint("merge"), ["part", "length"]).withColumn("rank", F.col("first") + F.col("place"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        hand_out, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
