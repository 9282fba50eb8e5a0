"""Scores of documents by masked pseudo-likelihood.

Words are classes: the most frequent words of the corpus one each, all others by their last letters. A network sees
the two words before and the two after a place, not the word itself, and predicts it in two steps: its group of
classes, then its class within the group. It is trained in numpy on every word of every document: each task trains
on its own documents, the results are averaged by the words they have seen, and the next round goes on from
there. Within its class a word has a share, from the counts of all words of the corpus. Class and share are a
word's prior. What the corpus holds between the same two neighbours is evidence, which grows with the corpus: a word that
came k times of n between its neighbours, its own place not counted, has the probability (k + PRIOR * prior) / (n + PRIOR). So a
passage that is found elsewhere is likely, however rare its words. Places meet in buckets by the hash of their
neighbours; those of neighbours that come very often are spread by the word between them, or settled where they are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histload.llm.tables import stored
from histload.llm.words import LOWER, hash_words, mixed, split_words, steps, text_bytes

#: Groups, and classes in a group. Half of the classes are frequent words, half endings of the others.
SIDE = 32
CLASSES = SIDE * SIDE
FREQUENT = CLASSES // 2
#: Words before and after a place; numbers that stand for a word, and in the hidden layer.
REACH, WIDTH, HIDDEN = 2, 8, 24
#: Words in a step of training.
BATCH = 4096
RATE = 0.15
#: Words beside the frequent ones that have a count of their own in each task; those beyond share what is left of their class.
KNOWN = 200_000
#: Occurrences that the prior counts for.
PRIOR = 1.0
#: Neighbours, and words between them, that are at least this part of all places are counted for all tasks; of twice that
#: part there are none beside them, and of these at most 1 / HOT.
HOT = 1 / 2000
#: Characters of text for which one more bucket of places is opened.
BUCKET_CHARS = 16_000_000
#: A prior's logarithm is kept in steps of this, in 16 bits.
STEP_OF_PRIOR = 2.0**-10
#: Words that a task gathers before it hands them on, so that buckets get few large pieces.
GATHERED = 2_000_000

_SHAPES = {
    "embedding": (CLASSES + 1, WIDTH),
    "inner": (2 * REACH * WIDTH, HIDDEN),
    "inner_bias": (HIDDEN,),
    "group": (HIDDEN, SIDE),
    "group_bias": (SIDE,),
    "member": (HIDDEN, SIDE),
    "member_bias": (SIDE, SIDE),
}
Net = dict[str, np.ndarray]


@dataclass
class Vocabulary:
    """The words of a corpus: hashes of the frequent ones, sorted; counts (word, n) of all others, a table; and of each
    class of others, how often its words come plus one for each and one for words that are not counted. ``known`` are
    the hashes of the most frequent others, sorted, with ``logs`` of their counts plus one; ``tails`` the same for a word of each class that is not known.
    ``contexts`` and ``cells`` are the hashes of neighbours, and of words between them, that are hot."""

    frequent: np.ndarray
    counts: DataFrame
    totals: np.ndarray
    known: np.ndarray
    logs: np.ndarray
    tails: np.ndarray
    contexts: np.ndarray
    cells: np.ndarray

    def log_shares(self, hashes: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each word, the log of its share of its class."""
        out, other = np.zeros(len(target)), np.flatnonzero(target >= FREQUENT)
        of, words = target[other] - FREQUENT, hashes[other]
        each = self.tails[of]
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, words), len(self.known) - 1)
            each = np.where(self.known[at] == words, self.logs[at], each)
        out[other] = each - np.log(self.totals)[of]
        return out


class Tallies(NamedTuple):
    """How often the hot contexts and cells of a vocabulary come in some documents."""

    contexts: np.ndarray
    cells: np.ndarray


def _place(sorted_: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Where values are in a sorted array, -1 if they are not."""
    if not len(sorted_):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)
    return np.where(sorted_[at] == values, at, -1)


class _Hot:
    """Places of values in a sorted array, -1 if they are not; most are told by a small table."""

    def __init__(self, sorted_: np.ndarray):
        self.sorted, self.table = sorted_, np.zeros(1 << 16, bool)
        self.table[(sorted_ & np.uint64(0xFFFF)).astype(np.int64)] = True

    def places(self, values: np.ndarray) -> np.ndarray:
        out = np.full(len(values), -1)
        some = np.flatnonzero(self.table[(values & np.uint64(0xFFFF)).astype(np.int64)])
        out[some] = _place(self.sorted, values[some])
        return out


def _often(values: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The values that come at least so often, and how often."""
    low = (values & np.uint64(0xFFFFF)).astype(np.int64)
    some = values[(np.bincount(low, minlength=1 << 20) >= least)[low]]
    found, n = np.unique(some, return_counts=True)
    return found[n >= least], n[n >= least]


def neighbours(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the two words around each place, with the ends of a text as words of their own, and of all three."""
    before, after = np.empty_like(hashes), np.empty_like(hashes)
    before[1:], after[:-1] = hashes[:-1], hashes[1:]
    some = np.flatnonzero(np.diff(first) > 0)
    before[first[:-1][some]] = 1
    after[first[1:][some] - 1] = 2
    around = mixed(mixed(before * np.uint64(0x9E3779B97F4A7C15)) + after)
    return around, mixed(around * np.uint64(0x2545F4914F6CDD1D) + hashes)


def fresh(seed: int = 5) -> Net:
    rng = np.random.default_rng(seed)
    return {n: (0.1 * rng.standard_normal(s) if "bias" not in n else np.zeros(s)).astype(np.float32) for n, s in _SHAPES.items()}


def _flat(net: Net) -> np.ndarray:
    return np.concatenate([net[n].ravel() for n in _SHAPES])


def _shaped(flat: np.ndarray) -> Net:
    out, at = {}, 0
    for n, s in _SHAPES.items():
        size = math.prod(s)
        out[n] = flat[at : at + size].reshape(s).astype(np.float32)
        at += size
    return out


def _softmax(x: np.ndarray, at: tuple[np.ndarray, np.ndarray], whole: bool) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities by row, written over ``x`` if the ``whole`` is wanted, and the logs of those chosen."""
    if max(x.max(initial=0), -x.min(initial=0)) > 60:  # else no sum of exponentials leaves its range
        x -= x.max(axis=1, keepdims=True)
    chosen = x[at]
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    if whole:
        x /= total[:, None]
    return x, chosen - np.log(total)


def _forward(net: Net, context: np.ndarray, target: np.ndarray, whole: bool = True) -> tuple[np.ndarray, ...]:
    seen = net["embedding"].take(context, axis=0).reshape(len(context), -1)
    hidden = np.tanh(seen @ net["inner"] + net["inner_bias"])
    group, member, at = target >> 5, target & 31, np.arange(len(target))
    groups, of_group = _softmax(hidden @ net["group"] + net["group_bias"], (at, group), whole)
    members, of_member = _softmax(hidden @ net["member"] + net["member_bias"].take(group, axis=0), (at, member), whole)
    return seen, hidden, groups, members, of_group + of_member


def log_probabilities(net: Net, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each word, the log of its probability given the words around it."""
    parts = [_forward(net, context[a : a + BATCH], target[a : a + BATCH], False)[4] for a in range(0, len(target), BATCH)]
    return np.concatenate(parts) if parts else np.zeros(0, np.float32)


def train_step(net: Net, memory: Net, context: np.ndarray, target: np.ndarray) -> None:
    """One step of Adagrad, in place."""
    n = len(target)
    seen, hidden, d_groups, d_members, _ = _forward(net, context, target)
    group, member, at = target >> 5, target & 31, np.arange(n)
    d_groups[at, group] -= 1
    d_members[at, member] -= 1
    d_hidden = (d_groups @ net["group"].T + d_members @ net["member"].T) * (1 - hidden**2)
    d_seen = (d_hidden @ net["inner"].T).reshape(-1, WIDTH)
    which = context.ravel()
    of_group = (group[None, :] == np.arange(SIDE)[:, None]).astype(np.float32)
    gradient = {
        "embedding": np.stack([np.bincount(which, d_seen[:, j], CLASSES + 1) for j in range(WIDTH)], axis=1),
        "inner": seen.T @ d_hidden,
        "inner_bias": d_hidden.sum(axis=0),
        "group": hidden.T @ d_groups,
        "group_bias": d_groups.sum(axis=0),
        "member": hidden.T @ d_members,
        "member_bias": of_group @ d_members,
    }
    for name, g in gradient.items():
        g = (g / n).astype(np.float32)
        memory[name] += g * g
        net[name] -= RATE * g / np.sqrt(memory[name] + 1e-8)


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words in lower case and of their last three bytes, and the first word of each text."""
    data, bounds = text_bytes(column)
    data = LOWER[data]
    starts, ends, first = split_words(data, bounds)
    return hash_words(data, starts, ends), hash_words(data, np.maximum(starts, ends - 3), ends, 1), first


def classes(hashes: np.ndarray, endings: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """``frequent`` holds the hashes of frequent words, sorted; a word's class is its place, or that of its ending."""
    rest = FREQUENT + _ending_class(endings)
    if not len(frequent):
        return rest
    at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
    return np.where(frequent[at] == hashes, at, rest)


def contexts(target: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The classes around each word; beyond its text, the last class."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = np.full((len(target), 2 * REACH), CLASSES, np.int64)
    offsets = [o for o in range(-REACH, REACH + 1) if o]
    for column, o in enumerate(offsets):
        a, b = max(0, -o), len(target) - max(0, o)
        if a < b:
            same = text[a:b] == text[a + o : b + o]
            out[a:b, column][same] = target[a + o : b + o][same]
    return out


_WORD, _CONTEXT, _CELL = 0, 1, 2


def vocabulary(docs: DataFrame) -> Vocabulary:
    """The words of all documents, each counted; of the frequent and the known ones, ties to smaller hashes.

    Each task also hands on the neighbours, and the words between them, that are at least the part HOT of the places it has gathered
    at once. What is HOT of all places is that of some such gathering; what comes twice as often is counted for at least the part HOT."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, places = [], 0, []
        for batch in steps(batches):
            hashes, endings, first = word_hashes(batch.column("text"))
            words, at, n = np.unique(hashes, return_index=True, return_counts=True)
            held.append((words, n, _ending_class(endings[at])))
            places.append(neighbours(hashes, first))
            size += len(hashes)
            if size > GATHERED:  # a task hands on what it has before it grows
                yield from counted_places(held, places)
                held, size, places = [], 0, []
        if held:
            yield from counted_places(held, places)

    def counted_places(held: list, places: list) -> Iterator[pa.RecordBatch]:
        yield _counted(*([h[i] for h in held] for i in range(3)))
        around, cells = (np.concatenate([p[i] for p in places]) for i in range(2))
        least = max(2, HOT * len(around))
        hot, n = _often(around, least)
        yield _tallied(hot, n, _CONTEXT)
        yield _tallied(*_often(cells[_Hot(hot).places(around) >= 0], least), _CELL)

    counted = docs.select("text").mapInArrow(count, "word long, class int, n long, kind int").groupBy("kind", "word")
    counted = stored(counted.agg(F.sum("n").alias("n"), F.min("class").alias("class")), "words")
    words = counted.where(f"kind = {_WORD}")
    top = words.select("word", "n", "class").orderBy(F.desc("n"), "word").limit(FREQUENT + KNOWN).toArrow()
    hashes, n, of_class = (top.column(c).to_numpy() for c in ("word", "n", "class"))
    frequent = docs.sparkSession.createDataFrame([(int(w),) for w in hashes[:FREQUENT]], "word long")
    others = words.join(F.broadcast(frequent), "word", "left_anti")  # FREQUENT rows
    totals, tails, sizes = np.ones(CLASSES - FREQUENT), np.zeros(CLASSES - FREQUENT), np.zeros(CLASSES - FREQUENT)
    for r in others.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        totals[r["class"]] += r["n"] + r["words"]
        tails[r["class"]], sizes[r["class"]] = r["n"] + r["words"], r["words"]
    known, n, of_class = hashes[FREQUENT:].view(np.uint64), n[FREQUENT:], of_class[FREQUENT:]
    left = sizes - np.bincount(of_class, minlength=len(sizes))
    tails = (tails - np.bincount(of_class, n + 1, len(sizes))) / np.maximum(left, 1)
    order = np.argsort(known)
    total = words.agg(F.sum("n")).first()[0] or 0
    hot = counted.where(F.col("kind") != _WORD).where(F.col("n") >= max(2, HOT * total)).collect()  # at most 1 / HOT of a kind
    sorted_ = lambda kind: np.sort(np.array([r["word"] for r in hot if r["kind"] == kind], np.int64).view(np.uint64))
    logs = np.log1p(n[order].astype(float))
    return Vocabulary(
        np.sort(hashes[:FREQUENT].view(np.uint64)), others.select("word", "n"), totals, known[order], logs, np.log(np.where(left > 0, tails, 1.0)), sorted_(_CONTEXT), sorted_(_CELL)
    )


def _tallied(words: np.ndarray, n: np.ndarray, kind: int) -> pa.RecordBatch:
    kinds = pa.array(np.full(len(words), kind, np.int32))
    return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.nulls(len(words), pa.int32()), pa.array(n.astype(np.int64)), kinds], ["word", "class", "n", "kind"])


def _tally(known: _Words, hashes: np.ndarray, first: np.ndarray, tallies: Tallies) -> None:
    """Adds what a batch holds, in place."""
    around, cells = neighbours(hashes, first)
    at = known.hot_contexts.places(around)
    hot = at >= 0
    tallies.contexts[:] += np.bincount(at[hot], minlength=len(tallies.contexts))
    at = known.hot_cells.places(cells[hot])
    tallies.cells[:] += np.bincount(at[at >= 0], minlength=len(tallies.cells))


def _no_tallies(known: Vocabulary) -> Tallies:
    return Tallies(np.zeros(len(known.contexts), np.int64), np.zeros(len(known.cells), np.int64))


def _ending_class(endings: np.ndarray) -> np.ndarray:
    return (endings % np.uint64(CLASSES - FREQUENT)).astype(np.int64)


def _counted(words: list[np.ndarray], n: list[np.ndarray], ending: list[np.ndarray]) -> pa.RecordBatch:
    every, at, place = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
    total = np.bincount(place, np.concatenate(n)).astype(np.int64)
    of_class = np.concatenate(ending)[at].astype(np.int32)
    kind = pa.array(np.full(len(every), _WORD, np.int32))
    return pa.RecordBatch.from_arrays([pa.array(every.view(np.int64)), pa.array(of_class), pa.array(total), kind], ["word", "class", "n", "kind"])


def train(docs: DataFrame, rounds: int = 2) -> tuple[Vocabulary, Net]:
    """The vocabulary and the net, after one pass over all documents; each round takes those of its hash."""
    known, net, _ = _taught(docs, rounds)
    return known, net


def _taught(docs: DataFrame, rounds: int) -> tuple[Vocabulary, Net, Tallies]:
    known, net = vocabulary(docs), fresh()
    tallies = _no_tallies(known)
    for turn in range(rounds):
        part = docs.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == turn) if rounds > 1 else docs
        part = part.where("text is not null")  # null hashes to one round, and has no words
        net, found = _averaged(_trained(part.select("text"), known, net), net, known)
        tallies = Tallies(*(a + b for a, b in zip(tallies, found)))
    return known, net, tallies


def _trained(docs: DataFrame, known: Vocabulary, start: Net | None) -> DataFrame:
    """What each task makes of the net, and tallies: (net, n, tallies), n the words it has seen. Without a net it only
    tallies."""
    own = _Words(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies, n, rng = _no_tallies(own), 0, np.random.default_rng(1)
        net = {k: v.copy() for k, v in (start or {}).items()}
        memory = {k: np.full_like(v, 0.01) for k, v in net.items()}
        for batch in steps(batches):
            hashes, endings, first = word_hashes(batch.column("text"))
            _tally(own, hashes, first, tallies)
            n += len(hashes)
            if start is None:
                continue
            target = classes(hashes, endings, own.frequent)
            around = contexts(target, first).astype(np.int32)
            order = rng.permutation(len(target))
            for a in range(0, len(order), BATCH):
                some = order[a : a + BATCH]
                train_step(net, memory, around[some], target[some])
        if n:
            flat = _flat(net) if net else np.zeros(0, np.float32)
            arrays = [pa.array([flat.tobytes()], pa.binary()), pa.array([n], pa.int64()), pa.array([np.concatenate(tallies).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["net", "n", "tallies"])

    return docs.mapInArrow(run, "net binary, n long, tallies binary")


def tally(docs: DataFrame, known: Vocabulary) -> Tallies:
    """How often what is hot in the vocabulary comes in ``docs``, exactly."""
    return _averaged(_trained(docs.select("text"), known, None), {}, known)[1]


def _averaged(nets: DataFrame, otherwise: Net, known: Vocabulary) -> tuple[Net, Tallies]:
    """The mean net, weighted by words, and the sums of the tallies: first within groups of tasks, so that the driver gets
    about as many as the root of the number of tasks."""
    nets = stored(nets.withColumn("task", F.spark_partition_id()), "nets")
    groups = math.isqrt(nets.count()) + 1
    size, n_hot, split = sum(math.prod(s) for s in _SHAPES.values()) if otherwise else 0, len(known.contexts) + len(known.cells), len(known.contexts)

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, tallies = np.zeros(size), 0, np.zeros(n_hot, np.int64)
        for batch in batches:
            for net, words, found in zip(*(batch.column(i).to_pylist() for i in range(3))):
                total += np.frombuffer(net, np.float32) * float(words)
                tallies += np.frombuffer(found, np.int64)
                n += words
        if n:
            arrays = [pa.array([(total / n).tobytes()], pa.binary()), pa.array([n], pa.int64()), pa.array([tallies.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["net", "n", "tallies"])

    rows = nets.repartition(groups, F.col("task") % groups).select("net", "n", "tallies").mapInArrow(mean, "net binary, n long, tallies binary").collect()
    if not rows:
        return otherwise, _no_tallies(known)
    total = sum(r["n"] for r in rows)
    tallies = sum(np.frombuffer(r["tallies"], np.int64) for r in rows)
    net = _shaped(sum(np.frombuffer(r["net"]) * (r["n"] / total) for r in rows)) if otherwise else otherwise
    return net, Tallies(tallies[:split], tallies[split:])


class _Words:
    """A vocabulary's arrays, without its table, for tasks."""

    def __init__(self, known: Vocabulary):
        for name in ("frequent", "totals", "known", "logs", "tails", "contexts", "cells"):
            setattr(self, name, getattr(known, name))
        self.hot_contexts, self.hot_cells = _Hot(self.contexts), _Hot(self.cells)

    log_shares = Vocabulary.log_shares


_BLOB = "piece long, bucket int, at binary, places binary, more binary, words binary, priors binary"
_SCORED = "id long, doc_id long, n_words long, log_probability double, log_share double, evidence double"
_SUMS = "piece long, at binary, sums binary"


def _cut(buckets: int, bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The places of each bucket, in their order."""
    bucket = bucket.astype(np.uint16) if buckets < 1 << 16 else bucket  # 16 bits are sorted in two passes
    order = np.argsort(bucket, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
    for b in np.flatnonzero(np.diff(ends)).tolist():
        yield b, order[ends[b] : ends[b + 1]]


def _steps_between(at: np.ndarray) -> bytes:
    """Rising numbers as their differences, in as few bytes each as the largest takes."""
    by = np.diff(at, prepend=0)
    size = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if by.max(initial=0) <= np.iinfo(t).max)
    return by.astype(size).tobytes()


def _from_steps(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, f"u{len(data) // n}").astype(np.int64)) if n else np.zeros(0, np.int64)


def _in_steps(prior: np.ndarray) -> np.ndarray:
    """Logs of priors as whole steps below 0; one below 16 bits counts as the least there is."""
    return np.clip(np.round(prior / -STEP_OF_PRIOR), 0, 0xFFFF).astype(np.uint16)


def _log_posterior(prior: np.ndarray, k: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of places that count themselves in k and n; priors in steps."""
    return np.log((k - 1 + PRIOR * np.exp(prior * -STEP_OF_PRIOR)) / (n - 1 + PRIOR))


def _classed(words: _Words, net: Net, tallies: Tallies, buckets: int) -> Callable:
    """Map side: a row with an id for each document, with the prior of its words and what is settled of their evidence; and
    by bucket the places whose evidence is to be counted, with the documents they are of. The ids of a piece, the documents gathered
    together, follow one another from its own."""
    names = [c.split()[0] for c in (_SCORED + ", " + _BLOB).split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int32(), *[pa.binary()] * 5)

    def blobs(piece: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        own, around, cells, prior, spread = (np.concatenate([h[i] for h in held]) for i in range(5))
        # the places of hot neighbours are spread by the word between them
        bucket = ((np.where(spread, cells, around) >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
        for b, some in _cut(buckets, bucket):
            # 40 bits of the neighbours' hash tell them apart within a bucket
            place = around[some]
            more = ((place >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8)
            parts = [_steps_between(own[some]), place.astype(np.uint32).tobytes(), more.tobytes(), cells[some].astype(np.uint32).tobytes(), prior[some].tobytes()]
            arrays = [*(pa.nulls(1, k) for k in kinds[:6]), pa.array([piece], pa.int64()), pa.array([b], pa.int32()), *(pa.array([p], pa.binary()) for p in parts)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, size = TaskContext.get().partitionId() << 40, [], 0
        piece = at
        for batch in steps(batches):
            hashes, endings, first = word_hashes(batch.column("text"))
            target = classes(hashes, endings, words.frequent)
            each = log_probabilities(net, contexts(target, first).astype(np.int32), target).astype(float)
            share = words.log_shares(hashes, target)
            around, cells = neighbours(hashes, first)
            prior, settled = _in_steps(each + share), np.zeros(len(target))
            within = words.hot_contexts.places(around)
            hot = words.hot_cells.places(cells)
            done = np.flatnonzero(hot >= 0)
            settled[done] = _log_posterior(prior[done], tallies.cells[hot[done]], tallies.contexts[within[done]])
            open_ = np.flatnonzero(hot < 0)
            sums = [np.diff(np.concatenate([[0.0], np.cumsum(x)])[first]) for x in (each, share, settled)]
            n, ids = np.diff(first), np.arange(at, at + batch.num_rows)
            at += batch.num_rows
            rows = [pa.array(ids), batch.column("doc_id"), pa.array(n), *map(pa.array, sums)]
            yield pa.RecordBatch.from_arrays([*rows, *(pa.nulls(len(n), k) for k in kinds[6:])], names)
            held.append((np.repeat(ids - piece, n)[open_], around[open_], cells[open_], prior[open_], (within >= 0)[open_]))
            size += len(open_)
            if size > GATHERED:
                yield from blobs(piece, held)
                piece, held, size = at, [], 0
        if size:
            yield from blobs(piece, held)

    return run


def counts_of(around: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often each place's neighbours (up to 40 bits) come, and its word between them (32 bits). A bucket has fewer than
    2 ** 24 places, so that a value and its place are sorted as one number."""
    shift = np.uint64(24)
    mask = np.uint64((1 << 24) - 1)
    whole = np.sort((around << shift) | np.arange(len(around), dtype=np.uint64))
    order, around = (whole & mask).astype(np.int64), whole >> shift
    heads = np.flatnonzero(np.concatenate([[True], around[1:] != around[:-1]])) if len(order) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(heads, len(order)))
    n, k = np.empty(len(order), np.int64), np.ones(len(order), np.int64)
    n[order] = np.repeat(sizes, sizes)
    # only neighbours that come again can have a word again
    group, again = np.repeat(np.arange(len(heads), dtype=np.uint64), sizes), np.repeat(sizes > 1, sizes)
    keys = (group[again] << np.uint64(32)) | cells[order[again]]
    known = np.sort(keys)
    k[order[again]] = np.searchsorted(known, keys, "right") - np.searchsorted(known, keys)
    return n, k


def _meet(words: _Words, tallies: Tallies) -> Callable:
    """Reduce side: of the documents of a piece, the evidence of their places in a bucket. Rows of documents pass."""
    passed, sums = (["id", "doc_id", "n_words", "log_probability", "log_share", "evidence"], ["piece", "at", "sums"])
    parts = ("at", "places", "more", "words", "priors")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[tuple]] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rows = table.filter(pc.is_null(table["bucket"])).select(passed)
            for some in rows.to_batches():
                yield pa.RecordBatch.from_arrays([*some.columns, *(pa.nulls(some.num_rows, t) for t in (pa.int64(), pa.binary(), pa.binary()))], passed + sums)
            for row in table.filter(pc.is_valid(table["bucket"])).select(["bucket", "piece", *parts]).to_pylist():
                places, more, cells, priors = (np.frombuffer(row[c], t) for c, t in zip(parts[1:], (np.uint32, np.uint8, np.uint32, np.uint16)))
                around = (more.astype(np.uint64) << np.uint64(32)) | places
                found.setdefault(row["bucket"], []).append((row["piece"], _from_steps(row["at"], len(cells)), around, cells, priors))
        for b in sorted(found):
            yield from of_bucket(found.pop(b))

    # 40 bits of hot neighbours, and how often they come
    low = words.contexts & np.uint64((1 << 40) - 1)
    order = np.argsort(low)
    hot, n_hot = _Hot(low[order]), tallies.contexts[order]

    def of_bucket(pieces: list[tuple]) -> Iterator[pa.RecordBatch]:
        around, cells = (np.concatenate([p[i] for p in pieces]) for i in (2, 3))
        n, k = counts_of(around, cells)
        spread = hot.places(around)
        n[spread >= 0] = n_hot[spread[spread >= 0]]
        at = 0
        for piece, own, _, _, priors in pieces:
            some = slice(at, at + len(own))
            at += len(own)
            heads = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            each = np.add.reduceat(_log_posterior(priors.astype(float), k[some], n[some]), heads)
            blob = [pa.array([piece]), pa.array([_steps_between(own[heads])], pa.binary()), pa.array([each.astype(np.float32).tobytes()], pa.binary())]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in kinds), *blob], passed + sums)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the documents of a piece, whose ids follow one another, the evidence of all buckets; rows of documents pass."""
    passed, totals = ["id", "doc_id", "n_words", "log_probability", "log_share", "evidence"], {}
    for batch in batches:
        table = pa.Table.from_batches([batch])
        yield from table.filter(pc.is_null(table["piece"])).select(passed).to_batches()
        for row in table.filter(pc.is_valid(table["piece"])).select(["piece", "at", "sums"]).to_pylist():
            each = np.frombuffer(row["sums"], np.float32)
            at = _from_steps(row["at"], len(each))
            total = totals.get(row["piece"], np.zeros(0))
            if at[-1] >= len(total):
                total = totals[row["piece"]] = np.concatenate([total, np.zeros(at[-1] + 1 - len(total))])
            total[at] += each
    for piece, total in totals.items():
        n = len(total)
        nothing = (pa.nulls(n, t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(piece + np.arange(n)), *nothing, pa.array(total)], passed)


def score(docs: DataFrame, known: Vocabulary, net: Net, tallies: Tallies | None = None) -> DataFrame:
    """The score of every whole text: (doc_id, n_words, log_probability, per_word, prior_log_likelihood, prior_log_likelihood_per_word,
    pseudo_log_likelihood, pseudo_log_likelihood_per_word). ``log_probability`` is that of the classes of its words, given those around;
    ``prior_log_likelihood`` that of the words themselves, their shares of their classes included; ``pseudo_log_likelihood`` that with
    the evidence of what else stands between the same neighbours in ``docs``.

    Takes doc_id and text; other columns are ignored. One row for each input row, repeated ones too. A text without
    words, null or empty, scores 0 and has null means per word. ``tallies`` are those of ``docs``; without them they are
    counted.

    A frequent word is all of its class. Another that comes n times has the share (n + 1) / (N + V + 1) of its class, whose
    V words come N times; words that are not known have the mean share of such words, or 1 / (N + V + 1), all those of a class together, if all are known.
    """
    tallies = tallies or tally(docs, known)
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = 1 + chars // BUCKET_CHARS
    words, schema = _Words(known), f"{_SCORED}, {_BLOB}"
    placed = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_classed(words, net, tallies, buckets), schema)
    # rows of documents are dealt by their ids, places by their bucket
    placed = placed.repartition(buckets, F.coalesce(F.col("bucket").cast("long"), F.xxhash64("id")))
    parts = placed.mapInArrow(_meet(words, tallies), f"{_SCORED}, {_SUMS}")
    parts = parts.repartition(F.coalesce("piece", F.xxhash64("id"))).mapInArrow(_summed, _SCORED)
    # all but the evidence is in one row of an id
    whole = parts.groupBy("id").agg(*(F.max(c).alias(c) for c in ("doc_id", "n_words", "log_probability", "log_share")), F.sum("evidence").alias("evidence"))
    mean = lambda x: x / F.nullif("n_words", F.lit(0))
    prior = F.col("log_probability") + F.col("log_share")
    return whole.select(
        "doc_id",
        "n_words",
        "log_probability",
        mean(F.col("log_probability")).alias("per_word"),
        prior.alias("prior_log_likelihood"),
        mean(prior).alias("prior_log_likelihood_per_word"),
        F.col("evidence").alias("pseudo_log_likelihood"),
        mean(F.col("evidence")).alias("pseudo_log_likelihood_per_word"),
    )


def pseudo_likelihood(docs: DataFrame, rounds: int = 2) -> DataFrame:
    """Trains on ``docs`` and scores them."""
    known, net, tallies = _taught(docs, rounds)
    return score(docs, known, net, tallies)
