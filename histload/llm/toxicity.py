"""Toxicity of documents by bags of subwords.

Every word is the bag of its character n-grams, its edges included, so that a misspelling never seen in training
shares most of its n-grams, and their vectors, with words that were. A text is cut into windows of like length; the
vectors of a window's n-grams are averaged and go to a linear softmax over (clean, toxic). Vectors and softmax are
trained jointly, in numpy, by one task, on a bounded sample of labelled documents: a document is clean if all of its
windows are, so of a toxic one those windows learn most that are likeliest toxic already. The score of a text is that of its most
toxic window; were windows' chances multiplied, length alone would make a text toxic.

Once trained, the vectors meet the softmax only through the difference of its two rows, so each n-gram has one number:
scoring adds up numbers, and a whole text costs about as much as splitting it into words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histload.llm.words import LOWER, hash_words, mixed, split_words, steps, text_bytes

#: Bounds of the training sample: so many labelled documents, those whose id has the smallest hash, of which texts of more
#: characters are left out, and so many bytes of text in all.
LABELLED, LONGEST, SAMPLE_BYTES = 4000, 20_000, 16 << 20
#: Bytes in an n-gram, the mark at a word's edge included.
GRAMS = (3, 4, 5, 6)
#: Words in a window; windows of a text differ by one word at most. A window with fewer n-grams counts as having FULL.
WINDOW, FULL = 24, 250
#: Length of an n-gram's vector. One that words of the sample hold in fewer than RARE (document, word) pairs has none.
WIDTH, RARE = 6, 10
#: Rounds over the sample, the step, the weight decay, and the least share of the greatest squared gradient that a step
#: is divided by.
ROUNDS, RATE, DECAY, FLOOR = 40, 0.15, 2e-6, 1e-4
#: Part of the distinct words that a round does not hear, so that each of a document's toxic words must do on its own.
DROPPED = 0.5
#: What a window's mean is multiplied by, as few of its n-grams tell.
SCALE = 50.0
#: Weights are multiples of this, so that their sums are exact and equal texts score alike wherever they stand.
GRID = 2.0**-20
#: From this score on, a document is predicted toxic.
THRESHOLD = 0.3


@dataclass(frozen=True)
class Bags:
    """The n-grams of distinct words, word after word: hashes, and where each word's begin; of each text, which words it
    has in order, and where its first one is."""

    grams: np.ndarray
    bounds: np.ndarray
    words: np.ndarray
    first: np.ndarray


def bags(column: pa.Array) -> Bags:
    """Lower-case bytes split at white space; n-grams are hashed with the word's edges as a space byte."""
    data, bounds = text_bytes(column)
    data = LOWER[data]
    starts, ends, first = split_words(data, bounds)
    _, at, place = np.unique(hash_words(data, starts, ends), return_index=True, return_inverse=True)
    if not len(at):
        return Bags(np.zeros(0, np.uint64), np.zeros(1, np.int64), place, first)
    # the distinct words one after another, a space before, between and after them
    sizes = ends[at] - starts[at]
    places = np.concatenate([[0], np.cumsum(sizes + 1)])
    line = np.full(places[-1] + 1 + max(GRAMS), 0x20, np.uint64)
    inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    line[np.repeat(places[:-1] + 1, sizes) + inner] = data[np.repeat(starts[at], sizes) + inner]
    n = places[-1]
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)  # of the space before a word and of its bytes
    stop = np.append(places[1:], n)[owner]  # the space after the word
    found, whose = [], []
    rolling = line[:n].copy()
    for size in range(2, max(GRAMS) + 1):
        rolling = rolling * np.uint64(0x100000001B3) + line[size - 1 : n + size - 1]
        if size in GRAMS:
            inside = np.flatnonzero(np.arange(n) + size - 1 <= stop)
            found.append(mixed(rolling[inside] + np.uint64(size)))
            whose.append(owner[inside])
    grams, whose = np.concatenate(found), np.concatenate(whose)
    order = np.argsort(whose, kind="stable")
    return Bags(grams[order], np.searchsorted(whose[order], np.arange(len(sizes) + 1)), place, first)


@dataclass(frozen=True)
class Windows:
    """Windows of words: the distinct words of each, window after window, where each window's begin, how many n-grams they
    have, and the first window of each text."""

    words: np.ndarray
    bounds: np.ndarray
    sizes: np.ndarray
    first: np.ndarray


def windows(found: Bags) -> Windows:
    """A bag holds a word once, however often it is repeated. One with few n-grams counts as having FULL."""
    counts = np.diff(found.first)
    per_text = -(-counts // WINDOW)
    first = np.concatenate([[0], np.cumsum(per_text)])
    of = np.repeat(np.arange(len(counts)), per_text)
    nth = np.arange(first[-1]) - first[:-1][of]
    starts = np.append(found.first[:-1][of] + nth * counts[of] // np.maximum(per_text[of], 1), found.first[-1])
    n_words = max(1, len(found.bounds) - 1)
    keys = np.unique(np.repeat(np.arange(first[-1]), np.diff(starts)) * n_words + found.words)
    words, bounds = keys % n_words, np.searchsorted(keys, np.arange(first[-1] + 1) * n_words)
    return Windows(words, bounds, np.maximum(_sums(np.diff(found.bounds)[words], bounds), FULL), first)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the runs between bounds."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=float)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _clean(logits: np.ndarray) -> np.ndarray:
    """Log of the clean probability of windows."""
    return -np.logaddexp(0.0, logits)


@dataclass(frozen=True)
class Model:
    """The hashes of n-grams that have a vector, sorted; of each, its vector times the difference of the softmax' rows; and
    the difference of the softmax' offsets."""

    grams: np.ndarray
    weights: np.ndarray
    offset: float

    def scores(self, column: pa.Array) -> np.ndarray:
        """Of each text, the toxic probability of its most toxic window. A text without words scores as a window that
        holds nothing that was learned."""
        found = bags(column)
        each = np.zeros(len(found.grams))
        if len(self.grams):
            at = np.minimum(np.searchsorted(self.grams, found.grams), len(self.grams) - 1)
            each = np.where(self.grams[at] == found.grams, self.weights[at], 0.0)
        seen = windows(found)
        means = _sums(_sums(each, found.bounds)[seen.words], seen.bounds) / seen.sizes
        logits, some = np.full(len(column), self.offset), np.diff(seen.first) > 0
        if some.any():
            logits[some] += np.maximum.reduceat(means, seen.first[:-1][some])
        return np.exp(-np.logaddexp(0.0, -logits))


def fit(texts: pa.Array, toxic: np.ndarray, seed: int = 3) -> Model:
    """Vectors, softmax and offset together, by Adagrad on all documents of the sample in each round.

    The gradient of a window's mean is one number times the difference of the softmax' rows; what reaches
    an n-gram's vector is therefore summed as one number as well."""
    share = float(np.clip(toxic.mean(), 1e-3, 1 - 1e-3)) if len(toxic) else 0.5
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    found = bags(texts)
    if not len(found.grams) or toxic.min() == toxic.max():
        return nothing
    known, grams = _kept(found)
    if not len(known):
        return nothing
    seen = windows(found)
    has = grams >= 0
    gram, whose = grams[has], np.repeat(np.arange(len(found.bounds) - 1), np.diff(found.bounds))[has]
    window = np.repeat(np.arange(len(seen.sizes)), np.diff(seen.bounds))
    text = np.repeat(np.arange(len(toxic)), np.diff(seen.first))
    n_words, some = len(found.bounds) - 1, np.diff(seen.first) > 0

    rng = np.random.default_rng(seed)
    vectors, softmax = rng.normal(0, 0.1, (len(known), WIDTH)), rng.normal(0, 1, (2, WIDTH))
    bias = np.log(share / (1 - share)) - np.log(max(1.0, float(np.median(np.diff(seen.first)[some]))))
    held = [0.0, 0.0, 0.0]
    y = toxic[some].astype(float)
    for _ in range(ROUNDS):
        across = SCALE * (softmax[1] - softmax[0])
        each = vectors @ across
        heard = rng.random(n_words) >= DROPPED
        word = np.bincount(whose, each[gram], n_words) * heard
        logits = np.bincount(window, word[seen.words], len(seen.sizes)) / seen.sizes + bias
        clean = _sums(_clean(logits), seen.first)[some]
        # of a toxic document's windows, the likelier a window is toxic the more of the gradient is its own
        odds = 1 / np.maximum(np.expm1(np.minimum(-clean, 50)), 1e-12)
        push = np.zeros(len(toxic))
        push[some] = np.where(y > 0, -np.minimum(odds, 1e6), 1.0) / len(y)
        at_window = push[text] / (1 + np.exp(-logits))
        back = np.bincount(seen.words, (at_window / seen.sizes)[window], n_words) * heard
        amount = np.bincount(gram, back[whose], len(known))
        slope = SCALE * (amount @ vectors)
        # Adagrad with a floor: n-grams of few documents would otherwise learn as fast as those that many share
        gradients = (np.outer(amount, across) + DECAY * vectors, np.stack([-slope, slope]), at_window.sum())
        held = [h + g * g for h, g in zip(held, gradients)]
        change = [RATE * g / np.sqrt(h + FLOOR * np.max(h)) for g, h in zip(gradients, held)]
        vectors, softmax, bias = vectors - change[0], softmax - change[1], bias - change[2]
    weights = vectors @ (SCALE * (softmax[1] - softmax[0]))
    return Model(known, np.round(weights / GRID) * GRID, float(bias))


def _kept(found: Bags) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams that are not rare, sorted, and of each n-gram of a word its place among them, or -1."""
    n_words, text = len(found.bounds) - 1, np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
    in_texts = np.bincount(np.unique(text * n_words + found.words) % n_words, minlength=n_words)
    grams, place = np.unique(found.grams, return_inverse=True)
    kept = np.bincount(place, np.repeat(in_texts, np.diff(found.bounds)), len(grams)) >= RARE
    return grams[kept], np.where(kept[place], (np.cumsum(kept) - 1)[place], -1)


_MODEL = "grams binary, weights binary, offset double"


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(batches, None) if (batches := list(batches)) else None
    if rows is None:
        return
    rows = rows.sort_by("doc_id").combine_chunks()
    texts = rows.column("text").combine_chunks()
    within = np.cumsum([len(t.as_buffer()) for t in texts]) <= SAMPLE_BYTES
    model = fit(texts.filter(pa.array(within)), rows.column("toxic").to_numpy()[within])
    parts = [pa.array([x.tobytes()], pa.binary()) for x in (model.grams, model.weights)]
    yield pa.RecordBatch.from_arrays([*parts, pa.array([model.offset])], ["grams", "weights", "offset"])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The model from labelled documents: (doc_id, toxic) with toxic 0 or 1, of which null ids and labels are left out.

    Of labels that repeat an id the smallest counts, of documents the first text by its bytes. The sample, which LABELLED,
    LONGEST and SAMPLE_BYTES bound, is fitted in one task. Without labels, or with one kind, all scores are equal.
    """
    chosen = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(LABELLED)
    )
    texts = docs.where(F.length("text") <= LONGEST).select(F.col("doc_id").cast("long"), "text")
    sample = texts.join(F.broadcast(chosen), "doc_id")  # at most LABELLED rows
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic"))
    rows = sample.repartition(1).mapInArrow(_fitted, _MODEL).collect()
    if not rows:
        return fit(pa.array([], pa.string()), np.zeros(0))
    return Model(np.frombuffer(rows[0]["grams"], np.uint64), np.frombuffer(rows[0]["weights"]), rows[0]["offset"])


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """The score of every whole text: (doc_id, score, predicted).

    Takes doc_id and text; other columns are ignored. One row for each input row, repeated ones and null ids too. A
    text without words, null or empty, has the score of a window in which nothing was learned. Equal texts score alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            found = model.scores(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int")
