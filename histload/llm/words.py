"""Words of whole record batches, found and hashed with array operations on their bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once; a longer text is worked on alone.
STEP = 4 << 20
#: Longer words are hashed one by one.
LONG_WORD = 256

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def steps(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches, cut so that the texts of each have at most STEP bytes or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + STEP, "right")))
            yield batch.slice(at, to - at)
            at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last ends. A null text is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def split_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words start and end, and the first word of each text. A word has no white space byte."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    full = bounds[:-1] < bounds[1:]
    heads, tails = bounds[:-1][full], bounds[1:][full] - 1
    first[heads] = solid[heads]
    last[tails] = solid[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values, in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9E6F0B5D3C2A7E1B)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC3A5C85C97CB3127)
    x ^= x >> np.uint64(32)
    return x


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    size = ends - starts
    out = mixed(size.astype(np.uint64) + np.uint64(0x51ED270B * (seed + 1)))
    if not len(starts):
        return out
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    which, at = np.arange(len(starts)), 0
    short = size <= LONG_WORD
    if not short.all():
        for i in np.flatnonzero(~short):
            digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
            out[i] ^= np.uint64(int.from_bytes(digest, "little"))
        which = which[short]
    while len(which):
        left = size[which] - at
        value = eight[starts[which] + at] & _MASK[np.minimum(left, 8)]
        out[which] = mixed(out[which] ^ value)
        which = which[left > 8]
        at += 8
    return out


def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of the runs of ``words`` words of each text, and where each text's begin.

    Letters A-Z count as a-z. A text of fewer words has its whole sequence as one; a text without
    words, or null, has none.
    """
    data, bounds = text_bytes(column)
    data = LOWER[data]
    starts, ends, first = split_words(data, bounds)
    hashes = hash_words(data, starts, ends)
    counts = np.diff(first)
    runs = hashes.copy()
    for j in range(1, words):
        runs[: max(0, len(runs) - j)] = mixed(runs[: max(0, len(runs) - j)] * np.uint64(0x2545F4914F6CDD1D) + hashes[j:])
    own = np.maximum(counts - words + 1, np.minimum(counts, 1))
    at = np.repeat(first[:-1] - np.concatenate([[0], np.cumsum(own)[:-1]]), own) + np.arange(own.sum())
    sets = runs[at]
    place = np.concatenate([[0], np.cumsum(own)])
    for i in np.flatnonzero((counts > 0) & (counts < words)):
        value = np.array([0x5A5A0000 + int(counts[i])], np.uint64)
        for h in hashes[first[i] : first[i + 1]]:
            value = mixed(value * np.uint64(0x2545F4914F6CDD1D) + h)
        sets[place[i]] = value[0]
    for a, b in zip(place[:-1].tolist(), place[1:].tolist()):
        if b - a > 1:
            sets[a:b].sort()
    if not len(sets):
        return sets, place
    new = np.ones(len(sets), bool)
    new[1:] = sets[1:] != sets[:-1]
    new[place[:-1][own > 0]] = True
    return sets[new], np.concatenate([[0], np.cumsum(new)])[place]
