"""BPE encoding and decoding by tree concatenation.

A text is cut where every reading of it has a boundary between two pre-tokens; pieces between such places
are encoded on their own and their ids put one after the other. A pre-token longer than a leaf (a long run
without a boundary) is halved until its parts are leaves. These are encoded in parallel and joined in pairs
up the tree: the last tokens of the left side and the first of the right are decoded and encoded again as one
window, which grows until its first token is the left side's and its last the right side's. Two adjacent
tokens that come from one encoding stay as they are in any longer one, so the joined ids are then the ids of
the whole.

Ids are held as binary: little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histload.llm.words import steps

#: Fixed value: how byte-level BPE cuts a text into pre-tokens.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Code points of a leaf, and of a text that is cut over several tasks.
LEAF = 1 << 14
LONG_TEXT = 1 << 16

#: No pre-token holds a visible character and white space after it.
_BOUNDARY = re.compile(r"(?<=[!-~])(?=[ \t\r\n])")


def _letters_to_bytes() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: visible ones stand for themselves, the
    others, in order, for the code points from 256."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Codec:
    """The vocabulary in a tokenizer file, with its merges in the order of their ids."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for n, merge in enumerate(spec["model"]["merges"]):
            if vocabulary["".join(merge.split(" ") if isinstance(merge, str) else merge)] != 256 + n:
                raise ValueError("the ids of the vocabulary are not in the order of its merges")
        byte = _letters_to_bytes()
        ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if t not in self.special}
        self._encoding = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self._bytes = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in self.special.items()}
        self._split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")" if self.special else r"(?!)()")

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, in one go."""
        return self._encoding.encode_to_numpy(text, allowed_special="all")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; ids without a token are left out, bytes that are no UTF-8 are replaced."""
        return b"".join(map(self._bytes.get, ids.tolist(), _nothing())).decode("utf-8", "replace")

    def segments(self, text: str, leaf: int = LEAF) -> Iterator[tuple[bool, str]]:
        """A text in order, as (is a run, part): parts that are encoded on their own, and pre-tokens
        longer than a leaf."""
        for n, part in enumerate(self._split_special.split(text)):
            if n % 2:
                yield False, part
                continue
            at = 0
            while at < len(part):
                to = _next_boundary(part, at + leaf)
                if to - at <= 2 * leaf:
                    yield False, part[at:to]
                else:
                    yield from _runs(part[at:to], leaf)
                at = to

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids of a run from those of its two parts."""
        k = 4
        while len(left) and len(right):
            a, b = min(k, len(left)), min(k, len(right))
            window = b"".join(map(self._bytes.__getitem__, [*left[len(left) - a :].tolist(), *right[:b].tolist()]))
            try:
                middle = self._encoding.encode_to_numpy(window.decode(), disallowed_special=())
            except UnicodeDecodeError:  # it begins or ends within a character
                k += 1
                continue
            if (a == len(left) or middle[0] == left[-a]) and (b == len(right) or middle[-1] == right[b - 1]):
                return np.concatenate([left[: len(left) - a], middle, right[b:]])
            k *= 2
        return left if len(left) else right

    def tree(self, parts: list[np.ndarray]) -> np.ndarray:
        """Joins neighbours until one is left."""
        while len(parts) > 1:
            parts = [self.join(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0]

    def encode_by_tree(self, text: str, leaf: int = LEAF) -> np.ndarray:
        """The ids of a text, by the cuts and joins that a cluster makes."""
        done = [self.tree([self.encode(x) for x in halves(s, leaf)]) if run else self.encode(s) for run, s in self.segments(text, leaf)]
        return np.concatenate(done) if done else np.zeros(0, np.uint32)


def _nothing() -> Iterator[bytes]:
    while True:
        yield b""


def _next_boundary(text: str, at: int) -> int:
    found = _BOUNDARY.search(text, at) if at < len(text) else None
    return found.start() if found else len(text)


def _runs(text: str, leaf: int) -> Iterator[tuple[bool, str]]:
    """A stretch without a certain boundary, by its own pre-tokens: short ones gathered, long ones alone."""
    begin = end = 0
    for found in regex.finditer(PATTERN, text):
        if found.end() - found.start() > leaf:
            yield from _closed(text, begin, found.start())
            yield True, found.group()
            begin = found.end()
        elif found.end() - begin > leaf:
            yield from _closed(text, begin, found.start())
            begin = found.start()
        end = found.end()
    yield from _closed(text, begin, end)


def _closed(text: str, begin: int, end: int) -> Iterator[tuple[bool, str]]:
    """The pre-tokens between two places as one part, but for white space at its end, which would be read
    otherwise without what follows: its pre-tokens stay alone."""
    cut = end
    while cut > begin and text[cut - 1].isspace():
        cut -= 1
    if begin < cut:
        yield False, text[begin:cut]
    for found in regex.finditer(PATTERN, text[: end + 1], pos=cut):
        if found.start() < end:
            yield False, text[found.start() : min(found.end(), end)]


def halves(run: str, leaf: int) -> list[str]:
    """A run cut in two again and again, until no part is longer than a leaf."""
    n = 1
    while len(run) > n * leaf:
        n *= 2
    return [run[len(run) * i // n : len(run) * (i + 1) // n] for i in range(n)]


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One per worker."""
    return Codec(path)


#: Makes the rows of some documents from their ids: gets doc_ids and ids. One is made for each task.
Finish = Callable[[pa.Array, list[np.ndarray]], pa.RecordBatch]


def encode_rows(docs: DataFrame, path: str, finish: Callable[[int], Finish], schema: str, leaf: int = LEAF, long_text: int = LONG_TEXT) -> DataFrame:
    """What ``finish`` makes of the ids of every text. ``finish(0)`` gets short texts, ``finish(1)`` long ones."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, encode = finish(0), codec(path).encode
        for batch in steps(batches):
            yield make(batch.column("doc_id"), [encode(t) for t in batch.column("text").to_pylist()])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            rows = [
                {"doc_id": r["doc_id"], "digest": r["digest"], "copies": r["copies"], "segment": i, "leaf": j, "text": x}
                for r in batch.to_pylist()
                for i, (run, s) in enumerate(codec(path).segments(r["text"], leaf))
                for j, x in enumerate(halves(s, leaf) if run else [s])
            ]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("doc_id", pa.int64()), ("digest", pa.string()), ("copies", pa.int64()), ("segment", pa.int32()), ("leaf", pa.int32()), ("text", pa.string())]))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path).encode
        for batch in steps(batches):
            ids = pa.array([encode(t).tobytes() for t in batch.column("text").to_pylist()], pa.binary())
            yield batch.select(["doc_id", "digest", "copies", "segment", "leaf"]).append_column("ids", ids)

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = finish(1)
        for batch in batches:
            for row in range(batch.num_rows):
                segments: dict[int, list[np.ndarray]] = {}
                for part in batch.column("parts")[row].as_py():
                    segments.setdefault(part["segment"], []).append(np.frombuffer(part["ids"], np.uint32))
                ids = np.concatenate([codec(path).tree(parts) for _, parts in sorted(segments.items())])
                for _ in range(batch.column("copies")[row].as_py()):
                    yield make(batch.column("doc_id").slice(row, 1), [ids])

    short = docs.where(F.length("text") <= long_text).mapInArrow(whole, schema)
    long = docs.where(F.length("text") > long_text).groupBy("doc_id", "text").agg(F.count("*").alias("copies"))
    keys = ("doc_id", "digest", "copies")
    parts = (
        long.select("doc_id", F.sha2("text", 256).alias("digest"), "copies", "text")
        .mapInArrow(cut, "doc_id long, digest string, copies long, segment int, leaf int, text string")
        .repartition("doc_id", "digest", "segment", "leaf")
        .mapInArrow(leaves, "doc_id long, digest string, copies long, segment int, leaf int, ids binary")
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("segment", "leaf", "ids"))).alias("parts"))  # of one document
    )
    return short.unionByName(parts.mapInArrow(grown, schema))


def _as_ids(_: int) -> Finish:
    def make(doc_ids: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [doc_ids, pa.array([len(i) for i in ids], pa.int64()), pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())],
            ["doc_id", "n_tokens", "ids"],
        )

    return make


def encode(docs: DataFrame, path: str, leaf: int = LEAF, long_text: int = LONG_TEXT) -> DataFrame:
    """The ids of every whole text by the tokenizer in the file ``path``: (doc_id, n_tokens, ids).

    Takes doc_id and text; other columns are ignored. One row for each input row, repeated ones too. A null
    text is empty and has no ids. The text of a special token stands for that token.
    """
    return encode_rows(docs, path, _as_ids, "doc_id long, n_tokens long, ids binary", leaf, long_text)


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` (doc_id, n_tokens, ids) with the text of the ids. Special tokens are written out, ids without
    a token left out, null ids have a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in steps(batches, "ids"):
            texts = [None if x is None else own.decode(np.frombuffer(x, "<u4")) for x in batch.column("ids").to_pylist()]
            yield batch.append_column("text", pa.array(texts, pa.string()))

    return tokens.select("doc_id", "n_tokens", "ids").mapInArrow(run, "doc_id long, n_tokens long, ids binary, text string")
