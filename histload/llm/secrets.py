"""Secret scans: three base patterns, and a battery of randomness tests.

Every run of 20 or more characters of A-Z a-z 0-9 + / _ = - is a candidate. Its encoding is the smallest
alphabet that holds all its characters. Three tests hold it against a random string over that alphabet:

* chi-squared: each symbol equally often;
* runs: the number of stretches in the lower and the upper half of the alphabet;
* serial correlation: a symbol and the next one.

Their p-values, combined by Fisher's method, must not refute randomness. The other error, ordinary text that
looks random, is held down by the false-discovery rate: under the character frequencies of all words of the corpus,
the chi-squared statistic of a text of the candidate's length has a known mean and spread, which gives the
chance that text gets one as small; and text seldom goes from one kind of character (digits, lower, upper, signs) to another, which
bounds the chance that one of the candidate's length does it as often. Fisher's method makes one p-value of both.
Short candidates thus need a better fit. Within each stratum of encoding
and length band the Benjamini-Hochberg step, on a grid of thresholds, finds the cut.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histload.llm.tables import stored
from histload.llm.words import steps, text_bytes

#: The base patterns, by kind, in the order of their kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets of encodings, the smallest first.
ENCODINGS = {
    "decimal": _DIGITS,
    "hex": _DIGITS + "abcdef",
    "HEX": _DIGITS + "ABCDEF",
    "base32": _UPPER + "234567",
    "base36": _DIGITS + _LOWER,
    "BASE36": _DIGITS + _UPPER,
    "base62": _DIGITS + _UPPER + _LOWER,
    "base64": _UPPER + _LOWER + _DIGITS + "+/=",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_=",
    "any": _UPPER + _LOWER + _DIGITS + "+/-_=",
}
NAMES = tuple(ENCODINGS)
SIZES = np.array([len(a) for a in ENCODINGS.values()])
_SYMBOL = np.full((len(NAMES), 256), -1, np.int64)
for _i, _letters in enumerate(ENCODINGS.values()):
    _SYMBOL[_i, list(_letters.encode())] = np.arange(len(_letters))

#: Kinds of characters: digits, lower and upper case, signs of encodings; 0 for all others.
_KIND = np.zeros(256, np.uint8)
for _i, _letters in enumerate((_DIGITS, _LOWER, _UPPER, "+/_=-"), 1):
    _KIND[list(_letters.encode())] = _i

#: Of random strings, the part that the three tests may refute.
REFUTED = 0.001
#: The false-discovery rate.
RATE = 0.01
#: Lengths at which bands begin.
BANDS = (20, 24, 32, 40, 48, 64, 96, 128, 256, 1024)
#: The grid of p-values: each step is a quarter of a power of ten, and the last holds all beyond.
STEPS = 400


@dataclass(frozen=True)
class Battery:
    """What a scan needs to know of the corpus: mean and spread of the chi-squared statistic of text, as
    (constant, by length) for each encoding; how often its next character is of another kind; and the step of the grid from
    which each stratum is cut."""

    mean: tuple[tuple[float, float], ...]
    spread: tuple[tuple[float, float], ...]
    change: float
    cuts: dict[tuple[int, int], int] = field(default_factory=dict)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans (start, kind, end) of the base patterns, in order; kind as its place in KINDS."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _upper_tail(z: np.ndarray) -> np.ndarray:
    return np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in z])


def run_tests(candidates: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each candidate: encoding, length, chi-squared statistic, how often its kind of character changes, and the combined
    p-value of the three tests against randomness."""
    n = len(candidates)
    size = np.array([len(c) for c in candidates])
    data = np.frombuffer("".join(candidates).encode(), np.uint8)
    begins = np.cumsum(size) - size
    owner = np.repeat(np.arange(n), size)
    holds = np.stack([np.minimum.reduceat(_SYMBOL[e][data], begins) >= 0 for e in range(len(NAMES))])
    order = np.argsort(SIZES, kind="stable")
    encoding = order[np.argmax(holds[order], axis=0)]
    alphabet = SIZES[encoding]
    symbol = _SYMBOL[encoding[owner], data]

    counts = np.bincount(owner * 128 + symbol, minlength=n * 128).reshape(n, 128)
    expected = size / alphabet
    chi = (counts.astype(float) ** 2).sum(axis=1) / expected - size
    # Wilson and Hilferty's cube root, with the exact variance for few draws
    free = alphabet - 1.0
    shrunk = free + (chi - free) / np.sqrt(1 - 1 / size)
    z = (np.cbrt(np.maximum(shrunk, 0) / free) - (1 - 2 / (9 * free))) / np.sqrt(2 / (9 * free))
    p_chi = _upper_tail(z)

    half = symbol >= alphabet[owner] // 2
    inside = np.ones(len(data), bool)
    inside[begins] = False
    runs = 1 + np.add.reduceat((half & inside) != (np.concatenate([[False], half[:-1]]) & inside), begins)
    ups = np.add.reduceat(half.astype(np.int64), begins)
    downs = size - ups
    middle = 2.0 * ups * downs / size + 1
    spread = np.sqrt(np.maximum((middle - 1) * (middle - 2) / (size - 1), 1e-9))
    p_runs = np.minimum(1, 2 * _upper_tail(np.abs(runs - middle) / np.maximum(spread, 0.3)))

    centred = symbol - (np.add.reduceat(symbol, begins) / size)[owner]
    variance = np.add.reduceat(centred**2, begins)
    after = np.concatenate([[0.0], centred[1:] * centred[:-1]]) * inside
    r = np.add.reduceat(after, begins) / np.maximum(variance, 1e-9)
    p_serial = np.minimum(1, 2 * _upper_tail(np.abs(r + 1 / size) * np.sqrt(size)))

    half_fisher = -np.log(np.maximum(p_chi, 1e-300)) - np.log(np.maximum(p_runs, 1e-300)) - np.log(np.maximum(p_serial, 1e-300))
    combined = np.exp(-half_fisher) * (1 + half_fisher + half_fisher**2 / 2)  # chi-squared with six degrees of freedom
    kind = _KIND[data]
    changes = np.add.reduceat((kind != np.concatenate([[0], kind[:-1]])) & inside, begins)
    return encoding, size, chi, changes, combined


def text_step(battery: Battery, encoding: np.ndarray, size: np.ndarray, chi: np.ndarray, changes: np.ndarray) -> np.ndarray:
    """The step of the grid that the p-value of "ordinary text of this length" is in; larger is less like text."""
    mean, spread = np.array(battery.mean)[encoding], np.array(battery.spread)[encoding]
    z = (mean[:, 0] + mean[:, 1] * size - chi) / np.sqrt(spread[:, 0] + spread[:, 1] * size)
    # log10 of the upper tail, also where the tail is too small for a float
    tail = np.array([math.log10(max(0.5 * math.erfc(x / math.sqrt(2)), 1e-300)) if x < 30 else -(x * x / 2 + math.log(x * 2.5066)) / math.log(10) for x in z])
    # Chernoff's bound of a binomial tail
    part, rate = np.clip(changes / (size - 1), 1e-12, 1 - 1e-12), battery.change
    apart = part * np.log(part / rate) + (1 - part) * np.log((1 - part) / (1 - rate))
    both = -tail * math.log(10) + np.where(part > rate, (size - 1) * apart, 0.0)
    return np.clip(np.floor(4 * (both - np.log1p(both)) / math.log(10)), 0, STEPS).astype(np.int64)


def _bands(size: np.ndarray) -> np.ndarray:
    return np.searchsorted(BANDS, size, "right") - 1


def _candidates(texts: list[str]) -> tuple[list[str], list[int], list[int]]:
    strings, which, starts = [], [], []
    for i, t in enumerate(texts):
        for m in CANDIDATE.finditer(t):
            strings.append(m.group())
            which.append(i)
            starts.append(m.start())
    return strings, which, starts


def calibrate(docs: DataFrame) -> Battery:
    """The battery for a corpus, from all characters and all candidates of all documents. What reaches the
    driver is one count for each byte and for each stratum and step of the grid."""

    measures = ["encoding", "size", "chi", "changes", "combined"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(258, np.int64)  # of each byte; of two that an encoding may hold, and such of two kinds
        for batch in steps(batches):
            data, _ = text_bytes(batch.column("text"))
            counts[:256] += np.bincount(data, minlength=256)
            kind = _KIND[data]
            pair = (kind[1:] > 0) & (kind[:-1] > 0)
            counts[256:] += np.count_nonzero(pair), np.count_nonzero(pair & (kind[1:] != kind[:-1]))
            strings, _, _ = _candidates(batch.column("text").to_pylist())
            if strings:
                encoding, size, chi, changes, combined = run_tests(strings)
                arrays = [pa.array(encoding), pa.array(size), pa.array(chi), pa.array(changes.astype(np.int64)), pa.array(combined)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.nulls(len(size), pa.list_(pa.int64()))], [*measures, "bytes"])
        nothing = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64())]
        yield pa.RecordBatch.from_arrays([*nothing, pa.array([counts.tolist()], pa.list_(pa.int64()))], [*measures, "bytes"])

    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    found = stored(texts.mapInArrow(measure, "encoding long, size long, chi double, changes long, combined double, bytes array<long>"), "candidates")
    per_byte = found.where("bytes is not null").select(F.posexplode("bytes").alias("byte", "n")).groupBy("byte").agg(F.sum("n").alias("n"))
    counts = np.zeros(258)
    for row in per_byte.collect():  # 258 rows
        counts[row["byte"]] = row["n"]

    mean, spread = [], []
    for e, letters in enumerate(ENCODINGS.values()):
        a = len(letters)
        p = np.zeros(a)
        for byte in letters.encode():
            p[_SYMBOL[e, byte]] = counts[byte] + 1.0
        p /= p.sum()
        square = (p**2).sum()
        mean.append((a * (1 - square), a * ((p - 1 / a) ** 2).sum()))
        spread.append((2.0 * (a - 1), 4.0 * a**2 * (p * (p - square) ** 2).sum()))
    battery = Battery(tuple(mean), tuple(spread), float((counts[257] + 1) / (counts[256] + 2)))

    def grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            encoding, size, chi, changes, combined = (batch.column(c).to_numpy() for c in measures)
            step = np.where(combined >= REFUTED, text_step(battery, encoding, size, chi, changes), -1)
            yield pa.RecordBatch.from_arrays([pa.array(encoding), pa.array(_bands(size)), pa.array(step)], ["encoding", "band", "step"])

    placed = found.where("bytes is null").select(*measures).mapInArrow(grid, "encoding long, band long, step long")
    strata: dict[tuple[int, int], np.ndarray] = {}
    for row in placed.groupBy("encoding", "band", "step").count().collect():  # strata by steps
        strata.setdefault((row["encoding"], row["band"]), np.zeros(STEPS + 2))[row["step"] + 1] += row["count"]
    cuts = {}
    for stratum, n in strata.items():
        reached = n[1:][::-1].cumsum()[::-1]  # candidates in a step or beyond
        threshold = 10.0 ** (-np.arange(STEPS + 1) / 4)
        good = np.flatnonzero((reached > 0) & (n.sum() * threshold <= RATE * reached))
        if len(good):
            cuts[stratum] = int(good[0])
    return Battery(battery.mean, battery.spread, battery.change, cuts)


def find(texts: list[str], battery: Battery) -> list[list[tuple[int, int, int]]]:
    """All spans (start, kind, end) of each text, in order: those of the base patterns, and candidates that the
    battery takes for random and that no base span covers."""
    spans = [base_spans(t) for t in texts]
    strings, which, starts = _candidates(texts)
    if strings:
        encoding, size, chi, changes, combined = run_tests(strings)
        step = text_step(battery, encoding, size, chi, changes)
        bands = _bands(size)
        for j in np.flatnonzero(combined >= REFUTED).tolist():
            start, end = starts[j], starts[j] + int(size[j])
            own = spans[which[j]]
            if step[j] >= battery.cuts.get((int(encoding[j]), int(bands[j])), STEPS + 1) and not any(a <= start and end <= b for a, k, b in own if k < 3):
                own.append((start, 3, end))
    return [sorted(s) for s in spans]


def scan(docs: DataFrame, battery: Battery | None = None) -> DataFrame:
    """The secrets of every whole text: (doc_id, spans), spans an array of (start, kind, end) in code points, end
    exclusive, in order. Kinds: assign, access, hex, random.

    Takes doc_id and text; other columns are ignored. One row for each input row, repeated ones too. A null
    text is empty; a text without secrets has an empty array. Without a battery, one is made for these
    documents.
    """
    battery = battery or calibrate(docs)
    kind = pa.array(KINDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            found = find(batch.column("text").to_pylist(), battery)
            flat = [s for own in found for s in own]
            spans = pa.StructArray.from_arrays(
                [pa.array([s[0] for s in flat], pa.int64()), kind.take(pa.array([s[1] for s in flat], pa.int64())), pa.array([s[2] for s in flat], pa.int64())],
                ["start", "kind", "end"],
            )
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in found])]), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(offsets, spans)], ["doc_id", "spans"])

    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, spans array<struct<start long, kind string, end long>>")


def mask(docs: DataFrame, battery: Battery | None = None, by: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret in ``text`` replaced; overlapping spans as one. Null texts stay null, other columns
    as they are."""
    battery = battery or calibrate(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            texts = batch.column("text").to_pylist()
            for i, own in enumerate(find([t or "" for t in texts], battery)):
                parts, at = [], 0
                for start, _, end in own:
                    if start >= at:
                        parts += [texts[i][at:start], by]
                    at = max(at, end)
                if own:
                    texts[i] = "".join(parts) + texts[i][at:]
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.concat_ws(",", each)
