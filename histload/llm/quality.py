"""Quality classifier by hierarchical empirical Bayes.

A logistic model over the make-up of whole texts gives each document evidence: the log of how much likelier
it is among good documents than among bad ones. Documents stand in paths, paths in hosts. Evidence is pooled
upwards by grouped sums: a host's share of good documents is shrunk towards the corpus', a path's towards its
host's, the more the fewer documents there are; how much is estimated from how far hosts (paths) differ. The shrunk
share of its path, its own evidence left out, is a document's prior; prior and evidence give its posterior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histload.llm.tables import stored, tasks_after
from histload.llm.words import split_words, steps, text_bytes

#: The model is fitted to at most so many labelled documents, those whose id has the smallest hash.
LABELLED = 8000

#: Classes of bytes whose share of a text is a feature.
_CLASSES = ("upper", "lower", "digit", "space", "newline", "bar", "shout", "symbol", "stop", "mark", "wide", "control")


def _class_of() -> np.ndarray:
    out = np.full(256, _CLASSES.index("control"), np.int64)
    out[0x80:] = _CLASSES.index("wide")
    out[0x21:0x7F] = _CLASSES.index("mark")
    for name, letters in {
        "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "lower": "abcdefghijklmnopqrstuvwxyz",
        "digit": "0123456789",
        "space": " \t\r",
        "newline": "\n",
        "bar": "|",
        "shout": "!?",
        "symbol": "#$%&*+<=>@^_~{}[]\\/",
        "stop": ".,;:",
    }.items():
        out[list(letters.encode())] = _CLASSES.index(name)
    return out


_CLASS = _class_of()
N_FEATURES = len(_CLASSES) + 5


def features(column: pa.Array) -> np.ndarray:
    """The make-up of each text: shares of byte classes, and lengths of words, lines and the text."""
    data, bounds = text_bytes(column)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    counts = np.bincount(owner * len(_CLASSES) + _CLASS[data], minlength=len(sizes) * len(_CLASSES)).reshape(len(sizes), -1)
    starts, ends, first = split_words(data, bounds)
    words = np.diff(first)
    whose = np.repeat(np.arange(len(sizes)), words)
    short = np.bincount(whose, (ends - starts) <= 3, minlength=len(sizes))
    long = np.bincount(whose, (ends - starts) >= 12, minlength=len(sizes))
    some, any_word = np.maximum(sizes, 1), np.maximum(words, 1)
    lines = 1 + counts[:, _CLASSES.index("newline")]
    shares = np.log1p(200 * counts / some[:, None])
    more = (np.log1p(sizes), (counts.sum(axis=1) - counts[:, 3:5].sum(axis=1)) / any_word / 5, short / any_word, long / any_word, np.log1p(words / lines))
    return np.column_stack([shares, *more])


@dataclass(frozen=True)
class Model:
    """A logistic model on standardised features; ``share`` of its labelled documents were good."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    share: float

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log of the likelihood ratio of good to bad, within the range that doubles can weigh."""
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        score = self.weights[0] + z @ self.weights[1:]
        return np.clip(score - np.log(self.share / (1 - self.share)), -30, 30)


def fit(x: np.ndarray, good: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> Model:
    """Newton's method with a ridge. Without both kinds of label, all evidence is nil."""
    share = float(np.clip(good.mean(), 1e-3, 1 - 1e-3)) if len(good) else 0.5
    if len(good) == 0 or good.min() == good.max():
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.append(np.log(share / (1 - share)), np.zeros(N_FEATURES)), share)
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.column_stack([np.ones(len(x)), np.clip((x - centre) / scale, -8, 8)])
    w = np.zeros(z.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(h, z.T @ (good - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return Model(centre, scale, w, share)


def train(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> Model:
    """The model from labelled documents: (doc_id, quality) with quality 0 or 1; null labels are left out.
    At most ``most`` labels are used, so that their ids can be handed to all tasks and their features to the driver."""
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    known = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")  # at most `most` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            x = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality").cast(pa.int32()), pa.array(x.tolist(), pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    measured = known.mapInArrow(run, "doc_id long, quality int, x array<double>")
    rows = measured.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("x").alias("x")).orderBy("doc_id").collect()
    return fit(np.array([r["x"] for r in rows]).reshape(-1, N_FEATURES), np.array([r["quality"] for r in rows], float))


def _logit(p: Column) -> Column:
    return F.ln(p / (1 - p))


def _strength(groups: DataFrame, mean: str) -> float:
    """How many documents the prior of a group counts for, by moments: the spread of the groups' shares
    around ``mean`` beyond that of samples of their sizes. Takes n, good and mean."""
    row = groups.where("n > 1").agg(
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col(mean), 2)),
        F.sum(F.col(mean) * (1 - F.col(mean))),
        F.sum((F.col("n") - 1) * F.col(mean) * (1 - F.col(mean))),
    ).first()
    if row[0] is None or not row[2]:
        return 1.0
    between = max(row[0] - row[1], 0.0) / row[2]  # part of the variance that lies between groups
    return float(np.clip((1 - between) / max(between, 1e-6), 1.0, 1e6))


def _row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def posteriors(docs: DataFrame, model: Model, host: Column, path: Column, least: float = 0.5) -> DataFrame:
    """The posterior of every document: (doc_id, evidence, prior, posterior, keep).

    Takes doc_id, text and what ``host`` and ``path`` need; other columns are ignored. One row for each input row,
    repeated ones too. A null text is empty. Null hosts are one host, null paths one path of their host.
    ``keep`` says whether the posterior reaches ``least``.
    """
    return _judged(docs, model, host, path, least).drop("row")


def good_documents(docs: DataFrame, model: Model, host: Column, path: Column, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose posterior reaches ``least``, with all their columns."""
    bad = _judged(docs, model, host, path, least).where("not keep").select(F.col("row").alias("bad_row")).distinct()
    return docs.join(bad, _row_key() == F.col("bad_row"), "left_anti")


def _judged(docs: DataFrame, model: Model, host: Column, path: Column, least: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            evidence = model.evidence(features(batch.column("text")))
            yield batch.select(["doc_id", "row", "host", "path"]).append_column("evidence", pa.array(evidence))

    names = {"host": F.coalesce(host.cast("string"), F.lit("\0")), "path": F.coalesce(path.cast("string"), F.lit("\0"))}
    texts = docs.select(F.col("doc_id").cast("long"), _row_key().alias("row"), "text", *(c.alias(n) for n, c in names.items()))
    each = stored(texts.mapInArrow(run, "doc_id long, row long, host string, path string, evidence double"), "evidence")
    prior = float(np.log(model.share / (1 - model.share)))
    each = each.withColumn("own", 1 / (1 + F.exp(-(F.col("evidence") + prior))))

    # sums are taken before rows are moved, so that a host with most of the documents is a few rows
    paths = stored(each.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("own").alias("good")), "paths", tasks_after(each))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    mean = hosts.agg(F.sum("good") / F.sum("n")).first()[0]
    hosts = hosts.withColumn("mean", F.lit(mean if mean is not None else model.share))
    by_host = _strength(hosts, "mean")
    shrunk = hosts.select("host", ((F.col("good") + by_host * F.col("mean")) / (F.col("n") + by_host)).alias("host_share"))
    paths = paths.join(shrunk, "host")
    by_path = _strength(paths, "host_share")

    placed = each.join(paths.select("host", "path", "n", "good", "host_share"), ["host", "path"])
    share = (F.col("good") - F.col("own") + by_path * F.col("host_share")) / (F.col("n") - 1 + by_path)
    placed = placed.withColumn("prior", F.least(F.greatest(share, F.lit(1e-4)), F.lit(1 - 1e-4)))
    placed = placed.withColumn("posterior", 1 / (1 + F.exp(-(F.col("evidence") + _logit(F.col("prior"))))))
    return placed.select("doc_id", "row", "evidence", "prior", "posterior", (F.col("posterior") >= least).alias("keep"))
