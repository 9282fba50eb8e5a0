"""A corpus pipeline: its stages in order, each reading the written rows of the one before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from histload.llm import jaccard_join, line_dedup, packing, quality, secrets
from histload.llm.tables import stored, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. It learns from the labelled documents among those given.

    A null text is judged as an empty one, and repeated rows alike, by their id and text. Null sources are one host, null
    languages one path. Without labels of both kinds nothing is evidence, and all stay. Without documents none stay."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.good_documents(docs, model, F.col("source"), F.col("lang")).select(*COLUMNS)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go, and documents that had nothing else; what goes stays in an earlier document, or, where no
    document with an id has it, in one without. Null, empty and blank texts that had no such line stay as they are. Rows
    that repeat a doc_id are one document and are treated alike."""
    return _measured(line_dedup.dedup(docs).where("n_removed = 0 or text is null or text rlike '[^ \\t-\\r]'"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the first by doc_id, null after all others, then by the hash of its
    text, then by the other columns. Texts decide what is a copy: rows that share a doc_id but not their text are
    documents of their own. A text without words is only a copy of the same text with the same doc_id, or both null."""
    docs = docs.select(*COLUMNS)
    alone = lambda c: F.when(F.col("label").isNull(), F.col(c)).alias(f"own_{c}")
    # copies of a row are counted before anything is moved
    rows = jaccard_join.labelled(docs).groupBy("label", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash", "n")).alias("m")
    kept = rows.groupBy("label", alone("doc_id"), alone("text_hash")).agg(first)
    kept = stored(kept.selectExpr("m.doc_id as kept_id", "m.text_hash as kept_hash", "m.n as n"), "kept")
    met = F.col("doc_id").cast("long").eqNullSafe(F.col("kept_id")) & (F.xxhash64("text") == F.col("kept_hash"))
    once = docs.join(kept.where("n = 1"), met, "left_semi")
    repeated = kept.where("n > 1")
    if repeated.isEmpty():
        return once
    again = docs.join(repeated, met).groupBy("kept_id", "kept_hash").agg(F.min(F.struct(*COLUMNS)).alias("m"))
    return once.union(again.select("m.*"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark. All rows stay, repeated ones too; null and empty texts as they are."""
    return _measured(secrets.mask(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, as pieces in sequences of 1024 tokens. A null or empty text is a piece with the end token alone;
    repeated rows are packed as often as they are there. Among documents of a length, which goes where depends on the order in which they are read."""
    return packing.pack(docs, TOKENIZER)


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_quality),
    ("line_dedup", without_boilerplate),
    ("jaccard_join", near_duplicates),
    ("secret_scans", without_secrets),
    ("best_fit_packing", packed),
]

#: No SQL: the stages hold a trained model and a genetic search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Of columns of the same name beside those of documents nothing is kept; empty tables give no
    rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
