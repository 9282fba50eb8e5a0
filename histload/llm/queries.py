"""The queries of this subpackage's operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histload.llm import (
    bpe,
    jaccard_join,
    language_model,
    line_dedup,
    merkle,
    packing,
    quality,
    secrets,
    simhash,
    tool_calls,
    top_k,
    toxicity,
    whitening,
)
from histload.llm.tables import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str) -> Callable:
    def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = fn
        return fn

    return register


@query("op1_line_dedup")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents"))


@query("op2_top_k")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long"), top_k.scaled(F.col("embedding")).alias("v"))
    return top_k.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5)


@query("op3_bpe")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = bpe.encode(table(spark, sf_dir, "documents"), TOKENIZER)
    return bpe.decode(tokens, TOKENIZER).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256")
    )


@query("op4_tool_calls")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    schemas = {
        "answer": {"prompt": ("string", True), "turn": ("integer", True)},
        "configure": {"instructions": ("string", True)},
    }
    return tool_calls.linked(*tool_calls.exchanges(table(spark, sf_dir, "conversations")), schemas)


@query("op5_quality")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.posteriors(docs, model, F.col("source"), F.col("lang"))


@query("op6_simhash")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op7_secrets")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    of = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter(spans, lambda s: s["kind"] != "random")
    return secrets.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", of("assign"), of("access"), of("hex"), F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(spans).alias("spans")
    )


@query("op8_packing")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


@query("op9_language_model")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.pseudo_likelihood(table(spark, sf_dir, "documents"))


@query("op10_jaccard_join")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_components(table(spark, sf_dir, "documents"), words=4, num=85, den=100)


@query("op11_merkle")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.documents(table(spark, sf_dir, "documents"))


@query("op12_toxicity")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, part = table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 4
    model = toxicity.train(docs, table(spark, sf_dir, "labels").where(part != 2))
    held_out = F.coalesce(part == 2, F.lit(False)).alias("held_out")
    return toxicity.scores(docs, model).select("doc_id", held_out, "score", "predicted")


@query("op13_whitening")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(whitening.scaled(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), most=32)
