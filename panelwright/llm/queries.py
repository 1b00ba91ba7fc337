"""One query for each operator, with the parameters meant for whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelwright.llm import (
    chat,
    crosswalk,
    decontaminate,
    embeddings,
    minhash,
    packing,
    pages,
    phrases,
    pii,
    secret_scan,
    sharding,
    toxicity,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all documents."""
    return pii.digest(table(spark, folder, "documents"))


@query
def op2_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near copies among all documents: three words, 85 in 100."""
    return minhash.near_duplicates(table(spark, folder, "documents"), words=3, percent=85)


@query
def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark passages in all documents."""
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op4_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    return pages.extract(table(spark, folder, "pages"))


@query
def op5_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Near copies among all vectors: cosine of 0.95 or more."""
    return embeddings.near_duplicates(table(spark, folder, "embeddings"), cosine=0.95)


@query
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    return sharding.by_bytes(table(spark, folder, "documents"), shards=16)


@query
def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in all documents."""
    return secret_scan.digest(table(spark, folder, "documents"))


@query
def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations in the template, and one that spells out the template's own marks."""
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.digest(turns)


@query
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labels that are not held out."""
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")), threshold=0.3)


@query
def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(table(spark, folder, "documents"), capacity=2048)


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """All vectors on the 32 leading axes of their covariance, in units of deviation."""
    return whitening.digest(table(spark, folder, "embeddings"), components=32)


@query
def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """Phrase fingerprints of all documents and their edited texts."""
    return phrases.digest(table(spark, folder, "documents"))


@query
def op13_crosswalk(spark: SparkSession, folder: str) -> DataFrame:
    """Two tokenizers aligned on all documents."""
    return crosswalk.digest(table(spark, folder, "documents"))
