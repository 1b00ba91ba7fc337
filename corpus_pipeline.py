"""From documents to packed training sequences: each stage applies one operator to what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm import decontaminate, minhash, packing, secret_scan, toxicity
from panelwright.llm.shared import settle


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the table labels scores less than 0.3; held-out labels are not learnt from."""
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model, threshold=0.3)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id (five words, 80 in 100).

    Documents without words and rows without a doc_id stay. Rows are told apart by doc_id and text, and one of equal
    rows is kept.
    """
    keyed = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    found = minhash.near_duplicates(keyed, id_col="_row", words=5, percent=80).where("n_shingles > 0")
    grouped = found.select(F.col("doc_id").alias("_row"), "component_id").distinct()
    rows = keyed.where("doc_id is not null").groupBy("_row").agg(F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"))
    members = settle(grouped.join(rows, "_row"))
    least = members.groupBy("component_id").agg(F.min(F.struct("doc_id", "_row")).alias("least"))
    members = settle(members.join(least, "component_id").select("_row", "n", (F.col("_row") == F.col("least._row")).alias("kept")))
    rest = keyed.join(members.where("not kept or n > 1").select("_row"), "_row", "left_anti")
    once = keyed.join(members.where("kept and n > 1").select("_row"), "_row", "left_semi").dropDuplicates(["_row"])
    return rest.union(once.select(rest.columns)).select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the table benchmark. Rows are told apart by doc_id and text."""
    keyed = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    leaks = decontaminate.find_leaks(keyed, _table(spark, sf_dir, "benchmark"), id_col="_row")
    gone = leaks.select(F.col("doc_id").alias("_row")).distinct()
    return keyed.join(gone, "_row", "left_anti").select(docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts replaced by a mark, and n_chars as it is then."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

#: SQL cannot express the trained, hashed and iterated stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the table documents, each to what the one before kept."""
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
