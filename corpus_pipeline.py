"""A corpus pipeline of five stages; each takes and gives the columns of `documents`, the last one gives pieces."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import packing, quality, secret_scan, simhash, toxicity
from riskloom.llm.batches import fresh_name, quoted
from riskloom.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _columns(docs: DataFrame) -> list[str]:
    return [c for c in COLUMNS if c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below 0.3; the model learns from the labels of documents at hand."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    keep = _columns(docs)
    return toxicity.score_texts(docs, model, keep=keep, name="__toxicity").where("__toxicity < 0.3").select(*keep)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; rules run by rejections per cost on a sample."""
    keep = _columns(docs)
    order = quality.ordered(quality.RULES, quality.estimate(docs, "text"))
    return quality.first_rejection(docs, "text", order, keep, "__why").where("__why is null").select(*keep)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate component; rows with a null or repeated id count as they are."""
    return simhash.one_of_each(docs.select(*_columns(docs)), "doc_id", "text")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret in the text replaced by a mark; n_chars follows the text."""
    model = secret_scan.train(secret_scan.labelled_tokens(docs))
    base = fresh_name(docs.columns, "base")
    found = fresh_name(docs.columns, "found")
    spans = secret_scan.find_spans(docs, model, base=base, found=found)
    text = secret_scan.redacted(F.col("text"), F.col(found))
    masked = spans.withColumn("n_chars", F.when(F.size(found) > 0, F.length(text).cast("long")).otherwise(F.col("n_chars"))) if "n_chars" in docs.columns else spans
    return masked.withColumn("text", text).select(*map(quoted, _columns(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' tokens in sequences of 2048."""
    return packing.pack(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("simhash_near_dedup", drop_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: The fitted and sampled stages can't be said in SQL; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's result written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
