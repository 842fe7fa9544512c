"""The corpus pipeline: quality rules, near-dedup, decontamination, secret redaction, tokenization.

Each stage takes the documents that the stage before it kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from leadmill.llm.bpe import encode_documents
from leadmill.llm.decontaminate import drop_leaks
from leadmill.llm.near_dups import keep_one_of_each
from leadmill.llm.quality_rules import filter_documents
from leadmill.llm.secrets import redact_documents
from leadmill.session import scratch_path, ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that the rules reject go."""
    return filter_documents(docs)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one document of each class stays."""
    ship_package(spark)
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a benchmark item go."""
    ship_package(spark)
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: every document stays; each secret in its text becomes a mark."""
    return redact_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: doc_id, lang and source with the token ids, and whether decoding them gives the text back."""
    ship_package(spark)
    out = encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id", "lang", "source", "text"], decode=True)
    return out.select("row.doc_id", "row.lang", "row.source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                      (F.col("decoded") == F.coalesce("row.text", F.lit(""))).alias("round_trip"))


STAGES = [("quality_rules", quality_rules), ("near_dups", near_dups), ("decontamination", decontamination),
          ("secret_scans", secret_scans), ("tokens", tokens)]
ORACLE_SQL = None       # SQL can express neither the sampling nor the tokens; tests use a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; the result is the last stage's."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = scratch_path(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
