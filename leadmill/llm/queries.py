"""One query ``opN_<name>`` per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import oracles
from .bpe import encode_documents
from .chat import format_conversations, read_back, reply_chains
from .collocations import collocations
from .common import table
from .decontaminate import find_leaks
from .near_dups import duplicate_classes
from .pitman_yor import score_documents as score_texts
from .quality_classifier import score_documents
from .quality_rules import judge_documents
from .registry import ORACLES, QUERIES, query  # noqa: F401
from .repair import repair_report
from .secrets import scan_documents
from .sharding import shard_documents
from .substrings import remove_repeats
from .url_filters import judge_urls


@query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op2_near_dups")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_classes(table(spark, sf_dir, "documents"))


@query("op3_substrings", oracles.SUBSTRINGS)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_quality_rules", oracles.QUALITY_RULES)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op5_url_filters", oracles.URL_FILTERS)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op6_bpe")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"], True)
    return out.select("row.doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op7_chat", oracles.CHAT)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    say = "</s>[INST] ok [/INST]"
    rows = rows.union(spark.createDataFrame([(-1, 0, "user", say), (-1, 1, "assistant", say)], rows.schema))
    out = format_conversations(reply_chains(rows))
    out = out.withColumn("back", read_back(F.col("formatted"), F.col("mask")))
    conv_id = F.when(F.col("conv") != "", F.substring("conv", 2, 100).cast("long"))
    return out.select(conv_id.alias("conv_id"), "back.n_turns", F.sha2("back.turns", 256).alias("turns_sha256"),
                      F.length("back.loss").cast("long").alias("loss_chars"), F.sha2("back.loss", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"))


@query("op8_secret_scans")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(table(spark, sf_dir, "documents"))


@query("op9_decontamination", oracles.DECONTAMINATION)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "n_shingles", "n_shared", "containment")


@query("op10_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), 8)


@query("op11_pitman_yor")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


@query("op12_collocations", oracles.COLLOCATIONS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@query("op13_conversation_repair", oracles.REPAIR)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(table(spark, sf_dir, "conversations"))
