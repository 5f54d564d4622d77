"""One query per corpus operator, over whole tables, and the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    brown,
    classifier,
    decontaminate,
    linechunks,
    mixing,
    prefixtrie,
    rules,
    sharding,
    simhash,
    tokens,
    warczip,
    wrappers,
)
from .common import read_documents, text_of, word_count


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_documents(spark, folder).select(
        "doc_id", "source", word_count(text_of()).alias("n_words"), F.xxhash64("text").alias("tie"))
    return (
        mixing.plan_mix(docs, mixing.MixPlan(size=F.col("n_words"), tie=F.col("tie")))
        .select("doc_id", "size", "source_size", "target", "taken", "copies", "position")
        .orderBy(F.col("position").asc_nulls_last(), "doc_id")
    )


def class_lm(spark: SparkSession, folder: str) -> DataFrame:
    return brown.score_documents(read_documents(spark, folder))


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linechunks.remove_repeated_chunks(read_documents(spark, folder).select("doc_id", "text"))


def html_wrappers(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.extract_text(_table(spark, folder, "pages"))


def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classifier.score_quality(read_documents(spark, folder), _table(spark, folder, "labels"))


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = rules.judge(read_documents(spark, folder), _table(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def winnowing(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.overlaps(read_documents(spark, folder), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def token_counts(spark: SparkSession, folder: str, path: str | None = None) -> DataFrame:
    return tokens.count_tokens(read_documents(spark, folder), path or public_tokenizers.path("word_bpe_49k.json"))


def shards(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_documents(spark, folder).select(
        "doc_id", "source",
        (F.octet_length(text_of()) + 16).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"))
    return sharding.interleave(rows, tie=F.col("text_crc32")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read_documents(spark, folder)).select("doc_id", "fingerprint", "component_id")


def prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefixtrie.prefix_trie(_table(spark, folder, "conversations"), prefixtrie.branched)


def zip_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    records = warczip.read_packages(warczip.write_packages(pages), payload=False)
    kind = pages.schema["page_id"].dataType
    return records.select(
        F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind))


def token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_tokenizers(
        read_documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_curriculum_mix": mix_sources,
    "op2_class_lm": class_lm,
    "op3_line_chunks": line_dedup,
    "op4_html_wrappers": html_wrappers,
    "op5_quality_classifier": quality_classifier,
    "op6_quality_rules": quality_rules,
    "op7_winnowing": winnowing,
    "op8_token_counts": token_counts,
    "op9_shards": shards,
    "op10_simhash_groups": simhash_groups,
    "op11_prefix_trie": prefix_trie,
    "op12_zip_warc": zip_warc,
    "op13_token_alignment": token_alignment,
}
