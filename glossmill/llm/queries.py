"""The operators as registered queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from glossmill.llm import (
    audit,
    decontaminate,
    html,
    licenses,
    middle,
    mixing,
    pii,
    quality,
    secrets,
    sharding,
    simhash,
    substrings,
    tokens,
)
from glossmill.llm.common import table
from glossmill.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.learn_rules(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, rules).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "rule",
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs).select("row.doc_id", "source", "block", "slot", "place", "release", "deadline", "weight")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    file = public_tokenizers.path("word_bpe_49k.json")
    manifest = tokens.write_tokens(docs, file, tokens.token_folder(docs))
    return tokens.read_documents(manifest)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), 40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "vslot",
    )


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), key="test key, not a secret")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.masked(secrets.scan(table(spark, sf_dir, "documents")))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = middle.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(
        "row.doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = found.withColumn("base", licenses.base_places(F.col("detections")))
    return base.select(
        "row.doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.first_word").alias("first_word"),
        F.array_max("base.first_word").alias("last_word"),
        licenses.joined_labels(F.col("base")).alias("base_labels"),
        licenses.joined_labels(F.col("detections")).alias("labels"),
        "score",
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audit.find_failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit.audit(found).select(
        "part",
        "filter_order",
        "step",
        "kept",
        "removed",
        "redundant",
        "unique_fails",
        "good_lost",
        "toxic_lost",
        "shapley",
    )


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_quality_rules": op2_quality_rules,
    "op3_mixing": op3_mixing,
    "op4_token_files": op4_token_files,
    "op5_simhash": op5_simhash,
    "op6_sharding": op6_sharding,
    "op7_html_text": op7_html_text,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_secret_scan": op9_secret_scan,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_license_scan": op12_license_scan,
    "op13_filter_audit": op13_filter_audit,
}
