"""The corpus pipeline: documents -> good, distinct, decontaminated, mixed -> token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each
result as Parquet in the shared folder and reads it back as the next one's docs.
All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from glossmill.llm import decontaminate, mixing, quality, simhash, tokens
from glossmill.llm.common import saved, table

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned decision list reject go."""
    return quality.keep_good(docs, quality.learn_rules(docs, table(spark, sf_dir, "labels")))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a pattern of a benchmark item go."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, sorted into the mixture: the order of the files and of the rows in them."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mixture, and per document what was read back from them."""
    manifest = tokens.write_tokens(
        docs, public_tokenizers.path(TOKENIZER), tokens.token_folder(docs), _written_order(docs)
    )
    return tokens.read_documents(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def _written_order(docs: DataFrame) -> list[Column]:
    """Where rows stand in the files they were read from; by doc_id if they come from elsewhere."""
    if not docs.inputFiles():
        return [F.col("doc_id")]
    return [F.col("_metadata.file_name"), F.col("_metadata.row_index")]


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing", mix_sources),
    ("token output", token_output),
]

#: SQL can express neither the learned rules nor the fingerprints; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`: one row per document in the token files.

    Null and repeated ids, null, empty and very long texts and extra columns pass through as the
    stages define for them; without documents the result is empty. Each stage is written
    whole before the next reads it, so a lost executor costs at most a part of one stage.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-').lower()}")
    return docs
