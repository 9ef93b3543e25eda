"""A form -> lemma and tags table, counted from an annotated corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def build_lexicon(flat_tokens: DataFrame) -> DataFrame:
    """Rows with `token, lemma, pos1, pos2` -> `form, lemma, pos1, pos2, n`.

    A form is a lower-cased token and appears once, with its most frequent
    reading; ties go to the smallest lemma, then pos1, then pos2. Both steps
    combine map-side, so a frequent form reaches its reducer as a few rows.
    """
    readings = flat_tokens.groupBy(F.lower("token").alias("form"), "lemma", "pos1", "pos2").agg(
        F.count("*").alias("n")
    )
    best = F.min(F.struct((-F.col("n")).alias("rank"), "lemma", "pos1", "pos2", "n"))
    return (
        readings.groupBy("form")
        .agg(best.alias("best"))
        .select("form", "best.lemma", "best.pos1", "best.pos2", "best.n")
    )
