"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from glossmill.session import shared_path

#: White space of the word rule `[^\x20\x09-\x0D]+`, as a Java character class.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Apply a batch function to every Arrow batch; it may return None for no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = function(batch)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """`edges(a, b)` of longs -> `node, component`, the smallest node reachable.

    Alternates large-star and small-star steps until the edges stay the same.
    Every step is two shuffles whose groups combine map-side, each round is
    written to the shared folder, and only two numbers per round reach the
    driver. A hub is a skewed join key, which adaptive execution splits.
    """
    current = saved(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a < b")
        .distinct(),
        f"{name}-edges",
    )
    before = _fingerprint(current)
    while before[0]:
        current = saved(_small_star(_large_star(current)), f"{name}-edges")
        now = _fingerprint(current)
        if now == before:
            break
        before = now
    # Stable edges are stars: every node points at the smallest of its component.
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        current.select("a", "a").distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.join(least, "u")
        .filter("v > u")
        .select(F.col("m").alias("a"), F.col("v").alias("b"))
        .filter("a < b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    links = edges.join(least, "b").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return links.filter("a < b").union(least.select("m", "b")).distinct()


def _fingerprint(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
    ).first()
    return row["n"], row["x"]


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array without nulls, not copied, and where each text starts; one offset more at the end."""
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    kind, n = (np.int64 if wide else np.int32), len(texts)
    if offsets is None or not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    places = np.frombuffer(offsets, kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    values = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return values[places[0] : places[-1]], places - places[0]
