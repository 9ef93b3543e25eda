"""Spread a narrow scan over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame


def distribute(scan: DataFrame, partitions: int | None = None) -> DataFrame:
    """Give the rows of a scan at least `partitions` tasks (default: one per core).

    A file that Spark cannot split, such as a Parquet file of one row group, is
    one task however expensive the work on its rows is. A scan that is wide
    enough already is returned as it is, so a large table is never shuffled.
    `scan` must not contain a shuffle of its own: counting its partitions would
    run that.
    """
    target = partitions or scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= target:
        return scan
    return scan.repartition(target)
