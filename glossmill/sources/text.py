"""Text source and the matching sink for line-oriented records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from glossmill.functions.text import strip


def scan_lines(spark: SparkSession, src: str | list[str]) -> DataFrame:
    """Read text files, globs or directories as stripped lines, in parallel splits.

    Columns: `path`; `split`, the byte offset at which the file split starts;
    `row`, increasing within a split; `line`; `valid`, false when the raw bytes
    are not UTF-8 (`line` then holds replacement characters, and `raw` the bytes in
    base64; it is NULL for valid lines). `(split, row)` is file order, and rows of a split
    are consecutive numbers. A line ends at LF, CR LF or CR. The session is left as it is;
    see `session.split_settings` for plans with several scans.
    """
    return spark.read.text(src).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
        strip(F.make_valid_utf8("value")).alias("line"),
        F.is_valid_utf8("value").alias("valid"),
        F.when(~F.is_valid_utf8("value"), F.base64(F.col("value").cast("binary"))).alias("raw"),
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Add `number`, the place of a line in its file from 1, to whole `scan_lines` output.

    The rows of a split are consecutive, so a line has as many lines before it as the earlier
    splits of its file, plus its distance from the first row of its own. Only one
    row per split is shuffled, aggregated map-side from a scan that reads no text out.
    """
    in_file = W.partitionBy("path").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    splits = (
        lines.groupBy("path", "split")
        .agg(F.min("row").alias("first_row"), F.count("*").alias("n"))
        .select("path", "split", "first_row", F.coalesce(F.sum("n").over(in_file), F.lit(0)).alias("lines_before"))
    )
    changed = F.raise_error(F.lit("file splits changed between scans")).cast("long")
    number = F.coalesce("lines_before", changed) + F.col("row") - F.col("first_row") + 1
    return lines.join(splits, ["path", "split"], "left").select(*lines.columns, number.alias("number"))


def write_blocks(df: DataFrame, lines: Column, dest: str) -> None:
    """Write one blank-line-terminated block per row; `lines` is an array column.

    A row becomes one multi-line string, so the lines of a block stay together
    without a sort or a shuffle.
    """
    df.select(F.concat(F.array_join(lines, "\n"), F.lit("\n"))).write.mode("overwrite").text(dest)
