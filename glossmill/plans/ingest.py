"""The ingest job: text files -> annotated, nested records."""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from glossmill.operators.annotate import Annotator, annotate, annotate_with
from glossmill.operators.blocks import MAX_BLOCK_BYTES, group_blocks
from glossmill.operators.parse import parse_blocks
from glossmill.schemas import QUARANTINE_SCHEMA, STORED_SCHEMA
from glossmill.session import get_session, settings, split_settings
from glossmill.sources.records import split_outcomes, staged, with_codec
from glossmill.sources.text import scan_lines

# Where the job reads and writes by default.
DEFAULT_SRC = "/data/abstracts/test.txt"
DEFAULT_DEST = "/data/test.json"

KEYS = ("path", "block_no", "part")
# The partition column of the one write; its folders become the two outputs.
OUTCOME = "outcome"

# Every map task keeps an index entry per shuffle partition and the second shuffle
# has a block per pair of partitions, so the width cannot follow the input for ever.
# 100 TB in 20,000 partitions is 5 GB each, which sorts with spilling.
MAX_WIDTH = 20_000


def ingest(
    spark: SparkSession,
    src: str | list[str],
    dest: str,
    *,
    fmt: str = "json",
    quarantine: str | None = None,
    lexicon: DataFrame | None = None,
    annotator: Callable[[], Annotator] | None = None,
    keep_unterminated: bool = True,
    max_block_bytes: int = MAX_BLOCK_BYTES,
    max_record_bytes: int | None = None,
    partitions: int | None = None,
    ordered: bool = False,
    max_width: int = MAX_WIDTH,
    compression: str | None = None,
) -> dict[str, int]:
    """Read `src`, write nested records to `dest`, and count the rows written.

    A record larger than `max_block_bytes` is several rows with the same id and tags
    and a `part` number; the field is NULL, so absent from JSON, for whole records. A
    block is good or bad as a whole, whatever the limit.
    Bad blocks go to `quarantine` (default: `dest` + ".quarantine") with a reason. Both
    come from one write, and replace what was there before together: after a failure both
    folders are as they were. Parquet files of either have the columns of both, NULL
    where they are the other's; the declared schemas leave those out.
    `partitions` spreads records over more tasks than the splits and the shuffle give,
    for an expensive annotator. `ordered` writes records in file order, for the
    price of a range shuffle. `_errors` of a plug-in annotator is written next to
    the record fields; JSON leaves it out of clean records. Settings of the session
    that the job needs are put back when it ends. `compression` is the codec of both
    outputs, as in `write_records`; `read_records` finds it by the names of the files.
    """
    lines = scan_lines(spark, src)
    held = split_settings(spark) | {
        # Both outcomes are open in a task at once, so rows need no sort by outcome and keep their order.
        "spark.sql.maxConcurrentOutputFileWriters": "4",
    }
    with settings(spark, held), shuffle_width(spark, lines, max_width):
        blocks = parse_blocks(group_blocks(lines, keep_unterminated, max_block_bytes), max_record_bytes)
        rows = _outcomes(blocks)
        # A plug-in and the shape rules keep the order of their input, re-nesting does not.
        renests = annotator is None and lexicon is not None
        if ordered and not renests:
            rows = _in_file_order(rows, partitions)
        elif partitions:
            rows = rows.repartition(partitions)

        if annotator is None:
            annotated = annotate(rows, lexicon, KEYS)
        else:
            annotated = annotate_with(rows, annotator)
        if ordered and renests:
            annotated = _in_file_order(annotated, partitions)
        return _write_outcomes(annotated, dest, quarantine or f"{dest.rstrip('/')}.quarantine", fmt, compression)


def _outcomes(blocks: DataFrame) -> DataFrame:
    """`id, tags, texts` of good blocks and the quarantine columns of bad ones, each NULL in the other's rows."""
    good = F.col("reason").isNull()
    return blocks.select(
        *KEYS,
        *[F.when(good, F.col(c)).alias(c) for c in ("id", "tags", "texts")],
        "reason",
        *[F.when(~good, F.col(c)).alias(c) for c in ("lines", "raw")],
    )


def _write_outcomes(
    rows: DataFrame, dest: str, quarantine: str, fmt: str, compression: str | None = None
) -> dict[str, int]:
    """One write of both outcomes, put in place together; counted in the tasks that write, where a retry counts once."""
    rejected = F.col("reason").isNotNull()
    fields = [f for f in (*STORED_SCHEMA.names, "_errors") if f in rows.columns]
    others = [f for f in QUARANTINE_SCHEMA.names if f not in fields]
    places = [F.when(rejected, F.col(c)).alias(c) for c in ("path", "block_no")]
    typed = rows.select(
        *fields,
        *places,
        *[c for c in others if c not in ("path", "block_no")],
        F.when(rejected, "rejected").otherwise("record").alias(OUTCOME),
    )
    for field in STORED_SCHEMA:
        if typed.schema[field.name].dataType != field.dataType:
            typed = typed.withColumn(field.name, F.col(field.name).cast(field.dataType))
    seen = Observation()
    counted = typed.observe(
        seen, F.count_if(~rejected).alias("records"), F.count_if(rejected).alias("quarantined")
    )
    with staged(rows.sparkSession, [dest, quarantine]) as (records_stage, rejected_stage):
        both = f"{records_stage}.both"
        with_codec(counted.write.partitionBy(OUTCOME).format(fmt), compression).save(both)
        split_outcomes(rows.sparkSession, both, OUTCOME, {"record": records_stage, "rejected": rejected_stage})
        return dict(seen.get)


def _in_file_order(df: DataFrame, partitions: int | None) -> DataFrame:
    if partitions:
        return df.repartitionByRange(partitions, *KEYS).sortWithinPartitions(*KEYS)
    return df.orderBy(*KEYS)


def quarantined(parsed: DataFrame) -> DataFrame:
    """Rejected blocks with their lines, and the raw bytes of those that are not UTF-8."""
    return parsed.filter("reason IS NOT NULL").select(*QUARANTINE_SCHEMA.names)


@contextmanager
def shuffle_width(spark: SparkSession, lines: DataFrame, max_width: int = MAX_WIDTH) -> Iterator[None]:
    """Give shuffles about one partition per file split while a job runs.

    Adaptive execution merges small shuffle partitions but never adds any, so
    the default of 200 would make partitions of hundreds of GB from a large
    input. A session that asks for more than this keeps its setting.
    """
    key = "spark.sql.shuffle.partitions"
    width = max(int(spark.conf.get(key)), min(lines.rdd.getNumPartitions(), max_width))
    with settings(spark, {key: str(width)}):
        yield


def _load(name: str) -> Callable[[], Annotator]:
    module, _, factory = name.partition(":")
    return getattr(importlib.import_module(module), factory)


def main(argv: Sequence[str] | None = None) -> None:
    """Command line of the job, for spark-submit."""
    parser = argparse.ArgumentParser(description="Ingest a text corpus.")
    parser.add_argument("--src", default=DEFAULT_SRC)
    parser.add_argument("--dest", default=DEFAULT_DEST)
    parser.add_argument("--format", default="json", choices=["json", "parquet"])
    parser.add_argument("--compression", help="codec of the outputs, such as gzip")
    parser.add_argument("--quarantine")
    parser.add_argument("--lexicon", help="parquet table with form, lemma, pos1, pos2")
    parser.add_argument("--partitions", type=int)
    parser.add_argument("--ordered", action="store_true", help="write records in file order")
    parser.add_argument("--drop-unterminated", action="store_true")
    parser.add_argument("--annotator", help="module:factory of a plug-in annotator")
    parser.add_argument("--max-block-bytes", type=int, default=MAX_BLOCK_BYTES)
    parser.add_argument("--max-record-bytes", type=int)
    parser.add_argument("--max-width", type=int, default=MAX_WIDTH, help="most shuffle partitions")
    args = parser.parse_args(argv)

    spark = get_session("ingest")
    counts = ingest(
        spark,
        args.src,
        args.dest,
        fmt=args.format,
        quarantine=args.quarantine,
        lexicon=spark.read.parquet(args.lexicon) if args.lexicon else None,
        keep_unterminated=not args.drop_unterminated,
        partitions=args.partitions,
        ordered=args.ordered,
        annotator=_load(args.annotator) if args.annotator else None,
        max_block_bytes=args.max_block_bytes,
        max_record_bytes=args.max_record_bytes,
        max_width=args.max_width,
        compression=args.compression,
    )
    print(counts)


if __name__ == "__main__":
    main()
