"""Nest child rows into records, and walk the children of records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from glossmill.functions.text import explode_with_position
from glossmill.schemas import TOKEN_FIELDS
from glossmill.session import shared_path


# A row cannot exceed 2 GiB; a group of more than this is several rows.
MAX_PART_BYTES = 256 * 1024 * 1024
# What an entry takes besides its text.
ENTRY_BYTES = 48


def nest_children(
    children: DataFrame,
    keys: Sequence[str],
    order: str,
    fields: Sequence[str],
    into: str,
    parents: DataFrame | None = None,
    max_part_bytes: int = MAX_PART_BYTES,
) -> DataFrame:
    """One row per key with its children, in `order`, as an array of structs `into`.

    With `parents` (one row per key) a parent without children gets an empty array.
    A group larger than `max_part_bytes` is several rows, numbered by `part` from 0 in
    `order`; `part` is NULL for whole groups. No child is left out, and only a child
    that alone is too large makes a larger part. Children with one `order` are sorted by `fields`.

    Sizes of groups, which combine map-side, are measured first, by a job of its own. Groups that
    fit are placed by one shuffle. If there are others, their children are dealt by ranges of keys and order, so however many a group has, they are
    spread over all tasks; see `_nested_in_parts`.
    """
    keys = list(keys)
    size = sum((_bytes(f) for f in fields), F.lit(ENTRY_BYTES)).cast("long")
    sized = children.select(*keys, order, *[f for f in fields if f not in (*keys, order)], size.alias("_size"))
    totals = sized.groupBy(*keys).agg(F.sum("_size").alias("_total"))
    if (totals.agg(F.max("_total")).first()[0] or 0) <= max_part_bytes:
        nested = _nested_whole(sized, keys, order, fields)
    else:
        large = totals.filter(F.col("_total") > max_part_bytes)
        large = large.select(*[F.col(k).alias(f"_large_{i}") for i, k in enumerate(keys)])
        in_large = _same([(F.col(k), F.col(f"_large_{i}")) for i, k in enumerate(keys)])
        whole = _nested_whole(sized.join(large, in_large, "left_anti"), keys, order, fields)
        of_large = sized.join(large, in_large, "left_semi")
        nested = whole.union(_nested_in_parts(of_large, keys, order, fields, max_part_bytes))
    children_of = F.transform("_children", lambda c: F.struct(*[c[f].alias(f) for f in fields]))
    nested = nested.select(*keys, "part", children_of.alias(into))
    if parents is None:
        return nested
    return parents.join(nested, keys, "left").withColumn(
        into, F.coalesce(into, F.array().cast(nested.schema[into].dataType))
    )


def _nested_whole(children: DataFrame, keys: list[str], order: str, fields: Sequence[str]) -> DataFrame:
    nested = children.groupBy(*keys).agg(F.sort_array(F.collect_list(_entry(order, fields))).alias("_children"))
    return nested.select(*keys, F.lit(None).cast("long").alias("part"), "_children")


def _nested_in_parts(
    children: DataFrame, keys: list[str], order: str, fields: Sequence[str], max_part_bytes: int
) -> DataFrame:
    """Large groups as numbered parts.

    The place of a child in bytes has two levels, as that of a line in a file: a running sum
    inside its range, and per range the bytes of all earlier ranges of its group, which is one
    row per group and range. Both levels must see the same ranges, which Spark draws from a sample
    each time it deals rows; so the children of large groups are dealt once and written to the shared folder.
    """
    spark = children.sparkSession
    sort = [order, *[f for f in fields if f != order and f not in keys]]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = children.repartitionByRange(ranges, *keys, *sort).withColumn("_range", F.spark_partition_id())
    path = shared_path(spark, "children")
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sums = (
        dealt.groupBy(*keys, "_range")
        .agg(
            F.sum("_size").alias("_bytes"),
            F.max("_size").alias("_widest"),
        )
        .withColumn("_start", F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)))
        .withColumn("_widest", F.max("_widest").over(W.partitionBy(*keys)))
        .select(
            *[F.col(k).alias(f"_sum_{i}") for i, k in enumerate(keys)],
            F.col("_range").alias("_of_range"),
            "_start",
            "_widest",
        )
    )
    pairs = [(F.col(k), F.col(f"_sum_{i}")) for i, k in enumerate(keys)]
    same = _same(pairs) & (F.col("_range") == F.col("_of_range"))
    in_range = W.partitionBy(*keys, "_range").orderBy(*sort).rowsBetween(W.unboundedPreceding, -1)
    local = F.coalesce(F.sum("_size").over(in_range), F.lit(0))
    # Only where a child alone is larger than a part are numbers left out; they then close up.
    has_gaps = F.col("_gaps")
    closing = W.partitionBy(*keys, F.when(~has_gaps, F.col("part"))).orderBy("part")
    return (
        dealt.join(sums, same)
        .withColumn("_at", F.col("_start") + local)
        .groupBy(*keys, F.floor(F.col("_at") / max_part_bytes).alias("part"))
        .agg(
            F.sort_array(F.collect_list(_entry(order, fields))).alias("_children"),
            (F.max("_widest") > max_part_bytes).alias("_gaps"),
        )
        .withColumn("part", F.when(has_gaps, F.dense_rank().over(closing) - 1).otherwise(F.col("part")).cast("long"))
        .select(*keys, "part", "_children")
    )


def _entry(order: str, fields: Sequence[str]) -> Column:
    return F.struct(F.col(order).alias("_order"), *fields)


def _same(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Equal in all pairs, NULL being equal to NULL."""
    return reduce(Column.__and__, [a.eqNullSafe(b) for a, b in pairs])


def _bytes(field: str) -> Column:
    return F.coalesce(F.octet_length(F.col(field).cast("string")), F.lit(0))


def flatten_sentences(records: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """One row per sentence: the keys, `sent_pos` and the sentence fields.

    A record without sentences stays as a row of NULLs.
    """
    return records.select(*keys, F.posexplode_outer("sentences").alias("sent_pos", "s")).select(
        *keys, "sent_pos", "s.*"
    )


def flatten_tokens(sentences: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """`flatten_sentences` output -> one row per token, with `tok_pos` and five fields."""
    zipped = F.arrays_zip(*[_as_long_as_token(f).alias(f) for f in TOKEN_FIELDS])
    rows = explode_with_position(sentences, [*keys, "sent_pos"], zipped, "tok_pos", "t")
    return rows.select(*keys, "sent_pos", "tok_pos", "t.*")


def _as_long_as_token(name: str) -> Column:
    # One NULL array would make the zip NULL and lose every token.
    nulls = F.array_repeat(F.lit(None).cast("string"), F.size("token"))
    return F.coalesce(F.col(name), F.when(F.col("token").isNotNull(), nulls))
