"""Sharding by fixed virtual slots.

A record's hash names one of some thousands of slots, for good. Bytes are summed per
slot, and a map from slots to shards, stored by version, says where each slot lives.
Rebalancing edits the map and writes a new version; records never change slots. Only
the map and the sums per slot, rows of a fixed number, reach the driver.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from glossmill.llm.common import saved
from glossmill.session import shared_path

N_SLOTS = 8192
OVERHEAD = 16

Sizes = Mapping[int, int]


def virtual_slot(doc_id: str = "doc_id", text: str = "text", n_slots: int = N_SLOTS) -> Column:
    """The slot of a record, from the id and the text, so rows that share an id spread; see `sized_rows` for equal rows."""
    return F.pmod(F.xxhash64(doc_id, text), F.lit(n_slots)).cast("int")


def record_size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


def slot_sizes(sized: DataFrame) -> dict[int, int]:
    """Bytes per slot of `vslot, size, n`; at most as many rows as there are slots."""
    return {r[0]: r[1] for r in sized.groupBy("vslot").agg(F.sum(F.col("size") * F.col("n"))).collect()}


def balanced_map(sizes: Sizes, n_shards: int, n_slots: int = N_SLOTS) -> list[int]:
    """slot -> shard: the largest slot that is left goes to the shard with the fewest bytes."""
    loads = [(0, shard) for shard in range(n_shards)]
    out = [0] * n_slots
    for slot in sorted(range(n_slots), key=lambda s: (-sizes.get(s, 0), s)):
        load, shard = heapq.heappop(loads)
        out[slot] = shard
        # An empty slot counts a byte, so empty slots spread as well.
        heapq.heappush(loads, (load + max(1, sizes.get(slot, 0)), shard))
    return out


def rebalanced_map(old: list[int], sizes: Sizes, n_shards: int, tolerance: float = 0.01) -> list[int]:
    """An edited map for `n_shards` and new sizes that moves few slots.

    Slots of shards that no longer exist move first; then slots leave the fullest
    shard for the emptiest while that narrows the gap by more than the tolerance.
    """
    out = list(old)
    members: list[set[int]] = [set() for _ in range(n_shards)]
    homeless = []
    for slot, shard in enumerate(out):
        (members[shard].add if shard < n_shards else homeless.append)(slot)
    loads = [sum(sizes.get(s, 0) for s in m) for m in members]

    def move(slot: int, to: int) -> None:
        if out[slot] < n_shards and slot in members[out[slot]]:
            members[out[slot]].discard(slot)
            loads[out[slot]] -= sizes.get(slot, 0)
        out[slot] = to
        members[to].add(slot)
        loads[to] += sizes.get(slot, 0)

    for slot in sorted(homeless, key=lambda s: (-sizes.get(s, 0), s)):
        move(slot, min(range(n_shards), key=lambda i: (loads[i], i)))
    mean = sum(loads) / n_shards
    for _ in range(len(out)):
        high = max(range(n_shards), key=lambda i: (loads[i], -i))
        low = min(range(n_shards), key=lambda i: (loads[i], i))
        gap = loads[high] - loads[low]
        if gap <= tolerance * mean:
            break
        fitting = [s for s in members[high] if 0 < sizes.get(s, 0) < gap]
        if not fitting:
            break
        move(min(fitting, key=lambda s: (abs(2 * sizes.get(s, 0) - gap), s)), low)
    return out


def save_map(spark: SparkSession, folder: str, version: int, slot_map: list[int]) -> None:
    """Store one version of the map; an existing version is never overwritten."""
    rows = spark.createDataFrame(list(enumerate(slot_map)), "vslot int, shard int")
    rows.coalesce(1).write.mode("error").parquet(f"{folder.rstrip('/')}/version={version}")


def load_map(spark: SparkSession, folder: str, version: int) -> list[int]:
    rows = spark.read.parquet(f"{folder.rstrip('/')}/version={version}").collect()
    return [shard for _, shard in sorted((r["vslot"], r["shard"]) for r in rows)]


def sized_rows(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """`doc_id, size, text_crc32, vslot, n` of `docs(doc_id, text)`; a null text is empty.

    Rows equal in id and text are one class with a number of copies, counted map-side. Copies are dealt
    over the slots from the class's own on, so a class of any number weighs on all slots alike;
    a row that occurs once stays in its `virtual_slot`. `n` is the number of copies in the slot.
    """
    classes = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            record_size().alias("size"),
            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64("doc_id", "text").alias("hash"),
        )
        .groupBy("doc_id", "size", "text_crc32", "hash")
        .agg(F.count("*").alias("copies"))
    )
    # The outer form, as the optimizer adds no filter of its own to it.
    dealt = classes.select("*", F.explode_outer(F.sequence(F.lit(0), F.least("copies", F.lit(n_slots)).cast("int") - 1)).alias("k"))
    left_over = F.col("k") < F.pmod("copies", F.lit(n_slots))
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.pmod(F.pmod("hash", F.lit(n_slots)) + F.col("k"), F.lit(n_slots)).cast("int").alias("vslot"),
        (F.floor(F.col("copies") / n_slots) + left_over.cast("long")).alias("n"),
    )


def place(rows: DataFrame, slot_map: list[int]) -> DataFrame:
    """One row per copy with `shard` and `slot`, the place of the record in its shard, 0, 1, 2, ...

    A place is the number of records in the shard's earlier virtual slots, plus the
    record's number in its own, so a task orders one virtual slot, not a shard. Rows
    with equal ids, null ones too, take places in the order of their contents.
    """
    mapped = rows.sparkSession.createDataFrame(list(enumerate(slot_map)), "vslot int, shard int")
    per_slot = rows.groupBy("vslot").agg(F.sum("n").alias("total"))
    earlier = W.partitionBy("shard").orderBy("vslot").rowsBetween(W.unboundedPreceding, -1)
    # One row per virtual slot, a fixed number.
    starts = mapped.join(per_slot, "vslot").select(
        "vslot", "shard", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("first")
    )
    own = W.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size").rowsBetween(W.unboundedPreceding, -1)
    return (
        rows.withColumn("own", F.coalesce(F.sum("n").over(own), F.lit(0)))
        .join(F.broadcast(starts), "vslot")
        .withColumn("copy", F.explode_outer(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        .withColumn("slot", (F.col("first") + F.col("own") + F.col("copy")).cast("long"))
        .drop("own", "first", "copy", "n")
    )


def assign(docs: DataFrame, n_shards: int, n_slots: int = N_SLOTS, folder: str | None = None) -> DataFrame:
    """`doc_id, size, text_crc32, shard, slot, vslot`: shards of near equal bytes.

    The map is stored in `folder` (default: a new one in the shared folder) as version 1,
    edited for the measured sizes as version 2 where it is out of balance, and the records are placed
    by what is stored. A folder that has versions is edited from its last one, so slots move only where they must.
    Every row of `docs` is placed, rows equal in id and text over all slots, repeated rows and null ids and texts included;
    other columns are ignored, an empty table gives an empty result.
    """
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "slot-map")
    # Read three times below: numbers only, without the texts.
    rows = saved(sized_rows(docs, n_slots), "slot-rows")
    sizes = slot_sizes(rows)
    version = last_version(spark, folder)
    if not version:
        version = 1
        save_map(spark, folder, version, balanced_map(sizes, n_shards, n_slots))
    stored = load_map(spark, folder, version)
    edited = rebalanced_map(stored, sizes, n_shards)
    if edited != stored:
        version += 1
        save_map(spark, folder, version, edited)
    return place(rows, load_map(spark, folder, version))


def last_version(spark: SparkSession, folder: str) -> int:
    """The number of the last stored map, 0 if there is none."""
    try:
        versions = spark.read.parquet(folder)
    except AnalysisException:
        return 0
    return versions.agg(F.max("version")).first()[0] or 0


def write_shards(docs: DataFrame, slot_map: list[int], dest: str) -> None:
    """All columns of `docs` as Parquet, one folder `shard=N` per shard.

    Rows equal in id and text that are more than a slot's share of all go to slots drawn by a seeded number,
    as they would weigh on one shard. There are at most as many such classes as slots.
    """
    spark, names, n_slots = docs.sparkSession, docs.columns, len(slot_map)
    mapped = spark.createDataFrame(list(enumerate(slot_map)), "_vslot int, _shard int")
    classes = docs.groupBy(F.xxhash64("doc_id", "text").alias("_class")).agg(F.count("*").alias("_n"))
    hot = classes.filter(F.col("_n") > max(1, docs.count() / n_slots)).select("_class", F.lit(True).alias("_hot"))
    own, drawn = virtual_slot(n_slots=n_slots), F.floor(F.rand(7) * n_slots).cast("int")
    rows = (
        docs.select(F.struct(*names).alias("_row"), F.xxhash64("doc_id", "text").alias("_class"), own.alias("_own"), drawn.alias("_drawn"))
        .join(F.broadcast(hot), "_class", "left")
        .select("_row", F.when(F.col("_hot"), F.col("_drawn")).otherwise(F.col("_own")).alias("_vslot"))
    )
    placed = rows.join(F.broadcast(mapped), "_vslot").repartition("_vslot")
    out = placed.select("_row.*", F.col("_shard").alias("shard")) if "shard" not in names else placed.select(
        *[F.col(f"_row.{n}").alias(n) for n in names if n != "shard"],
        F.col("_row.shard").alias("record_shard"),
        F.col("_shard").alias("shard"),
    )
    out.write.mode("overwrite").partitionBy("shard").parquet(dest)
