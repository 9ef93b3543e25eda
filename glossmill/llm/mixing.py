"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

The rows of a source, in the order of a hash, form blocks. With whole shares s of a
period P (the target weight is s / P, the shares add up to P), block j of a source
is released at slot floor(j * P / s) and due before slot ceil((j + 1) * P / s). In
each slot the released block with the earliest deadline goes next. As the shares
fill the period every slot is taken and every deadline met, so after any number of
slots each source is less than one block off its weight. The schedule repeats with
the period, so it is computed once for P slots and applied to all blocks by
arithmetic. A source that has run out leaves its slots empty; no row is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

PERIOD = 1000
BLOCK_ROWS = 16
BUCKET_ROWS = 4096


def tempered_weights(docs: DataFrame, power: float = 0.5) -> DataFrame:
    """`source, weight`: rows of each source to a power, which lifts small sources."""
    return docs.groupBy(_source().alias("source")).agg(F.pow(F.count("*"), F.lit(power)).alias("weight"))


def _source() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(""))


def shares(sources: DataFrame, weights: DataFrame, period: int = PERIOD) -> DataFrame:
    """`source, share`: weights as whole slots of a period of about `period`, at least 1 each."""
    known = sources.join(weights.groupBy("source").agg(F.max("weight").alias("weight")), "source", "left")
    usable = F.when(F.col("weight") > 0, F.col("weight")).otherwise(0.0)
    # One row per source; the window sees no other rows.
    total = F.sum(usable).over(W.partitionBy())
    share = F.when(total > 0, F.round(usable * period / total)).otherwise(1).cast("long")
    return known.select("source", F.greatest(share, F.lit(1).cast("long")).alias("share"))


def schedule(shared: DataFrame) -> DataFrame:
    """`source, k, slot, share, period`: the slot of the k-th block of each source.

    Earliest deadline first over one period, folded over the slots of one row. Its
    size is the period, whatever the size of the corpus.
    """
    one = shared.agg(
        F.sort_array(F.collect_list(F.struct("source", "share"))).alias("s"),
        F.sum("share").alias("period"),
    ).filter("period > 0")
    share = lambda i: F.element_at("s", i + 1).getField("share")
    release = lambda c, i: F.floor(c * F.col("period") / share(i))
    deadline = lambda c, i: F.ceil((c + 1) * F.col("period") / share(i))

    def pick(counts: Column, t: Column) -> Column:
        ready = F.transform(
            counts,
            lambda c, i: F.when(
                (c < share(i)) & (release(c, i) <= t), F.struct(deadline(c, i).alias("d"), i.alias("i"))
            ),
        )
        return F.array_min(ready).getField("i")

    def step(state: Column, t: Column) -> Column:
        best = pick(state["counts"], t)
        counts = F.transform(state["counts"], lambda c, i: F.when(i == best, c + 1).otherwise(c))
        return F.struct(counts.alias("counts"), F.concat(state["picks"], F.array(best)).alias("picks"))

    start = F.struct(
        F.transform("s", lambda x: F.lit(0).cast("long")).alias("counts"),
        F.array().cast("array<int>").alias("picks"),
    )
    picks = F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("period") - 1), start, step, lambda x: x["picks"])
    taken = one.withColumn("picks", picks).select("s", "period", F.posexplode("picks").alias("slot", "i"))
    in_source = W.partitionBy("i").orderBy("slot")
    return taken.select(
        F.element_at("s", F.col("i") + 1).getField("source").alias("source"),
        (F.row_number().over(in_source) - 1).cast("long").alias("k"),
        F.col("slot").cast("long").alias("slot"),
        F.element_at("s", F.col("i") + 1).getField("share").alias("share"),
        "period",
    )


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
    period: int = PERIOD,
) -> DataFrame:
    """`docs(doc_id, source)`, all columns in `row`, with `source, block, slot, place, release, deadline`.

    Rows in the order of `slot, place` are the mixture. A null source is the source
    ''; one without a weight gets one slot. Rows with equal ids or none are ordered
    by a hash of the row, equal rows arbitrarily, which changes no result. Numbers
    in a source come from two levels, so a hot source is many small groups: rows in
    a bucket, and buckets before it.
    """
    names = docs.columns
    total = docs.count()
    n_buckets = max(1, total // BUCKET_ROWS)
    hashable = [c for c in names if not docs.schema[c].dataType.simpleString().startswith("map")]
    rows = docs.select(
        F.struct(*names).alias("row"),
        _source().alias("source"),
        F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(*hashable))).alias("key"),
    ).withColumn("bucket", F.pmod(F.col("key"), F.lit(n_buckets)))
    counts = rows.groupBy("source", "bucket").agg(F.count("*").alias("n"))
    before = counts.withColumn(
        "before", F.sum("n").over(W.partitionBy("source").orderBy("bucket")) - F.col("n")
    ).drop("n")
    weights = tempered_weights(docs) if weights is None else weights
    plan = schedule(shares(rows.select("source").distinct(), weights, period))
    per_source = plan.groupBy("source").agg(F.max("share").alias("share"), F.max("period").alias("period"))
    in_bucket = W.partitionBy("source", "bucket").orderBy("key")
    numbered = (
        rows.withColumn("rank", F.row_number().over(in_bucket) - 1)
        .join(before, ["source", "bucket"])
        .withColumn("number", F.col("before") + F.col("rank"))
        .withColumn("block", F.floor(F.col("number") / block_rows))
        .withColumn("place", F.pmod("number", F.lit(block_rows)))
        .drop("before", "rank", "number", "bucket", "key")
    )
    # A row per source, and a row per slot of the period: both bounded, whatever the corpus.
    return (
        numbered.join(F.broadcast(per_source), "source")
        .withColumn("k", F.pmod("block", "share"))
        .join(F.broadcast(plan.select("source", "k", F.col("slot").alias("first_slot"))), ["source", "k"])
        .select(
            "row",
            "source",
            "block",
            (F.floor(F.col("block") / F.col("share")) * F.col("period") + F.col("first_slot")).alias("slot"),
            "place",
            F.floor(F.col("block") * F.col("period") / F.col("share")).alias("release"),
            F.ceil((F.col("block") + 1) * F.col("period") / F.col("share")).alias("deadline"),
            (F.col("share") / F.col("period")).alias("weight"),
        )
    )


def mixed(docs: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """The rows and columns of `docs`, sorted into the mixture across the output files."""
    return mix(docs, weights).orderBy("slot", "place").select("row.*")
