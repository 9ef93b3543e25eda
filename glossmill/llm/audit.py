"""How filters interact: what each removes after every order of the others.

The failures are relations of ids, one stored table per filter. What a filter removes
after others is its table left-anti joined with theirs, what it would have removed too
the left-semi join, and what goes on are all ids left-anti joined with the tables so far:
`removed_ids`, `redundant_ids` and `surviving_ids` give the documents of any prefix that
way. For all prefixes of all orders at once, ids that fail the same filters behave alike
in every such join. So one pass over the id tables, placed by id, puts each id into the
class of the filters it fails, with the number of its documents as weight; then
the joins run on the classes, of which a part has at most two to the number of filters,
whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from glossmill.llm.common import saved
from glossmill.session import shared_path

#: White space between words, as a Java character class.
SPACE = r"[\x20\x09-\x0D]+"
#: What is counted of documents besides their number.
MEASURES = ("n", "good", "toxic")


def standard_filters() -> dict[str, Column]:
    """Conditions under which a text, never null, fails; `E` looks at `first_id`, the smallest id with the same text."""
    text = F.col("text")
    words = F.col("words")
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 2 * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


@dataclass(frozen=True)
class Failures:
    """Stored relations: `documents` (key, doc_id, part, n, good, toxic) and per filter the keys that fail it.

    A key stands for rows equal in id, text and source; `n` counts them, `good` and
    `toxic` those of them with such a label.
    """

    spark: SparkSession
    path: str
    filters: tuple[str, ...]

    @property
    def documents(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/documents")

    def failing(self, name: str) -> DataFrame:
        """The id table of one filter; only its files are read."""
        table = self.spark.read.schema("key binary, filter string").parquet(f"{self.path}/failing")
        return table.filter(F.col("filter") == name).select("key")


def find_failures(
    docs: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Column] | None = None,
    duplicates: str | None = "E",
) -> Failures:
    """Apply the filters to every whole text, and store one table of failing ids per filter.

    `filters` are conditions on `text` and `words`; `duplicates` names the filter
    that fails where a smaller doc_id has the same text, anywhere in the table and
    whatever other filters say. Names are single letters, in the order of `filters`.

    A null text is an empty one, a null source the empty string. A null doc_id is
    smaller than none and fails no duplicate filter. Rows equal in id, text and source
    count as often as they stand there. A label counts if any label row of the id has it.
    """
    filters = dict(standard_filters() if filters is None else filters)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    # Whole texts are read once; what is kept of them is a digest.
    judged = saved(
        rows.select(
            "doc_id",
            "part",
            F.unhex(F.sha2("text", 256)).alias("digest"),
            F.array_compact(F.array(*[F.when(fails, name) for name, fails in filters.items()])).alias("failed"),
        ),
        "audit-judged",
    )
    names = tuple(filters)
    if duplicates is not None:
        judged = _with_duplicates(judged, duplicates)
        names += (duplicates,)
    # Equal rows become one before anything is joined by id.
    counted = judged.groupBy("doc_id", "part", "digest").agg(
        F.count("*").alias("n"), F.first("failed").alias("failed")
    )
    of_id = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    keyed = counted.join(of_id, "doc_id", "left").select(
        F.unhex(F.sha2(F.concat(id_text.cast("binary"), F.lit(b" "), "digest", F.col("part").cast("binary")), 256)).alias("key"),
        "doc_id",
        "part",
        "n",
        *[(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")],
        "failed",
    )
    path = shared_path(docs.sparkSession, "audit")
    keyed = saved(keyed, "audit-keyed")
    keyed.drop("failed").write.parquet(f"{path}/documents")
    keyed.select("key", F.explode("failed").alias("filter")).write.partitionBy("filter").parquet(f"{path}/failing")
    return Failures(docs.sparkSession, path, names)


def _with_duplicates(judged: DataFrame, name: str) -> DataFrame:
    """Add `name` to `failed` where a smaller doc_id has the digest.

    Minima combine map-side, and only digests found under several ids are joined back,
    so a text that a third of all rows have is one row on that side; its rows are on the
    other, where adaptive execution splits them.
    """
    first = (
        judged.groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
        .filter("first_id < last_id")
        .select("digest", "first_id")
    )
    is_later = F.col("doc_id") > F.col("first_id")
    return judged.join(first, "digest", "left").select(
        "doc_id",
        "part",
        "digest",
        F.when(is_later, F.concat("failed", F.array(F.lit(name)))).otherwise(F.col("failed")).alias("failed"),
    )


def surviving_ids(found: Failures, prefix: Sequence[str]) -> DataFrame:
    """Documents that pass every filter of the prefix."""
    return reduce(lambda ids, name: ids.join(found.failing(name), "key", "left_anti"), prefix, found.documents)


def removed_ids(found: Failures, prefix: Sequence[str], name: str) -> DataFrame:
    """Documents that `name` removes after the prefix."""
    return surviving_ids(found, prefix).join(found.failing(name), "key", "left_semi")


def redundant_ids(found: Failures, prefix: Sequence[str], name: str) -> DataFrame:
    """Documents that fail `name` but went before it."""
    failing = found.documents.join(found.failing(name), "key", "left_semi")
    return failing.join(removed_ids(found, prefix, name), "key", "left_anti")


def failure_classes(found: Failures) -> DataFrame:
    """`part, failed` (the filters, as letters) and how many documents fail exactly those, by label.

    The id tables and the documents are placed by key once; the classes then combine map-side.
    """
    marks = [found.failing(name).select("key", F.lit(name).alias("filter")) for name in found.filters]
    if not marks:
        of_key = found.documents.limit(0).select("key", F.lit("").alias("failed"))
    else:
        of_key = (
            reduce(DataFrame.union, marks)
            .groupBy("key")
            .agg(F.array_join(F.sort_array(F.collect_set("filter")), "").alias("failed"))
        )
    return (
        found.documents.join(of_key, "key", "left")
        .groupBy("part", F.coalesce("failed", F.lit("")).alias("failed"))
        .agg(*[F.sum(m).alias(m) for m in MEASURES])
    )


def audit(found: Failures) -> DataFrame:
    """Every part, order of all filters and step: what is kept, removed, redundant and lost.

    Columns: `part`, `filter_order`, `step` (from 1; its filter is that letter of the
    order), `kept`, `removed`, `redundant`, `unique_fails`, `good_lost`, `toxic_lost` and
    `shapley`, the removals of the step's filter summed over all orders. An empty
    table has no parts, so no rows.
    """
    classes = saved(failure_classes(found), "audit-classes")
    names = sorted(found.filters)
    prefixes = ["".join(c) for k in range(len(names) + 1) for c in combinations(names, k)]
    # What fails a filter, at each prefix without that filter, and what fails any filter of a prefix.
    fails = classes.select("*", F.explode(F.split("failed", "")).alias("filter")).filter("filter != ''")
    due = fails.select("*", _each(prefixes, lambda p: ~F.contains(p, F.col("filter"))).alias("prefix"))
    gone = classes.select("*", _each(prefixes, lambda p: F.call_function("translate", p, F.col("failed"), F.lit("")) != p).alias("prefix"))
    keys = ["prefix", "part", "failed"]
    zero = F.lit(0).cast("long")
    removed = due.join(gone.select(*keys), keys, "left_anti").select(
        "part", "prefix", "filter",
        F.col("n").alias("removed"), zero.alias("redundant"),
        F.when(F.col("failed") == F.col("filter"), F.col("n")).otherwise(zero).alias("unique_fails"),
        F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
    )
    redundant = due.join(gone.select(*keys), keys, "left_semi").select(
        "part", "prefix", "filter",
        zero.alias("removed"), F.col("n").alias("redundant"), zero.alias("unique_fails"),
        zero.alias("good_lost"), zero.alias("toxic_lost"),
    )
    counts = removed.columns[3:]
    effects = removed.union(redundant).groupBy("part", "prefix", "filter").agg(*[F.sum(c).alias(c) for c in counts])
    lost = gone.groupBy("part", F.col("prefix").alias("after")).agg(F.sum("n").alias("gone"))
    table = (
        _steps(classes, names)
        .join(effects, ["part", "prefix", "filter"], "left")
        .join(lost, ["part", "after"], "left")
        .select(
            "part", "filter_order", "step", "filter",
            (F.col("total") - F.coalesce("gone", zero)).alias("kept"),
            *[F.coalesce(c, zero).alias(c) for c in counts],
        )
    )
    # A part has each filter in as many rows as there are orders.
    return table.withColumn("shapley", F.sum("removed").over(W.partitionBy("part", "filter"))).drop("filter")


def _each(prefixes: Sequence[str], keep: Callable[[Column], Column]) -> Column:
    """One row per set of filters for which `keep` holds."""
    return F.explode(F.filter(F.array(*map(F.lit, prefixes)), keep))


def _steps(classes: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per part, with its `total`, every order and step, with the filters before the step and up to it, as sorted letters."""
    orders = ["".join(p) for p in permutations(names)]
    letters = lambda c: F.array_join(F.sort_array(F.split(c, "")), "")
    order, step = F.col("filter_order"), F.col("step")
    return (
        classes.groupBy("part")
        .agg(F.sum("n").alias("total"))
        .withColumn("filter_order", F.explode(F.split(F.lit(" ".join(orders)), " ")))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(names)))))
        .withColumn("filter", F.substring(order, step, F.lit(1)))
        .withColumn("prefix", letters(F.substring(order, F.lit(1), step - 1)))
        .withColumn("after", letters(F.substring(order, F.lit(1), step)))
    )
