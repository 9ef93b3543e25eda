"""Quality rules: decision lists learned by sequential covering, in column expressions only.

A rule is a conjunction of thresholds on text statistics that says "reject". Rules
are grown one literal at a time by FOIL gain on two thirds of the labelled rows,
pruned on the other third, and added while they stay precise there; the rows a
rule covers leave the training set before the next one is grown. The result is
one ordered CASE expression that names the first rule that fires.

Statistics, candidate counts and decisions run as built-in functions; only counts
per candidate literal (at most features * 2 * quantiles) reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from glossmill.llm.common import WORD, saved

#: The base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

FEATURES = (
    "n_words",
    "mean_word_chars",
    "symbols_per_word",
    "dup_line_ratio",
    "repeat_ratio",
    "distinct_ratio",
    "upper_ratio",
    "mark_ratio",
)


@dataclass(frozen=True)
class Settings:
    """Bounds of the training. `max_labels` rows, the first by a hash of doc_id, are used."""

    max_labels: int = 4000
    max_rules: int = 6
    max_literals: int = 3
    quantiles: int = 15
    min_precision: float = 0.9
    min_covered: int = 3


@dataclass(frozen=True)
class Literal:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= F.lit(self.threshold) if self.at_least else value < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = tuple[Literal, ...]


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts and the ratios of `FEATURES` of whole texts; null counts as empty.

    Windows of three words are compared by a 64-bit hash inside one document.
    """
    # Steps of their own, so that no step computes an array twice.
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(WORD))
    window = lambda i: F.xxhash64(
        F.element_at("_words", i), F.element_at("_words", i + 1), F.element_at("_words", i + 2)
    )
    n = F.size("_words")
    no_windows = F.array().cast("array<bigint>")
    df = docs.withColumns({"_words": words, "_lines": lines})
    df = df.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[#*$%&|<>]")).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_distinct": F.size(F.array_distinct("_words")).cast("long"),
            "n_upper": F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[A-Z]")).cast("long"),
            "n_marks": F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[!?|]")).cast("long"),
            "_windows": F.when(
                n >= 3, F.transform(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))), window)
            ).otherwise(no_windows),
        }
    ).drop("_lines", "_words")
    # A condition that is always true but not deterministic makes this step a barrier: a filter on statistics that
    # the optimizer pushed below it would compute every array again inside the filter.
    repeated = F.when(F.monotonically_increasing_id() >= 0, _repeated_words("_windows"))
    df = df.withColumn("n_repeat_words", repeated).drop("_windows")
    per_word = lambda name: F.when(F.col("n_words") > 0, F.col(name) / F.col("n_words")).otherwise(0.0)
    per_char = lambda name: F.when(F.col("word_chars") > 0, F.col(name) / F.col("word_chars")).otherwise(0.0)
    return df.withColumns(
        {
            "mean_word_chars": per_word("word_chars"),
            "symbols_per_word": per_word("n_symbols"),
            "dup_line_ratio": F.when(F.col("n_lines") > 0, F.col("n_dup_lines") / F.col("n_lines")).otherwise(0.0),
            "repeat_ratio": per_word("n_repeat_words"),
            "distinct_ratio": per_word("n_distinct"),
            "upper_ratio": per_char("n_upper"),
            "mark_ratio": per_char("n_marks"),
        }
    )


def _repeated_words(windows: str) -> Column:
    """Words covered by windows that occur twice or more.

    Sorting (hash, position) pairs brings equal windows together; the positions of
    those are sorted again, and each adds the words up to the next one, at most 3.
    """
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    hash_at = lambda a, i: F.try_element_at(a, i).getField("h")

    def repeated(a: Column) -> Column:
        marked = F.filter(
            a,
            lambda p, i: (p["h"] == hash_at(a, i + 2))
            | (F.when(i > 0, p["h"] == hash_at(a, F.greatest(i, F.lit(1)))).otherwise(False)),
        )
        return F.sort_array(F.transform(marked, lambda p: p["i"]))

    def covered(at: Column) -> Column:
        gaps = F.zip_with(
            at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), lambda x, y: F.least(F.coalesce(y - x, F.lit(3)), F.lit(3))
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x)

    # let() through a one-element array: the lambda variable is computed once.
    let = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)
    count = let(pairs, lambda a: let(repeated(a), covered))
    return F.when(F.size(windows) == F.size(F.array_distinct(windows)), F.lit(0).cast("long")).otherwise(count)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def first_rule(rules: Sequence[Rule]) -> Column:
    """The ordered CASE: the text of the first rule that fires, or NULL."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        condition = F.lit(True)
        for literal in rule:
            condition = condition & literal.column()
        out = F.when(condition, " AND ".join(map(str, rule))).otherwise(out)
    return out


def learn_rules(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> list[Rule]:
    """Learn reject rules from `docs(doc_id, text)` and `labels(doc_id, quality)`.

    Rows with a null id or label are no labels. A doc_id that repeats in `docs`
    counts once per row. Without labels of both kinds no rule is learned.
    """
    # The label side is at most max_labels rows of 12 bytes, so this broadcast has a bound.
    some = (
        labels.select(F.col("doc_id"), F.col("quality").cast("int").alias("_quality"))
        .dropna()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "_quality")
        .limit(settings.max_labels)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    train = saved(
        with_statistics(rows)
        .filter(~base_failed())
        .select(
            (F.col("_quality") == 0).alias("bad"),
            (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) == 0).alias("holdout"),
            *[F.col(f).cast("double").alias(f) for f in FEATURES],
        ),
        "quality-labels",
    )
    literals = _candidates(train, settings)
    rules: list[Rule] = []
    while literals and len(rules) < settings.max_rules:
        left = train.filter(first_rule(rules).isNull())
        rule = _prune(left.filter("holdout"), _grow(left.filter("NOT holdout"), literals, settings))
        good, covered = _precision(left, rule)
        held, _ = _precision(left.filter("holdout"), rule)
        if not rule or covered < settings.min_covered or min(good, held) < settings.min_precision:
            break
        rules.append(rule)
    return rules


def _candidates(train: DataFrame, settings: Settings) -> list[Literal]:
    """Thresholds at quantiles of either class."""
    at = [(i + 0.5) / settings.quantiles for i in range(settings.quantiles)]
    found = train.groupBy("bad").agg(
        *[F.percentile_approx(f, at, 10_000).alias(f) for f in FEATURES]
    ).collect()
    if len(found) < 2:
        return []
    return [
        Literal(f, at_least, t)
        for f in FEATURES
        for t in sorted({t for row in found for t in row[f]})
        for at_least in (True, False)
    ]


def _grow(rows: DataFrame, literals: Sequence[Literal], settings: Settings) -> Rule:
    rule: Rule = ()
    while len(rule) < settings.max_literals:
        counts = _count_literals(_covered(rows, rule), literals)
        bad, good = counts.pop(-1, (0, 0))
        if not bad or not good:
            break
        before = math.log2(bad / (bad + good))
        gain = lambda c: c[0] * (math.log2(c[0] / sum(c)) - before) if c[0] else 0.0
        best = max(counts, key=lambda k: (gain(counts[k]), -k), default=None)
        if best is None or gain(counts[best]) <= 0:
            break
        rule += (literals[best],)
    return rule


def _count_literals(rows: DataFrame, literals: Sequence[Literal]) -> dict[int, tuple[int, int]]:
    """(bad, good) rows that each literal covers; -1 stands for all rows."""
    # One table of literals of bounded size, met by each training row.
    options = [(-1, 0, "true", "double('-inf')")] + [
        (k, FEATURES.index(x.feature), str(x.at_least).lower(), f"{float(x.threshold)!r}D")
        for k, x in enumerate(literals)
    ]
    items = ", ".join(f"named_struct('k', {k}, 'f', {f}, 'up', {up}, 't', {t})" for k, f, up, t in options)
    met = rows.select("bad", F.array(*FEATURES).alias("x"), F.expr(f"explode(array({items}))").alias("o")).filter(
        (F.element_at("x", F.col("o.f") + 1) >= F.col("o.t")) == F.col("o.up")
    )
    counts = met.groupBy("o.k").agg(
        F.count_if(F.col("bad")).alias("bad"), F.count_if(~F.col("bad")).alias("good")
    )
    return {r["k"]: (r["bad"], r["good"]) for r in counts.collect()}


def _covered(rows: DataFrame, rule: Rule) -> DataFrame:
    for literal in rule:
        rows = rows.filter(literal.column())
    return rows


def _precision(rows: DataFrame, rule: Rule) -> tuple[float, int]:
    r = _covered(rows, rule).agg(F.count_if(F.col("bad")).alias("bad"), F.count("*").alias("n")).first()
    return (r["bad"] / r["n"] if r["n"] else 0.0), r["n"]


def _prune(rows: DataFrame, rule: Rule) -> Rule:
    """The prefix with the best (bad - good) / (bad + good) on the held-out rows."""
    best, value = rule, -2.0
    for size in range(1, len(rule) + 1):
        precision, n = _precision(rows, rule[:size])
        if n and 2 * precision - 1 > value:
            best, value = rule[:size], 2 * precision - 1
    return best


def judge(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """`docs` with statistics, `base_failed`, `rule` (why the list rejects) and `kept`."""
    return (
        with_statistics(docs)
        .withColumns({"base_failed": base_failed(), "rule": first_rule(rules)})
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def keep_good(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that neither the base rules nor the list reject, with the columns of `docs`.

    Statistics are computed next to a packed copy of the row, so that columns of
    `docs` may have any names, theirs included.
    """
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))
    return judge(packed, rules).filter("kept").select("row.*")
