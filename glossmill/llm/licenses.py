"""License scan by ordered signature rules.

Hundreds of expressions (`license_rules`) run on the words of a text. An expression is
tried only on texts that have all of its keywords, which for nearly every text and
rule settles the matter with one look into a set. Detections are word intervals. They
are resolved kind by kind, in the order of `KINDS`: a detection goes if a kept one of an
earlier kind overlaps it, or if one of its own kind contains it. The base phrases
resolve nothing and are never resolved away.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from glossmill.llm import license_rules

BASE = "base"
#: Kinds of signature, the strongest first, and how sure a license is of which one is found.
KINDS = {"tag": 1.0, "address": 0.95, "sentence": 0.95, "versioned": 0.9, "name": 0.7, "generic": 0.3}
BASE_SCORE = 0.5

DETECTION = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("end_word", T.LongType()),
    ]
)
SCAN = T.StructType(
    [T.StructField("n_words", T.LongType()), T.StructField("detections", T.ArrayType(DETECTION, False))]
)

#: Bytes of words become themselves, A-Z lower-cased; all others become spaces.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isdigit() or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


@dataclass(frozen=True)
class Signature:
    label: str
    kind: str
    keywords: tuple[bytes, ...]
    pattern: re.Pattern[bytes]


def signature(label: str, kind: str, keywords: str, expression: str) -> Signature:
    """A rule whose match begins and ends at word borders."""
    pattern = re.compile(b"(?<= )(?:" + expression.encode() + b")(?= )")
    return Signature(label, kind, tuple(keywords.encode().split()), pattern)


@cache
def signatures() -> tuple[Signature, ...]:
    """All rules, in order; the base phrases come first."""

    def lines(text: str) -> Iterable[list[str]]:
        return ([part.strip() for part in line.split("|", 2)] for line in text.strip().splitlines())

    tags = [
        signature(label, "tag", expression.split("(")[0] + " spdx", "spdx license identifier " + expression)
        for label, expression in ([p.strip() for p in x.split("|", 1)] for x in license_rules.TAGS.strip().splitlines())
    ]
    tables = {
        BASE: license_rules.BASE,
        "address": license_rules.ADDRESSES,
        "sentence": license_rules.SENTENCES,
        "versioned": license_rules.VERSIONED,
        "name": license_rules.NAMES,
        "generic": license_rules.GENERIC,
    }
    return (*tags, *(signature(label, kind, words, x) for kind, t in tables.items() for label, words, x in lines(t)))


@cache
def _by_keyword() -> dict[bytes, list[int]]:
    """The rules to look at for a word: each rule under the first of its keywords."""
    found: dict[bytes, list[int]] = {}
    for order, rule in enumerate(signatures()):
        found.setdefault(rule.keywords[0], []).append(order)
    return found


def detect(words: list[bytes]) -> list[tuple[str, str, int, int]]:
    """(label, kind, first word, word after the last) of all matches, ordered by place and then by rule."""
    by_keyword, rules = _by_keyword(), signatures()
    have = set(words)
    orders = sorted(o for word in by_keyword.keys() & have for o in by_keyword[word])
    due = [rules[o] for o in orders if have.issuperset(rules[o].keywords)]
    if not due:
        return []
    text = b" " + b" ".join(words) + b" "
    # Where words begin; a match begins at one and ends before the space after another.
    starts = list(accumulate((len(w) + 1 for w in words), initial=1))
    found = []
    for order, rule in enumerate(due):
        for m in rule.pattern.finditer(text):
            found.append((bisect_left(starts, m.start()), bisect_left(starts, m.end() + 1), order))
    return [(due[o].label, due[o].kind, a, b) for a, b, o in sorted(found)]


def resolve(detections: list[tuple[str, str, int, int]]) -> list[tuple[str, str, int, int]]:
    """Without those that an earlier kind overlaps, or that one of their own kind contains.

    Of equal intervals of one kind the first stays. Sorting is all it costs: kept intervals
    are looked up by the largest end of those that start before a place.
    """
    if not detections:
        return []
    kept = [d for d in detections if d[1] == BASE]
    stronger: list[tuple[int, int]] = []
    for kind in KINDS:
        places = [a for a, _ in stronger]
        furthest = list(accumulate((b for _, b in stronger), max))

        def is_free(first: int, end: int) -> bool:
            before = bisect_left(places, end)
            return before == 0 or furthest[before - 1] <= first

        own = [d for d in detections if d[1] == kind and is_free(d[2], d[3])]
        reach = -1
        for d in sorted(own, key=lambda d: (d[2], -d[3])):
            if d[3] > reach:
                reach = d[3]
                kept.append(d)
                stronger.append((d[2], d[3]))
        stronger.sort()
    return sorted(kept, key=lambda d: (d[2], d[3]))


@F.arrow_udf(SCAN)
def _scan(texts: pa.Array) -> pa.Array:
    counts, found = [], []
    for text in texts:
        words = text.as_buffer().to_pybytes().translate(WORD_BYTES).split()
        counts.append(len(words))
        found.append([dict(zip(DETECTION.names, d)) for d in resolve(detect(words))])
    item = pa.struct([("label", pa.string()), ("kind", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64())])
    return pa.StructArray.from_arrays(
        [pa.array(counts, pa.int64()), pa.array(found, pa.list_(item))], SCAN.names
    )


def scan(docs: DataFrame) -> DataFrame:
    """Every license named anywhere in the whole `text` of each row.

    Columns: `row` (the input row as it is, whatever its columns are called), `n_words`,
    `detections` (label, kind, first word, word after the last; by place) and `score`,
    the surest kind found, 0 if none. A null text is an empty one and has no words, so
    no detections. Equal rows give equal results, and an empty table none. Time grows
    with the length of a text, times the rules whose keywords it has.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    scanned = rows.withColumn("found", _scan(F.coalesce(F.col("row.text").cast("string"), F.lit(""))))
    return scanned.select(
        "row", "found.n_words", "found.detections", _score(F.col("found.detections")).alias("score")
    )


def _score(detections: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in {**KINDS, BASE: BASE_SCORE}.items() for x in pair])
    return F.coalesce(F.array_max(F.transform(detections, lambda d: known[d["kind"]])), F.lit(0.0))


def base_places(detections: Column) -> Column:
    return F.filter(detections, lambda d: d["kind"] == BASE)


def joined_labels(detections: Column) -> Column:
    """Distinct labels, sorted and joined by commas."""
    return F.array_join(F.sort_array(F.array_distinct(detections["label"])), ",")
