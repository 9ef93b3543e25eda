"""Fill-in-the-middle documents, cut at code points found eight bytes at a time.

A batch of texts is one buffer of UTF-8, viewed as uint64 words. In a word, a byte
starts a code point if its bit 7 is clear or its bit 6 is set; moved down by one
byte, with the first byte of the next word moved in, the same marks stand on the
bytes that end one. `bitwise_count` gives the ends per word and their running sum
is searched for the word of the k-th end. Inside a word, multiplying the marks by
0x0101... puts the number of ends so far into every byte, and one subtraction
compares all eight with k. So no text is decoded, whatever its length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from glossmill.llm.common import text_buffer

ONES = np.uint64(0x0101010101010101)
HIGHS = np.uint64(0x8080808080808080)
#: Bytes of text looked at together; a longer text is looked at alone.
CHUNK_BYTES = 1 << 24
CUTS = T.StructType(
    [T.StructField(f, T.LongType()) for f in ("n", "prefix_chars", "middle_chars")]
    + [T.StructField(f, T.IntegerType()) for f in ("prefix_bytes", "middle_bytes")]
)


@dataclass(frozen=True)
class Sentinels:
    """The marks before the three pieces.

    None of them may have a first character of one at a later place. Then a text without
    them cannot form one together with a mark, and `restored` is exact.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        marks = (self.prefix, self.suffix, self.middle)
        if not all(marks) or len(set(marks)) < 3:
            raise ValueError("sentinels must be three different texts")
        firsts = {m[0] for m in marks}
        if any(c in firsts for m in marks for c in m[1:]) or any(
            a != b and a.startswith(b) for a in marks for b in marks
        ):
            raise ValueError("a sentinel must not be found across the border of another")


def transform(
    docs: DataFrame,
    sentinels: Sentinels = Sentinels(),
    seed: str = "1",
    plain_percent: int = 10,
    spm_percent: int = 20,
) -> DataFrame:
    """Cut every whole text into prefix, middle and suffix and put them in training order.

    Columns: `row` (the input row as it is, whatever its columns are called), `n` (code
    points), `form` (`plain`, `psm` or `spm`), `prefix_chars` and `middle_chars` (NULL if
    plain) and `output`. The cuts and the form follow from the sha256 of `seed`, `:` and
    doc_id, so rows with one doc_id and text get one output and a rerun changes nothing.

    A null text is an empty one, a null doc_id an empty string after the `:`. An empty text,
    one that has a sentinel, and one that is not UTF-8 stay plain. An empty table gives no rows.
    """
    text = F.coalesce(F.col("row.text"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    has_mark = text.contains(sentinels.prefix) | text.contains(sentinels.suffix) | text.contains(sentinels.middle)
    rows = (
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        .select("row", digest.alias("digest"))
        .select("row", *[h[i].alias(f"h{i + 1}") for i in range(4)])
        .withColumn("cut", _cuts(text, "h1", "h2"))
    )
    plain = (text == "") | ~F.is_valid_utf8(text) | has_mark | (F.col("h3") % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    raw = text.cast("binary")
    prefix = F.substring(raw, F.lit(1), F.col("cut.prefix_bytes")).cast("string")
    middle = F.substring(
        raw, F.col("cut.prefix_bytes") + 1, F.col("cut.middle_bytes")
    ).cast("string")
    rest = F.col("cut.prefix_bytes") + F.col("cut.middle_bytes")
    suffix = F.substring(raw, rest + 1, F.octet_length(text)).cast("string")
    p, s, m = F.lit(sentinels.prefix), F.lit(sentinels.suffix), F.lit(sentinels.middle)
    is_plain = F.col("form") == "plain"
    return rows.withColumn("form", form).select(
        "row",
        F.col("cut.n").alias("n"),
        "form",
        F.when(~is_plain, F.col("cut.prefix_chars")).alias("prefix_chars"),
        F.when(~is_plain, F.col("cut.middle_chars")).alias("middle_chars"),
        F.when(is_plain, text)
        .when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle))
        .otherwise(F.concat(s, suffix, p, prefix, m, middle))
        .alias("output"),
    )


def restored(output: Column, form: Column, sentinels: Sentinels = Sentinels()) -> Column:
    """The text that `transform` made `output` from, byte for byte."""
    p, s, m = sentinels.prefix, sentinels.suffix, sentinels.middle

    def pieces(first: str, second: str) -> tuple[Column, Column, Column]:
        before_middle = F.substring_index(output, m, 1)
        one = F.substring(F.substring_index(before_middle, second, 1), F.lit(len(first) + 1), F.length(output))
        return one, F.substring_index(before_middle, second, -1), F.substring_index(output, m, -1)

    prefix, suffix, middle = pieces(p, s)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = pieces(s, p)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


@F.arrow_udf(CUTS)
def _cuts(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    data, offsets = text_buffer(texts)
    draws = [np.asarray(h, np.int64) for h in (h1, h2)]
    found, start = [], 0
    while start < len(texts):
        limit = offsets[start] + CHUNK_BYTES
        stop = max(start + 1, int(np.searchsorted(offsets, limit, "right")) - 1)
        part = slice(start, stop)
        base = offsets[start]
        found.append(cuts(data[base : offsets[stop]], offsets[start : stop + 1] - base, *(h[part] for h in draws)))
        start = stop
    columns = [np.concatenate(c) for c in zip(*found)] or [np.zeros(0, np.int64)] * 5
    kinds = [pa.int64()] * 3 + [pa.int32()] * 2
    names = ["n", "prefix_chars", "middle_chars", "prefix_bytes", "middle_bytes"]
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def cuts(data: np.ndarray, offsets: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per text: units, units of prefix and middle, bytes of prefix and middle.

    `data` holds the UTF-8 of all texts, one after the other, from `offsets[i]` to `offsets[i + 1]`.
    """
    ends = unit_ends(data, offsets)
    per_word = np.bitwise_count(ends).astype(np.int64)
    so_far = np.cumsum(per_word)
    before = _ends_before(ends, so_far, per_word, offsets)
    n = before[1:] - before[:-1]
    a, b = h1 % (n + 1), h2 % (n + 1)
    low, high = np.minimum(a, b), np.maximum(a, b)
    starts = offsets[:-1]
    cut1, cut2 = (
        np.where(k > 0, _after_end(ends, so_far, per_word, before[:-1] + np.maximum(k, 1), n > 0), starts)
        for k in (low, high)
    )
    return n, low, high - low, cut1 - starts, cut2 - cut1


def unit_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words with bit 0 of every byte set that is the last of a code point."""
    padded = np.zeros(len(data) // 8 * 8 + 8, np.uint8)
    padded[: len(data)] = data
    words = padded.view("<u8")
    starts = ((~words >> np.uint64(7)) | (words >> np.uint64(6))) & ONES
    ends = starts >> np.uint64(8)
    ends[:-1] |= starts[1:] << np.uint64(56)
    # A text ends a unit whatever follows it; what lies beyond the last text ends none.
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    np.bitwise_or.at(ends, last >> 3, np.uint64(1) << (8 * (last & 7)).astype(np.uint64))
    ends[len(data) >> 3] &= (np.uint64(1) << np.uint64(8 * (len(data) & 7))) - np.uint64(1)
    return ends


def _ends_before(ends: np.ndarray, so_far: np.ndarray, per_word: np.ndarray, at: np.ndarray) -> np.ndarray:
    word = at >> 3
    below = (np.uint64(1) << (8 * (at & 7)).astype(np.uint64)) - np.uint64(1)
    return so_far[word] - per_word[word] + np.bitwise_count(ends[word] & below)


def _after_end(
    ends: np.ndarray, so_far: np.ndarray, per_word: np.ndarray, rank: np.ndarray, has_units: np.ndarray
) -> np.ndarray:
    """The place after the `rank`-th end, counted from 1; anything where a text has no units."""
    rank = np.where(has_units, rank, 1)
    word = np.minimum(np.searchsorted(so_far, rank), len(ends) - 1)
    left = np.clip(rank - (so_far[word] - per_word[word]), 1, 8).astype(np.uint64)
    counts = ends[word] * ONES
    reached = ((counts | HIGHS) - left * ONES) & HIGHS
    return word * 8 + 9 - np.bitwise_count(reached)
