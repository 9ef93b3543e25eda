"""Exact substring dedup over a distributed, sparse suffix array.

All suffixes of a corpus would be 200 times the corpus. But two equal strings of
SPAN bytes have equal minimal grams at equal places, so it is enough to keep, of
each text, the anchors: positions whose GRAM-byte gram is the leftmost minimum (by
a hash) of some SPAN-byte window, about one per 85 bytes. The windows with one
anchor are a segment, a run of suffixes that share their leading tokens, the gram.

1. Anchors are counted by gram; only segments whose gram occurs again go on.
2. Equal segments are counted, and one of each fetches its bytes.
3. These are range-partitioned by their leading tokens, between splitters that Spark
   samples. In a bucket the suffixes of all segments are ordered by several keys in
   turn, the gram, the place of the gram, a 64-bit digest of the SPAN bytes, and a
   suffix is repeated if its neighbour is equal or its segment occurs twice.
4. A gram with more different segments than a task should hold is met the other way:
   its suffixes are counted by digest over all tasks, combined map-side. All suffixes
   of a gram are thus compared with each other, also where buckets meet.
5. Marked suffixes go back to every segment, and the bytes they cover are removed.

Digests are only compared under equal grams at equal places; equal digests are taken
for equal strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from glossmill.llm.common import map_rows, saved

SPAN = 200
GRAM = 32
CHUNK = 1 << 20
#: A gram with more distinct segments than this is spread over tasks.
MAX_SEGMENTS = 50_000
#: Segments whose suffixes a task orders at once, at gram borders.
SORTED_AT_ONCE = 4_000

SEGMENT = "d long, t int, at long, k long, c long"


def _random_words(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)


BYTE_VALUE = _random_words(256, 1)
STEP = _random_words(8, 2)
ROUND = np.uint64(0x9E3779B97F4A7C15)


def grams(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes from every position, by doubling."""
    h, size = BYTE_VALUE[data], 1
    for step in STEP[: GRAM.bit_length() - 1]:
        h = h[:-size] * step + h[size:]
        h ^= h >> np.uint64(31)
        size *= 2
    return h * ROUND


def sliding_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum (by the high 32 bits) of each window."""
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[: len(low) - (width - size)], low[width - size :])
    return (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


def segments(data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first window, windows, place of the gram in the first window, gram) of all segments."""
    for base in range(0, max(0, len(data) - SPAN + 1), CHUNK):
        part = np.frombuffer(data, np.uint8)[base : base + CHUNK + SPAN - 1]
        h = grams(part)
        anchor = sliding_argmin(h, SPAN - GRAM + 1)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        n = np.diff(np.r_[first, len(anchor)])
        yield first + base, n, anchor[first] - first, h[anchor[first]]


def _pack(first, n, place):
    return first << 16 | n << 8 | place


def _unpack(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return at >> 16, at >> 8 & 255, at & 255


def _keyed(docs: DataFrame) -> DataFrame:
    """Two keys that name a row for joins, and its text; equal rows share them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("d"),
        F.hash(text, F.col("doc_id").isNull()).alias("t"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
    )


def anchored(rows: DataFrame) -> DataFrame:
    """All segments of `d, t, text`: where (`at`), the hash of the gram `k`, of all bytes `c`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            size = 0
            for d, t, text in zip(*(c.to_pylist() for c in batch.columns[:2]), batch.column(2)):
                data = text.as_py().encode()
                view = memoryview(data)
                for first, n, place, gram in segments(data):
                    ends = first + n - 1 + SPAN
                    digest = xxhash.xxh3_64_intdigest
                    c = [digest(view[a:b], p) for a, b, p in zip(first.tolist(), ends.tolist(), place.tolist())]
                    new = (np.full(len(n), d), np.full(len(n), t), _pack(first, n, place), gram.view(np.int64), np.array(c, np.uint64).view(np.int64))
                    for column, values in zip(out, new):
                        column.append(values)
                    size += len(n)
                if size > 100_000:
                    yield _batch(out)
                    out, size = [[], [], [], [], []], 0
            if size:
                yield _batch(out)

    return rows.select("d", "t", "text").mapInArrow(run, SEGMENT)


def _batch(out: list[list[np.ndarray]]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    arrays = [pa.array(np.concatenate(c).astype(t.to_pandas_dtype())) for c, t in zip(out, types)]
    return pa.RecordBatch.from_arrays(arrays, ["d", "t", "at", "k", "c"])


def _packed_texts(rows: DataFrame) -> DataFrame:
    """Texts compressed for the shuffles that bring them to their segments."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=1).compress
        z = pa.array([pack(t.as_py().encode()) for t in batch.column("text")], pa.binary())
        return pa.RecordBatch.from_arrays([*batch.columns[:3], z], ["d", "t", "doc_id", "z"])

    return map_rows(rows.select("d", "t", "doc_id", "text"), run, "d long, t int, doc_id long, z binary")


def _with_bytes(chosen: DataFrame, rows: DataFrame) -> DataFrame:
    """`d, t, at, k, c, m` -> `lead, k, c, m, n, place, bytes`, from the texts of `rows`."""
    lists = chosen.groupBy("d", "t").agg(F.collect_list(F.struct("at", "k", "c", "m")).alias("wanted"))
    # Equal rows share d and t; one of them is enough.
    joined = _packed_texts(rows).join(lists, ["d", "t"]).select("z", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for z, wanted in zip(batch.column(0), batch.column(1)):
                data = zstandard.ZstdDecompressor().decompress(z.as_py())
                at, k, c, m = (wanted.values.field(i).to_numpy() for i in range(4))
                first, n, place = _unpack(at)
                parts = [data[a:b] for a, b in zip(first.tolist(), (first + n - 1 + SPAN).tolist())]
                lead = [x[p : p + GRAM] for x, p in zip(parts, place.tolist())]
                for i in range(0, len(parts), 50_000):
                    j = slice(i, i + 50_000)
                    yield pa.record_batch(
                        {
                            "lead": pa.array(lead[j], pa.binary()),
                            "k": k[j],
                            "c": c[j],
                            "m": m[j],
                            "n": n[j].astype(np.int32),
                            "place": place[j].astype(np.int32),
                            "bytes": pa.array(parts[j], pa.binary()),
                        }
                    )

    return joined.mapInArrow(run, "lead binary, k long, c long, m long, n int, place int, bytes binary")


def suffix_digests(parts: list[bytes], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For segments of n windows: (segment, digest of its SPAN bytes) of every window, in order."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    inverse = np.uint64(pow(int(ROUND), -1, 1 << 64))
    powers, ups = _powers(inverse, len(data) + 1), _powers(ROUND, len(data) + 1)
    total = np.r_[np.uint64(0), np.cumsum(BYTE_VALUE[data] * powers[:-1], dtype=np.uint64)]
    starts = np.cumsum([0, *map(len, parts[:-1])])
    owner = np.repeat(np.arange(len(parts)), n)
    at = starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    return owner, (total[at + SPAN] - total[at]) * ups[at]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def repeated_windows(batch: dict[str, np.ndarray], parts: list[bytes]) -> np.ndarray:
    """(segment, first, last) of the maximal runs of repeated windows of whole groups."""
    n, place = batch["n"].astype(np.int64), batch["place"].astype(np.int64)
    owner, digest = suffix_digests(parts, n)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    # The keys in turn: leading tokens, where they stand in the suffix, the rest.
    order = np.lexsort((digest, place[owner] - within, batch["k"][owner]))
    keys = [batch["k"][owner][order], (place[owner] - within)[order], digest[order]]
    equal = np.logical_and.reduce([x[1:] == x[:-1] for x in keys])
    marked = batch["m"][owner] > 1
    marked[order[1:][equal]] = True
    marked[order[:-1][equal]] = True
    return _runs(owner, within, marked)


def _runs(owner: np.ndarray, within: np.ndarray, marked: np.ndarray) -> np.ndarray:
    owner, within = owner[marked], within[marked]
    if not len(owner):
        return np.empty((0, 3), np.int64)
    new = np.r_[True, (owner[1:] != owner[:-1]) | (within[1:] != within[:-1] + 1)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(owner)] - 1
    return np.stack([owner[first], within[first], within[last]], axis=1)


MARK = "k long, c long, first int, last int"


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by lead and k: order the suffixes of whole groups, many groups at once."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        while held.num_rows > SORTED_AT_ONCE:
            k = held.column("k").to_numpy()
            border = np.flatnonzero(k[1:] != k[:-1]) + 1
            if not len(border):
                break
            after = border[border >= SORTED_AT_ONCE]
            cut = int(after[0] if len(after) else border[-1])
            yield from _marks(held.slice(0, cut))
            held = held.slice(cut)
            if not len(after):
                break
    if held is not None and held.num_rows:
        yield from _marks(held)


def _marks(table: pa.Table) -> Iterator[pa.RecordBatch]:
    batch = {x: table.column(x).to_numpy() for x in ("k", "c", "m", "n", "place")}
    runs = repeated_windows(batch, table.column("bytes").to_pylist())
    yield pa.record_batch(
        {
            "k": batch["k"][runs[:, 0]],
            "c": batch["c"][runs[:, 0]],
            "first": runs[:, 1].astype(np.int32),
            "last": runs[:, 2].astype(np.int32),
        }
    )


def _count_suffixes(fetched: DataFrame) -> DataFrame:
    """The marks of grams with very many segments: suffixes counted across tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SORTED_AT_ONCE):
                part = batch.slice(at, SORTED_AT_ONCE)
                k, c, m, n, place = (part.column(x).to_numpy() for x in ("k", "c", "m", "n", "place"))
                owner, digest = suffix_digests(part.column("bytes").to_pylist(), n.astype(np.int64))
                within = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                yield pa.record_batch(
                    {
                        "k": k[owner],
                        "c": c[owner],
                        "m": m[owner],
                        "first": within.astype(np.int32),
                        "o": (place[owner] - within).astype(np.int32),
                        "digest": digest.view(np.int64),
                    }
                )

    windows = fetched.mapInArrow(run, "k long, c long, m long, first int, o int, digest long")
    again = windows.groupBy("k", "o", "digest").agg(F.sum("m").alias("total")).filter("total > 1")
    return windows.join(again, ["k", "o", "digest"], "left_semi").select(
        "k", "c", "first", F.col("first").alias("last")
    )


def repeated_spans(rows: DataFrame, max_segments: int = MAX_SEGMENTS) -> DataFrame:
    """`d, t, spans` (byte ranges, ends excluded) of rows with strings that occur elsewhere."""
    found = anchored(rows)
    again = found.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1").select("k")
    # From a table, so that the join deals both sides itself and can split a frequent gram.
    kept = saved(found.join(saved(again, "repeated-grams"), "k"), "suffixes")
    # One of each kind of segment; m of them exist.
    kinds = kept.groupBy("k", "c").agg(F.count("*").alias("m"), F.min(F.struct("d", "t", "at")).alias("one"))
    chosen = kinds.select("one.*", "k", "c", "m")
    large = kinds.groupBy("k").count().filter(F.col("count") > max_segments).select("k")
    large = saved(large, "large-grams")
    fetched = _with_bytes(chosen, rows)
    n_large = large.count()
    if n_large:
        fetched = saved(fetched, "segments")
        usual = fetched.join(large, "k", "left_anti")
    else:
        usual = fetched
    sorted_ = usual.repartitionByRange("lead", "k").sortWithinPartitions("lead", "k")
    marks = sorted_.select("k", "c", "m", "n", "place", "bytes").mapInArrow(_sort_buckets, MARK)
    if n_large:
        marks = marks.union(_count_suffixes(fetched.join(large, "k", "left_semi")))
    first = F.shiftright("at", 16)
    return (
        kept.join(marks, ["k", "c"])
        .select(
            "d",
            "t",
            F.struct((first + F.col("first")).alias("a"), (first + F.col("last") + SPAN).alias("b")).alias("span"),
        )
        .groupBy("d", "t")
        .agg(F.collect_set("span").alias("spans"))
    )


def merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """Sorted maximal runs of (start, end) ranges."""
    out: list[tuple[int, int]] = []
    for a, b in spans[np.lexsort((spans[:, 1], spans[:, 0]))].tolist():
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<a:long,b:long>>"


def remove_repeats(docs: DataFrame, max_segments: int = MAX_SEGMENTS) -> DataFrame:
    """Per row of `docs(doc_id, text)`: what is removed, and a digest of the bytes that stay.

    Every byte covered by a SPAN-byte string that also starts anywhere else, in the
    same text or another, is removed; texts are judged as they came. Null texts are
    empty, rows that repeat count as copies of each other, null ids stay null, other
    columns are ignored.
    """
    rows = _keyed(docs)
    spans = repeated_spans(rows, max_segments)
    joined = _packed_texts(rows).join(spans, ["d", "t"], "left").select("doc_id", "z", "spans")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for doc_id, z, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            data = zstandard.ZstdDecompressor().decompress(z.as_py())
            runs = []
            if found.is_valid:
                runs = merged(np.stack([found.values.field(i).to_numpy() for i in range(2)], axis=1))
            digest, at = hashlib.sha256(), 0
            for a, b in runs:
                digest.update(data[at:a])
                at = b
            digest.update(data[at:])
            out.append(
                {
                    "doc_id": doc_id,
                    "n_bytes": len(data),
                    "n_removed": sum(b - a for a, b in runs),
                    "n_spans": len(runs),
                    "kept_sha256": digest.hexdigest(),
                    "removed": [{"a": a, "b": b} for a, b in runs],
                }
            )
        return pa.RecordBatch.from_pylist(out, schema=OUT)

    return map_rows(joined, run, REMOVED)


OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
        ("removed", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
    ]
)
