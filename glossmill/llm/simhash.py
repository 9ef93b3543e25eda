"""SimHash near-duplicates by anchor-point covering.

The anchors are the codewords of the Hamming code [63, 57] over the low 63 bits
of a fingerprint: a perfect covering code of radius 1. Two fingerprints that
differ in at most two bits have a point between them that differs from each in
at most one, and that point has an anchor within the covering radius. So each
fingerprint is copied to every anchor within the radius plus its half of the
threshold, 1 + 1 bits: itself if it is a codeword, else 1 anchor at distance 1
and 31 at distance 2. Bit 63 needs no anchor of its own, as a pair that differs
there differs in at most one other bit.

Fingerprints, not documents, are copied, so a group of equal texts of any size
is one point. An anchor has at most 4034 points around it (2 * (1 + 63 + 1953)),
whatever the size of the corpus, and its points leave it as a spanning forest of
their links, never as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from glossmill.llm.common import connected_components, map_rows, saved

SEED = 42
SHINGLE = 3
#: Links join fingerprints with at most this many differing bits; the covering holds for 2.
THRESHOLD = 2
LOW63 = np.uint64((1 << 63) - 1)
POINTS_PER_PASS = 1 << 15


def simhash(text: str | None) -> int:
    """Unsigned 64-bit fingerprint; null and wordless texts have fingerprint 0."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z, only \x20 and \x09-\x0D
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), POINTS_PER_PASS):
        part = hashes[i : i + POINTS_PER_PASS].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """`doc_id, fp` (the fingerprint as a signed long) of every row of `doc_id, text`."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([simhash(t.as_py()) for t in batch.column(1)], np.uint64).view(np.int64)
        return pa.record_batch({"doc_id": batch.column(0), "fp": pa.array(fps)})

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, fp long")


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (index of the fingerprint, anchor) within two bits, for uint64 fingerprints."""
    low = fps & LOW63
    bits = np.unpackbits(low.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :63]
    syndrome = np.zeros(len(fps), np.int64)
    for i in range(63):
        syndrome ^= np.where(bits[:, i], i + 1, 0)
    rows, found = [np.nonzero(syndrome == 0)[0]], [low[syndrome == 0]]
    other = np.nonzero(syndrome)[0]
    s, x = syndrome[other], low[other]
    flip = lambda k: np.uint64(1) << (k - 1).astype(np.uint64)
    rows.append(other)
    found.append(x ^ flip(s))
    for i in range(1, 64):
        j = i ^ s
        use = j > i  # each pair once; j is 0 where i alone is the nearest flip
        rows.append(other[use])
        found.append(x[use] ^ flip(np.full(use.sum(), i)) ^ flip(j[use]))
    return np.concatenate(rows), np.concatenate(found)


def forest(points: np.ndarray, threshold: int = THRESHOLD) -> list[tuple[int, int]]:
    """Spanning forest of the links among distinct uint64 points, as index pairs."""
    edges = []
    waiting = np.arange(len(points))
    while len(waiting) > 1:
        queue, waiting = [waiting[0]], waiting[1:]
        while queue and len(waiting):
            i = queue.pop()
            near = np.bitwise_count(points[waiting] ^ points[i]) <= threshold
            edges += [(i, j) for j in waiting[near]]
            queue += list(waiting[near])
            waiting = waiting[~near]
    return edges


def _replicate(batch: pa.RecordBatch) -> pa.RecordBatch:
    fps = batch.column(0).to_numpy(zero_copy_only=False)
    rows, found = anchors(fps.view(np.uint64))
    return pa.record_batch({"anchor": pa.array(found.view(np.int64)), "fp": pa.array(fps[rows])})


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted `anchor, fp` -> links of each anchor; an anchor may span batches."""
    held = (np.empty(0, np.int64), np.empty(0, np.int64))
    for batch in batches:
        a, f = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        a, f = np.concatenate([held[0], a]), np.concatenate([held[1], f])
        last = np.searchsorted(a, a[-1]) if len(a) else 0
        held = (a[last:], f[last:])
        yield from _links_of(a[:last], f[:last])
    yield from _links_of(*held)


def _links_of(a: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
    starts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.empty(0, int)
    ends = np.r_[starts[1:], len(a)] if len(a) else starts
    left, right = [], []
    for s, e in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
        points = f[s:e].view(np.uint64)
        if e - s == 2:
            pairs = [(0, 1)] if int(points[0] ^ points[1]).bit_count() <= THRESHOLD else []
        else:
            pairs = forest(points)
        left += [f[s + i] for i, _ in pairs]
        right += [f[s + j] for _, j in pairs]
    if left:
        yield pa.record_batch({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})


def links(distinct: DataFrame) -> DataFrame:
    """`fp` (distinct longs) -> `a, b`: links whose closure is that of all links."""
    copies = map_rows(distinct.select("fp"), _replicate, "anchor long, fp long")
    return (
        copies.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_links, "a long, b long")
    ).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """`doc_id, fp, component_id` of every row of `docs`.

    `component_id` is the smallest doc_id reachable over links of at most two
    differing bits. Rows with a null doc_id take part and stay; a component that
    has no other row has a null id. Rows may repeat, extra columns are ignored,
    an empty table gives an empty result.
    """
    fps = saved(fingerprints(docs), "simhash")
    points = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = connected_components(links(points), "simhash").toDF("fp", "component")
    member = points.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    ids = member.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_fp = member.join(ids, "component").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group: the one whose doc_id is the component's.

    Rows with a null doc_id are never dropped, and rows that repeat a doc_id share
    its fate, so a repeated row of a representative stays.
    """
    losers = near_duplicates(docs).filter("doc_id > component_id").select("doc_id").distinct()
    return docs.join(losers, "doc_id", "left_anti").select(*docs.columns)


def hex_fingerprint(fp: str = "fp") -> Column:
    """16 lowercase hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
