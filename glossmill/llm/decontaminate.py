"""Benchmark decontamination by the q-gram lemma.

Texts are lower-cased and white space runs become one space. Every benchmark item
is cut into overlapping patterns. A pattern of m characters that occurs with at
most e edits keeps at least T = m + 1 - q - q * e of its q-grams, on diagonals
(text position - pattern position) at most e apart. Diagonals are dealt into bands
of 2 * (e + 1) that overlap by half, so one band sees all of them; a band with T
shared q-grams is retained, and a banded alignment decides.

The benchmark is the query set and is met in blocks of bounded bytes, each sent to
the tasks as one index, so documents are neither shuffled nor joined. Each block
is one pass over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from glossmill.llm.common import map_rows

RESULT = "doc_id long, item_id long, start long, end long, edits int, n_patterns int"
#: Bands that are aligned at once, and a code that no text has.
ALIGNED = 1 << 15
NOTHING = np.uint32(0xFFFFFFFF)


@dataclass(frozen=True)
class Settings:
    """A verbatim passage of an item is certain to be found from `pattern_chars + step_chars - 1`
    characters on (after normalising), and a whole item at any length: items shorter than
    `min_chars` are found exactly, between word borders. Those are reported; they drop documents
    only with `short_items_drop`, as a word that is an item by itself may stand in most texts.

    `block_bytes` bounds the text of one index: items are dealt into as many blocks as their bytes
    need. By default an index takes less than 100 MB (see `index_bytes`). `chunk_chars` bounds the text
    that is looked up at once, and with it the memory of a search.
    """

    q: int = 12
    pattern_chars: int = 50
    step_chars: int = 10
    edit_rate: float = 0.05
    min_chars: int = 24
    block_bytes: int = 400 << 10
    chunk_chars: int = 1 << 14
    short_items_drop: bool = False


def index_bytes(text_bytes: int, settings: Settings) -> int:
    """What an index of so much text takes at most: per gram its hash, place, owner and offset and up to 16 marks, and the patterns."""
    n_grams = settings.pattern_chars + 1 - settings.q
    per_pattern = n_grams * (8 + 8 + 4 + 2 + 16) + 4 * settings.pattern_chars + 400
    return text_bytes * per_pattern // settings.step_chars


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def q_grams(text: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q code points from every position, q - 1 fewer than positions."""
    n = len(text) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(q):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += text[i : i + n]
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


class Index:
    """Patterns and q-grams of one block of benchmark items. Equal patterns are searched once."""

    def __init__(self, items: list[tuple[int | None, str | None]], settings: Settings):
        self.settings = settings
        self.patterns: list[tuple[int, str]] = []  # (item number, text)
        self.ids: list[int | None] = []
        short = []
        for item_id, raw in items:
            text = normalise(raw)
            if len(text) < settings.min_chars:
                short += [(item_id, text)] if text else []
                continue
            m, step = settings.pattern_chars, settings.step_chars
            starts = [0] if len(text) <= m else [*range(0, len(text) - m, step), len(text) - m]
            self.patterns += [(len(self.ids), p) for p in dict.fromkeys(text[at : at + m] for at in starts)]
            self.ids.append(item_id)
        self.n_long = len(self.patterns)
        self.same: dict[str, list[int]] = {}
        for p, (_, pattern) in enumerate(self.patterns):
            self.same.setdefault(pattern, []).append(p)
        self.texts = list(self.same)
        self.short = ahocorasick.Automaton()
        for item_id, text in short:
            self.short.add_word(text, [*self.short.get(text, []), len(self.patterns)])
            self.patterns.append((len(self.ids), text))
            self.ids.append(item_id)
        self.short.make_automaton()
        self.empty = not self.patterns
        # Short patterns get the largest budget for which the lemma still asks for a q-gram.
        q = settings.q
        budget = lambda n: np.minimum((n * settings.edit_rate).astype(int), np.maximum(n - q, 0) // q)
        self.budget = budget(np.array([len(p) for _, p in self.patterns], int))
        if not self.n_long:
            return
        self.lengths = np.array([len(t) for t in self.texts])
        self.edits = budget(self.lengths)
        self.needed = self.lengths + 1 - q - q * self.edits
        grams = [q_grams(code_points(t), q) for t in self.texts]
        owners = np.repeat(np.arange(len(grams), dtype=np.int32), [len(g) for g in grams])
        offsets = np.concatenate([np.arange(len(g), dtype=np.int16) for g in grams])
        grams = np.concatenate(grams)
        order = np.argsort(grams, kind="stable")
        self.owners, self.offsets = owners[order], offsets[order]
        self.grams, self.first = np.unique(grams[order], return_index=True)
        self.first = np.append(self.first, len(order))
        bits = max(16, int(np.ceil(np.log2(len(self.grams)))) + 3)
        self.shift = np.uint64(64 - min(bits, 28))
        self.seen = np.zeros(1 << (64 - int(self.shift)), bool)
        self.seen[self.grams >> self.shift] = True

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(pattern, start, end, edits) of the first verified match of every pattern in a normalised text.

        Texts are met in pieces that overlap by more than a pattern with its edits; a
        match belongs to the piece where it starts. A pattern that was found is not
        searched any further.
        """
        if not self.n_long:
            return
        size, overlap = self.settings.chunk_chars, 2 * self.settings.pattern_chars + 2
        codes, places = shortened(code_points(text), 2 * self.settings.pattern_chars)
        n, alive = len(codes), np.ones(len(self.texts), bool)
        for at in range(0, max(1, n - overlap), size):
            last = at + size + overlap >= n
            for u, start, end, edits in self._find(codes[at : at + size + overlap], size if not last else n, alive):
                alive[u] = False
                for p in self.same[self.texts[u]]:
                    yield p, int(places[at + start]), int(places[at + end - 1]) + 1, edits
            if not alive.any():
                return

    def find_short(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """The same for the items that are too short for patterns: whole, between word borders."""
        if not len(self.short):
            return
        seen = set()
        for last, numbers in self.short.iter(text):
            if numbers[0] in seen:
                continue
            start, end = last + 1 - len(self.patterns[numbers[0]][1]), last + 1
            if not _in_word(text[start - 1 : start]) and not _in_word(text[end : end + 1]):
                seen.add(numbers[0])
                for p in numbers:
                    yield p, start, end, 0

    def _find(self, text: np.ndarray, size: int, alive: np.ndarray) -> list[tuple[int, int, int, int]]:
        """First matches that start before `size` of the patterns that are alive, by number in `texts`."""
        hashes = q_grams(text, self.settings.q)
        position = np.flatnonzero(self.seen[hashes >> self.shift])
        gram = np.minimum(np.searchsorted(self.grams, hashes[position]), len(self.grams) - 1)
        known = self.grams[gram] == hashes[position]
        if not alive.all():
            known &= np.logical_or.reduceat(alive[self.owners], self.first[:-1])[gram]
        position, gram = position[known], gram[known]
        if not len(position):
            return []
        # One row per (text position, pattern, offset) that share a q-gram.
        count = self.first[gram + 1] - self.first[gram]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        slot = np.repeat(self.first[gram], count) + within
        again = np.r_[False, hashes[1:] == hashes[:-1]][position]
        owner, offset, again = self.owners[slot].astype(np.int64), self.offsets[slot], np.repeat(again, count)
        diagonal, width = np.repeat(position, count) - offset, self.edits[owner] + 1
        band = np.floor_divide(diagonal, width)
        # In a run of one character the gram before says the same for the same band.
        fresh = alive[owner] & ~(again & (np.floor_divide(diagonal - 1, width) == band))
        owner, offset, band = owner[fresh], offset[fresh], band[fresh] + self.settings.pattern_chars + 1
        # Shared grams of a band are counted once per place in the pattern.
        m, n_bands = self.settings.pattern_chars, len(text) + 2 * self.settings.pattern_chars + 4
        key = (owner * n_bands + band) * m + offset
        bands, counts = np.unique(np.unique(np.r_[key, key - m]) // m, return_counts=True)
        owner, band = bands // n_bands, bands % n_bands - self.settings.pattern_chars - 1
        kept = counts >= self.needed[owner]
        owner, band = owner[kept], band[kept]
        out: dict[int, tuple[int, int, int, int]] = {}
        # Patterns of one length and budget are aligned together.
        for length, budget in np.unique(np.stack([self.lengths[owner], self.edits[owner]], 1), axis=0) if len(owner) else ():
            these = np.flatnonzero((self.lengths[owner] == length) & (self.edits[owner] == budget))
            for part in np.array_split(these, -(-len(these) // ALIGNED)):
                distinct, which = np.unique(owner[part], return_inverse=True)
                patterns = np.stack([code_points(self.texts[u]) for u in distinct])[which]
                start, end, edits = align(patterns, text, band[part] * (budget + 1), 2 * int(budget + 1))
                good = (edits <= budget) & (start < size)
                for u, s, e, n in zip(owner[part][good], start[good], end[good], edits[good]):
                    best = out.get(u)
                    # Neighbouring bands tell the same place; the fewest edits name it best.
                    if best is None or s < best[1] - 2 * budget - 2 or (s <= best[1] + 2 * budget + 2 and (n, s) < (best[3], best[1])):
                        out[u] = (int(u), int(s), int(e), int(n))
        return sorted(out.values())


def _in_word(char: str) -> bool:
    return char.isalnum() or char == "_"


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def shortened(codes: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """`codes` with the middle of long periodic runs left out, and the place of every code that stays.

    A run repeats one to four characters. `half` characters stay on either side of what is left out, whole
    periods, so every window of up to `half` characters is still there, at the place where it is first.
    """
    places = np.arange(len(codes))
    for period in range(1, 5):
        same = np.r_[False, codes[period:] == codes[:-period], False] if len(codes) > period else np.zeros(2, bool)
        change = np.flatnonzero(same[1:] != same[:-1])
        first, last = change[::2], change[1::2] + period  # a run is codes[first:last]
        cut = np.maximum(last - first - 2 * half, 0) // period * period
        if cut.any():
            gone = np.zeros(len(codes) + 1, np.int64)
            np.add.at(gone, first[cut > 0] + half, 1)
            np.add.at(gone, (first + half + cut)[cut > 0], -1)
            kept = np.cumsum(gone[:-1]) == 0
            codes, places = codes[kept], places[kept]
    return codes, places


def align(patterns: np.ndarray, text: np.ndarray, low: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best occurrence of each row of `patterns` on the diagonals low .. low + width - 1.

    Returns starts, ends and edits in `text`; all rows are aligned at once, cell by cell
    of the band. Places before and behind the text match nothing.
    """
    n, m = patterns.shape
    edge = m + width + 1
    padded = np.concatenate([np.full(edge, NOTHING), text, np.full(edge, NOTHING)])
    at = np.clip(low + edge, 0, len(padded) - m - width)
    # A cell holds edits * width + the diagonal where the occurrence starts.
    cells = [np.full(n, k, np.int32) for k in range(width)]
    for i in range(m):
        new: list[np.ndarray] = []
        for k in range(width):
            best = cells[k] + width * (padded[at + i + k] != patterns[:, i])
            if k + 1 < width:
                best = np.minimum(best, cells[k + 1] + width)  # a character of the pattern is missing
            if k:
                best = np.minimum(best, new[k - 1] + width)  # the text has one more
            new.append(best.astype(np.int32))
        cells = new
    table = np.stack(cells, 1)
    k = np.argmin(table, 1)
    best, low = table[np.arange(n), k], at - edge
    return np.clip(low + best % width, 0, len(text)), np.clip(low + m + k, 0, len(text)), best // width


def blocks(benchmark: DataFrame, settings: Settings) -> Iterator[Index]:
    """Indexes of the items, each of about `block_bytes` of text at most.

    The number of blocks follows the bytes of the benchmark, so what is collected
    at once and sent to the tasks stays bounded however long the benchmark is.
    """
    items = benchmark.select(F.col("item_id").cast("long"), "text").filter("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // settings.block_bytes)
    for b in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        index = Index([tuple(r) for r in part.orderBy("item_id", "text").collect()], settings)
        if not index.empty:
            yield index


def leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document and benchmark item it holds a pattern of.

    Each pattern counts where it is found first: `start, end` reach from the first to the last
    character of these places in the normalised text, `edits` are those of the best of them,
    `n_patterns` of the item, different ones, were found.
    Null and empty texts on either side match nothing, repeated rows are reported
    once per row, a null doc_id or item_id stays null, other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    found = [_search(rows, index) for index in blocks(benchmark, settings)]
    out = docs.sparkSession.createDataFrame([], RESULT)
    for part in found:
        out = part if out.isLocal() else out.unionByName(part)
    return out


def _search(rows: DataFrame, index: Index) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        index = shared.value
        out = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            by_item: dict[int, list] = {}
            normal = normalise(text.as_py())
            for p, start, end, edits in chain(index.find(normal), index.find_short(normal)):
                by_item.setdefault(index.patterns[p][0], []).append((p, start, end, edits))
            for item, hits in sorted(by_item.items()):
                out.append(
                    {
                        "doc_id": doc_id,
                        "item_id": index.ids[item],
                        "start": min(h[1] for h in hits),
                        "end": max(h[2] for h in hits),
                        "edits": min(h[3] for h in hits),
                        "n_patterns": len({h[0] for h in hits}),
                    }
                )
        return pa.RecordBatch.from_pylist(out, schema=SCHEMA)

    return map_rows(rows, run, RESULT)


SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("edits", pa.int32()),
        ("n_patterns", pa.int32()),
    ]
)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of `docs`, all columns, that hold no pattern of the benchmark.

    Items shorter than `min_chars` drop nothing unless `short_items_drop` is set.
    Each block of the benchmark is one filter over batches: no join, no shuffle.
    """
    spark, at = docs.sparkSession, docs.columns.index("text")
    for index in blocks(benchmark, settings):
        shared = spark.sparkContext.broadcast(index)

        def run(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            clean = []
            for text in map(normalise, batch.column(at).to_pylist()):
                found = shared.value.find(text)
                if settings.short_items_drop:
                    found = chain(found, shared.value.find_short(text))
                clean.append(next(found, None) is None)
            return batch.filter(pa.array(clean, pa.bool_()))

        docs = map_rows(docs, run, docs.schema)
    return docs
