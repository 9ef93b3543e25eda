"""Token ids as Arrow stream files of fixed-size-list batches.

Each task writes the ids of its documents, one after the other with an end id, cut
into sequences of equal length: columns `ids` (fixed-size list of uint16, or uint32
for larger vocabularies) and `mask` (fixed-size list of bool, false on the padding
that ends a file). All batches but the last have the same number of sequences, so
a memory-mapped file gives any sequence without copying. A second stream next to
it lists the documents and their numbers of ids.

A file gets its final name by a rename when it is complete, and the manifest names
only files of tasks that succeeded, so a task that runs again leaves no trace.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from tokenizers import Tokenizer

from glossmill.llm.common import saved
from glossmill.session import shared_path

END_ID = 1
SEQUENCE = 2048
BATCH_SEQUENCES = 128
#: Bound of each of the two caches of a worker, of words and of pieces of words.
CACHED = 200_000
MANIFEST = "part int, file string, n_docs long, n_ids long"

#: How the lower-casing vocabulary normalises and cuts texts.
LOWER_CASING = ["NFC", "Replace", "Lowercase"]
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words of these characters alone need no normalising but lower case.
PLAIN = "".join(map(chr, [*range(0x21, 0x7F), *range(0xA1, 0x100)]))


class Encoder:
    """Encodes texts word by word, with the ids of words and of their pieces kept.

    Characters are never joined across a blank or a line feed, so the ids of the words
    between them are the ids of the text; `word_wise=False` encodes whole texts, for
    vocabularies of which that is not true. Words of plain characters are cut here as a
    lower-casing vocabulary says it cuts them, and their pieces go to its merges; all
    other words, and all words of other vocabularies, go through the whole library.
    """

    def __init__(self, definition: str, word_wise: bool = True):
        self.tokenizer = Tokenizer.from_str(definition)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.word_wise = word_wise
        self.words: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}
        self.cut = regex.compile(PIECES).findall if _cuts_as_expected(json.loads(definition)) else None
        special = {t.content[:1] for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.plain = re.compile(f"[{re.escape(''.join(c for c in PLAIN if c not in special))}]+").fullmatch
        self.as_bytes = str.maketrans({chr(i): _byte_letters(chr(i)) for i in range(256)})

    def encode(self, text: str) -> np.ndarray:
        if not self.word_wise:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)
        words = text.replace("\n", " ").split(" ")
        known, more = self.words, {}
        for word in set(words).difference(known):
            (known if len(known) < CACHED else more)[word] = self._word(word)
        if more:
            ids = [more[w] if x is None else x for w, x in zip(words, map(known.get, words))]
        else:
            ids = map(known.__getitem__, words)
        return np.frombuffer(b"".join(ids), self.dtype)

    def _word(self, word: str) -> bytes:
        if self.cut is None or not self.plain(word):
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            return np.array(ids, self.dtype).tobytes()
        out = []
        for piece in self.cut(word.lower()):
            ids = self.pieces.get(piece)
            if ids is None:
                found = self.tokenizer.model.tokenize(piece.translate(self.as_bytes))
                ids = struct.pack(f"<{len(found)}{self.code}", *[t.id for t in found])
                if len(self.pieces) < CACHED:
                    self.pieces[piece] = ids
            out.append(ids)
        return b"".join(out)


def _cuts_as_expected(definition: dict) -> bool:
    """Whether a vocabulary normalises and cuts texts as `Encoder._word` does."""
    normalizers = (definition.get("normalizer") or {}).get("normalizers", [])
    steps = (definition.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        [n["type"] for n in normalizers] == LOWER_CASING
        and normalizers[1]["pattern"] == {"Regex": r"\s+"}
        and normalizers[1]["content"] == " "
        and [s["type"] for s in steps] == ["Split", "ByteLevel"]
        and steps[0]["pattern"] == {"Regex": PIECES}
        and (steps[0]["behavior"], steps[0]["invert"]) == ("Removed", True)
        and (steps[1]["add_prefix_space"], steps[1]["use_regex"]) == (False, False)
        and definition["model"]["type"] == "BPE"
    )


@lru_cache(maxsize=1)
def _letters_of_bytes() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for letters from 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def _byte_letters(char: str) -> str:
    return "".join(_letters_of_bytes()[b] for b in char.encode())


@lru_cache(maxsize=2)
def _encoder(definition: str, word_wise: bool) -> Encoder:
    """One encoder per worker process, so that its caches serve all its tasks."""
    return Encoder(definition, word_wise)


class Writer:
    """Packs ids into sequences and writes them batch by batch."""

    def __init__(self, sink, dtype: np.dtype, length: int, batch: int):
        value = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
        self.length, self.batch, self.dtype = length, batch, dtype
        self.schema = pa.schema(
            [("ids", pa.list_(value, length)), ("mask", pa.list_(pa.bool_(), length))]
        )
        self.stream = pa.ipc.new_stream(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        full = self.length * self.batch
        if self.n_held >= full:
            ids = np.concatenate(self.held)
            for at in range(0, len(ids) - full + 1, full):
                self._write(ids[at : at + full], full)
            self.held = [ids[len(ids) - len(ids) % full :]]
            self.n_held = len(self.held[0])

    def close(self) -> None:
        if self.n_held:
            size = -(-self.n_held // self.length) * self.length
            self._write(np.concatenate(self.held), size)
        self.stream.close()

    def _write(self, ids: np.ndarray, size: int) -> None:
        padded = np.zeros(size, self.dtype)
        padded[: len(ids)] = ids
        mask = np.arange(size) < len(ids)
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (padded, mask)]
        self.stream.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))


def write_tokens(
    docs: DataFrame,
    tokenizer_file: str,
    dest: str,
    order: Sequence[str | Column] = ("doc_id",),
    length: int = SEQUENCE,
    word_wise: bool = True,
) -> DataFrame:
    """Write ids of `docs(doc_id, text)` under `dest`; returns the manifest, one row per file.

    Documents are sorted by range on `order`, so files in the order of `part` hold
    them all in that order. A null text is empty, a null doc_id sorts first, rows
    that tie stand in any order, other columns are ignored.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())  # a file of fixed size
    keys = [c if isinstance(c, Column) else F.col(c) for c in order]
    named = [k.alias(f"_key{i}") for i, k in enumerate(keys)]
    names = [f"_key{i}" for i in range(len(keys))]
    rows = docs.select(*named, F.col("doc_id").cast("long").alias("_id"), F.col("text").alias("_text"))
    rows = rows.repartitionByRange(*names).sortWithinPartitions(*names).select("_id", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value, word_wise)
        part = TaskContext.get().partitionId()
        store, folder = pafs.FileSystem.from_uri(dest)
        store.create_dir(folder, recursive=True)
        name = f"{folder}/part-{part:05d}-{uuid.uuid4().hex}"
        ids_of, docs_of, n_ids = [], [], 0
        end = np.array([END_ID], encoder.dtype)
        with store.open_output_stream(f"{name}.ids.tmp") as sink:
            writer = Writer(sink, encoder.dtype, length, BATCH_SEQUENCES)
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    ids = encoder.encode(text.as_py() or "")
                    writer.add(ids)
                    writer.add(end)
                    docs_of.append(doc_id)
                    ids_of.append(len(ids) + 1)
                    n_ids += len(ids) + 1
            writer.close()
        listed = pa.record_batch(
            {"doc_id": pa.array(docs_of, pa.int64()), "n_tokens": pa.array(ids_of, pa.int64())}
        )
        with store.open_output_stream(f"{name}.docs.tmp") as sink:
            with pa.ipc.new_stream(sink, listed.schema) as stream:
                stream.write_batch(listed)
        for kind in ("ids", "docs"):
            store.move(f"{name}.{kind}.tmp", f"{name}.{kind}.arrows")
        yield pa.record_batch(
            {
                "part": pa.array([part], pa.int32()),
                "file": [f"{dest}/{name.rpartition('/')[2]}"],
                "n_docs": pa.array([len(docs_of)], pa.int64()),
                "n_ids": pa.array([n_ids], pa.int64()),
            }
        )

    return saved(rows.mapInArrow(run, MANIFEST), "token-manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: `doc_id, start, n_tokens, ids_crc32, file, file_start`.

    `start` counts the ids of all documents before it, in the order of the files.
    """
    # One row per file, far fewer than documents.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    files = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _documents(row["file"], row["before"])

    # A number of partitions of their own: merged by size, these few small rows would be one task.
    return files.select("file", "before").repartition(max(manifest.count(), 1), "file").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long, file string, file_start long"
    )


def open_sequences(file: str) -> pa.Table:
    """The sequences of one file: memory-mapped without copies where the store is local."""
    store, path = pafs.FileSystem.from_uri(f"{file}.ids.arrows")
    local = isinstance(store, pafs.LocalFileSystem)
    source = pa.memory_map(path) if local else store.open_input_file(path)
    return pa.ipc.open_stream(source).read_all()


def sequence(table: pa.Table, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and mask of sequence i, as views of the file where it is mapped."""
    chunk, at = divmod(i, table.column("ids").chunk(0).__len__())
    ids, mask = (table.column(c).chunk(chunk)[at].values for c in ("ids", "mask"))
    return ids.to_numpy(zero_copy_only=True), mask.to_numpy(zero_copy_only=False)


def _documents(file: str, before: int) -> Iterator[pa.RecordBatch]:
    store, path = pafs.FileSystem.from_uri(f"{file}.docs.arrows")
    with store.open_input_file(path) as source:
        listed = pa.ipc.open_stream(source).read_all()
    chunks = open_sequences(file).column("ids").chunks
    counts = listed.column("n_tokens").to_numpy()
    ends = np.cumsum(counts)
    held, base, k = np.empty(0, "<u4"), 0, 0  # ids read and not yet used, their place, next chunk
    crcs = []
    for start, end in zip(ends - counts, ends):
        crc = 0
        while start < end:
            if start - base >= len(held):
                base += len(held)
                held = chunks[k].flatten().to_numpy(zero_copy_only=False).astype("<u4")
                k += 1
            take = held[start - base : end - base]
            crc = zlib.crc32(take.tobytes(), crc)
            start += len(take)
        crcs.append(crc)
    yield pa.record_batch(
        {
            "doc_id": listed.column("doc_id").combine_chunks(),
            "start": pa.array(before + ends - counts, pa.int64()),
            "n_tokens": pa.array(counts, pa.int64()),
            "ids_crc32": pa.array(crcs, pa.int64()),
            "file": pa.array([file] * len(counts), pa.string()),
            "file_start": pa.array(ends - counts, pa.int64()),
        }
    )


def token_folder(docs: DataFrame) -> str:
    """A new folder for token files in the shared folder, as a URI."""
    path = shared_path(docs.sparkSession, "tokens")
    return path if "://" in path else f"file://{path}"
