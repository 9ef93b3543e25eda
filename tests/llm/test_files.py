"""Token files, the pipeline and the registered queries."""

import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from glossmill.llm import decontaminate, quality, simhash, tokens
from glossmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def brute_tokens(tokenizer, rows):
    """doc_id, start, n_tokens, crc32 of rows in their order."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


TEXTS = [
    "",
    None,
    'quote " and \'s don\'t <|endoftext|> x',
    "tabs\tand\r\nlines\n\n  blanks    wide",
    "étude ΟΔΟΣ İstanbul ﬁ 数字 123 \U0001d11e",
    "w" * 5000,
    "one two " * 3000,
    "퟿ \x85 \x1f a\x00b",
]


def test_files_give_back_the_ids(spark, tokenizer, tmp_path):
    rows = list(enumerate(TEXTS)) + [(100 + i, f"row {i} text") for i in range(300)]
    docs = spark.createDataFrame([(*r, "x") for r in reversed(rows)], "doc_id long, text string, start string")
    manifest = tokens.write_tokens(docs, FILE, f"file://{tmp_path}/tokens", length=64)
    got = tokens.read_documents(manifest).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == brute_tokens(tokenizer, rows)
    assert not list(Path(tmp_path).rglob("*.tmp"))


def test_sequences_are_equal_and_mapped(spark, tokenizer, tmp_path):
    rows = [(i, f"the document number {i} has words" * (1 + i % 9)) for i in range(200)]
    manifest = tokens.write_tokens(
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), FILE, f"file://{tmp_path}/t", length=32
    )
    ids = []
    for part in sorted(manifest.collect(), key=lambda r: r.part):
        table = tokens.open_sequences(part.file)
        sizes = [len(c) for c in table.column("ids").chunks]
        assert set(sizes[:-1]) <= {tokens.BATCH_SEQUENCES}
        found = [tokens.sequence(table, i) for i in range(table.num_rows)]
        assert all(len(x) == len(m) == 32 for x, m in found)
        joined, mask = np.concatenate([x for x, _ in found]), np.concatenate([m for _, m in found])
        assert mask[: part.n_ids].all() and not mask[part.n_ids :].any()
        ids.append(joined[: part.n_ids])
    want = [i for _, t in rows for i in [*tokenizer.encode(t, add_special_tokens=False).ids, 1]]
    assert np.concatenate(ids).tolist() == want


def test_other_vocabularies_and_whole_texts(spark, tmp_path):
    file = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(1, "  two  blanks\n\nand lines "), (2, "x"), (None, "first")]
    manifest = tokens.write_tokens(
        spark.createDataFrame(rows, "doc_id long, text string"), file, f"file://{tmp_path}/t", word_wise=False
    )
    got = {tuple(r) for r in tokens.read_documents(manifest).select("doc_id", "start", "n_tokens", "ids_crc32").collect()}
    assert got == set(brute_tokens(Tokenizer.from_file(file), [rows[2], *rows[:2]]))


def test_no_documents_no_files(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    manifest = tokens.write_tokens(empty, FILE, f"file://{tmp_path}/t")
    assert tokens.read_documents(manifest).count() == 0


def test_wide_vocabularies_use_wider_ids():
    sink = pa.BufferOutputStream()
    writer = tokens.Writer(sink, np.dtype("<u4"), 4, 2)
    for ids in (range(3), range(70_000, 70_014), range(2)):
        writer.add(np.array(ids, "<u4"))
    writer.close()
    table = pa.ipc.open_stream(sink.getvalue()).read_all()
    flat = np.concatenate([c.flatten().to_numpy() for c in table.column("ids").chunks])
    assert flat.tolist()[:19] == [0, 1, 2, *range(70_000, 70_014), 0, 1]


# --- pipeline ----------------------------------------------------------------


def brute_pipeline(spark, tokenizer):
    """Ids that stay, and the ids' digests, from whole tables held in memory."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rules = quality.learn_rules(table, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in quality.judge(table.select("doc_id", "text"), rules).filter("kept").collect()}
    fps = {d: simhash.simhash(docs[d]) for d in sorted(good)}
    group = {d: d for d in fps}
    for _ in range(20):
        for a in fps:
            for b in fps:
                if (fps[a] ^ fps[b]).bit_count() <= 2:
                    group[a] = group[b] = min(group[a], group[b])
    kept = {d for d, g in group.items() if d == g}
    items = [decontaminate.normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {d for d in kept if not any(i in decontaminate.normalise(docs[d]) for i in items)}
    return {d: brute_tokens(tokenizer, [(d, docs[d])])[0][2:] for d in clean}, docs


def test_pipeline_matches_brute_force(spark, tokenizer):
    want, _ = brute_pipeline(spark, tokenizer)
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_crc32) for r in got} == want
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens


def test_token_files_follow_the_mixture(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    from glossmill.llm.common import saved

    mixed = corpus_pipeline.mix_sources(spark, docs, SF)
    order = [r.doc_id for r in mixed.collect()]
    out = corpus_pipeline.token_output(spark, saved(mixed, "mixed"), SF).collect()
    assert [r.doc_id for r in sorted(out, key=lambda r: r.start)] == order
    assert order != sorted(order)


def test_stages_survive_hard_rows(spark):
    from glossmill.llm.common import saved

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.selectExpr("null as doc_id", "text", "cast(null as string) as lang", "source", "n_chars").limit(3)
    nulls = docs.selectExpr("doc_id + 5000 as doc_id", "cast(null as string) as text", "lang", "cast(null as string) as source", "n_chars").limit(2)
    long = docs.selectExpr("9000L as doc_id", "repeat(concat(text, ' '), 400) as text", "lang", "source", "n_chars").limit(1)
    hard = docs.union(extra).union(nulls).union(long).union(docs.limit(5)).selectExpr(
        "*", "1 as n_words", "2 as fp", "'x' as slot", "3 as kept", "4 as row"
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, saved(hard, "hard"), SF)
        assert out.columns == hard.columns, name
        assert out.count() > 0
        assert stage(spark, saved(hard.limit(0), "empty"), SF).count() == 0, name
    assert corpus_pipeline.token_output(spark, saved(hard, "hard"), SF).count() == hard.count()
    assert corpus_pipeline.token_output(spark, saved(hard.limit(0), "empty"), SF).count() == 0


# --- queries -----------------------------------------------------------------

COLUMNS = {
    "op2": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op4": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op5": ["doc_id", "fingerprint", "component_id"],
    "op6": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op7": ["page_id", "url", "text", "n_chars"],
    "op10": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
}


def test_ten_operators_are_registered():
    numbers = Counter(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == Counter(range(1, 11))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_runs(spark, name):
    result = QUERIES[name](spark, SF)
    wanted = COLUMNS.get(name.split("_")[0], [])
    assert result.columns[: len(wanted)] == wanted
    n_docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = result.collect()
    assert len(rows) > 0
    if name.split("_")[0] in ("op2", "op3", "op4", "op5", "op6", "op8", "op10"):
        assert len(rows) == n_docs
    if name.startswith("op5"):
        assert all(re.fullmatch("[0-9a-f]{16}", r.fingerprint) for r in rows)
