"""SimHash near-dedup, decontamination and suffix dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from glossmill.llm import decontaminate, simhash, substrings

WORDS = "the of and tion ing her that with ere for sch ung eau ción ñandú über straße alpha beta gamma".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(WORDS) for _ in range(n))


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


# --- SimHash -----------------------------------------------------------------


def brute_simhash(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_anchors_cover_all_pairs_within_two_bits():
    r = np.random.default_rng(0)
    for _ in range(300):
        x = int(r.integers(0, 1 << 63)) << 1 | int(r.integers(2))
        y = x
        for b in r.choice(64, r.integers(0, 3), replace=False):
            y ^= 1 << int(b)
        points = np.array([x, y], np.uint64)
        rows, found = simhash.anchors(points)
        assert set(found[rows == 0]) & set(found[rows == 1])
        assert np.bitwise_count(found ^ (points[rows] & simhash.LOW63)).max() <= 2


def test_components_match_brute_force(spark):
    base = prose(1, 300)
    texts = [prose(i, 40 + i) for i in range(30)] + [base] * 5 + [None, "", " \t", "one", "ONE", "two words"]
    for i in range(25):
        words = base.split()
        words[i * 11 % 300] = f"x{i % 3}"
        texts.append(" ".join(words))
    rows = list(enumerate(texts)) + [(None, base), (3, texts[3])]
    got = simhash.near_duplicates(frame(spark, [(*r, 7) for r in rows], "doc_id long, text string, fp long")).collect()
    fps = [brute_simhash(t) for _, t in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= 2:
                    group[i] = group[j] = min(group[i], group[j])
    first = {}
    for (doc_id, _), g in zip(rows, group):
        if doc_id is not None:
            first[g] = min(first.get(g, doc_id), doc_id)
    want = [(d, fp - (1 << 64) if fp >> 63 else fp, first[g]) for (d, _), fp, g in zip(rows, fps, group)]
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_forest_spans_large_buckets():
    points = np.array([0] + [1 << i for i in range(60)] + [3 << i for i in range(0, 58, 3)], np.uint64)
    edges = simhash.forest(points)
    assert len(edges) == len(points) - 1
    assert all(int(points[i] ^ points[j]).bit_count() <= 2 for i, j in edges)


def test_drop_near_duplicates_keeps_one_and_all_columns(spark):
    text = prose(2, 100)
    docs = frame(
        spark,
        [(5, text, 1), (2, text, 2), (9, prose(3, 90), 3), (None, text, 4)],
        "doc_id long, text string, component_id int",
    )
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.component_id) for r in kept.collect()} == {(2, 2), (9, 3), (None, 4)}


def test_simhash_of_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


# --- decontamination ---------------------------------------------------------


def spoiled(text, n, seed):
    r, out = random.Random(seed), list(text)
    for _ in range(n):
        i = r.randrange(5, len(out) - 5)
        kind = r.randrange(3)
        if kind == 0:
            out[i] = "q"
        elif kind == 1:
            del out[i]
        else:
            out.insert(i, "z")
    return "".join(out)


def edit_distance_in(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


@pytest.fixture(scope="module")
def leak_case():
    items = [(i, prose(100 + i, n)) for i, n in enumerate((4, 12, 30, 60))] + [(8, None), (9, ""), (10, "too short")]
    docs = [(0, prose(1, 200)), (1, None), (2, ""), (3, prose(5, 30) + " " + items[2][1].upper() + "\n" + prose(6, 30))]
    docs += [(4, spoiled(items[1][1], 2, 4)), (5, prose(7, 3000) + " " + items[3][1][50:260] + " " + prose(8, 50))]
    docs += [(6, prose(9, 20) + " " + spoiled(items[2][1], 9, 1)), (None, items[0][1]), (7, "x" * 5000), (7, "x" * 5000)]
    return docs, items


def test_leaks_match_alignment_of_every_pattern(spark, leak_case):
    docs, items = leak_case
    settings = decontaminate.Settings(chunk_chars=700)
    index = decontaminate.Index(items, settings)
    want = set()
    for doc_id, raw in docs:
        text = decontaminate.normalise(raw)
        for p, (item, pattern) in enumerate(index.patterns):
            if edit_distance_in(pattern, text) <= index.budget[p]:
                want.add((doc_id, index.ids[item]))
    for block_bytes in (8 << 20, 300):
        found = decontaminate.leaks(
            frame(spark, docs),
            frame(spark, items, "item_id long, text string"),
            decontaminate.Settings(chunk_chars=700, block_bytes=block_bytes),
        )
        assert {(r.doc_id, r.item_id) for r in found.collect()} == want
    assert {(3, 2), (4, 1), (5, 3), (None, 0)} <= want


def test_drop_leaks_keeps_clean_rows_and_columns(spark, leak_case):
    docs, items = leak_case
    wide = frame(spark, [(*d, "s") for d in docs], "doc_id long, text string, item_id string")
    kept = decontaminate.drop_leaks(wide, frame(spark, items, "item_id long, text string"))
    assert kept.columns == wide.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 7, 7]


def test_empty_tables_leak_nothing(spark, leak_case):
    docs, items = leak_case
    none = frame(spark, [], "item_id long, text string")
    assert decontaminate.leaks(frame(spark, docs), none).count() == 0
    assert decontaminate.drop_leaks(frame(spark, docs), none).count() == len(docs)
    assert decontaminate.leaks(frame(spark, []), frame(spark, items, "item_id long, text string")).count() == 0


def test_every_passage_of_the_stated_length_and_short_items_are_found(spark):
    settings = decontaminate.Settings()
    size = settings.pattern_chars + settings.step_chars - 1
    assert size <= 60
    item = decontaminate.normalise(prose(300, 60))
    index = decontaminate.Index([(1, item), (2, "Paris, France"), (3, "forty two")], settings)
    for at in range(len(item) - size + 1):
        text = prose(at, 20) + " #" + item[at : at + size] + "# " + prose(at + 1, 20)
        assert {index.patterns[p][0] for p, *_ in index.find(decontaminate.normalise(text))} == {0}, at
    docs = [(0, "It is PARIS,\nFrance."), (1, "forty twofold"), (2, "forty two"), (3, prose(9, 40))]
    items = frame(spark, [(2, "Paris, France"), (3, "forty two"), (4, " ")], "item_id long, text string")
    found = decontaminate.leaks(frame(spark, docs), items).collect()
    assert {(r.doc_id, r.item_id, r.start, r.end) for r in found} == {(0, 2, 6, 19), (2, 3, 0, 9)}
    assert decontaminate.drop_leaks(frame(spark, docs), items).count() == 4


# --- suffix dedup ------------------------------------------------------------


def brute_removal(texts):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for b in data:
        for s in range(len(b) - 199):
            seen[b[s : s + 200]] = seen.get(b[s : s + 200], 0) + 1
    out = []
    for b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - 199):
            if seen[b[s : s + 200]] > 1:
                gone[s : s + 200] = b"\1" * 200
        spans = sum(1 for x, y in zip(b"\0" + bytes(gone), gone) if y and not x)
        kept = bytes(x for x, y in zip(b, gone) if not y)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.fixture(scope="module")
def repeat_case():
    passage, other = prose(50, 40), prose(51, 60)
    texts = [prose(i, 60) for i in range(12)]
    texts += [prose(20, 30) + passage + prose(21, 30), passage[:210], passage[:199], other * 3, other + "!" + other[1:]]
    texts += ["a" * 900, "ab" * 400, "é" * 300, "", None, "short", texts[0], texts[0][:150] + "X" + texts[0][150:]]
    for i in range(15):  # near copies with an edit each
        at = 40 + 31 * i % len(other)
        texts.append(other[:at] + "#" + other[at + 1 :])
    return list(enumerate(texts)) + [(None, passage), (3, texts[3])]


@pytest.mark.parametrize("max_segments", [substrings.MAX_SEGMENTS, 2])
def test_removal_matches_brute_force(spark, repeat_case, max_segments):
    docs = frame(spark, [(*r, 1) for r in repeat_case], "doc_id long, text string, k long")
    got = substrings.remove_repeats(docs, max_segments).drop("removed").collect()
    want = [(d, *x) for (d, _), x in zip(repeat_case, brute_removal([t for _, t in repeat_case]))]
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_segments_hold_every_window_once(monkeypatch):
    monkeypatch.setattr(substrings, "CHUNK", 500)
    data = prose(1, 400).encode()
    windows = []
    for first, n, place, _ in substrings.segments(data):
        assert (place <= 168).all() and (place - (n - 1) >= 0).all()
        windows += [w for f, m in zip(first, n) for w in range(f, f + m)]
    assert windows == list(range(len(data) - 199))


def test_small_sort_batches_change_nothing(spark, repeat_case, monkeypatch):
    import pyarrow as pa

    docs = frame(spark, repeat_case)
    rows = substrings._keyed(docs)
    kinds = substrings.anchored(rows).selectExpr("d", "t", "at", "k", "c", "1L as m").distinct()
    fetched = substrings._with_bytes(kinds, rows).orderBy("lead", "k").drop("lead").toArrow().to_batches(max_chunksize=7)
    marks = lambda: sorted(map(str, pa.Table.from_batches(substrings._sort_buckets(iter(fetched))).to_pylist()))
    whole = marks()
    monkeypatch.setattr(substrings, "SORTED_AT_ONCE", 5)
    assert marks() == whole and whole


def test_removal_of_empty_table(spark):
    assert substrings.remove_repeats(frame(spark, [])).count() == 0
