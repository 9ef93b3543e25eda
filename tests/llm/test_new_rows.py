"""Fill in the middle, license scans and the filter audit, against plain Python."""

import time
import hashlib
import pickle
import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from glossmill.llm import audit, decontaminate, license_rules, licenses, middle, secrets, sharding
from glossmill.llm.oracles import ORACLES
from glossmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    sql = duckdb.connect()
    for table in ("documents", "labels"):
        sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = sql.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    df = QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(df.columns)
    expected = sorted(result.fetchall(), key=repr)
    assert expected and sorted(map(tuple, df.select(*columns).collect()), key=repr) == expected


# --- fill in the middle --------------------------------------------------------


def brute_middle(doc_id, text):
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (n, "plain", None, None, text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}")
    return (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_cuts_match_slices_of_code_points():
    r = random.Random(3)
    for _ in range(200):
        texts = ["".join(r.choice("ab é😀数\x00ÿ") for _ in range(r.randrange(40))) for _ in range(r.randrange(1, 12))]
        offsets = np.cumsum([0] + [len(t.encode()) for t in texts]).astype(np.int64)
        h1, h2 = (np.array([r.randrange(2**32) for _ in texts]) for _ in range(2))
        got = middle.cuts(np.frombuffer("".join(texts).encode(), np.uint8), offsets, h1, h2)
        for text, x, y, *row in zip(texts, h1, h2, *(c.tolist() for c in got)):
            n = len(text)
            a, b = sorted((int(x) % (n + 1), int(y) % (n + 1)))
            assert row == [n, a, b - a, len(text[:a].encode()), len(text[a:b].encode())]


def test_fill_in_middle_matches_brute_force(spark, monkeypatch):
    r = random.Random(1)
    texts = [None, "", "<P>", "a<S", "S><M>x", "<", ">", "<P", "M>", "é", "\x00\x00", "👩‍👩‍👧", "<<<", "x" * 9]
    texts += ["".join(r.choice("<PSM>aé😀\n ") for _ in range(r.randrange(30))) for _ in range(300)]
    texts += [" ".join(f"wörd{i}" for i in range(30_000))]
    rows = [(i, t, i, "x") for i, t in enumerate(texts)]
    rows += [(None, "no id", 1, "x"), (5, "again", 1, "x"), (5, "again", 1, "x"), (-3, "minus", 1, "x")]
    docs = frame(spark, rows, "doc_id long, text string, n int, output string").repartition(3)
    out = middle.transform(docs)
    got = out.select("row.*", F.struct("n", "form", "prefix_chars", "middle_chars", "output").alias("fim"), middle.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert len(got) == len(rows)
    for row in got:
        assert tuple(row.fim) == brute_middle(row.doc_id, row.text)
        assert row.back == (row.text or "")
    assert {row.fim.form for row in got} == {"plain", "psm", "spm"}
    assert middle.transform(docs.limit(0)).count() == 0


def test_texts_that_are_not_utf8_stay_plain(spark):
    docs = spark.sql("SELECT id AS doc_id, CAST(unhex('80C3C3A9FFE282') AS STRING) AS text FROM range(40)")
    out = middle.transform(docs).select("n", "form", F.hex("row.text").alias("a"), F.hex(middle.restored(F.col("output"), F.col("form"))).alias("b"))
    rows = out.collect()
    assert all(r.a == r.b for r in rows) and {r.form for r in rows} == {"plain"}


def test_chunks_do_not_change_cuts(spark, monkeypatch):
    import pyarrow as pa

    texts = pa.array(["é" * i for i in range(50)])
    h = pa.array([7 * i for i in range(50)])
    whole = middle._cuts.func(texts, h, h)
    monkeypatch.setattr(middle, "CHUNK_BYTES", 30)
    assert middle._cuts.func(texts, h, h) == whole
    assert middle._cuts.func(texts.slice(10, 5), h.slice(10, 5), h.slice(10, 5)) == whole.slice(10, 5)
    assert len(middle._cuts.func(texts.slice(0, 0), h.slice(0, 0), h.slice(0, 0))) == 0


def test_sentinels_that_can_be_confused_are_refused():
    for marks in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("aba", "<S>", "<M>"), ("<P>", "<P>x", "y"), ("P<", "<S>", "<M>")):
        with pytest.raises(ValueError):
            middle.Sentinels(*marks)


# --- licenses ------------------------------------------------------------------

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute_base(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    firsts = [i for i, _ in places]
    return len(words), len(places), min(firsts, default=None), max(firsts, default=None), sorted({x for _, x in places})


def license_texts():
    r = random.Random(2)
    pieces = ["GNU General Public License", "Apache\n# License", "CC-BY", "cc by-nc 4.0", "MIT licENSE", "mit", "license", "version 2.0"]
    pieces += ["SPDX-License-Identifier: Apache-2.0", "www.apache.org/licenses/LICENSE-2.0", "GPLv3", "É", "x", "ＭＩＴ", "_", "gnu", "general", "cc"]
    texts = [None, "", " ", "mit licensed", "MIT License", "mit license mit license", "smit license", "cc by" * 3]
    texts += [" ".join(r.choice(pieces) for _ in range(r.randrange(1, 20))) for _ in range(300)]
    return [*texts, "mit license " * 20_000]


def test_base_phrases_match_brute_force(spark):
    texts = license_texts()
    docs = frame(spark, [(i, t, 9) for i, t in enumerate(texts)] + [(None, "MIT License", 1)], "doc_id long, text string, n_words int")
    rows = licenses.scan(docs).select("row.doc_id", "row.text", "n_words", licenses.base_places(F.col("detections")).alias("base"), licenses.joined_labels(F.col("detections")).alias("labels"), "score").collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        firsts = [d.first_word for d in row.base]
        labels = sorted({d.label for d in row.base})
        assert (row.n_words, len(firsts), min(firsts, default=None), max(firsts, default=None), labels) == brute_base(row.text)
        assert set(labels) <= set(row.labels.split(",")) or not labels
        assert 0 <= row.score <= 1 and (row.score > 0) == (row.labels != "")
    assert licenses.scan(docs.limit(0)).count() == 0


def brute_detect(words):
    """Every rule on every text, without keywords."""
    text = b" " + b" ".join(words) + b" "
    found = []
    for order, rule in enumerate(licenses.signatures()):
        for m in rule.pattern.finditer(text):
            found.append((text[: m.start()].count(b" ") - 1, text[: m.end() + 1].count(b" ") - 1, order))
    return [(licenses.signatures()[o].label, licenses.signatures()[o].kind, a, b) for a, b, o in sorted(found)]


def brute_resolve(found):
    kept = [d for d in found if d[1] == licenses.BASE]
    stronger = []
    for kind in licenses.KINDS:
        own = [d for d in found if d[1] == kind and not any(d[2] < b and a < d[3] for a, b in stronger)]
        for i, d in enumerate(own):
            inside = [e for j, e in enumerate(own) if j != i and e[2] <= d[2] and d[3] <= e[3]]
            if all(e[2:] == d[2:] and own.index(e) > i for e in inside) and d not in own[:i]:
                kept.append(d)
        stronger += [d[2:] for d in kept if d[1] == kind]
    return Counter(kept)


def test_keywords_lose_nothing_and_resolution_matches_brute_force():
    for text in license_texts()[:-1]:
        words = (text or "").encode().translate(licenses.WORD_BYTES).split()
        found = licenses.detect(words)
        assert found == brute_detect(words)
        assert Counter(licenses.resolve(found)) == brute_resolve(found)


def test_every_table_is_read_and_every_rule_can_be_met():
    rules = licenses.signatures()
    assert len(rules) > 300 and {r.kind for r in rules} == {licenses.BASE, *licenses.KINDS}
    assert all(r.keywords and r.label for r in rules)
    # What a tag rule looks for stands in its table.
    for line in license_rules.TAGS.strip().splitlines():
        label, expression = (x.strip() for x in line.split("|", 1))
        words = f"spdx license identifier {expression.split('(')[0]}".encode().split()
        assert (label, "tag") in {d[:2] for d in licenses.detect(words)}


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
        ("// SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2.0"),
        ("licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
        ("the GNU Lesser General Public License", "lgpl"),
        ("see https://www.mozilla.org/MPL/2.0/ for the Mozilla Public License, v. 2.0", "mpl-2.0"),
        ("Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software and associated documentation files", "mit"),
        ("she summits and commits", ""),
        ("released under a private license", "unknown-license"),
    ],
)
def test_known_notices(text, labels):
    words = text.encode().translate(licenses.WORD_BYTES).split()
    assert ",".join(sorted({d[0] for d in licenses.resolve(licenses.detect(words))})) == labels


# --- filter audit ----------------------------------------------------------------


def brute_audit(rows, labels):
    rows = [(i, t or "", s or "") for i, t, s in rows]
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t] = min(i, first.get(t, i))
    failed = []
    for i, t, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed.append(
            ("A" if len(words) < 200 else "")
            + ("B" if 100 * len(set(words)) < 50 * len(words) else "")
            + ("C" if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t) else "")
            + ("D" if re.search(r"[#$%&*|]", t) else "")
            + ("E" if i is not None and first[t] < i else "")
        )
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = []
    for part in sorted({s for _, _, s in rows}):
        own = [(r[0], f) for r, f in zip(rows, failed) if r[2] == part]
        removed_by = Counter()
        lines = []
        for order in permutations("ABCDE"):
            left = list(own)
            for step, x in enumerate(order, 1):
                gone = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                fails = [f for _, f in own if x in f]
                removed_by[x] += len(gone)
                lines.append(
                    (part, "".join(order), step, len(left), len(gone), len(fails) - len(gone), fails.count(x))
                    + (sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))
                )
        out += [(*line, removed_by[line[1][line[2] - 1]]) for line in lines]
    return out


def audit_rows():
    r = random.Random(4)
    texts = [None, "", "x", "A" * 10, "a b # c", " ".join(map(str, range(300))), " ".join("ab" for _ in range(300))]
    texts += [" ".join(r.choice("abcdefgh#A") + str(r.randrange(r.choice((5, 500)))) for _ in range(r.choice((150, 250)))) for _ in range(30)]
    rows = [(i, r.choice(texts), r.choice(("x", "y", None, ""))) for i in range(120)]
    rows += [(None, texts[5], "x"), (None, None, None), (7, "same", "y"), (7, "same", "y"), (7, "other", "y"), (300, "same", "y")]
    labels = [(i, r.choice((0, 1, None)), r.choice((0, 1, None))) for i in range(0, 130, 2)]
    return rows, labels + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]


def test_audit_matches_brute_force(spark):
    rows, labels = audit_rows()
    docs = frame(spark, [(*x, 1) for x in rows], "doc_id long, text string, source string, n int").repartition(5)
    found = audit.find_failures(docs, frame(spark, labels, "doc_id long, quality int, toxic int"))
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = audit.audit(found).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(brute_audit(rows, labels))

    # The joins on ids say the same as the joins on classes.
    for order in ("ABCDE", "EDCBA", "CADBE"):
        for step in range(1, 6):
            prefix, name = order[: step - 1], order[step - 1]
            total = lambda df: df.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            ids = (
                total(audit.surviving_ids(found, prefix + name)),
                total(audit.removed_ids(found, prefix, name)),
                total(audit.redundant_ids(found, prefix, name)),
            )
            counted = [r for r in got if r.filter_order == order and r.step == step]
            assert ids == (sum(r.kept for r in counted), sum(r.removed for r in counted), sum(r.redundant for r in counted))


def test_audit_of_nothing_and_of_other_filters(spark):
    none = frame(spark, [], "doc_id long, text string, source string")
    no_labels = frame(spark, [], "doc_id long, quality int, toxic int")
    assert audit.audit(audit.find_failures(none, no_labels)).count() == 0
    docs = frame(spark, [(1, "a", "s"), (2, "bb", "s")], "doc_id long, text string, source string")
    found = audit.find_failures(docs, no_labels, {"L": F.length("text") > 1}, duplicates=None)
    assert [tuple(r) for r in audit.audit(found).select("filter_order", "step", "kept", "removed", "shapley").collect()] == [("L", 1, 1, 1, 1)]


# --- maps and indexes ------------------------------------------------------------


def test_records_are_placed_by_the_stored_map(spark, tmp_path):
    folder = str(tmp_path / "map")
    docs = frame(spark, [(i, "x" * (i % 50)) for i in range(3000)])
    first = sharding.assign(docs, 5, 512, folder)
    assert sharding.last_version(spark, folder) == 1
    by_map = {(r.vslot, r.shard) for r in first.select("vslot", "shard").distinct().collect()}
    stored = sharding.load_map(spark, folder, 1)
    assert all(stored[slot] == shard for slot, shard in by_map)
    # One more shard edits the last version, and only what moves goes to the new shard.
    second = sharding.assign(docs, 6, 512, folder)
    assert sharding.last_version(spark, folder) == 2
    moved = {(a, b) for a, b in zip(stored, sharding.load_map(spark, folder, 2)) if a != b}
    assert moved and {b for _, b in moved} == {5}
    sizes = [r[0] for r in second.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(sizes) == 6 and max(sizes) < 1.05 * min(sizes)
    assert sharding.assign(docs, 6, 512, folder).exceptAll(second).count() == 0
    assert sharding.last_version(spark, folder) == 2


def test_an_index_takes_no_more_than_its_measure(spark):
    r = random.Random(1)
    text = " ".join("".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 9))) for _ in range(40_000))
    settings = decontaminate.Settings()
    index = decontaminate.Index([(1, text)], settings)
    assert len(pickle.dumps(index)) < decontaminate.index_bytes(len(text), settings)
    assert decontaminate.index_bytes(settings.block_bytes, settings) < 100 << 20
    # So a block of items, whatever the size of the benchmark, stays under the bound.
    items = frame(spark, [(i, text[2000 * i : 2000 * i + 2000]) for i in range(60)], "item_id long, text string")
    small = decontaminate.Settings(block_bytes=40_000)
    found = list(decontaminate.blocks(items, small))
    assert len(found) == 3 and sum(len(x.ids) for x in found) == 60
    assert all(len(pickle.dumps(x)) < 2 * decontaminate.index_bytes(small.block_bytes, small) for x in found)


def test_runs_and_long_texts_take_linear_time():
    item = "Name: " + "_" * 120 + " date of birth and signature of the applicant"
    half = "please fill in here " + "_" * 35 + " and go on with the next form, dear applicant"
    index = decontaminate.Index([(1, item), (2, half), (3, "Paris, France"), (4, "__")], decontaminate.Settings())
    began = time.monotonic()
    found = {index.ids[index.patterns[p][0]] for p, *_ in index.find("_" * 1_000_000)}
    assert found == {1} and time.monotonic() - began < 6
    began = time.monotonic()
    other = decontaminate.Index([(2, half)], decontaminate.Settings())
    assert list(other.find("_" * 1_000_000)) == [] and time.monotonic() - began < 10
    text = "x" + "_" * 5000 + "." * 3000 + "-=" * 4000 + half.lower() + "abc" * 2000 + "!"
    codes, places = decontaminate.shortened(decontaminate.code_points(text), 100)
    assert len(codes) < 1000 and "".join(text[i] for i in places) == codes.tobytes().decode("utf-32-le")
    short = "".join(text[i] for i in places)
    assert {text[i : i + 60] for i in range(len(text) - 59)} == {short[i : i + 60] for i in range(len(short) - 59)}
    assert all(text[places[i] : places[i] + 60] == short[i : i + 60] for i in (0, 100, 101, len(short) - 60))
    at = text.index(half.lower())
    assert min(s for _, s, *_ in other.find(text)) == at and max(e for *_, e, _ in other.find(text)) == at + len(half)
    assert {index.patterns[p][1] for p, *_ in index.find_short("in paris, france __ " + "_" * 1000)} == {"paris, france", "__"}


def test_short_items_drop_documents_where_asked(spark):
    docs = spark.createDataFrame([(0, "It is PARIS,\nFrance."), (1, "Paris, Frances"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "Paris, France")], "item_id long, text string")
    kept = decontaminate.drop_leaks(docs, items, decontaminate.Settings(short_items_drop=True))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert decontaminate.drop_leaks(docs, items).count() == 3


def test_equal_rows_spread_over_all_shards(spark, tmp_path):
    rows = [(None, "the same text in half of the rows")] * 2000 + [(i, f"text number {i}") for i in range(2000)]
    docs = frame(spark, rows)
    got = sharding.assign(docs, 8, 512).toPandas()
    assert len(got) == 4000 and got.doc_id.isna().sum() == 2000
    loads = got.groupby("shard")["size"].sum()
    assert len(loads) == 8 and loads.max() < 1.02 * loads.mean()
    for _, shard in got.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    # More copies than slots: every slot has its share.
    few = sharding.sized_rows(frame(spark, [(1, "x")] * 1001 + [(2, "y")]), 16).groupBy("vslot").agg(F.sum("n").alias("n")).collect()
    assert sum(r.n for r in few) == 1002 and {r.n for r in few} <= {62, 63, 64}
    sharding.write_shards(docs, sharding.balanced_map({}, 8, 512), str(tmp_path / "shards"))
    counts = [r[1] for r in spark.read.parquet(str(tmp_path / "shards")).groupBy("shard").count().collect()]
    assert sum(counts) == 4000 and max(counts) < 1.3 * 500


# --- secrets ---------------------------------------------------------------------


def test_values_after_an_announcement_are_candidates_whatever_they_are(spark):
    texts = [
        'password = "hunter2!" end',
        "secret=correcthorsebatterystaple, and",
        "so Zx8!Kq2Lm#P0vR7tY it is",
        "AWS_SECRET_ACCESS_KEY_2=wJalrXUtnFEMIK7MDENGbPxRfiCYEX then",
        "Authorization: Bearer abc",
        "'api-key': 'a b c'; key:1;key:2;key:3;key:4;key:5;key:6;key:7;key:8;key:9",
        None,
        "",
        "x" * 100_000 + "=" * 100_000 + "key" * 50_000,
        "plain words, and a time of 10:30 o'clock",
        "key: ,;",
    ]
    docs = frame(spark, [(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, value int")
    got = {}
    for r in secrets.candidates(docs).orderBy("doc_id", "n").collect():
        got.setdefault(r.doc_id, []).append(r.value)
        if r.doc_id < 8:
            assert r.before + r.value + r.after in texts[r.doc_id]
            assert len(r.before) == 32 or texts[r.doc_id].startswith(r.before + r.value)
    assert got[0] == ["hunter2!"] and got[1] == ["correcthorsebatterystaple"] and got[2] == ["Zx8!Kq2Lm#P0vR7tY"]
    assert got[3] == ["wJalrXUtnFEMIK7MDENGbPxRfiCYEX"] and got[4] == ["abc"]
    assert got[5][0] == "a b c" and len(got[5]) >= 2
    assert not {6, 7, 9, 10} & set(got)


def test_findings_that_no_template_writes(spark):
    forest = secrets.train(secrets.labelled_findings(spark))
    secret = ['db_password: "tr0ub4dor&3"', "secret=correcthorsebatterystaple", "export API_TOKEN=q9Vn3LxT0aWz7RkE2sYp", 'password = "hunter2!"', "AWS_SECRET_ACCESS_KEY_2=wJalrXUtnFEMIK7MDENGbPxRfiCYEX"]
    harmless = ["author: Miller wrote this", "the key: patience", "password = ${DB_PASS}", "token: string", "see report-2024-final-version-03.html", "key: one of the things"]
    docs = frame(spark, [(i, t) for i, t in enumerate(secret + harmless)])
    told = {r.doc_id for r in secrets.scan(docs, forest).filter("is_secret").collect()}
    assert len(told & set(range(len(secret)))) >= 4
    assert len(told - set(range(len(secret)))) <= 1
