"""Quality rules, mixing, sharding, HTML, personal data and secrets."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from glossmill.llm import html, mixing, pii, quality, secrets, sharding


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


# --- quality -----------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    counts = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if counts[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_statistics_match_brute_force(spark):
    r = random.Random(5)
    alphabet = ["a", "b", "é", "𝄞x", "#*", "|", " y", " ", " ", "\n", "\n", "\t", "\x0b", "\r\n"]
    texts = [None, "", " ", "\n\n", "a b", "a a a a", "a b c a b c", "x\nx\n\nx"]
    texts += ["".join(r.choice(alphabet) for _ in range(r.randrange(200))) for _ in range(60)]
    texts.append(" ".join(r.choice("abc") for _ in range(20000)))
    got = quality.with_statistics(frame(spark, list(enumerate(texts)))).collect()
    for row in got:
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        assert tuple(row[n] for n in names) == brute_statistics(texts[row.doc_id]), texts[row.doc_id]


def labelled_docs():
    r = random.Random(1)
    good = [" ".join(f"{r.choice('abcdefgh')}{r.randrange(10**4)}wo" for _ in range(80)) for _ in range(120)]
    bad = [" ".join(f"{r.randrange(10**4)}##*" for _ in range(80)) for _ in range(60)]
    rows = list(enumerate(good + bad))
    return rows, [(i, int(i < 120)) for i, _ in rows]


def test_rules_are_learned_and_keep_clean_rows(spark):
    rows, labels = labelled_docs()
    docs = frame(spark, [(*x, 0) for x in rows] + [(None, rows[0][1], 1), (500, None, 2)], "doc_id long, text string, n_words int")
    rules = quality.learn_rules(docs, frame(spark, labels + [(None, 0), (7, None)], "doc_id long, quality int"))
    assert rules and all(isinstance(x, quality.Literal) for rule in rules for x in rule)
    kept = quality.keep_good(docs, rules)
    assert kept.columns == docs.columns
    assert sorted(x.doc_id if x.doc_id is not None else -1 for x in kept.collect()) == [-1, *range(120)]
    reasons = quality.judge(docs.select("doc_id", "text"), rules).filter("doc_id >= 120 AND doc_id < 200").select("rule").distinct()
    assert {x.rule for x in reasons.collect()} <= {" AND ".join(map(str, rule)) for rule in rules}


def test_no_labels_no_rules(spark):
    rows, _ = labelled_docs()
    none = frame(spark, [], "doc_id long, quality int")
    assert quality.learn_rules(frame(spark, rows), none) == []
    assert quality.learn_rules(frame(spark, []), none) == []
    assert quality.keep_good(frame(spark, rows), []).count() == len(rows)
    assert quality.keep_good(frame(spark, []), []).count() == 0


# --- mixing ------------------------------------------------------------------


def test_mixture_is_less_than_one_block_off(spark):
    sizes = {"a": 900, "b": 300, "c": 64, None: 48, "": 40, "z": 1}
    rows = [(i, s, i) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    rows += [(None, "a", 1), (None, "a", 1), (3, "a", 1)]
    docs = frame(spark, rows, "doc_id long, source string, slot int")
    got = mixing.mix(docs, block_rows=8, period=100).select("row.*", F.col("source").alias("s"), F.col("slot").alias("at"), "place", "block", "release", "deadline", "weight").toPandas()
    assert sorted(map(str, got[["doc_id", "source", "slot"]].itertuples(index=False))) == sorted(
        map(str, docs.toPandas().itertuples(index=False))
    )
    assert ((got["at"] >= got.release) & (got["at"] < got.deadline)).all()
    assert got.groupby("at").s.nunique().max() == 1 and got.groupby(["at", "place"]).size().max() == 1
    weight = got.groupby("s").weight.first()
    assert abs(weight.sum() - 1) < 1e-9
    done = Counter()
    for t, s in enumerate(got.drop_duplicates("at").sort_values("at").set_index("at").s.items()):
        if s[0] != t:
            break  # a source has run out
        done[s[1]] += 1
        assert all(abs(done[x] - weight[x] * (t + 1)) < 1 for x in weight.index)


def test_given_weights_and_empty_tables(spark):
    docs = frame(spark, [(i, "ab"[i % 2]) for i in range(400)], "doc_id long, source string")
    weights = frame(spark, [("a", 3.0), ("b", 1.0), ("gone", 5.0)], "source string, weight double")
    got = mixing.mix(docs, weights, block_rows=1, period=4).toPandas()
    assert dict(got.groupby("source").weight.first()) == {"a": 0.75, "b": 0.25}
    assert mixing.mixed(docs).columns == docs.columns and mixing.mixed(docs).count() == 400
    assert mixing.mix(docs.limit(0)).count() == 0


# --- sharding ----------------------------------------------------------------


def test_shards_are_near_equal_and_places_gapless(spark):
    r = random.Random(2)
    rows = [(i, "xé" * r.randrange(400)) for i in range(1500)] + [(None, None), (None, "a"), (4, "same"), (4, "same")]
    got = sharding.assign(frame(spark, [(*x, 0) for x in rows], "doc_id long, text string, slot int"), 7, 512).toPandas()
    assert len(got) == len(rows)
    assert Counter(zip(got["size"], got.text_crc32)) == Counter(
        (len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in rows
    )
    for _, shard in got.groupby("shard"):
        assert sorted(shard.slot) == list(range(len(shard)))
    loads = got.groupby("shard")["size"].sum()
    assert len(loads) == 7 and loads.max() < 1.02 * loads.mean()
    assert sharding.assign(frame(spark, []), 7).count() == 0


def test_rebalancing_moves_few_slots_and_versions_stay(spark, tmp_path):
    r = random.Random(3)
    sizes = {s: r.randrange(1, 1000) for s in range(256)}
    old = sharding.balanced_map(sizes, 8, 256)
    grown = sharding.rebalanced_map(old, sizes, 9)
    loads = [sum(sizes[s] for s in range(256) if grown[s] == i) for i in range(9)]
    assert max(loads) < 1.05 * sum(loads) / 9
    assert sum(a != b for a, b in zip(old, grown)) < 0.35 * 256
    shrunk = sharding.rebalanced_map(grown, sizes, 8)
    assert set(shrunk) == set(range(8))
    folder = str(tmp_path / "map")
    sharding.save_map(spark, folder, 1, old)
    sharding.save_map(spark, folder, 2, grown)
    assert sharding.load_map(spark, folder, 1) == old and sharding.load_map(spark, folder, 2) == grown
    with pytest.raises(Exception, match="(?i)exist"):
        sharding.save_map(spark, folder, 2, old)


def test_written_shards_hold_all_rows(spark, tmp_path):
    docs = frame(spark, [(i, f"t{i}", "s") for i in range(50)], "doc_id long, text string, shard string")
    slot_map = sharding.balanced_map({}, 4, 64)
    sharding.write_shards(docs, slot_map, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert {(r.doc_id, r.text, r.record_shard) for r in back.collect()} == {tuple(r) for r in docs.collect()}


# --- HTML --------------------------------------------------------------------

PAGES = {
    "<html><body><nav><a>Menu</a></nav><article><h1>T &amp; U</h1><p>One\n  two&nbsp;<b>three</b>.</p><p>Four.</p>"
    "</article><footer>&copy; x</footer></body></html>": "T & U\n\nOne two three.\n\nFour.",
    '<body><div class="ad">Buy now</div><div class="post-content"><h1>Head</h1><p>Some words of the text, and more.'
    '<p>Unclosed <i>para</p><form><label>Mail</label></form></div><div class="comments"><p>Nice text, thanks a lot!'
    "</p></div></body>": "Head\n\nSome words of the text, and more.\n\nUnclosed para",
    "<p>only<br>text<!-- no --><script>var a='<p>x</p>'</script>": "only text",
    "": "",
    None: "",
    "plain & <simple": "plain & <simple",
}


def test_main_text(spark):
    rows = [(i, None if i else "u", page, 1) for i, page in enumerate(PAGES)]
    got = html.extract(frame(spark, rows, "page_id long, url string, html string, text int")).collect()
    want = list(PAGES.values())
    assert {r.page_id: r.text for r in got} == dict(enumerate(want))
    assert all(r.n_chars == len(r.text) for r in got)
    assert html.extract(frame(spark, [], "page_id long, url string, html string")).count() == 0


def test_held_out_elements():
    model, right, total = html.page_model(), 0, 0
    for nodes, x, y in html.labelled_pages(60, 4321):
        kept = html.decode(nodes, model.log_odds(x))
        right, total = right + (kept == (y == 1))[y >= 0].sum(), total + (y >= 0).sum()
        for i in range(1, len(nodes)):
            assert kept[nodes[i].parent] or not kept[i]
    assert right / total > 0.98


def test_hard_markup_is_linear():
    deep = "<b>" * 20_000 + "x" + '<p title="' * 2000 + "<div>" * 5000
    assert next(html.main_texts([deep], html.page_model())).startswith("x")


def test_names_in_attribute_values_hide_nothing_and_a_form_may_hold_the_page():
    body = "<h1>Head</h1>" + "<p>Some words of the text, and then some more of it.</p>" * 3
    want = "\n\n".join(["Head"] + ["Some words of the text, and then some more of it."] * 3)
    pages = [f"<body {a}><div class=content {a}>{body}</div></body>" for a in ('style="overflow:hidden"', 'data-title="The hidden cost"', "data-hidden=false", "title='x hidden'")]
    pages.append(f'<body><form action="./x.aspx"><div class="content">{body}</div></form></body>')
    assert list(html.main_texts(pages, html.page_model())) == [want] * len(pages)
    gone = [f"<body><article>{body}</article><div {a}><p>Not seen here.</p></div></body>" for a in ("hidden", 'HIDDEN=""', "hidden=hidden", 'aria-hidden="true"', "data-x='a' hidden")]
    gone.append(f"<body><article>{body}</article><form><label>Mail</label></form></body>")
    assert list(html.main_texts(gone, html.page_model())) == [want] * len(gone)
    nodes, texts = html.parse("<ul>" + "<li>x</li>" * 70 + "</ul>")
    assert html.features(nodes, texts)[-1, len(html.TAGS) + 17] == 70


# --- personal data -----------------------------------------------------------


def test_surrogates_keep_type_form_and_coreference(spark):
    text = (
        "Write to Ann.Lee@mail.example.com or ANN.LEE@MAIL.EXAMPLE.COM, +1 (555) 010-2030, 555-010-2030,"
        " 10.20.30.40, card 4539 1488 0343 6467 and 4539148803436467, not 4539148803436468,"
        " 123-45-6789, Mr Smith, Mrs Smith and Herr Müller, Госпожа Иванова. Version 4.0."
    )
    rows = [(1, text, "x"), (2, "mail ann.lee@mail.example.com", "y"), (None, None, "z"), (4, "", "z"), (5, "clean", "z"), (5, "clean", "z")]
    got = pii.pseudonymise(frame(spark, rows, "doc_id long, text string, kinds string"), "key").collect()
    by_id = {r.doc_id: r for r in got}
    new = by_id[1].text
    assert len(got) == 6 and by_id[None].text is None and by_id[4].text == "" and by_id[5].text == "clean"
    for old in ("Lee", "010-2030", "10.20.30.40", "4539 1488", "4539148803436467", "123-45-6789", "Smith", "Müller", "Иванова"):
        assert old.lower() not in new.lower(), old
    assert "4539148803436468" in new and "Version 4.0." in new
    emails = re.findall(r"\S+@[\w.]+\w", new)
    assert emails[1] == emails[0].upper() and by_id[2].text.split()[-1] == emails[0]
    assert emails[0].endswith(".com") and len(emails[0]) == len("ann.lee@mail.example.com")
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}, \d{3}-\d{3}-\d{4},", new)
    spaced, plain = re.search(r"card (4\d{3}(?: \d{4}){3}) and (4\d{15}),", new).groups()
    assert spaced.replace(" ", "") == plain
    digits = [int(c) for c in reversed(plain)]
    assert sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits)) % 10 == 0
    assert re.search(r"Mr [A-Z][a-z]+, Mrs [A-Z][a-z]+ and Herr [A-Z][a-z]+, Госпожа [А-Я][а-я]+а\.", new)
    other = pii.pseudonymise(frame(spark, rows[:1], "doc_id long, text string, kinds string"), "other key").first()
    assert other.text != new
    assert pii.pseudonymise(frame(spark, []), "key").count() == 0


def test_collisions_are_drawn_again(spark):
    mails = [f"{a}@{b}.co" for a in "abcdefghij" for b in "abcdefghij"]
    docs = frame(spark, [(i if i % 7 else None, f"see {m} and {m}") for i, m in enumerate(mails)])
    found = pii.entities(docs)
    again = pii.redrawn(found, "k")
    assert again.count() > 10
    got = [r.text.split() for r in pii.pseudonymise(docs, "k").collect()]
    assert all(x[1] == x[3] for x in got)
    drawn = {x[1] for x in got}
    assert len(drawn) == len(mails) and not drawn & set(mails)


def test_redraws_end_where_a_shape_has_no_free_surrogate(spark):
    mails = [f"{a}@{b}.io" for a in map(chr, range(97, 123)) for b in map(chr, range(97, 123))] + ["---@---.com", "_@-.com"]
    docs = frame(spark, [(i, f"see {m} and {m}") for i, m in enumerate(mails)])
    got = [r.text.split() for r in pii.pseudonymise(docs, "k").collect()]
    assert all(x[1] == x[3] and "@" in x[1] for x in got)
    drawn = {x[1] for x in got}
    assert len(drawn) == len(mails) and not drawn & set(mails)


def test_surrogates_of_every_type_grow_with_the_attempts(spark):
    rows = [("ip", "10.20.30.40"), ("ssn", "123456789"), ("card", "4539148803436467"), ("phone", "5550102030"), ("male", "male:smith"), ("female", "female:иванова")]
    grown = [pii.surrogate(F.col("kind"), F.col("entity"), "k", F.lit(n)).alias(f"n{n}") for n in (0, 12)]
    for row in frame(spark, rows, "kind string, entity string").select("kind", "entity", *grown).collect():
        assert len(row.n12) >= len(row.n0) + 4, row
        assert row.kind != "card" or sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(row.n12))) % 10 == 0
    shown = pii.written(F.lit("ssn"), F.lit("123-45-6789"), F.lit("98765432101"), "k")
    assert spark.range(1).select(shown).first()[0] == "987-65-432101"


def test_entities_are_found_whole(spark):
    text = (
        "Mr John Smith, Mr J. R. Smith and Mr Smith. The Herr Meier-Schulz, Mr O’Brien, Mr O'Brien's hat, Herr Dr. von Bülow, Señor Ortega y Señora Vidal."
        " Frau Prof. Anna-Lena Groß\nNext"
    )
    new = pii.pseudonymise(frame(spark, [(1, text)]), "key").first().text
    for old in "John Smith Meier Schulz Brien Bülow Ortega Vidal Anna Lena Groß".split():
        assert old not in new, old
    family = r"([A-Z][a-z]{6,})"
    shape = rf"Mr [A-Z][a-z]+ {family}, Mr [A-Z]\. [A-Z]\. \1 and Mr \1\. The Herr {family}, Mr {family}, Mr \3's hat, Herr Dr\. von {family}, Señor {family} y Señora {family}\. Frau Prof\. [A-Z][a-z]+ {family}\nNext"
    assert re.fullmatch(shape, new), new
    numbers = ["+49 30 1234567", "+49 (0)30 123 45 67", "0049 171 1234567", "030 1234567", "0171/1234567", "(030) 123 4567", "01711234567"]
    numbers += ["06 12 34 56 78", "06.12.34.56.78", "0612345678", "+33 6 12 34 56 78", "612 345 678", "91 123 45 67", "+34 612 345 678", "+442079460958"]
    numbers += ["3782 822463 10005", "3782-822463-10005"]
    clean = ["05.12.2024", "2024-01-05", "1 234 567", "10:30", "007", "3.14159265", "0012345678901234", "3782 822463 10006"]
    got = pii.pseudonymise(frame(spark, [(i, f"at {x}, so") for i, x in enumerate(numbers + clean)]), "key").collect()
    for row in got:
        x = (numbers + clean)[row.doc_id]
        assert (row.text == f"at {x}, so") == (x in clean), (x, row.text)
        assert re.sub(r"\d", "9", row.text) == re.sub(r"\d", "9", f"at {x}, so"), (x, row.text)
        assert row.kinds == ("" if x in clean else "card" if x[:4] == "3782" else "phone")


# --- secrets -----------------------------------------------------------------


@pytest.fixture(scope="module")
def forest(spark):
    return secrets.train(secrets.labelled_findings(spark, 3000))


def test_held_out_findings(spark, forest):
    held = secrets.labelled_findings(spark, 1500, seed=99)
    scored = forest.transform(secrets._vectors(secrets.described(held))).toPandas()
    assert (scored.label == scored.prediction).mean() > 0.97


def test_secrets_are_found_and_harmless_tokens_are_not(spark, forest):
    key = "9b1f" * 3 + "0c7a5e2d4f6b8a3c1d9e7f5a2b4c"
    rows = [
        (1, f'config token = "{key}" end', 0),
        (2, "see https://www.example.com/2024/report/archive/latest7.html and report_summary_2024", 0),
        (3, f"api_key={key} and password: Zx8Kq2LmP0vR7tYw3Bn5", 0),
        (None, "", 0),
        (4, None, 0),
        (5, "a1" * 50_000, 0),
    ]
    docs = frame(spark, rows, "doc_id long, text string, value int")
    got = secrets.scan(docs, forest).toPandas()
    secret = got[got.is_secret]
    assert set(secret[secret.value == key].doc_id) == {1, 3}
    assert "Zx8Kq2LmP0vR7tYw3Bn5" in set(secret.value)
    assert not (got.is_secret & (got.doc_id == 2)).any() and (got.doc_id == 2).any()
    assert set(secrets.masked(secrets.scan(docs, forest)).columns) == {"doc_id", "n", "probability", "is_secret", "value_start", "value_sha256"}
    assert secrets.scan(frame(spark, []), forest).count() == 0


def test_features_are_numbers(spark):
    row = secrets.described(frame(spark, [("", "", "")], "value string, before string, after string")).first()
    assert all(np.isfinite(row[f]) for f in secrets.FEATURES)


def test_scan_works_in_a_session_that_has_observed_a_metric(spark, forest):
    from pyspark.sql import Observation

    seen = Observation()
    spark.range(5).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get["n"] == 5
    docs = frame(spark, [(1, "api_key=Zx8Kq2LmP0vR7tYw3Bn5")])
    secrets.scan(docs, forest).write.format("noop").mode("overwrite").save()
