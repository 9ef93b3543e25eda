import importlib

import pytest
from pyspark.accumulators import AccumulatorParam
from pyspark.sql import functions as F

from glossmill.operators.annotate import MAX_LOOKUP_BYTES, lexicon_bytes
from glossmill import annotate, annotate_with, build_lexicon, flatten_sentences, flatten_tokens
from glossmill.functions.text import TOKEN_RULE, shape_pos1, shape_pos2
from glossmill.schemas import TOKEN_FIELDS

KEYS = ["k"]
# The package has a function of the same name.
annotate_module = importlib.import_module("glossmill.operators.annotate")


class Largest(AccumulatorParam):
    def zero(self, value):
        return 0

    def addInPlace(self, a, b):
        return max(a, b)


@pytest.fixture
def records(spark):
    return spark.createDataFrame(
        [
            (1, "a", ["x"], ["The dogs ran.", "It's 3"]),
            (2, "a", [], []),
            (3, "b", None, ["dogs"]),
            (4, "c", ["y"], None),
            (5, "a", ["x"], ["The dogs ran.", "​", "The dogs ran."]),
        ],
        "k int, id string, tags array<string>, texts array<string>",
    )


@pytest.fixture
def lexicon(spark):
    rows = [("dogs", "dog", "NOUN", "NNS"), ("ran", "run", "VERB", None), ("the", None, "DET", "DT")]
    return spark.createDataFrame(rows, "form string, lemma string, pos1 string, pos2 string")


def by_key(df):
    return {r.k: r for r in df.collect()}


def test_shape_annotation(records):
    rows = by_key(annotate(records))
    first = rows[1].sentences[0]
    assert first.text == "The dogs ran."
    assert first.token == ["The", "dogs", "ran", "."]
    assert first.lemma == ["the", "dogs", "ran", "."]
    assert first.pos1 == ["X", "X", "X", "PUNCT"]
    assert first.pos2 == ["XX", "XX", "XX", "."]
    assert first.dep is None
    assert rows[2].sentences == []
    assert rows[4].sentences is None


def test_shape_annotation_does_not_shuffle_or_join(records):
    plan = annotate(records)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("broadcast, limit", [("10m", 0), ("-1", 0), ("10m", MAX_LOOKUP_BYTES)])
def test_lexicon_annotation(records, lexicon, conf, broadcast, limit):
    conf("spark.sql.autoBroadcastJoinThreshold", broadcast)
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", broadcast)
    rows = by_key(annotate(records, lexicon, KEYS, limit))
    assert set(rows) == {1, 2, 3, 4, 5}
    first, second = rows[1].sentences
    assert first.text == "The dogs ran."
    assert first.token == ["The", "dogs", "ran", "."]
    assert first.lemma == ["the", "dog", "run", "."]
    assert first.pos1 == ["DET", "NOUN", "VERB", "PUNCT"]
    assert first.pos2 == ["DT", "NNS", "XX", "."]
    assert second.token == ["It's", "3"]
    assert rows[2].sentences == [] and rows[2].tags == []
    assert rows[3].tags is None and rows[3].sentences[0].lemma == ["dog"]
    assert [s.text for s in rows[5].sentences] == ["The dogs ran.", "​", "The dogs ran."]
    assert all((rows[k].id, rows[k].tags) == t for k, t in {1: ("a", ["x"]), 4: ("c", ["y"])}.items())


def test_lexicon_annotation_shuffles_records_once(spark, records, lexicon, tmp_path):
    lexicon.write.parquet(str(tmp_path / "lexicon"))
    saved = spark.read.parquet(str(tmp_path / "lexicon"))
    df = annotate(records, saved, KEYS, max_lookup_bytes=0)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in plan


def test_lexicon_that_fits_needs_no_shuffle_and_no_row_per_token(spark, records, lexicon):
    assert lexicon_bytes(lexicon) < 1000 and lexicon_bytes(lexicon.limit(0)) == 0
    df = annotate(records, lexicon, KEYS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Generate" not in plan
    empty = by_key(annotate(records, lexicon.limit(0), KEYS))
    assert {k: r.sentences for k, r in empty.items()} == {k: r.sentences for k, r in by_key(annotate(records)).items()}


def test_failing_sentences_are_found_by_halves(spark):
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def run(texts):
            calls.add(1)
            if "bad" in texts:
                raise ValueError("bad")
            return [{"token": [t]} for t in texts]

        return run

    texts = [str(i) for i in range(255)] + ["bad"]
    df = spark.createDataFrame([("a", texts)], "id string, texts array<string>")
    row = annotate_with(df, factory).first()
    assert [e.sent_pos for e in row._errors] == [255]
    assert [s.token for s in row.sentences] == [[t] for t in texts[:-1]] + [None]
    assert calls.value < 25


def test_arrays_are_parallel(records, lexicon):
    for df in (annotate(records), annotate(records, lexicon, KEYS)):
        for r in flatten_sentences(df, KEYS).filter("token IS NOT NULL").collect():
            assert len({len(r[f]) for f in ("token", "lemma", "pos1", "pos2")}) == 1


def splitting_annotator():
    def factory():
        def run(texts):
            out = []
            for text in texts:
                if "boom" in text:
                    raise ValueError("boom")
                token = text.split()
                dep = ["d"] if "uneven" in text else ["d"] * len(token)
                out.append({"token": token, "lemma": [t.lower() for t in token], "dep": dep})
            return out

        return run

    return factory


@pytest.mark.parametrize("batch_size", [1, 2, 100])
def test_plugin(spark, batch_size):
    records = spark.createDataFrame(
        [
            (1, ["A b", "C"]),
            (2, ["ok", "boom here", "D e"]),
            (3, []),
            (4, None),
            (5, ["uneven now please"]),
            (6, ["", "F"]),
        ],
        "k int, texts array<string>",
    )
    rows = by_key(annotate_with(records, splitting_annotator(), batch_size))
    assert rows[1]._errors is None
    assert [s.token for s in rows[1].sentences] == [["A", "b"], ["C"]]
    assert [s.lemma for s in rows[1].sentences] == [["a", "b"], ["c"]]
    assert rows[1].sentences[0].pos1 is None
    assert [s.token for s in rows[2].sentences] == [["ok"], None, ["D", "e"]]
    assert rows[2].sentences[1].text == "boom here"
    assert [tuple(e) for e in rows[2]._errors] == [(1, "ValueError: boom")]
    assert rows[3].sentences == [] and rows[4].sentences is None
    assert rows[5].sentences[0].token is None
    assert [e.error for e in rows[5]._errors] == ["ValueError: token arrays differ in size"]
    assert [s.token for s in rows[6].sentences] == [[], ["F"]]


def test_plugin_that_returns_too_few_results(spark):
    records = spark.createDataFrame([(1, ["a", "b"])], "k int, texts array<string>")

    def factory():
        return lambda texts: [{"token": [t]} for t in texts[:1]]

    row = annotate_with(records, factory).first()
    assert [s.token for s in row.sentences] == [["a"], ["b"]]
    assert row._errors is None


def test_plugin_with_the_library_token_rule_gives_the_library_tokens(spark, records):
    def factory(rule=TOKEN_RULE):
        import regex

        return lambda texts: [{"token": regex.findall(rule, t)} for t in texts]

    plugin = flatten_sentences(annotate_with(records, factory), KEYS).select("k", "sent_pos", "token")
    ours = flatten_sentences(annotate(records), KEYS).select("k", "sent_pos", "token")
    assert plugin.exceptAll(ours).isEmpty() and ours.exceptAll(plugin).isEmpty()


def test_build_lexicon(spark):
    tokens = spark.createDataFrame(
        [("Run", "run", "VERB", "VB")] * 2
        + [("run", "run", "NOUN", "NN")] * 3
        + [("Tie", "b", "X", "XX"), ("tie", "a", "X", "YY"), ("tie", "a", "X", "XX")],
        "token string, lemma string, pos1 string, pos2 string",
    )
    rows = sorted(map(tuple, build_lexicon(tokens).collect()))
    assert rows == [("run", "run", "NOUN", "NN", 3), ("tie", "a", "X", "XX", 1)]


def test_lexicon_of_an_annotated_corpus_reproduces_it(spark, records, lexicon):
    annotated = annotate(records, lexicon, KEYS)
    learned = build_lexicon(flatten_tokens(flatten_sentences(annotated, KEYS), KEYS))
    again = annotate(records, learned, KEYS)
    assert annotated.exceptAll(again).isEmpty() and again.exceptAll(annotated).isEmpty()


def test_frequent_form_is_split_by_adaptive_execution(spark, conf, tmp_path):
    """A form that holds most tokens, joined without a broadcast, is not left to one task."""
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.shuffle.partitions": "8",
    }.items():
        conf(key, value)
    from glossmill.operators.annotate import tag_tokens

    words = F.when(F.col("id") % 10 < 8, "the").otherwise(F.concat(F.lit("w"), F.col("id") % 997))
    tokens = spark.range(0, 300_000, 1, 8).select("id", words.alias("token"), F.uuid().alias("payload"))
    lexicon = spark.createDataFrame(
        [("the", "the", "DET", "DT")], "form string, lemma string, pos1 string, pos2 string"
    )
    df = tag_tokens(tokens, lexicon)
    tagged = df.filter("pos1 = 'DET'").collect()
    assert len(tagged) == 240_000
    rows = df.collect()
    assert len({r.id for r in rows}) == len(rows) == 300_000
    assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()


def test_all_token_fields_are_declared():
    assert TOKEN_FIELDS == ("token", "lemma", "pos1", "pos2", "dep")


def test_a_plugin_task_holds_the_arrays_of_a_piece_of_its_batch(spark, monkeypatch):
    """Before, it held those of the whole batch, which here take 70 MB."""
    monkeypatch.setattr(annotate_module, "PIECE_BYTES", 100_000, raising=False)
    held = spark.sparkContext.accumulator(0, Largest())

    def factory():
        import pyarrow as pa

        def run(texts):
            held.add(pa.total_allocated_bytes())
            tokens = [t.split() for t in texts]
            return [{f: t for f in ("token", "lemma", "pos1", "pos2", "dep")} for t in tokens]

        return run

    text = F.concat(F.col("k").cast("string"), F.repeat(F.lit(" word"), 300))
    records = spark.range(4000).coalesce(1).select(F.col("id").alias("k")).select("k", F.array(text).alias("texts"))
    rows = annotate_with(records, factory)
    sums = rows.select(F.sum("k"), F.sum(F.size(F.col("sentences")[0]["dep"])), F.count("_errors")).first()
    assert tuple(sums) == (4000 * 3999 // 2, 4000 * 301, 0)
    assert held.value < 20e6


def test_pieces_of_a_batch_give_the_same_annotations(spark, records, lexicon, monkeypatch):
    many = spark.range(40).coalesce(1).withColumnRenamed("id", "i").crossJoin(records.coalesce(1))
    many = many.withColumn("k", F.col("i") * 10 + F.col("k")).drop("i")
    whole = [by_key(annotate(many, lexicon, KEYS)), by_key(annotate_with(many, splitting_annotator()))]
    monkeypatch.setattr(annotate_module, "PIECE_BYTES", 200)
    cuts = spark.sparkContext.accumulator(0)
    pieces_of = annotate_module._pieces_of

    def counted(most):
        pieces = pieces_of(most)

        def run(rows):
            for piece in pieces(rows):
                cuts.add(1)
                assert piece.nbytes <= most or len(piece) == 1
                yield piece

        return run

    monkeypatch.setattr(annotate_module, "_pieces_of", counted)
    for before, make in zip(whole, (lambda: annotate(many, lexicon, KEYS), lambda: annotate_with(many, splitting_annotator()))):
        assert by_key(make()) == before and len(before) == 200
        assert cuts.value > 20
        cuts = spark.sparkContext.accumulator(0)


def test_shape_rules_give_a_character_the_tags_of_its_lower_case(spark):
    """All code points but the surrogates, alone and as the first of a token."""
    points = spark.range(0x110000).filter("id < 55296 OR id > 57343")
    text = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    for token in (text, F.concat(text, F.lit("a"))):
        same = [shape(token) == shape(F.lower(token)) for shape in (shape_pos1, shape_pos2)]
        assert points.filter(~same[0] | ~same[1]).isEmpty()


def test_lexicon_rows_that_repeat_the_shape_rules_are_not_sent(spark, records, lexicon):
    plain = spark.range(2000).selectExpr("concat('w', id) AS form", "concat('w', id) AS lemma", "'X' AS pos1", "'XX' AS pos2")
    rest = spark.createDataFrame([("3", None, "NUM", None), (".", ".", None, "."), (None, "x", "Y", "Z")], lexicon.schema)
    large = lexicon.union(plain).union(rest)
    limit = lexicon_bytes(lexicon)
    assert lexicon_bytes(large) > 100 * limit
    df = annotate(records, large, KEYS, limit)
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()
    assert by_key(df) == by_key(annotate(records, large, KEYS)) == by_key(annotate(records, large, KEYS, 0))
