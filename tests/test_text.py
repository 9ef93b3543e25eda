import pytest
from pyspark.sql import functions as F

from glossmill.functions.safe import field_error, field_or_null, json_error, json_or_null
from glossmill.functions.text import (
    PUNCTUATION_TAGS,
    WHITESPACE,
    explode_with_position,
    shape_lemma,
    shape_pos1,
    shape_pos2,
    split_tags,
    strip,
    text_lines,
    tokens,
)


def one(spark, text, function):
    return spark.createDataFrame([(text,)], "t string").select(function(F.col("t"))).first()[0]


def test_whitespace_is_what_python_strips():
    assert sorted(WHITESPACE) == [c for c in map(chr, range(0x110000)) if c.isspace()]


def test_strip_and_split_agree_with_python_on_every_character(spark):
    chars = [chr(i) for i in range(1, 0x10000) if not 0xD800 <= i <= 0xDFFF] + ["😀"]
    texts = [f"{c}a{c}{c}b {c}" for c in chars]
    rows = (
        spark.createDataFrame([(t,) for t in texts], "t string")
        .select("t", strip(F.col("t")).alias("s"), split_tags(strip(F.col("t"))).alias("w"))
        .collect()
    )
    assert [r.s for r in rows] == [r.t.strip() for r in rows]
    assert [r.w for r in rows] == [r.t.split() for r in rows]


@pytest.mark.parametrize("text", ["", " ", "\x85", " x", "\x0bx\x0c y　", "é", "é\xa0"])
def test_strip(spark, text):
    assert one(spark, text, strip) == text.strip()


def test_split_tags_of_blank_line(spark):
    assert one(spark, " \t", split_tags) == []


def test_text_lines(spark):
    assert one(spark, "\n a\r\nb\r\r\n \x0b\nc\n", text_lines) == ["a", "b", "c"]
    assert one(spark, "", text_lines) == []
    assert one(spark, None, text_lines) is None


def test_tokens(spark):
    text = "Don't pay $1,000.50, l’été… naïve\xa0x-y 😀"
    assert one(spark, text, tokens) == [
        "Don't", "pay", "$", "1,000.50", ",", "l’été", "…", "naïve", "x", "-", "y", "😀",
    ]


@pytest.mark.parametrize(
    "token, pos1, pos2",
    [
        ("Word", "X", "XX"),
        ("été", "X", "XX"),
        ("3.5", "NUM", "CD"),
        ("٣", "NUM", "CD"),
        (".", "PUNCT", "."),
        ("-", "PUNCT", "HYPH"),
        ("(", "PUNCT", "-LRB-"),
        ("%", "PUNCT", "SYM"),
        ("$", "SYM", "$"),
        ("+", "SYM", "SYM"),
        ("😀", "SYM", "SYM"),
        ("​", "X", "XX"),
    ],
)
def test_shapes(spark, token, pos1, pos2):
    assert one(spark, token, shape_pos1) == pos1
    assert one(spark, token, shape_pos2) == pos2
    assert one(spark, token, shape_lemma) == token.lower()


def test_punctuation_tags_do_not_overlap():
    characters = "".join(PUNCTUATION_TAGS.values())
    assert len(characters) == len(set(characters))


def test_explode_with_position_drops_empty_and_null(spark):
    df = spark.createDataFrame([(1, ["a", None]), (2, []), (3, None)], "k int, a array<string>")
    rows = explode_with_position(df, ["k"], F.col("a"), "p", "x").collect()
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == [(1, 0, "a"), (1, 1, None)]


def test_json_or_null(spark):
    texts = ['{"k": 1}', '{"k": 1', '{"k": "x"}', "{}", "", None]
    parsed = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("d", json_or_null(F.col("t")))
    rows = parsed.select(field_or_null(F.col("d"), "$.k", "bigint"), json_error(F.col("t"), F.col("d")))
    assert [tuple(r) for r in rows.collect()] == [
        (1, None),
        (None, "invalid_json"),
        (None, None),
        (None, None),
        (None, "invalid_json"),
        (None, "null_input"),
    ]


def test_field_error(spark):
    df = spark.createDataFrame([('{"k": 1}',), ('{"k": "x"}',), ("{}",), ("{",)], "t string")
    rows = df.select(field_error(json_or_null(F.col("t")), "$.k", "bigint")).collect()
    assert [r[0] for r in rows] == [None, "wrong_type", "absent", None]


def test_long_repeats_do_not_overflow_the_stack(spark):
    df = spark.createDataFrame([("1," * 100_000,), ("a'" * 100_000,)], "t string")
    assert [r[0] for r in df.select(F.size(tokens(F.col("t")))).collect()] == [2, 2]
