"""The operators run as queries over the test tables, with flat results.

Nested columns are flattened, and lists are joined with U+0001, so that results
can be compared with SQL on the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from glossmill.functions.safe import field_or_null, fields_or_reasons, json_error, json_or_null
from glossmill.functions.text import (
    TOKEN_RULE,
    explode_with_position,
    split_tags,
    text_lines,
    tokens,
)
from glossmill.operators.annotate import Annotator, annotate, annotate_with, tag_tokens
from glossmill.operators.blocks import group_blocks
from glossmill.operators.distribute import distribute
from glossmill.operators.lexicon import build_lexicon
from glossmill.operators.nested import flatten_sentences, flatten_tokens, nest_children
from glossmill.operators.parse import parse_blocks
from glossmill.operators.typed import enforce_schema, fill_missing, schema_violations
from glossmill.plans.ingest import ingest
from glossmill.schemas import QUARANTINE_SCHEMA, RECORD_SCHEMA, STORED_SCHEMA
from glossmill.session import settings, shared_path
from glossmill.sources.records import read_checked, read_records, write_records
from glossmill.sources.text import number_lines, scan_lines, write_blocks

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _written_once(make: Callable[[SparkSession, str], str]) -> Callable[[SparkSession, str], str]:
    """Write an input of several queries once per session, and again when its folder of tables has changed."""
    known: dict[tuple, str] = {}

    @wraps(make)
    def path(spark: SparkSession, sf_dir: str) -> str:
        tables = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
        store = tables.getFileSystem(spark._jsc.hadoopConfiguration())
        state = tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in store.listStatus(tables)))
        key = (spark.sparkContext.applicationId, sf_dir, state)
        if key not in known:
            known[key] = make(spark, sf_dir)
        return known[key]

    return path


def _joined(items: Column | str) -> Column:
    return F.array_join(items, "\x01")


def _size(items: Column | str) -> Column:
    return F.size(items).cast("bigint")


# --- inputs that Spark derives from the tables -------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records: `id, tags, texts`; a line is a sentence."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return distribute(documents).select(
        F.col("doc_id").cast("string").alias("id"),
        split_tags(F.concat_ws(" ", "lang", "source")).alias("tags"),
        text_lines(F.col("text")).alias("texts"),
    )


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return distribute(turns).select("conv_id", "turn", text_lines(F.col("text")).alias("texts"))


def _sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_with_position(
        _documents(spark, sf_dir), ["id"], F.col("texts"), "sent_pos", "text"
    )


def _document_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_with_position(
        _sentences(spark, sf_dir), ["id", "sent_pos"], tokens(F.col("text")), "tok_pos", "token"
    )


def _nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate(_documents(spark, sf_dir))


@_written_once
def _text_corpus(spark: SparkSession, sf_dir: str) -> str:
    """Documents written as text: id, tags, then one sentence per line."""
    block = F.concat(F.array("id", F.array_join("tags", " ")), "texts")
    path = shared_path(spark, "corpus")
    write_blocks(_documents(spark, sf_dir), block, path)
    return path


@_written_once
def _ragged_corpus(spark: SparkSession, sf_dir: str) -> str:
    """As `_text_corpus`, but one-line documents lack everything but the id."""
    body = F.concat(F.array(F.array_join("tags", " ")), "texts")
    rest = F.when(F.size("texts") > 1, body).otherwise(F.array().cast("array<string>"))
    path = shared_path(spark, "ragged")
    write_blocks(_documents(spark, sf_dir), F.concat(F.array("id"), rest), path)
    return path


@_written_once
def _edge_corpus(spark: SparkSession, sf_dir: str) -> str:
    """As `_text_corpus`, with line ends, separators and bytes by language.

    German has CR LF, French CR, Spanish blank lines before and a line of blanks after.
    Texts of one source end in a line with their id and bytes that are not UTF-8.
    """
    lang, end = F.col("tags")[0], F.lit("\n")
    none = F.array().cast("array<string>")
    bad = F.array(F.concat("id", F.unhex(F.lit("FFC328")).cast("string")))
    rows = F.concat(
        F.array("id", F.array_join("tags", " ")),
        F.coalesce("texts", none),
        F.when(F.col("tags")[1] == "src0", bad).otherwise(none),
    )
    text = (
        F.when(lang == "de", F.concat(F.array_join(rows, "\r\n"), F.lit("\r\n\r")))
        .when(lang == "fr", F.concat(F.array_join(rows, "\r"), F.lit("\r\r")))
        .when(lang == "es", F.concat(F.lit("\n\n"), F.array_join(rows, "\n"), F.lit("\n \t")))
        .otherwise(F.concat(F.array_join(rows, "\n"), end))
    )
    path = shared_path(spark, "edges")
    _documents(spark, sf_dir).select(text).write.text(path)
    return path


@_written_once
def _corpus_by_source(spark: SparkSession, sf_dir: str) -> str:
    """As `_text_corpus`, one file per source and thousand ids, with its documents in order of their ids."""
    rows = F.concat(F.array("id", F.array_join("tags", " ")), "texts")
    number = F.col("id").cast("long")
    documents = _documents(spark, sf_dir).withColumns({"source": F.col("tags")[1], "bucket": F.floor(number / 1000)})
    ordered = documents.repartition("source", "bucket").sortWithinPartitions("source", "bucket", number)
    path = shared_path(spark, "sources")
    text = F.concat(F.array_join(rows, "\n"), F.lit("\n"))
    ordered.select(text, "source", "bucket").write.partitionBy("source", "bucket").text(path)
    return path


def capital_annotator(rule: str = TOKEN_RULE) -> Callable[[], Annotator]:
    """A factory of plug-ins that take capitals inside a sentence for proper nouns.

    The factory is a closure, so tasks get it by value and need not import this package.
    """

    def factory() -> Annotator:
        import regex

        token_rule = regex.compile(rule)
        capital = regex.compile(r"\p{Lu}")

        def one(text: str) -> dict:
            token = token_rule.findall(text)
            proper = [i > 0 and capital.match(t) is not None for i, t in enumerate(token)]
            return {
                "token": token,
                "lemma": [t if p else t.lower() for t, p in zip(token, proper)],
                "pos1": ["PROPN" if p else "X" for p in proper],
                "pos2": ["NNP" if p else "XX" for p in proper],
                "dep": ["ROOT" if i == 0 else "dep" for i in range(len(token))],
            }

        return lambda texts: [one(text) for text in texts]

    return factory


#: Of the nested JSON that queries write: it says every token up to four times.
COMPRESSION = "gzip"

#: What a part may hold in the queries that show them.
PART_BYTES = 600


def _annotated_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_sentences(
        annotate_with(_turns(spark, sf_dir), capital_annotator()), ["conv_id", "turn"]
    )


def _lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_lexicon(flatten_tokens(_annotated_turns(spark, sf_dir), ["conv_id", "turn"]))


@_written_once
def _saved_lexicon_path(spark: SparkSession, sf_dir: str) -> str:
    path = shared_path(spark, "lexicon")
    write_records(_lexicon(spark, sf_dir), path, "parquet")
    return path


def _saved_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lexicon as a table, which tells the planner its size."""
    return spark.read.parquet(_saved_lexicon_path(spark, sf_dir))


# --- queries -----------------------------------------------------------------


def scan_lines_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = scan_lines(spark, _text_corpus(spark, sf_dir))
    return lines.groupBy("line", "valid").agg(F.count("*").alias("n"))


def line_numbers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with its file and its place in it, empty ones included."""
    lines = number_lines(scan_lines(spark, _corpus_by_source(spark, sf_dir)))
    source, bucket = (F.regexp_extract("path", f"{name}=([^/]*)/", 1) for name in ("source", "bucket"))
    return lines.select(source.alias("source"), bucket.cast("long").alias("bucket"), "number", "line")


def scoped_settings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per language, counted under settings of their own, and what became of those settings."""
    wanted = {"spark.sql.shuffle.partitions": "5", "spark.sql.files.minPartitionNum": "9"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    path = shared_path(spark, "counts")
    with settings(spark, wanted):
        held = all(spark.conf.get(key) == value for key, value in wanted.items())
        counts = _table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n"))
        write_records(counts, path, "parquet")
    restored = before == {key: spark.conf.get(key, None) for key in wanted}
    return spark.read.parquet(path).select("lang", "n", F.lit(held).alias("held"), F.lit(restored).alias("restored"))


def group_blocks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_blocks(scan_lines(spark, _text_corpus(spark, sf_dir))).select(
        F.try_element_at("lines", F.lit(1)).alias("id"),
        _size("lines").alias("n_lines"),
        _joined("lines").alias("block"),
    )


def group_blocks_parts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of all parts, at a limit that most documents exceed."""
    blocks = group_blocks(scan_lines(spark, _text_corpus(spark, sf_dir)), max_block_bytes=PART_BYTES)
    parts = F.sort_array(F.collect_list(F.struct(F.coalesce("part", F.lit(-1)).alias("part"), "lines")))
    joined = blocks.groupBy("path", "block_no", F.col("head")[0].alias("id")).agg(
        F.flatten(parts["lines"]).alias("lines"), F.every(F.col("part").isNull()).alias("whole")
    )
    return joined.select("id", "whole", _size("lines").alias("n_lines"), _joined("lines").alias("block"))


def group_blocks_edges_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of line end and separator, and lines that are not UTF-8 with their bytes."""
    blocks = group_blocks(scan_lines(spark, _edge_corpus(spark, sf_dir)))
    bad = F.array_compact(F.coalesce("raw", F.array().cast("array<string>")))
    return parse_blocks(blocks).select(
        "id",
        _joined("tags").alias("tags"),
        _joined(F.slice("lines", F.lit(3), F.size("texts") - F.size(bad))).alias("texts"),
        F.coalesce("reason", F.lit("ok")).alias("status"),
        _joined(F.transform(bad, lambda r: F.hex(F.unbase64(r)))).alias("raw"),
    )


def parse_blocks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = group_blocks(scan_lines(spark, _text_corpus(spark, sf_dir)))
    return parse_blocks(blocks).select(
        "id",
        _size("tags").alias("n_tags"),
        _size("texts").alias("n_sentences"),
        F.try_element_at("texts", F.lit(1)).alias("first_sentence"),
        "reason",
    )


def quarantine_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = group_blocks(scan_lines(spark, _ragged_corpus(spark, sf_dir)))
    return parse_blocks(blocks).select(
        "id",
        _size("lines").alias("n_lines"),
        F.coalesce("reason", F.lit("ok")).alias("status"),
    )


def split_lines_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sentences(spark, sf_dir).select("id", F.col("sent_pos").cast("bigint").alias("pos"), "text")


def distribute_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return distribute(orders, 16)


def split_tags_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = explode_with_position(_documents(spark, sf_dir), ["id"], F.col("tags"), "pos", "tag")
    return tags.withColumn("pos", F.col("pos").cast("bigint"))


def _token_columns(*names: str) -> list[Column | str]:
    return ["id", *[F.col(c).cast("bigint").alias(c) for c in ("sent_pos", "tok_pos")], *names]


def tokens_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _document_tokens(spark, sf_dir).select(*_token_columns("token"))


def lemmas_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = tag_tokens(_document_tokens(spark, sf_dir), _saved_lexicon(spark, sf_dir))
    return tagged.select(*_token_columns("token", "lemma"))


def pos_tags_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = tag_tokens(_document_tokens(spark, sf_dir), _saved_lexicon(spark, sf_dir))
    return tagged.select(*_token_columns("token", "pos1", "pos2"))


def _annotation_columns(keys: list[str]) -> list[Column | str]:
    arrays = ("token", "lemma", "pos1", "pos2")
    return [
        *keys,
        F.col("sent_pos").cast("bigint").alias("sent_pos"),
        "text",
        *[_size(a).alias(f"n_{a}") for a in arrays],
        *[_joined(a).alias(a) for a in arrays],
        _joined("dep").alias("dep"),
    ]


def annotate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = annotate(_documents(spark, sf_dir), _saved_lexicon(spark, sf_dir), ["id"])
    return flatten_sentences(records).filter("sent_pos IS NOT NULL").select(*_annotation_columns(["id"]))


def annotate_shape_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sentences = flatten_sentences(_nested_documents(spark, sf_dir)).filter("sent_pos IS NOT NULL")
    return sentences.select(*_annotation_columns(["id"]))


def annotate_plugin_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["conv_id", "turn"]
    return _annotated_turns(spark, sf_dir).filter("sent_pos IS NOT NULL").select(*_annotation_columns(keys))


def build_lexicon_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lexicon(spark, sf_dir)


def flatten_sentences_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_sentences(_nested_documents(spark, sf_dir)).select(
        "id", F.col("sent_pos").cast("bigint").alias("sent_pos"), "text"
    )


def flatten_tokens_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sentences = flatten_sentences(_nested_documents(spark, sf_dir))
    return flatten_tokens(sentences).select(*_token_columns("token", "lemma", "pos1", "pos2", "dep"))


def nest_sentences_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    nested = nest_children(turns, ["conv_id"], "turn", ["role", "text"], "turns")
    return nested.select(
        "conv_id",
        _size("turns").alias("n"),
        _joined("turns.role").alias("roles"),
        _joined("turns.text").alias("texts"),
    )


def nest_parts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every child of every part, at a limit that most conversations exceed."""
    turns = _table(spark, sf_dir, "conversations")
    nested = nest_children(turns, ["conv_id"], "turn", ["turn", "role", "text"], "turns", max_part_bytes=300)
    return nested.select("conv_id", F.inline("turns"))


def nest_under_parents_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as parents, their orders as children; some have none."""
    orders = _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority"
    )
    customers = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    nested = nest_children(orders, ["c_custkey"], "o_orderkey", ["o_orderpriority"], "orders", customers)
    return nested.select(
        "c_custkey",
        "c_name",
        _size("orders").alias("n"),
        _joined("orders.o_orderpriority").alias("priorities"),
    )


def enforce_schema_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType([*RECORD_SCHEMA.fields[:2], T.StructField("doc_id", T.LongType())])
    documents = _table(spark, sf_dir, "documents").select(
        # Spanish documents have lost their id.
        F.when(F.col("lang") != "es", F.col("doc_id").cast("string")).alias("id"),
        split_tags(F.concat_ws(" ", "lang", "source")).alias("tags"),
        "doc_id",
    )
    good = enforce_schema(documents, schema).select("doc_id", "id", F.lit("ok").alias("status"))
    bad = schema_violations(documents, schema).select("doc_id", "id", F.col("reason").alias("status"))
    return good.unionByName(bad)


def enforce_nested_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required fields inside structs and arrays: French documents lose their first text, German ones their source."""
    line = T.StructType([T.StructField("text", T.StringType(), False), T.StructField("n", T.IntegerType())])
    origin = T.StructType([T.StructField("source", T.StringType(), False)])
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("lines", T.ArrayType(line, False)), T.StructField("origin", origin)]
    )
    lang = F.col("lang")
    lines = F.transform(
        text_lines(F.col("text")),
        lambda t, i: F.struct(F.when((lang != "fr") | (i > 0), t).alias("text"), F.length(t).alias("n")),
    )
    source = F.struct(F.when(lang != "de", F.col("source")).alias("source"))
    documents = _table(spark, sf_dir, "documents").select(
        "doc_id", lines.alias("lines"), F.when(lang != "es", source).alias("origin")
    )
    good = enforce_schema(documents, schema)
    bad = schema_violations(documents, schema)
    columns = ["doc_id", _size("lines").alias("n_lines"), "origin.source"]
    return good.select(*columns, F.lit("ok").alias("status")).unionByName(
        bad.select(*columns, F.col("reason").alias("status"))
    )


def default_missing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
        ]
    )
    documents = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang", "text")
    benchmark = _table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    return fill_missing(documents, schema).unionByName(fill_missing(benchmark, schema))


def safe_parse_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Error events have lost the end of their properties.
    cut = F.expr("CASE WHEN event_type = 'error' THEN left(props, length(props) - 1) ELSE props END")
    events = _table(spark, sf_dir, "events").select("event_id", cut.alias("props"))
    parsed = events.withColumn("document", json_or_null(F.col("props")))
    return parsed.select(
        "event_id",
        field_or_null(F.col("document"), "$.k", "bigint").cast("string").alias("k"),
        json_error(F.col("props"), F.col("document")).alias("error"),
    )


def safe_parse_fields_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value or a reason for every field: purchases have lost `k`, and clicks have a word in its place."""
    props = F.col("props")
    changed = (
        F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)"))
        .when(F.col("event_type") == "purchase", F.regexp_replace(props, '"k"', '"other"'))
        .when(F.col("event_type") == "click", F.regexp_replace(props, r"(\d+)", r'"no $1"'))
        .otherwise(props)
    )
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("other", T.LongType())])
    parsed = _table(spark, sf_dir, "events").select("event_id", fields_or_reasons(changed, schema).alias("f"))
    return parsed.select(
        "event_id",
        *[F.col(f"f.{n}.{x}").alias(f"{n}_{x}") for n in ("k", "other") for x in ("value", "reason")],
    )


def _record_columns() -> list[Column | str]:
    token_counts = F.transform("sentences", lambda s: F.size(s["token"]))
    all_tokens = F.flatten(F.transform("sentences", lambda s: s["token"]))
    return [
        "id",
        _joined("tags").alias("tags"),
        _size("sentences").alias("n_sentences"),
        F.aggregate(token_counts, F.lit(0).cast("bigint"), lambda a, n: a + n).alias("n_tokens"),
        _joined("sentences.text").alias("texts"),
        _joined(all_tokens).alias("tokens"),
    ]


def _round_trip(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    path = shared_path(spark, "records")
    write_records(_nested_documents(spark, sf_dir), path, fmt, COMPRESSION if fmt == "json" else None)
    return read_records(spark, path, fmt=fmt)


def json_round_trip_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "json").select(*_record_columns())


def parquet_round_trip_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "parquet").select(*_record_columns())


def read_back_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON drops the NULL `dep`; the declared schema brings the field back."""
    records = enforce_schema(_round_trip(spark, sf_dir, "json"))
    return flatten_sentences(records).filter("sent_pos IS NOT NULL").select(
        "id",
        F.col("sent_pos").cast("bigint").alias("sent_pos"),
        _joined("lemma").alias("lemma"),
        F.col("dep").isNull().alias("dep_is_null"),
    )


def read_back_corrupt_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of a JSON file with its status: French ones are cut, German ones have a field more."""
    schema = T.StructType([T.StructField("id", T.StringType(), False), T.StructField("doc_id", T.LongType())])
    whole = F.to_json(
        F.struct(
            F.when(F.col("lang") != "es", F.col("source")).alias("id"),
            "doc_id",
            F.when(F.col("lang") == "de", "red").alias("color"),
        )
    )
    line = F.when(F.col("lang") == "fr", F.regexp_replace(whole, r"\}\z", "")).otherwise(whole)
    path = shared_path(spark, "corrupt")
    _table(spark, sf_dir, "documents").select(line).write.text(path)
    return read_checked(spark, path, schema).select(
        F.regexp_extract("line", r'"doc_id":(\d+)', 1).cast("bigint").alias("doc_id"),
        F.coalesce("reason", F.lit("ok")).alias("status"),
    )


def read_back_unknown_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unknown fields at any depth, by their paths: French sentences have one, German records two."""
    sentence = T.StructType([T.StructField("text", T.StringType())])
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("sentences", T.ArrayType(sentence))]
    )
    lang = F.col("lang")
    sentences = F.transform(
        text_lines(F.col("text")),
        lambda t: F.struct(t.alias("text"), F.when(lang.isin("fr", "de"), F.length(t)).alias("zzz")),
    )
    line = F.to_json(F.struct("doc_id", sentences.alias("sentences"), F.when(lang == "de", "red").alias("color")))
    path = shared_path(spark, "unknown")
    _table(spark, sf_dir, "documents").select(line).write.text(path)
    return read_checked(spark, path, schema).select(
        "doc_id", _size("sentences").alias("n_sentences"), F.coalesce("reason", F.lit("ok")).alias("status")
    )


def ingest_parts_bad_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of which one line is not UTF-8 are rejected with all of their parts, at a low limit."""
    dest = shared_path(spark, "ingested")
    ingest(spark, _edge_corpus(spark, sf_dir), dest, max_block_bytes=PART_BYTES, compression=COMPRESSION)
    good = read_records(spark, dest, STORED_SCHEMA).select(
        "id", F.lit("ok").alias("status"), "part", F.col("sentences.text").alias("texts")
    )
    bad = spark.read.schema(QUARANTINE_SCHEMA).json(f"{dest}.quarantine")
    block = F.struct(F.coalesce("part", F.lit(-1)).alias("part"), F.col("lines").alias("texts"))
    bad = bad.groupBy("path", "block_no", "reason").agg(F.flatten(F.sort_array(F.collect_list(block))["texts"]).alias("lines"))
    # The id, the tags and the line at fault stand around the sentences.
    bad = bad.select(
        F.col("lines")[0].alias("id"),
        F.col("reason").alias("status"),
        F.lit(None).cast("long").alias("part"),
        F.slice("lines", F.lit(3), F.size("lines") - 3).alias("texts"),
    )
    part = F.struct(F.coalesce("part", F.lit(-1)).alias("part"), "texts")
    texts = F.flatten(F.sort_array(F.collect_list(part))["texts"])
    joined = good.unionByName(bad).groupBy("id", "status").agg(texts.alias("texts"))
    return joined.select("id", "status", _size("texts").alias("n_sentences"), _joined("texts").alias("texts"))


def ingest_parts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records put together again from the rows of a run with a low limit."""
    dest = shared_path(spark, "ingested")
    ingest(spark, _text_corpus(spark, sf_dir), dest, max_block_bytes=PART_BYTES, compression=COMPRESSION)
    rows = read_records(spark, dest, STORED_SCHEMA)
    part = F.struct(F.coalesce("part", F.lit(-1)).alias("part"), F.col("sentences.text").alias("texts"))
    texts = F.flatten(F.sort_array(F.collect_list(part))["texts"])
    records = rows.groupBy("id", "tags").agg(texts.alias("texts"), F.count("part").alias("n_parts"))
    return records.select(
        "id",
        _joined("tags").alias("tags"),
        _size("texts").alias("n_sentences"),
        _joined("texts").alias("texts"),
        (F.col("n_parts") == 0).alias("whole"),
    )


def _ingested(spark: SparkSession, src: str, **options: object) -> DataFrame:
    dest = shared_path(spark, "ingested")
    ingest(spark, src, dest, compression=COMPRESSION, **options)
    return read_records(spark, dest)


def ingest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, _text_corpus(spark, sf_dir)).select(*_record_columns())


def ingest_lexicon_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _ingested(
        spark, _text_corpus(spark, sf_dir), lexicon=_saved_lexicon(spark, sf_dir)
    )
    lemmas = F.flatten(F.transform("sentences", lambda s: s["lemma"]))
    return records.select(*_record_columns(), _joined(lemmas).alias("lemmas"))


def ingest_plugin_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plug-in annotator fills `dep`, on more tasks than the grouping shuffle has."""
    records = _ingested(
        spark, _text_corpus(spark, sf_dir), annotator=capital_annotator(), partitions=16
    )
    deps = F.flatten(F.transform("sentences", lambda s: s["dep"]))
    tags = F.flatten(F.transform("sentences", lambda s: s["pos2"]))
    return records.select(*_record_columns(), _joined(tags).alias("pos2"), _joined(deps).alias("deps"))


def ingest_ragged_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and quarantined blocks of one run, together."""
    dest = shared_path(spark, "ingested")
    ingest(spark, _ragged_corpus(spark, sf_dir), dest, quarantine=f"{dest}-rejected", compression=COMPRESSION)
    good = read_records(spark, dest).select("id", F.lit("ok").alias("status"))
    bad = spark.read.schema("reason string, lines array<string>").json(f"{dest}-rejected")
    return good.unionByName(bad.select(F.col("lines")[0].alias("id"), F.col("reason").alias("status")))


QUERIES: dict[str, Query] = {
    "scan_lines": scan_lines_query,
    "line_numbers": line_numbers_query,
    "scoped_settings": scoped_settings_query,
    "split_lines": split_lines_query,
    "distribute": distribute_query,
    "group_blocks": group_blocks_query,
    "group_blocks_parts": group_blocks_parts_query,
    "group_blocks_edges": group_blocks_edges_query,
    "parse_blocks": parse_blocks_query,
    "quarantine": quarantine_query,
    "split_tags": split_tags_query,
    "tokens": tokens_query,
    "build_lexicon": build_lexicon_query,
    "lemmas": lemmas_query,
    "pos_tags": pos_tags_query,
    "annotate": annotate_query,
    "annotate_shape": annotate_shape_query,
    "annotate_plugin": annotate_plugin_query,
    "flatten_sentences": flatten_sentences_query,
    "flatten_tokens": flatten_tokens_query,
    "nest_sentences": nest_sentences_query,
    "nest_parts": nest_parts_query,
    "nest_under_parents": nest_under_parents_query,
    "enforce_schema": enforce_schema_query,
    "enforce_nested": enforce_nested_query,
    "default_missing": default_missing_query,
    "safe_parse": safe_parse_query,
    "safe_parse_fields": safe_parse_fields_query,
    "json_round_trip": json_round_trip_query,
    "parquet_round_trip": parquet_round_trip_query,
    "read_back": read_back_query,
    "read_back_corrupt": read_back_corrupt_query,
    "read_back_unknown": read_back_unknown_query,
    "ingest": ingest_query,
    "ingest_parts": ingest_parts_query,
    "ingest_parts_bad": ingest_parts_bad_query,
    "ingest_lexicon": ingest_lexicon_query,
    "ingest_plugin": ingest_plugin_query,
    "ingest_ragged": ingest_ragged_query,
}
