"""Sentence annotation: text -> five parallel token-level arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from glossmill.functions.text import shape_lemma, shape_pos1, shape_pos2, tokens
from glossmill.schemas import SENTENCE_SCHEMA, TOKEN_FIELDS

ERRORS_TYPE = T.ArrayType(
    T.StructType([T.StructField("sent_pos", T.IntegerType()), T.StructField("error", T.StringType())])
)

# Called with sentences, returns one dict of token arrays per sentence.
Annotator = Callable[[list[str]], list[dict]]


# A lexicon of more than this, measured, is joined and not sent to every task.
MAX_LOOKUP_BYTES = 64 * 1024 * 1024
# Python tasks work on pieces of a batch of about this size, as what they make of one takes many times as much.
PIECE_BYTES = 4 * 1024 * 1024


def annotate(
    records: DataFrame,
    lexicon: DataFrame | None = None,
    keys: Sequence[str] = ("path", "block_no"),
    max_lookup_bytes: int = MAX_LOOKUP_BYTES,
) -> DataFrame:
    """Replace `texts` (array of sentences) by `sentences` (array of annotated structs).

    Without a lexicon the annotation is a projection: no join and no shuffle.
    With one (`form, lemma, pos1, pos2`, one row per form), tokens take its
    lemma and tags, and the shape rules fill in for unknown forms. The text of the lexicon is
    measured first, by a job of its own, and where it is too large, that of its rows that do not just
    repeat the shape rules. Up to `max_lookup_bytes` of either, records stay where they are and
    the forms of many are looked up at once. Beyond that, tokens become rows that are
    joined with it; `keys` must then identify a record. `dep` is NULL either way; only a
    plug-in of `annotate_with` fills it.
    """
    if lexicon is None:
        return records.withColumn("sentences", shape_sentences(F.col("texts"))).drop("texts")
    if lexicon_bytes(lexicon) <= max_lookup_bytes:
        return _annotate_by_lookup(records, lexicon)
    telling = _beyond_the_shape_rules(lexicon)
    if lexicon_bytes(telling) <= max_lookup_bytes:
        return _annotate_by_lookup(records, telling)
    return _annotate_from_lexicon(records, lexicon, list(keys))


def lexicon_bytes(lexicon: DataFrame) -> int:
    """Bytes of the strings of a lexicon, and eight more for each."""
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) + 8 for c in ("form", "lemma", "pos1", "pos2")]
    return lexicon.agg(F.sum(sum(sizes[1:], sizes[0]).cast("long"))).first()[0] or 0


def _beyond_the_shape_rules(lexicon: DataFrame) -> DataFrame:
    """The rows without which some token would be annotated otherwise.

    The shape rules look at the first character of a token, and give a character the tags of
    its lower case (tested for all of them), so they can be asked about the form.
    """
    form = F.col("form")
    rules = {"lemma": form, "pos1": shape_pos1(form), "pos2": shape_pos2(form)}
    tells = reduce(or_, (F.coalesce(F.col(name), rule) != rule for name, rule in rules.items()))
    return lexicon.filter(form.isNotNull() & tells)


def _annotate_by_lookup(records: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Looks the forms of many records up in one call; no row per token and no shuffle."""
    names = ("lemma", "pos1", "pos2")
    table = lexicon.select("form", *names).filter("form IS NOT NULL").toArrow().combine_chunks()
    shared = records.sparkSession.sparkContext.broadcast(table)
    readings = T.StructType([T.StructField(n, T.ArrayType(T.ArrayType(T.StringType()))) for n in names])
    pieces = _pieces_of(PIECE_BYTES)

    def look_up(batches):  # type: ignore[no-untyped-def]
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def lists(like: pa.Array, values: pa.Array) -> pa.Array:
            """`values` in lists as long as those of `like`."""
            lengths = pc.fill_null(pc.list_value_length(like), 0).to_numpy(zero_copy_only=False)
            offsets = pa.array(np.append(0, np.cumsum(lengths)), pa.int32())
            return pa.ListArray.from_arrays(offsets, values, mask=pc.is_null(like))

        known = {n: shared.value[n].combine_chunks() for n in ("form", *names)}
        for forms in (piece for whole in batches for piece in pieces(whole)):
            sentences = forms.flatten()
            flat = sentences.flatten()
            places = pc.index_in(flat, known["form"])
            found = [known[n].take(places) for n in names]
            # The lemma of an unknown form is the form.
            found[0] = pc.coalesce(found[0], flat)
            yield pa.StructArray.from_arrays([lists(forms, lists(sentences, x)) for x in found], names)

    look_up.__annotations__ = _arrow_types()
    looked_up = F.arrow_udf(look_up, readings)
    tokenised = records.withColumn("_token", F.transform("texts", tokens))
    lowered = F.transform("_token", lambda ts: F.transform(ts, shape_lemma))
    found = tokenised.withColumn("_found", looked_up(lowered))

    def filled(name: str, at: Column, token: Column, shape: Callable[[Column], Column]) -> Column:
        known = F.get(F.col(f"_found.{name}"), at)
        return F.zip_with(token, known, lambda t, k: F.coalesce(k, shape(t))).alias(name)

    def sentence(text: Column, at: Column) -> Column:
        token = F.get("_token", at)
        return F.struct(
            text.alias("text"),
            token.alias("token"),
            F.get(F.col("_found.lemma"), at).alias("lemma"),
            filled("pos1", at, token, shape_pos1),
            filled("pos2", at, token, shape_pos2),
            F.lit(None).cast("array<string>").alias("dep"),
        )

    return found.withColumn("sentences", F.transform("texts", sentence)).drop("texts", "_token", "_found")


def _arrow_types() -> dict[str, type]:
    import pyarrow as pa

    return {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}


def _pieces_of(most: int) -> Callable[[object], Iterator]:
    """A function that cuts an Arrow batch or array into runs of rows of at most `most` bytes, or of one row.

    It is a closure, so tasks get it by value and need not import this package.
    """

    def pieces(rows):  # type: ignore[no-untyped-def]
        if len(rows) < 2 or rows.nbytes <= most:
            yield rows
        else:
            half = len(rows) // 2
            yield from pieces(rows.slice(0, half))
            yield from pieces(rows.slice(half))

    return pieces


def shape_sentences(texts: Column) -> Column:
    """Array of sentence texts -> array of sentence structs, by the shape rules."""
    tokenised = F.transform(texts, lambda t: F.struct(t.alias("text"), tokens(t).alias("token")))
    return F.transform(
        tokenised,
        lambda s: F.struct(
            s["text"].alias("text"),
            s["token"].alias("token"),
            F.transform(s["token"], shape_lemma).alias("lemma"),
            F.transform(s["token"], shape_pos1).alias("pos1"),
            F.transform(s["token"], shape_pos2).alias("pos2"),
            F.lit(None).cast("array<string>").alias("dep"),
        ),
    )


def tag_tokens(flat_tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Add `lemma`, `pos1` and `pos2` to rows that have a `token`.

    There is no broadcast hint: Catalyst broadcasts the lexicon while it is
    below spark.sql.autoBroadcastJoinThreshold (a lexicon read from a table has
    its file size to go by), and beyond that joins by sort-merge, where adaptive
    execution splits the partitions of frequent forms.
    """
    known = lexicon.select(
        F.col("form").alias("_form"),
        F.col("lemma").alias("_lemma"),
        F.col("pos1").alias("_pos1"),
        F.col("pos2").alias("_pos2"),
    )
    token = F.col("token")
    return (
        flat_tokens.join(known, F.lower(token) == F.col("_form"), "left")
        .withColumn("lemma", F.coalesce("_lemma", shape_lemma(token)))
        .withColumn("pos1", F.coalesce("_pos1", shape_pos1(token)))
        .withColumn("pos2", F.coalesce("_pos2", shape_pos2(token)))
        .drop("_form", "_lemma", "_pos1", "_pos2")
    )


def _annotate_from_lexicon(records: DataFrame, lexicon: DataFrame, keys: list[str]) -> DataFrame:
    carried = [c for c in records.columns if c not in (*keys, "texts")]
    records = records.withColumn("_none", F.col("texts").isNull())
    # Whole records are placed by key before they are exploded. A broadcast join
    # keeps that placement, so both regroupings below need no shuffle, and what
    # moves is sentence text and not token rows. The second repartition matters
    # only after a sort-merge join; otherwise the planner removes it.
    sentences = records.repartition(*keys).select(
        *keys,
        F.struct(*carried, "_none").alias("record"),
        F.posexplode_outer("texts").alias("sent_pos", "text"),
    )
    # The record travels on its first sentence and a text on its first token.
    sentences = sentences.withColumn("record", F.when(F.coalesce("sent_pos", F.lit(0)) == 0, F.col("record")))
    rows = sentences.select("*", F.posexplode_outer(tokens(F.col("text"))).alias("tok_pos", "token"))
    first = F.coalesce("tok_pos", F.lit(0)) == 0
    rows = rows.withColumn("record", F.when(first, F.col("record"))).withColumn("text", F.when(first, F.col("text")))

    tagged = tag_tokens(rows, lexicon).repartition(*keys)
    entry = F.when(F.col("token").isNotNull(), F.struct("tok_pos", "token", "lemma", "pos1", "pos2"))
    by_sentence = tagged.groupBy(*keys, "sent_pos").agg(
        F.first("record", ignorenulls=True).alias("record"),
        F.first("text", ignorenulls=True).alias("text"),
        F.sort_array(F.collect_list(entry)).alias("tok"),
    )
    by_record = by_sentence.groupBy(*keys).agg(
        F.first("record", ignorenulls=True).alias("record"),
        F.sort_array(
            F.collect_list(F.when(F.col("sent_pos").isNotNull(), F.struct("sent_pos", "text", "tok")))
        ).alias("sent"),
    )
    nested = F.transform(
        "sent",
        lambda s: F.struct(
            s["text"].alias("text"),
            *[s["tok"][name].alias(name) for name in ("token", "lemma", "pos1", "pos2")],
            F.lit(None).cast("array<string>").alias("dep"),
        ),
    )
    sentences = F.when(~F.col("record._none"), nested).alias("sentences")
    return by_record.select(*keys, *[F.col(f"record.{c}") for c in carried], sentences)


def annotate_with(
    records: DataFrame, factory: Callable[[], Annotator], batch_size: int = 256
) -> DataFrame:
    """Replace `texts` by `sentences` from a plug-in annotator, in Arrow batches.

    `factory` runs once per task and returns the annotator, so a model is loaded
    on executors only. The annotator gets up to `batch_size` sentences and
    returns one dict each with the keys token, lemma, pos1, pos2 and dep; a key
    left out gives a NULL array. A sentence that makes it fail, or whose arrays
    differ in size, keeps its text, has NULL arrays, and is listed in the column
    `_errors`, which is NULL for a clean record. A task holds one batch of Spark's and the
    arrays of about `PIECE_BYTES` of it, or of one record if that has more.
    """
    pieces = _pieces_of(PIECE_BYTES)
    kept = [f for f in records.schema.fields if f.name != "texts"]
    out_schema = T.StructType(
        kept
        + [
            T.StructField("sentences", T.ArrayType(SENTENCE_SCHEMA)),
            T.StructField("_errors", ERRORS_TYPE),
        ]
    )
    kept_names = [f.name for f in kept]
    fields = TOKEN_FIELDS

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        annotator = factory()

        def checked(result: dict) -> dict:
            if len({len(result[f]) for f in fields if result.get(f) is not None}) > 1:
                raise ValueError("token arrays differ in size")
            return result

        def one(text: str) -> tuple[dict, str | None]:
            try:
                (result,) = annotator([text])
                return checked(result), None
            except Exception as e:
                return {}, f"{type(e).__name__}: {e}"

        def many(texts: list[str]) -> list[tuple[dict, str | None]]:
            try:
                results = [checked(r) for r in annotator(texts)]
                if len(results) == len(texts):
                    return [(r, None) for r in results]
            except Exception:
                pass
            if len(texts) <= 1:
                return [one(t) for t in texts]
            # Find the sentences at fault, by halves: one of them costs a few calls.
            half = len(texts) // 2
            return many(texts[:half]) + many(texts[half:])

        strings = pa.list_(pa.string())
        for batch in (piece for whole in batches for piece in pieces(whole)):
            lists = batch.column(batch.schema.get_field_index("texts"))
            texts = lists.flatten()
            parts, messages = [], []
            for start in range(0, len(texts), batch_size):
                part = texts.slice(start, batch_size)
                done = many(part.to_pylist())
                # Into Arrow at once: Python strings take many times the memory.
                arrays = [pa.array([r.get(f) for r, _ in done], type=strings) for f in fields]
                parts.append(pa.StructArray.from_arrays([part, *arrays], names=["text", *fields]))
                messages += [error for _, error in done]

            offsets, errors = [0], []
            for length in pc.fill_null(pc.list_value_length(lists), 0).to_pylist():
                begin = offsets[-1]
                offsets.append(begin + length)
                found = [
                    {"sent_pos": i, "error": error}
                    for i, error in enumerate(messages[begin : begin + length])
                    if error is not None
                ]
                errors.append(found or None)
            struct_type = pa.struct([("text", pa.string()), *[(f, strings) for f in fields]])
            values = pa.concat_arrays(parts) if parts else pa.array([], type=struct_type)
            sentences = pa.ListArray.from_arrays(
                pa.array(offsets, type=pa.int32()), values, mask=pc.is_null(lists)
            )
            error_type = pa.list_(pa.struct([("sent_pos", pa.int32()), ("error", pa.string())]))
            columns = [batch.column(batch.schema.get_field_index(n)) for n in kept_names]
            yield pa.RecordBatch.from_arrays(
                columns + [sentences, pa.array(errors, type=error_type)],
                names=[*kept_names, "sentences", "_errors"],
            )

    return records.mapInArrow(run, out_schema)
