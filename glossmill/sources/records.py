"""Source and sink of nested records."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, functions as F, types as T

from glossmill.operators.typed import violation
from glossmill.schemas import RECORD_SCHEMA, STORED_SCHEMA

# A string may be as long as a row; the reader's own limit is 20 million characters.
_READ_OPTIONS = {"maxStringLen": str(2**31 - 1)}


def write_records(df: DataFrame, dest: str, fmt: str = "json", compression: str | None = None) -> None:
    """Overwrite `dest` with a directory of JSON lines, or of another file format.

    `compression` is a codec of the format (default: the format's own, which is none for JSON). Annotated
    records as JSON are about six times their text, and as much as the text with `gzip`. Such a file is
    read by one task, so there should be as many as the readers have cores: one per task that writes.
    """
    writer = df.write.mode("overwrite").format(fmt)
    with_codec(writer, compression).save(dest)


def with_codec(writer: DataFrameWriter, compression: str | None) -> DataFrameWriter:
    return writer if compression is None else writer.option("compression", compression)


@contextmanager
def staged(spark: SparkSession, targets: Sequence[str]) -> Iterator[list[str]]:
    """Folders to write to, one per target, which replace the targets together or not at all.

    The staged folders lie next to their targets. When the block ends, a marker next to the
    first target says what is about to happen, the old folders are moved aside, the
    new ones moved in, and the marker and the old folders deleted. If the block or a move fails, the old folders are
    put back; if the driver is lost in between, `recover` puts them back. A move is one
    operation of the file system where that has one, such as HDFS; an object store copies.
    """
    targets = [t.rstrip("/") for t in targets]
    recover(spark, targets[0])
    run = uuid.uuid4().hex
    stages = [f"{t}.staged-{run}" for t in targets]
    moves = [(stage, t, f"{t}.old-{run}") for stage, t in zip(stages, targets)]
    files = _files(spark, targets[0])
    try:
        yield stages
        for stage in stages:
            files.mkdirs(stage)
        files.write(_marker(targets[0]), json.dumps(moves))
        for _, target, old in moves:
            if files.exists(target):
                files.move(target, old)
        for stage, target, _ in moves:
            files.move(stage, target)
        # From here on the new folders are the right ones.
        files.delete(_marker(targets[0]))
    except BaseException:
        recover(spark, targets[0])
        for stage in stages:
            files.delete(stage)
            files.delete(f"{stage}.both")
        raise
    for _, _, old in moves:
        files.delete(old)


def split_outcomes(spark: SparkSession, src: str, column: str, places: Mapping[str, str]) -> None:
    """Move the folders of a write partitioned by `column` to one place per value; one without rows is left empty."""
    files = _files(spark, src)
    for value, place in places.items():
        part = f"{src}/{column}={value}"
        files.move(part, place) if files.exists(part) else files.mkdirs(place)
        files.write(f"{place}/_SUCCESS", "")
    files.delete(src)


def recover(spark: SparkSession, target: str) -> bool:
    """Put back what an interrupted `staged` left half replaced; whether there was such a thing."""
    marker = _marker(target.rstrip("/"))
    files = _files(spark, target)
    if not files.exists(marker):
        return False
    text = files.read(marker)
    # A marker that is cut off was never acted on.
    for stage, place, old in json.loads(text) if text.endswith("]]") else []:
        # The staged folder is there until it was moved in.
        if files.exists(place) and not files.exists(stage):
            files.move(place, stage)
        if files.exists(old):
            files.move(old, place)
        files.delete(stage)
    files.delete(marker)
    return True


def _marker(target: str) -> str:
    folder, _, name = target.rpartition("/")
    return f"{folder}/_{name}.replacing" if folder else f"_{name}.replacing"


class _files:
    """The few operations on folders that `staged` needs, on whatever store the path names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._io = spark._jvm.org.apache.commons.io.IOUtils

    def _at(self, path: str) -> tuple:
        place = self._path(path)
        return place.getFileSystem(self._conf), place

    def exists(self, path: str) -> bool:
        store, place = self._at(path)
        return store.exists(place)

    def mkdirs(self, path: str) -> None:
        store, place = self._at(path)
        store.mkdirs(place)

    def move(self, path: str, to: str) -> None:
        store, place = self._at(path)
        if not store.rename(place, self._path(to)):
            raise OSError(f"cannot move {path} to {to}")

    def delete(self, path: str) -> None:
        store, place = self._at(path)
        store.delete(place, True)

    def write(self, path: str, text: str) -> None:
        store, place = self._at(path)
        stream = store.create(place, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def read(self, path: str) -> str:
        store, place = self._at(path)
        stream = store.open(place)
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()


def read_records(
    spark: SparkSession, src: str, schema: T.StructType = RECORD_SCHEMA, fmt: str = "json"
) -> DataFrame:
    """Read nested records with a declared schema.

    The schema is never inferred: JSON leaves NULL fields out, so an inferred
    one loses a field that is NULL in every row and reorders the others. Readers
    make every column nullable; `enforce_schema` checks the values.
    """
    return spark.read.schema(schema).options(**_READ_OPTIONS).format(fmt).load(src)


def read_checked(spark: SparkSession, src: str, schema: T.StructType = STORED_SCHEMA) -> DataFrame:
    """JSON lines with a `reason` next to the fields of `schema`, and the raw `line`; no line is lost.

    `reason` is NULL for a good record, else `malformed`; `unknown_fields: ...` with the paths of
    fields that `schema` does not have, at any depth; or the required field that is NULL (see `violation`).
    """
    corrupt = "_malformed"
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
    parsed = F.from_json(
        "line", nullable.add(corrupt, T.StringType()), {**_READ_OPTIONS, "columnNameOfCorruptRecord": corrupt}
    )
    top = F.array_except(F.json_object_keys("line"), F.array(*[F.lit(n) for n in schema.names]))
    deeper = _unknown_in_fields(F.col("line"), schema, "")
    unknown = F.array_distinct(F.concat(top, *deeper)) if deeper else top
    reason = (
        F.when(F.col(corrupt).isNotNull() | unknown.isNull(), "malformed")
        .when(F.size(unknown) > 0, F.concat(F.lit("unknown_fields: "), F.array_join(unknown, ", ")))
        .otherwise(violation(schema))
    )
    lines = spark.read.text(src).select(F.col("value").alias("line"))
    rows = lines.withColumn("_parsed", parsed).select("line", "_parsed.*")
    return rows.withColumn("reason", reason).drop(corrupt)


def _unknown_in_fields(document: Column, kind: T.StructType, prefix: str) -> list[Column]:
    """Per field with structs below it, the unknown paths in there; `document` is the JSON text around the fields."""
    nested = [f for f in kind if _has_struct(f.dataType)]
    if not nested:
        return []
    texts = F.from_json(document, T.StructType([T.StructField(f.name, T.StringType()) for f in nested]), _READ_OPTIONS)
    return [_unknown_below(texts.getField(f.name), f.dataType, prefix + f.name) for f in nested]


def _unknown_below(document: Column, kind: T.DataType, path: str) -> Column:
    """Paths of the fields in a JSON text that `kind`, which has a struct, does not have; an empty array if there are none."""
    none = F.array().cast("array<string>")
    if isinstance(kind, T.StructType):
        known = F.array(*[F.lit(n) for n in kind.names]).cast("array<string>")
        extra = F.transform(F.array_except(F.json_object_keys(document), known), lambda k: F.concat(F.lit(f"{path}."), k))
        return F.concat(F.coalesce(extra, none), *_unknown_in_fields(document, kind, f"{path}."))
    if isinstance(kind, T.ArrayType):
        item, items = kind.elementType, F.from_json(document, T.ArrayType(T.StringType()), _READ_OPTIONS)
    else:
        pairs = F.from_json(document, T.MapType(T.StringType(), T.StringType()), _READ_OPTIONS)
        item, items = kind.valueType, F.map_values(pairs)
    per_item = F.transform(items, lambda x: _unknown_below(x, item, path))
    return F.coalesce(F.array_distinct(F.flatten(per_item)), none)


def _has_struct(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_struct(kind.elementType)
    if isinstance(kind, T.MapType):
        return _has_struct(kind.valueType)
    return isinstance(kind, T.StructType)


def read_strict(spark: SparkSession, src: str, schema: T.StructType = STORED_SCHEMA) -> DataFrame:
    """JSON lines of which every one must be a record: the first that is not fails the job, with its reason."""
    checked = read_checked(spark, src, schema)
    bad = F.raise_error(F.concat(F.lit("bad record: "), "reason")).cast("boolean")
    return checked.filter(F.when(F.col("reason").isNull(), F.lit(True)).otherwise(bad)).select(*schema.names)
