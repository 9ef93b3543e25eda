"""Schema enforcement on DataFrames."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from glossmill.schemas import RECORD_SCHEMA

_PLACEHOLDERS = {
    T.StringType: "",
    T.BinaryType: b"",
    T.BooleanType: False,
    T.DateType: datetime.date(1970, 1, 1),
    T.TimestampType: datetime.datetime(1970, 1, 1),
}


def _placeholder(kind: T.DataType) -> Column:
    """Any value of a type: coalesce with it is what makes a column non-nullable for the planner."""
    if isinstance(kind, T.StructType):
        return F.struct(
            *[
                (F.lit(None).cast(f.dataType) if f.nullable else _placeholder(f.dataType)).alias(f.name)
                for f in kind
            ]
        )
    if isinstance(kind, T.ArrayType):
        return F.array().cast(kind)
    if isinstance(kind, T.MapType):
        return F.create_map().cast(kind)
    return F.lit(_PLACEHOLDERS[type(kind)] if type(kind) in _PLACEHOLDERS else 0).cast(kind)


def enforce_schema(df: DataFrame, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """The rows that satisfy `schema`, typed as it says, nullability at every depth included.

    Rows with a NULL where the schema requires a value, in a column or inside its structs,
    arrays and maps, are left out; `schema_violations` has them. Unknown fields raise.
    """
    _no_unknown_fields(df, schema)
    good = df.filter(violation(schema, df.schema).isNull())
    typed = {f.name: _typed(F.col(f"`{f.name}`"), f) for f in schema if f.name in df.columns and _requires(f)}
    return fill_missing(good.withColumns(typed) if typed else good, schema)


def schema_violations(df: DataFrame, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """The rows that `enforce_schema` leaves out, with a `reason`."""
    return df.withColumn("reason", violation(schema, df.schema)).filter("reason IS NOT NULL")


def violation(schema: T.StructType, actual: T.StructType | None = None) -> Column:
    """Why a row does not satisfy `schema`, as `null_` and the path of the field; NULL when it does.

    Fields of structs in arrays and maps have the path of the field (`null_sentences.text`), elements
    that must not be NULL end in `[]`. Of several reasons it is the first in schema order. `actual` is
    the schema of the rows, where they may lack fields of `schema`.
    """
    faults = [_fault(f, actual, "", lambda name: F.col(f"`{name}`")) for f in schema]
    known = [fault for fault in faults if fault is not None]
    return F.coalesce(*known) if known else F.lit(None).cast("string")


def _requires(field: T.StructField) -> bool:
    return not field.nullable or _requires_inside(field.dataType)


def _requires_inside(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(map(_requires, kind))
    if isinstance(kind, T.ArrayType):
        return not kind.containsNull or _requires_inside(kind.elementType)
    if isinstance(kind, T.MapType):
        return not kind.valueContainsNull or _requires_inside(kind.valueType)
    return False


def _fault(
    field: T.StructField, actual: T.DataType | None, prefix: str, get: Callable[[str], Column]
) -> Column | None:
    """The reason of one field; None if it can have none."""
    if not _requires(field):
        return None
    path = prefix + field.name
    kind = None
    if isinstance(actual, T.StructType):
        if field.name not in actual.names:
            return None if field.nullable else F.lit(f"null_{path}")
        kind = actual[field.name].dataType
    value = get(field.name)
    inside = _fault_inside(value, field.dataType, kind, path)
    absent = None if field.nullable else F.when(value.isNull(), f"null_{path}")
    both = [c for c in (absent, inside) if c is not None]
    return F.coalesce(*both) if len(both) > 1 else both[0]


def _fault_inside(value: Column, kind: T.DataType, actual: T.DataType | None, path: str) -> Column | None:
    if not _requires_inside(kind):
        return None
    if isinstance(kind, T.StructType):
        faults = [_fault(f, actual, f"{path}.", value.getField) for f in kind]
        return F.when(value.isNotNull(), F.coalesce(*[f for f in faults if f is not None]))
    if isinstance(kind, T.MapType):
        items, item, nulls = F.map_values(value), kind.valueType, kind.valueContainsNull
        actual_item = actual.valueType if isinstance(actual, T.MapType) else None
    else:
        items, item, nulls = value, kind.elementType, kind.containsNull
        actual_item = actual.elementType if isinstance(actual, T.ArrayType) else None

    def of_item(x: Column) -> Column:
        inside = _fault_inside(x, item, actual_item, path)
        found = F.lit(None).cast("string") if inside is None else inside
        return found if nulls else F.when(x.isNull(), f"null_{path}[]").otherwise(found)

    return F.get(F.filter(F.transform(items, of_item), lambda reason: reason.isNotNull()), F.lit(0))


def _typed(value: Column, field: T.StructField) -> Column:
    """The same value in a type that says that it has no NULL where `field` allows none."""
    inside = _typed_inside(value, field.dataType)
    return inside if field.nullable else F.coalesce(inside, _placeholder(field.dataType))


def _typed_inside(value: Column, kind: T.DataType) -> Column:
    if not _requires_inside(kind):
        return value
    if isinstance(kind, T.StructType):
        fields = F.struct(*[_typed(value.getField(f.name), f).alias(f.name) for f in kind])
        return F.when(value.isNotNull(), fields)
    if isinstance(kind, T.ArrayType):
        item = T.StructField("", kind.elementType, kind.containsNull)
        return F.transform(value, lambda x: _typed(x, item))
    item = T.StructField("", kind.valueType, kind.valueContainsNull)
    return F.transform_values(value, lambda _, x: _typed(x, item))


def fill_missing(df: DataFrame, schema: T.StructType = RECORD_SCHEMA) -> DataFrame:
    """Project to `schema`: an absent nullable field is NULL, an unknown one is an error."""
    _no_unknown_fields(df, schema)
    if all(_fits(df.schema[f.name], f) if f.name in df.columns else f.nullable for f in schema):
        return df.select(
            [f.name if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        )
    # Rebuilds every array element by element, so only when a type differs.
    return df.to(schema)


def _fits(actual: T.StructField, expected: T.StructField) -> bool:
    # simpleString leaves out nullability.
    same_type = actual.dataType.simpleString() == expected.dataType.simpleString()
    return same_type and (expected.nullable or not actual.nullable)


def _no_unknown_fields(df: DataFrame, schema: T.StructType) -> None:
    unknown = _unknown_fields(df.schema, schema, "")
    if unknown:
        raise TypeError(f"unexpected fields: {', '.join(unknown)}")


def _unknown_fields(actual: T.DataType, expected: T.DataType, prefix: str) -> list[str]:
    if isinstance(actual, T.ArrayType) and isinstance(expected, T.ArrayType):
        return _unknown_fields(actual.elementType, expected.elementType, prefix)
    if not (isinstance(actual, T.StructType) and isinstance(expected, T.StructType)):
        return []
    names = set(expected.names)
    found = [prefix + f.name for f in actual if f.name not in names]
    for f in actual:
        if f.name in names:
            found += _unknown_fields(f.dataType, expected[f.name].dataType, f"{prefix}{f.name}.")
    return found
