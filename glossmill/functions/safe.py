"""Column functions that give NULL where the plain form would fail the job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T


def json_or_null(text: Column) -> Column:
    """A JSON string as a VARIANT, NULL when it does not parse."""
    return F.try_parse_json(text)


def field_or_null(document: Column, path: str, type_name: str) -> Column:
    """A field of a VARIANT, NULL when it is absent or of another type."""
    return F.try_variant_get(document, path, type_name)


def json_error(text: Column, document: Column) -> Column:
    """Why `document`, the result of `json_or_null(text)`, is NULL; NULL when it is not."""
    return F.when(text.isNull(), "null_input").when(document.isNull(), "invalid_json")


def field_error(document: Column, path: str, type_name: str) -> Column:
    """Why `field_or_null` gives NULL for a document that parsed: `absent`, also for a JSON null, or `wrong_type`."""
    found = F.try_variant_get(document, path, "variant")
    return F.when(
        document.isNotNull() & F.try_variant_get(document, path, type_name).isNull(),
        F.when(found.isNull() | F.is_variant_null(found), "absent").otherwise("wrong_type"),
    )


def fields_or_reasons(text: Column, schema: T.StructType) -> Column:
    """Every field of `schema` in a JSON object, as a struct of structs `value, reason`.

    One of the two is NULL. The reason is `null_input`, `invalid_json` or `not_an_object` for the
    whole text, else `absent` (no such key, or JSON null) or `wrong_type`. Types are those
    of `try_variant_get`, which casts where nothing is lost, as from "7" to a number.
    """
    document = json_or_null(text)
    whole = F.coalesce(
        json_error(text, document),
        F.when(F.try_variant_get(document, "$", "map<string,variant>").isNull(), "not_an_object"),
    )
    fields = []
    for field in schema:
        # A path has no escapes, so a name may have one kind of quote.
        quote = '"' if "'" in field.name else "'"
        path, kind = f"$[{quote}{field.name}{quote}]", field.dataType.simpleString()
        value = F.when(whole.isNull(), field_or_null(document, path, kind))
        reason = F.coalesce(whole, field_error(document, path, kind))
        fields.append(F.struct(value.alias("value"), reason.alias("reason")).alias(field.name))
    return F.struct(*fields)
