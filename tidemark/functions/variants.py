"""Access to VARIANT values: paths, kinds and truth."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A step is an object key, or EACH for "every element of the array here".
EACH = None


def parse(text: Column) -> Column:
    return F.parse_json(text)


def get(value: Column, keys: tuple[str, ...], dtype: str = "variant") -> Column:
    """Value below ``value`` at an object path; NULL when it is absent or of another type."""
    path = "$"
    for index, key in enumerate(keys):
        if "'" not in key:
            path += f"['{key}']"
        elif '"' not in key:
            path += f'["{key}"]'
        else:
            # The path syntax cannot quote this key; a map lookup can.
            parent = F.try_variant_get(value, path, "map<string,variant>")
            return get(F.try_element_at(parent, F.lit(key)), keys[index + 1:], dtype)
    return F.try_variant_get(value, path, dtype)


def values_at(value: Column, steps: tuple) -> Column:
    """All values at a path as one array, in document order."""
    if EACH not in steps:
        return F.array_compact(F.array(get(value, steps)))
    cut = steps.index(EACH)
    elements = get(value, steps[:cut], "array<variant>")
    rest = steps[cut + 1:]
    if rest:
        elements = F.flatten(F.transform(elements, lambda item: values_at(item, rest)))
    return F.coalesce(elements, F.array().cast("array<variant>"))


def is_object(value: Column) -> Column:
    return get(value, (), "map<string,variant>").isNotNull()


def is_array(value: Column) -> Column:
    return get(value, (), "array<variant>").isNotNull()


def kind_of(schema: Column) -> Column:
    """Kind for the schema text of a variant: ``object``, ``array``, ``null``, ``boolean``,
    ``bigint``, ``double`` or ``text``; NULL when there is no value.

    A whole number beyond 64 bits is ``bigint`` too, so that reading it fails instead of
    losing digits.
    """
    return (
        F.when(schema == "STRING", "text")
        .when(schema == "BIGINT", "bigint")
        .when(schema == "BOOLEAN", "boolean")
        .when(schema == "VOID", "null")
        .when(schema.startswith("OBJECT<"), "object")
        .when(schema.startswith("ARRAY<"), "array")
        .when(schema.rlike(r"^DECIMAL\((19|2\d|3\d),0\)$"), "bigint")
        .when(schema.isNotNull(), "double")
    )


def kind(value: Column) -> Column:
    """:func:`kind_of` a value; for hot paths select the schema text as a column first."""
    return kind_of(F.schema_of_variant(value))


def truthy(value: Column) -> Column:
    """False for no value, null, false, zero, '' and empty objects and arrays."""
    schema = F.schema_of_variant(value)
    return F.coalesce(
        F.when(schema.isNull() | (schema == "VOID") | (schema == "OBJECT<>"), F.lit(False))
        .when(schema.startswith("OBJECT<"), F.lit(True))
        .when(schema.startswith("ARRAY<"), F.size(get(value, (), "array<variant>")) > 0)
        .when(schema == "BOOLEAN", get(value, (), "boolean"))
        .when(schema == "STRING", get(value, (), "string") != "")
        .otherwise(get(value, (), "double") != 0),
        F.lit(False),
    )


def integer(value: Column) -> Column:
    """Whole number of a value; booleans count as 0 and 1, other types give NULL."""
    value_kind = kind(value)
    return F.when(value_kind == "bigint", get(value, (), "bigint")).when(
        value_kind == "boolean", get(value, (), "boolean").cast("bigint")
    )


def text_of(value: Column) -> Column:
    """The string a value is, NULL for every other type."""
    return F.when(F.schema_of_variant(value) == "STRING", get(value, (), "string"))
