"""Identifier rules, as plain functions for names and as expressions for columns of names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

IDENTIFIER_LIMIT = 63
SLUG_LIMIT = 64
DIMENSION_PREFIX = "dim_"

# Columns every staged row carries, and those a dimension adds to them.
TECHNICAL_COLUMNS = ("_row_id", "_source_batch_id", "_parent_id", "_parent_key", "_row_index")
DIMENSION_COLUMNS = (
    "_sk", "_business_key", "valid_from", "valid_to", "is_current", "_content_hash",
)
# Names that would land on the batch ledger or on the fixed master dimensions.
RESERVED_TABLES = ("raw_batches", "user", "department")
RESERVED_COLUMNS = ("valid_from", "valid_to", "is_current")


def identifier(name: str) -> str:
    """Table or column name for an arbitrary string, never cut: long keys stay apart."""
    text = re.sub(r"[^a-z0-9]+", "_", str(name).lower()).strip("_") or "col"
    if text[0].isdigit():
        text = "c_" + text
    return text


def identifier_column(name: Column) -> Column:
    """:func:`identifier` over a column of names, cut to the length that databases allow."""
    text = F.btrim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), F.lit("_"))
    text = (
        F.when(text == "", "col")
        .when(text.rlike("^[0-9]"), F.concat(F.lit("c_"), text))
        .otherwise(text)
    )
    return F.left(text, F.lit(IDENTIFIER_LIMIT))


def source_slug(name: Column) -> Column:
    """File-name part of a source: letters, digits and ``-`` of any script are kept."""
    text = F.btrim(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}-]", "_"), F.lit("_"))
    return F.left(F.when(text == "", "source").otherwise(text), F.lit(SLUG_LIMIT))


def dimension_name(table: str) -> str:
    return DIMENSION_PREFIX + table


def mart_name(dimension: str) -> str:
    """Published name of a dimension; empty when nothing is left after the prefix."""
    name = dimension[len(DIMENSION_PREFIX):]
    return "t_" + name if name[:1].isdigit() else name


def check_root_table(table: str) -> None:
    if table in RESERVED_TABLES:
        raise ValueError(f"source name resolves to the reserved table {table!r}")


def check_columns(table: str, columns: list[str]) -> None:
    taken = sorted(set(columns) & set(RESERVED_COLUMNS))
    if taken:
        raise ValueError(f"table {table!r} has column(s) reserved for history: {', '.join(taken)}")
