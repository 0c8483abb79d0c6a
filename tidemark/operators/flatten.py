"""Flatten JSON records into a root table and one child table per nested array.

Nested objects become prefixed columns of the same row, arrays become child tables whose
rows point at their parent. Input is ``(root_index BIGINT, rec VARIANT)``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names
from ..functions.values import double_text, json_string, uuid_text
from ..functions.variants import EACH, get, is_array, is_object, kind, values_at
from .shape import Shape, discover

SPARK_TYPES = {
    "boolean": T.BooleanType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "text": T.StringType(),
}
# Column types by table, in column order.
Types = dict[str, dict[str, str]]

#: Schema of whole numbers beyond 64 bits.
BEYOND = r"^DECIMAL\((19|2\d|3\d),0\)$"

_TRUE = ("t", "true", "y", "yes", "on", "1")
_FALSE = ("f", "false", "n", "no", "off", "0")


@dataclass(frozen=True)
class Cell:
    """A path that feeds a column.

    ``holds`` is False where only nulls can be cells, ``mixed`` is True where structure was
    seen too, ``text`` where every value is text or null.
    """

    path: tuple
    holds: bool
    mixed: bool
    text: bool = False

    def of(self, value: Column) -> Column:
        return get(value, self.path) if self.path else value

    def schema(self, value: Column) -> Column:
        """Schema text of the cell in ``value``, NULL when it is structure or not there."""
        found = self.of(value)
        if not self.holds:
            return F.when(F.is_variant_null(found), "VOID")
        if not self.mixed:
            return F.schema_of_variant(found)
        if self.path:
            return F.when(~(is_object(found) | is_array(found)), F.schema_of_variant(found))
        # An element that is an array is a cell: it is kept as its JSON text.
        return F.when(is_array(found), "STRING").when(~is_object(found), F.schema_of_variant(found))


def _column_type(schema: str) -> str:
    """Column type for the schema text of its first value."""
    if schema in ("STRING", "VOID"):
        return "text"
    if schema in ("BIGINT", "BOOLEAN"):
        return schema.lower()
    # A whole number beyond 64 bits: storing it will fail instead of losing digits.
    return "bigint" if re.fullmatch(BEYOND, schema) else "double"


@dataclass
class Feed:
    """One array path: where it lies below the record and which cells feed each column."""

    table: str
    steps: tuple
    parent: "Feed | None"
    columns: dict[str, list[Cell]]

    @property
    def array_keys(self) -> tuple:
        """Object path of the array inside the parent's element."""
        below = self.steps[len(self.parent.steps):] if self.parent else self.steps
        return below[:-1]


@dataclass
class TableShape:
    """A table and the array paths its rows come from; several when names collide."""

    name: str
    feeds: list[Feed] = field(default_factory=list)


def table_shapes(source: str, shape: Shape) -> dict[str, TableShape]:
    """Tables and columns of a structure. The root table is always there."""
    tables: dict[str, TableShape] = {}

    def add(table: str, node: Shape, steps: tuple, parent: Feed | None) -> None:
        # A record or element that is not an object is kept as "value".
        only_text = node.kinds == {"string"} and node.fields is None and node.element is None
        own = Cell((), node.scalar or node.element is not None, True, only_text)
        # Records that are null would have been seen as scalars, elements that are null need not.
        feed = Feed(table, steps, parent, {"value": [own]} if own.holds or parent is not None else {})
        tables.setdefault(table, TableShape(table)).feeds.append(feed)
        fields(node, (), "", feed)

    def fields(node: Shape, keys: tuple, prefix: str, feed: Feed) -> None:
        for key in sorted(node.fields or {}):
            child = node.fields[key]
            column = names.identifier(f"{prefix}_{key}" if prefix else key)
            path = (*keys, key)
            feed.columns.setdefault(column, []).append(
                Cell(
                    path, child.scalar, child.fields is not None or child.element is not None,
                    child.kinds == {"string"} and child.fields is None and child.element is None,
                )
            )
            if child.fields is not None:
                fields(child, path, column, feed)
            if child.element is not None:
                add(
                    names.identifier(f"{feed.table}_{column}"), child.element,
                    (*feed.steps, *path, EACH), feed,
                )

    add(names.identifier(source), shape, (), None)
    return tables


def first_seen_types(
    records: DataFrame, tables: dict[str, TableShape], known: Types | None = None,
) -> Types:
    """Type every column by the first value met in record order; a null counts as text.

    Types already in ``known`` stay. Columns that never hold a cell are left out, and those whose cells
    are text or null only are text whichever comes first. One aggregation without grouping finds all
    others; it returns one row.
    """
    known = known or {}
    candidates: list[tuple[str, str, tuple, Cell]] = []
    plain: dict[tuple[str, str], bool] = {}
    for table in tables.values():
        for feed in table.feeds:
            for column, cells in feed.columns.items():
                if column not in known.get(table.name, {}):
                    candidates += [(table.name, column, feed.steps, cell) for cell in cells]
                    place = (table.name, column)
                    plain[place] = plain.get(place, True) and all(cell.text for cell in cells)
    types: Types = {table: dict(known.get(table, {})) for table in tables}
    every, candidates = candidates, [item for item in candidates if not plain[item[:2]]]

    def first_in_record(steps: tuple, cell: Cell) -> Column:
        if not steps:
            return cell.schema(F.col("rec"))
        schemas = F.transform(values_at(F.col("rec"), steps), cell.schema)
        return F.get(F.array_compact(schemas), F.lit(0))

    firsts = {} if not candidates else records.select("root_index", *[
        first_in_record(steps, cell).alias(f"cell {index}")
        for index, (_, _, steps, cell) in enumerate(candidates)
    ]).agg(*[
        F.min(F.when(F.col(name).isNotNull(), F.struct("root_index", F.col(name).alias("schema")))).alias(name)
        for name in (f"cell {index}" for index in range(len(candidates)))
    ]).first()

    earliest: dict[tuple[str, str], tuple] = {}
    for index, (table, column, _, _) in enumerate(candidates):
        first = firsts[f"cell {index}"]
        if first is not None:
            found = (first["root_index"], index, first["schema"])
            earliest[table, column] = min(found, earliest.get((table, column), found))
    for table, column, _, _ in every:
        if column in types[table]:
            continue
        if plain[table, column]:
            types[table][column] = "text"
        elif (table, column) in earliest:
            types[table][column] = _column_type(earliest[table, column][2])
    return types


def _plain_text(feed: Feed, column: str, dtype: str) -> Cell | None:
    """The cell of a text column whose values are all text or null, so that they are read as they are."""
    cells = feed.columns.get(column, [])
    return cells[0] if dtype == "text" and len(cells) == 1 and cells[0].holds and cells[0].text else None


def typed_cell(value: Column, schema: Column, dtype: str, where: str) -> Column:
    """A cell as the type of its column; a value that does not fit fails the job."""
    text = get(value, (), "string")
    number = get(value, (), "double")
    empty = schema.isNull() | (schema == "VOID")
    message = F.concat(F.lit(f"{where}: cannot store "), F.to_json(value), F.lit(f" as {dtype}"))
    misfit = F.raise_error(message).cast(SPARK_TYPES[dtype])

    if dtype == "text":
        real = schema.isin("DOUBLE", "FLOAT") | schema.startswith("DECIMAL")
        return (
            F.when(schema == "STRING", text).when(real, double_text(number))
            .when(empty, F.lit(None)).otherwise(F.to_json(value))
        )
    if dtype == "bigint":
        # A real number that is whole, as 1.0, loses nothing; one with a fraction fails.
        exact = get(value, (), "decimal(38,9)")
        real = schema.isin("DOUBLE", "FLOAT") | schema.startswith("DECIMAL")
        whole = (
            F.when(schema == "BIGINT", get(value, (), "bigint"))
            .when(
                (schema == "STRING") & text.rlike(r"^\s*[+-]?\d+\s*$"),
                F.trim(text).try_cast("bigint"),
            )
            .when(real & (exact % 1 == 0) & ~schema.rlike(BEYOND), exact.try_cast("bigint"))
        )
        return F.when(~empty, F.coalesce(whole, misfit))
    if dtype == "double":
        real = (
            F.when(schema == "STRING", F.trim(text).try_cast("double"))
            .when(schema != "BOOLEAN", number)
        )
        return F.when(~empty, F.coalesce(real, misfit))
    word = F.lower(F.trim(text))
    truth = (
        F.when(schema == "BOOLEAN", get(value, (), "boolean"))
        .when((schema == "STRING") & word.isin(*_TRUE), F.lit(True))
        .when((schema == "STRING") & word.isin(*_FALSE), F.lit(False))
    )
    return F.when(~empty, F.coalesce(truth, misfit))


def _row_key(value: Column, table: str, parent_key: Column, index: Column) -> Column:
    """Stable key of a row, from the stable key of its parent and its own ``id``."""
    found = get(value, ("id",))
    found_kind = kind(found)
    own = (
        F.when(found_kind == "text", json_string(get(found, (), "string")))
        .when(found_kind == "double", double_text(get(found, (), "double"), 16, keep_point=True))
        .when(found_kind.isin("bigint", "boolean"), F.to_json(found))
    )
    below = F.concat(
        F.lit("["), json_string(parent_key), F.lit(f',"{table}",'),
        F.coalesce(own, index.cast("string")), F.lit("]"),
    )
    top = F.concat(F.lit(f'["{table}",'), own, F.lit("]"))
    return F.when(parent_key.isNull(), top).otherwise(below)


def _feed_rows(records: DataFrame, feed: Feed, batch_id: int) -> DataFrame:
    """Rows of one array path: technical columns and the element ``v``."""
    if feed.parent is None:
        return records.select(
            uuid_text(F.lit(str(batch_id)), F.lit(feed.table), F.col("root_index")).alias("_row_id"),
            F.lit(None).cast("string").alias("_parent_id"),
            F.lit(None).cast("string").alias("_parent_key"),
            F.col("root_index").alias("_row_index"),
            F.col("rec").alias("v"),
        )
    parents = _feed_rows(records, feed.parent, batch_id)
    elements = parents.select(
        F.col("_row_id").alias("_parent_id"),
        _row_key(F.col("v"), feed.parent.table, F.col("_parent_key"), F.col("_row_index"))
        .alias("_parent_key"),
        F.posexplode(get(F.col("v"), feed.array_keys, "array<variant>")).alias("_row_index", "v"),
    )
    position = F.col("_row_index").cast("bigint")
    path = "/".join(feed.array_keys)
    return elements.select(
        uuid_text(F.col("_parent_id"), F.lit(feed.table), F.lit(path), position).alias("_row_id"),
        "_parent_id", "_parent_key", position.alias("_row_index"), "v",
    )


def _cells(rows: DataFrame, feed: Feed, columns: dict[str, str]) -> DataFrame:
    """Add ``cell c`` and its variant schema ``schema c`` for every column the feed has, but for plain text.

    Values and schemas are separate projections, so each is computed once per row.
    """
    sources = {
        column: [cell for cell in feed.columns.get(column, []) if cell.holds]
        for column, dtype in columns.items() if _plain_text(feed, column, dtype) is None
    }
    sources = {column: cells for column, cells in sources.items() if cells}
    values = {}
    for column, cells in sources.items():
        if len(cells) == 1:
            values[f"cell {column}"] = cells[0].of(F.col("v"))
        else:
            # Keys that collide after normalisation: the last of them in the object wins.
            values[f"cell {column}"] = F.coalesce(
                *[
                    F.when(cell.schema(F.col("v")).isNotNull(), cell.of(F.col("v")))
                    for cell in reversed(cells)
                ]
            )
    rows = rows.withColumns(values) if values else rows
    schemas = {}
    for column, cells in sources.items():
        schema = F.schema_of_variant(F.col(f"`cell {column}`"))
        if any(cell.mixed for cell in cells):
            structure = schema.startswith("OBJECT<")
            if all(cell.path for cell in cells):
                structure = structure | schema.startswith("ARRAY<")
            schema = F.when(~structure, schema)
        schemas[f"schema {column}"] = schema
    return rows.withColumns(schemas) if schemas else rows


def table_rows(
    records: DataFrame, table: TableShape, columns: dict[str, str], batch_id: int,
) -> DataFrame:
    """All rows of one table, typed; columns the batch does not have are NULL."""
    parts = []
    for feed in table.feeds:
        rows = _cells(_feed_rows(records, feed, batch_id), feed, columns)
        held = set(rows.columns)
        plain = {c: _plain_text(feed, c, dtype) for c, dtype in columns.items()}
        parts.append(rows.select(
            "_row_id", F.lit(batch_id).cast("bigint").alias("_source_batch_id"),
            "_parent_id", "_parent_key", "_row_index",
            *[
                (
                    get(F.col("v"), plain[c].path, "string") if plain[c] is not None
                    else typed_cell(
                        F.col(f"`cell {c}`"), F.col(f"`schema {c}`"), dtype, f"{table.name}.{c}"
                    ) if f"cell {c}" in held else F.lit(None)
                ).cast(SPARK_TYPES[dtype]).alias(c)
                for c, dtype in columns.items()
            ],
        ))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@dataclass
class Flattened:
    """Tables of one batch and the column types they were written with."""

    tables: dict[str, DataFrame]
    types: Types


def flatten(
    records: DataFrame, source: str, batch_id: int, known: Types | None = None,
    max_paths: int | None = None,
) -> Flattened:
    """Flatten records into tables; ``known`` holds the column types of earlier batches."""
    tables = table_shapes(source, discover(records, "rec", max_paths))
    names.check_root_table(names.identifier(source))
    types = first_seen_types(records, tables, known)
    for table, columns in types.items():
        names.check_columns(table, list(columns))
    return Flattened(
        {name: table_rows(records, table, types[name], batch_id) for name, table in tables.items()},
        types,
    )
