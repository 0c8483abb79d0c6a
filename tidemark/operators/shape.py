"""Structure of a column of JSON values, found by aggregation over all of them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.variants import EACH, is_array, is_object, values_at


@dataclass
class Shape:
    """What was seen at one path: scalars, an object with fields, an array, or several."""

    scalar: bool = False
    fields: dict[str, "Shape"] | None = None
    element: "Shape | None" = None
    kinds: set[str] = field(default_factory=set)

    def walk(self, steps: tuple = ()) -> Iterator[tuple[tuple, "Shape"]]:
        """This node and all below it, with their paths; keys in alphabetical order."""
        yield steps, self
        for key in sorted(self.fields or {}):
            yield from self.fields[key].walk((*steps, key))
        if self.element is not None:
            yield from self.element.walk((*steps, EACH))

    def at(self, steps: tuple) -> "Shape":
        node = self
        for step in steps:
            node = node.element if step is EACH else node.fields[step]
        return node


@dataclass
class _Pending:
    paths: list[tuple] = field(default_factory=list)


def _datatype(schema_text: str) -> T.DataType:
    """Data type of a variant schema text; only the word OBJECT differs from DDL."""
    ddl = re.sub(
        r"`(?:[^`]|``)*`|OBJECT<",
        lambda found: "STRUCT<" if found.group() == "OBJECT<" else found.group(),
        schema_text,
    )
    return T.DataType.fromDDL(f"root {ddl}")["root"].dataType


def _merge(node: Shape, dtype: T.DataType, steps: tuple, pending: _Pending) -> None:
    if isinstance(dtype, T.StructType):
        node.fields = node.fields if node.fields is not None else {}
        for item in dtype.fields:
            child = node.fields.setdefault(item.name, Shape())
            _merge(child, item.dataType, (*steps, item.name), pending)
    elif isinstance(dtype, T.ArrayType):
        node.element = node.element or Shape()
        _merge(node.element, dtype.elementType, (*steps, EACH), pending)
    elif isinstance(dtype, T.VariantType):
        pending.paths.append(steps)
    else:
        node.scalar = True
        node.kinds.add(dtype.simpleString())


def discover(records: DataFrame, column: str = "rec", max_paths: int | None = None) -> Shape:
    """Merge the structure of all values of a VARIANT column.

    Each pass aggregates the schemas per path and kind, so values of different kinds at one
    path do not hide each other. Only schema texts reach the driver: at most three per path
    whose kinds are mixed, and one pass is enough when there is none below the root. A caller may
    refuse records with more than ``max_paths`` distinct paths.
    """
    root = Shape()
    paths: list[tuple] = [()]
    while paths:
        candidates = F.array(*[
            F.struct(F.lit(index).alias("path"), values_at(F.col(column), steps).alias("found"))
            for index, steps in enumerate(paths)
        ])
        if paths == [()]:
            values = records.select(F.lit(0).alias("path"), F.col(column).alias("v")).where("v IS NOT NULL")
        else:
            values = records.select(F.inline(candidates)).select("path", F.explode("found").alias("v"))
        head = F.when(is_object(F.col("v")), "object").when(is_array(F.col("v")), "array").otherwise("scalar")
        found = (
            values.groupBy("path", head.alias("head"))
            .agg(F.schema_of_variant_agg("v").alias("schema"))
            .collect()
        )
        pending = _Pending()
        for row in found:
            node = root.at(paths[row["path"]])
            if row["head"] == "scalar":
                node.scalar = True
                node.kinds.add(row["schema"].lower())
            else:
                _merge(node, _datatype(row["schema"]), paths[row["path"]], pending)
        if max_paths is not None and (count := sum(1 for _ in root.walk())) > max_paths:
            raise ValueError(f"records have {count} distinct paths, more than {max_paths}")
        paths = pending.paths
    return root


def exists_at(value: Column, steps: tuple, predicate) -> Column:
    """True when ``predicate`` holds for some value at the path."""
    return F.coalesce(F.exists(values_at(value, steps), predicate), F.lit(False))
