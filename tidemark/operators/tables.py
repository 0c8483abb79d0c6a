"""Whole-table operators: defaults for missing values, first rows and size statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def backfill(table: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill missing values, and only those, with defaults derived from the row."""
    return table.withColumns({
        name: F.coalesce(F.col(name), value) for name, value in defaults.items()
    })


def first_rows(table: DataFrame, key: str, count: int) -> DataFrame:
    """The rows with the least keys, in their order."""
    return table.orderBy(key).limit(count)


def dataset_stats(table: DataFrame, limit: int = 1000, name: str = "json_bytes") -> DataFrame:
    """Row count and exact size of the table as a compact JSON response.

    Rows, the commas between them and the envelope of the last page are counted.
    """
    body = F.to_json(F.struct(*table.columns), {"ignoreNullFields": "false"})
    sums = table.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length(body)), F.lit(0)).alias("_bytes"),
    )
    rows = F.col("rows")
    last_skip = F.greatest(F.lit(0), F.expr(f"((rows - 1) div {limit}) * {limit}"))
    envelope = F.concat(
        F.lit('{"items":[],"total":'), rows, F.lit(',"skip":'), last_skip,
        F.lit(f',"limit":{limit},"has_more":false}}'),
    )
    return sums.select(
        "rows",
        (F.col("_bytes") + F.greatest(F.lit(0), rows - 1) + F.octet_length(envelope)).alias(name),
    )
