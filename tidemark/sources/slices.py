"""Incremental slices of a table, as a paged source would serve them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.instants import iso_text


def changed_since(table: DataFrame, column: str, checkpoint: Column | None) -> DataFrame:
    """Rows changed after a checkpoint (exclusive); a plain filter, so it is pushed down."""
    return table if checkpoint is None else table.where(F.col(column) > checkpoint)


def list_page(
    table: DataFrame, key: str, limit: int = 1000, skip: int = 0,
    updated: str = "updated_at", since: Column | None = None, most: int | None = None,
) -> DataFrame:
    """One page in key order, with the totals of its envelope on every row.

    ``most`` is the largest page a caller may ask for, if there is one.
    """
    if limit < 1 or (most is not None and limit > most):
        raise ValueError("limit must be positive" if limit < 1 else f"limit must be {most} at most")
    if skip < 0:
        raise ValueError("skip must not be negative")
    changed = changed_since(table, updated, since)
    total = changed.agg(F.count(F.lit(1))).scalar()
    rendered = [
        iso_text(F.col(item.name), "Z").alias(item.name)
        if isinstance(item.dataType, T.TimestampType) else F.col(item.name)
        for item in table.schema
    ]
    page = changed.orderBy(key).offset(skip).limit(limit).select(*rendered)
    return page.withColumns({
        "total": total, "skip": F.lit(skip), "limit": F.lit(limit),
    }).withColumn("has_more", F.col("total") > skip + limit)
