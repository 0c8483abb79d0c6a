"""Running totals and dense numbers over whole tables, without one task seeing all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096


def running_total(
    rows: DataFrame, group: list[str], order: str, value: str, name: str, block: int = BLOCK,
) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the earlier rows of the group.

    ``order`` is an integer that is unique within the group. Rows are cut into blocks of the
    order, so a window task holds one block; only block sums are totalled per group.
    """
    blocked = rows.withColumn("_block", F.floor(F.col(order) / F.lit(block)))
    inside = Window.partitionBy(*group, "_block").orderBy(order)
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sums = (
        blocked.groupBy(*group, "_block").agg(F.sum(value).alias("_sum"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .drop("_sum")
    )
    within = F.coalesce(
        F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        blocked.withColumn("_within", within)
        .join(sums, [*group, "_block"])
        .withColumn(name, F.col("_before") + F.col("_within"))
        .drop("_block", "_within", "_before")
    )


def dense_ids(rows: DataFrame, key: str, start: Column, name: str, buckets: int = BLOCK) -> DataFrame:
    """Number rows from ``start + 1`` without gaps; ``key`` is unique.

    Keys are hashed into a fixed number of buckets. The bucket counts are the only thing that
    is totalled in one place, and their number does not depend on the data.
    """
    bucketed = rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        bucketed.withColumn("_position", position)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, start + F.col("_offset") + F.col("_position"))
        .drop("_bucket", "_position", "_offset")
    )
