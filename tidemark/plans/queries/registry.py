"""Registered queries: a Spark plan over the given tables and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions.variants import parse
from ...session import configure, scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(configure(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(rows: DataFrame) -> DataFrame:
    """Rows written to the shared folder and read back, so later steps start from there."""
    spark = rows.sparkSession
    path = scratch_folder(spark)
    # Keys and hashes are hexadecimal text, which this halves.
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def records(rows: DataFrame, index: Column, document: Column) -> DataFrame:
    """Rows as parsed JSON documents."""
    return rows.select(index.cast("bigint").alias("root_index"), parse(F.to_json(document)).alias("rec"))


def staged(rows: DataFrame, batch_id: int, index: str) -> DataFrame:
    """Rows of a relational snapshot with the columns of a staged table."""
    return rows.withColumns({
        "_row_id": F.md5(F.concat_ws("|", F.lit(batch_id), *rows.columns)),
        "_source_batch_id": F.lit(batch_id).cast("bigint"),
        "_parent_id": F.lit(None).cast("string"),
        "_parent_key": F.lit(None).cast("string"),
        "_row_index": F.col(index).cast("bigint"),
    })


def day(instant: str) -> Column:
    return F.date_format(instant, "yyyy-MM-dd").alias(instant)
