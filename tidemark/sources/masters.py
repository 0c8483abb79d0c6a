"""Master data: departments and users, read from files, tables or a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns of the master tables.
DEPARTMENT_COLUMNS = ("department_id", "code", "name")
USER_COLUMNS = ("user_id", "username", "full_name", "department_id", "is_active")


def scan_masters(
    spark: SparkSession, department: str, end_user: str, format: str = "table", **options: str,
) -> tuple[DataFrame, DataFrame]:
    """Department and user table; ``format`` is ``table``, ``jdbc`` or a file format."""
    def read(name: str) -> DataFrame:
        if format == "table":
            return spark.read.table(name)
        reader = spark.read.format(format).options(**options)
        return reader.option("dbtable", name).load() if format == "jdbc" else reader.load(name)

    return read(department).select(*DEPARTMENT_COLUMNS), read(end_user).select(*USER_COLUMNS)
