"""Published current state and the row filter of the user dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns that are not published.
HIDDEN_COLUMNS = (
    "_sk", "valid_from", "valid_to", "is_current", "_content_hash", "_business_key", "_parent_key",
)


def current_rows(dimension: DataFrame) -> DataFrame:
    return dimension.where("is_current")


def project_mart(dimension: DataFrame) -> DataFrame | None:
    """Current rows without the history columns, None when no column is left."""
    kept = [name for name in dimension.columns if name not in HIDDEN_COLUMNS]
    return current_rows(dimension).select(*kept) if kept else None


def visible_users(users: DataFrame, departments: DataFrame, code: str | None) -> DataFrame:
    """Versions of users a department may see; no code or ``ALL`` sees everything."""
    if code in (None, "", "ALL"):
        return users
    own = departments.where("is_current").where(F.col("code") == code).select("department_id")
    return users.join(own, "department_id", "left_semi").select(*users.columns)


def users_with_departments(users: DataFrame, departments: DataFrame) -> DataFrame:
    """Users joined with every version of their department."""
    described = departments.select("department_id", "code", F.col("name").alias("department_name"))
    return users.join(described, "department_id")
