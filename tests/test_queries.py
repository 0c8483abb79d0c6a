"""Every registered query against its SQL in DuckDB on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from tidemark.plans.queries import QUERIES
from tidemark.plans.queries.documents import order_documents

DATA = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test data are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(rows, columns):
    return sorted(
        (tuple((type(v).__name__, str(v)) for v in (row[c] for c in columns)) for row in rows), key=repr
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = driver.queries()[name](spark, str(DATA))
    columns = sorted(frame.columns)
    found = plain([row.asDict() for row in frame.collect()], columns)
    result = duck.execute(driver.oracle_sql()[name])
    names = [item[0] for item in result.description]
    assert sorted(names) == columns
    assert found == plain([dict(zip(names, row)) for row in result.fetchall()], columns)


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() > 0


def test_documents_are_made_in_many_tasks_whatever_the_files_are(spark):
    orders = spark.range(1).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'F' AS o_orderstatus", "1.5D AS o_totalprice",
        "TIMESTAMP '2024-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority",
    )
    plan = order_documents(orders.coalesce(1))._jdf.queryExecution().optimizedPlan().toString()
    # The rows are dealt by their key below the projection that makes the documents.
    assert plan.lstrip().startswith("Project") and "RepartitionByExpression [o_orderkey" in plan, plan
