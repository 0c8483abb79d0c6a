"""Queries over type 2 history: every mode, policy and kind of key."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators.history import Merge, master_stats, merge, sync_batch, sync_users
from ...operators.flatten import Flattened, flatten
from ...operators.keys import business_key, latest_per_key
from ...operators.marts import project_mart, users_with_departments, visible_users
from ...functions.values import record_text, value_text
from ...options import (
    CLOSE_ON_FULL_SNAPSHOT as CLOSE, FULL_SNAPSHOT as FULL, INCREMENTAL_UPSERT as INCREMENTAL,
    NEVER_CLOSE as NEVER,
)
from .documents import order_documents
from .registry import day, query, staged, table, written

T0, T1, T2 = (datetime(2024, month, 1, tzinfo=timezone.utc) for month in (1, 2, 3))
COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def first_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(*COLUMNS)


def second_snapshot(first: DataFrame) -> DataFrame:
    """The whole first snapshot with keys gone, rows changed and new keys added."""
    kept = first.where("c_custkey % 10 <> 3").withColumn(
        "c_acctbal", F.when(F.col("c_custkey") % 7 == 0, F.col("c_acctbal") + 1)
        .otherwise(F.col("c_acctbal")),
    )
    new = first.where("c_custkey % 50 = 0").withColumn("c_custkey", -F.col("c_custkey") - 1)
    return kept.unionByName(new)


SNAPSHOTS = """
WITH v1 AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer),
v2 AS (
  SELECT c_custkey, c_name, c_nationkey,
         CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
  FROM v1 WHERE c_custkey % 10 <> 3
  UNION ALL
  SELECT -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment FROM v1 WHERE c_custkey % 50 = 0
)"""


def merged_sql(old: str, new: str, old_at: str, new_at: str, closes: bool) -> str:
    """Versions after merging relation ``new`` into current rows ``old``, by UNION ALL."""
    same = (
        "n.c_name IS NOT DISTINCT FROM o.c_name AND n.c_nationkey IS NOT DISTINCT FROM o.c_nationkey "
        "AND n.c_acctbal IS NOT DISTINCT FROM o.c_acctbal "
        "AND n.c_mktsegment IS NOT DISTINCT FROM o.c_mktsegment"
    )
    missing = f"NOT EXISTS (SELECT 1 FROM {new} n WHERE n.c_custkey = o.c_custkey)"
    changed = f"EXISTS (SELECT 1 FROM {new} n WHERE n.c_custkey = o.c_custkey AND NOT ({same}))"
    closing = f"({changed} OR {missing})" if closes else changed
    return f"""
SELECT o.*, '{old_at}' AS valid_from, CASE WHEN {closing} THEN '{new_at}' END AS valid_to,
       NOT {closing} AS is_current
FROM {old} o
UNION ALL
SELECT n.*, '{new_at}', NULL, TRUE FROM {new} n
WHERE NOT EXISTS (SELECT 1 FROM {old} o WHERE o.c_custkey = n.c_custkey AND {same})"""


def start(first: DataFrame) -> DataFrame:
    """Dimension after a first full snapshot."""
    batch = staged(first, 1, "c_custkey")
    return apply(None, batch, FULL, CLOSE, T0).dimension


def apply(dimension: DataFrame | None, batch: DataFrame, mode: str, policy: str, at, plan: str = "auto") -> Merge:
    return merge(dimension, batch, business_key(batch, ["c_custkey"]), mode, policy, at, plan=plan)


def versions(dimension: DataFrame, *columns: str) -> DataFrame:
    return dimension.select(*(columns or COLUMNS), day("valid_from"), day("valid_to"), "is_current")


@query("scd2_snapshot_close", SNAPSHOTS + merged_sql("v1", "v2", "2024-01-01", "2024-02-01", True))
def scd2_snapshot_close(spark: SparkSession, folder: str) -> DataFrame:
    first = first_snapshot(spark, folder)
    batch = staged(second_snapshot(first), 2, "c_custkey")
    return versions(apply(start(first), batch, FULL, CLOSE, T1).dimension)


@query("scd2_snapshot_never_close", SNAPSHOTS + merged_sql("v1", "v2", "2024-01-01", "2024-02-01", False))
def scd2_snapshot_never_close(spark: SparkSession, folder: str) -> DataFrame:
    first = first_snapshot(spark, folder)
    batch = staged(second_snapshot(first), 2, "c_custkey")
    return versions(apply(start(first), batch, FULL, NEVER, T1).dimension)


@query("scd2_incremental", SNAPSHOTS + """,
delta AS (SELECT * FROM v2 EXCEPT SELECT * FROM v1)
""" + merged_sql("v1", "delta", "2024-01-01", "2024-02-01", False))
def scd2_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Only changed and new rows are sent; everything else stays current."""
    first = first_snapshot(spark, folder)
    delta = second_snapshot(first).where("c_custkey % 7 = 0 OR c_custkey < 0")
    return versions(apply(start(first), staged(delta, 2, "c_custkey"), INCREMENTAL, CLOSE, T1).dimension)


@query("scd2_three_revisions", SNAPSHOTS + """,
two AS (""" + merged_sql("v1", "v2", "2024-01-01", "2024-02-01", True) + """),
cur AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM two WHERE is_current),
three AS (""" + merged_sql("cur", "v1", "", "2024-03-01", True) + """)
SELECT * FROM two WHERE NOT is_current
UNION ALL
SELECT t.c_custkey, t.c_name, t.c_nationkey, t.c_acctbal, t.c_mktsegment,
       CASE WHEN t.valid_from = '' THEN
         (SELECT w.valid_from FROM two w WHERE w.is_current AND w.c_custkey = t.c_custkey)
       ELSE t.valid_from END, t.valid_to, t.is_current
FROM three t""")
def scd2_three_revisions(spark: SparkSession, folder: str) -> DataFrame:
    """Keys that went away and changed rows come back as they were: new versions each."""
    first = first_snapshot(spark, folder)
    second = apply(start(first), staged(second_snapshot(first), 2, "c_custkey"), FULL, CLOSE, T1)
    return versions(apply(second.dimension, staged(first, 3, "c_custkey"), FULL, CLOSE, T2).dimension)


@query("scd2_null_key", """
WITH keyed AS (SELECT *, nullif(c_custkey % 5, 0) AS k FROM customer),
latest AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY c_custkey DESC) AS rn FROM keyed) x WHERE rn = 1)
SELECT k, c_custkey, '2024-01-01' AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, TRUE AS is_current FROM latest
UNION ALL
SELECT k, c_custkey, '2024-02-01', NULL, TRUE FROM latest WHERE k IS NULL""")
def scd2_null_key(spark: SparkSession, folder: str) -> DataFrame:
    """The last row of each repeated key counts; a NULL key is inserted again by every run."""
    rows = first_snapshot(spark, folder).withColumn("k", F.expr("nullif(c_custkey % 5, 0)"))
    dimension = None
    for batch_id, at in ((1, T0), (2, T1)):
        batch = staged(rows, 1, "c_custkey").withColumn("_source_batch_id", F.lit(batch_id).cast("bigint"))
        dimension = merge(dimension, batch, business_key(batch, ["k"]), INCREMENTAL, CLOSE, at).dimension
    return versions(dimension, "k", "c_custkey")


@query("scd2_composite_key", """
WITH keys AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
SELECT '(' || l_orderkey || ',' || l_linenumber || ')' AS business_key, '2024-01-01' AS valid_from,
       CASE WHEN l_linenumber = 7 THEN '2024-02-01' END AS valid_to, l_linenumber <> 7 AS is_current
FROM keys""")
def scd2_composite_key(spark: SparkSession, folder: str) -> DataFrame:
    """A two-column key over lines; one line number disappears from the second snapshot."""
    lines = staged(table(spark, folder, "lineitem"), 1, "l_partkey")
    key = business_key(lines, ["l_orderkey", "l_linenumber"])
    first = merge(None, lines, key, FULL, CLOSE, T0, store=written).dimension
    second = merge(first, lines.where("l_linenumber <> 7"), key, FULL, CLOSE, T1, store=written)
    return second.dimension.select(
        F.col("_business_key").alias("business_key"), day("valid_from"), day("valid_to"), "is_current",
    )


@query("scd2_empty_snapshot", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, '2024-01-01' AS valid_from,
       '2024-02-01' AS valid_to, FALSE AS is_current FROM customer""")
def scd2_empty_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """A full snapshot without rows closes everything."""
    first = first_snapshot(spark, folder)
    nothing = staged(first.where("c_custkey IS NULL"), 2, "c_custkey")
    return versions(apply(start(first), nothing, FULL, CLOSE, T1).dimension)


@query("scd2_stats", SNAPSHOTS + """,
m AS (""" + merged_sql("v1", "v2", "2024-01-01", "2024-02-01", True) + """)
SELECT 'outer' AS plan, count(*) FILTER (WHERE valid_from = '2024-02-01') AS inserted_count,
       count(*) FILTER (WHERE valid_to = '2024-02-01') AS closed_count FROM m
UNION ALL
SELECT 'delta', count(*) FILTER (WHERE valid_from = '2024-02-01'),
       count(*) FILTER (WHERE valid_to = '2024-02-01') FROM m""")
def scd2_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Inserted and closed versions, by both join plans."""
    first = first_snapshot(spark, folder)
    batch = staged(second_snapshot(first), 2, "c_custkey")
    parts = [
        apply(start(first), batch, FULL, CLOSE, T1, plan).stats().select(F.lit(plan).alias("plan"), "*")
        for plan in ("outer", "delta")
    ]
    return parts[0].unionByName(parts[1])


@query("mart_current", SNAPSHOTS + " SELECT * FROM v2")
def mart_current(spark: SparkSession, folder: str) -> DataFrame:
    """Published rows after the second snapshot; history columns are gone."""
    first = first_snapshot(spark, folder)
    batch = staged(second_snapshot(first), 2, "c_custkey")
    mart = project_mart(apply(start(first), batch, FULL, CLOSE, T1).dimension)
    return mart.drop("_row_id", "_source_batch_id", "_parent_id", "_row_index")


@query("schema_evolution_versions", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS label,
       '2024-01-01' AS valid_from, CASE WHEN c_nationkey < 12 THEN '2024-02-01' END AS valid_to,
       c_nationkey >= 12 AS is_current
FROM customer
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, c_mktsegment || '-' || c_nationkey,
       '2024-02-01', NULL, TRUE
FROM customer WHERE c_nationkey < 12""")
def schema_evolution_versions(spark: SparkSession, folder: str) -> DataFrame:
    """A new column changes the hash, so every key that is sent again gets a new version."""
    first = first_snapshot(spark, folder)
    sent = first.where("c_nationkey < 12").withColumn(
        "label", F.concat_ws("-", "c_mktsegment", "c_nationkey")
    )
    merged = apply(start(first), staged(sent, 2, "c_custkey"), INCREMENTAL, CLOSE, T1)
    return versions(merged.dimension, *COLUMNS, "label")


@query("latest_per_key", """
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) e
WHERE rn = 1""")
def latest_rows(spark: SparkSession, folder: str) -> DataFrame:
    events = staged(table(spark, folder, "events"), 1, "event_id")
    return latest_per_key(events, "user_id").select("event_id", "user_id", "event_type", "value")


@query("record_text_key", """
SELECT l_orderkey, l_linenumber, l_partkey,
  '(' || l_orderkey || ',' || coalesce(nullif(l_returnflag, 'N'), '') || ',"' || l_linestatus || ' "",x"'
  || ',' || regexp_replace(CAST(l_quantity AS VARCHAR), '\\.0$', '')
  || ',' || regexp_replace(CAST(l_discount AS VARCHAR), '\\.0$', '')
  || ',' || CASE WHEN l_tax > 0.04 THEN 't' ELSE 'f' END || ')' AS key_text,
  regexp_replace(CAST(l_extendedprice AS VARCHAR), '\\.0$', '') AS price_text
FROM lineitem""")
def record_text_key(spark: SparkSession, folder: str) -> DataFrame:
    """Text of rows with NULLs, quoted text, whole and broken numbers and booleans."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        F.expr("nullif(l_returnflag, 'N')").alias("flag"),
        F.concat("l_linestatus", F.lit(' ",x')).alias("quoted"), "l_quantity", "l_discount",
        (F.col("l_tax") > 0.04).alias("taxed"),
    )
    types = {item.name: item.dataType for item in lines.schema}
    names = ["l_orderkey", "flag", "quoted", "l_quantity", "l_discount", "taxed"]
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        record_text((F.col(name), types[name]) for name in names).alias("key_text"),
        value_text(F.col("l_extendedprice"), types["l_extendedprice"]).alias("price_text"),
    )


def stored(batch: Flattened) -> Flattened:
    """Staged tables as a run finds them: written once, then read."""
    return Flattened({name: written(rows) for name, rows in batch.tables.items()}, batch.types)


@query("sync_batch", """
WITH first AS (SELECT count(*) AS n, sum(len(string_split(o_orderpriority, '-'))) AS tags FROM orders),
second AS (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F')
SELECT 1 AS batch, 'dim_orders' AS dim_table, n AS inserted_count, 0 AS closed_count FROM first
UNION ALL SELECT 1, 'dim_orders_charges', 2 * n, 0 FROM first
UNION ALL SELECT 1, 'dim_orders_tags', CAST(tags AS BIGINT), 0 FROM first
UNION ALL SELECT 2, 'dim_orders', n, n FROM second
UNION ALL SELECT 2, 'dim_orders_charges', n, n FROM second
UNION ALL SELECT 2, 'dim_orders_tags', 0, 0 FROM second""")
def sync_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches of nested orders through root and child tables, with counts per table.

    The second batch sends the finished orders again with another total, which changes the
    root row and one of the two charges; tags stay as they are.
    """
    orders = table(spark, folder, "orders")
    first = stored(flatten(written(order_documents(orders)), "orders", 1))
    again = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    second = stored(flatten(written(order_documents(again)), "orders", 2, first.types))
    loaded = sync_batch(first.tables, {}, FULL, CLOSE, T0, store=written)
    held = {name: merged.dimension for name, merged in loaded.items()}
    updated = sync_batch(second.tables, held, INCREMENTAL, CLOSE, T1, store=written)
    parts = [
        merged.stats().select(
            F.lit(batch).alias("batch"), F.lit(name).alias("dim_table"), "inserted_count", "closed_count",
        )
        for batch, merges in ((1, loaded), (2, updated)) for name, merged in merges.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# ---- master dimensions -----------------------------------------------------------------

def masters(spark: SparkSession, folder: str, later: bool) -> tuple[DataFrame, DataFrame]:
    """Nations as departments and suppliers as users, as they are or some time later."""
    departments = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("department_id"), F.col("n_name").alias("code"),
        F.concat(F.lit("Nation "), "n_nationkey").alias("name"),
    )
    users = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("username"),
        F.concat(F.lit("User "), "s_suppkey").alias("full_name"),
        F.col("s_nationkey").alias("department_id"), (F.col("s_acctbal") > 0).alias("is_active"),
    )
    if later:
        departments = departments.where("department_id % 10 <> 9").withColumn(
            "name", F.when(F.col("department_id") % 4 == 0, F.concat("name", F.lit(" new"))).otherwise(F.col("name"))
        )
        users = users.where("user_id % 10 <> 3").withColumn(
            "is_active", F.when(F.col("user_id") % 7 == 0, ~F.col("is_active")).otherwise(F.col("is_active"))
        )
    return departments, users


def synced_masters(spark: SparkSession, folder: str) -> dict[str, Merge]:
    first = sync_users(*masters(spark, folder, False), {}, FULL, CLOSE, T0)
    held = {name: merged.dimension for name, merged in first.items()}
    return sync_users(*masters(spark, folder, True), held, FULL, CLOSE, T1)


@query("users_sync", """
SELECT 'dim_department' AS entity,
       count(*) FILTER (WHERE n_nationkey % 10 <> 9 AND n_nationkey % 4 = 0) AS upserted_count,
       count(*) FILTER (WHERE n_nationkey % 10 = 9) AS closed_count FROM nation
UNION ALL
SELECT 'dim_user', count(*) FILTER (WHERE s_suppkey % 10 <> 3 AND s_suppkey % 7 = 0),
       count(*) FILTER (WHERE s_suppkey % 10 = 3) FROM supplier""")
def users_sync(spark: SparkSession, folder: str) -> DataFrame:
    parts = [
        master_stats(merged).select(F.lit(name).alias("entity"), "upserted_count", "closed_count")
        for name, merged in synced_masters(spark, folder).items()
    ]
    return parts[0].unionByName(parts[1])


USER_VERSIONS = """
WITH u AS (SELECT s_suppkey AS user_id, s_name AS username, s_nationkey AS department_id,
                  s_acctbal > 0 AS is_active, s_suppkey % 10 = 3 AS gone,
                  s_suppkey % 10 <> 3 AND s_suppkey % 7 = 0 AS changed FROM supplier),
dim_user AS (
SELECT user_id, username, department_id, is_active, '2024-01-01' AS valid_from,
       CASE WHEN gone OR changed THEN '2024-02-01' END AS valid_to, NOT (gone OR changed) AS is_current FROM u
UNION ALL
SELECT user_id, username, department_id, NOT is_active, '2024-02-01', NULL, TRUE FROM u WHERE changed)"""


@query("users_history", USER_VERSIONS + " SELECT * FROM dim_user")
def users_history(spark: SparkSession, folder: str) -> DataFrame:
    users = synced_masters(spark, folder)["dim_user"].dimension
    return versions(users, "user_id", "username", "department_id", "is_active")


@query("row_filter_department", USER_VERSIONS + """
SELECT * FROM dim_user WHERE department_id = (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_8')""")
def row_filter_department(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of users that the department with this code may see."""
    merges = synced_masters(spark, folder)
    seen = visible_users(merges["dim_user"].dimension, merges["dim_department"].dimension, "NATION_8")
    return versions(seen, "user_id", "username", "department_id", "is_active")


@query("users_by_department", USER_VERSIONS + """,
dim_department AS (
SELECT n_nationkey AS department_id, n_name AS code, 'Nation ' || n_nationkey AS department_name FROM nation
UNION ALL
SELECT n_nationkey, n_name, 'Nation ' || n_nationkey || ' new' FROM nation
WHERE n_nationkey % 10 <> 9 AND n_nationkey % 4 = 0)
SELECT code, department_name, count(*) AS users, count(*) FILTER (WHERE is_current) AS current_users
FROM dim_user JOIN dim_department USING (department_id) GROUP BY code, department_name""")
def users_by_department(spark: SparkSession, folder: str) -> DataFrame:
    merges = synced_masters(spark, folder)
    joined = users_with_departments(merges["dim_user"].dimension, merges["dim_department"].dimension)
    return joined.groupBy("code", "department_name").agg(
        F.count(F.lit(1)).alias("users"), F.count_if("is_current").alias("current_users")
    )
