"""Queries over ledgers, source settings, runs, slices and whole tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators.ledger import (
    batch_gate, committed_checkpoints, freshness, last_successes, recent_runs, register_batches,
    run_plans, run_states, source_problem, source_report, update_sources,
)
from ...operators.reconcile import missing_names
from ...operators.watermark import column_high_water_mark
from ...sources.slices import list_page
from ...operators.tables import backfill, dataset_stats, first_rows
from .registry import query, table


# ---- batches ---------------------------------------------------------------------------

@query("ledger_dedup", """
WITH l AS (SELECT 'file_' || c_custkey AS filename, c_custkey + 1 AS id, c_mktsegment FROM customer),
f AS (SELECT 'file_' || o_custkey * 2 AS filename, o_orderkey AS arrival,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
SELECT f.filename, f.arrival,
       CASE WHEN l.id IS NULL AND rn = 1 THEN 'loaded' ELSE 'skipped_duplicate' END AS status,
       l.id AS known_batch, l.c_mktsegment AS known_table
FROM f LEFT JOIN l USING (filename)""")
def ledger_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Orders register files by customer: known ones and repeats are duplicates."""
    known = table(spark, folder, "customer").select(
        (F.col("c_custkey") + 1).alias("id"), F.concat(F.lit("file_"), "c_custkey").alias("filename"),
        F.array("c_mktsegment").alias("table_names"),
    )
    files = table(spark, folder, "orders").select(
        F.concat(F.lit("file_"), F.col("o_custkey") * 2).alias("filename"), F.col("o_orderkey").alias("arrival"),
    )
    return register_batches(known, files).select(
        "filename", "arrival", "status",
        F.when(F.col("tables").isNotNull(), F.col("batch_id")).alias("known_batch"),
        F.col("tables")[0].alias("known_table"),
    )


@query("ledger_ids", """
WITH n AS (SELECT count(DISTINCT o_custkey) AS n FROM orders), t AS (SELECT max(c_custkey) AS top FROM customer)
SELECT n AS files, top + 1 AS first_id, top + n AS last_id, n AS ids FROM n, t""")
def ledger_ids(spark: SparkSession, folder: str) -> DataFrame:
    """New files get ids without gaps or repeats after the highest one."""
    known = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("old_"), "c_custkey").alias("filename"),
        F.array(F.lit("t")).alias("table_names"),
    )
    files = table(spark, folder, "orders").select(
        F.concat(F.lit("new_"), "o_custkey").alias("filename"), F.col("o_orderkey").alias("arrival"),
    )
    loaded = register_batches(known, files).where("status = 'loaded'")
    return loaded.agg(
        F.count(F.lit(1)).alias("files"), F.min("batch_id").alias("first_id"),
        F.max("batch_id").alias("last_id"), F.count_distinct("batch_id").alias("ids"),
    )


@query("batch_gate", """
SELECT o_orderkey AS batch_id,
  CASE o_orderkey % 8 WHEN 0 THEN 'batch does not exist' WHEN 1 THEN 'unsupported load mode'
    WHEN 2 THEN 'unsupported delete policy' WHEN 3 THEN 'batch metadata does not match'
    WHEN 4 THEN 'batch metadata does not match' WHEN 5 THEN 'batch is incomplete' END AS refusal
FROM orders""")
def gated_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Batches that may and may not be synchronised, one order each."""
    orders = table(spark, folder, "orders")
    fault = F.col("o_orderkey") % 8
    known = orders.where(fault != 0).select(
        F.col("o_orderkey").alias("id"), F.when(fault != 3, F.col("o_orderstatus")).alias("source"),
        F.lit("full_snapshot").alias("load_mode"),
        F.when(fault == 4, "never_close").otherwise("close_on_full_snapshot").alias("delete_policy"),
        (fault != 5).alias("pagination_complete"),
    )
    asked = orders.select(
        F.col("o_orderkey").alias("batch_id"), F.col("o_orderstatus").alias("source"),
        F.when(fault == 1, "append").otherwise("full_snapshot").alias("load_mode"),
        F.when(fault != 2, "close_on_full_snapshot").alias("delete_policy"),
    )
    return batch_gate(asked, known).select("batch_id", "refusal")


@query("reconcile_tables", """
SELECT DISTINCT p_name AS table_name FROM part WHERE p_brand <> 'Brand#3'
EXCEPT SELECT p_name FROM part WHERE p_size > 45""")
def reconcile_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Loaded names that never arrived in the next step."""
    parts = table(spark, folder, "part").withColumnRenamed("p_name", "table_name")
    return missing_names(parts.where("p_brand <> 'Brand#3'"), parts.where("p_size > 45"), "table_name")


# ---- sources ---------------------------------------------------------------------------

def source_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as source settings in every combination of mode, mark and checkpoint."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("id"), F.col("c_name").alias("name"),
        F.concat(F.lit("https://api.example.org/"), key).alias("url"), F.lit("0 * * * *").alias("cron"),
        F.when(key % 2 == 0, "full_snapshot").otherwise("incremental_upsert").alias("load_mode"),
        F.when(key % 9 == 0, None).otherwise("close_on_full_snapshot").alias("delete_policy"),
        F.lit("updated_since").alias("incremental_param"),
        F.when(key % 3 == 0, " ").otherwise("updated_at").alias("watermark_field"),
        F.when(key % 5 > 1, F.concat(F.lit("2024-01-0"), key % 5)).alias("checkpoint"),
        F.lit("2024-05-01T00:00:00Z").alias("next_run"), (key % 7 == 0).alias("force_full"),
        F.array(F.lit("id")).alias("key_fields"),
    )


@query("effective_mode", """
SELECT c_custkey AS id,
  CASE WHEN c_custkey % 7 = 0 OR (c_custkey % 3 <> 0 AND c_custkey % 5 <= 1) OR c_custkey % 2 = 0
       THEN 'full_snapshot' ELSE 'incremental_upsert' END AS effective_mode,
  CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 3 <> 0 AND c_custkey % 5 > 1
       THEN '2024-01-0' || c_custkey % 5 END AS effective_checkpoint,
  'close_on_full_snapshot' AS effective_policy
FROM customer""")
def effective_mode(spark: SparkSession, folder: str) -> DataFrame:
    return run_plans(source_rows(spark, folder)).select(
        "id", "effective_mode", "effective_checkpoint", "effective_policy"
    )


@query("checkpoint_reset", """
SELECT c_custkey AS id,
  CASE WHEN c_custkey % 5 > 1 AND NOT (c_custkey % 11 IN (1, 2, 3, 4) OR (c_custkey % 11 = 5 AND c_custkey % 2 = 1))
       THEN '2024-01-0' || c_custkey % 5 END AS checkpoint,
  CASE WHEN c_custkey % 11 <> 6 THEN '2024-05-01T00:00:00Z' END AS next_run,
  CASE WHEN c_custkey % 11 = 7 THEN 'never_close' WHEN c_custkey % 9 <> 0 THEN 'close_on_full_snapshot' END
    AS delete_policy
FROM customer""")
def checkpoint_reset(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of what is read drop the checkpoint; schedule, policy and keys do not."""
    sources = source_rows(spark, folder)
    which = F.col("id") % 11
    changes = sources.where(which.between(1, 7)).select(
        "id", F.when(which == 1, F.concat("url", F.lit("/v2"))).otherwise(F.col("url")).alias("url"),
        F.when(which == 6, "5 * * * *").otherwise(F.col("cron")).alias("cron"),
        F.when(which == 2, F.when(F.col("load_mode") == "full_snapshot", "incremental_upsert").otherwise("full_snapshot"))
        .when(which == 5, "full_snapshot").otherwise(F.col("load_mode")).alias("load_mode"),
        F.when(which == 7, "never_close").otherwise(F.col("delete_policy")).alias("delete_policy"),
        F.when(which == 3, "since").otherwise(F.col("incremental_param")).alias("incremental_param"),
        F.when(which == 4, "changed_at").otherwise(F.col("watermark_field")).alias("watermark_field"),
    )
    return update_sources(sources, changes).select("id", "checkpoint", "next_run", "delete_policy")


@query("validate_sources", """
SELECT page_id, CASE page_id % 8 WHEN 0 THEN 'url' WHEN 1 THEN 'url' WHEN 2 THEN 'load_mode'
  WHEN 3 THEN 'delete_policy' WHEN 4 THEN 'incremental_param' WHEN 5 THEN 'key_fields' END AS problem
FROM pages""")
def validate_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Page addresses as source settings with one fault of each kind seeded in."""
    which = F.col("page_id") % 8
    sources = table(spark, folder, "pages").select(
        "page_id",
        F.when(which == 0, F.regexp_replace("url", "^https?", "ftp")).when(which == 1, "https:///path only")
        .when(which == 7, " LOCAL://Demo ").otherwise(F.col("url")).alias("url"),
        F.when(which == 2, "append").when(which.isin(4, 6), "incremental_upsert")
        .otherwise("full_snapshot").alias("load_mode"),
        F.when(which == 3, "drop").when(which == 6, None).otherwise("never_close").alias("delete_policy"),
        F.when(which == 4, " ").otherwise("since").alias("incremental_param"),
        F.lit("updated_at").alias("watermark_field"),
        F.when(which == 5, F.array(F.lit("id"), F.lit(" "))).otherwise(F.array(F.lit("id"))).alias("key_fields"),
    )
    return sources.select("page_id", source_problem().alias("problem"))


# ---- runs ------------------------------------------------------------------------------

def runs(spark: SparkSession, folder: str) -> DataFrame:
    """Events as runs: purchases succeed, errors fail, the rest is still running."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        (F.col("event_id") + 1).alias("id"), F.concat(F.lit("s"), "user_id").alias("source"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("started"),
        F.when(kind.isin("purchase", "error"), F.date_format(F.col("ts") + F.expr("INTERVAL 5 MINUTES"), "yyyy-MM-dd HH:mm:ss"))
        .alias("finished"),
        F.when(kind == "purchase", "done").when(kind == "error", "failed").otherwise("running").alias("status"),
        F.when(kind == "error", F.concat(F.lit("code "), F.col("event_id"))).alias("error"),
        F.when(kind == "purchase", "done").otherwise("load").alias("step"),
    )


RUNS = """
WITH runs AS (
  SELECT event_id + 1 AS id, 's' || user_id AS source, strftime(ts, '%Y-%m-%d %H:%M:%S') AS started,
         CASE WHEN event_type IN ('purchase', 'error') THEN strftime(ts + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') END
           AS finished,
         CASE event_type WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' ELSE 'running' END AS status,
         CASE WHEN event_type = 'error' THEN 'code ' || event_id END AS error,
         CASE WHEN event_type = 'purchase' THEN 'done' ELSE 'load' END AS step
  FROM events)
"""


@query("run_report", RUNS + """,
facts AS (
  SELECT source, max_by(finished, id) FILTER (status = 'done') AS last_successful_run,
         max(id) FILTER (status = 'done') AS done, max(id) FILTER (status = 'failed') AS failed
  FROM runs GROUP BY source)
SELECT x.source AS name, last_successful_run, bad.error AS last_error, bad.step AS last_error_step,
       bad.id AS last_error_run_id, bad.started AS last_error_started
FROM facts x LEFT JOIN runs bad ON bad.id = x.failed AND (x.done IS NULL OR x.failed > x.done)
UNION ALL SELECT 'never run', NULL, NULL, NULL, NULL, NULL""")
def run_report(spark: SparkSession, folder: str) -> DataFrame:
    """Per source the last success and the failure that is still open."""
    ledger = runs(spark, folder)
    never = spark.range(1).select(F.lit("never run").alias("name"))
    names = ledger.select(F.col("source").alias("name")).distinct().unionByName(never)
    return source_report(names, ledger)


@query("last_successes", RUNS + """
SELECT source, arg_max(finished, id) FILTER (WHERE status = 'done') AS last_successful_run
FROM runs GROUP BY source""")
def successes(spark: SparkSession, folder: str) -> DataFrame:
    return last_successes(runs(spark, folder))


@query("recent_runs", RUNS + " SELECT id, source, status, started FROM runs ORDER BY id DESC LIMIT 50")
def recent(spark: SparkSession, folder: str) -> DataFrame:
    return recent_runs(runs(spark, folder)).select("id", "source", "status", "started")


RUN_EVENTS = """
WITH e AS (SELECT event_id, event_id // 4 AS run_id, event_id AS seq, 's' || (event_id // 4 % 50) AS source,
  CASE WHEN event_id % 4 = 3 THEN CASE WHEN event_type = 'error' THEN 'failed' ELSE 'done' END
       WHEN event_id % 4 = 1 THEN 'running' WHEN event_id % 4 = 0 THEN 'queued' END AS status,
  CASE WHEN event_id % 4 = 2 AND event_type <> 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS checkpoint_after,
  CASE WHEN event_id % 4 = 3 AND event_type = 'error' THEN 'code ' || user_id END AS error
  FROM events)
"""


def run_event_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events as the events of runs of four steps each."""
    step, error = F.col("event_id") % 4, F.col("event_type") == "error"
    run = F.floor(F.col("event_id") / 4)
    return table(spark, folder, "events").select(
        run.alias("run_id"), F.col("event_id").alias("seq"), F.col("ts").alias("at"),
        F.concat(F.lit("s"), run % 50).alias("source"),
        F.when(step == 3, F.when(error, "failed").otherwise("done")).when(step == 1, "running")
        .when(step == 0, "queued").alias("status"),
        F.when((step == 2) & (F.col("event_type") != "click"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("checkpoint_after"),
        F.when((step == 3) & error, F.concat(F.lit("code "), "user_id")).alias("error"),
    )


@query("run_states", RUN_EVENTS + """
SELECT run_id, any_value(source) AS source, arg_max(status, seq) FILTER (WHERE status IS NOT NULL) AS status,
       max(checkpoint_after) AS checkpoint_after, max(error) AS error
FROM e GROUP BY run_id""")
def folded_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Events of a run folded to its last state."""
    return run_states(run_event_rows(spark, folder)).select(
        "run_id", "source", "status", "checkpoint_after", "error"
    )


@query("checkpoint_commit", RUN_EVENTS + """,
r AS (SELECT run_id, any_value(source) AS source, arg_max(status, seq) FILTER (WHERE status IS NOT NULL) AS status,
             max(checkpoint_after) AS checkpoint_after FROM e GROUP BY run_id)
SELECT source, arg_max(checkpoint_after, run_id) AS checkpoint FROM r
WHERE status = 'done' AND checkpoint_after IS NOT NULL GROUP BY source""")
def checkpoint_commit(spark: SparkSession, folder: str) -> DataFrame:
    """Only runs that went through commit their checkpoint; the last commit counts."""
    finished = run_states(run_event_rows(spark, folder)).where("status = 'done'")
    return committed_checkpoints(finished.select(
        "source", F.col("run_id").alias("seq"), F.col("checkpoint_after").alias("checkpoint")
    ))


@query("freshness_rollup", """
SELECT user_id, CASE WHEN count(*) FILTER (WHERE event_type = 'signup' AND user_id % 3 = 0) > 0 THEN 'starting'
  WHEN count(*) FILTER (WHERE event_type = 'error' AND user_id % 3 <> 1) = 0 THEN 'ok' ELSE 'degraded' END AS status
FROM events GROUP BY user_id""")
def freshness_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Users as tables: one unknown update is enough for ``starting``, one failed for ``degraded``."""
    kind, user = F.col("event_type"), F.col("user_id")
    states = table(spark, folder, "events").select(
        "user_id",
        F.when((kind == "signup") & (user % 3 == 0), F.lit(None).cast("boolean"))
        .otherwise(~((kind == "error") & (user % 3 != 1))).alias("healthy"),
    )
    return freshness(states, "user_id")


# ---- slices and marks ------------------------------------------------------------------

@query("incremental_slice", """
WITH c AS (SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00')
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN microsecond(ts) % 1000000 <> 0 THEN strftime(ts, '.%f') ELSE '' END || 'Z' AS updated_at,
       user_id, (SELECT count(*) FROM c) AS total, 500 AS skip, 1000 AS "limit",
       (SELECT count(*) FROM c) > 1500 AS has_more
FROM c ORDER BY event_id LIMIT 1000 OFFSET 500""")
def incremental_slice(spark: SparkSession, folder: str) -> DataFrame:
    """One page of what changed after a checkpoint; the limit is the page size."""
    events = table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("updated_at"), "user_id"
    )
    since = F.lit(datetime(2024, 1, 10, tzinfo=timezone.utc))
    return list_page(events, "event_id", 1000, 500, since=since)


@query("column_high_water_mark", """
SELECT strftime(greatest(max(o_orderdate), TIMESTAMP '1990-01-01'), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS checkpoint,
       count(o_orderdate) AS found FROM orders""")
def orders_mark(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(F.col("o_orderdate").cast("timestamp").alias("updated_at"))
    return column_high_water_mark(orders, "updated_at", "1990-01-01T00:00:00+00:00")


# ---- statistics and changes ------------------------------------------------------------

@query("dataset_stats", """
WITH r AS (SELECT count(*) AS n, sum(strlen(to_json({doc_id: doc_id, text: text, lang: lang, source: source,
             n_chars: n_chars})::VARCHAR)) AS bytes FROM documents)
SELECT n AS rows, CAST(bytes + n - 1 + strlen('{"items":[],"total":' || n || ',"skip":' || ((n - 1) // 1000 * 1000)
         || ',"limit":1000,"has_more":false}') AS BIGINT) AS json_bytes FROM r""")
def documents_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and exact JSON size of whole documents."""
    return dataset_stats(table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars"))


@query("first_ids", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 20")
def first_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The first twenty rows by id; the limit is the operator."""
    return first_rows(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderkey", 20)


@query("backfill_defaults", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus ELSE o_orderpriority END AS record_type,
  CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS INT) ELSE CAST(o_orderkey % 1000 AS INT) END AS score,
  '{"customer":' || o_custkey || '}' AS attributes
FROM orders""")
def backfill_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Missing types, scores and attributes are filled from the row, values that are there stay."""
    key = F.col("o_orderkey")
    gaps = table(spark, folder, "orders").select(
        key.alias("id"), F.when(key % 4 != 0, F.col("o_orderstatus")).alias("record_type"),
        F.when(key % 5 != 0, F.col("o_custkey").cast("int")).alias("score"),
        F.lit(None).cast("string").alias("attributes"), "o_orderpriority", "o_custkey",
    )
    return backfill(gaps, {
        "record_type": F.col("o_orderpriority"), "score": (F.col("id") % 1000).cast("int"),
        "attributes": F.to_json(F.struct(F.col("o_custkey").alias("customer"))),
    }).drop("o_orderpriority", "o_custkey")
