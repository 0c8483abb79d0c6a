"""Queries that go through a warehouse on storage: landing, runs, marts and the stream."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...options import CLOSE_ON_FULL_SNAPSHOT, FULL_SNAPSHOT, INCREMENTAL_UPSERT, SourceConfig
from ...session import scratch_folder
from ...sources.landing import write_landing
from ...sources.slices import changed_since
from ...streaming.landings import ingest_landings
from ..run import Request, run_source
from ..store import Warehouse
from .history import COLUMNS, SNAPSHOTS, first_snapshot, merged_sql, second_snapshot
from .paging import as_pages, page_rows, with_totals
from .registry import day, query, records, table

SOURCE = SourceConfig("Customers", "https://api.example.org/customers", key_fields=("c_custkey",), watermark_field="")
DAYS = (datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 2, 1, tzinfo=timezone.utc))


def land(warehouse: Warehouse, rows: DataFrame, folder: str, run_id: int, at: datetime) -> Request:
    """Land a snapshot of customers as JSON records."""
    # Every step takes long for few bytes, and reads the files that landing writes: as many as there are tasks.
    documents = records(rows.repartition("c_custkey"), F.col("c_custkey"), F.struct(*rows.columns))
    manifest = write_landing(documents, folder, SOURCE.name, {
        "run_id": str(run_id), "load_mode": FULL_SNAPSHOT, "delete_policy": CLOSE_ON_FULL_SNAPSHOT,
        "pagination_complete": True, "requested_url": SOURCE.url, "fetched_at": at.isoformat(),
    }, f"customers_{run_id}.json")
    return Request(
        manifest["payload_filename"], SOURCE.name, str(run_id), FULL_SNAPSHOT, CLOSE_ON_FULL_SNAPSHOT,
    )


@query("staging_roundtrip", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def staging_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """A table through landing, staging, history and mart, sent twice: it comes back as it was."""
    root = scratch_folder(spark)
    warehouse = Warehouse(spark, f"{root}/warehouse")
    request = land(warehouse, first_snapshot(spark, folder), f"{root}/landing", 1, DAYS[0])
    for _ in range(2):
        run_source(warehouse, SOURCE, folder=f"{root}/landing", request=request, effective_at=DAYS[0])
    mart = warehouse.mart("customers")
    return mart.select("c_custkey", "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"), "c_acctbal", "c_mktsegment")


WAREHOUSE_SQL = SNAPSHOTS + merged_sql("v1", "v2", "2024-01-01", "2024-02-01", True)


def stored_versions(warehouse: Warehouse) -> DataFrame:
    dimension = warehouse.dimension("dim_customers").withColumn("c_nationkey", F.col("c_nationkey").cast("int"))
    return dimension.select(*COLUMNS, day("valid_from"), day("valid_to"), "is_current")


@query("warehouse_runs", WAREHOUSE_SQL)
def warehouse_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Two full runs over storage; the dimension is read back with all its versions."""
    root = scratch_folder(spark)
    warehouse = Warehouse(spark, f"{root}/warehouse")
    first = first_snapshot(spark, folder)
    for run_id, (rows, at) in enumerate(zip((first, second_snapshot(first)), DAYS), start=1):
        request = land(warehouse, rows, f"{root}/landing", run_id, at)
        run_source(warehouse, SOURCE, folder=f"{root}/landing", request=request, effective_at=at)
    return stored_versions(warehouse)


@query("stream_scd2", WAREHOUSE_SQL)
def stream_scd2(spark: SparkSession, folder: str) -> DataFrame:
    """The same two snapshots as a stream of landed extracts."""
    root = scratch_folder(spark)
    warehouse = Warehouse(spark, f"{root}/warehouse")
    first = first_snapshot(spark, folder)
    for run_id, (rows, at) in enumerate(zip((first, second_snapshot(first)), DAYS), start=1):
        land(warehouse, rows, f"{root}/landing", run_id, at)
    ingest_landings(
        warehouse, {SOURCE.name: SOURCE}, f"{root}/landing", f"{root}/stream"
    ).awaitTermination()
    return stored_versions(warehouse)


@query("incremental_runs", """
WITH e AS (SELECT event_id, event_type, date_trunc('second', ts) AS ts FROM events),
half AS (SELECT date_trunc('second', min(ts) + (max(ts) - min(ts)) / 2) AS mid FROM events),
runs AS (SELECT 1 AS run, * FROM e, half WHERE ts <= mid UNION ALL SELECT 2, * FROM e, half WHERE ts > mid)
SELECT run, count(*) AS sent, count(DISTINCT event_id) AS inserted, 0 AS closed,
       strftime(max(ts), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS checkpoint
FROM runs GROUP BY run""")
def incremental_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A full first run and an incremental second one that starts after its checkpoint."""
    root = scratch_folder(spark)
    warehouse = Warehouse(spark, f"{root}/warehouse")
    events = table(spark, folder, "events").select(
        "event_id", F.date_trunc("second", F.col("ts").cast("timestamp")).alias("updated_at"), "event_type"
    )
    bounds = events.agg(F.min("updated_at").alias("low"), F.max("updated_at").alias("high")).first()
    exact = table(spark, folder, "events").agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    half = exact["low"] + (exact["high"] - exact["low"]) / 2
    cuts = [half.replace(microsecond=0, tzinfo=timezone.utc), bounds["high"].replace(tzinfo=timezone.utc)]
    source = SourceConfig(
        "event feed", "https://api.example.org/feed", load_mode=INCREMENTAL_UPSERT, key_fields=("event_id",),
    )

    def fetch_until(cut: datetime):
        def fetch(_: str, checkpoint: str | None) -> DataFrame:
            since = None if checkpoint is None else F.lit(datetime.fromisoformat(checkpoint))
            changed = changed_since(events, "updated_at", since).where(F.col("updated_at") <= F.lit(cut))
            item = F.struct("event_id", F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"), "event_type")
            numbered = page_rows(changed, "event_id", item)
            # One extraction: pages are renumbered from one, in the order of their ids.
            pages = numbered.withColumn("page_no", F.col("run") * 20 + F.col("page_no")).withColumn("run", F.lit(1))
            lowest = pages.agg(F.min("page_no")).first()[0]
            pages = with_totals(pages.withColumn("page_no", F.col("page_no") - lowest + 1))
            more = F.col("page_no") < F.col("last_page")
            body = F.concat(
                F.lit('{"items":'), F.to_json("list"), F.lit(',"has_more":'),
                more.cast("string"), F.lit("}"),
            )
            return as_pages(pages, body, F.concat(F.lit("https://api.example.org/feed?page="), "page_no"))
        return fetch

    rows = []
    for run, (cut, at) in enumerate(zip(cuts, DAYS), start=1):
        result = run_source(warehouse, source, fetch_until(cut), folder=f"{root}/landing", effective_at=at)
        counts = result.dimensions["dim_event_feed"]
        rows.append((run, result.tables["event_feed"], counts["inserted_rows"], counts["closed_rows"], result.checkpoint))
    return spark.createDataFrame(rows, "run INT, sent BIGINT, inserted BIGINT, closed BIGINT, checkpoint STRING")


@query("reset_runs", """
WITH c AS (SELECT c_custkey, DATE '2024-01-01' + CAST(c_custkey % 50 AS INTEGER) AS day FROM customer),
m AS (SELECT strftime(max(day), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS mark, count(*) AS n, count(*) FILTER (WHERE day > DATE '2024-02-01') AS late
      FROM c)
SELECT 1 AS run, 'full_snapshot' AS asked_mode, NULL AS asked_after, n AS sent, mark AS checkpoint FROM m
UNION ALL SELECT 2, 'incremental_upsert', mark, 0, mark FROM m
UNION ALL SELECT 3, 'full_snapshot', NULL, late, mark FROM m""")
def reset_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A first run, one after its checkpoint, and one whose changed address drops the checkpoint."""
    root = scratch_folder(spark)
    warehouse = Warehouse(spark, f"{root}/warehouse")
    day_of = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % 50).cast("int")).cast("timestamp")
    customers = table(spark, folder, "customer").select("c_custkey", day_of.alias("updated_at"), "c_name")
    rows, asked = [], []

    def fetch_from(wanted: DataFrame):
        def fetch(mode: str, checkpoint: str | None) -> DataFrame:
            asked.append((mode, checkpoint))
            since = None if checkpoint is None else F.lit(datetime.fromisoformat(checkpoint))
            changed = changed_since(wanted, "updated_at", since)
            item = F.struct("c_custkey", F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"), "c_name")
            numbered = page_rows(changed, "c_custkey", item)
            lists = numbered.withColumn("page_no", F.col("run") * 20 + F.col("page_no")).withColumn("run", F.lit(1))
            if lists.isEmpty():
                # A run without changes still sends its one empty page.
                lists = spark.range(1).select(
                    F.lit(1).alias("run"), F.lit(1).cast("bigint").alias("page_no"),
                    F.from_json(F.lit("[]"), lists.schema["list"].dataType.simpleString()).alias("list"),
                )
            lowest = lists.agg(F.min("page_no")).first()[0]
            pages = with_totals(lists.withColumn("page_no", F.col("page_no") - lowest + 1))
            body = F.concat(
                F.lit('{"items":'), F.to_json("list"), F.lit(',"has_more":'),
                (F.col("page_no") < F.col("last_page")).cast("string"), F.lit("}"),
            )
            return as_pages(pages, body, F.concat(F.lit(f"{base}?page="), "page_no"))
        return fetch

    source = SourceConfig("mailing list", "https://api.example.org/v1", load_mode=INCREMENTAL_UPSERT, key_fields=("c_custkey",))
    late = customers.where("updated_at > TIMESTAMP '2024-02-01 00:00:00'")
    for run, (wanted, changes) in enumerate([(customers, {}), (customers, {}), (late, {"url": "https://api.example.org/v2"})], start=1):
        source = source.updated(**changes)
        base = source.url
        result = run_source(warehouse, source, fetch_from(wanted), folder=f"{root}/landing", effective_at=DAYS[0] + timedelta(days=run))
        rows.append((run, *asked[-1], result.tables["mailing_list"], result.checkpoint))
    return spark.createDataFrame(rows, "run INT, asked_mode STRING, asked_after STRING, sent BIGINT, checkpoint STRING")
