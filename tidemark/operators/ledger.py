"""Batch and run ledgers as tables: registration, gates, folding and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.numbering import dense_ids
from ..options import (
    CLOSE_ON_FULL_SNAPSHOT, DELETE_POLICIES, DEMO_ADDRESS, FULL_SNAPSHOT, INCREMENTAL_UPSERT, LOAD_MODES,
    READ_SETTINGS,
)

# Fields a run event may set.
RUN_FIELDS = (
    "status", "step", "error", "filename", "batch_id", "finished", "checkpoint_before",
    "checkpoint_after", "load_mode",
)


# ---- batches ---------------------------------------------------------------------------

def register_batches(ledger: DataFrame, files: DataFrame) -> DataFrame:
    """Give every new file a batch id; a known one returns its id and tables.

    ``status`` is ``loaded`` or ``skipped_duplicate``. A file named several times in one call
    is new once; ``arrival`` orders its rows.
    """
    known = ledger.groupBy("filename").agg(
        F.min("id").alias("known_id"), F.min_by("table_names", "id").alias("known_tables"),
    )
    firsts = files.groupBy("filename").agg(F.min("arrival").alias("first_arrival"))
    placed = firsts.join(known, "filename", "left")
    top = ledger.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    new = dense_ids(
        placed.where("known_id IS NULL").select("filename"), "filename", top, "new_id"
    )
    ids = placed.join(new, "filename", "left")
    is_new = F.col("known_id").isNull() & (F.col("arrival") == F.col("first_arrival"))
    return files.join(ids, "filename").select(
        *files.columns,
        F.coalesce("known_id", "new_id").alias("batch_id"),
        F.when(is_new, "loaded").otherwise("skipped_duplicate").alias("status"),
        F.when(~is_new, F.col("known_tables")).alias("tables"),
    )


def batch_gate(requests: DataFrame, ledger: DataFrame) -> DataFrame:
    """Add ``refusal``: why a batch may not be synchronised, NULL when it may."""
    row = ledger.select(
        F.col("id").alias("batch_id"), F.col("source").alias("_source"),
        F.col("load_mode").alias("_mode"), F.col("delete_policy").alias("_policy"),
        F.col("pagination_complete").alias("_complete"), F.lit(True).alias("_exists"),
    )
    matches = (
        F.col("source").eqNullSafe(F.col("_source")) & F.col("load_mode").eqNullSafe(F.col("_mode"))
        & F.col("delete_policy").eqNullSafe(F.col("_policy"))
    )
    refusal = (
        F.when(~F.coalesce(F.col("load_mode").isin(*LOAD_MODES), F.lit(False)), "unsupported load mode")
        .when(
            ~F.coalesce(F.col("delete_policy").isin(*DELETE_POLICIES), F.lit(False)),
            "unsupported delete policy",
        )
        .when(F.col("_exists").isNull(), "batch does not exist")
        .when(~matches, "batch metadata does not match")
        .when(~F.col("_complete"), "batch is incomplete")
    )
    return requests.join(row, "batch_id", "left").select(*requests.columns, refusal.alias("refusal"))


# ---- sources ---------------------------------------------------------------------------

def source_problem() -> Column:
    """First problem of a row of source settings, NULL when they are valid."""
    url = F.trim(F.regexp_replace("url", r"^\s+|\s+$", ""))
    absolute = (urls.scheme(url).isin("http", "https") & (urls.host(url) != "")) | url.rlike(DEMO_ADDRESS)
    blank_watermark = F.trim(F.coalesce("watermark_field", F.lit(""))) == ""
    blank_param = F.trim(F.coalesce("incremental_param", F.lit(""))) == ""
    return (
        F.when(~F.coalesce(absolute, F.lit(False)), "url")
        .when(~F.coalesce(F.col("load_mode").isin(*LOAD_MODES), F.lit(False)), "load_mode")
        .when(~F.coalesce(F.col("delete_policy").isin(*DELETE_POLICIES), F.lit(True)), "delete_policy")
        .when(
            (F.col("load_mode") == INCREMENTAL_UPSERT) & ~blank_watermark & blank_param,
            "incremental_param",
        )
        .when(F.exists("key_fields", lambda key: F.trim(key) == ""), "key_fields")
    )


def run_plans(sources: DataFrame) -> DataFrame:
    """Add ``effective_mode`` and ``effective_checkpoint`` of the next run of each source."""
    watermark = F.trim(F.coalesce("watermark_field", F.lit(""))) != ""
    has_checkpoint = F.coalesce("checkpoint", F.lit("")) != ""
    full = F.col("force_full") | (watermark & ~has_checkpoint)
    return sources.withColumns({
        "effective_mode": F.when(full, FULL_SNAPSHOT).otherwise(F.col("load_mode")),
        "effective_checkpoint": F.when(~F.col("force_full") & watermark, F.col("checkpoint")),
        "effective_policy": F.coalesce("delete_policy", F.lit(CLOSE_ON_FULL_SNAPSHOT)),
    })


def update_sources(sources: DataFrame, changes: DataFrame) -> DataFrame:
    """Apply new settings by ``id``; a change of what is read drops the checkpoint.

    A changed schedule clears ``next_run``. Keys and policy keep both.
    """
    settings = [name for name in changes.columns if name != "id"]
    new = changes.select(
        "id", F.lit(True).alias("_changed"), *[F.col(name).alias(f"_{name}") for name in settings]
    )

    def differs(*fields: str) -> Column:
        result = F.lit(False)
        for name in fields:
            if name in settings:
                result = result | ~F.col(name).eqNullSafe(F.col(f"_{name}"))
        return F.coalesce(F.col("_changed"), F.lit(False)) & result

    reset = differs(*READ_SETTINGS)
    values = {
        name: F.when(F.col("_changed"), F.col(f"_{name}")).otherwise(F.col(name)) for name in settings
    }
    values["checkpoint"] = F.when(~reset, F.col("checkpoint"))
    if "next_run" in sources.columns:
        values["next_run"] = F.when(~differs("cron"), F.col("next_run"))
    return sources.join(new, "id", "left").select(
        *[values.get(name, F.col(name)).alias(name) for name in sources.columns]
    )


# ---- runs ------------------------------------------------------------------------------

def run_states(events: DataFrame) -> DataFrame:
    """Last state of every run of a source: for each field the latest value that was set.

    Sources number their runs by themselves, so a run is known by both.
    """
    def last(name: str) -> Column:
        value = F.col(name)
        return F.max_by(value, F.when(value.isNotNull(), F.col("seq"))).alias(name)

    fields = [name for name in RUN_FIELDS if name in events.columns]
    return events.groupBy("source", "run_id").agg(F.min("at").alias("started"), *map(last, fields))


def last_successes(runs: DataFrame) -> DataFrame:
    """Finish time of the newest successful run of each source."""
    done = F.when(F.col("status") == "done", F.col("id"))
    return runs.groupBy("source").agg(F.max_by("finished", done).alias("last_successful_run"))


def source_report(sources: DataFrame, runs: DataFrame) -> DataFrame:
    """Sources with their last success and the failure that came after it, if any."""
    done = F.when(F.col("status") == "done", F.col("id"))
    failed = F.when(F.col("status") == "failed", F.col("id"))
    facts = runs.groupBy("source").agg(
        F.max_by("finished", done).alias("last_successful_run"), F.max(done).alias("_done"),
        F.max(failed).alias("_failed"),
        F.max_by(F.struct("error", "step", "started"), failed).alias("_failure"),
    )
    open_failure = F.col("_failed") > F.coalesce("_done", F.lit(0))

    def failure(name: str) -> Column:
        return F.when(open_failure, F.col(f"_failure.{name}"))

    return sources.join(facts.withColumnRenamed("source", "name"), "name", "left").select(
        *sources.columns, "last_successful_run", failure("error").alias("last_error"),
        failure("step").alias("last_error_step"),
        F.when(open_failure, F.col("_failed")).alias("last_error_run_id"),
        failure("started").alias("last_error_started"),
    )


def recent_runs(runs: DataFrame, limit: int = 50) -> DataFrame:
    return runs.orderBy(F.desc("id")).limit(limit)


def committed_checkpoints(checkpoints: DataFrame) -> DataFrame:
    """Checkpoint of every source: the one committed last."""
    return checkpoints.where("checkpoint IS NOT NULL").groupBy("source").agg(
        F.max_by("checkpoint", "seq").alias("checkpoint")
    )


def freshness(states: DataFrame, group: str, healthy: str = "healthy") -> DataFrame:
    """Roll-up of a flag: any unknown is ``starting``, all true ``ok``, else ``degraded``."""
    return states.groupBy(group).agg(
        F.when(F.count_if(F.col(healthy).isNull()) > 0, "starting")
        .when(F.bool_and(healthy), "ok").otherwise("degraded").alias("status")
    )
