"""Run one source end to end: land, validate, stage, merge, publish, commit the checkpoint."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import check_root_table, dimension_name, identifier
from ..operators.flatten import flatten
from ..operators.history import keyed_master, keyed_tables
from ..operators.reconcile import check_arrived
from ..operators.shape import discover
from ..operators.watermark import run_checkpoint
from ..options import INCREMENTAL_UPSERT, PipelineError, SourceConfig
from ..sources.landing import inspect_landing, read_manifest, write_landing
from ..sources.manifests import validate_manifests
from ..sources.pages import (
    PAGE_SCHEMA, assemble_pages, empty_payload, page_chain_audit, run_complete,
)
from ..sources.payloads import scan_document, scan_records
from .store import Warehouse

# Pages of a source for a load mode and the checkpoint to start after.
Fetch = Callable[[str, str | None], DataFrame]


@dataclass
class Request:
    """What a run asks for; the manifest of its extract has to agree."""

    filename: str
    source: str
    run_id: str
    load_mode: str
    delete_policy: str
    checkpoint_before: str | None = None
    checkpoint_after: str | None = None
    pagination_complete: bool = True


@dataclass
class RunResult:
    run_id: int
    status: str
    batch_id: int | None = None
    tables: dict[str, int] = field(default_factory=dict)
    dimensions: dict[str, dict] = field(default_factory=dict)
    marts: list[dict] = field(default_factory=list)
    checkpoint: str | None = None


def _now_text() -> str:
    return datetime.now(timezone.utc).isoformat()


def land_pages(
    warehouse: Warehouse, pages: DataFrame, source: SourceConfig, run_id: int, load_mode: str,
    checkpoint_before: str | None, folder: str,
) -> Request:
    """Combine the pages of one extraction and land them; refuses chains that are not whole.

    Pages are written as they arrive, so the source is read once however often the checks
    and the assembly look at them.
    """
    raw = f"{folder}/_pages/{identifier(source.name)}-{run_id}"
    pages.write.mode("overwrite").parquet(raw)
    pages = warehouse.spark.read.schema(PAGE_SCHEMA).parquet(raw)
    broken = page_chain_audit(pages).where("problem IS NOT NULL").orderBy("page_no").first()
    if broken is not None:
        raise PipelineError("extract", f"page {broken['page_no']}: {broken['problem']}")
    # Bodies are large: their structure is found once, for all that looks into them.
    shape = discover(pages, "body")
    state = run_complete(pages, shape).first()
    if state is None or not state["pagination_complete"]:
        raise PipelineError("extract", "the extract lacks pages that its source still has")
    try:
        records = assemble_pages(pages).select("root_index", "rec")
    except ValueError as error:
        raise PipelineError("extract", str(error)) from error
    watermark = source.watermark_field.strip()
    required = source.load_mode == INCREMENTAL_UPSERT and bool(watermark)
    one_empty = pages.count() == 1 and pages.select(empty_payload(F.col("body"))).first()[0]
    try:
        checkpoint_after = run_checkpoint(
            records, watermark, load_mode, checkpoint_before, required, bool(one_empty),
            shape=shape, marks=pages.select(F.col("body").alias("rec")),
        )
    except ValueError as error:
        raise PipelineError("extract", str(error)) from error
    manifest = {
        "run_id": str(run_id), "load_mode": load_mode, "delete_policy": source.delete_policy,
        "checkpoint_before": checkpoint_before, "checkpoint_after": checkpoint_after,
        "pagination_complete": True, "requested_url": source.url, "final_url": source.url,
    }
    landed = write_landing(records, folder, source.name, manifest)
    return Request(
        landed["payload_filename"], source.name, str(run_id), load_mode, source.delete_policy,
        checkpoint_before, checkpoint_after,
    )


def land_document(
    warehouse: Warehouse, path: str, source: SourceConfig, run_id: int, load_mode: str,
    checkpoint_before: str | None, folder: str,
) -> Request:
    """Land a JSON document that another program wrote, as the extract of a run."""
    records = scan_document(warehouse.spark, path)
    watermark = source.watermark_field.strip()
    required = source.load_mode == INCREMENTAL_UPSERT and bool(watermark)
    try:
        checkpoint_after = run_checkpoint(records, watermark, load_mode, checkpoint_before, required)
    except ValueError as error:
        raise PipelineError("extract", str(error)) from error
    landed = write_landing(records, folder, source.name, {
        "run_id": str(run_id), "load_mode": load_mode, "delete_policy": source.delete_policy,
        "checkpoint_before": checkpoint_before, "checkpoint_after": checkpoint_after,
        "pagination_complete": True, "requested_url": source.url, "final_url": source.url,
    })
    return Request(
        landed["payload_filename"], source.name, str(run_id), load_mode, source.delete_policy,
        checkpoint_before, checkpoint_after,
    )


def load_batch(warehouse: Warehouse, request: Request, folder: str) -> tuple[int, dict[str, int]]:
    """Validate a landed extract and stage it once; a known file returns its batch."""
    spark = warehouse.spark
    known = warehouse.find_batch(request.filename)
    if known is not None:
        return known["id"], {table: 0 for table in known["table_names"]}
    asked = spark.createDataFrame(
        [tuple(vars(request).values())],
        "filename STRING, source STRING, run_id STRING, load_mode STRING, delete_policy STRING, "
        "checkpoint_before STRING, checkpoint_after STRING, pagination_complete BOOLEAN",
    )
    checked = validate_manifests(
        asked, inspect_landing(spark, folder, request.filename),
        read_manifest(spark, folder, request.filename),
    ).first()
    if checked["reject_reason"] is not None:
        raise PipelineError("load", checked["reject_reason"])
    records = scan_records(spark, f"{folder}/{request.filename}")
    batch_id, types = warehouse.next_batch_id(), warehouse.staged_types()
    try:
        batch = flatten(records, request.source, batch_id, types)
        counts = warehouse.append_batch(batch_id, batch, types, {
            "filename": request.filename, "source": request.source,
            "source_url": checked["m"]["requested_url"], "payload_filename": request.filename,
            "payload_sha256": checked["sha256"], "payload_size": checked["byte_size"],
            "run_id": request.run_id, "load_mode": request.load_mode,
            "delete_policy": request.delete_policy, "checkpoint_before": request.checkpoint_before,
            "checkpoint_after": request.checkpoint_after,
            "pagination_complete": request.pagination_complete,
        })
    except Exception:
        warehouse.release("batches", batch_id)
        raise
    return batch_id, counts


def sync_core(
    warehouse: Warehouse, batch_id: int, source: SourceConfig, load_mode: str,
    effective_at: datetime, masters: tuple[DataFrame, DataFrame] | None = None,
) -> dict[str, dict]:
    """Merge a staged batch, and the master tables if given, into the dimensions."""
    entry = warehouse.ledger.where(F.col("id") == batch_id).first()
    if entry is None:
        raise ValueError(f"staging batch {batch_id} does not exist")
    asked = (source.name, load_mode, source.delete_policy)
    if (entry["source"], entry["load_mode"], entry["delete_policy"]) != asked:
        raise ValueError(f"staging batch {batch_id} does not match the request")
    if not entry["pagination_complete"]:
        raise ValueError(f"staging batch {batch_id} is incomplete")
    types = warehouse.staged_types()
    written = set(entry["table_names"])
    tables = {
        table: warehouse.staged_batch(table, batch_id, types[table], table in written)
        for table in sorted(written | {identifier(source.name)}) if table in types
    }
    # What staging observed: whether a table has rows, and whether all of them have a parent key.
    seen = {table: (fact["rows"], fact["parented"]) for table, fact in entry["table_facts"].items()}

    def facts(table: str) -> tuple[bool, bool]:
        rows, parented = seen.get(table, (0, 0))
        return rows > 0, rows == parented

    batches = keyed_tables(tables, source.key_fields, facts)
    if masters is not None:
        batches = {
            dimension_name(entity): keyed_master(entity, rows) for entity, rows in zip(("department", "user"), masters)
        } | batches
    states = warehouse.dimension_states(names_only=set(batches))
    return warehouse.merge_batches(batches, load_mode, source.delete_policy, effective_at, states)


def run_source(
    warehouse: Warehouse, source: SourceConfig, fetch: Fetch | None = None, *, folder: str,
    request: Request | None = None, masters: tuple[DataFrame, DataFrame] | None = None,
    effective_at: datetime | None = None, force_full: bool = False,
) -> RunResult:
    """Run a source from its pages (``fetch``) or from an extract landed before (``request``).

    The checkpoint is written after everything else, so a run that fails is repeated from
    the old one. Failures are recorded with their step and raised again.
    """
    run_id = int(request.run_id) if request else warehouse.next_run_id()
    name = source.name

    def record(*events: dict) -> None:
        warehouse.append_run_events(run_id, name, *events)

    queued = [{"status": "queued", "step": "queued"}]
    step = "validate"
    try:
        source.validate()
        check_root_table(identifier(name))
        if request is None:
            plan = SourceConfig(**{**vars(source), "checkpoint": warehouse.checkpoint(name, source.read_settings) or source.checkpoint})
            load_mode, before = plan.run_plan(force_full)
        else:
            load_mode, before = request.load_mode, request.checkpoint_before
        step = "extract"
        record(*queued, {
            "status": "running", "step": step, "checkpoint_before": before, "load_mode": load_mode,
        })
        queued = []
        if request is None:
            request = land_pages(warehouse, fetch(load_mode, before), source, run_id, load_mode, before, folder)
        after = request.checkpoint_after
        step = "load"
        record({"step": step, "checkpoint_after": after, "filename": request.filename})
        batch_id, tables = load_batch(warehouse, request, folder)
        step = "core"
        record({"step": step, "batch_id": batch_id})
        effective_at = effective_at or datetime.now(timezone.utc)
        dimensions = sync_core(warehouse, batch_id, source, load_mode, effective_at, masters)
        check_arrived(step, map(dimension_name, tables), dimensions)
        step = "mart"
        record({"step": step})
        marts = warehouse.refresh_marts()
        check_arrived(step, map(dimension_name, tables), [row["dim_table"] for row in marts])
        step = "checkpoint"
        if after:
            warehouse.commit_checkpoint(name, run_id, after, source.read_settings)
        record({"status": "done", "step": "done", "finished": _now_text()})
        return RunResult(run_id, "done", batch_id, tables, dimensions, marts, after)
    except Exception as error:
        step = error.step if isinstance(error, PipelineError) else step
        record(*queued, {"status": "failed", "step": step, "error": str(error), "finished": _now_text()})
        if isinstance(error, PipelineError):
            raise
        raise PipelineError(step, str(error)) from error
