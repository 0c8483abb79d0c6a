"""Micro-batches over landed extracts: every new manifest is one run."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..options import SourceConfig
from ..plans.run import Request, run_source
from ..plans.store import Warehouse, at_once
from ..sources.manifests import MANIFEST_SCHEMA, MANIFEST_SUFFIX


def manifest_stream(warehouse: Warehouse, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Stream of the manifests below a landing folder; they are written after the payload."""
    return (
        warehouse.spark.readStream.schema(MANIFEST_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(f"{folder}/*{MANIFEST_SUFFIX}")
    )


def ingest_landings(
    warehouse: Warehouse, sources: Mapping[str, SourceConfig], folder: str, checkpoint: str,
    files_per_batch: int = 100,
) -> StreamingQuery:
    """Run the pipeline for every extract that landed since the last call.

    Extracts of one source are run in the order they were fetched, those of different sources at
    once. A micro-batch that is replayed skips the extracts whose run is finished. An extract that is incomplete or of an
    unknown source is recorded as a failed run. Manifests are metadata, one row per
    extract, and their number per micro-batch is bounded.
    """
    def run_one(row: Row) -> None:
        problem = (
            "unknown source" if row["source"] not in sources
            else None if row["pagination_complete"] else "the extract lacks pages that its source still has"
        )
        if problem is not None:
            warehouse.append_run_events(int(row["run_id"]), row["source"], {
                "status": "failed", "step": "extract", "error": problem, "filename": row["payload_filename"],
            })
            return
        request = Request(
            row["payload_filename"], row["source"], row["run_id"], row["load_mode"],
            row["delete_policy"], row["checkpoint_before"], row["checkpoint_after"],
            row["pagination_complete"],
        )
        run_source(
            warehouse, sources[row["source"]], folder=folder, request=request,
            effective_at=datetime.fromisoformat(row["fetched_at"]),
        )

    def run_batch(manifests: DataFrame, _: int) -> None:
        finished = warehouse.finished_files(manifests)
        by_source: dict[str, list[Row]] = {}
        for row in manifests.orderBy("fetched_at", F.col("run_id").cast("bigint")).collect():
            if (row["source"], row["payload_filename"]) not in finished:
                by_source.setdefault(row["source"], []).append(row)
        # Sources have tables of their own; extracts of one source build on each other.
        at_once(lambda rows: [run_one(row) for row in rows], by_source.values())

    return (
        manifest_stream(warehouse, folder, files_per_batch).writeStream
        .option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(run_batch).start()
    )
