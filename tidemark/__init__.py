"""Incremental warehouse on Spark: JSON extracts to history tables and published marts."""

from .operators.flatten import flatten
from .operators.history import merge, sync_batch, sync_users
from .options import PipelineError, SourceConfig
from .plans.run import Request, RunResult, run_source
from .plans.store import Warehouse
from .session import configure, local_session, scratch_folder

__all__ = [
    "PipelineError", "Request", "RunResult", "SourceConfig", "Warehouse", "configure", "flatten",
    "local_session", "merge", "run_source", "scratch_folder", "sync_batch", "sync_users",
]
