"""Checks that what one step wrote arrived in the next one."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from ..options import PipelineError


def missing_names(expected: DataFrame, arrived: DataFrame, name: str) -> DataFrame:
    """Distinct names of ``expected`` that ``arrived`` lacks."""
    return expected.select(name).distinct().join(arrived.select(name), name, "left_anti")


def check_arrived(step: str, expected: Iterable[str], arrived: Iterable[str]) -> None:
    """Fail the step when tables of this run did not reach it."""
    missing = sorted(set(expected) - set(arrived))
    if missing:
        raise PipelineError(step, f"table(s) of this run never reached {step}: {', '.join(missing)}")
