"""High-water marks of JSON records and the checkpoint of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.instants import iso_text, parse_instant
from ..functions.variants import text_of, values_at
from ..options import INCREMENTAL_UPSERT
from .shape import Shape, discover


def field_values(records: DataFrame, field: str, column: str = "rec", shape: Shape | None = None) -> DataFrame:
    """All values of a field, at any depth, as rows ``v``; nulls included.

    The paths come from one pass over the structure, or from ``shape`` when it is known.
    """
    shape = shape or discover(records, column)
    paths = [steps for steps, _ in shape.walk() if steps and steps[-1] == field]
    if not paths:
        return records.select(F.lit(None).cast("variant").alias("v")).where(F.lit(False))
    found = F.concat(*[values_at(F.col(column), steps) for steps in paths])
    return records.select(F.explode(found).alias("v"))


def high_water_mark(
    records: DataFrame, field: str, previous: str | None = None, column: str = "rec",
    shape: Shape | None = None,
) -> DataFrame:
    """One row: ``checkpoint`` (UTC text), ``found`` values and ``bad`` ones.

    The mark includes the previous checkpoint, so it never moves back. Without any value of
    the field it is NULL.
    """
    values = field_values(records, field, column, shape)
    instant = parse_instant(text_of(F.col("v")))
    facts = values.select(instant.alias("at")).agg(
        F.count(F.lit(1)).alias("found"), F.count_if(F.col("at").isNull()).alias("bad"),
        F.max("at").alias("highest"),
    )
    mark = F.greatest("highest", parse_instant(F.lit(previous).cast("string")))
    return facts.select(
        F.when((F.col("found") > 0) & (F.col("bad") == 0), iso_text(mark)).alias("checkpoint"),
        "found", "bad",
    )


def column_high_water_mark(table: DataFrame, column: str, previous: str | None = None) -> DataFrame:
    """:func:`high_water_mark` of a timestamp column whose place is known."""
    mark = F.greatest(F.max(column), parse_instant(F.lit(previous).cast("string")))
    return table.agg(F.count(column).alias("found"), mark.alias("mark")).select(
        F.when(F.col("found") > 0, iso_text(F.col("mark"))).alias("checkpoint"), "found",
    )


def run_checkpoint(
    records: DataFrame, field: str, load_mode: str, previous: str | None, required: bool,
    empty_single_page: bool = False, shape: Shape | None = None, marks: DataFrame | None = None,
) -> str | None:
    """Checkpoint to commit after a run.

    The mark is searched in ``marks``, rows ``rec`` of whole pages with their envelopes, else in the
    records.
    An empty incremental result keeps the previous checkpoint. A run that needs a checkpoint
    and finds none fails, as does a value that is not an ISO-8601 text.
    """
    watermark = field.strip()
    needed = required or (load_mode == INCREMENTAL_UPSERT and bool(watermark))
    if not needed:
        return None
    if previous and records.sparkSession.range(1).select(parse_instant(F.lit(previous))).first()[0] is None:
        raise ValueError("the checkpoint to start from is no ISO-8601 instant")
    mark = high_water_mark(records if marks is None else marks, watermark, previous, shape=shape).first()
    if mark["bad"]:
        raise ValueError(f"{field!r} holds something that is no ISO-8601 instant")
    checkpoint = mark["checkpoint"]
    if checkpoint is None and load_mode == INCREMENTAL_UPSERT and previous:
        if empty_single_page or records.isEmpty():
            checkpoint = previous
    if checkpoint is None:
        raise ValueError(f"no record has a mark in {field!r}")
    return checkpoint
