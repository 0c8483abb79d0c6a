"""Helpers the corpus operators share: batches, tables in the shared folder, row ids, dropping rows."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder

# Bytes and rows of one Arrow batch. They bound what a Python worker holds at once;
# a single longer row is a batch of its own.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.session.timeZone": "UTC",
}

#: Rows up to which a set of keys is broadcast; beyond it the join is left to the planner.
BROADCAST_ROWS = 1_000_000


def batched(spark: SparkSession) -> SparkSession:
    """The session with small Arrow batches."""
    for name, value in BATCH_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def stored(rows: DataFrame) -> DataFrame:
    """Rows written to the shared folder and read back: lineage ends there, and rows are computed once."""
    path = scratch_folder(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def released(
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same work over batches, which gives unused memory back to the system when its task ends.

    Python workers live on from task to task, and their allocators keep what the largest batch needed.
    """

    @functools.wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    """Hand free memory of the Arrow pool and of the C library back to the system, where it can do that."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def fresh_name(rows: DataFrame, name: str) -> str:
    """A column name that the rows do not have yet, whatever the case of letters."""
    taken = {column.lower() for column in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def training_row(doc_id: Column, parts: int, held_out: int) -> Column:
    """False for the rows whose CRC-32 of the id as text leaves the held-out remainder; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts != held_out, F.lit(True))


def small(keys: DataFrame) -> DataFrame:
    """Stored keys, marked for broadcast if they were counted to be few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` labelled rows of each class, the first by a hash of the id: (doc_id, text, label).

    Labels other than 0 and 1 and null ids are no labels; of several labels of an id the least counts,
    of several texts the least.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    first = [known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for value in (0, 1)]
    chosen = F.broadcast(first[0].unionByName(first[1]))
    return docs.select("doc_id", "text").join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
