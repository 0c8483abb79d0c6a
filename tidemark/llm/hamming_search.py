"""Exact nearest binary codes by incremental multi-index hashing.

A vector's code has a bit for the sign of each dimension (64 bits; further dimensions are folded in by
exclusive or). Codes are cut into pieces of about log2(rows) bits, and every piece is a key of the
index. A search probes the pieces at radius 0, then 1, and so on: after radius r, each code within
pieces * (r + 1) - 1 bits has been met, for one of its pieces differs in r bits at most. Met codes are
verified by their whole distance, and a query is done when its k-th distance is covered; until then
only candidates that could still enter its first k are kept. A radius that has more changes of a piece
than there are codes is not probed: the queries that are still open, which have few codes near them, are
compared with all codes, in blocks of queries that go to every task.

Vectors of one code are one entry with its smallest ids, queries of one code are one query, so copies
meet nobody twice. Ties go to the smaller id. Vectors without a value have no code and no neighbours.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import released, stored

BITS, NEIGHBOURS = 64, 10
#: Changes up to which they are broadcast, queries that are compared with all codes at once, and of these at a time.
FEW_MASKS, BLOCK_QUERIES, AT_A_TIME = 100_000, 50_000, 256


def code(vector: Column) -> Column:
    """Sign bits of a vector; null for a null or empty one."""
    bit = lambda value, place: F.when(
        value > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), place % BITS)
    ).otherwise(F.lit(0).cast("bigint"))
    bits = F.aggregate(F.transform(vector, bit), F.lit(0).cast("bigint"), lambda total, value: total.bitwiseXOR(value))
    return F.when(F.size(vector) > 0, bits)


def pieces_of(rows: int) -> list[tuple[int, int]]:
    """First bit and length of each piece: lengths of about log2(rows)."""
    count = min(8, max(2, round(BITS / max(1.0, math.log2(max(2, rows))))))
    edges = [BITS * i // count for i in range(count + 1)]
    return [(first, last - first) for first, last in zip(edges, edges[1:])]


def _pieces(codes: DataFrame, pieces: list[tuple[int, int]], name: str) -> DataFrame:
    """A row for each piece of each code."""
    cut = [
        F.struct(F.lit(number).alias("piece"), F.shiftrightunsigned(name, first).bitwiseAND((1 << length) - 1).alias("value"))
        for number, (first, length) in enumerate(pieces)
    ]
    return codes.select("*", F.inline(F.array(*cut)))


def _first_masks(spark, pieces: list[tuple[int, int]]) -> DataFrame:
    """No change, for each piece: piece, length, mask, next (the first bit that may still change)."""
    rows = [(number, length, 0, 0) for number, (_, length) in enumerate(pieces)]
    return spark.createDataFrame(rows, "piece int, length int, mask long, next int")


def _more_masks(masks: DataFrame) -> DataFrame:
    """All changes of one more bit: each mask with a bit behind its last."""
    rows = masks.where("next < length").select(
        "piece", "length", "mask", F.explode(F.sequence("next", F.col("length") - 1)).alias("bit")
    )
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))
    return stored(rows.select("piece", "length", F.col("mask").bitwiseOR(one).alias("mask"), (F.col("bit") + 1).alias("next")))


def _nearest_codes(queries: np.ndarray, bounds: np.ndarray, k: int):
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The distances of the k + 1 nearest entries so far; what lies farther cannot be among the first.
        best = np.repeat(bounds[:, None], k + 1, axis=1).astype(np.uint8)
        for batch in batches:
            codes = batch.column("code").to_numpy().view(np.uint64)
            for first in range(0, len(queries), AT_A_TIME):
                part = slice(first, first + AT_A_TIME)
                distance = np.bitwise_count(queries[part, None] ^ codes[None, :])
                own = np.concatenate([best[part], distance], axis=1)
                own.partition(k, axis=1)
                best[part] = own[:, :k + 1]
                query, entry = np.nonzero(distance <= best[part].max(axis=1)[:, None])
                rows = batch.take(pa.array(entry))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries[part][query].view(np.int64)), *rows.columns, pa.array(distance[query, entry].astype(np.int32))],
                    names=["query", "code", "first", "ids", "distance"],
                )

    return compared


def _compared(todo: DataFrame, entries: DataFrame, k: int, kind: str) -> DataFrame:
    """Open queries with the codes that may be among their nearest, by comparison with all codes."""
    blocks = max(1, -(-todo.count() // BLOCK_QUERIES))
    found = None
    for block in range(blocks):
        own = todo.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).toArrow()
        queries, bounds = (own.column(name).to_numpy() for name in ("query", "bound"))
        near = entries.select("code", "first", "ids").mapInArrow(
            released(_nearest_codes(queries.view(np.uint64), bounds, k)), f"query long, code long, first {kind}, ids long, distance int"
        )
        found = near if found is None else found.unionByName(near)
    return found


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """The k nearest other vectors of each query: query_id, vec_id, distance, rank.

    Both tables have vec_id and code; queries are among the vectors. Repeated rows count once.
    """
    spark = vectors.sparkSession
    vectors = vectors.where(F.col("code").isNotNull() & F.col("vec_id").isNotNull()).select("vec_id", "code").distinct()
    # One more than k, as the query itself is among them; the limit holds before rows are dealt by code.
    smallest = F.row_number().over(Window.partitionBy("code").orderBy("vec_id"))
    ids = stored(vectors.withColumn("place", smallest).where(F.col("place") <= k + 1).drop("place"))
    entries = stored(ids.groupBy("code").agg(F.min("vec_id").alias("first"), F.count("*").alias("ids")))
    queries = stored(queries.where(F.col("code").isNotNull()).select(F.col("vec_id").alias("query_id"), F.col("code").alias("query")).distinct())
    size = entries.count()
    pieces = pieces_of(size)
    postings = stored(_pieces(entries, pieces, "code"))
    todo = queries.select("query").distinct().withColumn("bound", F.lit(BITS))
    best: DataFrame | None = None
    nearest = Window.partitionBy("query").orderBy("distance", "first")
    masks = _first_masks(spark, pieces)
    for radius in range(max(length for _, length in pieces) + 1):
        changes = sum(math.comb(length, radius) for _, length in pieces)
        whole = changes > size
        if whole:
            met = _compared(todo, entries, k, ids.schema["vec_id"].dataType.simpleString())
        else:
            masks = _more_masks(masks) if radius else masks
            own = masks.select("piece", "mask")
            probes = _pieces(todo, pieces, "query").join(F.broadcast(own) if changes <= FEW_MASKS else own, "piece").select(
                "query", "bound", "piece", F.col("value").bitwiseXOR(F.col("mask")).alias("value")
            )
            distance = F.bit_count(F.col("query").bitwiseXOR(F.col("code")))
            met = probes.join(
                postings, (probes["piece"] == postings["piece"]) & (probes["value"] == postings["value"]) & (distance <= F.col("bound"))
            ).select("query", "code", "first", "ids", distance.alias("distance")).distinct()
        if best is not None:
            met = met.unionByName(best).distinct()
        best = stored(met.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k + 1).drop("place"))
        enough = best.withColumn("sum", F.sum("ids").over(nearest.rowsBetween(Window.unboundedPreceding, 0)))
        bounds = enough.where(F.col("sum") >= k + 1).groupBy(F.col("query").alias("full")).agg(F.min("distance").alias("kth"))
        if whole:
            break
        covered = len(pieces) * (radius + 1) - 1
        todo = stored(
            todo.join(bounds, F.col("query") == F.col("full"), "left")
            .where(F.col("kth").isNull() | (F.col("kth") > covered))
            .select("query", F.coalesce("kth", F.lit(BITS)).alias("bound"))
        )
        if todo.isEmpty():
            break
    pairs = queries.join(best.join(ids, "code"), "query").where(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "vec_id", F.col("distance").cast("int").alias("distance"), F.col("rank").cast("int").alias("rank")
    )
