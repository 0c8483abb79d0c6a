"""Mixing sources to target weights in blocks of equal size, apportioned by Sainte-Laguë.

A source's target is its weight's share of all words, at most ``EPOCHS`` times its own; what is above
goes to the others by weight. Each source is dealt into shards of about ``SHARD_DOCS`` documents by a
hash of the id. The mix is so many blocks of ``block`` words, and the blocks go to the shards by
highest quotients (divisors 1, 3, 5, ...): integer quotas that keep to the targets. Inside a shard the
documents are laid end to end in a seeded order and cut into blocks; a quota is whole passes over the
shard and then one run of neighbouring blocks from a seeded start. So a partial pass takes documents
whole or not at all, but for the two at the ends of a run, which are cut.

No step gathers a source: shares are sums over a table of sources, quotas come from a search for the
divisor over a table of shards, and a window holds the ids and sizes of one shard.

Null texts have size 0; a null source is a source of its own, the last; repeated rows count each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_name, small, stored

# White space, the characters of a word, and those between words.
SPACE = " \t\n\x0b\x0c\r"
WORD, SPACES = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]*"

#: Weights of the sources in the order of their names, repeating; passes over a source at most.
WEIGHTS, EPOCHS = (1, 2, 3), 3
#: Words of a block, documents of a shard (about), divisors tried in one round of the search.
BLOCK_WORDS, SHARD_DOCS, DIVISORS = 16, 1024, 64


@dataclass(frozen=True)
class Mix:
    """What a mix is made by."""

    weights: tuple[int, ...] = WEIGHTS
    epochs: int = EPOCHS
    block: int = BLOCK_WORDS
    seed: int = 42


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def ranked(sources: DataFrame, column: str) -> DataFrame:
    """Adds ``place``, the position from 0 by code point with null last: sorted in ranges, counted by range."""
    spread = stored(
        sources.repartitionByRange(F.col(column).asc_nulls_last()).withColumn("part", F.spark_partition_id())
    )
    # One row for each range.
    counts = spread.groupBy("part").agg(F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy(F.col(column).asc_nulls_last())
    return spread.withColumn("local", F.row_number().over(inside) - 1).join(F.broadcast(offsets), "part").select(
        *sources.columns, (F.col("local") + F.col("before")).alias("place")
    )


def targets(sources: DataFrame, mix: Mix) -> DataFrame:
    """Adds ``target`` to stored sources (source, source_size, docs): shares by weight below the caps."""
    weight = F.element_at(F.array(*map(F.lit, mix.weights)), (F.col("place") % len(mix.weights) + 1).cast("int"))
    weighed = stored(ranked(sources, "source").withColumn("weight", weight))
    cap = F.lit(mix.epochs) * F.col("source_size")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    share, capped = 0.0, None
    while True:
        # Sources at their cap under the share so far; the rest shares what they leave.
        full = cap <= F.col("weight") * share
        held, weights, count = weighed.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
            F.coalesce(F.sum(full.cast("bigint")), F.lit(0)),
        ).first()
        if count == capped or not weights:
            break
        share, capped = (total - held) / weights, count
    return weighed.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(float(share))))


def apportion(units: DataFrame, seats: int, order: list[str]) -> DataFrame:
    """Adds ``quota`` to stored units with a ``claim``: ``seats`` in all by Sainte-Laguë, ties by ``order``.

    The quota under a divisor d is claim / d rounded half up. A few rounds narrow the divisor down;
    seats between its bounds go to the highest quotients.
    """
    count, total, most = units.agg(F.count("*"), F.sum("claim"), F.max("claim")).first()
    if not seats or not most:
        return units.withColumn("quota", F.lit(0).cast("bigint"))
    quota = lambda divisor: F.floor(F.col("claim") / divisor + 0.5)
    low = total / (seats + count / 2 + 1)
    high = min(total / (seats - count / 2), 3 * most) if seats > count / 2 else 3 * most
    for _ in range(4):
        steps = [low + (high - low) * i / DIVISORS for i in range(DIVISORS + 1)]
        tried = units.select(F.explode(F.array(*map(F.lit, steps))).alias("divisor"), "claim")
        sums = tried.groupBy("divisor").agg(F.sum(quota(F.col("divisor"))).alias("seats")).collect()
        given = {row["divisor"]: row["seats"] for row in sums}
        low = max((d for d in steps if given[d] >= seats), default=low)
        high = min((d for d in steps if given[d] <= seats), default=high)
        if high <= low:
            low = high = min(low, high) if given.get(min(low, high)) == seats else high
            break
    held = units.agg(F.sum(quota(F.lit(high)))).first()[0]
    base = units.withColumn("sure", quota(F.lit(high)))
    left = int(seats - held)
    if left <= 0:
        return base.withColumnRenamed("sure", "quota")
    upper = quota(F.lit(low)) if low < high else F.col("sure") + 1
    disputed = base.where(upper > F.col("sure")).select(
        *order, F.col("claim"), F.explode(F.sequence(F.col("sure") + 1, upper)).alias("seat")
    )
    won = disputed.orderBy(F.desc(F.col("claim") / (F.col("seat") - 0.5)), *[F.col(c).asc_nulls_last() for c in order])
    won = won.limit(left).groupBy(*[F.col(c).alias(f"_{c}") for c in order]).agg(F.count("*").alias("more"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in order]
    return base.join(won, same, "left").select(
        *units.columns, (F.col("sure") + F.coalesce("more", F.lit(0))).alias("quota")
    )


def plan(rows: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """What the mix takes of each stored row (row, doc_id, source, size, and mark, a hash of the text).

    Documents are dealt by id, those without one by row. Texts of one id are laid in the order of their sizes
    and marks, and what agrees in all of that in the order of the rows.

    Adds source_size, target, passes (times the whole document is taken), and of the run of blocks picked
    beyond these: start (its first word in the document, from 0) and part (its words there); and taken, the
    words taken in all.
    """
    block, seed = mix.block, mix.seed
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    sources = small(stored(targets(stored(sources), mix).select("source", "source_size", "docs", "target")))
    own = sources.select(F.col("source").alias("_source"), "source_size", "docs", "target")
    shards = F.ceil(F.col("docs") / SHARD_DOCS)
    mark = F.col("mark") if "mark" in rows.columns else F.lit(None).cast("bigint")
    # Rows without an id may be many: they are dealt one by one.
    alone = F.when(F.col("doc_id").isNull(), F.col("row"))
    dealt = rows.join(own, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumns({
        "shard": F.pmod(F.xxhash64("doc_id", alone, F.lit(seed)), shards).cast("bigint"),
        "draw": F.xxhash64("doc_id", alone, F.lit(seed), F.lit(1)),
        "tie": mark,
    })
    units = stored(
        dealt.groupBy("source", "shard").agg(
            F.sum("size").alias("shard_size"), F.first("target").alias("target"), F.first("source_size").alias("whole"),
        ).withColumn("claim", F.when(F.col("whole") > 0, F.col("target") * F.col("shard_size") / F.col("whole")).otherwise(0.0))
        .drop("target", "whole")
    )
    total = units.agg(F.sum("claim")).first()[0] or 0
    quotas = apportion(units, math.floor(total / block + 0.5), ["source", "shard"])
    words = F.col("quota") * block
    blocks = F.ceil(F.col("shard_size") / block)
    passes = F.when(F.col("shard_size") > 0, F.least(F.lit(mix.epochs), F.floor(words / F.col("shard_size")))).otherwise(0)
    quotas = quotas.withColumn("passes", passes.cast("bigint")).select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), "passes", blocks.alias("blocks"),
        F.when(F.col("passes") >= mix.epochs, 0).otherwise(
            F.least(blocks, F.floor((words - F.col("passes") * F.col("shard_size")) / block + 0.5))
        ).cast("bigint").alias("picked"),
        F.xxhash64("source", "shard", F.lit(seed)).alias("draw_run"),
    ).withColumn("phase", F.pmod("draw_run", F.col("blocks") - F.col("picked") + 1)).drop("draw_run", "blocks")
    ahead = (
        Window.partitionBy("source", "shard").orderBy("draw", "doc_id", "size", "tie", "row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    laid = dealt.withColumn("first", F.coalesce(F.sum("size").over(ahead), F.lit(0)))
    quotas = small(stored(quotas))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard"))
    begin = F.greatest(F.col("phase") * block - F.col("first"), F.lit(0))
    end = F.least((F.col("phase") + F.col("picked")) * block - F.col("first"), F.col("size"))
    return laid.join(quotas, same).withColumns({
        "start": begin.cast("bigint"), "part": F.greatest(end - begin, F.lit(0)).cast("bigint"),
    }).withColumn("taken", F.col("passes") * F.col("size") + F.col("part")).drop(
        "_source", "_shard", "docs", "draw", "tie", "first", "picked", "phase"
    )


def cut(text: Column, start: Column, count: Column) -> Column:
    """``count`` words of a text from its word ``start`` (from 0), with the white space between them."""
    pieces = F.regexp_extract_all(text, F.lit(WORD + SPACES), F.lit(0))
    return F.rtrim(F.array_join(F.slice(pieces, (start + 1).cast("int"), count.cast("int")), ""), F.lit(SPACE))


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself, with the columns of the documents: a row for each pass over a document, and one
    with what the run of picked blocks has of it. Documents that the mix does not take are gone."""
    row = fresh_name(docs, "_row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()))
    thin = rows.select(F.col(row).alias("row"), "doc_id", "source", size(F.col("text")).alias("size"), F.xxhash64("text").alias("mark"))
    taken = plan(stored(thin), mix).where(F.col("taken") > 0).select(
        F.struct(F.col("row").alias("_taken"), "passes", "size", "start", "part").alias(mine := fresh_name(docs, "_mine"))
    )
    joined = rows.join(taken, rows[row] == taken[f"{mine}._taken"])
    part, length = F.col(f"{mine}.part"), F.col(f"{mine}.size")
    # Only the documents at the ends of a run are cut.
    piece = F.when(part < length, cut(F.col("text"), F.col(f"{mine}.start"), part)).otherwise(F.col("text"))
    whole = F.array_repeat(F.col("text"), F.col(f"{mine}.passes").cast("int"))
    texts = F.when(part > 0, F.concat(whole, F.array(piece))).otherwise(whole)
    pieces = joined.select(*[rows[c] for c in docs.columns if c != "text"], F.explode(texts).alias("text"))
    if "n_chars" in docs.columns:
        pieces = pieces.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return pieces.select(*docs.columns)
