"""Near duplicates by BagMinHash signatures, bands, and a check of the multiset overlap.

A text is the multiset of its shingles of five words (ASCII lower case); one with fewer words has one
shingle, and one without words is like no other. Two texts are linked if their weighted Jaccard
similarity, the sum of least over the sum of greatest multiplicities, is 0.8 or more; classes are the
connected components of the links, and exact copies of a multiset are one node.

Signatures. Multiplicities are levels 1, 2, 3, ...; each shingle has a hierarchy of Poisson processes
over level intervals (0,1], (1,2], (2,4], (4,8], ... whose rate is the interval's length. A point has a
time, a component of the signature and a level inside its interval, all from a hash of shingle,
interval and number of the point; it counts if its level is reached. The first point of each component
is its value. So a component of two texts agrees with a probability of exactly their weighted Jaccard
similarity. Points are made in order of time only up to a limit by which all components are filled
almost surely (a text whose components are not gets a later limit), so a long text needs a few points
more than it has shingles, not a number of components for each.

Candidates. Texts that agree on all values of a band meet in a bucket. In each round every bucket has one centre, at first the text that meets most others, and each
of the others that is not yet in the centre's class is checked against it. Once few pairs of different classes are left, or centres no
longer settle most of them, all of these are checked: texts that are alike, but below the bar, make as
many pairs as there are in their buckets. Before texts are compared, a pair must have sizes
that allow the similarity, enough agreeing values, and bitmaps of its shingles that do not rule it out
(a bit that one text has alone is a shingle that it has alone, so this loses nothing). Links inside a class are neither found nor needed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import fresh_name, released, small, stored
from .components import components

#: Words of a shingle, least similarity, bands, values in a band.
SHINGLE, SIMILARITY, BANDS, ROWS = 5, 0.8, 24, 4
#: Most rounds with one centre in each bucket, and the share of pairs left from which there is no other.
ROUNDS, SETTLED = 6, 0.8
#: Agreeing values below which a pair is not checked. Of 96 values of a pair of similarity 0.8 so few
#: agree with a probability of 1e-6.
AGREEING = 57

#: Bytes of texts that are signed at once (a longer text is signed alone), and shingles of one step.
BLOCK, STEP = 1 << 20, 1 << 17

_SLACK = 3.0
_LEVELS = 24
_ROUNDING = 1e-9


def shingles(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of texts: text, hash, multiplicity, and the number of shingles of each text."""
    starts, ends, firsts = W.spans(data, bounds)
    hashes, edges = W.windows(W.word_hashes(data, starts, ends, W.LOWER), firsts, SHINGLE)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(edges))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(np.append(at, len(text))), np.diff(edges)


def _uniform(values: np.ndarray) -> np.ndarray:
    return ((values >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def signatures(text: np.ndarray, hashes: np.ndarray, weights: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """BagMinHash values (texts x width) of multisets; rows of empty ones are 0."""
    best = np.full((len(sizes), width), np.inf)
    value = np.zeros((len(sizes), width), np.uint64)
    limit = (math.log(width) + _SLACK) / np.maximum(sizes, 1)
    todo = sizes > 0
    while todo.any():
        mine = np.flatnonzero(todo[text])
        for level in range(_LEVELS):
            low = 0 if level == 0 else 1 << (level - 1)
            mine = mine[weights[mine] > low]
            if not len(mine):
                break
            for first in range(0, len(mine), STEP):
                part = mine[first:first + STEP]
                _process(text[part], hashes[part], weights[part], level, low, max(low, 1), limit, best, value)
        todo &= np.isinf(best).any(axis=1)
        best[todo], value[todo] = np.inf, 0
        limit[todo] *= 2
    return value


def _process(text, hashes, weights, level, low, length, limit, best, value) -> None:
    """Points of one interval of levels (low, low + length] of some shingles, up to the limit of their texts."""
    width = best.shape[1]
    with np.errstate(over="ignore"):
        state = W.mix(hashes + np.uint64(level + 1) * W.GOLDEN)
    time = np.zeros(len(text))
    flat_best, flat_value = best.reshape(-1), value.reshape(-1)
    while len(text):
        with np.errstate(over="ignore"):
            state = W.mix(state + W.GOLDEN)
        time = time - np.log(_uniform(state)) / (length * width)
        on = time <= limit[text]
        text, weights, state, time = text[on], weights[on], state[on], time[on]
        if not len(text):
            break
        with np.errstate(over="ignore"):
            mark = W.mix(state ^ W.SECOND)
        component = (mark % np.uint64(width)).astype(np.int64)
        reached = np.ones(len(text), bool)
        if length > 1:
            reached = low + 1 + ((mark >> np.uint64(32)) % np.uint64(length)).astype(np.int64) <= weights
        place = (text * width + component)[reached]
        # Of points of one component the earliest is written last.
        order = np.argsort(-time[reached])
        place, when, what = place[order], time[reached][order], mark[reached][order]
        better = when < flat_best[place]
        flat_best[place[better]] = when[better]
        flat_value[place[better]] = what[better]


def _lists(table: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(table.reshape(-1)), table.shape[1]).cast(pa.list_(pa.int64()))


def bitmaps(text: np.ndarray, hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of the shingles of each text, as longs with the offsets of the texts.

    A text has a power of two of bits, at least two for each shingle. A bit that only one of two texts
    has is a shingle that only it has, so bits bound the overlap of two texts from above.
    """
    longs = np.maximum(1, 1 << np.ceil(np.log2(np.maximum(2 * sizes, 1) / 64)).clip(0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(longs)])
    bits = np.zeros(64 * offsets[-1], bool)
    bits[64 * offsets[text] + (hashes & (64 * longs[text] - 1).astype(np.uint64)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view("<i8"), offsets


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of a bounded size, so that the arrays made of a part are small."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + BLOCK, "right")))
        yield batch.slice(first, last - first)
        first = last


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in _blocks(whole)):
        data, bounds = W.buffers(batch.column("text"))
        text, hashes, weights, sizes = shingles(data, bounds)
        values = signatures(text, hashes, weights, sizes, BANDS * ROWS)
        keys = np.zeros((len(sizes), BANDS), np.uint64)
        bag = np.zeros((2, len(sizes)), np.uint64)
        with np.errstate(over="ignore"):
            for row in range(ROWS):
                keys = W.mix(keys * W.FIRST + values[:, row::ROWS] + W.GOLDEN)
            keys += np.arange(BANDS, dtype=np.uint64) * W.GOLDEN
            # A mark has the first byte of each value of a band (the last ones tell the component).
            marks = np.zeros((len(sizes), BANDS), np.int64)
            for row in range(ROWS):
                marks |= (values[:, row::ROWS] >> np.uint64(56)).astype(np.int64) << (8 * row)
            bits, offsets = bitmaps(text, hashes, sizes)
            both = W.mix(hashes * W.FIRST + weights.astype(np.uint64))
            np.add.at(bag[0], text, both)
            np.add.at(bag[1], text, W.mix(both ^ W.SECOND))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"), pa.array(sizes.astype(np.int64)),
                pa.array(bag[0].view(np.int64)), pa.array(bag[1].view(np.int64)),
                _lists(keys.view(np.int64)), _lists(marks),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(bits)),
            ],
            names=["row", "n_shingles", "bag_a", "bag_b", "bands", "marks", "bits"],
        )


def _overlaps(similarity: float):
    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            # Equal texts of a batch are cut once.
            known, place = np.unique(np.concatenate([a, b]), return_index=True)
            texts = pa.concat_arrays([batch.column("text_a"), batch.column("text_b")]).take(pa.array(place))
            text, hashes, weights, sizes = shingles(*W.buffers(texts))
            edges = np.searchsorted(text, np.arange(len(known) + 1))
            keep = np.zeros(len(a), bool)
            for i, (x, y) in enumerate(zip(np.searchsorted(known, a), np.searchsorted(known, b))):
                one, two = slice(edges[x], edges[x + 1]), slice(edges[y], edges[y + 1])
                _, left, right = np.intersect1d(hashes[one], hashes[two], assume_unique=True, return_indices=True)
                common = int(np.minimum(weights[one][left], weights[two][right]).sum())
                keep[i] = common >= similarity * (int(sizes[x]) + int(sizes[y]) - common) - _ROUNDING
            chosen = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays(
                [batch.column("class_a").take(chosen), batch.column("class_b").take(chosen)], names=["a", "b"]
            )

    return verified


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between the classes of those pairs (a, b, class_a, class_b) whose texts overlap enough."""
    pairs = stored(pairs.distinct())
    needed = pairs.select(F.col("a").alias("needed")).union(pairs.select("b")).distinct()
    own = stored(texts.join(small(stored(needed)), F.col("row") == F.col("needed"), "left_semi").select("row", "text"))
    left = own.select(F.col("row").alias("a"), F.col("text").alias("text_a"))
    right = own.select(F.col("row").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "class_a", "class_b", "text_a", "text_b")
    return joined.mapInArrow(released(_overlaps(similarity)), "a long, b long")


def _merged(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows with their class replaced by its root."""
    joined = rows.join(roots, F.col("class") == F.col("node"), "left")
    return joined.withColumn("class", F.coalesce("root", "class")).drop("node", "root")


def _open(buckets: DataFrame) -> DataFrame:
    """Rows of the buckets in which more than one class is left."""
    kinds = buckets.groupBy("bucket").agg(F.min("class").alias("least"), F.max("class").alias("most"))
    return stored(buckets.join(kinds.where("least <> most").select("bucket"), "bucket"))


def _close_enough(similarity: float) -> Column:
    """Whether sizes and signatures allow the similarity."""
    fewer, more = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    low, high = int("7F" * ROWS, 16), int("80" * ROWS, 16)

    def differing(band: int) -> Column:
        """Values of a band that differ: each leaves the highest bit of its byte set."""
        bits = F.get("marks_a", F.lit(band)).bitwiseXOR(F.get("marks_b", F.lit(band)))
        return F.bit_count((bits.bitwiseAND(low) + low).bitwiseOR(bits).bitwiseAND(high))

    apart = sum((differing(band) for band in range(1, BANDS)), differing(0))
    # A pair that meets in several bands is made distinct before its texts are compared: marks cannot tell
    # whether it met in an earlier one, for they agree by chance where the values do not.
    return (
        (fewer >= similarity * more - _ROUNDING) & (apart <= BANDS * ROWS - AGREEING)
        & (_overlap_bound() >= similarity * (F.col("size_a") + F.col("size_b") - _overlap_bound()) - _ROUNDING)
    )


def _overlap_bound() -> Column:
    """Most shingles that two texts of similar sizes can share by their bits."""

    def folded(own: str, other: str) -> Column:
        """Bits at the length of the other's, if that is half."""
        half = (F.size(own) / 2).cast("int")
        both = F.zip_with(F.slice(own, 1, half), F.slice(own, half + 1, half), lambda x, y: x.bitwiseOR(y))
        return F.when(F.size(own) > F.size(other), both).otherwise(F.col(own))

    def alone(own: Column, other: Column) -> Column:
        single = F.zip_with(own, other, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y))))
        return F.aggregate(single, F.lit(0), lambda total, value: total + value)

    a, b = folded("bits_a", "bits_b"), folded("bits_b", "bits_a")
    return F.least(F.col("size_a") - alone(a, b), F.col("size_b") - alone(b, a))


def classes_of(rows: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Stored rows (row, text) to (row, class, copies): the least row of the class, null-safe for every row.

    ``row`` must be unique. The result also has n_shingles.
    """
    signed = stored(rows.select("row", "text").mapInArrow(
        released(_signed), "row long, n_shingles long, bag_a long, bag_b long, bands array<long>, marks array<long>, bits array<long>"
    ))
    worded = signed.where("n_shingles > 0")
    # Copies of a multiset are one node, that of the least row.
    bags = stored(worded.groupBy("bag_a", "bag_b").agg(F.min("row").alias("node"), F.count("*").alias("copies")))
    nodes = worded.select("row", "n_shingles", "bands", "marks", "bits").join(bags.select(F.col("node").alias("row")), "row", "left_semi")
    buckets = nodes.select("row", F.col("n_shingles").alias("size"), F.explode("bands").alias("bucket"))
    crowded = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    buckets = stored(buckets.join(crowded, "bucket"))
    # Texts that meet many others are in the middle of their neighbourhood, and the best first centres.
    middle = buckets.groupBy("row").agg(F.sum("n").alias("met"))
    buckets = stored(buckets.drop("n").join(nodes.select("row", "marks", "bits").join(middle, "row"), "row"))
    count = buckets.count()
    buckets = buckets.withColumn("class", F.col("row"))
    merged: list[DataFrame] = []
    before = None
    for turn in range(ROUNDS + 1):
        buckets = _open(buckets)
        each = buckets.groupBy("bucket", "class").agg(F.count("*").alias("n"))
        each = each.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"))
        left = each.agg(F.coalesce(F.sum(F.col("n") * F.col("n") - F.col("same")), F.lit(0)) / 2).first()[0]
        if not left:
            break
        # A further centre is worth while as long as centres settle some of what is left.
        last = left <= count or turn == ROUNDS or (before is not None and left > SETTLED * before)
        before = left
        other = buckets.select("bucket", *[F.col(c).alias(f"{c}_b") for c in ("row", "size", "class", "marks", "bits")])
        if last:
            own = buckets.select("bucket", *[F.col(c).alias(f"{c}_a") for c in ("row", "size", "class", "marks", "bits")])
            apart = F.col("row_a") < F.col("row_b")
        else:
            draw = F.xxhash64("row", F.lit(turn)) if turn else -F.col("met")
            pick = F.min(F.struct(draw.alias("draw"), "row", "size", "class", "marks", "bits")).alias("own")
            own = buckets.groupBy("bucket").agg(pick).select(
                "bucket", *[F.col(f"own.{c}").alias(f"{c}_a") for c in ("row", "size", "class", "marks", "bits")]
            )
            apart = F.lit(True)
        same = (
            (own["bucket"] == other["bucket"]) & (F.col("class_a") != F.col("class_b")) & apart & _close_enough(similarity)
        )
        pairs = other.join(own, same).select(F.col("row_a").alias("a"), F.col("row_b").alias("b"), "class_a", "class_b")
        merged.append(small(components(_verified(pairs, rows, similarity))))
        if last:
            break
        buckets = _merged(buckets, merged[-1])
    same_bag = worded.select("row", "bag_a", "bag_b").join(bags, ["bag_a", "bag_b"]).select(
        "row", F.col("node").alias("class"), "copies"
    )
    for roots in merged:
        same_bag = _merged(same_bag, roots)
    placed = same_bag.select(F.col("row").alias("placed"), "class", "copies")
    return signed.select("row", "n_shingles").join(placed, F.col("row") == F.col("placed"), "left").select(
        "row", "n_shingles", F.coalesce("class", "row").alias("class"), F.coalesce("copies", F.lit(1)).alias("copies")
    )


def numbered(docs: DataFrame, row: str = "row") -> DataFrame:
    """The documents with a unique number, stored so that it stays the same."""
    return stored(docs.withColumn(row, F.monotonically_increasing_id()))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Documents (doc_id, text) to one row each: doc_id, class_id, kept, n_shingles, n_copies.

    ``class_id`` is the least doc_id of the class, ``kept`` marks its first document (least doc_id,
    null last), ``n_copies`` counts documents of the very same shingles. Documents without words, null
    texts among them, are alone in their class. Repeated rows are copies.
    """
    rows = numbered(docs.select("doc_id", "text"))
    placed = classes_of(rows, similarity)
    known = stored(rows.select(F.col("row").alias("own"), "doc_id").join(placed, F.col("own") == F.col("row")).drop("own"))
    first = known.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    first = first.select(F.col("class").alias("of"), F.col("first.doc_id").alias("class_id"), F.col("first.row").alias("stays"))
    return known.join(first, F.col("class") == F.col("of")).select(
        "doc_id", "class_id", (F.col("row") == F.col("stays")).alias("kept"), "n_shingles", F.col("copies").alias("n_copies")
    )


def keep(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The first document (least doc_id, null last) of each class, with the columns of the documents."""
    row = fresh_name(docs, "_row")
    rows = numbered(docs, row)
    placed = stored(classes_of(rows.select(F.col(row).alias("row"), "text"), similarity))
    ids = rows.select(F.col(row).alias("own"), F.col("doc_id").alias("id")).join(placed, F.col("own") == F.col("row"))
    # Most classes are single documents: only the others are ranked, and only their rows go.
    several = placed.groupBy("class").agg(F.count("*").alias("n")).where("n > 1").select("class")
    ids = stored(ids.join(several, "class", "left_semi").select("class", "id", "row"))
    first = ids.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"))
    gone = ids.join(first, "class").where(F.col("row") != F.col("first.row")).select(F.col("row").alias("_gone"))
    gone = small(stored(gone))
    return rows.join(gone, rows[row] == gone["_gone"], "left_anti").select(*docs.columns)
