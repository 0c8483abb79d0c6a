"""Alignment of two tokenizers over the same texts, by merge-path pieces.

A text is cut by a byte-level vocabulary (A, of a space and the text) and by a piece model (B, which adds
that space itself). The ends of both sides' tokens are byte offsets of the same bytes. Where a token of A
and one of B end together, a group of tokens ends, and these two are linked; a text's groups are its
finest common cut.

Merging both lists of ends is divided by diagonals of the merge path: a binary search on each diagonal
finds how many ends of A and of B come before it, so that pieces have equal work whatever the texts'
lengths: short texts share a piece, long ones have many. A piece by itself emits its overlaps, which are
the stretches between neighbouring ends with the token of A and of B over them, and its links, the
overlaps that end in both. A group that a cut goes through is stitched: what a piece has after its last
common end is written with the first group of the next one.

The number of linked pairs of ids is bounded by the two vocabularies: of tokens that end together one's
bytes are the end of the other's. So pairs have fixed numbers, their counts over a corpus are one array,
and it is added up in Spark, from one array for each task, before it goes back to all tasks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pair_bpe
from .common import released, stored

#: Steps of the merge path in a piece, and characters of texts aligned at once.
PIECE, BLOCK = 1 << 16, 1 << 19
#: Characters from which a text is cut for the piece model, at a single space between two words.
PART = 1 << 16

_BOUNDARY = re.compile(r"(?<=[^\s▁])(?= [^\s▁])")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
_MODELS: dict[bytes, "PieceModel"] = {}

ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups string, "
    "links array<int>, times array<int>"
)


class PieceModel:
    """A piece model with the bytes of its pieces."""

    def __init__(self, content: bytes) -> None:
        self.own = sentencepiece.SentencePieceProcessor(model_proto=content)
        names = [self.own.id_to_piece(number) for number in range(self.own.get_piece_size())]
        self.token = [self._bytes(number, name) for number, name in enumerate(names)]
        # Cuts before a space are safe only if no piece goes on over a space.
        self.cuts = not any("▁" in name.lstrip("▁") for name in names)

    def _bytes(self, number: int, name: str) -> bytes:
        if self.own.is_control(number) or self.own.is_unknown(number):
            return b""
        byte = _BYTE_PIECE.fullmatch(name) if self.own.is_byte(number) else None
        return bytes([int(byte[1], 16)]) if byte else name.replace("▁", " ").encode()

    def encode(self, texts: Sequence[str], length: int = PART) -> list[list[int]]:
        """Ids of each text; long texts are encoded in parts."""
        long = {place for place, text in enumerate(texts) if self.cuts and len(text) > length}
        short = iter(self.own.encode([text for place, text in enumerate(texts) if place not in long], num_threads=1))
        return [self._in_parts(text, length) if place in long else next(short) for place, text in enumerate(texts)]

    def _in_parts(self, text: str, length: int) -> list[int]:
        ids, done = [], 0
        while done < len(text):
            found = _BOUNDARY.search(text, done + length)
            end = found.start() if found else len(text)
            # The model puts the space before a part that the cut takes away here.
            ids += self.own.encode(text[done:end])
            done = end + 1 if found else end
        return ids


@dataclass(frozen=True)
class Pairs:
    """Keys (A id times the size of B, plus B id) of all pairs of ids that can end together, in order."""

    keys: np.ndarray
    size_b: int

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, a.astype(np.int64) * self.size_b + b)


def possible_pairs(first: Sequence[bytes], second: Sequence[bytes]) -> Pairs:
    """Pairs of tokens one of which is the end of the other."""
    of_first: dict[bytes, list[int]] = {}
    of_second: dict[bytes, list[int]] = {}
    for known, tokens in ((of_first, first), (of_second, second)):
        for number, token in enumerate(tokens):
            if token:
                known.setdefault(token, []).append(number)
    keys = set()
    for number, token in enumerate(first):
        for start in range(len(token)):
            keys.update(number * len(second) + other for other in of_second.get(token[start:], ()))
    for number, token in enumerate(second):
        for start in range(1, len(token)):
            keys.update(other * len(second) + number for other in of_first.get(token[start:], ()))
    return Pairs(np.array(sorted(keys), np.int64), len(second))


def diagonal_cuts(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of both sorted lists come before each diagonal; equal ends stay together."""
    steps = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while (low < high).any():
        open_ = low < high
        middle = (low + high) // 2
        before = open_.copy()
        before[open_] = a[middle[open_]] <= b[steps[open_] - middle[open_] - 1]
        low = np.where(before, middle + 1, low)
        high = np.where(open_ & ~before, middle, high)
    i, j = low, steps - low
    parted = (i > 0) & (j < len(b))
    parted[parted] = a[i[parted] - 1] == b[j[parted]]
    return i, j + parted


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Overlaps of a piece: end, token of A, token of B (by place in the piece), and whether both end there."""
    # Two sorted lists: a stable sort only merges them.
    ends = np.sort(np.concatenate([a, b]), kind="stable")
    ends = ends[np.diff(ends, prepend=-1) > 0]
    left, right = np.searchsorted(a, ends), np.searchsorted(b, ends)
    both = np.zeros(len(ends), bool)
    inner = (left < len(a)) & (right < len(b))
    both[inner] = (a[left[inner]] == ends[inner]) & (b[right[inner]] == ends[inner])
    return ends, left, right, both


def _digits(size: int) -> np.ndarray:
    """Decimal digits of the numbers below ``size``, one row each, with zero bytes behind and one for a separator."""
    width = len(str(max(size - 1, 0))) + 1
    return np.frombuffer(b"".join(str(n).encode().ljust(width, b"\0") for n in range(size)), np.uint8).reshape(size, width)


class Aligner:
    """Both tokenizers of a worker process, and the arrays that alignment looks up."""

    def __init__(self, first: pair_bpe.Vocabulary, second: PieceModel, pairs: Pairs) -> None:
        self.first, self.second, self.pairs = first, second, pairs
        self.length_a = np.array([len(token) for token in first.token], np.int64)
        self.length_b = np.array([len(token) for token in second.token], np.int64)
        digits = max(len(first.token), len(second.token))
        self.digits = _digits(digits)

    def first_tokens(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A end to end and the bounds of each text."""
        return self.first.encode([" " + text if text else "" for text in texts], special=False)

    def tokens(
        self, texts: Sequence[str], ids_a: np.ndarray, bounds_a: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B end to end and the bounds of each text; texts that are not kept whole have none."""
        lists = self.second.encode(texts)
        keep = np.zeros(len(texts), bool)
        for place, text in enumerate(texts):
            if text:
                raw = b" " + text.encode()
                own = ids_a[bounds_a[place]:bounds_a[place + 1]].tolist()
                keep[place] = (
                    b"".join(map(self.second.token.__getitem__, lists[place])) == raw
                    and b"".join(map(self.first.token.__getitem__, own)) == raw
                )
        sizes_a = np.where(keep, np.diff(bounds_a), 0)
        ids_a = ids_a[np.repeat(keep, np.diff(bounds_a))]
        lists = [own if kept else [] for own, kept in zip(lists, keep)]
        sizes_b = [len(own) for own in lists]
        ids_b = np.concatenate([np.empty(0, np.int32), *(np.array(own, np.int32) for own in lists)])
        return ids_a, np.concatenate([[0], np.cumsum(sizes_a)]), ids_b, np.concatenate([[0], np.cumsum(sizes_b)])

    def align(
        self, texts: Sequence[str], encoded: tuple[np.ndarray, np.ndarray] | None = None, piece: int = PIECE
    ) -> dict[str, pa.Array]:
        """Columns of the alignment of some texts, whose ids of A may be given."""
        ids_a, bounds_a, ids_b, bounds_b = self.tokens(texts, *(encoded or self.first_tokens(texts)))
        a, b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        # A text ends with tokens of both sides, so ends of all texts can be one list.
        done = np.concatenate([[0], a])[bounds_a]
        cut_a, cut_b = diagonal_cuts(a, b, piece)
        text_end = np.zeros(len(b), bool)
        text_end[bounds_b[1:][np.diff(bounds_b) > 0] - 1] = True
        n_overlaps = np.zeros(len(texts), np.int64)
        n_groups = np.zeros(len(texts), np.int64)
        linked_text, linked, written, text_ends = [], [], [], []
        size, open_a, open_b = 0, 0, 0
        for step in range(len(cut_a) - 1):
            own_a, own_b = a[cut_a[step]:cut_a[step + 1]], b[cut_b[step]:cut_b[step + 1]]
            ends, left, right, both = overlaps(own_a, own_b)
            text = np.searchsorted(done, ends) - 1
            n_overlaps += np.bincount(text, minlength=len(texts))
            if not both.any():
                continue
            common, text = ends[both], text[both]
            n_groups += np.bincount(text, minlength=len(texts))
            left, right = cut_a[step] + left[both], cut_b[step] + right[both]
            linked_text.append(text)
            linked.append(self.pairs.number(ids_a[left], ids_b[right]))
            # Tokens up to the last common end, with those that earlier pieces left open.
            close_a, close_b = int(left[-1]) + 1, int(right[-1]) + 1
            part, ends_here = self._written(
                ids_a[open_a:close_a], ids_b[open_b:close_b], np.searchsorted(common, a[open_a:close_a]),
                np.searchsorted(common, b[open_b:close_b]), text_end[open_b:close_b],
            )
            written.append(part)
            text_ends.append(size + ends_here)
            size, open_a, open_b = size + len(part), close_a, close_b
        offsets = np.zeros(len(texts) + 1, np.int64)
        filled = np.flatnonzero(np.diff(bounds_b)) + 1
        offsets[filled] = np.concatenate([np.empty(0, np.int64), *text_ends])
        offsets = np.maximum.accumulate(offsets)
        groups = pa.Array.from_buffers(
            pa.large_string(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(written))]
        )
        of = np.concatenate([np.empty(0, np.int64), *linked_text])
        key, times = np.unique(of * len(self.pairs.keys) + np.concatenate([np.empty(0, np.int64), *linked]), return_counts=True)
        firsts = pa.array(np.searchsorted(key, np.arange(len(texts) + 1) * len(self.pairs.keys)), pa.int32())
        return {
            "n_a": pa.array(np.diff(bounds_a)), "n_b": pa.array(np.diff(bounds_b)),
            "n_groups": pa.array(n_groups), "n_links": pa.array(np.bincount(of, minlength=len(texts))),
            "n_overlaps": pa.array(n_overlaps), "groups": groups,
            "links": pa.ListArray.from_arrays(firsts, pa.array((key % max(len(self.pairs.keys), 1)).astype(np.int32))),
            "times": pa.ListArray.from_arrays(firsts, pa.array(times.astype(np.int32))),
        }

    def _written(self, ids_a, ids_b, group_a, group_b, ends_text) -> tuple[bytes, np.ndarray]:
        """Whole groups in writing, and where texts end in it."""
        count = int(group_b[-1]) + 1
        size_a, size_b = np.bincount(group_a, minlength=count), np.bincount(group_b, minlength=count)
        place_a = np.arange(len(ids_a)) + (np.cumsum(size_b) - size_b)[group_a]
        place_b = np.arange(len(ids_b)) + np.cumsum(size_a)[group_b]
        table = np.empty((len(ids_a) + len(ids_b), self.digits.shape[1]), np.uint8)
        table[place_a], table[place_b] = self.digits[ids_a], self.digits[ids_b]
        table[place_a, -1] = np.where(np.diff(group_a, append=-1) != 0, ord("|"), ord(","))
        table[place_b, -1] = np.where(ends_text, 0, np.where(np.diff(group_b, append=-1) != 0, ord(";"), ord(",")))
        filled = table != 0
        ends = np.cumsum(filled.sum(axis=1))
        return table[filled].tobytes(), ends[place_b[ends_text]]


@dataclass(frozen=True)
class Tokenizers:
    """Both tokenizers' files and the pairs of their ids, as the executors get them."""

    vocabulary: Broadcast[bytes]
    pattern: str
    model: Broadcast[bytes]
    pairs: Broadcast[Pairs]

    def aligner(self) -> Aligner:
        """Aligner of the files; each worker process builds it once."""
        return Aligner(pair_bpe.vocabulary(self.vocabulary.value, self.pattern), piece_model(self.model.value), self.pairs.value)


def piece_model(content: bytes) -> PieceModel:
    key = hashlib.sha256(content).digest()
    if key not in _MODELS:
        _MODELS[key] = PieceModel(content)
    return _MODELS[key]


def load(spark: SparkSession, vocabulary: str, pattern: str, model: str) -> Tokenizers:
    """Both files, read once by the driver; the pairs are made of the vocabularies alone, so they are bounded."""
    with open(model, "rb") as file:
        content = file.read()
    first = pair_bpe.load_vocabulary(spark, vocabulary)
    pairs = possible_pairs(pair_bpe.vocabulary(first.value, pattern).token, piece_model(content).token)
    send = spark.sparkContext.broadcast
    return Tokenizers(first, pattern, send(content), send(pairs))


def align(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """Documents (doc_id, text) to their alignment: counts, groups in writing, and linked pairs with their times.

    ``groups`` is ``a1,a2|b1;a3|b2,b3`` (ids of A and B for each group), ``links`` has numbers of pairs of
    ids. Null and empty texts, and those that a tokenizer does not keep byte for byte, have no tokens: zeros,
    empty text and lists. Other columns are not carried; repeated rows stay.
    """

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers.aligner()
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            values, bounds = own.first_tokens(texts)
            for block in pair_bpe.blocks(texts, BLOCK):
                edges = bounds[block.start:block.stop + 1]
                ids = batch.column("doc_id").slice(block.start, block.stop - block.start)
                columns = own.align(texts[block], (values[edges[0]:edges[-1]], edges - edges[0]))
                columns["groups"] = columns["groups"].cast(pa.string())
                yield pa.RecordBatch.from_arrays([ids, *columns.values()], names=["doc_id", *columns])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(released(aligned), ALIGNED)


def link_counts(aligned: DataFrame, size: int) -> np.ndarray:
    """Links of each pair of ids over all rows: one array for each task, added up by pair in Spark."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            np.add.at(total, batch.column("links").flatten().to_numpy(), batch.column("times").flatten().to_numpy())
        pairs = np.flatnonzero(total)
        for first in range(0, len(pairs), 1 << 16):
            part = pairs[first:first + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(total[part])], names=["pair", "n"])

    sums = aligned.select("links", "times").mapInArrow(counted, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # As many rows as there are pairs at most, which the vocabularies bound.
    rows, total = sums.toArrow(), np.zeros(size, np.int64)
    total[rows.column("pair").to_numpy()] = rows.column("n").to_numpy()
    return total


def scored(aligned: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """Stored alignments with ``n_best`` (links whose count over all rows is the highest of their B id, ties
    included) and ``count_sum`` (counts over all links); the lists go."""
    pairs = tokenizers.pairs.value
    total = link_counts(aligned, len(pairs.keys))
    highest = np.zeros(pairs.size_b, np.int64)
    np.maximum.at(highest, pairs.keys % pairs.size_b, total)
    best = total == highest[pairs.keys % pairs.size_b]
    shared = aligned.sparkSession.sparkContext.broadcast((total, best))
    kept = [field for field in aligned.schema.fields if field.name not in ("links", "times")]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, wins = shared.value
        for batch in batches:
            links, times = batch.column("links"), batch.column("times")
            number, often = links.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(links.value_lengths().to_numpy())])
            sums = [np.concatenate([[0], np.cumsum(values)]) for values in (often * wins[number], often * counts[number])]
            columns = [batch.column(field.name) for field in kept] + [pa.array(np.diff(one[ends])) for one in sums]
            yield pa.RecordBatch.from_arrays(columns, names=[*(field.name for field in kept), "n_best", "count_sum"])

    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in kept)
    return aligned.mapInArrow(summed, f"{schema}, n_best long, count_sum long")


def alignment_digests(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """One row for each document with the digest of its groups; alignments are stored once without the writing."""
    rows = align(docs, tokenizers)
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return scored(stored(rows.withColumn("groups_sha256", digest).drop("groups")), tokenizers)
