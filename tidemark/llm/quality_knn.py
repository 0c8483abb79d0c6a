"""Quality of texts by a vote of their nearest labelled neighbours in a latent-semantic space.

The terms of a text are the shapes of its character trigrams, its words, the lengths of its words and
whether its windows of three words and its lines occurred before in it. Relative frequencies are
damped by a square root, weighted by inverse document frequency and projected by a truncated singular
value decomposition of the labelled rows. All labelled vectors are sent to every task, where a block of
documents is multiplied with them; the nearest ones vote with weights that grow with their cosine.

Labelled rows are bounded: at most ``SAMPLE`` of each class, chosen by a hash of the id. So are the
number of terms (hashed) and of dimensions, and with them the broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql.pandas.functions import pandas_udf

from . import words as W
from .common import labelled_sample

#: Labelled rows of each class, hashed terms of each kind, latent dimensions, neighbours that vote.
SAMPLE, SHAPES, WORDS, LENGTHS, DIMENSIONS, NEIGHBOURS = 1000, 1024, 512, 16, 48, 25
#: Power of the cosine that weighs a vote.
SHARPNESS = 8
#: Documents in one matrix product.
BLOCK = 512

TERMS = SHAPES + WORDS + LENGTHS + 4

# Kinds of characters: letters of either case, digits, white space, bytes beyond ASCII; signs are themselves.
_KIND = np.arange(256, dtype=np.uint64)
_KIND[ord("a"):ord("z") + 1] = 1
_KIND[ord("A"):ord("Z") + 1] = 2
_KIND[ord("0"):ord("9") + 1] = 3
_KIND[128:] = 4


@dataclass(frozen=True)
class Neighbours:
    """Weights of the terms, projection, unit vectors of the labelled rows, their labels."""

    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def _seen_before(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Whether an item's key occurred earlier in its text."""
    order = np.lexsort((np.arange(len(keys)), keys, text))
    again = np.zeros(len(keys), bool)
    if len(keys):
        same = (keys[order][1:] == keys[order][:-1]) & (text[order][1:] == text[order][:-1])
        again[order[1:][same]] = True
    return again


def _share(place: np.ndarray, text: np.ndarray, texts: int, width: int) -> np.ndarray:
    """Square roots of the relative frequencies of terms in each text."""
    counts = np.bincount(text * width + place, minlength=texts * width).reshape(texts, width).astype(np.float32)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def terms(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Terms of texts (texts x TERMS)."""
    texts = len(bounds) - 1
    kinds = _KIND[data]
    text_of = np.repeat(np.arange(texts), np.diff(bounds))
    with np.errstate(over="ignore"):
        codes = kinds[:-2] * np.uint64(1 << 16) + kinds[1:-1] * np.uint64(1 << 8) + kinds[2:] if len(data) > 2 else kinds[:0]
        inside = text_of[:len(codes)] == text_of[2:2 + len(codes)]
        codes = (codes[inside] * W.GOLDEN >> np.uint64(40)) % np.uint64(SHAPES)
    shapes = _share(codes.astype(np.int64), text_of[:len(inside)][inside], texts, SHAPES)
    starts, ends, firsts = W.spans(data, bounds)
    hashes = W.word_hashes(data, starts, ends, W.LOWER)
    owner = np.repeat(np.arange(texts), np.diff(firsts))
    words = _share((hashes % np.uint64(WORDS)).astype(np.int64), owner, texts, WORDS)
    lengths = _share(np.minimum(ends - starts, LENGTHS) - 1, owner, texts, LENGTHS)
    three, edges = W.windows(hashes, firsts, 3)
    of = np.repeat(np.arange(texts), np.diff(edges))
    windows = _share(_seen_before(three, of).astype(np.int64), of, texts, 2)
    # Lines are told apart by the sum of their words' hashes, each mixed with its place in the line.
    breaks = np.searchsorted(np.flatnonzero(data == 10), starts)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (breaks[1:] != breaks[:-1]) | (owner[1:] != owner[:-1])
    line = np.cumsum(fresh) - 1
    at = np.flatnonzero(fresh)
    with np.errstate(over="ignore"):
        within = (np.arange(len(starts)) - at[line]).astype(np.uint64) if len(at) else np.zeros(0, np.uint64)
        keys = np.add.reduceat(W.mix(hashes + within * W.GOLDEN), at) if len(at) else np.zeros(0, np.uint64)
    lines = _share(_seen_before(keys, owner[at]).astype(np.int64), owner[at], texts, 2)
    return np.concatenate([shapes, words, lengths, windows, lines], axis=1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def _texts(values: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    return W.buffers(pa.array(values, pa.large_string(), from_pandas=True))


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int = SAMPLE) -> DataFrame:
    """The bounded labelled rows to learn from: (doc_id, label, text)."""
    return labelled_sample(docs, labels, label, most)


def learn(labelled: DataFrame) -> Neighbours:
    """The space and its labelled vectors from bounded labelled rows (doc_id, text, label)."""

    @pandas_udf("binary")
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            yield pd.Series([row.tobytes() for row in terms(*_texts(values)).astype("<f4")], dtype=object)

    rows = labelled.select("doc_id", "label", packed("text").alias("terms")).collect()
    rows.sort(key=lambda row: (row["doc_id"], row["label"], row["terms"]))
    labels = np.array([row["label"] for row in rows], np.float32)
    table = np.array([np.frombuffer(row["terms"], "<f4") for row in rows], np.float32).reshape(-1, TERMS)
    weights = np.log((1 + len(table)) / (1 + (table > 0).sum(axis=0))).astype(np.float32) + 1
    table = table * weights
    values, vectors = np.linalg.eigh(table.T @ table)
    top = np.argsort(values)[::-1][:DIMENSIONS]
    projection = np.ascontiguousarray(vectors[:, top], np.float32)
    return Neighbours(weights, projection, _unit(table @ projection), labels)


def vote(table: np.ndarray, model: Neighbours) -> np.ndarray:
    """Score of each row of terms."""
    scores = np.full(len(table), 0.5)
    count = min(NEIGHBOURS, len(model.labels))
    for first in range(0, len(table) if count else 0, BLOCK):
        cosine = _unit(table[first:first + BLOCK] * model.weights @ model.projection) @ model.vectors.T
        near = np.argpartition(-cosine, count - 1, axis=1)[:, :count]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(float) ** SHARPNESS
        total = weight.sum(axis=1)
        voted = (weight * model.labels[near]).sum(axis=1)
        scores[first:first + BLOCK] = np.where(total > 0, voted / np.maximum(total, 1e-300), 0.5)
    return np.clip(scores, 0, 1)


def quality(text: Column, model: Broadcast[Neighbours]) -> Column:
    """Score of each text; null is an empty text, and 0.5 stands for a text that is like none."""

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            yield pd.Series(vote(terms(*_texts(values)), model.value), dtype="float64")

    return score(text)
