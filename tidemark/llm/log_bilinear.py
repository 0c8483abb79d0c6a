"""Language model scores: a log-bilinear neural model over units, trained by noise-contrastive estimation.

Tokens are words (ASCII lower case) and one end for each text. All tokens of the learning rows are
counted. The most frequent words are units of their own, as is the end; every other word belongs to a
class by its last two bytes. The model predicts a unit from the two before it: a context's vector is the
sum of its units' vectors, each times a matrix of its place, and a unit's score is its product with the
unit's vector plus a bias. Its probabilities are normalised for every context in one matrix product. A
word of a class has the share of its smoothed count in the class, an unseen one that of a further word;
so the probabilities of all words and of the unseen sum to 1.

The triples of units are counted over all learning rows; their number is bounded by the third power of
``UNITS``, so the driver trains on the counts of the whole corpus, whatever its size: every step takes
all counted triples and the expected noise. Only the units have vectors; a word of a class has its
class's, so the vocabulary of the context does not grow with the corpus. Counts of words stay a table: the most frequent (at most ``HEAD``) go to every task, the rest is joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import stored

#: Units: the end, words of their own, classes. Words whose counts go to every task.
WORDS, CLASSES = 63, 64
UNITS = 1 + WORDS + CLASSES
HEAD = 200_000
#: Dimensions, training steps, noise units for each triple, rate of learning.
DIMENSIONS, STEPS, NOISE, RATE = 24, 1500, 64, 0.02
#: Added to each count.
ALPHA = 0.1

_MOST_KEPT = 1 << 20


@dataclass(frozen=True)
class Model:
    """Log10 probabilities of units by their two predecessors, counts of frequent words, and totals."""

    table: np.ndarray
    unit_words: np.ndarray
    head: np.ndarray
    head_counts: np.ndarray
    class_logs: np.ndarray
    ends: int
    tokens: int
    distinct: int


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and class of each word, and the index of the first word of each text."""
    data, bounds = W.buffers(column)
    starts, ends, firsts = W.spans(data, bounds)
    hashes = W.word_hashes(data, starts, ends, W.LOWER)
    if not len(starts):
        return hashes, np.zeros(0, np.int64), firsts
    last = W.LOWER[data[ends - 1]]
    before = np.where(ends - starts > 1, W.LOWER[data[np.maximum(ends - 2, 0)]], np.uint64(0))
    return hashes, (W.mix(before * np.uint64(256) + last) % np.uint64(CLASSES)).astype(np.int64), firsts


def _units(hashes: np.ndarray, classes: np.ndarray, unit_words: np.ndarray) -> np.ndarray:
    units = classes + 1 + WORDS
    if len(unit_words):
        place = np.minimum(np.searchsorted(unit_words, hashes), len(unit_words) - 1)
        units = np.where(unit_words[place] == hashes, place + 1, units)
    return units


def _sequence(units: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code of predecessors and unit of each token, the end after each text, and the text it is in."""
    texts = len(firsts) - 1
    text = np.repeat(np.arange(texts), np.diff(firsts) + 1)
    line = np.zeros(len(units) + texts, np.int64)
    line[np.arange(len(units)) + np.repeat(np.arange(texts), np.diff(firsts))] = units
    one, two = np.zeros_like(line), np.zeros_like(line)
    one[1:], two[2:] = line[:-1], line[:-2]
    two[firsts[:-1] + np.arange(texts)] = 0
    return two * UNITS + one, line, text


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes, at, place = np.unique(np.concatenate([k[0] for k in kept]), return_index=True, return_inverse=True)
        counts = np.bincount(place, weights=np.concatenate([k[2] for k in kept]), minlength=len(hashes))
        return hashes, np.concatenate([k[1] for k in kept])[at], counts

    def rows(whole) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(whole[0].view(np.int64)), pa.array(whole[1]), pa.array(whole[2].astype(np.int64))],
            names=["word", "class", "n"],
        )

    size = 0
    for batch in batches:
        hashes, classes, _ = _tokens(batch.column("text"))
        own, at, counts = np.unique(hashes, return_index=True, return_counts=True)
        kept.append((own, classes[at], counts))
        size += len(own)
        if size > 2 * _MOST_KEPT:
            kept = [merged()]
            size = len(kept[0][0])
            if size > _MOST_KEPT:
                yield rows(kept.pop())
                size = 0
    if kept:
        yield rows(merged())


def _triples(unit_words: np.ndarray):
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(UNITS ** 3, np.int64)
        for batch in batches:
            hashes, classes, firsts = _tokens(batch.column("text"))
            context, unit, _ = _sequence(_units(hashes, classes, unit_words), firsts)
            total += np.bincount(context * UNITS + unit, minlength=len(total))
        codes = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(total[codes])], names=["code", "n"])

    return counted


def train(codes: np.ndarray, counts: np.ndarray, seed: int = 42) -> np.ndarray:
    """Log10 probabilities (contexts x units) from counted triples, by noise-contrastive estimation."""
    rng = np.random.default_rng(seed)
    scale = 0.1
    shapes = {"context": (UNITS, DIMENSIONS), "unit": (UNITS, DIMENSIONS), "bias": (UNITS,)}
    p = {name: (scale * rng.standard_normal(shape)).astype(np.float32) for name, shape in shapes.items()}
    p |= {"far": np.eye(DIMENSIONS, dtype=np.float32) / 2, "near": np.eye(DIMENSIONS, dtype=np.float32)}
    if len(codes):
        # Each step goes over all counted triples, and over all units as noise by their shares.
        seen = np.bincount(codes, weights=counts, minlength=UNITS ** 3).reshape(-1, UNITS)
        share = seen.sum(axis=0) + 1.0
        noise = share / share.sum()
        p["bias"] = np.log(noise).astype(np.float32)
        prior = np.log(NOISE * noise).astype(np.float32)
        seen = (seen / seen.sum()).astype(np.float32)
        drawn = seen.sum(axis=1, keepdims=True) * (NOISE * noise).astype(np.float32)
        both = seen + drawn
        moments = {name: (np.zeros_like(v), np.zeros_like(v)) for name, v in p.items()}
        for step in range(1, STEPS + 1):
            hidden = (p["context"] @ p["far"])[:, None, :] + (p["context"] @ p["near"])[None, :, :]
            hidden = hidden.reshape(-1, DIMENSIONS)
            score = hidden @ p["unit"].T
            score += p["bias"] - prior
            # Gradients of the log-likelihood of telling data from noise: seen * (1 - s) - drawn * s.
            np.clip(score, -50, 50, out=score)
            np.exp(-score, out=score)
            score += 1
            side = seen - both / score
            back = (side @ p["unit"]).reshape(UNITS, UNITS, DIMENSIONS)
            back_far, back_near = back.sum(axis=1), back.sum(axis=0)
            g = {"far": p["context"].T @ back_far, "near": p["context"].T @ back_near}
            g["context"] = back_far @ p["far"].T + back_near @ p["near"].T
            g["unit"], g["bias"] = side.T @ hidden, side.sum(axis=0)
            rate = np.float32(RATE * min(1.0, 2 * (1 - step / (STEPS + 1))))
            for name, (first, second) in moments.items():
                first += 0.1 * (g[name] - first)
                second += 0.01 * (g[name] ** 2 - second)
                fixed = first / np.float32(1 - 0.9 ** step), second / np.float32(1 - 0.99 ** step)
                p[name] = p[name] + rate * fixed[0] / (np.sqrt(fixed[1]) + 1e-12)
    p = {name: value.astype(float) for name, value in p.items()}
    hidden = (p["context"] @ p["far"])[:, None, :] + (p["context"] @ p["near"])[None, :, :]
    scores = hidden.reshape(-1, DIMENSIONS) @ p["unit"].T + p["bias"]
    scores -= scores.max(axis=1, keepdims=True)
    return ((scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))) / np.log(10)).astype(np.float32)


def learn(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the texts, and the stored table of word counts (word, class, n)."""
    texts = docs.select("text")
    counts = texts.mapInArrow(_counted, "word long, class long, n long")
    counts = stored(counts.groupBy("word").agg(F.min("class").alias("class"), F.sum("n").alias("n")))
    ends = docs.count()
    # Counts on a logarithmic scale, in at most some hundred levels: the words of the highest are the head,
    # which is full wherever there are words enough.
    level = F.floor(F.log2("n") * 8)
    levels = sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect(), reverse=True)
    least, taken, parted = 1e9, 0, None
    for at, number in levels:
        if taken + number > HEAD:
            parted = at, number
            break
        least, taken = at, taken + number
    chosen = counts.where(level >= least).collect()
    if parted is not None and taken < HEAD:
        # Of a level that does not fit whole, the words with the least hashes: these are even, so few more are looked at.
        wanted = HEAD - taken
        edge = -(1 << 63) + int((1 << 64) * min(1.0, 2 * wanted / parted[1] + 1e-3)) - 1
        own = counts.where((level == parted[0]) & (F.col("word") <= F.lit(edge))).orderBy("word").limit(wanted)
        chosen += own.collect()
    head = sorted((-n, word, kind) for word, kind, n in chosen)
    unit_words = np.sort(np.array([word for _, word, _ in head[:WORDS]], np.int64).view(np.uint64))
    kinds = {row["class"]: row for row in counts.groupBy("class").agg(
        F.sum("n").alias("n"), F.count("*").alias("words")).collect()}
    tokens = sum(row["n"] for row in kinds.values()) + ends
    distinct = sum(row["words"] for row in kinds.values()) + (ends > 0)
    # Words that are units do not belong to their class.
    sizes = np.array([[kinds[c]["n"], kinds[c]["words"]] if c in kinds else [0, 0] for c in range(CLASSES)], float)
    for minus, _, kind in head[:WORDS]:
        sizes[kind] -= [-minus, 1]
    own, order = np.unique(np.array([word for _, word, _ in head], np.int64).view(np.uint64), return_index=True)
    head_counts = np.array([-minus for minus, _, _ in head], np.int64)[order]
    triples = texts.mapInArrow(_triples(unit_words), "code long, n long")
    triples = triples.groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toArrow()
    table = train(triples.column("code").to_numpy(), triples.column("n").to_numpy())
    model = Model(
        table, unit_words, own, head_counts, np.log10(sizes[:, 0] + ALPHA * (sizes[:, 1] + 1)), ends, tokens, distinct
    )
    return model, counts


def _scored(shared):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        number = TaskContext.get().partitionId() << 33
        logs = np.log10(model.head_counts + ALPHA)
        for batch in batches:
            hashes, classes, firsts = _tokens(batch.column("text"))
            texts = len(firsts) - 1
            units = _units(hashes, classes, model.unit_words)
            context, unit, text = _sequence(units, firsts)
            part = np.bincount(text, weights=model.table[context, unit].astype(float), minlength=texts)
            owner = np.repeat(np.arange(texts), np.diff(firsts))
            place = np.minimum(np.searchsorted(model.head, hashes), max(0, len(model.head) - 1))
            known = model.head[place] == hashes if len(model.head) else np.zeros(len(hashes), bool)
            counted = np.where(known, logs[place], 0.0) if len(model.head) else np.zeros(len(hashes))
            inside = units > WORDS
            part += np.bincount(owner[inside], weights=(counted[inside] - model.class_logs[classes[inside]]), minlength=texts)
            base = np.bincount(owner, weights=counted, minlength=texts) + np.log10(model.ends + ALPHA)
            seen = np.bincount(owner, weights=known, minlength=texts).astype(np.int64) + (model.ends > 0)
            order = np.lexsort((hashes[~known], owner[~known]))
            rare, of = hashes[~known][order], owner[~known][order]
            new = np.ones(len(rare), bool)
            new[1:] = (rare[1:] != rare[:-1]) | (of[1:] != of[:-1])
            at = np.flatnonzero(new)
            times = np.diff(np.append(at, len(rare)))
            rows = np.arange(number, number + texts)
            number += texts
            void = lambda kind: pa.nulls(len(at), kind)
            more = lambda values: pa.concat_arrays([values, void(values.type)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([rows, rows[of[at]]])), more(batch.column("doc_id")),
                    more(batch.column("held_out")), more(pa.array(np.diff(firsts) + 1)), more(pa.array(seen)),
                    more(pa.array(part)), more(pa.array(base)),
                    pa.concat_arrays([pa.nulls(texts, pa.int64()), pa.array(rare[at].view(np.int64))]),
                    pa.concat_arrays([pa.nulls(texts, pa.int64()), pa.array(times)]),
                ],
                names=["row", "doc_id", "held_out", "n_tokens", "seen", "part", "base", "word", "times"],
            )

    return scored


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """Scores of documents (doc_id, held_out, text), a row for each: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.

    Null texts are empty and have their end. Without learning rows every count is 0.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    shape = (
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, seen long, part double, base double, "
        "word long, times long"
    )
    found = stored(docs.select("doc_id", "held_out", "text").mapInArrow(_scored(spark.sparkContext.broadcast(model)), shape))
    rare = found.where("word IS NOT NULL").select("row", "word", "times")
    c = F.coalesce("n", F.lit(0))
    rare = rare.join(counts.select("word", "n"), "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(c + ALPHA)).alias("more"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("seen_more"),
    )
    more, none = F.coalesce("more", F.lit(0.0)), F.lit(0).cast("bigint")
    whole = float(np.log10(model.tokens + ALPHA * (model.distinct + 1)))
    return found.where("word IS NULL").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("seen") + F.coalesce("seen_more", none)).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("part") + more).alias("score"),
    )
