"""Toxicity of texts by a weighted lexicon, matched with an Aho-Corasick automaton.

Texts are folded first: compatibility forms, letters of other scripts that look Latin, digits and
signs that stand for letters. Marks between letters are kept apart from words. A term of the lexicon
is a whole word or the beginning of a word; of overlapping terms the longest counts. Hits inside an
exception phrase do not count. The sum of the weights is normalised by the length of the text and
turned into a score from 0 to 1 by a logistic curve.

The lexicon and the curve are learnt from labelled rows (``learn``), at most ``SAMPLE`` of each
class, chosen by a hash of the id: terms are chosen one by one, by how many toxic rows each explains
that few before it do. The beginning of a word is a candidate only if several words of toxic rows go
on from it and none of them stands for most of its rows; else the whole word is. Built-in terms are used
only where a class has too few labelled rows to learn from.
"""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from .common import give_back, labelled_sample, released, stored

# Letters of other scripts and signs that look like Latin letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "ё": "e", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ɡ": "g", "ո": "n", "ս": "u", "ӏ": "l",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ɑ": "a", "ℓ": "l", "ǃ": "i",
}
# Digits and signs written for letters inside a word.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
# Built-in terms, and phrases in which a term is meant otherwise.
BUILT_IN = ("idiot", "moron", "stupid", "scum", "worthless", "pathetic", "disgusting", "loser", "trash", "clown")
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "circus clown", "class clown", "sore loser")

#: Labelled rows of each class that the lexicon is learnt from, at most.
SAMPLE = 3000
#: The shortest and longest beginning of a word that may become a term, and how many words have to go on from it.
SHORTEST, LONGEST, WORDS = 4, 10, 3
#: Toxic rows a term must be in, and in how many of them it must be among the first terms that explain
#: them; and its least weight: the log of how much more frequent it is among the words of toxic rows.
LEAST_ROWS, LEAST_NEW, LEAST_WEIGHT = 5, 3, 3.0
#: Terms that may explain a row, and occurrences in one text that count.
EXPLAINED, REPEATS = 3, 5
#: Weight of built-in terms, and the number of words from which a text counts as long.
BUILT_IN_WEIGHT, LONG_TEXT = 3.0, 200

_FOLD = str.maketrans(HOMOGLYPHS)
_MARKS = re.compile(r"[­​-‏⁠﻿]")
_MIXED = re.compile(r"(?<=[^\W\d_])[0134578@$!]+(?=[^\W\d_])|\b[0134578@$]+(?=[^\W\d_]\w)|(?<=[^\W\d_]{2})[0134578@$]+\b")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Lexicon:
    """Terms with their weights (a term that ends with a space is a whole word), and the curve of the score."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    slope: float = 1.0
    offset: float = -2.0


def fold(text: str) -> str:
    """Folded words of a text, each with a space on either side of it."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = _MARKS.sub("", text.lower()).translate(_FOLD)
    text = _MIXED.sub(lambda found: "".join(DIGITS[c] for c in found.group()), text)
    words = _WORD.findall(text)
    return f" {' '.join(words)} " if words else ""


def automaton(lexicon: Lexicon) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for term, weight in lexicon.weights.items():
        built.add_word(f" {term}", (len(term), weight))
    for phrase in lexicon.exceptions:
        built.add_word(f" {phrase} ", (len(phrase) + 1, None))
    built.make_automaton()
    return built


def matches(folded: str, built: ahocorasick.Automaton) -> list[tuple[int, int, float]]:
    """Spans of the folded text with their weights; the longest of overlapping terms, none in an exception."""
    found: dict[int, tuple[int, float | None]] = {}
    for end, (length, weight) in built.iter(folded):
        begin = end - length + 1
        if begin not in found or length > found[begin][0]:
            found[begin] = (length, weight)
    hits, covered = [], 0
    for begin in sorted(found):
        length, weight = found[begin]
        if weight is None:
            covered = max(covered, begin + length)
            while hits and hits[-1][1] > begin:
                hits.pop()
        elif begin >= covered:
            hits.append((begin, begin + length, weight))
    return hits


def strength(text: str | None, built: ahocorasick.Automaton | None) -> float:
    """Sum of the weights normalised by the length: each further stretch of words halves it more slowly."""
    if not text or built is None or not len(built):
        return 0.0
    folded = fold(text)
    total = sum(weight for _, _, weight in matches(folded, built))
    return total / (1 + math.log1p((folded.count(" ") - 1) / LONG_TEXT)) if total else 0.0


def logistic(value: float, lexicon: Lexicon) -> float:
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, lexicon.slope * value + lexicon.offset))))


def toxicity(text: Column, lexicon: Lexicon) -> Column:
    """Score of each text; null, empty and wordless texts get that of a text without hits."""

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        built = automaton(lexicon)
        for texts in batches:
            yield pd.Series([logistic(strength(text, built), lexicon) for text in texts], dtype="float64")
        give_back()

    return score(text)


def _terms(words: list[str]) -> Counter:
    """Whole words and beginnings of words, with their occurrences."""
    terms: Counter = Counter()
    for word, count in Counter(words).items():
        if len(word) >= SHORTEST:
            for length in range(SHORTEST, min(len(word), LONGEST) + 1):
                terms[word[:length]] += count
            if len(word) <= 2 * LONGEST:
                terms[f"{word} "] += count
    return terms


#: Stands for every word in the counts of terms.
EVERY = ""


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, list[int]] = {}

    def rows() -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.string()), *(pa.array(column, pa.int64()) for column in zip(*counts.values()))]
        counts.clear()
        return pa.RecordBatch.from_arrays(columns, names=["term", "clean", "toxic", "texts"])

    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            words = fold(text or "").split()
            for term, count in [*_terms(words).items(), (EVERY, len(words))]:
                own = counts.setdefault(term, [0, 0, 0])
                own[label] += count if term == EVERY else min(count, REPEATS)
                own[2] += label
            if len(counts) > 400_000:
                yield rows()
    if counts:
        yield rows()


def _continued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words that go on from each beginning, with the number of texts that have them."""
    counts: Counter = Counter()

    def rows() -> pa.RecordBatch:
        known = list(counts)
        columns = [[pair[0] for pair in known], [pair[1] for pair in known]]
        numbers = pa.array([counts[pair] for pair in known], pa.int64())
        counts.clear()
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns), numbers], names=["term", "word", "n"])

    for batch in batches:
        for text in batch.column("text").to_pylist():
            for word in set(fold(text or "").split()):
                counts.update((word[:length], word) for length in range(SHORTEST, min(len(word), LONGEST) + 1))
            if len(counts) > 200_000:
                yield rows()
    yield rows()


def sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """The bounded labelled rows to learn from: (doc_id, label, text)."""
    return labelled_sample(docs, labels, "toxic", most)


def learn(labelled: DataFrame) -> Lexicon:
    """Lexicon and curve from bounded labelled rows (text, label)."""
    labelled = stored(labelled.select("text", "label"))
    sizes = {row["label"]: row["n"] for row in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    few = min(toxic, clean) < LEAST_ROWS
    weights = {term: BUILT_IN_WEIGHT for term in BUILT_IN} if few else {}
    if toxic and clean:
        weights |= _needed(labelled.where("label = 1"), _candidates(labelled))
    lexicon = Lexicon(weights)
    return _fitted(labelled, lexicon) if toxic and clean else lexicon


def _candidates(labelled: DataFrame) -> dict[str, float]:
    """Words, and beginnings that stand for several words, with their weights; the labelled rows bound them."""
    sums = [F.sum(name).alias(name) for name in ("toxic", "clean", "texts")]
    counts = stored(labelled.mapInArrow(released(_counted), "term string, clean long, toxic long, texts long").groupBy("term").agg(*sums))
    every = counts.where(F.col("term") == EVERY).first()
    rate = [F.log((F.col(name) + 0.5) / (every[name] + 1)) for name in ("toxic", "clean")]
    likely = counts.where((F.col("term") != EVERY) & (F.col("texts") >= LEAST_ROWS)).withColumn("weight", rate[0] - rate[1])
    going_on = labelled.where("label = 1").mapInArrow(released(_continued), "term string, word string, n long")
    going_on = going_on.groupBy("term", "word").agg(F.sum("n").alias("n"))
    going_on = going_on.groupBy("term").agg(F.count("*").alias("words"), F.max("n").alias("most"))
    several = F.endswith("term", F.lit(" ")) | ((F.col("words") >= WORDS) & (2 * F.col("most") <= F.col("texts")))
    chosen = likely.where(F.col("weight") >= LEAST_WEIGHT).join(going_on, "term", "left").where(several)
    rows = {row["term"]: row for row in chosen.select("term", "weight", "toxic", "clean").collect()}
    # Of beginnings that go on in one way only, the longest stands for them.
    longer = {(term[:-1], row["toxic"], row["clean"]) for term, row in rows.items() if not term.endswith(" ")}
    return {term: row["weight"] for term, row in rows.items() if (term, row["toxic"], row["clean"]) not in longer}


def _needed(toxic: DataFrame, weights: dict[str, float]) -> dict[str, float]:
    """The candidates that explain the toxic rows: again and again the term of the largest weight times
    number of rows that fewer than ``EXPLAINED`` chosen terms are in; of equals a whole word, then the
    longest. Words that only stand beside terms, as in copies of a toxic text, explain little and are left out."""

    @pandas_udf("array<string>")
    def held(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = [_terms(fold(text or "").split()).keys() & weights.keys() for text in texts]
            yield pd.Series([sorted(terms) for terms in found], dtype=object)
        give_back()

    inside: dict[str, set[int]] = {}
    rows = [row[0] for row in toxic.select(held("text")).collect()]
    for number, terms in enumerate(rows):
        for term in terms:
            inside.setdefault(term, set()).add(number)
    left = [EXPLAINED] * len(rows)

    def gain(term: str) -> tuple:
        return -len(inside[term]) * weights[term], not term.endswith(" "), -len(term), term

    # A term's open rows only get fewer, so the first one whose gain is up to date is the best.
    queue = [gain(term) for term in inside]
    heapq.heapify(queue)
    chosen = {}
    while queue:
        entry = heapq.heappop(queue)
        term = entry[-1]
        inside[term] = {number for number in inside[term] if left[number]}
        if len(inside[term]) < LEAST_NEW:
            continue
        if gain(term) != entry:
            heapq.heappush(queue, gain(term))
            continue
        chosen[term] = weights[term]
        for number in inside[term]:
            left[number] -= 1
    return chosen


def _fitted(labelled: DataFrame, lexicon: Lexicon) -> Lexicon:
    """The curve that fits the labelled rows: logistic regression on the normalised sum, lightly damped."""

    @pandas_udf("double")
    def value(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        built = automaton(lexicon)
        for texts in batches:
            yield pd.Series([strength(text, built) for text in texts], dtype="float64")
        give_back()

    rows = np.array(labelled.select(value("text"), F.col("label").cast("double")).collect(), float).reshape(-1, 2)
    x, y = rows[:, 0], rows[:, 1]
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    design = np.column_stack([x, np.ones_like(x)])
    prior, damping = np.array([lexicon.slope, lexicon.offset]), np.array([1e-3, 1e-3])
    found = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ found, -60, 60)))
        gradient = design.T @ (share * (p - y)) + damping * (found - prior)
        curvature = (design * (share * p * (1 - p))[:, None]).T @ design + np.diag(damping)
        step = np.linalg.solve(curvature, gradient)
        found -= np.clip(step, -5, 5)
        if abs(step).max() < 1e-9:
            break
    return Lexicon(lexicon.weights, lexicon.exceptions, float(max(found[0], 0.05)), float(found[1]))
