from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import log_bilinear

from .conftest import LOWER, prose, words

END = object()


def tokens(text):
    return [*words((text or "").translate(LOWER)), END]


def scored(corpus, learning, texts, **more):
    model, counts = log_bilinear.learn(corpus(learning))
    docs = corpus(texts, **more).selectExpr("doc_id", "doc_id % 2 = 0 AS held_out", "text")
    return model, log_bilinear.score(docs, model, counts).collect()


@pytest.mark.parametrize("head", [200_000, 20])
def test_base_scores_and_counts(corpus, monkeypatch, head):
    monkeypatch.setattr(log_bilinear, "HEAD", head)
    monkeypatch.setattr(log_bilinear, "STEPS", 50)
    learning = [prose(n, 80) for n in range(40)] + ["the cat The CAT. sat"] * 30 + [None, ""]
    texts = [*learning[:3], "the cat was Not seen", None, "", "\n", "É the", prose(4, 5000), "x" * 70000, "same", "same"]
    _, rows = scored(corpus, learning, texts, clashing=True)
    count = Counter(t for text in learning for t in tokens(text))
    total, distinct = sum(count.values()), len(count)
    assert len(rows) == len(texts)
    for row in rows:
        own = tokens(texts[row["doc_id"]])
        base = sum(math.log10((count[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in own)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(own), sum(count[t] > 0 for t in own), total)
        assert row["base_score"] == pytest.approx(base, rel=1e-9) and row["score"] < 0
        assert row["held_out"] == (row["doc_id"] % 2 == 0)


def test_words_of_one_frequency_fill_the_head(corpus, monkeypatch):
    monkeypatch.setattr(log_bilinear, "HEAD", 200)
    monkeypatch.setattr(log_bilinear, "STEPS", 5)
    model, rows = scored(corpus, [f"word{n} other{n}" for n in range(1000)], ["word1 other2"])
    assert len(model.head) == 200 and len(model.unit_words) == log_bilinear.WORDS
    assert rows[0]["n_known"] == 3


def test_probabilities_sum_to_one(corpus, monkeypatch):
    monkeypatch.setattr(log_bilinear, "STEPS", 50)
    learning = ["a b c d e f g"] * 3 + [prose(n, 60) for n in range(30)]
    vocabulary = sorted({t for text in learning for t in tokens(text) if t is not END})
    model, rows = scored(corpus, learning, vocabulary + [""])
    assert np.allclose((10 ** model.table.astype(float)).sum(axis=1), 1, atol=1e-4)
    # The first word of a text: all known words, the end, and an unseen word of each class.
    first = sum(10 ** (r["score"] - end) for r, end in ((r, last(model, vocabulary[r["doc_id"]])) for r in rows if r["n_tokens"] == 2))
    none = sum(10 ** r["score"] for r in rows if r["n_tokens"] == 1)
    unseen = sum(10 ** float(model.table[0, 1 + log_bilinear.WORDS + c]) * 0.1 / 10 ** model.class_logs[c] for c in range(log_bilinear.CLASSES))
    assert first + none + unseen == pytest.approx(1, abs=1e-3)


def last(model, word):
    """Log-probability of the end after a text of one word."""
    hashes, classes, _ = log_bilinear._tokens(pa.array([word]))
    unit = log_bilinear._units(hashes, classes, model.unit_words)[0]
    return float(model.table[unit, 0])


def test_model_learns_what_follows(corpus):
    pattern = [" ".join(["red", "fish", "blue", "bird"][(n + i) % 4] for i in range(60)) for n in range(200)]
    _, rows = scored(corpus, pattern[:150], pattern[150:])
    assert all(row["score"] > 0.5 * row["base_score"] for row in rows)
    again = scored(corpus, pattern[:150], pattern[150:])[1]
    assert {r["doc_id"]: r["score"] for r in again} == pytest.approx({r["doc_id"]: r["score"] for r in rows}, rel=1e-6)


def test_rare_triples_are_learnt(monkeypatch):
    monkeypatch.setattr(log_bilinear, "STEPS", 300)
    units = log_bilinear.UNITS
    code = lambda far, near, unit: (far * units + near) * units + unit
    # Beside 10**9 common triples, pairs of contexts with a follower each, counted 100 times.
    common = {code(1, 1, 1): 10**9, code(2, 2, 2): 10**9}
    rare = {code(n, n, n + 1): 100 for n in range(10, 60, 2)}
    codes = np.array(sorted(common | rare))
    table = log_bilinear.train(codes, np.array([(common | rare)[c] for c in codes]))
    for n in range(10, 60, 2):
        m = 10 + (n - 10 + 2) % 50
        assert table[n * units + n, n + 1] > table[m * units + m, n + 1] + 1


def test_nothing_to_learn_from(corpus):
    _, rows = scored(corpus, [], ["some words", None])
    assert all(row["n_known"] == 0 and row["train_tokens"] == 0 and row["base_score"] == pytest.approx(0) for row in rows)
    assert scored(corpus, ["a"], [])[1] == []
