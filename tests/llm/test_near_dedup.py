from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import near_dedup
from tidemark.llm import words as W
from tidemark.llm.components import components

from .conftest import LOWER, prose, words


def bag(text):
    own = words((text or "").translate(LOWER))
    return Counter(tuple(own[i:i + 5]) for i in range(max(1, len(own) - 4))) if own else Counter()


def alike(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def classes(texts):
    """Least index of each class, by brute force."""
    bags, root = [bag(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if bags[a] and alike(bags[a], bags[b]) >= 0.8:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [find(x) for x in range(len(texts))]


def changed(text, places, seed):
    own = text.split()
    for place in random.Random(seed).sample(range(len(own)), places):
        own[place] = f"new{seed}x{place}"
    return " ".join(own)


def family():
    base, heavy = prose(1, 300), "again and again we say so " * 40
    texts = [base, base.upper(), None, "", " \n", "two words", "Two Words", "two  words", heavy, heavy + "we say so ", prose(2, 20000)]
    texts += [changed(base, n, n) for n in (1, 2, 4, 6, 8, 12, 30, 80)]
    texts += [changed(changed(base, 5, 50), 5, n) for n in range(60, 72)]
    texts += [prose(n, 5 + n) for n in range(100, 160)] + [changed(prose(2, 20000), 300, 7)]
    return texts


def test_classes_equal_brute_force(corpus):
    texts = family()
    rows = near_dedup.near_duplicates(corpus(texts, clashing=True)).collect()
    assert {row["doc_id"]: row["class_id"] for row in rows} == dict(enumerate(classes(texts)))
    assert {row["doc_id"] for row in rows if row["kept"]} == set(classes(texts))
    copies = Counter(tuple(sorted(bag(t).items())) for t in texts if bag(t))
    assert all(row["n_copies"] == copies.get(tuple(sorted(bag(texts[row["doc_id"]]).items())), 1) for row in rows)


def test_bucket_of_many_near_copies(corpus):
    base = prose(9, 200)
    texts = [changed(base, 1 + n % 6, n) for n in range(120)]
    rows = near_dedup.near_duplicates(corpus(texts)).collect()
    assert {row["doc_id"]: row["class_id"] for row in rows} == dict(enumerate(classes(texts)))


def test_no_pair_is_lost_to_marks_that_agree_by_chance(corpus):
    texts = []
    for n in range(4000):
        base = prose(10_000 + n, 54 + n % 40)
        texts += [base, changed(base, 1, n)]
    linked = [alike(bag(texts[i]), bag(texts[i + 1])) >= 0.8 for i in range(0, len(texts), 2)]
    assert sum(linked) > 3900
    rows = near_dedup.near_duplicates(corpus(texts)).collect()
    found = {row["doc_id"]: row["class_id"] for row in rows}
    assert [found[i] == found[i + 1] for i in range(0, len(texts), 2)] == linked


def test_keep_has_the_columns_and_one_of_each(corpus):
    texts = family()
    docs = corpus(texts + texts[:3], ids=[*range(len(texts)), 0, None, None], clashing=True)
    kept = near_dedup.keep(docs)
    assert kept.columns == docs.columns
    ids = sorted((row["doc_id"] is None, row["doc_id"] or 0) for row in kept.collect())
    assert ids == sorted([(False, i) for i in set(classes(texts))] + [(True, 0)])


def test_empty_table(corpus):
    assert near_dedup.near_duplicates(corpus([])).collect() == []
    assert near_dedup.keep(corpus([])).collect() == []


@pytest.mark.parametrize("heavy", [1, 3, 20])
def test_values_agree_as_often_as_the_weighted_similarity(heavy):
    one = " ".join(["a b c d e f"] * heavy + [f"w{i}" for i in range(60)])
    two = " ".join(["a b c d e f"] * (2 * heavy) + [f"w{i}" for i in range(40)] + [f"z{i}" for i in range(20)])
    values = near_dedup.signatures(*near_dedup.shingles(*W.buffers(pa.array([one, two]))), 20000)
    assert abs(np.mean(values[0] == values[1]) - alike(bag(one), bag(two))) < 0.015


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (200, 201), (201, 200)]
    rows = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert rows == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 50)}, 201: 200}
