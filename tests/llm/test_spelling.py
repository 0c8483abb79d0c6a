from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, spelling

from .conftest import LOWER
from .test_queries import DATA, needs_data

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            mark = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if mark % 97 == 0:
                run = run[:mark % len(run)] + run[mark % len(run) + 1:]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 5 and n >= 3}


def brute_near(words):
    """Near words by marks of each word with one place left open, of equal length or one shorter."""
    open_, near = defaultdict(set), defaultdict(set)
    for word in words:
        for place in range(len(word)):
            open_[word[:place], word[place + 1:]].add(word)
            shorter = word[:place] + word[place + 1:]
            if shorter in words:
                near[word].add(shorter)
                near[shorter].add(word)
    for same in open_.values():
        for word in same:
            near[word] |= same - {word}
    return near


def brute_groups(counts):
    near = brute_near(counts)
    form = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda other: (-counts[other], other), default=None)
        if best is not None and counts[best] >= 2 * n:
            form[word] = best
    rows = []
    for word, n in counts.items():
        root = word
        while root in form:
            root = form[root]
        rows.append((word, form.get(word), root, n, len(near[word]), counts.get(form.get(word))))
    return sorted(rows, key=repr)


def rows_of(frame):
    return sorted((tuple(row[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for row in frame.collect()), key=repr)


@pytest.mark.parametrize("letters", ["ab", "abÿ÷", "abcdefghij"])
def test_composition_accepts_near_pairs_once(letters):
    draw = random.Random(letters)
    for _ in range(60):
        words = sorted({"".join(draw.choice(letters) for _ in range(draw.randint(0, 6))) for _ in range(draw.randint(0, 50))})
        found = [frozenset(pair) for pair in spelling.near_pairs(words)]
        near = brute_near(words)
        assert len(found) == len(set(found))
        assert set(found) == {frozenset((a, b)) for a in near for b in near[a]}


def test_acceptor_is_minimal_and_accepts_its_words():
    words = sorted(["tapping", "topping", "taps", "tops", "zapping", "zaps"])
    own = spelling.Acceptor(words)
    reached, accepted, todo = set(), [], [("", 0)]
    while todo:
        path, state = todo.pop()
        reached.add(state)
        if own.final[state]:
            accepted.append(path)
        todo += [(path + letter, target) for letter, target in own.arcs[state].items()]
    assert sorted(accepted) == words
    # First state, behind t, z, ta/to, tap.. and one chain of "ping" that "s" shares the end of.
    assert len(reached) == 9


def test_very_long_words():
    long = "ab" * 30000
    words = sorted([long, long[:9] + "x" + long[10:], long[:50000] + long[50001:], "q" + long[1:50] + "q" + long[51:]])
    assert len(list(spelling.near_pairs(words))) == 2


@pytest.mark.parametrize("most", [4096, 3])
def test_groups_equal_brute_force(spark, most):
    draw = random.Random(most)
    counts = {"".join(draw.choice("abcé") for _ in range(draw.randint(5, 8))): draw.choice([3, 4, 7, 8, 40, 90]) for _ in range(900)}
    counts |= {"a" * n: 3 * n for n in range(5, 60)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.grouped(frame, most=most)) == brute_groups(counts)


def test_words_of_documents(spark, corpus):
    draw = random.Random(6)
    stems = ["".join(draw.choice("abcdé×") for _ in range(draw.randint(4, 8))) for _ in range(60)]
    texts = [None, "", "12 34 - ", "ÀÉ ÀÉ", "X" * 40000 + " ", "x" * 40000] + [
        draw.choice([" ", "\n", "1", "_"]).join(draw.choice([str.upper, str.lower, str.title])(draw.choice(stems)) for _ in range(200))
        for _ in range(40)
    ]
    texts += [texts[-1]] * 3 + ["z" * 3000] * 3
    ids = [None if n % 9 == 0 else n for n in range(len(texts))]
    frame = spelling.spelling_variants(corpus(texts, ids=ids, clashing=True))
    assert rows_of(frame) == brute_groups(brute_words(zip(ids, texts)))


def test_letters_left_out(spark):
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("spelling").alias("run"))
    found = [r[0] for r in rows.orderBy("doc_id").select(spelling.spelt(F.col("doc_id"), F.col("run"))).collect()]
    wanted = []
    for n in range(400):
        mark = zlib.crc32(f"{n}:spelling".encode())
        wanted.append("spelling" if mark % 97 else "spelling"[:mark % 8] + "spelling"[mark % 8 + 1:])
    assert found == wanted and len(set(found)) > 1


def test_no_documents(spark, corpus):
    assert spelling.spelling_variants(corpus([])).collect() == []
    assert spelling.spelling_variants(corpus([None, ""])).collect() == []


@needs_data
def test_registered_query(spark, corpus):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert rows_of(queries.QUERIES["op13_spelling"](spark, str(DATA))) == brute_groups(brute_words(docs))
