from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tidemark.llm.common import stored

from .conftest import prose, words


def targets(sizes):
    """Shares by weight, at most three times a source's size, by the rule itself."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        whole = sum(weight[s] for s in rest)
        got = {s: 3 * sizes[s] if s in full else left * weight[s] / whole for s in names}
        above = [s for s in rest if got[s] > 3 * sizes[s]]
        if not above:
            return got
        full.update(above)


def sources():
    made = []
    for number, (name, docs, length) in enumerate([("a", 60, 40), ("b", 3, 30), ("é", 200, 25), ("z", 90, 60), (None, 30, 50), ("B", 1, 3)]):
        made += [(name, prose(1000 * number + n, length + n % 9)) for n in range(docs)]
    return made + [("a", None), ("a", ""), ("z", prose(5, 9000)), ("void", "")]


def planned(corpus, rows, **more):
    docs = corpus([t for _, t in rows], sources=[s for s, _ in rows], **more)
    thin = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", mixing.size(F.col("text")).alias("size"))
    return docs, mixing.plan(stored(thin))


def test_targets_and_taken_words(corpus):
    rows = sources()
    _, plan = planned(corpus, rows, clashing=True)
    found = plan.collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for name, text in rows:
        sizes[name] += len(words(text))
    wanted = targets(sizes)
    assert len(found) == len(rows)
    for row in found:
        assert row["size"] == len(words(rows[row["doc_id"]][1])) and row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(wanted[row["source"]])
        assert 0 <= row["taken"] <= 3 * row["size"]
        taken[row["source"]] += row["taken"]
    for name in sizes:
        assert abs(taken[name] - wanted[name]) <= 2 * mixing.BLOCK_WORDS
    again = planned(corpus, rows)[1].collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in found)


def test_mixed_texts_hold_the_taken_words(corpus):
    rows = sources()
    docs, plan = planned(corpus, rows, clashing=True)
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    counts = defaultdict(int)
    for row in mixed.select("doc_id", "text", "n_chars").collect():
        counts[row["doc_id"]] += len(words(row["text"]))
        assert row["n_chars"] == len(row["text"])
    assert counts == {r["doc_id"]: r["taken"] for r in plan.collect() if r["taken"]}


def test_documents_are_whole_but_at_the_ends_of_a_run(corpus):
    rows = [(s, "\n".join([f"{s}{n}", *(prose(100 * n + i, 9).replace(" ", "\t", 3) for i in range(12))])) for s in "abc" for n in range(80)]
    mixed = mixing.mixed(corpus([t for _, t in rows], sources=[s for s, _ in rows])).collect()
    pieces = defaultdict(list)
    for row in mixed:
        source, text = rows[row["doc_id"]]
        # What is taken of a document is one run of its text, white space and all.
        assert row["text"] in text
        if row["text"] != text:
            pieces[source].append(row["text"])
    assert pieces and all(len(cut) <= 2 for cut in pieces.values())
    assert 20 < len({row["doc_id"] for row in mixed if rows[row["doc_id"]][0] == "a"}) < 80


@pytest.mark.parametrize("seats", [0, 1, 7, 40, 1000])
def test_apportionment_by_highest_quotients(spark, corpus, seats):
    claims = [("a", 10.0), ("b", 20.5), ("c", 20.5), (None, 3.25), ("d", 0.0), ("e", 77.75), ("f", 20.5)]
    units = stored(spark.createDataFrame([(s, 0, c) for s, c in claims], "source string, shard long, claim double"))
    found = {r["source"]: r["quota"] for r in mixing.apportion(units, seats, ["source", "shard"]).collect()}
    held = {s: 0 for s, _ in claims}
    for _ in range(seats):
        best = max(claims, key=lambda item: (item[1] / (2 * held[item[0]] + 1), item[0] is not None, [-ord(c) for c in item[0] or ""]))
        held[best[0]] += 1
    assert found == held


def test_rows_without_id_are_spread(spark):
    rows = stored(spark.range(4096).select(
        F.col("id").alias("row"), F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit(20).cast("long").alias("size"),
        F.lit(7).cast("long").alias("mark"),
    ))
    shards = mixing.plan(rows).groupBy("shard").count().collect()
    assert len(shards) == 4 and max(row["count"] for row in shards) < 1400


def test_repeated_rows_and_empty_tables(corpus):
    _, plan = planned(corpus, [("a", "one two three")] * 5, ids=[1, 1, 1, None, None])
    assert sum(r["taken"] for r in plan.collect()) == 15
    assert planned(corpus, [])[1].collect() == []
    assert mixing.mixed(corpus([])).collect() == []
    assert mixing.mixed(corpus([None, ""])).collect() == []
