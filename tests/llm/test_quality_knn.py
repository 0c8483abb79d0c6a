from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import quality_knn
from tidemark.llm import words as W

from .conftest import prose


def texts(count):
    good = [prose(n, 60 + n % 40) + ".\n" + prose(n + 5000, 50) + "." for n in range(count)]
    bad = [
        (prose(n, 60).upper().replace(" ", "!! "), " ".join(w + "***" for w in prose(n, 70).split()), (prose(n, 6) + "\n") * 15)[n % 3]
        for n in range(count)
    ]
    return good, bad


def labelled(spark, good, bad):
    rows = [(i, 1, t) for i, t in enumerate(good)] + [(1000 + i, 0, t) for i, t in enumerate(bad)]
    return spark.createDataFrame(rows, "doc_id long, label int, text string")


def test_held_out_rows(spark, corpus):
    good, bad = texts(120)
    model = spark.sparkContext.broadcast(quality_knn.learn(labelled(spark, good[:60], bad[:60])))
    rest = corpus(good[60:] + bad[60:] + [None, "", "x", prose(1, 30000)], clashing=True)
    scores = {r["doc_id"]: r["s"] for r in rest.select("doc_id", quality_knn.quality(F.col("text"), model).alias("s")).collect()}
    right = sum(scores[i] >= 0.5 for i in range(60)) + sum(scores[60 + i] < 0.5 for i in range(60))
    assert right >= 116 and all(0 <= s <= 1 for s in scores.values()) and len(scores) == 124


def test_votes_equal_brute_force(spark):
    good, bad = texts(30)
    model = quality_knn.learn(labelled(spark, good, bad))
    table = quality_knn.terms(*W.buffers(pa.array([*good[:5], *bad[:5], ""])))
    unit = lambda v: v / max(np.linalg.norm(v), 1e-12)
    for row, score in zip(table, quality_knn.vote(table, model)):
        own = unit((row * model.weights) @ model.projection)
        near = sorted(((float(own @ v), float(label)) for v, label in zip(model.vectors, model.labels)), reverse=True)
        weights = [max(c, 0) ** quality_knn.SHARPNESS for c, _ in near[:quality_knn.NEIGHBOURS]]
        wanted = sum(w * label for w, (_, label) in zip(weights, near)) / sum(weights) if sum(weights) else 0.5
        assert abs(score - wanted) < 1e-3


def test_terms_do_not_depend_on_the_batch():
    some = ["a b c a b c", "", "Ab!! Cd!!\nAb!! Cd!!", "é" * 50, "line\nline\nother"]
    whole = quality_knn.terms(*W.buffers(pa.array(some)))
    alone = np.concatenate([quality_knn.terms(*W.buffers(pa.array([t]))) for t in some])
    assert np.allclose(whole, alone)


def test_sample_is_bounded_and_settles_ties(spark, corpus):
    docs = corpus([prose(n, 9) for n in range(50)] + ["again"], ids=[*range(50), 3])
    labels = [(n, n % 2) for n in range(50)] + [(3, 0), (4, 7), (None, 1), (5, None), (77, 1)]
    chosen = quality_knn.sample(docs, spark.createDataFrame(labels, "doc_id long, quality int"), "quality", 10).collect()
    assert len(chosen) <= 20 and len({r["doc_id"] for r in chosen}) == len(chosen)
    assert all(r["label"] == (0 if r["doc_id"] == 3 else r["doc_id"] % 2) for r in chosen)


def test_no_labels_and_no_rows(spark, corpus):
    model = spark.sparkContext.broadcast(quality_knn.learn(labelled(spark, [], [])))
    assert corpus(["some text"]).select(quality_knn.quality(F.col("text"), model)).first()[0] == 0.5
    assert corpus([]).select(quality_knn.quality(F.col("text"), model)).collect() == []
