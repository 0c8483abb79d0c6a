"""The registered corpus queries against their SQL, and the pipeline against its rules."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import mixing, queries
from tidemark.llm.common import stored

from .conftest import prose, words
from .test_near_dedup import classes

DATA = Path("/root/testdata/sf0.001")
TABLES = "documents embeddings pages labels".split()

needs_data = pytest.mark.skipif(not DATA.exists(), reason="test data are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


@needs_data
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, corpus, duck, name):
    frame = queries.QUERIES[name](spark, str(DATA))
    columns = sorted(frame.columns)
    result = duck.execute(queries.ORACLES[name])
    names = [item[0] for item in result.description]
    assert sorted(names) == columns
    wanted = [tuple(dict(zip(names, row))[c] for c in columns) for row in result.fetchall()]
    assert sorted(map(repr, (tuple(row[c] for c in columns) for row in frame.collect()))) == sorted(map(repr, wanted))


@needs_data
@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES) - {"op13_spelling"}))
def test_other_queries_have_a_row_for_each(spark, corpus, name):
    table = "pages" if name.startswith("op5") else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    rows = queries.QUERIES[name](spark, str(DATA)).select(key).collect()
    assert sorted(r[0] for r in rows) == sorted(r[0] for r in spark.read.parquet(f"{DATA}/{table}.parquet").select(key).collect())


@needs_data
def test_there_is_a_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark, corpus, folder):
    base = prose(1, 120)
    texts = [base, base + " more", prose(2, 80), prose(3, 70) + " you idiot moron scum trash", prose(4, 20), None, "", "a b c " * 60]
    texts += [prose(n, 60 + n) for n in range(10, 30)]
    corpus(texts, sources=["a", "b"] * (len(texts) // 2), clashing=True).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(3, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, folder))
        if stage is corpus_pipeline.mix:
            before_mix, mixed_texts = docs, [(r["doc_id"], r["text"]) for r in out.collect()]
        seen.append(sorted({r["doc_id"] for r in out.collect()}))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            docs = out
    every = set(range(len(texts)))
    assert set(seen[0]) == every - {3}
    assert set(seen[1]) == {i for i in seen[0] if len(words(texts[i])) >= 50 and i != 7}
    left = seen[1]
    roots = classes([texts[i] for i in left])
    assert seen[2] == [left[i] for i in sorted(set(roots))]
    assert seen[3] == seen[4] and set(seen[3]) <= set(seen[2])
    # The mix takes texts whole, with their white space, but for the two at the ends of a run.
    cut = Counter(texts[i] == text for i, text in mixed_texts)
    assert all(text in texts[i] for i, text in mixed_texts) and cut[False] <= 2 * 2
    planned = {r["doc_id"]: r["taken"] for r in mixing.plan(stored(before_mix.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "source", mixing.size(F.col("text")).alias("size"),
        F.xxhash64("text").alias("mark"),
    ))).collect()}
    own, wanted = Counter(), Counter({key: n for key, n in planned.items() if n})
    for i, text in mixed_texts:
        own[i] += len(words(text))
    assert own == wanted
    for row in out.collect():
        assert row["round_trip"] and row["n_tokens"] == len(np.frombuffer(row["ids"], "<u4")) > 0
    whole = corpus_pipeline.run(spark, folder)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in whole.collect()) == sorted((r["doc_id"], r["n_tokens"]) for r in out.collect())


def test_pipeline_over_nothing(spark, corpus, folder):
    corpus([]).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []
