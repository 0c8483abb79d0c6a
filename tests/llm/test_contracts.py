"""Every column of the registered queries against plain work over the same tables."""

from __future__ import annotations

import base64
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidemark.llm import log_bilinear, queries

from .conftest import LOWER, words
from .test_mixing import targets
from .test_queries import DATA, needs_data

pytestmark = needs_data


def rows_of(spark, name, folder=DATA):
    return queries.QUERIES[name](spark, str(folder)).collect()


def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").collect()


def remainder(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def test_op2(spark, corpus):
    lines = open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r["doc_id"]: tuple(r) for r in rows_of(spark, "op2_byte_bpe").copy()}
    wanted = {}
    for doc in documents(spark):
        ids = plain.encode_ordinary(doc["text"] or "")
        raw = np.array(ids, "<u4").tobytes()
        text = hashlib.sha256((doc["text"] or "").encode()).hexdigest()
        wanted[doc["doc_id"]] = (doc["doc_id"], len(ids), hashlib.sha256(raw).hexdigest(), text)
    assert found == wanted


def test_op5_with_repeated_pages(spark, corpus, folder):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    more = pages.where("page_id < 20").select((F.col("page_id") + 5000).alias("page_id"), "url", "html")
    short = spark.createDataFrame(
        [(9000 + n, f"http://x.test/{n}", text) for n, text in enumerate(["", None, "short", "short", "", "y" * 99, "y" * 99, "z" * 100, "z" * 100])],
        "page_id long, url string, html string",
    )
    every = pages.select("page_id", "url", "html").unionByName(more).unionByName(short)
    every.repartition(3).write.parquet(f"{folder}/pages.parquet")
    held = {r["page_id"]: (r["html"] or "").encode() for r in every.collect()}
    first = {}
    for page_id in sorted(held):
        first.setdefault(held[page_id], page_id)
    found = {
        r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
        for r in rows_of(spark, "op5_warc", folder)
    }
    wanted = {}
    for page_id, raw in held.items():
        again = len(raw) >= 100 and first[raw] != page_id
        wanted[page_id] = (
            len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[raw] if again else None,
        )
    assert found == wanted and sum(kind == "revisit" for _, _, kind, _ in found.values()) == 21


def test_op6(spark, corpus):
    docs = documents(spark)
    size = {d["doc_id"]: len(words(d["text"])) for d in docs}
    of = {d["doc_id"]: d["source"] for d in docs}
    sizes, taken = defaultdict(int), Counter()
    for key, n in size.items():
        sizes[of[key]] += n
    wanted = targets(sizes)
    found = rows_of(spark, "op6_mixing")
    assert sorted(r["doc_id"] for r in found) == sorted(size)
    for row in found:
        source = of[row["doc_id"]]
        assert (row["size"], row["source_size"]) == (size[row["doc_id"]], sizes[source])
        assert row["target"] == pytest.approx(wanted[source]) and 0 <= row["taken"] <= 3 * row["size"]
        taken[source] += row["taken"]
    assert all(abs(taken[s] - wanted[s]) <= 64 for s in sizes)
    again = rows_of(spark, "op6_mixing")
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in found)


@pytest.mark.parametrize("name, label, bar", [("op7_quality_knn", "quality", 0.5), ("op8_toxicity", "toxic", 0.7)])
def test_op7_and_op8_learn_from_their_rows_only(spark, corpus, folder, name, label, bar):
    spark.read.parquet(f"{DATA}/documents.parquet").withColumns({
        "lang": F.lit("xx"), "source": F.lit("yy"),
    }).write.parquet(f"{folder}/documents.parquet")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    labels.withColumn(label, F.when(out, 1 - F.col(label)).otherwise(F.col(label))).write.parquet(f"{folder}/labels.parquet")
    found = {r["doc_id"]: r for r in rows_of(spark, name)}
    turned = {r["doc_id"]: r["score"] for r in rows_of(spark, name, folder)}
    assert sorted(found) == sorted(turned) == sorted(d["doc_id"] for d in documents(spark))
    for key, row in found.items():
        assert row["held_out"] == (remainder(key, 3) == 1)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= bar)
        assert turned[key] == pytest.approx(row["score"], abs=1e-6)


def test_op10(spark, corpus, monkeypatch):
    monkeypatch.setattr(log_bilinear, "STEPS", 40)
    docs = {d["doc_id"]: d["text"] or "" for d in documents(spark)}
    own = {key: [*words(text.translate(LOWER)), None] for key, text in docs.items()}
    count = Counter(t for key, tokens in own.items() if remainder(key, 10) for t in tokens)
    total, distinct = sum(count.values()), len(count)
    found = rows_of(spark, "op10_log_bilinear")
    assert sorted(r["doc_id"] for r in found) == sorted(docs)
    learning = spark.read.parquet(f"{DATA}/documents.parquet").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0)
    model, _ = log_bilinear.learn(learning)
    for row in found:
        tokens = own[row["doc_id"]]
        base = sum(math.log10((count[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        assert row["held_out"] == (remainder(row["doc_id"], 10) == 0)
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(tokens), sum(count[t] > 0 for t in tokens), total)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        assert row["score"] == pytest.approx(score_by_hand(model, count, docs[row["doc_id"]]), rel=1e-4)


def score_by_hand(model, count, text):
    """Word by word: the unit after the two before it, and a word's share of its class."""
    import pyarrow as pa

    total, far, near = 0.0, 0, 0
    for word in words(text.translate(LOWER)):
        hashes, classes, _ = log_bilinear._tokens(pa.array([word]))
        unit = int(log_bilinear._units(hashes, classes, model.unit_words)[0])
        total += float(model.table[far * log_bilinear.UNITS + near, unit])
        if unit > log_bilinear.WORDS:
            total += math.log10(count[word] + log_bilinear.ALPHA) - float(model.class_logs[classes[0]])
        far, near = near, unit
    return total + float(model.table[far * log_bilinear.UNITS + near, 0])
