from __future__ import annotations

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
AWKWARD = [
    None, "", " ", "\n\n", "<|endoftext|> is text", "don't 's 'll", "a" * 5000, " " * 5000 + "a b", "x" + " \n" * 3000,
    "end" + "　" * 1500 + "y", "!\x1c" * 1200 + "\x1c" * 1500 + "!", "naïve 漢字 🙂 é", "word " * 30000, "12 34" * 20000,
]


@pytest.fixture(scope="module")
def plain():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_library_and_decode(spark, corpus, plain):
    draw = random.Random(3)
    texts = AWKWARD + ["".join(draw.choice("ab 1.\n\t'sé  ") for _ in range(70000))]
    ranks = byte_bpe.load_ranks(spark, PATH)
    ids = byte_bpe.encode(F.col("text"), ranks, public_tokenizers.PATTERN)
    rows = corpus(texts + ["twice", "twice"], clashing=True).select("doc_id", "text", ids.alias("own"))
    rows = rows.withColumn("raw", byte_bpe.decode(F.col("own"), ranks, public_tokenizers.PATTERN))
    for row in rows.withColumn("n", byte_bpe.token_count(F.col("own"))).collect():
        wanted = plain.encode_ordinary(row["text"] or "")
        assert np.frombuffer(row["own"], "<u4").tolist() == wanted
        assert row["n"] == len(wanted)
        assert bytes(row["raw"]) == (row["text"] or "").encode()


def test_run_beyond_the_pattern_stack(plain):
    text = " " * 2_000_000 + "abc"
    packed = byte_bpe.encode_text(byte_bpe.encoder(open(PATH, "rb").read(), public_tokenizers.PATTERN), text)
    assert plain.decode_bytes(np.frombuffer(packed, "<u4").tolist()) == text.encode()


def test_bytes_that_are_no_text(spark):
    ranks = byte_bpe.load_ranks(spark, PATH)
    own = byte_bpe.encoder(ranks.value, public_tokenizers.PATTERN)
    half = "é".encode()[:1]
    packed = np.array([own.encode_single_token(half)], "<u4").tobytes()
    frame = spark.createDataFrame([(packed,), (None,)], "ids binary")
    rows = frame.select(byte_bpe.decode(F.col("ids"), ranks, public_tokenizers.PATTERN)).collect()
    assert bytes(rows[0][0]) == half and rows[1][0] is None


def test_empty_table(spark, corpus):
    ranks = byte_bpe.load_ranks(spark, PATH)
    assert corpus([]).select(byte_bpe.encode(F.col("text"), ranks, public_tokenizers.PATTERN)).collect() == []
