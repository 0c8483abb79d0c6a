from __future__ import annotations

import hashlib
import json
import os
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import pair_bpe, queries

from .test_queries import DATA, needs_data

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PATH = public_tokenizers.path("byte_bpe_50k.json")
AWKWARD = [
    None, "", " ", "\n\n", "<|endoftext|> is text<|endoftext|>", "a  <|endoftext|>  b", "<|endoftext", "don't 's 'll 'S",
    "a" * 5001, " " * 5000 + "a b", "x" + " \n" * 3000, "end" + "　" * 1500 + "y", "!\x1c" * 1200 + "\x1c" * 1500 + "!",
    "naïve 漢字 🙂 é", "word " * 30000, "12 34" * 20000, "-" * 777, "twice", "twice",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return pair_bpe.vocabulary(open(PATH, "rb").read(), public_tokenizers.PATTERN)


def test_ids_and_text_equal_the_library(spark, corpus, library):
    draw = random.Random(4)
    texts = AWKWARD + ["".join(draw.choice("ab 1.\n\t'sé  <|") for _ in range(draw.randint(0, 2000))) for _ in range(60)]
    content = pair_bpe.load_vocabulary(spark, PATH)
    rows = pair_bpe.encode(corpus(texts, clashing=True), content, public_tokenizers.PATTERN)
    assert rows.columns[-1] == "ids_"  # the documents have a column of that name
    rows = rows.withColumn("back", pair_bpe.decode(F.col("ids_"), content, public_tokenizers.PATTERN))
    found = rows.collect()
    assert len(found) == len(texts)
    for row in found:
        wanted = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids_"] == wanted
        assert row["back"] == library.decode(wanted, skip_special_tokens=False)


def test_any_ids_decode_as_in_the_library(own, library):
    draw = random.Random(8)
    for _ in range(200):
        ids = [draw.randrange(own.size) for _ in range(20)]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_added_tokens_can_be_plain_text(own):
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    text = "a <|endoftext|> b"
    assert own.encode([text], special=False)[0].tolist() == plain.encode(text, add_special_tokens=False).ids


def test_positions_of_a_batch_merge_like_single_words(own):
    draw = random.Random(1)
    words = ["".join(draw.choice("aab") for _ in range(draw.randint(0, 30))) for _ in range(300)] + ["é" * 9, ""]
    ids, bounds = own.merge(words)
    for place, word in enumerate(words):
        assert ids[bounds[place]:bounds[place + 1]].tolist() == one_by_one(own, word)


def one_by_one(own, word):
    rank = {(a, b): (n, c) for n, (a, b, c) in enumerate(zip(own.left.tolist(), own.right.tolist(), own.made.tolist()))}
    ids = [own.symbol[byte].item() for byte in word.encode()]
    while True:
        found = [(rank[pair], place) for place, pair in enumerate(zip(ids, ids[1:])) if pair in rank]
        if not found:
            return ids
        (_, made), place = min(found)
        ids[place:place + 2] = [made]


def test_odd_vocabularies_are_refused():
    whole = json.load(open(PATH))
    whole["model"]["merges"] = [["he", "r"], ["h", "e"]]
    with pytest.raises(ValueError):
        pair_bpe.Vocabulary(json.dumps(whole).encode(), public_tokenizers.PATTERN)
    whole["model"].update(merges=[], dropout=0.1)
    with pytest.raises(ValueError):
        pair_bpe.Vocabulary(json.dumps(whole).encode(), public_tokenizers.PATTERN)


def test_empty_table(spark, corpus):
    content = pair_bpe.load_vocabulary(spark, PATH)
    assert pair_bpe.encode(corpus([]), content, public_tokenizers.PATTERN).collect() == []


@needs_data
def test_registered_query(spark, corpus, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = queries.QUERIES["op12_pair_bpe"](spark, str(DATA)).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
