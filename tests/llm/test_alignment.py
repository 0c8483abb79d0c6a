from __future__ import annotations

import hashlib
import os
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment, pair_bpe, queries
from tidemark.llm.common import stored

from .test_queries import DATA, needs_data

os.environ["TOKENIZERS_PARALLELISM"] = "false"
ENTRIES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
AWKWARD = [
    None, "", " ", "a  b", "x▁y", "<|endoftext|> <s> hi", "naïve 漢字 🙂 é", "\x00\x01 t", "word " * 30000,
    "ab cd  ef\n" * 20000, "日本" * 5000, "a" * 3000, "▁", "tail ", "twice", "twice",
]


@pytest.fixture(scope="module")
def own():
    vocabulary = pair_bpe.vocabulary(open(ENTRIES, "rb").read(), public_tokenizers.PATTERN)
    model = alignment.piece_model(open(PIECES, "rb").read())
    return alignment.Aligner(vocabulary, model, alignment.possible_pairs(vocabulary.token, model.token))


@pytest.fixture(scope="module")
def brute():
    """Groups by walking through both libraries' tokens: A count, B count, groups, links."""
    first = Tokenizer.from_file(ENTRIES)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = {letter: byte for byte, letter in enumerate(pair_bpe.byte_letters())}

    def piece(number):
        name = second.id_to_piece(number)
        return bytes([int(name[3:5], 16)]) if second.is_byte(number) else name.replace("▁", " ").encode()

    def walk(text):
        if not text:
            return 0, 0, [], []
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        left = [bytes(letters[c] for c in first.id_to_token(number)) for number in a]
        right = [piece(number) for number in b]
        if not b"".join(left) == b"".join(right) == (" " + text).encode():
            return 0, 0, [], []
        ends_a, ends_b = np.cumsum([len(x) for x in left]).tolist(), np.cumsum([len(x) for x in right]).tolist()
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            k, m = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append((a[i:k], b[j:m]))
            i, j = k, m
        return len(a), len(b), groups, [(x[-1], y[-1]) for x, y in groups]

    return walk


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


@pytest.mark.parametrize("piece", [1 << 16, 1000, 7])
def test_pieces_of_any_size_give_the_same_groups(own, brute, piece):
    draw = random.Random(piece)
    texts = [text or "" for text in AWKWARD if piece == 1 << 16 or len(text or "") < 6000]
    texts += ["".join(draw.choice("ab 1.\n\t'sé  漢") for _ in range(draw.randint(0, 900))) for _ in range(80)]
    out = own.align(texts, piece=piece)
    for place, text in enumerate(texts):
        n_a, n_b, groups, links = brute(text)
        found = [out[name][place].as_py() for name in ("n_a", "n_b", "n_groups", "n_links", "groups")]
        assert found == [n_a, n_b, len(groups), len(links), written(groups)]
        numbers = Counter(int(own.pairs.number(np.array([a]), np.array([b]))[0]) for a, b in links)
        assert dict(zip(out["links"][place].as_py(), out["times"][place].as_py())) == numbers


def test_diagonals_cut_equal_work():
    draw = np.random.default_rng(3)
    a = np.unique(draw.integers(0, 5000, 900))
    b = np.unique(draw.integers(0, 5000, 2000))
    i, j = alignment.diagonal_cuts(a, b, 64)
    assert i[0] == j[0] == 0 and i[-1] == len(a) and j[-1] == len(b)
    assert (np.diff(i + j) <= 65).all() and (np.diff(i) >= 0).all() and (np.diff(j) >= 0).all()
    for x, y in zip(i[1:-1], j[1:-1]):
        # Whatever comes before the cut is less than whatever comes behind it.
        assert max(a[x - 1] if x else -1, b[y - 1] if y else -1) < min(a[x:].min(initial=9999), b[y:].min(initial=9999))


def test_overlaps_cover_all_bytes():
    ends, left, right, both = alignment.overlaps(np.array([2, 5, 6]), np.array([1, 5, 6]))
    assert ends.tolist() == [1, 2, 5, 6] and left.tolist() == [0, 0, 1, 2] and right.tolist() == [0, 1, 1, 2]
    assert both.tolist() == [False, False, True, True]


def checked(rows, texts, brute):
    cut = {key: brute(text) for key, text in texts}
    count = Counter(link for n, (key, _) in enumerate(texts) for link in cut[key][3])
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    assert sorted(r["doc_id"] for r in rows) == sorted(key for key, _ in texts)
    for row in rows:
        n_a, n_b, groups, links = cut[row["doc_id"]]
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"]) == (n_a, n_b, len(groups), len(links))
        assert row["n_best"] == sum(count[link] == best[link[1]] for link in links)
        assert row["count_sum"] == sum(count[link] for link in links)
        assert row["groups_sha256"] == (hashlib.sha256(written(groups).encode()).hexdigest() if n_a else "")


def test_counts_are_those_of_all_documents(spark, corpus, brute):
    tokenizers = alignment.load(spark, ENTRIES, public_tokenizers.PATTERN, PIECES)
    docs = corpus(AWKWARD, clashing=True).repartition(5)
    rows = alignment.alignment_digests(docs, tokenizers).collect()
    checked(rows, list(enumerate(AWKWARD)), brute)


def test_no_documents(spark, corpus):
    tokenizers = alignment.load(spark, ENTRIES, public_tokenizers.PATTERN, PIECES)
    assert alignment.alignment_digests(corpus([]), tokenizers).collect() == []
    assert alignment.align(stored(corpus([None, ""])), tokenizers).select("n_links", "groups").collect() == [(0, ""), (0, "")]


@needs_data
def test_registered_query(spark, corpus, brute):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    checked(queries.QUERIES["op11_alignment"](spark, str(DATA)).collect(), texts, brute)
