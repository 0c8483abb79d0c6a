from __future__ import annotations

import random
import re

import pytest

from tidemark.llm.common import batched

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Names that the operators use themselves.
CLASHING = ("row", "_row", "class", "size", "score", "_score", "kept", "taken", "ids", "text_key", "node", "_gone", "first", "_first")


def words(text):
    return WORD.findall(text or "")


def prose(seed, count):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(count))


@pytest.fixture(scope="session")
def corpus(spark):
    """Builds documents from texts, with clashing columns on demand."""
    batched(spark)

    def build(texts, ids=None, sources=None, clashing=False):
        ids = list(range(len(texts))) if ids is None else ids
        sources = ["s"] * len(texts) if sources is None else sources
        rows = [(i, t, None, s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources)]
        kinds = "doc_id long, text string, lang string, source string, n_chars long"
        if clashing:
            rows = [(*row, *["x"] * len(CLASHING)) for row in rows]
            kinds += "".join(f", {name} string" for name in CLASHING)
        return spark.createDataFrame(rows, kinds)

    return build
