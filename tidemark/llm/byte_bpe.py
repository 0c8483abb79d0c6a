"""Byte-level BPE with the tiktoken library, from a local file of ranks.

Texts are cut into matches of a pattern, and each match is merged by rank. Ids travel as packed
little-endian unsigned 32-bit integers, as token files keep them; decoding gives the raw bytes,
which need not be valid UTF-8.

Very long texts are split first, at places where the pattern always starts a new match whatever
stands before: where white space follows another character. Inside a long run of white space the
pattern makes one match of all but the last, which is encoded as one piece; so neither the
backtracking of the pattern nor a text's length grows with what one call holds.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from .common import give_back

#: Characters from which a text is split, and of white space from which a run is encoded by itself.
PART, RUN = 1 << 16, 1 << 10

# White space of Unicode, which the pattern means; Python's own has four control characters more.
_SPACE, _OTHER = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
_BOUNDARY = re.compile(f"(?<={_OTHER})(?={_SPACE})")
_LONG_RUN = re.compile(f"{_SPACE}{{{RUN},}}")
_ENCODERS: dict[str, tiktoken.Encoding] = {}


def load_ranks(spark: SparkSession, path: str) -> Broadcast[bytes]:
    """The rank file, read once by the driver and sent to the executors (a vocabulary has a fixed size)."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encoder(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """Encoder of the ranks; each worker process builds it once."""
    key = hashlib.sha256(ranks + pattern.encode()).hexdigest()
    if key not in _ENCODERS:
        lines = (line.split() for line in ranks.splitlines() if line)
        merges = {base64.b64decode(token): int(rank) for token, rank in lines}
        _ENCODERS[key] = tiktoken.Encoding(key, pat_str=pattern, mergeable_ranks=merges, special_tokens={})
    return _ENCODERS[key]


def parts(text: str, length: int = PART) -> Iterator[tuple[str, bool]]:
    """Parts of a text that can be encoded apart; True marks one that is a single match of white space."""
    done = 0
    for run in _LONG_RUN.finditer(text):
        # All but the last space of the run is one match, unless the text ends with the run.
        last = run.end() if run.end() == len(text) else run.end() - 1
        yield from ((part, False) for part in _split(text[done:run.start()], length))
        yield text[run.start():last], True
        done = last
    yield from ((part, False) for part in _split(text[done:], length))


def _split(text: str, length: int) -> Iterator[str]:
    done = 0
    while len(text) - done > length:
        found = _BOUNDARY.search(text, done + length)
        if found is None:
            break
        yield text[done:found.start()]
        done = found.start()
    if done < len(text):
        yield text[done:]


def encode_text(encoding: tiktoken.Encoding, text: str | None) -> bytes:
    """Packed ids of one text; null is an empty text, and text that looks like a special token is plain text."""
    if not text:
        return b""
    if len(text) <= RUN:
        return encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
    packed = []
    for part, single in parts(text):
        if single:
            packed.append(np.array(encoding._encode_single_piece(part), "<u4").tobytes())
        else:
            packed.append(encoding.encode_to_numpy(part, disallowed_special=()).astype("<u4").tobytes())
    return b"".join(packed)


def encode(text: Column, ranks: Broadcast[bytes], pattern: str) -> Column:
    """Packed ids of each text. Null and empty texts have no ids."""

    @pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        own = encoder(ranks.value, pattern)
        found = pd.Series([encode_text(own, value) for value in texts], dtype=object)
        give_back()
        return found

    return packed(text)


def decode(packed: Column, ranks: Broadcast[bytes], pattern: str) -> Column:
    """Raw bytes of packed ids; null stays null."""

    @pandas_udf("binary")
    def raw(values: pd.Series) -> pd.Series:
        own = encoder(ranks.value, pattern)
        return pd.Series(
            [None if value is None else own.decode_bytes(np.frombuffer(value, "<u4").tolist()) for value in values],
            dtype=object,
        )

    return raw(packed)


def token_count(packed: Column) -> Column:
    return (F.octet_length(packed) / 4).cast("bigint")
