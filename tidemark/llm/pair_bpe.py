"""Byte-level BPE by an index from each pair to its positions, from a local vocabulary file.

A vocabulary file (JSON) has entries spelt in the letters of byte-level BPE, merges in the order of
their ranks, and added tokens. A batch of a Spark partition is encoded at once: its texts are cut into
matches of the pattern, distinct matches are laid end to end as symbols, and an index maps each rank to
all positions of its pair. The least active rank is applied at all its positions; each merge takes its
right symbol out of the chain and enters the two new pairs that it makes, and entries of pairs that are
gone are passed over when their rank comes. As no merge makes a pair of a lower rank (checked when the
file is read), this gives every match the merges that it would have alone.

Texts that look like added tokens become those tokens, or stay plain text on demand. Null and empty
texts have no ids. A long text is cut where the pattern starts a new match whatever stands before.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import pandas_udf

from .byte_bpe import RUN, parts
from .common import fresh_name, released

#: Settings of a vocabulary that this encoder follows, all others are refused.
_PLAIN_MODEL = {
    "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
    "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False,
}
#: Text (in bytes) of which one index is made.
INDEX_BYTES = 4 << 20

_VOCABULARIES: dict[bytes, "Vocabulary"] = {}


def byte_letters() -> list[str]:
    """Letter of each byte: printable bytes of Latin-1 stand for themselves, the others follow from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [byte for byte in range(256) if byte not in shown]
    return [chr(byte) if byte in shown else chr(256 + hidden.index(byte)) for byte in range(256)]


class Vocabulary:
    """Entries, merges and added tokens of a vocabulary file, with the pattern that cuts texts."""

    def __init__(self, content: bytes, pattern: str) -> None:
        whole = json.loads(content)
        model, cut = whole["model"], whole["pre_tokenizer"]
        odd = [name for name, value in _PLAIN_MODEL.items() if model.get(name, value) != value]
        if odd or whole.get("normalizer") or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space"):
            raise ValueError(f"not a plain byte-level vocabulary: {', '.join(odd) or 'normalizer or pre-tokenizer'}")
        self.pattern = regex.compile(pattern)
        letters = {letter: byte for byte, letter in enumerate(byte_letters())}
        ids = model["vocab"]
        self.size = 1 + max([*ids.values(), *(item["id"] for item in whole["added_tokens"])])
        #: Bytes of each id.
        self.token = [b""] * self.size
        for entry, number in ids.items():
            self.token[number] = bytes(letters[letter] for letter in entry)
        self.added: dict[str, int] = {}
        for item in whole["added_tokens"]:
            if any(item.get(name) for name in ("single_word", "lstrip", "rstrip")):
                raise ValueError(f"added token with white space rules: {item['content']}")
            self.added[item["content"]] = item["id"]
            self.token[item["id"]] = item["content"].encode()
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, longest_first))) if longest_first else None
        self.symbol = np.array([ids[letter] for letter in byte_letters()], np.int64)
        merges = [item.split(" ") if isinstance(item, str) else item for item in model["merges"]]
        self.left = np.array([ids[a] for a, _ in merges], np.int64)
        self.right = np.array([ids[b] for _, b in merges], np.int64)
        self.made = np.array([ids[a + b] for a, b in merges], np.int64)
        born = np.full(self.size, -1)
        born[self.made] = np.arange(len(merges))
        if (np.maximum(born[self.left], born[self.right]) >= np.arange(len(merges))).any():
            raise ValueError("a merge comes before one that it builds on")
        keys = self.left * self.size + self.right
        self.ranks = np.argsort(keys, kind="stable")
        self.keys = keys[self.ranks]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 where it has none."""
        if not len(self.keys):
            return np.full(len(left), -1)
        key = left.astype(np.int64) * self.size + right
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[place] == key, self.ranks[place], -1)

    def matches(self, text: str, special: bool) -> Iterator[list[str] | int]:
        """Matches of the pattern in a text, and between them ids of added tokens."""
        done = 0
        if special and self.special is not None:
            for found in self.special.finditer(text):
                yield from self._cut(text[done:found.start()])
                yield self.added[found.group()]
                done = found.end()
        yield from self._cut(text[done:] if done else text)

    def _cut(self, text: str) -> Iterator[list[str]]:
        if len(text) <= RUN:
            yield self.pattern.findall(text)
        else:
            for part, single in parts(text):
                yield [part] if single else self.pattern.findall(part)

    def encode(self, texts: Iterable[str | None], special: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts end to end, and the bounds of each text."""
        # Distinct matches by number; an added token is a match of its own, by its negative id.
        numbers: defaultdict[str | int, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        chain, sizes = [], [0]
        for text in texts:
            found = 0
            for piece in self.matches(text or "", special):
                own = [numbers[piece]] if isinstance(piece, int) else list(map(numbers.__getitem__, piece))
                chain.append(np.array(own, np.int64))
                found += len(own)
            sizes.append(found)
        words = np.concatenate(chain) if chain else np.empty(0, np.int64)
        ids, bounds = self.merge(list(numbers))
        lengths = np.diff(bounds)[words]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        place = np.arange(ends[-1]) - np.repeat(ends[:-1] - bounds[words], lengths)
        return ids[place].astype(np.int32), ends[np.cumsum(sizes)]

    def merge(self, words: Sequence[str | int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words end to end and the bounds of each word, by the index of pairs."""
        raw = [word.encode() if isinstance(word, str) else b"\0" for word in words]
        bounds = np.concatenate([[0], np.cumsum([len(item) for item in raw], dtype=np.int64)])
        # Narrow numbers, as positions are looked up out of order.
        symbol = self.symbol[np.frombuffer(b"".join(raw), np.uint8)].astype(np.int32)
        for place, word in enumerate(words):
            if not isinstance(word, str):
                symbol[bounds[place]] = word
        count = len(symbol)
        after = np.arange(1, count + 1, dtype=np.int32)
        before = np.arange(-1, count - 1, dtype=np.int32)
        filled = np.diff(bounds) > 0
        after[bounds[1:][filled] - 1] = -1
        before[bounds[:-1][filled]] = -1
        index: defaultdict[int, list[int]] = defaultdict(list)
        pairs = np.flatnonzero(after >= 0)
        ranks = self.rank(symbol[pairs], symbol[pairs + 1])
        pairs, ranks = pairs[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        pairs, ranks = pairs[order], ranks[order]
        firsts = np.flatnonzero(np.diff(ranks, prepend=-1))
        for rank, own in zip(ranks[firsts].tolist(), np.split(pairs, firsts[1:])):
            index[rank] = own.tolist()
        active = list(index)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            at = np.sort(np.array(index.pop(rank), np.int64))
            at = at[np.diff(at, prepend=-1) > 0]
            left, right = self.left[rank], self.right[rank]
            # Positions whose pair is gone since it was entered are passed over.
            at = at[(symbol[at] == left) & (after[at] >= 0)]
            at = at[symbol[after[at]] == right]
            if left == right and len(at) > 1:
                at = at[_alternate(after[at[:-1]] == at[1:])]
            if not len(at):
                continue
            gone = after[at]
            following = after[gone]
            symbol[at] = self.made[rank]
            symbol[gone] = -1
            after[at] = following
            inner = following >= 0
            before[following[inner]] = at[inner]
            fresh = np.concatenate([at[inner], before[at][before[at] >= 0]])
            new = self.rank(symbol[fresh], symbol[after[fresh]])
            fresh, new = fresh[new >= 0], new[new >= 0]
            for own, place in zip(new.tolist(), fresh.tolist()):
                if own not in index:
                    heapq.heappush(active, own)
                index[own].append(place)
        live = np.flatnonzero(symbol >= 0)
        return symbol[live], np.searchsorted(live, bounds)

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids; bytes that are no text become replacement characters."""
        return b"".join(map(self.token.__getitem__, ids)).decode("utf-8", "replace")


def _alternate(joined: np.ndarray) -> np.ndarray:
    """First, third, fifth ... of each run; ``joined`` tells whether a place goes on in the next one."""
    place = np.arange(len(joined) + 1)
    first = np.maximum.accumulate(np.where(np.concatenate([[True], ~joined]), place, 0))
    return (place - first) % 2 == 0


def load_vocabulary(spark: SparkSession, path: str) -> Broadcast[bytes]:
    """The vocabulary file, read once by the driver and sent to the executors (it has a fixed size)."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def vocabulary(content: bytes, pattern: str) -> Vocabulary:
    """Vocabulary of a file; each worker process builds it once."""
    key = hashlib.sha256(content + pattern.encode()).digest()
    if key not in _VOCABULARIES:
        _VOCABULARIES[key] = Vocabulary(content, pattern)
    return _VOCABULARIES[key]


def blocks(texts: Sequence[str | None], most: int = INDEX_BYTES) -> Iterator[slice]:
    """Runs of texts of about so many characters; a longer text is a block of its own."""
    first, size = 0, 0
    for place, text in enumerate(texts):
        length = len(text or "")
        if size and size + length > most:
            yield slice(first, place)
            first, size = place, 0
        size += length
    if first < len(texts):
        yield slice(first, len(texts))


def encode(
    docs: DataFrame, content: Broadcast[bytes], pattern: str, text: str = "text", ids: str = "ids", special: bool = True
) -> DataFrame:
    """The rows with an array of token ids of a text column, in a new column (renamed if the name is taken).

    With ``special`` the strings of added tokens become these tokens, else they are plain text. Null and
    empty texts have an empty array. Repeated rows stay.
    """
    name = fresh_name(docs, ids)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))])
    place = docs.columns.index(text)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(content.value, pattern)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for block in blocks(texts):
                values, bounds = own.encode(texts[block], special)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))
                rows = batch.slice(block.start, block.stop - block.start)
                yield pa.RecordBatch.from_arrays([*rows.columns, lists], names=[*rows.schema.names, name])

    return docs.mapInArrow(released(encoded), schema)


def decode(ids: Column, content: Broadcast[bytes], pattern: str) -> Column:
    """Text of an array of ids; null stays null. Added tokens are written out."""

    @pandas_udf("string")
    def decoded(values: pd.Series) -> pd.Series:
        own = vocabulary(content.value, pattern)
        return pd.Series([None if value is None else own.decode(value.tolist()) for value in values], dtype=object)

    return decoded(ids)


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
