"""Spelling variants by composing an acceptor of the words with a one-edit transducer and the acceptor again.

The composition accepts exactly the pairs of words that differ by one inserted, deleted or replaced code
point. A state of it is a state of the acceptor on either side and one of the transducer, which has not
edited yet or has. Up to the edit both sides read the same letters, so the composition is divided by where
it starts: words that share their first half are one partition, entered at the state behind that half.
Pairs that are edited in the first half share the second one, so they come from partitions of the reversed
words. A pair whose longer word has L code points shares at least L // 2 of them in a row with its other
word, at one end; so each word enters four partitions, first and last L // 2 code points for L its length
and its length plus one, and a partition yields only pairs of its own L.

In a partition the rests of the words, which come sorted, make a minimised acceptor. States with the same
continuations are one, so what the transducer can edit at a state is found once, as an intersection of
two states' languages, and given out for each path to that state. The edit is taken at the first
difference, so no pair comes twice. A partition with more words than a task should hold is dealt into
blocks, and each two blocks are composed by themselves.

A word's form is its most frequent near word if that is at least twice as frequent; forms are followed to
their roots by doubling, in as many joins as the logarithm of the longest chain.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import released, small, stored

# Letters of a run, and the ones that are put in lower case.
LETTERS = "[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Least code points and occurrences of a word, and how often a form must be as frequent as the word.
LENGTH, TIMES, RATIO = 5, 3, 2
#: Divisor of the hash by which an occurrence loses a letter.
DIVISOR = 97
#: Words of a partition beyond which it is dealt into blocks.
BLOCK = 4096

#: A chain of letters.
Rest = tuple | None

_GROUP = ("way", "longest", "half", "tile_a", "tile_b")


class Acceptor:
    """Minimised acceptor of sorted distinct words; state 0 is the first one."""

    def __init__(self, words: Sequence[str]) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [False]
        known: dict[tuple, int] = {}
        open_: list[tuple[int, str, int]] = []
        last = ""
        for word in words:
            shared = 0
            for one, two in zip(word, last):
                if one != two:
                    break
                shared += 1
            self._close(open_, shared, known)
            state = open_[-1][2] if open_ else 0
            for letter in word[shared:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[state][letter] = len(self.arcs) - 1
                open_.append((state, letter, len(self.arcs) - 1))
                state = len(self.arcs) - 1
            self.final[state] = True
            last = word
        self._close(open_, 0, known)

    def _close(self, open_: list[tuple[int, str, int]], left: int, known: dict[tuple, int]) -> None:
        """States beyond the shared letters get no more arcs: each becomes the known one that goes on alike."""
        while len(open_) > left:
            parent, letter, state = open_.pop()
            same = known.setdefault((self.final[state], *self.arcs[state].items()), state)
            if same != state:
                self.arcs[parent][letter] = same


class Composition:
    """The acceptor, one edit, and the acceptor again.

    Rests are chains (letter, rest) that end in None, shared by all longer ones, so that memory grows with
    the acceptor also where words are very long.
    """

    def __init__(self, acceptor: Acceptor) -> None:
        self.own = acceptor
        self.common: dict[tuple[int, int], list[Rest]] = {}
        self.edits: dict[int, list[tuple[Rest, Rest]]] = {}

    def after(self, one: int, two: int) -> list[Rest]:
        """What both states accept: the way on behind the edit."""
        arcs, final = self.own.arcs, self.own.final
        todo = [(one, two) if one < two else (two, one)]
        while todo:
            key = todo[-1]
            here, there = arcs[key[0]], arcs[key[1]]
            ways = [(letter, here[letter], there[letter]) for letter in here if letter in there]
            ways = [(letter, (x, y) if x < y else (y, x)) for letter, x, y in ways]
            missing = [way for _, way in ways if way not in self.common]
            if missing:
                todo += missing
                continue
            found: list[Rest] = [None] if final[key[0]] and final[key[1]] else []
            for letter, way in ways:
                found += [(letter, rest) for rest in self.common[way]]
            self.common[key] = found
            todo.pop()
        return found

    def edited(self, state: int) -> list[tuple[Rest, Rest]]:
        """Pairs of rests, the longer one first, that the edit right at this state makes."""
        if state not in self.edits:
            arcs, pairs = list(self.own.arcs[state].items()), []
            for place, (letter, target) in enumerate(arcs):
                for other, goal in arcs[place + 1:]:
                    pairs += [((letter, rest), (other, rest)) for rest in self.after(target, goal)]
                # Left out on one side; the next letter of the other is another one, or the pair would differ later.
                if self.own.final[target] and self.own.final[state]:
                    pairs.append(((letter, None), None))
                for other, goal in arcs:
                    following = self.own.arcs[target].get(other) if other != letter else None
                    if following is not None:
                        pairs += [((letter, (other, rest)), (other, rest)) for rest in self.after(following, goal)]
            self.edits[state] = pairs
        return self.edits[state]

    def pairs(self) -> Iterator[tuple[str, str]]:
        """All accepted pairs, each once, the longer word first."""
        paths: list[tuple[tuple | None, int]] = [(None, 0)]
        while paths:
            path, state = paths.pop()
            pairs = self.edited(state)
            if pairs:
                start, back = [], path
                while back is not None:
                    back, letter = back
                    start.append(letter)
                read = "".join(reversed(start))
                for one, two in pairs:
                    yield read + _letters(one), read + _letters(two)
            paths += [((path, letter), target) for letter, target in self.own.arcs[state].items()]


def _letters(rest: Rest) -> str:
    letters = []
    while rest is not None:
        letter, rest = rest
        letters.append(letter)
    return "".join(letters)


def near_pairs(words: Sequence[str]) -> Iterator[tuple[str, str]]:
    """Pairs of sorted distinct words that are one edit apart."""
    return Composition(Acceptor(words)).pairs()


def runs(docs: DataFrame) -> DataFrame:
    """Runs of letters of all texts (doc_id, run), one row each; null texts have none."""
    text = F.translate("text", UPPER, LOWER)
    return docs.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("run"))


def spelt(doc_id: Column, run: Column, divisor: int = DIVISOR) -> Column:
    """The run, without one letter where the hash of document and run (a null id is empty) says so."""
    mark = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    place = (mark % F.char_length(run)).cast("int")
    cut = F.concat(F.substr(run, F.lit(1), place), F.substr(run, place + 2))
    return F.when(mark % divisor == 0, cut).otherwise(run)


def vocabulary(words: DataFrame, length: int = LENGTH, times: int = TIMES) -> DataFrame:
    """Words (word), one row for each occurrence, to stored distinct ones with their number: word, n."""
    counts = words.where(F.char_length("word") >= length).groupBy("word").agg(F.count("*").alias("n"))
    return stored(counts.where(F.col("n") >= times))


def _partitions(words: DataFrame) -> DataFrame:
    """Each word in its four partitions: way, longest (L), half, rest, n."""
    size = F.char_length("word")
    starts = []
    for longest in (size, size + 1):
        half = (longest / 2).cast("int")
        starts.append(F.struct(
            F.lit(0).alias("way"), longest.alias("longest"), F.substr("word", F.lit(1), half).alias("half"),
            F.substr("word", half + 1).alias("rest"),
        ))
        starts.append(F.struct(
            F.lit(1).alias("way"), longest.alias("longest"), F.substr("word", size - half + 1).alias("half"),
            F.reverse(F.substr("word", F.lit(1), size - half)).alias("rest"),
        ))
    return words.select(F.inline(F.array(*starts)), "n")


def _tiled(rows: DataFrame, most: int) -> DataFrame:
    """Partitions beyond the limit as pairs of blocks (tile_a, tile_b); each row has its own block."""
    key = ["way", "longest", "half"]
    large = rows.groupBy(*key).agg(F.count("*").alias("words")).where(F.col("words") > most)
    large = small(stored(large.select(*key, F.ceil(F.col("words") / most).cast("int").alias("blocks"))))
    rows = rows.join(large, key, "left")
    block = F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("rest"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("block", block)
    others = F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)
    rows = rows.select(*key, "rest", "n", "block", F.explode(others).alias("other"))
    return rows.select(
        *key, F.least("block", "other").alias("tile_a"), F.greatest("block", "other").alias("tile_b"), "rest", "n", "block"
    )


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the partitions, which come one after the other with their rests in order, both ways round."""
    group, rests, counts, block = None, [], [], []
    words, nears, numbers = [], [], []

    def finish() -> None:
        if len(rests) < 2:
            return
        way, longest, half, tile_a, tile_b = group
        number, own = dict(zip(rests, counts)), dict(zip(rests, block)) if tile_a != tile_b else {}
        shared = longest // 2
        for one, two in near_pairs(rests):
            # Other lengths come in their own partition, and pairs inside a block in that block's.
            if len(one) + shared != longest or (own and own[one] == own[two]):
                continue
            if way:
                first, second = one[::-1] + half, two[::-1] + half
                if first[:shared] == second[:shared]:
                    continue  # Both halves are the same: the other way has this pair.
            else:
                first, second = half + one, half + two
            words.extend((first, second))
            nears.extend((second, first))
            numbers.extend((number[two], number[one]))

    def taken() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array(nears, pa.string()), pa.array(numbers, pa.int64())],
            names=["word", "near", "near_n"],
        )
        words.clear(), nears.clear(), numbers.clear()
        return out

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in (*_GROUP, "rest", "n", "block")]
        for *key, rest, n, own in zip(*columns):
            if key != group:
                finish()
                group, rests, counts, block = key, [], [], []
                if len(words) > 1 << 16:
                    yield taken()
            rests.append(rest)
            counts.append(n)
            block.append(own)
    finish()
    yield taken()


def near_words(words: DataFrame, most: int = BLOCK) -> DataFrame:
    """Distinct words (word, n) to their near words: word, near, near_n, both ways round."""
    rows = _tiled(_partitions(words), most)
    ordered = rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "rest")
    return ordered.mapInArrow(released(_composed), "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """Words with their form (word, form; forms never go in a circle) to stored (word, root)."""
    known = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        further = known.select(F.col("word").alias("via"), F.col("root").alias("next"))
        step = stored(known.join(further, F.col("root") == F.col("via"), "left"))
        known = step.select("word", F.coalesce("next", "root").alias("root"))
        if step.where("next is not null").isEmpty():
            return known


def grouped(words: DataFrame, ratio: int = RATIO, most: int = BLOCK) -> DataFrame:
    """Stored words (word, n) to word, form, root, n, n_near, form_n.

    Of near words the most frequent one counts, of equals the first in code-point order; it is the form if
    it is at least ``ratio`` times as frequent, else form and form_n are null and the word is its own root.
    """
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    found = near_words(words, most).groupBy("word").agg(F.count("*").alias("n_near"), best)
    rows = words.join(found, "word", "left")
    formed = -F.col("best.less") >= ratio * F.col("n")
    rows = stored(rows.select(
        "word", F.when(formed, F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(formed, -F.col("best.less")).alias("form_n"),
    ))
    last = roots(rows.where("form is not null")).withColumnRenamed("word", "of")
    return rows.join(last, F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) to their words, grouped by spelling.

    Words are runs of letters in lower case (some occurrences lose a letter by a hash, see ``spelt``) of at
    least five code points and three occurrences. Null and empty texts have none, repeated rows count, other
    columns have no part.
    """
    words = runs(docs.select("doc_id", "text")).select(spelt(F.col("doc_id"), F.col("run")).alias("word"))
    return grouped(vocabulary(words))
