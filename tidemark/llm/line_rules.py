"""Quality rules of documents: sizes and repetition inside a text, and lines that many documents share.

Everything is built-in functions of arrays and strings. Words are runs of characters other than
ASCII white space. A text is read once: its counts and the hashes of its lines are stored, and the
frequency of lines is found on these alone.

Lines are normalised (ASCII lower case, white space collapsed) and hashed together with the host of
their document. A line is common if it stands in more distinct texts of the host than both limits
allow; exact copies of a text are one text. Common lines are taken out, and a document that loses
most of its words, or keeps very few, is rejected. Lines of many words can be judged by the number of
texts alone (``long_line``), for no share is natural for a whole passage; the text of the least doc_id
(null last) then keeps it, so that of documents that share all their passages one is left.

Null texts are empty, a null host is a host of its own, and repeated rows each get their row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh_name, small, stored

# White space between words, the characters of a word, and the symbols counted.
SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bits of a sort key that hold a position: a text may have 2**28 words, which is more than a row can hold.
_PLACE = 28


@dataclass(frozen=True)
class Limits:
    """Fewest words; largest share of repeated words; texts and share of a host's texts a line may be in;
    largest share of words in common lines, and fewest words that must be left; words from which the number
    of texts alone decides about a line (none: the share holds for all lines)."""

    words: int = 50
    repeated_pct: int = 50
    line_texts: int = 20
    line_pct: int = 5
    removed_pct: int = 50
    left: int = 20
    long_line: int | None = None


#: The rules of the query and the pipeline: a line of ten words is a passage, and its number of texts decides.
RULES = Limits(long_line=10)


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(line, UPPER, LOWER), r"[\x20\x09-\x0D]+", " "))


def _neighbours(items: str, key) -> Column:
    """Items of a sorted array whose key is that of an item next to them."""

    def same(item: Column, place: Column) -> Column:
        before, after = F.get(F.col(items), place - 1), F.get(F.col(items), place + 1)
        return F.coalesce(key(item) == key(before), F.lit(False)) | F.coalesce(key(item) == key(after), F.lit(False))

    return F.filter(items, same)


def base_counts(docs: DataFrame, text: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words; ``text`` must not be null.

    Windows of three words are told apart by a sort of hashes with their positions in the low bits;
    only windows whose hash occurs twice are then compared as text.
    """
    high = lambda value: F.shiftright(value, _PLACE)
    counted = docs.withColumns({
        "_words": F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        "_lines": F.filter(F.split(text, "\n"), lambda line: without(line, SPACE) != ""),
        "word_chars": F.length(without(F.col(text), SPACE)).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(without(F.col(text), SYMBOLS))).cast("bigint"),
    }).withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "_sorted": F.sort_array(F.when(F.size("_words") >= 3, F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("_words") - 3, F.lit(0))),
            lambda i: F.shiftleft(high(F.xxhash64(
                F.get(F.col("_words"), i), F.get(F.col("_words"), i + 1), F.get(F.col("_words"), i + 2)
            )), _PLACE).bitwiseOR(i.cast("bigint")),
        )).otherwise(F.array().cast("array<bigint>"))),
    })
    counted = counted.withColumn("_found", _neighbours("_sorted", high)).withColumn("_texts", F.array_sort(F.transform(
        F.transform("_found", lambda value: value.bitwiseAND((1 << _PLACE) - 1).cast("int")),
        lambda i: F.struct(
            F.concat_ws(" ", F.slice("_words", i + 1, 3)).alias("text"), i.alias("place")
        ),
    )))
    counted = counted.withColumn(
        "_places", F.sort_array(F.transform(_neighbours("_texts", lambda item: item["text"]), lambda item: item["place"]))
    )
    repeated = F.aggregate(
        F.transform("_places", lambda p, i: F.least(F.lit(3), F.coalesce(F.get(F.col("_places"), i + 1) - p, F.lit(3)))),
        F.lit(0), lambda total, value: total + value,
    )
    return counted.withColumn("n_repeat_words", repeated.cast("bigint")).drop("_sorted", "_found", "_texts", "_places")


def verdicts(docs: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """Counts and verdict of every row of documents (doc_id, text, host).

    Result: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    n_removed_words (words in common lines), and two hashes of text and host (``text_key``, ``host_key``).
    """
    rows = docs.select("doc_id", F.col(host).alias("_host"), F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    line = lambda text: F.struct(
        F.xxhash64("_host", text).alias("line"),
        (F.length(text) - F.length(without(text, " ")) + 1).alias("words"),
    )
    counted = stored(base_counts(rows, "_text").select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_host",
        F.xxhash64("_text", "_host").alias("text_key"),
        F.xxhash64("_host", F.lit(1), "_text").alias("host_key"),
        ((F.col("n_words") < limits.words) | (100 * F.col("n_repeat_words") > limits.repeated_pct * F.col("n_words")))
        .alias("base_failed"),
        F.transform(F.transform("_lines", normalised), line).alias("lines"),
    ))
    # Only lines beyond the fixed limit are compared with the size of their host.
    own_place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key").alias("own")
    lines = counted.select("row", "_host", "text_key", own_place, F.explode("lines").alias("item")).select(
        "row", "_host", "text_key", "own", "item.line", "item.words"
    )
    frequent = (
        lines.groupBy("line", "text_key").agg(
            F.first("_host").alias("_host"), F.first("words").alias("words"), F.min("own").alias("own")
        )
        .groupBy("line").agg(
            F.count("*").alias("texts"), F.first("_host").alias("_host"),
            F.first("words").alias("words"), F.min("own").alias("own"),
        )
        .where(F.col("texts") > limits.line_texts)
    )
    sizes = (
        counted.groupBy("_host", "text_key").agg(F.lit(1).alias("one"))
        .groupBy(F.col("_host").alias("_other")).agg(F.count("*").alias("host_texts"))
    )
    placed = frequent.join(sizes, F.col("_host").eqNullSafe(F.col("_other")))
    share = 100 * F.col("texts") > limits.line_pct * F.col("host_texts")
    if limits.long_line is None:
        found = lines.join(small(stored(placed.where(share).select("line"))), "line")
    else:
        common = placed.where(share | (F.col("words") >= limits.long_line)).select(
            "line", F.when(~share, F.col("own.text_key")).alias("keeper")
        )
        found = lines.join(small(stored(common)), "line").where(~F.col("text_key").eqNullSafe(F.col("keeper")))
    removed = found.groupBy("row").agg(F.sum("words").cast("bigint").alias("n_removed_words"))
    removed = small(stored(removed))
    n_removed = F.coalesce("n_removed_words", F.lit(0).cast("bigint"))
    depleted = (n_removed > 0) & (
        (100 * n_removed > limits.removed_pct * F.col("n_words")) | (F.col("n_words") - n_removed < limits.left)
    )
    return counted.drop("lines", "_host").join(removed, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~depleted).alias("kept"),
        n_removed.alias("n_removed_words"), "text_key", "host_key",
    )


def keep(docs: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """The documents that the rules keep, with their columns. Rows of equal text and host share their fate."""
    rejected = verdicts(docs, limits, host).where(~F.col("kept")).select("text_key", "host_key").distinct()
    rejected = small(stored(rejected.toDF("_text_key", "_host_key")))
    text = F.coalesce(F.col("text"), F.lit(""))
    first, second = fresh_name(docs, "_first"), fresh_name(docs, "_second")
    keyed = docs.withColumns({first: F.xxhash64(text, host), second: F.xxhash64(host, F.lit(1), text)})
    same = (keyed[first] == rejected["_text_key"]) & (keyed[second] == rejected["_host_key"])
    return keyed.join(rejected, same, "left_anti").select(*(keyed[name] for name in docs.columns))
