"""A corpus pipeline: each stage works on what the one before it kept.

Toxic documents go, then those that the quality rules reject, then near copies; the rest is mixed to the
sources' target weights and encoded. Every stage takes and returns documents (the last one tokens).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, line_rules, mixing, near_dedup, toxicity
from tidemark.llm.common import batched, fresh_name, stored, training_row

RANKS = "byte_bpe_50k.tiktoken"

#: Score from which a document counts as toxic.
TOXIC = 0.7


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold. The lexicon is learnt from the labelled ones
    among them; null and empty texts have no hits and stay."""
    batched(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(training_row(F.col("doc_id"), 3, 1))
    lexicon = toxicity.learn(toxicity.sample(docs, labels))
    score = fresh_name(docs, "_score")
    scored = docs.withColumn(score, toxicity.toxicity(F.col("text"), lexicon))
    return scored.where(F.col(score) < TOXIC).select(*docs.columns)


def within_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts have too few words and go."""
    batched(spark)
    return line_rules.keep(docs, line_rules.RULES)


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies; documents without words are alone and stay."""
    batched(spark)
    return near_dedup.keep(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a row for each pass over a document, a partial pass takes a run of
    neighbours and cuts only those at its ends; documents without words are not taken."""
    batched(spark)
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their packed token ids, checked by decoding; null texts have none."""
    batched(spark)
    ranks = byte_bpe.load_ranks(spark, public_tokenizers.path(RANKS))
    packed = byte_bpe.encode(F.col("text"), ranks, public_tokenizers.PATTERN)
    rows = docs.select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"), packed.alias("ids"))
    decoded = byte_bpe.decode(F.col("ids"), ranks, public_tokenizers.PATTERN)
    return rows.select(
        "doc_id", "lang", "source", byte_bpe.token_count(F.col("ids")).alias("n_tokens"), "ids",
        (decoded == F.encode("text", "UTF-8")).alias("round_trip"),
    )


STAGES = [
    ("toxicity", without_toxic),
    ("quality rules", within_rules),
    ("MinHash near-dedup", first_copies),
    ("mixing to target weights", mix),
    ("byte-level BPE", tokens),
]

#: Signatures, a learnt lexicon and merges by rank cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(batched(spark), docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs)
    return docs
