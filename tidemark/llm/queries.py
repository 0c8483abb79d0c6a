"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder
from . import (
    alignment, byte_bpe, hamming_search, license_scan, line_rules, log_bilinear, mixing, near_dedup, pair_bpe, quality_knn,
    spelling, toxicity, warc,
)
from .common import batched, stored, training_row

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RANKS = "byte_bpe_50k.tiktoken"
ENTRIES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(batched(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_near_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


@query("op2_byte_bpe")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    ranks = byte_bpe.load_ranks(spark, public_tokenizers.path(RANKS))
    ids = byte_bpe.encode(F.col("text"), ranks, public_tokenizers.PATTERN)
    rows = table(spark, folder, "documents").select("doc_id", ids.alias("ids"))
    return rows.select(
        "doc_id",
        byte_bpe.token_count(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(F.col("ids"), ranks, public_tokenizers.PATTERN), 256).alias("decoded_sha256"),
    )


@query("op3_license_scan", license_scan.sql())
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents"))


SEARCH_SQL = """
WITH d AS (SELECT DISTINCT q.vec_id AS query_id, v.vec_id,
                  len([i FOR i IN range(1, 65) IF (q.embedding[i] > 0) <> (v.embedding[i] > 0)])::INTEGER AS distance
           FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INTEGER AS rank FROM d)
SELECT query_id, vec_id, distance, rank FROM r WHERE rank <= 10
"""


@query("op4_hamming_search", SEARCH_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    codes = table(spark, folder, "embeddings").select("vec_id", hamming_search.code(F.col("embedding")).alias("code"))
    return hamming_search.neighbours(codes, codes.where(F.col("vec_id") % 50 == 0))


@query("op5_warc")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    place = scratch_folder(spark)
    shards = warc.index(warc.write(pages, f"{place}/archives"), f"{place}/index")
    requests = pages.select(warc.url_key(F.col("url")).alias("key"), "page_id")
    read = warc.read(warc.lookup(requests, f"{place}/index", shards), f"{place}/archives")
    # A response is measured by what was read back; a revisit has what its record says of the payload.
    return read.select(
        "page_id",
        F.coalesce(F.octet_length("payload").cast("bigint"), "payload_bytes").alias("payload_bytes"),
        F.coalesce(F.sha2("payload", 256), "digest").alias("payload_digest"),
        "record_type", "refers_to",
    )


@query("op6_mixing")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "source", mixing.size(F.col("text")).alias("size"),
        F.xxhash64("text").alias("mark"),
    )
    return mixing.plan(stored(rows)).select("doc_id", "size", "source_size", "target", "taken", "passes")


@query("op7_quality_knn")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    learning = training_row(F.col("doc_id"), 3, 1)
    labels = table(spark, folder, "labels").where(learning)
    model = spark.sparkContext.broadcast(quality_knn.learn(quality_knn.sample(docs, labels, "quality")))
    rows = docs.select("doc_id", (~learning).alias("held_out"), quality_knn.quality(F.col("text"), model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op8_toxicity")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    learning = training_row(F.col("doc_id"), 3, 1)
    lexicon = toxicity.learn(toxicity.sample(docs, table(spark, folder, "labels").where(learning)))
    rows = docs.select("doc_id", (~learning).alias("held_out"), toxicity.toxicity(F.col("text"), lexicon).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


RULES_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
),
w AS (
  SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM d
),
windows AS (
  SELECT r, i AS p, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS three
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
),
twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, three) AS n FROM windows) WHERE n > 1),
repeated AS (
  SELECT r, sum(least(3, coalesce(following - p, 3))) AS n
  FROM (SELECT r, p, lead(p) OVER (PARTITION BY r ORDER BY p) AS following FROM twice) GROUP BY r
),
base AS (
  SELECT d.r, doc_id, source, t, len(ws) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, ls
  FROM d JOIN w USING (r) LEFT JOIN repeated USING (r)
),
lines AS (
  SELECT r, doc_id, source, t, trim(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS line
  FROM (SELECT r, doc_id, source, t, unnest(ls) AS x FROM base)
),
hosts AS (SELECT source, count(DISTINCT t) AS texts FROM d GROUP BY source),
common AS (
  SELECT l.source, line, CASE WHEN 100 * n <= 5 * texts THEN keeper END AS keeper
  FROM (SELECT source, line, count(DISTINCT t) AS n, arg_min(t, coalesce(doc_id, 9223372036854775807)) AS keeper
        FROM lines GROUP BY source, line) l
  JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
  WHERE n > 20 AND (100 * n > 5 * texts OR len(string_split(line, ' ')) >= 10)
),
removed AS (
  SELECT r, sum(len(string_split(l.line, ' '))) AS n FROM lines l
  JOIN common c ON l.line = c.line AND l.source IS NOT DISTINCT FROM c.source
  WHERE c.keeper IS NULL OR l.t <> c.keeper GROUP BY r
),
judged AS (
  SELECT b.*, coalesce(n, 0)::BIGINT AS n_removed_words,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM base b LEFT JOIN removed USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_removed_words > 0
         AND (100 * n_removed_words > 50 * n_words OR n_words - n_removed_words < 20)) AS kept,
       n_removed_words
FROM judged
"""


@query("op9_line_rules", RULES_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.verdicts(table(spark, folder, "documents"), line_rules.RULES).drop("text_key", "host_key")


@query("op10_log_bilinear")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    learning = training_row(F.col("doc_id"), 10, 0)
    docs = table(spark, folder, "documents").select("doc_id", (~learning).alias("held_out"), "text")
    model, counts = log_bilinear.learn(docs.where(learning))
    return log_bilinear.score(docs, model, counts)


@query("op11_alignment")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    tokenizers = alignment.load(
        spark, public_tokenizers.path(ENTRIES), public_tokenizers.PATTERN, public_tokenizers.path(PIECES)
    )
    return alignment.alignment_digests(table(spark, folder, "documents"), tokenizers)


@query("op12_pair_bpe")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    content = pair_bpe.load_vocabulary(spark, public_tokenizers.path(ENTRIES))
    rows = pair_bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), content, public_tokenizers.PATTERN)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(pair_bpe.ids_text(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2(pair_bpe.decode(F.col("ids"), content, public_tokenizers.PATTERN), 256).alias("decoded_sha256"),
    )


@query("op13_spelling")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))
