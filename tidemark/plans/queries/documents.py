"""Queries over JSON documents: flattening, typing, envelopes and marks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions.variants import get, parse
from ...operators.flatten import flatten
from ...operators.watermark import high_water_mark, run_checkpoint
from ...options import INCREMENTAL_UPSERT
from ...session import scratch_folder
from ...sources.arrays import scan_arrays
from ...sources.pages import empty_payload
from ...sources.payloads import unwrap
from .registry import query, records, table


def order_documents(orders: DataFrame) -> DataFrame:
    """Orders as documents with a nested object, an array of texts and one of objects."""
    # Making documents takes long for few bytes, so rows are spread whatever files they come from.
    return records(orders.repartition("o_orderkey"), F.col("o_orderkey"), F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("Status"),
        F.col("o_totalprice").alias("total price"),
        F.struct(
            F.col("o_custkey").alias("id"),
            F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("last-order")).alias("dates"),
        ).alias("customer"),
        F.split("o_orderpriority", "-").alias("tags"),
        F.array(
            F.struct(F.lit("total").alias("kind"), F.col("o_totalprice").alias("amount")),
            F.struct(F.lit("customer").alias("kind"), F.col("o_custkey").cast("double").alias("amount")),
        ).alias("charges"),
    ))


@query("flatten_root", """
SELECT o_orderkey AS row_index, o_orderkey AS id, o_orderstatus AS status, o_totalprice AS total_price,
       o_custkey AS customer_id, strftime(o_orderdate, '%Y-%m-%d') AS customer_dates_last_order
FROM orders""")
def flatten_root(spark: SparkSession, folder: str) -> DataFrame:
    """Nested objects become prefixed columns of the root row."""
    tables = flatten(order_documents(table(spark, folder, "orders")), "orders", 1).tables
    return tables["orders"].select(
        F.col("_row_index").alias("row_index"), "id", "status", "total_price", "customer_id",
        "customer_dates_last_order",
    )


@query("flatten_child", """
SELECT '["orders",' || o_orderkey || ']' AS parent_key, 0 AS row_index, 'total' AS kind, o_totalprice AS amount
FROM orders
UNION ALL
SELECT '["orders",' || o_orderkey || ']', 1, 'customer', CAST(o_custkey AS DOUBLE) FROM orders""")
def flatten_child(spark: SparkSession, folder: str) -> DataFrame:
    """Arrays of objects become child tables that keep their order and parent."""
    tables = flatten(order_documents(table(spark, folder, "orders")), "orders", 1).tables
    return tables["orders_charges"].select(
        F.col("_parent_key").alias("parent_key"), F.col("_row_index").alias("row_index"), "kind", "amount",
    )


@query("flatten_parent_ids", """
SELECT o_orderkey AS id, len(string_split(o_orderpriority, '-')) AS tags, 2 AS charges FROM orders""")
def flatten_parent_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Child rows find their parent by row id, whichever job wrote them."""
    tables = flatten(order_documents(table(spark, folder, "orders")), "orders", 1).tables
    counts = [
        tables[f"orders_{name}"].groupBy("_parent_id").agg(F.count(F.lit(1)).alias(name))
        for name in ("tags", "charges")
    ]
    root = tables["orders"].select("id", F.col("_row_id").alias("_parent_id"))
    return root.join(counts[0], "_parent_id").join(counts[1], "_parent_id").drop("_parent_id")


@query("flatten_scalar_array", """
SELECT '["documents",' || doc_id || ']' AS parent_key, u.i - 1 AS row_index, u.line AS value
FROM documents, unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(line, i)""")
def flatten_scalar_array(spark: SparkSession, folder: str) -> DataFrame:
    """Arrays of texts become rows with ``value``; whole documents, line by line."""
    documents = table(spark, folder, "documents")
    rows = records(documents, F.col("doc_id"), F.struct(
        F.col("doc_id").alias("id"), F.split("text", "\n").alias("lines"),
    ))
    return flatten(rows, "documents", 1).tables["documents_lines"].select(
        F.col("_parent_key").alias("parent_key"), F.col("_row_index").alias("row_index"), "value",
    )


@query("stable_parent_keys", """
WITH lines AS (
  SELECT conv_id || '-' || turn AS id, u.i - 1 AS line_no, u.line
  FROM conversations, unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(line, i))
SELECT '["[\\"talks\\",\\"' || id || '\\"]","talks_lines",' || line_no || ']' AS parent_key,
       w.i - 1 AS row_index, w.word AS value
FROM lines, unnest(string_split(line, ' ')) WITH ORDINALITY AS w(word, i)""")
def stable_parent_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Arrays in arrays: keys are carried down, with positions where there is no id."""
    talks = table(spark, folder, "conversations")
    rows = records(talks, F.col("conv_id"), F.struct(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        F.transform(
            F.split("text", "\n"), lambda line: F.struct(F.split(line, " ").alias("words"))
        ).alias("lines"),
    ))
    return flatten(rows, "talks", 1).tables["talks_lines_words"].select(
        F.col("_parent_key").alias("parent_key"), F.col("_row_index").alias("row_index"), "value",
    )


@query("flatten_props", """
SELECT event_id AS row_index, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def flatten_props(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        F.col("event_id").alias("root_index"), parse(F.col("props")).alias("rec")
    )
    return flatten(events, "props", 1).tables["props"].select(F.col("_row_index").alias("row_index"), "k")


@query("flatten_first_seen_types", """
SELECT event_id AS row_index, CAST(user_id AS VARCHAR) AS code,
  CASE WHEN event_id % 3 <> 0 THEN regexp_replace(CAST(value AS VARCHAR), '\\.0$', '') END AS late,
  user_id AS amount, CAST(user_id AS DOUBLE) AS ratio,
  CASE WHEN event_id % 3 = 0 OR event_type = 'click' THEN TRUE WHEN event_type = 'view' THEN FALSE END AS flag
FROM events""")
def flatten_first_seen_types(spark: SparkSession, folder: str) -> DataFrame:
    """Columns keep the type of their first value; later values are converted to it.

    ``code`` starts as text, ``late`` as null, ``amount`` whole, ``ratio`` with a fraction, and
    ``flag`` as a boolean, for every third record has one from the first on.
    """
    events = table(spark, folder, "events")
    every = F.col("event_id") % 3
    user, value = F.col("user_id").cast("string"), F.col("value").cast("string")
    flag = (
        F.when((every == 0) | (F.col("event_type") == "click"), "true")
        .when(F.col("event_type") == "view", '"no"').otherwise("null")
    )
    text = F.concat(
        F.lit('{"code":'), F.when(every == 0, F.concat(F.lit('"'), user, F.lit('"'))).otherwise(user),
        F.lit(',"late":'), F.when(every == 0, "null").otherwise(value),
        F.lit(',"amount":'), F.when(every == 1, F.concat(F.lit('"'), user, F.lit('"'))).otherwise(user),
        F.lit(',"ratio":'), F.when(every == 0, F.concat(user, F.lit(".0"))).otherwise(user),
        F.lit(',"flag":'), flag, F.lit("}"),
    )
    rows = events.select(F.col("event_id").alias("root_index"), parse(text).alias("rec"))
    flat = flatten(rows, "mixed", 1).tables["mixed"]
    return flat.select(F.col("_row_index").alias("row_index"), "code", "late", "amount", "ratio", "flag")


@query("flatten_widened_types", """
SELECT event_id AS row_index, event_id AS whole, 100 * user_id AS scaled, CAST(user_id AS DOUBLE) AS ratio FROM events""")
def flatten_widened_types(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers stay whole where later records write them as ``7.0`` or ``1e2``; nothing is lost."""
    events = table(spark, folder, "events")
    user, odd = F.col("user_id").cast("string"), F.col("event_id") % 2 == 1
    text = F.concat(
        F.lit('{"whole":'), F.col("event_id").cast("string"), F.when(odd, ".0").otherwise(""),
        F.lit(',"scaled":'), user, F.when(odd, "e2").otherwise("00"),
        F.lit(',"ratio":'), user, F.when(odd, "").otherwise(".00"), F.lit("}"),
    )
    # A number must not start with zeros.
    rows = events.select(F.col("event_id").alias("root_index"), parse(F.replace(text, F.lit(":000"), F.lit(":0"))).alias("rec"))
    flat = flatten(rows, "numbers", 1).tables["numbers"]
    return flat.select(F.col("_row_index").alias("row_index"), "whole", "scaled", "ratio")


def sparse_documents(documents: DataFrame) -> dict[str, DataFrame]:
    """Tables of all documents with all their columns, and an array that is empty in each."""
    rows = records(documents, F.col("doc_id"), F.struct(*documents.columns, F.array().cast("array<string>").alias("none")))
    return flatten(rows, "sparse", 1).tables


@query("flatten_empty_arrays", """
SELECT doc_id AS row_index, 'sparse' AS found_in, source AS value FROM documents
UNION ALL SELECT NULL, 'sparse_none', NULL""")
def flatten_empty_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """An array that is empty in every record still has its table; its absence would miss the marker row."""
    tables = sparse_documents(table(spark, folder, "documents"))
    root = tables["sparse"].select(
        F.col("_row_index").alias("row_index"), F.lit("sparse").alias("found_in"), F.col("source").alias("value")
    )
    empty = tables["sparse_none"].agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(
        F.lit(None).cast("bigint").alias("row_index"), F.lit("sparse_none").alias("found_in"),
        F.lit(None).cast("string").alias("value"),
    )
    return root.unionByName(empty)


@query("array_documents", """
SELECT doc_id // 2000 AS part, row_number() OVER (PARTITION BY doc_id // 2000 ORDER BY doc_id) - 1 AS root_index,
       doc_id, lang, source, sha256(text) AS text_sha256
FROM documents""")
def array_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written as JSON arrays of up to 2,000, one file each, and read back record by record."""
    documents = table(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    arrays = documents.groupBy(F.floor(F.col("doc_id") / 2000).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct(*documents.columns))).alias("list")
    )
    path = scratch_folder(spark)
    arrays.select("part", F.to_json("list", {"ignoreNullFields": "false"}).alias("value")).write.partitionBy("part").text(path)
    found = scan_arrays(spark, path)
    field = lambda name, dtype: get(F.col("rec"), (name,), dtype)
    return found.select(
        F.regexp_extract("file", r"part=(-?\d+)", 1).cast("bigint").alias("part"), "root_index",
        field("doc_id", "bigint").alias("doc_id"), field("lang", "string").alias("lang"), field("source", "string").alias("source"),
        F.sha2(field("text", "string"), 256).alias("text_sha256"),
    )


@query("envelope_unwrap", """
SELECT conv_id, turn // 20 AS chunk,
       CASE WHEN conv_id % 3 = 2 THEN 0
            ELSE row_number() OVER (PARTITION BY conv_id, turn // 20 ORDER BY turn) - 1 END AS root_index,
       CASE WHEN conv_id % 3 <> 2 THEN turn END AS turn, sha256(text) AS text_sha256
FROM conversations
WHERE conv_id % 3 <> 2
UNION ALL
SELECT DISTINCT conv_id, turn // 20, 0, NULL::BIGINT, NULL FROM conversations WHERE conv_id % 3 = 2""")
def envelope_unwrap(spark: SparkSession, folder: str) -> DataFrame:
    """Turns in envelopes of at most 20; an object without paging keys is one record."""
    turns = table(spark, folder, "conversations")
    chunks = turns.groupBy("conv_id", F.floor(F.col("turn") / 20).alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("list")
    )
    items, kind = F.to_json("list"), F.col("conv_id") % 3
    body = (
        F.when(kind == 0, F.concat(F.lit('{"results":'), items, F.lit(',"total":1}')))
        .when(kind == 1, F.concat(F.lit('{"next":null,"records":'), items, F.lit("}")))
        .otherwise(F.concat(F.lit('{"results":'), items, F.lit("}")))
    )
    pages = chunks.select("conv_id", "chunk", parse(body).alias("body"))
    return unwrap(pages).select(
        "conv_id", "chunk", "root_index", get(F.col("rec"), ("turn",), "bigint").alias("turn"),
        F.sha2(get(F.col("rec"), ("text",), "string"), 256).alias("text_sha256"),
    )


@query("high_water_mark", """
WITH m AS (SELECT max(CASE WHEN event_id % 4 = 3 THEN date_trunc('second', ts) ELSE ts END) AS t,
                  sum(CASE WHEN event_id % 4 = 1 THEN 2 ELSE 1 END)::BIGINT AS found FROM events)
SELECT strftime(t, '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN microsecond(t) % 1000000 <> 0 THEN strftime(t, '.%f') ELSE '' END || '+00:00' AS checkpoint,
       found, 0 AS bad
FROM m""")
def watermark(spark: SparkSession, folder: str) -> DataFrame:
    """Highest ``updated_at`` at any depth, over texts with several zones and formats."""
    events = table(spark, folder, "events")
    moment = F.col("ts").cast("timestamp")

    def text(instant, pattern: str, zone: str):
        return F.concat(F.date_format(instant, pattern), F.lit(zone))

    plain = text(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "Z")
    moved = text(moment + F.expr("INTERVAL 3 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "+03:00")
    naive = text(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS", "")
    basic = text(moment, "yyyyMMdd'T'HHmmss", "Z")
    which = F.col("event_id") % 4

    def document(*pieces):
        return F.concat(*[F.lit(piece) if isinstance(piece, str) else piece for piece in pieces])

    body = (
        F.when(which == 0, document('{"updated_at":"', plain, '"}'))
        .when(which == 1, document(
            '{"updated_at":"', F.lit("2020-01-01"), '","parts":[{"meta":{"updated_at":"', moved, '"}}]}'))
        .when(which == 2, document('{"meta":{"updated_at":"', naive, '"}}'))
        .otherwise(document('{"parts":[{"updated_at":"', basic, '"}]}'))
    )
    return high_water_mark(
        events.select(parse(body).alias("rec")), "updated_at", "2020-06-01T00:00:00Z",
    )


@query("empty_payload_checkpoint", """
WITH m AS (SELECT strftime(date_trunc('second', max(ts)), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS mark
           FROM events WHERE event_id % 6 = 4)
SELECT event_id, event_id % 6 IN (0, 1, 2, 3) AS is_empty,
       CASE WHEN event_id % 6 IN (0, 1, 2, 3) THEN '2020-01-01T00:00:00+00:00' WHEN event_id % 6 = 4 THEN mark END AS checkpoint
FROM events, m""")
def empty_payload_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    """Runs over six kinds of answers: empty ones keep the checkpoint from before, one with marks gets
    its own, and one with content but no mark has none."""
    events = table(spark, folder, "events")
    which = F.col("event_id") % 6
    moment = F.date_format(F.date_trunc("second", F.col("ts").cast("timestamp")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    body = (
        F.when(which == 0, "[]").when(which == 1, "{}").when(which == 2, "null")
        .when(which == 3, '{"items":[],"errors":[],"total":0}')
        .when(which == 4, F.concat(F.lit('{"items":['), "event_id", F.lit('],"errors":[],"updated_at":"'), moment, F.lit('"}')))
        .otherwise(F.col("props"))
    )
    answers = events.select("event_id", which.alias("kind"), parse(body).alias("rec"))
    answers = answers.withColumn("is_empty", empty_payload(F.col("rec")))
    before, found = "2020-01-01T00:00:00+00:00", []
    for kind in range(6):
        own = answers.where(F.col("kind") == kind)
        empty = own.agg(F.bool_and("is_empty")).first()[0]
        try:
            after = run_checkpoint(own.select("rec"), "updated_at", INCREMENTAL_UPSERT, before, True, bool(empty))
        except ValueError:
            after = None
        found.append((kind, after))
    marks = spark.createDataFrame(found, "kind INT, checkpoint STRING")
    return answers.join(F.broadcast(marks), "kind").select("event_id", "is_empty", "checkpoint")
