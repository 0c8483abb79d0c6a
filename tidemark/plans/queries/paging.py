"""Queries over pages of paged sources: assembly, completeness, links and hosts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...functions.names import identifier_column, source_slug
from ...functions.urls import is_allowed, read_allowed
from ...functions.variants import get, parse
from ...session import scratch_folder
from ...sources.manifests import MANIFEST_SUFFIX, manifest_name, pack_manifests, read_manifests, validate_manifests
from ...sources.masters import scan_masters
from ...sources.pages import assemble_pages, envelope, page_chain_audit, pagination_complete, run_complete
from ...sources.payloads import inspect_content
from .registry import query, table

PAGE_SIZE, RUN_PAGES = 100, 20


def page_rows(rows: DataFrame, key: str, item) -> DataFrame:
    """Rows cut into pages of at most 100 ids and runs of at most 20 pages."""
    page = F.floor(F.col(key) / PAGE_SIZE)
    items = rows.select(
        F.floor(page / RUN_PAGES).alias("run"), (page % RUN_PAGES + 1).alias("page_no"),
        F.struct(F.col(key).alias("_order"), item.alias("item")).alias("entry"),
    )
    return items.groupBy("run", "page_no").agg(
        F.transform(F.array_sort(F.collect_list("entry")), lambda entry: entry["item"]).alias("list")
    )


def whole_event():
    return F.struct("event_id", "ts", "user_id", "event_type", "value", "props")


def with_totals(pages: DataFrame) -> DataFrame:
    """Add the record and page totals of each run."""
    totals = pages.groupBy("run").agg(
        F.sum(F.size("list")).alias("total"), F.max("page_no").alias("last_page"),
    )
    return pages.join(totals, "run")


def as_pages(pages: DataFrame, body, url=None, header=None) -> DataFrame:
    return pages.select(
        F.lit("feed").alias("source"), F.col("run").cast("string").alias("run_id"), "page_no",
        (url if url is not None else F.lit("https://api.example.org/feed")).alias("url"),
        (header if header is not None else F.lit(None).cast("string")).alias("link_header"),
        parse(body).alias("body"),
    )


@query("assemble_pages", """
SELECT CAST(doc_id // 2000 AS VARCHAR) AS run_id,
       row_number() OVER (PARTITION BY doc_id // 2000 ORDER BY doc_id) - 1 AS root_index,
       doc_id AS id, text
FROM documents""")
def assembled(spark: SparkSession, folder: str) -> DataFrame:
    """Documents from pages of three envelope forms, numbered through each run."""
    documents = table(spark, folder, "documents")
    pages = page_rows(documents, "doc_id", F.struct("doc_id", "lang", "text"))
    items = F.to_json("list")
    body = (
        F.when(F.col("run") % 3 == 0, F.concat(F.lit('{"items":'), items, F.lit(',"page":'), "page_no", F.lit("}")))
        .when(F.col("run") % 3 == 1, F.concat(F.lit('{"meta":{"page":1},"rows":'), items, F.lit("}")))
        .otherwise(items)
    )
    records = assemble_pages(as_pages(pages, body))
    return records.select(
        "run_id", "root_index", get(F.col("rec"), ("doc_id",), "bigint").alias("id"),
        get(F.col("rec"), ("text",), "string").alias("text"),
    )


@query("page_envelopes", """
SELECT CAST(event_id // 2000 AS VARCHAR) AS run_id, 'items' AS collection_key,
       '{"page":' || (max(event_id // 100) % 20 + 1) || ',"total":' || count(*) || '}' AS metadata
FROM events GROUP BY event_id // 2000""")
def page_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """The combined document keeps the metadata of the last page."""
    pages = with_totals(page_rows(table(spark, folder, "events"), "event_id", F.col("event_id")))
    body = F.concat(
        F.lit('{"items":'), F.to_json("list"), F.lit(',"page":'), "page_no", F.lit(',"total":'), "total", F.lit("}"),
    )
    return envelope(as_pages(pages, body)).select("run_id", "collection_key", "metadata")


def offset_body(extra=None):
    skip = (F.col("page_no") - 1) * PAGE_SIZE
    return F.concat(
        F.lit('{"items":'), F.to_json("list"), F.lit(',"total":'), "total", F.lit(',"skip":'), skip,
        F.lit(f',"limit":{PAGE_SIZE}'), extra if extra is not None else F.lit(""), F.lit("}"),
    )


EVENT_PAGES = """
WITH pages AS (
  SELECT event_id // 2000 AS run, event_id // 100 % 20 + 1 AS page_no, count(*) AS n
  FROM events GROUP BY ALL),
totals AS (SELECT run, sum(n) AS total, max(page_no) AS last_page FROM pages GROUP BY run)
"""


@query("page_completeness", EVENT_PAGES + """
SELECT CAST(run AS VARCHAR) AS run_id, page_no,
       total <= page_no * 100 AND NOT (run % 3 = 1 AND page_no % 4 = 0)
       AND NOT (run % 3 = 2 AND page_no % 5 = 0) AS complete
FROM pages JOIN totals USING (run)""")
def page_completeness(spark: SparkSession, folder: str) -> DataFrame:
    """Pages that point to further ones by totals, a nested flag or a nested cursor."""
    pages = with_totals(page_rows(table(spark, folder, "events"), "event_id", whole_event()))
    run, page = F.col("run"), F.col("page_no")
    hint = (
        F.when((run % 3 == 1) & (page % 4 == 0), ',"meta":{"paging":[{"has_more":true}]}')
        .when((run % 3 == 2) & (page % 5 == 0), ',"links":{"next_cursor":"c1","next":""}')
        .otherwise(',"meta":{"paging":[]},"links":{"next_cursor":null,"next":""}')
    )
    return pagination_complete(as_pages(pages, offset_body(hint))).select("run_id", "page_no", "complete")


@query("run_completeness", EVENT_PAGES + """
SELECT CAST(run AS VARCHAR) AS run_id, run % 2 = 0 AS pagination_complete FROM totals""")
def run_completeness(spark: SparkSession, folder: str) -> DataFrame:
    """The last page of a run decides; every other run claims more rows than it sent."""
    pages = with_totals(page_rows(table(spark, folder, "events"), "event_id", whole_event()))
    pages = pages.withColumn("total", F.col("total") + F.when(F.col("run") % 2 == 1, 500).otherwise(0))
    return run_complete(as_pages(pages, offset_body())).select("run_id", "pagination_complete")


@query("page_chain_audit", EVENT_PAGES + """,
seeded AS (
  SELECT run, page_no, last_page, run % 4 AS kind,
         'https://api.example.org/v1/feed?' ||
         CASE run % 4 WHEN 2 THEN 'skip=' || (used - 1) * 100 || '&limit=100' ELSE 'page=' || used END AS url
  FROM (SELECT *, CASE WHEN page_no = 9 AND run % 5 = 1 THEN 8 ELSE page_no END AS used FROM pages) p
  JOIN totals USING (run)),
linked AS (
  SELECT *, CASE WHEN page_no < last_page AND NOT (page_no = 12 AND run % 5 = 2) THEN
           CASE kind WHEN 0 THEN 'next' WHEN 1 THEN 'header' WHEN 2 THEN 'offset' ELSE 'page' END END AS link_kind
  FROM seeded),
expected AS (
  SELECT *, CASE WHEN link_kind IS NULL THEN NULL
     WHEN kind = 2 THEN 'https://api.example.org/v1/feed?skip=' || page_no * 100 || '&limit=100'
     WHEN kind = 3 AND page_no = 9 AND run % 5 = 1 THEN 'https://api.example.org/v1/feed?page=9'
     ELSE 'https://api.example.org/v1/feed?page=' || (page_no + 1) END AS next_url
  FROM linked)
SELECT CAST(e.run AS VARCHAR) AS run_id, e.page_no, e.link_kind, e.next_url,
  CASE WHEN e.page_no = 9 AND e.run % 5 = 1 THEN 'repeated URL'
       WHEN e.next_url IS NOT NULL AND f.url IS NULL THEN 'missing page'
       WHEN e.next_url IS NULL AND f.url IS NOT NULL THEN 'unexpected page'
       WHEN e.next_url <> f.url THEN 'wrong page' END AS problem
FROM expected e LEFT JOIN expected f ON f.run = e.run AND f.page_no = e.page_no + 1""")
def chain_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Four kinds of links, with repeated addresses and missing links seeded in."""
    pages = with_totals(page_rows(table(spark, folder, "events"), "event_id", whole_event()))
    run, page = F.col("run"), F.col("page_no")
    kind = run % 4
    used = F.when((page == 9) & (run % 5 == 1), F.lit(8)).otherwise(page)
    base = "https://api.example.org/v1/feed"
    url = F.when(
        kind == 2, F.concat(F.lit(f"{base}?skip="), (used - 1) * PAGE_SIZE, F.lit(f"&limit={PAGE_SIZE}"))
    ).otherwise(F.concat(F.lit(f"{base}?page="), used))
    more = (page < F.col("last_page")) & ~((page == 12) & (run % 5 == 2))
    items = F.concat(F.lit('{"items":'), F.to_json("list"))
    total = F.when(more, F.col("total")).otherwise(F.lit(0))
    body = (
        F.when(kind == 0, F.concat(
            items, F.when(more, F.concat(F.lit(',"next":" ../v1/./feed?page='), page + 1, F.lit('"'))).otherwise(',"next":null'),
            F.lit("}")))
        .when(kind == 2, F.concat(
            items, F.lit(',"total":'), total, F.lit(',"skip":'), (page - 1) * PAGE_SIZE,
            F.lit(f',"limit":{PAGE_SIZE}}}')))
        .when(kind == 3, F.concat(items, F.lit(',"has_more":'), more.cast("string"), F.lit("}")))
        .otherwise(F.concat(items, F.lit("}")))
    )
    header = F.when(
        (kind == 1) & more,
        F.concat(
            F.lit('<https://api.example.org/>; rel="first", </v1/feed?page='), page + 1,
            F.lit('>; title="a, b; c"; REL="last next"'),
        ),
    )
    return page_chain_audit(as_pages(pages, body, url, header)).select(
        "run_id", "page_no", "link_kind", "next_url", "problem"
    )


# ---- hosts and names -------------------------------------------------------------------

ALLOWED = """
# hosts of the crawl
*.example.com

m.thther.example.org
HTTPS://Exact.example.net/Path
"""


@query("allowed_hosts", """
WITH h AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]*)', 1)) AS host FROM pages)
SELECT page_id, url, host LIKE '%.example.com' OR host = 'm.thther.example.org' AS allowed FROM h
UNION ALL
SELECT page_id, 'ftp' || regexp_replace(url, '^https?', ''), FALSE FROM h
UNION ALL
SELECT page_id, regexp_replace(url, '^(https?://)[^/?#]*', '\\1look-example.com'), FALSE FROM h
UNION ALL
SELECT page_id, regexp_replace(url, '^(https?://)[^/?#]*', '\\1user:pw@A.Example.COM:8443'), TRUE FROM h""")
def allowed_hosts(spark: SparkSession, folder: str) -> DataFrame:
    """Page addresses, and the same with other schemes, look-alike hosts, users and ports."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    variants = F.array(
        F.col("url"), F.concat(F.lit("ftp"), F.regexp_replace("url", "^https?", "")),
        F.regexp_replace("url", "^(https?://)[^/?#]*", "$1look-example.com"),
        F.regexp_replace("url", "^(https?://)[^/?#]*", "$1user:pw@A.Example.COM:8443"),
    )
    addresses = pages.select("page_id", F.explode(variants).alias("url"))
    return addresses.withColumn("allowed", is_allowed(F.col("url"), read_allowed(ALLOWED.splitlines())))


@query("normalized_names", """
WITH named AS (
  SELECT p_partkey || ' ' || p_brand || '  ' || upper(p_name) || '!' AS name FROM part
  UNION ALL SELECT url FROM pages UNION ALL SELECT text FROM documents),
cut AS (SELECT name, trim(regexp_replace(lower(name), '[^a-z0-9]+', '_', 'g'), '_') AS s,
               trim(regexp_replace(lower(name), '[^\\p{L}\\p{N}-]', '_', 'g'), '_') AS g FROM named)
SELECT name, left(CASE WHEN s = '' THEN 'col' WHEN regexp_matches(s, '^[0-9]') THEN 'c_' || s ELSE s END, 63)
         AS identifier,
       left(CASE WHEN g = '' THEN 'source' ELSE g END, 64) AS slug
FROM cut""")
def normalized_names(spark: SparkSession, folder: str) -> DataFrame:
    """Identifiers and file-name slugs of part names, addresses and whole texts."""
    named = (
        table(spark, folder, "part")
        .select(F.concat("p_partkey", F.lit(" "), "p_brand", F.lit("  "), F.upper("p_name"), F.lit("!")).alias("name"))
        .unionByName(table(spark, folder, "pages").select(F.col("url").alias("name")))
        .unionByName(table(spark, folder, "documents").select(F.col("text").alias("name")))
    )
    return named.select(
        "name", identifier_column(F.col("name")).alias("identifier"), source_slug(F.col("name")).alias("slug")
    )


# ---- manifests -------------------------------------------------------------------------

@query("manifest_validation", """
WITH d AS (
  SELECT doc_id, doc_id % 17 AS fault,
         'doc_' || doc_id || '.json' AS filename,
         CASE WHEN doc_id % 17 = 2 THEN '{' ELSE '' END || '{"id":' || doc_id || ',"text":' || to_json(text) || '}' AS content
  FROM documents)
SELECT filename,
  CASE WHEN fault <> 0 THEN strlen(content) END AS byte_size,
  CASE WHEN fault <> 0 THEN sha256(content) END AS sha256,
  CASE fault WHEN 0 THEN 'landing file not found' WHEN 1 THEN 'landing manifest not found'
    WHEN 2 THEN 'payload is not valid JSON' WHEN 3 THEN 'payload filename does not match'
    WHEN 4 THEN 'source does not match' WHEN 5 THEN 'run id does not match'
    WHEN 6 THEN 'load mode does not match' WHEN 7 THEN 'unsupported delete policy'
    WHEN 8 THEN 'delete policy does not match' WHEN 9 THEN 'checkpoint_before does not match'
    WHEN 10 THEN 'checkpoint_after does not match' WHEN 11 THEN 'pagination_complete does not match'
    WHEN 12 THEN 'checksum does not match' WHEN 13 THEN 'size does not match' END AS reject_reason
FROM d""")
def manifest_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Load requests against payloads and manifests, with one fault of each kind seeded in."""
    fault = F.col("doc_id") % 17
    landed = table(spark, folder, "documents").select(
        "doc_id", fault.alias("fault"), F.concat(F.lit("doc_"), "doc_id", F.lit(".json")).alias("filename"),
        F.concat(
            F.when(fault == 2, "{").otherwise(""), F.lit('{"id":'), "doc_id", F.lit(',"text":'),
            F.get(F.split(F.to_json(F.struct("text")), '^\\{"text":', 2), F.lit(1)),
        ).cast("binary").alias("content"),
    )

    def unless(number: int, wrong, right):
        return F.when(F.col("fault") == number, wrong).otherwise(right)

    requests = landed.select(
        "filename", F.lit("docs").alias("source"), unless(14, None, F.lit("7")).alias("run_id"),
        F.lit("full_snapshot").alias("load_mode"),
        F.when(F.col("fault") == 7, "drop").when(F.col("fault") == 15, None)
        .otherwise("close_on_full_snapshot").alias("delete_policy"),
        F.lit(None).cast("string").alias("checkpoint_before"), F.lit("2024-01-02").alias("checkpoint_after"),
        F.lit(True).alias("pagination_complete"),
    )
    payloads = inspect_content(landed.where("fault <> 0").select("filename", "content")).drop("content")
    manifests = landed.where("fault <> 1").select(
        manifest_name(F.col("filename")).alias("manifest_filename"),
        unless(3, "other.json", F.col("filename")).alias("payload_filename"),
        unless(4, "other", "docs").alias("source"),
        F.when(F.col("fault") == 5, "8").when(F.col("fault") == 14, None).otherwise("7").alias("run_id"),
        unless(6, "incremental_upsert", "full_snapshot").alias("load_mode"),
        unless(8, "never_close", "close_on_full_snapshot").alias("delete_policy"),
        unless(9, "2024-01-01", None).alias("checkpoint_before"),
        unless(10, None, "2024-01-02").alias("checkpoint_after"),
        unless(11, False, True).alias("pagination_complete"),
        unless(12, "0", F.sha2("content", 256)).alias("sha256"),
        F.when(F.col("fault") == 13, 1).when(F.col("fault") != 16, F.octet_length("content"))
        .cast("bigint").alias("byte_size"),
    )
    return validate_manifests(requests, payloads, manifests).select(
        "filename", "byte_size", "sha256", "reject_reason"
    )


@query("read_manifests", """
SELECT 'feed_' || user_id || '.manifest.json' AS manifest_filename, user_id % 7 = 0 AS is_corrupt,
       CASE WHEN user_id % 7 <> 0 THEN 'user ' || user_id END AS source, CASE WHEN user_id % 7 <> 0 THEN count(*) END AS byte_size
FROM events GROUP BY user_id""")
def manifests_read(spark: SparkSession, folder: str) -> DataFrame:
    """A manifest for each user's events, written and read back; every seventh is not JSON."""
    made = table(spark, folder, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    root = scratch_folder(spark)
    pack_manifests(made.select(
        F.concat(
            F.when(F.col("user_id") % 7 == 0, "{").otherwise(""),
            F.lit('{"source":"user '), "user_id", F.lit('","byte_size":'), "n", F.lit("}"),
        ).alias("value"),
        F.concat(F.lit("feed_"), "user_id", F.lit(MANIFEST_SUFFIX)).alias("manifest_filename"),
    ), root)
    return read_manifests(spark, root).select(
        "manifest_filename", F.col("_corrupt").isNotNull().alias("is_corrupt"), "source", "byte_size",
    )


@query("scan_masters", """
SELECT s_suppkey AS user_id, s_name AS username, n_name AS code, s_acctbal > 0 AS is_active
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def masters_scanned(spark: SparkSession, folder: str) -> DataFrame:
    """Departments and users written as files and scanned as masters."""
    root = scratch_folder(spark)
    table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("department_id"), F.col("n_name").alias("code"), F.col("n_name").alias("name"), "n_regionkey"
    ).write.parquet(f"{root}/departments")
    table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("username"), F.col("s_name").alias("full_name"),
        F.col("s_nationkey").alias("department_id"), (F.col("s_acctbal") > 0).alias("is_active"), "s_acctbal",
    ).write.parquet(f"{root}/users")
    departments, users = scan_masters(spark, f"{root}/departments", f"{root}/users", "parquet")
    return users.join(departments, "department_id").select("user_id", "username", "code", "is_active")
