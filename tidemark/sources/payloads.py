"""JSON documents as rows of ``(root_index, rec)``, and what is known about their files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.variants import get, kind
from .arrays import scan_arrays, starts_with_array

# Envelope keys of paged sources, in the order they are looked up.
COLLECTION_KEYS = ("results", "items", "records", "products", "data")
ENVELOPE_KEYS = ("total", "skip", "offset", "limit", "has_more", "next", "next_cursor", "nextCursor")


def first_collection(body: Column) -> Column:
    """Name of the first common collection key that holds an array."""
    return F.coalesce(*[
        F.when(get(body, (key,), "array<variant>").isNotNull(), key) for key in COLLECTION_KEYS
    ])


def envelope_key(body: Column) -> Column:
    """Collection of a recognised envelope, NULL when the document is not one."""
    is_envelope = F.lit(False)
    for key in ENVELOPE_KEYS:
        is_envelope = is_envelope | get(body, (key,)).isNotNull()
    return F.when(is_envelope, first_collection(body))


def collection(body: Column, key: Column) -> Column:
    """Array under one of the common collection keys."""
    return F.coalesce(*[
        F.when(key == name, get(body, (name,), "array<variant>")) for name in COLLECTION_KEYS
    ])


def records_of(body: Column) -> Column:
    """Records of a document: a root array, an envelope's collection, or the document itself."""
    return F.coalesce(
        get(body, (), "array<variant>"), collection(body, envelope_key(body)), F.array(body),
    )


def unwrap(documents: DataFrame, body: str = "body") -> DataFrame:
    """One row per record of every document, with its position; other columns are kept."""
    kept = [name for name in documents.columns if name != body]
    return documents.select(
        *kept, F.posexplode(records_of(F.col(body))).alias("position", "rec")
    ).select(*kept, F.col("position").cast("bigint").alias("root_index"), "rec")


def scan_document(spark: SparkSession, path: str) -> DataFrame:
    """Records of one JSON document. An array may have any size; an envelope is one row of one task."""
    if starts_with_array(spark, path):
        return scan_arrays(spark, path).select("root_index", "rec")
    documents = spark.read.option("wholetext", True).text(path)
    return unwrap(documents.select(F.parse_json("value").alias("body")))


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of an extract that Spark landed: splittable rows with their position."""
    return spark.read.schema("root_index BIGINT, rec VARIANT").parquet(path)


def inspect_content(documents: DataFrame, content: str = "content") -> DataFrame:
    """Add validity, root type, collection, size and SHA-256 of a binary document column."""
    text = F.try_validate_utf8(F.col(content).cast("string"))
    body = F.try_parse_json(text)
    root = kind(F.col("_body"))
    return (
        documents.withColumn("_body", body)
        .withColumns({
            "is_json": F.col("_body").isNotNull(),
            "root_type": F.when(root.isin("object", "array"), root)
            .when(F.col("_body").isNotNull(), "scalar"),
            "collection_key": F.when(root == "object", envelope_key(F.col("_body"))),
            "byte_size": F.octet_length(content).cast("bigint"),
            "sha256": F.sha2(content, 256),
        })
        .drop("_body")
    )


def inspect_files(spark: SparkSession, path: str) -> DataFrame:
    """:func:`inspect_content` of every document file below a path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
    files = files.where(~F.col("path").endswith(".manifest.json")).select(
        F.element_at(F.split("path", "/"), -1).alias("filename"), "content"
    )
    return inspect_content(files).drop("content")
