"""Manifests of landed extracts and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..options import CLOSE_ON_FULL_SNAPSHOT, DELETE_POLICIES, FULL_SNAPSHOT

# Fields of a manifest.
MANIFEST_SCHEMA = T.StructType([
    T.StructField("manifest_version", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("load_mode", T.StringType()),
    T.StructField("delete_policy", T.StringType()),
    T.StructField("checkpoint_before", T.StringType()),
    T.StructField("checkpoint_after", T.StringType()),
    T.StructField("pagination_complete", T.BooleanType()),
    T.StructField("requested_url", T.StringType()),
    T.StructField("final_url", T.StringType()),
    T.StructField("fetched_at", T.StringType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("byte_size", T.LongType()),
    T.StructField("sha256", T.StringType()),
    T.StructField("payload_filename", T.StringType()),
])
MANIFEST_SUFFIX = ".manifest.json"
#: Folder of manifests that lie many in a file, below the one of the others.
PACKED = "_manifests"


def manifest_name(filename: Column) -> Column:
    return F.concat(F.regexp_replace(filename, r"\.[^.]*$", ""), F.lit(MANIFEST_SUFFIX))


def pack_manifests(manifests: DataFrame, path: str) -> None:
    """Write manifests (``manifest_filename, value``) to a folder, many in a file.

    A file of its own takes longer to make than a manifest to write, so a folder with very many holds them
    packed; one without a name is none. :func:`read_manifests` reads both kinds.
    """
    named = manifests.select("manifest_filename", "value").where("manifest_filename IS NOT NULL")
    named.write.mode("append").parquet(f"{path}/{PACKED}")


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """All manifests in a folder, each a file or packed; one that is not JSON has ``_corrupt`` set."""
    schema = T.StructType([*MANIFEST_SCHEMA.fields, T.StructField("_corrupt", T.StringType())])
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{PACKED}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return _read_files(spark, path, schema)
    packed = _read_packed(spark, path, schema)
    alone = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*{MANIFEST_SUFFIX}")
    if not alone.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(alone):
        return packed
    return packed.unionByName(_read_files(spark, path, schema))


def _read_packed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    rows = spark.read.schema("manifest_filename STRING, value STRING").parquet(f"{path}/{PACKED}")
    parsed = rows.select(
        "manifest_filename", "value",
        F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt"}).alias("m"),
    )
    # A text without any JSON in it is parsed as nothing.
    empty = F.when(F.col("m").isNull() | (F.trim("value") == ""), F.coalesce("value", F.lit("")))
    return parsed.select(
        *[F.col(f"m.{name}") for name in MANIFEST_SCHEMA.names],
        F.coalesce("m._corrupt", empty).alias("_corrupt"), "manifest_filename",
    )


def _read_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    manifests = (
        spark.read.schema(schema).option("multiLine", True)
        .option("columnNameOfCorruptRecord", "_corrupt").json(f"{path}/*{MANIFEST_SUFFIX}")
    )
    # A manifest is a file, or a directory of one file when Spark wrote it.
    name = F.regexp_extract(F.url_decode("_metadata.file_path"), r"([^/]+\.manifest\.json)", 1)
    return manifests.withColumn("manifest_filename", name)


def validate_manifests(requests: DataFrame, payloads: DataFrame, manifests: DataFrame) -> DataFrame:
    """Check load requests against payloads and manifests.

    ``requests`` has ``filename`` and what the caller expects; ``payloads`` is the result of
    inspecting the files; ``manifests`` has ``manifest_filename``. Adds ``reject_reason``, the
    first check that fails, NULL for accepted requests. A source or run id the request does
    not name is not checked.
    """
    found = payloads.select(
        "filename", "is_json", "byte_size", "sha256", F.lit(True).alias("_landed"),
    )
    manifest_fields = [name for name in manifests.columns if name != "manifest_filename"]
    described = manifests.select(
        F.col("manifest_filename").alias("_manifest_name"), F.struct(*manifest_fields).alias("m"),
    )
    joined = (
        requests.withColumn("_manifest_name", manifest_name(F.col("filename")))
        .join(found, "filename", "left").join(described, "_manifest_name", "left")
    )
    field = {name: F.col(f"m.{name}") for name in manifest_fields}
    corrupt = field["_corrupt"].isNotNull() if "_corrupt" in field else F.lit(False)
    manifest_mode = F.coalesce(field["load_mode"], F.lit(FULL_SNAPSHOT))
    manifest_policy = F.coalesce(field["delete_policy"], F.lit(CLOSE_ON_FULL_SNAPSHOT))
    policy = F.coalesce("delete_policy", field["delete_policy"], F.lit(CLOSE_ON_FULL_SNAPSHOT))
    manifest_complete = F.coalesce(field["pagination_complete"], F.lit(True))

    def asked(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) != ""

    checks = [
        (F.col("filename").contains("/"), "invalid landing filename"),
        (F.col("_landed").isNull(), "landing file not found"),
        (F.col("m").isNull(), "landing manifest not found"),
        (~F.col("is_json"), "payload is not valid JSON"),
        (corrupt, "manifest is not valid JSON"),
        (~field["payload_filename"].eqNullSafe(F.col("filename")), "payload filename does not match"),
        (asked("source") & ~field["source"].eqNullSafe(F.col("source")), "source does not match"),
        (asked("run_id") & ~field["run_id"].eqNullSafe(F.col("run_id")), "run id does not match"),
        (manifest_mode != F.col("load_mode"), "load mode does not match"),
        (~policy.isin(*DELETE_POLICIES), "unsupported delete policy"),
        (manifest_policy != policy, "delete policy does not match"),
        (~field["checkpoint_before"].eqNullSafe(F.col("checkpoint_before")), "checkpoint_before does not match"),
        (~field["checkpoint_after"].eqNullSafe(F.col("checkpoint_after")), "checkpoint_after does not match"),
        (manifest_complete != F.col("pagination_complete"), "pagination_complete does not match"),
        (~field["sha256"].eqNullSafe(F.col("sha256")), "checksum does not match"),
        (
            field["byte_size"].isNotNull() & (field["byte_size"] != F.col("byte_size")),
            "size does not match",
        ),
    ]
    reason = F.coalesce(*[F.when(failed, message) for failed, message in checks])
    return joined.select(
        *requests.columns, "byte_size", "sha256", "m", reason.alias("reject_reason")
    )
