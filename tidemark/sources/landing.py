"""Landed extracts: record files with their position, and a manifest written last."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.names import source_slug
from .manifests import MANIFEST_SCHEMA
from .payloads import scan_records

_PARTS = tuple(f"part_{n}" for n in range(4))


def _hashed(records: DataFrame) -> DataFrame:
    """Records with the size of their JSON and the parts of a hash of it and the position.

    The parts are columns: an aggregate would compute each of them more than once for a record.
    """
    sized = records.select("root_index", "rec", F.to_json("rec").alias("_json"))
    text = F.concat_ws(":", F.col("root_index").cast("string"), F.col("_json"))
    hashed = sized.select(
        "root_index", "rec", F.octet_length("_json").alias("_size"), F.sha2(text.cast("binary"), 256).alias("_digest")
    )
    return hashed.select("root_index", "rec", "_size", *[
        F.conv(F.substring("_digest", 1 + 15 * n, 15), 16, 10).cast("bigint").alias(name)
        for n, name in enumerate(_PARTS)
    ])


def _totals() -> list[Column]:
    """Aggregates over the hashed records: the hashes are combined by exclusive or, so in any order."""
    parts = [F.bit_xor(name).alias(name) for name in _PARTS]
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("_size"), F.lit(0)).alias("bytes"), *parts]


def _combined(facts: Mapping[str, int]) -> tuple[int, int, str]:
    whole = ":".join(str(facts[name]) for name in ("rows", "bytes", *_PARTS))
    return facts["rows"], facts["bytes"], hashlib.sha256(whole.encode()).hexdigest()


def content_digest(records: DataFrame) -> tuple[int, int, str]:
    """Rows, JSON bytes and a SHA-256 that depends on every record and its position.

    One aggregation whose partial results are one row per task, with nothing moved.
    """
    return _combined(_hashed(records).agg(*_totals()).first().asDict())


def landing_name(spark: SparkSession, source: str) -> str:
    """Fresh name ``<slug>_<UTC milliseconds>_<uuid>`` of an extract."""
    slug = spark.range(1).select(source_slug(F.lit(source))).first()[0]
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")[:-3] + "Z"
    return f"{slug}_{stamp}_{uuid.uuid4()}.json"


def write_landing(
    records: DataFrame, folder: str, source: str, manifest: dict, filename: str | None = None,
) -> dict:
    """Write ``(root_index, rec)`` below ``folder`` and publish it with a manifest.

    Records are parsed once and stay VARIANT, which also keeps ``1.0`` apart from ``1``.
    The payload goes to its own fresh directory; an extract exists once its manifest does.
    Size and checksum are observed by the tasks that write, so nothing is read again.
    """
    spark = records.sparkSession
    filename = filename or landing_name(spark, source)
    path = f"{folder}/{filename}"
    seen = Observation()
    _hashed(records).observe(seen, *_totals()).select("root_index", "rec").write.parquet(path)
    rows, byte_size, digest = _combined(seen.get)
    complete = {
        "manifest_version": 1, "status": "extracted", "source": source,
        "fetched_at": datetime.now(timezone.utc).isoformat(), "http_status": 200,
        "content_type": "application/json", **manifest,
        "byte_size": byte_size, "sha256": digest, "payload_filename": filename,
    }
    row = {name: complete.get(name) for name in MANIFEST_SCHEMA.names}
    manifests = spark.createDataFrame([row], MANIFEST_SCHEMA)
    manifests.coalesce(1).write.option("ignoreNullFields", False).json(
        f"{folder}/{filename.rsplit('.', 1)[0]}.manifest.json"
    )
    return {**row, "rows": rows}


def inspect_landing(spark: SparkSession, folder: str, filename: str) -> DataFrame:
    """Size and checksum of a landed extract, in the form the manifest checks expect."""
    written = scan_records(spark, f"{folder}/{filename}")
    _, byte_size, digest = content_digest(written)
    return spark.createDataFrame(
        [(filename, True, byte_size, digest)],
        "filename STRING, is_json BOOLEAN, byte_size BIGINT, sha256 STRING",
    )


def read_manifest(spark: SparkSession, folder: str, filename: str) -> DataFrame:
    """Manifest of one landed extract."""
    name = filename.rsplit(".", 1)[0] + ".manifest.json"
    return (
        spark.read.schema(MANIFEST_SCHEMA).json(f"{folder}/{name}")
        .withColumn("manifest_filename", F.lit(name))
    )
