"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings; the last of repeated JSON keys counts, zones are UTC.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that exists."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: int | str = "*", memory: str = "16g", name: str = "tidemark") -> SparkSession:
    """Local session for tests and measurements."""
    partitions = 8 if cpus == "*" else cpus
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    settings = {
        **RUNTIME_SETTINGS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": memory,
        # Expressions are built faster when the call site of each is not recorded.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors share.

    It is the one the cluster names in ``spark.checkpoint.dir``, else the context's checkpoint
    folder, else a folder below the warehouse. Only a session whose tasks all run in this process
    may fall back on a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        own = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(own)
        return own
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_folder(spark: SparkSession) -> str:
    """Fresh folder below the shared one."""
    return f"{shared_folder(spark)}/tidemark-{uuid.uuid4().hex}"
