"""A warehouse in a shared folder: staging, dimensions, marts and ledgers as Parquet.

Every step writes to a path nobody reads yet and becomes visible by one small append: a
batch by its ledger row, a set of dimension versions and a set of mart versions by their
pointer rows. A step that is lost and repeated writes the same path again.

A dimension is laid out in hash buckets of the business key, and each bucket's current rows are
in the version that wrote it last. A merge looks at keys and hashes only, and writes the buckets
in which something changes; all others stay the files they are. When a dimension has outgrown its
buckets, the next merge that changes it writes all of them, more and smaller ones. A mart is a
pointer to a version of a dimension, whose files are read through a projection, so publishing
writes no rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import reduce
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names
from ..operators.flatten import SPARK_TYPES, Flattened, Types
from ..operators.history import (
    FEW, Store, after_closing, current_versions, decide, empty_dimension, evolve_dimension, opened_versions,
    repeats, sent_keys, surrogate_key,
)
from ..operators.ledger import RUN_FIELDS, run_states, source_report
from ..operators.marts import project_mart
from ..options import CLOSE_ON_FULL_SNAPSHOT, FULL_SNAPSHOT, SourceConfig, check_options

# Columns of the ledgers.
LEDGER = (
    "id BIGINT, loaded_at TIMESTAMP, filename STRING, source STRING, source_url STRING, "
    "payload_filename STRING, payload_sha256 STRING, payload_size BIGINT, run_id STRING, "
    "load_mode STRING, delete_policy STRING, checkpoint_before STRING, checkpoint_after STRING, "
    "pagination_complete BOOLEAN, table_names ARRAY<STRING>, "
    "table_facts MAP<STRING, STRUCT<rows: BIGINT, parented: BIGINT>>"
)
COLUMNS = "batch_id BIGINT, filename STRING, table STRING, ordinal INT, column STRING, type STRING"
VERSIONS = (
    "name STRING, version BIGINT, columns STRING, current_rows BIGINT, inserted_rows BIGINT, "
    "closed_rows BIGINT, at TIMESTAMP, buckets INT, layout BIGINT, written ARRAY<STRUCT<bucket: INT, rows: BIGINT>>"
)
MARTS = "dim_table STRING, mart_table STRING, version BIGINT, row_count BIGINT, at TIMESTAMP"
RUN_EVENTS = "run_id BIGINT, seq BIGINT, at TIMESTAMP, source STRING, " + ", ".join(
    f"{name} STRING" for name in RUN_FIELDS
)
CHECKPOINTS = "source STRING, seq BIGINT, run_id BIGINT, checkpoint STRING, settings STRING"
SOURCES = "name STRING, seq BIGINT, settings STRING"

WRITERS = 4
#: Current rows for which a dimension has one bucket, and the most buckets of a dimension.
BUCKET_ROWS, MOST_BUCKETS = 500_000, 1 << 16
#: Folder of closed rows, next to those of the buckets.
CLOSED_BUCKET = -1
#: Files of a log from which on they are written as one.
COMPACT = 64
_Item = TypeVar("_Item")
_Result = TypeVar("_Result")


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whichever file system it names."""
    location, files = _file_system(spark, path)
    return files.exists(location)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder, none when it is not there."""
    location, files = _file_system(spark, path)
    return sorted(item.getPath().getName() for item in files.listStatus(location)) if files.exists(location) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder that this warehouse wrote and nobody reads any more."""
    location, files = _file_system(spark, path)
    files.delete(location, True)


def read_text(spark: SparkSession, path: str) -> str:
    location, files = _file_system(spark, path)
    stream = files.open(location)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there as a whole or not at all."""
    folder, name = path.rsplit("/", 1)
    part, files = _file_system(spark, f"{folder}/.{name}")
    stream = files.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not files.rename(part, spark._jvm.org.apache.hadoop.fs.Path(path)):
        raise OSError(f"cannot write {path}")


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file if it is not there; of several that try, one succeeds."""
    location, files = _file_system(spark, path)
    files.mkdirs(location.getParent())
    if files.getScheme() == "file":
        return spark._jvm.java.io.File(location.toUri().getPath()).createNewFile()
    return files.createNewFile(location)


def at_once(task: Callable[[_Item], _Result], items: Iterable[_Item]) -> list[_Result]:
    """Submit independent Spark jobs together."""
    with ThreadPoolExecutor(max_workers=WRITERS) as pool:
        return list(pool.map(task, items))


class Warehouse:
    """Tables below one root folder. Runs of different sources may write at once, of one source in order."""

    def __init__(self, spark: SparkSession, root: str, bucket_rows: int = BUCKET_ROWS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.bucket_rows = bucket_rows

    # ---- small append-only tables ------------------------------------------------------

    def _path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def _log_files(self, name: str) -> list[str]:
        """Files of a log: the newest snapshot and what was appended since."""
        folder = self._path("logs", name)
        found = names_in(self.spark, folder)
        snapshots = [item for item in found if item.endswith(".included")]
        files = {item for item in found if item.endswith(".json") and not item.startswith(".")}
        if not snapshots:
            return sorted(f"{folder}/{item}" for item in files)
        newest = snapshots[-1]
        files -= set(read_text(self.spark, f"{folder}/{newest}").split())
        return [f"{folder}/{newest.removesuffix('.included')}", *sorted(f"{folder}/{item}" for item in files)]

    def _read_log(self, name: str, schema: str) -> DataFrame:
        files = self._log_files(name)
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).json(files)

    def _append_log(self, name: str, schema: str, rows: list[dict]) -> None:
        """Append rows in a file of their own; writers do not meet."""
        fields = T.StructType.fromDDL(schema).names
        lines = [
            json.dumps({field: row.get(field) for field in fields}, default=lambda moment: moment.isoformat()) for row in rows
        ]
        stamp = f"{int(_now().timestamp() * 1_000_000):020d}-{uuid.uuid4().hex}"
        write_text(self.spark, self._path("logs", name, f"{stamp}.json"), "\n".join(lines) + "\n")
        self.compact_log(name, schema)

    def compact_log(self, name: str, schema: str, least: int = COMPACT) -> None:
        """Write a log of many files as one numbered snapshot, which counts once its list of files is there.

        Files go when the snapshot before held them already, so a reader that listed them still finds them,
        and of two snapshots made at once either may count.
        """
        folder, files = self._path("logs", name), self._log_files(name)
        if len(files) < least:
            return
        found = names_in(self.spark, folder)
        before = [item for item in found if item.endswith(".included")]
        number = 1 + int(before[-1].split(".")[0].removeprefix("snapshot-")) if before else 1
        number = self.claim(f"snapshots/{name}", number)
        snapshot = f"{folder}/snapshot-{number:012d}"
        rows = self.spark.read.schema(schema).json(files).coalesce(1)
        rows.write.mode("overwrite").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(snapshot)
        held = set(read_text(self.spark, f"{folder}/{before[-1]}").split()) if before else set()
        included = held | {file.rsplit("/", 1)[1] for file in files if file.endswith(".json")}
        write_text(self.spark, f"{snapshot}.included", "\n".join(sorted(included & set(found))))
        for item in sorted(held & set(found)):
            remove_path(self.spark, f"{folder}/{item}")
        for item in before[:-1]:
            remove_path(self.spark, f"{folder}/{item.removesuffix('.included')}")
            remove_path(self.spark, f"{folder}/{item}")

    def claim(self, kind: str, first: int) -> int:
        """Take the first free number from ``first`` on; no two writers get the same one."""
        number = first
        while not create_new(self.spark, self._claim_path(kind, number)):
            number += 1
        return number

    def release(self, kind: str, number: int) -> None:
        """Give a claimed number back that came to nothing."""
        remove_path(self.spark, self._claim_path(kind, number))

    def _claim_path(self, kind: str, number: int) -> str:
        return self._path("claims", kind, f"{number:012d}")

    @property
    def ledger(self) -> DataFrame:
        """Loaded batches; a batch that is not listed does not exist."""
        return self._read_log("raw_batches", LEDGER)

    # ---- staging -----------------------------------------------------------------------

    def staged_types(self) -> Types:
        """Columns of the staged tables, in the order they were added.

        What an attempt noted that never reached the ledger does not count.
        """
        loaded = self.ledger.select(F.col("id").alias("batch_id"), "filename")
        rows = (
            self._read_log("staging_columns", COLUMNS).join(loaded, ["batch_id", "filename"], "left_semi")
            .distinct().orderBy("batch_id", "table", "ordinal").collect()
        )
        types: Types = {}
        for row in rows:
            columns = types.setdefault(row["table"], {})
            if row["column"] is not None:
                columns.setdefault(row["column"], row["type"])
        return types

    def find_batch(self, filename: str):
        """Ledger row of a landed file, None when it was not loaded."""
        return self.ledger.where(F.col("filename") == filename).first()

    def next_batch_id(self) -> int:
        """A batch id that no other writer gets; :meth:`release` gives one back that was not used."""
        return self.claim("batches", (self.ledger.agg(F.max("id")).first()[0] or 0) + 1)

    def append_batch(self, batch_id: int, batch: Flattened, known: Types, entry: dict) -> dict[str, int]:
        """Write all tables of a batch, then its columns, then its ledger row."""
        def write(table: str) -> tuple[int, int]:
            seen = Observation()
            (
                batch.tables[table].drop("_source_batch_id")
                .observe(seen, F.count(F.lit(1)).alias("rows"), F.count("_parent_key").alias("parented"))
                .write.mode("overwrite").parquet(self._staged_path(table, batch_id))
            )
            return seen.get["rows"], seen.get["parented"]

        tables = sorted(batch.tables)
        facts = dict(zip(tables, at_once(write, tables)))
        added = []
        for table in tables:
            old = known.get(table)
            new = [c for c in batch.types[table] if c not in (old or {})]
            if old is None:
                added.append({"table": table, "ordinal": -1})
            added += [
                {"table": table, "ordinal": n, "column": c, "type": batch.types[table][c]}
                for n, c in enumerate(new)
            ]
        if added:
            self._append_log("staging_columns", COLUMNS, [
                {"batch_id": batch_id, "filename": entry["filename"], **row} for row in added
            ])
        self._append_log("raw_batches", LEDGER, [
            {
                **entry, "id": batch_id, "loaded_at": _now(), "table_names": tables,
                "table_facts": {table: {"rows": rows, "parented": parented} for table, (rows, parented) in facts.items()},
            }
        ])
        return {table: rows for table, (rows, _) in facts.items()}

    def _staged_path(self, table: str, batch_id: int) -> str:
        return self._path("staging", table, f"_source_batch_id={batch_id}")

    def staged_batch(self, table: str, batch_id: int, columns: dict[str, str], written: bool) -> DataFrame:
        """Rows one batch added to a staged table, with all columns the table has now."""
        schema = T.StructType(
            [T.StructField(name, T.StringType()) for name in ("_row_id", "_parent_id", "_parent_key")]
            + [T.StructField("_row_index", T.LongType())]
            + [T.StructField(name, SPARK_TYPES[dtype]) for name, dtype in columns.items()]
        )
        if written:
            rows = self.spark.read.schema(schema).parquet(self._staged_path(table, batch_id))
        else:
            rows = self.spark.createDataFrame([], schema)
        return rows.select(
            "_row_id", F.lit(batch_id).cast("bigint").alias("_source_batch_id"), "_parent_id",
            "_parent_key", "_row_index", *[F.col(f"`{name}`") for name in columns],
        )

    # ---- dimensions --------------------------------------------------------------------

    def _versions(self) -> DataFrame:
        return self._read_log("dimension_versions", VERSIONS)

    def dimension_states(self, upto: dict[str, int] | None = None, names_only: set[str] | None = None) -> dict[str, dict]:
        """Newest committed version of every dimension, or one not newer than ``upto`` says for its name.

        ``parts`` has for each version that still holds current rows its buckets with their numbers of
        rows, ``closed`` the versions that closed rows.
        """
        log = self._versions()
        if names_only is not None:
            log = log.where(F.col("name").isin(*names_only))
        if upto is not None:
            allowed = [(F.col("name") == name) & (F.col("version") <= version) for name, version in upto.items()]
            log = log.where(reduce(lambda x, y: x | y, allowed, F.lit(False)))
        # An attempt that was lost after its append and repeated has written the same version again.
        log = log.groupBy("name", "version").agg(F.max_by(F.struct(*log.drop("name", "version").columns), "at").alias("v"))
        log = log.select("name", "version", "v.*")
        rows = log.groupBy("name").agg(
            F.max(F.struct("version", "columns", "current_rows", "buckets", "layout")).alias("last"),
            F.collect_set(F.when(F.col("closed_rows") > 0, F.col("version"))).alias("closed"),
        ).collect()
        states = {
            row["name"]: {**row["last"].asDict(), "closed": sorted(row["closed"]), "parts": {}} for row in rows
        }
        # Buckets of an earlier layout do not count any more.
        last = F.max("layout").over(Window.partitionBy("name"))
        parts = (
            log.withColumn("last", last).where("layout = last").select("name", "version", F.inline("written"))
            .groupBy("name", "bucket").agg(F.max(F.struct("version", "rows")).alias("at"))
            .where("at.rows > 0").select("name", "bucket", "at.version", "at.rows").collect()
        )
        for row in parts:
            states[row["name"]]["parts"].setdefault(row["version"], {})[row["bucket"]] = row["rows"]
        return states

    def dimension(self, name: str, states: dict[str, dict] | None = None) -> DataFrame | None:
        """All versions of a dimension, None when it does not exist."""
        state = (self.dimension_states(names_only={name}) if states is None else states).get(name)
        if state is None:
            return None
        schema = T.StructType.fromJson(json.loads(state["columns"]))
        parts = [self.current(name, state).drop("_bucket")]
        if state["closed"]:
            paths = [self._rows_path(name, version, False) for version in state["closed"]]
            parts.append(self._read_rows(name, schema, paths, False).drop("_bucket"))
        return reduce(DataFrame.unionByName, parts)

    def current(self, name: str, state: dict, buckets: Iterable[int] | None = None) -> DataFrame:
        """Current rows of a dimension, of all buckets or some, with their ``_bucket``."""
        schema = T.StructType.fromJson(json.loads(state["columns"]))
        wanted = None if buckets is None else set(buckets)
        paths = []
        for version, held in sorted(state["parts"].items()):
            root = self._rows_path(name, version, True)
            paths += [f"{root}/_bucket={bucket}" for bucket in sorted(held) if wanted is None or bucket in wanted]
        return self._read_rows(name, schema, paths, True)

    def _rows_path(self, name: str, version: int, current: bool) -> str:
        # Names that no column of a dimension can have.
        return self._path("core", name, f"_version={version}", f"_current={str(current).lower()}")

    def _read_rows(self, name: str, schema: T.StructType, paths: list[str], current: bool) -> DataFrame:
        held = T.StructType([item for item in schema if item.name != "is_current"] + [T.StructField("_bucket", T.IntegerType())])
        if not paths:
            rows = self.spark.createDataFrame([], held)
        else:
            rows = self.spark.read.schema(held).option("basePath", self._path("core", name)).parquet(*paths)
        return rows.withColumn("is_current", F.lit(current)).select(*schema.names, "_bucket")

    def _buckets_for(self, rows: int) -> int:
        """Power of two of buckets that so many rows need."""
        wanted = max(1, -(-rows // self.bucket_rows))
        return min(MOST_BUCKETS, 1 << (wanted - 1).bit_length())

    @staticmethod
    def _bucket(buckets: int, key: Column | None = None, surrogate: Column | None = None) -> Column:
        """Bucket of a row; rows without a key, which match nothing, are spread."""
        key, surrogate = (F.col("_business_key"), F.col("_sk")) if key is None else (key, surrogate)
        return F.pmod(F.xxhash64(F.coalesce(key, surrogate)), F.lit(buckets)).cast("int")

    def _write_version(self, name: str, version: int, rows: DataFrame) -> None:
        """Write versions by bucket; what is closed lies together."""
        (
            # One task writes a bucket, so buckets stay few files however often they are written.
            rows.repartition("_bucket")
            .withColumn("_bucket", F.when(F.col("is_current"), F.col("_bucket")).otherwise(F.lit(CLOSED_BUCKET)))
            .withColumnRenamed("is_current", "_current")
            .write.mode("overwrite").partitionBy("_current", "_bucket")
            .parquet(self._path("core", name, f"_version={version}"))
        )

    def merge_batches(
        self, batches: dict[str, DataFrame], load_mode: str, delete_policy: str, effective_at: datetime,
        states: dict[str, dict],
    ) -> dict[str, dict]:
        """Merge keyed batches into their dimensions, by dimension name, and make all of them current at once.

        Batches carry ``_business_key`` and ``_content_hash``. Returns the newest version of each dimension
        with the rows that this merge inserted and closed; one in which nothing changes gets no new version.
        """
        check_options(load_mode, delete_policy)
        closes_missing = load_mode == FULL_SNAPSHOT and delete_policy == CLOSE_ON_FULL_SNAPSHOT

        def write(name: str) -> dict:
            if name not in states:
                return self._first_version(name, batches[name], effective_at)
            return self._next_version(name, batches[name], states[name], closes_missing, effective_at)

        rows = at_once(write, sorted(batches))
        new = [row for row in rows if row.pop("is_new")]
        if new:
            self._append_log("dimension_versions", VERSIONS, [
                {**row, "written": [{"bucket": b, "rows": n} for b, n in sorted(row["written"].items())]} for row in new
            ])
        return {row["name"]: row for row in rows}

    def _first_version(self, name: str, batch: DataFrame, at: datetime) -> dict:
        rows = batch.drop("_business_key", "_content_hash")
        schema = empty_dimension(self.spark, rows).schema
        types = {item.name: item.dataType for item in schema}
        buckets = self._buckets_for(rows.count())
        work = self._work_path(name)
        # Rows whose key is alone in the batch are not ordered: they move once, to their bucket.
        found = repeats(batch, self._stored_at(f"{work}/repeated"))
        opened = opened_versions(batch, schema.names, types, F.lit(at), repeated=found).drop("_change")
        self._write_version(name, 1, opened.withColumn("_bucket", self._bucket(buckets)))
        remove_path(self.spark, work)
        state = {"version": 1, "columns": schema.json(), "buckets": buckets, "layout": 1}
        written = self._count_written(name, 1)
        total = sum(written.values())
        return {
            **state, "name": name, "current_rows": total, "inserted_rows": total, "closed_rows": 0, "at": _now(),
            "written": written, "is_new": True,
        }

    def _work_path(self, name: str) -> str:
        return self._path("work", f"{name}-{uuid.uuid4().hex}")

    def _stored_at(self, path: str) -> Store:
        """What writes rows to a path and reads them back."""
        def store(rows: DataFrame) -> DataFrame:
            rows.write.parquet(path)
            return self.spark.read.schema(rows.schema).parquet(path)

        return store

    def _count_written(self, name: str, version: int) -> dict[int, int]:
        """Current rows of each bucket that a version wrote; Parquet footers have the numbers."""
        path = self._rows_path(name, version, True)
        if not path_exists(self.spark, path):
            return {}
        rows = self.spark.read.schema("_sk STRING, _bucket INT").parquet(path)
        return {row["_bucket"]: row["count"] for row in rows.groupBy("_bucket").count().collect()}

    def _next_version(self, name: str, batch: DataFrame, state: dict, closes_missing: bool, at: datetime) -> dict:
        version, buckets = state["version"] + 1, state["buckets"]
        work = self._work_path(name)
        now = F.lit(at)
        dimension = empty_dimension(self.spark, batch.drop("_business_key", "_content_hash"))
        schema = evolve_dimension(
            self.spark.createDataFrame([], T.StructType.fromJson(json.loads(state["columns"]))), dimension
        ).schema
        types = {item.name: item.dataType for item in schema}
        # Keys and hashes of the batch are computed once.
        key = F.when(F.col("_join_key").startswith("k"), F.substr("_join_key", F.lit(2)))
        place = self._bucket(buckets, key, surrogate_key(key, now))
        found = repeats(batch, self._stored_at(f"{work}/repeated"))
        sent_keys(batch, found).withColumn("_sent_bucket", place).write.parquet(f"{work}/sent")
        sent = self.spark.read.schema("_join_key STRING, _new_hash BINARY, _row STRING, _sent_bucket INT").parquet(f"{work}/sent")
        met = None if closes_missing else [row[0] for row in sent.select("_sent_bucket").distinct().collect()]
        current = current_versions(self.current(name, state, met))
        opening_bucket = F.coalesce("_bucket", "_sent_bucket").alias("_bucket")
        decided = decide(current, sent, closes_missing, "_bucket", sent_columns=("_sent_bucket",))
        decided.select("_join_key", "_row", "_closes", "_opens", opening_bucket).write.parquet(f"{work}/decided")
        decided = self.spark.read.schema(
            "_join_key STRING, _row STRING, _closes BOOLEAN, _opens BOOLEAN, _bucket INT"
        ).parquet(f"{work}/decided")
        changed = {
            row["_bucket"]: (row["opened"], row["closed"])
            for row in decided.groupBy("_bucket").agg(
                F.count_if("_opens").alias("opened"), F.count_if("_closes").alias("closed")
            ).collect()
        }
        opened, closed = (sum(pair[place] for pair in changed.values()) for place in (0, 1))
        held = {b: rows for part in state["parts"].values() for b, rows in part.items()}
        total = sum(held.values()) + opened - closed
        entry = {
            "name": name, "version": version, "columns": schema.json(), "current_rows": total, "inserted_rows": opened,
            "closed_rows": closed, "at": _now(), "buckets": buckets, "layout": state["layout"],
            "is_new": bool(changed) or schema.json() != state["columns"],
            "written": {b: held.get(b, 0) + pair[0] - pair[1] for b, pair in changed.items()},
        }
        if not entry["is_new"]:
            entry["version"] = state["version"]
        if changed:
            # Outgrown buckets are written anew, all of them, and then are more.
            outgrown = total > 2 * buckets * self.bucket_rows and buckets < MOST_BUCKETS
            # Where nothing closes, what opens had no current row; as many as were sent means all of them.
            every = closed == 0 and (found is None or found.count == 0) and opened == batch.count()
            own = evolve_dimension(self.current(name, state, None if outgrown else changed), dimension)
            rows = after_closing(
                current_versions(own), decided, [*schema.names, "_bucket"], closes_missing, now, closed <= FEW
            )
            new = opened_versions(
                batch, schema.names, types, now, None if every else decided, opened <= FEW, repeated=found
            )
            if outgrown:
                entry["buckets"], entry["layout"] = self._buckets_for(total), version
            place = self._bucket(entry["buckets"])
            rows = (rows.withColumn("_bucket", place) if outgrown else rows).unionByName(new.withColumn("_bucket", place))
            self._write_version(name, version, rows.drop("_change"))
            if outgrown:
                entry["written"] = self._count_written(name, version)
        remove_path(self.spark, work)
        return entry

    # ---- marts -------------------------------------------------------------------------

    def refresh_marts(self) -> list[dict]:
        """Publish the newest version of every dimension that moved, by a pointer.

        Returns every dimension with its mart and row count, published now or before.
        """
        states = self.dimension_states()
        marts = self._read_log("mart_versions", MARTS)
        published = {
            row["dim_table"]: row["last"]
            for row in marts.groupBy("dim_table").agg(
                F.max(F.struct("version", "mart_table", "row_count")).alias("last")
            ).collect()
        }
        new = []
        for name in sorted(states):
            mart, state = names.mart_name(name), states[name]
            if name in published and published[name]["version"] == state["version"]:
                continue
            if mart and project_mart(self.spark.createDataFrame([], T.StructType.fromJson(json.loads(state["columns"])))) is not None:
                new.append({
                    "dim_table": name, "mart_table": mart, "version": state["version"],
                    "row_count": state["current_rows"], "at": _now(),
                })
        if new:
            self._append_log("mart_versions", MARTS, new)
        fresh = {row["dim_table"] for row in new}
        old = [
            {"dim_table": name, **last.asDict()} for name, last in published.items() if name not in fresh
        ]
        return sorted(new + old, key=lambda row: row["dim_table"])

    def mart(self, name: str) -> DataFrame:
        """Published table; of dimensions that share the name, the one published last."""
        row = (
            self._read_log("mart_versions", MARTS).where(F.col("mart_table") == name)
            .orderBy(F.desc("at"), F.desc("dim_table")).first()
        )
        if row is None:
            raise ValueError(f"mart {name!r} is not published")
        dimension = row["dim_table"]
        state = self.dimension_states({dimension: row["version"]})[dimension]
        return project_mart(self.current(dimension, state).drop("_bucket"))

    # ---- runs --------------------------------------------------------------------------

    @property
    def run_events(self) -> DataFrame:
        return self._read_log("run_events", RUN_EVENTS)

    def append_run_events(self, run_id: int, source: str, *events: dict) -> None:
        """Append what happened to a run, in order."""
        rows = []
        at = _now()
        for offset, fields in enumerate(events):
            for name in fields:
                if name not in RUN_FIELDS:
                    raise ValueError(f"a run has no {name!r}")
            text = {name: None if value is None else str(value) for name, value in fields.items()}
            seq = int(at.timestamp() * 1_000_000) + offset
            rows.append({"run_id": run_id, "seq": seq, "at": at, "source": source, **text})
        self._append_log("run_events", RUN_EVENTS, rows)

    def is_finished(self, source: str, filename: str) -> bool:
        """Whether a run of a source over a landed file went through to its end."""
        own = self.run_events.where(F.col("source") == source)
        states = run_states(own).where(F.col("filename") == filename)
        return not states.where("status = 'done'").isEmpty()

    def finished_files(self, landed: DataFrame) -> set[tuple[str, str]]:
        """Of landed files (source, payload_filename) those whose runs went through to their end."""
        asked = landed.select("source", F.col("payload_filename").alias("filename"))
        states = run_states(self.run_events.join(asked.select("source"), "source", "left_semi")).where("status = 'done'")
        found = states.join(asked, ["source", "filename"], "left_semi").select("source", "filename").distinct()
        return {(row["source"], row["filename"]) for row in found.collect()}

    def next_run_id(self) -> int:
        """A run number that no other writer gets."""
        return self.claim("runs", (self.run_events.agg(F.max("run_id")).first()[0] or 0) + 1)

    @property
    def checkpoints(self) -> DataFrame:
        return self._read_log("checkpoints", CHECKPOINTS)

    def commit_checkpoint(self, source: str, run_id: int, checkpoint: str, settings: str | None = None) -> None:
        """Commit a checkpoint next to the settings it was read under."""
        seq = int(_now().timestamp() * 1_000_000)
        self._append_log("checkpoints", CHECKPOINTS, [
            {"source": source, "seq": seq, "run_id": run_id, "checkpoint": checkpoint, "settings": settings}
        ])

    def checkpoint(self, source: str, settings: str | None = None) -> str | None:
        """Checkpoint committed last; with ``settings`` only if it was committed under the same."""
        last = (
            self.checkpoints.where(F.col("source") == source)
            .agg(F.max_by(F.struct("checkpoint", "settings"), "seq").alias("last")).first()["last"]
        )
        if last is None or (settings is not None and last["settings"] != settings):
            return None
        return last["checkpoint"]

    # ---- sources -----------------------------------------------------------------------

    def sources(self) -> dict[str, SourceConfig]:
        """Settings of every source, as they were saved last."""
        rows = self._read_log("sources", SOURCES).groupBy("name").agg(
            F.max_by("settings", "seq").alias("settings")
        ).collect()
        read = {row["name"]: json.loads(row["settings"]) for row in rows}
        return {
            name: SourceConfig(**{**fields, "key_fields": tuple(fields["key_fields"])})
            for name, fields in sorted(read.items()) if fields is not None
        }

    def remove_source(self, name: str) -> None:
        """Take a source away. What its runs brought stays; saved again, it starts without a checkpoint."""
        if name not in self.sources():
            raise ValueError(f"no such source: {name}")
        seq = int(_now().timestamp() * 1_000_000)
        self._append_log("sources", SOURCES, [{"name": name, "seq": seq, "settings": json.dumps(None)}])

    def save_source(self, source: SourceConfig) -> SourceConfig:
        """Create a source or change its settings; a change of what is read drops the checkpoint."""
        source.validate()
        old = self.sources().get(source.name)
        changes = {name: value for name, value in vars(source).items() if name not in ("checkpoint", "next_run")}
        saved = source if old is None else old.updated(**changes)
        self._append_log("sources", SOURCES, [{
            "name": saved.name, "seq": int(_now().timestamp() * 1_000_000), "settings": json.dumps(vars(saved)),
        }])
        return saved

    def source_report(self) -> DataFrame:
        """The saved sources with their last success and the failure that is still open, if any."""
        saved = self._read_log("sources", SOURCES).groupBy("name").agg(F.max_by("settings", "seq").alias("settings"))
        names = saved.where("settings <> 'null'").select("name")
        return source_report(names, run_states(self.run_events).withColumnRenamed("run_id", "id"))

