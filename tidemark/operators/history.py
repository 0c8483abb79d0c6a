"""Type 2 history: merge a batch into a dimension, closing and inserting versions.

Versions are half-open, ``valid_from <= t < valid_to``. Closing sets ``valid_to`` and
``is_current``; nothing is ever deleted and closed versions are never opened again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names
from ..functions.values import value_text
from ..options import (
    CLOSE_ON_FULL_SNAPSHOT, FULL_SNAPSHOT, INCREMENTAL_UPSERT, check_options,
)
from .keys import batch_facts, business_key, configured_key, data_columns, keyed, latest_per_key, row_hash

KEEP, CLOSE, INSERT = "keep", "close", "insert"
NULL_SALTS = 1024
#: Decided keys up to which they are broadcast to the rows they pick.
FEW = 200_000
#: Writes rows and reads them back.
Store = Callable[[DataFrame], DataFrame]

_HISTORY_TYPES = {
    "_sk": T.StringType(),
    "_business_key": T.StringType(),
    "valid_from": T.TimestampType(),
    "valid_to": T.TimestampType(),
    "is_current": T.BooleanType(),
    "_content_hash": T.StringType(),
}


def empty_dimension(spark: SparkSession, batch: DataFrame) -> DataFrame:
    """Dimension without rows: the columns of the staged table and the history columns."""
    fields = [T.StructField(item.name, item.dataType) for item in batch.schema]
    fields += [T.StructField(name, dtype) for name, dtype in _HISTORY_TYPES.items()]
    return spark.createDataFrame([], T.StructType(fields))


def evolve_dimension(dimension: DataFrame, batch: DataFrame) -> DataFrame:
    """Add the columns the dimension does not have yet; columns are never dropped."""
    new = [item for item in batch.schema if item.name not in dimension.columns]
    return dimension.withColumns({
        item.name: F.lit(None).cast(item.dataType) for item in new
    }) if new else dimension


@dataclass
class Merge:
    """Result of a merge. ``changes`` are the current rows and what happens to them, ``decided`` the keys
    that change, where they were stored before any row was fetched."""

    history: DataFrame
    changes: DataFrame
    decided: DataFrame | None = None

    @property
    def dimension(self) -> DataFrame:
        """All versions after the merge."""
        return self.history.unionByName(self.changes.drop("_change"))

    def stats(self) -> DataFrame:
        """One row with the numbers of inserted and closed versions."""
        if self.decided is not None:
            return self.decided.agg(
                F.count_if("_opens").alias("inserted_count"), F.count_if("_closes").alias("closed_count")
            )
        return self.changes.agg(
            F.count_if(F.col("_change") == INSERT).alias("inserted_count"),
            F.count_if(F.col("_change") == CLOSE).alias("closed_count"),
        )


def _null_safe_key(key: Column, salt: Column | None = None) -> Column:
    """Join key on which NULL keys match nothing and, with a salt, spread over tasks."""
    spread = F.lit("n") if salt is None else F.concat(F.lit("n"), salt.cast("string"))
    return F.when(key.isNotNull(), F.concat(F.lit("k"), key)).otherwise(spread)


def packed_hash(digest: Column) -> Column:
    """A content hash as bytes: half as long where it is 32 hexadecimal digits."""
    digits = F.unhex(digest)
    is_digits = (F.length(digest) == 32) & (F.lower(F.hex(digits)) == digest)
    return F.when(is_digits, digits).otherwise(F.encode(digest, "UTF-8"))


@dataclass
class Repeats:
    """Hashes (``_repeated``) of the join keys that a batch has more than once, stored, and their number."""

    hashes: DataFrame
    count: int


def repeats(batch: DataFrame, store: Store) -> Repeats | None:
    """Which keys of a keyed batch repeat; only hashes move. None for a batch whose key is unique."""
    if "_row_index" not in batch.columns:
        return None
    key = F.xxhash64(_null_safe_key(F.col("_business_key"))).alias("_join_key")
    hashes = store(batch.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_join_key"))
    return Repeats(hashes.select(F.col("_join_key").alias("_repeated")), hashes.count())


def _latest(rows: DataFrame, repeated: Repeats | None) -> DataFrame:
    """Rows that count, of rows with ``_join_key``: all, or the last of each key where a batch may repeat keys.

    Where few keys repeat, only their rows are ordered; all others stay where they are.
    """
    if "_row_index" not in rows.columns:
        return rows
    if repeated is None or repeated.count > FEW:
        return latest_per_key(rows, "_join_key")
    if repeated.count == 0:
        return rows
    hashes, same = F.broadcast(repeated.hashes), F.xxhash64("_join_key") == F.col("_repeated")
    return rows.join(hashes, same, "left_anti").unionByName(
        latest_per_key(rows.join(hashes, same, "left_semi"), "_join_key")
    )


def sent_keys(batch: DataFrame, repeated: Repeats | None = None) -> DataFrame:
    """What a merge needs to know of a keyed batch before any wide row moves.

    ``_join_key``, ``_new_hash`` and ``_row`` (which row it is) of the row that counts for each key. A batch
    with ``_row_index`` may repeat keys and the last row counts; one without it comes from a table whose
    key is unique.
    """
    narrow = batch.withColumns({
        "_join_key": _null_safe_key(F.col("_business_key")), "_new_hash": packed_hash(F.col("_content_hash")),
    })
    if "_row_index" in batch.columns:
        narrow = _latest(narrow.select("_join_key", "_new_hash", "_row_index", "_row_id"), repeated)
    return narrow.select("_join_key", "_new_hash", _row_of(batch).alias("_row"))


def _row_of(batch: DataFrame) -> Column:
    return F.col("_row_id") if "_row_index" in batch.columns else _null_safe_key(F.col("_business_key"))


def current_versions(dimension: DataFrame) -> DataFrame:
    """Current rows with the key they are joined on."""
    salt = F.pmod(F.xxhash64("_sk"), F.lit(NULL_SALTS))
    return dimension.where("is_current").withColumn("_join_key", _null_safe_key(F.col("_business_key"), salt))


def decide(
    current: DataFrame, sent: DataFrame, closes_missing: bool, *carried: str, sent_columns: Sequence[str] = ()
) -> DataFrame:
    """Keys that change: ``_join_key``, ``_row`` of the batch, ``_closes``, ``_opens``, and carried columns
    of the current rows and of what was sent. Only keys and hashes go through this join."""
    held = current.select("_join_key", packed_hash(F.col("_content_hash")).alias("_old_hash"), *carried)
    # Without closing what is missing, only keys that were sent can change.
    pairs = held.join(sent, "_join_key", "full_outer" if closes_missing else "right_outer")
    differs = ~F.col("_old_hash").eqNullSafe(F.col("_new_hash"))
    in_dimension, in_batch = F.col("_old_hash").isNotNull(), F.col("_new_hash").isNotNull()
    closes = in_dimension & ((in_batch & differs) | (~in_batch & F.lit(closes_missing)))
    opens = in_batch & differs
    flags = (closes.alias("_closes"), opens.alias("_opens"))
    return pairs.select("_join_key", "_row", *flags, *carried, *sent_columns).where(
        "_closes OR _opens"
    )


def after_closing(
    current: DataFrame, decided: DataFrame, columns: list[str], closes_missing: bool, effective_at: Column,
    few: bool = False,
) -> DataFrame:
    """Current rows after the merge: as they are, or closed. ``few`` says that few keys were counted."""
    # NULL keys match nothing: they are closed if missing ones are.
    closing = decided.where(F.col("_closes") & F.col("_join_key").startswith("k"))
    closing = closing.select("_join_key", F.lit(True).alias("_closing"))
    # The join key says what the business key is, so that one stays behind.
    keyless = F.col("_join_key").startswith("n")
    joined = current.drop("_business_key").join(F.broadcast(closing) if few else closing, "_join_key", "left")
    gone = F.when(keyless, F.lit(closes_missing)).otherwise(F.coalesce("_closing", F.lit(False)))
    held = joined.withColumn("_business_key", F.when(~keyless, F.substr("_join_key", F.lit(2))))
    return held.select(*_version(columns, gone, effective_at, lambda name: F.col(f"`{name}`")))


def opened_versions(
    batch: DataFrame, columns: list[str], types: Mapping[str, T.DataType], effective_at: Column,
    decided: DataFrame | None = None, few: bool = False, repeated: Repeats | None = None,
    hashed: Sequence[str] | None = None,
) -> DataFrame:
    """New versions of the rows of a keyed batch that open one; without decisions of all its latest rows.

    With ``hashed``, the columns its hash is over, the hash is taken of the rows that count, not moved.
    """
    if decided is not None:
        rows = decided.where("_opens").select(F.col("_row").alias("_opening"))
        chosen = batch.join(F.broadcast(rows) if few else rows, _row_of(batch) == F.col("_opening"), "left_semi")
    elif "_row_index" in batch.columns:
        keyed_rows = batch.withColumn("_join_key", _null_safe_key(F.col("_business_key")))
        if hashed is None:
            chosen = _latest(keyed_rows, repeated)
        else:
            moved = _latest(keyed_rows.drop("_business_key", "_content_hash"), repeated)
            key = F.when(F.col("_join_key").startswith("k"), F.substr("_join_key", F.lit(2)))
            chosen = moved.withColumns({"_business_key": key, "_content_hash": row_hash(moved, hashed)})
    else:
        chosen = batch
    return _opened(chosen, columns, types, effective_at).select(*columns, F.lit(INSERT).alias("_change"))


def surrogate_key(key: Column, effective_at: Column) -> Column:
    """Key of the version that opens at an instant; rows without a key share one."""
    return F.md5(F.concat_ws("|", F.coalesce(key, F.lit("")), key.isNull().cast("string"), F.unix_micros(effective_at)))


def _opened(rows: DataFrame, columns: list[str], types: Mapping[str, T.DataType], effective_at: Column) -> DataFrame:
    """The rows as versions that open at an instant, with the columns of the dimension."""
    opened = {
        "_sk": surrogate_key(F.col("_business_key"), effective_at),
        "valid_from": effective_at, "valid_to": F.lit(None).cast("timestamp"),
        "is_current": F.lit(True),
    }
    kept = [name for name in ("_join_key",) if name in rows.columns]
    return rows.withColumns(opened).select(
        *kept,
        *[
            (F.col(f"`{name}`") if name in rows.columns or name in opened else F.lit(None))
            .cast(types[name]).alias(name)
            for name in columns
        ],
    )


def merge_keyed(
    dimension: DataFrame | None, batch: DataFrame, load_mode: str, delete_policy: str,
    effective_at: datetime, plan: str = "auto", store: Store | None = None, hashed: Sequence[str] | None = None,
) -> Merge:
    """Merge a batch that carries ``_business_key`` and ``_content_hash`` into a dimension.

    Without a dimension everything is inserted, and there is nothing to join. A batch with
    ``_row_index`` may repeat keys and the last row counts; one without it comes
    from a table whose key is unique.

    Two plans give the same result. ``outer`` joins keys and hashes of both sides in full, which
    suits a batch about as large as the dimension, and fetches rows for what closes or opens. ``delta``
    joins the current rows with only the keys and hashes of the batch, and the batch with the versions
    those keys pick: when the keys are under the session's broadcast threshold the planner ships them to
    the dimension, which then is not shuffled; beyond it, it sorts and merges.
    ``auto`` takes ``delta`` for incremental batches.

    With ``store``, which writes rows and reads them back, the batch is looked at for keys that repeat, and
    only their rows are ordered; keys and hashes decide in one join what happens, and rows are fetched only for
    what closes or opens. A first load is stored too. ``hashed`` names the columns the hash is over; rows of a
    first load then move without it.
    """
    check_options(load_mode, delete_policy)
    at = F.lit(effective_at)
    closes_missing = load_mode == FULL_SNAPSHOT and delete_policy == CLOSE_ON_FULL_SNAPSHOT
    rows = batch.drop("_business_key", "_content_hash")
    is_new = dimension is None
    dimension = empty_dimension(batch.sparkSession, rows) if is_new else evolve_dimension(dimension, rows)
    columns = dimension.columns
    types = {item.name: item.dataType for item in dimension.schema}
    if is_new:
        # A filter that is never true is planned away, so a first load reads the batch once.
        found = None if store is None else repeats(batch, store)
        fresh = opened_versions(batch, columns, types, at, repeated=found, hashed=hashed)
        fresh = fresh if store is None else store(fresh)
        return Merge(fresh.select(*columns).where(F.lit(False)), fresh)
    current = current_versions(dimension)
    if store is not None:
        decided = store(decide(current, sent_keys(batch, repeats(batch, store)), closes_missing))
        closed, opened = decided.agg(
            *[F.count_if(flag).alias(flag) for flag in ("_closes", "_opens")]
        ).first()
        changes = after_closing(current, decided, columns, closes_missing, at, closed <= FEW).unionByName(
            opened_versions(batch, columns, types, at, decided, opened <= FEW)
        )
        return Merge(dimension.where("NOT is_current"), changes, decided)
    if plan == "delta" or (plan == "auto" and load_mode == INCREMENTAL_UPSERT):
        changes = _delta_changes(current, batch, columns, types, closes_missing, at)
    else:
        decided = decide(current, sent_keys(batch), closes_missing)
        changes = after_closing(current, decided, columns, closes_missing, at).unionByName(
            opened_versions(batch, columns, types, at, decided)
        )
    return Merge(dimension.where("NOT is_current"), changes)


def _delta_changes(
    current: DataFrame, batch: DataFrame, columns: list[str], types: Mapping[str, T.DataType], closes_missing: bool,
    effective_at: Column,
) -> DataFrame:
    latest = batch.withColumn("_join_key", _null_safe_key(F.col("_business_key")))
    if "_row_index" in batch.columns:
        latest = latest_per_key(latest, "_join_key")
    fresh = _opened(latest, columns, types, effective_at)
    sent = fresh.select("_join_key", F.col("_content_hash").alias("_new_hash"))
    closing = F.coalesce(F.col("_new_hash") != F.col("_content_hash"), F.lit(closes_missing))
    kept = current.join(sent, "_join_key", "left").select(
        *_version(columns, closing, effective_at, lambda name: F.col(f"`{name}`"))
    )
    # The versions the batch can meet are picked by the keys sent, not by a shuffle of all.
    held = current.select("_join_key", "_content_hash").join(
        sent.select("_join_key"), "_join_key", "left_semi"
    )
    inserted = fresh.join(held, ["_join_key", "_content_hash"], "left_anti").select(
        *columns, F.lit(INSERT).alias("_change")
    )
    return kept.unionByName(inserted)


def _version(columns: list[str], closing: Column, effective_at: Column, value) -> list[Column]:
    """Current row after the merge: as it is, or closed at ``effective_at``."""
    changed = {
        "valid_to": F.when(closing, effective_at).otherwise(value("valid_to")),
        "is_current": ~closing,
    }
    return [
        *[changed.get(name, value(name)).alias(name) for name in columns],
        F.when(closing, CLOSE).otherwise(KEEP).alias("_change"),
    ]


def merge(
    dimension: DataFrame | None, batch: DataFrame, key: Column, load_mode: str, delete_policy: str,
    effective_at: datetime, hashed: Sequence[str] | None = None, plan: str = "auto", store: Store | None = None,
) -> Merge:
    """Merge staged rows into a dimension; the last row of a key in the batch counts."""
    columns = data_columns(batch) if hashed is None else hashed
    return merge_keyed(
        dimension, keyed(batch, key, columns), load_mode, delete_policy, effective_at, plan, store, columns
    )


def keyed_tables(
    tables: Mapping[str, DataFrame], key_fields: Sequence[str] = (),
    facts: Callable[[str], tuple[bool, bool]] | None = None,
) -> dict[str, DataFrame]:
    """Every staged table of one batch with its keys and hashes, by dimension name.

    ``facts`` tells of a table whether it has rows and all their parent keys; without it the rows are looked at.
    """
    look = {table: (lambda rows: batch_facts(rows)) if facts is None else (lambda _, table=table: facts(table)) for table in tables}
    if key_fields and not any(configured_key(rows, key_fields) is not None for rows in tables.values()):
        if any(look[table](rows)[0] for table, rows in tables.items()):
            raise ValueError("configured key field(s) are missing from the batch")
    return {
        names.dimension_name(table): keyed(tables[table], business_key(tables[table], key_fields, table, look[table]))
        for table in sorted(tables)
    }


def sync_batch(
    tables: Mapping[str, DataFrame], dimensions: Mapping[str, DataFrame], load_mode: str,
    delete_policy: str, effective_at: datetime, key_fields: Sequence[str] = (), plan: str = "auto",
    store: Store | None = None, facts: Callable[[str], tuple[bool, bool]] | None = None,
) -> dict[str, Merge]:
    """Merge every staged table of one batch into its dimension, by dimension name.

    ``tables`` holds the rows of the batch, with all columns the staged table has so far.
    Dimensions that do not exist yet start empty. With ``store`` the tables are merged at once.
    """
    check_options(load_mode, delete_policy)
    batches = keyed_tables(tables, key_fields, facts)

    def merged(name: str) -> Merge:
        return merge_keyed(
            dimensions.get(name), batches[name], load_mode, delete_policy, effective_at, plan, store
        )

    with ThreadPoolExecutor(max_workers=4) as pool:
        return dict(zip(batches, pool.map(merged, batches)))


# Key and compared columns of the two master dimensions.
MASTER_ENTITIES = {
    "department": ("department_id", ("code", "name")),
    "user": ("user_id", ("username", "full_name", "department_id", "is_active")),
}


def keyed_master(entity: str, master: DataFrame) -> DataFrame:
    """A master table (``department`` or ``user``) with its keys and hashes."""
    key, compared = MASTER_ENTITIES[entity]
    types = {item.name: item.dataType for item in master.schema}
    return keyed(master.select(key, *compared), value_text(F.col(key), types[key]), compared)


def sync_master(
    entity: str, master: DataFrame, dimension: DataFrame | None, load_mode: str,
    delete_policy: str, effective_at: datetime,
) -> Merge:
    """Merge a master table into its fixed dimension."""
    return merge_keyed(dimension, keyed_master(entity, master), load_mode, delete_policy, effective_at)


def master_stats(merge_result: Merge) -> DataFrame:
    """Upserted versions, and versions closed because their key is gone from the master."""
    stats = merge_result.changes.groupBy("_business_key").agg(
        F.count_if(F.col("_change") == INSERT).alias("inserted"),
        F.count_if(F.col("_change") == CLOSE).alias("closed"),
    )
    return stats.agg(
        F.coalesce(F.sum("inserted"), F.lit(0)).alias("upserted_count"),
        F.coalesce(F.sum(F.when(F.col("inserted") == 0, F.col("closed"))), F.lit(0)).alias("closed_count"),
    )


def sync_users(
    departments: DataFrame, users: DataFrame, dimensions: Mapping[str, DataFrame],
    load_mode: str, delete_policy: str, effective_at: datetime,
) -> dict[str, Merge]:
    """Merge both master tables, with the mode and policy of the run they are part of."""
    return {
        names.dimension_name(entity): sync_master(
            entity, master, dimensions.get(names.dimension_name(entity)), load_mode,
            delete_policy, effective_at,
        )
        for entity, master in (("department", departments), ("user", users))
    }
