"""History merges: the decision table, random trials against a plain model, key rules."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators.history import (
    current_versions, decide, empty_dimension, evolve_dimension, master_stats, merge, packed_hash, sent_keys, sync_batch,
    sync_users,
)
from tidemark.operators.keys import batch_facts, business_key, keyed, latest_per_key
from tidemark.operators.marts import HIDDEN_COLUMNS, project_mart, visible_users

FULL, INCREMENTAL = "full_snapshot", "incremental_upsert"
CLOSE, NEVER = "close_on_full_snapshot", "never_close"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = (
    "_row_id STRING, _source_batch_id BIGINT, _parent_id STRING, _parent_key STRING, _row_index BIGINT, "
    "id BIGINT, v STRING"
)


def at(run):
    return START + timedelta(days=run)


def batch(spark, rows, batch_id=1):
    data = [(f"{batch_id}-{i}", batch_id, None, None, i, key, value) for i, (key, value) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def run(spark, steps, plan="auto"):
    dimension = None
    for number, (mode, policy, rows) in enumerate(steps):
        staged = batch(spark, rows, number)
        dimension = dimension if dimension is not None else empty_dimension(spark, staged)
        dimension = merge(dimension, staged, business_key(staged), mode, policy, at(number), plan=plan).dimension
        # Each step of a real run reads what the step before wrote.
        dimension = spark.createDataFrame(dimension.collect(), dimension.schema)
    return dimension


def versions(dimension):
    rows = dimension.select("id", "v", "valid_from", "valid_to", "is_current").collect()
    day = lambda moment: None if moment is None else (moment.replace(tzinfo=timezone.utc) - START).days
    return sorted(
        ((r["id"], r["v"], day(r["valid_from"]), day(r["valid_to"]), r["is_current"]) for r in rows), key=repr
    )


def model(steps):
    """The same rules over Python lists, statement by statement."""
    held = []
    for now, (mode, policy, rows) in enumerate(steps):
        latest = dict(rows)
        changed = [r for r in held if r[4] and r[0] is not None and r[0] in latest and latest[r[0]] != r[1]]
        gone = [
            r for r in held
            if r[4] and r not in changed and (r[0] is None or r[0] not in latest)
        ] if (mode, policy) == (FULL, CLOSE) else []
        for row in changed + gone:
            held[held.index(row)] = (row[0], row[1], row[2], now, False)
        current = {r[0] for r in held if r[4] and r[0] is not None}
        held += [(key, value, now, None, True) for key, value in latest.items() if key not in current]
    return sorted(held, key=repr)


DECISIONS = [
    (None, "a"), ("a", "a"), ("a", "b"), ("a", None),
]


@pytest.mark.parametrize("plan", ["outer", "delta"])
@pytest.mark.parametrize("mode, policy", [(FULL, CLOSE), (FULL, NEVER), (INCREMENTAL, CLOSE), (INCREMENTAL, NEVER)])
def test_decision_table(spark, mode, policy, plan):
    before = [(i, old) for i, (old, _) in enumerate(DECISIONS) if old] + [(None, "n")]
    after = [(i, new) for i, (_, new) in enumerate(DECISIONS) if new] + [(None, "n")]
    steps = [(FULL, CLOSE, before), (mode, policy, after)]
    found = versions(run(spark, steps, plan))
    assert found == model(steps)
    assert ((3, "a", 0, None, True) in found) == ((mode, policy) != (FULL, CLOSE))
    assert (2, "a", 0, 1, False) in found and (2, "b", 1, None, True) in found
    assert (1, "a", 0, None, True) in found
    assert sum(1 for row in found if row[0] is None) == 2


@pytest.mark.parametrize("seed", range(4))
def test_random_trials(spark, seed):
    rng = random.Random(seed)
    steps = []
    for _ in range(3):
        rows = [
            (rng.choice([None, *range(6)]), rng.choice("ab")) for _ in range(rng.choice([0, 3, 9]))
        ]
        steps.append((rng.choice([FULL, INCREMENTAL]), rng.choice([CLOSE, NEVER]), rows))
    expected = model(steps)
    for plan in ("outer", "delta"):
        assert versions(run(spark, steps, plan)) == expected


def writer(spark, folder):
    """Stores rows in folders of their own, and remembers their columns."""
    seen = []

    def store(rows):
        seen.append(rows.columns)
        rows.write.parquet(f"{folder}/{len(seen)}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{len(seen)}")

    return store, seen


@pytest.mark.parametrize("seed", range(3))
def test_decisions_that_are_stored_first(spark, folder, seed):
    rng = random.Random(seed)
    steps = [
        (mode, policy, [(rng.choice([None, *range(7)]), rng.choice("ab")) for _ in range(rng.choice([0, 4, 10]))])
        for mode, policy in [(FULL, CLOSE), (INCREMENTAL, CLOSE), (FULL, NEVER), (FULL, CLOSE)]
    ]
    store, seen = writer(spark, folder)
    dimension = None
    for number, (mode, policy, rows) in enumerate(steps):
        staged = batch(spark, rows, number)
        merged = merge(dimension, staged, business_key(staged), mode, policy, at(number), store=store)
        lazy = merge(dimension, staged, business_key(staged), mode, policy, at(number))
        assert merged.stats().first() == lazy.stats().first()
        dimension = store(merged.dimension)
        assert versions(dimension) == model(steps[:number + 1])
    # Keys, hashes and rows only went through the join that decides.
    narrow = {"_join_key", "_new_hash", "_row", "_closes", "_opens"}
    assert all(set(columns) <= narrow for columns in seen if "_sk" not in columns)


def test_no_payload_goes_through_the_outer_join(spark, folder):
    staged = batch(spark, [(i, "a") for i in range(50)])
    merge(None, staged, business_key(staged), FULL, CLOSE, at(0)).dimension.write.parquet(f"{folder}/d")
    batch(spark, [(1, "b")], 2).write.parquet(f"{folder}/b")
    delta = spark.read.parquet(f"{folder}/b")
    decided = decide(current_versions(spark.read.parquet(f"{folder}/d")), sent_keys(keyed(delta, business_key(delta))), True)
    plan = decided._jdf.queryExecution().executedPlan().toString()
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert "FullOuter" in plan or "full_outer" in plan.lower()
    assert any(set(c.split(":")[0] for c in columns.split(",")) == {"_sk", "_business_key", "is_current", "_content_hash"} for columns in read)
    assert "valid_from" not in plan and "_parent_key" not in plan


def test_four_revisions(spark):
    one = [(1, "A v1"), (2, "B")]
    two = [(1, "A v2")]
    steps = [(FULL, CLOSE, one), (INCREMENTAL, CLOSE, two), (FULL, NEVER, two), (FULL, CLOSE, two)]
    assert versions(run(spark, steps[:2])) == versions(run(spark, steps[:3]))
    final = run(spark, steps)
    assert versions(final) == [
        (1, "A v1", 0, 1, False), (1, "A v2", 1, None, True), (2, "B", 0, 3, False),
    ]
    assert [(r["id"], r["v"]) for r in project_mart(final).collect()] == [(1, "A v2")]


def test_empty_full_snapshot_closes_everything(spark):
    final = run(spark, [(FULL, CLOSE, [(1, "a"), (2, "b")]), (FULL, CLOSE, [])])
    assert {row[4] for row in versions(final)} == {False}


def test_same_batch_twice_changes_nothing(spark):
    steps = [(FULL, CLOSE, [(1, "a"), (2, "b")])]
    assert versions(run(spark, steps)) == versions(run(spark, steps * 2))


def test_last_duplicate_wins_and_a_hot_key_is_reduced_before_the_shuffle(spark):
    staged = batch(spark, [(1, "a"), (2, "x"), (1, "b")])
    assert sorted((r["id"], r["v"]) for r in latest_per_key(staged, "id").collect()) == [(1, "b"), (2, "x")]
    plan = latest_per_key(staged, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_small_delta_is_broadcast_and_the_dimension_not_shuffled(spark, folder):
    staged = batch(spark, [(i, "a") for i in range(50)])
    first = merge(empty_dimension(spark, staged), staged, business_key(staged), FULL, CLOSE, at(0)).dimension
    first.write.parquet(f"{folder}/d")
    batch(spark, [(1, "b")], 2).write.parquet(f"{folder}/b")
    stored, delta = spark.read.parquet(f"{folder}/d"), spark.read.parquet(f"{folder}/b")
    merged = merge(stored, delta, business_key(delta), INCREMENTAL, CLOSE, at(1))
    plan = merged.changes._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # Only the delta is shuffled, for its latest rows; the stored side goes straight to the join.
    assert "PushedFilters: [IsNotNull(is_current), EqualTo(is_current,true)]" in plan


def test_mode_and_policy_are_checked(spark):
    staged = batch(spark, [(1, "a")])
    for mode, policy in (("append", CLOSE), (None, CLOSE), (FULL, "drop"), (FULL, None)):
        with pytest.raises(ValueError):
            merge(empty_dimension(spark, staged), staged, business_key(staged), mode, policy, at(0))


def test_new_columns_are_added_and_old_ones_kept(spark):
    staged = batch(spark, [(1, "a"), (2, "b")])
    first = merge(empty_dimension(spark, staged), staged, business_key(staged), FULL, CLOSE, at(0)).dimension
    wider = batch(spark, [(1, "a")], 2).withColumn("w", F.lit(5))
    assert evolve_dimension(first, wider).columns == [*first.columns, "w"]
    merged = merge(first, wider, business_key(wider), INCREMENTAL, CLOSE, at(1)).dimension
    found = [(r["w"], r["is_current"]) for r in merged.orderBy("valid_from").collect() if r["id"] == 1]
    assert found == [(None, False), (5, True)]


# ---- keys ------------------------------------------------------------------------------

def key_of(frame, *args):
    return [r[0] for r in frame.select(business_key(frame, *args)).collect()]


def test_configured_keys(spark):
    frame = batch(spark, [(1, "a b"), (None, None)])
    assert key_of(frame, ["V"]) == ["a b", None]
    assert key_of(frame, ["id", "v"]) == ['(1,"a b")', "(,)"]
    assert key_of(frame, ["missing"]) == ["1", None]
    assert key_of(frame, ["id", "ID"]) == ["1", None]


def test_parent_key_and_position(spark):
    frame = batch(spark, [(1, "a")]).drop("id").withColumn("_parent_key", F.lit('["s",1]'))
    assert key_of(frame) == ['("[""s"",1]",0)']


def test_no_stable_key(spark):
    frame = batch(spark, [(1, "a")]).drop("id")
    with pytest.raises(ValueError, match="cannot be told apart"):
        business_key(frame, table="t")
    with pytest.raises(ValueError, match="configured key"):
        business_key(frame, ["missing"], "t")
    assert batch_facts(frame) == (True, False)
    empty = frame.where("v = 'none'")
    assert key_of(empty) == []


def test_configured_key_in_no_table(spark):
    tables = {"s": batch(spark, [(1, "a")])}
    with pytest.raises(ValueError, match="configured key"):
        sync_batch(tables, {}, FULL, CLOSE, at(0), ["missing"])
    assert list(sync_batch({"s": tables["s"].where("id = 9")}, {}, FULL, CLOSE, at(0), ["missing"])) == ["dim_s"]


# ---- masters ---------------------------------------------------------------------------

def masters(spark, departments, users):
    return (
        spark.createDataFrame(departments, "department_id INT, code STRING, name STRING"),
        spark.createDataFrame(
            users, "user_id INT, username STRING, full_name STRING, department_id INT, is_active BOOLEAN"
        ),
    )


def test_masters_and_row_filter(spark):
    first = masters(
        spark, [(1, "ENG", "Engineering"), (2, "OPS", "Operations")],
        [(1, "a", "A", 1, True), (2, "b", "B", 2, True), (3, "c", "C", None, True)],
    )
    merges = sync_users(*first, {}, FULL, CLOSE, at(0))
    held = {name: merged.dimension for name, merged in merges.items()}
    later = masters(
        spark, [(1, "ENG", "Engineering and more")], [(1, "a", "A", 1, False), (2, "b", "B", 2, True)],
    )
    merges = sync_users(*later, held, FULL, CLOSE, at(1))
    stats = {name: tuple(master_stats(merged).first()) for name, merged in merges.items()}
    assert stats == {"dim_department": (1, 1), "dim_user": (1, 1)}
    users, departments = merges["dim_user"].dimension, merges["dim_department"].dimension
    seen = visible_users(users, departments, "ENG").select("user_id", "is_active").collect()
    assert sorted(map(tuple, seen)) == [(1, False), (1, True)]
    for code in (None, "", "ALL"):
        assert visible_users(users, departments, code).count() == users.count()
    # A department that is closed, or unknown, sees nobody.
    assert visible_users(users, departments, "OPS").count() == 0
    assert not set(project_mart(users).columns) & set(HIDDEN_COLUMNS)


def test_only_repeated_keys_are_ordered_and_few_bytes_move(spark, folder):
    stored, _ = writer(spark, folder)
    plans = []

    def store(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return stored(frame)

    def load(rows, **more):
        plans.clear()
        staged = batch(spark, rows)
        return merge(None, staged, business_key(staged), "full_snapshot", "close_on_full_snapshot", at(0), **more).dimension

    unique = [(key, f"v{key}") for key in range(20)]
    # Keys that do not repeat: rows of a first load do not move at all.
    assert versions(load(unique, store=store)) == versions(load(unique))
    load(unique, store=store)
    assert "Window" not in plans[-1] and "Exchange" not in plans[-1]
    # Of keys that repeat, and of rows without a key, the last row counts, as without a store.
    repeated = unique + [(3, "x"), (None, "a"), (3, "y"), (None, "b")]
    assert versions(load(repeated, store=store)) == versions(load(repeated))
    assert (3, "y", 0, None, True) in versions(load(repeated, store=store))
    hashes = spark.createDataFrame([("0123456789abcdef" * 2,), ("A" * 32,), ("",)], "h STRING")
    assert [len(row[0]) for row in hashes.select(packed_hash(F.col("h"))).collect()] == [16, 32, 0]
