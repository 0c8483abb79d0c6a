"""Whole runs over a warehouse on storage."""

from __future__ import annotations

import glob
import json
import os
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import PipelineError, SourceConfig, Warehouse, run_source
from tidemark.functions.variants import parse
from tidemark.operators import watermark
from tidemark.operators.ledger import run_states
from tidemark.plans import run as runs
from tidemark.sources import landing
from tidemark.sources import pages as page_rules
from tidemark.sources.manifests import MANIFEST_SCHEMA
from tidemark.streaming.landings import ingest_landings

START = datetime(2026, 1, 1, tzinfo=timezone.utc)
INCREMENTAL = "incremental_upsert"


def pages(spark, *bodies):
    rows = [
        ("s", "1", n + 1, f"https://a.test/s?page={n + 1}", None, json.dumps(body)) for n, body in enumerate(bodies)
    ]
    frame = spark.createDataFrame(
        rows, "source STRING, run_id STRING, page_no BIGINT, url STRING, link_header STRING, t STRING"
    )
    return frame.withColumn("body", parse(frame.t)).drop("t")


def row(key, title, hour):
    return {"id": key, "title": title, "price": 1.5, "updated_at": f"2026-01-01T{hour:02d}:00:00Z", "tags": ["x", title]}


@pytest.fixture
def warehouse(spark, folder):
    return Warehouse(spark, f"{folder}/warehouse")


def go(warehouse, source, folder, *bodies, day=0, **options):
    seen = []

    def fetch(mode, checkpoint):
        seen.append((mode, checkpoint))
        return pages(warehouse.spark, *bodies)

    result = run_source(
        warehouse, source, fetch, folder=f"{folder}/landing", effective_at=START + timedelta(days=day), **options
    )
    return result, seen[0]


def last_state(warehouse):
    return run_states(warehouse.run_events).orderBy(F.desc("run_id")).first()


def test_incremental_source_with_children(spark, warehouse, folder):
    source = SourceConfig("Feed", "https://a.test/s", INCREMENTAL)
    masters = (
        spark.createDataFrame([(1, "ENG", "E")], "department_id INT, code STRING, name STRING"),
        spark.createDataFrame(
            [(1, "a", "A", 1, True)],
            "user_id INT, username STRING, full_name STRING, department_id INT, is_active BOOLEAN",
        ),
    )
    result, asked = go(
        warehouse, source, folder, {"items": [row(1, "A v1", 9)], "has_more": True}, {"items": [row(2, "B", 10)], "has_more": False},
        masters=masters,
    )
    assert asked == ("full_snapshot", None)
    assert result.tables == {"feed": 2, "feed_tags": 4}
    assert {m["mart_table"]: m["row_count"] for m in result.marts} == {
        "department": 1, "user": 1, "feed": 2, "feed_tags": 4,
    }
    assert warehouse.checkpoint("Feed") == result.checkpoint == "2026-01-01T10:00:00+00:00"

    result, asked = go(warehouse, source, folder, {"items": [row(1, "A v2", 11)]}, day=1)
    assert asked == (INCREMENTAL, "2026-01-01T10:00:00+00:00")
    counts = {name: (d["inserted_rows"], d["closed_rows"]) for name, d in result.dimensions.items()}
    assert counts == {"dim_feed": (1, 1), "dim_feed_tags": (1, 1)}
    titles = warehouse.mart("feed").select("id", "title").orderBy("id").collect()
    assert [tuple(r) for r in titles] == [(1, "A v2"), (2, "B")]
    history = warehouse.dimension("dim_feed").where("id = 1").orderBy("valid_from").collect()
    assert [(r["title"], r["is_current"]) for r in history] == [("A v1", False), ("A v2", True)]
    assert history[0]["valid_to"] == history[1]["valid_from"]
    # Nothing new: the answer is empty and the checkpoint stays.
    result, _ = go(warehouse, source, folder, {"items": []}, day=2)
    assert result.checkpoint == "2026-01-01T11:00:00+00:00"
    assert warehouse.mart("feed").count() == 2
    # A forced full snapshot closes what is gone.
    result, asked = go(warehouse, source, folder, {"items": [row(1, "A v2", 11)]}, day=3, force_full=True)
    assert asked == ("full_snapshot", None)
    assert [r["id"] for r in warehouse.mart("feed").collect()] == [1]
    assert warehouse.dimension("dim_feed").count() == 3
    assert last_state(warehouse)["status"] == "done"


def test_failure_keeps_the_checkpoint_and_says_where(warehouse, folder, monkeypatch):
    source = SourceConfig("s", "https://a.test/s", INCREMENTAL)
    go(warehouse, source, folder, [row(1, "a", 9)])
    monkeypatch.setattr(Warehouse, "refresh_marts", lambda self: 1 / 0)
    with pytest.raises(PipelineError) as error:
        go(warehouse, source, folder, [row(1, "b", 10)], day=1)
    assert error.value.step == "mart"
    assert warehouse.checkpoint("s") == "2026-01-01T09:00:00+00:00"
    state = last_state(warehouse)
    assert (state["status"], state["step"]) == ("failed", "mart") and "division" in state["error"]
    monkeypatch.undo()
    _, asked = go(warehouse, source, folder, [row(1, "b", 10)], day=2)
    assert asked[1] == "2026-01-01T09:00:00+00:00"
    assert [r["title"] for r in warehouse.mart("s").collect()] == ["b"]


def test_tables_that_do_not_arrive(warehouse, folder, monkeypatch):
    monkeypatch.setattr(runs, "sync_core", lambda *args: {})
    with pytest.raises(PipelineError) as error:
        go(warehouse, SourceConfig("s", "https://a.test/s"), folder, [row(1, "a", 9)])
    assert error.value.step == "core"


@pytest.mark.parametrize("bodies, step", [
    (([{"name": "no key"}],), "core"), (([row(1, "a", 9)], {"items": []}), "extract"),
    (({"items": [row(1, "a", 9)], "next_cursor": "c"},), "extract"),
    (([{"id": 1, "valid_to": "x"}],), "load"), (([{"id": 1, "a": 1}, {"id": 2, "a": "x"}],), "load"),
])
def test_refused_extracts(warehouse, folder, bodies, step):
    with pytest.raises(PipelineError) as error:
        go(warehouse, SourceConfig("s", "https://a.test/s", watermark_field=""), folder, *bodies)
    assert error.value.step == step
    assert last_state(warehouse)["step"] == step
    if step == "load":
        assert warehouse.ledger.isEmpty() and warehouse.staged_types() == {}


def test_reserved_and_invalid_sources(warehouse, folder):
    for source in (SourceConfig("User", "https://a.test/s"), SourceConfig("s", "ftp://a.test")):
        with pytest.raises(PipelineError) as error:
            go(warehouse, source, folder, [row(1, "a", 9)])
        assert error.value.step == "validate"


def test_landed_file_is_loaded_once(warehouse, folder):
    source = SourceConfig("s", "https://a.test/s", watermark_field="")
    go(warehouse, source, folder, [row(1, "a", 9)])
    entry = warehouse.ledger.first()
    request = runs.Request(
        entry["filename"], "s", entry["run_id"], entry["load_mode"], entry["delete_policy"], None, None,
    )
    again = run_source(warehouse, source, folder=f"{folder}/landing", request=request, effective_at=START)
    assert again.batch_id == entry["id"] and set(again.tables.values()) == {0}
    assert warehouse.ledger.count() == 1 and warehouse.dimension("dim_s").count() == 1


def test_altered_landing_is_refused(spark, warehouse, folder):
    source = SourceConfig("s", "https://a.test/s", watermark_field="")
    landing = f"{folder}/landing"
    request = runs.land_pages(warehouse, pages(spark, [row(1, "a", 9)]), source, 1, "full_snapshot", None, landing)
    spark.createDataFrame([(1,)], "root_index BIGINT").selectExpr("root_index", "parse_json('{\"id\":2}') AS rec").write.mode(
        "append").parquet(f"{landing}/{request.filename}")
    with pytest.raises(PipelineError, match="checksum"):
        runs.load_batch(warehouse, request, landing)
    request.load_mode = INCREMENTAL
    with pytest.raises(PipelineError, match="load mode"):
        runs.load_batch(warehouse, request, landing)
    assert set(MANIFEST_SCHEMA.names) >= {"sha256", "byte_size"} and warehouse.ledger.isEmpty()


def test_schema_grows_and_types_stay(warehouse, folder):
    source = SourceConfig("s", "https://a.test/s", INCREMENTAL, watermark_field="")
    go(warehouse, source, folder, [{"id": 1, "a": "x"}])
    go(warehouse, source, folder, [{"id": 1, "a": 5, "b": True}], day=1)
    assert warehouse.staged_types() == {"s": {"id": "bigint", "a": "text", "b": "boolean"}}
    found = warehouse.dimension("dim_s").orderBy("valid_from").select("a", "b", "is_current").collect()
    assert [tuple(r) for r in found] == [("x", None, False), ("5", True, True)]


def test_attempt_that_is_lost_leaves_no_columns(warehouse, folder, monkeypatch):
    source = SourceConfig("s", "https://a.test/s", watermark_field="")
    append = Warehouse._append_log

    def lose(self, name, schema, rows):
        if name == "raw_batches":
            raise OSError("lost")
        append(self, name, schema, rows)

    monkeypatch.setattr(Warehouse, "_append_log", lose)
    with pytest.raises(PipelineError, match="lost"):
        go(warehouse, source, folder, [{"id": "a", "x": True}])
    monkeypatch.undo()
    result, _ = go(warehouse, source, folder, [{"id": 1, "y": 2.5}])
    assert result.batch_id == 1
    assert warehouse.staged_types() == {"s": {"id": "bigint", "y": "double"}}
    assert [(r["id"], r["y"]) for r in warehouse.mart("s").collect()] == [(1, 2.5)]


def test_core_refuses_batches_that_do_not_match(warehouse, folder):
    source = SourceConfig("s", "https://a.test/s", watermark_field="")
    go(warehouse, source, folder, [row(1, "a", 9)])
    with pytest.raises(ValueError, match="does not exist"):
        runs.sync_core(warehouse, 99, source, "full_snapshot", START)
    with pytest.raises(ValueError, match="does not match"):
        runs.sync_core(warehouse, 1, source, INCREMENTAL, START)


def buckets_of(warehouse, name):
    """Files with current rows of each version of a dimension, by version and bucket."""
    files = glob.glob(f"{warehouse.root}/core/{name}/_version=*/_current=true/_bucket=*/*.parquet")
    return sorted({tuple(int(part.split("=")[1]) for part in file.split("/")[-4:-1:2]) for file in files})


def written_rows(spark, warehouse, name, version):
    return spark.read.parquet(f"{warehouse.root}/core/{name}/_version={version}").count()


def test_small_delta_writes_only_its_buckets(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/warehouse", bucket_rows=20)
    source = SourceConfig("s", "https://a.test/s", INCREMENTAL, watermark_field="")
    go(warehouse, source, folder, [{"id": n, "v": "a"} for n in range(600)])
    state = warehouse.dimension_states()["dim_s"]
    assert state["buckets"] == 32 and len(state["parts"][1]) == 32
    result, _ = go(warehouse, source, folder, [{"id": 3, "v": "b"}, {"id": 4, "v": "a"}, {"id": 9999, "v": "n"}], day=1)
    counts = result.dimensions["dim_s"]
    assert (counts["inserted_rows"], counts["closed_rows"], counts["current_rows"]) == (2, 1, 601)
    second = [bucket for version, bucket in buckets_of(warehouse, "dim_s") if version == 2]
    assert 1 <= len(second) <= 2
    held = {b: n for part in state["parts"].values() for b, n in part.items()}
    assert written_rows(spark, warehouse, "dim_s", 2) == sum(held[b] for b in second) + 2
    # The mart is a pointer: nothing is written for it.
    assert not os.path.exists(f"{warehouse.root}/mart") and not os.listdir(f"{warehouse.root}/work")
    mart = warehouse.mart("s")
    assert mart.count() == 601 and {r["id"]: r["v"] for r in mart.where("id IN (3, 4, 9999)").collect()} == {3: "b", 4: "a", 9999: "n"}
    assert [m["row_count"] for m in result.marts] == [601]
    found = {(r["id"], r["v"], r["is_current"]) for r in warehouse.dimension("dim_s").collect()}
    assert found == {(n, "b" if n == 3 else "a", True) for n in range(600)} | {(3, "a", False), (9999, "n", True)}
    # A batch in which nothing differs writes nothing and moves no version.
    result, _ = go(warehouse, source, folder, [{"id": 3, "v": "b"}], day=2)
    assert result.dimensions["dim_s"]["version"] == 2 and not os.path.exists(f"{warehouse.root}/core/dim_s/_version=3")
    # A full snapshot writes the buckets of what it closes.
    rows = [{"id": n, "v": {3: "b", 9999: "n"}.get(n, "a")} for n in [*range(600), 9999] if n != 77]
    result, _ = go(warehouse, source, folder, rows, day=3, force_full=True)
    assert (result.dimensions["dim_s"]["inserted_rows"], result.dimensions["dim_s"]["closed_rows"]) == (0, 1)
    assert len([1 for version, _ in buckets_of(warehouse, "dim_s") if version == 3]) <= 1
    assert warehouse.mart("s").where("id = 77").isEmpty() and warehouse.mart("s").count() == 600


def test_outgrown_buckets_become_more(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/warehouse", bucket_rows=10)
    source = SourceConfig("s", "https://a.test/s", INCREMENTAL, watermark_field="")
    go(warehouse, source, folder, [{"id": n} for n in range(8)])
    go(warehouse, source, folder, [{"id": n} for n in range(5, 60)], day=1)
    state = warehouse.dimension_states()["dim_s"]
    assert (state["buckets"], state["layout"], list(state["parts"])) == (8, 2, [2])
    go(warehouse, source, folder, [{"id": 60}], day=2)
    state = warehouse.dimension_states()["dim_s"]
    assert sum(rows for part in state["parts"].values() for rows in part.values()) == state["current_rows"] == 61
    assert sorted(r["id"] for r in warehouse.mart("s").collect()) == list(range(61))
    assert sorted(r["id"] for r in warehouse.dimension("dim_s").collect()) == list(range(61))


def test_rows_without_key_stay_in_their_bucket(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/warehouse", bucket_rows=2)
    source = SourceConfig("s", "https://a.test/s", INCREMENTAL, watermark_field="", key_fields=("k",))
    rows = [{"k": n, "v": "a"} for n in range(12)]
    go(warehouse, source, folder, [*rows, {"k": None, "v": "x"}])
    go(warehouse, source, folder, [{"k": None, "v": "y"}, {"k": 1, "v": "b"}], day=1)
    found = sorted(((r["k"], r["v"], r["is_current"]) for r in warehouse.dimension("dim_s").collect()), key=repr)
    assert found == sorted(
        [(n, "a", n != 1) for n in range(12)] + [(None, "x", True), (None, "y", True), (1, "b", True)], key=repr
    )
    result, _ = go(warehouse, source, folder, rows, day=2, force_full=True)
    assert (result.dimensions["dim_s"]["inserted_rows"], result.dimensions["dim_s"]["closed_rows"]) == (1, 3)
    assert sorted((r["k"], r["v"]) for r in warehouse.mart("s").collect()) == [(n, "a") for n in range(12)]


def test_columns_named_like_folders(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    source = SourceConfig("s", "https://a.test/s", INCREMENTAL, watermark_field="")
    go(warehouse, source, folder, [{"id": 1, "version": 7, "bucket": "b", "current": False}])
    assert [(r["version"], r["bucket"], r["current"]) for r in warehouse.mart("s").collect()] == [(7, "b", False)]


def test_two_sources_at_once(spark, warehouse, folder):
    def one(name):
        source = SourceConfig(name, f"https://a.test/{name}", watermark_field="")
        return [go(warehouse, source, folder, [row(n, name, 9) for n in range(3)], day=day)[0] for day in range(2)]

    with ThreadPoolExecutor(3) as pool:
        results = [result for own in pool.map(one, ["a", "b", "c"]) for result in own]
    assert sorted(r.batch_id for r in results) == sorted(r["id"] for r in warehouse.ledger.collect()) == list(range(1, 7))
    assert sorted(r.run_id for r in results) == list(range(1, 7))
    states = run_states(warehouse.run_events).collect()
    assert len(states) == 6 and {r["status"] for r in states} == {"done"}
    for name in "abc":
        assert {r["title"] for r in warehouse.mart(name).collect()} == {name} and warehouse.mart(name).count() == 3


def test_numbers_are_claimed_once(spark, warehouse):
    with ThreadPoolExecutor(8) as pool:
        taken = list(pool.map(lambda _: warehouse.claim("x", 5), range(40)))
    assert sorted(taken) == list(range(5, 45))
    warehouse.release("x", 7)
    assert warehouse.claim("x", 5) == 7


def test_logs_are_compacted(spark, warehouse):
    schema = "n BIGINT, at TIMESTAMP, m ARRAY<STRUCT<a: INT>>"
    stamps = [START + timedelta(microseconds=n) for n in range(50)]
    for n, stamp in enumerate(stamps):
        warehouse._append_log("things", schema, [{"n": n, "at": stamp, "m": [{"a": n}] if n % 2 else None}])
        if n % 10 == 9:
            warehouse.compact_log("things", schema, least=5)
    names = os.listdir(f"{warehouse.root}/logs/things")
    assert len([name for name in names if name.endswith(".included")]) == 2
    # Files of the last snapshot are still there, those of the one before are not.
    assert len([name for name in names if name.endswith(".json") and not name.startswith(".")]) == 10
    found = warehouse._read_log("things", schema).orderBy("n").collect()
    assert [(r["n"], r["at"].replace(tzinfo=timezone.utc), r["m"]) for r in found] == [
        (n, stamp, [(n,)] if n % 2 else None) for n, stamp in enumerate(stamps)
    ]


def test_landing_is_digested_while_it_is_written(spark, folder, monkeypatch):
    rows = spark.createDataFrame([(n, json.dumps({"n": n})) for n in range(20)], "root_index BIGINT, t STRING")
    records = rows.select("root_index", parse(rows.t).alias("rec")).repartition(3)
    monkeypatch.setattr(landing, "content_digest", None)
    written = landing.write_landing(records, folder, "s", {"run_id": "1"})
    monkeypatch.undo()
    found = landing.content_digest(landing.scan_records(spark, f"{folder}/{written['payload_filename']}"))
    assert found == (20, written["byte_size"], written["sha256"]) and written["rows"] == 20


def test_sources_in_one_micro_batch(spark, warehouse, folder):
    names = ["a", "b", "c"]
    for run, (name, day) in enumerate([(name, day) for day in range(2) for name in names], start=1):
        records = spark.createDataFrame([(n, json.dumps({"id": n, "v": f"{name}{day}"})) for n in range(4)], "root_index BIGINT, t STRING")
        landing.write_landing(records.select("root_index", parse(records.t).alias("rec")), f"{folder}/landing", name, {
            "run_id": str(run), "load_mode": "full_snapshot", "delete_policy": "close_on_full_snapshot", "pagination_complete": True,
            "requested_url": f"https://a.test/{name}", "fetched_at": (START + timedelta(days=day)).isoformat(),
        })
    sources = {name: SourceConfig(name, f"https://a.test/{name}", watermark_field="") for name in names}
    for _ in range(2):
        ingest_landings(warehouse, sources, f"{folder}/landing", f"{folder}/stream-{_}").awaitTermination()
    assert warehouse.ledger.count() == 6
    for name in names:
        found = warehouse.dimension(f"dim_{name}").select("v", "is_current").distinct().collect()
        assert {tuple(r) for r in found} == {(f"{name}0", False), (f"{name}1", True)}


def test_source_taken_away(spark, warehouse):
    warehouse.save_source(SourceConfig("Feed", "local://demo", checkpoint="c"))
    warehouse.remove_source("Feed")
    assert warehouse.sources() == {} and warehouse.source_report().isEmpty()
    with pytest.raises(ValueError, match="no such source"):
        warehouse.remove_source("Feed")
    assert warehouse.save_source(SourceConfig("Feed", "https://a.test/s")).checkpoint is None


def test_unknown_run_field(warehouse):
    with pytest.raises(ValueError, match="color"):
        warehouse.append_run_events(1, "s", {"color": "red"})


def test_changed_address_drops_the_checkpoint(spark, warehouse, folder):
    source = SourceConfig("Feed", "https://a.test/s", INCREMENTAL)
    go(warehouse, source, folder, {"items": [{"id": 1, "updated_at": "2026-01-05T00:00:00Z"}], "has_more": False})
    _, asked = go(warehouse, source, folder, {"items": [{"id": 1, "updated_at": "2026-01-06T00:00:00Z"}]}, day=1)
    assert asked == (INCREMENTAL, "2026-01-05T00:00:00+00:00")
    moved = source.updated(url="https://b.test/s")
    result, asked = go(warehouse, moved, folder, {"items": [{"id": 2, "updated_at": "2026-01-01T00:00:00Z"}]}, day=2)
    assert asked == ("full_snapshot", None) and result.checkpoint == "2026-01-01T00:00:00+00:00"


def test_mark_in_the_envelope(spark, warehouse, folder):
    source = SourceConfig("Feed", "https://a.test/s", INCREMENTAL)
    result, _ = go(warehouse, source, folder, {"updated_at": "2026-01-05T00:00:00Z", "items": [{"id": 1}]})
    assert result.checkpoint == "2026-01-05T00:00:00+00:00"


def test_runs_of_two_sources_with_one_number(spark, warehouse):
    for source, status in (("a", "done"), ("b", "failed")):
        warehouse.append_run_events(1, source, {"status": status, "filename": f"{source}.json"})
    states = {r["source"]: (r["status"], r["filename"]) for r in run_states(warehouse.run_events).collect()}
    assert states == {"a": ("done", "a.json"), "b": ("failed", "b.json")}
    assert warehouse.is_finished("a", "a.json") and not warehouse.is_finished("b", "b.json")


def test_saved_sources(spark, warehouse):
    first = warehouse.save_source(SourceConfig("Feed", "https://a.test/s", key_fields=("id",), checkpoint="c"))
    assert warehouse.sources() == {"Feed": first}
    same = warehouse.save_source(SourceConfig("Feed", "https://a.test/s", key_fields=("id", "x")))
    assert same.checkpoint == "c" and same.key_fields == ("id", "x")
    assert warehouse.save_source(SourceConfig("Feed", "https://b.test/s")).checkpoint is None
    with pytest.raises(ValueError):
        warehouse.save_source(SourceConfig("Bad", "b.test"))
    assert [r["name"] for r in warehouse.source_report().collect()] == ["Feed"]


def test_long_keys_that_agree_in_their_beginning(spark, warehouse, folder):
    key = "k" * 70
    source = SourceConfig("Long", "https://a.test/s", watermark_field="")
    go(warehouse, source, folder, [{"id": 1, f"{key}a": 1, f"{key}b": 2}])
    row = warehouse.mart("long").first().asDict()
    assert (row[f"{key}a"], row[f"{key}b"]) == (1, 2)


def test_new_keys_are_neither_ordered_nor_joined(spark, folder, monkeypatch):
    plans = []

    class Watched(Warehouse):
        def _write_version(self, name, version, rows):
            plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
            super()._write_version(name, version, rows)

    warehouse = Watched(spark, f"{folder}/warehouse")
    source = SourceConfig("s", "https://a.test/s", INCREMENTAL, watermark_field="", key_fields=("k",))
    go(warehouse, source, folder, [{"k": n, "v": "a"} for n in range(6)])
    go(warehouse, source, folder, [{"k": n, "v": "b"} for n in range(6, 9)], day=1)
    assert "Window" not in plans[0] and "LeftSemi" not in plans[1]
    # Of keys that repeat, and of rows without a key, the last row counts; what is there already is no new version.
    result, _ = go(warehouse, source, folder, [
        {"k": 9, "v": "c"}, {"k": 9, "v": "d"}, {"k": 0, "v": "a"}, {"k": 7, "v": "e"}, {"k": None, "v": "x"}, {"k": None, "v": "y"},
    ], day=2)
    assert (result.dimensions["dim_s"]["inserted_rows"], result.dimensions["dim_s"]["closed_rows"]) == (3, 1)
    found = sorted(((r["k"], r["v"], r["is_current"]) for r in warehouse.dimension("dim_s").collect()), key=repr)
    assert found == sorted(
        [(n, "a", True) for n in range(6)] + [(6, "b", True), (7, "b", False), (7, "e", True), (8, "b", True), (9, "d", True), (None, "y", True)],
        key=repr,
    )
    # New keys beside one that stays as it is: nothing closes, and only the new ones open.
    result, _ = go(warehouse, source, folder, [{"k": 0, "v": "a"}, {"k": 20, "v": "n"}], day=3)
    assert (result.dimensions["dim_s"]["inserted_rows"], result.dimensions["dim_s"]["closed_rows"]) == (1, 0)
    assert warehouse.dimension("dim_s").count() == 13 and not os.listdir(f"{warehouse.root}/work")


def test_repeated_keys_of_a_first_load(spark, warehouse, folder):
    source = SourceConfig("s", "https://a.test/s", INCREMENTAL, watermark_field="", key_fields=("k",))
    items = [{"k": n % 4, "v": f"{n}"} for n in range(9)] + [{"k": None, "v": "x"}, {"k": None, "v": "y"}, {"k": 8, "v": "z"}]
    result, _ = go(warehouse, source, folder, items)
    assert result.tables == {"s": 12} and result.dimensions["dim_s"]["inserted_rows"] == 6
    found = {(r["k"], r["v"]) for r in warehouse.mart("s").collect()}
    assert found == {(0, "8"), (1, "5"), (2, "6"), (3, "7"), (8, "z"), (None, "y")}
    assert not os.listdir(f"{warehouse.root}/work")


def test_structure_of_pages_is_found_once(spark, warehouse, folder, monkeypatch):
    for module in (page_rules, watermark):
        monkeypatch.setattr(module, "discover", None)
    source = SourceConfig("Feed", "https://a.test/s", INCREMENTAL)
    bodies = [{"items": [row(1, "a", 9)], "has_more": True}, {"items": [row(2, "b", 10)], "has_more": False}]
    request = runs.land_pages(warehouse, pages(spark, *bodies), source, 1, "full_snapshot", None, f"{folder}/landing")
    assert request.checkpoint_after == "2026-01-01T10:00:00+00:00"
    # One empty page keeps the checkpoint.
    for number, empty in enumerate(([{"items": []}], [{"items": [], "has_more": False}]), start=2):
        request = runs.land_pages(
            warehouse, pages(spark, *empty), source, number, INCREMENTAL, "2026-01-01T10:00:00+00:00", f"{folder}/landing"
        )
        assert request.checkpoint_after == "2026-01-01T10:00:00+00:00"
