"""Pages, manifests, marks, slices and ledgers."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from pathlib import Path
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from tidemark.functions import urls
from tidemark.functions.variants import parse
from tidemark.operators.ledger import register_batches, run_states, update_sources
from tidemark.operators.reconcile import check_arrived
from tidemark.operators.tables import dataset_stats
from tidemark.operators.watermark import high_water_mark, run_checkpoint
from tidemark.options import PipelineError, SourceConfig
from tidemark.sources.landing import content_digest, landing_name, write_landing
from tidemark.sources.manifests import pack_manifests, read_manifests
from tidemark.sources.pages import (
    assemble_pages, empty_payload, envelope, next_links, page_chain_audit, pagination_complete, run_complete,
    run_problems,
)
from tidemark.sources.slices import list_page

BASE = "https://api.test/items"


def pages(spark, bodies, urls=None, headers=None, run="1"):
    rows = [
        ("s", run, n + 1, (urls or {}).get(n, f"{BASE}?page={n + 1}"), (headers or {}).get(n),
         body if isinstance(body, str) else json.dumps(body))
        for n, body in enumerate(bodies)
    ]
    frame = spark.createDataFrame(
        rows, "source STRING, run_id STRING, page_no BIGINT, url STRING, link_header STRING, t STRING"
    )
    return frame.withColumn("body", parse(frame.t)).drop("t")


def links(frame):
    return [
        (r["link_kind"], r["next_url"], r["link_problem"]) for r in next_links(frame).orderBy("page_no").collect()
    ]


def test_offset_pages(spark):
    bodies = [{"items": [{"id": i + 1}], "total": 3, "skip": i, "limit": 1} for i in range(3)]
    urls = {0: BASE, 1: f"{BASE}?skip=1&limit=1", 2: f"{BASE}?skip=2&limit=1"}
    frame = pages(spark, bodies, urls)
    assert links(frame) == [
        ("offset", f"{BASE}?skip=1&limit=1", None), ("offset", f"{BASE}?skip=2&limit=1", None), (None, None, None),
    ]
    assert page_chain_audit(frame).where("problem IS NOT NULL").isEmpty()
    ids = assemble_pages(frame).orderBy("root_index").selectExpr("root_index", "variant_get(rec, '$.id', 'int')")
    assert [tuple(r) for r in ids.collect()] == [(0, 1), (1, 2), (2, 3)]
    assert run_complete(frame).first()["pagination_complete"] is True
    assert json.loads(envelope(frame).first()["metadata"]) == {"total": 3, "skip": 2, "limit": 1}


def test_link_kinds(spark):
    assert links(pages(spark, [[1]], headers={0: f'<{BASE}?page=2>; rel="next"'}))[0][:2] == ("header", f"{BASE}?page=2")
    assert links(pages(spark, [[1]], headers={0: f'<{BASE}?page=0>; rel="prev"'}))[0] == (None, None, None)
    assert links(pages(spark, [{"items": [1], "next": "items?page=2"}]))[0][:2] == ("next", f"{BASE}?page=2")
    assert links(pages(spark, [{"items": [1], "next": None, "links": {"next": "/x"}}]))[0][:2] == (
        "links.next", "https://api.test/x")
    assert links(pages(spark, [{"items": [1], "has_more": True}]))[0][:2] == ("page", f"{BASE}?page=2")
    assert links(pages(spark, [{"items": [1], "has_more": True, "page": 7}]))[0][:2] == ("page", f"{BASE}?page=8")
    assert links(pages(spark, [{"items": [1], "offset": 0, "total": 9, "limit": 1}]))[0][:2] == (
        "offset", f"{BASE}?page=1&offset=1&limit=1")


def test_link_problems(spark):
    assert links(pages(spark, [{"items": [], "total": 5, "skip": 0, "limit": 2}]))[0][2] == "no progress"
    assert links(pages(spark, [{"items": [], "has_more": True}]))[0][2] == "no progress"
    bad = pages(spark, [{"items": [1], "has_more": True}], {0: f"{BASE}?page=x"})
    assert links(bad)[0] == ("page", None, "page is not a number")


def test_repeated_address(spark):
    bodies = [{"items": [1], "next": BASE}, {"items": [2]}]
    found = page_chain_audit(pages(spark, bodies, {0: BASE, 1: BASE})).orderBy("page_no").collect()
    assert [r["problem"] for r in found] == [None, "repeated URL"]


def test_shapes_that_do_not_fit(spark):
    def problem(*bodies):
        return run_problems(pages(spark, bodies)).first()["problem"]

    assert problem({"items": [1]}, {"items": [2]}) is None
    assert problem({"rows": [1], "x": 1}, {"rows": [2]}) is None
    assert problem({"a": 1}) is None
    assert problem({"items": [1]}, {"data": [2]}) == "pages differ in shape"
    assert problem([1], {"items": [2]}) == "pages differ in shape"
    assert problem({"items": [1]}, {"a": 1}) == "pages differ in shape"
    assert problem({"a": [1], "b": [2]}, {"a": [1], "b": [2]}) == "pages differ in shape"
    with pytest.raises(ValueError, match="pages differ in shape"):
        assemble_pages(pages(spark, [{"items": [1]}, {"data": [2]}]))


def test_extract_of_many_pages(spark):
    frame = pages(spark, [{"items": [n, n]} for n in range(5000)])
    assert run_problems(frame).first()["problem"] is None
    found = assemble_pages(frame).selectExpr("root_index", "variant_get(rec, '$', 'int') AS n")
    assert found.where("n <> root_index div 2").isEmpty() and found.count() == 10000
    assert page_chain_audit(frame.withColumn("url", F.concat(F.lit("https://x/?page="), "page_no"))).where(
        "problem = 'too many pages'").isEmpty()


@pytest.mark.parametrize("base, link", [
    ("https://x/a/b", "../c?y=2"), ("https://x/a/b", "./c"), ("https://x/a/", "../../../d"), ("https://x/a/b", "c/./d/../e"),
    ("https://x/a?q", "/u/../v?w=../z"), ("https://x", "c"), ("https://x/a/b", "."), ("https://x/a/b/c", ".."), ("https://x/a", "x..y/z"),
])
def test_dot_segments(spark, base, link):
    row = spark.range(1).select(urls.join_url(F.lit(base), F.lit(link))).first()
    assert row[0] == urljoin(base, link)


@pytest.mark.parametrize("header, target", [
    ('<a>; rel="prev next"', "a"), ('<a>; title="x, y; z"; rel=next', "a"), ('<a>; rel=prev, <b>; REL="Next"', "b"), (None, ""),
    ('<a>; rel="nextish"', ""), ("<a,b;c>;rel=next", "a,b;c"), ('<a>; rel=first; title="rel=next"', ""),
])
def test_link_header(spark, header, target):
    assert spark.range(1).select(urls.header_link(F.lit(header).cast("string"), "next")).first()[0] == target


@pytest.mark.parametrize("body, complete", [
    ({"items": [1], "next_cursor": "c"}, False), ({"items": [1], "next": ""}, True), ({"a": [{"b": {"has_more": True}}]}, False),
    ({"has_more": "true"}, True), ({"total": 3, "skip": 0, "limit": 2}, False), ({"total": 3, "skip": 1, "limit": 2}, True),
    ({"total": 3, "limit": 2, "offset": 1, "items": [1]}, False), ({"total": 3, "limit": 9, "items": [1]}, False),
    ({"total": 1, "limit": 9, "items": [1], "errors": []}, True), ({"total": "3", "skip": 0, "limit": 2}, True),
    ({"total": 3, "skip": None, "offset": 0, "limit": 1}, True), ([], True), (5, True),
])
def test_completeness(spark, body, complete):
    assert pagination_complete(pages(spark, [body])).first()["complete"] is complete


@pytest.mark.parametrize("text, empty", [
    ("null", True), ("[]", True), ("{}", True), ('{"items":[],"total":0}', True), ('{"items":[1]}', False),
    ('{"total":0}', False), ("0", False), ('""', False), ("[[]]", False),
])
def test_empty_payload(spark, text, empty):
    assert spark.range(1).select(empty_payload(parse(F.lit(text)))).first()[0] is empty


# ---- marks -----------------------------------------------------------------------------

def recs(spark, *items):
    frame = spark.createDataFrame([(i, json.dumps(item)) for i, item in enumerate(items)], "root_index BIGINT, t STRING")
    return frame.select("root_index", parse(frame.t).alias("rec"))


def test_mark_across_zones(spark):
    found = high_water_mark(recs(
        spark, {"updated_at": "2026-01-01T15:00:00+03:00"}, {"x": [{"updated_at": "2026-01-01T11:30:00+00:00"}]},
    ), "updated_at").first()
    assert tuple(found) == ("2026-01-01T12:00:00+00:00", 2, 0)


def test_mark_does_not_move_back(spark):
    found = high_water_mark(recs(spark, {"u": "2026-01-01T09:00:00Z"}), "u", "2026-01-01T10:00:00Z").first()
    assert found["checkpoint"] == "2026-01-01T10:00:00+00:00"


def test_checkpoint_rules(spark):
    before = "2026-01-01T10:00:00Z"
    empty = recs(spark, {"id": 1}).where("root_index < 0")
    assert run_checkpoint(empty, "u", "incremental_upsert", before, True) == before
    assert run_checkpoint(recs(spark, {"id": 1}), "u", "full_snapshot", None, False) is None
    assert run_checkpoint(recs(spark, {"id": 1}), "", "incremental_upsert", None, False) is None
    assert run_checkpoint(recs(spark, {"items": []}), "u", "incremental_upsert", before, True, True) == before
    for items, mode, old in (
        ([{"id": 1}], "incremental_upsert", before), ([{"u": 5}], "incremental_upsert", before),
        ([{"u": None}], "incremental_upsert", before), ([{"u": "soon"}], "incremental_upsert", before),
        ([{"u": "2026-01-01"}], "incremental_upsert", "bad"),
    ):
        with pytest.raises(ValueError):
            run_checkpoint(recs(spark, *items), "u", mode, old, True)
    with pytest.raises(ValueError):
        run_checkpoint(empty, "u", "full_snapshot", None, True)


# ---- landing ---------------------------------------------------------------------------

def test_digest_depends_on_content_and_order_only(spark):
    frame = recs(spark, *[{"id": i} for i in range(50)])
    rows, size, digest = content_digest(frame)
    assert rows == 50 and size == sum(len(f'{{"id":{i}}}') for i in range(50))
    assert content_digest(frame.repartition(7))[2] == digest
    swapped = frame.withColumn("root_index", 49 - F.col("root_index"))
    assert content_digest(swapped)[2] != digest
    assert content_digest(frame.where("root_index < 0"))[:2] == (0, 0)


def test_landing_and_manifest(spark, folder):
    manifest = write_landing(recs(spark, {"v": 1.0}, {"v": 2}), folder, "My Källa", {"run_id": "4", "load_mode": "full_snapshot"})
    assert manifest["rows"] == 2 and manifest["payload_filename"].startswith("my_källa_")
    found = read_manifests(spark, folder).first()
    assert (found["run_id"], found["sha256"], found["_corrupt"]) == ("4", manifest["sha256"], None)
    with open(f"{folder}/bad.manifest.json", "w") as out:
        out.write("{")
    assert sum(r["_corrupt"] is not None for r in read_manifests(spark, folder).collect()) == 1
    assert landing_name(spark, "***").startswith("source_")


def test_manifests_lie_packed_or_alone(spark, folder):
    bodies = {"a": '{"source":\n "x", "byte_size": 3}', "b": "{", "c": "", "d": "[1", None: "{}"}
    made = [(name and f"{name}.manifest.json", body) for name, body in bodies.items()]
    pack_manifests(spark.createDataFrame(made, "manifest_filename STRING, value STRING"), folder)
    # Many manifests are few files.
    assert len(list(Path(folder, "_manifests").glob("*.parquet"))) <= spark.sparkContext.defaultParallelism

    def found():
        return {
            row["manifest_filename"][0]: (row["source"], row["byte_size"], row["_corrupt"])
            for row in read_manifests(spark, folder).collect()
        }

    packed = {"a": ("x", 3, None), "b": (None, None, "{"), "c": (None, None, ""), "d": (None, None, "[1")}
    assert found() == packed
    Path(folder, "e.manifest.json").write_text('{"source": "y"}')
    assert found() == packed | {"e": ("y", None, None)}


# ---- slices, synthetic data and ledgers ------------------------------------------------

def test_list_page(spark):
    table = spark.range(10).selectExpr("id", "timestamp_seconds(id) AS updated_at")
    since = F.lit(datetime(1970, 1, 1, 0, 0, 3, tzinfo=timezone.utc))
    found = list_page(table, "id", 2, 1, since=since).collect()
    assert [(r["id"], r["updated_at"], r["total"], r["has_more"]) for r in found] == [
        (5, "1970-01-01T00:00:05Z", 6, True), (6, "1970-01-01T00:00:06Z", 6, True)
    ]
    assert list_page(table, "id", 5000).first()["has_more"] is False
    for limit, skip in ((0, 0), (10, -1)):
        with pytest.raises(ValueError):
            list_page(table, "id", limit, skip)


def test_sizes(spark):
    table = spark.createDataFrame([(1, "ä", None), (2, 'q"', 1.5)], "a INT, b STRING, c DOUBLE")
    found = dataset_stats(table).first()
    body = json.dumps({
        "items": [{"a": 1, "b": "ä", "c": None}, {"a": 2, "b": 'q"', "c": 1.5}], "total": 2, "skip": 0, "limit": 1000,
        "has_more": False,
    }, separators=(",", ":"), ensure_ascii=False)
    assert tuple(found) == (2, len(body.encode()))


def test_registration(spark):
    ledger = spark.createDataFrame([(5, "a", ["t"])], "id BIGINT, filename STRING, table_names ARRAY<STRING>")
    files = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4)], "filename STRING, arrival BIGINT")
    found = {r["arrival"]: r for r in register_batches(ledger, files).collect()}
    assert (found[1]["batch_id"], found[1]["status"], found[1]["tables"]) == (5, "skipped_duplicate", ["t"])
    assert found[2]["batch_id"] == found[3]["batch_id"] and found[3]["status"] == "skipped_duplicate"
    assert {found[2]["batch_id"], found[4]["batch_id"]} == {6, 7} and found[4]["status"] == "loaded"


def test_run_states_keep_the_latest_value_of_each_field(spark):
    events = spark.createDataFrame([
        (1, 1, datetime(2026, 1, 1), "s", "queued", None), (1, 2, datetime(2026, 1, 2), "s", "running", "f.json"),
        (1, 3, datetime(2026, 1, 3), "s", "failed", None),
    ], "run_id INT, seq INT, at TIMESTAMP, source STRING, status STRING, filename STRING")
    row = run_states(events).first()
    assert (row["status"], row["filename"], row["source"]) == ("failed", "f.json", "s")


def test_source_config():
    source = SourceConfig("s", "https://a.test/", "incremental_upsert", checkpoint="2026-01-01", cron="x", next_run="n")
    source.validate()
    assert source.run_plan() == ("incremental_upsert", "2026-01-01")
    assert source.run_plan(force_full=True) == ("full_snapshot", None)
    assert source.updated(delete_policy="never_close").checkpoint == "2026-01-01"
    assert source.updated(watermark_field="x").checkpoint is None
    assert source.updated(cron="y").next_run is None
    assert SourceConfig("s", "https://a.test/", "incremental_upsert").run_plan() == ("full_snapshot", None)
    assert SourceConfig("s", "https://a.test/", "incremental_upsert", watermark_field="").run_plan() == (
        "incremental_upsert", None)
    for bad in (
        {"url": "ftp://a"}, {"url": "https://"}, {"load_mode": "x"}, {"delete_policy": "x"}, {"key_fields": (" ",)},
        {"load_mode": "incremental_upsert", "incremental_param": " "},
    ):
        with pytest.raises(ValueError):
            SourceConfig(**{"name": "s", "url": "https://x.test", **bad}).validate()


def test_update_of_unknown_source_changes_nothing(spark):
    sources = spark.createDataFrame([(1, "u", "c")], "id INT, url STRING, checkpoint STRING")
    changes = spark.createDataFrame([(2, "v")], "id INT, url STRING")
    assert [tuple(r) for r in update_sources(sources, changes).collect()] == [(1, "u", "c")]


def test_reconciliation():
    check_arrived("core", ["a"], ["a", "b"])
    with pytest.raises(PipelineError, match="b, c"):
        check_arrived("core", ["c", "a", "b"], ["a"])
