from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import names, urls, values
from tidemark.functions.instants import iso_text, parse_instant
from tidemark.functions.numbering import dense_ids, running_total
from tidemark.functions.variants import kind, parse, truthy


@pytest.mark.parametrize("raw, expected", [
    ("Order Lines", "order_lines"), ("  A-b  ", "a_b"), ("2024 sales", "c_2024_sales"), ("---", "col"),
    ("_row_id", "row_id"), ("Käse", "k_se"), ("a__b", "a_b"),
])
def test_identifier(spark, raw, expected):
    assert names.identifier(raw) == expected
    row = spark.createDataFrame([(raw,)], "n STRING").select(names.identifier_column(F.col("n"))).first()
    assert row[0] == expected


def test_names_are_not_cut():
    long = "x" * 80
    assert names.identifier(long) == long and names.mart_name(names.dimension_name(long)) == long
    assert names.mart_name("dim_") == ""


def test_reserved_names():
    with pytest.raises(ValueError):
        names.check_root_table("user")
    with pytest.raises(ValueError):
        names.check_columns("t", ["a", "valid_from"])


def test_slug_keeps_letters_of_any_script(spark):
    rows = spark.createDataFrame([(" Käse & Brot-1 ",), ("***",)], "n STRING")
    assert [r[0] for r in rows.select(names.source_slug(F.col("n"))).collect()] == ["käse___brot-1", "source"]


@pytest.mark.parametrize("number, text", [
    (1.0, "1"), (0.5, "0.5"), (-2.25, "-2.25"), (1e10, "10000000000"), (123456789.125, "123456789.125"),
    (1e14, "100000000000000"), (1e15, "1e+15"), (1.5e300, "1.5e+300"), (0.0001, "0.0001"),
    (0.00001, "1e-05"), (0.0, "0"), (-0.0, "-0"), (0.1, "0.1"), (100.0, "100"),
])
def test_double_text(spark, number, text):
    row = spark.createDataFrame([(number,)], "v DOUBLE").select(values.double_text(F.col("v"))).first()
    assert row[0] == text


def test_double_text_for_json_keys_is_python_text(spark):
    numbers = [1.0, 2.5, 1e15, 1e16, 1.25e-7, 12345678.0, -3.0]
    rows = spark.createDataFrame([(n,) for n in numbers], "v DOUBLE")
    texts = [r[0] for r in rows.select(values.double_text(F.col("v"), 16, keep_point=True)).collect()]
    assert texts == [repr(n) for n in numbers]


def test_record_text(spark):
    schema = "a BIGINT, b STRING, c BOOLEAN, d DOUBLE"
    rows = spark.createDataFrame([
        (1, "x", True, 2.0), (None, None, None, None), (2, "", False, 0.5), (3, 'a "b", (c)\\', None, 1e20),
    ], schema)
    types = {item.name: item.dataType for item in rows.schema}
    text = values.record_text((F.col(name), types[name]) for name in rows.columns)
    assert [r[0] for r in rows.select(text).collect()] == [
        "(1,x,t,2)", "(,,,)", '(2,"",f,0.5)', '(3,"a ""b"", (c)\\\\",,1e+20)',
    ]


def test_hash_tells_null_from_empty_and_needs_no_columns(spark):
    rows = spark.createDataFrame([(None,), ("",)], "a STRING")
    hashes = [r[0] for r in rows.select(values.content_hash([(F.col("a"), T.StringType())])).collect()]
    assert hashes[0] != hashes[1]
    assert len({r[0] for r in rows.select(values.content_hash([])).collect()}) == 1


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(exclude_categories=["Cs"])), min_size=1, max_size=8))
def test_json_string_is_python_json(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING")
    found = rows.select("i", values.json_string(F.col("t")).alias("j")).orderBy("i").collect()
    assert [row["j"] for row in found] == [json.dumps(text) for text in texts]


@pytest.mark.parametrize("text, expected", [
    ("2026-01-01T15:00:00+03:00", "2026-01-01T12:00:00+00:00"), ("2026-01-01T11:30:00Z", "2026-01-01T11:30:00+00:00"),
    ("2026-01-01", "2026-01-01T00:00:00+00:00"), ("2026-01-01T11:30", "2026-01-01T11:30:00+00:00"),
    ("20260101T113000Z", "2026-01-01T11:30:00+00:00"), ("2026-01-01 11:30:00.25", "2026-01-01T11:30:00.250000+00:00"),
    ("2026-01-01T11:30:00+0530", "2026-01-01T06:00:00+00:00"), ("2026", None), ("yesterday", None), ("2026-13-01", None),
    ("", None),
])
def test_instants(spark, text, expected):
    row = spark.createDataFrame([(text,)], "t STRING").select(iso_text(parse_instant(F.col("t")))).first()
    assert row[0] == expected


@pytest.mark.parametrize("text, expected", [
    ("2026-01-01T11:30:00.123456789Z", "2026-01-01T11:30:00.123456+00:00"), ("2026-01-01 11:30:00-02:30", "2026-01-01T14:00:00+00:00"),
    ("2026-01-01T11:30:00,5Z", "2026-01-01T11:30:00.500000+00:00"), ("2026-02-30T00:00:00Z", None), ("2026-01-01T25:00:00Z", None),
    (" 2026-01-01T11:30:00Z", None), ("2026-01-01T11:30:00Z ", None), ("2026-01-01T11:30:00Z\n", "2026-01-01T11:30:00+00:00"), ("2026-01-01T11:30:00+25:00", None),
])
def test_instants_that_are_cast_as_they_stand(spark, text, expected):
    row = spark.createDataFrame([(text,)], "t STRING").select(iso_text(parse_instant(F.col("t")))).first()
    assert row[0] == expected


def test_instants_do_not_depend_on_the_session_zone(spark):
    rows = spark.createDataFrame([("2026-01-01T11:30:00",), ("20260101T113000",)], "t STRING")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        texts = [r[0] for r in rows.select(iso_text(parse_instant(F.col("t")), "Z")).collect()]
        assert texts == ["2026-01-01T11:30:00Z"] * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("url, allowed", [
    ("https://shop.test/products", True), ("https://api.shop.test/x", True), ("https://a.b.sub.test/", True),
    ("https://sub.test/", False), ("https://notshop.test/", False), ("https://shop.test.evil/", False),
    ("ftp://shop.test/", False), (" HTTPS://Shop.Test:8443/p ", True), ("local://demo", True),
    ("LOCAL://demo", False), ("https://user@shop.test/", True), ("https://shop.test@evil.test/", False), ("", False),
    ("http://demo/", False), ("https:///shop.test", False),
])
def test_allowed_hosts(spark, url, allowed):
    entries = urls.read_allowed(["# list", "", "local://demo", "Shop.test", "*.shop.test", "*.sub.test"])
    row = spark.createDataFrame([(url,)], "u STRING").select(urls.is_allowed(F.col("u"), entries)).first()
    assert row[0] is allowed


@pytest.mark.parametrize("base, link, expected", [
    ("https://h.test/a/b?x=1", "c", "https://h.test/a/c"), ("https://h.test/a/b", "/c?d=1", "https://h.test/c?d=1"),
    ("https://h.test/a/b?x=1", "?x=2", "https://h.test/a/b?x=2"), ("https://h.test", "c", "https://h.test/c"),
    ("https://h.test/a", "http://o.test/z", "http://o.test/z"), ("https://h.test/a", "//o.test/z", "https://o.test/z"),
])
def test_join_url(spark, base, link, expected):
    rows = spark.createDataFrame([(base, link)], "b STRING, l STRING")
    assert rows.select(urls.join_url(F.col("b"), F.col("l"))).first()[0] == expected


def test_query_parameters(spark):
    rows = spark.createDataFrame([("https://h.test/a?page=1&x=2#f",), ("https://h.test/a",)], "u STRING")
    out = rows.select(
        urls.with_query_param(F.col("u"), F.lit("page"), F.lit("5")), urls.query_param(F.col("u"), "page")
    ).collect()
    assert [tuple(row) for row in out] == [("https://h.test/a?page=5&x=2", "1"), ("https://h.test/a?page=5", None)]


def test_running_total_crosses_blocks(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS g", "id DIV 3 AS n", "id % 7 AS v")
    found = {(r["g"], r["n"]): r["t"] for r in running_total(rows, ["g"], "n", "v", "t", block=16).collect()}
    for group in range(3):
        total = 0
        for row in sorted((r for r in rows.collect() if r["g"] == group), key=lambda r: r["n"]):
            assert found[group, row["n"]] == total
            total += row["v"]


def test_dense_ids(spark):
    rows = spark.range(500).selectExpr("concat('f', id) AS f")
    ids = sorted(r["n"] for r in dense_ids(rows, "f", F.lit(100), "n", buckets=16).collect())
    assert ids == list(range(101, 601))


@pytest.mark.parametrize("text, expected", [
    ("null", False), ("0", False), ("0.0", False), ('""', False), ("[]", False), ("{}", False), ("false", False),
    ("1", True), ('"a"', True), ("[0]", True), ('{"a":null}', True), ("true", True),
])
def test_truthy(spark, text, expected):
    assert spark.range(1).select(truthy(parse(F.lit(text)))).first()[0] is expected


@pytest.mark.parametrize("text, expected", [
    ("1", "bigint"), ("1.0", "double"), ("1e3", "double"), ("true", "boolean"), ("null", "null"), ('"1"', "text"),
    ("[]", "array"), ("{}", "object"), ("9223372036854775808", "bigint"),
])
def test_kind(spark, text, expected):
    assert spark.range(1).select(kind(parse(F.lit(text)))).first()[0] == expected


def test_utc_datetimes(spark):
    at = datetime(2026, 1, 1, 12, tzinfo=timezone.utc)
    assert spark.range(1).select(iso_text(F.lit(at))).first()[0] == "2026-01-01T12:00:00+00:00"
