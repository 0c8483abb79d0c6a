from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException

from tidemark.functions.variants import parse
from tidemark.operators.flatten import first_seen_types, flatten, table_shapes
from tidemark.operators.shape import discover
from tidemark.plans.queries.documents import sparse_documents
from tidemark.sources.payloads import inspect_content, scan_document, unwrap


def records(spark, items):
    rows = [(i, item if isinstance(item, str) else json.dumps(item)) for i, item in enumerate(items)]
    frame = spark.createDataFrame(rows, "root_index BIGINT, t STRING")
    return frame.select("root_index", parse(frame.t).alias("rec"))


def rows(frame, *columns):
    return [tuple(row[c] for c in columns) for row in frame.orderBy("_parent_key", "_row_index").collect()]


def test_nested_objects_and_arrays(spark):
    flat = flatten(records(spark, [{
        "id": 1, "name": "A", "profile": {"region": "EU", "verified": True},
        "attributes": {"labels": ["x", "y"]}, "tags": [{"id": 7, "value": "t"}],
        "orders": [{"id": 5, "amount": 1.5}, {"id": 6, "amount": 2.0}],
    }]), "Shop", 3)
    assert sorted(flat.tables) == ["shop", "shop_attributes_labels", "shop_orders", "shop_tags"]
    assert flat.types["shop"] == {
        "id": "bigint", "name": "text", "profile_region": "text", "profile_verified": "boolean",
    }
    assert rows(flat.tables["shop"], "id", "name", "profile_verified", "_source_batch_id", "_parent_id") == [
        (1, "A", True, 3, None)
    ]
    assert rows(flat.tables["shop_orders"], "_parent_key", "_row_index", "id", "amount") == [
        ('["shop",1]', 0, 5, 1.5), ('["shop",1]', 1, 6, 2.0)
    ]
    assert rows(flat.tables["shop_attributes_labels"], "_row_index", "value") == [(0, "x"), (1, "y")]


def test_row_ids_are_unique_and_stable(spark):
    source = records(spark, [{"id": i, "a": [{"b": [1, 2]}, {"b": [3]}]} for i in range(20)])
    first, again = flatten(source, "s", 1), flatten(source, "s", 1)
    ids = {
        name: [r["_row_id"] for r in flat.collect()] for name, flat in first.tables.items()
    }
    every = [i for found in ids.values() for i in found]
    assert len(every) == len(set(every)) == 20 + 40 + 60
    assert sorted(ids["s_a_b"]) == sorted(r["_row_id"] for r in again.tables["s_a_b"].collect())
    parents = {r["_parent_id"] for r in first.tables["s_a_b"].collect()}
    assert parents == set(ids["s_a"])


def test_empty_root_keeps_its_table(spark):
    flat = flatten(records(spark, []), "s", 1)
    assert list(flat.tables) == ["s"] and flat.tables["s"].count() == 0


def test_empty_array_registers_its_table_and_absent_one_does_not(spark):
    flat = flatten(records(spark, [{"id": 1, "tags": []}]), "s", 1)
    assert sorted(flat.tables) == ["s", "s_tags"]
    assert flat.tables["s_tags"].count() == 0 and flat.types["s_tags"] == {}
    assert sorted(flatten(records(spark, [{"id": 1}]), "s", 1).tables) == ["s"]


def test_records_that_are_not_objects(spark):
    flat = flatten(records(spark, ["5", '{"id":1}', "[1,2]", "null"]), "s", 1)
    assert flat.types["s"] == {"value": "bigint", "id": "bigint"} or flat.types["s"]["value"] == "bigint"
    with pytest.raises(PySparkException):
        flat.tables["s"].collect()
    flat = flatten(records(spark, ['"a"', "[1,2]", "null"]), "s", 1)
    assert rows(flat.tables["s"], "_row_index", "value") == [(0, "a"), (1, "[1,2]"), (2, None)]


def test_lists_in_lists_and_nulls_in_arrays(spark):
    flat = flatten(records(spark, [{"id": 1, "m": [[1, 2], "x", None], "o": [None, {"a": 1}]}]), "s", 1)
    assert rows(flat.tables["s_m"], "_row_index", "value") == [(0, "[1,2]"), (1, "x"), (2, None)]
    assert flat.types["s_o"] == {"value": "text", "a": "bigint"}
    assert rows(flat.tables["s_o"], "_row_index", "value", "a") == [(0, None, None), (1, None, 1)]


def test_parent_keys(spark):
    flat = flatten(records(spark, [
        {"id": "ä", "kids": [{"id": "k", "toys": [{"n": 1}]}, {"toys": [{"n": 2}]}]},
        {"kids": [{"id": "k", "toys": [{"n": 3}]}, {"toys": [{"n": 4}]}]},
        {"id": {"x": 1}, "kids": [{"id": True, "toys": [{"n": 5}]}]},
    ]), "s", 1)
    top = json.dumps(["s", "ä"], separators=(",", ":"))
    assert {r["_parent_key"] for r in flat.tables["s_kids"].collect()} == {top, None}
    keys = {r["n"]: r["_parent_key"] for r in flat.tables["s_kids_toys"].collect()}
    assert keys == {
        1: json.dumps([top, "s_kids", "k"], separators=(",", ":")),
        2: json.dumps([top, "s_kids", 1], separators=(",", ":")),
        3: '["s_kids","k"]', 4: None, 5: '["s_kids",true]',
    }


def test_names_that_collide(spark):
    flat = flatten(records(spark, [
        {"A-b": 1, "a_b": 2}, {"A-b": 3}, {"x y": [1], "x_y": [2]},
    ]), "s", 1)
    assert rows(flat.tables["s"], "a_b") == [(2,), (3,), (None,)]
    assert sorted(r["value"] for r in flat.tables["s_x_y"].collect()) == [1, 2]


def test_mixed_structure_at_one_path(spark):
    flat = flatten(records(spark, [{"id": 1, "v": {"a": 1}}, {"id": 2, "v": 3}, {"id": 3, "v": [4]}, {"id": 4, "v": None}]), "s", 1)
    assert flat.types == {"s": {"id": "bigint", "v": "bigint", "v_a": "bigint"}, "s_v": {"value": "bigint"}}
    assert rows(flat.tables["s"], "id", "v", "v_a") == [(1, None, 1), (2, 3, None), (3, None, None), (4, None, None)]


def test_null_beside_structure_is_a_text_column(spark):
    flat = flatten(records(spark, [{"id": 1, "meta": None, "tags": None}, {"id": 2, "meta": {"a": 1}, "tags": ["x"]}]), "s", 1)
    assert flat.types["s"] == {"id": "bigint", "meta": "text", "meta_a": "bigint", "tags": "text"}


def test_first_seen_type_wins(spark):
    flat = flatten(records(spark, [
        '{"a":"1","b":null,"c":1,"d":1.5,"e":true}', '{"a":2,"b":2.50,"c":" 7 ","d":3,"e":"off"}',
        '{"a":true,"b":false,"c":null,"d":"4.5","e":null}', '{"a":1e20,"b":[1],"c":2}',
    ]), "s", 1)
    assert flat.types["s"] == {"a": "text", "b": "text", "c": "bigint", "d": "double", "e": "boolean"}
    assert rows(flat.tables["s"], "a", "b", "c", "d", "e") == [
        ("1", None, 1, 1.5, True), ("2", "2.5", 7, 3.0, False), ("true", "false", None, 4.5, None),
        ("1e+20", None, 2, None, None),
    ]


def test_known_types_stay(spark):
    known = {"s": {"old": "text", "a": "text"}}
    flat = flatten(records(spark, [{"a": 1, "z": 2}]), "s", 2, known)
    assert flat.types["s"] == {"old": "text", "a": "text", "z": "bigint"}
    assert rows(flat.tables["s"], "old", "a", "z") == [(None, "1", 2)]


@pytest.mark.parametrize("second", ['{"a":1.5}', '{"a":true}', '{"a":"x"}', '{"a":9223372036854775808}'])
def test_value_that_does_not_fit_fails(spark, second):
    flat = flatten(records(spark, ['{"a":1}', second]), "s", 1)
    with pytest.raises(PySparkException, match="s.a: cannot store"):
        flat.tables["s"].collect()


def test_whole_numbers_may_be_written_with_a_point(spark):
    texts = ['{"a":1,"b":["x"]}', '{"a":1.0}', '{"a":-2.50e1,"b":["y",null]}', '{"a":3e3}', '{"a":9007199254740993.0}']
    flat = flatten(records(spark, texts), "s", 1)
    assert flat.types == {"s": {"a": "bigint"}, "s_b": {"value": "text"}}
    assert rows(flat.tables["s"], "a") == [(1,), (1,), (-25,), (3000,), (9007199254740993,)]


def test_text_columns_need_no_second_pass(spark):
    data = records(spark, [{"a": None, "b": "y"}, {"a": "x", "b": None}, {"c": "z"}])
    assert first_seen_types(None, table_shapes("s", discover(data))) == {"s": {"a": "text", "b": "text", "c": "text"}}


def test_types_inside_one_record_follow_its_order(spark):
    flat = flatten(records(spark, ['{"x":[{"v":"s"},{"v":1}]}']), "s", 1)
    assert flat.types["s_x"] == {"v": "text"}
    flat = flatten(records(spark, ['{"x":[{"v":1},{"v":"2"}]}']), "s", 1)
    assert flat.types["s_x"] == {"v": "bigint"}


def test_odd_keys(spark):
    item = {"a.b": 1, "it's": 2, 'q"': 3, "k`t": 4, "": 5, "OBJECT<": 6, "both'\"": {"n": 7}, "B": 8, "$x[0]": 9}
    flat = flatten(records(spark, [item]), "s", 1)
    row = flat.tables["s"].first()
    found = {c: row[c] for c in flat.types["s"]}
    assert found == {"a_b": 1, "it_s": 2, "q": 3, "k_t": 4, "col": 5, "object": 6, "both_n": 7, "b": 8, "x_0": 9}


def test_repeated_key_last_wins(spark):
    assert rows(flatten(records(spark, ['{"a":1,"a":2}']), "s", 1).tables["s"], "a") == [(2,)]


def test_reserved_column_is_refused(spark):
    with pytest.raises(ValueError, match="reserved"):
        flatten(records(spark, [{"id": 1, "valid_from": "x"}]), "s", 1)


def test_too_many_paths(spark):
    with pytest.raises(ValueError, match="distinct paths"):
        discover(records(spark, [{f"k{i}": 1 for i in range(50)}]), max_paths=20)


@pytest.mark.parametrize("text, expected", [
    ('{"items":[{"id":1},{"id":2}],"total":2}', ['{"id":1}', '{"id":2}']), ('[{"id":1},5]', ['{"id":1}', "5"]),
    ('{"items":[{"id":1}]}', ['{"items":[{"id":1}]}']), ('{"rows":[1],"total":1}', ['{"rows":[1],"total":1}']),
    ('{"items":5,"data":[1],"next":null}', ["1"]), ("7", ["7"]), ("[]", []),
])
def test_envelopes(spark, text, expected):
    documents = spark.createDataFrame([(text,)], "t STRING")
    found = unwrap(documents.select(parse(documents.t).alias("body"))).orderBy("root_index")
    assert [r[0] for r in found.selectExpr("to_json(rec)").collect()] == expected


def test_document_files(spark, folder):
    path = f"{folder}/doc.json"
    with open(path, "w", encoding="utf-8") as out:
        json.dump({"products": [{"id": 2}, {"id": 1}], "total": 2, "skip": 0, "limit": 2}, out)
    found = scan_document(spark, path).selectExpr("root_index", "to_json(rec)").orderBy("root_index").collect()
    assert [tuple(r) for r in found] == [(0, '{"id":2}'), (1, '{"id":1}')]


def test_inspection(spark):
    texts = [b'{"items":[],"total":0}', b"[1]", b"5", b"{", b"", b"\xff", b'{"items":[]}']
    found = inspect_content(spark.createDataFrame([(i, bytearray(t)) for i, t in enumerate(texts)], "i INT, content BINARY"))
    facts = [(r["is_json"], r["root_type"], r["collection_key"], r["byte_size"]) for r in found.orderBy("i").collect()]
    assert facts == [
        (True, "object", "items", 22), (True, "array", None, 3), (True, "scalar", None, 1), (False, None, None, 1),
        (False, None, None, 0), (False, None, None, 1), (True, "object", None, 12),
    ]


def test_empty_arrays_beside_all_columns_of_all_documents(spark):
    made = [(n, f"text {n}\n", None if n % 5 == 0 else "en", f"src{n % 3}", 6 + n) for n in range(40)]
    documents = spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long")
    tables = sparse_documents(documents)
    found = tables["sparse"].select("doc_id", "text", "lang", "source", "n_chars").collect()
    assert sorted(tuple(row) for row in found) == made
    assert tables["sparse_none"].count() == 0


def test_plain_text_is_read_as_it_is(spark):
    items = [{"t": "a", "m": "b", "n": 1}, {"t": None, "m": 2.5, "n": None}, {"m": {"x": "y"}}, {"t": "", "m": [1], "n": 3}]
    flat = flatten(records(spark, items), "s", 1).tables["s"]
    assert rows(flat, "t", "m", "m_x", "n") == [("a", "b", None, 1), (None, "2.5", None, None), (None, None, "y", None), ("", None, None, 3)]
    # Text and nulls need no look at the kind of each value; a text in a column of numbers does.
    plan = flat.select("t")._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "schemaofvariant" not in plan and "schema_of_variant" not in plan
    typed = flatten(records(spark, [{"t": "7"}, {"t": None}]), "s", 1, {"s": {"t": "bigint"}})
    assert rows(typed.tables["s"], "t") == [(7,), (None,)]
    # Records that are text, and keys that collide.
    assert rows(flatten(records(spark, ["\"a\"", "null"]), "s", 1).tables["s"], "value") == [("a",), (None,)]
    assert rows(flatten(records(spark, [{"A b": "x"}, {"a_b": "y"}]), "s", 1).tables["s"], "a_b") == [("x",), ("y",)]
