"""Records of large JSON arrays, read in splits."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.errors import PySparkException

from tidemark import SourceConfig, Warehouse, run_source
from tidemark.plans.run import land_document
from tidemark.sources.arrays import scan_arrays
from tidemark.sources.payloads import scan_document

TEXTS = ["", "a", '"', "\\", '\\"', "}", "{", "]}", '[{"', "\n\t", "é漢🙂", 'x"}]', "\\\\", "},{", " " * 30]


def value(draw, depth=0):
    kind = draw.random()
    if kind < 0.35 or depth > 3:
        return draw.choice([None, True, 1, -2.5, *TEXTS])
    if kind < 0.6:
        return [value(draw, depth + 1) for _ in range(draw.randint(0, 3))]
    return {draw.choice(["a", "b}", 'c"', "{d"]) + str(n): value(draw, depth + 1) for n in range(draw.randint(0, 4))}


def written(spark, folder, texts):
    for n, text in enumerate(texts):
        with open(f"{folder}/{n}.json", "w", encoding="utf-8") as file:
            file.write(text)
    rows = scan_arrays(spark, folder).selectExpr("file", "root_index", "to_json(rec) AS t").collect()
    found = {n: {} for n in range(len(texts))}
    for row in rows:
        own = found[int(row["file"].rsplit("/", 1)[1].split(".")[0])]
        assert row["root_index"] not in own
        own[row["root_index"]] = json.loads(row["t"])
    return [[own[n] for n in range(len(own))] for own in found.values()]


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}
    before = {name: spark.conf.get(name) for name in names}
    for name, size in names.items():
        spark.conf.set(name, size)
    yield
    for name, size in before.items():
        spark.conf.set(name, size)


@pytest.mark.parametrize("seed", range(3))
def test_any_records_over_splits(spark, folder, small_splits, seed):
    draw = random.Random(seed)
    arrays = [[{"n": n, "v": value(draw)} for n in range(draw.choice([1, 7, 90]))] for _ in range(4)]
    indents = [None, 1, None, 3]
    texts = [json.dumps(items, ensure_ascii=draw.random() < 0.5, indent=indent) for items, indent in zip(arrays, indents)]
    assert written(spark, folder, texts) == arrays


def test_other_values_between_objects(spark, folder, small_splits):
    arrays = [[], [{}], [1, "}", None], [{"a": 1}, 7, [{"b": 2}, "]"], {"c": 3}, {"d": 4}, None], [[1], [{"x": "y"}]], ["a" * 3000, {}]]
    assert written(spark, folder, [json.dumps(items) for items in arrays] + [" \n[ \n] \n"]) == [*arrays, []]


@pytest.mark.parametrize("text", ['{"a":1}', '[{"a":1} {"b":2}]', '[{"a":1}', '[{"a":1},]', "", '[{"a":1}]]x'])
def test_files_that_are_no_arrays(spark, folder, text):
    with open(f"{folder}/x.json", "w") as file:
        file.write(text)
    if not text:
        assert scan_arrays(spark, folder).collect() == []
        return
    with pytest.raises((PySparkException, ValueError)):
        scan_arrays(spark, folder).collect()


def test_long_text_of_another_program_runs(spark, folder, small_splits):
    with open(f"{folder}/feed.json", "w") as file:
        json.dump([{"id": n, "tags": [{"t": "}" * (n % 3)}]} for n in range(60)], file)
    assert scan_document(spark, f"{folder}/feed.json").count() == 60
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    source = SourceConfig("feed", "https://a.test/feed", watermark_field="")
    request = land_document(warehouse, f"{folder}/feed.json", source, 1, "full_snapshot", None, f"{folder}/landing")
    result = run_source(warehouse, source, folder=f"{folder}/landing", request=request)
    assert result.tables == {"feed": 60, "feed_tags": 60}
    assert sorted(r["id"] for r in warehouse.mart("feed").collect()) == list(range(60))
