from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import hamming_search


def brute(rows, queries, k):
    rows, found = sorted(set(rows)), []
    for own, code in sorted(set(queries)):
        near = sorted((((code ^ other) & (2 ** 64 - 1)).bit_count(), i) for i, other in rows if i != own)
        found += [(own, i, distance, rank + 1) for rank, (distance, i) in enumerate(near[:k])]
    return sorted(found)


def signed(value):
    return value - 2 ** 64 if value >= 2 ** 63 else value


@pytest.mark.parametrize("seed", [0, 1])
def test_equal_to_brute_force(spark, seed):
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(4)]
    rows = []
    for i in range(300):
        code = draw.choice(centres)
        for _ in range(draw.randint(0, 12)):
            code ^= 1 << draw.randrange(64)
        rows.append((i, signed(code if i % 7 else draw.getrandbits(64))))
    rows += [(i, signed(centres[0])) for i in range(300, 360)] + rows[:5]
    frame = spark.createDataFrame([*rows, (400, None), (None, 5)], "vec_id long, code long")
    found = hamming_search.neighbours(frame, frame.where("vec_id % 10 = 0"), 5)
    queries = [row for row in rows if row[0] % 10 == 0]
    assert sorted(map(tuple, found.collect())) == brute(rows, queries, 5)


def test_fewer_rows_than_neighbours_and_empty(spark):
    frame = spark.createDataFrame([(0, 1), (1, 3), (2, -1)], "vec_id long, code long")
    found = hamming_search.neighbours(frame, frame.where("vec_id = 0"), 10)
    assert sorted(map(tuple, found.collect())) == [(0, 1, 1, 1), (0, 2, 63, 2)]
    assert hamming_search.neighbours(frame.limit(0), frame.limit(0)).collect() == []


def test_code_is_the_signs(spark):
    rows = [([1.0, -1.0, 0.0, 2.0],), ([-1.0] * 63 + [5.0],), (None,), ([],), ([1.0] + [0.0] * 63 + [1.0],), ([None, 1.0],)]
    frame = spark.createDataFrame(rows, "v array<float>")
    assert [r[0] for r in frame.select(hamming_search.code(F.col("v"))).collect()] == [9, signed(1 << 63), None, None, 0, 2]
