"""Hard negatives against a brute-force search in whole numbers."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clinflat.llm import hard_negatives, queries
from clinflat.llm.hard_negatives import best_first, first_of_slots, products

# 'row', 'parts', 'score' and 'anchor' clash with names inside the operator
SCHEMA = "vec_id long, embedding array<float>, label int, row string, parts long, score double, anchor string"


def brute(rows, positives=5, negatives=3, low=50, high=95):
    points = []
    for k, (i, vector, label, *_) in enumerate(rows):
        if i is None or vector is None or label is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        points.append((i, k, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    found = []
    for i, k, label, a in points:
        if i % 50:
            continue
        others = [
            (-sum(x * y for x, y in zip(a, b)), j, other == label)
            for j, m, other, b in points
            if m != k and len(b) == len(a)
        ]
        for ps, p, _ in sorted(o for o in others if o[2])[:positives]:
            fits = sorted(o for o in others if not o[2] and low * -ps <= 100 * -o[0] <= high * -ps)
            for rank, (ns, n, _) in enumerate(fits[:negatives]):
                found.append((i, p, rank + 1, n, -ps, -ns))
    return sorted(found)


def some_rows(n=900):
    rnd = np.random.default_rng(11)
    centres = rnd.normal(size=(6, 8))
    rows = []
    for i in range(n):
        v = centres[rnd.integers(6)] + 0.6 * rnd.normal(size=8)
        v = [float(x) for x in np.float32(v / np.linalg.norm(v))]
        label = 1 if rnd.random() < 0.35 else int(rnd.integers(10))
        rows.append((i, v, label, "r", 1, None, "a"))
    rows[3] = (3, None, 1, None, None, None, None)
    rows[4] = (4, rows[5][1][:7] + [None], 1, None, None, None, None)
    rows[6] = (6, rows[5][1][:7] + [float("nan")], 1, None, None, None, None)
    rows[50] = (50, rows[5][1][:7] + [float("-inf")], 1, None, None, None, None)
    rows[8] = (8, rows[9][1], None, None, None, None, None)
    rows[12] = (None, rows[9][1], 2, None, None, None, None)
    for k in range(200, 240):
        rows[k] = (k, rows[100][1], k % 3, None, None, None, None)
    rows[150] = (150, [0.0] * 8, 1, None, None, None, None)
    rows[250] = (250, [0.5, 0.25], 1, None, None, None, None)
    rows[251] = (251, [0.5, 0.5], 1, None, None, None, None)
    rows[252] = (252, [0.25, 0.5], 3, None, None, None, None)
    rows[300] = (300, [], 1, None, None, None, None)
    rows[303] = (303, [], 1, None, None, None, None)
    rows[302] = (302, [], 2, None, None, None, None)
    return rows


@pytest.mark.parametrize("sizes", [(1 << 14, 1 << 13), (100, 4)])
def test_equals_brute_force(spark, sizes):
    rows = some_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.hard_negatives(
        df, F.col("vec_id") % 50 == 0, label=label, rows_per_slice=sizes[0], anchors_per_group=sizes[1]
    )
    expected = brute(rows)
    assert len(expected) > 100 and any(r[0] == 150 for r in expected) and any(r[0] == 300 for r in expected)
    assert sorted(map(tuple, found.collect())) == expected


def test_repeated_rows_and_ids(spark):
    rows = some_rows()[:120]
    rows += [rows[100], rows[100], (100, rows[7][1], 1, None, None, None, None), rows[55], rows[55]]
    df = spark.createDataFrame(rows, SCHEMA)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.hard_negatives(df, F.col("vec_id") % 50 == 0, label=label)
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_query_and_sql(spark, tmp_path):
    rows = [r for r in some_rows()[:400] if r[1] is None or len(r[1]) == 8]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = sorted(map(tuple, queries.op11_hard_negatives(spark, str(tmp_path)).collect()))
    assert found == brute(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted(con.sql(hard_negatives.SQL).fetchall()) == found


def test_empty_and_extreme(spark):
    assert hard_negatives.hard_negatives(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
    rows = [(0, [1e7, 1e6], 1), (1, [1e7, 1.0], 1), (2, [7e6, 0.0], 2), (3, [1e3, 0.0], 2), (4, [-1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    found = hard_negatives.hard_negatives(df, F.col("vec_id") == 0).collect()
    parts = {i: [math.floor(256 * x) for x in v] for i, v, _ in rows}
    dot = {i: sum(a * b for a, b in zip(parts[0], v)) for i, v in parts.items()}
    assert [tuple(r) for r in found] == [(0, 1, 1, 2, dot[1], dot[2])]
    with pytest.raises(ValueError):
        hard_negatives.hard_negatives(df, F.lit(True), low=95, high=50)


def test_parts():
    rnd = random.Random(2)
    for _ in range(300):
        scores = np.array([rnd.randint(0, 9) for _ in range(rnd.randint(0, 60))], np.int64)
        order = sorted(range(len(scores)), key=lambda k: (-scores[k], k))
        assert best_first(scores, 3).tolist() == order[:3]
        uppers = np.array(sorted((rnd.randint(9, 12) if not k else rnd.randint(0, 12) for k in range(4)), reverse=True))
        slots, places = first_of_slots(scores, uppers, 2)
        for slot in range(4):
            own = [k for k in order if scores[k] <= uppers[slot] and (slot == 3 or scores[k] > uppers[slot + 1])]
            assert places[slots == slot].tolist() == own[:2]
    big = np.array([[2.0**40, 1.0]])
    assert products(big, np.array([[2.0**20, 1.0]])).tolist() == [[2**60 + 1]]
