"""Ranking, joins and pivots against brute force."""

import random
from collections import Counter

from conftest import rows
from pyspark.sql import functions as F

from clinflat.operators import ranking
from clinflat.operators.joins import left_or_join, lookup
from clinflat.operators.ranking import first_k_per_key, first_per_key, pivot_ranked, rank_all


def skewed(n=900, seed=7):
    """Rows in which one key holds most and one row is repeated very often."""
    rnd = random.Random(seed)
    out = [("hot", 5, "same", None)] * (n // 3)
    for _ in range(n - len(out)):
        key = "hot" if rnd.random() < 0.5 else rnd.choice([f"k{i}" for i in range(20)] + [None])
        number = None if rnd.random() < 0.05 else rnd.randrange(400)
        out.append((key, number, rnd.choice("abc"), rnd.choice(["Y", "N", None])))
    return out


def expected_ranks(data):
    def order(row):
        return tuple((v is None, v if v is not None else 0) for v in row[1:])

    result, seen = Counter(), Counter()
    for row in sorted(data, key=lambda r: (r[0] or "", order(r))):
        seen[row[0]] += 1
        result[(*row, seen[row[0]])] += 1
    return result


def test_rank_all_matches_row_number(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK", 16)  # many blocks and many repeated chunks
    data = skewed()
    df = spark.createDataFrame(data, "k string, n bigint, c string, p string").repartition(5)
    got = rank_all(df, ["k"], "n", ["c", "p"], "r")
    assert Counter(tuple(r) for r in got.select("k", "n", "c", "p", "r").collect()) == expected_ranks(data)


def test_first_k_has_the_same_ranks(spark):
    data = skewed()
    df = spark.createDataFrame(data, "k string, n bigint, c string, p string").repartition(5)
    got = first_k_per_key(df, ["k"], [F.col("n"), F.col("c"), F.col("p")], 25, "r")
    want = {k: v for k, v in expected_ranks(data).items() if k[-1] <= 25}
    assert Counter(tuple(r) for r in got.select("k", "n", "c", "p", "r").collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_first_k_of_a_key_in_many_partitions(spark):
    """A claim with rows in 200 partitions: its last task gets no more than k times the salts."""
    rnd = random.Random(5)
    data = [("hot", rnd.randrange(50), rnd.choice("abc"), None) for _ in range(8000)] + skewed(100)
    df = spark.createDataFrame(data, "k string, n bigint, c string, p string").repartition(200)
    order = [F.col("n"), F.col("c"), F.col("p")]
    want = {k: v for k, v in expected_ranks(data).items() if k[-1] <= 25}
    for salts in (1, 4):
        got = first_k_per_key(df, ["k"], order, 25, "r", salts)
        assert Counter(tuple(r) for r in got.select("k", "n", "c", "p", "r").collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("WindowGroupLimit") == 4
    # what the second step gets of the key, where one step would get up to 25 rows of each of 200 tasks
    parts = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(4)))
    met = ranking._limited(parts, ["k", "__salt"], [c.asc_nulls_last() for c in order], 25, "r")
    assert met.filter("k = 'hot'").count() == 100


def test_first_per_key_and_pivot(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", None, "z"), ("b", None, "w")], "k string, n int, v string")
    assert rows(first_per_key(df, ["k"], [F.col("n")], ["v"])) == [{"k": "a", "v": "y"}, {"k": "b", "v": "w"}]
    ranked = first_k_per_key(df, ["k"], [F.col("n")], 2, "r")
    got = rows(pivot_ranked(ranked, "k", "r", {"v": "c", "n": "m"}, 2))
    assert got == [{"k": "a", "c_1": "y", "c_2": "x", "m_1": 1, "m_2": 2}, {"k": "b", "c_1": "w", "c_2": None, "m_1": None, "m_2": None}]


def test_or_join_keeps_the_rows_of_an_or_condition(spark):
    rnd = random.Random(3)
    ids = [*"pqrs", None]
    left = [(i, rnd.choice(ids), rnd.choice(ids)) for i in range(60)] + [(0, "p", "q")]
    right = [(rnd.choice(ids), rnd.choice(ids), f"n{i}") for i in range(12)]
    l = spark.createDataFrame(left, "i int, a string, b string")
    r = spark.createDataFrame(right, "x string, y string, name string")
    got = left_or_join(l, r, [("a", "x"), ("b", "y")], ["name"])
    want = Counter()
    for row in left:
        hits = [n for x, y, n in right if (row[1] is not None and row[1] == x) or (row[2] is not None and row[2] == y)]
        for name in hits or [None]:
            want[(*row, name)] += 1
    assert Counter(tuple(t) for t in got.collect()) == want
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_lookup_keeps_rows_without_a_key(spark):
    left = spark.createDataFrame([("1", "p"), ("2", None), ("3", "gone")], "id string, ref string")
    right = spark.createDataFrame([("p", "Pat"), ("~2", "trap")], "rid string, name string")
    got = lookup(left, right.filter("rid = 'p'"), F.col("ref"), "rid", F.col("id"))
    assert rows(got) == [{"id": "1", "ref": "p", "name": "Pat"}, {"id": "2", "ref": None, "name": None}, {"id": "3", "ref": "gone", "name": None}]
