"""Periodic runs against a brute-force search, the query's digests included."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from clinflat.llm import periodic_runs, queries
from clinflat.llm.periodic_runs import dense_pieces, runs_in, runs_of

# 'runs', 'collapsed' and 'n_words' clash with names that the operator returns
SCHEMA = "doc_id long, text string, runs string, collapsed long, n_words string"


def brute_runs(words, least=6, times=4):
    found = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            stretch = words[start : i + q]
            smaller = any(stretch[r:] == stretch[:-r] for r in range(1, q))
            if len(stretch) >= max(least, times * q) and not smaller:
                found.append((start, len(stretch), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {k for s, size, q in runs for k in range(s + q, s + size)}
    kept = b" ".join(w for k, w in enumerate(words) if k not in dropped)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    return (
        doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


def some_words(rnd):
    words = [rnd.choice("abcde"[: rnd.choice([1, 2, 3, 5])]) for _ in range(rnd.randint(0, 60))]
    if words and rnd.random() < 0.5:
        a, p = rnd.randrange(len(words)), rnd.randint(1, 6)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
    return words


@pytest.mark.parametrize("least,times", [(6, 4), (2, 2), (4, 3)])
def test_runs_of_random_words(least, times):
    rnd = random.Random(least)
    for _ in range(1500):
        words = some_words(rnd)
        expected = brute_runs(words, least, times)
        assert runs_of([ord(w) for w in words], least, times) == expected
        assert runs_in([w.encode() for w in words], least, times) == expected


def test_long_texts():
    assert runs_of([i % 777 for i in range(60_000)]) == [(0, 60_000, 777)]
    assert runs_of([0] * 60_000) == [(0, 60_000, 1)]
    words = [str(i).encode() for i in range(500_000)]
    words[300_000:300_060] = [b"x", b"y", b"z"] * 20
    assert runs_in(words) == [(300_000, 60, 3)]


def test_pieces_keep_all_runs(monkeypatch):
    """Whatever the rounds of the filter, the runs are the same."""
    rnd = random.Random(3)
    texts = [[w.encode() for w in some_words(rnd)] for _ in range(200)]
    expected = [runs_in(t) for t in texts]
    monkeypatch.setattr(periodic_runs, "ROUNDS", 1)
    assert [runs_in(t) for t in texts] == expected
    import numpy as np

    assert dense_pieces(np.array([], np.int64)) == []


def test_query(spark, tmp_path):
    rnd = random.Random(5)
    texts = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "é é é é é é é", "a b c a b c a b c a b c" * 3]
    texts += [" ".join(some_words(rnd)) for _ in range(150)] + [" ".join(["long"] * 30_000)]
    rows = [(i * 3, t, "x", 1, None) for i, t in enumerate(texts)]
    rows += [(None, "a b a b a b a b", "x", 1, None), rows[5], rows[5], (15, "other text", None, None, None)]
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 5
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_periodic_runs(spark, str(tmp_path))
    expected = [brute_row(r[0], r[1]) for r in rows if r[1] is None or len(r[1]) < 100_000]
    assert sorted(map(repr, map(tuple, found.where("coalesce(length, 0) < 1000").collect()))) == sorted(map(repr, expected))
    assert found.where("length >= 1000").count() == 1


def test_texts_come_back(spark):
    rows = [(1, "x a b a b a b a b y  z", "r", 1, None), (2, None, "r", 1, None)]
    found = {r.doc_id: r for r in periodic_runs.find_runs(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[1].collapsed == "x a b y z" and [tuple(r) for r in found[1].runs] == [(1, 8, 2)]
    assert found[2].collapsed == "" and found[2].runs == [] and found[2].n_words == 0
    assert periodic_runs.find_runs(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(spark.createDataFrame([], SCHEMA), times=1)
