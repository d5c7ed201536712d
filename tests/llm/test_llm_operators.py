"""The operators against brute force, on small tables with every awkward case."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from clinflat.llm import (
    byte_bpe,
    exact_dedup,
    line_dedup,
    lm_scoring,
    mixing,
    quality_rules,
    simhash,
    suffix_dedup,
    token_files,
    warc,
)

# 'text_sha256' and 'keep_id' clash with names that operators return
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_sha256 string, keep_id long"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def words(text):
    return (text or "").encode().lower().split()


def some_texts():
    rnd = random.Random(7)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7))) for _ in range(80)]
    base = [" ".join(rnd.choice(vocabulary) for _ in range(n)) for n in (1, 4, 5, 9, 12, 40, 60, 90, 200, 300)]
    texts = [None, "", " ", "\n \n", "a", "a b", "x" * 5000, "a b " * 700, "日本語 😀 " * 30, base[5], base[5]]
    texts += [base[6].replace(" ", "  "), base[6], base[6].upper(), "### $$$ " * 40, "<|endoftext|> is text"]
    for _ in range(140):
        lines = []
        for _ in range(rnd.randint(1, 4)):
            line = rnd.choice(base).split(" ")
            for _ in range(rnd.choice([0, 0, 1, 3])):
                line[rnd.randrange(len(line))] = rnd.choice(vocabulary)
            lines.append(" ".join(line))
        texts.append("\n".join(lines))
    return texts


@pytest.fixture(scope="module")
def rows():
    sources = ["s1", "s0", None, "s2", "s0", "s0"]
    langs = ["en", "fr", None]
    return [
        (i * 7 % 1009, t, langs[i % 3], sources[i % 6], None, "x", 1) for i, t in enumerate(some_texts())
    ]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    found = {row.doc_id: row for row in df.collect()}
    return found


def duck(rows, sql):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", [r[:4] for r in rows])
    found = con.sql(sql)
    return {r[0]: dict(zip(found.columns, r)) for r in found.fetchall()}


def test_exact_dedup(docs, rows, empty):
    expected = duck(rows, exact_dedup.SQL)
    found = by_id(exact_dedup.exact_dedup(docs))
    assert {k: v.asDict() for k, v in found.items()} == expected
    assert exact_dedup.exact_dedup(docs, max_bits=1 << 15).count() == len(rows)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_null_ids(spark):
    df = spark.createDataFrame([(None, "a"), (3, "a"), (3, "a"), (None, "b")], "doc_id long, text string")
    found = sorted((r.doc_id is None, r.kept, r.keep_id) for r in exact_dedup.exact_dedup(df).collect() if r.group_size > 1)
    assert found == [(False, True, 3), (False, True, 3), (True, False, 3)]


def test_byte_bpe(docs, rows, empty):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    peer = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = by_id(byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN, with_ids=True))
    for doc_id, text, *_ in rows:
        assert found[doc_id].ids == peer.encode_ordinary(text or "")
        assert found[doc_id].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    encoded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    back = by_id(byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN))
    assert all(bytes(back[r[0]].content).decode() == (r[1] or "") for r in rows)
    assert byte_bpe.round_trip(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def cut(rows):
    seen, out = set(), {}
    for doc_id, text in sorted((r[0], r[1] or "") for r in rows):
        content = text.encode()
        gone = bytearray(len(content))
        for p in range(len(content) - suffix_dedup.LENGTH + 1):
            piece = content[p : p + suffix_dedup.LENGTH]
            if piece in seen:
                gone[p : p + suffix_dedup.LENGTH] = b"\1" * suffix_dedup.LENGTH
            seen.add(piece)
        spans = sum(1 for p in range(len(gone)) if gone[p] and not (p and gone[p - 1]))
        out[doc_id] = (len(content), sum(gone), spans, bytes(c for c, g in zip(content, gone) if not g))
    return out


@pytest.mark.parametrize(("hot", "cut_at"), [(False, 1 << 16), (True, 1 << 16), (False, 150), (True, 150)])
def test_suffix_dedup(docs, rows, empty, hot, cut_at, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", cut_at)
    if hot:
        monkeypatch.setattr(suffix_dedup, "SAMPLE", 1)
        monkeypatch.setattr(suffix_dedup, "HOT_LEAST", 2)
        monkeypatch.setattr(suffix_dedup, "SORTED", 500)
    found = by_id(suffix_dedup.cut_repeats(docs))
    for doc_id, expected in cut(rows).items():
        r = found[doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == expected
        assert r.kept_sha256 == hashlib.sha256(expected[3]).hexdigest()
    assert suffix_dedup.cut_repeats(empty).count() == 0


def repeated_ids(spark):
    rnd = random.Random(9)
    one, two = (" ".join(str(rnd.random()) for _ in range(40)) for _ in range(2))
    texts = [(1, one), (1, one), (2, two), (2, two + "\n" + one), (2, "short"), (3, two), (None, one), (None, one)]
    return spark.createDataFrame([(k, x, None, None, 0, "x", 0) for k, x in texts], SCHEMA), one, two


def test_suffix_dedup_repeated_ids(spark):
    docs, one, two = repeated_ids(spark)
    found = [(r.doc_id, bytes(r.kept).decode()) for r in suffix_dedup.cut_repeats(docs).collect()]
    assert sorted(x for k, x in found if k == 1) == ["", one]
    # of id 2, either row comes first: two stays once in all
    assert sum(two in x for k, x in found if k == 2) == 1 and sum(one in x for k, x in found if k == 2) == 0
    assert (2, "short") in found and (3, "") in found
    assert [x for k, x in found if k is None] == [one, one]


def test_line_dedup_repeated_ids(spark):
    docs, one, two = repeated_ids(spark)
    found = [(r.doc_id, r.text) for r in line_dedup.drop_lines(docs).collect()]
    assert sorted(x for k, x in found if k == 1) == ["", one]
    assert sorted(x for k, x in found if k == 2) == sorted(["", "short", two])
    assert (3, "") in found and [x for k, x in found if k is None] == [one, one]


def test_lm_scoring(docs, rows, empty):
    out = {r[0]: zlib.crc32(str(r[0]).encode()) % 5 == 1 for r in rows}
    counts = Counter(w for r in rows if not out[r[0]] for w in [*words(r[1]), b""])
    n, v = sum(counts.values()), len(counts)
    found = by_id(lm_scoring.score(docs, classes=64, listed=20))
    for doc_id, text, *_ in rows:
        tokens = [*words(text), b""]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        r = found[doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out[doc_id], len(tokens), n)
        assert r.n_known == sum(counts[w] > 0 for w in tokens)
        assert r.base_score == pytest.approx(base)
    held = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm_scoring.score(empty, classes=8).count() == 0


def test_lm_model_is_normalised():
    pairs = np.random.default_rng(1).integers(0, 9, (12, 12)).astype(float)
    logs = lm_scoring.train(pairs, steps=30)
    assert np.allclose((10**logs).sum(axis=1), 1)


def test_quality_rules(docs, rows, empty):
    expected = duck(rows, quality_rules.SQL)
    found = by_id(quality_rules.quality_verdicts(docs))
    assert {k: v.asDict() for k, v in found.items()} == expected
    assert {r.doc_id for r in quality_rules.keep_good(docs).collect()} == {k for k, v in expected.items() if v["kept"]}
    assert quality_rules.quality_verdicts(empty).count() == 0


def test_pipeline_quality_adapts(spark):
    # "bad" is the largest source and a third of it junk, so its own quartiles hold junk; "long" has longer words
    rnd = random.Random(5)
    rows, junk, odd = [], set(), set()
    for k in range(1500):
        source = "bad" if k % 2 else ("fine", "long", "plain")[k // 2 % 3]
        size = 9 if source == "long" else 4
        text = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(size - 2, size + 2))) for _ in range(rnd.randint(60, 200))]
        if source == "bad" and k % 5 < 2:
            text = [w if j % 3 else "#$%&" for j, w in enumerate(text)]
            junk.add(k)
        elif k in (100, 200):
            text = [w * 8 for w in text]
            odd.add(k)
        rows.append((k, " ".join(text), "en", source, 0, "x", 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, "").collect()}
    assert not kept & (junk | odd)
    assert len(kept) >= 0.98 * (len(rows) - len(junk | odd))


def without_similar(rows):
    lines, gone = [], set()
    for doc_id, text in sorted((r[0], r[1] or "") for r in rows):
        for k, line in enumerate(text.split("\n")):
            if found := words(line):
                shingles = frozenset(tuple(found[j : j + 5]) for j in range(max(1, len(found) - 4)))
                if any(len(shingles & s) >= 0.8 * len(shingles | s) - 1e-9 for s in lines):
                    gone.add((doc_id, k))
                lines.append(shingles)
    return {
        r[0]: None if r[1] is None else "\n".join(x for k, x in enumerate(r[1].split("\n")) if (r[0], k) not in gone)
        for r in rows
    }


def test_line_dedup(docs, rows, empty):
    expected = without_similar(rows)
    found = by_id(line_dedup.drop_lines(docs))
    assert {k: r.text for k, r in found.items()} == expected
    assert all(r.text_sha256 == "x" for r in found.values())
    digests = by_id(line_dedup.line_dedup(docs))
    assert all(digests[k].kept_sha256 == hashlib.sha256((t or "").encode()).hexdigest() for k, t in expected.items())
    assert line_dedup.line_dedup(empty).count() == 0


def test_token_files(spark, docs, rows, empty, tmp_path):
    peer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    token_files.write_ids(docs, f"{tmp_path}/t", public_tokenizers.path("byte_bpe_50k.json"))
    found = by_id(token_files.read_ids(spark, f"{tmp_path}/t"))
    start = 0
    for doc_id, text in sorted((r[0], r[1] or "") for r in rows):
        ids = [*peer.encode(text, add_special_tokens=False).ids, 2]
        r = found[doc_id]
        assert (r.start, r.n_tokens, r.ids) == (start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    token_files.write_ids(empty, f"{tmp_path}/e", public_tokenizers.path("byte_bpe_50k.json"))
    assert token_files.read_ids(spark, f"{tmp_path}/e").count() == 0


def test_frequencies_are_counted_by_batch(spark):
    # an array as long as the largest id, made for each document, would take minutes
    packed = bytearray(token_files.narrow(np.array([7, 7, 4_000_000], np.uint32)))
    encoded = spark.range(0, 4000, 1, 1).select(F.lit(packed).alias("ids"))
    begin = time.monotonic()
    found = {r.id: r.n for r in token_files.frequencies(encoded).collect()}
    assert found == {7: 8000, 4_000_000: 4000}
    assert time.monotonic() - begin < 30


def test_packed_ranks():
    for n in (0, 1, 4, 7, 1000):
        ranks = np.random.default_rng(n).choice([0, 255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1], n).astype(np.uint32)
        assert (token_files.unpack(*token_files.pack(ranks), n) == ranks).all()


def test_mixing(docs, rows, empty):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: 1 + k % 3 for k, s in enumerate(names)}
    held, left = {}, sum(sizes.values())
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in names if x not in held) for s in names if s not in held}
        above = {s for s in share if share[s] > 3 * sizes[s]}
        if not above:
            break
        held |= {s: 3 * sizes[s] for s in above}
        left = sum(sizes.values()) - sum(held.values())
    targets = {**share, **held}
    found = by_id(mixing.mix(docs, block_words=8))
    taken = Counter()
    for r in rows:
        m = found[r[0]]
        assert (m.size, m.source_size) == (len(words(r[1])), sizes[r[3]])
        assert m.target == pytest.approx(targets[r[3]])
        assert 0 <= m.taken <= 3 * m.size
        taken[r[3]] += m.taken
    assert all(abs(taken[s] - targets[s]) <= 0.02 * targets[s] + 16 for s in names)
    assert by_id(mixing.mix(docs.repartition(5), block_words=8)) == found
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed(docs).columns == docs.columns


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 331, 1000, 4099, 49_981])
def test_permutation_of_blocks(spark, n):
    n_col = F.lit(n).cast("long")
    rows = spark.range(n).select(
        mixing.permuted(F.col("id"), n_col, F.lit(1), F.lit("s")).alias("a"), mixing.permuted(F.col("id"), n_col, F.lit(1), F.lit(None)).alias("b")
    ).collect()
    for found in ([r.a for r in rows], [r.b for r in rows]):
        assert sorted(found) == list(range(n))
        if n > 300:
            # a stretch of slots is no stretch of blocks
            steps = Counter(y - x for x, y in zip(found, found[1:]))
            assert steps.most_common(1)[0][1] < 0.05 * n
            assert sum(f < n / 2 for f in found[: n // 4]) == pytest.approx(n / 8, rel=0.35)


def test_permutation_of_very_many_blocks(spark):
    n = 100_000_000_007
    numbers = [0, 1, 2, n // 2, n - 2, n - 1]
    rows = spark.createDataFrame([(x,) for x in numbers], "x long")
    found = [r[0] for r in rows.select(mixing.permuted(F.col("x"), F.lit(n), F.lit("s"))).collect()]
    assert len(set(found)) == len(numbers) and all(0 <= f < n for f in found)


def test_mixing_many_sources(spark):
    docs = spark.range(100_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("host"), F.col("id")).alias("source"), F.repeat(F.lit("w "), 20).alias("text")
    )
    docs = docs.unionByName(spark.range(300).select((F.col("id") + 200_000).alias("doc_id"), F.lit("big").alias("source"), F.repeat(F.lit("w "), 900).alias("text")))
    taken = mixing.mix(docs).agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).first()
    assert taken.n == 100_300 and taken.taken == pytest.approx(taken.size, rel=0.06)


def test_mixing_tiny_sources(spark):
    rows = [(k, "w " * 10, None, f"t{k:02}", 0, "x", 0) for k in range(30)]
    rows += [(100 + k, "w " * 500, None, "z", 0, "x", 0) for k in range(20)]
    tiny = [r for r in mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect() if r.doc_id < 100]
    assert all(r.target == pytest.approx(30) and 10 <= r.taken <= 30 for r in tiny)
    assert sum(r.taken for r in tiny) >= 0.8 * 30 * len(tiny)


def test_mixed_keeps_targets(spark):
    # a hot source and long documents: copies of each are few, sources have one ratio each
    rnd = random.Random(3)
    rows = []
    for k in range(1200):
        source = "hot" if k % 3 == 0 else f"s{k % 7}" if k % 7 else None
        rows.append((k, " ".join(["w"] * rnd.choice([3, 20, 70, 300, 800])), None, source, 0, "x", 0))
    rows += [(5000, "a b c", None, "hot", 0, "x", 0)] * 2 + [(None, "a b", None, "hot", 0, "x", 0), (None, "c", None, None, 0, "x", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    sizes = spark.createDataFrame([(r[3], len(words(r[1]))) for r in rows], "source string, size long")
    targets = {r.source: r.target for r in mixing.targets(sizes).collect()}
    found = mixing.mixed(docs)
    kept, copies = Counter(), Counter()
    for r in found.collect():
        kept[r.source] += len(words(r.text))
        copies[r.doc_id] += 1
    assert all(abs(kept[s] - targets[s]) <= 0.02 * targets[s] + 800 for s in targets)
    assert max(n for k, n in copies.items() if k not in (5000, None)) <= 3
    again = mixing.mixed(docs.repartition(5))
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, found.collect()))


def test_simhash(docs, rows, empty):
    def print_of(text):
        w = words(text)
        shingles = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = {r[0]: print_of(r[1]) for r in rows}
    group = {k: k for k in prints}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((root(a), root(b)))
                group[y] = x
    found = by_id(simhash.near_duplicates(docs))
    assert {k: (r.fingerprint, r.component_id) for k, r in found.items()} == {
        k: (f"{prints[k]:016x}", root(k)) for k in ids
    }
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_large_blocks(spark, monkeypatch):
    rnd = random.Random(5)
    centre = rnd.getrandbits(64)
    prints = {centre ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(150)}
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "print long")

    def groups():
        return {r.node: r.root for r in simhash.components(simhash.links(df)).collect()}

    pairs = groups()
    monkeypatch.setattr(simhash, "PAIRS_UPTO", 1)
    assert groups() == pairs


def test_warc(spark, tmp_path):
    pages = [(1, "u", "a"), (2, "u\r\nX: y", "a"), (3, None, None), (4, "u", ""), (5, "u", "é" * 5000), (None, "u", "a"), (6, "u", "z")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    warc.write_archive(df, f"{tmp_path}/w", chunk_bytes=64)
    found = {r.page_id: r for r in warc.read_archive(spark, f"{tmp_path}/w").collect()}
    for page_id, _, html in pages:
        payload = (html or "").encode()
        r = found[str(page_id)]
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
    kinds = {k: (r.record_type, r.refers_to) for k, r in found.items()}
    assert kinds["1"] == kinds["None"] == ("revisit", "2")
    assert kinds["2"] == ("response", None) and kinds["3"] == ("revisit", "4")
    (tmp_path / "files").mkdir()
    warc.write_files(spark, f"{tmp_path}/w", f"file://{tmp_path}/files")
    raw = b"".join(p.read_bytes() for p in (tmp_path / "files").iterdir())
    assert raw.count(b"WARC/1.1\r\n") == len(pages)
    assert warc.read_records(warc.records(df.limit(0))).count() == 0


def test_pipeline_stages(spark, docs):
    table, seen = docs.select("doc_id", "text", "lang", "source", "n_chars"), []
    for name, stage in corpus_pipeline.STAGES:
        before = table
        table = spark.createDataFrame(stage(spark, table, "").toArrow())
        seen.append((name, table.count()))
        if name != "tokens":
            assert table.columns == before.columns
    assert seen[0][1] < docs.count() and seen[1][1] == seen[0][1] and seen[2][1] < seen[1][1]
    assert seen[4][1] == seen[3][1] > 0


def test_suffix_dedup_sorts_hulls_without_repeats(spark):
    """A task whose hulls share an anchor but no string has no run to return."""
    texts = [bytes((7 * i + k) % 251 for i in range(suffix_dedup.LENGTH)) for k in (1, 2)]
    rows = [(5, k, 0, 1, bytearray(t)) for k, t in enumerate(texts)]
    schema = "key long, doc_id long, first long, n long, content binary"
    assert suffix_dedup._sorted_runs(spark.createDataFrame(rows, schema)).collect() == []
    again = [*rows, (5, 9, 3, 1, bytearray(texts[0]))]
    assert [tuple(r) for r in suffix_dedup._sorted_runs(spark.createDataFrame(again, schema)).collect()] == [(9, 3, 1)]
