"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

A byte goes if it lies in a string of `length` bytes that starts earlier in the corpus. Suffixes
are ordered through `length` bytes alone, most significant digit first; after each pass, a suffix
that shares its digits with no other is unique and drops out, and what is equal after the last
pass are exactly the repeated strings.

The first digit is not the leading one but the string's anchor: the 32-byte piece with the least
hash among all in the string. Equal strings have equal anchors at equal places, neighbouring
strings mostly share theirs, so one row stands for all strings about an anchor (their hull). The
passes are

1. by anchor, and by the hash of the hull: an equal hull seen earlier settles all its strings;
2. within anchors whose hulls differ, by eight bytes of the strings at a time, to the full length.

An anchor that very many documents have, each with another hull, would be one group for one task.
Such anchors are found in a sample of the documents. Their strings are dealt by their own hash
instead, which is as exact; the sample decides the way alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflat.llm.common import PLACE_BITS, in_small_batches, numbered, staged, text_of

LENGTH = 100
ANCHOR = 32
#: Of the documents, one in this many is looked at for anchors that very many have.
SAMPLE = 64
#: Hulls of an anchor in the sample from which its strings are dealt by themselves: a share, and a number at least.
HOT_SHARE, HOT_LEAST = 0.002, 64
#: Strings that are sorted at a time, and strings of a text that are hashed at a time.
SORTED = 1 << 18
SEGMENT = 1 << 16
BASE = 0x9E3779B97F4A7C15
#: Kinds of rows before the sort: hulls, strings of hot anchors, runs that are settled.
HULL, STRING, RUN = 0, 1, 2


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Hashes:
    """Hashes of all pieces of a text: polynomials modulo 2^64, read from running sums."""

    _up, _down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __init__(self, content: np.ndarray, base: int = BASE) -> None:
        n = len(content) + 1
        if len(Hashes._up) < n:
            size = max(n, 2 * len(Hashes._up))
            for name, factor in (("_up", BASE), ("_down", pow(BASE, -1, 1 << 64))):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(Hashes, name, np.multiply.accumulate(steps))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((_mixed(content.astype(np.uint64) + np.uint64(base & 0xFFFF))) * Hashes._up[: n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * Hashes._down[start])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each window of values: from least values before and after block borders."""
    n = len(values)
    padded = np.full(-(-n // width) * width + width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def hulls(content: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per anchor of a text: its hash, its hull's hash, the first string about it and their number.

    The number is negative where the anchor's piece lies near an equal one, so that strings of the
    hull may repeat within it.
    """
    if len(content) < LENGTH:
        none = np.zeros(0, np.uint64)
        return none, none, none.astype(np.int64), none.astype(np.int64)
    hashes = Hashes(content)
    starts = np.arange(len(content) - ANCHOR + 1)
    pieces = hashes.of(starts, starts + ANCHOR)
    width = LENGTH - ANCHOR + 1
    least = _sliding_least(pieces, width)
    # runs of strings with the same least hash; several pieces of a run can have it
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    count = np.diff(np.append(first, len(least)))
    anchor = least[first]
    # places of anchors; two successive ones with one hash mark the strings about them
    most = ~_sliding_least(~np.pad(least, width - 1), width)
    places = np.flatnonzero(pieces == most)
    equal = (pieces[places][1:] == pieces[places][:-1]) & (np.diff(places) < width)
    near = np.zeros(len(first), bool)
    if equal.any():
        edges = np.zeros(len(least) + 1, np.int64)
        np.add.at(edges, np.maximum(places[:-1][equal] - width + 1, 0), 1)
        np.add.at(edges, np.minimum(places[1:][equal] + 1, len(least)), -1)
        near = np.logical_or.reduceat(np.cumsum(edges)[:-1] > 0, first)
    # a long run repeats its piece: cut it, so that no hull is longer than two strings
    if (count > width).any():
        cuts = -(-count // width)
        which = np.repeat(np.arange(len(first)), cuts)
        step = np.arange(len(which)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        first, anchor, near = first[which] + step * width, anchor[which], near[which]
        count = np.minimum(count[which] - step * width, width)
    hull = hashes.of(first, first + count - 1 + LENGTH)
    return anchor, hull ^ _mixed(count.astype(np.uint64)), first, np.where(near, -count, count)


def _bytes(column: pa.Array, k: int) -> np.ndarray:
    return np.frombuffer(column[k].as_buffer(), np.uint8)


def segments(content: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Pieces of a text with their places: each string lies whole in one. A hull that two pieces
    share is cut there; its parts have one anchor, so they are compared string by string."""
    for place in range(0, len(content) - LENGTH + 1, SEGMENT):
        yield place, content[place : place + SEGMENT + LENGTH - 1]


def _hot_anchors(docs: DataFrame) -> np.ndarray:
    """Anchors with very many hulls, estimated from a sample: at most 1 / HOT_SHARE times the anchors of a text."""

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (_bytes(batch.column(1), k) for k in range(batch.num_rows))
            found = [hulls(part)[:2] for text in texts for _, part in segments(text)] or [hulls(np.zeros(0, np.uint8))[:2]]
            anchor, hull = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(anchor.view("i8")), pa.array(hull.view("i8"))], ["anchor", "hull"])

    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    least = max(HOT_LEAST, int(sample.count() * HOT_SHARE))
    found = sample.mapInArrow(sampled, "anchor long, hull long").distinct().groupBy("anchor").count()
    hot = found.where(F.col("count") >= least).select("anchor").toArrow()
    return np.sort(hot["anchor"].to_numpy().astype("i8").view(np.uint64))


def _dealt(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """Rows (key, kind, other, doc_id, first, n): hulls by anchor, strings of hot anchors by hash, runs by document.

    From here on, a place has the number of its row among those of the id above its bits.
    Within a batch an equal hull or string seen before is settled at once, so that each batch
    passes on one row for it.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            above = batch.column(2).to_numpy() << PLACE_BITS
            order = np.lexsort((above, ids))
            parts = [[np.zeros(0, t)] for t in (np.uint64, np.int8, np.uint64, np.int64, np.int64, np.int64)]

            def add(key: np.ndarray, kind: int, other: np.ndarray, doc: int, first: np.ndarray, n: np.ndarray) -> None:
                for part, x in zip(parts, (key, np.full(len(key), kind, np.int8), other, np.full(len(key), doc), first, n)):
                    part.append(x)

            for k in order:
                for place, content in segments(_bytes(batch.column(1), k)):
                    place += above[k]
                    anchor, hull, first, n = hulls(content)
                    is_hot = np.isin(anchor, hot) if len(hot) else np.zeros(len(anchor), bool)
                    cold = ~is_hot
                    add(anchor[cold], HULL, hull[cold], ids[k], first[cold] + place, n[cold])
                    if is_hot.any():
                        starts = np.unique(np.concatenate([np.arange(a, a + c) for a, c in zip(first[is_hot], abs(n[is_hot]))]))
                        one, two = (Hashes(content, b).of(starts, starts + LENGTH) for b in (BASE, BASE ^ 0x5A5A))
                        add(one, STRING, two, ids[k], starts + place, np.ones(len(starts), np.int64))
            key, kind, other, doc, first, n = (np.concatenate(p) for p in parts)
            # rows are in order of documents and places: of equal ones, the first is passed on
            by = np.lexsort((np.arange(len(key)), kind, other, key))
            same = (key[by][1:] == key[by][:-1]) & (other[by][1:] == other[by][:-1]) & (kind[by][1:] == kind[by][:-1])
            again = by[1:][same]
            kind[again] = RUN
            key[again] = _mixed(doc[again].astype(np.uint64))
            other[again] = 0
            columns = [key.view("i8"), kind, other.view("i8"), doc, first, n]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "kind", "other", "doc_id", "first", "n"])

    return docs.mapInArrow(rows, "key long, kind byte, other long, doc_id long, first long, n long")


def _settled(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, first, n, key): runs that are repeated, key null, and hulls still to sort, by anchor."""

    def passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come sorted by key, kind, other, doc_id, first; the last key's rows wait for the next batch
        held: list[np.ndarray] | None = None
        anchor_seen: tuple | None = None

        def out(key, kind, other, doc, first, n) -> pa.RecordBatch:
            new_key = np.append(True, (key[1:] != key[:-1]) | (kind[1:] != kind[:-1]))
            new = new_key | np.append(True, other[1:] != other[:-1])
            group = np.cumsum(new_key) - 1
            variants = np.bincount(group, weights=new)[group]
            run = (kind == RUN) | ~new
            keep = run | ((kind == HULL) & new & ((variants > 1) | (n < 0)))
            none, n = run[keep], abs(n)
            return pa.RecordBatch.from_arrays(
                [pa.array(doc[keep]), pa.array(first[keep]), pa.array(n[keep]), pa.array(key[keep], mask=none)], names
            )

        for batch in batches:
            now = [c.to_numpy() for c in batch.columns]
            if held is not None:
                now = [np.concatenate(pair) for pair in zip(held, now)]
            if not len(now[0]):
                continue
            last = int(np.searchsorted(now[0], now[0][-1]))
            if last:
                yield out(*(c[:last] for c in now))
            held = [c[last:] for c in now]
        if held is not None and len(held[0]):
            yield out(*held)

    names = ["doc_id", "first", "n", "key"]
    ordered = rows.repartition("key").sortWithinPartitions("key", "kind", "other", "doc_id", "first")
    return ordered.mapInArrow(passes, "doc_id long, first long, n long, key long")


def repeated_strings(content: np.ndarray, start: np.ndarray, group: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Of strings of LENGTH bytes at `start`, those whose group has an equal one of lower rank.

    A most-significant-digit radix sort of eight bytes a pass; groups of one drop out.
    """
    digits = np.ndarray(len(content) - 7, "<u8", content.data, strides=(1,))
    left = np.arange(len(start))
    group = np.unique(group, return_inverse=True)[1].astype(np.int64)
    for depth in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        if not len(left):
            break
        digit = digits[start[left] + depth]
        order = np.lexsort((digit, group))
        left, digit, old = left[order], digit[order], group[order]
        new = np.append(True, (digit[1:] != digit[:-1]) | (old[1:] != old[:-1]))
        group = np.cumsum(new) - 1
        several = np.bincount(group)[group] > 1
        left, group = left[several], group[several]
    order = np.lexsort((rank[left], group))
    left, group = left[order], group[order]
    return left[1:][group[1:] == group[:-1]]


def _sorted_runs(texts: DataFrame) -> DataFrame:
    """Runs (doc_id, first, n) of strings that rows (key, doc_id, first, n, content) repeat within a key."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(batch: pa.RecordBatch) -> pa.RecordBatch:
            key, doc, first, n = (batch.column(i).to_numpy() for i in range(4))
            column = batch.column(4)
            content = np.frombuffer(b"".join([column[k].as_buffer() for k in range(len(column))]) + bytes(8), np.uint8)
            size = n + LENGTH - 1
            at = np.cumsum(size) - size
            hull = np.repeat(np.arange(len(n)), n)
            inside = np.arange(len(hull)) - np.repeat(np.cumsum(n) - n, n)
            place = first[hull] + inside
            rank = np.empty(len(hull), np.int64)
            rank[np.lexsort((place, doc[hull]))] = np.arange(len(hull))
            found = np.sort(repeated_strings(content, at[hull] + inside, key[hull], rank))
            # successive strings of a hull are one run
            joins = np.append(False, (np.diff(found) == 1) & (hull[found][1:] == hull[found][:-1]))[: len(found)]
            begin = np.flatnonzero(~joins)
            count = np.diff(np.append(begin, len(found)))
            columns = [doc[hull[found[begin]]], place[found[begin]], count]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "first", "n"])

        def all_held() -> pa.RecordBatch:
            return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

        strings = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            strings += int(batch.column(3).to_numpy().sum())
            if strings >= SORTED and held[0].column(0)[0] != batch.column(0)[-1]:
                whole = all_held()
                keys = whole.column(0).to_numpy()
                last = int(np.searchsorted(keys, keys[-1]))
                if last:
                    yield out(whole.slice(0, last))
                held = [whole.slice(last)]
                strings = int(held[0].column(3).to_numpy().sum())
        if held:
            yield out(all_held())

    ordered = texts.repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(rows, "doc_id long, first long, n long")


def _hull_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (key, doc_id, first, n, content) of hulls, cut from their documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, asked = batch.columns
            parts, content = [], []
            for k in range(batch.num_rows):
                want = asked[k].values
                key, first, n = (want.field(i).to_numpy() for i in range(3))
                whole = memoryview(texts[k].as_buffer())
                places = first & ((1 << PLACE_BITS) - 1)
                content += [whole[a : a + c + LENGTH - 1] for a, c in zip(places.tolist(), n.tolist())]
                parts.append((key, np.full(len(key), ids[k].as_py()), first, n))
            columns = [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 4
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(content, pa.binary())], names)

    names = ["key", "doc_id", "first", "n", "content"]
    row = F.shiftright("first", PLACE_BITS).alias("row")
    lists = wanted.groupBy("doc_id", row).agg(F.collect_list(F.struct("key", "first", "n")).alias("wanted"))
    return docs.join(lists, ["doc_id", "row"]).select("doc_id", "text", "wanted").mapInArrow(
        rows, "key long, doc_id long, first long, n long, content binary"
    )


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Texts (doc_id, text, row; null as empty) and their repeated runs (doc_id, row, first, n) of strings' starts."""
    spark = docs.sparkSession
    in_small_batches(spark, 2000)
    texts = numbered(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")), "doc_id", "text"
    ).withColumn("text", F.col("text").cast("binary"))
    named = texts.where(F.col("doc_id").isNotNull())
    settled = staged(_settled(_dealt(named, _hot_anchors(named))), "repeats")
    runs = settled.where("key IS NULL").select("doc_id", "first", "n")
    more = staged(_sorted_runs(_hull_texts(named, settled.where("key IS NOT NULL"))), "repeats")
    return texts, runs.unionByName(more).select(
        "doc_id",
        F.shiftright("first", PLACE_BITS).alias("row"),
        F.col("first").bitwiseAND((1 << PLACE_BITS) - 1).alias("first"),
        "n",
    )


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (binary).

    A text is its bytes in UTF-8, null as empty. Strings are judged on the input: each byte that
    a string of LENGTH bytes covers goes if an equal string starts earlier, in a document of a
    smaller id or before it in the same one. Ids are integers; rows that repeat one are documents
    of their own, in the order of `numbered`: of rows with one id and text, the first keeps its
    text. A row without an id is left as it is and takes no part. Other columns are ignored.
    """
    texts, runs = repeats(docs, id_col, text_col)
    lists = runs.groupBy("doc_id", "row").agg(F.collect_list(F.struct("first", "n")).alias("runs"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, contents, found = batch.columns
            out = []
            for k in range(batch.num_rows):
                content = _bytes(contents, k)
                edges = np.zeros(len(content) + 1, np.int64)
                if found[k].is_valid:
                    first, n = (found[k].values.field(i).to_numpy() for i in range(2))
                    np.add.at(edges, first, 1)
                    np.add.at(edges, first + n - 1 + LENGTH, -1)
                gone = np.cumsum(edges)[:-1] > 0
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                kept = content[~gone].tobytes()
                out.append((len(content), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: len(names) - 1]
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(columns, kinds)]], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_kept
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept
    joined = texts.join(lists, ["doc_id", "row"], "left").select("doc_id", "text", "runs")
    in_small_batches(docs.sparkSession, 500)
    return joined.mapInArrow(rows, schema)
