"""Periodic runs of words: a suffix automaton read through link-cut access.

The suffix links of the automaton of a text form a tree in which the ancestors of a prefix are
its suffixes. Words are appended in order; appending one accesses its prefix, and the path to
the root takes the new place as its last occurrence. The path crosses older preferred paths,
each of one colour, the place where its words ended before. If suffixes of up to l words ended
p words earlier and p <= l, the last p + l words are a repetition of period p that cannot grow
to the left; where the next word differs from the one p back it cannot grow to the right either,
and it is a run. No smaller period is possible, as the suffix would then have occurred later.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflat.llm.common import send_library, text_of, words_of

#: A run has at least so many words, and at least so many times its period.
LEAST_WORDS = 6
LEAST_TIMES = 4
#: Rounds of leaving out words that are too rare for a run: a filter only, what is left is searched.
ROUNDS = 24
RUNS = "array<struct<start:long,length:long,period:long>>"


def suffix_links(word_ids: Sequence[int]) -> tuple[array, array, array]:
    """The automaton of a text: per state its suffix link (0, the root, at the top) and the
    length of its longest string; per place the state of the prefix that ends there.

    Most states have one way out, which two arrays hold; only others have a table.
    """
    n = len(word_ids)
    link, length = array("i", [0]) * (2 * n + 1), array("i", [0]) * (2 * n + 1)
    word, target = array("i", [-1]) * (2 * n + 1), array("i", [0]) * (2 * n + 1)
    others: dict[int, dict[int, int]] = {}
    prefix = array("i", [0]) * n
    link[0] = -1
    last, states = 0, 1
    for i, w in enumerate(word_ids):
        new = states
        states += 1
        length[new] = i + 1
        at, found = last, 0
        while at >= 0:
            if word[at] == w:
                found = target[at]
                break
            if word[at] < 0:
                word[at], target[at] = w, new
            else:
                table = others.setdefault(at, {})
                if w in table:
                    found = table[w]
                    break
                table[w] = new
            at = link[at]
        if at < 0:
            link[new] = 0
        elif length[found] == length[at] + 1:
            link[new] = found
        else:
            clone = states
            states += 1
            length[clone] = length[at] + 1
            link[clone], word[clone], target[clone] = link[found], word[found], target[found]
            if found in others:
                others[clone] = dict(others[found])
            link[found] = link[new] = clone
            while at >= 0:
                if word[at] == w:
                    if target[at] != found:
                        break
                    target[at] = clone
                else:
                    table = others.get(at)
                    if table is None or table.get(w) != found:
                        break
                    table[w] = clone
                at = link[at]
        prefix[i] = last = new
    del link[states:], length[states:]
    return link, length, prefix


def runs_of(
    word_ids: Sequence[int], least: int = LEAST_WORDS, times: int = LEAST_TIMES
) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a text, by start and period; times is 2 or more."""
    up, length, prefix = suffix_links(word_ids)
    n, states = len(prefix), len(up)
    # A preferred path is a splay tree by depth; up leads to its parent or, at its root, to the
    # path above. The root has the colour of the path: all of a path was last accessed together.
    left, right = array("i", [0]) * states, array("i", [0]) * states
    colour = array("i", [-1]) * states

    def rotate(x: int) -> None:
        y = up[x]
        z = up[y]
        if left[y] == x:
            inner = left[y] = right[x]
            right[x] = y
        else:
            inner = right[y] = left[x]
            left[x] = y
        if inner:
            up[inner] = y
        up[y], up[x] = x, z
        if z and left[z] == y:
            left[z] = x
        elif z and right[z] == y:
            right[z] = x
        else:
            colour[x] = colour[y]

    def splay(x: int) -> None:
        while (y := up[x]) and (left[y] == x or right[y] == x):
            z = up[y]
            if z and (left[z] == y or right[z] == y):
                rotate(y if (left[y] == x) == (left[z] == y) else x)
            rotate(x)

    found = []
    for i in range(n):
        x, below = prefix[i], 0
        while x:
            splay(x)
            before = colour[x]
            deeper = right[x]
            if deeper:
                colour[deeper] = before
            right[x] = below
            if before >= 0:
                period = i - before
                size = period + length[x]
                if size >= times * period and size >= least:
                    if i + 1 == n or word_ids[i + 1] != word_ids[i + 1 - period]:
                        found.append((i - size + 1, size, period))
            below, x = x, up[x]
        x = prefix[i]
        splay(x)
        colour[x] = i
    found.sort(key=lambda run: (run[0], run[2]))
    return found


def dense_pieces(
    word_ids: np.ndarray, least: int = LEAST_WORDS, times: int = LEAST_TIMES
) -> list[tuple[int, int]]:
    """(begin, end) of the stretches that may hold runs.

    A word of a run stands in it times times or more. So words that are rarer than that in
    their stretch part it, and what is shorter than a run goes, until nothing changes.
    """
    def stretches(kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begins = np.flatnonzero(np.diff(kept, prepend=-2) != 1)
        return begins, np.diff(begins, append=len(kept))

    kept = np.flatnonzero(np.bincount(word_ids, minlength=1)[word_ids] >= times)
    classes = int(word_ids.max(initial=0)) + 1
    for _ in range(ROUNDS):
        _, sizes = stretches(kept)
        piece = np.repeat(np.arange(len(sizes)), sizes)
        good = (sizes >= least)[piece]
        kept, piece = kept[good], piece[good]
        _, where, counts = np.unique(piece * classes + word_ids[kept], return_inverse=True, return_counts=True)
        good = counts[where] >= times
        if good.all():
            break
        kept = kept[good]
    begins, sizes = stretches(kept)
    return [(int(kept[b]), int(kept[b]) + int(s)) for b, s in zip(begins, sizes) if s >= least]


def runs_in(words: Sequence[bytes], least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> list[tuple[int, int, int]]:
    """Runs of a list of words, those that cannot belong to one left out first."""
    if len(words) < least:
        return []
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    found = []
    for begin, end in dense_pieces(ids, least, times):
        found += [(begin + s, size, period) for s, size, period in runs_of(ids[begin:end].tolist(), least, times)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run repeats after its first period."""
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    for start, size, period in runs:
        drop[start + period] += 1
        drop[start + size] -= 1
    return b" ".join(w for w, d in zip(words, np.cumsum(drop).tolist()) if not d)


def find_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST_WORDS,
    times: int = LEAST_TIMES,
) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period by start, then period), collapsed text.

    A run is a stretch of words with smallest period q, at least least words and times * q long,
    that no neighbour extends. In collapsed, words that a run contains after its first q words are
    left out and the others joined by one space. A null or empty text has no words, no runs and
    the empty text. Rows are independent: rows that repeat an id, or have none, each give a row.
    Other columns are ignored. A text is held by one task, with some 70 bytes a word of the
    stretches that may hold runs; time grows as n log n with its words. Nothing shuffles.
    """
    if times < 2:
        raise ValueError("a run repeats its period twice or more")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        names = ["doc_id", "n_words", "runs", "collapsed"]
        for batch in batches:
            # results are sent on a few at a time, as a batch may hold long texts
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                counts, runs, texts = [], [], []
                for text in part.column(1):
                    words = text.as_py().encode().split()
                    own = runs_in(words, least, times)
                    counts.append(len(words))
                    runs.append([{"start": s, "length": k, "period": p} for s, k, p in own])
                    texts.append(collapsed(words, own).decode())
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)

    send_library(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    return source.mapInArrow(rows, f"doc_id {id_type}, n_words long, runs {RUNS}, collapsed string")


def with_stutter(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with words repeated to the end in the texts of one id in ten, as a loop of a generator would.

    With h the CRC-32 of the id as text and g = h div 10, a text of n words whose h ends in 0 goes
    on from word a = g mod n with its next p = 1 + (n - a) div (3 + g mod 8) words over and over.
    Its words are then joined by one space. Rows without an id stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.col("__stutter_words")
    n = F.size(words)
    a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
    p = (F.floor((n - a) / (g % 8 + 3)) + 1).cast("int")
    unit = F.slice(words, a + 1, p)
    loop = F.slice(F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    looped = F.array_join(F.concat(F.slice(words, F.lit(1), a), loop), " ")
    chosen = F.when(F.coalesce(h % 10 == 0, F.lit(False)), words_of(text_of(text_col)))
    text = F.when(F.coalesce(n, F.lit(0)) > 0, looped).otherwise(text_of(text_col))
    return docs.withColumn("__stutter_words", chosen).withColumn(text_col, text).drop("__stutter_words")


def run_report(found: DataFrame) -> DataFrame:
    """Per row of find_runs: doc_id, n_runs, the longest run's start, length, period and exponent in
    thousandths (ties: smallest start, then period; null without a run), and digests of the runs
    and of the collapsed text."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("size"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))

    def hashed(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    best = F.col("best")
    size = -best["size"]
    return found.select("*", longest.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        size.alias("length"),
        best["period"].alias("period"),
        F.floor(size * 1000 / best["period"]).cast("long").alias("exponent_milli"),
        hashed(F.array_join(lines, "")).alias("runs_sha256"),
        hashed(F.col("collapsed")).alias("collapsed_sha256"),
    )
