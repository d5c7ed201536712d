"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links, components.

Two fingerprints that differ in two bits at most agree on two of their four quarters. Distinct
fingerprints are joined on each pair of quarters and verified by Hamming distance. Where many
share a pair of quarters, no pairs are made: fingerprints within two bits have a neighbour at
one bit in common, so each lists its neighbours among the other bits, and those that meet at one
are linked to the smallest there.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflat.llm.common import checkpointed, in_small_batches, text_of

SHINGLE_WORDS = 3
QUARTER = 16
#: Bits by which linked fingerprints differ at most; the blocks are made for this number.
MOST_BITS = 2
#: Members of a block from which neighbours are listed instead of pairs: both give the same components.
PAIRS_UPTO = 64


def fingerprint(text: str) -> int:
    """64 bits, as a signed integer: a bit is 1 if set in over half the shingles' hashes."""
    words = text.encode().lower().split()
    if len(words) < SHINGLE_WORDS:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
    hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], "<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        part = hashes[k : k + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document doc_id and print (long)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([fingerprint(t) for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], ["doc_id", "print"])

    in_small_batches(docs.sparkSession, 500)
    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return source.mapInArrow(rows, f"doc_id {dict(docs.dtypes)[id_col]}, print long")


def _quarters(a: int, b: int) -> Column:
    """Two quarters of a fingerprint in one number."""

    def quarter(k: int) -> Column:
        return F.shiftrightunsigned("print", QUARTER * k).bitwiseAND(F.lit((1 << QUARTER) - 1))

    return F.shiftleft(quarter(a), QUARTER).bitwiseOR(quarter(b))


def links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to join all within MOST_BITS of each other."""
    pairs = list(combinations(range(4), 2))
    keys = [F.struct(F.lit(k).alias("pair"), _quarters(a, b).alias("value")) for k, (a, b) in enumerate(pairs)]
    keyed = prints.select("print", F.explode(F.array(*keys)).alias("k")).select("print", "k.pair", "k.value")
    sizes = checkpointed(keyed.groupBy("pair", "value").agg(F.count(F.lit(1)).alias("members")).where("members > 1"))
    met = checkpointed(keyed.join(sizes, ["pair", "value"]))

    few = met.where(F.col("members") <= PAIRS_UPTO).select("pair", "value", "print")
    near = few.withColumnRenamed("print", "a").join(few.withColumnRenamed("print", "b"), ["pair", "value"])
    close = near.where(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST_BITS)
    ).select("a", "b")

    free = F.array(
        *[
            F.array(*[F.lit(_signed(1 << (QUARTER * q + i))) for q in range(4) if q not in p for i in range(QUARTER)])
            for p in pairs
        ]
    )
    flips = F.concat(F.array(F.lit(0).cast("long")), F.element_at(free, F.col("pair") + 1))
    many = met.where(F.col("members") > PAIRS_UPTO).select("pair", "value", "print", F.explode(flips).alias("flip"))
    at = many.select("pair", "value", F.col("print").bitwiseXOR(F.col("flip")).alias("meet"), F.col("print").alias("b"))
    least = at.groupBy("pair", "value", "meet").agg(F.min("b").alias("a"))
    hubs = at.join(least, ["pair", "value", "meet"]).where("a <> b").select("a", "b")
    return close.unionByName(hubs).distinct()


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) of all nodes of edges (a, b) but the roots; root is the least node that is reached.

    Rounds of large stars and small stars: each hangs the neighbours of a node on the least of
    them, until no edge changes. Rounds grow with the logarithm of the longest chain.
    """
    edges = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())

    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = checkpointed(hung.unionByName(least.withColumnRenamed("m", "b")).distinct())
        last, now = now, state(edges)
        if now == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id.

    Words are lower-cased from A to Z; shingles are three words, a shorter text is one shingle. A
    text without words, null included, has fingerprint zero and is linked like any other. The id
    of a component is the least doc_id in it, rows without an id aside; it is null where none has
    one. Rows that repeat an id each count. Other columns are ignored.
    """
    printed = checkpointed(fingerprints(docs, id_col, text_col))
    distinct = checkpointed(printed.groupBy("print").agg(F.min("doc_id").alias("first")))
    roots = components(links(distinct.select("print")))
    rooted = distinct.join(roots, distinct["print"] == roots["node"], "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    members = checkpointed(rooted.select("print", "root").join(named, "root").select("print", "component_id"))
    return printed.join(members, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of docs whose id is that of their component: one of each group, with the rows that repeat its id."""
    found = near_duplicates(docs, id_col, text_col)
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_first"))
    return docs.join(first.distinct(), F.col(id_col).eqNullSafe(F.col("_first")), "left_semi")
