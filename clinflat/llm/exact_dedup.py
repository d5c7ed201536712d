"""Exact deduplication: two passes over a Bloom filter, so that only possible repeats shuffle.

Pass one counts the rows that meet each slot of the filter and keeps the slots met twice or
more as bitmaps. Pass two asks that filter about every row in place: a row with a slot that no
other row meets is unique and goes straight through; the rest are grouped by their digest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflat.llm.bitmaps import MAX_BITS, asked, bitmaps, filter_bits, slot
from clinflat.llm.common import SPACE, checkpointed, text_of


def repeated_slots(digests: DataFrame, bits: int) -> DataFrame:
    """Bitmaps of the slots that two or more rows meet."""
    slots = digests.select(F.explode(F.array(slot("text_sha256", 1, bits), slot("text_sha256", 2, bits))).alias("slot"))
    return bitmaps(slots.groupBy("slot").count().where("count > 1"))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits_per_row: int = 16,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after each run of white space is one space; a null
    text counts as empty. The smallest id of equal texts stays. Rows without an id never stay
    before rows with one; keep_id is null where no row of a group has an id. Rows that repeat an
    id are one document and share its verdict. Other columns of docs are ignored.

    The filter is broadcast and bounded by max_bits (32 MB); a corpus that outgrows it has more
    possible repeats to shuffle and the same result. A text of any number of copies is one
    pre-aggregated group; the join back can be split.
    """
    normal = F.regexp_replace(text_of(text_col), SPACE, " ")
    digests = checkpointed(docs.select(F.col(id_col).alias("doc_id"), F.sha2(normal, 256).alias("text_sha256")))
    bits = filter_bits(digests.count(), bits_per_row, max_bits)
    maps = checkpointed(repeated_slots(digests, bits))
    both = asked(asked(digests, maps, "text_sha256", 1, bits, "first"), maps, "text_sha256", 2, bits, "second")
    looked_up = both.select("doc_id", "text_sha256", (F.col("first") & F.col("second")).alias("maybe"))
    single = looked_up.where(~F.col("maybe")).select(
        "doc_id", "text_sha256", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")
    )
    possible = looked_up.where("maybe").select("doc_id", "text_sha256")
    # kept as a table, so that Spark can split a large group in the join
    groups = checkpointed(
        possible.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    several = possible.join(groups, "text_sha256").select(*single.columns)
    return single.unionByName(several).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM d
"""
