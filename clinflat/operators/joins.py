"""Joins with the care that large skewed data needs.

No side is ever broadcast by hint. Spark broadcasts a side when its size, from its files at
planning or measured at run time, is below the session's bound; otherwise it shuffles, and
adaptive execution splits skewed partitions. The planned size knows nothing of unnesting,
so tables that grow with unnested rows are kept out of that choice altogether.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_nulls(key: Column, by: Column) -> Column:
    """Join key without nulls. Rows without a key would all hash to one partition, so they
    get a filler that differs from row to row and can never be an id: ids consist of
    letters, digits, hyphens and points."""
    return F.coalesce(key, F.concat(F.lit("~"), by))


def never_broadcast(df: DataFrame) -> DataFrame:
    """Mark a table whose size is not bounded by that of its files."""
    return df.hint("merge")


def lookup(left: DataFrame, right: DataFrame, key: Column, right_key: str, spread: Column) -> DataFrame:
    """Left join of an optional reference: all left rows stay. Columns of ``right`` must
    not clash with those of ``left``; its key column is dropped."""
    keyed = left.withColumn("__key", spread_nulls(key, spread))
    joined = keyed.join(right, keyed["__key"] == right[right_key], "left")
    return joined.drop("__key", right_key)


def left_or_join(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], keep: Sequence[str]
) -> DataFrame:
    """Left join where any of several column pairs may match.

    Spark can only run an OR condition as a nested loop. Here each pair is an equality
    join that leaves out matches of earlier pairs, and left rows without any match are
    added at the end. The rows, with their multiplicity, are those of the OR join.
    ``keep`` names the right columns to return. Rows without a key are spread by a hash of
    the row in the search for rows without a match, as they match nothing.
    """
    l, r = left.alias("l"), right.alias("r")
    parts, rest, row = [], left, F.xxhash64(*left.columns).cast("string")
    for i, (a, b) in enumerate(pairs):
        condition = F.col(f"l.{a}") == F.col(f"r.{b}")
        for c, d in pairs[:i]:
            earlier = F.col(f"l.{c}") == F.col(f"r.{d}")
            condition = condition & ~F.coalesce(earlier, F.lit(False))
        parts.append(l.join(r, condition).select("l.*", *[F.col(f"r.{k}") for k in keep]))
        matches = right.where(F.col(b).isNotNull()).select(F.col(b).alias("__match")).distinct()
        keyed = rest.withColumn("__key", spread_nulls(F.col(a), row))
        rest = keyed.join(matches, F.col("__key") == F.col("__match"), "left_anti").drop("__key")
    types = {f.name: f.dataType for f in right.schema.fields}
    parts.append(rest.select("*", *[F.lit(None).cast(types[k]).alias(k) for k in keep]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
