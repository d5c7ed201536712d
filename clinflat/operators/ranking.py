"""Ranks and firsts per key that stay spread out when one key holds most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 12
BLOCK = 1 << BLOCK_BITS


def nulls_last(c: Column) -> Column:
    """Sort key that puts null after every value, for use inside a struct."""
    return F.struct(c.isNull(), c)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], values: Sequence[str]
) -> DataFrame:
    """One row per key: the values of the row that comes first in ``order`` (nulls last).

    An aggregate, so each task reduces its rows to one per key before the shuffle. Ties
    are decided by the values themselves, which makes the result repeatable.
    """
    ranked = [nulls_last(c) for c in [*order, *[F.col(v) for v in values]]]
    best = F.min(F.struct(*[r.alias(f"o{i}") for i, r in enumerate(ranked)])).alias("__best")
    start = len(order)
    return df.groupBy(*keys).agg(best).select(
        *keys,
        *[F.col(f"__best.o{start + i}.{v}").alias(v) for i, v in enumerate(values)],
    )


def first_k_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str, salts: int = 1
) -> DataFrame:
    """The first ``k`` rows per key with their rank from 1. Spark limits each group in the
    map tasks, before the shuffle, so a key never sends more than ``k`` rows per task.

    With ``salts`` over 1 the rows of a key are first limited in that many parts, by a hash of the
    row, and the parts' firsts then meet: a key's last task gets at most ``k`` times ``salts`` rows,
    whatever the number of map tasks. That is one more shuffle, for tables where few keys hold
    rows of very many tasks.
    """
    ordered = [c.asc_nulls_last() for c in order]
    if salts > 1:
        df = _limited(df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts))), [*keys, "__salt"], ordered, k, rank)
        df = df.drop("__salt", rank)
    return _limited(df, keys, ordered, k, rank).withColumn(rank, F.col(rank).cast("bigint"))


def _limited(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def rank_all(
    df: DataFrame, keys: Sequence[str], number: str, ties: Sequence[str], rank: str
) -> DataFrame:
    """``row_number`` over a whole-number column, then ``ties``, for every row of every key.

    ``df`` must consist of the keys, the number and the ties. A window over a whole key
    would sort it in one task, so the number range is cut into blocks: equal rows are
    counted first, each block is ranked by itself, and the sizes of earlier blocks are
    added; the block of nulls comes last. A 32-bit number has at most 2^31 / 4096 blocks per
    key, and a block holds the distinct ties of 4,096 numbers. Equal rows come back as one
    entry with a count, and large counts are spread out before they are repeated.
    """
    block = F.coalesce(F.shiftright(F.col(number).cast("bigint"), BLOCK_BITS), F.lit(2**63 - 1))
    types = {f.name: f.dataType for f in df.schema.fields}
    # A null key is a key like any other: two plain columns stand for it, so that the windows and
    # the join below are by the same columns and share one partitioning.
    plain = [f"__k_{k}" for k in keys] + [f"__null_{k}" for k in keys]
    counted = (
        df.groupBy(*keys, number, *ties)
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__block", block.cast("bigint"))
        .select(
            "*",
            *[F.coalesce(F.col(k), F.lit("0").cast(types[k])).alias(f"__k_{k}") for k in keys],
            *[F.col(k).isNull().alias(f"__null_{k}") for k in keys],
        )
    )
    in_block = (
        Window.partitionBy(*plain, "__block")
        .orderBy(*[F.col(c).asc_nulls_last() for c in [number, *ties]])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before_block = (
        Window.partitionBy(*plain).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    )
    sizes = counted.groupBy(*plain, "__block").agg(F.sum("__n").alias("__size"))
    offsets = sizes.select(
        *plain, "__block", F.coalesce(F.sum("__size").over(before_block), F.lit(0)).alias("__before")
    )
    placed = counted.withColumn("__start", F.coalesce(F.sum("__n").over(in_block), F.lit(0)))
    columns = [*keys, number, *ties]
    placed = placed.join(offsets, [*plain, "__block"]).select(
        *columns, "__n", (F.col("__start") + F.col("__before")).alias("__start")
    )

    # A row stands for at most BLOCK copies once its count is cut into chunks.
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col("__n") - 1) / BLOCK)))
    chunks = placed.select("*", chunk.alias("__chunk")).repartition(*columns, "__chunk")
    done = F.col("__chunk") * BLOCK
    copy = F.explode(F.sequence(F.lit(1), F.least(F.col("__n") - done, F.lit(BLOCK))))
    copies = chunks.select(*columns, (F.col("__start") + done).alias("__start"), copy.alias("__copy"))
    return copies.select(*columns, (F.col("__start") + F.col("__copy")).cast("bigint").alias(rank))


def ranked_lists(df: DataFrame, key: str, rank: str, columns: Sequence[str], n: int, name: str) -> DataFrame:
    """One row per key with its ranked rows as an array in rank order.

    Ranks must run from 1 without gaps; only those up to ``n`` are kept, so an array never
    has more than ``n`` entries.
    """
    entry = F.struct(F.col(rank), *columns)
    rows = df.filter(F.col(rank) <= n).groupBy(key).agg(F.collect_list(entry).alias(name))
    return rows.withColumn(name, F.sort_array(name))


def list_columns(rows: str, columns: dict[str, str], n: int) -> list[Column]:
    """Columns ``<prefix>_1`` to ``<prefix>_n`` of an array from :func:`ranked_lists`;
    ``columns`` maps a field of its entries to a prefix."""
    return [
        F.get(F.col(rows), F.lit(k - 1))[field].alias(f"{prefix}_{k}")
        for field, prefix in columns.items()
        for k in range(1, n + 1)
    ]


def pivot_ranked(
    df: DataFrame, key: str, rank: str, columns: dict[str, str], n: int
) -> DataFrame:
    """Ranked rows to columns: ``columns`` maps a value column to an output prefix."""
    lists = ranked_lists(df, key, rank, list(columns), n, "__rows")
    return lists.select(key, *list_columns("__rows", columns, n))
