"""Hard-negative mining: for each anchor and positive, the best rows of other labels in a score window.

The windows of an anchor's positives overlap. Their upper limits split the scores into disjoint
slots: slot i reaches from the limit of positive i down to that of positive i + 1, the last one
to the lowest score that any window takes. Each task keeps the best k rows of a slot, tasks'
findings are merged by slot, and one descending pass over the slots answers all windows: the best
rows at or below limit i are those of slot i, filled up with the best at or below limit i + 1.

Anchors are queries against all rows. Both sides are dealt into cells of bounded size, one slice
of the rows and one group of the anchors each, and a cell is a matrix product.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinflat.llm.common import numbered, send_library, staged

#: Rows and anchors of a cell at most, and bytes of a cell's larger side at most (8 a component).
ROWS_PER_SLICE = 1 << 14
ANCHORS_PER_GROUP = 1 << 13
CELL_BYTES = 1 << 26
#: Rows of a slice at least, where there are too few rows to fill the slices.
LEAST_SLICE = 1 << 10
#: Anchors that are multiplied at once.
TILE = 64


class Side:
    """One side of a cell in the order of ids: ids, numbers among equal ids, label codes, components."""

    def __init__(self, table: pa.Table, labels: dict[str, int]) -> None:
        ids, rows = (table.column(c).to_numpy() for c in ("id", "row"))
        order = np.lexsort((rows, ids))
        self.table = table.take(pa.array(order))
        self.ids, self.rows = ids[order], rows[order]
        self.labels = np.array([labels.setdefault(x, len(labels)) for x in self.table.column("label").to_pylist()], np.int64)
        parts = self.table.column("parts").combine_chunks()
        self.sizes = np.diff(parts.offsets.to_numpy())
        self.values = parts.flatten().to_numpy(zero_copy_only=False)

    def matrix(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the vectors of one size, and their components."""
        places = np.flatnonzero(self.sizes == size)
        starts = (np.cumsum(self.sizes) - self.sizes)[places]
        return places, self.values[starts[:, None] + np.arange(size)[None, :]].reshape(len(places), size)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exactly: in the shortest type that holds every sum."""
    bound = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if bound < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if bound < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.array((whole(a).astype(object) @ whole(b).astype(object).T).tolist(), np.int64).reshape(len(a), len(b))


def scored(rows: Side, anchors: Side) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per anchor of a cell: its place, the places of the rows of its size, their scores."""
    for size in np.unique(anchors.sizes).tolist():
        row_places, row_parts = rows.matrix(size)
        anchor_places, anchor_parts = anchors.matrix(size)
        for first in range(0, len(anchor_places), TILE):
            block = products(anchor_parts[first : first + TILE], row_parts)
            for k, place in enumerate(anchor_places[first : first + TILE].tolist()):
                yield place, row_places, block[k]


def best_first(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, highest first, ties by place."""
    near = np.arange(len(scores))
    if len(scores) > 8 * k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return near[np.argsort(-scores[near], kind="stable")][:k]


def first_of_slots(scores: np.ndarray, uppers: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots and places of the k highest scores of each slot, highest first, ties by place.

    uppers are descending; a score belongs to the last slot whose limit it does not pass."""
    order = np.argsort(-scores, kind="stable")
    slots = np.searchsorted(-uppers, -scores[order], side="right") - 1
    rank = np.arange(len(order)) - np.searchsorted(slots, slots, side="left")
    kept = rank < k
    return slots[kept], order[kept]


def usable(vectors: DataFrame, label: Column, anchor: Column, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """Rows that take part: id, row (number among equal ids), label, parts (whole numbers), anchor."""
    def floored(x: Column) -> Column:
        y = x.cast("double") * scale
        # larger ones are whole already
        return F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y)

    whole = F.transform(F.col(vector_col), floored)
    finite = F.forall(F.col(vector_col), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(F.coalesce(F.col(id_col).isNotNull() & label.isNotNull() & finite, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"),
        label.cast("string").alias("label"),
        whole.alias("parts"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    told_apart = rows.withColumn("tie", F.concat_ws(" ", "label", F.col("parts").cast("string"), F.col("anchor").cast("string")))
    return numbered(told_apart, "id", "tie").drop("tie")


def in_cells(
    points: DataFrame,
    anchors: DataFrame,
    slices: int,
    groups: int,
    find: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
) -> DataFrame:
    """find(rows, anchors) of every cell of rows and anchors."""
    hashed = F.xxhash64("id", "row")

    def dealt(df: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        df = df.withColumn(own, F.pmod(hashed, F.lit(parts)).cast("int"))
        df = df.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        # dealt by number, so that small but costly cells are not put together
        return df.repartition(min(slices * groups, 20_000), "slice", "group")

    rows = dealt(points.drop("anchor"), "slice", slices, "group", groups)
    asked = dealt(anchors, "group", groups, "slice", slices)
    return rows.groupBy("slice", "group").cogroup(asked.groupBy("slice", "group")).applyInArrow(find, schema)


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: str | Column = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    rows_per_slice: int = ROWS_PER_SLICE,
    anchors_per_group: int = ANCHORS_PER_GROUP,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A component x counts as floor(scale * x), a score is the integer inner product with the anchor;
    higher scores come first, ties by smaller id. Rows where anchor is true are anchors. Positives
    of an anchor are its first rows of the same label other than itself, negatives of a positive
    the first rows of another label with low * p <= 100 * n <= high * p for the scores p and n.
    A positive without any gives no row.

    Rows with a null id, label or vector, or with a null, infinite or undefined component, take no
    part. Vectors of different size have no score with each other; empty ones have score 0. Rows
    that repeat an id are rows of their own, as candidates and as anchors; an anchor leaves out
    itself alone. A score beyond 64 bits is an error. Empty tables give no rows, other columns are
    ignored. A label may hold all rows: nothing is grouped by it.
    """
    if not 0 <= low < high:
        raise ValueError("a window needs 0 <= low < high")
    spark = vectors.sparkSession
    send_library(spark)
    label = F.col(label) if isinstance(label, str) else label
    points = staged(usable(vectors, label, anchor, id_col, vector_col, scale), "points")
    size = points.agg(
        F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"), F.max(F.size("parts")).alias("size")
    ).first()
    fitting = max(1, CELL_BYTES // (8 * max(size["size"] or 1, 1)))
    rows_per_slice, anchors_per_group = min(rows_per_slice, fitting), min(anchors_per_group, fitting)
    spread = min(-(-size["n"] // LEAST_SLICE), 2 * spark.sparkContext.defaultParallelism)
    slices = max(-(-size["n"] // rows_per_slice), spread, 1)
    groups = max(-(-size["anchors"] // anchors_per_group), 1)
    # columns of their own, as Spark could not tell both sides of a cell apart otherwise
    asked = points.where("anchor").select(*[F.col(c).alias(c) for c in ("id", "row", "label", "parts")])

    def nearest(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        codes: dict[str, int] = {}
        left, right = Side(rows, codes), Side(anchors, codes)
        found = []
        for place, others, scores in scored(left, right):
            same = left.labels[others] == right.labels[place]
            same &= (left.ids[others] != right.ids[place]) | (left.rows[others] != right.rows[place])
            own = np.flatnonzero(same)
            for k in own[best_first(scores[own], positives)].tolist():
                at = others[k]
                found.append((right.ids[place], right.rows[place], left.ids[at], left.rows[at], scores[k]))
        columns = list(zip(*found)) or [()] * 5
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["anchor_id", "anchor_row", "id", "row", "score"])

    near = in_cells(points, asked, slices, groups, nearest, "anchor_id long, anchor_row long, id long, row long, score long")
    anchor_key = ["anchor_id", "anchor_row"]
    order = [F.desc("score"), "id", "row"]
    ranked = near.withColumn("n", F.row_number().over(Window.partitionBy(*anchor_key).orderBy(*order)))
    # below 0 no score is in a window
    chosen = ranked.where((F.col("n") <= positives) & (F.col("score") >= 0))
    taken = F.array_sort(F.collect_list(F.struct("n", "id", "score")))
    limits = staged(chosen.groupBy(*anchor_key).agg(taken.alias("positives")), "positives")

    def hundredth(percent: int, more: int) -> Column:
        """(percent * score + more) div 100 of each positive, without going beyond 64 bits on the way."""
        rest = f"((p.score % 100) * {int(percent)} + {more}) div 100"
        return F.expr(f"transform(positives, p -> (p.score div 100) * {int(percent)} + {rest})")

    windows = limits.select(
        *anchor_key, "positives", hundredth(high, 0).alias("uppers"), hundredth(low, 99).alias("lowers")
    )
    on = (F.col("id") == F.col("anchor_id")) & (F.col("row") == F.col("anchor_row"))
    with_windows = asked.join(windows, on).select("id", "row", "label", "parts", "uppers", F.array_min("lowers").alias("least"))

    def in_slots(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        codes: dict[str, int] = {}
        left, right = Side(rows, codes), Side(anchors, codes)
        uppers, least = right.table.column("uppers"), right.table.column("least").to_pylist()
        found = []
        for place, others, scores in scored(left, right):
            limits = np.array(uppers[place].as_py(), np.int64)
            fits = (left.labels[others] != right.labels[place]) & (scores >= least[place]) & (scores <= limits[0])
            own = np.flatnonzero(fits)
            for slot, k in zip(*(x.tolist() for x in first_of_slots(scores[own], limits, negatives))):
                at = others[own[k]]
                found.append((right.ids[place], right.rows[place], slot, left.ids[at], left.rows[at], scores[own[k]]))
        columns = list(zip(*found)) or [()] * 6
        names = ["anchor_id", "anchor_row", "slot", "id", "row", "score"]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

    slotted = in_cells(
        points, with_windows, slices, groups, in_slots,
        "anchor_id long, anchor_row long, slot long, id long, row long, score long",
    )
    ranked = slotted.withColumn("n", F.row_number().over(Window.partitionBy(*anchor_key, "slot").orderBy(*order)))
    # by slot and rank: descending scores; what is at or below limit i is the rest of the list from slot i on
    listed = ranked.where(F.col("n") <= negatives).groupBy(*anchor_key).agg(
        F.array_sort(F.collect_list(F.struct("slot", "n", "id", "score"))).alias("found")
    )
    each = windows.join(listed, anchor_key).select(
        "anchor_id", "found", F.posexplode(F.arrays_zip("positives", "lowers")).alias("slot", "p")
    )
    below = F.slice(F.filter("found", lambda x: x["slot"] >= F.col("slot")), F.lit(1), F.lit(negatives))
    taken = F.filter(below, lambda x: x["score"] >= F.col("p.lowers"))
    return each.select("anchor_id", "p", F.posexplode(taken).alias("place", "x")).select(
        "anchor_id",
        F.col("p.positives.id").alias("positive_id"),
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("x.id").alias("negative_id"),
        F.col("p.positives.score").alias("positive_score"),
        F.col("x.score").alias("negative_score"),
    )


#: DuckDB SQL of the query over the table embeddings.
SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS parts
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.parts, b.parts)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.parts) = len(b.parts)
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), pairs AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id)::INTEGER AS rank,
       negative_id, positive_score, negative_score
FROM pairs QUALIFY rank <= 3
"""
