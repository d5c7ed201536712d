"""Mixing sources to target weights, by blocks of words.

The words of a source are laid end to end in a fixed order of its documents and cut into blocks
of a fixed length. Each output shard draws how many of its slots come from which source; the
slots of a source, numbered through all shards, pass through a permutation of the source's block
numbers, again and again where a source is taken more than once. Joining blocks by number tells
how often each is taken. All draws are hashes of stable keys, so that reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinflat.llm.common import WORD, checkpointed, text_of
from clinflat.operators.joins import never_broadcast

#: Times that a source, and so a document, may be taken at most.
MOST = 3
WEIGHTS = (1, 2, 3)
#: Rounds of the network that permutes block numbers, and walks until a number is one of the source's.
ROUNDS = 4
WALKS = 64
#: Groups of one source's documents whose order is settled by itself: so many at least, and more for larger corpora.
PARTS = 4096
PART_ROWS = 1 << 16
#: For whole copies: groups of documents of about one size, and what a fraction of a copy counts in.
SIZE_PARTS = 64
ONE = 1 << 30


def targets(sizes: DataFrame) -> DataFrame:
    """Per source (source, source_size, target, share, upto): one row each, null last.

    Weights repeat over the sources by code point. Sources share all words by weight; one whose
    share is above three times its size gets that, and the rest is shared again. Sorted by
    limit over weight, the sources held at their limit come first: the level of the others
    follows from running sums.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    weighed = per_source.select(
        "source",
        "source_size",
        F.get(weights, ((F.row_number().over(by_name) - 1) % len(WEIGHTS)).cast("int")).alias("weight"),
        (F.col("source_size") * MOST).cast("double").alias("limit"),
        F.sum("source_size").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all"),
    )
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = Window.unboundedPreceding, Window.unboundedFollowing
    held = F.coalesce(F.sum("limit").over(by_limit.rowsBetween(before, -1)), F.lit(0.0))
    # weights are whole numbers; a frame that ends with the last row would be summed anew for each row
    whole = Window.orderBy(F.lit(1)).rowsBetween(before, after)
    held_weight = F.coalesce(F.sum("weight").over(by_limit.rowsBetween(before, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(whole) - held_weight
    leveled = weighed.select("*", ((F.col("all") - held) / open_weight).alias("level"))
    # the first source below its limit at its level settles the level of all; later rows' levels are lower
    settled = F.max(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))).over(whole)
    return leveled.select(
        "source",
        "source_size",
        F.least(F.col("limit"), F.coalesce(settled, F.lit(0.0)) * F.col("weight")).alias("target"),
    )


def _unit(*keys: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) / float(1 << 30)


def permuted(number: Column, n: Column, *keys: Column) -> Column:
    """A pseudorandom permutation of the numbers 0 to n - 1, one for each value of keys.

    Numbers are the cells of a rectangle of about equal sides that holds n of them. A round adds
    to one side a hash of the other, which can be undone, so that rounds permute the cells. What
    falls on a cell of no number goes on until it meets one: less than a side's length of cells
    are of none, so a walk ends within that, and within WALKS but for a chance of 64^-64.
    """
    side = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    other = F.floor((n + side - 1) / side).cast("long")

    def once(x: Column) -> Column:
        a, b = F.pmod(x, side), F.floor(x / side)
        for k in range(ROUNDS):
            if k % 2:
                b = F.pmod(b + F.pmod(F.xxhash64(F.lit(k), a, *keys), other), other)
            else:
                a = F.pmod(a + F.pmod(F.xxhash64(F.lit(k), b, *keys), side), side)
        return b * side + a

    first = once(number)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), first, lambda x, _: F.when(x < n, x).otherwise(once(x)))
    return F.when(first < n, first).otherwise(walked)


def _tasks(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def draws(spark, target: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """Runs of slots (source, first, n): how often a source is drawn in each shard, numbered through the shards.

    The multinomial draw of a shard is stratified: slot i of n draws its number from
    [i/n, (i+1)/n), which keeps the mean of the counts and makes them come near it. So a source's
    count follows from its limits and at most two draws, and no slot is drawn on its own.
    A target is as many slots as blocks of the source's mean length, as its last one is shorter.
    """
    before = Window.unboundedPreceding
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    slots = F.col("target") * F.ceil(F.col("source_size") / block_words) / F.col("source_size")
    upto = target.where("target > 0").select("source", F.sum(slots).over(ordered.rowsBetween(before, 0)).alias("upto"))
    spans = upto.select("source", "upto", F.lag("upto", 1, 0.0).over(ordered).alias("low"))
    cumulated = spans.agg(
        F.sort_array(F.collect_list(F.struct("low", "upto", F.col("source").isNull().alias("none"), "source"))).alias("s"),
        F.max("upto").alias("all"),
    )
    shards = cumulated.select(
        "s",
        "all",
        F.ceil(F.coalesce(F.col("all"), F.lit(0.0))).cast("long").alias("slots"),
    ).where("slots > 0")
    shards = shards.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / shard_slots))).alias("shard")
    ).repartition(_tasks(spark), F.col("shard"))
    n = F.least(F.lit(shard_slots).cast("long"), F.col("slots") - F.col("shard") * shard_slots)
    # a source holds the numbers from x to y: all draws whose parts lie between, and of the two parts
    # that x and y cut, those whose draw falls on its side
    each = shards.select("shard", "all", n.alias("n"), F.explode("s").alias("s")).select(
        "shard", "n", "s.source", *[(F.col(f"s.{c}") / F.col("all") * F.col("n")).alias(name) for c, name in (("low", "x"), ("upto", "y"))]
    )
    each = each.select("*", F.floor("x").alias("i"), F.floor("y").alias("j"))

    def draw(part: str) -> Column:
        return _unit(F.lit(seed), F.col("shard"), F.col(part))

    above, below = draw("i") >= F.col("x") - F.col("i"), (F.col("j") < F.col("n")) & (draw("j") < F.col("y") - F.col("j"))
    one = F.when(above & below, 1).otherwise(0)
    several = F.col("j") - F.col("i") - 1 + above.cast("int") + below.cast("int")
    count = F.when(F.col("i") == F.col("j"), one).otherwise(several).cast("long")
    counts = each.select("shard", "source", count.alias("n")).where("n > 0")
    running = F.sum("n").over(Window.partitionBy("source").orderBy("shard").rowsBetween(before, 0))
    return counts.select("source", (running - F.col("n")).alias("first"), "n")


def _size(text_col: str) -> Column:
    return F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long")


def _taken(docs: DataFrame, id_col: str, text_col: str, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, taken), one per document."""
    sizes = checkpointed(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col("source").cast("string").alias("source"), _size(text_col).alias("size")
        )
    )
    target = checkpointed(targets(sizes))

    # where a document starts among its source's words: parts of a source are ordered alone
    n_parts = max(PARTS, -(-sizes.count() // PART_ROWS))
    parts = sizes.where("size > 0").select("*", F.pmod(F.xxhash64("doc_id"), F.lit(n_parts)).alias("part"))
    before = Window.unboundedPreceding
    inside = Window.partitionBy("source", "part").orderBy("doc_id", "size").rowsBetween(before, 0)
    of_part = parts.groupBy("source", "part").agg(F.sum("size").alias("words"))
    through = Window.partitionBy("source").orderBy("part").rowsBetween(before, 0)
    offsets = of_part.select("source", "part", (F.sum("words").over(through) - F.col("words")).alias("offset"))
    placed = parts.select("*", (F.sum("size").over(inside) - F.col("size")).alias("at"))
    both = placed.join(
        offsets.withColumnsRenamed({"source": "s2", "part": "p2"}),
        F.col("source").eqNullSafe(F.col("s2")) & (F.col("part") == F.col("p2")),
    ).select("doc_id", "source", "size", (F.col("offset") + F.col("at")).alias("start"))
    first, last = F.col("start"), F.col("start") + F.col("size")
    blocks = both.select(
        "*",
        F.explode(F.sequence(F.floor(first / block_words), F.floor((last - 1) / block_words))).alias("block"),
    ).select(
        "doc_id",
        "source",
        "size",
        "start",
        "block",
        (
            F.least(last, (F.col("block") + 1) * block_words) - F.greatest(first, F.col("block") * block_words)
        ).alias("words"),
    )

    n_blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    # runs meet their source while they are few; their slots are dealt over many tasks
    spark = docs.sparkSession
    runs = draws(spark, target, block_words, shard_slots, seed)
    known = target.select(F.col("source").alias("s2"), n_blocks.alias("blocks"))
    runs = runs.join(known, F.col("source").eqNullSafe(F.col("s2"))).repartition(_tasks(spark), "source", "first")
    slot = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot")
    drawn = runs.select("source", "blocks", slot).where(F.col("slot") < MOST * F.col("blocks"))
    # each round through a source's blocks has an order of its own
    blocks_of, lap = F.col("blocks"), F.floor(F.col("slot") / F.col("blocks"))
    block = permuted(F.col("slot") % blocks_of, blocks_of, F.lit(seed), F.col("source"), lap)
    times = drawn.groupBy("source", block.alias("block")).agg(F.count(F.lit(1)).alias("times"))

    names = {"source": "s2", "block": "b2"}
    joined = blocks.join(
        never_broadcast(times.withColumnsRenamed(names)),
        F.col("source").eqNullSafe(F.col("s2")) & (F.col("block") == F.col("b2")),
        "left",
    )
    taken = joined.groupBy("doc_id", "source", "size", "start").agg(
        F.sum(F.col("words") * F.coalesce("times", F.lit(0))).alias("taken")
    )
    none = sizes.where("size = 0").select("doc_id", "source", "size", F.lit(0).cast("long").alias("taken"))
    rows = taken.select("doc_id", "source", "size", "taken").unionByName(none)
    return rows.join(
        target.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))
    ).select("doc_id", "source", "size", "source_size", "target", "taken")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_words: int = 64,
    shard_slots: int = 8192,
    seed: int = 42,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    docs has source; null is a source of its own, the last. Size counts words; a null text has
    none. No block is taken more than three times, and so no document. Rows that repeat an id
    each get their own words; a document without words is taken zero times. Where no document
    has words, all targets are zero. Other columns are ignored.
    """
    taken = _taken(docs, id_col, text_col, block_words, shard_slots, seed)
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def _copies(taken: DataFrame, seed: int) -> DataFrame:
    """Rows (doc_id, source, size, times): whole copies, with about the taken words of each source.

    The whole times that a document is taken are copies; what is left is a fraction. Fractions
    are summed from the longest documents of a source to the shortest, from a start drawn for
    the source, and a document whose fraction takes the sum over a whole number gets one copy
    more. So a fraction is the chance of its copy, and a source's words miss the taken ones by
    a few of its longest documents at most. Sums are whole numbers of 1 / ONE, in groups of
    about one size, so that they do not depend on the dealing and no source is one task.
    """
    # the size's first six bits and their number tell sizes apart to a thirty-second
    low = F.greatest(F.length(F.bin("size")) - 6, F.lit(0))
    near = F.floor(F.col("size") / F.pow(F.lit(2), low)).cast("long") + low * 64
    whole = taken.where("size > 0").select(
        "doc_id",
        "source",
        "size",
        F.floor(F.col("taken") / F.col("size")).alias("whole"),
        F.expr(f"((taken % size) * {ONE}) div size").alias("fraction"),
        (near * SIZE_PARTS + F.pmod(F.xxhash64("doc_id"), F.lit(SIZE_PARTS))).alias("part"),
    )
    whole = checkpointed(whole)
    before = Window.unboundedPreceding
    of_part = whole.groupBy("source", "part").agg(F.sum("fraction").alias("all"))
    through = Window.partitionBy("source").orderBy(F.col("part").desc()).rowsBetween(before, 0)
    offsets = of_part.select(
        F.col("source").alias("s2"), F.col("part").alias("p2"), (F.sum("all").over(through) - F.col("all")).alias("offset")
    )
    inside = Window.partitionBy("source", "part").orderBy(F.col("size").desc(), "doc_id", "whole", "fraction")
    summed = whole.select("*", F.sum("fraction").over(inside.rowsBetween(before, 0)).alias("upto"))
    both = summed.join(offsets, F.col("source").eqNullSafe(F.col("s2")) & (F.col("part") == F.col("p2")))
    start = F.pmod(F.xxhash64(F.lit(seed + 2), "source"), F.lit(ONE))
    upto = start + F.col("offset") + F.col("upto")
    more = F.floor(upto / ONE) - F.floor((upto - F.col("fraction")) / ONE)
    return both.select("doc_id", "source", "size", (F.col("whole") + more).cast("int").alias("times"))


def _key(id_col: str, source: Column, size: Column) -> Column:
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col), source.isNull(), source, size)


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_words: int = 64,
    shard_slots: int = 8192,
    seed: int = 42,
) -> DataFrame:
    """The documents of the mix, in whole copies that keep the words taken of each source.

    Rows that repeat an id each have their own copies; rows that share id, source and size are
    told apart by their text alone.
    """
    copies = _copies(_taken(docs, id_col, text_col, block_words, shard_slots, seed), seed)
    often = copies.groupBy(_key("doc_id", F.col("source"), F.col("size")).alias("_key")).agg(
        F.sort_array(F.collect_list("times")).alias("_times")
    )
    often = often.where(F.element_at("_times", -1) > 0).withColumnRenamed("_key", "_key2")
    keyed = docs.withColumn("_key", _key(id_col, F.col("source").cast("string"), _size(text_col)))
    place = F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64(text_of(text_col))))
    joined = keyed.withColumn("_place", place).join(often, F.col("_key") == F.col("_key2"))
    times = F.element_at("_times", F.col("_place"))
    return (
        joined.where(times > 0)
        .select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), times)).alias("_copy"))
        .drop("_copy")
    )
