"""Chat formatting in budgeted windows, with the text under the loss mask.

Prefix sums of the turns' tokens cut a conversation into spans of whole turns: span b holds the
turns between b and b + 1 times the room, and a turn that reaches beyond its span's end stands in
a window of its own. A window starts with the system turn and with the turns before it that fit
into the history; both are repeated there without loss, so that each turn of the assistant is a
target once.

Prefix sums are added up in two steps, within blocks of turn numbers and over the blocks, so that
a conversation of any length is dealt over many tasks.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinflat.llm.common import text_of, words_of

#: Turn numbers of a block whose tokens are summed by one task.
BLOCK = 1 << 10
#: Position of rows without a turn number: after all others.
LAST = (1 << 63) - 1


@dataclass(frozen=True)
class Template:
    """begin, role, middle, text, end; a backslash parts control strings that stand in a role or text."""

    begin: str = "<s>[INST] "
    middle: str = " [/INST] "
    end: str = "</s>"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")

    def __post_init__(self) -> None:
        marks = (self.begin, self.middle, self.end)
        if any(len(c) < 2 or "\\" in c for c in self.controls) or any("\\" in m for m in marks):
            raise ValueError("a control string has two characters or more and no backslash")
        if any(not any(c in m for c in self.controls) for m in marks):
            raise ValueError("each mark holds a control string")
        for c in self.controls:
            for k in range(1, len(c)):
                if any(m.startswith(c[k:]) or m.endswith(c[:k]) for m in marks):
                    raise ValueError(f"{c!r} could begin or end within a text")

    def escape(self, text: Column) -> Column:
        """text with each backslash doubled and one after the first character of each control string."""
        inside = "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in self.controls)
        return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), inside, r"\\")

    @staticmethod
    def unescape(text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def word_tokens(text: Column) -> Column:
    """Words of a text: a measure of its tokens that needs no vocabulary."""
    return F.size(words_of(text))


def placed_turns(
    turns: DataFrame,
    template: Template,
    conv_col: str,
    turn_col: str,
    role_col: str,
    text_col: str,
    tokens: Callable[[Column], Column],
    budget: int,
    history: int,
    block: int,
) -> DataFrame:
    """Turns with their place, the tokens before them, the room of a window, and their span and window.

    A window is numbered twice its span, and one more for a turn that reaches beyond the span.
    """
    kind = dict(turns.dtypes)[conv_col]
    role, text = text_of(role_col), text_of(text_col)
    rows = turns.select(
        # a null is a conversation of its own; two columns, so that joins stay on plain keys
        F.col(conv_col).isNull().alias("unnamed"),
        F.coalesce(F.col(conv_col), F.lit(0).cast(kind)).alias("conv"),
        F.coalesce(F.col(turn_col).cast("long"), F.lit(LAST)).alias("turn"),
        role.alias("role"),
        text.alias("text"),
        # the marks take one token each
        (tokens(text) + tokens(role) + 3).cast("long").alias("tokens"),
    ).withColumn("block", F.floor(F.col("turn") / block))
    conv, key = ["unnamed", "conv"], ["unnamed", "conv", "block"]
    order = Window.partitionBy(*key).orderBy("turn", "role", "tokens", "text")
    within = rows.select(
        "*",
        F.row_number().over(order).cast("long").alias("nth"),
        (F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")).alias("ahead"),
    )
    # the first system turn by the same order
    system = F.min(F.when(F.col("role") == "system", F.struct("turn", "tokens")))
    blocks = rows.groupBy(*key).agg(
        F.count(F.lit(1)).alias("turns"), F.sum("tokens").alias("sum"), system.alias("system")
    )
    so_far = Window.partitionBy(*conv).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*conv)
    bases = blocks.select(
        *key,
        F.coalesce(F.sum("turns").over(so_far), F.lit(0)).alias("turns_before"),
        F.coalesce(F.sum("sum").over(so_far), F.lit(0)).alias("tokens_before"),
        F.sum("sum").over(whole).alias("all_tokens"),
        F.min("system").over(whole).alias("system"),
    )
    first_system = F.row_number().over(Window.partitionBy(*key, "turn", "role").orderBy("tokens", "text"))
    found = within.withColumn("nth_of_role", F.when(F.col("role") == "system", first_system)).join(bases, key)
    before = F.col("tokens_before") + F.col("ahead")
    room = F.greatest(budget - history - F.coalesce(F.col("system.tokens"), F.lit(0)), F.lit(budget // 4))
    is_system = (F.col("role") == "system") & (F.col("turn") == F.col("system.turn")) & (F.col("nth_of_role") == 1)
    return (
        found.withColumn("before", before)
        .withColumn("room", room)
        .select(
            *conv,
            "role",
            "text",
            "before",
            "room",
            (F.col("turns_before") + F.col("nth") - 1).alias("place"),
            F.coalesce(is_system, F.lit(False)).alias("retained"),
            F.floor(F.col("before") / F.col("room")).alias("span"),
            F.floor((F.col("before") + F.col("tokens") - 1) / F.col("room")).alias("reach"),
            F.floor((F.col("all_tokens") - 1) / F.col("room")).alias("last_span"),
        )
        .withColumn("window", 2 * F.col("span") + F.when(F.col("reach") > F.col("span"), 1).otherwise(0))
    )


def format_chats(
    turns: DataFrame,
    template: Template = Template(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    tokens: Callable[[Column], Column] = word_tokens,
    budget: int = 512,
    history: int = 128,
    block: int = BLOCK,
) -> DataFrame:
    """One row per window: conv_id, window, n_repeated, formatted, loss.

    formatted is the template's text of the window's turns, by turn. Its first n_repeated turns are
    repeated from earlier windows: the conversation's first system turn, and the turns right before
    the window that hold up to history tokens together. loss lists the spans (start, length in code
    points of formatted) of the new turns of the assistant, texts without their marks.

    A window holds up to budget tokens, its system turn and history included. It exceeds them where
    a single turn does, or a system turn leaves less than a quarter of them, which is the least room.
    Turns follow their number, then role, tokens and text; those without a number come last. Rows without a
    conversation are one conversation, given back with a null. Null roles and texts are empty,
    repeated rows are turns of their own. An empty table gives no rows; other columns are ignored.
    A conversation may hold any share of the rows, if its turn numbers differ: at most the rows of
    block numbers, or of one window, meet in a task. A text of any length is one turn.
    """
    if not 0 <= history <= budget // 4:
        raise ValueError("the history takes at most a quarter of the budget")
    placed = placed_turns(
        turns, template, conv_col, turn_col, role_col, text_col, tokens, budget, history, block
    )
    conv = ["unnamed", "conv"]
    starts = placed.groupBy(*conv, "span", "window").agg(
        F.min("place").alias("first"), F.min("before").alias("first_before")
    )
    # a turn is asked for in its own span, in the next ones that its history reaches, or in all
    last = F.when(F.col("retained"), F.col("last_span")).otherwise(
        F.least(F.floor((F.col("before") + history) / F.col("room")), F.col("last_span"))
    )
    asked = placed.withColumnRenamed("window", "own").select(
        *conv, "role", "text", "before", "place", "retained", "own",
        F.explode(F.sequence("span", F.greatest("span", last))).alias("span"),
    )
    fresh = F.col("own") == F.col("window")
    repeated = (F.col("first") > F.col("place")) & (
        F.col("retained") | (F.col("first_before") - F.col("before") <= history)
    )
    begin, middle, end = F.lit(template.begin), F.lit(template.middle), F.lit(template.end)
    members = asked.join(starts, [*conv, "span"]).where(fresh | repeated).select(
        *conv,
        "span",
        "window",
        "place",
        (~fresh).alias("again"),
        (fresh & (F.col("role") == "assistant")).alias("target"),
        F.concat(begin, template.escape(F.col("role")), middle).alias("head"),
        template.escape(F.col("text")).alias("body"),
    )
    items = F.array_sort(F.collect_list(F.struct("place", "again", "target", "head", "body")))
    listed = members.groupBy(*conv, "span", "window").agg(items.alias("items"))
    tail = len(template.end)
    # the end of each turn's text, from which its span follows
    ends = F.aggregate(
        "items",
        F.array().cast("array<long>"),
        lambda done, x: F.concat(
            done,
            F.array(
                (F.coalesce(F.get(done, F.size(done) - 1) + tail, F.lit(0)) + F.char_length(x["head"]) + F.char_length(x["body"])).cast("long")
            ),
        ),
    )
    spans = F.transform(
        F.filter(F.arrays_zip("items", "ends"), lambda x: x["items"]["target"]),
        lambda x: F.struct(
            (x["ends"] - F.char_length(x["items"]["body"])).alias("start"),
            F.char_length(x["items"]["body"]).cast("long").alias("length"),
        ),
    )
    return listed.withColumn("ends", ends).select(
        F.when(~F.col("unnamed"), F.col("conv")).alias("conv_id"),
        "window",
        F.size(F.filter("items", lambda x: x["again"])).alias("n_repeated"),
        F.array_join(F.transform("items", lambda x: F.concat(x["head"], x["body"], end)), "").alias("formatted"),
        spans.alias("loss"),
    )


def read_chats(windows: DataFrame, template: Template = Template()) -> DataFrame:
    """The windows of format_chats with what their text says: turns (role and text of those that are
    new in the window) and targets (the texts under the loss mask), both without escapes."""

    def quoted(mark: str) -> str:
        return re.escape(mark)

    parts = F.split("formatted", quoted(template.end))
    new = F.slice(parts, F.col("n_repeated") + 1, F.size(parts) - 1 - F.col("n_repeated"))

    def turn(part: Column) -> Column:
        halves = F.split(part, quoted(template.middle), 2)
        role = F.substr(halves[0], F.lit(len(template.begin) + 1))
        return F.struct(template.unescape(role).alias("role"), template.unescape(halves[1]).alias("text"))

    def target(span: Column) -> Column:
        return template.unescape(F.substr(F.col("formatted"), (span["start"] + 1).cast("int"), span["length"].cast("int")))

    return windows.select("*", F.transform(new, turn).alias("turns"), F.transform("loss", target).alias("targets"))


def chat_report(windows: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation, read back from its windows: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars. A digest is of a whole conversation, which one row therefore holds."""
    read = read_chats(windows, template).select(
        "conv_id",
        "window",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        F.array_join("targets", "").alias("learnt"),
        F.char_length("formatted").cast("long").alias("chars"),
    )
    parts = F.array_sort(F.collect_list(F.struct("window", "said", "learnt")))
    whole = read.groupBy("conv_id").agg(F.sum("n_turns").alias("n_turns"), F.sum("chars").alias("formatted_chars"), parts.alias("parts"))
    said = F.array_join(F.col("parts.said"), "")
    learnt = F.array_join(F.col("parts.learnt"), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


#: DuckDB SQL of the query over the table conversations.
SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + len(regexp_extract_all(role, '[^\x20\x09-\x0D]+')) + 3 AS tokens,
    length('<s>[INST] ' || role || ' [/INST] ' || text || '</s>')
      + len(regexp_extract_all(role || ' ' || text, '\\|</?s>|\[/?INST\]')) AS chars
  FROM turns
), placed AS (
  SELECT *, row_number() OVER w AS place, (sum(tokens) OVER w)::BIGINT - tokens AS before
  FROM sized
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, tokens, text ROWS UNBOUNDED PRECEDING)
), systems AS (
  SELECT conv_id, min(place) AS system_place, arg_min(tokens, place) AS system_tokens
  FROM placed WHERE role = 'system' GROUP BY conv_id
), roomed AS (
  SELECT p.*, system_place, greatest(512 - 128 - coalesce(system_tokens, 0), 128) AS room
  FROM placed p LEFT JOIN systems s ON p.conv_id IS NOT DISTINCT FROM s.conv_id
), spans AS (
  SELECT *, 2 * (before // room) + CASE WHEN (before + tokens - 1) // room > before // room THEN 1 ELSE 0 END AS win
  FROM roomed
), starts AS (
  SELECT conv_id, win, min(place) AS first, min(before) AS first_before FROM spans GROUP BY conv_id, win
), shown AS (
  SELECT t.conv_id, sum(t.chars)::BIGINT AS formatted_chars
  FROM spans t JOIN starts s ON t.conv_id IS NOT DISTINCT FROM s.conv_id
    AND (t.win = s.win OR t.place < s.first AND (t.place = t.system_place OR s.first_before - t.before <= 128))
  GROUP BY t.conv_id
), said AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256
  FROM placed GROUP BY conv_id
)
SELECT said.*, formatted_chars FROM said JOIN shown ON said.conv_id IS NOT DISTINCT FROM shown.conv_id
"""
