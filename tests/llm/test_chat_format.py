"""Chat windows: read back whole, each answer a target once, budgets held; against SQL and plain Python."""

from __future__ import annotations

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from clinflat.llm import chat_format, queries
from clinflat.llm.chat_format import Template, chat_report, format_chats, read_chats

# 'window', 'formatted', 'place' and 'loss' clash with names inside the operator
SCHEMA = "conv_id long, turn long, role string, text string, window string, formatted string, place string, loss string"
PARTS = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "/s>", "[", "INST]", " ", "\n", "\r\n", "é😀", "word", "<\\/s>", "\\\\"]


def some_turns():
    rnd = random.Random(4)
    rows = []
    for conv in range(40):
        for turn in range(rnd.choice([1, 2, 5, 12, 60])):
            role = "system" if not turn and rnd.random() < 0.4 else rnd.choice(["user", "assistant", "assistant", "tool"])
            text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30)))
            rows.append((conv, turn, role, text + " w" * rnd.choice([0, 3, 40, 90])))
    rows += [(50, 0, "user", None), (50, None, None, "last"), (50, 3, "", ""), (50, 2, "[INST] \\ </s>", "x")]
    rows += [(None, 1, "user", "no id"), (None, 2, "assistant", "none"), (51, 5, "system", "late")]
    rows += [(52, 1, "assistant", "same"), (52, 1, "assistant", "same"), (52, 1, "system", "b c"), (52, 1, "system", "a c")]
    rows += [(53, 0, "system", "s " * 400), (53, 1, "user", "u " * 100), (53, 2, "assistant", "a " * 700), (53, 3, "assistant", "z")]
    return [(*r, "w", "f", "p", "l") for r in rows]


def words(text):
    return len((text or "").encode().split())


def expected_of(rows):
    convs = {}
    for conv, turn, role, text, *_ in rows:
        n = words(text) + words(role) + 3
        convs.setdefault(conv, []).append((turn is None, turn or 0, (role or "").encode(), n, (text or "").encode()))
    found = {}
    for conv, turns in convs.items():
        turns = [(r.decode(), t.decode()) for _, _, r, _, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        found[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return found


@pytest.mark.parametrize("block", [4, 1 << 10])
def test_turns_come_back(spark, block):
    rows = some_turns()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    windows = format_chats(df, budget=200, history=50, block=block).cache()
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat_report(windows).collect()}
    assert found == expected_of(rows)
    read = read_chats(windows).collect()
    assert max(r.n_repeated for r in read) > 3 and len({r.conv_id for r in read}) < len(read)
    systems = {r[0]: (r[1], r[3]) for r in reversed(rows) if r[2] == "system"}
    order = {}
    for r in sorted(read, key=lambda r: (r.conv_id is None, r.conv_id, r.window)):
        parts = r.formatted.split("</s>")[:-1]
        tokens = [words(p.split(" [/INST] ", 1)[1]) + words(p[len("<s>[INST] ") :].split(" [/INST] ", 1)[0]) + 3 for p in parts]
        assert all(p.startswith("<s>[INST] ") and p.count("[INST]") == 1 and p.count("[/INST]") == 1 for p in parts)
        new = len(parts) - r.n_repeated
        assert new > 0 and len(r.turns) == new
        if r.conv_id in systems and r.window > 0 and r.conv_id < 40:
            assert parts[0].startswith("<s>[INST] system")
        # within the budget, unless a single turn or a long system turn leaves no other way
        if r.conv_id != 53:
            assert sum(tokens) <= 200 or new == 1
        assert [t for t in r.targets] == [t.text for t in r.turns if t.role == "assistant"]
        order.setdefault(r.conv_id, []).extend((t.role, t.text) for t in r.turns)


def test_history_is_masked(spark):
    rows = [(1, k, "assistant", f"t{k} " * 10, *"wfpl") for k in range(30)]
    windows = format_chats(spark.createDataFrame(rows, SCHEMA), budget=120, history=30).orderBy("window").collect()
    assert len(windows) > 3 and all(w.n_repeated == 2 for w in windows[1:])
    assert sum(len(w.loss) for w in windows) == 30
    for w in windows:
        assert len(w.loss) == w.formatted.count("</s>") - w.n_repeated
        assert all(w.formatted[s.start : s.start + s.length].endswith(" ") for s in w.loss)


def test_query_and_sql(spark, tmp_path):
    rows = some_turns()
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    result = queries.op12_chat_format(spark, str(tmp_path))
    found = {tuple(r) for r in result.collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    told = con.sql(chat_format.SQL)
    assert told.columns == result.columns
    assert set(told.fetchall()) == found
    awkward = next(r for r in found if r[0] == -7)
    text = "</s>[INST] ok [/INST]"
    assert awkward[1:5] == expected_of([(-7, 0, "user", text), (-7, 1, "assistant", text)])[-7]
    assert "Python" not in result._jdf.queryExecution().toString()


def test_long_and_empty(spark):
    empty = format_chats(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and chat_report(empty).count() == 0
    long = spark.range(1).select(
        F.lit(1).alias("conv_id"), F.lit(0).alias("turn"), F.lit("assistant").alias("role"),
        F.concat(F.repeat(F.lit("</s> "), 200_000), F.lit("end")).alias("text"),
    )
    row = chat_report(format_chats(long)).first()
    assert row.loss_chars == 1_000_003 and row.formatted_chars > 1_200_003


def test_templates():
    with pytest.raises(ValueError):
        Template(begin="<s>", middle="plain", end="</s>")
    with pytest.raises(ValueError):
        Template(begin="||", middle="|||", end="|", controls=("||", "|||"))
    with pytest.raises(ValueError):
        format_chats(None, history=200, budget=400)
