"""Recursive descent."""

import time

import pytest
from conftest import same
from pyspark.sql import types as T

from clinflat import Col, FlatView, Select, ViewError
from clinflat.functions.collections import Path
from clinflat.operators.descent import descendants, nested_schema


def level(child):
    answer = T.StructType().add("value", "string").add("item", child)
    return T.StructType().add("linkId", "string").add("answer", T.ArrayType(answer)).add("item", child)


SCHEMA = (
    T.StructType()
    .add("resourceType", "string")
    .add("id", "string")
    .add("item", T.ArrayType(nested_schema(level)))
)


FORM = {
    "resourceType": "Form",
    "id": "f",
    "item": [
        {
            "linkId": "1",
            "item": [
                {"linkId": "1.1", "answer": [{"value": "yes", "item": [{"linkId": "1.1.1"}]}]},
                {"linkId": "1.2", "item": [{"linkId": "1.2.1"}]},
            ],
        },
        {"linkId": "2"},
    ],
}


@pytest.fixture
def form(ndjson):
    return ndjson([FORM, {"resourceType": "Form", "id": "empty"}], SCHEMA)


def run(form, *selects):
    return FlatView("v", "Form", [Select([Col("id", "id")]), *selects]).apply(form)


def links(form, paths):
    got = run(form, Select([Col("i", lambda n: n.row_index, "integer"), Col("l", "linkId")], repeat=paths))
    return [r.l for r in sorted(got.collect(), key=lambda r: r.i)]


def test_depth_first_order(form):
    assert links(form, ["item"]) == ["1", "1.1", "1.2", "1.2.1", "2"]
    assert links(form, ["item", "answer.item"]) == ["1", "1.1", "1.1.1", "1.2", "1.2.1", "2"]


def test_a_path_that_is_not_there(form):
    with pytest.raises(ViewError, match="no declared records"):
        run(form, Select([Col("x", lambda n: n.row_index, "integer")], repeat=["jurisdiction"]))


def test_repeat_with_for_each_inside(form):
    answer = Select([Col("v", "value")], for_each="answer")
    same(run(form, Select([Col("l", "linkId")], repeat=["item"], select=[answer])), [{"id": "f", "l": "1.1", "v": "yes"}])
    outer = Select([Col("v", "value")], for_each_or_null="answer")
    got = run(form, Select([Col("l", "linkId")], repeat=["item"], select=[outer]))
    same(got, [{"id": "f", "l": x, "v": "yes" if x == "1.1" else None} for x in ("1", "1.1", "1.2", "1.2.1", "2")])


def test_repeat_inside_for_each_and_repeat(form):
    inner = Select([Col("below", "linkId")], repeat=["item", "answer.item"])
    got = run(form, Select([Col("above", "linkId")], for_each="item", select=[inner]))
    same(got, [{"id": "f", "above": "1", "below": x} for x in ("1.1", "1.1.1", "1.2", "1.2.1")])
    got = run(form, Select([Col("above", "linkId")], repeat=["item"], select=[inner]))
    pairs = [("1", "1.1"), ("1", "1.1.1"), ("1", "1.2"), ("1", "1.2.1"), ("1.1", "1.1.1"), ("1.2", "1.2.1")]
    same(got, [{"id": "f", "above": a, "below": b} for a, b in pairs])


def test_sibling_repeats_multiply(form):
    one = Select([Col("a", "linkId")], repeat=["item"])
    two = Select([Col("b", "linkId")], repeat=["item"])
    assert run(form, one, two).count() == 25


def test_repeat_inside_a_union(form):
    got = run(
        form,
        Select(
            union_all=[
                Select([Col("kind", lambda n: n["id"]), Col("l", lambda n: n["item"]["linkId"].first())]),
                Select([Col("kind", lambda n: n["linkId"]), Col("l", "linkId")], repeat=["item"]),
            ]
        ),
    )
    want = [{"id": "f", "kind": "f", "l": "1"}, {"id": "empty", "kind": "empty", "l": None}]
    same(got, want + [{"id": "f", "kind": x, "l": x} for x in ("1", "1.1", "1.2", "1.2.1", "2")])


def test_union_inside_repeat(form):
    kinds = [Select([Col("k", lambda n: n["linkId"])]), Select([Col("k", lambda n: n["answer"]["value"].first())])]
    got = run(form, Select(repeat=["item"], union_all=kinds))
    assert got.count() == 10


def test_breadth_first(form):
    found = descendants(Path(None, form.schema), ["item", "answer.item"], "breadth")["linkId"]
    got = form.filter("id = 'f'").select(found.col.alias("l")).first().l
    assert got == ["1", "2", "1.1", "1.2", "1.1.1", "1.2.1"]


def chain(depth):
    """One record per level, by item and by answer.item in turn, numbered from the top."""
    node = {"linkId": str(depth)}
    for k in range(depth - 1, 0, -1):
        node = {"linkId": str(k), **({"item": [node]} if k % 2 else {"answer": [{"value": "v", "item": [node]}]})}
    return node


def test_any_depth(ndjson):
    depths = {"a": 1, "b": 3, "c": 40, "d": 230}
    records = [{"resourceType": "Form", "id": i, "item": [chain(d), {"linkId": "end"}]} for i, d in depths.items()]
    got = run(ndjson(records, SCHEMA), Select([Col("i", lambda n: n.row_index, "integer"), Col("l", "linkId")], repeat=["item", "answer.item"]))
    found = {i: [] for i in depths}
    for r in sorted(got.collect(), key=lambda r: r.i):
        found[r.id].append(r.l)
    assert found == {i: [*map(str, range(1, d + 1)), "end"] for i, d in depths.items()}


def test_plan_does_not_grow_with_depth(ndjson):
    def plan(depth):
        form = ndjson([{"resourceType": "Form", "id": "f", "item": [chain(depth)]}], SCHEMA)
        view = Select([Col("l", "linkId")], repeat=["item", "answer.item"])
        started = time.monotonic()
        text = run(form, view)._jdf.queryExecution().optimizedPlan().toString()
        return len(text.splitlines()), time.monotonic() - started

    (lines, _), (more, seconds) = plan(2), plan(60)
    assert lines == more and seconds < 3


def test_reading_below_a_found_record(ndjson):
    hidden = {"linkId": "b", "answer": [{"value": "y", "item": [{"linkId": "c", "item": [{"linkId": "d"}]}]}]}
    below = {"resourceType": "Form", "id": "f", "item": [{"linkId": "a", "item": [hidden]}]}
    answers = Select([Col("below", lambda n: n["item"].first()["item"]["linkId"].first())], for_each_or_null="answer")
    deep = run(ndjson([below], SCHEMA), Select([Col("l", "linkId")], repeat=["item"], select=[answers]))
    same(deep, [{"id": "f", "l": "a", "below": None}, {"id": "f", "l": "b", "below": "d"}])


def test_function_steps(form):
    steps = [lambda n: n["item"].where(lambda x: x["linkId"] != "1.2"), "answer.item"]
    found = descendants(Path(None, form.schema), steps)["linkId"]
    assert form.filter("id = 'f'").select(found.col.alias("l")).first().l == ["1", "1.1", "1.1.1", "2"]
    assert links(form, [lambda n: n["item"].skip(1)]) == ["2"]
    with pytest.raises(ViewError, match="does not reach records"):
        run(form, Select([Col("l", "linkId")], repeat=[lambda n: n["id"]]))


def test_odd_shapes(ndjson):
    records = [
        {"resourceType": "Form", "id": "nulls", "item": [{"linkId": "a", "item": None}, {"linkId": "b", "item": []}]},
        {"resourceType": "Form", "id": "braces", "item": [{"linkId": "}{{", "item": [{"linkId": "{"}]}]},
        {"resourceType": "Form", "id": "none", "item": []},
    ]
    got = run(ndjson(records, SCHEMA), Select([Col("l", "linkId")], repeat=["item"]))
    same(got, [{"id": "nulls", "l": x} for x in "ab"] + [{"id": "braces", "l": x} for x in ("}{{", "{")])
    wrong = ndjson([{"resourceType": "Form", "id": "w", "item": [{"linkId": "a", "item": {"linkId": "b"}}]}], SCHEMA)
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        run(wrong, Select([Col("l", "linkId")], repeat=["item"])).collect()


def test_many_children_stay_in_order(ndjson):
    """More siblings than a byte counts, each with a child of its own."""
    items = [{"linkId": str(i), "item": [{"linkId": f"{i}.0"}]} for i in range(300)]
    form = ndjson([{"resourceType": "Form", "id": "f", "item": items}], SCHEMA)
    assert links(form, ["item"]) == [x for i in range(300) for x in (str(i), f"{i}.0")]


def test_trees_of_a_small_file_are_dealt(spark, tmp_path):
    """One split of narrow rows, but the descents below it are work for all cores."""
    from checks.operator_queries import chains, trees

    part = "p_partkey long, p_name string, p_brand string, p_type string, p_size int"
    rows = [(k, f"n{k}", "b", "t", k % 7) for k in range(100)]
    spark.createDataFrame(rows, part).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    for build, n in ((chains, 85), (trees, 100)):
        built = build(spark, str(tmp_path))
        assert built.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        assert built.count() == n
