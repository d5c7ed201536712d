"""Random select trees over records that nest to any depth, against a plain evaluation in Python."""

import random
from itertools import product

import pytest
from pyspark.sql import types as T
from test_descent import SCHEMA

from clinflat import Col, FlatView, Select

# what can be read of each kind of node, and where its arrays lead
FIELD = {"form": "id", "node": "linkId", "answer": "value"}
STEPS = {"form": {"item": "node"}, "node": {"item": "node", "answer": "answer"}, "answer": {"item": "node"}}


def record(rnd, depth):
    node = {}
    if rnd.random() < 0.9:
        node["linkId"] = f"n{rnd.randrange(1000)}"
    if depth and rnd.random() < 0.7:
        node["item"] = [record(rnd, depth - 1) for _ in range(rnd.randrange(3))]
    if depth and rnd.random() < 0.4:
        node["answer"] = [
            {"value": f"v{rnd.randrange(9)}", "item": [record(rnd, depth - 1) for _ in range(rnd.randrange(2))]}
            for _ in range(rnd.randrange(3))
        ]
    return node


def tree(rnd, kind, names, depth, columns=None):
    """A select below a node of a kind; columns are the names it must have, in a union."""
    options, below = {}, kind
    if rnd.random() < 0.75:
        how = rnd.choice(["for_each", "for_each_or_null", "repeat"])
        if how == "repeat":
            options["repeat"], below = rnd.choice([["item"], ["item", "answer.item"]]), "node"
        else:
            options[how] = rnd.choice(list(STEPS[kind]))
            below = STEPS[kind][options[how]]
    own = columns or [next(names), next(names)]
    cols = [Col(n, FIELD[below]) if k % 2 == 0 else Col(n, lambda n: n.row_index, "integer") for k, n in enumerate(own)]
    selects, union = [], []
    if depth and columns is None:
        selects = [tree(rnd, below, names, depth - 1) for _ in range(rnd.choice([0, 1, 1, 2]))]
        if rnd.random() < 0.4:
            shared = [next(names), next(names)]
            union = [tree(rnd, below, names, 0, shared) for _ in range(rnd.choice([1, 2, 3]))]
    return Select(columns=cols, select=selects, union_all=union, **options)


def step(node, path):
    found = [node or {}]
    for name in path.split("."):
        found = [y for x in found for y in x.get(name, [])]
    return found


def descend(node, paths):
    for path in paths:
        for child in step(node, path):
            yield child
            yield from descend(child, paths)


def evaluated(sel, kind, node, index):
    below = kind
    if sel.repeat:
        items, below = list(enumerate(descend(node, sel.repeat))), "node"
    elif sel.for_each or sel.for_each_or_null:
        path = sel.for_each or sel.for_each_or_null
        items, below = list(enumerate(step(node, path))), STEPS[kind][path]
        if not items and sel.for_each_or_null:
            items = [(0, None)]
    else:
        items = [(index, node)]
    out = []
    for i, item in items:
        own = {c.name: (item or {}).get(c.path) if isinstance(c.path, str) else i for c in sel.columns}
        parts = [[own]] + [evaluated(s, below, item, i) for s in sel.select]
        if sel.union_all:
            parts.append([row for s in sel.union_all for row in evaluated(s, below, item, i)])
        out += [{k: v for part in combined for k, v in part.items()} for combined in product(*parts)]
    return out


@pytest.mark.parametrize("seed", range(12))
def test_random_trees(ndjson, seed):
    rnd = random.Random(seed)
    forms = [{"resourceType": "Form", "id": f"f{i}", "item": [record(rnd, 4) for _ in range(rnd.randrange(3))]} for i in range(8)]
    names = (f"c{i}" for i in range(1000))
    selects = [Select([Col("id", "id")]), *[tree(rnd, "form", names, 2) for _ in range(rnd.choice([1, 2]))]]
    found = [r.asDict() for r in FlatView("v", "Form", selects).apply(ndjson(forms, SCHEMA)).collect()]
    expected = []
    for form in forms:
        parts = [evaluated(s, "form", form, 0) for s in selects]
        expected += [{k: v for part in combined for k, v in part.items()} for combined in product(*parts)]
    assert isinstance(SCHEMA, T.StructType)
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
