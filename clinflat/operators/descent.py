"""Recursive descent over records that nest into themselves, to any depth.

Spark types cannot be recursive. So the schema of a self-nesting record declares one level, and
keeps what lies below as Variant values, which a path reads as records of the same level when it
steps into them. A descent is one loop inside the row: each round follows the paths from the
records that the last round found, until there are none. A level is a round and not a part of the
plan, which has the same size for every depth; nothing shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflat.functions.collections import Path, PathError, marked_records

#: Where the children of a record are: a dotted path, or a function from the record to them.
Step = str | Callable[[Path], Path]


def nested_schema(level: Callable[[T.DataType], T.StructType]) -> T.StructType:
    """Schema of a self-nesting record. ``level(child)`` builds one level around the type of its
    children; a field of that type holds an array of records of the same level."""
    return marked_records(level(T.VariantType()))


def _children(node: Path, step: Step) -> Path | None:
    """The records that a step reaches, or None where it is not declared for this node."""
    try:
        reached = node.go(step) if isinstance(step, str) else step(node)
    except PathError:
        return None
    if not isinstance(reached.item_type, T.StructType):
        raise PathError(f"{step} does not reach records")
    return reached


def descendants(node: Path, paths: Sequence[Step], order: str = "depth") -> Path:
    """All records reached from ``node`` by following ``paths`` again and again.

    ``node`` itself is not included. Depth order lists each record before its own descendants and
    tries the paths in turn at every record; breadth order lists one level after the other. A path
    may be a function of the record, such as ``lambda n: n["item"].where(...)``.
    """
    reached = [c for c in (_children(node, p) for p in paths) if c is not None]
    if not reached:
        raise PathError(f"no declared records below {paths}")
    level = reached[0].item_type
    entry = T.StructType().add("key", T.BinaryType()).add("node", level)
    # a round copies all that was found before, where bytes are copied by reference

    def keyed(key: Column, number: int) -> Callable[[Column, Column], Column]:
        def body(child: Column, i: Column) -> Column:
            place = F.concat(F.lit(f"{number:08X}"), F.lpad(F.hex(i), 8, "0"))
            return F.struct(F.concat(key, F.unhex(place)).alias("key"), child.alias("node"))

        return body

    def found_from(parent: Path, key: Column) -> Column:
        """Children of a record, each with its key: four bytes of path and of position at every level down to it."""
        parts = []
        for number, step in enumerate(paths):
            children = _children(parent, step)
            if children is None:
                continue
            if children.item_type != level:
                raise PathError(f"{step} reaches records of another kind than {paths[0]}")
            parts.append(F.transform(children.array, keyed(key, number)))
        return F.concat(*parts) if parts else F.array().cast(T.ArrayType(entry))

    def round_of(state: Column, _: Column) -> Column:
        below = F.transform(state["last"], lambda x: found_from(Path(x["node"], level), x["key"]))
        step = F.struct(F.flatten(below).alias("last"), F.concat(state["all"], state["last"]).alias("all"))
        return F.when(F.size(state["last"]) > 0, step).otherwise(state)

    first = found_from(node, F.lit(b""))
    # a record is one pair of braces at least, so no descent has more levels than those
    text = F.to_json(F.transform(first, lambda x: x["node"]))
    braces = F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))
    start = F.struct(first.alias("last"), F.array().cast(T.ArrayType(entry)).alias("all"))

    def listed(state: Column) -> Column:
        records = state["all"]
        if order == "depth":
            records = F.array_sort(
                records, lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)
            )
        return F.transform(records, lambda x: x["node"])

    rounds = F.sequence(F.lit(0), F.coalesce(braces, F.lit(0)))
    return Path(F.aggregate(rounds, start, round_of, listed), T.ArrayType(level), False, True)
