"""Nested records from flat rows, one record per row, without any shuffle.

A record is described by nested dicts and lists whose leaves are SQL expressions over the
source table. :func:`record` builds exactly the declared read schema from it; fields that
are not described are null.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflat.sources.schemas import resource_schema


@dataclass(frozen=True)
class When:
    """A part that is only there when a SQL condition holds."""

    condition: str
    part: Any


def nested(part: Any, dtype: T.DataType) -> str:
    """SQL text that builds a part in exactly the given type."""
    if part is None:
        return f"cast(null as {dtype.simpleString()})"
    if isinstance(part, When):
        return f"case when {part.condition} then {nested(part.part, dtype)} end"
    if isinstance(dtype, T.StructType):
        unknown = set(part) - set(dtype.names)
        if unknown:
            raise ValueError(f"fields {unknown} are not declared")
        fields = [f"'{f.name}', {nested(part.get(f.name), f.dataType)}" for f in dtype.fields]
        return f"named_struct({', '.join(fields)})"
    if isinstance(dtype, T.ArrayType):
        items = f"array({', '.join(nested(p, dtype.elementType) for p in part)})"
        if not any(isinstance(p, When) for p in part):
            return items
        if not isinstance(dtype.elementType, T.StructType):
            return f"array_compact({items})"
        # without a lambda, so that code is generated for all that is inside
        return f"concat({', '.join(_one_or_none(p, dtype) for p in part if p is not None)})"
    return f"cast({part} as {dtype.simpleString()})"


def _one_or_none(part: Any, dtype: T.ArrayType) -> str:
    """SQL text of an array with a struct, or of an empty one where its condition does not hold."""
    if not isinstance(part, When):
        return f"array({nested(part, dtype.elementType)})"
    empty = f"cast(array() as {dtype.simpleString()})"
    return f"case when {part.condition} then {_one_or_none(part.part, dtype)} else {empty} end"


def within(part: Any, dtype: T.DataType) -> Any:
    """A part without what a narrower type leaves out."""
    if isinstance(part, When):
        return When(part.condition, within(part.part, dtype))
    if isinstance(part, dict) and isinstance(dtype, T.StructType):
        return {name: within(p, dtype[name].dataType) for name, p in part.items() if name in dtype.names}
    if isinstance(part, list) and isinstance(dtype, T.ArrayType):
        return [within(p, dtype.elementType) for p in part]
    return part


def record(
    df: DataFrame, resource_type: str, parts: dict[str, Any], schema: T.StructType | None = None
) -> DataFrame:
    """Records of the declared read schema, or of a part of it (see :meth:`FlatView.reads`)."""
    declared = resource_schema(resource_type)
    parts = {"resourceType": f"'{resource_type}'", **parts}
    unknown = set(parts) - set(declared.names)
    if unknown:
        raise ValueError(f"fields {unknown} are not declared")
    if schema is None:
        schema = declared
    else:
        parts = within(parts, schema)
    built = df.selectExpr(*[f"{nested(parts.get(f.name), f.dataType)} as {f.name}" for f in schema.fields])
    # the comments of the schema, which say what kind of text a leaf is; a cast that changes no value is free
    return built.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields])


def as_json(df: DataFrame) -> DataFrame:
    """Records as lines of JSON, with numbers where the read schema keeps their text."""
    plain = [F.col(f.name).cast(_plain(f.dataType)).alias(f.name) for f in df.schema.fields]
    return df.select(F.to_json(F.struct(*plain)).alias("value"))


def _plain(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_plain(dtype.elementType), dtype.containsNull)
    if not isinstance(dtype, T.StructType):
        return dtype
    return T.StructType([
        T.StructField(f.name, T.DoubleType() if f.metadata.get("comment") == "decimal" else _plain(f.dataType), f.nullable)
        for f in dtype.fields
    ])
