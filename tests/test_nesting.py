"""Nested records built from flat rows."""

from pyspark.sql import types as T

from checks.nesting import When, nested, record
from clinflat.sources.schemas import resource_schema

ITEM = T.StructType().add("a", "string").add("b", "long")


def test_conditional_structs_without_a_lambda(spark):
    """An array of structs is built by generated code; a lambda would be interpreted with all inside."""
    parts = [None, When("x > 0", {"a": "'one'", "b": "x"}), {"b": "x"}, When("x is null", When("true", {"a": "'two'"}))]
    text = nested(parts, T.ArrayType(ITEM))
    df = spark.createDataFrame([(1,), (0,), (None,)], "x bigint").selectExpr(f"{text} as items")
    assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()
    got = [[tuple(i) for i in r["items"]] for r in df.collect()]
    assert got == [[("one", 1), (None, 1)], [(None, 0)], [(None, None), ("two", None)]]


def test_conditional_leaves_drop_nulls(spark):
    text = nested([When("x > 0", "'a'"), "y", None], T.ArrayType(T.StringType()))
    df = spark.createDataFrame([(1, "b"), (0, None)], "x bigint, y string").selectExpr(f"{text} as t")
    assert [r.t for r in df.collect()] == [["a", "b"], []]


def test_a_record_has_the_declared_schema(spark):
    built = record(spark.range(1), "Patient", {"id": "cast(id as string)", "name": [When("id = 0", {"family": "'F'"})]})
    declared = resource_schema("Patient")

    def comments(t):
        if isinstance(t, T.ArrayType):
            return comments(t.elementType)
        return [(f.name, f.metadata, comments(f.dataType)) for f in t] if isinstance(t, T.StructType) else t

    assert comments(built.schema) == comments(declared)
    assert built.first()["name"][0]["family"] == "F"


def test_methods_too_large_for_the_compiler_are_split(spark):
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
