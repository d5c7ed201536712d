"""Leaves read as they are written, choice elements without a type, equivalence, incremental tables."""

import json

import pytest
from conftest import rows, same
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflat import Col, FlatView, Select, ViewError
from clinflat.functions.collections import PartialDates, Path, PathError, WrittenNumbers
from clinflat.sources.resources import read_resources
from clinflat.sources.schemas import resource_schema
from clinflat.sources.upkeep import IncrementalTable, latest_versions

SEEN = [
    {"resourceType": "Observation", "id": "a", "valueQuantity": {"value": "RAW1.50", "unit": "mg"}, "effectiveDateTime": "2020-06",
     "component": [{"valueQuantity": {"value": "RAW1e2"}}, {"valueCodeableConcept": {"text": "t"}}, {"valueQuantity": {"value": 3}}]},
    {"resourceType": "Observation", "id": "b", "valueString": "Word", "effectiveDateTime": "2020-06-10"},
    {"resourceType": "Observation", "id": "c", "valueBoolean": False, "effectiveDateTime": "2021"},
    {"resourceType": "Observation", "id": "d", "valueCodeableConcept": {"text": "concept"}},
    {"resourceType": "Observation", "id": "e"},
]


@pytest.fixture
def seen(ndjson):
    # numbers as they are written, not as Python would write them
    text = [json.dumps(r).replace('"RAW1.50"', "1.50").replace('"RAW1e2"', "1e2") for r in SEEN]
    return ndjson(text, resource_schema("Observation"))


def column(df, path, type="string", collection=False):
    view = FlatView("v", "Observation", [Select([Col("id", "id"), Col("x", path, type, collection)])])
    return {r.id: r.x for r in view.apply(df).collect()}


def test_written_digits_of_bundled_schemas(seen):
    assert column(seen, "valueQuantity.value", "decimal")["a"] == 1.5
    assert column(seen, lambda n: n["valueQuantity"]["value"].low_boundary(), "decimal")["a"] == 1.495
    assert column(seen, lambda n: n["valueQuantity"]["value"].high_boundary(), "decimal")["a"] == 1.505
    values = column(seen, lambda n: n["component"]["valueQuantity"]["value"], "decimal", True)
    assert values["a"] == [100.0, 3.0] and values["b"] == []
    assert column(seen, lambda n: n["component"]["valueQuantity"]["value"].last().high_boundary(), "decimal")["a"] == 3.5
    assert column(seen, lambda n: n["valueQuantity"]["value"] > 1, "boolean") == {"a": True, **dict.fromkeys("bcde")}
    assert column(seen, lambda n: n["component"]["valueQuantity"]["value"].where(lambda v: v > 50).count(), "integer")["a"] == 1


def test_boundaries_need_the_written_form(spark):
    number = Path(F.lit(1.5), T.DoubleType())
    with pytest.raises(PathError, match="as written"):
        number.low_boundary("decimal")
    with pytest.raises(PathError, match="as written"):
        Path(F.lit("x"), T.StringType()).high_boundary()
    df = spark.createDataFrame([(1.5,)], "value double")
    with pytest.raises(ViewError):
        FlatView("v", "R", [Select([Col("x", lambda n: n["value"].low_boundary(), "decimal")])]).apply(df)


def test_dates_compare_by_their_precision(seen):
    assert column(seen, lambda n: n["effectiveDateTime"] == "2020-06-10", "boolean") == {"a": None, "b": True, "c": False, "d": None, "e": None}
    assert column(seen, lambda n: n["effectiveDateTime"] < "2020-07", "boolean") == {"a": True, "b": True, "c": False, "d": None, "e": None}
    assert column(seen, lambda n: n["effectiveDateTime"].high_boundary())["a"] == "2020-06-30T23:59:59.999-12:00"
    start = Path(F.col("p"), T.StructType.fromDDL("start string COMMENT 'dateTime'"))["start"]
    assert isinstance(start, PartialDates) and start.kind == "dateTime"


def test_dates_in_collections(spark):
    df = spark.createDataFrame(
        [(["2020", "2020-06", "2020", "2020-01-01T00:00:00Z", "2020-01-01T01:00:00+01:00", None],)], "a array<string>"
    )
    dates = PartialDates(F.col("a"), T.ArrayType(T.StringType()), kind="dateTime")
    kept = ["2020", "2020-06", "2020-01-01T00:00:00Z"]
    got = df.select(
        dates.distinct().col.alias("distinct"),
        dates.take(1).union(dates).col.alias("union"),
        dates.where(lambda d: d == "2020-06").col.alias("month"),
        dates.first().equals("2020-01").alias("undecided"),
        dates.contains_item(F.lit("2020-01-01T02:00:00+02:00")).alias("instant"),
    ).first()
    assert (got.distinct, got.union, got.month, got.undecided, got.instant) == (kept, kept, ["2020-06"], None, True)


def test_choice_without_type(seen):
    assert column(seen, "value") == {
        "a": '{"value":"1.50","unit":"mg"}', "b": "Word", "c": "false", "d": '{"text":"concept"}', "e": None,
    }
    assert column(seen, lambda n: n["value"].exists(), "boolean") == {**dict.fromkeys("abcd", True), "e": False}
    assert column(seen, lambda n: n["value"]["unit"])["a"] == "mg"
    assert column(seen, lambda n: n["value"]["value"].low_boundary(), "decimal")["a"] == 1.495
    assert column(seen, "value.text")["d"] == "concept"
    assert column(seen, lambda n: n["value"].is_type("string"), "boolean") == {"a": False, "b": True, "c": False, "d": False, "e": None}
    assert column(seen, lambda n: n["value"].only_type("string"))["b"] == "Word"
    assert column(seen, lambda n: n["value"].only_type("Period")) == dict.fromkeys("abcde")
    assert column(seen, lambda n: n["value"] == "Word", "boolean") == {"a": False, "b": True, "c": False, "d": False, "e": None}
    assert column(seen, lambda n: n["value"] == False, "boolean")["c"] is True  # noqa: E712
    assert column(seen, lambda n: n["effective"])["b"] == "2020-06-10"
    texts = column(seen, lambda n: n["component"]["value"], collection=True)["a"]
    assert texts == ['{"value":"1e2"}', '{"text":"t"}', '{"value":"3"}']
    assert column(seen, lambda n: n["component"]["value"]["text"].first())["a"] == "t"
    with pytest.raises(ViewError, match="no field"):
        column(seen, "worth")
    with pytest.raises(ViewError, match="no variant"):
        column(seen, "value.nothing")


def test_plain_fields_are_no_variants(ndjson):
    df = ndjson([{"id": "x", "statusReason": "r", "valueSet": "s"}], "id string, statusReason string, valueSet string")
    for name in ("status", "value"):
        with pytest.raises(ViewError, match="no field"):
            FlatView("v", "R", [Select([Col("x", name)])]).apply(df)


def test_equivalence(spark):
    def alike(a, b, kind="string", **options):
        df = spark.createDataFrame([(a, b)], f"a array<{kind}>, b array<{kind}>")
        dtype = df.schema["a"].dataType
        return df.select(Path(F.col("a"), dtype).equivalent(Path(F.col("b"), dtype), **options)).first()[0]

    assert alike(["A  b", "c"], ["C", " a b\t"]) is True
    assert alike(["A  b", "c"], ["C", " a b\t"], in_order=True) is False
    assert alike(["a", "a", "b"], ["a", "b", "b"]) is False
    assert alike(["a"], ["a", "a"]) is False
    assert alike(None, []) is True and alike([None], None) is True and alike(["a"], None) is False
    assert alike([2.0, 1.0], [1.0, 2.0], "double") is True
    one = spark.range(1).select(Path(F.lit(" X y"), T.StringType()).equivalent("x  Y"), Path(F.lit(None).cast("string"), T.StringType()).equivalent("x"))
    assert tuple(one.first()) == (True, False)


# -- incremental tables ----------------------------------------------------------------------


def person(i, day, family):
    meta = {} if day is None else {"meta": {"lastUpdated": f"2024-01-{day:02d}T10:00:00Z"}}
    return {"resourceType": "Patient", "id": i, "name": [{"family": family}], **meta}


def write(folder, name, people):
    folder.mkdir(exist_ok=True)
    (folder / f"Patient.{name}.ndjson").write_text("\n".join(json.dumps(p) for p in people))


def families(df):
    return {r.id: r.name[0].family for r in df.collect()}


def test_two_exports_give_the_table_of_one(spark, tmp_path):
    table = IncrementalTable(spark, str(tmp_path / "table"), "Patient")
    assert table.current().count() == 0 and table.mark() is None and table.compact() is None
    first = [person("a", 1, "A"), person("b", 2, "B"), person("c", None, "C"), person("d", 3, "D")]
    later = [person("b", 5, "B2"), person("d", 3, "D"), person("e", 4, "E"), person("b", 4, "B1"), person("a", 1, "A")]
    write(tmp_path / "one", "1", first)
    write(tmp_path / "two", "2", later)
    table.load(str(tmp_path / "one"))
    assert families(table.current()) == {"a": "A", "b": "B", "c": "C", "d": "D"}
    mark = table.load(str(tmp_path / "two"))
    want = {"a": "A", "b": "B2", "c": "C", "d": "D", "e": "E"}
    assert families(table.current()) == want
    # an update that lies before the mark is not read again
    assert spark.read.parquet(f"{tmp_path}/table/runs/run={mark.run:08d}").count() == 4
    write(tmp_path / "all", "1", first)
    write(tmp_path / "all", "2", later)
    full = read_resources(spark, str(tmp_path / "all"), "Patient")
    assert rows(latest_versions(full)) == rows(table.current())
    compacted = table.compact()
    assert compacted.base == compacted.run and families(table.current()) == want
    assert table.load(str(tmp_path / "two")).since == compacted.since
    assert families(table.current()) == want


def test_a_failed_load_changes_nothing(spark, tmp_path, monkeypatch):
    table = IncrementalTable(spark, str(tmp_path / "table"), "Patient")
    write(tmp_path / "one", "1", [person("a", 1, "A")])
    table.load(str(tmp_path / "one"))
    write(tmp_path / "two", "1", [person("a", 2, "A2")])

    def fail(mark):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(table, "_commit", fail)
        with pytest.raises(OSError):
            table.load(str(tmp_path / "two"))
    assert families(table.current()) == {"a": "A"}
    mark = table.load(str(tmp_path / "two"))
    assert families(table.current()) == {"a": "A2"}
    with pytest.raises(RuntimeError, match="another load"):
        table._commit(mark)


def test_versions_updated_at_once_are_told_apart(spark, ndjson):
    people = [person("a", 1, "X"), person("a", 1, "Y"), person("b", None, "Z"), person("b", None, "Z")]
    schema = resource_schema("Patient")
    one, other = latest_versions(ndjson(people, schema)), latest_versions(ndjson(people[::-1], schema))
    assert rows(one) == rows(other) and one.count() == 2
    same(latest_versions(ndjson([], schema)).select("id"), [])
    assert isinstance(Path(None, resource_schema("Observation"))["valueQuantity"]["value"], WrittenNumbers)
