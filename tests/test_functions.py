"""Text, date, code and collection functions on hand-written values."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflat.functions import codes, temporal, text
from clinflat.functions.collections import Path, reference_key


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def each(spark, fn, *cases):
    """Evaluate ``fn`` on text inputs and compare; a case is (inputs..., expected)."""
    width = len(cases[0]) - 1
    names = [f"x{i}" for i in range(width)]
    schema = ", ".join(f"{n} string" for n in ["id", *names])
    df = spark.createDataFrame([(str(i), *c[:-1]) for i, c in enumerate(cases)], schema)
    got = {r.id: r.v for r in df.select("id", fn(*[F.col(n) for n in names]).alias("v")).collect()}
    assert [got[str(i)] for i in range(len(cases))] == [c[-1] for c in cases]


@pytest.mark.parametrize(
    "target,want",
    [
        ("Patient", ["1", "1", "1", None, None, None, None, None, "1", None, None]),
        (None, ["1", "1", "1", "abc", None, None, None, "1", "1", None, "1.2"]),
    ],
)
def test_reference_key(spark, target, want):
    forms = [
        "Patient/1", "http://h/fhir/Patient/1", "Patient/1/_history/2", "urn:uuid:abc", "#1",
        "Patient?identifier=x|1", "1", "Group/1", "Patient/1/", None, "urn:oid:1.2",
    ]
    each(spark, lambda r: reference_key(r, target), *zip(forms, want, strict=True))


def test_reference_key_of_plain_and_odd_references(spark):
    want = {
        "Patient/1": "1", "Patient/é b": "é b", "Patient/a#b": "a#b", "Patient/1/": "1", "Patient/1/_history/2": "1",
        "Patient/": None, "Patient//": None, "Patient": None, "Patient/a?x=1": None, "Patient?x": None, "Patients/1": None,
        "patient/1": None, "Patient/1/2": None, "#Patient/1": None, "": None, "http://a/Patient/7": "7", "Patient/_history/2": None,
    }
    each(spark, lambda r: reference_key(r, "Patient"), *want.items())


def test_clean_name(spark):
    each(spark, text.clean_name, ("Eli499", "Eli"), (" Ann 1", "Ann"), ("123", None), ("", None), (None, None))


def test_conversions(spark):
    each(spark, text.to_integer, ("12", 12), ("-3", -3), ("1.5", None), ("x", None), ("", None), (None, None))
    each(spark, text.to_decimal, ("12", 12.0), ("-3.25", -3.25), ("1.", None), (".5", None), (None, None))


def test_number_text(spark):
    numbers = [0.0, 1.0, 120.0, 0.5, 0.00025, 1e-05, 123456789.125, 1e7, 1e16, -2.5e20, None]
    want = ["0.0", "1.0", "120.0", "0.5", "0.00025", "1e-05", "123456789.125", "10000000.0", "1e+16", "-2.5e+20", None]
    df = spark.createDataFrame(list(enumerate(numbers)), "i int, x double")
    got = [r.v for r in df.orderBy("i").select(text.number_text(F.col("x")).alias("v")).collect()]
    assert got == want


def test_text_helpers(spark):
    each(spark, lambda x: text.substring_from(x, 1, 2), ("abcd", "bc"), ("ab", "b"), ("a", None), (None, None))
    each(spark, lambda x: text.substring_from(x, -1), ("abcd", None))
    each(spark, text.equivalent, (" A  b", "a b ", True), ("a", "b", False), (None, None, True), ("a", None, False))
    assert value(spark, text.floor_mod(F.lit(-7), F.lit(3))) == 2
    assert value(spark, text.floor_mod(F.lit(7), F.lit(-3))) == -2
    assert value(spark, text.floor_mod(F.lit(7), F.lit(0))) is None


def test_code_system(spark):
    each(spark, codes.code_system, (codes.ICD10, "icd-10-cm"), (codes.CPT, "hcpcs"), ("urn:x", "urn:x"), (None, None))


def test_full_date_and_timestamp(spark):
    each(spark, lambda x: temporal.to_full_date(x).cast("string"), ("2020-02-03T01:02:03Z", "2020-02-03"), ("2020-06", None), ("2020", None), ("2020-02-31", None), (None, None))
    each(
        spark,
        lambda x: temporal.to_local_timestamp(x).cast("string"),
        ("2020-02-03T01:02:03+02:00", "2020-02-02 23:02:03"),
        ("2020-02-03", "2020-02-03 00:00:00"),
        ("2020-02", None),
        ("2020", None),
        ("nonsense text", None),
    )


def test_compare_partial(spark):
    each(
        spark,
        temporal.compare_partial,
        ("2020", "2021", -1),
        ("2020-05", "2020", None),
        ("2020-05", "2020-05", 0),
        ("2020-05-02", "2020-05-01", 1),
        ("2020-06", "2020-05-31", 1),
        ("2020-01-01T10:00:00Z", "2020-01-01T12:00:00+02:00", 0),
        ("2020-01-01T10:00:00Z", "2020-01-01T10:00:00+02:00", 1),
        ("2020-01-01T10:00", "2020-01-01T10:00:30", None),
        ("10:30:00.5", "10:30:00.49", 1),
        ("10:30", "10:30:00", None),
        (None, "2020", None),
    )


@pytest.mark.parametrize(
    "kind,written,low,high",
    [
        ("date", "1970-06", "1970-06-01", "1970-06-30"),
        ("date", "2020", "2020-01-01", "2020-12-31"),
        ("date", "2020-02", "2020-02-01", "2020-02-29"),
        ("dateTime", "2010-10-10", "2010-10-10T00:00:00.000+14:00", "2010-10-10T23:59:59.999-12:00"),
        ("dateTime", "2010-10-10T12:30Z", "2010-10-10T12:30:00.000Z", "2010-10-10T12:30:59.999Z"),
        ("date", "2010-10-10T12", "2010-10-10T12:00:00.000+14:00", "2010-10-10T12:59:59.999-12:00"),
        ("time", "12:34:00", "12:34:00.000", "12:34:00.999"),
        ("time", "12:34", "12:34:00.000", "12:34:59.999"),
        ("decimal", "1.0", 0.95, 1.05),
        ("decimal", "7", 6.5, 7.5),
        ("decimal", "-0.25", -0.255, -0.245),
        ("date", "not a date", None, None),
    ],
)
def test_boundaries(spark, kind, written, low, high):
    assert value(spark, temporal.low_boundary(F.lit(written), kind)) == low
    assert value(spark, temporal.high_boundary(F.lit(written), kind)) == high


def collection(*items, kind="string"):
    dtype = T.ArrayType(T.StringType() if kind == "string" else T.LongType())
    if items == (None,):
        return Path(F.lit(None).cast(dtype), dtype)
    return Path(F.array(*[F.lit(x) for x in items]).cast(dtype), dtype)


def test_collection_equality(spark):
    assert value(spark, collection("a") == "a") is True
    assert value(spark, collection("a", "b") == "a") is False
    assert value(spark, collection("a", "a") == "a") is False
    assert value(spark, collection(None, "a") == "a") is None or value(spark, collection("a", None) == "a") is True
    assert value(spark, collection() == "a") is None
    assert value(spark, collection(None) == "a") is None
    assert value(spark, collection("b") != "a") is True
    assert value(spark, collection("a", "b") == collection("a", "b")) is True
    assert value(spark, collection("a", "b") == collection("b", "a")) is False
    assert value(spark, collection("a", "b") == collection("a")) is False
    assert value(spark, collection("a") == collection()) is None


def test_nulls_do_not_count(spark):
    c = Path(F.array(F.lit(None).cast("string"), F.lit("a"), F.lit(None), F.lit("b")), T.ArrayType(T.StringType()))
    assert value(spark, c.count()) == 2
    assert value(spark, c.first().col) == "a"
    assert value(spark, c.at(1).col) == "b"
    assert value(spark, c.at(2).col) is None
    assert value(spark, c.last().col) == "b"
    assert value(spark, c.join("-").col) == "a-b"
    assert value(spark, c.tail().col) == ["b"]
    assert value(spark, Path(F.array(F.lit("a"), F.lit(None)), T.ArrayType(T.StringType())) == "a") is True


def test_empty_collections(spark):
    for c in (collection(), collection(None)):
        assert value(spark, c.count()) == 0
        assert value(spark, c.exists()) is False
        assert value(spark, c.empty()) is True
        assert value(spark, c.all(lambda x: x == "a")) is True
        assert value(spark, c.first().col) is None
        assert value(spark, c.join(",").col) is None
        assert value(spark, c.contains_item("a")) is False
        assert value(spark, c.skip(1).col) == []
        assert value(spark, c.array) == []


def test_single_and_membership(spark):
    assert value(spark, collection("a").single().col) == "a"
    with pytest.raises(Exception, match="more than one value"):
        value(spark, collection("a", "b").single().col)
    assert value(spark, collection("a").contains_item(F.lit(None).cast("string"))) is None
    assert value(spark, collection("a", "b").union(collection("b", "c")).col) == ["a", "b", "c"]
    assert value(spark, collection("b", "a", "b").distinct().col) == ["b", "a"]
    assert value(spark, collection("a").has_value()) is True


def test_types(spark):
    assert value(spark, collection(1, kind="long").is_type("integer")) is True
    assert value(spark, collection(1, kind="long").is_type("decimal")) is True
    assert value(spark, collection("2020").is_type("date")) is False
    assert value(spark, collection().is_type("string")) is None


def test_index_in_select_and_all(spark):
    df = spark.createDataFrame([(["a", None, "b", "c"],), ([],), (None,)], "a array<string>")
    a = Path(F.col("a"), T.ArrayType(T.StringType()))
    got = df.select(
        a.select(lambda x, i: x.map(lambda c: F.concat(c, i), T.StringType())).col.alias("named"),
        a.select(lambda x, i: i).col.alias("places"),
        a.all(lambda x, i: (i < 2) | (x == "c")).alias("all"),
        a.all(lambda x, i: i < 2).alias("two"),
    ).collect()
    assert got[0].named == ["a0", "b1", "c2"] and got[0].places == [0, 1, 2]
    assert [(r.all, r.two) for r in got] == [(True, False), (True, True), (True, True)]
