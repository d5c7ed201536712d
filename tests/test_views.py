"""Views: columns, unnesting, cross products, unions, filters, constants, validation."""

import pytest
from conftest import same
from pyspark.sql import functions as F

from clinflat import Col, Constant, FlatView, Select, ViewError

SCHEMA = """resourceType string, id string, active boolean, gender string, birthDate string,
    name array<struct<use:string,family:string,given:array<string>>>,
    contact array<struct<role:string,name:struct<family:string,given:array<string>>,
        telecom:array<struct<system:string,value:string>>>>,
    telecom array<struct<system:string,value:string>>, link array<struct<reference:string>>"""
PEOPLE = [
    {
        "resourceType": "Patient",
        "id": "a",
        "active": True,
        "gender": "female",
        "name": [{"use": "usual", "family": "Ash"}, {"use": "official", "family": "Oak", "given": ["Ivy", None, "Fern"]}],
        "contact": [
            {"role": "kin", "name": {"family": "Elm", "given": ["Bo", "Cy"]}, "telecom": [{"system": "phone", "value": "1"}, {"system": "email", "value": "2"}]},
            {"name": {"family": "Fir", "given": ["Di"]}, "telecom": [{"system": "phone", "value": "3"}]},
        ],
        "telecom": [{"system": "fax", "value": "9"}],
        "link": [{"reference": "Patient/a"}],
    },
    {"resourceType": "Patient", "id": "b", "active": False, "gender": "male", "name": [{"family": "Yew"}], "link": [{"reference": "Patient/z"}]},
    {"resourceType": "Patient", "id": "c"},
    {"resourceType": "Group", "id": "g", "active": True},
]
ID = Select([Col("id", "id", "id")])


@pytest.fixture
def people(ndjson):
    return ndjson(PEOPLE, SCHEMA)


def run(people, *selects, **options):
    return FlatView("v", "Patient", list(selects), **options).apply(people)


def index(name="i"):
    return Col(name, lambda n: n.row_index, "integer")


def test_only_records_of_the_type(people):
    same(run(people, ID), [{"id": "a"}, {"id": "b"}, {"id": "c"}])
    same(FlatView("v", "Group", [ID]).apply(people), [{"id": "g"}])


def test_booleans_keep_false_and_null(people):
    got = run(people, ID, Select([Col("active", "active", "boolean")]))
    same(got, [{"id": "a", "active": True}, {"id": "b", "active": False}, {"id": "c", "active": None}])


def test_column_order_is_own_then_selects_then_union(people):
    view = FlatView(
        "v",
        "Patient",
        [
            Select(
                [Col("a", lambda n: F.lit("A"))],
                select=[Select([Col("b", lambda n: F.lit("B"))], for_each="name")],
                union_all=[Select([Col("c", lambda n: F.lit("C1"))]), Select([Col("c", lambda n: F.lit("C2"))])],
            ),
            Select([Col("d", lambda n: F.lit("D"))]),
        ],
    )
    got = view.apply(people)
    assert got.columns == view.columns == ["a", "b", "c", "d"]
    assert got.count() == 6


def test_for_each_drops_and_or_null_keeps_records_without_items(people):
    same(
        run(people, ID, Select([Col("f", "family"), index()], for_each="name")),
        [{"id": "a", "f": "Ash", "i": 0}, {"id": "a", "f": "Oak", "i": 1}, {"id": "b", "f": "Yew", "i": 0}],
    )
    got = run(people, ID, Select([Col("f", "name.family"), index()], for_each_or_null="contact"))
    same(
        got,
        [
            {"id": "a", "f": "Elm", "i": 0},
            {"id": "a", "f": "Fir", "i": 1},
            {"id": "b", "f": None, "i": 0},
            {"id": "c", "f": None, "i": 0},
        ],
    )


def test_siblings_multiply(people):
    got = run(people, Select([Col("f", "family")], for_each="name"), Select([Col("c", "name.family")], for_each="contact"))
    same(got, [{"f": f, "c": c} for f in ("Ash", "Oak") for c in ("Elm", "Fir")])


def test_nested_for_each_has_its_own_index(people):
    inner = Select([index("j"), Col("sys", "system")], for_each="telecom")
    got = run(people, ID, Select([index()], for_each="contact", select=[inner]))
    same(
        got,
        [
            {"id": "a", "i": 0, "j": 0, "sys": "phone"},
            {"id": "a", "i": 0, "j": 1, "sys": "email"},
            {"id": "a", "i": 1, "j": 0, "sys": "phone"},
        ],
    )


def test_for_each_through_two_arrays_and_plain_values(people):
    got = run(people, ID, Select([Col("v", "value")], for_each="contact.telecom"))
    same(got, [{"id": "a", "v": v} for v in "123"])
    got = run(people, ID, Select([Col("g", "$this")], for_each="name.given"))
    same(got, [{"id": "a", "g": "Ivy"}, {"id": "a", "g": "Fern"}])


def test_union_keeps_duplicates_and_inherits_the_index(people):
    branch = Select([Col("v", "value"), index("j")], for_each="telecom")
    plain = Select([Col("v", "name.family"), index("j")])
    got = run(people, ID, Select([index()], for_each="contact", union_all=[branch, plain, plain]))
    same(
        got,
        [
            {"id": "a", "i": 0, "v": "1", "j": 0},
            {"id": "a", "i": 0, "v": "2", "j": 1},
            {"id": "a", "i": 0, "v": "Elm", "j": 0},
            {"id": "a", "i": 0, "v": "Elm", "j": 0},
            {"id": "a", "i": 1, "v": "3", "j": 0},
            {"id": "a", "i": 1, "v": "Fir", "j": 1},
            {"id": "a", "i": 1, "v": "Fir", "j": 1},
        ],
    )


def test_union_of_or_null_branches(people):
    one = Select([Col("v", "value")], for_each_or_null="telecom")
    none = Select([Col("v", "value")], for_each="telecom")
    got = run(people, ID, Select(union_all=[none, one]))
    same(got, [{"id": "a", "v": "9"}, {"id": "a", "v": "9"}, {"id": "b", "v": None}, {"id": "c", "v": None}])


def test_nested_union_and_items_by_position(people):
    first = Select([Col("v", "value")], for_each=lambda n: n["telecom"].at(0))
    contact = Select([Col("v", "value")], for_each=lambda n: n["contact"]["telecom"].at(0))
    got = run(people, ID, Select(union_all=[first, Select(union_all=[first, contact])]))
    same(got, [{"id": "a", "v": "9"}, {"id": "a", "v": "9"}, {"id": "a", "v": "1"}])


def test_cross_product_inside_a_union_branch(people):
    branch = Select(
        [Col("f", "name.family")],
        for_each="contact",
        select=[Select([Col("g", "$this")], for_each="name.given"), Select([Col("s", "system")], for_each="telecom")],
    )
    got = run(people, ID, Select(union_all=[branch]))
    pairs = [("Elm", g, s) for g in ("Bo", "Cy") for s in ("phone", "email")] + [("Fir", "Di", "phone")]
    same(got, [{"id": "a", "f": f, "g": g, "s": s} for f, g, s in pairs])


def test_collection_columns(people):
    got = run(people, Select([Col("id", "id"), Col("g", "name.given", collection=True)]))
    same(got, [{"id": "a", "g": ["Ivy", "Fern"]}, {"id": "b", "g": []}, {"id": "c", "g": []}])


def test_several_values_in_a_plain_column_are_an_error(people):
    with pytest.raises(Exception, match="more than one value"):
        run(people, Select([Col("f", "name.family")])).collect()


def test_where_needs_true(people):
    same(run(people, ID, where=["active"]), [{"id": "a"}])
    same(run(people, ID, where=[lambda n: n["active"] == False]), [{"id": "b"}])  # noqa: E712
    two = [lambda n: n["name"].exists(), lambda n: n["name"].exists(lambda x: x["use"] == "official")]
    same(run(people, ID, where=two), [{"id": "a"}])
    same(run(people, ID, where=[lambda n: n["name"].where(lambda x: x["family"] == "Yew").empty()]), [{"id": "a"}, {"id": "c"}])
    same(run(people, ID, where=[lambda n: n["name"]["family"].exists() & (n["name"]["family"] == "Yew")]), [{"id": "b"}])


def test_where_that_is_not_boolean(people):
    with pytest.raises(ViewError, match="boolean"):
        run(people, ID, where=["name.family"])
    with pytest.raises(ViewError, match="boolean"):
        run(people, ID, where=[lambda n: F.lit(1)])


def test_constants(people):
    constants = {"use": Constant("string", "official"), "n": Constant("integer", 1), "ok": Constant("boolean", True)}
    got = run(
        people,
        Select(
            [
                Col("id", "id"),
                Col("f", lambda n: n["name"].where(lambda x: x["use"].col == n.const("use"))["family"]),
                Col("second", lambda n: n["name"].at(n.const("n").cast("int"))["family"]),
                Col("system", lambda n: n.const("loinc")),
            ]
        ),
        where=[lambda n: n["active"].col == n.const("ok")],
        constants=constants,
    )
    same(got, [{"id": "a", "f": "Oak", "second": "Oak", "system": "http://loinc.org"}])
    with pytest.raises(ViewError, match="undefined constant"):
        run(people, Select([Col("x", lambda n: n.const("nope"))]))


@pytest.mark.parametrize(
    "kind,value,stored",
    [
        ("base64Binary", "aGk=", "aGk="),
        ("code", "x", "x"),
        ("date", "2020-01-01", "2020-01-01"),
        ("dateTime", "2020-01-01", "2020-01-01"),
        ("decimal", "1.2", 1.2),
        ("id", "i1", "i1"),
        ("instant", "2015-02-07T13:28:17.239+02:00", "2015-02-07T13:28:17.239+02:00"),
        ("integer64", 7, 7),
        ("oid", "urn:oid:1", "urn:oid:1"),
        ("positiveInt", 1, 1),
        ("time", "18:12:00", "18:12:00"),
        ("unsignedInt", 9, 9),
        ("uri", "urn:x", "urn:x"),
        ("url", "http://x", "http://x"),
        ("uuid", "urn:uuid:1", "urn:uuid:1"),
        ("canonical", "http://c", "http://c"),
    ],
)
def test_constant_kinds(spark, kind, value, stored):
    dtype = {str: "string", int: "bigint", float: "double"}[type(stored)]
    df = spark.createDataFrame([("T", stored), ("T", None)], f"resourceType string, v {dtype}")
    view = FlatView("v", "T", [Select([Col("b", lambda n: n["v"].col == n.const("k"), "boolean")])], constants={"k": Constant(kind, value)})
    same(view.apply(df), [{"b": True}, {"b": None}])


def test_resource_is_reachable_from_an_item(people):
    got = run(people, Select([Col("who", lambda n: n.resource["id"]), Col("f", "family")], for_each="name"))
    same(got, [{"who": "a", "f": "Ash"}, {"who": "a", "f": "Oak"}, {"who": "b", "f": "Yew"}])


def test_reference_keys_against_the_own_key(people):
    def column(target):
        return Col("same", lambda n: n["id"].equals(n["link"].ref_key(target)), "boolean")

    for target in (None, "Patient"):
        got = run(people, ID, Select([column(target)]))
        same(got, [{"id": "a", "same": True}, {"id": "b", "same": False}, {"id": "c", "same": None}])
    got = run(people, Select([column("Group")]))
    same(got, [{"same": None}] * 3)


def test_output_types(people):
    got = run(
        people,
        Select(
            [
                Col("json", lambda n: n["telecom"].first()),
                Col("flag_text", "active"),
                Col("flag_number", "active", "integer"),
                Col("not_flag", "gender", "boolean"),
                Col("count", lambda n: n["name"].count(), "integer"),
            ]
        ),
        where=[lambda n: n["id"] == "a"],
    )
    assert [f.dataType.simpleString() for f in got.schema] == ["string", "string", "bigint", "boolean", "bigint"]
    same(got, [{"json": '{"system":"fax","value":"9"}', "flag_text": "true", "flag_number": None, "not_flag": None, "count": 2}])


def test_validation():
    with pytest.raises(ViewError):
        FlatView("v", "Patient", [])
    with pytest.raises(ViewError):
        FlatView("v", "", [ID])
    with pytest.raises(ViewError, match="duplicate"):
        FlatView("v", "Patient", [ID, ID])
    with pytest.raises(ViewError, match="invalid column name"):
        Col("1x", "id")
    with pytest.raises(ViewError, match="only one"):
        Select([Col("x", "id")], for_each="name", repeat=["item"])
    with pytest.raises(ViewError, match="for_each"):
        Select([Col("x", "id")], for_each=1)
    with pytest.raises(ViewError, match="branches differ"):
        Select(union_all=[Select([Col("a", "id"), Col("b", "id")]), Select([Col("b", "id"), Col("a", "id")])])
    with pytest.raises(ViewError):
        Constant("string", None)
    with pytest.raises(ViewError):
        Constant("Quantity", 1)
    with pytest.raises(ViewError):
        FlatView("v", "Patient", [ID], constants={"x": "plain"})


def test_unknown_field(people):
    with pytest.raises(ViewError, match="no field"):
        run(people, Select([Col("x", "nickname")]))


def test_the_plan_has_no_shuffle(people):
    got = run(people, ID, Select([Col("f", "family")], for_each="name"), Select(union_all=[Select([Col("g", "gender")])]))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def reads(*selects, **options):
    from pyspark.sql import types as T

    view = FlatView("v", "Patient", list(selects), **options)
    return view.reads(T.StructType.fromDDL(SCHEMA)).simpleString()


def test_a_view_of_some_columns_reads_their_fields_only(people, ndjson):
    from pyspark.sql import types as T

    contact = Select(
        for_each="contact",
        shared={"size": lambda n: F.size(n["telecom"].col), "family": lambda n: n["name"]["family"].col},
        columns=[
            index(),
            Col("role", "role", "code"),
            Col("size", lambda n: n.shared("size"), "integer"),
            Col("family", lambda n: n.shared("family")),
        ],
    )
    view = FlatView("v", "Patient", [Select([Col("id", "id", "id"), Col("gender", "gender")]), contact], where=["active"])
    few = view.only(["id", "i", "family"])
    schema = few.reads(T.StructType.fromDDL(SCHEMA))
    assert schema.simpleString() == (
        "struct<resourceType:string,id:string,active:boolean,contact:array<struct<name:struct<family:string,given:array<string>>>>>"
    )
    assert few.columns == ["id", "i", "family"]
    want = [{"id": "a", "i": 0, "family": "Elm"}, {"id": "a", "i": 1, "family": "Fir"}]
    same(few.apply(ndjson(PEOPLE, schema)), want)
    same(few.apply(people), want)
    # rows stay where no column of the items does
    none = view.only(["id"])
    same(none.apply(ndjson(PEOPLE, none.reads(T.StructType.fromDDL(SCHEMA)))), [{"id": "a"}, {"id": "a"}])


def test_records_and_items_used_as_a_whole_are_read_as_a_whole():
    whole = "link:array<struct<reference:string>>"
    assert whole in reads(Select(for_each="link", columns=[Col("x", "$this")]))
    assert whole in reads(Select(for_each="link", columns=[index()]), Select([Col("n", lambda n: n["link"].count(), "integer")]))
    names = Select(for_each="name", columns=[Col("family", "family")])
    assert "name:array<struct<family:string>>>" in reads(names)
    assert "gender" in reads(Select(for_each="name", columns=[Col("g", lambda n: n.resource["gender"])]))
    deep = Select(for_each="contact", columns=[Col("role", "role")], select=[Select(for_each="telecom", columns=[Col("value", "value")])])
    assert "contact:array<struct<role:string,telecom:array<struct<system:string,value:string>>>>" in reads(deep)


def test_only_needs_known_columns_and_whole_branches():
    view = FlatView("v", "Patient", [ID, Select(union_all=[Select([Col("x", "gender")]), Select([Col("x", "birthDate")])])])
    assert view.only(["id", "x"]).columns == ["id", "x"]
    for wrong in (["nothing"], ["id"]):
        with pytest.raises(ViewError):
            view.only(wrong)
