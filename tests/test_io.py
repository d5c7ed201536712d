"""Readers, writers, the flatten job and the stream."""

import gzip
import json

import pytest
from conftest import rows, same
from pyspark.sql import functions as F

from clinflat import Col, FlatView, Select
from clinflat.plans.tables import TABLES
from clinflat.sources.resources import (
    read_bundles, bundle_resources, explode_bundles, read_code_table, read_resources,
    read_resources_since, latest_update, reference_index, resolve_conditional_refs,
    resolve_references,
)
from clinflat.sources.schemas import DIAGNOSIS_MAP_SCHEMA
from clinflat.sources.sinks import flatten_all, write_parquet, write_table
from clinflat.sources import router
from clinflat.streaming.landing import StreamReport, flatten_folder, flatten_stream, stream_resources

PEOPLE = [
    {"resourceType": "Patient", "id": f"p{i}", "meta": {"lastUpdated": f"2024-01-0{i + 1}T00:00:00Z"}, "name": [{"use": "official", "family": f"F{i}"}]}
    for i in range(4)
]
OBSERVATIONS = [
    {"resourceType": "Observation", "id": "o1", "component": [{"valueQuantity": {"value": 1.5}}, {"valueQuantity": {"value": 2}}]},
    {"resourceType": "Observation", "id": "o2", "valueQuantity": {"value": 7}},
]


def lines(records):
    return "\n".join(json.dumps(r) for r in records)


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "export"
    root.mkdir()
    (root / "Patient.000.ndjson").write_text(lines(PEOPLE[:2]) + "\n\n   \n")
    with gzip.open(root / "Patient_1.ndjson.gz", "wt") as f:
        f.write(lines(PEOPLE[2:3]))
    (root / "mixed.jsonl").write_text(lines([PEOPLE[3], *OBSERVATIONS]))
    (root / "Group.ndjson").write_text('{"resourceType": "Group", "id": "g"}')
    (root / "notes.txt").write_text("not a resource")
    return str(root)


def test_file_names(spark, tmp_path):
    names = ["Patient.001.ndjson", "Patient_1.ndjson", "Patient-2.ndjson.gz", "patients.ndjson", "P4.ndjson", "PatientX.ndjson", "Patient.txt"]
    for name in names:
        with (gzip.open if name.endswith("gz") else open)(tmp_path / name, "wt") as f:
            f.write(json.dumps({"resourceType": "Patient", "id": name}))
    same(read_resources(spark, str(tmp_path), "Patient").select("id"), [{"id": n} for n in names[:5]])


def test_read_resources(spark, folder):
    same(read_resources(spark, folder, "Patient").select("id"), [{"id": f"p{i}"} for i in range(4)])
    same(read_resources(spark, folder, "Observation").select("id"), [{"id": "o1"}, {"id": "o2"}])
    assert read_resources(spark, folder + "/Group.ndjson", "Group", "resourceType string, id string").count() == 1


def test_named_files_are_read_whatever_their_names(spark, tmp_path):
    (tmp_path / "export.json").write_text(lines(PEOPLE))
    (tmp_path / "Group.txt").write_text(lines(PEOPLE[:1]))
    assert read_resources(spark, str(tmp_path / "export.json"), "Patient").count() == 4
    assert read_resources(spark, str(tmp_path / "Group.txt"), "Patient").count() == 1
    assert read_resources(spark, [str(tmp_path / "export.json"), str(tmp_path / "Group.txt")], "Patient").count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_resources(spark, str(tmp_path / "absent.json"), "Patient")


def test_untyped_files_are_routed_once(spark, folder, tmp_path):
    with open(f"{folder}/mixed.jsonl", "a") as f:
        f.write('\n \t \n{"id": "no type"}\n')
    assert router.has_untyped_files(spark, folder) and not router.has_untyped_files(spark, f"{folder}/mixed.jsonl")
    layout = str(tmp_path / "layout")
    router.route_resources(spark, folder, layout)
    people = router.read_routed(spark, layout, "Patient")
    same(people.select("id"), [{"id": "p3"}])
    same(router.read_routed(spark, layout, "Observation").select("id"), [{"id": "o1"}, {"id": "o2"}])
    assert router.read_routed(spark, layout, "Group", "resourceType string, id string").count() == 0
    plan = people._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(record_type" in plan
    nothing = str(tmp_path / "nothing")
    router.write_by_type(spark.createDataFrame([], "value string, type string"), nothing)
    assert router.read_routed(spark, nothing, "Patient").count() == 0
    typed = read_resources(spark, folder, "Patient", typed_only=True)
    same(typed.select("id"), [{"id": f"p{i}"} for i in range(3)])


def test_mixed_folder_is_scanned_once_by_the_job(spark, folder, tmp_path, monkeypatch):
    """Once the lines are routed, the job does not touch the mixed file again."""
    from clinflat.sources import sinks

    def route(spark, source, layout):
        router.route_resources(spark, source, layout)
        (tmp_path / "export" / "mixed.jsonl").unlink()

    monkeypatch.setattr(sinks, "route_resources", route)
    report = flatten_all(spark, VIEWS, folder, parquet_folder=str(tmp_path / "flat"))
    got = {r.name: (r.rows, r.resources) for r in report.collect()}
    assert got == {"patient": (4, 4), "observation": (2, 2), "observation_component": (2, 2), "medication": (0, 0)}


def test_a_broken_line_of_an_untyped_file_is_an_error(spark, tmp_path):
    (tmp_path / "mixed.ndjson").write_text('{"resourceType": "Patient"')
    with pytest.raises(Exception, match="not a JSON record"):
        router.route_resources(spark, str(tmp_path), str(tmp_path / "layout"))


def test_only_matching_files_are_read(spark, folder):
    with open(f"{folder}/Group.ndjson", "w") as f:
        f.write("a broken line, an error once it is parsed")
    same(read_resources(spark, folder, "Patient").select("id"), [{"id": f"p{i}"} for i in range(4)])
    view = TABLES["patient"]
    query = flatten_stream(view, stream_resources(spark, folder, "Patient"), f"{folder}-out", f"{folder}-state")
    query.awaitTermination(120)
    assert query.exception() is None and spark.read.parquet(f"{folder}-out").count() == 4


def test_broken_lines_and_wrong_shapes_fail(spark, tmp_path):
    (tmp_path / "Patient.ndjson").write_text('{"resourceType": "Patient"')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_resources(spark, str(tmp_path), "Patient").collect()
    (tmp_path / "Patient.ndjson").write_text('{"resourceType": "Patient", "id": "x", "name": {"family": "not an array"}}')
    with pytest.raises(Exception, match="(?i)malformed"):
        TABLES["patient"].apply(read_resources(spark, str(tmp_path), "Patient")).collect()


def test_incremental_read(spark, folder):
    got = read_resources_since(spark, folder, "Patient", "2024-01-02T12:00:00+00:00").select("id")
    same(got, [{"id": "p2"}, {"id": "p3"}])
    newest = latest_update(read_resources(spark, folder, "Patient")).first().transaction_time
    assert str(newest).startswith("2024-01-04")


def test_bundles(spark, tmp_path):
    entry = [{"resource": PEOPLE[0]}, {"fullUrl": "x"}, {"resource": OBSERVATIONS[1]}]
    (tmp_path / "one.json").write_text(json.dumps({"resourceType": "Bundle", "type": "transaction", "entry": entry}, indent=1))
    entries = explode_bundles(read_bundles(spark, str(tmp_path)))
    same(
        entries.select("entry_count", "entry_index", "resourceType"),
        [
            {"entry_count": 3, "entry_index": 0, "resourceType": "Patient"},
            {"entry_count": 3, "entry_index": 2, "resourceType": "Observation"},
        ],
    )
    got = TABLES["patient"].apply(bundle_resources(entries, "Patient"))
    assert rows(got.select("id", "family_name")) == [{"id": "p0", "family_name": "F0"}]


def test_conditional_references(spark):
    target = spark.createDataFrame(
        [("1", [("s", "a"), ("s", "b")]), ("0", [("s", "b")]), ("2", None)],
        "id string, identifier array<struct<system:string,value:string>>",
    )
    df = spark.createDataFrame(
        [("Org?identifier=s|a",), ("Org?identifier=s|b",), ("Org?identifier=s|z",), ("Org/9",), ("Person?identifier=s|a",), (None,)],
        "r string",
    )
    got = resolve_conditional_refs(df, "r", target, "Org")
    same(got, [{"r": x} for x in ("Org/1", "Org/0", "Org?identifier=s|z", "Org/9", "Person?identifier=s|a", None)])


def test_references_of_many_types(spark):
    kind = "id string, identifier array<struct<system:string,value:string>>"
    people = spark.createDataFrame([("p2", [("s", "a|b")]), ("p1", [("s", "a|b"), (None, "x"), ("s", None)])], kind)
    groups = spark.createDataFrame([("g", [("s", "a|b")]), ("h", [("", "e")])], kind)
    index = reference_index({"Person": people, "Group": groups, "Empty": groups.limit(0)})
    assert index.count() == 3
    refs = ["Person?identifier=s|a|b", "Group?identifier=s|a|b", "Group?identifier=|e", "Empty?identifier=s|a|b", "Person?identifier=s|"]
    plain = ["Person/1", "Person?name=x", "#c", "", None]
    df = spark.createDataFrame([(r, 1) for r in refs + plain], "r string, __n int")
    got = resolve_references(df, "r", index)
    want = ["Person/p1", "Group/g", "Group/h", *refs[3:], *plain]
    same(got, [{"r": r, "__n": 1} for r in want])
    # only searches are shuffled: the other rows' branch, the first of the union, has no exchange
    plan = resolve_references(df, "r", index)._jdf.queryExecution().executedPlan().toString().splitlines()
    top = next(i for i, line in enumerate(plan) if line.endswith("Union"))
    indent = plan[top].index("Union")
    bypass = [line for line in plan[top + 1 :] if line[indent : indent + 1] == ":"]
    assert any("NOT coalesce(RLIKE" in line for line in bypass) and not any("Exchange" in line for line in bypass)


def test_code_table(spark, tmp_path):
    (tmp_path / "map.csv").write_text(
        "referenced_component_id,map_target,map_target_name,map_group,map_priority,map_rule,active\n123,E11.9,Diabetes,1,1,TRUE,1\n"
    )
    got = read_code_table(spark, str(tmp_path / "map.csv"), DIAGNOSIS_MAP_SCHEMA).first()
    assert (got.referenced_component_id, got.map_target) == ("123", "E11.9")


VIEWS = [TABLES["patient"], TABLES["observation"], TABLES["observation_component"], TABLES["medication"]]


@pytest.mark.parametrize(("once", "staging"), [(True, "stage"), (True, None), (False, None)])
def test_flatten_all(spark, folder, tmp_path, once, staging):
    out = str(tmp_path / "flat")
    staging = staging and str(tmp_path / staging)
    report = flatten_all(spark, VIEWS, folder, parquet_folder=out, parse_once=once, staging=staging)
    got = {r.name: (r.rows, r.resources) for r in report.collect()}
    assert got == {"patient": (4, 4), "observation": (2, 2), "observation_component": (2, 2), "medication": (0, 0)}
    component = spark.read.parquet(f"{out}/observation_component")
    assert [r.value_quantity for r in component.orderBy("component_index").collect()] == [1.5, 2.0]
    empty = spark.read.parquet(f"{out}/medication")
    assert empty.columns == TABLES["medication"].columns and empty.count() == 0


def test_table_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    location = str(tmp_path / "warehouse_db")
    spark.sql(f"create database if not exists sink_test location '{location}'")
    try:
        write_table(df, "sink_test.t")
        write_table(df.limit(0), "sink_test.t")
        assert spark.table("sink_test.t").count() == 0
    finally:
        spark.sql("drop database sink_test cascade")
    write_parquet(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 1


def test_stream_gives_the_batch_rows_and_reads_files_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    view = TABLES["observation_component"]

    def advance():
        query = flatten_stream(view, stream_resources(spark, str(landing), "Observation"), out, state)
        query.awaitTermination(120)

    (landing / "Observation.1.ndjson").write_text(lines(OBSERVATIONS))
    advance()
    (landing / "Observation.2.ndjson").write_text(lines(OBSERVATIONS[:1]).replace("o1", "o3"))
    advance()
    advance()
    got = spark.read.parquet(out)
    want = view.apply(read_resources(spark, str(landing), "Observation"))
    assert rows(got) == rows(want)
    assert got.select("observation_id").distinct().count() == 2
    assert view.apply(stream_resources(spark, str(landing), "Observation")).isStreaming
    assert got.filter(F.col("component_index").isNull()).count() == 0


def test_one_stream_for_many_views(spark, tmp_path):
    """Five views of two types: each file is read once, counts add up, a batch that is run again replaces itself."""
    landing = tmp_path / "landing"
    landing.mkdir()
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    again = FlatView("patient_again", "Patient", TABLES["patient"].select)
    names = FlatView("patient_name", "Patient", [Select([Col("id", "id")]), Select([Col("family", "family")], for_each="name")])
    views = [TABLES["patient"], again, names, TABLES["observation"], TABLES["observation_component"]]
    report = StreamReport()

    def advance(**options):
        query = flatten_folder(spark, views, str(landing), out, state, report=report, **options)
        query.awaitTermination(180)
        assert query.exception() is None

    def found(name):
        return spark.read.parquet(f"{out}/{name}")

    (landing / "mixed.ndjson").write_text(lines([*PEOPLE, *OBSERVATIONS, {"resourceType": "Group", "id": "g"}]) + "\n\n")
    (landing / "Observation.1.ndjson").write_text(lines(OBSERVATIONS[:1]).replace("o1", "o3"))
    (landing / "Group.ndjson").write_text("a broken line of a type that nobody wants")
    advance()
    (landing / "Patient.2.ndjson").write_text(lines(PEOPLE[:2]).replace('"p', '"q'))
    advance(files_per_batch=1)
    assert {n: found(n).count() for n in ("patient", "patient_again", "patient_name")} == dict.fromkeys(("patient", "patient_again", "patient_name"), 6)
    assert rows(found("observation_component").drop("batch")) == rows(
        TABLES["observation_component"].apply(read_resources(spark, str(landing), "Observation"))
    )
    counted = {}
    for r in report.frame(spark).collect():
        counted[r.name] = tuple(a + b for a, b in zip(counted.get(r.name, (0, 0)), (r.rows, r.resources)))
    assert counted == {"patient": (6, 6), "patient_again": (6, 6), "patient_name": (6, 6), "observation": (3, 3), "observation_component": (4, 3)}
    # the last batch is forgotten, as if the driver had died before it was committed, and run again
    last = max(int(p.name) for p in (tmp_path / "state" / "commits").iterdir() if p.name.isdigit())
    for p in (tmp_path / "state" / "commits").iterdir():
        if p.name in (str(last), f".{last}.crc"):
            p.unlink()
    advance()
    assert found("patient").count() == 6 and found("observation").count() == 3
    assert len(report.counts) == last + 1
    with pytest.raises(ValueError, match="different names"):
        flatten_folder(spark, [again, again], str(landing), out, state)
