"""The map step as one job: shared intermediates once, joins by claim without a shuffle."""

import os
import re
import time
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clinflat.plans import claims, code_maps
from clinflat.plans.common import RunInfo
from clinflat.plans.job import LINE_COLUMNS, InputLayer
from clinflat.plans.tables import TABLES
from clinflat.session import SHUFFLE_CLEANUP
from clinflat.sources.schemas import DIAGNOSIS_MAP_SCHEMA, DRUG_PACKAGE_SCHEMA, resource_schema

RUN = RunInfo("test", datetime(2026, 1, 1))
KINDS = ("professional", "institutional", "pharmacy")


def claim(i, lines):
    line = [
        {"sequence": k + 1, "servicedPeriod": {"start": f"2020-0{1 + k % 9}-02", "end": f"2020-0{1 + k % 9}-03"}, "net": {"value": 1.5 + k}}
        for k in range(lines)
    ]
    icd = {"system": "http://hl7.org/fhir/sid/icd-10-cm", "code": "E11.9"}
    return {
        "id": f"c{i}",
        "patient": {"reference": f"Patient/p{i % 3}"},
        "created": "2020-05-01",
        "type": {"coding": [{"system": "http://terminology.hl7.org/CodeSystem/claim-type", "code": KINDS[i % 3]}]},
        "insurance": [{"coverage": {"display": "Medicare"}}],
        "item": line,
        "diagnosis": [{"sequence": k + 1, "diagnosisCodeableConcept": {"coding": [icd]}} for k in range(i % 4)],
    }


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    import json

    data = {
        "Patient": [{"id": f"p{i}", "birthDate": "1980-01-01"} for i in range(3)],
        "ExplanationOfBenefit": [claim(i, 300 if i == 4 else i % 5) for i in range(30)],
    }
    folder = tmp_path_factory.mktemp("records")
    flat = {}
    for name, view in TABLES.items():
        path = folder / f"{name}.ndjson"
        path.write_text("\n".join(json.dumps({"resourceType": view.resource, **r}) for r in data.get(view.resource, [])))
        flat[name] = view.apply(spark.read.schema(resource_schema(view.resource)).json(str(path)))
    maps = (spark.createDataFrame([], DIAGNOSIS_MAP_SCHEMA), spark.createDataFrame([], DRUG_PACKAGE_SCHEMA))
    return flat.__getitem__, maps


def job(spark, sources, path, name, **options):
    flat, maps = sources
    spark.sql(f"create database if not exists {name} location '{path}/{name}'")
    return InputLayer(spark, flat, *maps, name, RUN, buckets=5, **options)


def exchanges(df):
    """Keys of the shuffles of a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan), plan


def expected_claims(sources):
    flat, maps = sources
    names = ("explanation_of_benefit", "explanation_of_benefit_item", "encounter", "practitioner")
    headers, items = claims.claim_headers(*[flat(n) for n in names]), flat("explanation_of_benefit_item")
    codes = code_maps.diagnosis_code_map(maps[0])
    lists = claims.claim_diagnosis_lists(flat("explanation_of_benefit_diagnosis"), flat("condition"), codes)
    packages = code_maps.drug_package_map(maps[1])
    return claims.medical_claims(headers, items, lists, RUN), claims.pharmacy_claims(headers, items, packages, RUN)


def test_all_tables(spark, sources, tmp_path):
    layer = job(spark, sources, tmp_path, "layer_all")
    report = {r.name: r.rows for r in layer.build().collect()}
    tables = [n for n in report if not n.startswith("stage_")]
    assert len(tables) == 14 and report["appointment"] == 0 and report["patient"] == 3
    assert report["medical_claim"] > 300 and not layer.has_long_claims
    medical, pharmacy = expected_claims(sources)
    assert rows(layer.table("medical_claim")) == rows(medical)
    assert rows(layer.table("pharmacy_claim")) == rows(pharmacy)


def test_long_claims_stay_out_of_the_buckets(spark, sources, tmp_path):
    layer = job(spark, sources, tmp_path, "layer_long", long_claim=100)
    layer.stage()
    assert layer.has_long_claims and layer.table("stage_long_claim_line").count() == 300
    assert {r.claim_id for r in layer.table("stage_claim_header").collect()} == {f"c{i}" for i in range(30)}
    medical, pharmacy = expected_claims(sources)
    assert rows(layer.medical_claims()) == rows(medical)
    assert rows(layer.pharmacy_claims()) == rows(pharmacy)


def test_lines_are_flattened_once(spark, sources, tmp_path):
    flat, maps = sources
    seen = spark.sparkContext.accumulator(0)

    def noted(value):
        seen.add(1)
        return value

    def counted(name):
        df = flat(name)
        if name == "explanation_of_benefit_item":
            df = df.withColumn("eob_id", F.udf(noted, "string").asNondeterministic()("eob_id"))
        return df

    layer = job(spark, (counted, maps), tmp_path, "layer_once", long_claim=100)
    layer.stage()
    assert layer.has_long_claims
    assert seen.value == flat("explanation_of_benefit_item").count()


def test_no_shuffle_by_claim(spark, sources, tmp_path):
    layer = job(spark, sources, tmp_path, "layer_plan")
    layer.stage()
    keys, plan = exchanges(layer.medical_claims())
    assert keys == [] and plan.count("SortMergeJoin") == 2
    keys, plan = exchanges(layer.pharmacy_claims())
    assert "SortMergeJoin" in plan and not any("claim" in k or "eob_id" in k for k in keys)


def test_staging_again_replaces(spark, sources, tmp_path):
    folder = str(tmp_path / "files")
    layer = job(spark, sources, tmp_path, "layer_again", folder=folder)
    layer.stage()
    first = list(layer.report)
    layer.report = []
    layer.stage()
    assert [r[:2] for r in layer.report] == [r[:2] for r in first]
    assert spark.read.parquet(f"{folder}/stage_claim_header").count() == 30


def test_stages_leave_what_is_read_later(spark, sources, tmp_path):
    folder = tmp_path / "kept"
    layer = job(spark, sources, tmp_path, "layer_kept", folder=str(folder), long_claim=100)
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {x for top in manager.localDirsString() for _, _, names in os.walk(top) for x in names if x.startswith("shuffle_")}

    before = shuffles()
    layer.stage()
    for _ in range(50):  # they go in the background
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before
    assert "stage_line" in [r[0] for r in layer.report] and not spark.catalog.tableExists("layer_kept.stage_line")
    assert sorted(p.name for p in folder.iterdir() if p.name.endswith("_line")) == ["stage_claim_line", "stage_long_claim_line"]
    assert layer.table("stage_claim_line").columns == list(LINE_COLUMNS)


def test_no_sort_by_claim(spark, sources, tmp_path):
    layer = job(spark, sources, tmp_path, "layer_sorted")
    layer.stage()
    for table in (layer.medical_claims(), layer.pharmacy_claims()):
        _, plan = exchanges(table)
        assert "SortMergeJoin [__line_claim" in plan or "SortMergeJoin [claim_id" in plan
        assert not re.search(r"Sort \[(__line_claim|claim_id|__dx_claim)", plan)


def test_only_the_columns_that_are_read_are_asked_for(spark, sources, tmp_path):
    flat, maps = sources
    asked = {}

    def columns(name, names):
        asked[name] = set(names)
        return flat(name).select(*names)

    layer = job(spark, sources, tmp_path, "layer_columns", columns=columns)
    layer.stage()
    items = TABLES["explanation_of_benefit_item"].columns
    assert set(asked) == {"explanation_of_benefit_item", "explanation_of_benefit_diagnosis"}
    assert asked["explanation_of_benefit_item"] < set(items) and "patient_id" not in asked["explanation_of_benefit_item"]
    medical, pharmacy = expected_claims(sources)
    assert rows(layer.medical_claims()) == rows(medical)
    assert rows(layer.pharmacy_claims()) == rows(pharmacy)


def test_tables_are_reported_in_one_order(spark, sources, tmp_path):
    layer = job(spark, sources, tmp_path, "layer_order")
    names = [r.name for r in layer.build().collect()]
    assert names[-14:] == list(layer.models()) and names[0] == "stage_diagnosis_code"
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None


def test_a_table_that_fails_fails_the_job(spark, sources, tmp_path):
    flat, maps = sources

    def broken(name):
        if name == "observation":
            raise ValueError("no such table")
        return flat(name)

    layer = job(spark, (broken, maps), tmp_path, "layer_broken")
    with pytest.raises(ValueError, match="no such table"):
        layer.build()
