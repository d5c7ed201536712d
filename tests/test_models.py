"""Model rules that the given tables cannot show."""

from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from checks.queries import Models
from clinflat.functions import codes
from clinflat.plans import claims, clinical, reports
from clinflat.plans.common import RunInfo
from clinflat.plans.tables import TABLES
from clinflat.sources.schemas import resource_schema

RUN = RunInfo("test", datetime(2026, 1, 1))


def flat(ndjson, table, records):
    view = TABLES[table]
    return view.apply(ndjson([{"resourceType": view.resource, **r} for r in records], resource_schema(view.resource)))


def test_names_skip_missing_parts(ndjson):
    people = [
        {"id": "1", "name": [{"use": "official", "given": [None, "B"]}, {"use": "official", "family": "Z"}, {"family": "Q"}]},
        {"id": "2", "name": [{"family": "Only", "given": ["G"]}]},
        {"id": "3", "identifier": [{"type": {"coding": [{"code": "MR"}, {"code": "XX"}]}, "value": "no"}, {"type": {"coding": [{"code": "MR"}]}, "value": "yes"}]},
    ]
    got = rows(flat(ndjson, "patient", people).select("id", "family_name", "given_name", "middle_name", "mrn", "deceased_flag"))
    assert got == [
        {"id": "1", "family_name": "Z", "given_name": "B", "middle_name": None, "mrn": None, "deceased_flag": False},
        {"id": "2", "family_name": "Only", "given_name": "G", "middle_name": None, "mrn": None, "deceased_flag": False},
        {"id": "3", "family_name": None, "given_name": None, "middle_name": None, "mrn": "yes", "deceased_flag": False},
    ]


def test_adjudication_goes_on_to_the_next_entry(ndjson):
    from clinflat.functions.codes import LINE_PAID

    def entry(codes, amount):
        return {"category": {"coding": [{"code": c} for c in codes]}, **({"amount": {"value": amount}} if amount is not None else {})}

    items = [
        {"sequence": 1, "adjudication": [entry([LINE_PAID], None), entry([LINE_PAID, "x"], 1), entry([LINE_PAID], 2.5)]},
        {"sequence": 2, "adjudication": [entry([LINE_PAID], None)]},
        {"sequence": 3},
    ]
    got = flat(ndjson, "explanation_of_benefit_item", [{"id": "e", "item": items}])
    assert rows(got.select("sequence", "paid_amount")) == [
        {"sequence": 1, "paid_amount": 2.5},
        {"sequence": 2, "paid_amount": None},
        {"sequence": 3, "paid_amount": None},
    ]


def test_coverage_of_contained_resources(ndjson):
    record = {"id": "e", "contained": [{"resourceType": "Other", "type": {"text": "no"}}, {"type": {"text": "untyped counts"}}]}
    got = flat(ndjson, "explanation_of_benefit", [record]).first()
    assert got.coverage_type == "untyped counts"


def test_spans_are_clipped_to_life(spark):
    headers = spark.createDataFrame(
        [(p, "Acme", "commercial", "plan", date(y, 5, 1)) for p, y in (("a", 2000), ("a", 2000), ("a", 2001), ("a", 2003), ("b", 1999))],
        "person_id string, payer string, payer_type string, plan string, claim_start_date date",
    )
    people = spark.createDataFrame(
        [("a", "2000-03-04", "2001-02-03T00:00:00Z"), ("b", "1990", None)],
        "id string, birth_date string, deceased_datetime string",
    )
    spans = claims.enrolment_spans(headers, people)
    got = [(r.person_id, str(r.enrollment_start_date), str(r.enrollment_end_date)) for r in spans.orderBy("person_id", "enrollment_start_date").collect()]
    assert got == [("a", "2000-03-04", "2000-12-31"), ("a", "2001-01-01", "2001-02-03"), ("b", "1999-01-01", "1999-12-31")]
    months = [r.year_month for r in reports.member_months(spans).orderBy("person_id", "year_month").collect()]
    assert months[:12] == [f"2000{m:02d}" for m in range(3, 13)] + ["200101", "200102"]
    assert len(months) == 24


def test_cost_report_year_filter_and_missing_cost(spark):
    months = spark.createDataFrame([("a", "201601"), ("b", "201601"), ("a", "201501"), ("a", "201701")], "person_id string, year_month string")
    paid = spark.createDataFrame([(date(2016, 3, 1), 10.5), (date(2015, 1, 1), 99.0)], "claim_start_date date, paid_amount float")
    got = rows(reports.cost_per_member_month(months, paid))
    assert got == [
        {"year": "2016", "member_months": 2, "paid": 10.5, "pmpm": 5.25},
        {"year": "2017", "member_months": 1, "paid": 0.0, "pmpm": 0.0},
    ]


def test_member_years_combine_overlaps(spark):
    spans = [
        ("a", date(2016, 11, 30), date(2018, 2, 1)), ("a", date(2017, 3, 1), date(2017, 3, 2)), ("a", date(2018, 2, 1), date(2018, 4, 5)),
        ("b", date(2016, 1, 1), date(2016, 12, 31)), ("b", date(2016, 5, 1), date(2016, 6, 30)), ("c", None, date(2016, 1, 1)),
        ("c", date(2016, 5, 1), date(2016, 4, 1)), ("d", date(2016, 12, 31), date(2016, 12, 31)),
    ]
    df = spark.createDataFrame(spans, "person_id string, enrollment_start_date date, enrollment_end_date date")
    expected = {
        (p, f"{k // 12:04d}{k % 12 + 1:02d}")
        for p, s, e in spans if s and s <= e
        for k in range(s.year * 12 + s.month - 1, e.year * 12 + e.month)
    }
    months = reports.member_months(df)
    assert sorted(map(tuple, months.collect())) == sorted(expected)
    paid = spark.createDataFrame([(date(2016, 3, 1), 10.5)], "claim_start_date date, paid_amount float")
    of_years = reports.cost_of_member_years(reports.member_years(df), paid)
    assert rows(of_years) == rows(reports.cost_per_member_month(months, paid))
    # an explosion by year, none by month, and the bits are combined before their shuffle
    plan = of_years._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Generate explode") == 1 and "partial_bit_or" in plan


def test_summary_with_missing_tables(spark):
    people = spark.createDataFrame([("a",)], "person_id string")
    assert rows(reports.headline_summary(spark, patient=people)) == [
        {"patients": 1, "encounters": None, "medical_claim_lines": None, "pharmacy_claim_lines": None, "paid_amount": None}
    ]


def test_summary_lists_measures(spark):
    kind = "measure_id string, measure_name string, denominator_sum bigint, numerator_sum bigint, exclusion_sum bigint, performance_rate double"
    measures = spark.createDataFrame([("m2", "Two", 4, 1, 0, 0.25), ("m1", "One", 2, 1, 1, 0.5)], kind)
    row = reports.headline_summary(spark, measures=measures).first()
    assert [tuple(m) for m in row.quality_measures] == [("m1", "One", 2, 1, 1, 0.5), ("m2", "Two", 4, 1, 0, 0.25)]
    assert row.patients is None
    assert reports.headline_summary(spark, measures=measures.limit(0)).first().quality_measures == []


def test_places_of_amounts(spark):
    small = spark.createDataFrame([("e", "professional", 0.00004, 0.00004)] * 10, "encounter_id string, claim_type string, payment_amount double, total_submitted double")
    claims_of = spark.createDataFrame([(0.00004, date(2016, 1, 1))] * 10, "paid_amount double, claim_start_date date")
    assert reports.medical_paid(claims_of).first().paid == 0.0
    assert reports.medical_paid(claims_of, places=10).first().paid == 0.0004
    encounter = TABLES["encounter"].apply(spark.createDataFrame([], resource_schema("Encounter")))
    encounter = spark.createDataFrame([("e",)], "id string").join(encounter, "id", "left")
    run = RunInfo("test", datetime(2026, 1, 1), amount_places=10)
    assert clinical.encounters(encounter, small, run).first().paid_amount == 0.0004


def test_appointments_are_typed_and_empty(spark):
    got = clinical.appointments(spark)
    assert got.count() == 0
    assert dict(got.dtypes)["start_datetime"] == "timestamp_ntz" and len(got.columns) == 15


def test_every_flat_table_feeds_its_model(ndjson):
    record = {"id": "i1", "patient": {"reference": "Patient/p"}, "doseQuantity": {"value": 0.5}, "occurrenceDateTime": "2020"}
    got = clinical.immunizations(flat(ndjson, "immunization", [record]), RUN).first()
    assert (got.person_id, got.source_dose, got.occurrence_date, got.data_source) == ("p", "0.5", None, "test")


def test_a_claim_with_most_of_the_lines_is_split(spark, ndjson):
    """A third of all lines in one claim: both joins are split, and no row is lost."""
    n = 6000
    line_claim = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id") % 50))
    empty_items = flat(ndjson, "explanation_of_benefit_item", [{"id": "x"}])
    names = {f.name: f.dataType for f in empty_items.schema.fields}
    known = {
        "eob_id": line_claim,
        "sequence": F.col("id"),
        "claim_type": F.lit("professional"),
        "product_display": F.sha2(F.col("id").cast("string"), 512),
        "service_start": F.lit("2020-01-01"),
        "product_system": F.lit("http://www.ama-assn.org/go/cpt"),
        "product_code": F.sha2(F.col("id").cast("string"), 512),
        "paid_amount": F.lit(1.0),
    }
    columns = [(known[c] if c in known else F.lit(None)).cast(t).alias(c) for c, t in names.items()]
    items = spark.range(0, n, 1, 8).select(*columns)
    ids = ["hot", *[f"c{i}" for i in range(50)]]
    eob = flat(ndjson, "explanation_of_benefit", [{"id": i, "type": {"coding": [{"code": "professional"}]}, "insurer": {"display": "Acme"}, "provider": {"reference": "Practitioner/1"}} for i in ids])
    encounter = flat(ndjson, "encounter", [])
    practitioner = flat(ndjson, "practitioner", [{"id": "1"}])
    lists = spark.createDataFrame(
        [(i, [(1, "A" + i, "Y")]) for i in ids],
        "claim_id string, diagnoses array<struct<diagnosis_rank:bigint,icd10_code:string,on_admission_code:string>>",
    )
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        headers = claims.claim_headers(eob, items, encounter, practitioner)
        out = claims.medical_claims(headers, items, lists, RUN).select("claim_id", "claim_line_number", "diagnosis_code_1", "paid_amount")
        got = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert len(got) == n and len({r.claim_line_number for r in got}) == n
    assert sum(r.claim_id == "hot" for r in got) == n // 3
    assert all(r.diagnosis_code_1 == "A" + r.claim_id for r in got)
    assert plan.split("Initial Plan")[0].count("skew=true") >= 1


def test_claims_of_some_columns_read_fewer_fields(spark, ndjson):
    amount = [{"category": {"coding": [{"code": codes.LINE_PAID}]}, "amount": {"value": 2.5}}]
    lines = [
        {"sequence": k, "servicedDate": "2000-02-03", "adjudication": amount, "productOrService": {"coding": [{"system": codes.RXNORM, "code": "1"}]}}
        for k in (1, 2)
    ]
    claim = [
        {"id": f"c{kind}", "type": {"coding": [{"code": kind}]}, "insurer": {"display": "Acme"}, "item": lines, "created": "2000-03-04"}
        for kind in ("professional", "pharmacy")
    ]
    view, record = TABLES["explanation_of_benefit_item"], resource_schema("ExplanationOfBenefit")
    claim = [{"resourceType": view.resource, **r} for r in claim]

    def read(columns):
        few = view.only(columns)
        return few.apply(ndjson(claim, few.reads(record)))

    assert "productOrService" not in view.only(claims.medical_line_columns(reports.COST_COLUMNS)).reads(record).simpleString()
    eob, whole = flat(ndjson, "explanation_of_benefit", claim), flat(ndjson, "explanation_of_benefit_item", claim)
    people = flat(ndjson, "encounter", []), flat(ndjson, "practitioner", [])
    headers = claims.claim_headers(eob, read(claims.LINE_DATE_COLUMNS), *people)
    assert rows(headers) == rows(claims.claim_headers(eob, whole, *people))
    lists = spark.createDataFrame([], "claim_id string, diagnoses array<struct<diagnosis_rank:bigint,icd10_code:string,on_admission_code:string>>")
    packages = spark.createDataFrame([("1", "n1")], "rxnorm_code string, ndc_code string")
    for build, inputs, other in (
        (claims.medical_claims, claims.medical_line_columns, lists),
        (claims.pharmacy_claims, claims.pharmacy_line_columns, packages),
    ):
        full = build(headers, whole, other, RUN)
        assert full.count() == 2
        for name in ("charge_amount", "hcpcs_code" if other is lists else "ndc_code", "quantity" if other is packages else "claim_line_end_date"):
            few = build(headers, read(inputs([name])), other, RUN, [name])
            assert few.columns == [name]
            assert sorted(map(str, few.collect())) == sorted(map(str, full.select(name).collect())), name
    medical = claims.medical_claims(headers, read(claims.medical_line_columns(reports.COST_COLUMNS)), lists, RUN, reports.COST_COLUMNS)
    assert [r.paid_amount for r in medical.collect()] == [2.5, 2.5]
    with pytest.raises(AnalysisException):
        claims.medical_claims(headers, whole.drop("paid_amount"), lists, RUN, ["paid_amount"])


def test_cost_report_builds_no_fields_of_lines_that_it_does_not_read(spark, tmp_path):
    columns = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"
    spark.createDataFrame([(3, 5, 1, 1, 2.0, 10.0, "N", datetime(1996, 1, 2))], columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    m = Models(spark, str(tmp_path))
    table, some = "explanation_of_benefit_item", claims.medical_line_columns(reports.COST_COLUMNS)
    assert rows(m.flat(table, some)) == rows(m.flat(table).select(*some))
    # the leading scan reads what the records are built of
    plan = m.flat(table, some)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" in plan and "l_shipdate" not in plan and "l_returnflag" not in plan
