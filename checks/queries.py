"""The registered queries, each with the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import model_sql
from checks.model_sql import STAMP, money_sum, sql_with
from checks.records import FLAT_SQL, measures, records, terminology
from clinflat.plans import claims, clinical, code_maps, reports
from clinflat.plans.common import RunInfo
from clinflat.plans.job import InputLayer
from clinflat.plans.tables import TABLES
from clinflat.session import shared_folder
from clinflat.sources.schemas import resource_schema

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def flat(spark: SparkSession, folder: str, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A flat table, or some of its columns from records of no more fields than these need."""
    if columns is None:
        return TABLES[table].apply(records(spark, folder, table))
    view = TABLES[table].only(columns)
    return view.apply(records(spark, folder, table, view.reads(resource_schema(view.resource))))


def register(name: str, query: Query, sql: str | None) -> None:
    QUERIES[name] = query
    if sql is not None:
        SQL[name] = sql


def _flatten(table: str) -> Query:
    return lambda spark, folder: flat(spark, folder, table)


for _table in TABLES:
    register(f"flatten_{_table}", _flatten(_table), FLAT_SQL[_table])


# -- models ------------------------------------------------------------------------------

RUN = RunInfo(data_source="checks", ingest_datetime=datetime.fromisoformat(STAMP))


class Models:
    """Models over the records of one folder, or over flat tables written before."""

    def __init__(self, spark: SparkSession, folder: str, flat_folder: str | None = None):
        self.spark = spark
        self.folder = folder
        self.flat_folder = flat_folder
        self._flat: dict[tuple, DataFrame] = {}

    def flat(self, table: str, columns: Sequence[str] | None = None) -> DataFrame:
        if self.flat_folder is not None:
            written = self.spark.read.parquet(f"{self.flat_folder}/{table}")
            return written if columns is None else written.select(*columns)
        key = (table, None if columns is None else tuple(columns))
        if key not in self._flat:
            self._flat[key] = flat(self.spark, self.folder, table, columns)
        return self._flat[key]

    def settings(self) -> DataFrame:
        return claims.encounter_settings(self.flat("encounter"))

    def headers(self) -> DataFrame:
        return claims.claim_headers(
            self.flat("explanation_of_benefit"),
            self.flat("explanation_of_benefit_item", claims.LINE_DATE_COLUMNS),
            self.flat("encounter"),
            self.flat("practitioner"),
        )

    def code_map(self) -> DataFrame:
        return code_maps.diagnosis_code_map(terminology(self.spark, self.folder, "diagnosis_map"))

    def package_map(self) -> DataFrame:
        return code_maps.drug_package_map(terminology(self.spark, self.folder, "drug_packages"))

    def _dx(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        dx = self.flat("explanation_of_benefit_diagnosis", claims.DIAGNOSIS_INPUTS)
        return dx, self.flat("condition"), self.code_map()

    def diagnoses(self) -> DataFrame:
        return claims.claim_diagnoses(*self._dx())

    def diagnosis_lists(self) -> DataFrame:
        return claims.claim_diagnosis_lists(*self._dx())

    def diagnosis_columns(self) -> DataFrame:
        return claims.claim_diagnosis_columns(self.diagnosis_lists())

    def spans(self) -> DataFrame:
        return claims.enrolment_spans(self.headers(), self.flat("patient"))

    def patients(self) -> DataFrame:
        return clinical.patients(self.flat("patient"), RUN)

    def encounters(self) -> DataFrame:
        return clinical.encounters(self.flat("encounter"), self.headers(), RUN)

    def conditions(self) -> DataFrame:
        return clinical.conditions(self.flat("condition"), RUN)

    def procedures(self) -> DataFrame:
        return clinical.procedures(self.flat("procedure"), RUN)

    def observations(self) -> DataFrame:
        return clinical.observations(self.flat("observation"), self.flat("observation_component"), RUN)

    def labs(self) -> DataFrame:
        return clinical.lab_results(self.flat("observation"), self.flat("diagnostic_report_result"), RUN)

    def medications(self) -> DataFrame:
        return clinical.medications(
            self.flat("medication_request"), self.flat("medication"), self.package_map(), RUN
        )

    def immunizations(self) -> DataFrame:
        return clinical.immunizations(self.flat("immunization"), RUN)

    def locations(self) -> DataFrame:
        return clinical.locations(self.flat("location"), self.flat("organization"), RUN)

    def practitioners(self) -> DataFrame:
        return clinical.practitioners(self.flat("practitioner"), self.flat("practitioner_role"), RUN)

    def eligibility(self) -> DataFrame:
        return claims.eligibility(self.spans(), self.patients(), RUN)

    def medical(self, columns: Sequence[str] | None = None) -> DataFrame:
        lines = self.flat("explanation_of_benefit_item", claims.medical_line_columns(columns))
        return claims.medical_claims(self.headers(), lines, self.diagnosis_lists(), RUN, columns)

    def pharmacy(self, columns: Sequence[str] | None = None) -> DataFrame:
        lines = self.flat("explanation_of_benefit_item", claims.pharmacy_line_columns(columns))
        return claims.pharmacy_claims(self.headers(), lines, self.package_map(), RUN, columns)

    def months(self) -> DataFrame:
        return reports.member_months(self.spans())

    def pmpm(self) -> DataFrame:
        medical = self.medical(reports.COST_COLUMNS)
        return reports.cost_of_member_years(reports.member_years(self.spans()), medical, "1995", "2001")

    def patient_set(self) -> DataFrame:
        return reports.patients_dataset(self.patients(), date(2001, 12, 31))

    def claim_set(self) -> DataFrame:
        return reports.medical_claims_dataset(self.medical())

    def encounter_set(self) -> DataFrame:
        return reports.encounters_dataset(self.encounters())

    def condition_set(self) -> DataFrame:
        return reports.conditions_dataset(self.conditions())

    def measures(self) -> DataFrame:
        return measures(self.spark, self.folder)

    def measure_set(self) -> DataFrame:
        return reports.quality_measures_dataset(self.measures())

    def summary(self) -> DataFrame:
        return reports.headline_summary(
            self.spark, self.patients(), self.encounters(), self.medical(["paid_amount"]), self.pharmacy(["claim_id"])
        )


def model(name: str, build: Callable[[Models], DataFrame], uses: str, body: str) -> None:
    register(name, lambda spark, folder: build(Models(spark, folder)), sql_with(uses, body))


model("encounter_setting", Models.settings, "setting", "select * from setting")
model("claim_header", Models.headers, "claim", "select * from claim")
model("code_map_top1", Models.code_map, "code_map", "select * from code_map")
model("drug_code_top1", Models.package_map, "package_map", "select * from package_map")
model("claim_diagnosis", Models.diagnoses, "ranked", "select * from ranked")
model("claim_diagnosis_pivot", Models.diagnosis_columns, "dx_columns", "select * from dx_columns")
model("enrolment_spans", Models.spans, "spans", "select * from spans")
model("patient", Models.patients, "patient_table", "select * from patient_table")
model("encounter", Models.encounters, "encounter_table", "select * from encounter_table")
model("condition", Models.conditions, "condition_table", "select * from condition_table")
model("procedure", Models.procedures, "", model_sql.PROCEDURE_TABLE)
model("observation", Models.observations, "", model_sql.OBSERVATION_TABLE)
model("lab_result", Models.labs, "", model_sql.LAB_TABLE)
model(
    "medication", Models.medications, "package_map", model_sql.MEDICATION_TABLE
)
model("immunization", Models.immunizations, "immunization", model_sql.IMMUNIZATION_TABLE)
model("location", Models.locations, "", model_sql.LOCATION_TABLE)
model("practitioner", Models.practitioners, "practitioner practitioner_role", model_sql.PRACTITIONER_TABLE)
model("eligibility", Models.eligibility, "spans", model_sql.ELIGIBILITY)
model("medical_claim", Models.medical, "medical", "select * from medical")
model("pharmacy_claim", Models.pharmacy, "pharmacy", "select * from pharmacy")

# -- reports -----------------------------------------------------------------------------

PAID = money_sum("paid_amount")
PEOPLE = "count(distinct person_id)"
model("report_patients", Models.patient_set, "patient_set", "select * from patient_set")
model("report_medical_claims", Models.claim_set, "claim_set", "select * from claim_set")
model("report_encounters", Models.encounter_set, "encounter_set", "select * from encounter_set")
model("report_conditions", Models.condition_set, "condition_set", "select * from condition_set")
model(
    "report_quality_measures",
    Models.measure_set,
    "measures",
    "select measure_id, measure_name, performance_period_end, denominator_sum as denominator, "
    "numerator_sum as numerator, exclusion_sum as exclusions, performance_rate from measures",
)
model("member_months", Models.months, "months", "select * from months")
model("pmpm_by_year", Models.pmpm, "pmpm", "select * from pmpm")
model(
    "pmpm_of_months",
    lambda m: reports.cost_per_member_month(m.months(), m.medical(reports.COST_COLUMNS), "1995", "2001"),
    "pmpm",
    "select * from pmpm",
)
model(
    "patient_count",
    lambda m: reports.patient_count(m.patient_set()),
    "patient_set",
    f"select {PEOPLE} as patients from patient_set",
)
model(
    "medical_paid",
    lambda m: reports.medical_paid(m.claim_set()),
    "claim_set",
    f"select {PAID} as paid from claim_set",
)
model(
    "encounter_count",
    lambda m: reports.encounter_count(m.encounter_set()),
    "encounter_set",
    "select count(*) as encounters from encounter_set",
)
model(
    "average_pmpm",
    lambda m: reports.average_cost_per_member_month(m.pmpm()),
    "pmpm",
    f"select {money_sum('paid')} / cast(sum(member_months) as double) as pmpm from pmpm",
)
model(
    "pmpm_chart",
    lambda m: reports.cost_per_member_month_by_year(m.pmpm()),
    "pmpm",
    f"select year, {money_sum('paid')} / cast(sum(member_months) as double) as pmpm from pmpm group by 1 order by 1 limit 20",
)
model(
    "paid_by_service_category",
    lambda m: reports.paid_by_service_category(m.claim_set()),
    "claim_set",
    f"select service_category_2, {PAID} as paid from claim_set group by 1 order by 2 desc, 1 limit 15",
)
model(
    "patients_by_age_group",
    lambda m: reports.patients_by_age_group(m.patient_set()),
    "patient_set",
    f"select age_group, {PEOPLE} as patients from patient_set group by 1 order by age_group nulls last limit 15",
)
model(
    "patients_by_sex",
    lambda m: reports.patients_by_sex(m.patient_set()),
    "patient_set",
    f"select sex, {PEOPLE} as patients from patient_set group by 1 order by 2 desc, 1 limit 20",
)
model(
    "patients_by_race",
    lambda m: reports.patients_by_race(m.patient_set()),
    "patient_set",
    f"select race, {PEOPLE} as patients from patient_set group by 1 order by 2 desc, 1 limit 20",
)
model(
    "encounters_by_type",
    lambda m: reports.encounters_by_type(m.encounter_set()),
    "encounter_set",
    "select encounter_type, count(*) as encounters from encounter_set group by 1 order by 2 desc, 1 limit 15",
)
model(
    "common_conditions",
    lambda m: reports.common_conditions(m.condition_set()),
    "condition_set",
    f"select condition_name, {PEOPLE} as patients from condition_set group by 1 order by 2 desc, 1 limit 15",
)
model(
    "quality_measure_table",
    lambda m: reports.quality_measure_table(m.measure_set()),
    "measures",
    "select measure_id, measure_name, denominator_sum as denominator, numerator_sum as numerator, "
    "exclusion_sum as exclusions, performance_rate from measures order by measure_id limit 100",
)
model(
    "quality_measure_list",
    lambda m: reports.measure_list(m.measures()),
    "measures",
    "select measure_id, measure_name as name, denominator_sum as denominator, numerator_sum as numerator, "
    "exclusion_sum as exclusions, performance_rate as rate from measures order by measure_id",
)
model(
    "headline_summary",
    Models.summary,
    "patient_table encounter_table medical pharmacy",
    f"""select (select count(*) from patient_table) as patients, (select count(*) from encounter_table) as encounters,
    (select count(*) from medical) as medical_claim_lines, (select count(*) from pharmacy) as pharmacy_claim_lines,
    (select round({PAID}, 2) from medical) as paid_amount""",
)

model(
    "headline_summary_with_measures",
    lambda m: reports.headline_summary(m.spark, m.patients(), measures=m.measures()).select(
        "patients",
        F.expr("array_join(transform(quality_measures, q -> concat(q.measure_id, ' ', q.numerator, '/', q.denominator)), ';')").alias("list"),
    ),
    "patient_table measures",
    """select (select count(*) from patient_table) as patients,
    (select string_agg(measure_id || ' ' || numerator_sum || '/' || denominator_sum, ';' order by measure_id) from measures) as list""",
)

# -- the map step as one job ---------------------------------------------------------------


def input_layer(spark: SparkSession, folder: str, **options) -> InputLayer:
    """The job over the records of a folder, with a database and a folder of its own."""
    run, models = uuid.uuid4().hex, Models(spark, folder)
    spark.sql(f"create database job_{run} location '{shared_folder(spark)}/job-{run}'")
    maps = (terminology(spark, folder, "diagnosis_map"), terminology(spark, folder, "drug_packages"))
    return InputLayer(spark, models.flat, *maps, f"job_{run}", RUN, columns=models.flat, **options)


def _job_report(spark: SparkSession, folder: str) -> DataFrame:
    report = input_layer(spark, folder).build()
    return report.where("name not like 'stage%'").select("name", "rows")


def _job_table(name: str, **options) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        job = input_layer(spark, folder, **options)
        job.stage()
        return job.models()[name]()

    return query


JOB_BODIES = {
    "patient": "select * from patient_table",
    "encounter": "select * from encounter_table",
    "condition": "select * from condition_table",
    "procedure": model_sql.PROCEDURE_TABLE,
    "observation": model_sql.OBSERVATION_TABLE,
    "lab_result": model_sql.LAB_TABLE,
    "medication": model_sql.MEDICATION_TABLE,
    "immunization": model_sql.IMMUNIZATION_TABLE,
    "location": model_sql.LOCATION_TABLE,
    "practitioner": model_sql.PRACTITIONER_TABLE,
    "eligibility": model_sql.ELIGIBILITY,
    "medical_claim": "select * from medical",
    "pharmacy_claim": "select * from pharmacy",
}
JOB_USES = (
    "patient_table encounter_table condition_table package_map immunization practitioner practitioner_role "
    "spans medical pharmacy"
)
_counts = [f"select '{n}' as name, (select count(*) from ({b})) as rows" for n, b in JOB_BODIES.items()]
register(
    "map_job",
    _job_report,
    sql_with(JOB_USES, " union all ".join([*_counts, "select 'appointment', 0"])),
)
register("map_job_medical_claim", _job_table("medical_claim"), sql_with("medical", "select * from medical"))
register(
    "map_job_pharmacy_claim",
    _job_table("pharmacy_claim", long_claim=4),
    sql_with("pharmacy", "select * from pharmacy"),
)
