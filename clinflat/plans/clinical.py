"""Clinical tables of the input layer, from the flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflat.functions import codes
from clinflat.functions.codes import code_system, translate
from clinflat.functions.temporal import to_full_date, to_local_timestamp
from clinflat.functions.text import clean_name, exact_sum, number_text
from clinflat.operators.joins import left_or_join, lookup, never_broadcast
from clinflat.operators.ranking import nulls_last
from clinflat.plans.claims import MEDICAL_CLAIM_TYPES, encounter_settings
from clinflat.plans.common import RunInfo, empty, person_columns, text

# Published race and ethnicity codes and the labels of the contract.
RACES = {
    "2106-3": "white",
    "2054-5": "black or african american",
    "2028-9": "asian",
    "1002-5": "american indian or alaska native",
    "2076-8": "native hawaiian or other pacific islander",
    "2131-1": "other race",
}
ETHNICITIES = {"2135-2": "Hispanic or Latino", "2186-5": "Not Hispanic or Latino"}
OBSERVATION_TYPES = (
    "vital-signs", "social-history", "imaging", "survey", "exam", "therapy", "activity", "procedure",
)
LABORATORY = "laboratory"


def date_of(name: str) -> Column:
    return to_full_date(F.col(name))


def patients(patient: DataFrame, run: RunInfo) -> DataFrame:
    def labelled(name: str, names: dict[str, str]) -> Column:
        return F.coalesce(translate(F.col(name), names), F.lit("unknown"))

    sex = F.when(F.col("gender").isin("male", "female"), F.col("gender")).otherwise("unknown")
    return patient.select(
        *person_columns("id"),
        clean_name(F.col("given_name")).alias("first_name"),
        clean_name(F.col("middle_name")).alias("middle_name"),
        clean_name(F.col("family_name")).alias("last_name"),
        "name_suffix",
        sex.alias("sex"),
        labelled("race_code", RACES).alias("race"),
        labelled("ethnicity_code", ETHNICITIES).alias("ethnicity"),
        date_of("birth_date").alias("birth_date"),
        date_of("deceased_datetime").alias("death_date"),
        F.when(F.col("deceased_flag"), 1).otherwise(0).alias("death_flag"),
        text("ssn", "social_security_number"),
        text("address_line", "address"),
        "city",
        "state",
        text("postal_code", "zip_code"),
        empty("county"),
        F.col("latitude").cast("float").alias("latitude"),
        F.col("longitude").cast("float").alias("longitude"),
        "phone",
        "email",
        *run.columns(),
    )


def encounters(encounter: DataFrame, headers: DataFrame, run: RunInfo) -> DataFrame:
    """Encounters with the paid and charged amounts of their medical claims."""
    costs = (
        headers.filter(F.col("claim_type").isin(*MEDICAL_CLAIM_TYPES) & F.col("encounter_id").isNotNull())
        .groupBy(F.col("encounter_id").alias("__cost_encounter"))
        .agg(
            exact_sum(F.col("payment_amount"), run.amount_places).alias("__paid"),
            exact_sum(F.col("total_submitted"), run.amount_places).alias("__charged"),
        )
    )
    enc = encounter_settings(encounter)
    return enc.join(never_broadcast(costs), F.col("id") == F.col("__cost_encounter"), "left").select(
        text("id", "encounter_id"),
        *person_columns(),
        "encounter_type",
        date_of("period_start").alias("encounter_start_date"),
        date_of("period_end").alias("encounter_end_date"),
        "admit_source_code",
        empty("admit_type_code"),
        "discharge_disposition_code",
        text("practitioner_id", "attending_provider_id"),
        clean_name(F.col("practitioner_name")).alias("attending_provider_name"),
        empty("facility_npi"),
        F.coalesce("location_name", "service_provider_name").alias("facility_name"),
        code_system(F.col("reason_system")).alias("primary_diagnosis_code_type"),
        text("reason_code", "primary_diagnosis_code"),
        empty("drg_code_type"),
        empty("drg_code"),
        F.col("__paid").alias("paid_amount"),
        F.col("__paid").alias("allowed_amount"),
        F.col("__charged").alias("charge_amount"),
        *run.columns(),
    )


def conditions(condition: DataFrame, run: RunInfo) -> DataFrame:
    status = F.col("verification_status")
    kind = F.when(F.col("category") == "problem-list-item", "problem").otherwise("discharge diagnosis")
    return condition.filter(status.isNull() | (status != "entered-in-error")).select(
        text("id", "source_condition_id"),
        *person_columns(),
        text("encounter_id", "encounter_id"),
        F.coalesce(date_of("recorded_date"), date_of("onset_datetime")).alias("recorded_date"),
        date_of("onset_datetime").alias("onset_date"),
        date_of("abatement_datetime").alias("resolved_date"),
        text("clinical_status", "status"),
        kind.alias("condition_type"),
        code_system(F.col("code_system")).alias("code_system"),
        text("code_code", "source_code"),
        text("code_display", "source_description"),
        empty("condition_rank", "int"),
        empty("present_on_admit_code"),
        *run.columns(),
    )


def procedures(procedure: DataFrame, run: RunInfo) -> DataFrame:
    status = F.col("status")
    return procedure.filter(status.isNull() | ~status.isin("entered-in-error", "not-done")).select(
        text("id", "source_procedure_id"),
        *person_columns(),
        text("encounter_id", "encounter_id"),
        date_of("performed_start").alias("procedure_date"),
        code_system(F.col("code_system")).alias("code_system"),
        text("code_code", "source_code"),
        text("code_display", "source_description"),
        *[empty(f"modifier_{k}") for k in range(1, 6)],
        text("practitioner_id", "practitioner_id"),
        *run.columns(),
    )


def observations(observation: DataFrame, component: DataFrame, run: RunInfo) -> DataFrame:
    """Non-laboratory observations; a panel gives one row per component, with an id made
    from the panel's id and the component's position."""
    outside_lab = F.col("category") != LABORATORY
    shared = (
        "patient_id", "encounter_id", "effective_datetime", "category", "code_system",
        "code_code", "code_display", "value_unit",
    )
    single = observation.filter(outside_lab & ~F.coalesce("has_components", F.lit(False))).select(
        text("id", "observation_id"),
        empty("panel_id"),
        *shared,
        F.coalesce(
            number_text(F.col("value_quantity")),
            "value_code_display",
            "value_string",
            F.col("value_boolean").cast("string"),
        ).alias("result"),
        "reference_range_low",
        "reference_range_high",
    )
    parts = component.filter(outside_lab).select(
        F.concat_ws("-", "observation_id", F.col("component_index").cast("string")).alias("observation_id"),
        text("observation_id", "panel_id"),
        *shared,
        F.coalesce(number_text(F.col("value_quantity")), "value_code").alias("result"),
        empty("reference_range_low", "double"),
        empty("reference_range_high", "double"),
    )
    kind = F.when(F.col("category").isin(*OBSERVATION_TYPES), F.col("category")).otherwise("other")
    return single.unionByName(parts).select(
        "observation_id",
        *person_columns(),
        text("encounter_id", "encounter_id"),
        "panel_id",
        date_of("effective_datetime").alias("observation_date"),
        kind.alias("observation_type"),
        code_system(F.col("code_system")).alias("source_code_type"),
        text("code_code", "source_code"),
        text("code_display", "source_description"),
        "result",
        text("value_unit", "source_units"),
        empty("normalized_units"),
        number_text(F.col("reference_range_low")).alias("source_reference_range_low"),
        number_text(F.col("reference_range_high")).alias("source_reference_range_high"),
        empty("normalized_reference_range_low"),
        empty("normalized_reference_range_high"),
        *run.columns(),
    )


def panel_of_observation(report_result: DataFrame) -> DataFrame:
    """One ordering panel per observation: the smallest report, taken as a whole row."""
    panel = ("diagnostic_report_id", "code_system", "code_code", "code_display")
    best = F.min(F.struct(*[nulls_last(F.col(c)).alias(c) for c in panel])).alias("__best")
    return (
        report_result.filter(F.col("observation_id").isNotNull())
        .groupBy(F.col("observation_id").alias("__observation"))
        .agg(best)
        .select("__observation", *[F.col(f"__best.{c}.{c}").alias(f"order_{c}") for c in panel])
    )


def lab_results(observation: DataFrame, report_result: DataFrame, run: RunInfo) -> DataFrame:
    """Laboratory observations with the panel that ordered them, when there is one."""
    labs = observation.filter(F.col("category") == LABORATORY)
    panels = never_broadcast(panel_of_observation(report_result))
    joined = labs.join(panels, F.col("id") == F.col("__observation"), "left")
    taken = to_local_timestamp(F.col("effective_datetime"))
    result = F.coalesce(number_text(F.col("value_quantity")), "value_code_display", "value_string")
    return joined.select(
        text("id", "lab_result_id"),
        *person_columns(),
        text("encounter_id", "encounter_id"),
        text("order_diagnostic_report_id", "accession_number"),
        code_system(F.col("order_code_system")).alias("source_order_type"),
        text("order_code_code", "source_order_code"),
        text("order_code_display", "source_order_description"),
        code_system(F.col("code_system")).alias("source_component_type"),
        text("code_code", "source_component_code"),
        text("code_display", "source_component_description"),
        text("status", "status"),
        result.alias("result"),
        taken.alias("result_datetime"),
        taken.alias("collection_datetime"),
        text("value_unit", "source_units"),
        empty("normalized_units"),
        number_text(F.col("reference_range_low")).alias("source_reference_range_low"),
        number_text(F.col("reference_range_high")).alias("source_reference_range_high"),
        empty("normalized_reference_range_low"),
        empty("normalized_reference_range_high"),
        text("interpretation_code", "source_abnormal_code"),
        empty("normalized_abnormal_code"),
        empty("specimen"),
        empty("ordering_practitioner_id"),
        *run.columns(),
    )


def medications(request: DataFrame, medication: DataFrame, package_map: DataFrame, run: RunInfo) -> DataFrame:
    """Prescriptions; a referenced medication gives its code, a drug code its package."""
    drugs = medication.select(
        F.col("id").alias("__med_id"),
        F.col("code_system").alias("__system"),
        F.col("code_code").alias("__code"),
        F.col("code_display").alias("__display"),
    )
    mr = lookup(request, drugs, F.col("medication_id"), "__med_id", F.col("id"))
    mr = mr.select(
        "*",
        F.coalesce("medication_system", "__system").alias("med_system"),
        F.coalesce("medication_code", "__code").alias("med_code"),
        F.coalesce("medication_display", "__display").alias("med_display"),
    )
    drug = F.when(F.col("med_system") == codes.RXNORM, F.col("med_code"))
    packages = package_map.select(F.col("rxnorm_code").alias("__drug"), "ndc_code")
    mr = lookup(mr, packages, drug, "__drug", F.col("id"))
    return mr.select(
        text("id", "medication_id"),
        *person_columns(),
        text("encounter_id", "encounter_id"),
        empty("dispensing_date", "date"),
        date_of("authored_on").alias("prescribing_date"),
        code_system(F.col("med_system")).alias("source_code_type"),
        text("med_code", "source_code"),
        text("med_display", "source_description"),
        "ndc_code",
        drug.alias("rxnorm_code"),
        empty("atc_code"),
        empty("route"),
        empty("strength"),
        F.col("dispense_quantity").cast("double").alias("quantity"),
        empty("quantity_unit"),
        F.col("days_supply").cast("double").alias("days_supply"),
        text("requester_id", "practitioner_id"),
        *run.columns(),
    )


def immunizations(immunization: DataFrame, run: RunInfo) -> DataFrame:
    return immunization.select(
        text("id", "immunization_id"),
        *person_columns(),
        text("encounter_id", "encounter_id"),
        code_system(F.col("vaccine_system")).alias("source_code_type"),
        text("vaccine_code", "source_code"),
        text("vaccine_display", "source_description"),
        text("status", "status"),
        text("status_reason_code", "status_reason"),
        date_of("occurrence_datetime").alias("occurrence_date"),
        number_text(F.col("dose_quantity")).alias("source_dose"),
        text("lot_number", "lot_number"),
        text("site_code", "body_site"),
        text("route_code", "route"),
        text("location_id", "location_id"),
        text("practitioner_id", "practitioner_id"),
        *run.columns(),
    )


def locations(location: DataFrame, organization: DataFrame, run: RunInfo) -> DataFrame:
    """Locations with their organization, found by id or by source identifier."""
    org = organization.select(
        F.col("id").alias("__oid"), "source_identifier", "npi", F.col("name").alias("org_name")
    )
    joined = left_or_join(
        location.drop("source_identifier"),
        org,
        [("managing_organization_id", "__oid"), ("managing_organization_identifier", "source_identifier")],
        ["npi", "org_name"],
    )
    return joined.select(
        text("id", "location_id"),
        text("npi", "npi"),
        text("name", "name"),
        empty("facility_type"),
        text("org_name", "parent_organization"),
        text("address_line", "address"),
        text("city", "city"),
        text("state", "state"),
        text("postal_code", "zip_code"),
        F.col("latitude").cast("float").alias("latitude"),
        F.col("longitude").cast("float").alias("longitude"),
        *run.columns(),
    )


def practitioners(practitioner: DataFrame, role: DataFrame, run: RunInfo) -> DataFrame:
    """Practitioners with the specialty and affiliation of one of their roles, both taken
    from the same role when it has them."""
    best = F.min(
        F.struct(
            nulls_last(F.col("specialty_display")).alias("specialty"),
            nulls_last(F.col("organization_name")).alias("affiliation"),
        )
    ).alias("__best")
    roles = (
        role.filter(F.col("practitioner_npi").isNotNull())
        .groupBy(F.col("practitioner_npi").alias("__npi"))
        .agg(best, F.min("organization_name").alias("__any_affiliation"))
        .select(
            "__npi",
            F.col("__best.specialty.specialty_display").alias("specialty"),
            F.coalesce("__best.affiliation.organization_name", "__any_affiliation").alias("affiliation"),
        )
    )
    return lookup(practitioner, roles, F.col("npi"), "__npi", F.col("id")).select(
        text("id", "practitioner_id"),
        text("npi", "npi"),
        clean_name(F.col("given_name")).alias("first_name"),
        clean_name(F.col("family_name")).alias("last_name"),
        text("affiliation", "practice_affiliation"),
        F.lower("specialty").alias("specialty"),
        empty("sub_specialty"),
        *run.columns(),
    )


APPOINTMENT_SCHEMA = (
    "appointment_id string, person_id string, patient_id string, encounter_id string, "
    "start_datetime timestamp_ntz, end_datetime timestamp_ntz, duration int, "
    "location_id string, practitioner_id string, type string, status string, reason string, "
    "cancellation_reason string, ingest_datetime timestamp_ntz, data_source string"
)


def appointments(spark) -> DataFrame:
    """The contract's appointment table: typed and empty, records have no source for it."""
    return spark.createDataFrame([], APPOINTMENT_SCHEMA)
