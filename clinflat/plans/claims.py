"""Claim headers, diagnoses, enrolment and the claim tables of the input layer.

Inputs are the flat tables of :mod:`clinflat.plans.tables`; every function takes and
returns DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflat.functions import codes
from clinflat.functions.temporal import to_full_date
from clinflat.functions.text import strip_dots
from clinflat.operators.joins import lookup, never_broadcast
from clinflat.operators.ranking import first_k_per_key, list_columns, rank_all, ranked_lists
from clinflat.plans.common import RunInfo, empty, text

# Care settings, claim types and payers.
URGENT_CARE_TYPE = "702927004"
MEDICAL_CLAIM_TYPES = ("professional", "institutional")
UNINSURED = "NO_INSURANCE"
DIAGNOSIS_COLUMNS = 25
DIAGNOSIS_FIELDS = {"icd10_code": "diagnosis_code", "on_admission_code": "diagnosis_poa"}
ICD10_SYSTEMS = (codes.ICD10_CM, codes.ICD10)
PROCEDURE_SYSTEMS = (codes.CPT, codes.HCPCS)
# Flat columns that a step reads of claim lines and diagnoses.
LINE_DATE_COLUMNS = ("eob_id", "service_start", "service_end", "encounter_id")
DIAGNOSIS_INPUTS = (
    "eob_id", "sequence", "condition_id", "diagnosis_system", "diagnosis_code", "on_admission_code",
)
MEDICAL_KEYS = ("eob_id", "claim_type")
MEDICAL_LINE_INPUTS = {
    "claim_line_number": ("sequence",),
    "claim_line_start_date": ("service_start",),
    "claim_line_end_date": ("service_end", "service_start"),
    "service_unit_quantity": ("quantity",),
    "hcpcs_code": ("product_system", "product_code"),
    "paid_amount": ("paid_amount",),
    "allowed_amount": ("allowed_amount",),
    "charge_amount": ("submitted_amount", "net_amount"),
    "coinsurance_amount": ("coinsurance_amount",),
    "deductible_amount": ("deductible_amount",),
    "total_cost_amount": ("allowed_amount",),
}
# the package code takes part in a join, so its inputs are always read
PHARMACY_KEYS = ("eob_id", "claim_type", "sequence", "product_system", "product_code")
PHARMACY_LINE_INPUTS = {
    "dispensing_date": ("service_start",),
    "quantity": ("quantity",),
    "paid_amount": ("paid_amount",),
    "allowed_amount": ("allowed_amount",),
    "charge_amount": ("submitted_amount", "net_amount"),
    "coinsurance_amount": ("coinsurance_amount",),
    "deductible_amount": ("deductible_amount",),
}


def _line_columns(keys: Sequence[str], inputs: dict[str, Sequence[str]], columns: Sequence[str] | None) -> list[str]:
    needed = [n for name, names in inputs.items() if columns is None or name in columns for n in names]
    return list(dict.fromkeys([*keys, *needed]))


def medical_line_columns(columns: Sequence[str] | None = None) -> list[str]:
    """Flat columns of claim lines that :func:`medical_claims` reads for some of its columns, or all."""
    return _line_columns(MEDICAL_KEYS, MEDICAL_LINE_INPUTS, columns)


def pharmacy_line_columns(columns: Sequence[str] | None = None) -> list[str]:
    """The same for :func:`pharmacy_claims`."""
    return _line_columns(PHARMACY_KEYS, PHARMACY_LINE_INPUTS, columns)


def _with_all(eob_item: DataFrame, needed: Sequence[str], known: Sequence[str]) -> DataFrame:
    """The needed columns of claim lines; those that only columns left out are made of are null."""
    return eob_item.select(*needed, *[F.lit(None).alias(n) for n in known if n not in needed])


def date_of(name: str) -> Column:
    return to_full_date(F.col(name))


def _case(branches: list[tuple[Column, str]], default: str) -> Column:
    chain = F.when(branches[0][0], branches[0][1])
    for condition, value in branches[1:]:
        chain = chain.when(condition, value)
    return chain.otherwise(default)


def encounter_settings(encounter: DataFrame) -> DataFrame:
    """Encounters with the care setting that their class and type imply."""
    kind = F.col("class_code")
    name = F.lower("type_display")
    urgent = F.col("type_code") == URGENT_CARE_TYPE
    encounter_type = _case(
        [
            ((kind == "IMP") & name.contains("rehabilitation"), "inpatient substance use"),
            (kind == "IMP", "acute inpatient"),
            (kind == "EMER", "emergency department"),
            ((kind == "HH") & name.contains("hospice"), "outpatient hospice"),
            (kind == "HH", "home health"),
            (kind == "VR", "telehealth"),
            (urgent, "urgent care"),
            (kind.isin("AMB", "WELLNESS", "OUTPATIENT"), "office visit"),
        ],
        "office visit - other",
    )
    place = _case(
        [(kind == "IMP", "21"), (kind == "EMER", "23"), (kind == "HH", "12"), (kind == "VR", "02"), (urgent, "20")],
        "11",
    )
    bill = _case([(kind == "IMP", "111"), (kind == "EMER", "131"), (kind == "HH", "321")], "131")
    revenue = _case([(kind == "IMP", "0120"), (kind == "EMER", "0450"), (kind == "HH", "0550")], "0510")
    return encounter.select(
        "*",
        encounter_type.alias("encounter_type"),
        place.alias("place_of_service_code"),
        bill.alias("bill_type_code"),
        revenue.alias("revenue_center_code"),
    )


def claim_headers(
    eob: DataFrame, eob_item: DataFrame, encounter: DataFrame, practitioner: DataFrame
) -> DataFrame:
    """One row per insured claim: service dates from its lines, setting from its encounter."""
    dated = eob_item.select(
        F.col("eob_id").alias("__eob_id"),
        date_of("service_start").alias("__start"),
        date_of("service_end").alias("__end"),
        "encounter_id",
    )
    line_dates = dated.groupBy("__eob_id").agg(
        F.min("__start").alias("__first"),
        F.max(F.coalesce("__end", "__start")).alias("__last"),
        F.max("encounter_id").alias("__line_encounter"),
    )
    insured = eob.filter(F.col("payer_name") != UNINSURED)
    joined = insured.join(never_broadcast(line_dates), F.col("id") == F.col("__eob_id"), "left")
    claims = joined.select(
        F.col("id").alias("claim_id"),
        F.col("patient_id").alias("person_id"),
        "claim_type",
        F.col("payer_name").alias("payer"),
        _case(
            [
                (F.col("payer_name").isin("Medicare", "Dual Eligible"), "medicare"),
                (F.col("payer_name") == "Medicaid", "medicaid"),
            ],
            "commercial",
        ).alias("payer_type"),
        F.coalesce("coverage_type", "payer_name").alias("plan"),
        F.coalesce("__first", date_of("created")).alias("claim_start_date"),
        F.coalesce("__last", date_of("created")).alias("claim_end_date"),
        date_of("created").alias("paid_date"),
        F.coalesce("encounter_id", "__line_encounter").alias("encounter_id"),
        "provider_id",
        "facility_id",
        "total_submitted",
        "payment_amount",
    )
    settings = encounter_settings(encounter).select(
        F.col("id").alias("__enc_id"),
        "encounter_type",
        "class_code",
        "place_of_service_code",
        "bill_type_code",
        "revenue_center_code",
        date_of("period_start").alias("encounter_start_date"),
        date_of("period_end").alias("encounter_end_date"),
        "discharge_disposition_code",
    )
    npi = practitioner.select(F.col("id").alias("__prac_id"), F.col("npi").alias("rendering_npi"))
    claims = lookup(claims, settings, F.col("encounter_id"), "__enc_id", F.col("claim_id"))
    claims = lookup(claims, npi, F.col("provider_id"), "__prac_id", F.col("claim_id"))
    return claims.select(
        "claim_id", "person_id", "claim_type", "payer", "payer_type", "plan",
        "claim_start_date", "claim_end_date", "paid_date", "encounter_id", "encounter_type",
        "class_code", "place_of_service_code", "bill_type_code", "revenue_center_code",
        "encounter_start_date", "encounter_end_date", "discharge_disposition_code",
        "provider_id", "rendering_npi", "facility_id", "total_submitted", "payment_amount",
    )


def coded_diagnoses(eob_diagnosis: DataFrame, condition: DataFrame, code_map: DataFrame) -> DataFrame:
    """Claim diagnoses that have an ICD-10 code: their own, the one of the condition they
    point at, or the mapped SNOMED code of that condition."""

    def icd10(system: str, code: str) -> Column:
        return F.when(F.col(system).isin(*ICD10_SYSTEMS), strip_dots(F.col(code)))

    own = eob_diagnosis.select(
        F.col("eob_id").alias("claim_id"),
        "sequence",
        "on_admission_code",
        "condition_id",
        icd10("diagnosis_system", "diagnosis_code").alias("__own"),
    )
    problems = condition.select(
        F.col("id").alias("__cond_id"),
        icd10("code_system", "code_code").alias("__cond_icd10"),
        F.when(F.col("code_system") == codes.SNOMED, F.col("code_code")).alias("__snomed"),
    )
    targets = code_map.select(F.col("snomed_code").alias("__map_key"), F.col("icd10_code").alias("__mapped"))
    row = F.concat_ws(".", "claim_id", "sequence")
    dx = lookup(own, problems, F.col("condition_id"), "__cond_id", row)
    dx = lookup(dx, targets, F.col("__snomed"), "__map_key", row)
    dx = dx.select(
        "claim_id",
        "sequence",
        F.coalesce("__own", "__cond_icd10", "__mapped").alias("icd10_code"),
        "on_admission_code",
    )
    return dx.filter(F.col("icd10_code").isNotNull())


def claim_diagnoses(eob_diagnosis: DataFrame, condition: DataFrame, code_map: DataFrame) -> DataFrame:
    """Every coded diagnosis of every claim with its rank by sequence; equal sequences
    are ordered by code and admission flag."""
    dx = coded_diagnoses(eob_diagnosis, condition, code_map)
    ranked = rank_all(dx, ["claim_id"], "sequence", ["icd10_code", "on_admission_code"], "diagnosis_rank")
    return ranked.select("claim_id", "icd10_code", "on_admission_code", "diagnosis_rank")


def claim_diagnosis_lists(
    eob_diagnosis: DataFrame, condition: DataFrame, code_map: DataFrame, n: int = DIAGNOSIS_COLUMNS, salts: int = 1
) -> DataFrame:
    """One row per claim with its first ``n`` diagnoses as an array in rank order. Ranks are
    those of :func:`claim_diagnoses`; only the first ``n`` are computed. ``salts`` is for claims
    with diagnoses in very many tasks (see :func:`first_k_per_key`)."""
    order = [F.col("sequence"), F.col("icd10_code"), F.col("on_admission_code")]
    dx = coded_diagnoses(eob_diagnosis, condition, code_map)
    ranked = first_k_per_key(dx, ["claim_id"], order, n, "diagnosis_rank", salts)
    return ranked_lists(ranked, "claim_id", "diagnosis_rank", list(DIAGNOSIS_FIELDS), n, "diagnoses")


def claim_diagnosis_columns(lists: DataFrame, n: int = DIAGNOSIS_COLUMNS) -> DataFrame:
    """The lists of :func:`claim_diagnosis_lists` as diagnosis and admission flag columns."""
    return lists.select("claim_id", *list_columns("diagnoses", DIAGNOSIS_FIELDS, n))


def enrolment_spans(headers: DataFrame, patient: DataFrame) -> DataFrame:
    """A member counts as enrolled with a payer and plan for each calendar year in which
    one of their claims starts, clipped to birth and death."""
    years = (
        headers.filter(F.col("claim_start_date").isNotNull())
        .select("person_id", "payer", "payer_type", "plan", F.year("claim_start_date").alias("__year"))
        .distinct()
    )
    lives = patient.select(
        F.col("id").alias("__pat_id"),
        F.coalesce(date_of("birth_date"), F.lit("1900-01-01").cast("date")).alias("__born"),
        F.coalesce(date_of("deceased_datetime"), F.lit("2999-12-31").cast("date")).alias("__died"),
    )
    spans = years.join(lives, F.col("person_id") == F.col("__pat_id")).select(
        "person_id",
        "payer",
        "payer_type",
        "plan",
        F.greatest(F.make_date("__year", F.lit(1), F.lit(1)), "__born").alias("enrollment_start_date"),
        F.least(F.make_date("__year", F.lit(12), F.lit(31)), "__died").alias("enrollment_end_date"),
    )
    return spans.filter(F.col("enrollment_start_date") <= F.col("enrollment_end_date"))


def eligibility(spans: DataFrame, patient_table: DataFrame, run: RunInfo) -> DataFrame:
    """Enrolment spans with member demographics (the input-layer patient table)."""
    people = patient_table.select(
        F.col("person_id").alias("__pid"),
        "first_name", "middle_name", "last_name", "name_suffix", "social_security_number",
        "address", "city", "state", "zip_code", "phone", "email", "ethnicity", "sex", "race",
        "birth_date", "death_date", "death_flag",
    )
    joined = spans.join(people, F.col("person_id") == F.col("__pid"))
    return joined.select(
        text("person_id", "person_id"),
        text("person_id", "member_id"),
        text("person_id", "subscriber_id"),
        F.lit("self").alias("subscriber_relation"),
        "enrollment_start_date",
        "enrollment_end_date",
        text("payer", "payer"),
        text("payer_type", "payer_type"),
        text("plan", "plan"),
        *[c for c in people.columns if c != "__pid"],
        empty("original_reason_entitlement_code"),
        empty("dual_status_code"),
        empty("medicare_status_code"),
        empty("enrollment_status"),
        empty("hospice_flag", "int"),
        empty("institutional_snp_flag", "int"),
        F.when(F.col("payer") == "Medicaid", 1).otherwise(0).alias("medicaid_indicator"),
        empty("long_term_institutional_flag", "int"),
        empty("part_d_raf_type"),
        empty("low_income_subsidy_indicator", "int"),
        empty("metal_level"),
        empty("csr_indicator", "int"),
        empty("enrollment_duration_months", "int"),
        empty("esrd_status", "int"),
        empty("transplant_duration_months", "int"),
        empty("group_id"),
        empty("group_name"),
        F.lit("fhir:ExplanationOfBenefit").alias("file_name"),
        empty("file_date", "date"),
        *run.columns(),
    )


def _money(c: Column, name: str) -> Column:
    return c.cast("float").alias(name)


def medical_claims(
    headers: DataFrame,
    eob_item: DataFrame,
    diagnosis_lists: DataFrame,
    run: RunInfo,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Professional and institutional claim lines with the diagnoses of their claim.

    Lines meet their header first and the diagnoses last. Both sides of the first join come
    straight from a shuffle, so adaptive execution can split a claim with very many lines;
    the result is then shuffled again for the second join, which it can split as well.
    Without such a claim both joins share one partitioning. Diagnoses travel as one array
    and become columns at the very end, which keeps the joined rows narrow.

    With ``columns`` the rows have these columns only, and ``eob_item`` needs those of
    :func:`medical_line_columns`, so that the others need not be unnested.
    """
    needed = medical_line_columns(columns)
    lines = _with_all(eob_item, needed, medical_line_columns()).filter(F.col("claim_type").isin(*MEDICAL_CLAIM_TYPES)).select(
        F.col("eob_id").alias("__line_claim"),
        F.col("sequence").alias("__line"),
        date_of("service_start").alias("claim_line_start_date"),
        F.coalesce(date_of("service_end"), date_of("service_start")).alias("claim_line_end_date"),
        F.when(F.col("product_system").isin(*PROCEDURE_SYSTEMS), F.col("product_code")).alias("hcpcs_code"),
        "quantity",
        "paid_amount",
        "allowed_amount",
        F.coalesce("submitted_amount", "net_amount").alias("charge_amount"),
        "coinsurance_amount",
        "deductible_amount",
    )
    dx = diagnosis_lists.withColumnRenamed("claim_id", "__dx_claim")
    claims = headers.filter(F.col("claim_type").isin(*MEDICAL_CLAIM_TYPES))
    c = never_broadcast(lines).join(claims, F.col("claim_id") == F.col("__line_claim"))
    c = c.join(never_broadcast(dx), F.col("__line_claim") == F.col("__dx_claim"), "left")
    institutional = F.col("claim_type") == "institutional"
    stay = institutional & (F.col("class_code") == "IMP")
    zero = F.lit(0.0)
    slots = range(1, DIAGNOSIS_COLUMNS + 1)
    table = c.select(
        text("claim_id", "claim_id"),
        F.col("__line").cast("int").alias("claim_line_number"),
        "claim_type",
        text("person_id", "person_id"),
        text("person_id", "member_id"),
        text("payer", "payer"),
        text("plan", "plan"),
        "claim_start_date",
        "claim_end_date",
        "claim_line_start_date",
        "claim_line_end_date",
        F.when(stay, F.col("encounter_start_date")).alias("admission_date"),
        F.when(stay, F.col("encounter_end_date")).alias("discharge_date"),
        empty("admit_source_code"),
        empty("admit_type_code"),
        F.when(stay, F.coalesce("discharge_disposition_code", F.lit("01"))).alias("discharge_disposition_code"),
        F.when(F.col("claim_type") == "professional", F.col("place_of_service_code")).alias("place_of_service_code"),
        F.when(institutional, F.col("bill_type_code")).alias("bill_type_code"),
        empty("drg_code_type"),
        empty("drg_code"),
        F.when(institutional, F.col("revenue_center_code")).alias("revenue_center_code"),
        F.col("quantity").cast("double").alias("service_unit_quantity"),
        "hcpcs_code",
        *[empty(f"hcpcs_modifier_{k}") for k in range(1, 6)],
        text("rendering_npi", "rendering_npi"),
        empty("rendering_tin"),
        text("rendering_npi", "billing_npi"),
        empty("billing_tin"),
        empty("facility_npi"),
        "paid_date",
        _money(F.coalesce("paid_amount", zero), "paid_amount"),
        _money(F.coalesce("allowed_amount", zero), "allowed_amount"),
        _money(F.coalesce("charge_amount", zero), "charge_amount"),
        _money(F.col("coinsurance_amount"), "coinsurance_amount"),
        empty("copayment_amount", "float"),
        _money(F.col("deductible_amount"), "deductible_amount"),
        _money(F.coalesce("allowed_amount", zero), "total_cost_amount"),
        F.when(F.col("__dx_claim").isNotNull(), F.lit("icd-10-cm")).alias("diagnosis_code_type"),
        *list_columns("diagnoses", DIAGNOSIS_FIELDS, DIAGNOSIS_COLUMNS),
        empty("procedure_code_type"),
        *[empty(f"procedure_code_{k}") for k in slots],
        *[empty(f"procedure_date_{k}", "date") for k in slots],
        F.lit(1).alias("in_network_flag"),
        F.lit("fhir:ExplanationOfBenefit").alias("file_name"),
        empty("file_date", "date"),
        *run.columns(),
    )
    return table if columns is None else table.select(*columns)


def pharmacy_claims(
    headers: DataFrame,
    eob_item: DataFrame,
    package_map: DataFrame,
    run: RunInfo,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Pharmacy claim lines with a package code; records carry no days of supply. ``columns`` is as
    in :func:`medical_claims`, with :func:`pharmacy_line_columns`."""
    claims = headers.filter(F.col("claim_type") == "pharmacy").select(
        "claim_id", "person_id", "payer", "plan", "rendering_npi", "paid_date",
        "payment_amount", "total_submitted",
    )
    needed = pharmacy_line_columns(columns)
    lines = _with_all(eob_item, needed, pharmacy_line_columns()).filter(F.col("claim_type") == "pharmacy").select(
        F.col("eob_id").alias("__line_claim"), "sequence", "service_start", "product_system",
        "product_code", "quantity", "paid_amount", "allowed_amount", "submitted_amount",
        "net_amount", "coinsurance_amount", "deductible_amount",
    )
    joined = claims.join(never_broadcast(lines), F.col("claim_id") == F.col("__line_claim"))
    packages = package_map.select(F.col("rxnorm_code").alias("__drug"), "ndc_code")
    drug = F.when(F.col("product_system") == codes.RXNORM, F.col("product_code"))
    row = F.concat_ws(".", "claim_id", "sequence")
    joined = lookup(joined, packages, drug, "__drug", row)
    days = F.lit(run.default_days_supply)
    zero = F.lit(0.0)
    table = joined.select(
        text("claim_id", "claim_id"),
        F.col("sequence").cast("int").alias("claim_line_number"),
        text("person_id", "person_id"),
        text("person_id", "member_id"),
        text("payer", "payer"),
        text("plan", "plan"),
        text("rendering_npi", "prescribing_provider_npi"),
        empty("dispensing_provider_npi"),
        date_of("service_start").alias("dispensing_date"),
        "ndc_code",
        F.bround(F.coalesce("quantity", days)).cast("int").alias("quantity"),
        days.cast("int").alias("days_supply"),
        F.lit(0).alias("refills"),
        "paid_date",
        _money(F.coalesce("paid_amount", "payment_amount", zero), "paid_amount"),
        _money(F.coalesce("allowed_amount", "total_submitted", zero), "allowed_amount"),
        _money(F.coalesce("submitted_amount", "net_amount", "total_submitted", zero), "charge_amount"),
        _money(F.col("coinsurance_amount"), "coinsurance_amount"),
        empty("copayment_amount", "float"),
        _money(F.col("deductible_amount"), "deductible_amount"),
        F.lit(1).alias("in_network_flag"),
        F.lit("fhir:ExplanationOfBenefit").alias("file_name"),
        empty("file_date", "date"),
        *run.columns(),
    )
    return table if columns is None else table.select(*columns)
