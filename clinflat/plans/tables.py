"""The nineteen bundled flat tables, as views over the declared schemas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinflat.functions import codes
from clinflat.functions.collections import Path, first_present, size_of
from clinflat.operators.flatten import Col, FlatView, Node, Select

Paths = Path | Node


def first_code(path: Paths) -> Path:
    return path["coding"].first()["code"]


def first_system(path: Paths) -> Path:
    return path["coding"].first()["system"]


def label(concept: Path) -> Path:
    """Display of the first coding, else the free text."""
    return concept["coding"].first()["display"].or_first(concept["text"])


def by_system(path: Paths, system: str) -> Path:
    """First value of the entries (identifiers, contact points) of a system."""
    return path.where(lambda x: x["system"] == system)["value"].first()


def official(n: Node) -> Path:
    return n["name"].where(lambda x: x["use"] == "official")


def coded(*names: str):
    """Functions for the code of the first coding below a dotted path."""
    return lambda n: first_code(n.go(".".join(names)))


def ref(name: str, target: str):
    return lambda n: n[name].ref_key(target)


def _id() -> Col:
    return Col("id", "id", "id")


def _ref(column: str, name: str, target: str) -> Col:
    return Col(column, ref(name, target), "id")


def _concept(prefix: str, get) -> tuple[Col, Col, Col]:
    return (
        Col(f"{prefix}_system", lambda n: first_system(get(n)), "uri"),
        Col(f"{prefix}_code", lambda n: first_code(get(n)), "code"),
        Col(f"{prefix}_display", lambda n: label(get(n))),
    )


def _view(name: str, resource: str, *columns: Col, each: Select | None = None) -> FlatView:
    selects = [Select(columns=columns)] + ([each] if each else [])
    return FlatView(name, resource, selects)


def _us_extension(n: Node, url: str, part: str) -> Path:
    return n.extension(url).extension(part)


def _deceased(n: Node):
    is_dead = n.of_type("deceased", "dateTime").exists() | F.coalesce(
        n.of_type("deceased", "boolean").col, F.lit(False)
    )
    return is_dead


def _coordinate(n: Node, which: str) -> Path:
    geo = n["address"].first().extension(codes.GEOLOCATION).extension(which)
    return geo.of_type("value", "decimal").first()


def _address(n: Paths, name: str) -> Path:
    return n["address"].first()[name]


PATIENT = _view(
    "patient",
    "Patient",
    _id(),
    Col("source_identifier", lambda n: by_system(n["identifier"], codes.SOURCE_SYSTEM)),
    Col(
        "mrn",
        lambda n: n["identifier"].where(lambda x: x["type"]["coding"]["code"] == "MR")["value"].first(),
    ),
    Col("ssn", lambda n: by_system(n["identifier"], codes.SSN)),
    Col("family_name", lambda n: official(n)["family"].or_first(n["name"]["family"])),
    Col("given_name", lambda n: official(n)["given"].or_first(n["name"]["given"])),
    Col("middle_name", lambda n: official(n).first()["given"].at(1)),
    Col("name_prefix", lambda n: official(n).first()["prefix"].first()),
    Col("name_suffix", lambda n: official(n).first()["suffix"].first()),
    Col("gender", "gender", "code"),
    Col("birth_sex", lambda n: n.extension(codes.BIRTH_SEX).of_type("value", "code").first(), "code"),
    Col("birth_date", "birthDate", "date"),
    Col("deceased_datetime", lambda n: n.of_type("deceased", "dateTime"), "dateTime"),
    Col("deceased_flag", _deceased, "boolean"),
    Col(
        "race_code",
        lambda n: _us_extension(n, codes.RACE, "ombCategory").of_type("value", "Coding")["code"].first(),
        "code",
    ),
    Col(
        "race_display",
        lambda n: _us_extension(n, codes.RACE, "text").of_type("value", "string").first(),
    ),
    Col(
        "ethnicity_code",
        lambda n: (
            _us_extension(n, codes.ETHNICITY, "ombCategory").of_type("value", "Coding")["code"].first()
        ),
        "code",
    ),
    Col(
        "ethnicity_display",
        lambda n: _us_extension(n, codes.ETHNICITY, "text").of_type("value", "string").first(),
    ),
    Col("address_line", lambda n: _address(n, "line").join(", ")),
    Col("city", lambda n: _address(n, "city")),
    Col("state", lambda n: _address(n, "state")),
    Col("postal_code", lambda n: _address(n, "postalCode")),
    Col("country", lambda n: _address(n, "country")),
    Col("latitude", lambda n: _coordinate(n, "latitude"), "decimal"),
    Col("longitude", lambda n: _coordinate(n, "longitude"), "decimal"),
    Col("phone", lambda n: by_system(n["telecom"], "phone")),
    Col("email", lambda n: by_system(n["telecom"], "email")),
    Col("marital_status_code", coded("maritalStatus"), "code"),
    Col("language_code", lambda n: first_code(n["communication"]["language"]), "code"),
)

ENCOUNTER = _view(
    "encounter",
    "Encounter",
    _id(),
    _ref("patient_id", "subject", "Patient"),
    Col("status", "status", "code"),
    Col("class_code", "class.code", "code"),
    *_concept("type", lambda n: n["type"].first()),
    Col("period_start", "period.start", "dateTime"),
    Col("period_end", "period.end", "dateTime"),
    *_concept("reason", lambda n: n["reasonCode"].first()),
    Col("reason_condition_id", lambda n: n["reasonReference"].first().ref_key("Condition"), "id"),
    Col(
        "practitioner_id",
        lambda n: n["participant"]["individual"].first().ref_key("Practitioner"),
        "id",
    ),
    Col("practitioner_name", lambda n: n["participant"]["individual"].first()["display"]),
    Col("location_id", lambda n: n["location"].first()["location"].ref_key("Location"), "id"),
    Col("location_name", lambda n: n["location"].first()["location"]["display"]),
    _ref("service_provider_id", "serviceProvider", "Organization"),
    Col("service_provider_name", "serviceProvider.display"),
    Col("admit_source_code", coded("hospitalization", "admitSource"), "code"),
    Col("discharge_disposition_code", coded("hospitalization", "dischargeDisposition"), "code"),
)

CONDITION = _view(
    "condition",
    "Condition",
    _id(),
    _ref("patient_id", "subject", "Patient"),
    _ref("encounter_id", "encounter", "Encounter"),
    Col("clinical_status", coded("clinicalStatus"), "code"),
    Col("verification_status", coded("verificationStatus"), "code"),
    Col("category", lambda n: first_code(n["category"].first()), "code"),
    *_concept("code", lambda n: n["code"]),
    Col("onset_datetime", lambda n: n.of_type("onset", "dateTime"), "dateTime"),
    Col("abatement_datetime", lambda n: n.of_type("abatement", "dateTime"), "dateTime"),
    Col("recorded_date", "recordedDate", "dateTime"),
)

PROCEDURE = _view(
    "procedure",
    "Procedure",
    _id(),
    _ref("patient_id", "subject", "Patient"),
    _ref("encounter_id", "encounter", "Encounter"),
    Col("status", "status", "code"),
    *_concept("code", lambda n: n["code"]),
    Col(
        "performed_start",
        lambda n: n.of_type("performed", "Period")["start"].or_first(n.of_type("performed", "dateTime")),
        "dateTime",
    ),
    Col("performed_end", lambda n: n.of_type("performed", "Period")["end"], "dateTime"),
    Col("practitioner_id", lambda n: n["performer"]["actor"].first().ref_key("Practitioner"), "id"),
    _ref("location_id", "location", "Location"),
    *_concept("reason", lambda n: n["reasonCode"].first()),
)


def _effective(n: Node) -> Path:
    return n.of_type("effective", "dateTime").or_first(n.of_type("effective", "Period")["start"])


def _quantity_unit(n: Paths) -> Path:
    quantity = n.of_type("value", "Quantity")
    return quantity["code"].or_first(quantity["unit"])


OBSERVATION = _view(
    "observation",
    "Observation",
    _id(),
    _ref("patient_id", "subject", "Patient"),
    _ref("encounter_id", "encounter", "Encounter"),
    Col("status", "status", "code"),
    Col("category", lambda n: first_code(n["category"].first()), "code"),
    *_concept("code", lambda n: n["code"]),
    Col("effective_datetime", _effective, "dateTime"),
    Col("issued", "issued", "instant"),
    Col("value_quantity", lambda n: n.of_type("value", "Quantity")["value"], "decimal"),
    Col("value_unit", _quantity_unit),
    Col("value_string", lambda n: n.of_type("value", "string")),
    Col("value_boolean", lambda n: n.of_type("value", "boolean"), "boolean"),
    Col("value_code_system", lambda n: first_system(n.of_type("value", "CodeableConcept")), "uri"),
    Col("value_code", lambda n: first_code(n.of_type("value", "CodeableConcept")), "code"),
    Col("value_code_display", lambda n: label(n.of_type("value", "CodeableConcept"))),
    Col("interpretation_code", lambda n: first_code(n["interpretation"].first()), "code"),
    Col("reference_range_low", lambda n: n["referenceRange"].first()["low"]["value"], "decimal"),
    Col("reference_range_high", lambda n: n["referenceRange"].first()["high"]["value"], "decimal"),
    Col("has_components", lambda n: n["component"].exists(), "boolean"),
)

OBSERVATION_COMPONENT = _view(
    "observation_component",
    "Observation",
    Col("observation_id", "id", "id"),
    _ref("patient_id", "subject", "Patient"),
    _ref("encounter_id", "encounter", "Encounter"),
    Col("category", lambda n: first_code(n["category"].first()), "code"),
    Col("panel_code", coded("code"), "code"),
    Col("effective_datetime", _effective, "dateTime"),
    each=Select(
        for_each="component",
        columns=[
            Col("component_index", lambda n: n.row_index, "integer"),
            *_concept("code", lambda n: n["code"]),
            Col("value_quantity", lambda n: n.of_type("value", "Quantity")["value"], "decimal"),
            Col("value_unit", _quantity_unit),
            Col("value_code", lambda n: first_code(n.of_type("value", "CodeableConcept")), "code"),
        ],
    ),
)

DIAGNOSTIC_REPORT_RESULT = _view(
    "diagnostic_report_result",
    "DiagnosticReport",
    Col("diagnostic_report_id", "id", "id"),
    _ref("patient_id", "subject", "Patient"),
    _ref("encounter_id", "encounter", "Encounter"),
    Col("status", "status", "code"),
    Col("category", lambda n: first_code(n["category"].first()), "code"),
    *_concept("code", lambda n: n["code"]),
    Col("effective_datetime", lambda n: n.of_type("effective", "dateTime"), "dateTime"),
    Col("issued", "issued", "instant"),
    each=Select(
        for_each="result",
        columns=[Col("observation_id", lambda n: n.ref_key("Observation"), "id")],
    ),
)

MEDICATION_REQUEST = _view(
    "medication_request",
    "MedicationRequest",
    _id(),
    _ref("patient_id", "subject", "Patient"),
    _ref("encounter_id", "encounter", "Encounter"),
    Col("status", "status", "code"),
    Col("intent", "intent", "code"),
    Col("authored_on", "authoredOn", "dateTime"),
    *_concept("medication", lambda n: n.of_type("medication", "CodeableConcept")),
    Col(
        "medication_id",
        lambda n: n.of_type("medication", "Reference").ref_key("Medication"),
        "id",
    ),
    _ref("requester_id", "requester", "Practitioner"),
    Col("reason_condition_id", lambda n: n["reasonReference"].first().ref_key("Condition"), "id"),
    Col("dosage_text", lambda n: n["dosageInstruction"].first()["text"]),
    Col(
        "as_needed",
        lambda n: n["dosageInstruction"].first().of_type("asNeeded", "boolean"),
        "boolean",
    ),
    Col("dispense_quantity", "dispenseRequest.quantity.value", "decimal"),
    Col("dispense_repeats", "dispenseRequest.numberOfRepeatsAllowed", "integer"),
    Col("days_supply", "dispenseRequest.expectedSupplyDuration.value", "decimal"),
)

MEDICATION = _view(
    "medication",
    "Medication",
    _id(),
    Col("status", "status", "code"),
    *_concept("code", lambda n: n["code"]),
    Col("form_code", coded("form"), "code"),
)

IMMUNIZATION = _view(
    "immunization",
    "Immunization",
    _id(),
    _ref("patient_id", "patient", "Patient"),
    _ref("encounter_id", "encounter", "Encounter"),
    Col("status", "status", "code"),
    Col("status_reason_code", coded("statusReason"), "code"),
    *_concept("vaccine", lambda n: n["vaccineCode"]),
    Col("occurrence_datetime", lambda n: n.of_type("occurrence", "dateTime"), "dateTime"),
    _ref("location_id", "location", "Location"),
    Col("lot_number", "lotNumber"),
    Col("site_code", coded("site"), "code"),
    Col("route_code", coded("route"), "code"),
    Col("dose_quantity", "doseQuantity.value", "decimal"),
    Col("practitioner_id", lambda n: n["performer"]["actor"].first().ref_key("Practitioner"), "id"),
)

ALLERGY_INTOLERANCE = _view(
    "allergy_intolerance",
    "AllergyIntolerance",
    _id(),
    _ref("patient_id", "patient", "Patient"),
    Col("clinical_status", coded("clinicalStatus"), "code"),
    Col("type", "type", "code"),
    Col("category", lambda n: n["category"].first(), "code"),
    Col("criticality", "criticality", "code"),
    *_concept("code", lambda n: n["code"]),
    Col("recorded_date", "recordedDate", "dateTime"),
)

PRACTITIONER = _view(
    "practitioner",
    "Practitioner",
    _id(),
    Col("npi", lambda n: by_system(n["identifier"], codes.NPI)),
    Col("family_name", lambda n: n["name"].first()["family"]),
    Col("given_name", lambda n: n["name"].first()["given"].first()),
    Col("name_prefix", lambda n: n["name"].first()["prefix"].first()),
    Col("gender", "gender", "code"),
    Col("city", lambda n: _address(n, "city")),
    Col("state", lambda n: _address(n, "state")),
    Col("postal_code", lambda n: _address(n, "postalCode")),
)

PRACTITIONER_ROLE = _view(
    "practitioner_role",
    "PractitionerRole",
    _id(),
    _ref("practitioner_id", "practitioner", "Practitioner"),
    Col("practitioner_npi", lambda n: by_system(n["practitioner"]["identifier"], codes.NPI)),
    _ref("organization_id", "organization", "Organization"),
    Col("organization_identifier", "organization.identifier.value"),
    Col("organization_name", "organization.display"),
    *_concept("specialty", lambda n: n["specialty"].first()),
)

ORGANIZATION = _view(
    "organization",
    "Organization",
    _id(),
    Col("source_identifier", lambda n: by_system(n["identifier"], codes.SOURCE_SYSTEM)),
    Col("npi", lambda n: by_system(n["identifier"], codes.NPI)),
    Col("name", "name"),
    Col("type_code", lambda n: first_code(n["type"].first()), "code"),
    Col("address_line", lambda n: _address(n, "line").join(", ")),
    Col("city", lambda n: _address(n, "city")),
    Col("state", lambda n: _address(n, "state")),
    Col("postal_code", lambda n: _address(n, "postalCode")),
    Col("phone", lambda n: by_system(n["telecom"], "phone")),
)

LOCATION = _view(
    "location",
    "Location",
    _id(),
    Col("source_identifier", lambda n: by_system(n["identifier"], codes.SOURCE_SYSTEM)),
    Col("name", "name"),
    Col("status", "status", "code"),
    Col("type_code", lambda n: first_code(n["type"].first()), "code"),
    _ref("managing_organization_id", "managingOrganization", "Organization"),
    Col("managing_organization_identifier", "managingOrganization.identifier.value"),
    Col("address_line", lambda n: n["address"]["line"].join(", ")),
    Col("city", "address.city"),
    Col("state", "address.state"),
    Col("postal_code", "address.postalCode"),
    Col("latitude", "position.latitude", "decimal"),
    Col("longitude", "position.longitude", "decimal"),
)

COVERAGE = _view(
    "coverage",
    "Coverage",
    _id(),
    _ref("patient_id", "beneficiary", "Patient"),
    Col("status", "status", "code"),
    Col("subscriber_id", "subscriberId"),
    Col("relationship_code", coded("relationship"), "code"),
    Col("period_start", "period.start", "dateTime"),
    Col("period_end", "period.end", "dateTime"),
    Col("payer_id", lambda n: n["payor"].first().ref_key("Organization"), "id"),
    Col("payer_name", lambda n: n["payor"].first()["display"]),
    Col("type_code", coded("type"), "code"),
    Col(
        "plan_name",
        lambda n: (
            n["class"]
            .where(lambda x: x["type"]["coding"]["code"] == "plan")["name"]
            .or_first(n["type"]["text"])
        ),
    ),
)


def _amount(path: Paths, category: str) -> Path:
    """First amount of the entries whose only category code is the given one."""
    return path.where(lambda x: x["category"]["coding"]["code"] == category)["amount"]["value"].first()


def _adjudication_codes(n: Node) -> Column:
    """Per adjudication entry, its category code when that is the only one."""

    def only_code(entry: Column) -> Column:
        coding = entry["category"]["coding"]
        found = coding["code"]
        # the usual case without an array of codes
        return F.when(F.array_size(coding) == 1, F.get(coding, F.lit(0))["code"]).otherwise(
            F.when(size_of(found) == 1, first_present(found))
        )

    return F.transform(n["adjudication"].col, only_code)


def _adjudication_amounts(n: Node) -> Column:
    return n["adjudication"]["amount"]["value"].col


def adjudicated(category: str):
    """Amount of a category of adjudication. Five columns look in the same entries, so
    their codes and amounts are listed once per line and each column only finds its position. An entry
    without an amount sends the search on to the next one."""

    def amount(n: Node) -> Path:
        position = F.array_position(n.shared("codes"), category)
        listed = F.get(n.shared("amounts"), (position - 1).cast("int"))
        value = F.coalesce(listed, _amount(n["adjudication"], category).col)
        return Path(F.when(position > 0, value), T.DoubleType())

    return amount


EXPLANATION_OF_BENEFIT = _view(
    "explanation_of_benefit",
    "ExplanationOfBenefit",
    _id(),
    Col("claim_identifier", lambda n: by_system(n["identifier"], codes.CLAIM_ID_SYSTEM)),
    _ref("claim_id", "claim", "Claim"),
    _ref("patient_id", "patient", "Patient"),
    Col("claim_type", coded("type"), "code"),
    Col("status", "status", "code"),
    Col("outcome", "outcome", "code"),
    Col("billable_start", "billablePeriod.start", "dateTime"),
    Col("billable_end", "billablePeriod.end", "dateTime"),
    Col("created", "created", "dateTime"),
    Col(
        "payer_name",
        lambda n: n["insurer"]["display"].or_first(n["insurance"].first()["coverage"]["display"]),
    ),
    Col(
        "coverage_type",
        lambda n: n.of_type("contained", "Coverage")["type"]["text"].first(),
    ),
    _ref("provider_id", "provider", "Practitioner"),
    _ref("facility_id", "facility", "Location"),
    Col("facility_name", "facility.display"),
    Col("encounter_id", lambda n: n["item"]["encounter"].first().ref_key("Encounter"), "id"),
    Col("total_submitted", lambda n: _amount(n["total"], "submitted"), "decimal"),
    Col("payment_amount", "payment.amount.value", "decimal"),
)

EXPLANATION_OF_BENEFIT_ITEM = _view(
    "explanation_of_benefit_item",
    "ExplanationOfBenefit",
    Col("eob_id", "id", "id"),
    _ref("patient_id", "patient", "Patient"),
    Col("claim_type", coded("type"), "code"),
    each=Select(
        for_each="item",
        shared={"codes": _adjudication_codes, "amounts": _adjudication_amounts},
        columns=[
            Col("sequence", "sequence", "positiveInt"),
            *_concept("product", lambda n: n["productOrService"]),
            Col(
                "service_start",
                lambda n: (
                    n.of_type("serviced", "Period")["start"].or_first(n.of_type("serviced", "date"))
                ),
                "dateTime",
            ),
            Col("service_end", lambda n: n.of_type("serviced", "Period")["end"], "dateTime"),
            Col(
                "place_of_service_code",
                lambda n: first_code(n.of_type("location", "CodeableConcept")),
                "code",
            ),
            Col("category_code", coded("category"), "code"),
            Col("quantity", "quantity.value", "decimal"),
            Col("net_amount", "net.value", "decimal"),
            Col("submitted_amount", adjudicated(codes.LINE_SUBMITTED), "decimal"),
            Col("allowed_amount", adjudicated(codes.LINE_ALLOWED), "decimal"),
            Col("paid_amount", adjudicated(codes.LINE_PAID), "decimal"),
            Col(
                "coinsurance_amount",
                adjudicated(codes.LINE_COINSURANCE),
                "decimal",
            ),
            Col(
                "deductible_amount",
                adjudicated(codes.LINE_DEDUCTIBLE),
                "decimal",
            ),
            Col("diagnosis_sequence", lambda n: n["diagnosisSequence"].first(), "positiveInt"),
            Col("encounter_id", lambda n: n["encounter"].first().ref_key("Encounter"), "id"),
        ],
    ),
)

EXPLANATION_OF_BENEFIT_DIAGNOSIS = _view(
    "explanation_of_benefit_diagnosis",
    "ExplanationOfBenefit",
    Col("eob_id", "id", "id"),
    _ref("patient_id", "patient", "Patient"),
    each=Select(
        for_each="diagnosis",
        columns=[
            Col("sequence", "sequence", "positiveInt"),
            Col("condition_id", lambda n: n.of_type("diagnosis", "Reference").ref_key("Condition"), "id"),
            Col(
                "diagnosis_system",
                lambda n: first_system(n.of_type("diagnosis", "CodeableConcept")),
                "uri",
            ),
            Col(
                "diagnosis_code",
                lambda n: first_code(n.of_type("diagnosis", "CodeableConcept")),
                "code",
            ),
            Col("type_code", lambda n: first_code(n["type"].first()), "code"),
            Col("on_admission_code", coded("onAdmission"), "code"),
        ],
    ),
)

TABLES: dict[str, FlatView] = {
    v.name: v
    for v in (
        PATIENT, ENCOUNTER, CONDITION, PROCEDURE, OBSERVATION, OBSERVATION_COMPONENT,
        DIAGNOSTIC_REPORT_RESULT, MEDICATION_REQUEST, MEDICATION, IMMUNIZATION,
        ALLERGY_INTOLERANCE, PRACTITIONER, PRACTITIONER_ROLE, ORGANIZATION, LOCATION,
        COVERAGE, EXPLANATION_OF_BENEFIT, EXPLANATION_OF_BENEFIT_ITEM,
        EXPLANATION_OF_BENEFIT_DIAGNOSIS,
    )
}
