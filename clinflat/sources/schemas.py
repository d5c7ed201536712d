"""Declared read schemas: only the fields the bundled tables use.

JSON text carries no types, and a value read against the wrong shape becomes null or, in
fail-fast mode, an error. So every field's cardinality is declared here. The declaration
is also the column pruning of the scan: nothing else is parsed into rows.

Leaves whose written form counts are declared as text with a comment that names their kind:
dates and times, which may be partial and compare by their precision, and measured quantities,
whose written digits tell their precision. Paths read the comment.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import types as T

DATE, DATE_TIME, INSTANT = (f"string COMMENT '{kind}'" for kind in ("date", "dateTime", "instant"))
DECIMAL = "string COMMENT 'decimal'"
CODING = "struct<system:string,code:string,display:string>"
CONCEPT = f"struct<coding:array<{CODING}>,text:string>"
REFERENCE = "struct<reference:string,display:string>"
IDENTIFIER = f"struct<system:string,value:string,type:{CONCEPT}>"
SHORT_IDENTIFIER = "struct<system:string,value:string>"
IDENTIFIED_REFERENCE = f"struct<reference:string,display:string,identifier:{SHORT_IDENTIFIER}>"
PERIOD = f"struct<start:{DATE_TIME},end:{DATE_TIME}>"
QUANTITY = f"struct<value:{DECIMAL},unit:string,code:string>"
AMOUNT = "struct<value:double,currency:string>"
TELECOM = "struct<system:string,value:string>"
INNER_EXTENSION = (
    "struct<url:string,valueString:string,valueCode:string,valueDecimal:double,"
    f"valueCoding:{CODING}>"
)
EXTENSION = (
    "struct<url:string,valueString:string,valueCode:string,valueDecimal:double,"
    f"valueCoding:{CODING},extension:array<{INNER_EXTENSION}>>"
)
HUMAN_NAME = (
    "struct<use:string,family:string,given:array<string>,prefix:array<string>,suffix:array<string>>"
)
ADDRESS = (
    "struct<line:array<string>,city:string,state:string,postalCode:string,country:string,"
    f"extension:array<{EXTENSION}>>"
)
PLAIN_ADDRESS = "struct<line:array<string>,city:string,state:string,postalCode:string>"
RANGE = "struct<low:struct<value:double>,high:struct<value:double>>"
HEAD = f"resourceType string, id string, meta struct<lastUpdated:{INSTANT}>"

_FIELDS = {
    "Patient": f"""identifier array<{IDENTIFIER}>, name array<{HUMAN_NAME}>, gender string,
        birthDate {DATE}, deceasedDateTime {DATE_TIME}, deceasedBoolean boolean,
        extension array<{EXTENSION}>, address array<{ADDRESS}>, telecom array<{TELECOM}>,
        maritalStatus {CONCEPT}, communication array<struct<language:{CONCEPT}>>""",
    "Encounter": f"""status string, class {CODING}, type array<{CONCEPT}>, subject {REFERENCE},
        participant array<struct<individual:{REFERENCE}>>, period {PERIOD},
        reasonCode array<{CONCEPT}>, reasonReference array<{REFERENCE}>,
        location array<struct<location:{REFERENCE}>>, serviceProvider {REFERENCE},
        hospitalization struct<admitSource:{CONCEPT},dischargeDisposition:{CONCEPT}>""",
    "Condition": f"""clinicalStatus {CONCEPT}, verificationStatus {CONCEPT},
        category array<{CONCEPT}>, code {CONCEPT}, subject {REFERENCE}, encounter {REFERENCE},
        onsetDateTime {DATE_TIME}, abatementDateTime {DATE_TIME}, recordedDate {DATE_TIME}""",
    "Procedure": f"""status string, code {CONCEPT}, subject {REFERENCE}, encounter {REFERENCE},
        performedDateTime {DATE_TIME}, performedPeriod {PERIOD},
        performer array<struct<actor:{REFERENCE}>>, location {REFERENCE},
        reasonCode array<{CONCEPT}>""",
    "Observation": f"""status string, category array<{CONCEPT}>, code {CONCEPT},
        subject {REFERENCE}, encounter {REFERENCE}, effectiveDateTime {DATE_TIME},
        effectivePeriod {PERIOD}, issued {INSTANT}, valueQuantity {QUANTITY}, valueString string,
        valueBoolean boolean, valueCodeableConcept {CONCEPT}, interpretation array<{CONCEPT}>,
        referenceRange array<{RANGE}>,
        component array<struct<code:{CONCEPT},valueQuantity:{QUANTITY},
            valueCodeableConcept:{CONCEPT}>>""",
    "DiagnosticReport": f"""status string, category array<{CONCEPT}>, code {CONCEPT},
        subject {REFERENCE}, encounter {REFERENCE}, effectiveDateTime {DATE_TIME}, issued {INSTANT},
        result array<{REFERENCE}>""",
    "MedicationRequest": f"""status string, intent string, subject {REFERENCE},
        encounter {REFERENCE}, authoredOn {DATE_TIME}, medicationCodeableConcept {CONCEPT},
        medicationReference {REFERENCE}, requester {REFERENCE},
        reasonReference array<{REFERENCE}>,
        dosageInstruction array<struct<text:string,asNeededBoolean:boolean>>,
        dispenseRequest struct<quantity:struct<value:double>,numberOfRepeatsAllowed:bigint,
            expectedSupplyDuration:struct<value:double>>""",
    "Medication": f"status string, code {CONCEPT}, form {CONCEPT}",
    "Immunization": f"""status string, statusReason {CONCEPT}, vaccineCode {CONCEPT},
        patient {REFERENCE}, encounter {REFERENCE}, occurrenceDateTime {DATE_TIME},
        location {REFERENCE}, lotNumber string, site {CONCEPT}, route {CONCEPT},
        doseQuantity struct<value:double>, performer array<struct<actor:{REFERENCE}>>""",
    "AllergyIntolerance": f"""clinicalStatus {CONCEPT}, type string, category array<string>,
        criticality string, code {CONCEPT}, patient {REFERENCE}, recordedDate {DATE_TIME}""",
    "Practitioner": f"""identifier array<{SHORT_IDENTIFIER}>, name array<{HUMAN_NAME}>,
        gender string, address array<{PLAIN_ADDRESS}>""",
    "PractitionerRole": f"""practitioner {IDENTIFIED_REFERENCE},
        organization {IDENTIFIED_REFERENCE}, specialty array<{CONCEPT}>""",
    "Organization": f"""identifier array<{SHORT_IDENTIFIER}>, name string,
        type array<{CONCEPT}>, address array<{PLAIN_ADDRESS}>, telecom array<{TELECOM}>""",
    "Location": f"""identifier array<{SHORT_IDENTIFIER}>, name string, status string,
        type array<{CONCEPT}>, managingOrganization {IDENTIFIED_REFERENCE},
        address {PLAIN_ADDRESS}, position struct<latitude:double,longitude:double>""",
    "Coverage": f"""status string, subscriberId string, beneficiary {REFERENCE},
        relationship {CONCEPT}, period {PERIOD}, payor array<{REFERENCE}>, type {CONCEPT},
        class array<struct<type:{CONCEPT},value:string,name:string>>""",
    "ExplanationOfBenefit": f"""identifier array<{IDENTIFIER}>, status string, outcome string,
        claim {REFERENCE}, patient {REFERENCE}, type {CONCEPT}, billablePeriod {PERIOD},
        created {DATE_TIME}, insurer {REFERENCE}, provider {REFERENCE}, facility {REFERENCE},
        insurance array<struct<coverage:{REFERENCE}>>,
        contained array<struct<resourceType:string,id:string,type:struct<text:string>>>,
        diagnosis array<struct<sequence:bigint,diagnosisReference:{REFERENCE},
            diagnosisCodeableConcept:{CONCEPT},type:array<{CONCEPT}>,onAdmission:{CONCEPT}>>,
        item array<struct<sequence:bigint,productOrService:{CONCEPT},servicedPeriod:{PERIOD},
            servicedDate:{DATE},locationCodeableConcept:{CONCEPT},category:{CONCEPT},
            quantity:struct<value:double>,net:{AMOUNT},diagnosisSequence:array<bigint>,
            encounter:array<{REFERENCE}>,
            adjudication:array<struct<category:{CONCEPT},amount:{AMOUNT}>>>>,
        total array<struct<category:{CONCEPT},amount:{AMOUNT}>>,
        payment struct<amount:{AMOUNT}>""",
}

RESOURCE_TYPES = tuple(_FIELDS)


@cache
def resource_schema(resource_type: str) -> T.StructType:
    """Read schema of a resource type."""
    return T.StructType.fromDDL(f"{HEAD}, {_FIELDS[resource_type]}")


# Schemas in DDL text; every reader takes them as they are.
TARGET_KEY_SCHEMA = f"{HEAD}, identifier array<{SHORT_IDENTIFIER}>"
BUNDLE_SCHEMA = (
    "resourceType string, type string, entry array<struct<fullUrl:string,resource:string>>"
)
DIAGNOSIS_MAP_SCHEMA = (
    "referenced_component_id string, map_target string, map_target_name string, "
    "map_group string, map_priority string, map_rule string, active string"
)
DRUG_PACKAGE_SCHEMA = (
    "drug_id string, clinical_drug_id string, ndc11 string, active string"
)
MEASURE_SCHEMA = (
    "measure_id string, measure_name string, performance_period_end date, "
    "denominator_sum bigint, numerator_sum bigint, exclusion_sum bigint, performance_rate double"
)
