"""Health records derived from the given tables, and the same content as flat SQL.

Every leaf is an SQL expression that Spark and DuckDB read alike. ``RECORDS`` nests the
leaves; ``FLAT_SQL`` selects what flattening must give back, straight from the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.nesting import When, record
from clinflat.functions import codes


def concept(system: str | None, code: str | None, display: str | None = None, text: str | None = None) -> dict:
    return {"coding": [{"system": system, "code": code, "display": display}], "text": text}


def quoted(s: str) -> str:
    return f"'{s}'"


def key(prefix: str, column: str) -> str:
    return f"'{prefix}' || cast({column} as string)"


def ref(target: str, ident: str) -> str:
    return f"'{target}/' || {ident}"


SRC, SSN, NPI = quoted(codes.SOURCE_SYSTEM), quoted(codes.SSN), quoted(codes.NPI)
SCT, LNC, RXN = quoted(codes.SNOMED), quoted(codes.LOINC), quoted(codes.RXNORM)
ICD, CPT, CVX = quoted(codes.ICD10_CM), quoted(codes.CPT), quoted(codes.CVX)
OTHER = quoted("urn:other")

# -- Patient from customer ---------------------------------------------------------------

K = "c_custkey"
P = {
    "id": f"cast({K} as string)",
    "src": key("src-", K),
    "mrn": key("MRN", K),
    "ssn": key("999-", K),
    "official": f"({K} % 11 <> 0)",
    "given": key("Ann", K),
    "gender": f"case {K} % 3 when 0 then 'male' when 1 then 'female' else 'other' end",
    "born": f"substr(cast(date '1940-01-01' + cast({K} % 20000 as int) as string), 1, case when {K} % 50 = 0 then 7 else 10 end)",
    "died": f"case when {K} % 10 = 0 then '2000-06-15T10:00:00Z' end",
    "dead": f"case when {K} % 10 = 1 then true when {K} % 10 = 2 then false end",
    "race": "case c_nationkey % 7 when 0 then '2106-3' when 1 then '2054-5' when 2 then '2028-9' when 3 then '1002-5' when 4 then '2076-8' when 5 then '2131-1' else 'x' end",
    "race_text": "'race ' || cast(c_nationkey % 7 as string)",
    "eth": "case c_nationkey % 3 when 0 then '2135-2' when 1 then '2186-5' else 'y' end",
    "line1": f"cast({K} as string) || ' Main St'",
    "state": "'S' || cast(c_nationkey as string)",
    "zip": f"lpad(cast({K} as string), 5, '0')",
    "lat": "c_acctbal / 128",
    "phone": key("555-", K),
    "email": f"cast({K} as string) || '@x.org'",
}


def _extension(url: str, value: str, text: str) -> dict:
    return {
        "url": quoted(url),
        "extension": [
            {"url": "'ombCategory'", "valueCoding": {"system": OTHER, "code": value, "display": text}},
            {"url": "'text'", "valueString": text},
        ],
    }


PATIENT = {
    "id": P["id"],
    "identifier": [
        {"system": SRC, "value": P["src"]},
        {
            "value": P["mrn"],
            "type": {"coding": [{"code": "'MR'"}, When(f"{K} % 5 = 0", {"code": "'XX'"})]},
        },
        {"system": SSN, "value": P["ssn"]},
    ],
    "name": [
        When(f"{K} % 2 = 1", {"use": "'nickname'", "family": "'Nick'", "given": ["'Nicky'"]}),
        When(
            P["official"],
            {
                "use": "'official'",
                "family": "c_name",
                "given": [P["given"], When(f"{K} % 4 <> 0", "'Bea7'")],
                "prefix": ["'Ms.'"],
                "suffix": [When(f"{K} % 9 = 0", "'PhD'")],
            },
        ),
        {"use": "'old'", "family": "'Old'", "given": [None, "'Olive'"]},
    ],
    "gender": P["gender"],
    "birthDate": P["born"],
    "deceasedDateTime": P["died"],
    "deceasedBoolean": P["dead"],
    "extension": [
        _extension(codes.RACE, P["race"], P["race_text"]),
        _extension(codes.ETHNICITY, P["eth"], "'eth'"),
        {"url": quoted(codes.BIRTH_SEX), "valueCode": "'F'"},
    ],
    "address": [
        {
            "line": [When(f"{K} % 6 <> 0", P["line1"]), When(f"{K} % 12 > 6", "'Apt 2'")],
            "city": "c_mktsegment",
            "state": P["state"],
            "postalCode": P["zip"],
            "country": "'US'",
            "extension": [
                {
                    "url": quoted(codes.GEOLOCATION),
                    "extension": [
                        {"url": "'latitude'", "valueDecimal": P["lat"]},
                        {"url": "'longitude'", "valueDecimal": f"0 - {P['lat']}"},
                    ],
                }
            ],
        }
    ],
    "telecom": [
        {"system": "'fax'", "value": "'0'"},
        {"system": "'phone'", "value": P["phone"]},
        When(f"{K} % 2 = 0", {"system": "'email'", "value": P["email"]}),
    ],
    "maritalStatus": concept(OTHER, "'M'"),
    "communication": [{"language": concept(OTHER, "'en'")}, {"language": concept(OTHER, "'fr'")}],
}

PATIENT_SQL = f"""select {P["id"]} as id, {P["src"]} as source_identifier,
  case when {K} % 5 <> 0 then {P["mrn"]} end as mrn, {P["ssn"]} as ssn,
  case when {P["official"]} then c_name when {K} % 2 = 1 then 'Nick' else 'Old' end as family_name,
  case when {P["official"]} then {P["given"]} when {K} % 2 = 1 then 'Nicky' else 'Olive' end as given_name,
  case when {P["official"]} and {K} % 4 <> 0 then 'Bea7' end as middle_name,
  case when {P["official"]} then 'Ms.' end as name_prefix,
  case when {P["official"]} and {K} % 9 = 0 then 'PhD' end as name_suffix,
  {P["gender"]} as gender, 'F' as birth_sex, {P["born"]} as birth_date, {P["died"]} as deceased_datetime,
  ({K} % 10 = 0 or {K} % 10 = 1) as deceased_flag, {P["race"]} as race_code, {P["race_text"]} as race_display,
  {P["eth"]} as ethnicity_code, 'eth' as ethnicity_display,
  case when {K} % 6 <> 0 and {K} % 12 > 6 then {P["line1"]} || ', Apt 2' when {K} % 6 <> 0 then {P["line1"]}
       when {K} % 12 > 6 then 'Apt 2' end as address_line,
  c_mktsegment as city, {P["state"]} as state, {P["zip"]} as postal_code, 'US' as country,
  {P["lat"]} as latitude, 0 - {P["lat"]} as longitude, {P["phone"]} as phone,
  case when {K} % 2 = 0 then {P["email"]} end as email, 'M' as marital_status_code, 'en' as language_code
from customer"""

# -- Coverage, Immunization and AllergyIntolerance from customer --------------------------

COVERAGE = {
    "id": key("cov-", K),
    "status": "'active'",
    "subscriberId": key("sub-", K),
    "beneficiary": {"reference": f"'http://h.org/fhir/Patient/' || {P['id']} || '/_history/2'"},
    "relationship": concept(OTHER, "'self'"),
    "period": {"start": P["born"]},
    "payor": [{"reference": ref("Organization", "cast(c_nationkey as string)"), "display": "c_mktsegment"}],
    "type": {"coding": [{"code": "'PPO'"}], "text": "'Plan text'"},
    "class": [
        {"type": concept(OTHER, "'group'"), "name": "'Group name'"},
        When(f"{K} % 3 = 0", {"type": concept(OTHER, "'plan'"), "name": key("Plan ", K)}),
        When(
            f"{K} % 3 = 1",
            {"type": {"coding": [{"code": "'plan'"}, {"code": "'other'"}]}, "name": "'Two codes'"},
        ),
    ],
}
COVERAGE_SQL = f"""select {key("cov-", K)} as id, {P["id"]} as patient_id, 'active' as status,
  {key("sub-", K)} as subscriber_id, 'self' as relationship_code, {P["born"]} as period_start,
  cast(null as string) as period_end, cast(c_nationkey as string) as payer_id, c_mktsegment as payer_name,
  'PPO' as type_code, case when {K} % 3 = 0 then {key("Plan ", K)} else 'Plan text' end as plan_name
from customer"""

IMMUNIZATION = {
    "id": key("imm-", K),
    "status": "'completed'",
    "statusReason": When(f"{K} % 8 = 0", concept(OTHER, "'late'")),
    "vaccineCode": concept(CVX, f"cast({K} % 150 as string)", None, key("Vaccine ", f"{K} % 150")),
    "patient": {"reference": ref("Patient", P["id"])},
    "encounter": {"reference": ref("Encounter", key("enc-", K))},
    "occurrenceDateTime": f"case when {K} % 25 = 0 then '2019-05' else '2019-05-07T09:30:00+02:00' end",
    "location": {"reference": f"'#loc'"},
    "lotNumber": key("L", f"{K} % 7"),
    "site": concept(OTHER, "'LA'"),
    "route": When(f"{K} % 2 = 0", concept(OTHER, "'IM'")),
    "doseQuantity": {"value": f"cast({K} % 4 as double) / 2"},
    "performer": [{"actor": {"reference": ref("Practitioner", f"cast({K} % 10 as string)")}}],
}
IMMUNIZATION_SQL = f"""select {key("imm-", K)} as id, {P["id"]} as patient_id, {key("enc-", K)} as encounter_id,
  'completed' as status, case when {K} % 8 = 0 then 'late' end as status_reason_code, {CVX} as vaccine_system,
  cast({K} % 150 as string) as vaccine_code, {key("Vaccine ", f"{K} % 150")} as vaccine_display,
  case when {K} % 25 = 0 then '2019-05' else '2019-05-07T09:30:00+02:00' end as occurrence_datetime,
  cast(null as string) as location_id, {key("L", f"{K} % 7")} as lot_number, 'LA' as site_code,
  case when {K} % 2 = 0 then 'IM' end as route_code, cast({K} % 4 as double) / 2 as dose_quantity,
  cast({K} % 10 as string) as practitioner_id
from customer"""

ALLERGY = {
    "id": key("alg-", K),
    "clinicalStatus": concept(OTHER, "'active'"),
    "type": "'allergy'",
    "category": [None, When(f"{K} % 3 <> 0", "'food'"), "'environment'"],
    "criticality": f"case when {K} % 2 = 0 then 'high' end",
    "code": {
        "coding": [{"system": SCT, "code": P["id"], "display": f"case when {K} % 2 = 0 then c_name end"}],
        "text": "'some allergy'",
    },
    "patient": {"reference": ref("Patient", P["id"])},
    "recordedDate": P["born"],
}
ALLERGY_SQL = f"""select {key("alg-", K)} as id, {P["id"]} as patient_id, 'active' as clinical_status,
  'allergy' as type, case when {K} % 3 <> 0 then 'food' else 'environment' end as category,
  case when {K} % 2 = 0 then 'high' end as criticality, {SCT} as code_system, {P["id"]} as code_code,
  case when {K} % 2 = 0 then c_name else 'some allergy' end as code_display, {P["born"]} as recorded_date
from customer"""

# -- Practitioner, PractitionerRole and Location from supplier; Organization from nation ---

S = "s_suppkey"
SID = f"cast({S} as string)"
NATION = "cast(s_nationkey as string)"
PRACTITIONER = {
    "id": SID,
    "identifier": [
        {"system": OTHER, "value": "'x'"},
        When(f"{S} % 17 <> 0", {"system": NPI, "value": key("N", S)}),
    ],
    "name": [{"family": "s_name", "given": [key("Doc", S)], "prefix": ["'Dr.'"]}],
    "gender": f"case when {S} % 2 = 0 then 'male' else 'female' end",
    "address": [{"city": "'City'", "state": f"'S' || {NATION}", "postalCode": "'00001'"}],
}
PRACTITIONER_SQL = f"""select {SID} as id, case when {S} % 17 <> 0 then {key("N", S)} end as npi,
  s_name as family_name, {key("Doc", S)} as given_name, 'Dr.' as name_prefix,
  case when {S} % 2 = 0 then 'male' else 'female' end as gender, 'City' as city,
  'S' || {NATION} as state, '00001' as postal_code
from supplier"""

ROLE = {
    "id": key("role-", S),
    "practitioner": {
        "reference": ref("Practitioner", SID),
        "identifier": {
            "system": f"case when {S} % 4 = 3 then {OTHER} else {NPI} end",
            "value": key("N", f"{S} % 50"),
        },
    },
    "organization": {
        "reference": ref("Organization", NATION),
        "display": f"'Org ' || {NATION}",
        "identifier": {"system": SRC, "value": f"'org-' || {NATION}"},
    },
    "specialty": [
        {
            "coding": [
                {
                    "system": OTHER,
                    "code": key("sp", f"{S} % 10"),
                    "display": f"case when {S} % 3 <> 0 then {key('Specialty ', f'{S} % 10')} end",
                }
            ],
            "text": key("Text ", f"{S} % 10"),
        }
    ],
}
ROLE_SQL = f"""select {key("role-", S)} as id, {SID} as practitioner_id,
  case when {S} % 4 <> 3 then {key("N", f"{S} % 50")} end as practitioner_npi, {NATION} as organization_id,
  'org-' || {NATION} as organization_identifier, 'Org ' || {NATION} as organization_name,
  {OTHER} as specialty_system, {key("sp", f"{S} % 10")} as specialty_code,
  case when {S} % 3 <> 0 then {key("Specialty ", f"{S} % 10")} else {key("Text ", f"{S} % 10")} end as specialty_display
from supplier"""

LOCATION = {
    "id": key("loc-", S),
    "identifier": [{"system": SRC, "value": key("lsrc-", S)}],
    "name": "s_name",
    "status": "'active'",
    "type": [concept(OTHER, "'HOSP'")],
    "managingOrganization": When(
        f"{S} % 10 <> 9",
        {
            "reference": f"case when {S} % 2 = 0 then {ref('Organization', NATION)} end",
            "identifier": When(
                f"{S} % 2 = 1 or {S} % 6 = 0",
                {
                    "system": SRC,
                    "value": f"'org-' || cast(case when {S} % 12 = 6 then s_nationkey else (s_nationkey + 1) % 25 end as string)",
                },
            ),
        },
    ),
    "address": {"line": [f"'{1} ' || s_name", "'Floor 1'"], "city": "'City'", "state": "'ST'", "postalCode": "'1'"},
    "position": {"latitude": "s_acctbal / 64", "longitude": "s_acctbal / 128"},
}
LOCATION_SQL = f"""select {key("loc-", S)} as id, {key("lsrc-", S)} as source_identifier, s_name as name,
  'active' as status, 'HOSP' as type_code,
  case when {S} % 10 <> 9 and {S} % 2 = 0 then {NATION} end as managing_organization_id,
  case when {S} % 10 <> 9 and ({S} % 2 = 1 or {S} % 6 = 0)
       then 'org-' || cast(case when {S} % 12 = 6 then s_nationkey else (s_nationkey + 1) % 25 end as string)
  end as managing_organization_identifier,
  '1 ' || s_name || ', Floor 1' as address_line, 'City' as city, 'ST' as state, '1' as postal_code,
  s_acctbal / 64 as latitude, s_acctbal / 128 as longitude
from supplier"""

N = "n_nationkey"
NID = f"cast({N} as string)"
ORGANIZATION = {
    "id": NID,
    "identifier": [
        {"system": SRC, "value": key("org-", N)},
        When(f"{N} % 4 <> 0", {"system": NPI, "value": key("9", N)}),
    ],
    "name": "n_name",
    "type": [concept(OTHER, "'prov'")],
    "address": [{"line": ["n_name"], "city": "'City'", "state": NID, "postalCode": "'2'"}],
    "telecom": [{"system": "'phone'", "value": key("1-", N)}],
}
ORGANIZATION_SQL = f"""select {NID} as id, {key("org-", N)} as source_identifier,
  case when {N} % 4 <> 0 then {key("9", N)} end as npi, n_name as name, 'prov' as type_code,
  n_name as address_line, 'City' as city, {NID} as state, '2' as postal_code, {key("1-", N)} as phone
from nation"""

# -- Medication and Condition from part ---------------------------------------------------

R = "p_partkey"
MEDICATION = {
    "id": key("med-", R),
    "status": "'active'",
    "code": {
        "coding": [
            {
                "system": f"case when {R} % 5 <> 0 then {RXN} else {SCT} end",
                "code": f"cast({R} % 700 as string)",
                "display": f"case when {R} % 3 = 0 then p_name end",
            }
        ],
        "text": When(f"{R} % 6 <> 1", "p_type"),
    },
    "form": concept(OTHER, "p_brand"),
}
MEDICATION_SQL = f"""select {key("med-", R)} as id, 'active' as status,
  case when {R} % 5 <> 0 then {RXN} else {SCT} end as code_system, cast({R} % 700 as string) as code_code,
  case when {R} % 3 = 0 then p_name when {R} % 6 <> 1 then p_type end as code_display, p_brand as form_code
from part"""

ONSET = f"case when {R} % 9 = 0 then '2001' when {R} % 9 = 1 then '2001-03' else '2001-03-0' || cast(1 + {R} % 9 as string) || 'T12:00:00Z' end"
RECORDED = f"case when {R} % 4 <> 0 then '2002-01-1' || cast({R} % 10 as string) end"
VERIFIED = f"case when {R} % 13 = 0 then 'entered-in-error' when {R} % 4 <> 0 then 'confirmed' end"
COND_CODE = f"case when {R} % 10 = 0 then 'E11.' || cast({R} % 90 as string) else cast({R} % 700 as string) end"
COND_SYSTEM = f"case when {R} % 10 = 0 then {ICD} else {SCT} end"
CONDITION = {
    "id": key("cond-", R),
    "subject": {"reference": ref("Patient", f"cast({R} % 150 as string)")},
    "encounter": {"reference": ref("Encounter", key("enc-", R))},
    "clinicalStatus": concept(OTHER, "'active'"),
    "verificationStatus": concept(OTHER, VERIFIED),
    "category": [concept(OTHER, f"case when {R} % 3 = 0 then 'problem-list-item' else 'encounter-diagnosis' end")],
    "code": {
        "coding": [
            {"system": COND_SYSTEM, "code": COND_CODE, "display": f"case when {R} % 2 = 0 then p_name end"}
        ],
        "text": When(f"{R} % 3 <> 0", "p_type"),
    },
    "onsetDateTime": ONSET,
    "abatementDateTime": When(f"{R} % 5 = 0", "'2003-02-03'"),
    "recordedDate": RECORDED,
}
CONDITION_SQL = f"""select {key("cond-", R)} as id, cast({R} % 150 as string) as patient_id,
  {key("enc-", R)} as encounter_id, 'active' as clinical_status, {VERIFIED} as verification_status,
  case when {R} % 3 = 0 then 'problem-list-item' else 'encounter-diagnosis' end as category,
  {COND_SYSTEM} as code_system, {COND_CODE} as code_code,
  case when {R} % 2 = 0 then p_name when {R} % 3 <> 0 then p_type end as code_display, {ONSET} as onset_datetime,
  case when {R} % 5 = 0 then '2003-02-03' end as abatement_datetime, {RECORDED} as recorded_date
from part"""

# -- Encounter, Procedure, MedicationRequest and claim headers from orders ------------------

O = "o_orderkey"
ENC = key("enc-", O)
PAT = "cast(o_custkey as string)"
DAY = "substr(cast(o_orderdate as string), 1, 10)"
LATER = f"cast(cast(o_orderdate as date) + cast({O} % 5 as int) as string)"
CLASS = "case o_orderpriority when '1-URGENT' then 'EMER' when '2-HIGH' then 'IMP' when '3-MEDIUM' then 'AMB' when '4-NOT SPECIFIED' then 'HH' else 'VR' end"
TYPE_CODE = f"case when {O} % 7 = 0 then '702927004' else cast({O} % 50 as string) end"
TYPE_NAME = f"case when {O} % 9 = 0 then 'Rehabilitation stay' when {O} % 8 = 0 then 'Hospice care' when {O} % 10 <> 3 then {key('Visit ', f'{O} % 50')} end"
DOC = f"cast({O} % 120 as string)"
ENCOUNTER = {
    "id": ENC,
    "status": "'finished'",
    "class": {"code": CLASS},
    "type": [{"coding": [{"system": SCT, "code": TYPE_CODE, "display": TYPE_NAME}], "text": "'Some visit'"}],
    "subject": {"reference": ref("Patient", PAT)},
    "participant": [
        When(f"{O} % 4 = 0", {}),
        {"individual": {"reference": ref("Practitioner", DOC), "display": key("Dr. Name", f"{O} % 120")}},
    ],
    "period": {"start": f"{DAY} || 'T08:00:00Z'", "end": f"{LATER} || 'T17:00:00Z'"},
    "reasonCode": [When(f"{O} % 3 = 0", concept(SCT, f"cast({O} % 700 as string)", None, "'reason'"))],
    "reasonReference": [{"reference": ref("Condition", key("cond-", f"{O} % 200"))}],
    "location": [
        {
            "location": {
                "reference": ref("Location", key("loc-", f"{O} % 100")),
                "display": When(f"{O} % 6 <> 0", key("Loc ", f"{O} % 100")),
            }
        }
    ],
    "serviceProvider": {"reference": ref("Organization", f"cast({O} % 25 as string)"), "display": "'Provider'"},
    "hospitalization": {
        "admitSource": concept(OTHER, f"case when {O} % 5 = 0 then 'emd' end"),
        "dischargeDisposition": When(f"{O} % 3 <> 0", concept(OTHER, "'home'")),
    },
}
ENCOUNTER_SQL = f"""select {ENC} as id, {PAT} as patient_id, 'finished' as status, {CLASS} as class_code,
  {SCT} as type_system, {TYPE_CODE} as type_code, coalesce({TYPE_NAME}, 'Some visit') as type_display,
  {DAY} || 'T08:00:00Z' as period_start, {LATER} || 'T17:00:00Z' as period_end,
  case when {O} % 3 = 0 then {SCT} end as reason_system, case when {O} % 3 = 0 then cast({O} % 700 as string) end as reason_code,
  case when {O} % 3 = 0 then 'reason' end as reason_display, {key("cond-", f"{O} % 200")} as reason_condition_id,
  {DOC} as practitioner_id, {key("Dr. Name", f"{O} % 120")} as practitioner_name,
  {key("loc-", f"{O} % 100")} as location_id, case when {O} % 6 <> 0 then {key("Loc ", f"{O} % 100")} end as location_name,
  cast({O} % 25 as string) as service_provider_id, 'Provider' as service_provider_name,
  case when {O} % 5 = 0 then 'emd' end as admit_source_code,
  case when {O} % 3 <> 0 then 'home' end as discharge_disposition_code
from orders"""

PROC_STATUS = f"case when {O} % 11 = 0 then 'not-done' when {O} % 17 = 0 then 'entered-in-error' when {O} % 5 <> 0 then 'completed' end"
PROC_SYSTEM = f"case when {O} % 3 = 0 then {CPT} when {O} % 3 = 1 then {SCT} else {OTHER} end"
PROCEDURE = {
    "id": key("proc-", O),
    "status": PROC_STATUS,
    "code": concept(PROC_SYSTEM, f"cast({O} % 300 as string)", key("Procedure ", f"{O} % 300")),
    "subject": {"reference": ref("Patient", PAT)},
    "encounter": {"reference": f"case when {O} % 9 = 0 then 'Group/1' else {ref('Encounter', ENC)} end"},
    "performedDateTime": When(f"{O} % 2 = 1", DAY),
    "performedPeriod": When(f"{O} % 2 = 0", {"start": f"{DAY} || 'T10:00:00Z'", "end": f"{LATER} || 'T11:00:00Z'"}),
    "performer": [{"actor": {"reference": ref("Practitioner", DOC)}}],
    "location": {"reference": ref("Location", key("loc-", f"{O} % 100"))},
    "reasonCode": [When(f"{O} % 3 = 0", concept(SCT, "'1'", "'why'"))],
}
PROCEDURE_SQL = f"""select {key("proc-", O)} as id, {PAT} as patient_id, case when {O} % 9 <> 0 then {ENC} end as encounter_id,
  {PROC_STATUS} as status, {PROC_SYSTEM} as code_system, cast({O} % 300 as string) as code_code,
  {key("Procedure ", f"{O} % 300")} as code_display,
  case when {O} % 2 = 1 then {DAY} else {DAY} || 'T10:00:00Z' end as performed_start,
  case when {O} % 2 = 0 then {LATER} || 'T11:00:00Z' end as performed_end, {DOC} as practitioner_id,
  {key("loc-", f"{O} % 100")} as location_id, case when {O} % 3 = 0 then {SCT} end as reason_system,
  case when {O} % 3 = 0 then '1' end as reason_code, case when {O} % 3 = 0 then 'why' end as reason_display
from orders"""

REQUEST = {
    "id": key("mr-", O),
    "status": "'active'",
    "intent": "'order'",
    "subject": {"reference": ref("Patient", PAT)},
    "encounter": {"reference": ref("Encounter", ENC)},
    "authoredOn": f"{DAY} || 'T08:30:00-05:00'",
    "medicationCodeableConcept": When(
        f"{O} % 2 = 0", concept(RXN, f"cast({O} % 900 as string)", key("Drug ", f"{O} % 900"))
    ),
    "medicationReference": When(f"{O} % 2 = 1", {"reference": ref("Medication", key("med-", f"{O} % 230"))}),
    "requester": {"reference": ref("Practitioner", DOC)},
    "reasonReference": [{"reference": ref("Observation", "'1'")}],
    "dosageInstruction": [{"text": "'daily'", "asNeededBoolean": f"{O} % 3 = 0"}],
    "dispenseRequest": {
        "quantity": {"value": f"cast({O} % 90 as double)"},
        "numberOfRepeatsAllowed": f"{O} % 4",
        "expectedSupplyDuration": When(f"{O} % 5 = 0", {"value": "30"}),
    },
}
REQUEST_SQL = f"""select {key("mr-", O)} as id, {PAT} as patient_id, {ENC} as encounter_id, 'active' as status,
  'order' as intent, {DAY} || 'T08:30:00-05:00' as authored_on, case when {O} % 2 = 0 then {RXN} end as medication_system,
  case when {O} % 2 = 0 then cast({O} % 900 as string) end as medication_code,
  case when {O} % 2 = 0 then {key("Drug ", f"{O} % 900")} end as medication_display,
  case when {O} % 2 = 1 then {key("med-", f"{O} % 230")} end as medication_id, {DOC} as requester_id,
  cast(null as string) as reason_condition_id, 'daily' as dosage_text, {O} % 3 = 0 as as_needed,
  cast({O} % 90 as double) as dispense_quantity, cast({O} % 4 as bigint) as dispense_repeats,
  case when {O} % 5 = 0 then cast(30 as double) end as days_supply
from orders"""


def claim_type(k: str) -> str:
    return f"case {k} % 3 when 0 then 'professional' when 1 then 'institutional' else 'pharmacy' end"


PAYER = "case o_custkey % 5 when 0 then 'Medicare' when 1 then 'Medicaid' when 2 then 'NO_INSURANCE' when 3 then 'Dual Eligible' else 'Acme Health' end"
HEADER = {
    "id": key("clm-", O),
    "identifier": [{"system": quoted(codes.CLAIM_ID_SYSTEM), "value": key("c", O)}],
    "status": "'active'",
    "outcome": "'complete'",
    "claim": {"reference": ref("Claim", key("cl-", O))},
    "patient": {"reference": ref("Patient", PAT)},
    "type": concept(OTHER, claim_type(O)),
    "billablePeriod": {"start": DAY, "end": LATER},
    "created": f"{LATER} || 'T00:00:00Z'",
    "insurer": When(f"{O} % 7 <> 0 and {O} % 23 <> 0", {"display": PAYER}),
    "insurance": [When(f"{O} % 23 <> 0", {"coverage": {"display": PAYER}})],
    "contained": [
        {"resourceType": "'ServiceRequest'", "id": "'r'", "type": {"text": "'not a plan'"}},
        When(f"{O} % 2 = 0", {"resourceType": "'Coverage'", "id": "'cov'", "type": {"text": key("Plan ", f"{O} % 4")}}),
    ],
    "provider": {"reference": ref("Practitioner", DOC)},
    "facility": {"reference": ref("Location", key("loc-", f"{O} % 100")), "display": "'Facility'"},
    "item": [{"sequence": "1", "encounter": [When(f"{O} % 3 <> 2 and {O} % 10 <> 0", {"reference": ref("Encounter", ENC)})]}],
    "total": [
        {
            "category": {"coding": [{"code": "'submitted'"}, When(f"{O} % 8 = 0", {"code": "'x'"})]},
            "amount": {"value": "o_totalprice"},
        },
        {"category": concept(OTHER, "'submitted'"), "amount": When(f"{O} % 16 = 0", {"value": "1.5"})},
    ],
    "payment": {"amount": {"value": "o_totalprice / 2"}},
}
HEADER_SQL = f"""select {key("clm-", O)} as id, {key("c", O)} as claim_identifier, {key("cl-", O)} as claim_id,
  {PAT} as patient_id, {claim_type(O)} as claim_type, 'active' as status, 'complete' as outcome,
  {DAY} as billable_start, {LATER} as billable_end, {LATER} || 'T00:00:00Z' as created,
  case when {O} % 23 <> 0 then {PAYER} end as payer_name,
  case when {O} % 2 = 0 then {key("Plan ", f"{O} % 4")} end as coverage_type, {DOC} as provider_id,
  {key("loc-", f"{O} % 100")} as facility_id, 'Facility' as facility_name,
  case when {O} % 3 <> 2 and {O} % 10 <> 0 then {ENC} end as encounter_id,
  case when {O} % 8 <> 0 then o_totalprice when {O} % 16 = 0 then cast(1.5 as double) end as total_submitted,
  o_totalprice / 2 as payment_amount
from orders"""

# -- claim lines and diagnoses from lineitem ------------------------------------------------

LK = "l_orderkey"
SHIP = "substr(cast(l_shipdate as string), 1, 10)"
SHIP_END = "cast(cast(l_shipdate as date) + 2 as string)"


def product_system(j: int) -> str:
    return f"case when {LK} % 3 = 2 then {RXN} when l_suppkey % 2 = {j % 2} then {CPT} else {SCT} end"


def product_code(j: int) -> str:
    return f"cast((l_partkey + {j}) % 900 as string)"


def _line(j: int) -> dict:
    def money(category: str, value: str) -> dict:
        return {"category": concept(OTHER, quoted(category)), "amount": {"value": value}}

    return {
        "sequence": f"cast(l_linenumber as bigint) * 10 + {j}",
        "productOrService": concept(product_system(j), product_code(j), key("Product ", f"l_partkey % 40")),
        "servicedPeriod": When("l_linenumber % 2 = 1", {"start": SHIP, "end": SHIP_END}),
        "servicedDate": When("l_linenumber % 2 = 0", SHIP),
        "locationCodeableConcept": concept(OTHER, "'11'"),
        "category": concept(OTHER, "l_returnflag"),
        "quantity": {"value": "l_quantity / 2"},
        "net": {"value": "l_extendedprice"},
        "diagnosisSequence": ["cast(l_linenumber as bigint)"],
        "encounter": [{"reference": ref("Encounter", key("enc-", LK))}],
        "adjudication": [
            When("l_suppkey % 3 <> 0", money(codes.LINE_SUBMITTED, "l_extendedprice + 1")),
            money(codes.LINE_ALLOWED, "l_extendedprice - l_quantity"),
            When("l_suppkey % 7 <> 0", money(codes.LINE_PAID, f"l_extendedprice - l_quantity - {j}")),
            money(codes.LINE_COINSURANCE, "l_quantity"),
            When("l_suppkey % 5 = 0", money(codes.LINE_DEDUCTIBLE, "l_quantity / 4")),
        ],
    }


def diagnosis_own(k: str = "l_partkey") -> str:
    return f"'J45.' || cast({k} % 30 as string)"


LINES = {
    "id": key("clm-", LK),
    "patient": {"reference": ref("Patient", f"cast({LK} % 150 as string)")},
    "type": concept(OTHER, claim_type(LK)),
    "item": [_line(0), When("l_partkey % 3 > 0", _line(1)), When("l_partkey % 3 > 1", _line(2))],
    "diagnosis": [
        {
            "sequence": "cast(l_linenumber as bigint) * 10",
            "diagnosisReference": {"reference": ref("Condition", key("cond-", "l_partkey"))},
            "type": [concept(OTHER, "'principal'")],
            "onAdmission": When("l_suppkey % 2 = 0", concept(OTHER, "'Y'")),
        },
        When(
            "l_suppkey % 3 = 0",
            {
                "sequence": "cast(l_linenumber as bigint) * 10 + 1",
                "diagnosisCodeableConcept": concept(ICD, diagnosis_own()),
                "onAdmission": concept(OTHER, "'N'"),
            },
        ),
    ],
}


def _line_sql(j: int) -> str:
    return f"""select {key("clm-", LK)} as eob_id, cast({LK} % 150 as string) as patient_id, {claim_type(LK)} as claim_type,
  cast(l_linenumber as bigint) * 10 + {j} as sequence, {product_system(j)} as product_system,
  {product_code(j)} as product_code, {key("Product ", "l_partkey % 40")} as product_display, {SHIP} as service_start,
  case when l_linenumber % 2 = 1 then {SHIP_END} end as service_end, '11' as place_of_service_code,
  l_returnflag as category_code, l_quantity / 2 as quantity, l_extendedprice as net_amount,
  case when l_suppkey % 3 <> 0 then l_extendedprice + 1 end as submitted_amount,
  l_extendedprice - l_quantity as allowed_amount,
  case when l_suppkey % 7 <> 0 then l_extendedprice - l_quantity - {j} end as paid_amount,
  l_quantity as coinsurance_amount, case when l_suppkey % 5 = 0 then l_quantity / 4 end as deductible_amount,
  cast(l_linenumber as bigint) as diagnosis_sequence, {key("enc-", LK)} as encounter_id
from lineitem where l_partkey % 3 >= {j}"""


LINES_SQL = "\nunion all\n".join(_line_sql(j) for j in range(3))
DIAGNOSES_SQL = f"""select {key("clm-", LK)} as eob_id, cast({LK} % 150 as string) as patient_id,
  cast(l_linenumber as bigint) * 10 as sequence, {key("cond-", "l_partkey")} as condition_id,
  cast(null as string) as diagnosis_system, cast(null as string) as diagnosis_code, 'principal' as type_code,
  case when l_suppkey % 2 = 0 then 'Y' end as on_admission_code
from lineitem
union all
select {key("clm-", LK)}, cast({LK} % 150 as string), cast(l_linenumber as bigint) * 10 + 1, null, {ICD},
  {diagnosis_own()}, null, 'N'
from lineitem where l_suppkey % 3 = 0"""

# -- Observation and DiagnosticReport from events -------------------------------------------

E = "event_id"
EV = "event_type"
TS = "substr(cast(ts as string), 1, 10) || 'T' || substr(cast(ts as string), 12, 8) || 'Z'"
EFFECTIVE = f"case when {E} % 20 = 0 then '2024-01' else {TS} end"
CATEGORY = f"case {EV} when 'error' then 'laboratory' when 'view' then 'vital-signs' when 'click' then 'social-history' when 'purchase' then 'vital-signs' else 'other-kind' end"
HAS_QUANTITY = f"({EV} = 'view' or ({EV} = 'error' and {E} % 2 = 0))"
HAS_CONCEPT = f"({EV} = 'error' and {E} % 2 = 1)"
LEVEL = "cast(regexp_extract(props, '[0-9]+', 0) as double)"
OBSERVATION = {
    "id": key("obs-", E),
    "status": "'final'",
    "category": [concept(OTHER, CATEGORY), concept(OTHER, "'second'")],
    "code": concept(LNC, f"cast({E} % 60 as string)", key("Test ", f"{E} % 60")),
    "subject": {"reference": ref("Patient", "cast(user_id as string)")},
    "encounter": {"reference": ref("Encounter", key("enc-", f"{E} % 100"))},
    "effectiveDateTime": When(f"{E} % 2 = 0", EFFECTIVE),
    "effectivePeriod": When(f"{E} % 2 = 1", {"start": EFFECTIVE}),
    "issued": TS,
    "valueQuantity": When(HAS_QUANTITY, {"value": "value", "unit": "'mg'", "code": When(f"{E} % 3 = 0", "'mg_code'")}),
    "valueString": When(f"{EV} = 'click'", "props"),
    "valueBoolean": When(f"{EV} = 'signup'", f"{E} % 3 = 0"),
    "valueCodeableConcept": When(HAS_CONCEPT, {"coding": [{"system": SCT, "code": "'260'"}], "text": "'Positive'"}),
    "interpretation": [When(f"{E} % 4 = 0", concept(OTHER, "'H'"))],
    "referenceRange": [
        When(f"{E} % 3 = 0", {"low": {"value": f"cast({E} % 50 as double)"}, "high": {"value": f"cast({E} % 50 as double) + 100.5"}})
    ],
    "component": When(
        f"{EV} = 'purchase'",
        [
            {"code": concept(LNC, "'8480-6'", None, "'Systolic'"), "valueQuantity": {"value": LEVEL, "unit": "'mmHg'"}},
            {"code": concept(LNC, "'8462-4'", "'Diastolic'"), "valueQuantity": {"value": "value", "code": "'mm'"}},
            When(f"{E} % 2 = 0", {"code": concept(LNC, "'x'"), "valueCodeableConcept": concept(SCT, "'77'")}),
        ],
    ),
}
OBSERVATION_SQL = f"""select {key("obs-", E)} as id, cast(user_id as string) as patient_id,
  {key("enc-", f"{E} % 100")} as encounter_id, 'final' as status, {CATEGORY} as category, {LNC} as code_system,
  cast({E} % 60 as string) as code_code, {key("Test ", f"{E} % 60")} as code_display, {EFFECTIVE} as effective_datetime,
  {TS} as issued, case when {HAS_QUANTITY} then value end as value_quantity,
  case when {HAS_QUANTITY} then case when {E} % 3 = 0 then 'mg_code' else 'mg' end end as value_unit,
  case when {EV} = 'click' then props end as value_string, case when {EV} = 'signup' then {E} % 3 = 0 end as value_boolean,
  case when {HAS_CONCEPT} then {SCT} end as value_code_system, case when {HAS_CONCEPT} then '260' end as value_code,
  case when {HAS_CONCEPT} then 'Positive' end as value_code_display,
  case when {E} % 4 = 0 then 'H' end as interpretation_code,
  case when {E} % 3 = 0 then cast({E} % 50 as double) end as reference_range_low,
  case when {E} % 3 = 0 then cast({E} % 50 as double) + 100.5 end as reference_range_high,
  {EV} = 'purchase' as has_components
from events"""


def _component_sql(j: int, code: str, display: str, quantity: str, unit: str, concept_code: str, where: str) -> str:
    return f"""select {key("obs-", E)} as observation_id, cast(user_id as string) as patient_id,
  {key("enc-", f"{E} % 100")} as encounter_id, {CATEGORY} as category, cast({E} % 60 as string) as panel_code,
  {EFFECTIVE} as effective_datetime, cast({j} as bigint) as component_index, {LNC} as code_system, {code} as code_code,
  {display} as code_display, {quantity} as value_quantity, {unit} as value_unit, {concept_code} as value_code
from events where {EV} = 'purchase' and {where}"""


COMPONENT_SQL = "\nunion all\n".join(
    [
        _component_sql(0, "'8480-6'", "'Systolic'", LEVEL, "'mmHg'", "cast(null as string)", "true"),
        _component_sql(1, "'8462-4'", "'Diastolic'", "value", "'mm'", "null", "true"),
        _component_sql(2, "'x'", "null", "null", "null", "'77'", f"{E} % 2 = 0"),
    ]
)

REPORT_SYSTEM = f"case when {E} % 5 = 0 then {OTHER} else {LNC} end"
REPORT = {
    "id": key("rep-", E),
    "status": "'final'",
    "category": [concept(OTHER, "'LAB'")],
    "code": concept(REPORT_SYSTEM, f"cast({E} % 12 as string)", key("Panel ", f"{E} % 12")),
    "subject": {"reference": ref("Patient", "cast(user_id as string)")},
    "encounter": {"reference": ref("Encounter", key("enc-", f"{E} % 100"))},
    "effectiveDateTime": TS,
    "issued": TS,
    "result": [
        {"reference": ref("Observation", key("obs-", E))},
        When(f"{E} % 3 = 0", {"reference": ref("Observation", key("obs-", f"({E} + 1)"))}),
        When(f"{E} % 5 = 0", {"reference": "'Media/1'"}),
    ],
}


def _report_sql(observation: str, where: str) -> str:
    return f"""select {key("rep-", E)} as diagnostic_report_id, cast(user_id as string) as patient_id,
  {key("enc-", f"{E} % 100")} as encounter_id, 'final' as status, 'LAB' as category, {REPORT_SYSTEM} as code_system,
  cast({E} % 12 as string) as code_code, {key("Panel ", f"{E} % 12")} as code_display, {TS} as effective_datetime,
  {TS} as issued, {observation} as observation_id
from events where {where}"""


REPORT_SQL = "\nunion all\n".join(
    [
        _report_sql(key("obs-", E), "true"),
        _report_sql(key("obs-", f"({E} + 1)"), f"{E} % 3 = 0"),
        _report_sql("cast(null as string)", f"{E} % 5 = 0"),
    ]
)

# -- terminology from part ------------------------------------------------------------------

DIAGNOSIS_MAP = {
    "referenced_component_id": f"cast({R} % 500 as string)",
    "map_target": f"case when {R} % 19 = 0 then '' when {R} % 23 <> 0 then 'A' || cast({R} % 77 as string) || '.' || cast({R} % 10 as string) end",
    "map_target_name": "p_name",
    "map_group": "cast(p_size % 3 as string)",
    "map_priority": f"cast({R} as string)",
    "map_rule": "case p_type when 'ECONOMY' then 'IFA 1' when 'SMALL' then 'true' else 'OTHERWISE TRUE' end",
    "active": "case when p_size % 7 = 0 then '0' else '1' end",
}
PACKAGES = {
    "drug_id": f"cast({R} % 700 as string)",
    "clinical_drug_id": f"cast({R} % 300 as string)",
    "ndc11": f"case when {R} % 29 <> 0 then cast({R} * 7 % 100003 as string) end",
    "active": "case when p_size % 2 = 0 then 'true' else 'false' end",
}
MEASURES_SQL = """select p_brand as measure_id, 'Measure ' || p_brand as measure_name, date '2001-12-31' as performance_period_end,
  count(*) as denominator_sum, count(case when p_size > 25 then 1 end) as numerator_sum,
  count(case when p_size < 5 then 1 end) as exclusion_sum,
  cast(count(case when p_size > 25 then 1 end) as double) / count(*) as performance_rate
from part group by p_brand"""

# table -> (resource type, source table, record, flat SQL)
RECORDS = {
    "patient": ("Patient", "customer", PATIENT, PATIENT_SQL),
    "encounter": ("Encounter", "orders", ENCOUNTER, ENCOUNTER_SQL),
    "condition": ("Condition", "part", CONDITION, CONDITION_SQL),
    "procedure": ("Procedure", "orders", PROCEDURE, PROCEDURE_SQL),
    "observation": ("Observation", "events", OBSERVATION, OBSERVATION_SQL),
    "observation_component": ("Observation", "events", OBSERVATION, COMPONENT_SQL),
    "diagnostic_report_result": ("DiagnosticReport", "events", REPORT, REPORT_SQL),
    "medication_request": ("MedicationRequest", "orders", REQUEST, REQUEST_SQL),
    "medication": ("Medication", "part", MEDICATION, MEDICATION_SQL),
    "immunization": ("Immunization", "customer", IMMUNIZATION, IMMUNIZATION_SQL),
    "allergy_intolerance": ("AllergyIntolerance", "customer", ALLERGY, ALLERGY_SQL),
    "practitioner": ("Practitioner", "supplier", PRACTITIONER, PRACTITIONER_SQL),
    "practitioner_role": ("PractitionerRole", "supplier", ROLE, ROLE_SQL),
    "organization": ("Organization", "nation", ORGANIZATION, ORGANIZATION_SQL),
    "location": ("Location", "supplier", LOCATION, LOCATION_SQL),
    "coverage": ("Coverage", "customer", COVERAGE, COVERAGE_SQL),
    "explanation_of_benefit": ("ExplanationOfBenefit", "orders", HEADER, HEADER_SQL),
    "explanation_of_benefit_item": ("ExplanationOfBenefit", "lineitem", LINES, LINES_SQL),
    "explanation_of_benefit_diagnosis": ("ExplanationOfBenefit", "lineitem", LINES, DIAGNOSES_SQL),
}
FLAT_SQL = {name: sql for name, (_, _, _, sql) in RECORDS.items()}
TERMINOLOGY_SQL = {
    "diagnosis_map": "select " + ", ".join(f"{e} as {n}" for n, e in DIAGNOSIS_MAP.items()) + " from part",
    "drug_packages": "select " + ", ".join(f"{e} as {n}" for n, e in PACKAGES.items()) + " from part",
    "measures": MEASURES_SQL,
}


def source(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A given table, dealt as its splits are."""
    return spark.read.parquet(f"{folder}/{table}.parquet")


def records(spark: SparkSession, folder: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """Nested records that the flat table ``table`` is made from."""
    resource_type, base, parts, _ = RECORDS[table]
    return record(source(spark, folder, base), resource_type, parts, schema)


def terminology(spark: SparkSession, folder: str, name: str) -> DataFrame:
    part = source(spark, folder, "part")
    leaves = {"diagnosis_map": DIAGNOSIS_MAP, "drug_packages": PACKAGES}[name]
    return part.selectExpr(*[f"{e} as {n}" for n, e in leaves.items()])


def measures(spark: SparkSession, folder: str) -> DataFrame:
    large = F.count(F.when(F.col("p_size") > 25, 1))
    return source(spark, folder, "part").groupBy(F.col("p_brand").alias("measure_id")).agg(
        F.concat(F.lit("Measure "), F.first("p_brand")).alias("measure_name"),
        F.lit("2001-12-31").cast("date").alias("performance_period_end"),
        F.count(F.lit(1)).alias("denominator_sum"),
        large.alias("numerator_sum"),
        F.count(F.when(F.col("p_size") < 5, 1)).alias("exclusion_sum"),
        (large.cast("double") / F.count(F.lit(1))).alias("performance_rate"),
    )
