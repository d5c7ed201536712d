"""Code systems and the fixed addresses that records use for them."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Published addresses of code systems, identifier systems and extensions.
SNOMED = "http://snomed.info/sct"
LOINC = "http://loinc.org"
UCUM = "http://unitsofmeasure.org"
RXNORM = "http://www.nlm.nih.gov/research/umls/rxnorm"
ICD10_CM = "http://hl7.org/fhir/sid/icd-10-cm"
ICD10 = "http://hl7.org/fhir/sid/icd-10"
ICD9_CM = "http://hl7.org/fhir/sid/icd-9-cm"
ICD10_PCS = "http://www.cms.gov/Medicare/Coding/ICD10"
NDC = "http://hl7.org/fhir/sid/ndc"
CVX = "http://hl7.org/fhir/sid/cvx"
CPT = "http://www.ama-assn.org/go/cpt"
HCPCS = "https://www.cms.gov/Medicare/Coding/HCPCSReleaseCodeSets"
CDT = "http://www.ada.org/cdt"
NPI = "http://hl7.org/fhir/sid/us-npi"
SSN = "http://hl7.org/fhir/sid/us-ssn"
SOURCE_SYSTEM = "https://github.com/synthetichealth/synthea"
CLAIM_ID_SYSTEM = "https://bluebutton.cms.gov/resources/variables/clm_id"
BIRTH_SEX = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-birthsex"
RACE = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-race"
ETHNICITY = "http://hl7.org/fhir/us/core/StructureDefinition/us-core-ethnicity"
GEOLOCATION = "http://hl7.org/fhir/StructureDefinition/geolocation"
LINE_SUBMITTED = "https://bluebutton.cms.gov/resources/variables/line_sbmtd_chrg_amt"
LINE_ALLOWED = "https://bluebutton.cms.gov/resources/variables/line_alowd_chrg_amt"
LINE_PAID = "https://bluebutton.cms.gov/resources/variables/line_prvdr_pmt_amt"
LINE_COINSURANCE = "https://bluebutton.cms.gov/resources/variables/line_coinsrnc_amt"
LINE_DEDUCTIBLE = "https://bluebutton.cms.gov/resources/variables/line_bene_ptb_ddctbl_amt"

# Short names of code systems.
CODE_SYSTEM_NAMES = {
    SNOMED: "snomed-ct",
    ICD10_CM: "icd-10-cm",
    ICD10: "icd-10-cm",
    ICD9_CM: "icd-9-cm",
    ICD10_PCS: "icd-10-pcs",
    LOINC: "loinc",
    RXNORM: "rxnorm",
    NDC: "ndc",
    CVX: "cvx",
    CPT: "hcpcs",
    HCPCS: "hcpcs",
    CDT: "cdt",
}


def translate(c: Column, names: dict[str, str]) -> Column:
    """Look a value up in a fixed table; null when it is not there."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(names.items())])
    return F.try_element_at(table, c)


def code_system(c: Column) -> Column:
    """Short name of a code system address; an unknown address stays as it is."""
    return F.coalesce(translate(c, CODE_SYSTEM_NAMES), c)
