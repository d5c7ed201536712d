"""SQL of the models, for DuckDB: most from the given tables themselves, as facts of their rows,
the others (patients, immunizations, practitioners) over the flat SQL of :mod:`checks.records`."""

from __future__ import annotations

from checks.records import FLAT_SQL, TERMINOLOGY_SQL
from clinflat.functions import codes

STAMP = "2026-01-02 03:04:05"
RUN_COLUMNS = f"timestamp '{STAMP}' as ingest_datetime, 'checks' as data_source"
SLOTS = range(1, 26)


def day(c: str) -> str:
    return f"try_cast(substr({c}, 1, 10) as date)"


def moment(c: str) -> str:
    return f"try_cast(replace({c}, 'Z', '') as timestamp)"


def money_sum(c: str) -> str:
    return f"cast(sum(cast({c} as decimal(18, 4))) as double)"


def name_only(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '[0-9]+', '', 'g')), '')"


def system_name(c: str) -> str:
    pairs = ", ".join(f"('{k}', '{v}')" for k, v in codes.CODE_SYSTEM_NAMES.items())
    return f"coalesce((select v from (values {pairs}) as t(k, v) where k = {c}), {c})"


def nothing(names: str, dtype: str = "varchar") -> str:
    return ", ".join(f"cast(null as {dtype}) as {n}" for n in names.split())


# What the orders themselves say of the visit of each: by priority, the usual kind and the rarer one.
VISIT = """select o_orderkey, if(rare, rare_type, usual_type) as encounter_type,
  if(rare, rare_place, usual_place) as place_of_service_code, bill_type_code, revenue_center_code
from (select o_orderkey, o_orderpriority, case o_orderpriority when '2-HIGH' then o_orderkey % 9 = 0 when '3-MEDIUM' then o_orderkey % 7 = 0
        when '4-NOT SPECIFIED' then o_orderkey % 8 = 0 and o_orderkey % 9 <> 0 else false end as rare from orders)
join (values ('1-URGENT', 'emergency department', null, '23', null, '131', '0450'),
  ('2-HIGH', 'acute inpatient', 'inpatient substance use', '21', '21', '111', '0120'),
  ('3-MEDIUM', 'office visit', 'urgent care', '11', '20', '131', '0510'),
  ('4-NOT SPECIFIED', 'home health', 'outpatient hospice', '12', '12', '321', '0550'),
  ('5-LOW', 'telehealth', null, '02', null, '131', '0510'))
  as kinds(priority, usual_type, rare_type, usual_place, rare_place, bill_type_code, revenue_center_code) on priority = o_orderpriority"""

SETTING = "select e.*, v.* exclude (o_orderkey) from encounter e join visit v on e.id = 'enc-' || v.o_orderkey"

# Claims as the orders and their lines have them: customers of one remainder and every 23rd order are uninsured.
CLAIM = """select 'clm-' || o_orderkey as claim_id, cast(o_custkey as varchar) as person_id,
  ['professional', 'institutional', 'pharmacy'][o_orderkey % 3 + 1] as claim_type, payer, payer_type,
  if(o_orderkey % 2 = 0, 'Plan ' || (o_orderkey % 4), payer) as plan, coalesce(first_shipped, billed) as claim_start_date,
  coalesce(last_shipped, billed) as claim_end_date, billed as paid_date, if(seen, 'enc-' || o_orderkey, null) as encounter_id,
  if(seen, encounter_type, null) as encounter_type,
  if(seen, case o_orderpriority when '1-URGENT' then 'EMER' when '2-HIGH' then 'IMP' when '3-MEDIUM' then 'AMB'
    when '4-NOT SPECIFIED' then 'HH' else 'VR' end, null) as class_code,
  if(seen, place_of_service_code, null) as place_of_service_code, if(seen, bill_type_code, null) as bill_type_code,
  if(seen, revenue_center_code, null) as revenue_center_code, if(seen, cast(o_orderdate as date), null) as encounter_start_date,
  if(seen, billed, null) as encounter_end_date, if(seen and o_orderkey % 3 <> 0, 'home', null) as discharge_disposition_code,
  cast(o_orderkey % 120 as varchar) as provider_id, if(s_suppkey % 17 <> 0, 'N' || s_suppkey, null) as rendering_npi,
  'loc-' || (o_orderkey % 100) as facility_id,
  if(o_orderkey % 16 = 0, 1.5::double, if(o_orderkey % 8 = 0, null, o_totalprice)) as total_submitted, o_totalprice / 2 as payment_amount
from (select orders.*, first_shipped, last_shipped, cast(o_orderdate as date) + cast(o_orderkey % 5 as int) as billed,
        l_orderkey is not null or (o_orderkey % 3 < 2 and o_orderkey % 10 > 0) as seen
      from orders left join (select l_orderkey, min(cast(l_shipdate as date)) as first_shipped,
          max(cast(l_shipdate as date) + 2 * (l_linenumber % 2)) as last_shipped from lineitem group by l_orderkey) on l_orderkey = o_orderkey)
join (values (0, 'Medicare', 'medicare'), (1, 'Medicaid', 'medicaid'), (3, 'Dual Eligible', 'medicare'), (4, 'Acme Health', 'commercial'))
  as payers(remainder, payer, payer_type) on remainder = o_custkey % 5
join visit using (o_orderkey) left join supplier on s_suppkey = o_orderkey % 120
where o_orderkey % 23 <> 0"""

CODE_MAP = """select snomed_code, split_part(best, '|', 1) as icd10_code, split_part(best, '|', 2) as icd10_description from (
  select referenced_component_id as snomed_code,
    arg_min(replace(map_target, '.', '') || '|' || map_target_name, (cast(map_group as integer), cast(map_priority as integer))) as best
  from diagnosis_map where active = '1' and map_target <> '' and upper(map_rule) in ('TRUE', 'OTHERWISE TRUE') group by 1)"""

PACKAGE_MAP = """select rxnorm_code, lpad(arg_min(ndc11, (active <> 'true', ndc11)), 11, '0') as ndc_code from (
  select unnest([drug_id, clinical_drug_id]) as rxnorm_code, ndc11, active from drug_packages where ndc11 is not null) group by 1"""

DX = """select 'clm-' || l_orderkey as claim_id, cast(l_linenumber as bigint) * 10 as sequence, if(l_suppkey % 2 = 0, 'Y', null) as on_admission_code,
  if(p_partkey % 10 = 0, 'E11' || (p_partkey % 90), (select icd10_code from code_map where snomed_code = cast(p_partkey % 700 as varchar))) as icd10_code
from lineitem left join part on p_partkey = l_partkey
union all
select 'clm-' || l_orderkey, l_linenumber * 10 + 1, 'N', 'J45' || (l_partkey % 30) from lineitem where l_suppkey % 3 = 0"""

RANKED = """select claim_id, icd10_code, on_admission_code,
  row_number() over (partition by claim_id order by sequence, icd10_code, on_admission_code nulls last) as diagnosis_rank
from dx where icd10_code is not null"""

DX_COLUMNS = (
    "select claim_id, "
    + ", ".join(f"c[{k}] as diagnosis_code_{k}" for k in SLOTS)
    + ", "
    + ", ".join(f"p[{k}] as diagnosis_poa_{k}" for k in SLOTS)
    + " from (select claim_id, list(icd10_code order by diagnosis_rank) as c, list(on_admission_code order by diagnosis_rank) as p"
    " from ranked group by claim_id)"
)

# Customers are born up to 1994, every 50th without a known day; every tenth dies on one day of 2000.
SPANS = """select person_id, payer, payer_type, plan,
  if(c_custkey % 50 <> 0 and year(born) = yr, born, make_date(yr, 1, 1)) as enrollment_start_date,
  if(c_custkey % 10 = 0 and yr = 2000, date '2000-06-15', make_date(yr, 12, 31)) as enrollment_end_date
from (select distinct person_id, payer, payer_type, plan, year(claim_start_date) as yr from claim)
join (select c_custkey, date '1940-01-01' + cast(c_custkey % 20000 as int) as born from customer) on person_id = cast(c_custkey as varchar)
where yr >= if(c_custkey % 50 = 0, 1900, year(born)) and (c_custkey % 10 <> 0 or yr <= 2000)"""

PATIENT_TABLE = f"""select id as person_id, id as patient_id, {name_only("given_name")} as first_name,
  {name_only("middle_name")} as middle_name, {name_only("family_name")} as last_name, name_suffix,
  case when gender in ('male', 'female') then gender else 'unknown' end as sex,
  coalesce((select v from (values ('2106-3', 'white'), ('2054-5', 'black or african american'), ('2028-9', 'asian'),
    ('1002-5', 'american indian or alaska native'), ('2076-8', 'native hawaiian or other pacific islander'),
    ('2131-1', 'other race')) t(k, v) where k = race_code), 'unknown') as race,
  coalesce((select v from (values ('2135-2', 'Hispanic or Latino'), ('2186-5', 'Not Hispanic or Latino')) t(k, v) where k = ethnicity_code), 'unknown') as ethnicity,
  {day("birth_date")} as birth_date, {day("deceased_datetime")} as death_date,
  cast(coalesce(deceased_flag, false) as integer) as death_flag, ssn as social_security_number, address_line as address,
  city, state, postal_code as zip_code, {nothing("county")}, cast(latitude as float) as latitude,
  cast(longitude as float) as longitude, phone, email, {RUN_COLUMNS} from patient"""

# An order is a visit; it has costs where its own claim is insured, no pharmacy claim, and names the visit itself or by a line.
ENCOUNTER_TABLE = f"""select 'enc-' || o_orderkey as encounter_id, cast(o_custkey as varchar) as person_id, cast(o_custkey as varchar) as patient_id,
  encounter_type, began as encounter_start_date, began + cast(o_orderkey % 5 as int) as encounter_end_date,
  if(o_orderkey % 5 = 0, 'emd', null) as admit_source_code, if(o_orderkey % 3 = 0, null, 'home') as discharge_disposition_code,
  cast(o_orderkey % 120 as varchar) as attending_provider_id, 'Dr. Name' as attending_provider_name,
  if(o_orderkey % 6 = 0, 'Provider', 'Loc ' || (o_orderkey % 100)) as facility_name,
  if(o_orderkey % 3 = 0, 'snomed-ct', null) as primary_diagnosis_code_type, if(o_orderkey % 3 = 0, cast(o_orderkey % 700 as varchar), null) as primary_diagnosis_code,
  paid as paid_amount, paid as allowed_amount, case when paid is null or o_orderkey % 16 = 8 then null when o_orderkey % 16 = 0 then 1.5 else o_totalprice end as charge_amount,
  {nothing("admit_type_code facility_npi drg_code_type drg_code")}, {RUN_COLUMNS}
from (select orders.*, cast(o_orderdate as date) as began,
        if(o_orderkey % 3 < 2 and o_custkey % 5 <> 2 and o_orderkey % 23 > 0 and (o_orderkey % 10 > 0 or o_orderkey in (select l_orderkey from lineitem)),
           o_totalprice / 2, null) as paid from orders) join visit using (o_orderkey)"""

# A part is a condition, every 13th in error; the day it began is known for seven of nine.
CONDITION_TABLE = f"""select 'cond-' || p_partkey as source_condition_id, cast(p_partkey % 150 as varchar) as person_id, cast(p_partkey % 150 as varchar) as patient_id,
  'enc-' || p_partkey as encounter_id, if(p_partkey % 4 > 0, make_date(2002, 1, 10 + p_partkey % 10), began) as recorded_date, began as onset_date,
  if(p_partkey % 5 = 0, date '2003-02-03', null) as resolved_date, 'active' as status, ['problem', 'discharge diagnosis', 'discharge diagnosis'][p_partkey % 3 + 1] as condition_type,
  if(p_partkey % 10 = 0, 'icd-10-cm', 'snomed-ct') as code_system, if(p_partkey % 10 = 0, 'E11.' || (p_partkey % 90), cast(p_partkey % 700 as varchar)) as source_code,
  [p_name, p_type, p_name, null, p_name, p_type][p_partkey % 6 + 1] as source_description, cast(null as integer) as condition_rank,
  {nothing("present_on_admit_code")}, {RUN_COLUMNS}
from (select *, if(p_partkey % 9 < 2, null, make_date(2001, 3, 1 + p_partkey % 9)) as began from part where p_partkey % 13 > 0)"""

PROCEDURE_TABLE = f"""select 'proc-' || o_orderkey as source_procedure_id, cast(o_custkey as varchar) as person_id, cast(o_custkey as varchar) as patient_id,
  if(o_orderkey % 9 = 0, null, 'enc-' || o_orderkey) as encounter_id, cast(o_orderdate as date) as procedure_date,
  ['hcpcs', 'snomed-ct', 'urn:other'][o_orderkey % 3 + 1] as code_system, cast(o_orderkey % 300 as varchar) as source_code,
  'Procedure ' || (o_orderkey % 300) as source_description, cast(o_orderkey % 120 as varchar) as practitioner_id,
  {nothing("modifier_1 modifier_2 modifier_3 modifier_4 modifier_5")}, {RUN_COLUMNS}
from orders where o_orderkey % 11 > 0 and o_orderkey % 17 > 0"""

# An event is one observation, but a purchase, which is two or three components.
OBSERVATION_TABLE = f"""select 'obs-' || event_id || coalesce('-' || o.part, '') as observation_id, cast(user_id as varchar) as person_id,
  cast(user_id as varchar) as patient_id, 'enc-' || (event_id % 100) as encounter_id,
  if(o.part is null, null, 'obs-' || event_id) as panel_id, if(event_id % 20 = 0, null, cast(ts as date)) as observation_date,
  case when event_type in ('view', 'purchase') then 'vital-signs' when event_type = 'click' then 'social-history' else 'other' end as observation_type,
  'loinc' as source_code_type, o.code as source_code, o.display as source_description, o.result, o.unit as source_units,
  {nothing("normalized_units normalized_reference_range_low normalized_reference_range_high")},
  if(event_id % 3 = 0 and o.part is null, cast(cast(event_id % 50 as double) as varchar), null) as source_reference_range_low,
  if(event_id % 3 = 0 and o.part is null, cast(event_id % 50 + 100.5::double as varchar), null) as source_reference_range_high, {RUN_COLUMNS}
from (select *, unnest(case when event_type = 'purchase' then list_slice([
    {{'part': 0, 'code': '8480-6', 'display': 'Systolic', 'result': cast(try_cast(regexp_extract(props, '[0-9]+', 0) as double) as varchar), 'unit': 'mmHg'}},
    {{'part': 1, 'code': '8462-4', 'display': 'Diastolic', 'result': cast(value as varchar), 'unit': 'mm'}},
    {{'part': 2, 'code': 'x', 'display': null, 'result': '77', 'unit': null}}], 1, 3 - event_id % 2)
  else [{{'part': null, 'code': cast(event_id % 60 as varchar), 'display': 'Test ' || (event_id % 60),
    'result': case event_type when 'view' then cast(value as varchar) when 'click' then props when 'signup' then cast(event_id % 3 = 0 as varchar) end,
    'unit': case when event_type = 'view' then if(event_id % 3 = 0, 'mg_code', 'mg') end}}] end) as o
  from events where event_type <> 'error')"""

# An error is a laboratory result; its panel is its own report, or the one before if that lists it too and comes first as text.
LAB_TABLE = f"""select 'obs-' || e.event_id as lab_result_id, cast(e.user_id as varchar) as person_id, cast(e.user_id as varchar) as patient_id,
  'enc-' || (e.event_id % 100) as encounter_id, 'rep-' || panel as accession_number, if(panel % 5 = 0, 'urn:other', 'loinc') as source_order_type,
  cast(panel % 12 as varchar) as source_order_code, 'Panel ' || (panel % 12) as source_order_description, 'loinc' as source_component_type,
  cast(e.event_id % 60 as varchar) as source_component_code, 'Test ' || (e.event_id % 60) as source_component_description, 'final' as status,
  if(e.event_id % 2 = 0, cast(e.value as varchar), 'Positive') as result, taken as result_datetime, taken as collection_datetime,
  case e.event_id % 6 when 0 then 'mg_code' when 2 then 'mg' when 4 then 'mg' end as source_units, if(e.event_id % 4 = 0, 'H', null) as source_abnormal_code,
  if(e.event_id % 3 = 0, cast(cast(e.event_id % 50 as double) as varchar), null) as source_reference_range_low,
  if(e.event_id % 3 = 0, cast(e.event_id % 50 + 100.5::double as varchar), null) as source_reference_range_high,
  {nothing("normalized_units normalized_reference_range_low normalized_reference_range_high normalized_abnormal_code specimen ordering_practitioner_id")}, {RUN_COLUMNS}
from (select events.*, if(event_id % 20 = 0, null, cast(date_trunc('second', ts) as timestamp)) as taken,
        if(event_id % 3 = 1 and 'rep-' || (event_id - 1) < 'rep-' || event_id and event_id - 1 in (select event_id from events), event_id - 1, event_id) as panel
      from events where event_type = 'error') e"""

# Even orders name their drug, odd ones a part.
MEDICATION_TABLE = f"""select 'mr-' || o_orderkey as medication_id, cast(o_custkey as varchar) as person_id, cast(o_custkey as varchar) as patient_id,
  'enc-' || o_orderkey as encounter_id, cast(null as date) as dispensing_date, cast(o_orderdate as date) as prescribing_date,
  if(known, 'rxnorm', if(known is null, null, 'snomed-ct')) as source_code_type, drug as source_code, label as source_description, ndc_code,
  if(known, drug, null) as rxnorm_code, {nothing("atc_code route strength quantity_unit")}, cast(o_orderkey % 90 as double) as quantity,
  if(o_orderkey % 5 = 0, 30::double, null) as days_supply, cast(o_orderkey % 120 as varchar) as practitioner_id, {RUN_COLUMNS}
from (select *, true as known, cast(o_orderkey % 900 as varchar) as drug, 'Drug ' || (o_orderkey % 900) as label from orders where o_orderkey % 2 = 0
      union all
      select orders.*, p_partkey % 5 > 0, cast(p_partkey % 700 as varchar), if(p_partkey % 3 = 0, p_name, if(p_partkey % 6 = 1, null, p_type))
      from orders left join part on p_partkey = o_orderkey % 230 where o_orderkey % 2 = 1)
left join package_map on known and rxnorm_code = drug"""

IMMUNIZATION_TABLE = f"""select id as immunization_id, patient_id as person_id, patient_id, encounter_id, {system_name("vaccine_system")} as source_code_type,
  vaccine_code as source_code, vaccine_display as source_description, status, status_reason_code as status_reason,
  {day("occurrence_datetime")} as occurrence_date, cast(dose_quantity as varchar) as source_dose, lot_number, site_code as body_site,
  route_code as route, location_id, practitioner_id, {RUN_COLUMNS} from immunization"""

# A supplier belongs to its nation, to the next one, to both, or to none.
LOCATION_TABLE = f"""select 'loc-' || s_suppkey as location_id, if(n_nationkey % 4 > 0, '9' || n_nationkey, null) as npi, s_name as name, n_name as parent_organization,
  '1 ' || s_name || ', Floor 1' as address, 'City' as city, 'ST' as state, '1' as zip_code, cast(s_acctbal / 64 as float) as latitude,
  cast(s_acctbal / 128 as float) as longitude, {nothing("facility_type")}, {RUN_COLUMNS}
from (select *, unnest(if(len(owners) = 0, [null], owners)) as owner from (select supplier.*, list_distinct(case when s_suppkey % 10 = 9 then []
        when s_suppkey % 2 = 1 then [(s_nationkey + 1) % 25] when s_suppkey % 12 = 0 then [s_nationkey, (s_nationkey + 1) % 25] else [s_nationkey] end) as owners from supplier))
left join nation on n_nationkey = owner"""

PRACTITIONER_TABLE = f"""select p.id as practitioner_id, p.npi, {name_only("p.given_name")} as first_name, {name_only("p.family_name")} as last_name,
  r.best[2] as practice_affiliation, lower(r.best[1]) as specialty, {nothing("sub_specialty")}, {RUN_COLUMNS}
from practitioner p left join (select practitioner_npi, min([specialty_display, organization_name]) as best
  from practitioner_role group by practitioner_npi) r on r.practitioner_npi = p.npi"""

ELIGIBILITY = f"""select person_id, person_id as member_id, person_id as subscriber_id, 'self' as subscriber_relation, spans.* exclude (person_id),
  if(c_custkey % 11 > 0, 'Ann', ['Olive', 'Nicky'][c_custkey % 2 + 1]) as first_name, if(c_custkey % 11 > 0 and c_custkey % 4 > 0, 'Bea', null) as middle_name,
  if(c_custkey % 11 > 0, rtrim(c_name, '0123456789'), ['Old', 'Nick'][c_custkey % 2 + 1]) as last_name, if(c_custkey % 11 > 0 and c_custkey % 9 = 0, 'PhD', null) as name_suffix,
  '999-' || c_custkey as social_security_number,
  nullif(concat_ws(', ', if(c_custkey % 6 = 0, null, c_custkey || ' Main St'), if(c_custkey % 12 > 6, 'Apt 2', null)), '') as address,
  c_mktsegment as city, 'S' || c_nationkey as state, lpad(cast(c_custkey as varchar), 5, '0') as zip_code, '555-' || c_custkey as phone,
  if(c_custkey % 2 = 0, c_custkey || '@x.org', null) as email, ['Hispanic or Latino', 'Not Hispanic or Latino', 'unknown'][c_nationkey % 3 + 1] as ethnicity,
  ['male', 'female', 'unknown'][c_custkey % 3 + 1] as sex,
  ['white', 'black or african american', 'asian', 'american indian or alaska native', 'native hawaiian or other pacific islander', 'other race', 'unknown'][c_nationkey % 7 + 1] as race,
  if(c_custkey % 50 = 0, null, date '1940-01-01' + cast(c_custkey % 20000 as int)) as birth_date, if(c_custkey % 10 = 0, date '2000-06-15', null) as death_date,
  cast(c_custkey % 10 < 2 as integer) as death_flag, cast(payer = 'Medicaid' as integer) as medicaid_indicator, 'fhir:ExplanationOfBenefit' as file_name,
  {nothing("original_reason_entitlement_code dual_status_code medicare_status_code enrollment_status part_d_raf_type metal_level group_id group_name")},
  {nothing("hospice_flag institutional_snp_flag long_term_institutional_flag low_income_subsidy_indicator csr_indicator enrollment_duration_months esrd_status transplant_duration_months", "integer")},
  cast(null as date) as file_date, {RUN_COLUMNS}
from spans join customer on person_id = cast(c_custkey as varchar)"""

# Lines of the other two thirds of the orders, each standing for one to three claim lines.
MEDICAL = f"""select claim_id, cast(l_linenumber * 10 + part as integer) as claim_line_number, claim_type, person_id, person_id as member_id, payer, plan,
  claim_start_date, claim_end_date, cast(l_shipdate as date) as claim_line_start_date, cast(l_shipdate as date) + cast(l_linenumber % 2 * 2 as int) as claim_line_end_date,
  if(stay, encounter_start_date, null) as admission_date, if(stay, encounter_end_date, null) as discharge_date, if(stay, 'home', null) as discharge_disposition_code,
  if(l_orderkey % 3 = 0, place_of_service_code, null) as place_of_service_code, if(l_orderkey % 3 = 1, bill_type_code, null) as bill_type_code,
  if(l_orderkey % 3 = 1, revenue_center_code, null) as revenue_center_code, l_quantity / 2 as service_unit_quantity,
  if((l_suppkey + part) % 2 = 0, cast((l_partkey + part) % 900 as varchar), null) as hcpcs_code, rendering_npi, rendering_npi as billing_npi, paid_date,
  cast(if(l_suppkey % 7 = 0, 0, l_extendedprice - l_quantity - part) as float) as paid_amount, cast(l_extendedprice - l_quantity as float) as allowed_amount,
  cast(l_extendedprice + if(l_suppkey % 3 = 0, 0, 1) as float) as charge_amount, cast(l_quantity as float) as coinsurance_amount,
  cast(null as float) as copayment_amount, cast(if(l_suppkey % 5 = 0, l_quantity / 4, null) as float) as deductible_amount,
  cast(l_extendedprice - l_quantity as float) as total_cost_amount, if(codes.claim_id is null, null, 'icd-10-cm') as diagnosis_code_type, codes.* exclude (claim_id),
  {nothing("admit_source_code admit_type_code drg_code_type drg_code rendering_tin billing_tin facility_npi procedure_code_type")},
  {nothing("hcpcs_modifier_1 hcpcs_modifier_2 hcpcs_modifier_3 hcpcs_modifier_4 hcpcs_modifier_5")},
  {nothing(" ".join(f"procedure_code_{k}" for k in SLOTS))}, {nothing(" ".join(f"procedure_date_{k}" for k in SLOTS), "date")},
  1 as in_network_flag, 'fhir:ExplanationOfBenefit' as file_name, cast(null as date) as file_date, {RUN_COLUMNS}
from (select *, unnest(range(l_partkey % 3 + 1)) as part from lineitem where l_orderkey % 3 < 2)
join (select *, claim_type = 'institutional' and class_code = 'IMP' as stay, claim_id as of_claim from claim) c on of_claim = 'clm-' || l_orderkey
left join dx_columns codes using (claim_id)"""

# Every third order is filled at a pharmacy; each of its lines stands for one to three claim lines.
PHARMACY = f"""select claim_id, cast(l_linenumber * 10 + part as integer) as claim_line_number, person_id, person_id as member_id, payer, plan,
  rendering_npi as prescribing_provider_npi, {nothing("dispensing_provider_npi")}, cast(l_shipdate as date) as dispensing_date, ndc_code,
  cast(l_quantity / 2 as integer) as quantity, 30 as days_supply, 0 as refills, paid_date,
  cast(if(l_suppkey % 7 = 0, payment_amount, l_extendedprice - l_quantity - part) as float) as paid_amount,
  cast(l_extendedprice - l_quantity as float) as allowed_amount,
  cast(l_extendedprice + if(l_suppkey % 3 = 0, 0, 1) as float) as charge_amount, cast(l_quantity as float) as coinsurance_amount,
  cast(null as float) as copayment_amount, cast(if(l_suppkey % 5 = 0, l_quantity / 4, null) as float) as deductible_amount,
  1 as in_network_flag, 'fhir:ExplanationOfBenefit' as file_name, cast(null as date) as file_date, {RUN_COLUMNS}
from (select *, unnest(range(l_partkey % 3 + 1)) as part from lineitem where l_orderkey % 3 = 2)
join claim on claim_id = 'clm-' || l_orderkey left join package_map on rxnorm_code = cast((l_partkey + part) % 900 as varchar)"""

MONTHS = """select distinct person_id, strftime(m, '%Y%m') as year_month from (
  select person_id, unnest(generate_series(date_trunc('month', enrollment_start_date), date_trunc('month', enrollment_end_date), interval 1 month)) as m from spans)"""

PMPM = f"""select k.yr as year, k.n as member_months, coalesce(q.paid, 0) as paid, coalesce(q.paid, 0) / k.n as pmpm
from (select year_month[:4] as yr, count(*) as n from months group by 1) k
left join (select cast(year(claim_start_date) as varchar) as yr, {money_sum("paid_amount")} as paid from medical group by 1) q on q.yr = k.yr
where k.yr between '1995' and '2001'"""

PATIENT_SET = """select person_id, sex, race, ethnicity, cast(date_sub('year', birth_date, date '2001-12-31') as integer) as age,
  (date_sub('year', birth_date, date '2001-12-31') // 10 * 10) || '-' || (date_sub('year', birth_date, date '2001-12-31') // 10 * 10 + 9) as age_group,
  death_flag, state from patient_table"""
CLAIM_SET = """select claim_id, person_id, claim_type, payer, claim_type as service_category_1,
  coalesce(place_of_service_code, bill_type_code) as service_category_2, claim_start_date, paid_amount, allowed_amount from medical"""
ENCOUNTER_SET = """select encounter_id, person_id, encounter_type, encounter_start_date,
  cast(encounter_end_date - encounter_start_date as integer) as length_of_stay, paid_amount from encounter_table"""
CONDITION_SET = """select person_id, condition_type as condition_family, source_description as condition_name
from condition_table where source_description is not null"""

# Parts in an order in which each may use the ones before it.
PARTS = {
    **FLAT_SQL,
    **TERMINOLOGY_SQL,
    "visit": VISIT,
    "setting": SETTING,
    "claim": CLAIM,
    "code_map": CODE_MAP,
    "package_map": PACKAGE_MAP,
    "dx": DX,
    "ranked": RANKED,
    "dx_columns": DX_COLUMNS,
    "spans": SPANS,
    "patient_table": PATIENT_TABLE,
    "encounter_table": ENCOUNTER_TABLE,
    "condition_table": CONDITION_TABLE,
    "medical": MEDICAL,
    "pharmacy": PHARMACY,
    "months": MONTHS,
    "pmpm": PMPM,
    "patient_set": PATIENT_SET,
    "claim_set": CLAIM_SET,
    "encounter_set": ENCOUNTER_SET,
    "condition_set": CONDITION_SET,
}
USES = {
    "setting": ["encounter", "visit"],
    "claim": ["visit"],
    "code_map": ["diagnosis_map"],
    "package_map": ["drug_packages"],
    "dx": ["code_map"],
    "ranked": ["dx"],
    "dx_columns": ["ranked"],
    "spans": ["claim"],
    "patient_table": ["patient"],
    "encounter_table": ["visit"],
    "medical": ["claim", "dx_columns"],
    "pharmacy": ["claim", "package_map"],
    "months": ["spans"],
    "pmpm": ["months", "medical"],
    "patient_set": ["patient_table"],
    "claim_set": ["medical"],
    "encounter_set": ["encounter_table"],
    "condition_set": ["condition_table"],
}


def sql_with(uses: str, body: str) -> str:
    """``body`` with the parts it uses, and theirs, as common table expressions."""
    needed: set[str] = set()

    def add(name: str) -> None:
        if name not in needed:
            needed.add(name)
            for other in USES.get(name, []):
                add(other)

    for name in uses.split():
        add(name)
    ctes = ",\n".join(f"{n} as (\n{PARTS[n]}\n)" for n in PARTS if n in needed)
    return f"with {ctes}\n{body}" if ctes else body
