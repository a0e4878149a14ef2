"""Star-schema test tables seen as clinical source tables.

Every source is one SELECT whose text serves Spark SQL and other SQL engines alike; only the
timestamp type and the digest that makes row ids differ by dialect. Facts read whole tables and
keep every row; codes are spread over the rows by the table's own keys.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..operators.sizing import tune
from ..sources.stage import staged
from ..sources.study import Study

SITE = "north"
FLOOR = date(1998, 1, 1)
TODAY = date(2024, 6, 1)

RAW_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split()


def literal(v: object) -> str:
    if v is None:
        return "null"
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def pick(expr: str, values: Sequence[object]) -> str:
    """Spread a list of values (None = NULL) over the rows by an integer expression."""
    arms = " ".join(f"when {i} then {literal(v)}" for i, v in enumerate(values))
    return f"case ({expr}) % {len(values)} {arms} end"


def rows(columns: str, *values: Sequence[object], casts: Mapping[str, str] | None = None) -> str:
    """A small table of fixed rows."""
    names = columns.split()
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in values)
    outs = ", ".join(f"cast({n} as {(casts or {}).get(n, 'string')}) as {n}" for n in names)
    return f"select {outs} from (values {body}) as t({', '.join(names)})"


# Value-set map of the test study: class, target, label, source, description, value.
_MAP = [
    ("Gender", "M", None, "8507", None, None), ("Gender", "F", None, "8532", None, None),
    ("Gender", "NI", None, None, None, None),
    ("Hispanic", "Y", None, "38003563", None, None), ("Hispanic", "N", None, "38003564", None, None),
    ("Race", "05", None, "8527", None, None), ("Race", "03", None, "8516", None, None),
    ("Race", "NI", None, None, None, None), ("Race", "UN", None, None, None, None),
    ("Language", "ENG", None, "4180186", None, None), ("Language", "SPA", None, "4182511", None, None),
    ("Encounter type", "IP", None, "9201", None, None), ("Encounter type", "ED", None, "9203", None, None),
    ("Encounter type", "AV", None, "9202", None, None), ("Encounter type", "EI", None, "2000000048", None, None),
    ("Discharge disposition", "A", None, None, None, "4161979"),
    ("Discharge disposition", "E", None, None, None, "4216643"),
    ("Discharge status", "EX", None, "4216643", None, None), ("Discharge status", "HO", None, "8536", None, None),
    ("Admitting source", "AV", None, "8977", None, None), ("Admitting source", "ED", None, "8870", None, None),
    ("Facility type", "HOSPITAL", None, "9201", "ward", "38004477"),
    ("Facility type", "CLINIC", None, "8756", "clinic", None), ("Facility type", "OFFICE", None, "8940", "office", None),
    ("Facility type", "EMERGENCY", None, "9203", "emergency", None),
    ("Payer", "2", None, "medicaid-hmo", None, None), ("Payer", "5", None, "private-ppo", None, None),
    ("Provider Specialty", "207K", None, "38004456", "Allergy", None),
    ("Provider Specialty", "208000", None, "", "General Pediatric Medicine", None),
    ("Provider Specialty", "2080P", None, "", "Pediatric Cardiology", None),
    ("dx_source", "DI", None, "38000201", None, None), ("dx_source", "AD", None, "2000000092", None, None),
    ("pdx", "P", None, "2000000092", None, None), ("pdx", "S", None, "38000201", None, None),
    ("pdx", "S", None, "38000230", None, None),
    ("dx origin", "OD", None, "38000201", None, None), ("dx origin", "OD", None, "38000230", None, None),
    ("dx origin", "OD", None, "2000000092", None, None), ("dx origin", "BI", None, "44786627", None, None),
    ("dx_poa", "Y", None, "4188539", None, None), ("dx_poa", "N", None, "4188540", None, None),
    ("Procedure Code Type", "CH", None, "CPT4", None, None), ("Procedure Code Type", "CH", None, "HCPCS", None, None),
    ("Procedure Code Type", "10", None, "ICD10PCS", None, None), ("Procedure Code Type", "09", None, "ICD9Proc", None, None),
    ("px source", "OD", None, "38000275", None, None), ("px source", "BI", None, "44786630", None, None),
    ("ppx", "P", None, "44786630", None, None),
    ("Death date impute", "N", None, "2000000034", None, None), ("Death date impute", "D", None, "2000000035", None, None),
    ("Lab priority", "R", None, "4044019", None, None), ("Lab priority", "S", None, "4210605", None, None),
    ("Result modifier", "EQ", None, "4172703", None, None), ("Result modifier", "GE", None, "4171755", None, None),
    ("Result modifier", "GT", None, "4172704", None, None), ("Result modifier", "LE", None, "4171754", None, None),
    ("Result modifier", "LT", None, "4171756", None, None), ("Result modifier", "OT", None, "44814649", None, None),
    ("Result modifier", "NO", None, "44814650", None, None), ("Result modifier", "OT", None, "4171754", None, None),
    ("Result unit", "mg/dL", None, "8840", None, None), ("Result unit", "/uL", None, "8647", None, None),
    ("Result unit", "OT", None, "8999", None, None), ("Result unit", "NI", None, "8998", None, None),
    ("Result unit", "UN", None, "8997", None, None),
    ("result_unit_source", "mmol/L", None, "mmol/l", None, None), ("result_unit_source", "U/L", None, "units", None, None),
    ("Result qualifier", "POSITIVE", None, "9191", None, None), ("Result qualifier", "NEGATIVE", None, "9189", None, None),
    ("Result qualifier", "HEAVY", None, "9190", None, None),
    ("Specimen concept", "BLD", None, "4001225", None, None), ("Specimen concept", "OT", None, "4001226", None, None),
    ("specimen_loinc", "URINE", None, "2756-5", None, None), ("specimen_source", "CSF", None, "spinal", None, None),
    ("specimen_source", "BLD", None, "whole blood", None, None),
    ("Dose unit", "mg", None, "8576", None, None), ("Dose unit", "mL", None, "8587", None, None),
    ("Route", "PO", None, "4132161", None, None), ("Route", "IV", None, "4112421", None, None),
    ("Rx Dose Form", "385055001", None, "19082573", None, None), ("Rx Dose Form", "385049006", None, "19082574", None, None),
    ("Rx Frequency", "01", None, "daily", None, None), ("Rx Frequency", "07", None, "as needed", None, None),
    ("dispense written", "Y", None, "4188539", None, None),
    ("imm_body_site", "LA", None, "4300192", None, None), ("imm_body_site", "RA", None, "4309106", None, None),
    ("imm_body_site_source", "LT", None, "left thigh", None, None),
    ("imm_body_site_source", "RT", None, "right thigh", None, None),
    ("vx_manufacturer", "MSD", None, "17", None, None),
    ("vx_manufacturer_source", "PFR", "Pfizer, Inc", None, None, None),
    ("vx_manufacturer_source", "MOD", "Moderna US, Inc.", None, None, None),
    ("abnormal_indicator", "AB", None, "9191", None, None), ("abnormal_indicator", "AL", None, "42536422", None, None),
    ("BP Position", "01", None, "3018586", None, None), ("BP Position", "02", None, "3035856", None, None),
    ("address_preferred", "N", None, "4188540", None, None), ("address_type", "PO", None, "4083586", None, None),
    ("address_state", "PA", "PA=Pennsylvania", None, None, None), ("address_state", "TX", "TX=Texas", None, None, None),
    ("tobacco", "01", None, None, None, "4298794"), ("tobacco", "02", None, None, None, "4144272"),
    ("tobacco type", "01", None, None, None, "42530756"), ("smoking", "04", None, None, None, "4209585"),
    ("smoking", None, None, None, None, "4209006"),
    ("datamart_name", "North General", None, SITE, None, None), ("datamart_id", "N01", None, SITE, None, None),
]

# Complaint map of the test study.
_COMPLAINTS = [
    ("Well Child", 3, 1, "routine visit", "Z00.1", "ICD10CM", "10"), ("fever", 2, 2, "fever", "R50.9", "ICD10CM", "10"),
    ("FEVER", 1, 2, "fever", "386661006", "SNOMED", "SM"), ("cough, dry", 1, 3, "cough", "49727002", "SNOMED", "SM"),
]

# Fixed part of the dictionary: id, code, name, vocabulary, class, domain, invalid_reason.
_CONCEPTS = [
    (3040464, "DRG", "group", "LOINC", "Survey", "Observation", None),
    (101, "001", "Transplant", "DRG", "MS-DRG", "Observation", None), (102, "002", "Heart", "DRG", "MS-DRG", "Observation", None),
    (103, "003", "Old", "DRG", "MS-DRG", "Observation", "D"), (104, "004", "Other", "DRG", "DRG", "Observation", None),
    (201, "386661006", "Fever", "SNOMED", "Clinical Finding", "Condition", None),
    (202, "49727002", "Cough", "SNOMED", "Clinical Finding", "Condition", None),
    (203, "840539006", "Epidemic disease", "SNOMED", "Clinical Finding", "Condition", None),
    (204, "X", "Short code", "SNOMED", "Clinical Finding", "Condition", None),
    (0, "No matching", "No matching concept", "None", "Undefined", "Metadata", None),
    (301, "780.6", "Fever", "ICD9CM", "4-dig billing code", "Condition", None),
    (302, "R50.9", "Fever", "ICD10CM", "4-char billing code", "Condition", None),
    (303, "J20.9", "Bronchitis", "ICD10", "ICD10 code", "Condition", None),
    (304, "U07.1", "Epidemic disease", "ICD10CM", "4-char billing code", "Condition", None),
    (305, "U07.1", "Epidemic disease", "ICD10", "ICD10 code", "Condition", None),
    (306, "B97.29", "Other agent", "ICD10CM", "billing code", "Condition", None),
    (307, "B97.21", "Named agent", "ICD10CM", "billing code", "Condition", None),
    (308, "079.82", "Named agent", "ICD9CM", "billing code", "Condition", None),
    (309, "4019", "Hypertension", "ICD9CM", "billing code", "Condition", None),
    (310, "R05", "Cough", "ICD10CM", "3-char billing code", "Condition", None),
    (44814649, "OTH", "Other", "Local", "Undefined", "Metadata", None),
    (38000201, "dx1", "Inpatient header", "Type", "Condition Type", "Type Concept", None),
    (38000230, "dx2", "Outpatient header", "Type", "Condition Type", "Type Concept", None),
    (2000000092, "dx3", "Admission", "Local", "Condition Type", "Type Concept", None),
    (44786627, "dx4", "Billing", "Type", "Condition Type", "Type Concept", None),
    (401, "99213", "Office visit", "CPT4", "CPT4", "Procedure", None), (402, "J1100", "Injection", "HCPCS", "HCPCS", "Procedure", None),
    (403, "0DTJ4ZZ", "Appendix", "ICD10PCS", "ICD10PCS", "Procedure", None), (404, "47.01", "Appendix", "ICD9Proc", "4-dig billing code", "Procedure", None),
    (405, "26", "Modifier", "CPT4", "CPT4 Modifier", "Procedure", None), (406, "0DT", "Group", "ICD10PCS", "2-dig nonbill code", "Procedure", None),
    (407, "80146002", "Appendix", "SNOMED", "Procedure", "Procedure", None),
    (501, "2345-7", "Glucose [Mass/volume] in Serum", "LOINC", "Lab Test", "Measurement", None),
    (502, "2746-6", "pH of Venous blood", "LOINC", "Lab Test", "Measurement", None),
    (503, "5811-5", "Specific gravity of Urine by Test strip", "LOINC", "Lab Test", "Measurement", None),
    (504, "751-8", "Neutrophils [#/volume] in Blood", "LOINC", "Lab Test", "Measurement", None),
    (505, "20584-9", "Leukocytes [#/volume] in Specimen", "LOINC", "Lab Test", "Measurement", None),
    (506, "2756-5", "pH of Urine by Test strip", "LOINC", "Lab Test", "Measurement", None),
    (507, "8310-5", "Body temperature", "LOINC", "Clinical Observation", "Measurement", None),
    (3020891, "8310-5", "Body temperature", "LOINC", "Clinical Observation", "Measurement", None),
    (3024171, "9279-1", "Respiratory rate", "LOINC", "Clinical Observation", "Measurement", None),
    (4172703, "=", "=", "SNOMED", "Qualifier Value", "Meas Value Operator", None),
    (4171756, "<", "<", "SNOMED", "Qualifier Value", "Meas Value Operator", None),
    (4172704, ">", ">", "SNOMED", "Qualifier Value", "Meas Value Operator", None),
    (3042924, "44250-9", "Little interest", "LOINC", "Survey", "Observation", None),
    (3045858, "44255-8", "Feeling down", "LOINC", "Survey", "Observation", None),
    (3042932, "55758-7", "Two item total score", "LOINC", "Survey", "Observation", None),
    (45883172, "LA6568-5", "Not at all", "LOINC", "Answer", "Meas Value", None),
    (45879886, "LA6569-3", "Several days", "LOINC", "Answer", "Meas Value", None),
    (724907, "208", "Vaccine, thirty mcg", "CVX", "CVX", "Drug", None), (724906, "207", "Vaccine, hundred mcg", "CVX", "CVX", "Drug", None),
    (702866, "212", "Vaccine, viral vector", "CVX", "CVX", "Drug", None), (701, "998", "No vaccine", "CVX", "CVX", "Drug", None),
    (702, "90686", "Influenza vaccine, split", "CPT4", "CPT4", "Drug", None), (703, "830464", "Vaccine product", "RxNorm Extension", "Clinical Drug", "Drug", None),
    (704, "48", "Hib", "CVX", "CVX", "Drug", None), (705, "115", "Tdap", "CVX", "CVX", "Drug", None),
    (711, "OD", "Ordered here", "Local", "Type", "Immunization Type", None), (712, "HS", "Historical record", "Local", "Type", "Immunization Type", None),
    (4044008, "129121000", "Tracheostomy tube", "SNOMED", "Physical Object", "Device", None),
    (4097216, "26412008", "Endotracheal tube", "SNOMED", "Physical Object", "Device", None),
    (4138614, "425826004", "Positive airway pressure unit", "SNOMED", "Physical Object", "Observation", None),
    (19082573, "317541", "Oral Tablet", "RxNorm", "Dose Form", "Drug", None), (19082574, "316968", "Oral Solution", "RxNorm", "Dose Form", "Drug", None),
    (19082575, "316949", "Injectable Solution", "RxNorm", "Dose Form", "Drug", None),
    (1367571, "5224", "heparin", "RxNorm", "Ingredient", "Drug", None), (967823, "9863", "sodium chloride", "RxNorm", "Ingredient", "Drug", None),
    (43011476, "1361029", "heparin product", "RxNorm", "Clinical Drug Form", "Drug", None),
    (42536422, "722496004", "E-cigarette user", "SNOMED", "Clinical Finding", "Condition", None),
]

_CONDITION_TEXTS = [
    "Fever|x|R50.9", "Cough|R05", "Epidemic|y|U07.1", "Agent|y|b97.2_", "Lead|z|,I10,J20", "None|NOD.X|R05",
    "Long|a|R50.9 and much more text", "|q| J20.9 ", None, "Agent|y|079.82", "Many|a|B97.2%"]
_RESULT_TEXTS = ["Not Detected", "yellow", "NONREACTIVE", "O negative", "1+", "", "trace ketones", "see Comment", None,
                 "inconclusive", "Slightly Cloudy", "17.5"]
_UNITS = ["mg/dL", "/100 WBC", "mmol/l", "MMOL/L", "Seconds", "cells/uL", None, "mEq/L", "weird", "u/l", "K/mm3"]
_DRUG_TEXTS = ["aspirin 81 mg|PO", "similac formula|PO", "HEPARIN 1 UNIT/ML|IV", "Sodium Chloride 0.9 % | IV", "omega-3 fish oil|PO",
               "heparin 2 unit/ml|IV", None, "\"quoted\" drug|x", "heparin 100 units/ml flush|IV", "kit for test|x"]
_VACCINE_TEXTS = ["Flu|x|y", "HIB (PRP-T) vaccine", "Moderna COVID-19|", "something|  998 |z", "Tdap vaccine", None, "unlisted thing"]
_VITALS = [3023540, 3013762, 3038553, 3018586, 3034703, 3035856, 3019962, 3036277, 3025315]


def sources(spark_dialect: bool) -> dict[str, str]:
    """SELECT text of every source table; table names stand for the raw tables or other sources."""
    ts = "timestamp_ntz" if spark_dialect else "timestamp"

    def digest(text: str) -> str:
        hexed = f"substring(md5({text}), 1, 15)"
        return f"cast(conv({hexed}, 16, 10) as bigint)" if spark_dialect else f"cast(('0x' || {hexed}) as bigint)"

    def text(c: str) -> str:
        return f"cast({c} as string)"

    def at(day: str, hour: int, minute: int = 0) -> str:
        return f"cast({day} as {ts}) + interval {hour * 60 + minute} minutes"

    quantity = "cast(l_quantity as bigint)"
    line = " || '-' || ".join(text(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    operators = [4172703, 4171755, None, 4172704, 4171754, 0, 4171756, 44814649]
    out: dict[str, str] = {
        "value_map": rows("source_class target_code target_label source_code description value_code", *_MAP),
        "complaint_map": rows("complaint_text row_count concept_id concept_name concept_code vocabulary_id code_type",
                              *_COMPLAINTS, casts={"row_count": "int", "concept_id": "bigint"}),
        "line_facts": f"""
            select /*+ shuffle_hash(o) */ {digest(line)} as fact_id, l_orderkey, l_partkey, l_suppkey, l_linenumber, {quantity} as qty,
                l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, cast(l_shipdate as date) as ship_date,
                o_custkey, o_orderdate, cast(o_orderdate as date) as order_date
            from lineitem join orders as o on l_orderkey = o_orderkey""",
        "person": f"""
            select c_custkey as person_id, 1950 + c_custkey % 50 as year_of_birth,
                case when c_custkey % 11 = 0 then null else 1 + c_custkey % 12 end as month_of_birth,
                case when c_custkey % 13 = 0 then null else 1 + c_custkey % 28 end as day_of_birth,
                cast('1970-01-01' as date) + cast(c_custkey % 10000 as int) as birth_date,
                case when c_custkey % 3 = 0 then null else {at("cast('1970-01-01' as date) + cast(c_custkey % 10000 as int)", 5, 7)} end as birth_datetime,
                {pick("c_custkey", [8507, 8532, None, 8551])} as gender_concept_id,
                {pick("c_custkey + 1", [38003563, 38003564, None])} as ethnicity_concept_id,
                {pick("c_custkey", [8527, 8516, 8515, None, 999])} as race_concept_id,
                {pick("c_custkey", [4180186, 4182511, None])} as language_concept_id,
                c_mktsegment as gender_source_value, {pick("c_custkey", ["hisp", "non", None])} as ethnicity_source_value,
                c_name as race_source_value, cast(null as string) as language_source_value,
                c_custkey % 10 as provider_id, c_nationkey as location_id,
                case when c_custkey % 5 = 0 then cast(30 + c_custkey % 12 as double) end as pn_gestational_age,
                '{SITE}' as site
            from customer""",
        "visit_occurrence": f"""
            select o_orderkey as visit_occurrence_id, o_custkey as person_id,
                cast(o_orderdate as date) as visit_start_date, {at("o_orderdate", 9, 30)} as visit_start_datetime,
                case when o_orderkey % 6 = 0 then null else cast(o_orderdate as date) + cast(o_orderkey % 5 as int) end as visit_end_date,
                case when o_orderkey % 6 = 0 then null else {at("cast(o_orderdate as date) + cast(o_orderkey % 5 as int)", 17, 5)} end as visit_end_datetime,
                o_orderkey % 100 as provider_id, case when o_orderkey % 31 = 30 then null else o_orderkey % 31 end as care_site_id,
                case o_orderpriority when '1-URGENT' then 9203 when '2-HIGH' then 9201 when '3-MEDIUM' then 9202
                    when '4-NOT SPECIFIED' then 2000000048 else 581399 end as visit_concept_id,
                o_orderpriority as visit_source_value,
                {pick("o_custkey", [4161979, 4216643, None, 8536])} as discharged_to_concept_id,
                o_orderstatus as discharged_to_source_value,
                {pick("o_custkey", [8977, None, 8870, 1])} as admitted_from_concept_id,
                {pick("o_custkey", ["clinic", None, "emergency", "?"])} as admitted_from_source_value
            from orders""",
        "observation": f"""
            select 2 * o_orderkey + 1 as observation_id, o_custkey as person_id,
                case when o_orderkey % 9 = 8 then null else o_orderkey end as visit_occurrence_id,
                o_orderkey % 100 as provider_id,
                {pick("o_orderkey", [44813951, 3040464, 3042924, 3045858, 3042932, 40192517, 40192426, 37116643, 42894222,
                                     4005823, 4219336, 4275495, 46235214, 46235215, 44813951, 3040464])} as observation_concept_id,
                cast(o_orderdate as date) + case when o_orderkey % 4 = 1 then 4000 else 0 end as observation_date,
                {at("o_orderdate", 8)} as observation_datetime,
                {pick("o_custkey", ["fever", "Well child", "COUGH, DRY", "unlisted", None])} as observation_source_value,
                case {pick("o_orderkey", [1, 2, 3, 3, 3, 4, 4, 4, 0, 5, 6, 7, 8, 9, 1, 2])}
                    when 1 then {pick("o_custkey", [4161979, 4216643, 44814653])} when 3 then {pick("o_custkey", [45883172, 45879886, 1])}
                    when 4 then {pick("o_custkey", [4188539, 4188540, 44814653, None])} when 5 then {pick("o_custkey", [4298794, 4144272, 1])}
                    when 6 then {pick("o_custkey", [42530756, 42536422, 36716478])} when 7 then {pick("o_custkey", [4209585, 4209006, 1])}
                    when 8 then {pick("o_custkey", [36307527, 36303203, 45878142, 1])} when 9 then {pick("o_custkey", [36308665, 36307702, 1585351, 2])}
                    end as value_as_concept_id,
                o_totalprice as value_as_number,
                {pick("o_custkey", ["001", "002", "003", "Often true", "No", "203", None, "42536422"])} as value_as_string,
                {pick("o_custkey", [9191, 9189, None])} as qualifier_concept_id, cast(null as string) as qualifier_source_value,
                '{SITE}' as site
            from orders
            union all
            select 2 * event_id as observation_id, user_id as person_id, cast(null as bigint) as visit_occurrence_id,
                event_id % 100 as provider_id,
                case event_type when 'view' then 42894222 when 'click' then 4219336 when 'signup' then 46235214
                    when 'error' then 46235215 else 3042924 end as observation_concept_id,
                cast(ts as date) as observation_date, ts as observation_datetime, event_type as observation_source_value,
                case event_type when 'click' then {pick("event_id", [42536422, 42536421, 36716478, 1])} when 'signup' then {pick("event_id", [36310681, 36308454, 3])}
                    when 'error' then {pick("event_id", [36309198, 45878142, 3])} else {pick("event_id", [45883172, 45879886, 45877986])} end as value_as_concept_id,
                value as value_as_number, {pick("event_id", ["42536422", "201", "text", None])} as value_as_string,
                {pick("event_id", [9190, None])} as qualifier_concept_id, props as qualifier_source_value,
                case when event_id % 10 = 0 then 'south' else '{SITE}' end as site
            from events""",
        "observation_derivation_covid": f"""
            select case when o_orderkey % 10 = 6 then o_orderkey + 1 else o_orderkey end as observation_id, o_custkey as person_id,
                o_orderkey as visit_occurrence_id, {pick("o_orderkey", [2000001411, 1])} as observation_concept_id, cast(o_orderdate as date) as observation_date,
                {pick("o_custkey", [2000001411, 2000001412, 2000001413, 2000001414])} as value_as_concept_id
            from orders""",
        "condition_occurrence": f"""
            select fact_id as condition_occurrence_id, o_custkey as person_id,
                case when l_partkey % 19 = 0 then null else l_orderkey end as visit_occurrence_id,
                {pick("l_partkey", [201, 202, 203, 0, 204, 999999])} as condition_concept_id,
                {pick("l_suppkey", [301, 302, 303, 203, 44814649, 0, 310])} as condition_source_concept_id,
                {pick("qty", [2000000089, 2000000090, 38000245, 2000001423, 2000000092, 38000201, 38000230, 44786627, 38000230])} as condition_type_concept_id,
                {pick("l_partkey", [4188539, 4188540, None])} as poa_concept_id, ship_date as condition_start_date,
                case when l_suppkey % 3 = 0 then null else ship_date + 30 end as condition_end_date,
                {pick("l_partkey + l_suppkey", _CONDITION_TEXTS)} as condition_source_value, l_linestatus as condition_status_source_value
            from line_facts""",
        "procedure_occurrence": f"""
            select fact_id as procedure_occurrence_id, o_custkey as person_id,
                case when l_partkey % 23 = 0 then null else l_orderkey end as visit_occurrence_id,
                {pick("l_partkey", [401, 402, 403, 404, 405, 407, 0, None, 406])} as procedure_concept_id,
                {pick("l_suppkey", [401, 0, 403, 402, 405])} as procedure_source_concept_id,
                {pick("qty", [38000275, 44786630, 1])} as procedure_type_concept_id, ship_date as procedure_date,
                {pick("l_partkey + l_suppkey", ["visit|99213", "appendix| ", "x|  47.01 and more", "only", None, "y|J11"])} as procedure_source_value
            from line_facts""",
        "measurement": f"""
            select fact_id as measurement_id, o_custkey as person_id,
                case when l_suppkey % 29 = 0 then null else l_orderkey end as visit_occurrence_id, l_suppkey % 100 as provider_id,
                {pick("l_partkey", [501, 502, 503, 504, 505, 506, 507, *_VITALS, *_VITALS[:2], 3020891, 3024171, 4353936, 2000001422])} as measurement_concept_id,
                {pick("l_suppkey", [501, 507, None, 0])} as measurement_source_concept_id,
                {pick("l_suppkey", [44818702, 44818702, 2000000033])} as measurement_type_concept_id,
                order_date + cast(l_linenumber % 2 as int) as measurement_date,
                case when l_suppkey % 17 = 0 then null when l_partkey % 2 = 0 then {at("o_orderdate", 8)} else {at("o_orderdate", 14, 5)} end as measurement_datetime,
                ship_date as measurement_order_date, {at("ship_date", 1)} as measurement_order_datetime,
                case when l_partkey % 4 = 0 then null else ship_date end as measurement_result_date,
                case when l_partkey % 4 = 0 then null else {at("ship_date", 16, 45)} end as measurement_result_datetime,
                case when l_linenumber % 4 = 0 then 'POC ' || l_returnflag else l_returnflag end as measurement_source_value,
                case when l_suppkey % 7 = 0 then null when l_partkey % 53 = 5 then cast(25000000.5 as double) when l_partkey % 53 = 6 then cast(0.0001 as double) when l_partkey % 53 = 7 then cast(12345678 as double) else cast(qty as double) end as value_as_number,
                {pick("l_partkey + l_suppkey", [9191, 9189, None, 0])} as value_as_concept_id,
                {pick("l_partkey + l_linenumber", _RESULT_TEXTS)} as value_source_value,
                {pick("l_partkey + qty", [8840, 8647, 8999, None, 8998, 1, 8997])} as unit_concept_id,
                {pick("l_suppkey + qty", _UNITS)} as unit_source_value, {pick("qty", ["milligram", "count", None])} as unit_concept_name,
                {pick("l_suppkey", operators)} as operator_concept_id,
                case when qty % 3 = 0 then null when l_partkey % 41 = 3 then cast(0.0005 as double) else cast(qty % 10 as double) end as range_low,
                case when qty % 5 = 0 then null else cast(qty as double) + 0.5 end as range_high,
                {pick("l_partkey", operators)} as range_low_operator_concept_id, {pick("qty", operators)} as range_high_operator_concept_id,
                {pick("qty", [4044019, 4210605, None])} as priority_concept_id, {pick("l_partkey", [4001225, 4001226, None, 1])} as specimen_concept_id,
                {pick("l_suppkey", ["Spinal |x", "whole blood", None, "tube|y"])} as specimen_source_value, '{SITE}' as site
            from line_facts""",
        "drug_exposure": f"""
            select fact_id as drug_exposure_id, o_custkey as person_id,
                case when l_partkey % 21 = 0 then null else l_orderkey end as visit_occurrence_id, l_suppkey % 100 as provider_id,
                case when l_suppkey % 9 = 0 then 0 when l_suppkey % 10 = 1 then {pick("l_partkey", [1367571, 967823, 43011476])}
                    else 900000000 + l_partkey end as drug_concept_id,
                900000000 + l_partkey + l_linenumber % 3 as drug_source_concept_id,
                {pick("l_partkey + qty", [38000175, 38000177, 38000180, 581373])} as drug_type_concept_id,
                ship_date as drug_exposure_start_date, {at("ship_date", 7, 15)} as drug_exposure_start_datetime,
                case when l_partkey % 5 = 0 then null else ship_date + 10 end as drug_exposure_end_date,
                case when l_partkey % 5 = 0 then null else {at("ship_date + 10", 21, 40)} end as drug_exposure_end_datetime,
                case when l_suppkey % 4 = 0 then 'P' || {text("l_partkey")} || '|raw' else {pick("l_partkey + l_suppkey", _DRUG_TEXTS)} end as drug_source_value,
                l_extendedprice as quantity, l_partkey % 4 as days_supply, qty % 6 as refills,
                {pick("qty", ["Daily", " as needed ", "every 4h PRN", None])} as frequency,
                case when l_suppkey % 8 = 0 then null else l_discount * 100 end as effective_drug_dose,
                {pick("qty", ["5 mg", None])} as eff_drug_dose_source_value, {pick("qty", [8576, 8587, None])} as dose_unit_concept_id,
                {pick("qty", ["mg", "ml"])} as dose_unit_source_value, {pick("l_suppkey", [4132161, 4112421, None])} as route_concept_id,
                l_linestatus as route_source_value, {pick("qty", [4188539, 4188540, None])} as dispense_as_written_concept_id
            from line_facts""",
        "immunization": f"""
            select fact_id as immunization_id, o_custkey as person_id,
                case when l_partkey % 25 = 0 then null else l_orderkey end as visit_occurrence_id, l_suppkey % 100 as provider_id,
                case when l_partkey % 3 = 0 then fact_id when l_partkey % 3 = 1 then -1 else null end as procedure_occurrence_id,
                {pick("l_partkey", [724907, 724906, 702866, 0, 701, 702, 703, None, 888])} as immunization_concept_id,
                {pick("l_suppkey", [711, 712, 0])} as immunization_type_concept_id, ship_date as immunization_date,
                order_date as imm_recorded_date, case when qty % 4 = 0 then null else ship_date + 365 end as imm_exp_date,
                {pick("l_partkey + l_suppkey", _VACCINE_TEXTS)} as immunization_source_value,
                {pick("qty", ["0.5 mL", "1.2.3", "", "123456789 mg", "2", None, "about 7.25 mg"])} as immunization_dose,
                {pick("qty", [8576, 8587, None])} as imm_dose_unit_concept_id, {pick("qty", ["mg", "ml"])} as imm_dose_unit_source_value,
                {pick("l_suppkey", [4132161, 4112421, None])} as imm_route_concept_id, l_linestatus as imm_route_source_value,
                {pick("l_suppkey", [4300192, 4309106, None, 1])} as imm_body_site_concept_id,
                {pick("l_partkey", ["Left|a", "thigh", "", None, "arm"])} as imm_body_site_source_value,
                {pick("qty", ["pfizer", "Moderna", "17", "", None, "unknown maker", "Inc"])} as imm_manufacturer,
                'lot"' || {text("qty")} as imm_lot_num, '{SITE}' as site
            from line_facts""",
        "death": f"""
            select o_custkey as person_id, cast('2012-01-01' as date) + cast(o_custkey % 3000 as int) as death_date,
                {pick("o_orderkey", [38003569, 38003569, 38003570])} as death_type_concept_id,
                {pick("o_custkey", [2000000034, 2000000035, None, 7])} as death_impute_concept_id,
                {pick("o_orderkey", [201, 202, 0, 203, 204])} as cause_concept_id,
                {pick("o_orderkey", [301, 302, 303, 203, 44814650, 0, 999999])} as cause_source_concept_id,
                {pick("o_orderkey", ["x|y|I10", "NI", "4019", "R05", "IMO123", "a|b", None, "J20.9", "0", "z|y|,K1,K2"])} as cause_source_value
            from orders""",
        "observation_period": """
            select o_custkey as person_id, make_date(cast(year(o_orderdate) as int), 1, 1) as observation_period_start_date,
                case when o_custkey % 7 = 0 then null else make_date(cast(year(o_orderdate) as int), 12, 31) end as observation_period_end_date
            from orders""",
        "visit_payer": f"""
            select fact_id as visit_payer_id, l_orderkey as visit_occurrence_id,
                {pick("l_suppkey", [31968, 31969, 0])} as visit_payer_type_concept_id,
                {pick("l_partkey", ["medicaid", "private", "other", None])} as plan_class,
                {pick("l_partkey", ["hmo", "ppo", "x", "y"])} as plan_type, {pick("l_partkey", ["Plan A", "Plan B"])} as plan_name
            from line_facts""",
        "provider": f"""
            select s_suppkey as provider_id, {pick("s_suppkey", [8507, 8532, None, 1])} as gender_concept_id,
                {pick("s_suppkey", [38004456, None, 1])} as specialty_concept_id,
                {pick("s_suppkey", ["Pediatric", "Cardio", "", None, "pediatric", "Surgery", "Allergy"])} as specialty_source_value
            from supplier""",
        "care_site": f"""
            select cast(n_nationkey as bigint) as care_site_id, (n_nationkey + 3) % 25 as location_id,
                {pick("n_nationkey", [8756, 8940, None, 1])} as place_of_service_concept_id,
                {pick("n_nationkey", [38004477, None, 38004477])} as specialty_concept_id
            from nation""",
        "location": f"""
            select n_nationkey as location_id, {pick("n_nationkey", ["Boston", "St. Paul", "123", "--", None, "Fort-Worth Town"])} as city,
                n_name as county, {pick("n_nationkey", ["PA", "pennsylvania", "tx", "zz", None, "Texas"])} as state,
                {pick("n_nationkey", ["12345-6789", "12345", "1234", "ABCDE", None, "123456789", "1234567"])} as zip
            from nation""",
        "location_history": f"""
            select 2 * c_custkey as location_history_id, c_nationkey as location_id, c_custkey as entity_id,
                {pick("c_custkey", ["Person", "PERSON", "care_site", " person "])} as domain_id,
                cast('2000-01-01' as date) + cast(c_custkey % 400 as int) as start_date,
                case when c_custkey % 3 = 0 then null else cast('2010-01-01' as date) end as end_date,
                {pick("c_custkey", [4188540, 4188539, None])} as location_preferred_concept_id,
                {pick("c_custkey", [4083586, None])} as relationship_type_concept_id, '{SITE}' as site
            from customer
            union all
            select 2 * c_custkey + 1 as location_history_id, (c_nationkey + 1) % 25 as location_id, c_custkey as entity_id,
                'person' as domain_id, cast('2010-01-01' as date) as start_date, cast(null as date) as end_date,
                4188539 as location_preferred_concept_id, 4083586 as relationship_type_concept_id, '{SITE}' as site
            from customer""",
        "location_fips": f"""
            select 1000 + n_nationkey as geocode_id, n_nationkey as location_id, lpad({text("n_nationkey")}, 2, '0') as geocode_state,
                lpad({text("n_regionkey")}, 3, '0') as geocode_county, '000100' as geocode_tract, '1' as geocode_group,
                {pick("n_nationkey", ["1001", None, "2002"])} as geocode_block, 2020 as geocode_year, 'tiger' as geocode_shapefile
            from nation
            union all
            select 2000 + n_nationkey as geocode_id, n_nationkey as location_id, '99' as geocode_state, '001' as geocode_county,
                '000200' as geocode_tract, '2' as geocode_group, '0001' as geocode_block, 2010 as geocode_year, 'tiger' as geocode_shapefile
            from nation""",
        "fact_relationship": f"""
            select 21 as domain_concept_id_1, a.fact_id as fact_id_1, 21 as domain_concept_id_2, b.fact_id as fact_id_2
            from line_facts a join line_facts b on a.l_orderkey = b.l_orderkey and b.l_linenumber = a.l_linenumber + 1
            union all
            select 27 as domain_concept_id_1, 2 * o_orderkey + 1 as fact_id_1, 27 as domain_concept_id_2, 2 * o_orderkey + 3 as fact_id_2
            from orders
            union all
            select 27 as domain_concept_id_1, 2 * o_orderkey + 1 as fact_id_1, 27 as domain_concept_id_2, 2 * o_orderkey + 5 as fact_id_2
            from orders""",
        "adt_occurrence": f"""
            select fact_id as adt_occurrence_id, l_orderkey as visit_occurrence_id, o_custkey as person_id,
                order_date + cast(l_linenumber % 3 as int) as adt_date, {at("order_date", 11, 20)} as adt_datetime,
                {pick("l_partkey", [2000000079, 2000000080, 2000000078, 1, 2])} as service_concept_id, '{SITE}' as site
            from line_facts""",
        "device_exposure": f"""
            select fact_id as device_exposure_id, o_custkey as person_id, l_orderkey as visit_occurrence_id, l_suppkey % 100 as provider_id,
                {pick("l_partkey", [4044008, 4097216, 4138614, 5, 6])} as device_concept_id,
                order_date + cast(l_linenumber % 2 as int) as device_exposure_start_date, {at("order_date", 6)} as device_exposure_start_datetime,
                case when l_suppkey % 4 = 0 then null else order_date + cast(qty % 3 as int) end as device_exposure_end_date,
                case when l_suppkey % 4 = 0 then null else {at("order_date", 18, 10)} end as device_exposure_end_datetime, '{SITE}' as site
            from line_facts""",
        "concept": rows("concept_id concept_code concept_name vocabulary_id concept_class_id domain_id invalid_reason",
                        *_CONCEPTS, casts={"concept_id": "bigint"}) + f"""
            union all
            select 900000000 + p_partkey as concept_id, 'P' || {text("p_partkey")} as concept_code, p_name as concept_name,
                {pick("p_partkey", ["RxNorm", "NDC", "RxNorm", "NDC", "Brand"])} as vocabulary_id,
                case when p_partkey % 5 = 1 then '11-digit NDC' when p_partkey % 5 = 3 then '9-digit NDC'
                    when p_type = 'PROMO' then 'Clinical Drug' when p_type = 'LARGE' then 'Branded Drug' else p_type end as concept_class_id,
                'Drug' as domain_id, cast(null as string) as invalid_reason
            from part""",
        "concept_relationship": """
            select 900000000 + p_partkey as concept_id_1, 900000000 + p_partkey + 1 as concept_id_2, 'Maps to' as relationship_id from part
            union all
            select 900000000 + p_partkey, 900000000 + p_partkey - 1, 'Maps to' from part
            union all
            select 900000000 + p_partkey, 19082573 + p_partkey % 3, 'RxNorm has dose form' from part
            union all
            select 900000000 + p_partkey, 19082574, 'RxNorm has dose form' from part where p_size > 25""",
    }
    return out


DEPENDS = {
    "line_facts": [], "condition_occurrence": ["line_facts"], "procedure_occurrence": ["line_facts"],
    "measurement": ["line_facts"], "drug_exposure": ["line_facts"], "immunization": ["line_facts"],
    "visit_payer": ["line_facts"], "fact_relationship": ["line_facts"], "adt_occurrence": ["line_facts"],
    "device_exposure": ["line_facts"],
}


class SourceTables(Mapping[str, DataFrame]):
    """Lazily built source tables over one folder of raw tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder
        self._texts = sources(True)
        self._built: dict[str, DataFrame] = {}
        self._settled: set[str] = set()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in RAW_TABLES:
                self._built[name] = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
            else:
                text = self._texts[name]
                used = {t: self[t] for t in [*RAW_TABLES, *self._texts] if t != name and f" {t} " in f"{text} ".replace("\n", " ")}
                body = text
                for t in used:
                    body = body.replace(f"from {t} ", f"from {{{t}}} ").replace(f"join {t} ", f"join {{{t}}} ")
                    body = body.replace(f"from {t}\n", f"from {{{t}}}\n")
                    if body.endswith(f"from {t}"):
                        body = body[: -len(t)] + f"{{{t}}}"
                self._built[name] = self._spark.sql(body, **used)
        return self._built[name]

    def settle(self, name: str) -> None:
        """Write a source that others are cut from, for runs that read most of them; they are then cut from its copy."""
        if name not in self._settled:
            self._settled.add(name)
            self._built[name] = staged(self[name], name)
            for other in [n for n, needs in DEPENDS.items() if name in needs]:
                self._built.pop(other, None)

    def __iter__(self) -> Iterator[str]:
        return iter(self._texts)

    def __len__(self) -> int:
        return len(self._texts)


_studies: dict[tuple[str, str], Study] = {}


def study(spark: SparkSession, folder: str) -> Study:
    """The test study over a folder of raw tables."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _studies:
        tune(spark)
        _studies[key] = Study(SourceTables(spark, folder), SITE, FLOOR, TODAY, local_vocabulary="Local")
    return _studies[key]


def prelude(names: list[str]) -> str:
    """WITH clause that gives another SQL engine the same source tables."""
    texts = sources(False)
    order: list[str] = []
    for n in names:
        for d in [*DEPENDS.get(n, []), n]:
            if d not in order:
                order.append(d)
    return "with " + ",\n".join(f"{n} as ({texts[n]})" for n in order)
