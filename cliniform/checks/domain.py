"""Domain operators on their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.lookup import codes_of, concept_lookup, lookup
from ..operators.membership import member_flag
from ..operators.rules import classify, classify_texts, ordered
from ..operators.sizing import attach
from ..plans import drugs, encounters, labs, observations, people, places, vitals
from ..rules import drugs as D
from ..rules import labs as L
from ..rules import visits as R
from ..rules.results import GENERAL_RESULT_TEXT, RESULT_TEXT
from ..sources.study import Study
from .registry import case, mapped, quoted
from .targets import (SINCE, _CODE_TYPE, _DOSE, _LEAST, _VX, _VX_RULES, _code, _recovered, classified, clock, first_listed, keywords,
                      part)

RAW = "condition_source_value"

# --- codes --------------------------------------------------------------------------------------


@case("code_cascade", f"""select co.condition_occurrence_id, {_code(first_listed("co." + RAW))} as code, {_CODE_TYPE} as code_type
    from condition_occurrence co left join concept std on std.concept_id = co.condition_concept_id
    left join concept src on src.concept_id = co.condition_source_concept_id""")
def _cascade(s: Study) -> DataFrame:
    df = concept_lookup(s["condition_occurrence"], s.concept, "condition_concept_id", {"_std_code": "concept_code"})
    df = concept_lookup(df, s.concept, "condition_source_concept_id", {"_src_code": "concept_code", "_src_voc": "vocabulary_id"})
    code, kind = encounters.coded_condition(RAW)
    return df.select("condition_occurrence_id", code.alias("code"), kind.alias("code_type"))


@case("epidemic_code_recover", f"""select condition_occurrence_id, dx as code, dx_type as code_type from ({_recovered("o_raw_codes", "true")})""")
def _recover(s: Study) -> DataFrame:
    df = s["condition_occurrence"].select("condition_occurrence_id", F.trim(fn.packed_field(RAW, 3)).alias("raw3"),
                                          F.lit("?").alias("code"), F.lit("OT").alias("code_type"))
    return encounters.recover_epidemic_codes(df, s.concept, F.col("raw3"), F.lit(True), "code", "code_type").drop("raw3")


from .registry import VIEWS  # noqa: E402

VIEWS["o_raw_codes"] = f"select condition_occurrence_id, trim({part(RAW, 3)}) as raw3, '?' as dx, 'OT' as dx_type from condition_occurrence"


@case("primary_flip", """select l_orderkey::varchar as encounterid, fact_id::varchar as diagnosisid,
    case when enc_type in ('IP', 'EI') and dx_origin = 'OD' and count(*) filter (pdx = 'P') over w = 0
        and row_number() over (w order by fact_id::varchar) = 1 then 'P' else pdx end as pdx
    from (select *, case l_returnflag when 'A' then 'P' else 'S' end as pdx, case when l_orderkey % 3 = 0 then 'IP' when l_orderkey % 3 = 1 then 'EI' else 'AV' end as enc_type,
        case l_linestatus when 'F' then 'OD' else 'BI' end as dx_origin from line_facts)
    window w as (partition by l_orderkey, enc_type, dx_origin)""")
def _flip(s: Study) -> DataFrame:
    kind = F.when(F.col("l_orderkey") % 3 == 0, "IP").when(F.col("l_orderkey") % 3 == 1, "EI").otherwise("AV")
    df = s["line_facts"].select(
        fn.text_id("l_orderkey").alias("encounterid"), fn.text_id("fact_id").alias("diagnosisid"), kind.alias("enc_type"),
        F.when(F.col("l_returnflag") == "A", "P").otherwise("S").alias("pdx"),
        F.when(F.col("l_linestatus") == "F", "OD").otherwise("BI").alias("dx_origin"))
    return encounters.promote_primary(df).select("encounterid", "diagnosisid", "pdx")


# --- keyword rules ------------------------------------------------------------------------------

def arms(c: str, rules: list[tuple[str, str]], mode: str) -> str:
    text = " ".join(f"when contains(lower({c}), {quoted([p])[1:-1]}) then {quoted([t])[1:-1]}" for p, t in ordered(rules, mode))
    return f"coalesce(case {text} end, 'OT')"


case("keyword_classify", f"select doc_id, {arms('text', RESULT_TEXT, 'fixed')} as result from documents")(
    lambda s: classify_texts(s["documents"], "text", RESULT_TEXT, "result", "OT").select("doc_id", "result"))
case("keyword_classify_strict", f"select measurement_id, {arms('value_source_value', RESULT_TEXT, 'strict')} as result from measurement")(
    lambda s: classify_texts(s["measurement"], "value_source_value", RESULT_TEXT, "result", "OT", "strict").select("measurement_id", "result"))
case("keyword_classify_longest", f"select measurement_id, {arms('value_source_value', RESULT_TEXT, 'longest')} as result from measurement")(
    lambda s: classify_texts(s["measurement"], "value_source_value", RESULT_TEXT, "result", "OT", "longest").select("measurement_id", "result"))
case("keyword_classify_general", f"select measurement_id, {classified('value_source_value', GENERAL_RESULT_TEXT, mapped('Result qualifier', 'value_as_concept_id'))} as result from measurement")(
    lambda s: lookup(s["measurement"], s.value_map, "Result qualifier", "value_as_concept_id", "_q").select(
        "measurement_id", classify("value_source_value", GENERAL_RESULT_TEXT, "OT", F.col("_q")).alias("result")))
case("vaccine_classify", f"""select immunization_id, left(case when immunization_concept_id <> 0 then concept_code
    when left(trim({part(_VX, 2)}), 11) <> '' then left(trim({part(_VX, 2)}), 11) {_VX_RULES} else '999' end, 11) as code
    from immunization im left join concept on concept_id = immunization_concept_id""")(
    lambda s: concept_lookup(s["immunization"], s.concept, "immunization_concept_id", {"_code": "concept_code"}).select(
        "immunization_id", drugs.vaccine_code(F.col("immunization_concept_id"), F.col("_code"), F.col("immunization_source_value")).alias("code")))


@case("vaccine_code_type", """select immunization_id, case when vx_voc = 'CVX' then 'CX' when vx_voc = 'NDC' then 'ND' when vx_voc ilike 'rxnorm%' then 'RX'
    when vx_voc in ('CPT4', 'HCPCS') then 'CH' when vx_code in (select concept_code from concept where vocabulary_id = 'CVX') then 'CX' else 'UN' end as code_type from o_vx_all""")
def _vx_type(s: Study) -> DataFrame:
    df = concept_lookup(s["immunization"], s.concept, "immunization_concept_id", {"_code": "concept_code", "_voc": "vocabulary_id"})
    df = df.withColumn("_vx", drugs.vaccine_code(F.col("immunization_concept_id"), F.col("_code"), F.col("immunization_source_value")))
    df = member_flag(df, codes_of(s.concept, "c", ["CVX"]), F.col("_vx"), "_cvx")
    return df.select("immunization_id", drugs.vaccine_code_type(F.col("_voc"), F.col("_cvx")).alias("code_type"))


VIEWS["o_vx_all"] = f"""select im.immunization_id, c.vocabulary_id as vx_voc, left(case when immunization_concept_id <> 0 then c.concept_code
    when left(trim({part(_VX, 2)}), 11) <> '' then left(trim({part(_VX, 2)}), 11) {_VX_RULES} else '999' end, 11) as vx_code
    from immunization im left join concept c on c.concept_id = immunization_concept_id"""

# --- drugs --------------------------------------------------------------------------------------

TEXT = "drug_source_value"
case("drug_code_pick", f"""select drug_exposure_id, coalesce(ndc.concept_code, txt.concept_code, rx.concept_code) as code,
    case when ndc.concept_code is not null or txt.concept_code is not null then 'ND' when rx.concept_id > 0 then 'RX' else 'OT' end as code_type
    from drug_exposure left join concept ndc on ndc.vocabulary_id = 'NDC' and ndc.concept_id = drug_source_concept_id
    left join (select distinct concept_code from concept where vocabulary_id = 'NDC') txt on txt.concept_code = {part(TEXT, 1)}
    left join concept rx on rx.vocabulary_id = 'RxNorm' and rx.concept_id = drug_concept_id""")(
    lambda s: drugs.pick_drug_code(s["drug_exposure"], s.concept).select("drug_exposure_id", "code", "code_type"))
case("ndc_pick", f"""select drug_exposure_id, coalesce(ndc.concept_code, lx.least_ndc, left({part(TEXT, 1)}, 11)) as ndc from drug_exposure
    left join {_LEAST} lx on lx.concept_id = drug_concept_id
    left join concept ndc on ndc.vocabulary_id = 'NDC' and ndc.concept_id = drug_source_concept_id
    where lx.least_ndc is not null or ndc.concept_id is not null or {part(TEXT, 1)} in (select concept_code from concept where vocabulary_id = 'NDC')""")(
    lambda s: drugs.pick_package_code(s["drug_exposure"], s.concept, s["concept_relationship"]).select("drug_exposure_id", "ndc"))
case("drug_override", f"""select drug_exposure_id, coalesce(fixed, 'old') as code, case when fixed is null then 'OT' else 'RX' end as code_type from (
    select *, case when drug_concept_id in (967823, 46276153) and {TEXT} ilike '%sodium chloride 0.9%' then '313002'
        when drug_concept_id = 43011476 and {TEXT} ilike '%heparin 100 units/ml%' then '1361048'
        when drug_concept_id = 1367571 and {TEXT} ilike '%heparin 2 unit/ml%' then '1362935'
        when drug_concept_id = 1367571 and ({TEXT} ilike '%heparin 1 unit/ml%' or {TEXT} ilike '%(1 unit/ml)%') then '1362025' end as fixed from drug_exposure)""")(
    lambda s: drugs.override_codes(s["drug_exposure"].withColumns({"code": F.lit("old"), "code_type": F.lit("OT")}),
                                   F.col("drug_concept_id"), F.col(TEXT), "code", "code_type").select("drug_exposure_id", "code", "code_type"))
case("nutrition_purge", f"""select drug_exposure_id from drug_exposure left join concept on concept_id = drug_concept_id
    where not (coalesce({keywords(TEXT, D.DENIED_WORDS)}, false) and coalesce(concept_code not in (select concept_code from concept
        where vocabulary_id = 'RxNorm' and concept_class_id in {quoted(D.KEPT_DRUG_CLASSES)}), true))""")(
    lambda s: drugs.purge_nutrition(concept_lookup(s["drug_exposure"], s.concept, "drug_concept_id", {"_code": "concept_code"}), s.concept,
                                    F.col(TEXT), F.col("_code")).select("drug_exposure_id"))
case("prn_flag", """select drug_exposure_id, case when lower(frequency) like '%as needed%' or lower(frequency) like '%prn%' then 'Y' else 'N' end as prn from drug_exposure""")(
    lambda s: s["drug_exposure"].select("drug_exposure_id", drugs.prn_flag(F.col("frequency")).alias("prn")))
case("body_site_pick", f"""select immunization_id, coalesce({mapped("imm_body_site", "imm_body_site_concept_id")}, (select min(m.target_code) from value_map m
    where m.source_class = 'imm_body_site_source' and trim({part("imm_body_site_source_value", 1)}) <> ''
    and contains(lower(m.source_code), lower(trim({part("imm_body_site_source_value", 1)})))), 'NI') as site,
    case when coalesce(imm_manufacturer, '') = '' then 'NI' else coalesce((select min(m.target_code) from value_map m where m.source_class = 'vx_manufacturer_source'
        and contains(lower(m.target_label), lower(imm_manufacturer))), {mapped("vx_manufacturer", "imm_manufacturer")}, 'OTH') end as maker from immunization""")(
    lambda s: drugs.manufacturer(drugs.body_site(s["immunization"].drop("site"), s.value_map, "imm_body_site_concept_id", "imm_body_site_source_value", "site"),
                                 s.value_map, "imm_manufacturer", "maker").select("immunization_id", "site", "maker"))

# --- laboratory ---------------------------------------------------------------------------------

LO, HI = "range_low_operator_concept_id", "range_high_operator_concept_id"
PAIR = f"""case when {HI} = {LO} then 'EQ|EQ' {" ".join(f"when {LO} in {quoted(lo)} and {HI} in {quoted(hi)} then '{v}'" for lo, hi, v in L.RANGE_PAIRS)}
    else {mapped("Result modifier", HI)} || '|' || {mapped("Result modifier", LO)} end"""


def _paired(s: Study) -> DataFrame:
    df = s["measurement"]
    for out, key in (("_hi", HI), ("_lo", LO), ("_mod", "operator_concept_id")):
        df = lookup(df, s.value_map, "Result modifier", key, out)
    return df.withColumn("pair", labs.range_modifier(F.col(LO), F.col(HI), F.col("_lo"), F.col("_hi")))


case("range_modifier", f"select measurement_id, {PAIR} as pair from measurement")(lambda s: _paired(s).select("measurement_id", "pair"))
case("result_modifier", f"""select measurement_id,
    coalesce(case when operator_concept_id <> 0 then mod end, case when p1 in ('EQ', 'GE', 'GT') then p1 when p2 in ('EQ', 'LE', 'LT') then p2 end,
        case when value_as_number is not null then 'EQ' end, mod) as result_modifier,
    coalesce(case when mod = 'EQ' then 'EQ' when mod in ('GE', 'GT') then mod when mod in ('LE', 'LT') then 'NO' end, p1) as norm_modifier_low,
    coalesce(case when mod = 'EQ' then 'EQ' when mod in ('GE', 'GT') then 'NO' when mod in ('LE', 'LT') then mod end, p2) as norm_modifier_high
    from (select *, split_part(pair, '|', 1) as p1, split_part(pair, '|', 2) as p2 from (select *, {PAIR} as pair,
        {mapped("Result modifier", "operator_concept_id")} as mod from measurement))""")(
    lambda s: _paired(s).select("measurement_id", *[c.alias(n) for n, c in labs.modifiers(
        F.col("operator_concept_id"), F.col("_mod"), F.col("pair"), F.col("value_as_number")).items()]))
case("specimen_resolve", f"""select measurement_id, case when spec1 = 'OT' then coalesce(spec2, 'OT') else spec1 end as specimen from (
    select measurement_id, coalesce({mapped("Specimen concept", "specimen_concept_id")}, {mapped("specimen_loinc", "concept_code")}, 'OT') as spec1,
    {mapped("specimen_source", f"trim(lower({part('specimen_source_value', 1)}))")} as spec2
    from measurement left join concept on concept_id = measurement_concept_id and vocabulary_id = 'LOINC')""")(
    lambda s: labs.resolve_specimen(concept_lookup(s["measurement"], s.concept, "measurement_concept_id", {"_loinc": "concept_code"}, ["LOINC"]), s.value_map,
                                    "specimen_concept_id", "_loinc", "specimen_source_value", "specimen").select("measurement_id", "specimen"))
case("unit_resolve", "select measurement_id, unit4 as result_unit from o_lab_tests")(
    lambda s: labs.resolve_units(_lab_rows(s), s.value_map).select("measurement_id", "result_unit"))


def _lab_rows(s: Study) -> DataFrame:
    from ..operators.membership import keep_visits
    test = F.col("concept_class_id") == "Lab Test"
    rows = s["measurement"].where((F.col("measurement_type_concept_id") == L.LAB_RECORD_TYPE) & fn.since("measurement_date", s.floor))
    df = concept_lookup(keep_visits(rows, s.cohort), s.concept, "measurement_concept_id",
                        {"lab_loinc": "concept_code", "raw_lab_name": "concept_name"}, ["LOINC"], test, how="inner")
    return df.withColumn("raw_unit", F.col("unit_source_value"))


@case("absolute_rescale", f"""select measurement_id, case when hit then value_as_number / 1000 else value_as_number end as result_num,
    case when hit then '10*3/uL' else unit_source_value end as result_unit from (select *, coalesce(concept_code in {quoted(L.ABSOLUTE_COUNT_CODES)}
    and unit_source_value in ('cells/uL', '/mm3'), false) as hit from measurement left join concept on concept_id = measurement_concept_id)""")
def _rescale(s: Study) -> DataFrame:
    df = concept_lookup(s["measurement"], s.concept, "measurement_concept_id", {"lab_loinc": "concept_code"})
    unit = F.when(F.col("unit_source_value") == "cells/uL", "{cells}/uL").otherwise(F.col("unit_source_value"))
    done = labs.rescale_counts(df.withColumns({"result_num": F.col("value_as_number"), "result_unit": unit}))
    kept = F.when(F.col("result_unit") == "{cells}/uL", "cells/uL").otherwise(F.col("result_unit"))
    return done.select("measurement_id", "result_num", kept.alias("result_unit"))


@case("loinc_rewrite", f"""select measurement_id, case when concept_code = '20584-9' and {mapped("Specimen concept", "specimen_concept_id")} = 'BLD' then '26464-8'
    else concept_code end as lab_loinc from measurement left join concept on concept_id = measurement_concept_id""")
def _rewrite(s: Study) -> DataFrame:
    df = concept_lookup(s["measurement"], s.concept, "measurement_concept_id", {"lab_loinc": "concept_code"})
    df = lookup(df, s.value_map, "Specimen concept", "specimen_concept_id", "specimen_source")
    return labs.rewrite_white_cells(df).select("measurement_id", "lab_loinc")


case("poc_flag", "select measurement_id, case when starts_with(measurement_source_value, 'POC') then 'P' else 'L' end as place from measurement")(
    lambda s: s["measurement"].select("measurement_id", labs.point_of_care(F.col("measurement_source_value")).alias("place")))

# --- visits -------------------------------------------------------------------------------------

PAYERS = [f"{kind}_{rank}" for rank in ("primary", "secondary") for kind in ("payer_type", "raw_payer_type", "raw_payer_name", "raw_payer_id")]
PLAN = "plan_class || '-' || plan_type"
case("payer_split", "select visit_payer_id, " + ", ".join(
    f"case when visit_payer_type_concept_id = {code} then {value} else {other} end as {kind}_{rank}"
    for rank, code in (("primary", R.PRIMARY_PAYER), ("secondary", R.SECONDARY_PAYER))
    for kind, value, other in (("payer_type", mapped("Payer", PLAN), "'NI'"), ("raw_payer_type", PLAN, "'NI'"), ("raw_payer_name", PLAN, "'NI'"),
                               ("raw_payer_id", "visit_payer_id::varchar", "null"))) + " from visit_payer")(
    lambda s: lookup(s["visit_payer"].withColumn("_plan", F.concat("plan_class", F.lit("-"), "plan_type")), s.value_map, "Payer", "_plan", "_payer").select(
        "visit_payer_id", *[c.alias(n) for n, c in encounters.payer_columns().items()]))
ANSWER = f"(select min(value_as_concept_id) from observation o where o.visit_occurrence_id = v.visit_occurrence_id and observation_concept_id = {R.DISPOSITION_QUESTION})"
case("discharge_pick", f"""select visit_occurrence_id, case when {ANSWER} in (4161979, 4216643) then {ANSWER} when discharged_to_concept_id = 4216643 then 4216643
    else 4161979 end as disposition from visit_occurrence v""")(
    lambda s: s["visit_occurrence"].join(encounters.visit_answers(s), F.col("visit_occurrence_id") == F.col("_va"), "left").select(
        "visit_occurrence_id", encounters.disposition_of(F.col("_disposition"), F.col("discharged_to_concept_id")).cast("bigint").alias("disposition")))
case("drg_pick", f"""select visit_occurrence_id, min(value_as_string) as drg from observation where observation_concept_id = {R.GROUP_QUESTION}
    and observation_date >= date '2007-10-01' and visit_occurrence_id is not null and value_as_string in (select concept_code from concept
    where vocabulary_id = 'DRG' and concept_class_id = 'MS-DRG' and invalid_reason is null) group by 1""")(
    lambda s: encounters.visit_answers(s).where(F.col("drg").isNotNull()).select(F.col("_va").alias("visit_occurrence_id"), "drg"))
case("facility_type", "select encounterid, facility_type from o_encounter")(lambda s: encounters.encounter(s).select("encounterid", "facility_type"))
case("outpatient_blank", f"""select visit_occurrence_id, case when visit_concept_id in {quoted(R.VISITS_WITHOUT_DISCHARGE)} then null else visit_end_date end as discharge_date
    from visit_occurrence where visit_start_date >= {SINCE}""")(
    lambda s: encounters.encounter(s).select(F.col("encounterid").cast("bigint").alias("visit_occurrence_id"), "discharge_date"))

# --- places and persons -------------------------------------------------------------------------

ZIPS = r"""case when regexp_matches(zip, '^[0-9]{5}$') then zip when length(zip) > 5 and regexp_matches(replace(zip, '-', ''), '^[0-9]+$') then left(replace(zip, '-', ''), 5) end as zip5,
    case when regexp_matches(replace(zip, '-', ''), '^[0-9]{9}$') then replace(zip, '-', '') end as zip9,
    case when regexp_matches(replace(zip, '-', ''), '^[0-9]{5,}$') then left(zip, 5) end as facility"""
case("zip_normalise", f"select location_history_id, {ZIPS} from location_history join location using (location_id)")(
    lambda s: attach(s["location_history"], s["location"].select(F.col("location_id").alias("_l"), "zip"), [(F.col("location_id"), "_l")], "inner").select(
        "location_history_id", fn.zip5("zip").alias("zip5"), fn.zip9("zip").alias("zip9"), fn.facility_zip("zip").alias("facility")))
case("city_clean", r"""select location_history_id, case when regexp_matches(city, '^[0-9]+$') then null when not regexp_matches(city, '[^A-Za-z0-9 ]') then city
    when regexp_replace(city, '[^\w]+', '') = '' then null else regexp_replace(city, '[^\w]', ' ') end as city from location_history join location using (location_id)""")(
    lambda s: attach(s["location_history"], s["location"].select(F.col("location_id").alias("_l"), "city"), [(F.col("location_id"), "_l")], "inner").select(
        "location_history_id", fn.clean_city("city").alias("city")))
case("state_lookup", "select addressid, address_state from o_address")(lambda s: places.address_history(s).select("addressid", "address_state"))
case("birth_date_build", f"select person_id, make_date(year_of_birth, coalesce(month_of_birth, 1), coalesce(day_of_birth, 1)) as birth_date, {clock('birth_datetime')} as birth_time from person")(
    lambda s: s["person"].select("person_id", fn.date_from_parts("year_of_birth", "month_of_birth", "day_of_birth").alias("birth_date"),
                                 fn.hhmm("birth_datetime").alias("birth_time")))

# --- vital signs and observations ---------------------------------------------------------------

case("vital_wide", """select distinct person_id, visit_occurrence_id, measurement_date, round(ht * 0.393701::double, 5) as inches, round(wt * 2.20462::double, 5) as pounds,
    bmi, systolic, diastolic from o_wide""")(
    lambda s: vitals.widen(vitals.cohort_signs(s), s["fact_relationship"]).select(
        "person_id", "visit_occurrence_id", "measurement_date", F.round(fn.to_inches("ht"), 5).alias("inches"), F.round(fn.to_pounds("wt"), 5).alias("pounds"),
        "bmi", F.col("sys").alias("systolic"), F.col("dia").alias("diastolic")).distinct())
case("tobacco_link", "select distinct visit_occurrence_id, observation_datetime::varchar as observed_at, tobacco, tobacco_type, smoking from o_tobacco")(
    lambda s: vitals.tobacco_answers(s).select(F.col("_ov").alias("visit_occurrence_id"), F.date_format("_ot", "yyyy-MM-dd HH:mm:ss").alias("observed_at"),
                                               "tobacco", "tobacco_type", "smoking"))
Q, A = "observation_concept_id", "value_as_concept_id"
YES = f"({A} = {R.YES} or coalesce(value_as_string, '') in {quoted(R.YES_TEXTS)})"
NO = f"({A} = {R.NO} or coalesce(value_as_string, '') in {quoted(R.NO_TEXTS)})"
case("survey_items", f"""select observation_id, case {A} when 45883172 then 0 when 45879886 then 1 end as score,
    case when {YES} then 1 when {NO} or {A} = {R.NO_INFORMATION} then 0 end as risk,
    case when {Q} in (40192517, 40192426) then case when {YES} then 'Sometimes true' when {NO} then 'Never true' else 'Don''t know or refused' end
        when {Q} = 37116643 then case when {A} = {R.YES} then 'At risk' when {A} <> {R.YES} then 'No Risk' end end as answer from observation""")(
    lambda s: s["observation"].select("observation_id", observations.survey_number(F.col(A)).alias("score"),
                                      observations.hunger_number(F.col(A), F.col("value_as_string")).alias("risk"),
                                      observations.hunger_text(F.col(Q), F.col(A), F.col("value_as_string")).alias("answer")))
case("survey_seq_key", """select observation_id, 'HVS' || person_id || coalesce(visit_occurrence_id::varchar, '') || strftime(observation_date, '%Y%m%d')
    || strftime(observation_datetime, '%H') || '00' as seq from observation""")(
    lambda s: s["observation"].select("observation_id", observations.survey_key("HVS", F.col("observation_date"), F.col("observation_datetime")).alias("seq")))
for name, letter in (("icu_flag", "a"), ("device_active", "d"), ("census_block", "L")):
    build = {"a": observations.icu_transfers, "d": observations.devices, "L": observations.census_blocks}[letter]
    case(name, f"select obsgenid, obsgen_start_date, obsgen_start_time, obsgen_stop_date, obsgen_result_text, obsgen_code, raw_obsgen_name "
               f"from o_general where starts_with(obsgenid, '{letter}')")(
        lambda s, build=build: build(s).select("obsgenid", "obsgen_start_date", "obsgen_start_time", "obsgen_stop_date", "obsgen_result_text", "obsgen_code",
                                               "raw_obsgen_name"))
case("gestational_age", f"""select 'p' || person_id as obsclinid, birth_date as obsclin_start_date, {clock("birth_datetime")} as obsclin_start_time,
    pn_gestational_age::varchar as obsclin_result_text from person where pn_gestational_age is not null and person_id in (select person_id from cohort_person)""")(
    lambda s: observations.gestational_age(s).select("obsclinid", "obsclin_start_date", "obsclin_start_time", "obsclin_result_text"))
case("modifier_no_to_un", f"select measurement_id, replace({mapped('Result modifier', 'operator_concept_id')}, 'NO', 'UN') as modifier from measurement")(
    lambda s: lookup(s["measurement"], s.value_map, "Result modifier", "operator_concept_id", "_m").select(
        "measurement_id", observations.no_to_unknown(F.col("_m")).alias("modifier")))
