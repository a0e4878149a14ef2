"""Target tables: one query per table, each with a hand-written SQL twin."""

from __future__ import annotations

from ..demo.adapter import FLOOR, SITE, TODAY
from ..plans import administration, drugs, encounters, labs, observations, people, places, vitals
from ..rules import drugs as D
from ..rules import labs as L
from ..rules import visits as R
from ..rules.results import GENERAL_RESULT_TEXT, RESULT_TEXT
from ..operators.rules import ordered
from ..sources.model import MANAGED_DATES, REFRESHED, TABLES
from ..sources.stage import staged
from .registry import VIEWS, case, mapped, quoted

SINCE = f"date '{FLOOR}'"


def blank(table: str, **known: str) -> str:
    """Select list of a target table: the given expressions, NULL for the rest, then the site."""
    out = []
    for f in TABLES[table].fields:
        kind = f.type.simpleString()
        kind = "double" if kind.startswith("decimal") else {"string": "varchar", "timestamp_ntz": "timestamp"}.get(kind, kind)
        if kind == "double" and f.name in known:
            out.append(f"cast(try_cast({known[f.name]} as {f.type.simpleString()}) as double) as {f.name}")
        else:
            out.append(f"cast({known.get(f.name, 'null')} as {kind}) as {f.name}")
    if TABLES[table].has_site:
        out.append(f"'{SITE}' as site")
    return ",\n  ".join(out)


def clock(c: str) -> str:
    return f"strftime({c}, '%H:%M')"


def part(c: str, n: int) -> str:
    return f"split_part({c}, '|', {n})"


def first_listed(c: str) -> str:
    third = part(c, 3)
    return (f"case when trim({third}) like '%,%' then trim(split_part(ltrim({third}, ','), ',', 1)) "
            f"else trim({third}) end")


def keywords(c: str, words: list[str]) -> str:
    return "(" + " or ".join(f"contains(lower({c}), {quoted([w])[1:-1]})" for w in words) + ")"


def classified(c: str, rules: list[tuple[str, str]], first: str) -> str:
    arms = " ".join(f"when contains(lower({c}), {quoted([p])[1:-1]}) then {quoted([t])[1:-1]}" for p, t in ordered(rules, "fixed"))
    return f"coalesce({first}, case {arms} end, 'OT')"


def decoded(c: str, codes: dict, default: str) -> str:
    return f"case {c} " + " ".join(f"when {k} then '{v}'" for k, v in codes.items()) + f" else {default} end"


# --- people -------------------------------------------------------------------------------------

case("pipe_cohort", "select person_id, visit_id from cohort")(people.cohort)

VIEWS["o_demographic"] = "select " + blank(
    "demographic", biobank_flag="'N'",
    birth_date="make_date(year_of_birth, coalesce(month_of_birth, 1), coalesce(day_of_birth, 1))",
    birth_time=clock("birth_datetime"),
    gender_identity=decoded("gi.answer", R.IDENTITY, "'NI'"), sexual_orientation=decoded("so.answer", R.ORIENTATION, "'NI'"),
    patid="p.person_id", raw_sex="gender_source_value", raw_hispanic="ethnicity_source_value",
    raw_race="race_source_value", raw_pat_pref_language_spoken="language_source_value",
    **{out: f"coalesce((select min(m.target_code) from value_map m where m.source_class = '{cls}' "
            f"and m.source_code is not distinct from cast({key} as varchar)), 'OT')"
       for out, cls, key in [("sex", "Gender", "gender_concept_id"), ("hispanic", "Hispanic", "ethnicity_concept_id"),
                             ("race", "Race", "race_concept_id"), ("pat_pref_language_spoken", "Language", "language_concept_id")]}
) + "".join(f"""
    {"from person p" if i == 0 else ""}
    left join (select person_id, value_as_concept_id as answer from observation where observation_concept_id = {q}
        qualify row_number() over (partition by person_id order by observation_date desc, observation_id desc) = 1) {t}
        on {t}.person_id = p.person_id""" for i, (t, q) in enumerate(
            [("so", R.ORIENTATION_QUESTION), ("gi", R.IDENTITY_QUESTION)])) + """
    where p.person_id in (select person_id from cohort_person)"""
case("pipe_demographic", "select * from o_demographic")(people.demographic)

case("pipe_private_demographic", "select " + blank("private_demographic", **{
    **{c: c for c in TABLES["private_demographic"].columns if c in TABLES["demographic"].columns},
    "pat_firstname": "''", "pat_lastname": "''"}) + " from o_demographic")(people.private_demographic)

case("pipe_enrollment", "select distinct " + blank(
    "enrollment", chart="'Y'", enr_basis="'E'", patid="person_id", enr_start_date="observation_period_start_date",
    enr_end_date="observation_period_end_date") + """
    from observation_period semi join cohort_person using (person_id)""")(people.enrollment)

VIEWS["o_provider"] = f"""select {blank(
    "provider", providerid="provider_id", provider_npi_flag="'N'",
    provider_sex="coalesce(" + mapped("Gender", "gender_concept_id") + ", 'OT')",
    provider_specialty_primary="coalesce(by_id.target_code, by_text.target_code, 'OT')",
    raw_provider_specialty_primary="case when by_id.source_code is not null then by_id.description else by_text.description end")}
    from provider p
    left join (select * from value_map where source_class = 'Provider Specialty' and source_code <> '') by_id
        on by_id.source_code = cast(p.specialty_concept_id as varchar)
    left join (select distinct on (s.specialty_source_value) s.specialty_source_value as sought, m.target_code, m.description
        from provider s join value_map m on m.source_class = 'Provider Specialty' and m.source_code = ''
            and s.specialty_source_value <> '' and contains(m.description, s.specialty_source_value)
        order by s.specialty_source_value, m.target_code, m.description) by_text
        on by_text.sought = p.specialty_source_value"""
case("pipe_provider", "select * from o_provider")(people.provider)

case("pipe_death", "select distinct " + blank(
    "death", death_date="death_date", death_source="'L'", patid="person_id",
    death_date_impute="coalesce(" + mapped("Death date impute", "death_impute_concept_id") + ", 'OT')") + f"""
    from death semi join cohort_person using (person_id) where death_type_concept_id = {R.DEATH_RECORD_TYPE}""")(people.death)

case("pipe_death_cause", f"""select distinct {blank(
    "death_cause", patid="d.person_id", death_cause_type="'NI'", death_cause_source="'L'",
    death_cause=f'''left(case when src.vocabulary_id in {quoted(R.ICD_VOCABULARIES)} then src.concept_code
        when era.vocabulary_id is not null then cause_source_value when cause_concept_id > 0 then std.concept_code
        when trim({part("cause_source_value", 3)}) <> '' then {first_listed("cause_source_value")}
        else trim({part("cause_source_value", 2)}) end, 8)''',
    death_cause_code='''case when src.vocabulary_id = 'ICD9CM' or era.vocabulary_id = 'ICD9CM' then '09'
        when src.vocabulary_id in ('ICD10', 'ICD10CM') then '10' else 'OT' end''')}
    from death d
    left join concept src on src.concept_id = cause_source_concept_id
    left join concept std on std.concept_id = cause_concept_id
    left join concept era on era.concept_code = cause_source_value
        and era.vocabulary_id = case when death_date < date '2015-10-01' then 'ICD9CM' else 'ICD10CM' end
    where d.person_id in (select person_id from cohort_person) and cause_source_value is not null
        and cause_source_concept_id not in (0, {R.UNKNOWN_CAUSE}) and cause_concept_id <> 0
        and cause_source_value not in {quoted(R.IGNORED_CAUSES)} and not contains(cause_source_value, 'IMO')""")(people.death_cause)

# --- places -------------------------------------------------------------------------------------

VIEWS["o_address"] = f"""select distinct {blank(
    "lds_address_history", address_county="county", address_period_end="end_date", address_period_start="start_date",
    address_use="'HO'", addressid="location_history_id", patid="entity_id",
    address_preferred="coalesce(" + mapped("address_preferred", "location_preferred_concept_id") + ", 'Y')",
    address_type="coalesce(" + mapped("address_type", "relationship_type_concept_id") + ", 'BO')",
    address_city=r"case when regexp_matches(city, '^[0-9]+$') then null when not regexp_matches(city, '[^A-Za-z0-9 ]') then city when regexp_replace(city, '[^\w]+', '') = '' then null else regexp_replace(city, '[^\w]', ' ') end",
    address_state='''coalesce((select min(m.target_code) from value_map m where m.source_class = 'address_state'
        and lower(trim(split_part(m.target_label, '=', case when length(state) = 2 then 1 else 2 end))) = lower(state)), 'NI')''',
    address_zip5='''case when length(zip) = 5 then case when regexp_matches(zip, '^[0-9]+$') then zip end
        when length(zip) > 5 and regexp_matches(replace(zip, '-', ''), '^[0-9]+$') then left(replace(zip, '-', ''), 5) end''',
    address_zip9='''case when regexp_matches(replace(zip, '-', ''), '^[0-9]{9}$') then replace(zip, '-', '') end''')}
    from location_history join location using (location_id)
    where lower(domain_id) = 'person' and entity_id in (select person_id from cohort_person)"""
case("pipe_address", "select * from o_address")(places.address_history)

case("pipe_geocode", "select " + blank(
    "private_address_geocode", geocodeid="cast(geocode_id as varchar) || cast(location_history_id as varchar)",
    addressid="location_history_id", geocode_state="geocode_state", geocode_county="geocode_county",
    geocode_tract="geocode_tract", geocode_group="geocode_group", geocode_block="geocode_block",
    geocode_custom_text="geocode_year", shapefile="geocode_shapefile") + """
    from location_history join location_fips using (location_id)
    where cast(location_history_id as varchar) in (select addressid from o_address)""")(places.address_geocode)

# --- visits -------------------------------------------------------------------------------------

_FLAG = "payer.visit_payer_type_concept_id"
_PLAN = "payer.plan_class || '-' || payer.plan_type"
VIEWS["o_encounter"] = f"""select {blank(
    "encounter", admit_date="visit_start_date", admit_time=clock("visit_start_datetime"),
    encounterid="v.visit_occurrence_id", patid="v.person_id", providerid="provider_id", facilityid="v.care_site_id",
    admitting_source="coalesce(" + mapped("Admitting source", "admitted_from_concept_id") + ", 'NI')",
    discharge_status="coalesce(" + mapped("Discharge status", "discharged_to_concept_id") + ", 'NI')",
    discharge_date=f"case when visit_concept_id in {quoted(R.VISITS_WITHOUT_DISCHARGE)} then null else visit_end_date end",
    discharge_time=f"case when visit_concept_id in {quoted(R.VISITS_WITHOUT_DISCHARGE)} then null else {clock('visit_end_datetime')} end",
    discharge_disposition="coalesce(" + mapped("Discharge disposition", f'''case when disp.answer in (4161979, 4216643) then disp.answer
        when discharged_to_concept_id = 4216643 then 4216643 else 4161979 end''', by="value_code") + ", 'A')",
    drg="grp.answer", drg_type="case when visit_start_date < date '2007-10-01' then '01' else '02' end",
    enc_type="coalesce(" + mapped("Encounter type", "visit_concept_id") + ", 'OT')",
    facility_location="case when regexp_matches(replace(zip, '-', ''), '^[0-9]{5,}$') then left(zip, 5) end",
    facility_type="coalesce(fac.both_code, fac.place_code, fac.visit_code, 'NI')",
    raw_facility_type="'|' || coalesce(fac.both_text, fac.place_text, fac.visit_text)",
    payer_type_primary=f"case when {_FLAG} = 31968 then payer.mapped else 'NI' end",
    payer_type_secondary=f"case when {_FLAG} = 31969 then payer.mapped else 'NI' end",
    raw_payer_type_primary=f"case when {_FLAG} = 31968 then {_PLAN} else 'NI' end",
    raw_payer_type_secondary=f"case when {_FLAG} = 31969 then {_PLAN} else 'NI' end",
    raw_payer_name_primary=f"case when {_FLAG} = 31968 then {_PLAN} else 'NI' end",
    raw_payer_name_secondary=f"case when {_FLAG} = 31969 then {_PLAN} else 'NI' end",
    raw_payer_id_primary=f"case when {_FLAG} = 31968 then payer.visit_payer_id end",
    raw_payer_id_secondary=f"case when {_FLAG} = 31969 then payer.visit_payer_id end",
    raw_enc_type="visit_source_value", raw_discharge_disposition="discharged_to_source_value",
    raw_discharge_status="discharged_to_source_value", raw_admitting_source="admitted_from_source_value",
    raw_siteid=f"'{SITE}'")}
    from visit_occurrence v
    left join care_site cs on cs.care_site_id = v.care_site_id
    left join location lo on lo.location_id = cs.location_id
    left join (select visit_occurrence_id, min(value_as_concept_id) as answer from observation
        where observation_concept_id = {R.DISPOSITION_QUESTION} group by 1) disp on disp.visit_occurrence_id = v.visit_occurrence_id
    left join (select visit_occurrence_id, min(value_as_string) as answer from observation
        where observation_concept_id = {R.GROUP_QUESTION} and observation_date >= date '2007-10-01'
            and value_as_string in (select concept_code from concept where vocabulary_id = 'DRG'
                and concept_class_id = 'MS-DRG' and invalid_reason is null) group by 1) grp
        on grp.visit_occurrence_id = v.visit_occurrence_id
    left join (select *, {mapped("Payer", "plan_class || '-' || plan_type")} as mapped from visit_payer
        qualify row_number() over (partition by visit_occurrence_id order by mapped nulls last, visit_payer_id) = 1) payer
        on payer.visit_occurrence_id = v.visit_occurrence_id
    left join (select k.visit_concept_id as vc_id, k.care_site_id as cs_id,
            min(target_code) filter (source_code = visit_key and value_code = specialty_key) as both_code,
            min(description) filter (source_code = visit_key and value_code = specialty_key) as both_text,
            min(target_code) filter (source_code = place_key) as place_code,
            min(description) filter (source_code = place_key) as place_text,
            min(target_code) filter (source_code = visit_key and value_code is null) as visit_code,
            min(description) filter (source_code = visit_key and value_code is null) as visit_text
        from (select distinct visit_concept_id, cs2.care_site_id, visit_concept_id::varchar as visit_key,
                specialty_concept_id::varchar as specialty_key, place_of_service_concept_id::varchar as place_key
            from visit_occurrence v2 left join care_site cs2 on cs2.care_site_id = v2.care_site_id) k
        join value_map on source_class = 'Facility type' group by 1, 2) fac
        on fac.vc_id = v.visit_concept_id and fac.cs_id is not distinct from cs.care_site_id
    where visit_start_date >= {SINCE}"""
case("pipe_encounter", "select * from o_encounter")(encounters.encounter)


def _code(text: str) -> str:
    return (f"case when src.vocabulary_id in {quoted(R.ICD_VOCABULARIES)} then src.concept_code "
            f"when co.condition_concept_id > 0 then std.concept_code else {text} end")


_CODE_TYPE = ("case when src.vocabulary_id = 'ICD9CM' then '09' when src.vocabulary_id in ('ICD10', 'ICD10CM') then '10' "
              "when co.condition_concept_id > 0 then 'SM' else 'OT' end")
_RAW = "co.condition_source_value"
_TWO_PARTS = f"coalesce({part(_RAW, 1)}, '') || '|' || coalesce({part(_RAW, 3)}, '')"


def _recovered(rel: str, guard: str) -> str:
    """Every column of ``rel`` (with dx, dx_type, raw3), code and type recovered from the raw text."""
    return f"""select r.* replace (case when fix.code is null then r.dx else fix.code end as dx,
            case when fix.code is null then r.dx_type when fix.voc = 'ICD9CM' then '09' else '10' end as dx_type)
        from {rel} r left join (select distinct on (x.raw3) x.raw3 as sought, c.concept_code as code, c.vocabulary_id as voc
            from (select distinct raw3 from {rel}) x join concept c on c.vocabulary_id in {quoted(R.ICD_VOCABULARIES)}
                and c.concept_code ilike x.raw3
            where {keywords("x.raw3", [f.lower() for f in R.EPIDEMIC_FRAGMENTS])}
            order by x.raw3, c.vocabulary_id, c.concept_code) fix on fix.sought = r.raw3 and {guard}"""


VIEWS["o_diag_base"] = f"""select co.condition_occurrence_id, co.person_id, co.visit_occurrence_id, co.condition_start_date,
        co.condition_type_concept_id, co.condition_source_concept_id, co.poa_concept_id, src.vocabulary_id as src_voc,
        typ.concept_name as type_name, {_TWO_PARTS} as raw_dx, trim({part(_RAW, 3)}) as raw3,
        left({_code(f"case when trim({part(_RAW, 3)}) <> '' then {first_listed(_RAW)} else trim({part(_RAW, 2)}) end")}, 18) as dx,
        {_CODE_TYPE} as dx_type, enc.enc_type, enc.admit_date, enc.providerid
    from condition_occurrence co join concept std on std.concept_id = co.condition_concept_id
    join o_encounter enc on enc.encounterid = cast(co.visit_occurrence_id as varchar)
    left join concept src on src.concept_id = co.condition_source_concept_id
    left join concept typ on typ.concept_id = co.condition_type_concept_id
    where co.condition_type_concept_id not in {quoted(R.PROBLEM_LIST_TYPES)} and co.condition_start_date >= {SINCE}
        and not contains({_RAW}, 'NOD')"""
VIEWS["o_diag_kept"] = "select * from o_diag_base where dx is null or length(dx) >= 2"
VIEWS["o_diag_fixed"] = f"""select *, coalesce({mapped("pdx", "condition_type_concept_id")}, 'NI') as pdx,
        coalesce({mapped("dx origin", "condition_type_concept_id")}, 'OT') as dx_origin
    from ({_recovered("o_diag_kept", "r.dx_type in ('SM', 'OT')")})"""
VIEWS["o_diagnosis"] = f"""select {blank(
    "diagnosis", admit_date="admit_date", diagnosisid="condition_occurrence_id", dx="dx", dx_date="condition_start_date",
    dx_origin="dx_origin", dx_type="dx_type", enc_type="enc_type", encounterid="visit_occurrence_id", patid="person_id",
    providerid="providerid", raw_dx="raw_dx", raw_dx_source="type_name",
    dx_poa="coalesce(" + mapped("dx_poa", "poa_concept_id") + ", 'OT')",
    dx_source="coalesce(" + mapped("dx_source", "condition_type_concept_id") + ", 'OT')",
    raw_dx_type="case when condition_source_concept_id = 44814649 then 'OT' else src_voc end",
    raw_pdx=f"case when condition_type_concept_id in {quoted(R.PRIMARY_NAMED_TYPES)} then type_name end",
    pdx='''case when enc_type in ('IP', 'EI') and dx_origin = 'OD'
        and count(*) filter (pdx = 'P') over (partition by visit_occurrence_id, enc_type, dx_origin) = 0
        and row_number() over (partition by visit_occurrence_id, enc_type, dx_origin order by cast(condition_occurrence_id as varchar)) = 1
        then 'P' else pdx end''')} from o_diag_fixed"""
case("pipe_diagnosis", "select * from o_diagnosis")(encounters.diagnosis)

VIEWS["o_cond_base"] = f"""select 'c' || co.condition_occurrence_id as conditionid, co.person_id, co.visit_occurrence_id,
        co.condition_start_date as report_date, co.condition_end_date as resolve_date,
        case when co.condition_end_date is null then 'AC' else 'RS' end as condition_status,
        {_code(first_listed(_RAW))} as dx, {_CODE_TYPE} as dx_type, trim({part(_RAW, 3)}) as raw3,
        case when co.condition_type_concept_id in {quoted(R.PROBLEM_LIST_TYPES)} then 'HC' else 'PR' end as condition_source,
        co.condition_status_source_value as raw_condition_status, {_TWO_PARTS} as raw_condition, src.vocabulary_id as raw_condition_type
    from condition_occurrence co join concept std on std.concept_id = co.condition_concept_id and std.vocabulary_id = 'SNOMED'
    join concept src on src.concept_id = co.condition_source_concept_id
    where co.condition_start_date >= {SINCE} and length(trim({part(_RAW, 3)})) <= 18
        and co.person_id in (select person_id from cohort_person)
        and (co.condition_type_concept_id in {quoted(R.COMPLAINT_TYPES)}
            or (co.condition_type_concept_id in {quoted(R.PROBLEM_LIST_TYPES)} and not regexp_matches({_RAW}, 'NOD.X')))"""
_OBSERVED = """'o' || observation_id as conditionid, person_id, visit_occurrence_id, observation_date as report_date,
        null as resolve_date, 'AC' as condition_status"""
case("pipe_condition", f"""select {blank(
    "condition", condition="dx", condition_source="condition_source", condition_status="condition_status",
    condition_type="dx_type", conditionid="conditionid", encounterid="visit_occurrence_id", patid="person_id",
    raw_condition="raw_condition", raw_condition_status="raw_condition_status", raw_condition_type="raw_condition_type",
    report_date="report_date", resolve_date="resolve_date")} from (
        select * exclude (raw3) from ({_recovered("o_cond_base", "r.dx_type in ('SM', 'OT') and r.condition_source = 'HC'")})
        union select {_OBSERVED}, 'COVID' as dx, 'AG' as dx_type, 'PR', null, null, null from observation_derivation_covid
            where observation_concept_id = 2000001411 and value_as_concept_id in {quoted(R.DERIVED_ANSWERS)}
                and observation_date >= {SINCE} and person_id in (select person_id from cohort_person)
        union select {_OBSERVED}, cm.concept_code, cm.code_type, 'CC', null, observation_source_value, cm.vocabulary_id
            from observation join (select distinct on (lower(complaint_text)) * from complaint_map
                order by lower(complaint_text), concept_code, code_type, vocabulary_id) cm
                on lower(cm.complaint_text) = lower(observation_source_value)
            where observation_concept_id = {R.COMPLAINT_QUESTION} and site = '{SITE}' and observation_date >= {SINCE}
                and person_id in (select person_id from cohort_person))
    where visit_occurrence_id is null or visit_occurrence_id not in (
        select visit_occurrence_id from visit_occurrence where visit_start_date < {SINCE})""")(encounters.condition)

VIEWS["o_procedures"] = f"""select {blank("procedures", **{c: c for c in (
    "admit_date enc_type encounterid patid ppx proceduresid providerid px px_date px_source px_type raw_ppx raw_px raw_px_type").split()})}
    from (select po.procedure_occurrence_id::varchar as proceduresid, enc.patid, enc.encounterid, enc.enc_type, enc.admit_date, enc.providerid,
            procedure_date as px_date, coalesce(c1.concept_code, c2.concept_code,
                case when left({part("procedure_source_value", 2)}, 11) in ('', ' ') then 'NI' else ltrim(left({part("procedure_source_value", 2)}, 11)) end) as px,
            coalesce({mapped("Procedure Code Type", "coalesce(c1.vocabulary_id, c2.vocabulary_id)")}, 'OT') as px_type,
            coalesce({mapped("px source", "procedure_type_concept_id")}, 'OT') as px_source,
            coalesce({mapped("ppx", "procedure_type_concept_id")}, 'OT') as ppx, {part("procedure_source_value", 1)} as raw_px,
            coalesce(c1.vocabulary_id, c2.vocabulary_id, 'OT') as raw_px_type, procedure_type_concept_id::varchar as raw_ppx
        from procedure_occurrence po
        join o_encounter enc on enc.encounterid = po.visit_occurrence_id::varchar and enc.patid = po.person_id::varchar
        left join concept c1 on c1.concept_id = procedure_concept_id and c1.vocabulary_id in {quoted(R.PROCEDURE_VOCABULARIES)}
        left join concept c2 on c2.concept_id = procedure_source_concept_id and c2.vocabulary_id in {quoted(R.PROCEDURE_VOCABULARIES)}
        where procedure_date >= {SINCE}
            and procedure_concept_id not in (select concept_id from concept where concept_class_id in {quoted(R.EXCLUDED_PROCEDURE_CLASSES)})
            and procedure_source_concept_id not in (select concept_id from concept where concept_class_id in {quoted(R.EXCLUDED_PROCEDURE_CLASSES)})
        union all
        select 'i' || immunization_id, enc.patid, enc.encounterid, enc.enc_type, enc.admit_date, enc.providerid, immunization_date,
            {decoded("immunization_concept_id", D.VACCINE_PROCEDURES, "null")}, 'CH', 'DR', 'OT', {part("immunization_source_value", 1)}, 'CVX',
            immunization_type_concept_id::varchar
        from immunization im
        join o_encounter enc on enc.encounterid = im.visit_occurrence_id::varchar and enc.patid = im.person_id::varchar
        where immunization_concept_id in {quoted(list(D.VACCINE_PROCEDURES))} and immunization_date >= {SINCE})
    where not coalesce((px_type = '10' and length(px) <> 7) or (px_type = 'CH' and length(px) < 5), false)"""
case("pipe_procedures", "select * from o_procedures")(encounters.procedures)

# --- drugs --------------------------------------------------------------------------------------

_TEXT = "drug_source_value"
case("pipe_med_admin", f"""select {blank(
    "med_admin", encounterid="visit_occurrence_id", medadmin_code="code", medadmin_type="code_type",
    medadmin_dose_admin="effective_drug_dose", medadmin_providerid="provider_id", medadmin_source="'OD'",
    medadmin_dose_admin_unit="coalesce(" + mapped("Dose unit", "dose_unit_concept_id") + ", 'OT')",
    medadmin_route="coalesce(" + mapped("Route", "route_concept_id") + ", 'OT')",
    medadmin_start_date="drug_exposure_start_date", medadmin_start_time=clock("drug_exposure_start_datetime"),
    medadmin_stop_date="drug_exposure_end_date", medadmin_stop_time=clock("drug_exposure_end_datetime"),
    medadminid="drug_exposure_id", patid="person_id", raw_medadmin_code="drug_concept_id",
    raw_medadmin_dose_admin="eff_drug_dose_source_value", raw_medadmin_dose_admin_unit="dose_unit_source_value",
    raw_medadmin_med_name="rx_name", raw_medadmin_route="route_source_value")}
    from (select * replace (coalesce(fixed, code) as code, case when fixed is null then code_type else 'RX' end as code_type) from (
        select *, case when drug_concept_id in (967823, 46276153) and {_TEXT} ilike '%sodium chloride 0.9%' then '313002'
                when drug_concept_id = 43011476 and {_TEXT} ilike '%heparin 100 units/ml%' then '1361048'
                when drug_concept_id = 1367571 and {_TEXT} ilike '%heparin 2 unit/ml%' then '1362935'
                when drug_concept_id = 1367571 and ({_TEXT} ilike '%heparin 1 unit/ml%'
                    or {_TEXT} ilike '%heparin (porcine) 250 unit/250 ml (1 unit/ml)%') then '1362025' end as fixed
        from (select de.*, rx.concept_name as rx_name,
                coalesce(ndc.concept_code, txt.concept_code, case when rx.concept_id > 0 then rx.concept_code end) as code,
                case when ndc.concept_code is not null or txt.concept_code is not null then 'ND' when rx.concept_id > 0 then 'RX' else 'OT' end as code_type
            from drug_exposure de semi join (select visit_id as visit_occurrence_id from cohort) using (visit_occurrence_id)
            left join concept ndc on ndc.vocabulary_id = 'NDC' and ndc.concept_id = drug_source_concept_id
            left join (select distinct concept_code from concept where vocabulary_id = 'NDC') txt on txt.concept_code = {part(_TEXT, 1)}
            left join concept rx on rx.vocabulary_id = 'RxNorm' and rx.concept_id = drug_concept_id
            where drug_type_concept_id = 38000180 and drug_exposure_start_date >= {SINCE})
        where not (coalesce({keywords(_TEXT, D.DENIED_WORDS)}, false) and coalesce(code not in (select concept_code from concept
            where vocabulary_id = 'RxNorm' and concept_class_id in {quoted(D.KEPT_DRUG_CLASSES)}), true))))""")(drugs.med_admin)

_LEAST = """(select rx.concept_id, min(nd.concept_code) as least_ndc from concept nd
        join concept_relationship e on e.concept_id_1 = nd.concept_id and e.relationship_id = 'Maps to'
        join concept rx on rx.concept_id = e.concept_id_2 and rx.vocabulary_id = 'RxNorm'
        where nd.vocabulary_id = 'NDC' and nd.concept_class_id = '11-digit NDC' group by 1)"""
case("pipe_dispensing", f"""select {blank(
    "dispensing", dispense_amt="quantity", dispense_date="drug_exposure_start_date",
    dispense_dose_disp="cast(effective_drug_dose as decimal(15,3))",
    dispense_dose_disp_unit="coalesce(" + mapped("Dose unit", "dose_unit_concept_id") + ", 'OT')",
    dispense_route="coalesce(" + mapped("Route", "route_concept_id") + ", 'OT')", dispense_source="'PM'",
    dispense_sup="case when days_supply <> 0 then days_supply end", dispensingid="drug_exposure_id",
    ndc=f"coalesce(ndc.concept_code, lx.least_ndc, left({part(_TEXT, 1)}, 11))", patid="person_id",
    raw_dispense_dose_disp="eff_drug_dose_source_value", raw_dispense_dose_disp_unit="dose_unit_source_value",
    raw_dispense_route="route_source_value", raw_ndc=_TEXT)}
    from drug_exposure de left join {_LEAST} lx on lx.concept_id = drug_concept_id
    left join concept ndc on ndc.vocabulary_id = 'NDC' and ndc.concept_id = drug_source_concept_id
    where drug_type_concept_id = 38000175 and person_id in (select person_id from cohort_person)
        and not {keywords(_TEXT, D.DENIED_WORDS)}
        and (lx.least_ndc is not null or ndc.concept_id is not null
            or {part(_TEXT, 1)} in (select concept_code from concept where vocabulary_id = 'NDC'))""")(drugs.dispensing)

case("pipe_prescribing", f"""select {blank(
    "prescribing", encounterid="visit_occurrence_id", patid="person_id", prescribingid="drug_exposure_id",
    raw_rx_dose_ordered="eff_drug_dose_source_value", raw_rx_dose_ordered_unit="dose_unit_source_value",
    raw_rx_frequency="frequency", raw_rx_med_name=f"coalesce(rx.concept_name, replace({part(_TEXT, 1)}, chr(34), ''))",
    raw_rx_refills="refills", raw_rx_route="route_source_value", raw_rxnorm_cui="rawc.concept_code",
    rx_basis="case drug_type_concept_id when 38000177 then '01' else '02' end", rx_days_supply="days_supply",
    rx_dispense_as_written="coalesce(" + mapped("dispense written", "dispense_as_written_concept_id") + ", 'OT')",
    rx_dose_form="coalesce(form.code, 'OT')", rx_dose_ordered="effective_drug_dose",
    rx_dose_ordered_unit="coalesce(" + mapped("Dose unit", "dose_unit_concept_id") + ", 'OT')",
    rx_end_date="drug_exposure_end_date", rx_frequency="coalesce(" + mapped("Rx Frequency", "trim(lower(frequency))") + ", 'OT')",
    rx_order_date="drug_exposure_start_date", rx_order_time=clock("drug_exposure_start_datetime"),
    rx_prn_flag="case when lower(frequency) like '%as needed%' or lower(frequency) like '%prn%' then 'Y' else 'N' end",
    rx_providerid="provider_id", rx_quantity="round(quantity, 2)", rx_refills="refills",
    rx_route="coalesce(" + mapped("Route", "route_concept_id") + ", 'OT')", rx_source="'OD'",
    rx_start_date="drug_exposure_start_date", rxnorm_cui="left(rx.concept_code, 8)")}
    from drug_exposure de
    left join concept rx on rx.concept_id = drug_concept_id and rx.vocabulary_id = 'RxNorm'
    left join concept rawc on rawc.concept_id = drug_source_concept_id
    left join (select concept_id_1, min({mapped("Rx Dose Form", "concept_id_2")}) as code from concept_relationship
        where relationship_id = 'RxNorm has dose form' group by 1) form on form.concept_id_1 = drug_concept_id
    where drug_type_concept_id in (38000177, 581373) and drug_exposure_start_date >= {SINCE}
        and person_id in (select person_id from cohort_person)
        and (visit_occurrence_id is null or visit_occurrence_id in (select visit_id from cohort))
        and not {keywords(_TEXT, D.DENIED_WORDS)}""")(drugs.prescribing)

_VX = "im.immunization_source_value"
_VX_RULES = " ".join(f"when contains(lower({_VX}), '{p}') then '{t}'" for p, t in D.VACCINE_TEXT)
_DOSE = "nullif(regexp_replace(immunization_dose, '[^0-9.]', '', 'g'), '')"
VIEWS["o_vx"] = f"""select im.*, c.concept_code as vx_concept_code, c.vocabulary_id as vx_voc, c.concept_name as vx_name,
        left(case when immunization_concept_id <> 0 then c.concept_code
            when left(trim({part(_VX, 2)}), 11) <> '' then left(trim({part(_VX, 2)}), 11) {_VX_RULES} else '999' end, 11) as vx_code
    from immunization im left join concept c on c.concept_id = immunization_concept_id
    where (visit_occurrence_id is null or visit_occurrence_id in (select visit_id from cohort))
        and person_id in (select person_id from cohort_person)"""
case("pipe_immunization", f"""select {blank(
    "immunization", encounterid="visit_occurrence_id", immunizationid="immunization_id", patid="person_id",
    proceduresid="case when procedure_occurrence_id in (select p.procedure_occurrence_id from procedure_occurrence p) then procedure_occurrence_id end",
    raw_vx_body_site="imm_body_site_source_value", raw_vx_code="vx_concept_code", raw_vx_code_type="vx_voc",
    raw_vx_dose="immunization_dose", raw_vx_dose_unit="imm_dose_unit_source_value", raw_vx_name="replace(vx_name, ',', '')",
    raw_vx_route="imm_route_source_value", raw_vx_status="'CP'", vx_admin_date="immunization_date",
    vx_body_site="coalesce(" + mapped("imm_body_site", "imm_body_site_concept_id") + f''', (select min(m.target_code) from value_map m
        where m.source_class = 'imm_body_site_source' and trim({part("imm_body_site_source_value", 1)}) <> ''
        and contains(lower(m.source_code), lower(trim({part("imm_body_site_source_value", 1)})))), 'NI')''',
    vx_code="vx_code", vx_code_type='''case when vx_voc = 'CVX' then 'CX' when vx_voc = 'NDC' then 'ND' when vx_voc ilike 'rxnorm%' then 'RX'
        when vx_voc in ('CPT4', 'HCPCS') then 'CH' when vx_code in (select concept_code from concept where vocabulary_id = 'CVX') then 'CX' else 'UN' end''',
    vx_dose=f'''case when length(immunization_dose) <= 8 then cast(try_cast({_DOSE} as decimal(10,0)) as decimal(20,5))
        else try_cast(left({_DOSE}, 8) as decimal(20,5)) end''',
    vx_dose_unit="coalesce(" + mapped("Dose unit", "imm_dose_unit_concept_id") + ", 'OT')", vx_exp_date="imm_exp_date",
    vx_lot_num="replace(imm_lot_num, chr(34), '')", vx_manufacturer="case when coalesce(imm_manufacturer, '') = '' then 'NI' else coalesce((select min(m.target_code) from value_map m "
        "where m.source_class = 'vx_manufacturer_source' and contains(lower(m.target_label), lower(imm_manufacturer))), "
        + mapped("vx_manufacturer", "imm_manufacturer") + ", 'OTH') end",
    vx_providerid="provider_id", vx_record_date="imm_recorded_date", vx_route="coalesce(" + mapped("Route", "imm_route_concept_id") + ", 'OT')",
    vx_source="coalesce((select t.concept_code from concept t where t.concept_id = immunization_type_concept_id and t.domain_id = 'Immunization Type'), 'OT')",
    vx_status="'CP'")} from o_vx""")(drugs.immunization)

# --- laboratory ---------------------------------------------------------------------------------

_MOD = mapped("Result modifier", "operator_concept_id")
_LO_ID, _HI_ID = "range_low_operator_concept_id", "range_high_operator_concept_id"
VIEWS["o_lab_base"] = f"""select m.*, c1.concept_code as loinc, c1.concept_name as loinc_name, c2.concept_code as raw_loinc,
        op.concept_name as op_name, {_MOD} as mod,
        case when {_HI_ID} = {_LO_ID} then 'EQ|EQ' {" ".join(
            f"when {_LO_ID} in {quoted(lo)} and {_HI_ID} in {quoted(hi)} then '{v}'" for lo, hi, v in L.RANGE_PAIRS)}
            else {mapped("Result modifier", _HI_ID)} || '|' || {mapped("Result modifier", _LO_ID)} end as pair,
        coalesce({mapped("Specimen concept", "specimen_concept_id")}, {mapped("specimen_loinc", "c1.concept_code")}, 'OT') as spec1,
        {mapped("specimen_source", f"trim(lower({part('specimen_source_value', 1)}))")} as spec2,
        coalesce({mapped("Result unit", "unit_concept_id")}, {mapped("result_unit_source", "trim(unit_source_value)")}) as unit0,
        (select min(v.target_code) from value_map v where v.source_class in ('Result unit', 'result_unit_source')
            and lower(v.target_code) = lower(unit_source_value)) as unit_spelled
    from measurement m join concept c1 on c1.concept_id = measurement_concept_id and c1.vocabulary_id = 'LOINC' and c1.concept_class_id = 'Lab Test'
    left join concept c2 on c2.concept_id = measurement_source_concept_id and c2.vocabulary_id = 'LOINC' and c2.concept_class_id = 'Lab Test'
    left join concept op on op.concept_id = operator_concept_id and op.domain_id = 'Meas Value Operator'
    where measurement_type_concept_id = {L.LAB_RECORD_TYPE} and measurement_concept_id > 0 and measurement_date >= {SINCE}
        and visit_occurrence_id in (select visit_id from cohort)"""
_RAW_UNIT = "case " + " ".join(
    f"when unit_source_value in {quoted(raws)} then '{unit}'" for unit, raws in L.RAW_UNITS) + " end"
_UNKNOWN = quoted(L.UNKNOWN_UNITS)
VIEWS["o_lab_units"] = f"""select *, case when spec1 = 'OT' then coalesce(spec2, 'OT') else spec1 end as spec,
        case when unit1 is null or unit1 in {_UNKNOWN} then coalesce({_RAW_UNIT}, unit1) else unit1 end as unit2
    from (select *, case when unit0 in ('', 'OT', 'NI') then unit_spelled else unit0 end as unit1 from o_lab_base)"""
VIEWS["o_lab_tests"] = f"""select *, case when (loinc in {quoted(L.RATIO_CODES)} or {keywords("loinc_name", L.RATIO_NAMES)})
            and unit3 in {_UNKNOWN} then '{{ratio}}' else unit3 end as unit4
    from (select *, case when (loinc in {quoted(L.PH_CODES)} or {keywords("loinc_name", L.PH_NAMES)}) and unit2 in {_UNKNOWN}
            then '[pH]' else unit2 end as unit3 from o_lab_units)"""
VIEWS["o_lab_mods"] = f"""select *, regexp_replace(cast(range_low as varchar), '\\.0$', '') as low_text, regexp_replace(cast(range_high as varchar), '\\.0$', '') as high_text,
        (loinc in {quoted(L.ABSOLUTE_COUNT_CODES)} and coalesce(unit4 in {quoted(L.PER_MICROLITRE)}, false)) as scaled,
        trim({part("pair", 1)}) as p1, trim({part("pair", 2)}) as p2,
        coalesce(case when operator_concept_id <> 0 then mod end, case when p1 in ('EQ', 'GE', 'GT') then p1 when p2 in ('EQ', 'LE', 'LT') then p2 end,
            case when value_as_number is not null then 'EQ' end, mod) as m0,
        coalesce(case when mod = 'EQ' then 'EQ' when mod in ('GE', 'GT') then mod when mod in ('LE', 'LT') then 'NO' end, p1) as l0,
        coalesce(case when mod = 'EQ' then 'EQ' when mod in ('GE', 'GT') then 'NO' when mod in ('LE', 'LT') then mod end, p2) as h0
    from o_lab_tests"""


def repair_views(source: str, prefix: str) -> str:
    """Chain of views, one per repair step, over columns m0, l0, h0, low_text, high_text."""
    rel = source
    for i, (accepted, new, bounds) in enumerate(labs.repair_steps()):
        tests = []
        for col, values in zip(("m0", "l0", "h0"), accepted):
            known = quoted(sorted(v for v in values if v is not None))
            tests.append(f"({col} in {known}" + (f" or {col} is null)" if None in values else ")"))
        tests += [f"{c} is {'not ' if there else ''}null" for c, there in zip(("low_text", "high_text"), bounds) if there is not None]
        when = " and ".join(tests)
        sets = ", ".join(f"case when {when} then '{n}' else {c} end as {c}" for c, n in zip(("m0", "l0", "h0"), new) if n is not None)
        VIEWS[f"{prefix}_{chr(97 + i)}"] = f"select * replace ({sets}) from {rel}"
        rel = f"{prefix}_{chr(97 + i)}"
    return rel


_REPAIRED = repair_views("o_lab_mods", "o_repair")
case("pipe_lab", f"""select {blank(
    "lab_result_cm", encounterid="visit_occurrence_id", lab_loinc="case when loinc = '20584-9' and spec = 'BLD' then '26464-8' else loinc end",
    lab_loinc_source="'LM'", lab_order_date="measurement_order_date", lab_result_cm_id="measurement_id", lab_result_source="'OD'",
    norm_modifier_high="h0", norm_modifier_low="l0", norm_range_high="left(high_text, 10)", norm_range_low="left(low_text, 10)",
    patid="person_id", priority=mapped("Lab priority", "priority_concept_id"), raw_lab_code="raw_loinc", raw_lab_name="loinc_name",
    raw_result=r"op_name || regexp_replace(cast(value_as_number as varchar), '\.0$', '')", raw_unit="unit_source_value",
    result_date="coalesce(measurement_result_date, measurement_date)",
    result_loc="case when starts_with(measurement_source_value, 'POC') then 'P' else 'L' end", result_modifier="m0",
    result_num="case when scaled then value_as_number / 1000 else value_as_number end",
    result_qual=classified("value_source_value", RESULT_TEXT, mapped("Result qualifier", "value_as_concept_id")),
    result_time=clock("measurement_result_datetime"), result_unit="case when scaled then '10*3/uL' else unit4 end",
    specimen_date="measurement_date", specimen_source="spec",
    specimen_time="hour(measurement_datetime) || ':' || minute(measurement_datetime)")} from {_REPAIRED}""")(labs.lab_result)

# --- vital signs and observations ---------------------------------------------------------------

VIEWS["o_signs"] = f"""select * from measurement where measurement_concept_id in {quoted(R.VITAL_CONCEPTS)}
        and measurement_date >= {SINCE} and visit_occurrence_id in (select visit_id from cohort)
        and person_id in (select person_id from cohort_person)"""
VIEWS["o_tobacco"] = f"""select t.visit_occurrence_id, t.observation_datetime, coalesce(t.target_code, 'OT') as tobacco,
        ty.tobacco_type, sm.smoking
    from (select o.*, m.target_code from observation o join value_map m on m.source_class = 'tobacco'
            and m.value_code = cast(value_as_concept_id as varchar) where observation_concept_id = {R.TOBACCO}) t
    left join fact_relationship f on f.fact_id_1 = t.observation_id
    """ + "".join(f"""left join (select o.observation_id, coalesce(m.target_code, 'OT') as {out} from observation o
            join value_map m on m.source_class = '{cls}' and m.value_code = cast(value_as_concept_id as varchar)
            where observation_concept_id = {q} and observation_date >= {SINCE} and visit_occurrence_id in (select visit_id from cohort)
                and person_id in (select person_id from cohort_person)) {t} on {t}.observation_id = f.fact_id_2
    """ for out, cls, q, t in [("tobacco_type", "tobacco type", R.TOBACCO_TYPE, "ty"), ("smoking", "smoking", R.SMOKING, "sm")])
VIEWS["o_wide"] = f"""select distinct b.person_id, b.visit_occurrence_id, b.measurement_date, b.measurement_datetime,
        ht.value_as_number as ht, wt.value_as_number as wt, bmi.value_as_number as bmi, sys.value_as_number as systolic,
        sys.measurement_concept_id as sys_concept, sys.measurement_source_value as sys_raw,
        dia.value_as_number as diastolic, dia.measurement_source_value as dia_raw
    from o_signs b """ + "".join(f"""
    left join o_signs {t} on {t}.visit_occurrence_id = b.visit_occurrence_id and {t}.measurement_datetime = b.measurement_datetime
        and {t}.measurement_concept_id in {quoted(ids)}""" for t, ids in [
            ("ht", [R.HEIGHT]), ("wt", [R.WEIGHT]), ("bmi", [R.BODY_MASS]), ("sys", R.SYSTOLIC)]) + f"""
    left join fact_relationship f on f.fact_id_1 = sys.measurement_id and f.domain_concept_id_1 = 21 and f.domain_concept_id_2 = 21
    left join o_signs dia on dia.measurement_id = f.fact_id_2 and dia.visit_occurrence_id = b.visit_occurrence_id
        and dia.measurement_concept_id in {quoted(R.DIASTOLIC)}"""
_VITAL = {
    "bp_position": "left(coalesce(" + mapped("BP Position", "sys_concept") + ", 'OT'), 2)", "diastolic": "diastolic",
    "encounterid": "w.visit_occurrence_id::varchar", "ht": "ht * 0.393701::double", "measure_date": "measurement_date",
    "measure_time": clock("measurement_datetime"), "original_bmi": "bmi", "patid": "person_id::varchar", "raw_diastolic": "dia_raw",
    "raw_smoking": "smoking", "raw_systolic": "sys_raw", "raw_tobacco": "tobacco", "raw_tobacco_type": "tobacco_type",
    "smoking": "left(smoking, 2)", "systolic": "systolic", "tobacco": "left(tobacco, 2)", "tobacco_type": "left(tobacco_type, 2)",
    "vital_source": "'HC'", "wt": "wt * 2.20462::double"}
_VITAL_KEY = "sha256(" + " || '|' || ".join(
    "coalesce('=' || " + (f"printf('%.6f', {c})" if c in ("diastolic", "ht", "original_bmi", "systolic", "wt") else f"{c}::varchar") + ", '~')"
    for c in _VITAL) + ")"
case("pipe_vital", f"""select {blank("vital", vitalid=_VITAL_KEY, **{c: c for c in _VITAL})} from (
    select distinct {", ".join(f"{e} as {c}" for c, e in _VITAL.items())}
    from o_wide w left join o_tobacco t on t.visit_occurrence_id = w.visit_occurrence_id and t.observation_datetime = w.measurement_datetime
    where coalesce(ht, wt, diastolic, systolic, bmi) is not null)""")(vitals.vital)


_CLIN_TIME = clock("measurement_datetime")
case("pipe_obs_clin", f"""select {blank("obs_clin", **{c: c for c in TABLES["obs_clin"].columns if c not in (
        "obsclin_result_num", "obsclin_stop_date", "obsclin_stop_time", "raw_obsclin_modifier", "obsclin_source")}, obsclin_source="'HC'")}
    from (select 'm' || measurement_id as obsclinid, m.person_id as patid, visit_occurrence_id as encounterid, provider_id as obsclin_providerid,
            measurement_date as obsclin_start_date, {_CLIN_TIME} as obsclin_start_time,
            case measurement_concept_id when 4353936 then 'SM' else 'LC' end as obsclin_type,
            case measurement_concept_id when 4353936 then '250774007' else c.concept_code end as obsclin_code,
            case measurement_concept_id when 4353936 then '250774007' end as obsclin_result_snomed,
            coalesce({mapped("abnormal_indicator", "value_as_concept_id")}, 'NI') as obsclin_abn_ind,
            {classified("value_source_value", RESULT_TEXT, mapped("Result qualifier", "value_as_concept_id"))} as obsclin_result_qual,
            regexp_replace(value_as_number::varchar, '\\.0$', '') as obsclin_result_text,
            replace(coalesce({_MOD}, 'OT'), 'NO', 'UN') as obsclin_result_modifier, {mapped("Result unit", "unit_concept_id")} as obsclin_result_unit,
            regexp_replace(value_as_number::varchar, '\\.0$', '') as raw_obsclin_result, unit_concept_name as raw_obsclin_unit,
            null as raw_obsclin_name, null as raw_obsclin_type, null as raw_obsclin_code
        from measurement m left join concept c on c.concept_id = measurement_concept_id and c.vocabulary_id = 'LOINC'
        where measurement_concept_id in {quoted(R.CLINICAL_CONCEPTS)} and m.person_id in (select person_id from cohort_person)
            and (visit_occurrence_id is null or visit_occurrence_id in (select visit_id from cohort))
        union all
        select 'o' || observation_id, o.person_id, visit_occurrence_id, provider_id, observation_date, {clock("observation_datetime")}, 'SM',
            c.concept_code, c.concept_code, coalesce({mapped("abnormal_indicator", "value_as_concept_id")}, 'NI'),
            coalesce({mapped("Result qualifier", "qualifier_concept_id")}, 'NI'), value_as_string, null, null, null, null, null, null, null
        from observation o left join concept c on c.concept_id = try_cast(value_as_string as bigint) and c.vocabulary_id = 'SNOMED'
        where observation_concept_id = {R.VAPING_QUESTION} and value_as_concept_id in {quoted(R.VAPING_ANSWERS)} and observation_date >= {SINCE}
            and o.person_id in (select person_id from cohort_person)
            and (visit_occurrence_id is null or visit_occurrence_id in (select visit_id from cohort))
        union all
        select 'p' || person_id, person_id, null, provider_id, birth_date, {clock("birth_datetime")}, 'LC', '18185-9', null, 'NI', 'NI',
            pn_gestational_age::varchar, 'NI', 'wk', pn_gestational_age::varchar, 'week', 'Gestational age', 'LOINC', '18185-9'
        from person where pn_gestational_age is not null and person_id in (select person_id from cohort_person))""")(observations.obs_clin)

VIEWS["o_places"] = """select entity_id as person_id, location_id, site, start_date, end_date from location_history where trim(lower(domain_id)) = 'person'
    union select person_id, location_id, site, null, null from person p where not exists (select 1 from location_history h
        where trim(lower(h.domain_id)) = 'person' and h.entity_id = p.person_id and h.location_id = p.location_id)"""
_BLOCK = "geocode_state || geocode_county || geocode_tract || geocode_group || geocode_block"
VIEWS["o_general"] = f"""select 'a' || adt_occurrence_id as obsgenid, a.person_id as patid, a.visit_occurrence_id as encounterid,
            v.provider_id as obsgen_providerid, adt_date as obsgen_start_date, {clock("adt_datetime")} as obsgen_start_time,
            visit_end_date as obsgen_stop_date, {clock("visit_end_datetime")} as obsgen_stop_time, 'PC_COVID' as obsgen_type, '2000' as obsgen_code,
            'Y' as obsgen_result_text, 'DR' as obsgen_source, null as obsgen_abn_ind, null as obsgen_result_qual, null as obsgen_result_num,
            null as obsgen_result_modifier, null as obsgen_result_unit, null as obsgen_id_modified, null as obsgen_table_modified,
            null as raw_obsgen_code, null as raw_obsgen_name, null as raw_obsgen_result, null as raw_obsgen_type, null as raw_obsgen_unit
        from adt_occurrence a join visit_occurrence v on v.visit_occurrence_id = a.visit_occurrence_id and v.visit_start_date = adt_date
        where service_concept_id in {quoted(R.ICU_SERVICES)}
        union all
        select 'm' || measurement_id, person_id, visit_occurrence_id, provider_id, measurement_date, {_CLIN_TIME}, null, null, 'PC_COVID', '1000',
            case measurement_concept_id when 2000001422 then 'Y' else 'N' end, 'HC', coalesce({mapped("abnormal_indicator", "value_as_concept_id")}, 'NI'),
            {classified("value_source_value", GENERAL_RESULT_TEXT, mapped("Result qualifier", "value_as_concept_id"))}, value_as_number,
            replace({_MOD}, 'NO', 'UN'), coalesce({mapped("Result unit", "unit_concept_id")}, '{{ratio}}'), null, null, null, null,
            regexp_replace(value_as_number::varchar, '\\.0$', ''), null, unit_concept_name || unit_source_value
        from measurement where measurement_concept_id in {quoted(R.GENERAL_MEASUREMENTS)}
        union all
        select 'd' || device_exposure_id, d.person_id, d.visit_occurrence_id, d.provider_id, device_exposure_start_date,
            {clock("device_exposure_start_datetime")}, device_exposure_end_date, {clock("device_exposure_end_datetime")}, 'PC_COVID', '3000',
            case when device_exposure_start_date <= visit_start_date and device_exposure_end_date > visit_start_date then 'Y' else 'N' end, 'DR',
            null, null, null, null, null, null, null, c.concept_code, c.concept_name, null, c.vocabulary_id, null
        from device_exposure d join visit_occurrence v on v.visit_occurrence_id = d.visit_occurrence_id
        left join concept c on c.concept_id = device_concept_id and c.vocabulary_id = 'SNOMED' and c.domain_id = 'Device'
        where device_concept_id in {quoted(R.DEVICE_CONCEPTS)}
        union all
        select 'L' || sha256('=' || geocode_id || '|=' || location_id || '|=' || person_id || '|' || coalesce('=' || start_date::varchar, '~') || '|'
                || coalesce('=' || end_date::varchar, '~') || '|' || coalesce('=' || site, '~')), person_id, null, null, coalesce(start_date, date '{TODAY}'), null,
            end_date, null, 'LC', '49084-7', {_BLOCK}, null, null, null, null, null, null, location_id::varchar, 'LDS', null, 'Census Block Group',
            location_id || ' - ' || {_BLOCK}, geocode_year::varchar, geocode_shapefile
        from o_places join location_fips using (location_id) where person_id in (select person_id from cohort_person)"""
case("pipe_obs_gen", "select " + blank("obs_gen", **{c: c for c in TABLES["obs_gen"].columns}) + " from o_general")(observations.obs_gen)

_Q, _A = "observation_concept_id", "value_as_concept_id"
_ITEM, _SCORE = f"{_Q} in {quoted(R.SURVEY_ITEMS)}", f"{_Q} in {quoted(R.SURVEY_SCORES)}"
_HUNGER = f"{_Q} in (40192517, 40192426)"
_YES = f"({_A} = {R.YES} or coalesce(value_as_string, '') in {quoted(R.YES_TEXTS)})"
_NO = f"({_A} = {R.NO} or coalesce(value_as_string, '') in {quoted(R.NO_TEXTS)})"
case("pipe_pro_cm", f"""select {blank(
    "pro_cm", encounterid="visit_occurrence_id", patid="o.person_id", pro_cm_id="observation_id", pro_date="observation_date",
    pro_time=clock("observation_datetime"), pro_type="'LC'",
    pro_item_loinc=f"case when {_ITEM} then q.concept_code when {_Q} = 40192517 then '88122-7' when {_Q} = 40192426 then '88123-5' end",
    pro_item_fullname=f"case when {_ITEM} then q.concept_name when {_Q} = 40192517 then {quoted([R.HUNGER_ITEM_NAMES[40192517]])[1:-1]} "
                      f"when {_Q} = 40192426 then {quoted([R.HUNGER_ITEM_NAMES[40192426]])[1:-1]} end",
    pro_measure_fullname=f"case when {_SCORE} then q.concept_name when {_Q} = 37116643 then 'Food insecurity risk (Hunger Vital Sign)' end",
    pro_measure_loinc=f"case when {_SCORE} then a.concept_code when {_Q} = 37116643 then '88124-3' end",
    pro_measure_score=f"case when {_SCORE} then value_as_number end",
    pro_measure_seq=f"case when {_ITEM} or {_SCORE} then 'PHQ' else 'HVS' end || o.person_id || coalesce(visit_occurrence_id::varchar, '') "
                    "|| strftime(observation_date, '%Y%m%d') || strftime(observation_datetime, '%H') || '00'",
    pro_response_text=f'''case when {_ITEM} then a.concept_name when {_HUNGER} and {_YES} then 'Sometimes true'
        when {_HUNGER} and {_NO} then 'Never true' when {_HUNGER} then 'Don''t know or refused'
        when {_Q} = 37116643 and {_A} = {R.YES} then 'At risk' when {_Q} = 37116643 and {_A} <> {R.YES} then 'No Risk' end''',
    pro_response_num=f'''case when {_ITEM} or {_SCORE} then case {_A} when 45883172 then 0 when 45879886 then 1 end
        when {_YES} then 1 when {_NO} or {_A} = {R.NO_INFORMATION} then 0 end''')}
    from observation o left join concept q on q.concept_id = {_Q} left join concept a on a.concept_id = {_A}
    where {_Q} in {quoted(R.SURVEY_QUESTIONS)} and o.person_id in (select person_id from cohort_person)
        and (visit_occurrence_id is null or (visit_occurrence_id, o.person_id) in (select visit_id, person_id from cohort))""")(observations.survey)

# --- administration -----------------------------------------------------------------------------

NAMES = {"datamart_name": "unnamed", "datamartid": "X01", "network_name": "net", "networkid": "N1"}
_HARVEST = {**{f"{d}_mgmt": "'01'" for d in MANAGED_DATES}, **{f"refresh_{t}_date": f"date '{TODAY}'" for t in REFRESHED},
            "cdm_version": "'061'", "datamart_claims": "'01'", "datamart_ehr": "'02'", "datamart_platform": "'03'",
            "network_name": "'net'", "networkid": "'N1'", "datamart_name": "'North General'", "datamartid": "'N01'"}
