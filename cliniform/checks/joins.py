"""Lookups, cohort joins, crosswalks and links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..demo.adapter import FLOOR, SITE
from ..operators import lookup as lk
from ..operators import membership as mb
from ..operators.lookup import concept_lookup, lookup
from ..operators.sizing import attach
from ..plans import encounters, people, places, vitals
from ..plans.observations import person_locations
from ..rules import drugs as D
from ..rules import labs as L
from ..rules import visits as R
from .registry import case, mapped, quoted
from .targets import SINCE, part

case("join_valueset", f"""select drug_exposure_id, coalesce({mapped("Route", "route_concept_id")}, 'OT') as route from drug_exposure""")(
    lambda s: lookup(s["drug_exposure"], s.value_map, "Route", "route_concept_id", "route", default="OT").select("drug_exposure_id", "route"))
case("join_valueset_nullsafe", """select person_id, (select min(m.target_code) from value_map m where m.source_class = 'Race'
    and m.source_code is not distinct from cast(race_concept_id as varchar)) as race from person""")(
    lambda s: lookup(s["person"], s.value_map, "Race", "race_concept_id", "race", null_safe=True).select("person_id", "race"))
case("join_valueset_reverse", f"""select observation_id, coalesce(m.target_code, 'OT') as tobacco from observation
    join value_map m on m.value_code = cast(value_as_concept_id as varchar) and m.source_class = 'tobacco' where observation_concept_id = {R.TOBACCO}""")(
    lambda s: lookup(s["observation"].where(F.col("observation_concept_id") == R.TOBACCO), s.value_map, "tobacco", "value_as_concept_id",
                     "tobacco", by=lk.VALUE, default="OT", how="inner").select("observation_id", "tobacco"))


@case("join_valueset_composite", f"""select visit_payer_id, {mapped("Payer", "plan_class || '-' || plan_type")} as payer from visit_payer""")
def _composite(s) -> DataFrame:
    plan = F.concat("plan_class", F.lit("-"), "plan_type")
    return lookup(s["visit_payer"], s.value_map, "Payer", plan, "payer").select("visit_payer_id", "payer")


@case("join_valueset_pair", """select visit_occurrence_id, (select min(m.target_code) from value_map m where m.source_class = 'Facility type'
    and m.source_code = cast(visit_concept_id as varchar) and m.value_code = cast(specialty_concept_id as varchar)) as facility
    from visit_occurrence left join care_site using (care_site_id)""")
def _pair(s) -> DataFrame:
    sites = s["care_site"].select(F.col("care_site_id").alias("_cs"), "specialty_concept_id")
    df = attach(s["visit_occurrence"], sites, [(F.col("care_site_id"), "_cs")])
    return lk.lookup_pair(df, s.value_map, "Facility type", "visit_concept_id", "specialty_concept_id", {"facility": lk.TARGET}).select(
        "visit_occurrence_id", "facility")


case("join_valueset_cascade", "select encounterid, facility_type, raw_facility_type from o_encounter")(
    lambda s: encounters.encounter(s).select("encounterid", "facility_type", "raw_facility_type"))
case("join_text_norm", f"""select drug_exposure_id, {mapped("Rx Frequency", "trim(lower(frequency))")} as code from drug_exposure""")(
    lambda s: lookup(s["drug_exposure"], s.value_map, "Rx Frequency", F.trim(F.lower("frequency")), "code").select("drug_exposure_id", "code"))
case("join_like_contains", """select immunization_id, (select min(m.target_code) from value_map m where m.source_class = 'vx_manufacturer_source'
    and imm_manufacturer <> '' and contains(lower(m.target_label), lower(imm_manufacturer))) as maker from immunization""")(
    lambda s: lk.lookup_contained(s["immunization"], s.value_map, "vx_manufacturer_source", F.col("imm_manufacturer"), "maker", by=lk.LABEL)
    .select("immunization_id", "maker"))
case("join_case_key", """select location_id, (select min(m.target_code) from value_map m where m.source_class = 'address_state'
    and lower(trim(split_part(m.target_label, '=', case when length(state) = 2 then 1 else 2 end))) = lower(state)) as code from location""")(
    lambda s: places.state_code(s["location"], s.value_map, F.col("state"), "code").select("location_id", "code"))
case("join_vocab_inner", """select condition_occurrence_id, concept_code from condition_occurrence
    join concept on concept_id = condition_concept_id and vocabulary_id = 'SNOMED'""")(
    lambda s: concept_lookup(s["condition_occurrence"], s.concept, "condition_concept_id", {"concept_code": "concept_code"}, ["SNOMED"], how="inner")
    .select("condition_occurrence_id", "concept_code"))
case("join_vocab_left", """select measurement_id, concept_code, concept_name from measurement
    left join concept on concept_id = measurement_concept_id and vocabulary_id = 'LOINC' and concept_class_id = 'Lab Test'""")(
    lambda s: concept_lookup(s["measurement"], s.concept, "measurement_concept_id", {"concept_code": "concept_code", "concept_name": "concept_name"},
                             ["LOINC"], F.col("concept_class_id") == "Lab Test").select("measurement_id", "concept_code", "concept_name"))
case("join_era_vocab", """select person_id, death_date, cause_source_value, vocabulary_id as era from death left join
    (select distinct concept_code, vocabulary_id from concept) c on concept_code = cause_source_value
    and vocabulary_id = case when death_date < date '2015-10-01' then 'ICD9CM' else 'ICD10CM' end""")(
    lambda s: people.era_match(s["death"], s.concept, F.col("cause_source_value"), F.col("death_date"), "era").select(
        "person_id", "death_date", "cause_source_value", "era"))


@case("join_crosswalk", """select a.concept_code as package_code, b.concept_code as ingredient_code from concept a
    join concept_relationship on concept_id_1 = a.concept_id and relationship_id = 'Maps to' join concept b on concept_id_2 = b.concept_id
    where a.vocabulary_id = 'NDC' and b.vocabulary_id = 'RxNorm'""")
def _crosswalk(s) -> DataFrame:
    a = s.concept.where("vocabulary_id = 'NDC'").select(F.col("concept_id").alias("_a"), F.col("concept_code").alias("package_code"))
    b = s.concept.where("vocabulary_id = 'RxNorm'").select(F.col("concept_id").alias("_b"), F.col("concept_code").alias("ingredient_code"))
    return lk.crosswalk(a, "_a", s["concept_relationship"], D.MAPS_TO, b, "_b").select("package_code", "ingredient_code")


case("join_semi_cohort", "select measurement_id from measurement where person_id in (select person_id from cohort_person)")(
    lambda s: mb.keep_persons(s["measurement"], s.cohort).select("measurement_id"))
case("join_semi_codes", "select drug_exposure_id, split_part(drug_source_value, '|', 1) in (select concept_code from concept where vocabulary_id = 'NDC') as known "
     "from drug_exposure where drug_source_value is not null")(
    lambda s: mb.member_flag(s["drug_exposure"].where("drug_source_value is not null"), lk.codes_of(s.concept, "code", ["NDC"]),
                             fn.packed_field("drug_source_value", 1), "known").select("drug_exposure_id", "known"))
case("join_inner_fanout", "select distinct p.person_id, p.year_of_birth from person p join cohort c on c.person_id = p.person_id")(
    lambda s: mb.keep_persons(s["person"], s.cohort).select("person_id", "year_of_birth"))
case("join_inner_visit", "select d.device_exposure_id from device_exposure d join cohort c on c.visit_id = d.visit_occurrence_id")(
    lambda s: mb.keep_visits(s["device_exposure"], s.cohort).select("device_exposure_id"))
case("join_null_or_equal", """select distinct observation_id from observation o join cohort c on c.person_id = o.person_id
    and (o.visit_occurrence_id is null or o.visit_occurrence_id = c.visit_id)""")(
    lambda s: mb.keep_absent_or_same_visit(s["observation"], s.cohort).select("observation_id"))


@case("join_anti_null_aware", f"""select procedure_occurrence_id from procedure_occurrence where procedure_concept_id not in (
    select concept_id from concept where concept_class_id in {quoted(R.EXCLUDED_PROCEDURE_CLASSES)})""")
def _anti(s) -> DataFrame:
    excluded = s.concept.where(F.col("concept_class_id").isin(R.EXCLUDED_PROCEDURE_CLASSES)).select("concept_id")
    return mb.drop_members(s["procedure_occurrence"], excluded, ("procedure_concept_id", "concept_id")).select("procedure_occurrence_id")


case("join_anti_correlated", "select person_id, location_id, start_date, end_date from o_places")(
    lambda s: person_locations(s).select("person_id", "location_id", "start_date", "end_date"))


@case("join_fact_link", f"""select a.measurement_id as systolic_id, b.measurement_id as diastolic_id from measurement a
    join fact_relationship on fact_id_1 = a.measurement_id and domain_concept_id_1 = 21 and domain_concept_id_2 = 21
    join measurement b on b.measurement_id = fact_id_2
    where a.measurement_concept_id in {quoted(R.SYSTOLIC)} and b.measurement_concept_id in {quoted(R.DIASTOLIC)}""")
def _link(s) -> DataFrame:
    m = s["measurement"]
    a = m.where(F.col("measurement_concept_id").isin(R.SYSTOLIC)).select(F.col("measurement_id").alias("systolic_id"))
    b = m.where(F.col("measurement_concept_id").isin(R.DIASTOLIC)).select(F.col("measurement_id").alias("diastolic_id"))
    return vitals.pair_link(a, s["fact_relationship"], b, "systolic_id", "diastolic_id", R.MEASUREMENT_DOMAIN, "inner")


WIDE = "person_id, visit_occurrence_id, measurement_date, measurement_datetime::varchar as measured_at, ht, wt, bmi"


@case("join_self_pivot", f"select {WIDE}, systolic as sys, diastolic as dia, sys_concept, sys_raw, dia_raw from o_wide")
def _pivot(s) -> DataFrame:
    wide = vitals.widen(vitals.cohort_signs(s), s["fact_relationship"])
    return wide.select("person_id", "visit_occurrence_id", "measurement_date", F.date_format("measurement_datetime", "yyyy-MM-dd HH:mm:ss").alias("measured_at"),
                       "ht", "wt", "bmi", "sys", "dia", "sys_concept", "sys_raw", "dia_raw").distinct()


@case("join_parent_enrich", "select condition_occurrence_id, enc_type, admit_date, providerid from condition_occurrence "
      "join o_encounter on encounterid = cast(visit_occurrence_id as varchar)")
def _parent(s) -> DataFrame:
    enc = encounters.encounter_columns(s)
    return s["condition_occurrence"].join(enc, F.col("visit_occurrence_id") == F.col("_enc")).select(
        "condition_occurrence_id", "enc_type", "admit_date", "providerid")


@case("join_star_left", """select visit_occurrence_id, person_id, place_of_service_concept_id, zip from visit_occurrence
    left join care_site c using (care_site_id) left join location l on l.location_id = c.location_id""")
def _star(s) -> DataFrame:
    sites = s["care_site"].select(F.col("care_site_id").alias("_cs"), F.col("location_id").alias("_csl"), "place_of_service_concept_id")
    spots = s["location"].select(F.col("location_id").alias("_lo"), "zip")
    df = attach(s["visit_occurrence"], sites, [(F.col("care_site_id"), "_cs")])
    return attach(df, spots, [(F.col("_csl"), "_lo")]).select("visit_occurrence_id", "person_id", "place_of_service_concept_id", "zip")


case("join_compound_date", """select adt_occurrence_id, visit_end_date from adt_occurrence a join visit_occurrence v
    on v.visit_occurrence_id = a.visit_occurrence_id and v.visit_start_date = a.adt_date""")(
    lambda s: s["adt_occurrence"].join(
        s["visit_occurrence"].select(F.col("visit_occurrence_id").alias("_v"), F.col("visit_start_date").alias("_d"), "visit_end_date"),
        (F.col("visit_occurrence_id") == F.col("_v")) & (F.col("adt_date") == F.col("_d"))).select("adt_occurrence_id", "visit_end_date"))
case("join_left_then_inner", """select location_history_id, city from location l left join location_history h on h.location_id = l.location_id
    and lower(h.domain_id) = 'person' where h.entity_id in (select person_id from cohort_person)""")(
    lambda s: attach(mb.keep_persons(s["location_history"].where(F.lower("domain_id") == "person"), s.cohort, "entity_id"),
                     s["location"].select(F.col("location_id").alias("_l"), "city"), [(F.col("location_id"), "_l")], "inner")
    .select("location_history_id", "city"))


@case("join_cross_singletons", f"""select s_suppkey, (select min(target_code) from value_map where source_class = 'datamart_name' and source_code = '{SITE}') as mart_name,
    (select min(target_code) from value_map where source_class = 'datamart_id' and source_code = '{SITE}') as mart_id from supplier""")
def _singletons(s) -> DataFrame:
    df = s["supplier"].select("s_suppkey", F.lit(s.site).alias("_site"))
    df = lookup(df, s.value_map, "datamart_name", "_site", "mart_name")
    return lookup(df, s.value_map, "datamart_id", "_site", "mart_id").drop("_site")


case("join_geo", "select location_history_id, geocode_id, geocode_state from location_history join location_fips using (location_id)")(
    lambda s: attach(s["location_history"], s["location_fips"].withColumnRenamed("location_id", "_l"), [(F.col("location_id"), "_l")], "inner")
    .select("location_history_id", "geocode_id", "geocode_state"))
case("join_mod_unlinked", f"select measurement_id, {mapped('Result unit', 'unit_concept_id')} as unit, "
     f"coalesce({mapped('Result modifier', 'operator_concept_id')}, 'OT') as modifier from measurement")(
    lambda s: lookup(lookup(s["measurement"], s.value_map, "Result unit", "unit_concept_id", "unit"), s.value_map, "Result modifier",
                     "operator_concept_id", "modifier", default="OT").select("measurement_id", "unit", "modifier"))
