"""Visits, diagnoses, conditions, procedures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (facility_zip, glue, hhmm, ilike_any, lead_code, null_of, packed_field, since, text_id)
from ..operators.dedupe import first_per_key, nulls_last, union_all
from ..operators.lookup import (DESCRIPTION, SOURCE, TARGET, VALUE, codes_of, concept_lookup, dictionary_slice, entries, lookup,
                                lookup_pair)
from ..operators.membership import keep_persons, keep_visits, member_flag
from ..operators.rules import code_levels
from ..operators.sizing import attach, is_small, join_spread, measured, planned_bytes
from ..operators.update import delete_where, set_where
from ..rules import drugs as D
from ..rules import visits as R
from ..sources.model import conform
from ..sources.stage import staged
from ..sources.study import Study


def visits_in_cohort(study: Study) -> DataFrame:
    """Visits of the cohort. The cohort is cut from this very table, so a filter is enough
    unless a cohort was supplied."""
    visits = study["visit_occurrence"]
    if "cohort" in study.built:
        return keep_visits(visits, study.cohort)
    return visits.where(since("visit_start_date", study.floor))


def visit_answers(study: Study) -> DataFrame:
    """Disposition and payment group of each visit, least value of each, in one aggregation."""
    groups = codes_of(study.concept, "code", ["DRG"],
                      F.col("invalid_reason").isNull() & (F.col("concept_class_id") == "MS-DRG"))
    asked = study["observation"].where(
        F.col("observation_concept_id").isin(R.DISPOSITION_QUESTION, R.GROUP_QUESTION)
        & F.col("visit_occurrence_id").isNotNull())
    flagged = member_flag(asked, groups, F.col("value_as_string"), "_valid")
    is_group = ((F.col("observation_concept_id") == R.GROUP_QUESTION) & F.col("_valid")
                & since("observation_date", R.GROUPS_SINCE))
    is_disposition = F.col("observation_concept_id") == R.DISPOSITION_QUESTION
    return flagged.groupBy(F.col("visit_occurrence_id").alias("_va")).agg(
        F.min(F.when(is_disposition, F.col("value_as_concept_id"))).alias("_disposition"),
        F.min(F.when(is_group, F.col("value_as_string"))).alias("drg"))


def visit_payers(study: Study) -> DataFrame:
    """One payer row per visit: the lowest mapped code, unmapped rows last."""
    plan = F.concat("plan_class", F.lit("-"), "plan_type")
    rows = study["visit_payer"].select(
        F.col("visit_occurrence_id").alias("_vp"), "visit_payer_id", "visit_payer_type_concept_id", plan.alias("_plan"))
    mapped = lookup(rows, study.value_map, "Payer", "_plan", "_payer")
    return first_per_key(mapped, ["_vp"], [*nulls_last("_payer"), F.col("visit_payer_id")])


def facility_lookup(df: DataFrame, vmap: DataFrame) -> DataFrame:
    """Facility by visit type and specialty, else by place of service, else by visit type."""
    df = lookup_pair(df, vmap, "Facility type", "visit_concept_id", "specialty_concept_id",
                     {"_f1": TARGET, "_d1": DESCRIPTION})
    df = lookup(df, vmap, "Facility type", "place_of_service_concept_id", "_f2", take={"_f2": TARGET, "_d2": DESCRIPTION})
    generic = entries(vmap, "Facility type", {"_kf": F.col(SOURCE)}, {"_f3": TARGET, "_d3": DESCRIPTION},
                      F.col(SOURCE).isNotNull() & F.col(VALUE).isNull())
    df = attach(df, generic, [(F.col("visit_concept_id").cast("string"), "_kf")], small=is_small(vmap))
    return df.withColumns({
        "facility_type": F.coalesce("_f1", "_f2", "_f3", F.lit("NI")),
        "raw_facility_type": F.concat(F.lit("|"), F.coalesce("_d1", "_d2", "_d3")),
    }).drop("_f1", "_f2", "_f3", "_d1", "_d2", "_d3")


def payer_columns() -> dict[str, Column]:
    """Split the one payer row of a visit by its three-valued primary flag."""
    flag = (F.when(F.col("visit_payer_type_concept_id") == R.PRIMARY_PAYER, True)
            .when(F.col("visit_payer_type_concept_id") == R.SECONDARY_PAYER, False))
    out: dict[str, Column] = {}
    for rank, test in (("primary", flag.eqNullSafe(F.lit(True))), ("secondary", flag.eqNullSafe(F.lit(False)))):
        out[f"payer_type_{rank}"] = F.when(test, F.col("_payer")).otherwise("NI")
        out[f"raw_payer_type_{rank}"] = F.when(test, F.col("_plan")).otherwise("NI")
        out[f"raw_payer_name_{rank}"] = F.when(test, F.col("_plan")).otherwise("NI")
        out[f"raw_payer_id_{rank}"] = F.when(test, text_id("visit_payer_id"))
    return out


def disposition_of(answer: Column, discharged_to: Column) -> Column:
    """Answered disposition if it is one of two, else the visit's own if expired, else alive."""
    return (F.when(answer.isin(R.ALIVE, R.EXPIRED), answer)
            .when(discharged_to == R.EXPIRED, discharged_to).otherwise(F.lit(R.ALIVE)))


def encounter(study: Study) -> DataFrame:
    visits, vmap = visits_in_cohort(study), study.value_map
    df = visits.join(visit_answers(study), F.col("visit_occurrence_id") == F.col("_va"), "left")
    df = df.join(visit_payers(study), F.col("visit_occurrence_id") == F.col("_vp"), "left")
    sites = study["care_site"].select(F.col("care_site_id").alias("_cs"), F.col("location_id").alias("_csl"),
                                      "place_of_service_concept_id", "specialty_concept_id")
    places = study["location"].select(F.col("location_id").alias("_lo"), "zip")
    df = attach(df, sites, [(F.col("care_site_id"), "_cs")])
    df = attach(df, places, [(F.col("_csl"), "_lo")])
    df = df.withColumn("_ddisp", disposition_of(F.col("_disposition"), F.col("discharged_to_concept_id")))
    df = lookup(df, vmap, "Encounter type", "visit_concept_id", "enc_type", default="OT")
    df = lookup(df, vmap, "Discharge disposition", "_ddisp", "discharge_disposition", by=VALUE, default="A", null_safe=True)
    df = lookup(df, vmap, "Discharge status", "discharged_to_concept_id", "discharge_status", default="NI")
    df = lookup(df, vmap, "Admitting source", "admitted_from_concept_id", "admitting_source", default="NI")
    df = facility_lookup(df, vmap)
    stays = ~F.coalesce(F.col("visit_concept_id").isin(R.VISITS_WITHOUT_DISCHARGE), F.lit(False))
    return conform(df.withColumns({
        **payer_columns(),
        "patid": text_id("person_id"), "encounterid": text_id("visit_occurrence_id"),
        "admit_date": F.to_date("visit_start_date"), "admit_time": hhmm("visit_start_datetime"),
        "discharge_date": F.when(stays, F.to_date("visit_end_date")),
        "discharge_time": F.when(stays, hhmm("visit_end_datetime")),
        "providerid": text_id("provider_id"), "facilityid": text_id("care_site_id"),
        "facility_location": facility_zip("zip"),
        "drg_type": F.when(F.col("visit_start_date") < F.lit(R.GROUPS_SINCE), "01").otherwise("02"),
        "raw_enc_type": F.col("visit_source_value"),
        "raw_discharge_disposition": F.col("discharged_to_source_value"),
        "raw_discharge_status": F.col("discharged_to_source_value"),
        "raw_admitting_source": F.col("admitted_from_source_value"),
        "raw_siteid": F.lit(study.site),
    }), "encounter", study.site)


# --- diagnoses and conditions -------------------------------------------------------------------

def coded_condition(field: str, source: str = "_src", standard: str = "_std",
                    text: Column | None = None) -> tuple[Column, Column]:
    """Code and code type: ICD source concept → standard concept → raw text."""
    vocabulary = F.col(f"{source}_voc")
    return code_levels(
        (vocabulary == R.ICD9, F.col(f"{source}_code"), F.lit("09")),
        (vocabulary.isin(R.ICD10), F.col(f"{source}_code"), F.lit("10")),
        (F.col("condition_concept_id") > 0, F.col(f"{standard}_code"), F.lit("SM")),
        default=(lead_code(field) if text is None else text, F.lit("OT")))


def epidemic_codes(concept: DataFrame) -> DataFrame:
    """Per code fragment, the ICD codes that contain it (a handful each)."""
    hits = F.explode(F.filter(F.array(*[F.lit(f.lower()) for f in R.EPIDEMIC_FRAGMENTS]),
                              lambda f: F.contains(F.lower("concept_code"), f)))
    coded = dictionary_slice(concept, R.ICD_VOCABULARIES, ilike_any("concept_code", R.EPIDEMIC_FRAGMENTS))
    grouped = coded.select("vocabulary_id", "concept_code", hits.alias("_fragment")).groupBy("_fragment").agg(
        F.collect_set(F.struct("vocabulary_id", "concept_code")).alias("_codes"))
    # a code that holds several fragments stands once under each
    return measured(grouped, planned_bytes(coded) * len(R.EPIDEMIC_FRAGMENTS))


def recover_epidemic_codes(df: DataFrame, concept: DataFrame, raw: Column, guard: Column,
                           code: str, kind: str) -> DataFrame:
    """Where the type fell back and the raw text holds an epidemic code fragment, take the ICD code
    that matches the raw text (as a LIKE pattern); the first by vocabulary and code among several."""
    low = F.lower(raw)
    fragment = F.coalesce(*[F.when(low.contains(f.lower()), F.lit(f.lower())) for f in R.EPIDEMIC_FRAGMENTS])
    probe = df.withColumns({"_raw": raw, "_probe": F.when(guard, fragment)})
    joined = attach(probe, epidemic_codes(concept), [(F.col("_probe"), "_fragment")])
    # an escape character no code holds: a backslash in the raw text stays a plain character
    match = F.expr("array_min(filter(_codes, c -> c.concept_code ilike _raw escape '\\u0001'))")
    joined = joined.withColumn("_match", match)
    new_kind = (F.when(F.col("_match.vocabulary_id") == R.ICD9, "09")
                .when(F.col("_match.vocabulary_id").isin(R.ICD10), "10").otherwise("OT"))
    joined = set_where(joined, F.col("_match").isNotNull(), **{code: F.col("_match.concept_code"), kind: new_kind})
    return joined.select(*df.columns)


def promote_primary(df: DataFrame) -> DataFrame:
    """In inpatient encounters whose order diagnoses hold no primary one, promote the lowest id.

    The encounters are reduced to one candidate id each, so the diagnoses of one very long
    encounter never meet in a task.
    """
    scope = F.col("enc_type").isin(R.FLIPPED_VISITS) & (F.col("dx_origin") == R.FLIPPED_ORIGIN)
    chosen = (df.where(scope).groupBy("encounterid", "enc_type")
              .agg(F.count_if(F.col("pdx") == R.PRIMARY).alias("_n"), F.min("diagnosisid").alias("_first"))
              .where("_n = 0").select("_first", F.lit(True).alias("_flip")))
    # only rows in scope can be chosen; the others stay where they are
    inside = F.coalesce(scope, F.lit(False))
    joined = df.where(inside).join(chosen, F.col("diagnosisid") == F.col("_first"), "left")
    return set_where(joined, F.col("_flip"), pdx=R.PRIMARY).select(*df.columns).unionByName(df.where(~inside))


def encounter_columns(study: Study) -> DataFrame:
    """What facts copy from their encounter, keyed by number. Without a finished encounter table
    only these columns are derived: no payer, disposition or facility joins."""
    if "encounter" in study.built:
        return study.built["encounter"].select(
            F.col("encounterid").cast("bigint").alias("_enc"), F.col("patid").cast("bigint").alias("_pat"),
            "enc_type", "admit_date", "providerid")
    df = lookup(visits_in_cohort(study), study.value_map, "Encounter type", "visit_concept_id", "enc_type", default="OT")
    return df.select(F.col("visit_occurrence_id").alias("_enc"), F.col("person_id").alias("_pat"), "enc_type",
                     F.to_date("visit_start_date").alias("admit_date"), text_id("provider_id").alias("providerid"))


def diagnosis(study: Study) -> DataFrame:
    raw = F.col("condition_source_value")
    rows = study["condition_occurrence"].where(
        ~F.col("condition_type_concept_id").isin(R.PROBLEM_LIST_TYPES)
        & since("condition_start_date", study.floor) & ~raw.rlike(R.NO_DIAGNOSIS_MARK))
    # encounters are exactly the cohort visits, so this join is the cohort test too
    df = rows.join(encounter_columns(study), F.col("visit_occurrence_id") == F.col("_enc")).drop("_enc", "_pat")
    concept, vmap = study.concept, study.value_map
    df = concept_lookup(df, concept, "condition_concept_id", {"_std_code": "concept_code"}, how="inner")
    df = concept_lookup(df, concept, "condition_source_concept_id", {"_src_code": "concept_code", "_src_voc": "vocabulary_id"})
    df = concept_lookup(df, concept, "condition_type_concept_id", {"_type_name": "concept_name"})
    for out, cls, default in [("dx_source", "dx_source", "OT"), ("pdx", "pdx", "NI"), ("dx_origin", "dx origin", "OT")]:
        df = lookup(df, vmap, cls, "condition_type_concept_id", out, default=default)
    df = lookup(df, vmap, "dx_poa", "poa_concept_id", "dx_poa", default="OT")
    field3 = F.trim(packed_field(raw, 3))
    text = F.when(F.length(field3) > 0, lead_code(raw)).otherwise(F.trim(packed_field(raw, 2)))
    code, kind = coded_condition("condition_source_value", text=text)
    df = df.select(
        text_id("condition_occurrence_id").alias("diagnosisid"), text_id("person_id").alias("patid"),
        text_id("visit_occurrence_id").alias("encounterid"), "enc_type", "admit_date", "providerid",
        F.left(code, F.lit(18)).alias("dx"), kind.alias("dx_type"), F.col("condition_start_date").alias("dx_date"),
        "dx_source", "pdx", "dx_origin", "dx_poa",
        glue(packed_field(raw, 1), F.lit("|"), packed_field(raw, 3)).alias("raw_dx"),
        F.when(F.col("condition_source_concept_id") == R.UNCODED_SOURCE, "OT").otherwise(F.col("_src_voc")).alias("raw_dx_type"),
        F.col("_type_name").alias("raw_dx_source"),
        F.when(F.col("condition_type_concept_id").isin(R.PRIMARY_NAMED_TYPES), F.col("_type_name")).alias("raw_pdx"),
        field3.alias("_field3"))
    df = delete_where(df, F.length("dx") < 2)
    df = recover_epidemic_codes(df, concept, F.col("_field3"), F.col("dx_type").isin("SM", "OT"), "dx", "dx_type")
    # the rows are read by the choice and by the update: they are built once
    return promote_primary(staged(conform(df, "diagnosis", study.site), "diagnosis_rows"))


def _coded_conditions(study: Study) -> DataFrame:
    """Problem-list conditions and chief-complaint conditions, from one pass over the table."""
    raw, kind_id = F.col("condition_source_value"), F.col("condition_type_concept_id")
    is_problem = kind_id.isin(R.PROBLEM_LIST_TYPES)
    field3 = F.trim(packed_field(raw, 3))
    rows = study["condition_occurrence"].where(
        kind_id.isin([*R.PROBLEM_LIST_TYPES, *R.COMPLAINT_TYPES]) & since("condition_start_date", study.floor)
        & (~is_problem | ~raw.rlike(R.NO_DIAGNOSIS_MARK)) & (F.length(field3) <= 18))
    df = keep_persons(rows, study.cohort)
    df = concept_lookup(df, study.concept, "condition_concept_id", {"_std_code": "concept_code"}, ["SNOMED"], how="inner")
    df = concept_lookup(df, study.concept, "condition_source_concept_id",
                        {"_src_code": "concept_code", "_src_voc": "vocabulary_id"}, how="inner")
    code, kind = coded_condition("condition_source_value")
    df = df.select(
        text_id("condition_occurrence_id", "c").alias("conditionid"), text_id("person_id").alias("patid"),
        F.col("visit_occurrence_id").alias("_visit"), F.col("condition_start_date").alias("report_date"),
        F.col("condition_end_date").alias("resolve_date"),
        F.when(F.col("condition_end_date").isNull(), "AC").otherwise("RS").alias("condition_status"),
        code.alias("condition"), kind.alias("condition_type"),
        F.when(is_problem, "HC").otherwise("PR").alias("condition_source"),
        F.col("condition_status_source_value").alias("raw_condition_status"),
        glue(packed_field(raw, 1), F.lit("|"), packed_field(raw, 3)).alias("raw_condition"),
        F.col("_src_voc").alias("raw_condition_type"), field3.alias("_field3"))
    fell_back = (F.col("condition_source") == "HC") & F.col("condition_type").isin("SM", "OT")
    df = recover_epidemic_codes(df, study.concept, F.col("_field3"), fell_back, "condition", "condition_type")
    return df.drop("_field3")


def _observed_conditions(observation: DataFrame, **columns: Column) -> DataFrame:
    none = null_of("string")
    shape = {
        "conditionid": text_id("observation_id", "o"), "patid": text_id("person_id"),
        "_visit": F.col("visit_occurrence_id"), "report_date": F.col("observation_date"),
        "resolve_date": null_of("date"), "condition_status": F.lit("AC"), "condition": none,
        "condition_type": none, "condition_source": none, "raw_condition_status": none,
        "raw_condition": none, "raw_condition_type": none, **columns}
    return observation.select(*[c.alias(n) for n, c in shape.items()])


def complaint_lookup(df: DataFrame, cmap: DataFrame, text: Column) -> DataFrame:
    """Inner lookup of a complaint text, letter case ignored; one map row per text."""
    outs = ["_cc_code", "_cc_type", "_cc_voc"]
    dim = cmap.groupBy(F.lower("complaint_text").alias("_kc")).agg(F.min(F.struct(
        F.col("concept_code").alias(outs[0]), F.col("code_type").alias(outs[1]),
        F.col("vocabulary_id").alias(outs[2]))).alias("r")).select("_kc", *[f"r.{o}" for o in outs])
    return attach(df, dim, [(F.lower(text), "_kc")], "inner", small=is_small(cmap))


def condition(study: Study) -> DataFrame:
    derived = study["observation_derivation_covid"].where(
        (F.col("observation_concept_id") == R.DERIVED_QUESTION)
        & F.col("value_as_concept_id").isin(R.DERIVED_ANSWERS) & since("observation_date", study.floor))
    derived = _observed_conditions(
        keep_persons(derived, study.cohort), condition=F.lit("COVID"), condition_type=F.lit("AG"),
        condition_source=F.lit("PR"))
    complaints = study["observation"].where(
        (F.col("observation_concept_id") == R.COMPLAINT_QUESTION) & (F.col("site") == study.site)
        & since("observation_date", study.floor))
    complaints = complaint_lookup(keep_persons(complaints, study.cohort), study["complaint_map"],
                                  F.col("observation_source_value"))
    complaints = _observed_conditions(
        complaints, condition=F.col("_cc_code"), condition_type=F.col("_cc_type"), condition_source=F.lit("CC"),
        raw_condition=F.col("observation_source_value"), raw_condition_type=F.col("_cc_voc"))
    # no row can repeat, but an id can: derived observations and complaints are two tables, numbered apart, whose ids
    # both start with "o" in the model. The key check reports such ids.
    df = union_all(_coded_conditions(study), derived, complaints)
    early = study["visit_occurrence"].where(F.col("visit_start_date") < F.lit(study.floor)).select(
        F.col("visit_occurrence_id").alias("_early"))
    # most of a problem list names no visit
    kept = join_spread(df, early, F.col("_visit"), "_early", "left_anti")
    return conform(kept.withColumn("encounterid", text_id("_visit")), "condition", study.site)


# --- procedures ---------------------------------------------------------------------------------

def raw_procedure_code(raw: Column) -> Column:
    part = F.left(packed_field(raw, 2), F.lit(11))
    return F.when(part.isin("", " "), F.lit("NI")).otherwise(F.ltrim(part))


def _with_encounter(df: DataFrame, study: Study) -> DataFrame:
    """Join to the encounter of the same visit and person, which also tests the cohort."""
    return df.join(encounter_columns(study), (F.col("visit_occurrence_id") == F.col("_enc"))
                   & (F.col("person_id") == F.col("_pat"))).drop("_enc", "_pat")


def procedures(study: Study) -> DataFrame:
    rows = study["procedure_occurrence"].where(
        since("procedure_date", study.floor) & F.col("procedure_concept_id").isNotNull()
        & F.col("procedure_source_concept_id").isNotNull())
    df = _with_encounter(rows, study)
    billable = F.lit(True)
    for i, key in ((1, "procedure_concept_id"), (2, "procedure_source_concept_id")):
        df = concept_lookup(df, study.concept, key, {
            f"_code{i}": "concept_code", f"_voc{i}": "vocabulary_id", f"_class{i}": "concept_class_id"})
        known = F.col(f"_voc{i}").isin(R.PROCEDURE_VOCABULARIES)
        excluded = F.col(f"_class{i}").isin(R.EXCLUDED_PROCEDURE_CLASSES)
        billable = billable & ~F.coalesce(excluded, F.lit(False))
        df = df.withColumns({f"_code{i}": F.when(known, F.col(f"_code{i}")), f"_voc{i}": F.when(known, F.col(f"_voc{i}"))})
    df = df.where(billable).withColumn("_voc", F.coalesce("_voc1", "_voc2"))
    df = lookup(df, study.value_map, "Procedure Code Type", "_voc", "px_type", default="OT")
    df = lookup(df, study.value_map, "px source", "procedure_type_concept_id", "px_source", default="OT")
    df = lookup(df, study.value_map, "ppx", "procedure_type_concept_id", "ppx", default="OT")
    raw = F.col("procedure_source_value")
    done = df.select(
        text_id("procedure_occurrence_id").alias("proceduresid"), text_id("person_id").alias("patid"),
        text_id("visit_occurrence_id").alias("encounterid"), "enc_type", "admit_date", "providerid",
        F.col("procedure_date").alias("px_date"),
        F.coalesce("_code1", "_code2", raw_procedure_code(raw)).alias("px"), "px_type", "px_source", "ppx",
        packed_field(raw, 1).alias("raw_px"), F.coalesce("_voc", F.lit("OT")).alias("raw_px_type"),
        text_id("procedure_type_concept_id").alias("raw_ppx"))
    df = union_all(done, vaccine_procedures(study))
    return conform(delete_where(df, wrong_code_length(F.col("px"), F.col("px_type"))), "procedures", study.site)


def vaccine_procedures(study: Study) -> DataFrame:
    """Epidemic vaccinations as procedures with fixed codes."""
    shots = study["immunization"].where(
        F.col("immunization_concept_id").isin(list(D.VACCINE_PROCEDURES)) & since("immunization_date", study.floor))
    code = F.coalesce(*[F.when(F.col("immunization_concept_id") == c, F.lit(p)) for c, p in D.VACCINE_PROCEDURES.items()])
    return _with_encounter(shots, study).select(
        text_id("immunization_id", "i").alias("proceduresid"), text_id("person_id").alias("patid"),
        text_id("visit_occurrence_id").alias("encounterid"), "enc_type", "admit_date", "providerid",
        F.col("immunization_date").alias("px_date"), code.alias("px"), F.lit("CH").alias("px_type"),
        F.lit("DR").alias("px_source"), F.lit("OT").alias("ppx"),
        packed_field("immunization_source_value", 1).alias("raw_px"), F.lit("CVX").alias("raw_px_type"),
        text_id("immunization_type_concept_id").alias("raw_ppx"))


def wrong_code_length(code: Column, kind: Column) -> Column:
    return ((F.length(code) != 7) & (kind == "10")) | ((F.length(code) < 5) & (kind == "CH"))
