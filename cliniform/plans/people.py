"""Cohort, persons, providers, enrolment, deaths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (date_from_parts, decode, hhmm, lead_code, null_of, packed_field, since, text_id)
from ..operators.lookup import DESCRIPTION, SOURCE, TARGET, concept_lookup, lookup, lookup_contained
from ..operators.membership import keep_persons
from ..operators.rules import code_levels
from ..operators.sizing import attach
from ..rules import visits as R
from ..sources.model import conform
from ..sources.study import Study


def cohort(study: Study) -> DataFrame:
    """(person_id, visit_id) of every visit that starts on or after the floor."""
    visits = study["visit_occurrence"].where(since("visit_start_date", study.floor))
    return visits.select(F.col("person_id").cast("bigint"), F.col("visit_occurrence_id").cast("bigint").alias("visit_id"))


def latest_answers(observation: DataFrame, questions: dict[str, int]) -> DataFrame:
    """Latest answer of each person to each question, all questions in one aggregation."""
    asked = observation.where(F.col("observation_concept_id").isin(list(questions.values())))
    last = [F.max(F.when(F.col("observation_concept_id") == q,
                         F.struct("observation_date", "observation_id", "value_as_concept_id"))).alias(name)
            for name, q in questions.items()]
    per_person = asked.groupBy(F.col("person_id").alias("_person")).agg(*last)
    return per_person.select("_person", *[F.col(f"{n}.value_as_concept_id").alias(n) for n in questions])


def demographic(study: Study) -> DataFrame:
    persons = keep_persons(study["person"], study.cohort)
    answers = latest_answers(study["observation"], {
        "_orientation": R.ORIENTATION_QUESTION, "_identity": R.IDENTITY_QUESTION})
    df = persons.join(answers, F.col("person_id") == F.col("_person"), "left")
    for out, cls, key in [("sex", "Gender", "gender_concept_id"), ("hispanic", "Hispanic", "ethnicity_concept_id"),
                          ("race", "Race", "race_concept_id"),
                          ("pat_pref_language_spoken", "Language", "language_concept_id")]:
        df = lookup(df, study.value_map, cls, key, out, default="OT", null_safe=True)
    return conform(df.select(
        "sex", "hispanic", "race", "pat_pref_language_spoken",
        text_id("person_id").alias("patid"),
        date_from_parts("year_of_birth", "month_of_birth", "day_of_birth").alias("birth_date"),
        hhmm("birth_datetime").alias("birth_time"),
        decode("_orientation", R.ORIENTATION, "NI").alias("sexual_orientation"),
        decode("_identity", R.IDENTITY, "NI").alias("gender_identity"),
        F.lit("N").alias("biobank_flag"),
        F.col("gender_source_value").alias("raw_sex"),
        F.col("ethnicity_source_value").alias("raw_hispanic"),
        F.col("race_source_value").alias("raw_race"),
        F.col("language_source_value").alias("raw_pat_pref_language_spoken"),
    ), "demographic", study.site)


def private_demographic(study: Study) -> DataFrame:
    """The demographic table with identifying columns blank; names may not be NULL, so ''."""
    base = study.target("demographic", demographic)
    blanked = base.withColumns({"pat_firstname": F.lit(""), "pat_lastname": F.lit("")})
    return conform(blanked, "private_demographic", study.site)


def enrollment(study: Study) -> DataFrame:
    periods = keep_persons(study["observation_period"], study.cohort)
    return conform(periods.select(
        text_id("person_id").alias("patid"),
        F.to_date("observation_period_start_date").alias("enr_start_date"),
        F.to_date("observation_period_end_date").alias("enr_end_date"),
    ).distinct().withColumns({"chart": F.lit("Y"), "enr_basis": F.lit("E")}), "enrollment", study.site)


def provider(study: Study) -> DataFrame:
    """Specialty by concept id; map rows without an id are found by their description instead."""
    df = lookup(study["provider"], study.value_map, "Gender", "gender_concept_id", "provider_sex", default="OT")
    df = lookup(df, study.value_map, "Provider Specialty", "specialty_concept_id", "_by_id",
                take={"_by_id": TARGET, "_id_name": DESCRIPTION})
    df = lookup_contained(df, study.value_map, "Provider Specialty", F.col("specialty_source_value"), "_by_name",
                          by=DESCRIPTION, take={"_by_name": TARGET, "_text_name": DESCRIPTION}, fold=False,
                          where=F.col(SOURCE) == "")
    by_id = F.col("_id_name").isNotNull() | F.col("_by_id").isNotNull()
    return conform(df.select(
        text_id("provider_id").alias("providerid"), "provider_sex",
        F.coalesce("_by_id", "_by_name", F.lit("OT")).alias("provider_specialty_primary"),
        F.when(by_id, F.col("_id_name")).otherwise(F.col("_text_name")).alias("raw_provider_specialty_primary"),
        F.lit("N").alias("provider_npi_flag"),
    ), "provider", study.site)


def death(study: Study) -> DataFrame:
    """One row per person, date and impute code, however many causes were recorded."""
    rows = study["death"].where(F.col("death_type_concept_id") == R.DEATH_RECORD_TYPE)
    rows = lookup(keep_persons(rows, study.cohort), study.value_map, "Death date impute",
                  "death_impute_concept_id", "death_date_impute", default="OT")
    return conform(rows.select(
        text_id("person_id").alias("patid"), "death_date", "death_date_impute").distinct()
        .withColumn("death_source", F.lit("L")), "death", study.site)


def era_vocabulary(day: Column) -> Column:
    """Diagnosis vocabulary in force on a day."""
    return F.when(day < F.lit(R.ICD10_SINCE), F.lit("ICD9CM")).when(day >= F.lit(R.ICD10_SINCE), F.lit("ICD10CM"))


def era_match(df: DataFrame, concept: DataFrame, code: Column, day: Column, out: str) -> DataFrame:
    """Add the era's vocabulary where it holds the code text; one join for both eras."""
    known = concept.where(F.col("vocabulary_id").isin("ICD9CM", "ICD10CM")).select(
        F.col("concept_code").alias("_code"), F.col("vocabulary_id").alias("_voc"),
        F.col("vocabulary_id").alias(out)).distinct()
    return attach(df, known, [(code, "_code"), (era_vocabulary(day), "_voc")])


def death_cause(study: Study) -> DataFrame:
    raw = F.col("cause_source_value")
    rows = study["death"].where(
        raw.isNotNull() & (F.col("cause_source_concept_id") != R.UNKNOWN_CAUSE)
        & (F.col("cause_source_concept_id") != 0) & (F.col("cause_concept_id") != 0)
        & ~raw.isin(R.IGNORED_CAUSES) & ~raw.contains(R.FOREIGN_CAUSE_MARK))
    df = keep_persons(rows, study.cohort)
    df = concept_lookup(df, study.concept, "cause_source_concept_id", {"_src_code": "concept_code", "_src_voc": "vocabulary_id"})
    df = concept_lookup(df, study.concept, "cause_concept_id", {"_std_code": "concept_code"})
    df = era_match(df, study.concept, raw, F.col("death_date"), "_era")
    field3 = F.trim(packed_field(raw, 3))
    text = F.when(F.length(field3) > 0, lead_code(raw)).otherwise(F.trim(packed_field(raw, 2)))
    none = null_of("string")
    code, _ = code_levels(
        (F.col("_src_voc").isin(R.ICD_VOCABULARIES), F.col("_src_code"), none),
        (F.col("_era").isNotNull(), raw, none),
        (F.col("cause_concept_id") > 0, F.col("_std_code"), none),
        default=(text, none))
    kind = (F.when(F.col("_src_voc") == R.ICD9, "09").when(F.col("_era") == R.ICD9, "09")
            .when(F.col("_src_voc").isin(R.ICD10), "10").otherwise("OT"))
    return conform(df.select(
        text_id("person_id").alias("patid"), F.left(code, F.lit(8)).alias("death_cause"),
        kind.alias("death_cause_code"), F.lit("NI").alias("death_cause_type"),
        F.lit("L").alias("death_cause_source")).distinct(), "death_cause", study.site)
