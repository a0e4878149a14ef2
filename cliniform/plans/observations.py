"""Clinical and general observations, survey answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import covers, hhmm, null_of, row_key, since, text_id
from ..operators.dedupe import union_all
from ..operators.lookup import concept_lookup, lookup
from ..operators.membership import drop_members, keep_absent_or_same_visit, keep_absent_or_visits, keep_persons
from ..operators.rules import classify
from ..operators.sizing import attach
from ..rules import visits as R
from ..rules.results import GENERAL_RESULT_TEXT, RESULT_TEXT
from ..sources.model import conform
from ..sources.study import Study
from .labs import number_text


def no_to_unknown(modifier: Column) -> Column:
    return F.when(modifier == "NO", "UN").otherwise(modifier)


# --- clinical observations ----------------------------------------------------------------------

def _clinical_measurements(study: Study) -> DataFrame:
    vmap = study.value_map
    rows = study["measurement"].where(F.col("measurement_concept_id").isin(R.CLINICAL_CONCEPTS))
    df = keep_absent_or_visits(keep_persons(rows, study.cohort), study.cohort)
    df = concept_lookup(df, study.concept, "measurement_concept_id", {"_loinc": "concept_code"}, ["LOINC"])
    df = lookup(df, vmap, "abnormal_indicator", "value_as_concept_id", "_abn", default="NI")
    df = lookup(df, vmap, "Result qualifier", "value_as_concept_id", "_qual")
    df = lookup(df, vmap, "Result unit", "unit_concept_id", "_unit")
    df = lookup(df, vmap, "Result modifier", "operator_concept_id", "_mod", default="OT")
    oxygen = F.col("measurement_concept_id") == R.OXYGEN_CONCEPT
    number = number_text("value_as_number")
    return df.select(
        text_id("measurement_id", "m").alias("obsclinid"), text_id("person_id").alias("patid"),
        text_id("visit_occurrence_id").alias("encounterid"), text_id("provider_id").alias("obsclin_providerid"),
        F.col("measurement_date").alias("obsclin_start_date"), hhmm("measurement_datetime").alias("obsclin_start_time"),
        F.when(oxygen, "SM").otherwise("LC").alias("obsclin_type"),
        F.when(oxygen, R.OXYGEN_CODE).otherwise(F.col("_loinc")).alias("obsclin_code"),
        F.when(oxygen, R.OXYGEN_CODE).alias("obsclin_result_snomed"), F.col("_abn").alias("obsclin_abn_ind"),
        classify("value_source_value", RESULT_TEXT, "OT", F.col("_qual"), study.classifier_mode).alias("obsclin_result_qual"),
        number.alias("obsclin_result_text"), F.col("_mod").alias("obsclin_result_modifier"),
        F.col("_unit").alias("obsclin_result_unit"), number.alias("raw_obsclin_result"),
        F.col("unit_concept_name").alias("raw_obsclin_unit"), *_clinical_blanks())


def _clinical_blanks() -> list[Column]:
    return [null_of("string").alias(c) for c in ("raw_obsclin_name", "raw_obsclin_type", "raw_obsclin_code")]


def vaping(study: Study) -> DataFrame:
    """Vaping answers, with the answer text read as a concept id."""
    vmap = study.value_map
    rows = study["observation"].where(
        since("observation_date", study.floor) & (F.col("observation_concept_id") == R.VAPING_QUESTION)
        & F.col("value_as_concept_id").isin(R.VAPING_ANSWERS))
    df = keep_absent_or_visits(keep_persons(rows, study.cohort), study.cohort)
    df = lookup(df, vmap, "Result qualifier", "qualifier_concept_id", "_qual", default="NI")
    df = lookup(df, vmap, "abnormal_indicator", "value_as_concept_id", "_abn", default="NI")
    df = concept_lookup(df, study.concept, F.col("value_as_string").try_cast("bigint"), {"_snomed": "concept_code"}, ["SNOMED"])
    return df.select(
        text_id("observation_id", "o").alias("obsclinid"), text_id("person_id").alias("patid"),
        text_id("visit_occurrence_id").alias("encounterid"), text_id("provider_id").alias("obsclin_providerid"),
        F.col("observation_date").alias("obsclin_start_date"), hhmm("observation_datetime").alias("obsclin_start_time"),
        F.lit("SM").alias("obsclin_type"), F.col("_snomed").alias("obsclin_code"),
        F.col("_snomed").alias("obsclin_result_snomed"), F.col("_abn").alias("obsclin_abn_ind"),
        F.col("_qual").alias("obsclin_result_qual"), F.col("value_as_string").alias("obsclin_result_text"),
        *[null_of("string").alias(c) for c in (
            "obsclin_result_modifier", "obsclin_result_unit", "raw_obsclin_result", "raw_obsclin_unit")],
        *_clinical_blanks())


def gestational_age(study: Study) -> DataFrame:
    """The gestational age of a cohort person as one observation at birth."""
    age = F.col("pn_gestational_age")
    df = keep_persons(study["person"].where(age.isNotNull()), study.cohort)
    return df.select(
        text_id("person_id", "p").alias("obsclinid"), text_id("person_id").alias("patid"),
        null_of("string").alias("encounterid"), text_id("provider_id").alias("obsclin_providerid"),
        F.col("birth_date").alias("obsclin_start_date"), hhmm("birth_datetime").alias("obsclin_start_time"),
        F.lit("LC").alias("obsclin_type"), F.lit(R.GESTATION_CODE).alias("obsclin_code"),
        null_of("string").alias("obsclin_result_snomed"), F.lit("NI").alias("obsclin_abn_ind"),
        F.lit("NI").alias("obsclin_result_qual"), age.cast("string").alias("obsclin_result_text"),
        F.lit("NI").alias("obsclin_result_modifier"), F.lit("wk").alias("obsclin_result_unit"),
        age.cast("string").alias("raw_obsclin_result"), F.lit("week").alias("raw_obsclin_unit"),
        F.lit("Gestational age").alias("raw_obsclin_name"), F.lit("LOINC").alias("raw_obsclin_type"),
        F.lit(R.GESTATION_CODE).alias("raw_obsclin_code"))


def obs_clin(study: Study) -> DataFrame:
    """Each branch has its own id letter and unique source keys, so the union needs no distinct."""
    branches = {"measurements": _clinical_measurements(study), "vaping": vaping(study), "gestational age": gestational_age(study)}
    df = union_all(*[study.watch(branch, f"obs_clin: {name}") for name, branch in branches.items()])
    return conform(df.withColumns({
        "obsclin_abn_ind": F.left("obsclin_abn_ind", F.lit(2)),
        "obsclin_code": F.left("obsclin_code", F.lit(18)),
        "obsclin_result_snomed": F.left("obsclin_result_snomed", F.lit(18)),
        "obsclin_result_modifier": F.left(no_to_unknown(F.col("obsclin_result_modifier")), F.lit(2)),
        "obsclin_source": F.lit("HC"),
    }), "obs_clin", study.site)


# --- general observations -----------------------------------------------------------------------

_GENERAL = (
    "obsgenid patid encounterid obsgen_providerid obsgen_start_date obsgen_start_time obsgen_stop_date "
    "obsgen_stop_time obsgen_type obsgen_code obsgen_result_text obsgen_source obsgen_abn_ind obsgen_result_qual "
    "obsgen_result_num obsgen_result_modifier obsgen_result_unit obsgen_id_modified obsgen_table_modified "
    "raw_obsgen_code raw_obsgen_name raw_obsgen_result raw_obsgen_type raw_obsgen_unit").split()
_GENERAL_TYPES = {"obsgen_start_date": "date", "obsgen_stop_date": "date", "obsgen_result_num": "double"}


def _general(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(*[columns.get(c, F.lit(None)).cast(_GENERAL_TYPES.get(c, "string")).alias(c) for c in _GENERAL])


def _visit_columns(study: Study, *names: str) -> DataFrame:
    return study["visit_occurrence"].select(*[F.col(n).alias(f"_e_{n}") for n in names])


def icu_transfers(study: Study) -> DataFrame:
    """Transfers to intensive care on the first day of the visit."""
    moves = study["adt_occurrence"].where(F.col("service_concept_id").isin(R.ICU_SERVICES))
    visits = _visit_columns(study, "visit_occurrence_id", "visit_start_date", "visit_end_date", "visit_end_datetime", "provider_id")
    df = moves.join(visits, (F.col("visit_occurrence_id") == F.col("_e_visit_occurrence_id"))
                    & (F.col("adt_date") == F.col("_e_visit_start_date")))
    return _general(
        df, obsgenid=text_id("adt_occurrence_id", "a"), patid=text_id("person_id"),
        encounterid=text_id("visit_occurrence_id"), obsgen_providerid=text_id("_e_provider_id"),
        obsgen_start_date=F.col("adt_date"), obsgen_start_time=hhmm("adt_datetime"),
        obsgen_stop_date=F.col("_e_visit_end_date"), obsgen_stop_time=hhmm("_e_visit_end_datetime"),
        obsgen_type=F.lit(R.GENERAL_TYPE), obsgen_code=F.lit(R.ICU_CODE), obsgen_result_text=F.lit("Y"),
        obsgen_source=F.lit("DR"))


def epidemic_results(study: Study) -> DataFrame:
    vmap = study.value_map
    df = study["measurement"].where(F.col("measurement_concept_id").isin(R.GENERAL_MEASUREMENTS))
    df = lookup(df, vmap, "Result qualifier", "value_as_concept_id", "_qual")
    df = lookup(df, vmap, "abnormal_indicator", "value_as_concept_id", "_abn", default="NI")
    df = lookup(df, vmap, "Result unit", "unit_concept_id", "_unit", default="{ratio}")
    df = lookup(df, vmap, "Result modifier", "operator_concept_id", "_mod")
    return _general(
        df, obsgenid=text_id("measurement_id", "m"), patid=text_id("person_id"),
        encounterid=text_id("visit_occurrence_id"), obsgen_providerid=text_id("provider_id"),
        obsgen_start_date=F.col("measurement_date"), obsgen_start_time=hhmm("measurement_datetime"),
        obsgen_type=F.lit(R.GENERAL_TYPE), obsgen_code=F.lit(R.RESULT_CODE), obsgen_source=F.lit("HC"),
        obsgen_result_text=F.when(F.col("measurement_concept_id") == R.EPIDEMIC_RESULT, "Y").otherwise("N"),
        obsgen_result_qual=classify("value_source_value", GENERAL_RESULT_TEXT, "OT", F.col("_qual"), study.classifier_mode),
        obsgen_result_num=F.col("value_as_number"), obsgen_result_modifier=no_to_unknown(F.col("_mod")),
        obsgen_result_unit=F.col("_unit"), obsgen_abn_ind=F.col("_abn"), raw_obsgen_result=number_text("value_as_number"),
        raw_obsgen_unit=F.concat("unit_concept_name", "unit_source_value"))


def devices(study: Study) -> DataFrame:
    """Breathing devices, with a flag whether they were in use when the visit started."""
    used = study["device_exposure"].where(F.col("device_concept_id").isin(R.DEVICE_CONCEPTS))
    visits = _visit_columns(study, "visit_occurrence_id", "visit_start_date")
    df = used.join(visits, F.col("visit_occurrence_id") == F.col("_e_visit_occurrence_id"))
    df = concept_lookup(df, study.concept, "device_concept_id", {
        "_name": "concept_name", "_voc": "vocabulary_id", "_code": "concept_code"}, ["SNOMED"], F.col("domain_id") == "Device")
    start, end = F.col("device_exposure_start_date"), F.col("device_exposure_end_date")
    return _general(
        df, obsgenid=text_id("device_exposure_id", "d"), patid=text_id("person_id"),
        encounterid=text_id("visit_occurrence_id"), obsgen_providerid=text_id("provider_id"),
        obsgen_start_date=start, obsgen_start_time=hhmm("device_exposure_start_datetime"), obsgen_stop_date=end,
        obsgen_stop_time=hhmm("device_exposure_end_datetime"), obsgen_type=F.lit(R.GENERAL_TYPE),
        obsgen_code=F.lit(R.DEVICE_CODE), obsgen_result_text=covers(start, end, "_e_visit_start_date"),
        obsgen_source=F.lit("DR"), raw_obsgen_name=F.col("_name"), raw_obsgen_type=F.col("_voc"), raw_obsgen_code=F.col("_code"))


def person_locations(study: Study) -> DataFrame:
    """Locations of persons over time, plus the present one where the history lacks it."""
    history = study["location_history"].where(F.trim(F.lower("domain_id")) == "person").select(
        F.col("entity_id").alias("person_id"), "location_id", "site", "start_date", "end_date")
    missing = drop_members(study["person"], history, ("person_id", "person_id"), ("location_id", "location_id"), keep_null=True)
    missing = missing.select("person_id", "location_id", "site", null_of("date").alias("start_date"),
                             null_of("date").alias("end_date"))
    return union_all(history, missing).distinct()


def census_blocks(study: Study) -> DataFrame:
    df = keep_persons(person_locations(study), study.cohort)
    fips = study["location_fips"].withColumnRenamed("location_id", "_loc")
    df = attach(df, fips, [(F.col("location_id"), "_loc")], "inner")
    block = F.concat(*[F.col(f"geocode_{p}").cast("string") for p in ("state", "county", "tract", "group", "block")])
    place = text_id("location_id")
    # a digest of all that makes the row in place of a running number: stable, unique, and no global sort
    key = row_key("geocode_id", "location_id", "person_id", "start_date", "end_date", "site")
    return _general(
        df, obsgenid=F.concat(F.lit("L"), key),
        patid=text_id("person_id"), obsgen_code=F.lit(R.CENSUS_CODE), obsgen_id_modified=place, obsgen_result_text=block,
        obsgen_start_date=F.coalesce("start_date", study.today_column), obsgen_stop_date=F.col("end_date"),
        obsgen_table_modified=F.lit("LDS"), obsgen_type=F.lit("LC"), raw_obsgen_name=F.lit("Census Block Group"),
        raw_obsgen_result=F.concat(place, F.lit(" - "), block), raw_obsgen_type=F.col("geocode_year"),
        raw_obsgen_unit=F.col("geocode_shapefile"))


def obs_gen(study: Study) -> DataFrame:
    df = union_all(icu_transfers(study), epidemic_results(study), devices(study), census_blocks(study))
    return conform(df, "obs_gen", study.site)


# --- survey answers -----------------------------------------------------------------------------

def survey_key(prefix: str | Column, day: Column, time: Column) -> Column:
    """Instance key: prefix, person, visit, yyyyMMdd, hour, and the minute of the (dateless) day: 00."""
    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(head, text_id("person_id"), F.coalesce(text_id("visit_occurrence_id"), F.lit("")),
                    F.date_format(day, "yyyyMMdd"), F.date_format(time, "HH"), F.lit("00"))


def survey_number(answer: Column) -> Column:
    chain: Column | None = None
    for concept, number in R.SURVEY_ANSWERS:
        chain = F.when(answer == concept, F.lit(number)) if chain is None else chain.when(answer == concept, F.lit(number))
    return chain


def hunger_number(answer: Column, text: Column) -> Column:
    return (F.when((answer == R.YES) | text.isin(R.YES_TEXTS), 1)
            .when(answer.isin(R.NO, R.NO_INFORMATION) | text.isin(R.NO_TEXTS), 0))


def hunger_text(question: Column, answer: Column, text: Column) -> Column:
    item = question.isin(R.HUNGER_RUN_OUT, R.HUNGER_NOT_LAST)
    flag = question == R.HUNGER_FLAG
    return (F.when(item & ((answer == R.YES) | text.isin(R.YES_TEXTS)), "Sometimes true")
            .when(item & ((answer == R.NO) | text.isin(R.NO_TEXTS)), "Never true")
            .when(item, "Don't know or refused")
            .when(flag & (answer == R.YES), "At risk").when(flag & (answer != R.YES), "No Risk"))


def survey(study: Study) -> DataFrame:
    """Depression and hunger questionnaires, from one pass over the observations."""
    question, answer = F.col("observation_concept_id"), F.col("value_as_concept_id")
    text = F.col("value_as_string")
    rows = study["observation"].where(question.isin(R.SURVEY_QUESTIONS))
    df = keep_absent_or_same_visit(rows, study.cohort)
    df = concept_lookup(df, study.concept, "observation_concept_id", {"_q_code": "concept_code", "_q_name": "concept_name"})
    df = concept_lookup(df, study.concept, "value_as_concept_id", {"_a_code": "concept_code", "_a_name": "concept_name"})
    item, score = question.isin(R.SURVEY_ITEMS), question.isin(R.SURVEY_SCORES)
    depression = item | score
    fixed_code = F.coalesce(*[F.when(question == q, F.lit(c)) for q, c in R.HUNGER_ITEM_CODES.items()])
    fixed_name = F.coalesce(*[F.when(question == q, F.lit(n)) for q, n in R.HUNGER_ITEM_NAMES.items()])
    flag = question == R.HUNGER_FLAG
    return conform(df.select(
        text_id("observation_id").alias("pro_cm_id"), text_id("person_id").alias("patid"),
        text_id("visit_occurrence_id").alias("encounterid"), F.col("observation_date").alias("pro_date"),
        hhmm("observation_datetime").alias("pro_time"), F.lit("LC").alias("pro_type"),
        F.when(item, F.col("_q_code")).otherwise(fixed_code).alias("pro_item_loinc"),
        F.when(item, F.col("_q_name")).otherwise(fixed_name).alias("pro_item_fullname"),
        survey_key(F.when(depression, "PHQ").otherwise("HVS"), F.col("observation_date"),
                   F.col("observation_datetime")).alias("pro_measure_seq"),
        F.when(score, F.col("value_as_number")).alias("pro_measure_score"),
        F.when(score, F.col("_a_code")).when(flag, R.HUNGER_FLAG_CODE).alias("pro_measure_loinc"),
        F.when(score, F.col("_q_name")).when(flag, R.HUNGER_FLAG_NAME).alias("pro_measure_fullname"),
        F.when(item, F.col("_a_name")).when(~depression, hunger_text(question, answer, text)).alias("pro_response_text"),
        F.when(depression, survey_number(answer)).otherwise(hunger_number(answer, text)).alias("pro_response_num"),
    ), "pro_cm", study.site)
