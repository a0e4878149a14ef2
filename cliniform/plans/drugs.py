"""Administered, dispensed and prescribed drugs; immunizations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (contains_any, decimal_of, decode, hhmm, ilike_any, null_if_zero, null_of, packed_field,
                         parse_dose, since, text_id)
from ..operators.dedupe import smallest_per_key
from ..operators.lookup import (LABEL, SOURCE, codes_of, concept_lookup, crosswalk, lookup, lookup_contained,
                                named_concepts)
from ..operators.membership import keep_absent_or_visits, keep_persons, keep_visits, member_flag
from ..operators.rules import classify
from ..operators.sizing import attach, is_small
from ..rules import drugs as D
from ..sources.model import conform
from ..sources.stage import staged
from ..sources.study import Study


def keyword_kept(text: Column) -> Column:
    """True when the text holds none of the denied words (NULL for NULL)."""
    return ~contains_any(text, D.DENIED_WORDS)


def pick_drug_code(df: DataFrame, concept: DataFrame) -> DataFrame:
    """Drug code and type: package code by source concept → by raw text → ingredient code."""
    df = concept_lookup(df, concept, "drug_source_concept_id", {"_ndc": "concept_code"}, ["NDC"])
    df = member_flag(df, codes_of(concept, "code", ["NDC"]), packed_field("drug_source_value", 1), "_raw_ndc")
    df = concept_lookup(df, concept, "drug_concept_id", {"_rx": "concept_code", "_rx_name": "concept_name", "_rx_id": "concept_id"}, ["RxNorm"])
    by_rx = F.col("_rx_id") > 0
    raw = packed_field("drug_source_value", 1)
    return df.withColumns({
        "code": F.when(F.col("_ndc").isNotNull(), F.col("_ndc")).when(F.col("_raw_ndc"), raw).when(by_rx, F.col("_rx")),
        "code_type": F.when(F.col("_ndc").isNotNull() | F.col("_raw_ndc"), "ND").when(by_rx, "RX").otherwise("OT"),
    }).drop("_ndc", "_raw_ndc", "_rx", "_rx_id")


def purge_nutrition(df: DataFrame, concept: DataFrame, text: Column, code: Column) -> DataFrame:
    """Drop nutrition and supply items, unless the code is a drug of a kept class."""
    kept = codes_of(concept, "code", ["RxNorm"], F.col("concept_class_id").isin(D.KEPT_DRUG_CLASSES))
    flagged = member_flag(df, kept, code, "_drug")
    denied = F.coalesce(contains_any(text, D.DENIED_WORDS), F.lit(False))
    return flagged.where(F.col("_drug") | ~denied).drop("_drug")


def override_codes(df: DataFrame, concept_id: Column, text: Column, code: str, kind: str) -> DataFrame:
    """Fixed codes for a few (drug concept, text) pairs; the last matching rule decides."""
    new: Column | None = None
    for ids, fragments, value in reversed(D.CODE_OVERRIDES):
        test = concept_id.isin(ids) & ilike_any(text, fragments)
        new = F.when(test, F.lit(value)) if new is None else new.when(test, F.lit(value))
    return (df.withColumn("_new", new)
            .withColumns({code: F.coalesce(F.col("_new"), F.col(code)),
                          kind: F.when(F.col("_new").isNotNull(), F.lit("RX")).otherwise(F.col(kind))})
            .drop("_new"))


def med_admin(study: Study) -> DataFrame:
    rows = study["drug_exposure"].where(
        (F.col("drug_type_concept_id") == D.INPATIENT_ADMIN) & since("drug_exposure_start_date", study.floor))
    df = pick_drug_code(keep_visits(rows, study.cohort), study.concept)
    text = F.col("drug_source_value")
    df = purge_nutrition(df, study.concept, text, F.col("code"))
    df = override_codes(df, F.col("drug_concept_id"), text, "code", "code_type")
    df = lookup(df, study.value_map, "Dose unit", "dose_unit_concept_id", "medadmin_dose_admin_unit", default="OT")
    df = lookup(df, study.value_map, "Route", "route_concept_id", "medadmin_route", default="OT")
    return conform(df.select(
        text_id("drug_exposure_id").alias("medadminid"), text_id("person_id").alias("patid"),
        text_id("visit_occurrence_id").alias("encounterid"),
        F.col("drug_exposure_start_date").alias("medadmin_start_date"),
        hhmm("drug_exposure_start_datetime").alias("medadmin_start_time"),
        F.col("drug_exposure_end_date").alias("medadmin_stop_date"),
        hhmm("drug_exposure_end_datetime").alias("medadmin_stop_time"),
        text_id("provider_id").alias("medadmin_providerid"),
        F.col("code_type").alias("medadmin_type"), F.col("code").alias("medadmin_code"),
        F.col("effective_drug_dose").alias("medadmin_dose_admin"), "medadmin_dose_admin_unit", "medadmin_route",
        F.lit("OD").alias("medadmin_source"), F.col("_rx_name").alias("raw_medadmin_med_name"),
        text_id("drug_concept_id").alias("raw_medadmin_code"),
        F.col("eff_drug_dose_source_value").alias("raw_medadmin_dose_admin"),
        F.col("dose_unit_source_value").alias("raw_medadmin_dose_admin_unit"),
        F.col("route_source_value").alias("raw_medadmin_route"),
    ), "med_admin", study.site)


def least_package_code(concept: DataFrame, edges: DataFrame) -> DataFrame:
    """Per ingredient concept, the least 11-digit package code that maps to it."""
    packages = concept.where((F.col("vocabulary_id") == "NDC") & (F.col("concept_class_id") == "11-digit NDC")).select(
        F.col("concept_id").alias("_ndc_id"), F.col("concept_code").alias("least_ndc"))
    ingredients = concept.where(F.col("vocabulary_id") == "RxNorm").select(F.col("concept_id").alias("rx_id"))
    hops = crosswalk(packages, "_ndc_id", edges, D.MAPS_TO, ingredients, "rx_id")
    return smallest_per_key(hops.select("rx_id", "least_ndc"), ["rx_id"], "least_ndc")


def pick_package_code(df: DataFrame, concept: DataFrame, edges: DataFrame) -> DataFrame:
    """Package code by source concept → least one of the ingredient → raw text; rows for which no
    route knows a package code are dropped."""
    raw = packed_field("drug_source_value", 1)
    df = concept_lookup(df, concept, "drug_source_concept_id", {"_ndc": "concept_code"}, ["NDC"])
    # a crosswalk has no more rows than the graph has edges, which is the size to check
    df = attach(df, least_package_code(concept, edges), [(F.col("drug_concept_id"), "rx_id")], small=is_small(edges))
    df = member_flag(df, codes_of(concept, "code", ["NDC"]), raw, "_raw_ndc")
    known = F.col("least_ndc").isNotNull() | F.col("_ndc").isNotNull() | F.col("_raw_ndc")
    return df.where(known).withColumn(
        "ndc", F.coalesce("_ndc", "least_ndc", F.left(raw, F.lit(11)))).drop("_ndc", "least_ndc", "_raw_ndc")


def dispensing(study: Study) -> DataFrame:
    text = F.col("drug_source_value")
    rows = study["drug_exposure"].where((F.col("drug_type_concept_id") == D.DISPENSED) & keyword_kept(text))
    df = pick_package_code(keep_persons(rows, study.cohort), study.concept, study["concept_relationship"])
    df = lookup(df, study.value_map, "Dose unit", "dose_unit_concept_id", "dispense_dose_disp_unit", default="OT")
    df = lookup(df, study.value_map, "Route", "route_concept_id", "dispense_route", default="OT")
    return conform(df.select(
        text_id("drug_exposure_id").alias("dispensingid"), text_id("person_id").alias("patid"),
        F.col("drug_exposure_start_date").alias("dispense_date"), "ndc",
        null_if_zero("days_supply").alias("dispense_sup"), F.col("quantity").alias("dispense_amt"),
        decimal_of("effective_drug_dose", 15, 3).alias("dispense_dose_disp"), "dispense_dose_disp_unit",
        "dispense_route", F.lit("PM").alias("dispense_source"), text.alias("raw_ndc"),
        F.col("eff_drug_dose_source_value").alias("raw_dispense_dose_disp"),
        F.col("dose_unit_source_value").alias("raw_dispense_dose_disp_unit"),
        F.col("route_source_value").alias("raw_dispense_route"),
    ), "dispensing", study.site)


def dose_forms(study: Study) -> DataFrame:
    """Per drug concept, the least mapped code among its dose forms."""
    forms = study.concept.select(F.col("concept_id").alias("_form"))
    edges = study["concept_relationship"]
    # the edges of this kind name the drugs themselves: one pass over the graph
    hops = edges.where(F.col("relationship_id") == D.HAS_DOSE_FORM).select(
        F.col("concept_id_1").alias("_drug"), F.col("concept_id_2").alias("_to")).join(forms, F.col("_to") == F.col("_form"))
    mapped = lookup(hops, study.value_map, "Rx Dose Form", "_form", "dose_form")
    return smallest_per_key(mapped.select("_drug", "dose_form"), ["_drug"], "dose_form")


def prn_flag(frequency: Column) -> Column:
    low = F.trim(F.lower(frequency))
    return F.when(low.contains("as needed") | low.contains("prn"), "Y").otherwise("N")


def prescribing(study: Study) -> DataFrame:
    text = F.col("drug_source_value")
    rows = study["drug_exposure"].where(
        F.col("drug_type_concept_id").isin(list(D.ORDER_BASIS)) & since("drug_exposure_start_date", study.floor)
        & keyword_kept(text))
    df = keep_absent_or_visits(keep_persons(rows, study.cohort), study.cohort)
    df = concept_lookup(df, study.concept, "drug_concept_id", {"_rx": "concept_code", "_rx_name": "concept_name"}, ["RxNorm"])
    df = concept_lookup(df, study.concept, "drug_source_concept_id", {"_raw_rx": "concept_code"})
    df = attach(df, dose_forms(study), [(F.col("drug_concept_id"), "_drug")],
                small=is_small(study["concept_relationship"]))
    for out, cls, key in [
            ("rx_dose_ordered_unit", "Dose unit", F.col("dose_unit_concept_id")),
            ("_frequency", "Rx Frequency", F.trim(F.lower("frequency"))),
            ("rx_route", "Route", F.col("route_concept_id")),
            ("_as_written", "dispense written", F.col("dispense_as_written_concept_id"))]:
        df = lookup(df, study.value_map, cls, key, out, default="OT")
    raw_name = F.replace(packed_field(text, 1), F.lit('"'), F.lit(""))
    day = F.col("drug_exposure_start_date")
    return conform(df.select(
        text_id("drug_exposure_id").alias("prescribingid"), text_id("person_id").alias("patid"),
        text_id("visit_occurrence_id").alias("encounterid"), text_id("provider_id").alias("rx_providerid"),
        day.alias("rx_order_date"), hhmm("drug_exposure_start_datetime").alias("rx_order_time"),
        day.alias("rx_start_date"), F.col("drug_exposure_end_date").alias("rx_end_date"),
        F.col("effective_drug_dose").alias("rx_dose_ordered"), "rx_dose_ordered_unit",
        F.coalesce("dose_form", F.lit("OT")).alias("rx_dose_form"),
        F.round("quantity", 2).alias("rx_quantity"), F.col("refills").alias("rx_refills"),
        F.col("days_supply").alias("rx_days_supply"), F.left("_frequency", F.lit(2)).alias("rx_frequency"),
        prn_flag(F.col("frequency")).alias("rx_prn_flag"), "rx_route",
        decode("drug_type_concept_id", D.ORDER_BASIS, "NI").alias("rx_basis"),
        F.left(F.nullif("_rx", F.lit("")), F.lit(8)).alias("rxnorm_cui"), F.lit("OD").alias("rx_source"),
        F.left("_as_written", F.lit(2)).alias("rx_dispense_as_written"),
        F.coalesce("_rx_name", raw_name).alias("raw_rx_med_name"), F.col("frequency").alias("raw_rx_frequency"),
        F.col("_raw_rx").alias("raw_rxnorm_cui"), F.col("eff_drug_dose_source_value").alias("raw_rx_dose_ordered"),
        F.col("dose_unit_source_value").alias("raw_rx_dose_ordered_unit"),
        F.col("route_source_value").alias("raw_rx_route"), F.col("refills").cast("string").alias("raw_rx_refills"),
    ), "prescribing", study.site)


def vaccine_code(concept_id: Column, code: Column, raw: Column, mode: str = "fixed") -> Column:
    """Vaccine code: dictionary → second raw field → text rules → 999, at most 11 characters."""
    field2 = F.left(F.trim(packed_field(raw, 2)), F.lit(11))
    by_text = classify(raw, D.VACCINE_TEXT, D.VACCINE_DEFAULT, mode=mode)
    return F.left(F.when(concept_id != 0, code).when(field2 != "", field2).otherwise(by_text), F.lit(11))


def vaccine_code_type(vocabulary: Column, is_vaccine_code: Column) -> Column:
    return (F.when(vocabulary == "CVX", "CX").when(vocabulary == "NDC", "ND")
            .when(F.lower(vocabulary).startswith("rxnorm"), "RX").when(vocabulary.isin("CPT4", "HCPCS"), "CH")
            .when(is_vaccine_code, "CX").otherwise("UN"))


def body_site(df: DataFrame, vmap: DataFrame, concept_id: str, raw: str, out: str) -> DataFrame:
    """Body site by concept, else by the map entry that contains the raw text, else NI."""
    df = lookup(df, vmap, "imm_body_site", concept_id, "_site_id")
    text = F.trim(packed_field(raw, 1))
    df = lookup_contained(df, vmap, "imm_body_site_source", text, "_site_text", by=SOURCE)
    return df.withColumn(out, F.coalesce("_site_id", "_site_text", F.lit("NI"))).drop("_site_id", "_site_text")


def manufacturer(df: DataFrame, vmap: DataFrame, raw: str, out: str) -> DataFrame:
    """Manufacturer by the map name that contains the raw text, else by exact id, else OTH."""
    df = lookup_contained(df, vmap, "vx_manufacturer_source", F.col(raw), "_maker_text", by=LABEL)
    df = lookup(df, vmap, "vx_manufacturer", raw, "_maker_id")
    known = F.coalesce("_maker_text", "_maker_id", F.lit("OTH"))
    absent = F.col(raw).isNull() | (F.col(raw) == "")
    return df.withColumn(out, F.when(absent, "NI").otherwise(known)).drop("_maker_text", "_maker_id")


def flag_linked(rows: DataFrame, procedures: DataFrame) -> DataFrame:
    """Flag the rows whose procedure is known; those that name none, often most of them, stay where they are."""
    names = F.col("procedure_occurrence_id").isNotNull()
    done = procedures.select(F.col("procedure_occurrence_id").alias("_proc"))
    flagged = member_flag(rows.where(names), done, F.col("procedure_occurrence_id"), "_linked", scanned=True)
    return flagged.unionByName(rows.where(~names).withColumn("_linked", F.lit(False)))


def immunization(study: Study) -> DataFrame:
    concept, vmap = study.concept, study.value_map
    # a cohort visit is one of a cohort person, so the visits leave fewer rows for the later joins; what they leave is
    # written, so that the shuffle files of all rows are gone before the next ones are made
    rows = staged(keep_absent_or_visits(study["immunization"], study.cohort), "immunization_rows")
    df = keep_persons(flag_linked(rows, study["procedure_occurrence"]), study.cohort)
    vaccines = named_concepts(concept, rows, "immunization_concept_id")
    df = concept_lookup(df, vaccines, "immunization_concept_id", {
        "_code": "concept_code", "_name": "concept_name", "_voc": "vocabulary_id"})
    types = F.col("domain_id") == "Immunization Type"
    if study.local_vocabulary:
        types = types & (F.col("vocabulary_id") == study.local_vocabulary)
    df = concept_lookup(df, concept, "immunization_type_concept_id", {"_vx_source": "concept_code"}, where=types)
    df = lookup(df, vmap, "Dose unit", "imm_dose_unit_concept_id", "vx_dose_unit", default="OT")
    df = lookup(df, vmap, "Route", "imm_route_concept_id", "vx_route", default="OT")
    df = body_site(df, vmap, "imm_body_site_concept_id", "imm_body_site_source_value", "vx_body_site")
    df = manufacturer(df, vmap, "imm_manufacturer", "vx_manufacturer")
    raw = F.col("immunization_source_value")
    df = df.withColumn("vx_code", vaccine_code(F.col("immunization_concept_id"), F.col("_code"), raw, study.classifier_mode))
    df = member_flag(df, codes_of(concept, "code", ["CVX"]), F.col("vx_code"), "_is_cvx")
    return conform(df.select(
        text_id("immunization_id").alias("immunizationid"), text_id("person_id").alias("patid"),
        text_id("visit_occurrence_id").alias("encounterid"),
        F.when(F.col("_linked"), text_id("procedure_occurrence_id")).alias("proceduresid"),
        text_id("provider_id").alias("vx_providerid"), F.col("imm_recorded_date").alias("vx_record_date"),
        F.col("immunization_date").alias("vx_admin_date"), "vx_code",
        vaccine_code_type(F.col("_voc"), F.col("_is_cvx")).alias("vx_code_type"),
        F.lit("CP").alias("vx_status"), F.left(F.coalesce("_vx_source", F.lit("OT")), F.lit(2)).alias("vx_source"),
        parse_dose("immunization_dose").alias("vx_dose"), "vx_dose_unit", "vx_route", "vx_body_site", "vx_manufacturer",
        F.replace("imm_lot_num", F.lit('"'), F.lit("")).alias("vx_lot_num"), F.col("imm_exp_date").alias("vx_exp_date"),
        F.replace("_name", F.lit(","), F.lit("")).alias("raw_vx_name"), F.col("_code").alias("raw_vx_code"),
        F.col("_voc").alias("raw_vx_code_type"), F.col("immunization_dose").alias("raw_vx_dose"),
        F.col("imm_dose_unit_source_value").alias("raw_vx_dose_unit"), F.col("imm_route_source_value").alias("raw_vx_route"),
        F.col("imm_body_site_source_value").alias("raw_vx_body_site"), F.lit("CP").alias("raw_vx_status"),
        null_of("string").alias("raw_vx_manufacturer"),
    ), "immunization", study.site)
