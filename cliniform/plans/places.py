"""Addresses and geocodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean_city, text_id, zip5, zip9
from ..operators.lookup import CLASS, LABEL, TARGET, lookup
from ..operators.membership import keep_persons
from ..operators.sizing import attach, is_small
from ..sources.model import conform
from ..sources.study import Study


def state_code(df: DataFrame, vmap: DataFrame, state: Column, out: str) -> DataFrame:
    """State by its two-letter code or its name: map labels read ``XX=Name``.

    Both spellings of a map row become keys, so the choice of spelling is part of the key.
    """
    label = F.col(LABEL)
    side = F.explode(F.array(
        F.struct(F.lit(True).alias("short"), F.lower(F.trim(F.split_part(label, F.lit("="), F.lit(1)))).alias("text")),
        F.struct(F.lit(False).alias("short"), F.lower(F.trim(F.split_part(label, F.lit("="), F.lit(2)))).alias("text"))))
    part = vmap.where(F.col(CLASS) == "address_state")
    spelled = part.select(side.alias("s"), F.col(TARGET).alias(out))
    dim = spelled.groupBy(F.col("s.short").alias("_short"), F.col("s.text").alias("_state")).agg(
        F.min(out).alias(out))
    return attach(df, dim, [(F.length(state) == 2, "_short"), (F.lower(state), "_state")], small=is_small(vmap))


def address_history(study: Study) -> DataFrame:
    history = study["location_history"].where(F.lower("domain_id") == "person")
    df = keep_persons(history, study.cohort, "entity_id")
    places = study["location"].select(F.col("location_id").alias("_loc"), "city", "county", "state", "zip")
    df = attach(df, places, [(F.col("location_id"), "_loc")], "inner")
    df = lookup(df, study.value_map, "address_preferred", "location_preferred_concept_id", "address_preferred", default="Y")
    df = lookup(df, study.value_map, "address_type", "relationship_type_concept_id", "address_type", default="BO")
    df = state_code(df, study.value_map, F.col("state"), "_state_code")
    return conform(df.select(
        clean_city("city").alias("address_city"), F.col("county").alias("address_county"),
        F.col("end_date").alias("address_period_end"), F.col("start_date").alias("address_period_start"),
        "address_preferred", "address_type",
        F.coalesce("_state_code", F.lit("NI")).alias("address_state"),
        F.lit("HO").alias("address_use"), zip5("zip").alias("address_zip5"), zip9("zip").alias("address_zip9"),
        text_id("location_history_id").alias("addressid"), text_id("entity_id").alias("patid"),
    ), "lds_address_history", study.site)


def address_geocode(study: Study) -> DataFrame:
    known = study.target("lds_address_history", address_history).select(F.col("addressid").alias("_known"))
    history = study["location_history"].select("location_history_id", "location_id")
    history = history.join(known, text_id("location_history_id") == F.col("_known"), "left_semi")
    codes = study["location_fips"].withColumnRenamed("location_id", "_loc")
    df = attach(history, codes, [(F.col("location_id"), "_loc")], "inner")
    return conform(df.withColumns({
        "geocodeid": F.concat(text_id("geocode_id"), text_id("location_history_id")),
        "addressid": text_id("location_history_id"),
        "geocode_custom_text": F.col("geocode_year").cast("string"),
        "shapefile": F.col("geocode_shapefile"),
    }), "private_address_geocode", study.site)
