"""Column functions, each over whole columns of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..demo.adapter import TODAY
from ..plans.labs import number_text
from .registry import case


def on(name: str, table: str, key: str, column, sql: str) -> None:
    """Query of one computed column beside the key of its table."""
    case(name, f"select {key} as id, {sql} as result from {table}")(
        lambda s: s[table].select(F.col(key).alias("id"), column().alias("result")))


RAW = "condition_source_value"
on("fn_split_part", "condition_occurrence", "condition_occurrence_id", lambda: fn.packed_field(RAW, 3), f"split_part({RAW}, '|', 3)")
on("fn_split_index", "drug_exposure", "drug_exposure_id", lambda: F.left(fn.packed_field("drug_source_value", 1), F.lit(11)),
   "left(string_split(drug_source_value, '|')[1], 11)")
on("fn_trim", "measurement", "measurement_id", lambda: F.trim(fn.packed_field("specimen_source_value", 1)),
   "trim(split_part(specimen_source_value, '|', 1))")
on("fn_first_of_list", "condition_occurrence", "condition_occurrence_id", lambda: fn.lead_code(RAW),
   f"""case when strpos(split_part({RAW}, '|', 3), ',') > 0 then trim(regexp_extract(split_part({RAW}, '|', 3), '^,*([^,]*)', 1))
   else trim(split_part({RAW}, '|', 3)) end""")
on("fn_lower", "documents", "doc_id", lambda: F.lower("lang"), "lower(lang)")
on("fn_left", "drug_exposure", "drug_exposure_id", lambda: F.left("drug_source_value", F.lit(11)), "left(drug_source_value, 11)")
on("fn_length", "documents", "doc_id", lambda: F.length("text"), "length(text)")
on("fn_replace", "immunization", "immunization_id", lambda: F.replace("imm_lot_num", F.lit('"'), F.lit("")), "replace(imm_lot_num, chr(34), '')")
on("fn_lpad", "person", "person_id", lambda: F.lpad(F.col("month_of_birth").cast("string"), 2, "0"), "lpad(month_of_birth::varchar, 2, '0')")
case("fn_concat", f"""select condition_occurrence_id as id, coalesce(split_part({RAW}, '|', 1), '') || '|' || coalesce(split_part({RAW}, '|', 3), '') as skipping,
    split_part({RAW}, '|', 1) || '|' || split_part({RAW}, '|', 3) as propagating from condition_occurrence""")(
    lambda s: s["condition_occurrence"].select(
        F.col("condition_occurrence_id").alias("id"),
        fn.glue(fn.packed_field(RAW, 1), F.lit("|"), fn.packed_field(RAW, 3)).alias("skipping"),
        F.concat(fn.packed_field(RAW, 1), F.lit("|"), fn.packed_field(RAW, 3)).alias("propagating")))
on("fn_regexp_match", "location", "location_id", lambda: fn.digits_only("zip"), "regexp_matches(zip, '^[0-9]+$')")
case("fn_regexp_replace", r"""select immunization_id as id, regexp_replace(immunization_dose, '[^0-9.]', '', 'g') as every,
    regexp_replace(imm_manufacturer, '[^\w]', ' ') as first_only from immunization""")(
    lambda s: s["immunization"].select(
        F.col("immunization_id").alias("id"), F.regexp_replace("immunization_dose", "[^0-9.]", "").alias("every"),
        F.regexp_replace("imm_manufacturer", r"^(\w*)[^\w]", "$1 ").alias("first_only")))
case("fn_like", """select drug_exposure_id as id, drug_source_value like '%oil%' as exact, drug_source_value ilike '%HEPARIN%' as folded,
    drug_source_value ilike '%kit%' or drug_source_value ilike '%formula%' as any_of from drug_exposure""")(
    lambda s: s["drug_exposure"].select(
        F.col("drug_exposure_id").alias("id"), F.col("drug_source_value").like("%oil%").alias("exact"),
        F.col("drug_source_value").ilike("%HEPARIN%").alias("folded"), fn.ilike_any("drug_source_value", ["kit", "formula"]).alias("any_of")))
on("fn_coalesce_default", "measurement", "measurement_id", lambda: F.coalesce("measurement_result_date", "measurement_date"),
   "coalesce(measurement_result_date, measurement_date)")
on("fn_nullif", "drug_exposure", "drug_exposure_id", lambda: fn.null_if_zero("days_supply"), "nullif(days_supply, 0)")
on("fn_case_decode", "visit_payer", "visit_payer_id", lambda: fn.decode("visit_payer_type_concept_id", {31968: "first", 31969: "second"}, "none"),
   "case visit_payer_type_concept_id when 31968 then 'first' when 31969 then 'second' else 'none' end")
case("fn_cast", """select observation_id as id, observation_id::varchar as as_text, try_cast(value_as_string as bigint) as as_number,
    try_cast(value_as_number as decimal(8,2))::double as as_decimal from observation""")(
    lambda s: s["observation"].select(
        F.col("observation_id").alias("id"), F.col("observation_id").cast("string").alias("as_text"),
        F.col("value_as_string").try_cast("bigint").alias("as_number"), fn.decimal_of("value_as_number", 8, 2).alias("as_decimal")))
case("fn_date_part", """select event_id as id, year(ts) as y, month(ts) as m, day(ts) as d, hour(ts) as h, minute(ts) as mi from events""")(
    lambda s: s["events"].select(F.col("event_id").alias("id"), F.year("ts").alias("y"), F.month("ts").alias("m"),
                                 F.dayofmonth("ts").alias("d"), F.hour("ts").alias("h"), F.minute("ts").alias("mi")))
on("fn_date_build", "person", "person_id", lambda: fn.date_from_parts("year_of_birth", "month_of_birth", "day_of_birth"),
   "make_date(year_of_birth, coalesce(month_of_birth, 1), coalesce(day_of_birth, 1))")
on("fn_time_hhmm", "events", "event_id", lambda: fn.hhmm("ts"), "strftime(ts, '%H:%M')")
on("fn_time_unpadded", "events", "event_id", lambda: fn.hour_minute_unpadded("ts"), "hour(ts) || ':' || minute(ts)")
case("fn_now", f"select location_history_id as id, coalesce(end_date, date '{TODAY}') as result from location_history")(
    lambda s: s["location_history"].select(F.col("location_history_id").alias("id"),
                                           F.coalesce("end_date", s.today_column).alias("result")))
case("fn_convert_units", """select measurement_id as id, round(value_as_number * 0.393701::double, 6) as inches,
    round(value_as_number * 2.20462::double, 6) as pounds, value_as_number / 1000 as thousands from measurement""")(
    lambda s: s["measurement"].select(
        F.col("measurement_id").alias("id"), F.round(fn.to_inches("value_as_number"), 6).alias("inches"),
        F.round(fn.to_pounds("value_as_number"), 6).alias("pounds"), (F.col("value_as_number") / 1000).alias("thousands")))
on("fn_round", "drug_exposure", "drug_exposure_id", lambda: fn.decimal_of(F.round("quantity", 1), 15, 8), "round(quantity, 1)")
on("fn_dose_parse", "immunization", "immunization_id", lambda: fn.parse_dose("immunization_dose"),
   """case when length(immunization_dose) <= 8 then try_cast(nullif(regexp_replace(immunization_dose, '[^0-9.]', '', 'g'), '') as decimal(10,0))::double
   else try_cast(left(nullif(regexp_replace(immunization_dose, '[^0-9.]', '', 'g'), ''), 8) as decimal(20,5))::double end""")
on("fn_number_text", "measurement", "measurement_id", lambda: number_text("range_high"), r"regexp_replace(range_high::varchar, '\.0$', '')")
