"""Laboratory results: specimen, modifiers, units, result codes, formatting rules."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import contains_any, hhmm, hour_minute_unpadded, null_of, packed_field, since, text_id
from ..operators.lookup import TARGET, concept_lookup, entries, lookup
from ..operators.membership import keep_visits
from ..operators.rules import classify
from ..operators.sizing import attach, fixed_rows, is_small
from ..operators.update import set_where, update_by_raw
from ..rules import labs as L
from ..rules.results import RESULT_TEXT
from ..sources.model import conform
from ..sources.study import Study


def number_text(c: str | Column) -> Column:
    """Number in plain digits, without needless zeros. Beyond 20 digits before the point or 18 behind
    it, the engine's own notation stays."""
    col = F.col(c) if isinstance(c, str) else c
    plain = F.regexp_replace(F.regexp_replace(col.try_cast("decimal(38,18)").cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return F.coalesce(F.when((col == 0) | (F.abs(col) >= 1e-16), plain), F.regexp_replace(col.cast("string"), r"\.0$", ""))


def range_modifier(low: Column, high: Column, low_name: Column, high_name: Column) -> Column:
    """Modifier pair of a reference range from its two operators."""
    pair = F.when(high == low, "EQ|EQ")
    for lows, highs, value in L.RANGE_PAIRS:
        pair = pair.when(low.isin(lows) & high.isin(highs), value)
    return pair.otherwise(F.concat(high_name, F.lit("|"), low_name))


def resolve_specimen(df: DataFrame, vmap: DataFrame, concept_id: str, loinc: str, raw: str, out: str) -> DataFrame:
    """Specimen by concept → by test code → by raw text → OT."""
    df = lookup(df, vmap, "Specimen concept", concept_id, "_sp1")
    df = lookup(df, vmap, "specimen_loinc", loinc, "_sp2")
    df = lookup(df, vmap, "specimen_source", F.trim(F.lower(packed_field(raw, 1))), "_sp3")
    mapped = F.coalesce("_sp1", "_sp2", F.lit("OT"))
    return df.withColumn(out, F.when(mapped == "OT", F.coalesce("_sp3", F.lit("OT"))).otherwise(mapped)).drop("_sp1", "_sp2", "_sp3")


def modifiers(operator: Column, name: Column, pair: Column, value: Column) -> dict[str, Column]:
    """Result, low and high modifier from the operator name, the range pair and the value."""
    first, second = F.trim(packed_field(pair, 1)), F.trim(packed_field(pair, 2))
    result = F.coalesce(
        F.when(operator.isNotNull() & (operator != 0), name),
        F.when(first.isin("EQ", "GE", "GT"), first).when(second.isin("EQ", "LE", "LT"), second),
        F.when(value.isNotNull(), "EQ"), name)
    rising, falling = name.isin("GE", "GT"), name.isin("LE", "LT")
    low = F.coalesce(F.when(name == "EQ", "EQ").when(rising, name).when(falling, "NO"), first)
    high = F.coalesce(F.when(name == "EQ", "EQ").when(rising, "NO").when(falling, name), second)
    return {"result_modifier": result, "norm_modifier_low": low, "norm_modifier_high": high}


def resolve_units(df: DataFrame, vmap: DataFrame) -> DataFrame:
    """Unit by concept → by raw text → by target spelling → by raw spelling lists → by test.

    The step by target spelling overwrites an unmapped unit even when nothing is found.
    """
    df = lookup(df, vmap, "Result unit", "unit_concept_id", "_u1")
    df = lookup(df, vmap, "result_unit_source", F.trim("raw_unit"), "_u2")
    df = df.withColumn("result_unit", F.coalesce("_u1", "_u2")).drop("_u1", "_u2")
    spelled = entries(vmap, ["result_unit_source", "Result unit"], {"_ku": F.lower(TARGET)}, {"_u3": TARGET})
    df = attach(df, spelled, [(F.lower("raw_unit"), "_ku")], small=is_small(vmap))
    df = set_where(df, F.col("result_unit").isin(L.UNMAPPED_UNITS), result_unit=F.col("_u3")).drop("_u3")
    lists = fixed_rows(df.sparkSession, "raw string, unit string",
                       [(raw, unit) for unit, raws in L.RAW_UNITS for raw in raws])
    unknown = F.col("result_unit").isNull() | F.col("result_unit").isin(L.UNKNOWN_UNITS)
    df = update_by_raw(df, lists, F.col("raw_unit"), unknown, "result_unit")
    return units_by_test(df)


def units_by_test(df: DataFrame) -> DataFrame:
    """Unit of pH and ratio tests that still have none (NULL stays NULL)."""
    unknown = F.col("result_unit").isin(L.UNKNOWN_UNITS)
    acid = F.col("lab_loinc").isin(L.PH_CODES) | contains_any("raw_lab_name", L.PH_NAMES)
    df = set_where(df, acid & unknown, result_unit="[pH]")
    ratio = F.col("lab_loinc").isin(L.RATIO_CODES) | contains_any("raw_lab_name", L.RATIO_NAMES)
    return set_where(df, ratio & unknown, result_unit="{ratio}")


def rescale_counts(df: DataFrame) -> DataFrame:
    """Absolute counts per microlitre become thousands."""
    test = F.col("lab_loinc").isin(L.ABSOLUTE_COUNT_CODES) & F.col("result_unit").isin(L.PER_MICROLITRE)
    return set_where(df, test, result_num=F.col("result_num") / 1000, result_unit=L.THOUSANDS_UNIT)


def rewrite_white_cells(df: DataFrame) -> DataFrame:
    test = (F.col("lab_loinc") == L.WHITE_CELL_CODE) & (F.col("specimen_source") == L.BLOOD)
    return set_where(df, test, lab_loinc=L.WHITE_CELL_BLOOD_CODE)


def repair_steps() -> list[tuple[list[set], list[str | None], tuple[bool | None, bool | None]]]:
    """Repair steps: accepted values (None stands for NULL), new values (None keeps), bounds that must be there or not."""
    return [([set(v) for v in step[:3]], list(step[3:6]), step[6:]) for step in L.MODIFIER_REPAIRS]


def repair_table() -> list[tuple]:
    """Outcome of all repair steps in order for every state they change.

    The steps read a few modifiers and whether the range bounds exist, so their combined effect
    is a finite table: (result, low, high, has_low, has_high) → (result, low, high).
    """
    steps = repair_steps()
    values = sorted({v for accepted, _, _ in steps for s in accepted for v in s if v is not None}) + [None]
    table = []
    for *state, has_low, has_high in product(values, values, values, (True, False), (True, False)):
        now = list(state)
        for accepted, new, (low, high) in steps:
            if low in (None, has_low) and high in (None, has_high) and all(v in s for v, s in zip(now, accepted)):
                now = [o if n is None else n for o, n in zip(now, new)]
        if now != state:
            table.append((*state, has_low, has_high, *now))
    return table


def repair_modifiers(df: DataFrame) -> DataFrame:
    """Apply the repair steps as one join with their outcome table."""
    schema = "_r string, _l string, _h string, _hl boolean, _hh boolean, _nr string, _nl string, _nh string"
    table = fixed_rows(df.sparkSession, schema, repair_table()).withColumn("_hit", F.lit(True))
    keys = [(F.col("result_modifier"), "_r"), (F.col("norm_modifier_low"), "_l"), (F.col("norm_modifier_high"), "_h"),
            (F.col("norm_range_low").isNotNull(), "_hl"), (F.col("norm_range_high").isNotNull(), "_hh")]
    joined = attach(df, table, keys, null_safe=True)
    done = set_where(joined, F.col("_hit"), result_modifier=F.col("_nr"), norm_modifier_low=F.col("_nl"),
                     norm_modifier_high=F.col("_nh"))
    return done.select(*df.columns)


def point_of_care(raw: Column) -> Column:
    return F.when(raw.startswith("POC"), "P").otherwise("L")


def lab_result(study: Study) -> DataFrame:
    concept, vmap = study.concept, study.value_map
    lab_test = F.col("concept_class_id") == "Lab Test"
    rows = study["measurement"].where(
        (F.col("measurement_type_concept_id") == L.LAB_RECORD_TYPE) & (F.col("measurement_concept_id") > 0)
        & since("measurement_date", study.floor))
    # the dictionary drops all that is no lab test before rows move for the visit test
    df = concept_lookup(rows, concept, "measurement_concept_id", {"lab_loinc": "concept_code", "raw_lab_name": "concept_name"},
                        ["LOINC"], lab_test, how="inner")
    df = keep_visits(df, study.cohort)
    df = concept_lookup(df, concept, "measurement_source_concept_id", {"raw_lab_code": "concept_code"}, ["LOINC"], lab_test)
    df = concept_lookup(df, concept, "operator_concept_id", {"_operator": "concept_name"},
                        where=F.col("domain_id") == "Meas Value Operator")
    for out, key in [("_hi", "range_high_operator_concept_id"), ("_lo", "range_low_operator_concept_id"),
                     ("_mod", "operator_concept_id")]:
        df = lookup(df, vmap, "Result modifier", key, out)
    df = resolve_specimen(df, vmap, "specimen_concept_id", "lab_loinc", "specimen_source_value", "specimen_source")
    df = lookup(df, vmap, "Lab priority", "priority_concept_id", "priority")
    df = lookup(df, vmap, "Result qualifier", "value_as_concept_id", "_qualifier")
    pair = range_modifier(F.col("range_low_operator_concept_id"), F.col("range_high_operator_concept_id"),
                          F.col("_lo"), F.col("_hi"))
    value = F.col("value_as_number")
    df = df.withColumn("_pair", pair)
    df = df.select(
        text_id("measurement_id").alias("lab_result_cm_id"), text_id("person_id").alias("patid"),
        text_id("visit_occurrence_id").alias("encounterid"), "specimen_source", "lab_loinc", "priority",
        F.lit("OD").alias("lab_result_source"), F.lit("LM").alias("lab_loinc_source"),
        point_of_care(F.col("measurement_source_value")).alias("result_loc"),
        F.col("measurement_order_date").alias("lab_order_date"), F.col("measurement_date").alias("specimen_date"),
        hour_minute_unpadded("measurement_datetime").alias("specimen_time"),
        F.coalesce("measurement_result_date", "measurement_date").alias("result_date"),
        hhmm("measurement_result_datetime").alias("result_time"),
        classify("value_source_value", RESULT_TEXT, "OT", F.col("_qualifier"), study.classifier_mode).alias("result_qual"),
        value.alias("result_num"),
        *[c.alias(n) for n, c in modifiers(F.col("operator_concept_id"), F.col("_mod"), F.col("_pair"), value).items()],
        F.left(number_text("range_low"), F.lit(10)).alias("norm_range_low"),
        F.left(number_text("range_high"), F.lit(10)).alias("norm_range_high"),
        "raw_lab_name", "raw_lab_code", F.concat(F.col("_operator"), number_text(value)).alias("raw_result"),
        F.col("unit_source_value").alias("raw_unit"), "unit_concept_id", null_of("string").alias("abn_ind"))
    df = resolve_units(df, vmap)
    df = repair_modifiers(rewrite_white_cells(rescale_counts(df)))
    return conform(df, "lab_result_cm", study.site)
