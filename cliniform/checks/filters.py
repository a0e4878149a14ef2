"""Row filters, predicates and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..demo.adapter import FLOOR, SITE
from ..operators.dedupe import first_per_key
from ..operators.membership import keep_absent_or_visits, keep_visits
from ..plans.people import private_demographic
from ..plans.vitals import cohort_signs
from ..rules import drugs as D
from ..rules import labs as L
from ..rules import visits as R
from ..sources.model import conform
from .registry import case, quoted
from .targets import keywords

SINCE = f"date '{FLOOR}'"


def rows(name: str, table: str, columns: str, test, sql: str) -> None:
    """Query of the rows of a table that pass one test."""
    case(name, f"select {columns} from {table} where {sql}")(
        lambda s: s[table].where(test(s)).select(*columns.split(", ")))


COND = "condition_occurrence_id, condition_source_value"
DRUG = "drug_exposure_id, drug_source_value"
rows("flt_year_floor", "visit_occurrence", "visit_occurrence_id, visit_start_date", lambda s: fn.since("visit_start_date", s.floor),
     f"visit_start_date >= {SINCE}")
rows("flt_year_below", "visit_occurrence", "visit_occurrence_id, visit_start_date", lambda s: F.col("visit_start_date") < F.lit(s.floor),
     f"visit_start_date < {SINCE}")
rows("flt_in_list", "measurement", "measurement_id, measurement_concept_id", lambda s: F.col("measurement_concept_id").isin(R.VITAL_CONCEPTS),
     f"measurement_concept_id in {quoted(R.VITAL_CONCEPTS)}")
rows("flt_not_in_list", "condition_occurrence", "condition_occurrence_id, condition_type_concept_id",
     lambda s: ~F.col("condition_type_concept_id").isin(R.PROBLEM_LIST_TYPES), f"condition_type_concept_id not in {quoted(R.PROBLEM_LIST_TYPES)}")
rows("flt_regex_exclude", "condition_occurrence", COND, lambda s: ~F.col("condition_source_value").rlike(R.NO_DIAGNOSIS_MARK),
     "not regexp_matches(condition_source_value, 'NOD.X')")
rows("flt_keyword_deny", "documents", "doc_id, lang", lambda s: ~fn.contains_any("text", D.DENIED_WORDS), f"not {keywords('text', D.DENIED_WORDS)}")
rows("flt_keyword_match", "drug_exposure", DRUG, lambda s: fn.contains_any("drug_source_value", D.DENIED_WORDS)
     & (F.col("route_concept_id").isNull() | ~F.col("route_concept_id").isin(4112421)),
     f"{keywords('drug_source_value', D.DENIED_WORDS)} and (route_concept_id is null or route_concept_id not in (4112421))")
rows("flt_ilike_any", "condition_occurrence", COND, lambda s: fn.ilike_any("condition_source_value", R.EPIDEMIC_FRAGMENTS),
     "(" + " or ".join(f"condition_source_value ilike '%{f}%'" for f in R.EPIDEMIC_FRAGMENTS) + ")")
rows("flt_like_any", "part", "p_partkey, p_name", lambda s: F.col("p_type").isin("PROMO", "LARGE") | fn.contains_any("p_name", ["ring", "gear"]),
     "p_type in ('PROMO', 'LARGE') or lower(p_name) like '%ring%' or lower(p_name) like '%gear%'")
rows("flt_prefix", "measurement", "measurement_id, measurement_source_value", lambda s: F.col("measurement_source_value").startswith("POC"),
     "measurement_source_value like 'POC%'")
rows("flt_length", "condition_occurrence", COND, lambda s: F.length(F.trim(fn.packed_field("condition_source_value", 3))) <= 18,
     "length(trim(split_part(condition_source_value, '|', 3))) <= 18")
rows("flt_any_not_null", "measurement", "measurement_id", lambda s: F.coalesce("value_as_number", "range_low", "range_high").isNotNull(),
     "coalesce(value_as_number, range_low, range_high) is not null")
rows("flt_digits", "location", "location_id, zip", lambda s: fn.digits_only("zip") & (F.length("zip") >= 5), "regexp_matches(zip, '^[0-9]+$') and length(zip) >= 5")
rows("flt_date_cmp", "death", "person_id, death_date", lambda s: F.col("death_date") < F.lit(R.ICD10_SINCE), "death_date < date '2015-10-01'")
case("flt_interval_cover", """select device_exposure_id, case when device_exposure_start_date <= visit_start_date
    and device_exposure_end_date > visit_start_date then 'Y' else 'N' end as in_use
    from device_exposure join visit_occurrence using (visit_occurrence_id)""")(
    lambda s: s["device_exposure"].join(s["visit_occurrence"].select("visit_occurrence_id", "visit_start_date"), "visit_occurrence_id").select(
        "device_exposure_id", fn.covers("device_exposure_start_date", "device_exposure_end_date", "visit_start_date").alias("in_use")))
case("flt_null_or_member", """select measurement_id, visit_occurrence_id from measurement
    where visit_occurrence_id is null or visit_occurrence_id in (select visit_id from cohort)""")(
    lambda s: keep_absent_or_visits(s["measurement"], s.cohort).select("measurement_id", "visit_occurrence_id"))
rows("flt_notnull_or_member", "observation", "observation_id, visit_occurrence_id", lambda s: F.col("visit_occurrence_id").isNotNull(),
     "visit_occurrence_id is not null or visit_occurrence_id in (select visit_id from cohort)")
rows("flt_is_null", "immunization", "immunization_id", lambda s: F.col("imm_exp_date").isNull() & F.col("imm_manufacturer").isNotNull(),
     "imm_exp_date is null and imm_manufacturer is not null")
rows("flt_known_concept", "drug_exposure", "drug_exposure_id, drug_concept_id", lambda s: F.col("drug_concept_id") > 0, "drug_concept_id > 0")
rows("flt_text_norm_eq", "location_history", "location_history_id, domain_id", lambda s: F.trim(F.lower("domain_id")) == "person",
     "trim(lower(domain_id)) = 'person'")
rows("flt_site", "observation", "observation_id, site", lambda s: F.col("site") == s.site, f"site = '{SITE}'")


@case("rel_cte", f"""with recent as (select * from visit_occurrence where visit_start_date >= {SINCE}),
    per_person as (select person_id, count(*) as n_visits, min(visit_start_date) as first_visit from recent group by person_id)
    select p.person_id, p.gender_concept_id, n_visits, first_visit from person p join per_person using (person_id)""")
def _cte(s) -> DataFrame:
    recent = s["visit_occurrence"].where(fn.since("visit_start_date", s.floor))
    per_person = recent.groupBy("person_id").agg(F.count(F.lit(1)).alias("n_visits"), F.min("visit_start_date").alias("first_visit"))
    return s["person"].join(per_person, "person_id").select("person_id", "gender_concept_id", "n_visits", "first_visit")


case("prj_constants", "select person_id, 'HC' as source, null::date as onset_date, null::varchar as raw_type from person")(
    lambda s: s["person"].select("person_id", F.lit("HC").alias("source"), fn.null_of("date").alias("onset_date"),
                                 fn.null_of("string").alias("raw_type")))
case("prj_prefixed_id", "select 'c' || condition_occurrence_id as id from condition_occurrence union all select 'o' || observation_id from observation")(
    lambda s: s["condition_occurrence"].select(fn.text_id("condition_occurrence_id", "c").alias("id")).unionByName(
        s["observation"].select(fn.text_id("observation_id", "o").alias("id"))))
case("prj_reorder", f"""select null::varchar as chart, 'E' as enr_basis, observation_period_end_date as enr_end_date,
    observation_period_start_date as enr_start_date, person_id::varchar as patid, '{SITE}' as site from observation_period""")(
    lambda s: conform(s["observation_period"].select(
        fn.text_id("person_id").alias("patid"), F.col("observation_period_start_date").alias("enr_start_date"),
        F.col("observation_period_end_date").alias("enr_end_date"), F.lit("E").alias("enr_basis")), "enrollment", s.site))
case("prj_redact", """select patid, '' as pat_firstname, '' as pat_lastname, null::varchar as pat_ssn, birth_date, sex from o_demographic""")(
    lambda s: private_demographic(s).select("patid", "pat_firstname", "pat_lastname", "pat_ssn", "birth_date", "sex"))
case("prj_surrogate_id", """select sha256(concat_ws('|', coalesce('=' || l_orderkey, '~'), coalesce('=' || l_linenumber, '~'),
    coalesce('=' || l_partkey, '~'), coalesce('=' || l_suppkey, '~'))) as row_id, l_orderkey, l_linenumber from lineitem""")(
    lambda s: s["lineitem"].select(fn.row_key("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"), "l_orderkey", "l_linenumber"))
