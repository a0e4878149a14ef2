"""Aggregates, picks, windows and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.dedupe import first_per_key, latest_per_key, nulls_last, smallest_per_key, union_all, union_distinct
from ..operators.lookup import lookup
from ..plans import drugs, encounters, people
from ..rules import visits as R
from ..sources.readers import key_bounds
from .registry import case, mapped, quoted
from .targets import SINCE

case("agg_distinct", "select distinct person_id, observation_period_start_date as period_start from observation_period")(
    lambda s: s["observation_period"].select("person_id", F.col("observation_period_start_date").alias("period_start")).distinct())
case("agg_group_min", f"""select visit_occurrence_id, min(value_as_concept_id) as value_as_concept_id from observation
    where observation_concept_id = {R.DISPOSITION_QUESTION} group by 1""")(
    lambda s: smallest_per_key(s["observation"].where(F.col("observation_concept_id") == R.DISPOSITION_QUESTION)
                               .select("visit_occurrence_id", "value_as_concept_id"), ["visit_occurrence_id"], "value_as_concept_id"))
case("agg_group_dedupe", "select person_id, death_date from death group by 1, 2")(
    lambda s: s["death"].select("person_id", "death_date").distinct())
DRUG = ["drug_exposure_id", "quantity", "route_concept_id"]
case("agg_first_per_key", """select distinct on (visit_occurrence_id) visit_occurrence_id, drug_exposure_id, quantity, route_concept_id from drug_exposure
    order by visit_occurrence_id, drug_exposure_start_date nulls first, drug_exposure_id""")(
    lambda s: first_per_key(s["drug_exposure"].select("visit_occurrence_id", *DRUG, "drug_exposure_start_date"), ["visit_occurrence_id"],
                            [F.col("drug_exposure_start_date"), F.col("drug_exposure_id")]).select("visit_occurrence_id", *DRUG))
ENC = "select encounterid, enc_type, count(*) filter (pdx = 'P') as primaries, count(*) filter (pdx <> 'P') as others from o_diagnosis group by 1, 2"


def _counts(s) -> DataFrame:
    return encounters.diagnosis(s).groupBy("encounterid", "enc_type").agg(
        F.count_if(F.col("pdx") == "P").alias("primaries"), F.count_if(F.col("pdx") != "P").alias("others"))


case("agg_conditional_count", ENC)(_counts)
case("agg_having_zero", f"select * from ({ENC}) where primaries = 0")(lambda s: _counts(s).where("primaries = 0"))
case("agg_group_case_count", """select person_id, visit_occurrence_id, qualifier_concept_id, value_as_string,
    case when count(value_as_string) > 1 and qualifier_concept_id = 9191 then value_as_string else value_as_string end as picked
    from observation group by 1, 2, 3, 4""")(
    lambda s: s["observation"].groupBy("person_id", "visit_occurrence_id", "qualifier_concept_id", "value_as_string").agg(
        F.count("value_as_string").alias("_n")).select("person_id", "visit_occurrence_id", "qualifier_concept_id", "value_as_string",
                                                       F.col("value_as_string").alias("picked")))
case("agg_minmax_bounds", "select min(measurement_id) as low, max(measurement_id) as high from measurement")(
    lambda s: key_bounds(s["measurement"], "measurement_id"))
case("agg_count_violations", "select count(*) as violations from observation where person_id not in (select person_id from cohort_person)")(
    lambda s: s["observation"].groupBy("person_id").agg(F.count(F.lit(1)).alias("n")).join(
        s.cohort.select("person_id"), "person_id", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")))
case("distinct_on", """select distinct on (person_id, death_date) person_id, death_date, cause_concept_id, cause_source_value from death
    order by person_id, death_date, cause_concept_id nulls first, cause_source_value nulls first""")(
    lambda s: first_per_key(s["death"].select("person_id", "death_date", "cause_concept_id", "cause_source_value"), ["person_id", "death_date"]))
PAYER = f"select visit_payer_id, visit_occurrence_id, {mapped('Payer', "plan_class || '-' || plan_type")} as payer from visit_payer"
case("distinct_on_ordered", f"""select distinct on (visit_occurrence_id) visit_occurrence_id, visit_payer_id, payer from ({PAYER})
    order by visit_occurrence_id, payer nulls last, visit_payer_id""")(
    lambda s: encounters.visit_payers(s).select(F.col("_vp").alias("visit_occurrence_id"), "visit_payer_id", F.col("_payer").alias("payer")))
case("win_latest_per_day", f"""select person_id, observation_id, observation_date, value_as_concept_id from observation
    where observation_concept_id = {R.ORIENTATION_QUESTION}
    qualify row_number() over (partition by person_id order by observation_date desc, observation_id desc) = 1""")(
    lambda s: latest_per_key(s["observation"].where(F.col("observation_concept_id") == R.ORIENTATION_QUESTION).select(
        "person_id", "observation_id", "observation_date", "value_as_concept_id"), ["person_id"], "observation_date", "observation_id"))
case("win_first_candidate", """select encounterid, enc_type, diagnosisid from o_diagnosis where dx_origin = 'OD'
    qualify row_number() over (partition by encounterid, enc_type order by diagnosisid) = 1""")(
    lambda s: smallest_per_key(encounters.diagnosis(s).where("dx_origin = 'OD'").select("encounterid", "enc_type", "diagnosisid"),
                               ["encounterid", "enc_type"], "diagnosisid"))
case("win_global_rownum", """select sha256(concat_ws('|', coalesce('=' || entity_id, '~'), coalesce('=' || location_id, '~'), coalesce('=' || start_date, '~'))) as row_id,
    entity_id, location_id from location_history""")(
    lambda s: s["location_history"].select(fn.row_key("entity_id", "location_id", "start_date").alias("row_id"), "entity_id", "location_id"))
case("top1_per_key", """select l_orderkey, l_extendedprice, l_partkey from lineitem
    qualify row_number() over (partition by l_orderkey order by l_extendedprice desc, l_partkey) = 1""")(
    lambda s: first_per_key(s["lineitem"].select("l_orderkey", "l_extendedprice", "l_partkey"), ["l_orderkey"],
                            [-F.col("l_extendedprice"), F.col("l_partkey")]))
case("set_union_distinct", "select person_id, observation_date as day from observation union select person_id, visit_start_date from visit_occurrence")(
    lambda s: union_distinct(s["observation"].select("person_id", F.col("observation_date").alias("day")),
                             s["visit_occurrence"].select("person_id", F.col("visit_start_date").alias("day"))))
VITAL = "person_id, visit_occurrence_id, measurement_concept_id, value_as_number"
case("set_union_same_source", " union ".join(f"select distinct {VITAL} from measurement where measurement_concept_id in {quoted(ids)}" for ids in (
    [R.HEIGHT, R.OTHER_HEIGHT], [R.WEIGHT, R.OTHER_WEIGHT], [R.BODY_MASS], R.SYSTOLIC, R.DIASTOLIC)))(
    lambda s: s["measurement"].where(F.col("measurement_concept_id").isin(R.VITAL_CONCEPTS)).select(*VITAL.split(", ")).distinct())
case("set_union_all", "select person_id, observation_date as day from observation union all select person_id, visit_start_date from visit_occurrence")(
    lambda s: union_all(s["observation"].select("person_id", F.col("observation_date").alias("day")),
                        s["visit_occurrence"].select("person_id", F.col("visit_start_date").alias("day"))))
