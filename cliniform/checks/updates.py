"""UPDATE and DELETE as transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..demo.adapter import SITE, TODAY
from ..operators.lookup import TARGET, entries, lookup
from ..operators.rules import apply_rules
from ..operators.sizing import attach, fixed_rows, is_small
from ..operators.update import delete_where, flag_ids, set_where, update_by_raw, update_from
from ..operators.membership import drop_members
from ..plans import encounters, labs
from ..rules import drugs as D
from ..rules import labs as L
from ..rules import visits as R
from .registry import VIEWS, case, mapped, quoted
from .targets import SINCE, _recovered, keywords, repair_views

case("upd_from_join", "select condition_occurrence_id, dx, dx_type from (" + _recovered("o_diag_kept", "r.dx_type in ('SM', 'OT')") + ")")(
    lambda s: encounters.diagnosis(s).select(F.col("diagnosisid").cast("bigint").alias("condition_occurrence_id"), "dx", "dx_type"))


@case("upd_from_map", f"""select measurement_id, case when unit_concept_id in (8998, 8999) then {mapped("result_unit_source", "lower(unit_source_value)")}
    else unit_concept_name end as unit from measurement""")
def _from_map(s) -> DataFrame:
    df = s["measurement"].select("measurement_id", "unit_concept_id", "unit_source_value", F.col("unit_concept_name").alias("unit"))
    df = lookup(df, s.value_map, "result_unit_source", F.lower("unit_source_value"), "_new")
    return set_where(df, F.col("unit_concept_id").isin(8998, 8999), unit=F.col("_new")).select("measurement_id", "unit")


RAW_UNIT = "case " + " ".join(f"when unit_source_value in {quoted(raws)} then '{u}'" for u, raws in L.RAW_UNITS) + " end"


@case("upd_by_source_value", f"""select measurement_id, coalesce(case when unit_concept_name is null or unit_concept_name = 'count' then {RAW_UNIT} end,
    unit_concept_name) as unit from measurement""")
def _by_source(s) -> DataFrame:
    df = s["measurement"].select("measurement_id", "unit_source_value", F.col("unit_concept_name").alias("unit"))
    rules = fixed_rows(df.sparkSession, "raw string, unit string", [(r, u) for u, raws in L.RAW_UNITS for r in raws])
    guard = F.col("unit").isNull() | (F.col("unit") == "count")
    return update_by_raw(df, rules, F.col("unit_source_value"), guard, "unit").select("measurement_id", "unit")


case("upd_by_rules", """select l_orderkey, l_linenumber, l_partkey, l_suppkey,
    case when l_returnflag = 'A' and l_quantity > 40 then l_extendedprice / 1000 else l_extendedprice end as price,
    case when l_returnflag = 'A' and l_quantity > 40 then 'K' when l_returnflag = 'N' and l_linestatus = 'O' then 'P' else l_returnflag end as flag
    from lineitem""")(
    lambda s: set_where(set_where(
        s["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_linestatus",
                             F.col("l_extendedprice").alias("price"), F.col("l_returnflag").alias("flag")),
        (F.col("flag") == "A") & (F.col("l_quantity") > 40), price=F.col("price") / 1000, flag="K"),
        (F.col("flag") == "N") & (F.col("l_linestatus") == "O"), flag="P")
    .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price", "flag"))

# Every modifier state occurs among the line items: three codes and two bounds from their keys.
_CODES = ["EQ", "GE", "GT", "LE", "LT", "OT", "NO", "", None]


def _spread(expr: str) -> str:
    arms = " ".join(f"when {i} then {'null' if c is None else quoted([c])[1:-1]}" for i, c in enumerate(_CODES))
    return f"case cast({expr} as bigint) % {len(_CODES)} {arms} end"


VIEWS["o_states"] = f"""select fact_id, {_spread("l_partkey")} as m0, {_spread("l_suppkey + qty")} as l0, {_spread("qty + l_linenumber")} as h0,
    case when l_partkey % 3 = 0 then null else 'x' end as low_text, case when l_suppkey % 4 = 0 then null else 'y' end as high_text from line_facts"""
_LAST = repair_views("o_states", "o_cascade")


def _states(s) -> DataFrame:
    def spread(expr: str):
        return F.expr(_spread(expr))
    return s["line_facts"].select(
        "fact_id", spread("l_partkey").alias("result_modifier"), spread("l_suppkey + qty").alias("norm_modifier_low"),
        spread("qty + l_linenumber").alias("norm_modifier_high"), F.expr("case when l_partkey % 3 = 0 then null else 'x' end").alias("norm_range_low"),
        F.expr("case when l_suppkey % 4 = 0 then null else 'y' end").alias("norm_range_high"))


_REPAIRED = f"select fact_id, m0 as result_modifier, l0 as norm_modifier_low, h0 as norm_modifier_high from {_LAST}"
_MODS = ["fact_id", "result_modifier", "norm_modifier_low", "norm_modifier_high"]


@case("upd_rule_cascade", _REPAIRED)
def _cascade(s) -> DataFrame:
    """The same repair as a fold of order-dependent updates."""
    cols = _MODS[1:]
    rules = []
    for accepted, new, bounds in labs.repair_steps():
        test = F.lit(True)
        for c, values in zip(cols, accepted):
            known = F.col(c).isin([v for v in values if v is not None])
            test = test & (known | F.col(c).isNull() if None in values else known)
        for c, there in zip(("norm_range_low", "norm_range_high"), bounds):
            if there is not None:
                test = test & (F.col(c).isNotNull() if there else F.col(c).isNull())
        rules.append((test, {c: n for c, n in zip(cols, new) if n is not None}))
    return apply_rules(_states(s), rules).select(*_MODS)


case("modifier_repair", _REPAIRED)(lambda s: labs.repair_modifiers(_states(s)).select(*_MODS))


@case("upd_by_id_set", """select drug_exposure_id, case when drug_exposure_id in (select drug_exposure_id from drug_exposure join concept
    on concept_id = drug_concept_id where vocabulary_id = 'Brand') then 'B' else 'G' end as kind from drug_exposure""")
def _by_ids(s) -> DataFrame:
    brands = s.concept.where("vocabulary_id = 'Brand'").select("concept_id")
    df = flag_ids(s["drug_exposure"], brands, "drug_concept_id", "_brand").withColumn("kind", F.lit("G"))
    return set_where(df, F.col("_brand"), kind="B").select("drug_exposure_id", "kind")


@case("upd_cross", f"""select s_suppkey, coalesce((select min(target_code) from value_map where source_class = 'datamart_name' and source_code = '{SITE}'), s_name) as mart,
    date '{TODAY}' as refreshed from supplier""")
def _cross(s) -> DataFrame:
    df = lookup(s["supplier"].withColumns({"_site": F.lit(s.site), "mart": F.col("s_name")}), s.value_map, "datamart_name", "_site", "_name")
    return set_where(df.withColumn("refreshed", s.today_column), F.col("_name").isNotNull(), mart=F.col("_name")).select("s_suppkey", "mart", "refreshed")


case("del_where", """select procedure_occurrence_id, procedure_source_value from procedure_occurrence
    where not coalesce(length(split_part(procedure_source_value, '|', 2)) < 5, false)""")(
    lambda s: delete_where(s["procedure_occurrence"], F.length(fn.packed_field("procedure_source_value", 2)) < 5)
    .select("procedure_occurrence_id", "procedure_source_value"))
case("del_in_subquery", f"""select measurement_id, visit_occurrence_id from measurement where visit_occurrence_id is null or visit_occurrence_id not in (
    select visit_occurrence_id from visit_occurrence where visit_start_date < {SINCE})""")(
    lambda s: drop_members(s["measurement"], s["visit_occurrence"].where(F.col("visit_start_date") < F.lit(s.floor)),
                           ("visit_occurrence_id", "visit_occurrence_id"), keep_null=True).select("measurement_id", "visit_occurrence_id"))
