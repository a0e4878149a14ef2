"""Sources, sinks, schemas, maps, audit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fn
from ..demo.adapter import SITE, TODAY
from ..operators.dedupe import union_all
from ..operators.lookup import CLASS
from ..plans import administration
from ..sources.model import TABLES, conform, empty
from ..sources.readers import COMPLAINT_MAP, VALUE_MAP, or_empty, read_map
from ..sources.audit import StageAudit
from ..sources.stage import stage_root, staged
from ..sources.study import Study
from ..sources.writers import insert, insert_sorted, run_log, seed_if_empty, stage_counts, write_csv, write_ranged, write_table
from .registry import case
from .targets import _HARVEST, NAMES, blank


def folder(s: Study, name: str) -> str:
    from uuid import uuid4
    return f"{stage_root(s.value_map.sparkSession)}/cliniform/{uuid4().hex}/{name}"


case("src_range_scan", "select o_orderkey, o_custkey, o_totalprice from orders")(
    lambda s: write_ranged(s["orders"].select("o_orderkey", "o_custkey", "o_totalprice"), folder(s, "orders_ranged"), "o_orderkey", 16))
case("src_plain_scan", "select * from nation")(lambda s: s["nation"])


def part_map(s: Study, schema: T.StructType, exprs: list[str]) -> DataFrame:
    """The parts as a mapping file: written as CSV, read back typed."""
    cols = s["part"].selectExpr(*[f"{e} as {f.name}" for e, f in zip(exprs, schema)])
    return read_map(s["part"].sparkSession, write_csv(cols, folder(s, "map")), schema)


CODE = ["p_type", "p_brand", "concat(p_name, ', \"', p_brand, '\"')", "cast(p_partkey as string)", "p_name", "nullif(p_type, 'PROMO')"]
CODE_SQL = """select p_type as source_class, p_brand as target_code, p_name || ', "' || p_brand || '"' as target_label, p_partkey::varchar as source_code,
    p_name as description, nullif(p_type, 'PROMO') as value_code from part"""
COMPLAINT = ["concat(p_name, ', ', p_type)", "p_size", "p_partkey", "p_name", "p_brand", "p_type", "'10'"]
COMPLAINT_SQL = """select p_name || ', ' || p_type as complaint_text, p_size as row_count, p_partkey as concept_id, p_name as concept_name,
    p_brand as concept_code, p_type as vocabulary_id, '10' as code_type from part"""
case("src_csv_map", COMPLAINT_SQL)(lambda s: part_map(s, COMPLAINT_MAP, COMPLAINT))
case("pipe_maps", f"""select 'codes' as map_name, source_class as class_name, count(*) as n_rows, count(distinct source_code) as n_keys from ({CODE_SQL}) group by 2
    union all select 'complaints', vocabulary_id, count(*), count(distinct lower(complaint_text)) from ({COMPLAINT_SQL}) group by 2""")(
    lambda s: part_map(s, VALUE_MAP, CODE).groupBy(F.lit("codes").alias("map_name"), F.col(CLASS).alias("class_name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("source_code").alias("n_keys")).unionByName(
        part_map(s, COMPLAINT_MAP, COMPLAINT).groupBy(F.lit("complaints").alias("map_name"), F.col("vocabulary_id").alias("class_name")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.countDistinct(F.lower("complaint_text")).alias("n_keys"))))


@case("src_empty_guard", "select o_orderkey as visit_occurrence_id, 0 as n from orders")
def _guard(s: Study) -> DataFrame:
    """An absent source joins the union as an empty frame of its sibling's schema."""
    present = s["orders"].select(F.col("o_orderkey").alias("visit_occurrence_id"), F.lit(0).cast("bigint").alias("n"))
    absent = or_empty(None, present.sparkSession, present.schema)
    return union_all(present, absent)


ORDER_COLUMNS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string"


@case("sink_csv", "select o_orderkey, o_custkey, o_orderstatus, o_orderpriority from orders")
def _csv(s: Study) -> DataFrame:
    names = [c.split(" ")[0] for c in ORDER_COLUMNS.split(", ")]
    path = write_csv(s["orders"].select(*names), folder(s, "orders_csv"))
    return s["orders"].sparkSession.read.option("header", True).schema(ORDER_COLUMNS).csv(path)


case("sink_insert", "select " + blank("provider", providerid="s_suppkey", provider_sex="'OT'") + " from supplier")(
    lambda s: insert(s["supplier"].select(fn.text_id("s_suppkey").alias("providerid"), F.lit("OT").alias("provider_sex"), "s_name"),
                     "provider", s.site, ["providerid", "provider_sex"]))


_OFFERED = """select case when s_suppkey % 7 = 0 then null else s_suppkey::varchar end as providerid, case when s_suppkey % 3 = 0 then s_name else 'M' end as provider_sex,
    case when s_suppkey % 5 = 0 then 'x' || s_suppkey else s_suppkey::varchar end as provider_npi from supplier"""


@case("sink_rejects", f"""with offered as ({_OFFERED}), named as (select coalesce(providerid, '~') as row_key, * from offered)
    select row_key, 'providerid' as column_name, 'required' as reason, null as raw_value from named where providerid is null
    union all select row_key, 'provider_sex', 'width', provider_sex from named where length(provider_sex) > 2
    union all select row_key, 'provider_npi', 'type', provider_npi from named where try_cast(provider_npi as decimal(20, 0)) is null
    union all select providerid, 'accepted', provider_sex, provider_npi from offered
        where providerid is not null and length(provider_sex) <= 2 and try_cast(provider_npi as decimal(20, 0)) is not null""")
def _rejects(s: Study) -> DataFrame:
    """What an insert refuses, value by value with its reason, and the rows it takes."""
    key = F.col("s_suppkey")
    offered = s["supplier"].select(
        F.when(key % 7 != 0, fn.text_id("s_suppkey")).alias("providerid"), F.when(key % 3 == 0, F.col("s_name")).otherwise("M").alias("provider_sex"),
        F.when(key % 5 == 0, fn.text_id("s_suppkey", "x")).otherwise(fn.text_id("s_suppkey")).alias("provider_npi"))
    taken, refused = insert_sorted(offered, "provider", s.site)
    return refused.unionByName(taken.select(F.col("providerid").alias("row_key"), F.lit("accepted").alias("column_name"), F.col("provider_sex").alias("reason"),
                                            F.col("provider_npi").cast("string").alias("raw_value")))


@case("sink_append_two", "select " + blank("provider", providerid="s_suppkey", provider_sex="'M'") + " from supplier union all select "
      + blank("provider", providerid="'c' || c_custkey", provider_sex="'F'") + " from customer")
def _append(s: Study) -> DataFrame:
    both = union_all(
        s["supplier"].select(fn.text_id("s_suppkey").alias("providerid"), F.lit("M").alias("provider_sex")),
        s["customer"].select(fn.text_id("c_custkey", "c").alias("providerid"), F.lit("F").alias("provider_sex")))
    return s["supplier"].sparkSession.read.parquet(write_table(both, folder(s, "out"), "provider", s.site)).select(
        *TABLES["provider"].columns, "site")


STAGES = ["visit_occurrence", "measurement", "observation"]
COUNTS = " union all ".join(f"select '{t}' as stage, count(*) as row_count from {t}" for t in STAGES)


@case("row_metrics", COUNTS)
def _metrics(s: Study) -> DataFrame:
    """Rows of every stage, counted while the visits of all stages are gathered and written."""
    audit = StageAudit()
    visits = [audit.watch(s[t].select("visit_occurrence_id"), t) for t in STAGES]
    staged(union_all(*visits).distinct(), "visits_of_stages")
    return audit.frame(s.value_map.sparkSession)


case("run_log", f"""select timestamp '2024-06-01 00:00:00' as datetime, 'load ' || stage || ': ' || row_count || ' rows' as operation, 'target' as model,
    '6.1.0' as model_version, null::varchar as dms_version, '0.6.1' as dmsa_version from ({COUNTS})""")(
    lambda s: run_log(stage_counts({t: s[t] for t in STAGES}), datetime(2024, 6, 1), "target", "6.1.0", dmsa_version="0.6.1"))

case("schema_registry", "select " + blank("trial", participantid="c_custkey", patid="c_custkey", trialid="'T' || c_nationkey") + " from customer")(
    lambda s: conform(s["customer"].select(fn.text_id("c_custkey").alias("participantid"), fn.text_id("c_custkey").alias("patid"),
                                           fn.text_id("c_nationkey", "T").alias("trialid")), "trial", s.site))
case("schema_alter", "select s_suppkey::varchar as providerid, cast(s_suppkey * 1000000000 as double) as provider_npi from supplier")(
    lambda s: conform(s["supplier"].select(fn.text_id("s_suppkey").alias("providerid"), (F.col("s_suppkey") * 1000000000).alias("provider_npi")),
                      "provider", s.site).select("providerid", "provider_npi"))
case("add_site_col", f"select c_custkey::varchar as patid, '{SITE}' as site from customer")(
    lambda s: conform(s["customer"].select(fn.text_id("c_custkey").alias("patid")), "demographic", s.site).select("patid", "site"))


@case("seed_if_empty", """select 'filled' as state, s_suppkey as id, s_name as name from supplier union all
    select 'seeded', c_custkey, 'default' from customer where not exists (select 1 from supplier where s_acctbal < -1000000000)""")
def _seed(s: Study) -> DataFrame:
    rows = s["supplier"].select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    none = s["supplier"].where("s_acctbal < -1000000000").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    default = s["customer"].select(F.col("c_custkey").alias("id"), F.lit("default").alias("name"))
    return seed_if_empty(rows, default).withColumn("state", F.lit("filled")).unionByName(
        seed_if_empty(none, default).withColumn("state", F.lit("seeded")))


@case("pipe_harvest", "select " + blank("harvest", **{**_HARVEST, "networkid": "'N' || s_suppkey", "network_name": "s_name"}) + " from supplier")
def _harvest(s: Study) -> DataFrame:
    """Harvest rows of many networks, refreshed by the map of this site."""
    named = {"networkid": fn.text_id("s_suppkey", "N"), "network_name": F.col("s_name")}
    existing = conform(s["supplier"].select(*[c.alias(k) for k, c in {**administration.seed_columns(NAMES), **named}.items()]),
                       "harvest", s.site)
    return administration.harvest(s, NAMES, existing)
