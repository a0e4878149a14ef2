"""Vital signs: vertical measurements to wide rows, blood-pressure pairs, tobacco answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hhmm, row_key, since, text_id, to_inches, to_pounds
from ..operators.lookup import VALUE, lookup
from ..operators.membership import keep_persons, keep_visits
from ..operators.sizing import join_spread
from ..rules import visits as R
from ..sources.model import conform
from ..sources.stage import staged
from ..sources.study import Study


def vital_kind(concept: Column) -> Column:
    return (F.when(concept == R.HEIGHT, "ht").when(concept == R.WEIGHT, "wt").when(concept == R.BODY_MASS, "bmi")
            .when(concept.isin(R.SYSTOLIC), "sys").when(concept.isin(R.DIASTOLIC), "dia").otherwise("other"))


def pair_link(left: DataFrame, links: DataFrame, right: DataFrame, left_id: str, right_id: str,
              domain: int | None = None, how: str = "left") -> DataFrame:
    """Resolve left facts to right facts through the fact-to-fact link table."""
    if domain is not None:
        links = links.where((F.col("domain_concept_id_1") == domain) & (F.col("domain_concept_id_2") == domain))
    edges = links.select(F.col("fact_id_1").alias("_f1"), F.col("fact_id_2").alias("_f2"))
    # most left facts may have no link at all
    return join_spread(left.join(edges, F.col(left_id) == F.col("_f1"), how), right, F.col("_f2"), right_id, how).drop("_f1", "_f2")


AT = ["visit_occurrence_id", "measurement_datetime"]
SINGLE = ["ht", "wt", "bmi"]


def pressures(signs: DataFrame, links: DataFrame) -> DataFrame:
    """Systolic readings with the diastolic ones they are linked to, per visit and time."""
    systolic = signs.where(F.col("kind") == "sys").select(
        *AT, F.col("value_as_number").alias("sys"), F.col("measurement_concept_id").alias("sys_concept"),
        F.col("measurement_source_value").alias("sys_raw"), "measurement_id")
    diastolic = signs.where(F.col("kind") == "dia").select(
        F.col("visit_occurrence_id").alias("_dv"), F.col("value_as_number").alias("dia"),
        F.col("measurement_source_value").alias("dia_raw"), F.col("measurement_id").alias("_dia_id"))
    pairs = pair_link(systolic, links, diastolic, "measurement_id", "_dia_id", R.MEASUREMENT_DOMAIN)
    # a linked diastolic reading of another visit does not count
    same = F.col("_dv") == F.col("visit_occurrence_id")
    return pairs.select(*AT, "sys", "sys_concept", "sys_raw", F.when(same, F.col("dia")).alias("dia"),
                        F.when(same, F.col("dia_raw")).alias("dia_raw"))


def widen(signs: DataFrame, links: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Vertical signs to one row per visit and time, keeping every combination of values.

    ``signs`` holds person, visit, date, time, kind, value, concept, raw text and id. One aggregation by
    (visit, time) gathers the different values of every kind, so copies of a reading never multiply; the combinations
    are the sets exploded one after the other. ``extra`` (visit, time and more columns) is one more such set.
    Signs without a visit or time stand alone, without values.
    """
    lone = F.col(AT[0]).isNull() | F.col(AT[1]).isNull()
    who = ["person_id", "measurement_date"]
    sets = {"_who": who, **{kind: [kind] for kind in SINGLE}, "_bp": ["sys", "sys_concept", "sys_raw", "dia", "dia_raw"]}
    # a struct is not NULL, so that a missing value is one of the values
    parts = signs.where(~lone).select(*AT, F.struct(*who).alias("_who"), *[
        F.when(F.col("kind") == kind, F.struct(F.col("value_as_number").alias(kind))).alias(kind) for kind in SINGLE])
    others = {"_bp": pressures(signs, links)} | ({} if extra is None else {"_extra": extra})
    for name, frame in others.items():
        sets[name] = [c for c in frame.columns if c not in AT]
        parts = parts.unionByName(frame.where(~lone).select(*AT, F.struct(*sets[name]).alias(name)), allowMissingColumns=True)
    df = parts.groupBy(*AT).agg(*[F.collect_set(name).alias(name) for name in sets])
    for name in sets:
        df = df.withColumn(name, F.explode(name) if name == "_who" else F.explode_outer(name))
    wide = df.select(*AT, *[F.col(f"{name}.{c}").alias(c) for name, cols in sets.items() for c in cols])
    return wide.unionByName(signs.where(lone).select(*who, *AT).distinct(), allowMissingColumns=True)


#: Per tobacco question: its class in the map and its output.
QUESTIONS = {R.TOBACCO: ("tobacco", "tobacco"), R.TOBACCO_TYPE: ("tobacco type", "tobacco_type"), R.SMOKING: ("smoking", "smoking")}


def tobacco_answers(study: Study) -> DataFrame:
    """Tobacco answer with the linked tobacco type and smoking answers, per visit and time.

    Type and smoking share a scan, the cohort tests and one join with the map, each question naming its class.
    """
    question = F.col("observation_concept_id")

    def asked(questions: list[int], test: Column | None = None) -> DataFrame:
        rows = study["observation"].where(question.isin(questions))
        if test is not None:
            rows = keep_visits(keep_persons(rows.where(test), study.cohort), study.cohort)
        cls = F.coalesce(*[F.when(question == q, F.lit(QUESTIONS[q][0])) for q in questions])
        # the map decides membership, as an inner join would
        return lookup(rows, study.value_map, cls, "value_as_concept_id", "_answer", by=VALUE, default="OT", how="inner")

    tobacco = asked([R.TOBACCO]).select(F.col("visit_occurrence_id").alias("_ov"), F.col("observation_datetime").alias("_ot"), "observation_id", F.col("_answer").alias("tobacco"))
    linked = asked([R.TOBACCO_TYPE, R.SMOKING], since("observation_date", study.floor))
    # type and smoking answers are different observations: one relation serves both, and one join of the links
    answers = linked.select(F.col("observation_id").alias("_answer_id"), *[F.when(question == q, F.col("_answer")).alias(out) for q, (_, out) in QUESTIONS.items() if q != R.TOBACCO])
    edges = study["fact_relationship"].select(F.col("fact_id_1").alias("_f1"), F.col("fact_id_2").alias("_f2"))
    df = tobacco.join(edges, F.col("observation_id") == F.col("_f1"), "left")
    df = join_spread(df, answers, F.col("_f2"), "_answer_id", "left")
    return df.select("_ov", "_ot", "tobacco", "tobacco_type", "smoking").distinct()


def cohort_signs(study: Study) -> DataFrame:
    """Vital measurements of the cohort, in one pass over the measurements."""
    rows = study["measurement"].where(
        F.col("measurement_concept_id").isin(R.VITAL_CONCEPTS) & since("measurement_date", study.floor))
    kept = keep_persons(keep_visits(rows, study.cohort), study.cohort)
    return kept.select("person_id", "visit_occurrence_id", "measurement_date", "measurement_datetime",
                       "measurement_id", "measurement_concept_id", "measurement_source_value", "value_as_number",
                       vital_kind(F.col("measurement_concept_id")).alias("kind"))


def vital(study: Study) -> DataFrame:
    # six branches read the signs, each one kind: they are written once, one folder per kind
    signs = staged(study.watch(cohort_signs(study), "vital: signs of the cohort"), "signs", by="kind")
    answers = study.watch(tobacco_answers(study), "vital: tobacco answers").withColumnsRenamed({"_ov": AT[0], "_ot": AT[1]})
    wide = study.watch(widen(signs, study["fact_relationship"], answers), "vital: combinations")
    df = wide.where(F.coalesce("ht", "wt", "dia", "sys", "bmi").isNotNull())
    df = lookup(df, study.value_map, "BP Position", "sys_concept", "bp_position", default="OT")
    done = df.select(
        F.left("bp_position", F.lit(2)).alias("bp_position"), F.col("dia").alias("diastolic"),
        text_id("visit_occurrence_id").alias("encounterid"), to_inches("ht").alias("ht"),
        F.to_date("measurement_date").alias("measure_date"), hhmm("measurement_datetime").alias("measure_time"),
        F.col("bmi").alias("original_bmi"), text_id("person_id").alias("patid"),
        F.col("dia_raw").alias("raw_diastolic"), F.col("smoking").alias("raw_smoking"),
        F.col("sys_raw").alias("raw_systolic"), F.col("tobacco").alias("raw_tobacco"),
        F.col("tobacco_type").alias("raw_tobacco_type"), F.left("smoking", F.lit(2)).alias("smoking"),
        F.col("sys").alias("systolic"), F.left("tobacco", F.lit(2)).alias("tobacco"),
        F.left("tobacco_type", F.lit(2)).alias("tobacco_type"), F.lit("HC").alias("vital_source"),
        to_pounds("wt").alias("wt")).distinct()
    # numbers enter the digest with six decimals, so that the key does not hang on an engine's notation
    parts = [F.when(F.col(c).isNotNull(), F.format_string("%.6f", F.col(c))) if kind == "double" else F.col(c) for c, kind in done.dtypes]
    return conform(done.withColumn("vitalid", row_key(*parts)), "vital", study.site)
