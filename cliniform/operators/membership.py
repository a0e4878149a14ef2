"""Cohort tests: semi, anti and 'absent or member' joins."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizing import are_few, attach, is_small, join_spread


_persons: WeakKeyDictionary[DataFrame, DataFrame] = WeakKeyDictionary()


def keep_visits(df: DataFrame, cohort: DataFrame, visit: str = "visit_occurrence_id") -> DataFrame:
    """Facts of cohort visits. The visit is the key of the cohort, so both sides of the join are
    plain scans and the adaptive engine can split a visit with very many facts."""
    return df.join(cohort.select(F.col("visit_id").alias("_v")), F.col(visit) == F.col("_v"), "left_semi")


def keep_persons(df: DataFrame, cohort: DataFrame, person: str = "person_id") -> DataFrame:
    """Facts of cohort persons. A person has one cohort row per visit: these are reduced first,
    then broadcast if small, else salted against persons with very many facts."""
    if cohort not in _persons:
        _persons[cohort] = cohort.select(F.col("person_id").alias("_p")).distinct()
    return attach(df, _persons[cohort], [(F.col(person), "_p")], "left_semi")


def keep_person_visits(df: DataFrame, cohort: DataFrame, person: str = "person_id",
                       visit: str = "visit_occurrence_id") -> DataFrame:
    """Facts whose person and visit form a cohort row."""
    pairs = cohort.select(F.col("visit_id").alias("_v"), F.col("person_id").alias("_p"))
    return df.join(pairs, (F.col(visit) == F.col("_v")) & (F.col(person) == F.col("_p")), "left_semi")


def member_flag(df: DataFrame, keys: DataFrame, key: Column, out: str, scanned: bool = False) -> DataFrame:
    """Add a never-NULL flag telling whether ``key`` is in the one-column set ``keys``.

    A set of codes is broadcast or salted like any dimension. A ``scanned`` set is the key column of
    a large table: it is broadcast only where its keys are few, and not copied per salt, since the adaptive engine can split a hot key between two
    plain scans; only rows without a key are spread, by a salt the set never carries.
    """
    name = keys.columns[0]
    marked = keys.select(F.col(name).alias("_m"), F.lit(True).alias(out))
    if not scanned or are_few(keys):
        joined = attach(df, marked, [(key, "_m")], small=is_small(keys))
    else:
        joined = join_spread(df, marked, key, "_m", "left").drop("_m")
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def keep_absent_or_visits(df: DataFrame, cohort: DataFrame, visit: str = "visit_occurrence_id") -> DataFrame:
    """Facts without a visit, or with one in the cohort."""
    flagged = member_flag(df, cohort.select("visit_id"), F.col(visit), "_in", scanned=True)
    return flagged.where(F.col(visit).isNull() | F.col("_in")).drop("_in")


def keep_absent_or_same_visit(df: DataFrame, cohort: DataFrame, person: str = "person_id",
                              visit: str = "visit_occurrence_id") -> DataFrame:
    """Facts of a cohort person that have no visit, or one of that person's cohort visits."""
    loose = keep_persons(df.where(F.col(visit).isNull()), cohort, person)
    bound = keep_person_visits(df.where(F.col(visit).isNotNull()), cohort, person, visit)
    return loose.unionByName(bound)


def drop_members(df: DataFrame, keys: DataFrame, *pairs: tuple[str, str], keep_null: bool = False) -> DataFrame:
    """Null-aware NOT IN: a NULL probe is dropped, or kept with ``keep_null`` (delete semantics)."""
    probe, name = pairs[0]
    right = keys.select(*[F.col(k).alias(f"_x{i}") for i, (_, k) in enumerate(pairs)])
    if are_few(right):
        right = F.broadcast(right)
    elif keep_null and len(pairs) == 1:
        return join_spread(df, right, F.col(probe), "_x0", "left_anti")
    cond: Column | None = None
    for i, (p, _) in enumerate(pairs):
        test = F.col(p) == F.col(f"_x{i}")
        cond = test if cond is None else cond & test
    kept = df.join(right, cond, "left_anti")
    return kept if keep_null else kept.where(F.col(probe).isNotNull())
