"""UPDATE and DELETE as pure transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizing import attach


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Rows for which the test is not true (so NULL keeps the row)."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def set_where(df: DataFrame, cond: Column, **values: Column | str | None) -> DataFrame:
    """Set columns where the test is true; all right-hand sides see the old row."""
    cond = F.coalesce(cond, F.lit(False))
    return df.withColumns({
        name: F.when(cond, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(name))
        for name, v in values.items()
    })


def update_from(df: DataFrame, matches: DataFrame, on: list[tuple[Column, str]], guard: Column,
                sets: dict[str, str]) -> DataFrame:
    """Overwrite columns from a match set (one row per key) where ``guard`` holds and a match exists.

    ``sets`` maps a column of ``df`` to a column of ``matches``.
    """
    hit = matches.withColumn("_hit", F.lit(True))
    joined = attach(df, hit, on)
    test = guard & F.coalesce(F.col("_hit"), F.lit(False))
    joined = set_where(joined, test, **{c: F.col(s) for c, s in sets.items()})
    return joined.select(*df.columns)


def update_by_raw(df: DataFrame, rules: DataFrame, raw: Column, guard: Column, target: str) -> DataFrame:
    """Set ``target`` from a two-column rule table (raw text, new value) where ``guard`` holds."""
    named = rules.toDF("_raw", "_new")
    return update_from(df, named, [(raw, "_raw")], guard, {target: "_new"})


def flag_ids(df: DataFrame, ids: DataFrame, key: str, out: str) -> DataFrame:
    """Mark rows whose key is in a one-column id set."""
    marks = ids.select(F.col(ids.columns[0]).alias("_f"), F.lit(True).alias(out)).distinct()
    return attach(df, marks, [(F.col(key), "_f")]).withColumn(out, F.coalesce(F.col(out), F.lit(False)))
