"""One row per key, and set unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """The first row of each key in a total order.

    Written as the minimum of a struct, not as a window: the partial aggregate runs before
    the shuffle, so one key with very many rows sends one row per task. ``order`` holds
    expressions whose ascending order (NULL first) decides; all columns break ties.
    """
    lead = [c.alias(f"_o{i}") for i, c in enumerate(order or [])]
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*lead, *[F.col(c) for c in rest])).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def nulls_last(c: str | Column) -> list[Column]:
    """Sort terms that put NULL behind every value."""
    col = F.col(c) if isinstance(c, str) else c
    return [col.isNull(), col]


def latest_per_key(df: DataFrame, keys: list[str], when: str, tie: str) -> DataFrame:
    """The row with the greatest date of each key; the greater ``tie`` wins among equals."""
    rest = [c for c in df.columns if c not in {*keys, when, tie}]
    picked = df.groupBy(*keys).agg(F.max(F.struct(when, tie, *rest)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def smallest_per_key(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(value).alias(value))


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()
