"""Sinks: CSV and Parquet tables, appends, stage counts, run log, seed rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .model import TABLES, conform, misfits
from .stage import staged


def write_csv(df: DataFrame, path: str, partitions: int | None = None) -> str:
    """CSV directory with header lines; ``partitions`` sets the number of files by a shuffle, so that the
    work before it keeps its own width."""
    out = df.repartition(partitions) if partitions else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_table(df: DataFrame, root: str, table: str, site: str, names: dict[str, str] | None = None) -> str:
    """One target table as Parquet under ``root/table``; ``names`` may rename table or columns."""
    return write_audited(df, root, table, site, names)[0]


def write_audited(df: DataFrame, root: str, table: str, site: str, names: dict[str, str] | None = None,
                  strict: bool = False) -> tuple[str, dict[str, int]]:
    """Write a target table and count, in the same pass, its rows (``rows``) and the values per column
    that do not fit their declared type; ``strict`` raises if there are any.

    ``df`` holds the values before the cast (a plan built :func:`~.model.unconformed`). After a repeated
    task a count may be too high, never too low.
    """
    names = names or {}
    path = f"{root}/site={site}/{names.get(table, table)}"
    seen = Observation(f"{table}")
    lost = {f"lost_{c}": F.count_if(test).alias(f"lost_{c}") for c, test in misfits(df, table).items()}
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *lost.values())
    shaped = conform(watched, table, site).withColumnsRenamed({k: v for k, v in names.items() if k in TABLES[table].columns})
    shaped.write.mode("overwrite").parquet(path)
    counts = {k.removeprefix("lost_"): int(v) for k, v in seen.get.items()}
    bad = {k: v for k, v in counts.items() if k != "rows" and v}
    if strict and bad:
        raise ValueError(f"{table}: values do not fit their columns: {bad}")
    return path, counts


def insert(df: DataFrame, table: str, site: str, columns: list[str]) -> DataFrame:
    """``insert into table(columns) select …``: unnamed target columns become NULL."""
    return conform(df.select(*columns), table, site)


def rejections(df: DataFrame, table: str) -> Column:
    """Values of a row that a database would refuse to insert: an array of (column, reason, raw value).

    The reasons are ``required`` (NULL where a value must be), ``type`` (no value of the declared type) and ``width``
    (a text longer than declared).
    """
    lost = misfits(df, table)
    tests = []
    for f in TABLES[table].fields:
        value = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.required:
            tests.append((value.isNull(), f.name, "required", value))
        if f.name in lost:
            tests.append((lost[f.name], f.name, "type", value))
        if f.width and f.name in df.columns:
            tests.append((F.length(value.cast("string")) > f.width, f.name, "width", value))
    found = [F.when(test, F.struct(F.lit(name).alias("column_name"), F.lit(reason).alias("reason"), value.cast("string").alias("raw_value"))) for test, name, reason, value in tests]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def insert_sorted(df: DataFrame, table: str, site: str) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, shaped for the table, and the refused values of all others, with the row's key as text.

    A database stops at the first such value. Here one pass over ``df`` sorts its rows and writes them once; both
    results are read from there, so that they always add up.
    """
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) if c in df.columns else F.lit("~") for c in TABLES[table].key])
    sorted_ = staged(df.withColumns({"_row_key": key, "_refused": rejections(df, table)}), f"{table}_offered")
    taken = conform(sorted_.where(F.size("_refused") == 0), table, site)
    refused = sorted_.where(F.size("_refused") > 0).select(F.col("_row_key").alias("row_key"), F.explode("_refused").alias("_r")).select("row_key", "_r.*")
    return taken, refused


def write_ranged(df: DataFrame, path: str, key: str, ranges: int) -> DataFrame:
    """Write rows as Parquet files of ascending key ranges, each sorted by key, and read them back.

    The ranges are quantiles of the key, so that gaps do not make them uneven; rows of one very frequent key are
    spread over several files by their hash, rows without a key come first. A later read between two keys
    (:func:`~.readers.read_between`) opens only the row groups that hold them.
    """
    shape = df.schema
    (df.repartitionByRange(ranges, F.col(key), F.xxhash64(*[F.col(c) for c in df.columns]))
     .sortWithinPartitions(key).write.mode("overwrite").parquet(path))
    return df.sparkSession.read.schema(shape).parquet(path)


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Audit frame of finished tables: one row per name with its row count. A running plan is counted without a scan by
    :class:`~.audit.StageAudit`.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("stage"), "row_count")
             for name, df in stages.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_log(stages: DataFrame, at: datetime, model: str, model_version: str, **versions: str) -> DataFrame:
    """Version-history rows of a run: one per audited stage (see :func:`stage_counts`)."""
    operation = F.concat(F.lit("load "), F.col("stage"), F.lit(": "), F.col("row_count").cast("string"), F.lit(" rows"))
    return conform(stages.select(
        F.lit(at).cast("timestamp_ntz").alias("datetime"), operation.alias("operation"), F.lit(model).alias("model"),
        F.lit(model_version).alias("model_version"), *[F.lit(v).alias(k) for k, v in versions.items()]),
        "version_history", "")


def seed_if_empty(df: DataFrame, default: DataFrame) -> DataFrame:
    """The table itself, or the default rows when it has none."""
    some = df.limit(1).select(F.lit(True).alias("_some"))
    return df.unionByName(default.join(some, F.col("_some"), "left_anti"))
