"""Sources: files, ranged and plain JDBC scans, mapping files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Read partitions of ranged scans: fact tables and dimension tables
FACT_RANGES, DIMENSION_RANGES = 2000, 200

VALUE_MAP = T.StructType([T.StructField(c, T.StringType()) for c in (
    "source_class", "target_code", "target_label", "source_code", "description", "value_code")])

COMPLAINT_MAP = T.StructType([
    T.StructField("complaint_text", T.StringType()),
    T.StructField("row_count", T.IntegerType()),
    T.StructField("concept_id", T.LongType()),
    T.StructField("concept_name", T.StringType()),
    T.StructField("concept_code", T.StringType()),
    T.StructField("vocabulary_id", T.StringType()),
    T.StructField("code_type", T.StringType()),
])


def read_map(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Mapping CSV with a header line and quoted commas, typed by position.

    The header's own names do not matter; a line that does not fit the schema fails the read.
    """
    return (spark.read.option("header", True).option("enforceSchema", True).option("mode", "FAILFAST")
            .option("quote", '"').option("escape", '"').option("multiLine", True)
            .schema(schema).csv(path))


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def key_bounds(df: DataFrame, key: str) -> DataFrame:
    """One row: smallest and greatest key (both NULL for an empty table)."""
    return df.agg(F.min(key).alias("low"), F.max(key).alias("high"))


def read_range(spark: SparkSession, url: str, table: str, key: str, partitions: int = DIMENSION_RANGES,
               properties: dict[str, str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """JDBC scan split into key ranges. The bounds come from one MIN/MAX row; an empty table
    gives an empty frame of the table's (or the given) schema."""
    props = dict(properties or {})
    bounds = spark.read.jdbc(url, f"(select min({key}) as low, max({key}) as high from {table}) b", properties=props)
    low, high = bounds.first()
    if low is None:
        shape = schema or spark.read.jdbc(url, table, properties=props).schema
        return spark.createDataFrame([], shape)
    return spark.read.jdbc(url, table, column=key, lowerBound=low, upperBound=high,
                           numPartitions=partitions, properties=props)


def read_plain(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None) -> DataFrame:
    """JDBC scan of a small table in one partition."""
    return spark.read.jdbc(url, table, properties=dict(properties or {}))


def read_between(df: DataFrame, key: str, low: object = None, high: object = None) -> DataFrame:
    """Rows with ``low <= key < high``; an open end is ``None``, and without a lower end rows without a key belong to it.

    Over files sorted by the key (:func:`~.writers.write_ranged`) the comparison reaches the scan, which skips all row
    groups outside the range by their own statistics.
    """
    k = F.col(key)
    if low is not None:
        df = df.where(k >= F.lit(low))
    if high is not None:
        df = df.where((k < F.lit(high)) if low is not None else (k.isNull() | (k < F.lit(high))))
    return df


def or_empty(df: DataFrame | None, spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An absent source as an empty frame, so that unions and joins over it still work."""
    return df if df is not None else spark.createDataFrame([], schema)
