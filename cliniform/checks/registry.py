"""Registry of queries and their SQL twins."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..demo import adapter
from ..sources.study import Study


@dataclass(frozen=True)
class Case:
    build: Callable[[Study], DataFrame]
    sql: str | None


CASES: dict[str, Case] = {}

# Views the SQL twins may use beside the source tables.
VIEWS: dict[str, str] = {
    "cohort": f"""select person_id, visit_occurrence_id as visit_id from visit_occurrence
        where visit_start_date >= date '{adapter.FLOOR}'""",
    "cohort_person": "select distinct person_id from cohort",
}


def case(name: str, sql: str | None = None) -> Callable[[Callable[[Study], DataFrame]], Callable[[Study], DataFrame]]:
    def register(build: Callable[[Study], DataFrame]) -> Callable[[Study], DataFrame]:
        assert name not in CASES, name
        CASES[name] = Case(build, sql)
        return build
    return register


def quoted(values: list) -> str:
    """SQL list of literals."""
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in values) + ")"


def mapped(cls: str, key: str, take: str = "target_code", by: str = "source_code") -> str:
    """Scalar subquery: least value of one map class for a key."""
    return (f"(select min(m.{take}) from value_map m where m.source_class = '{cls}' "
            f"and m.{by} = cast({key} as varchar))")


def with_tables(sql: str) -> str:
    """Put a WITH clause in front that defines every source table and view the text names."""
    texts = {**adapter.sources(False), **VIEWS}
    order: list[str] = []

    def need(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_]+", text)):
            if word in texts and word not in order and word not in adapter.RAW_TABLES:
                if texts[word] is not text:
                    need(texts[word])
                if word not in order:
                    order.append(word)

    need(sql)
    if not order:
        return sql
    body = sql.lstrip()
    heads = ",\n".join(f"{n} as ({texts[n]})" for n in order)
    return f"with {heads}\n, {body[5:]}" if body.lower().startswith("with ") else f"with {heads}\n{body}"


def plain(df: DataFrame) -> DataFrame:
    """Numbers as doubles and bigints, so that engines with other number types compare equal."""
    def out(f: T.StructField):
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return F.col(f.name).cast("bigint").alias(f.name)
        return F.col(f.name)
    return df.select(*[out(f) for f in df.schema])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Study], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: plain(build(adapter.study(spark, folder)))
    return {name: bind(c.build) for name, c in CASES.items()}


def sql_twins() -> dict[str, str]:
    return {name: with_tables(c.sql) for name, c in CASES.items() if c.sql}
