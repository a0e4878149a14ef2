"""A study: source tables, maps and parameters of one site."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .audit import StageAudit


@dataclass(frozen=True)
class Study:
    """Everything a target table is built from.

    ``tables`` gives source tables, ``value_map`` and ``complaint_map`` by name. ``built`` may hold
    target tables already written; plans that need one use it, and otherwise derive it. With an ``audit`` plans count the
    rows of their stages while they run.
    """

    tables: Mapping[str, DataFrame]
    site: str
    floor: date = date(2001, 1, 1)
    today: date | None = None
    classifier_mode: str = "fixed"
    local_vocabulary: str | None = None
    built: Mapping[str, DataFrame] = field(default_factory=dict)
    audit: StageAudit | None = None

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    @property
    def value_map(self) -> DataFrame:
        return self.tables["value_map"]

    @property
    def concept(self) -> DataFrame:
        return self.tables["concept"]

    @property
    def today_column(self):
        return F.current_date() if self.today is None else F.lit(self.today)

    @cached_property
    def cohort(self) -> DataFrame:
        return self.target("cohort", _cohort)

    def target(self, name: str, build: Callable[[Study], DataFrame]) -> DataFrame:
        return self.built[name] if name in self.built else build(self)

    def watch(self, df: DataFrame, stage: str) -> DataFrame:
        return df if self.audit is None else self.audit.watch(df, stage)

    def with_built(self, **frames: DataFrame) -> Study:
        return replace(self, built={**self.built, **frames})


def _cohort(study: Study) -> DataFrame:
    from ..plans.people import cohort
    return cohort(study)
