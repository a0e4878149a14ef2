"""Row counts of a plan's stages, taken by the plan's own action."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import fixed_rows


class StageAudit:
    """Counts the rows of every watched stage while a later action runs over it; no stage is read twice.

    A stage belongs to one place of a plan and is counted by the first action over it. A stage that turns out to be
    empty at run time, so that the engine leaves it out, counts 0. Tasks repeated after a loss may count too many,
    never too few.
    """

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, stage: str) -> DataFrame:
        if stage in self._seen:
            raise ValueError(f"stage {stage} is watched twice")
        self._seen[stage] = Observation(stage)
        return df.observe(self._seen[stage], F.count(F.lit(1)).alias("rows"))

    def counts(self) -> dict[str, int]:
        """Rows by stage, in the order of watching; to be asked for after the actions."""
        return {stage: int(seen.get.get("rows", 0)) for stage, seen in self._seen.items()}

    def frame(self, spark: SparkSession) -> DataFrame:
        """Audit frame: one row per stage."""
        return fixed_rows(spark, "stage string,row_count bigint", list(self.counts().items()))
