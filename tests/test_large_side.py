"""The plans with every broadcast ruled out: dimensions salted, joins shuffled."""

import pytest
from compare import connect, difference

from cliniform.checks import queries, sql_twins
from cliniform.operators import sizing

FOLDER = "/root/testdata/sf0.001"
NAMES = ["pipe_demographic", "pipe_encounter", "pipe_diagnosis", "pipe_condition", "pipe_procedures", "pipe_death_cause", "pipe_address",
         "pipe_lab", "pipe_obs_gen", "pipe_prescribing", "pipe_dispensing", "pipe_immunization", "flt_null_or_member", "modifier_repair"]


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = spark.conf.get(keys[0])
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    spark.conf.set(keys[0], before)
    spark.conf.unset(keys[1])


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_without_broadcast(spark, no_broadcast, name):
    df = queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "CartesianProduct" not in plan
    assert difference(df, connect(FOLDER), sql_twins()[name]) is None
