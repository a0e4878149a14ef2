"""Steps that are written between joins: no shuffle files stay, few rows move."""

import time

import pytest

from cliniform.operators import lookup as lk
from cliniform.operators import sizing
from cliniform.plans.drugs import flag_linked
from cliniform.sources import stage


def shuffle_files(spark):
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_a_staged_node_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = spark.range(1000).selectExpr("id % 7 as k", "id").repartition(3, "k").groupBy("k").count()
    named = spark.conf.get(stage.CLEANUP, None)
    back = stage.staged(rows, "counted")
    assert spark.conf.get(stage.CLEANUP, None) == named
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert back.count() == 7 and rows.count() == 7  # the frame itself can still be run


def test_rows_without_a_procedure_do_not_move(spark, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    sizing._sizes.clear()
    # the link may name a procedure that stands twice, one that is missing, or none
    facts = spark.createDataFrame([(1, 10), (2, 11), (3, None), (3, None), (4, -1)], "fact_id int, procedure_occurrence_id int")
    done = spark.createDataFrame([(10, "a"), (11, "b"), (11, "c"), (None, "d")], "procedure_occurrence_id int, code string")
    flagged = flag_linked(facts, done)
    got = sorted((r["fact_id"], r["procedure_occurrence_id"], r["_linked"]) for r in flagged.select("fact_id", "procedure_occurrence_id", "_linked").collect())
    assert [g for g in got if g[1] is None] == [(3, None, False)] * 2
    assert [g for g in got if g[1] is not None] == [(1, 10, True), (2, 11, True), (2, 11, True), (4, -1, False)]
    union = flagged._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert sum("Join" in line for line in union) == 1 and "isnotnull(procedure_occurrence_id" in "".join(union)


@pytest.mark.parametrize("bound", [10_000, 0])
def test_a_large_dictionary_is_cut_to_the_concepts_that_facts_name(spark, tmp_path, monkeypatch, bound):
    spark.range(5000).selectExpr("id as concept_id", "cast(id as string) as concept_code", "'V' || id % 3 as vocabulary_id").write.parquet(str(tmp_path / "d"))
    dictionary = spark.read.parquet(str(tmp_path / "d"))
    facts = spark.createDataFrame([(1, 7), (2, 7), (3, None), (4, 9999), (5, 4001)], "fact_id int, concept int")
    assert lk.named_concepts(dictionary, facts, "concept") is dictionary  # a small one stays
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", bound)
    named = lk.named_concepts(dictionary, facts, "concept")
    assert sorted(r["concept_id"] for r in named.collect()) == [7, 4001]
    joined = lk.concept_lookup(facts, named, "concept", {"code": "concept_code"})
    assert ("BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()) or not bound
    assert sorted((r["fact_id"], r["code"]) for r in joined.collect()) == [(1, "7"), (2, "7"), (3, None), (4, None), (5, "4001")]
