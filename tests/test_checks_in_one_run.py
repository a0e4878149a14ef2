"""Checks of all tables in one run: what is let go of, what is read once, what is broadcast."""

from datetime import date

from pyspark.sql import functions as F

from cliniform.checks import quality
from cliniform.demo import adapter
from cliniform.operators import membership as mb
from cliniform.operators import sizing
from cliniform.plans import administration
from cliniform.sources.model import TABLES, conform, empty
from cliniform.sources.study import Study


def lines(df):
    return sorted(tuple(r) for r in df.collect())


def study_of(spark, monkeypatch, rows):
    def plan(name):
        return lambda study: conform(spark.createDataFrame(*rows[name]), name, study.site) if name in rows else empty(spark, name)

    monkeypatch.setattr(administration, "BUILD_ORDER", {n: plan(n) for n in administration.BUILD_ORDER})
    monkeypatch.setattr(administration, "harvest", lambda study, names: empty(spark, "harvest"))
    visits = spark.createDataFrame([(1, 10, date(2020, 1, 1)), (1, 11, date(2020, 1, 1)), (2, 20, date(1990, 1, 1))], "person_id int, visit_occurrence_id int, visit_start_date date")
    return Study(tables={"value_map": spark.createDataFrame([("a",)], "source_class string"), "visit_occurrence": visits}, site="north")


ROWS = {"death": ([("1", "L"), ("1", "LONG"), ("2", "LONG"), (None, None)], "patid string, death_source string"),
        "condition": ([("c1", "1", "10", "TOOLONG"), ("c1", "1", None, "x"), ("c2", "1", "20", "TOOLONG"), ("c3", "1", "11", None)],
                      "conditionid string, patid string, encounterid string, condition_status string")}


def test_the_driver_lets_go_of_every_table(spark, monkeypatch):
    study, seen = study_of(spark, monkeypatch, ROWS), []
    monkeypatch.setattr(quality, "release", lambda session: seen.append(session))
    quality.raw_finished(study, quality._CHECKED)
    assert len(seen) == len(administration.BUILD_ORDER)
    quality.width_report(study_of(spark, monkeypatch, ROWS))
    counted = {n for n in administration.BUILD_ORDER if (TABLES[n].widths or TABLES[n].numbers) and n not in quality._SHARED}
    assert len(seen) == len(administration.BUILD_ORDER) + len(quality._SHARED) + len(counted)


def test_a_shared_source_is_written_once_with_the_same_rows(spark):
    tables = adapter.SourceTables(spark, "/root/testdata/sf0.001")
    before = tables["condition_occurrence"]
    tables.settle("line_facts")
    after, facts = tables["condition_occurrence"], tables["line_facts"]
    assert "Join" in before._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in after._jdf.queryExecution().optimizedPlan().toString()
    assert before.exceptAll(after).count() == after.exceptAll(before).count() == 0 and after.schema.names == before.schema.names
    tables.settle("line_facts")
    assert tables["line_facts"] is facts


def test_keys_of_a_large_table_are_not_broadcast(spark, tmp_path, monkeypatch):
    spark.range(20_000).select(F.xxhash64("id").alias("visit_id"), F.xxhash64("id").alias("p")).write.parquet(str(tmp_path / "v"))
    keys = spark.read.parquet(str(tmp_path / "v"))
    facts = keys.limit(50).select(F.col("visit_id").alias("visit_occurrence_id"), F.col("p").alias("person_id")).unionByName(
        spark.createDataFrame([(1, 1), (None, 2)], "visit_occurrence_id long, person_id long"))
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 4 * sizing.planned_bytes(keys))
    for test in (lambda: mb.keep_absent_or_visits(facts, keys), lambda: mb.drop_members(facts, keys, ("visit_occurrence_id", "visit_id"), keep_null=True)):
        sizing._sizes.clear()
        shuffled = test()
        assert "strategy=broadcast" not in shuffled._jdf.queryExecution().optimizedPlan().toString()
        found = lines(shuffled.select(F.coalesce("person_id", F.lit(0))))
        with monkeypatch.context() as m:
            m.setattr(sizing, "KEY_ROOM", 1)
            copied = test()
            assert "strategy=broadcast" in copied._jdf.queryExecution().optimizedPlan().toString()
            assert lines(copied.select(F.coalesce("person_id", F.lit(0)))) == found
