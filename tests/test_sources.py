"""Model, readers, writers, and a whole build."""

from datetime import datetime
from decimal import Decimal
from unittest.mock import MagicMock

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cliniform.checks import quality
from cliniform.demo import adapter
from cliniform.plans.administration import BUILD_ORDER, NEVER_FILLED, build_all, orphan_report
from cliniform.plans.vitals import cohort_signs
from cliniform.sources.model import PERSON_CHECKED, REFERENCES, TABLES, VISIT_CHECKED, conform, empty
from cliniform.sources.audit import StageAudit
from cliniform.sources.readers import COMPLAINT_MAP, read_between, read_map, read_range
from cliniform.sources.stage import CHECKPOINT_DIR, stage_root, staged
from cliniform.sources.writers import write_audited, write_ranged


def test_model_counts():
    widths = {"version_history": 6, "condition": 14, "death": 5, "death_cause": 6, "demographic": 16, "diagnosis": 18, "dispensing": 15,
              "encounter": 31, "enrollment": 5, "harvest": 60, "hash_token": 34, "immunization": 29, "lab_history": 17, "lab_result_cm": 33,
              "lds_address_history": 12, "med_admin": 20, "obs_clin": 24, "obs_gen": 24, "trial": 8, "prescribing": 31,
              "private_address_geocode": 16, "private_address_history": 15, "private_demographic": 27, "pro_cm": 27, "procedures": 14,
              "provider": 6, "vital": 21}
    assert {t: len(v.fields) for t, v in TABLES.items()} == widths
    assert len(REFERENCES) == 43
    assert all(set(t.key) <= set(t.columns) for t in TABLES.values())
    assert set(BUILD_ORDER) | set(NEVER_FILLED) | {"harvest", "version_history"} == set(TABLES)


def test_conform_fills_and_orders(spark):
    df = spark.createDataFrame([("x", 12345678901.0)], "vitalid string, ht double")
    got = conform(df, "vital", "s")
    assert got.columns == [*TABLES["vital"].columns, "site"]
    assert got.first()["ht"] is None and got.first()["site"] == "s"
    assert empty(spark, "hash_token").count() == 0


def test_map_file_with_quoted_commas(spark, tmp_path):
    path = tmp_path / "map.csv"
    path.write_text('a,count,c,d,e,f,g\nwell child,3,1,"Fever, unspecified",R50.9,ICD10CM,10\n"cough, ""dry""",1,2,x,y,z,SM\n')
    got = [tuple(r) for r in read_map(spark, str(path), COMPLAINT_MAP).orderBy("concept_id").collect()]
    assert got == [("well child", 3, 1, "Fever, unspecified", "R50.9", "ICD10CM", "10"), ('cough, "dry"', 1, 2, "x", "y", "z", "SM")]
    path.write_text("a,count,c,d,e,f,g\nx,notanumber,1,d,e,f,g\n")
    with pytest.raises(Exception):
        read_map(spark, str(path), COMPLAINT_MAP).collect()


def test_ranged_scan_asks_for_bounds_first():
    fake = MagicMock()
    fake.read.jdbc.return_value.first.return_value = (5, 90)
    read_range(fake, "jdbc:x", "north.measurement", "measurement_id", 2000)
    assert fake.read.jdbc.call_args.kwargs == {"column": "measurement_id", "lowerBound": 5, "upperBound": 90, "numPartitions": 2000, "properties": {}}
    fake.read.jdbc.return_value.first.return_value = (None, None)
    read_range(fake, "jdbc:x", "north.measurement", "measurement_id")
    fake.createDataFrame.assert_called_once()


def test_stage_uses_the_named_folder(spark, tmp_path, monkeypatch):
    named = MagicMock()
    named.conf.get.return_value = "/shared/checkpoints"
    assert stage_root(named) == "/shared/checkpoints"
    named.conf.get.assert_called_with(CHECKPOINT_DIR, None)
    monkeypatch.setattr("cliniform.sources.stage.stage_root", lambda s: str(tmp_path))
    df = staged(spark.range(10).withColumn("kind", F.when(F.col("id") < 5, "a").otherwise("b")), "x", by="kind")
    assert df.where("kind = 'a'").count() == 5 and list(tmp_path.glob("cliniform/*/x/kind=a"))


def test_stage_folder_is_required_on_a_cluster():
    settings = {"spark.master": "spark://host:7077"}
    named = MagicMock()
    named.conf.get.side_effect = lambda key, default=None: settings.get(key, default)
    with pytest.raises(ValueError, match="checkpoint"):
        stage_root(named)


def test_whole_build(spark, tmp_path):
    study = adapter.study(spark, "/root/testdata/sf0.001")
    names = {"datamart_name": "x", "datamartid": "y", "network_name": "n", "networkid": "N"}
    renames = {"trial": {"trial": "study_trial", "trialid": "study_trial_id"}}
    done = build_all(study, str(tmp_path), names, renames, datetime(2024, 6, 1))
    assert set(done) == set(TABLES)
    filled = {t: df.count() for t, df in done.items()}
    assert all(filled[t] > 0 for t in BUILD_ORDER), filled
    assert done["harvest"].first()["datamartid"] == "N01"
    left = orphan_report({t: done[t] for t in ("obs_gen", "vital", "diagnosis")}, study)
    assert left.agg(F.sum("violations")).first()[0] == 0
    home = f"{tmp_path}/site={study.site}"
    assert "study_trial_id" in spark.read.parquet(f"{home}/study_trial").columns and "trialid" in done["trial"].columns
    lost = {(r.table_name, r.column_name): r.violations for r in spark.read.parquet(f"{home}/report_misfits").collect()}
    assert lost["lab_result_cm", "result_num"] > 0 and lost["vital", "systolic"] > 0
    removed = spark.read.parquet(f"{home}/report_orphans")
    assert removed.where("table_name = 'obs_gen'").agg(F.sum("violations")).first()[0] > 0
    assert {r.table_name for r in removed.select("table_name").distinct().collect()} == set(PERSON_CHECKED) - set(NEVER_FILLED)
    stages = {r.stage: r.row_count for r in spark.read.parquet(f"{home}/report_stages").collect()}
    assert stages["vital: signs of the cohort"] == cohort_signs(study).count() and stages["vital: combinations"] >= filled["vital"]
    assert sum(n for s, n in stages.items() if s.startswith("obs_clin")) >= filled["obs_clin"] and stages["obs_clin: measurements"] > 0
    checks = spark.read.parquet(f"{home}/report_integrity")
    assert checks.where("check_name = 'reference'").count() == len(REFERENCES) and checks.where("check_name = 'key'").count() == len(TABLES)
    log = done["version_history"].collect()
    assert len({r["datetime"] for r in log}) == len(log) == len(TABLES) - 1
    assert f"load demographic: {filled['demographic']} rows" in {r["operation"] for r in log}


def test_checks_share_one_build_and_one_test_of_the_cohort(spark):
    study = adapter.Study(adapter.SourceTables(spark, "/root/testdata/sf0.001"), adapter.SITE, adapter.FLOOR, adapter.TODAY, local_vocabulary="Local")
    light = quality.raw_finished(study, quality._CHECKED)
    assert set(light) == set(TABLES) and set(light["vital"].columns) < set(TABLES["vital"].columns)
    keys = quality.raw_finished(study, {"vital": ["vitalid"]})
    assert keys["vital"].inputFiles() == light["vital"].inputFiles() and set(keys) == {"vital"}
    report = orphan_report(quality.finished(study, quality._CHECKED), study)
    # every table is read once for both of its keys, and all keys meet the cohort in one join
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1
    counts = {(r.table_name, r.column_name): r.violations for r in report.collect()}
    assert set(counts) == {(t, "patid") for t in PERSON_CHECKED} | {(t, "encounterid") for t in VISIT_CHECKED}
    rows, visits = quality.finished(study)["obs_gen"], study.cohort.select(F.col("visit_id").cast("string").alias("k"))
    assert counts["obs_gen", "encounterid"] == rows.where("encounterid is not null").join(visits, F.col("encounterid") == F.col("k"), "left_anti").count() > 0
    per_key = quality._kept_per_key(study, ["obs_gen", "vital"], "encounterid").where("table_name = 'obs_gen'")
    assert per_key.agg(F.sum("n_rows")).first()[0] == rows.count() - counts["obs_gen", "encounterid"]


def test_misfits_are_counted_or_stop_the_run(spark, tmp_path):
    rows = spark.createDataFrame([("1", 25000000.0), ("2", 1.5), ("3", None)], "lab_result_cm_id string, result_num double")
    path, counts = write_audited(rows, str(tmp_path), "lab_result_cm", "x")
    assert counts["rows"] == 3 and counts["result_num"] == 1
    assert {r["result_num"] for r in spark.read.parquet(path).collect()} == {None, Decimal("1.50000000")}
    with pytest.raises(ValueError, match="result_num"):
        write_audited(rows, str(tmp_path), "lab_result_cm", "x", strict=True)
    empty_counts = write_audited(rows.limit(0), str(tmp_path), "lab_result_cm", "x")[1]
    assert empty_counts.get("result_num", 0) == 0


def test_ranges_cover_every_row_once(spark, tmp_path):
    for i, keys in enumerate(([], [None], [5], [1, 2, 3, 1, None, 100, -7], list(range(50)))):
        df = spark.createDataFrame([(k,) for k in keys], "k long")
        for n in (1, 3, 16):
            laid = write_ranged(df, str(tmp_path / f"{i}_{n}"), "k", n)
            assert sorted(str(r.k) for r in laid.collect()) == sorted(map(str, keys))
            cuts = [None, 0, 3, 40, None]
            parts = [r.k for low, high in zip(cuts, cuts[1:]) for r in read_between(laid, "k", low, high).collect()]
            assert sorted(map(str, parts)) == sorted(map(str, keys))


def test_ranges_read_their_own_row_groups_only(spark, tmp_path):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select("o_orderkey", "o_totalprice")
    laid = write_ranged(orders.repartition(8, "o_totalprice"), str(tmp_path / "ranged"), "o_orderkey", 16)
    groups = []
    for file in sorted((tmp_path / "ranged").glob("*.parquet")):
        meta = pq.ParquetFile(file).metadata
        groups += [(meta.row_group(g).column(0).statistics.min, meta.row_group(g).column(0).statistics.max) for g in range(meta.num_row_groups)]
    groups.sort()
    assert len(groups) == 16 and all(a[1] < b[0] for a, b in zip(groups, groups[1:]))
    cuts = [low for low, _ in groups] + [None]
    for low, high in zip(cuts, cuts[1:]):  # a range between two cuts meets one row group
        assert sum(a < (high or float("inf")) and b >= low for a, b in groups) == 1
    one = read_between(laid, "o_orderkey", cuts[3], cuts[4])
    assert 0 < one.count() < orders.count() / 8
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderkey" in plan and "LessThan(o_orderkey" in plan


def test_a_frequent_key_is_spread_over_files(spark, tmp_path):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id")
    write_ranged(df, str(tmp_path / "hot"), "k", 12)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in (tmp_path / "hot").glob("*.parquet")]
    assert sum(sizes) == 30_000 and max(sizes) < 6_000


def test_stages_are_counted_by_the_action_itself(spark):
    audit = StageAudit()
    df = audit.watch(spark.range(10), "all")
    df = audit.watch(df.where("id >= 4"), "kept")
    gone = audit.watch(spark.range(5).where("id > 100"), "gone")
    assert df.union(gone).groupBy((F.col("id") % 2).alias("k")).count().count() == 2
    assert audit.counts() == {"all": 10, "kept": 6, "gone": 0}
    assert [tuple(r) for r in audit.frame(spark).collect()] == list(audit.counts().items())
    with pytest.raises(ValueError, match="twice"):
        audit.watch(df, "kept")


def test_an_insert_is_sorted_into_taken_and_refused(spark):
    from cliniform.sources.writers import insert_sorted
    rows = [("a", "M", "12"), (None, "M", "12"), ("b", "XYZ", "no number"), ("c", None, None), ("c", "F", "123456789012345678901")]
    taken, refused = insert_sorted(spark.createDataFrame(rows, "providerid string, provider_sex string, provider_npi string"), "provider", "s")
    assert sorted((r.providerid, r.provider_sex, r.provider_npi, r.site) for r in taken.collect()) == [("a", "M", 12, "s"), ("c", None, None, "s")]
    assert sorted((r.row_key, r.column_name, r.reason, r.raw_value) for r in refused.collect()) == [
        ("b", "provider_npi", "type", "no number"), ("b", "provider_sex", "width", "XYZ"), ("c", "provider_npi", "type", "123456789012345678901"), ("~", "providerid", "required", None)]
