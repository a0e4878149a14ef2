"""Widths of finished tables are counted where the tables are built."""

from cliniform.checks import quality
from cliniform.plans import administration
from cliniform.sources.model import TABLES, conform, empty
from cliniform.sources.study import Study


def test_only_tables_others_read_are_written(spark, monkeypatch):
    rows = {"death": ([("p1", "L"), ("p2", "LONG"), ("p3", None)], "patid string, death_source string"),
            "demographic": ([("p1", "F"), ("p2", "FEMALE")], "patid string, sex string"),
            "provider": ([("a", "12"), ("b", "x")], "providerid string, provider_npi string")}

    def plan(name):
        def build(study):
            if name == "private_demographic":  # reads a written table
                return conform(study.built["demographic"].select("patid", "sex"), name, study.site)
            return conform(spark.createDataFrame(*rows[name]), name, study.site) if name in rows else empty(spark, name)
        return build

    written = []
    original = quality.staged
    monkeypatch.setattr(quality, "staged", lambda df, name, by=None: written.append((name, len(df.columns))) or original(df, name, by))
    monkeypatch.setattr(administration, "BUILD_ORDER", {n: plan(n) for n in administration.BUILD_ORDER})
    monkeypatch.setattr(administration, "harvest", lambda study, names: empty(spark, "harvest"))
    study = Study(tables={"value_map": spark.createDataFrame([("a",)], "source_class string")}, site="north")
    got = {tuple(r)[:3]: r["violations"] for r in quality.width_report(study).collect()}
    assert len(got) == sum(len(t.widths) + len(t.numbers) for t in TABLES.values())
    assert {k: n for k, n in got.items() if n} == {
        ("death", "width", "death_source"): 1, ("demographic", "width", "sex"): 1, ("private_demographic", "width", "sex"): 1,
        ("provider", "numeric", "provider_npi"): 1}
    assert {n for n, _ in written if not n.startswith("widths_")} == {"demographic", "encounter", "lds_address_history"}
    assert all(columns == 4 for n, columns in written if n.startswith("widths_"))
