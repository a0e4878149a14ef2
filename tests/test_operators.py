"""Operators on hand-made rows: NULL rules, ties, hot keys, both join routes."""

from itertools import product

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cliniform.operators import lookup as lk
from cliniform.operators import membership as mb
from cliniform.operators import rules, sizing
from cliniform.operators.dedupe import first_per_key, latest_per_key, nulls_last
from cliniform.operators.quality import check_columns, check_key, check_keys, check_reference, drop_orphans
from cliniform.operators.update import delete_where, set_where, update_from
from cliniform.plans import labs
from cliniform.plans.encounters import promote_primary, recover_epidemic_codes
from cliniform.plans.vitals import widen
from cliniform.rules.results import RESULT_TEXT
from cliniform.sources.readers import VALUE_MAP


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


@pytest.fixture(params=["broadcast", "salted"])
def route(request, monkeypatch):
    """Run a test on both sides of the broadcast bound."""
    if request.param == "salted":
        monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    sizing._sizes.clear()
    return request.param


@pytest.fixture
def vmap(spark):
    return spark.createDataFrame([
        ("Sex", "M", None, "1", None, None), ("Sex", "F", None, "2", None, None), ("Sex", "B", None, "2", None, None),
        ("Sex", "U", None, None, None, None), ("Maker", "PF", "Pfizer, Inc", None, None, None),
        ("Maker", "MO", "Moderna Inc", None, None, None), ("Other", "X", None, "1", None, None)], VALUE_MAP)


def test_lookup_takes_one_least_target_per_key(spark, vmap, route):
    facts = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 9)], "fact_id int, key int")
    assert rows(lk.lookup(facts, vmap, "Sex", "key", "sex"), "fact_id", "sex") == [(1, "M"), (2, "B"), (3, None), (4, None)]
    safe = lk.lookup(facts, vmap, "Sex", "key", "sex", default="OT", null_safe=True)
    assert rows(safe, "fact_id", "sex") == [(1, "M"), (2, "B"), (3, "U"), (4, "OT")]
    inner = lk.lookup(facts, vmap, "Sex", "key", "sex", how="inner")
    assert rows(inner, "fact_id", "sex") == [(1, "M"), (2, "B")]


def test_contained_text_matches_brute_force(spark, vmap, route):
    texts = ["pfizer", "Inc", "", None, "mod", "a, i", "r, Inc", "zz", "moderna inc and more"]
    facts = spark.createDataFrame(list(enumerate(texts)), "fact_id int, text string")
    got = dict(rows(lk.lookup_contained(facts, vmap, "Maker", F.col("text"), "maker", by=lk.LABEL), "fact_id", "maker"))
    labels = {"Pfizer, Inc": "PF", "Moderna Inc": "MO"}
    for i, t in enumerate(texts):
        want = min((c for label, c in labels.items() if t and t.lower() in label.lower()), default=None)
        assert got[i] == want, t


def test_cohort_tests(spark, route):
    cohort = spark.createDataFrame([(1, 10), (1, 11), (2, 20)], "person_id bigint, visit_id bigint")
    facts = spark.createDataFrame([(1, 1, 10), (2, 1, None), (3, 2, 10), (4, 3, 30), (5, None, 11), (6, 1, 99)],
                                  "fact_id bigint, person_id bigint, visit_occurrence_id bigint")
    ids = lambda df: [r[0] for r in rows(df, "fact_id")]
    assert ids(mb.keep_persons(facts, cohort)) == [1, 2, 3, 6]
    assert ids(mb.keep_visits(facts, cohort)) == [1, 3, 5]
    assert ids(mb.keep_absent_or_visits(facts, cohort)) == [1, 2, 3, 5]
    assert ids(mb.keep_person_visits(facts, cohort)) == [1]
    assert ids(mb.keep_absent_or_same_visit(facts, cohort)) == [1, 2]
    gone = spark.createDataFrame([(10,)], "k bigint")
    assert ids(mb.drop_members(facts, gone, ("visit_occurrence_id", "k"))) == [4, 5, 6]
    assert ids(mb.drop_members(facts, gone, ("visit_occurrence_id", "k"), keep_null=True)) == [2, 4, 5, 6]
    assert ids(drop_orphans(facts, cohort.select("visit_id"), "visit_occurrence_id", keep_null=True)) == [1, 2, 3, 5]


def test_a_hot_key_is_spread_and_stays_whole(spark, route):
    facts = spark.range(9000).select(F.col("id").alias("fact_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("bigint").alias("k"))
    dim = spark.range(9000).select(F.col("id").alias("dk"), (F.col("id") * 2).alias("v"))
    joined = sizing.attach(facts, dim, [(F.col("k"), "dk")])
    assert joined.count() == 9000
    assert joined.where("k = 7").agg(F.sum("v")).first()[0] == 14 * facts.where("k = 7").count()
    if route == "salted":
        hot = facts.where("k = 7").select(sizing.spread_over(facts, sizing.SALTS).alias("s")).distinct().count()
        assert hot == sizing.SALTS


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["a", "b", None])), min_size=1, max_size=25))
def test_one_first_row_per_key(spark, data):
    df = spark.createDataFrame(data, "k int, o int, v string")
    got = {r["k"]: (r["o"], r["v"]) for r in first_per_key(df, ["k"], nulls_last("o")).collect()}
    order = lambda r: (r[1] is None, r[1] if r[1] is not None else 0, r[2] is not None, r[2] or "")
    assert got == {k: min((r for r in data if r[0] == k), key=order)[1:] for k in {r[0] for r in data}}


def test_latest_row_prefers_a_date(spark):
    df = spark.createDataFrame([(1, None, 9, "x"), (1, "2020-01-01", 1, "y"), (1, "2020-01-01", 2, "z")], "k int, d string, i int, v string")
    assert rows(latest_per_key(df, ["k"], "d", "i"), "v") == [("z",)]


def test_updates_and_deletes_ignore_null_tests(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "bb")], "id int, x string")
    assert [r[0] for r in rows(delete_where(df, F.length("x") < 2), "id")] == [2, 3]
    assert rows(set_where(df, F.col("x") == "a", x="z")) == [(1, "z"), (2, None), (3, "bb")]
    new = spark.createDataFrame([("a", "n")], "k string, v string")
    assert rows(update_from(df, new, [(F.col("x"), "k")], F.col("id") < 3, {"x": "v"})) == [(1, "n"), (2, None), (3, "bb")]


@pytest.mark.parametrize("text, strict, fixed, longest", [
    ("Not Detected", "DETECTED", "DETECTED", "NOT DETECTED"), ("yellow", "LOW", "LOW", "YELLOW"),
    ("NONREACTIVE", "NONREACTIVE", "NONREACTIVE", "NONREACTIVE"), ("O negative", "NEGATIVE", "NEGATIVE", "O NEG"),
    ("1+", "1+", "1+", "1+"), ("", "OT", "OT", "OT"), (None, "OT", "OT", "OT"), ("inconclusive", "UNDETERMINED", "INCONCLUSIVE", "INCONCLUSIVE"),
    ("Influenza A Virus", "OT", "INFLUENZA A VIRUS", "INFLUENZA A VIRUS")])
def test_classifier_modes(spark, text, strict, fixed, longest):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(*[rules.classify("t", RESULT_TEXT, "OT", mode=m).alias(m) for m in ("strict", "fixed", "longest")]).first()
    assert tuple(got) == (strict, fixed, longest)


def test_modifier_repair_on_every_state(spark):
    """The one-join repair equals running the steps one by one, on all states."""
    values = ["EQ", "GE", "GT", "LE", "LT", "OT", "NO", "", "zz", None]
    states = list(product(values, values, values, ["1", None], ["2", None]))
    df = spark.createDataFrame(states, "result_modifier string, norm_modifier_low string, norm_modifier_high string, norm_range_low string, norm_range_high string")
    got = labs.repair_modifiers(df.withColumn("id", F.struct(*df.columns))).collect()
    for r in got:
        now = list(r["id"])[:3]
        low, high = r["id"][3], r["id"][4]
        for accepted, new, bounds in labs.repair_steps():
            ok = all(v in s for v, s in zip(now, accepted))
            ok = ok and all(there is None or there == (v is not None) for there, v in zip(bounds, (low, high)))
            if ok:
                now = [o if n is None else n for o, n in zip(now, new)]
        assert [r["result_modifier"], r["norm_modifier_low"], r["norm_modifier_high"]] == now, r["id"]
    assert len(got) == len(states)


def test_epidemic_codes_read_the_raw_text_as_a_pattern(spark):
    concept = spark.createDataFrame([("ICD10CM", "U07.1"), ("ICD10", "U07.1"), ("ICD9CM", "B97.2"), ("ICD10CM", "B97.29"), ("SNOMED", "U07.1")],
                                    "vocabulary_id string, concept_code string")
    raws = ["u07.1", "B97.2_", "B97.2%", "b97.2", "xU07.1x", "J20", None, "U07.1\\"]
    df = spark.createDataFrame([(i, r, "c", "SM") for i, r in enumerate(raws)], "id int, raw string, code string, kind string")
    got = {r["id"]: (r["code"], r["kind"]) for r in recover_epidemic_codes(df, concept, F.col("raw"), F.col("kind") == "SM", "code", "kind").collect()}
    assert got == {0: ("U07.1", "10"), 1: ("B97.29", "10"), 2: ("B97.29", "10"), 3: ("B97.2", "09"), 4: ("c", "SM"), 5: ("c", "SM"), 6: ("c", "SM"),
                   7: ("c", "SM")}


def test_primary_is_promoted_only_where_none_exists(spark):
    df = spark.createDataFrame([("e1", "10", "IP", "OD", "S"), ("e1", "9", "IP", "OD", "S"), ("e2", "1", "IP", "OD", "S"), ("e2", "2", "IP", "OD", "P"),
                                ("e3", "3", "AV", "OD", "S"), ("e4", "4", "EI", "BI", "S")], "encounterid string, diagnosisid string, enc_type string, dx_origin string, pdx string")
    assert rows(promote_primary(df).where("pdx = 'P'"), "diagnosisid") == [("10",), ("2",)]


def test_wide_vitals_keep_every_combination(spark):
    signs = spark.createDataFrame([
        (1, 5, "d", "t", 1, 0, "", 150.0, "ht"), (1, 5, "d", "t", 2, 0, "", 150.0, "ht"), (1, 5, "d", "t", 3, 0, "", 151.0, "ht"),
        (1, 5, "d", "t", 4, 0, "a", 120.0, "sys"), (1, 5, "d", "t", 5, 0, "b", 125.0, "sys"), (1, 5, "d", "t", 6, 0, "c", 80.0, "dia"),
        (1, 6, "d", "t", 7, 0, "x", 70.0, "dia"), (1, 8, "d", None, 8, 0, "", 40.0, "wt")],
        "person_id int, visit_occurrence_id int, measurement_date string, measurement_datetime string, measurement_id int, measurement_concept_id int, "
        "measurement_source_value string, value_as_number double, kind string")
    links = spark.createDataFrame([(21, 4, 21, 6), (21, 5, 21, 7), (27, 5, 27, 6)], "domain_concept_id_1 int, fact_id_1 int, domain_concept_id_2 int, fact_id_2 int")
    got = rows(widen(signs, links).where("visit_occurrence_id = 5"), "ht", "sys", "dia", "dia_raw")
    assert got == [(150.0, 120.0, 80.0, "c"), (150.0, 125.0, None, None), (151.0, 120.0, 80.0, "c"), (151.0, 125.0, None, None)]
    assert rows(widen(signs, links).where("visit_occurrence_id = 8"), "wt") == [(None,)]  # no time: never matches itself


def test_keys_by_hash_equal_keys_in_full(spark):
    """Null parts, keys whose hashes clash, one key with a third of the rows, no rows."""
    hot = [("h", 1)] * 30 + [(str(i), i % 7) for i in range(60)]
    tables = {"pairs": [("a", 1), ("a", 1), ("a", None), (None, 1), (None, 1), (None, None)], "unique": [("a", 1), ("b", 1), ("a", 2)], "hot": hot, "none": []}
    frames = {n: spark.createDataFrame(r, "k string, n int") for n, r in tables.items()}
    keys = {n: ["k", "n"] for n in tables}
    for hashed in (F.xxhash64, lambda *c: F.lit(5), lambda *c: F.length(F.coalesce(c[0], F.lit("")))):
        got = rows(check_keys(frames, keys, hashed), "table_name", "check_name", "column_name", "violations")
        assert got == [("hot", "key", "k,n", 1), ("none", "key", "k,n", 0), ("pairs", "key", "k,n", 2), ("unique", "key", "k,n", 0)]


def test_reports(spark):
    df = spark.createDataFrame([(1, "abc", None), (1, "a", "x"), (2, None, "y")], "k int, t string, r string")
    assert rows(check_key(df, ["k"], "t"), "violations") == [(1,)]
    assert rows(check_columns(df, "t", ["t", "r"], {"t": 2}), "check_name", "column_name", "violations") == [
        ("not_null", "r", 1), ("not_null", "t", 1), ("width", "t", 1)]
    parent = spark.createDataFrame([("x",)], "id string")
    assert rows(check_reference(df, "r", parent, "id", "t"), "violations") == [(1,)]


def test_rows_without_a_key_are_spread(spark):
    from cliniform.operators.sizing import join_spread
    for key, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
        spark.conf.set(key, value)
    try:
        left = spark.range(4000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"))
        right = spark.range(0, 4000, 4).select(F.col("id").alias("r"))
        joined = join_spread(left, right, F.col("k"), "r", "left")
        assert joined.count() == 4000 and joined.where("r is not null").count() == 1000
        spread = joined.where("k is null").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(spread) == 4 and max(r["count"] for r in spread) < 1000
        anti = join_spread(left, right, F.col("k"), "r", "left_anti")
        assert anti.count() == 3000 and anti.where("k is null").count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_long_map_texts_are_not_broadcast(spark):
    from cliniform.operators.lookup import CLASS, LABEL, TARGET, laid_out_bytes, lookup_contained
    vmap = spark.createDataFrame([("c", "t", f"{i:03d}" + "x" * 900) for i in range(10)], f"{CLASS} string, {TARGET} string, {LABEL} string")
    assert laid_out_bytes(vmap, F.col(LABEL)) > 10 * 900 ** 3 / 6
    facts = spark.createDataFrame([(1, "003xx"), (2, "y"), (3, "")], "fact_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lookup_contained(facts, vmap.limit(10), "c", F.col("text"), "out", LABEL)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        short = spark.createDataFrame([("c", "t", "003xx1")], f"{CLASS} string, {TARGET} string, {LABEL} string")
        found = lookup_contained(facts, short, "c", F.col("text"), "out", LABEL)
        assert {(r.fact_id, r.out) for r in found.collect()} == {(1, "t"), (2, None), (3, None)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_numbers_in_plain_digits(spark):
    from cliniform.plans.labs import number_text
    rows = spark.createDataFrame([(x,) for x in (12345678.0, 0.0005, 25000000.5, 0.0, -7.0, 0.1, 100.0, None)], "x double")
    assert [r[0] for r in rows.select(number_text("x")).collect()] == ["12345678", "0.0005", "25000000.5", "0", "-7", "0.1", "100", None]


def test_index_of_map_texts_equals_brute_force(spark):
    """Long texts, rare and common grams, probes below, at and above a gram's length."""
    import random

    from cliniform.operators import lookup as lk
    rng = random.Random(5)
    texts = [(n, "".join(rng.choice("abcde ") for _ in range(rng.choice([1, 2, 3, 40, 2000])))) for n in range(60)] + [(60, ""), (61, None)]
    some = [t for _, t in texts if t]
    probes = {t[at:at + n] for t in some for at in (0, len(t) // 2) for n in (1, 2, 3, 4, 9, 500, 2000)} | {"zz", "z", "abcz", "", "dcbadcbaabcd", *["ab" * n for n in range(1, 6)]}
    frame = spark.createDataFrame(texts, "target_code int, _t string").where("_t <> ''")
    got = {r.k: r.target_code for r in lk.contained(spark.createDataFrame([(p,) for p in sorted(probes - {""})], "k string"), frame, "k", ["target_code"]).collect()}
    want = {p: min(n for n, t in texts if t and p in t) for p in probes - {""} if any(p in t for t in some)}
    assert got == want


def test_contained_lookup_beyond_the_bound(spark, monkeypatch):
    """The two ways give one result; the second lays nothing out and tests no pair of a fact and a map row."""
    from cliniform.operators import lookup as lk
    from cliniform.operators import sizing
    vmap = spark.createDataFrame([("c", f"t{n}", f"Label {n} of maker {'xyz' * (n % 7)}", f"s{n}", None, None) for n in range(40)] + [("other", "no", "maker", "s", None, None)],
                                 "source_class string, target_code string, target_label string, source_code string, description string, value_code string")
    facts = spark.createDataFrame([(n, t) for n, t in enumerate(["MAKER", "label 1", "zx", "x", "", None, "absent", "9 of", *["maker xyz"] * 30])], "fact_id int, text string")

    def found():
        df = lk.lookup_contained(facts, vmap, "c", F.col("text"), "out", by=lk.LABEL)
        return df, sorted((r.fact_id, r.out) for r in df.collect())

    near = found()[1]
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 1000)
    df, far = found()
    assert far == near and len(far) == facts.count()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan and "_salt_d" not in plan


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.text("ab c", min_size=1, max_size=5), st.sampled_from("XYZ")), max_size=12), st.text("ab c", max_size=30))
def test_one_pass_finds_the_first_rule(rules, text):
    from cliniform.operators.rules import automaton, ordered, reachable
    plain = next((t for p, t in ordered(rules, "fixed") if p in text), None)
    live = reachable(ordered(rules, "fixed"))
    first = min((n for _, n in automaton(tuple(p for p, _ in live)).iter(text)), default=None) if live else None
    assert (None if first is None else live[first][1]) == plain


def test_frames_and_columns_classify_alike(spark):
    from cliniform.operators.rules import classify, classify_texts
    from cliniform.rules.results import RESULT_TEXT
    texts = [(n, t) for n, t in enumerate([None, "", "ABNORMAL", "not detected", "xx o Positive", "prose " * 5000 + "Pink", "see comment", *[p + " " + q for p, _ in RESULT_TEXT[::7] for q, _ in RESULT_TEXT[::9]]])]
    df = spark.createDataFrame(texts, "n int, t string")
    for mode in ("strict", "fixed", "longest"):
        both = classify_texts(df, "t", RESULT_TEXT, "a", "OT", mode).withColumn("b", classify("t", RESULT_TEXT, "OT", mode=mode))
        assert both.where("not (a <=> b)").count() == 0


@pytest.fixture
def large_dictionary(spark, tmp_path):
    """Three vocabularies, one of them small, and a bound below the size of all but within that of the small one."""
    import numpy as np
    import pandas as pd
    n = 60_000
    ids = np.arange(n)
    frame = pd.DataFrame({"concept_id": ids, "concept_name": [f"name of the concept {i * 7919 % n}" for i in ids], "vocabulary_id": np.where(ids < 300, "LOINC", np.where(ids % 2 == 0, "SNOMED", "ICD10CM")),
                          "concept_class_id": np.where(ids % 3 == 0, "Lab Test", "Other"), "concept_code": [("U07.1" if i == 501 else f"B97.2{i}" if i == 601 else f"c{i}") for i in ids], "domain_id": "any"})
    frame.to_parquet(f"{tmp_path}/concept.parquet")
    return spark.read.parquet(f"{tmp_path}/concept.parquet")


def test_slices_of_a_large_dictionary_are_planned_by_their_own_size(spark, large_dictionary, monkeypatch):
    from cliniform.plans.encounters import epidemic_codes
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 100_000)
    facts = spark.range(3000).select(F.col("id"), (F.col("id") % 1000).alias("key"))
    lab = F.col("concept_class_id") == "Lab Test"
    assert not sizing.is_small(large_dictionary)
    found = lk.concept_lookup(facts, large_dictionary, "key", {"code": "concept_code"}, ["LOINC"], lab)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan
    assert rows(found.where("code is not null"), "id", "code") == sorted(((i, f"c{i % 1000}") for i in range(3000) if i % 1000 < 300 and i % 1000 % 3 == 0), key=repr)
    # one slice serves all lookups of a study
    assert lk.dictionary_slice(large_dictionary, ["LOINC"], lab) is lk.dictionary_slice(large_dictionary, ["LOINC"], F.col("concept_class_id") == "Lab Test")
    assert lk.dictionary_slice(large_dictionary, ["LOINC"]) is not lk.dictionary_slice(large_dictionary, ["LOINC"], lab)
    codes = epidemic_codes(large_dictionary)
    assert sizing.is_small(codes) and codes.count() == 2
    texts = spark.createDataFrame([(1, "u07.1", "?", "OT"), (2, "x", "?", "OT")], "id int, raw string, code string, kind string")
    got = recover_epidemic_codes(texts, large_dictionary, F.col("raw"), F.lit(True), "code", "kind")
    assert rows(got, "id", "code") == [(1, "U07.1"), (2, "?")]
    # a slice beyond the bound is shuffled once: no copies, and rows without a key are spread
    wide = lk.concept_lookup(facts.withColumn("key", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("key"))), large_dictionary, "key", {"code": "concept_code"}, ["SNOMED", "ICD10CM"])
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan and "Generate explode" not in plan
    assert wide.count() == 3000 and wide.where("code is not null").count() == sum(i % 3 == 1 and i % 1000 >= 300 for i in range(3000))


def test_a_hot_key_of_a_large_dimension_is_split(spark, monkeypatch):
    """A key with a third of the rows: its part is split by the adaptive engine, the dimension is not copied."""
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 0)
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 90_000, 1, 8).select(F.col("id").alias("fact_id"), F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, F.col("id") % 500).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        dim = spark.range(500).select(F.col("id").alias("d"), (F.col("id") * 2).alias("v"))
        df = sizing.attach(facts, dim, [(F.col("k"), "d")])
        before = df._jdf.queryExecution().optimizedPlan().toString()
        got = df.groupBy().agg(F.count("*"), F.count("v"), F.sum("v")).first()
        assert tuple(got) == (90_000, 60_000, 30_000 * 10 + sum(2 * (i % 500) for i in range(90_000) if i % 3 == 1))
        df.write.format("noop").mode("overwrite").save()
        assert "Generate explode" not in before and "skew=true" in _final_plan(spark, df)
    finally:
        for k in keys:
            spark.conf.unset(k)


def _final_plan(spark, df):
    executed = df._jdf.queryExecution()
    executed.executedPlan().executeCollect()
    return executed.executedPlan().toString()
