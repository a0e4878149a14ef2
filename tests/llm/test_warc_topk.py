"""WARC records and exact top-k, against their SQL twins and by hand."""

import math

import numpy as np
from compare import connect, difference
from conftest import saved

from cliniform.llm import QUERIES, SQL, topk, warc

PAGE = "page_id long, url string, html string"
FOLDER = "/root/testdata/sf0.001"


def test_queries_equal_their_twins(spark):
    con = connect(FOLDER)
    for name in ("op5_warc", "op9_topk"):
        assert difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


def test_revisits_and_odd_pages(spark, tmp_path):
    rows = [(3, "http://a/3", "<p>x</p>"), (1, "http://a/1", "<p>x</p>"), (1, "http://a/1", "<p>x</p>"), (5, None, None), (4, "u", ""),
            (6, "http://b\r\n/", "long \r\n\r\n WARC/1.1 日" * 50_000), (None, "n", "<p>x</p>"), (None, "n", "only here")]
    folder = saved(spark, tmp_path, pages=(PAGE, rows))
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in QUERIES["op5_warc"](spark, folder).collect()), key=str)
    size = len(rows[5][2].encode())
    assert got == sorted([(1, "response", None, 8), (1, "response", None, 8), (3, "revisit", 1, 8), (4, "response", None, 0), (5, "revisit", 4, 0),
                          (6, "response", None, size), (None, "revisit", 1, 8), (None, "response", None, 9)], key=str)
    assert QUERIES["op5_warc"](spark, saved(spark, tmp_path / "none", pages=(PAGE, []))).count() == 0


def test_archives_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i % 3}", f"<p>{i % 4}</p>" * 30) for i in range(20)], PAGE)
    warc.write_archives(warc.resolved(pages), f"{tmp_path}/w", archive_bytes=2000, date="2020-01-01T00:00:00Z")
    records = warc.read_archives(spark, f"{tmp_path}/w").collect()
    assert {r.page_id for r in records} == set(range(20))
    assert {r.page_id: bytes(r.payload).decode() for r in records if r.record_type == "response"} == {i: f"<p>{i}</p>" * 30 for i in range(4)}
    assert all(r.refers_to == r.page_id % 4 and r.refers_uri == f"http://h/{r.page_id % 4 % 3}" for r in records if r.record_type == "revisit")


def brute(rows, k=5):
    rows = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, q in rows:
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in rows if j != i)[:k]
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)}
    return out


def test_topk_is_exact_with_ties_and_odd_vectors(spark, tmp_path):
    draw = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in draw.normal(0, 0.1, 6).round(1)], 0) for i in range(400)]
    rows += [(1000, None, 0), (1050, [None, 1.0], 0), (1100, [float("nan")], 0), (1150, [float("inf"), 0.0], 0), (1200, [], 0), (1250, [0.5, 0.5], 0), (None, [1.0] * 6, 0)]
    schema = "vec_id long, embedding array<float>, label int"
    got = QUERIES["op9_topk"](spark, saved(spark, tmp_path, embeddings=(schema, rows)))
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()} == brute([r[:2] for r in rows])
    small = topk.integer_vectors(spark.createDataFrame(rows, schema))
    cells = topk.top_k(small.where("vec_id % 50 = 0"), small, shard_rows=40, group_rows=3)
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in cells.collect()} == brute([r[:2] for r in rows])
    assert topk.top_k(small.where("false"), small.where("false")).count() == 0


def test_max_score_prunes_nothing_it_needs():
    draw = np.random.default_rng(2)
    scores = draw.integers(-40, 40, (9000, 20)) * (draw.random((9000, 20)) < 0.3)
    ids = draw.permutation(9000)
    for _ in range(20):
        q = draw.integers(-40, 40, 20)
        top, who = topk.max_score(q, None, np.ascontiguousarray(scores.T), ids, scores.max(0), scores.min(0), 5)
        want = sorted(zip((-(scores @ q)).tolist(), ids.tolist(), strict=True))[:5]
        assert list(zip((-top).tolist(), who.tolist(), strict=True)) == want


def test_topk_leaves_out_the_query_row_alone(spark, tmp_path):
    draw = np.random.default_rng(3)
    rows = [(i, draw.integers(-3, 4, 4).astype(float).tolist(), 0) for i in range(120)]
    rows += [rows[0], rows[0], rows[50], rows[7], rows[8], (50, [2.0, -1.0, 3.0, 1.0], 0), (100, rows[100][1] + [0.0], 0)]
    # own product beyond 64 bits, all others small
    rows += [(150, [3e12, 1.0, 0.0, 0.0], 0)]
    rows = [(i, [0.0, *v[1:]] if i != 150 else v, n) for i, v, n in rows]
    vectors = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows]
    want = []
    for at, (i, q) in enumerate(vectors):
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for place, (j, v) in enumerate(vectors) if place != at)[:5]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    schema = "vec_id long, embedding array<double>, label int"
    got = QUERIES["op9_topk"](spark, saved(spark, tmp_path, embeddings=(schema, rows)))
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == sorted(want)
    small = topk.integer_vectors(spark.createDataFrame(rows, schema))
    cells = topk.top_k(small.where("vec_id % 50 = 0"), small, shard_rows=40, group_rows=2)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in cells.collect()) == sorted(want)
