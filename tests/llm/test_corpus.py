"""Mixing, rules, quality, secrets, extraction and the pipeline, against brute force and by hand."""

import hashlib
import re
from collections import Counter
from math import log2, sqrt

import numpy as np
import pytest
from conftest import DOC, saved
from pyspark.sql import functions as F

import corpus_pipeline
from cliniform.llm import QUERIES, mixing, quality, rules, secrets, wrapper

FOLDER = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


# ---- mixing ---------------------------------------------------------------------------------------

def reshared(sizes, weights=(5, 2, 1), share=1.5, repeats=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    full, total = set(), share * sum(sizes.values())
    while True:
        rest, open_ = total - sum(repeats * sizes[n] for n in full), [n for n in names if n not in full]
        got = {n: repeats * sizes[n] for n in full} | {n: rest * weight[n] / sum(weight[m] for m in open_) for n in open_}
        over = {n for n in open_ if got[n] > repeats * sizes[n]}
        if not over:
            return got
        full |= over


def test_targets_are_reshared(spark, documents):
    rows = QUERIES["op6_mix"](spark, FOLDER).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        doc = documents[r.doc_id]
        assert r.size == len(re.findall(WORD, doc.text or "")) and 0 <= r.taken <= 2 * r.size
        sizes[doc.source] += r.size
        taken[doc.source] += r.taken
        target[doc.source] = r.target
    want = reshared(dict(sizes))
    assert all(abs(target[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)
    assert all(abs(taken[s] - target[s]) <= 1.5 * mixing.BLOCK for s in sizes)
    again = {(r.doc_id, r.taken) for r in QUERIES["op6_mix"](spark, FOLDER).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_shards_draw_source_counts_near_the_targets(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    mix = mixing.Mix(docs, block=4, shard_slots=512)
    plan = {r.source_no: r.slots for r in mixing.planned(mix.sources, 4).collect()}
    counts = mix.shards.collect()
    total, shards = sum(plan.values()), -(-sum(plan.values()) // 512)
    assert shards > 10 and {r.shard for r in counts} == set(range(shards))
    for source, slots in plan.items():
        own = sorted((r.shard, r.first_slot, r.slots) for r in counts if r.source_no == source)
        # ranges follow each other in order of the shards and give all slots
        assert [first for _, first, _ in own] == np.cumsum([0] + [n for *_, n in own[:-1]]).tolist() and sum(n for *_, n in own) == slots
        # multinomial: within six deviations of the mean, and not all alike
        mean = slots / shards
        assert all(abs(n - mean) <= 6 * sqrt(mean) + 1 for *_, n in own)
    assert len({(r.source_no, r.slots) for r in counts}) > 2 * len(plan)
    slots = mix.slots.collect()
    assert len(slots) == total == len({(r.source_no, r.slot) for r in slots}) == len({(r.source_no, r.round, r.block_no) for r in slots})
    drawn = Counter((r.source_no, r.shard) for r in slots)
    assert drawn == {(r.source_no, r.shard): r.slots for r in counts}


def test_mixed_shards_hold_the_blocks_drawn(spark, odd, none):
    taken = sum(r.taken for r in mixing.Mix(odd, block=8).taken().collect())
    rows = mixing.mixed_shards(odd.withColumnRenamed("n_chars", "_mix_start"), block=8, shard_slots=64).collect()
    assert sum(r.n_words for r in rows) == taken and all(len(r.text.split()) == r.n_words <= 8 for r in rows)
    own = {}
    for r in odd.collect():
        own.setdefault(r.source, Counter()).update((r.text or "").split())
    for source in own:
        mixed = Counter(w for r in rows if r.source == source for w in r.text.split())
        assert all(n <= 2 * own[source][w] for w, n in mixed.items())
    assert len({r.shard for r in rows}) > 1 and mixing.mixed_shards(none).count() == 0


def test_rows_without_ids_are_spread(spark):
    rows = spark.createDataFrame([(None, f"text number {i} of many", "a") for i in range(200)], "doc_id long, text string, source string")
    mix = mixing.Mix(rows)
    parts = mix.docs.select(F.pmod(F.xxhash64("doc_id", F.lit(mixing.SEED), "salt"), F.lit(mixing.PARTS)).alias("part")).distinct().count()
    assert parts > 100 and mixing.mixed_texts(rows).count() > 0


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 1000):
        out = [r.p for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(5)).alias("p")).collect()]
        assert sorted(out) == list(range(n))
    assert out != sorted(out)


def test_mixed_texts_hold_the_words_drawn(spark, odd, none):
    mixed = mixing.mixed_texts(odd)
    assert mixed.columns == odd.columns
    own = {r.doc_id: (r.text or "").split() for r in odd.collect()}
    rows = mixed.collect()
    for r in rows:
        assert Counter(r.text.split()) <= Counter(own[r.doc_id])
    words = sum(r.taken for r in mixing.Mix(odd).taken().collect())
    assert sum(len(r.text.split()) for r in rows) == words
    assert mixing.mixed_texts(none).count() == 0 and mixing.Mix(none).taken().count() == 0
    assert mixing.Mix(odd).taken().count() == 8
    assert mixing.mixed_texts(odd.withColumnRenamed("lang", "_mix_size")).columns[2] == "_mix_size"


# ---- rules ----------------------------------------------------------------------------------------

def counted(text):
    words = re.findall(WORD, text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_base_counts(spark, odd, none):
    draw = np.random.default_rng(0)
    texts = [" ".join(draw.choice(list("abc"), int(n))) for n in draw.integers(0, 30, 60)] + ["a b c a b c", "x\nx\n\nx", "#a *b | c", "a b", None]
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOC).unionByName(odd.where("doc_id is not null").dropDuplicates(["doc_id"]).withColumn("doc_id", F.col("doc_id") + 1000))
    text = {r.doc_id: r.text for r in frame.collect()}
    for r in rules.judged(frame).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counted(text[r.doc_id]), text[r.doc_id][:50]
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert rules.judged(none).count() == 0


def test_distance(spark):
    p, q = [1.0, 3.0, 0.0], [2.0, 2.0, 4.0]
    a, b = [x / 4 for x in p], [x / 8 for x in q]
    want = sqrt(sum((x * log2(2 * x / (x + y)) if x else 0) + (y * log2(2 * y / (x + y)) if y else 0) for x, y in zip(a, b, strict=True)) / 2)
    frame = spark.createDataFrame([(p, q, 4.0, 8.0)], "p array<double>, q array<double>, a double, b double")
    assert abs(frame.select(rules.js_distance(F.col("p"), F.col("q"), F.col("a"), F.col("b"))).first()[0] - want) < 1e-12


def test_junk_goes_and_clean_stays(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op10_quality_rules"](spark, folder).collect() if r.doc_id in labels and not r.base_failed]
    clean, junk = [r for r in rows if labels[r.doc_id] == 1], [r for r in rows if labels[r.doc_id] == 0]
    assert sum(r.kept for r in clean) >= 0.995 * len(clean) and sum(r.kept for r in junk) <= 0.3 * len(junk)


def test_unknown_languages_meet_the_reference_of_all(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    junk_ids = [i for i, q in labels.items() if q == 0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    unknown = F.col("doc_id").isin(junk_ids) | (F.col("doc_id") % 5 == 0)
    # all of the junk and a fifth of the others
    docs = docs.withColumn("lang", F.when(unknown, F.element_at(F.array(F.lit(None), F.lit("en-US"), F.lit("EN")), (F.col("doc_id") % 3 + 1).cast("int"))).otherwise(F.col("lang")))
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = [r for r in rules.judged(docs).collect() if r.doc_id in labels and not r.base_failed and (r.doc_id in junk_ids or r.doc_id % 5 == 0)]
    clean, junk = [r for r in rows if labels[r.doc_id] == 1], [r for r in rows if labels[r.doc_id] == 0]
    assert sum(r.kept for r in clean) >= 0.995 * len(clean) and sum(r.kept for r in junk) <= 0.3 * len(junk)
    common = {w for v in rules.COMMON.values() for w in v.split()}
    uses = {i: (sum(w in common for w in words), len(words)) for i, t in text.items() for words in [re.findall(WORD, t.lower())]}
    y = sum(u for u, _ in uses.values()) / sum(n for _, n in uses.values())
    for r in rows:
        assert (r.word_distance is None) == (r.n_words < rules.LEAST_WORDS)
        if r.word_distance is not None:
            x = uses[r.doc_id][0] / uses[r.doc_id][1]
            want = sum(a * log2(2 * a / (a + b)) if a else 0 for p, q in ((x, y), (1 - x, 1 - y)) for a, b in ((p, q), (q, p))) / 2
            assert abs(r.word_distance ** 2 - want) < 1e-9


# ---- quality --------------------------------------------------------------------------------------

def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op8_quality"](spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in rows]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_of_odd_rows(spark, odd, none):
    marks = spark.createDataFrame([(1, 1, 0), (3, None, 0), (5, 0, 0), (5, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    scored = quality.trained(odd, marks).score(odd).collect()
    assert len(scored) == 8 and all(0 <= r.quality_score <= 1 for r in scored)
    assert len({r.quality_score for r in scored if r.doc_id == 1}) == 1
    assert quality.trained(none, marks.limit(0)).score(none).count() == 0
    assert {r.quality_score for r in quality.trained(odd, marks.where("false")).score(odd).collect()} == {0.5}
    assert quality.accepted(odd.withColumnRenamed("lang", "_quality_score"), marks).columns[2] == "_quality_score"


def test_contexts_are_sums_over_all_texts(spark):
    texts = ["one two three", "two three four", None, "five"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    places, signs = quality.index_vectors()
    want = np.zeros((quality.BUCKETS, quality.WIDTH), np.int64)
    for t in texts:
        c = quality.coded(t or "")
        for i in range(len(c)):
            for j in range(max(0, i - quality.REACH), min(len(c), i + quality.REACH + 1)):
                if i != j:
                    np.add.at(want[c[i]], places[c[j]], signs[c[j]])
    assert (quality.context_table(frame) == want).all()


# ---- secrets --------------------------------------------------------------------------------------

def plain_spans(text):
    kinds = [("assign", "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
              "[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
             ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 24)]
    found = [(m.start(), k, name, m.end()) for k, (name, pattern, holds) in enumerate(kinds) for m in re.finditer(pattern, text) if holds(m)]
    return [f"{name}:{a}:{b}" for a, _, name, b in sorted(found)]


HARD = ["token=ab password: 'abcdef' api-key=zzzzzz Api_Key = \"q.w=e/r+t\"", "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + "AKIAAKIA" + "C" * 16, "f" * 23 + "g" + "0" * 24,
        "paſsword=abcdefg toKen=abcdefgh", "secret:secret:secret=abcdef", "日本 token\t=abcdef token  :  abcdef", ""]


def test_base_spans():
    for text in HARD:
        assert secrets.joined(secrets.base_spans(text)) == ",".join(plain_spans(text))


def test_field_learns_and_decodes_exactly(documents):
    texts = [d.text for d in documents.values() if d.text]
    values = np.random.default_rng(0)
    planted = [t[:200] + f' token = "{secrets.invented(values)}" ' + t[200:400] for t in texts[:60]]
    field = secrets.fitted(texts + planted)
    for t in planted + texts[:40]:
        e = field.emissions(secrets._TOKENS.findall(t), t)
        assert (field.tags(e) == secrets.viterbi(e, field.move, False)).all()
    field.move[0, 2] = secrets.ILLEGAL
    for e in np.random.default_rng(1).normal(0, 3, (200, 30, 3)):
        assert (field.tags(e) == secrets.viterbi(e, field.move, False)).all()
    found = secrets.spans_of("please use my credential 8fj3kd9x0s8dk3j4kf9d7s6a5q for it", field)[1]
    assert [s[1] for s in found] == [3]
    clean = [secrets.spans_of(t, field) for t in texts]
    assert sum(len(a) - len(b) for b, a in clean) == 0


PHRASES = ["please use my credential {} for it", "Authorization: Bearer {}", "export AWS_KEY={}", "pwd={}", "sk_live_{}", "the login is {}.", '"client_key": "{}",', "{}"]


def test_planted_values_are_found_and_clean_texts_left_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    field = secrets.trained(docs)
    texts = sorted({r.text for r in docs.collect() if r.text})
    clean = [t for t in texts if not secrets.base_spans(t)]
    assert sum(bool(secrets.spans_of(t, field)[1]) for t in clean) <= len(clean) // 100
    rng = np.random.default_rng(8)
    letters = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
    for phrase in PHRASES:
        hits = 0
        for t in clean[:100]:
            value, words = "".join(rng.choice(letters, 28)), t.split(" ")
            text = " ".join([*words[:len(words) // 2], phrase.format(value), *words[len(words) // 2:]])
            at = text.index(value)
            base, spans = secrets.spans_of(text, field)
            hits += any(a <= at and b >= at + 28 for a, _, b in spans)
            assert set(base) <= set(spans)
            assert value not in secrets._masked(text, spans, "[secret]") or not any(a <= at and b >= at + 28 for a, _, b in spans)
        assert hits >= 90, phrase


def test_runs_beyond_base_spans_are_kept():
    base = [(0, 0, 10), (8, 2, 20), (30, 0, 40)]
    assert secrets.covered(2, 20, base) and secrets.covered(31, 40, base) and not secrets.covered(2, 21, base)
    assert not secrets.covered(19, 31, base) and not secrets.covered(22, 25, base) and not secrets.covered(0, 1, [])
    assert secrets._masked("k=abcdef$ghi end", [(0, 0, 8), (2, 3, 12)], "*") == "* end"


def test_secrets_of_odd_rows(spark, odd, none, tmp_path):
    folder = saved(spark, tmp_path, documents=(DOC, [(i, t, None, None, None) for i, t in enumerate([*HARD, None])]))
    for r in QUERIES["op3_secrets"](spark, folder).collect():
        base = plain_spans(HARD[r.doc_id] if r.doc_id < len(HARD) else "")
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex"))
        assert set(base) <= set(r.spans.split(",")) or not base
    hidden = {r.doc_id: r.text for r in secrets.redacted(odd).collect()}
    assert hidden[7].startswith("[secret] oké") and hidden[2] is None and hidden[3] == ""
    assert secrets.redacted(none).count() == 0 and secrets.redacted(odd.withColumnRenamed("lang", "_redacted")).columns[2] == "_redacted"


# ---- extraction -----------------------------------------------------------------------------------

PAGE = "page_id long, url string, html string"


def test_markup():
    text = wrapper.main_text
    assert text("<body><nav>menu</nav><article><h1>A &amp; B</h1><p>one <b>t</b>wo<p>three<br>four<aside>x</aside><div class='share'>y</div></article><footer>f</footer>", None) == "A & B one two three four"
    assert text("<div id=sidebar>s</div><div class=post-content><p>body text of it</p></div><div class=comments><p>reader</p></div>", None) == "body text of it"
    assert text("<div class='hentry post comments-open no-sidebar'><div class='entry-header'><h1>T</h1></div><p>text of post</p><div class=shareButtons>s</div>"
                "<article class='comment'>c</article></div><div id='cookieNotice'>k</div><div class='adBox top'>z</div>", None) == "T text of post"
    assert text("plain &lt;text&gt;", None) == "plain <text>" and text("", None) == text(None, None) == ""
    assert text("<div>" * 5000 + "deep" + "</div>" * 5000 + "<p>after", None) == "deep after"
    assert text("<article><p title=it's>Hello</p><p>more text it's here</p><p>end</p></article>", None) == "Hello more text it's here end"
    assert text('<p class="x>Hello</p>', None) == "Hello" and text("<p title='a > b' data-x=\"1>2\">in</p>", None) == "in"
    assert text("<p a=b=c \"odd\" it's>kept</p><p x = 'q'>two", None) == "kept two"
    assert text("<script>var a='</p>'</script><p>x<!-- no --> y", None) == "x y"


def test_layout_names_do_not_cut_the_article(spark):
    text = wrapper.main_text
    for name in ("right-sidebar", "content-with-sidebar", "layout-has-sidebar", "legal-news", "social-page", "sticky-header", "comments"):
        assert text(f"<div class='{name}'><article><h1>T</h1><p>whole text</article></div><div class=sidebar>s</div>", None) == "T whole text", name
    assert text("<form id=aspnetForm><div>menu</div><main><p>text of it</main></form>", None) == "text of it"
    assert text("<div class=left-sidebar><p>most of the text of this page</p><div class=cookie-bar>c</div></div><div>end</div>", None) == "most of the text of this page end"
    assert text("<main><p>Home</p><div class=right-sidebar><article>the article</article><div class=comments>" + "<p>reader</p>" * 20 + "</div></div></main>", None) == "Home the article"
    # parts that hold articles of readers or of other pages stay out
    assert text("<div class=right-sidebar><article>the article</article><div class=sidebar><article>card</article></div></div><div class=comments>"
                "<article class=comment-body>a reader with many words</article></div>", None) == "the article"
    assert [wrapper.name_kind(n) for n in ("legal-news", "right-sidebar", "shareButtons", "related-posts", "no-sidebar", "main-content")] == [0, 1, 1, 1, 0, 2]
    # without marks the aligned slots decide: a long constant list is template, the varying part is the content
    page = ("<div class=sidebar>" + "<p>the same list on all pages</p>" * 9 + "</div><div class=nav-layout-sidebar><div>Our site</div><p>text {0} of this page, and {0} again</p></div>")
    rows = [(i, f"http://h.example/{i}", page.format(f"number{i}")) for i in range(30)]
    got = {r.page_id: r.main_text for r in wrapper.extracted(spark.createDataFrame(rows, PAGE)).collect()}
    assert got[4] == "text number4 of this page, and number4 again"


def test_all_parts_of_the_article_stay():
    text = wrapper.main_text
    long = "a long text of the article " * 20
    assert text(f"<main><h1>Title</h1><div class='content'><p>{long}</p></div><p>end</p></main>", None) == f"Title {long}end"
    assert text(f"<div class=post><h1>Title</h1><div class=entry-content>{long}</div><nav>n</nav><p>end</p></div>", None) == f"Title {long}end"
    assert text(f"<div>menu</div><div class=entry-header><h1>Title</h1></div><div class=entry-content>{long}</div><div>foot</div>", None) == f"Title {long}".strip()
    assert text(f"<div class=post-content>one</div><div class=advert>x</div><div class=post-content>{long}</div><div class=post-content>three</div>", None) == f"one {long}three"
    assert text(f"<div class=entry-header>Title</div><article>{long}</article>", None) == f"Title {long}".strip()
    assert text(f"<article><header class=entry-header><h1>Title</h1></header>{long}<footer>f</footer></article>", None) == f"Title {long}".strip()
    assert text(f"<h1 class=entry-title>Title</h1><div>{long}</div>", None) == f"Title {long}".strip()


def test_wrapper_drops_what_never_changes(spark):
    page = "<html><body><div>Our site</div><div><h2>Title {0}</h2><p>text {0} of this page</p><span>Read more here</span></div><div>All rights</div></body></html>"
    rows = [(i, f"http://h.example/{i}", page.format(f"number{i} x{i * 7}")) for i in range(30)]
    rows += [(100, "http://other.example/", page.format("alone")), (101, None, "<p>no host"), (102, "http://h.example/n", None)]
    got = {r.page_id: r.main_text for r in wrapper.extracted(spark.createDataFrame(rows, PAGE)).collect()}
    assert got[3] == "Title number3 x21 text number3 x21 of this page"
    assert got[100] == "Our site Title alone text alone of this page Read more here All rights"
    assert got[101] == "no host" and got[102] == ""
    clash = wrapper.extracted(spark.createDataFrame(rows[:2], PAGE).withColumn("host", F.lit(1)).withColumn("wrapper", F.lit(2)))
    assert clash.columns == ["page_id", "url", "html", "host", "wrapper", "main_text"]
    assert wrapper.extracted(spark.createDataFrame([], PAGE)).count() == 0


def test_tree_matching():
    def node(label, *children):
        return wrapper.Slot(label, 1, [1], [], list(children))

    one = node("a", node("b", node("c"), node("d")), node("e"), node("b"))
    two = node("a", node("b"), node("b", node("d")), node("e"))
    assert wrapper.matched(one, two) == 4 and wrapper.matched(one, node("z")) == 0
    assert wrapper.matched(one, wrapper.Slot.load(one.dump())) == one.count()
    assert wrapper.merged(one, two).count() == 7


def test_articles_of_the_pages(spark):
    import html
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for r in QUERIES["op2_extract"](spark, FOLDER).collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", pages[r.page_id], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(h1|p|br)>", " ", inner))).split())
        assert r.text == want and r.n_chars == len(want)


# ---- pipeline -------------------------------------------------------------------------------------

def test_pipeline(spark, documents):
    from cliniform.sources.stage import staged
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert all(i in seen["quality"] for i, q in labels.items() if q == 1)
    assert set(seen["near_duplicates"]) <= set(seen["quality"])
    for i, text in seen["secrets"].items():
        assert not plain_spans(text) and ("[secret]" in text or text == documents[i].text)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.columns == [*columns, "token_ids"] and last.count() == docs.count()


def test_pipeline_stops_at_wrong_ids(spark, odd, monkeypatch):
    from cliniform.llm import tokens
    assert corpus_pipeline.STAGES[-1][1](spark, odd, FOLDER).count() == odd.count()

    class Wrong:
        def encode(self, text):
            return [0] * len(text)

    monkeypatch.setattr(tokens, "ranks_encoder", lambda path, pattern: Wrong())
    with pytest.raises(Exception, match="do not decode"):
        corpus_pipeline.STAGES[-1][1](spark, odd, FOLDER).collect()


def test_pipeline_on_odd_rows(spark, odd, none, tmp_path):
    folder = saved(spark, tmp_path, labels=("doc_id long, quality int, toxic int", [(1, 1, 0), (None, None, None)]))
    for docs in (odd, none, odd.withColumn("extra", F.lit(1)).withColumn("bits", F.lit("b"))):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).columns[-1] == "token_ids"
        docs.count()


def test_wrapper_keeps_nodes_of_hosts_with_many_templates(spark):
    letters = [f"{a}{b}" for a in "bcdfghk" for b in "bcdfghk"][:46]
    rows = [(i, "http://h.x/", f"<body><div class=qtail>Same tail</div><p>own words number {i}</p></body>") for i in range(12)]
    for i in range(100, 116):
        parts = "".join(f"<div class=q{a}>" + "".join(f"<div class=v{b}>w{i} {a} {b}</div>" for b in letters) + "</div>" for a in letters)
        rows.append((i, "http://h.x/", f"<body>{parts}</body>"))
    got = {r.page_id: r.main_text for r in wrapper.extracted(spark.createDataFrame(rows, PAGE).coalesce(1)).collect()}
    assert all(got[i] == f"own words number {i}" for i in range(12))
    assert len(got[100].split()) == 3 * 46 * 46
