"""Conversation repair, tokenizer alignment and toxicity, against brute force, twins and held-out labels."""

import hashlib
import itertools
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from compare import connect, difference
from conftest import LONG, saved
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cliniform.llm import align, toxicity, turns
from cliniform.llm.bpe import byte_alphabet

SF = "/root/testdata/sf0.01"


# ---- conversation repair

def legal(initials: str) -> bool:
    rest = initials.removeprefix("s")
    return initials == "" or (rest != "" and rest == "ua" * (len(rest) // 2))


def brute_repair(rows, most_inserted=3):
    """Least (cost, audit) over all edits of every row and up to a few insertions at every gap."""
    best = None
    fills = ["", *["".join(x) for n in range(1, most_inserted + 1) for x in itertools.product("ua", repeat=n)]]
    ways = []
    for initial, fault in rows:
        ways.append([("D", "", 4)])
        if fault in (turns.FINE, turns.TRUNCATED):
            extra = 3 if fault == turns.TRUNCATED else 0
            ways[-1] += [("K", initial, extra)] + [("R", x, 3 + extra) for x in "ua"]
    for picks in itertools.product(*ways):
        for gaps in itertools.product(fills, repeat=len(rows) + 1):
            cost = sum(p[2] for p in picks) + 3 * sum(map(len, gaps))
            if best is not None and cost > best[0]:
                continue
            said = gaps[0] + "".join(p[1] + g for p, g in zip(picks, gaps[1:]))
            if legal(said):
                audit = "I" * len(gaps[0]) + "".join(p[0] + "I" * len(g) for p, g in zip(picks, gaps[1:]))
                best = min(best, (cost, audit)) if best else (cost, audit)
    return best


def test_cells_equal_brute_force():
    kinds = [(i, f) for i in "sua-" for f in (turns.FINE, turns.BLANK, turns.TRUNCATED)]
    for n in range(3):
        for rows in itertools.product(kinds, repeat=n):
            assert turns.parsed(rows) == brute_repair(rows, 2), rows
    rng = np.random.default_rng(3)
    for _ in range(25):
        rows = tuple(kinds[k] for k in rng.integers(0, len(kinds), 3))
        assert turns.parsed(rows) == brute_repair(rows, 2), rows


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("sua-"), st.sampled_from([0, 1, 3])), max_size=40), st.integers(0, 40))
def test_any_split_gives_the_same_cells(rows, at):
    leaves = [turns.turn_cells(i, f) for i, f in rows]
    halves = turns.combined(turns.span_cells(leaves[:at]), turns.span_cells(leaves[at:]))
    assert turns.answer(halves) == turns.parsed(tuple(rows))


CONV = "conv_id long, turn long, role string, text string, Whole int, id string"
ODD_TURNS = [(1, 0, "user", "Hi.", 1, "x"), (1, 1, "assistant", "Yes?", 1, "x"), (1, 1, "assistant", "Yes?", 1, "x"), (2, None, None, None, None, None), (2, None, "user", "no end", 2, ""),
             (2, 3, "assistant", LONG, 2, ""), (None, 1, "user", "Ok.", 1, "y"), (None, 5, "tool", "Ok.", 1, "y"), (3, 0, "", "", None, None), (4, 7, "system", "Be kind.", 0, "z")]


def plain_repair(rows):
    """Counts, audit and repaired lines of all conversations, row by row."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((t is not None, t or 0, " " if r is None else r, " " if x is None else x) for c, t, r, x, *_ in rows if c == conv)
        seen, marks = set(), []
        for _, _, role, text in own:
            last = text.rstrip(turns.WHITE)[-1:]
            marks.append(1 if not last else 2 if (role, text) in seen else 0 if last in ".!?" else 3)
            seen.add((role, text))
        initials = [r[2][:1] if r[2][:1] in ("s", "u", "a") else "-" for r in own]
        out[conv] = (marks.count(1), marks.count(2), marks.count(3), *turns.parsed(tuple(zip(initials, marks))))
    return out


@pytest.mark.parametrize("sizes", [{}, {"long": 1, "block": 2, "fan": 2}])
def test_repair_of_odd_rows(spark, sizes):
    done = turns.repair(spark.createDataFrame(ODD_TURNS, CONV), **sizes)
    got = {r.conv: (r.blank, r.duplicate, r.truncated, r.cost, r.audit) for r in done.conversations.collect()}
    assert got == plain_repair(ODD_TURNS)
    lines = {}
    for r in done.turns.orderBy("conv", "place", "within").collect():
        lines.setdefault(r.conv, []).append((r.role, r.text))
    for conv, said in lines.items():
        assert legal("".join(role[0] for role, _ in said)), conv
    assert lines[1] == [("user", "Hi."), ("assistant", "Yes?")]
    none = turns.repair(spark.createDataFrame([], CONV))
    assert none.conversations.count() == none.turns.count() == 0


def test_long_conversation_in_blocks(spark, tmp_path):
    """A conversation in many blocks and its rows in many ranges equals the twin."""
    folder = saved(spark, tmp_path, conversations=("conv_id long, turn long, role string, text string", [
        (c, n, ["user", "assistant", "system"][(n * n + (c or 0)) % 3], ["Ok.", "no end", "", f"Turn {n}!"][(n + (c or 0)) % 4]) for c, size in ((1, 300), (2, 3), (None, 40)) for n in range(size)]))
    whole = turns.op13_turns(spark, folder)
    done = turns.repair(turns.damaged(spark.read.parquet(f"{folder}/conversations.parquet")), copies="copies", long=8, block=16, fan=3)
    want = {r.conv_id: r for r in whole.collect()}
    got = {r.conv: r for r in done.conversations.collect()}
    assert {k: (r.cost, r.audit, r.illegal, r.gaps) for k, r in got.items()} == {k: (r.cost, r.audit, r.illegal, r.gaps) for k, r in want.items()}
    digests = {r.conv: r.repaired_sha256 for r in turns.digests(done.turns).collect()}
    assert all(want[k].repaired_sha256 == d for k, d in digests.items())
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{folder}/conversations.parquet/*.parquet'")
    assert difference(whole, con, turns.OP13_SQL) is None


def test_turns_equal_their_twin(spark):
    assert difference(turns.op13_turns(spark, SF), connect(SF), turns.OP13_SQL) is None


# ---- alignment

@pytest.fixture(scope="module")
def peers():
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def brute_align(texts, peers):
    a, b = peers
    alphabet, links, out = byte_alphabet(), Counter(), []
    for text in texts:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        raw_a = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            out.append(None)
            continue
        ends_a, ends_b = (list(itertools.accumulate(map(len, raw))) for raw in (raw_a, raw_b))
        own, groups, at_a, at_b = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(end, at_a) + 1, ends_b.index(end, at_b) + 1
            groups.append(",".join(map(str, ids_a[at_a:to_a])) + "|" + ",".join(map(str, ids_b[at_b:to_b])))
            own.append((ids_a[to_a - 1], ids_b[to_b - 1]))
            at_a, at_b = to_a, to_b
        links.update(own)
        out.append((len(ids_a), len(ids_b), len(groups), len(own), own, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    tops = Counter()
    for (_, y), n in links.items():
        tops[y] = max(tops[y], n)
    return [(0, 0, 0, 0, 0, 0, "") if o is None else (*o[:4], sum(links[k] == tops[k[1]] for k in o[4]), sum(links[k] for k in o[4]), o[5]) for o in out]


ODD_TEXTS = ["plain words", None, "", " \t\n ", "<|endoftext|> and <s> </s> <0x0A>", "日本語 🙂 é ▁", "a▁b", "x" * 3000, "plain words", "ﬁ ligature   nbsp", "\x00 nul", "\U0001F9D1‍\U0001F680 ok"]


@pytest.mark.parametrize("block", [1, 200, align.BLOCK])
def test_alignment_equals_brute_force(spark, peers, block):
    docs = spark.createDataFrame([(n, t, n, "kept") for n, t in enumerate(ODD_TEXTS)] + [(None, "no id", 1, "k")], "doc_id long, text string, N_A long, Block string")
    got = {r.doc_id: tuple(r[c] for c in align.OUT) for r in align.align(docs, block=block).collect()}
    want = brute_align([*ODD_TEXTS, "no id"], peers)
    assert [got[n] for n in (*range(len(ODD_TEXTS)), None)] == want
    assert align.align(docs.limit(0)).count() == 0


def test_alignment_of_documents(spark, peers):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r[c] for c in align.OUT) for r in align.op11_align(spark, "/root/testdata/sf0.001").collect()}
    assert [got[r.doc_id] for r in rows] == brute_align([r.text for r in rows], peers)


def test_long_texts_are_cut_where_pieces_end(peers):
    both = align.sides(P.path(align.A), P.path(align.B), P.PATTERN)
    text = ("some words,  more\n words ▁ and é 日本 \t x" * 9000)
    assert len(text) > 3 * align.CUT and both.pieces(text) == peers[1].encode(text)
    assert both.pieces("y" * 70_000) == peers[1].encode("y" * 70_000)


def test_identity_map_is_by_bytes(spark):
    both = align.sides(P.path(align.A), P.path(align.B), P.PATTERN)
    for a, b in enumerate(both.identity.tolist()):
        assert b < 0 or both.bytes_a[a] == both.bytes_b[b]


# ---- toxicity

def test_held_out_toxicity(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [r for r in toxicity.op12_toxicity(spark, "/root/testdata/sf0.1").where("held_out").collect() if r.doc_id in labels]
    toxic, clean = ([r for r in held if labels[r.doc_id] == y] for y in (1, 0))
    assert sum(r.predicted for r in toxic) >= 0.75 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in held)


def test_windows_of_the_whole_text_count():
    one = toxicity.Distance(b" ordinary words here ", b" zzscumzz ", np.zeros(14))
    late = "ordinary words here " * 5000 + "zzscumzz"
    hist = one.histograms(["", None, late, "zzscumzz " * 24])
    assert hist[:2].sum() == 0
    assert hist[2].sum() == -(-15_001 // toxicity.WINDOW) and hist[2, 1:].sum() >= 1
    assert hist[3, 1:].sum() == 2


def test_toxicity_of_odd_rows(spark, odd, none):
    for rows in ([], [(1, 1), (2, 0), (5, None), (5, 1), (7, 0), (None, 1)], [(1, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        distance = toxicity.trained(odd, labels)
        got = toxicity.scored(odd.withColumnRenamed("lang", "TOXICITY"), distance).collect()
        assert len(got) == odd.count() and all(0 <= r.toxicity <= 1 for r in got)
        assert len({r.toxicity for r in got if r.doc_id == 1}) == 1
        assert toxicity.scored(none, distance).count() == 0
