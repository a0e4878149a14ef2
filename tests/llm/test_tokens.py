"""BPE against the public libraries, whole texts and prefixes."""

import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from conftest import saved
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cliniform.llm import QUERIES, tokens
from cliniform.llm.bpe import json_encoder, ranks_encoder

DOC = "doc_id long, text string, lang string, source string, n_chars long"
TEXTS = st.text(alphabet=st.sampled_from(list("aabeth ing\n\t'sdtre019.!*$\x1c\x85 éß٠日\U0001f600²½_")), max_size=80)


@pytest.fixture(scope="module")
def peer():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return ranks_encoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


@settings(max_examples=400, deadline=None)
@given(text=TEXTS)
def test_encoding_equals_the_library(own, peer, text):
    ids = own.encode(text)
    assert ids == peer.encode_ordinary(text)
    assert own.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(text=TEXTS, mark=st.booleans())
def test_counts_equal_the_library(text, mark):
    text = text[:40] + "<|endoftext|>" + text[40:] if mark else text
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    assert json_encoder(P.path("byte_bpe_50k.json"), P.PATTERN).table(text).total == len(library.encode(text, add_special_tokens=False).ids)


def test_long_runs_without_a_split(own, peer):
    for text in ("a" * 20_000, "ab" * 5_000, "日" * 3_000, "x " * 10, " " * 3_000 + "y"):
        assert own.encode(text) == peer.encode_ordinary(text)


def test_every_prefix_of_a_piece(own, peer):
    for piece in ("internationalisation", "aaaaaaaaaaaaaaab", "日本語"):
        counts = own.vocabulary.prefix_counts(piece.encode())
        for n in range(1, len(piece) + 1):
            assert counts[len(piece[:n].encode())] == len(peer.encode_single_piece(piece[:n].encode()) if hasattr(peer, "encode_single_piece") else peer._encode_single_piece(piece[:n].encode()))


def test_fit_is_the_longest_cut(own):
    table = own.table("The internationalisation of the unbelievable things 1234567 !!!")
    for budget in range(table.total + 2):
        cut = table.fit(budget)
        inside = [c for k in range(len(table.ends) - 1) for c in table.within(k)[1:]]
        assert cut == sum(1 for c in inside if c <= budget) or sorted(inside) != inside
        assert cut == len(table.text) or budget < table.total


def test_odd_rows(spark, odd, none):
    got = tokens.decode(tokens.encode(odd)).collect()
    assert len(got) == 8 and all(bytes(r.decoded) == (r.text or "").encode() for r in got)
    assert tokens.encode(none).count() == 0
    assert {r.token_count for r in tokens.count_tokens(odd).collect() if not r.text} == {0}
    clash = tokens.encode(odd.withColumnRenamed("lang", "Token_IDs"))
    assert clash.columns == ["doc_id", "text", "source", "n_chars", "token_ids"]


def test_queries(spark, peer, tmp_path):
    folder = saved(spark, tmp_path, documents=(DOC, [(1, "hello  world", "en", "a", 1), (2, None, None, None, None)]))
    rows = {r.doc_id: r for r in QUERIES["op4_bpe"](spark, folder).collect()}
    ids = peer.encode_ordinary("hello  world")
    assert rows[1].n_tokens == len(ids) and rows[1].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert rows[2].n_tokens == 0 and rows[2].ids_sha256 == rows[2].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    counts = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op7_token_counts"](spark, folder).collect()}
    assert counts == {1: (12, len(ids), False), 2: (0, 0, False)}
