"""Fingerprints and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from cliniform.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=3):
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = sorted(parent)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            if (a ^ b).bit_count() <= distance and root(a) != root(b):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {p: root(p) for p in names}


def near(seed, centres, copies, bits):
    draw = random.Random(seed)
    out = set()
    for _ in range(centres):
        base = draw.getrandbits(64)
        for _ in range(copies):
            x = base
            for b in draw.sample(range(64), draw.randint(0, bits)):
                x ^= 1 << b
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("centres,copies,bits", [(1, 400, 3), (30, 20, 6), (500, 1, 0), (3, 200, 12)])
def test_index_finds_all_classes(centres, copies, bits):
    prints = near(centres, centres, copies, bits)
    index = simhash.GrayIndex(np.array(prints, np.uint64))
    members, own = index.members.tolist(), index.classes(3)
    want, got = brute_components(prints), {}
    for m, c in zip(members, own.tolist(), strict=True):
        got.setdefault(members[c], set()).add(m)
    classes = {}
    for m, r in want.items():
        classes.setdefault(r, set()).add(m)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, classes.values()))


@pytest.mark.parametrize("most", [4, 64, 512])
def test_refiling_large_groups_loses_no_link(spark, most):
    prints = near(9, 6, 60, 5)
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "bits long")
    found = simhash.components(simhash.links(simhash.groups(frame, most)))
    got = {r.node % (1 << 64): r.root for r in found.collect()}
    want = brute_components(prints)
    same = lambda labels: sorted(sorted(p for p in prints if labels(p) == x) for x in {labels(p) for p in prints})
    assert same(lambda p: got.get(p, p - (1 << 64) if p >> 63 else p)) == same(lambda p: want[p])


def test_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_odd_rows(spark, odd, none):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 8
    by_id = {r.doc_id: r for r in rows}
    text = {r.doc_id: r.text for r in odd.collect()}
    assert all(r.bits % (1 << 64) == plain_fingerprint(text[r.doc_id]) for r in rows)
    assert by_id[2].bits == by_id[3].bits == by_id[4].bits == 0 and by_id[4].component_id == 2
    assert by_id[None].component_id is None
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.representatives(odd.withColumnRenamed("lang", "_bits"))
    assert kept.columns == ["doc_id", "text", "_bits", "source", "n_chars"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "5", "7", "None"]


@pytest.mark.parametrize("members,free", [(3000, 21), (4000, 25), (500, 14), (17, 8), (1, 3)])
def test_groups_of_the_last_level_equal_brute_force(members, free):
    bits = np.unique(np.random.default_rng(members).integers(0, 1 << free, members).astype(np.uint64))
    index = simhash.GrayIndex(bits)
    classes = {}
    for member, root in brute_components(bits.tolist()).items():
        classes.setdefault(root, set()).add(member)
    got = {}
    for member, own in zip(index.members.tolist(), index.classes(3).tolist(), strict=True):
        got.setdefault(own, set()).add(member)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, classes.values()))


def test_a_dense_group_is_one_class_and_a_code_is_none():
    dense = np.random.default_rng(1).choice(1 << 21, 1 << 18, replace=False).astype(np.uint64)
    assert not simhash.GrayIndex(dense).classes(3).any()
    words = np.arange(1 << 16, dtype=np.uint64)
    check = np.zeros(len(words), np.uint64)
    for bit in range(16):
        check ^= np.where(words >> np.uint64(bit) & np.uint64(1), np.uint64(bit + 1), np.uint64(0))
    code = words[(check == 0) & (np.bitwise_count(words) % 2 == 0)]  # any two differ in four bits or more
    assert len(np.unique(simhash.GrayIndex(code).classes(3))) == len(code)
