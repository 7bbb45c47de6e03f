"""SimHash components against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_fixtures import SCHEMA, corpus, docs, empty, words
from reelcast.llm import simhash_anchors as S
from reelcast.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def brute_components(nodes):
    """{node: smallest node reachable by steps of 3 bits or fewer} of (node, fingerprint)."""
    parent = {n: n for n, _ in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(nodes):
        for b, y in nodes[:i]:
            if (x ^ y).bit_count() <= 3:
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {n: find(n) for n in parent}


def test_components_match_brute_force(spark):
    rng = random.Random(11)
    rows = list(corpus())
    long = words(rng, 700).split(" ")
    for i in range(100, 125):                             # near copies: fingerprints a few bits apart
        w = list(long)
        for _ in range(rng.randrange(1, 6)):
            w[rng.randrange(len(w))] = f"new{i}"
        rows.append((i, " ".join(w).upper() if i % 5 == 0 else " ".join(w), "en", "h"))
    fps = {r[0]: brute_fingerprint(r[1]) for r in rows}
    want = brute_components(sorted(fps.items()))
    df = docs(spark, rows)
    for block_rows in (S.BLOCK_ROWS, 3):                  # one block an anchor, and hot anchors split
        got = S.simhash_components(df, block_rows=block_rows).collect()
        assert len(got) == len(rows) + 2
        assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
            i: (f"{x:016x}", want[i]) for i, x in fps.items()}
    assert len({want[i] for i in (36, 37, 38)}) == 1      # texts without words are linked
    assert len(set(want.values())) < len(fps) - 10
    assert S.simhash_components(empty(spark)).count() == 0


def test_null_ids_take_part(spark):
    df = spark.createDataFrame([(None, "a b c d", None, None), (7, "A b c d", None, None), (None, "other", None, None)], SCHEMA)
    got = {(r.doc_id, r.component_id) for r in S.simhash_components(df).collect()}
    assert got == {(None, 7), (7, 7), (None, None)}


@pytest.mark.parametrize("block_rows", [1 << 14, 5])
def test_links_connect_what_brute_force_connects(spark, block_rows):
    """Dense groups around a few centres, chains, fingerprints that are anchors themselves, top bits of the halves."""
    rng = np.random.default_rng(2)
    fps = {0, (1 << 64) - 1, 1 << 31, 1 << 63, (1 << 31) | (1 << 63)}
    for centre in rng.integers(0, 2**63, 6).tolist() + [0]:
        for _ in range(60):
            x = centre
            for b in rng.choice(64, rng.integers(0, 7), replace=False).tolist():
                x ^= 1 << b
            fps.add(x)
    x = 12345
    for b in range(0, 60, 3):                             # a chain, every step three bits
        x ^= 0b111 << b
        fps.add(x)
    want = brute_components([(f, f) for f in sorted(fps)])
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(4)
    edges = S.links(df, block_rows)
    for r in edges.collect():
        assert ((r.u ^ r.v) & (2**64 - 1)).bit_count() <= 3
    labels = {r.node & (2**64 - 1): r.label for r in connected_components(edges).collect()}
    for a in fps:
        assert (a in labels) == any(want[b] == want[a] and b != a for b in fps)
    groups = {}
    for a in labels:
        groups.setdefault(labels[a], set()).add(want[a])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({want[a] for a in labels})


def test_anchors_cover(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 1 << 31, 3000, dtype=np.uint64)
    x[:50] = S.home_anchors(x[:50])
    home = S.home_anchors(x)
    assert (np.bitwise_count(home ^ x) <= 1).all() and (S.syndromes(home) == 0).all()
    for bit in [None, *range(31)]:
        y = x if bit is None else x ^ np.uint64(1 << bit)
        rows, anchors = S.near_anchors(y)
        assert np.bincount(rows, minlength=len(x)).max() <= 16
        assert (np.bitwise_count(anchors ^ y[rows]) <= 2).all()
        near = set(zip(rows.tolist(), anchors.tolist()))
        assert all((i, a) in near for i, a in enumerate(home.tolist()))


def test_long_texts_are_cut_into_pieces(monkeypatch):
    text = words(random.Random(1), 3000) + " \n\t" + "x" * 300 + " end"
    whole = S.fingerprint(text.encode())
    monkeypatch.setattr(S, "PIECE_BYTES", 64)
    assert S.fingerprint(text.encode()) == whole == brute_fingerprint(text)
    assert S.fingerprint(b"One two") == brute_fingerprint("one two") != 0
    assert S.fingerprint(b" \n") == S.fingerprint(b"") == 0
