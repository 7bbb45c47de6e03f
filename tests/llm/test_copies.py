"""Exact dedup, Jaccard components and suffix dedup against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SCHEMA, corpus, docs, empty
from reelcast.llm import chunk_dedup, jaccard_join, radix_dedup
from reelcast.llm.common import stage_table
from reelcast.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_exact_dedup_matches_brute_force(spark):
    groups = defaultdict(list)
    for i, text, *_ in corpus():
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), i))
    want = {}
    for norm, members in groups.items():
        keep = min(members)[1]
        for _, i in members:
            want[i] = (keep, len(members), i == keep, hashlib.sha256(norm.encode()).hexdigest())
    out = chunk_dedup.exact_dedup(docs(spark)).collect()
    assert len(out) == len(want)                      # rows repeated whole count once
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in out} == want
    assert chunk_dedup.exact_dedup(empty(spark)).count() == 0


def test_chunks_cover_the_text_and_equal_hashes_are_told_apart(spark):
    df = spark.createDataFrame([(1, "x" * 20000 + "Qa" + "y" * 3000), (2, "short"), (3, None)], "doc_id long, text string")
    rows = chunk_dedup.chunk_rows(df, "doc_id", "text").groupBy("id").agg(F.sum("size").alias("n")).collect()
    assert {r.id: r.n for r in rows} == {1: 23002, 2: 5, 3: 0}
    clash = spark.createDataFrame([(1, 0, 7, b"a", 1), (2, 0, 7, b"b", 1), (3, 0, 8, b"c", 1)],
                                  "id long, pos int, h64 long, digest binary, size int")
    ids = {r.id: bytes(r.chunk_id) for r in chunk_dedup.verified_ids(clash).collect()}
    assert ids[1] == b"a" and ids[2] == b"b" and ids[3] == (8).to_bytes(8, "big")


def brute_keep(rows):
    """Multiset of the (id, text) rows that stay."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), i is None, i or 0, i))
    return sorted(((min(g)[3], norm, -min(g)[0]) for norm, g in groups.items()), key=str)


def kept_rows(df):
    return sorted(((r.doc_id, re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), len(r.text or "")) for r in df.collect()), key=str)


def test_keep_first_leaves_one_row_of_equal_texts(spark):
    """Multisets of rows: repeated rows, shared ids, equal texts under one id, null ids and texts."""
    out = chunk_dedup.keep_first(docs(spark))
    assert out.columns == docs(spark).columns
    assert kept_rows(out) == brute_keep([(r[0], r[1]) for r in corpus()])
    rows = [(1, "a b c"), (1, "a b c"), (2, "abc"), (3, "q"), (3, "abc"), (4, "x y"), (4, "x\ny"), (4, "other"),
            (None, "z"), (None, "z"), (5, "z"), (None, "alone"), (None, "alone"), (6, None), (7, ""), (8, " "), (8, " ")]
    df = spark.createDataFrame([(i, t, None, None) for i, t in rows], SCHEMA).repartition(4)
    assert kept_rows(chunk_dedup.keep_first(df)) == brute_keep(rows)
    assert chunk_dedup.keep_first(empty(spark)).count() == 0


def test_keep_first_moves_no_text(spark):
    """Without repeated rows no exchange carries the text."""
    df = docs(spark, repeat=False)
    plan = chunk_dedup.keep_first(stage_table(df))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_jaccard_components_match_brute_force(spark):
    want = brute_components([(r[0], r[1]) for r in corpus()])
    out = jaccard_join.jaccard_components(docs(spark)).collect()
    assert len(out) == len(corpus()) + 2
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want
    assert len({want[i][1] for i in range(24, 34)}) == 1          # the near copies are one component
    assert jaccard_join.jaccard_components(empty(spark)).count() == 0


def test_jaccard_hub_group_and_threshold_border(spark):
    """A large group of near copies of which many do not link to each other, and pairs just at the threshold."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        w = list(base)
        for at in rng.choice(60, rng.integers(0, 4), replace=False):
            w[at] = f"u{rng.integers(0, 40)}"
        rows.append((i, " ".join(w)))
    for k in range(6, 14):                    # windows shifted against each other
        rows.append((1000 + k, " ".join(f"v{i}" for i in range(k, 50 + k))))
    df = spark.createDataFrame(rows + [(None, "w1 w2")], "doc_id long, text string").repartition(6)
    out = jaccard_join.jaccard_components(df).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out if r.doc_id is not None} == brute_components(rows)
    assert [r.component_id for r in out if r.doc_id is None] == [None]


def test_join_returns_every_link_inside_components(spark):
    """Links of a group of near copies, of which many do not link to each other, and of equal texts."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(60):
        w = [f"w{j}" for j in range(60)]
        for at in rng.choice(60, rng.integers(1, 3), replace=False):
            w[at] = f"u{rng.integers(0, 40)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, rows[i][1].upper()) for i in range(5)] + [(200, None), (201, "")]
    sets = {i: shingles(t) for i, t in rows}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i] or i, i)
    reps = sorted(i for s, i in first.items() if s in sets.values() and s)
    link = lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    want = {(a, b) for a in reps for b in reps if a < b and link(a, b)}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard_join.jaccard_links(df).collect()
    assert len(got) == len(want) > 150 and {(r.u, r.v) for r in got} == want
    out = {r.doc_id: (r.n_shingles, r.class_id, r.n_links) for r in jaccard_join.jaccard_join(df).collect()}
    assert out == {i: (len(s), first[s or i], sum(first[s or i] in pair for pair in want)) for i, s in sets.items()}


def test_prefix_choice_lengthens_for_common_shingles():
    rare, common = np.zeros(40), np.concatenate([np.zeros(5), np.full(35, 5000)])
    assert jaccard_join.choose_prefix(rare, 40)[0] == 1
    k, length = jaccard_join.choose_prefix(common, 40)
    assert k > 1 and length == 40 - 30 + k


def test_components_of_a_path(spark):
    path = spark.range(1, 40).select((F.col("id") - 1).alias("u"), F.col("id").alias("v"))
    out = connected_components(path).collect()
    assert len(out) == 40 and {r.label for r in out} == {0}
    assert connected_components(path.limit(0)).count() == 0


def brute_suffix(rows):
    seen, want = set(), {}
    for i, text in sorted((i, (t or "").encode()) for i, t in rows):
        gone = np.zeros(len(text), bool)
        for s in range(len(text) - 99):
            w = text[s:s + 100]
            if w in seen:
                gone[s:s + 100] = True
            seen.add(w)
        spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        kept = bytes(np.frombuffer(text, np.uint8)[~gone])
        want[i] = (len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return want


def test_suffix_dedup_matches_brute_force(spark):
    rows = [(r[0], r[1]) for r in corpus()]
    passage = rows[7][1][:220]
    rows += [(100 + i, f"é{i} " * (3 + i) + passage[i:200 + i] + f" end{i}") for i in range(8)]
    rows += [(200, "ab" * 300), (201, "x" * 100), (202, "x" * 99), (203, "x" * 101)]
    df = spark.createDataFrame([(i, t, None, None) for i, t in rows], SCHEMA).repartition(4)
    out = radix_dedup.suffix_dedup(df).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == brute_suffix(rows)
    assert len(radix_dedup.suffix_dedup(docs(spark)).collect()) == len(corpus()) + 2
    assert radix_dedup.suffix_dedup(empty(spark)).count() == 0


def test_suffix_dedup_passages_in_changing_company(spark):
    """Passages cut at every length around the depth, with and without equal bytes before and behind, and null ids."""
    rng = np.random.default_rng(12)
    passage = "".join(rng.choice(list("abcdefghij "), 400))
    tail = "".join(rng.choice(list("abcdefghij "), 60))
    rows = [(0, "start " + passage + tail)]
    for i in range(1, 60):
        a, n = int(rng.integers(0, 300)), int(rng.integers(30, 200))
        rows.append((i, f"{i} " + passage[a:a + n] + (tail if i % 3 else str(i)) + "z" * int(rng.integers(0, 120))))
    want = brute_suffix(rows)
    df = spark.createDataFrame([(i, t, None, None) for i, t in rows], SCHEMA).repartition(5)
    out = radix_dedup.suffix_dedup(df).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == want
    assert 10 < sum(w[1] > 0 for w in want.values()) < 59
    last = spark.createDataFrame([(None, rows[0][1], None, None), (0, rows[0][1], None, None), (0, "short", None, None)], SCHEMA)
    got = {(r.doc_id, r.n_bytes): r.n_removed for r in radix_dedup.suffix_dedup(last).collect()}
    n = len(rows[0][1])
    assert got == {(None, n): n, (0, n): 0, (0, 5): 0}


@pytest.mark.parametrize("n", [100, 101, 173, 400])
def test_run_classes_cover_every_window_once(n):
    rng = np.random.default_rng(n)
    data = rng.integers(97, 100, n).astype(np.uint8)
    _, at, count, _, _ = radix_dedup.window_runs(data, np.array([0, n]))
    anchor = radix_dedup._anchors(radix_dedup._hashers()[0].prefix(data), 100, 32)[1][at]
    run, cls, first, some = radix_dedup.run_classes(at, count, anchor)
    starts = [s for a, c in zip(first, some) for s in range(a, a + c)]
    assert sorted(starts) == list(range(n - 99))
    for r, c, a, m in zip(run, cls, first, some):
        assert all(min((anchor[r] - s) // radix_dedup.STEP, 4) == c for s in range(a, a + m))


@pytest.mark.parametrize("n", [100, 101, 173, 400])
def test_window_runs_cover_every_window_once(n):
    rng = np.random.default_rng(n)
    data = rng.integers(97, 100, n).astype(np.uint8)
    text, at, count, _, _ = radix_dedup.window_runs(data, np.array([0, n]))
    starts = np.concatenate([np.arange(a, a + c) for a, c in zip(at, count)])
    assert sorted(starts.tolist()) == list(range(n - 99))
