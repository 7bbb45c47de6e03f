"""Ranked search against exhaustive scoring."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import SCHEMA, corpus, docs, empty, words
from reelcast.llm import block_max_search as S

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(rows, items, top):
    """[(item, rank, doc, score)] of (doc_id, text) rows and distinct (item, text)."""
    bags = [(i, Counter(terms(t))) for i, t in rows]
    bags = [(i, c, sum(c.values())) for i, c in bags if c]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in bags:
            m = 100 - 50 + (50 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0))
        out += [(item, k, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(found)[:top], 1)]
    return out


ITEMS = [(1, "Alphas beta GAMMAing? the the; omega-x"), (2, None), (3, " .,; "), (4, "unknownword"),
         (5, "one two three alpha"), (6, "the etas zetaed sigma kappa delta"), (6, "文字 é 🙂 wort"), (None, "betaing the alpha")]


@pytest.mark.parametrize("sizes", [dict(), dict(shard_docs=4, query_bytes=60)])
def test_search_matches_exhaustive_scoring(spark, monkeypatch, sizes):
    """Nulls, empty and long texts, ties, repeated rows and items, several shards and query batches."""
    rows = corpus() + [(None, "alpha beta the", None, None), (500, "alpha beta the", None, None)]
    df = docs(spark, rows)
    items = spark.createDataFrame(ITEMS + ITEMS[:1], "item_id long, text string").withColumn("q", F.lit(1)).withColumn(
        "rank", F.lit(0))
    plain = [(r.doc_id, r.text) for r in df.collect()]
    got = [(r.item_id, r.rank, r.doc_id, r.score) for r in S.ranked_search(df, items, top=7, **sizes).collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(brute(plain, ITEMS, 7), key=key)
    assert S.ranked_search(empty(spark), items).count() == 0
    assert S.ranked_search(df, items.limit(0)).count() == 0


def test_long_text_by_pieces(monkeypatch):
    text = words(random.Random(3), 4000) + " ;" + "x" * 500
    want = terms(text)
    monkeypatch.setattr(S, "PIECE_BYTES", 100)
    assert [w.decode() for part in S.terms_of(text.encode()) for w in part] == want


def test_corpus_size_counts_terms_at_borders(spark):
    texts = ["ab", "cd ef", None, "", "..", "é1", "x", "y "]
    df = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], SCHEMA).coalesce(1)
    assert S.corpus_size(df) == (5, 6)


def test_packed_integers_round_trip():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**31, 2**40, 5])
    data, ends = S.pack(values)
    assert (S.unpack(data) == values).all() and ends[-1] == len(data) and (data[ends - 1] < 128).all()
    assert len(S.unpack(S.pack(np.zeros(0, np.int64))[0])) == 0


def test_block_maxima_reject_before_unpacking():
    """Top documents equal exhaustive scoring while most blocks of the common terms stay packed."""
    rng = np.random.default_rng(6)
    n, size = 4000, (4000, 4000 * 60)
    lengths = rng.integers(5, 120, n)
    hits = []
    for term, share in ((1, 0.9), (2, 0.7), (3, 0.02), (4, 0.5)):
        at = np.flatnonzero(rng.random(n) < share)
        hits.append(np.int64(term) << 32 | np.repeat(at, rng.geometric(0.6, len(at))))
    rows = S.shard_rows(0, list(range(n)), lengths, np.concatenate(hits), size).to_pylist()
    norm = np.frombuffer(rows[0]["payload"], np.int64)
    weight = {1: 100, 2: 300, 3: 4000, 4: 700}
    lists = [(weight[r["term"]], S.Postings(r["last"], r["peak"], r["ends"], r["payload"], norm)) for r in rows[1:]]
    whole = np.zeros(n, np.int64)
    for r, (w, _) in zip(rows[1:], lists):
        d, s = S.Postings(r["last"], r["peak"], r["ends"], r["payload"], norm).whole()
        whole[d] += w * s
    want = np.lexsort((np.arange(n), -whole))[:10]
    docs_, scores = S.search_shard(lists, n, 10, 0, np.arange(n), window=100)
    assert docs_.tolist() == want.tolist() and scores.tolist() == whole[want].tolist()
    primed = [(w, S.Postings(r["last"], r["peak"], r["ends"], r["payload"], norm)) for r, (w, _) in zip(rows[1:], lists)]
    docs_, _ = S.search_shard(primed, n, 10, int(whole[want[-1]]), np.arange(n), window=100)
    assert docs_.tolist() == want.tolist()
    blocks = sum(len(p.last) for _, p in primed)
    assert sum(p.unpacked for _, p in primed) < blocks / 2
