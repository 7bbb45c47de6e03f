"""What grows with the tables: rows that leave a block pair, passes over a text, what comes to the driver."""

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from reelcast.functions import text as TX
from reelcast.operators import embeddings as EM
from reelcast.operators import pq
from reelcast.operators import text as TO
from reelcast.operators import vectors as V

DOC = "movie_id long, cate_id string, summary string"
TEXTS = [(1, "a", "red ring red 12 of the 漢字漢字 ring x"), (2, None, "of"), (3, "b", "x"), (4, "b", None), (5, "b", ""),
         (1, "a", "red ring"), (6, "c", "漢字 漢 12a éa été"), (7, "c", "漢字漢")]


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_block_pairs_return_few_rows(spark):
    """A query's K rows leave once for a block of the other side: 2,500 rows are one block."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2500, 4))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "movie_id long, vec array<double>")
    assert V.block_topk(v, v, [], 3, "l2", final_topk=False).count() == 2500 * 3


def test_slices_keep_ties_and_order():
    ids = np.array([9, 4, 7, 1])
    key = np.array([[0.5, 0.5, 0.1, 0.5], [np.inf, np.inf, 3.0, np.inf], [np.inf] * 4])
    row, at = V._best(key, ids, 3)
    assert list(zip(row.tolist(), ids[at].tolist())) == [(0, 7), (0, 1), (0, 4), (1, 7)]


def test_sliced_scores_are_those_of_one_piece(monkeypatch):
    rng = np.random.default_rng(2)
    f = pd.DataFrame({"movie_id": np.arange(40), "vec": list(np.round(rng.normal(size=(40, 3)), 1))})
    whole = V._block_scorer("cosine", 5, True, 2, [])(f, f)
    monkeypatch.setattr(V, "SLICE_CELLS", 90)
    assert V._block_scorer("cosine", 5, True, 2, [])(f, f).equals(whole) and len(whole) == 200


def test_terms_read_a_text_once(spark):
    """The token rules are a compiled filter on rows; no filter tokenises the text a second time."""
    docs = spark.createDataFrame(TEXTS, DOC)
    lines = [x for x in plan(TO.text_terms(docs)).splitlines() if "Filter" in x]
    assert lines and not any("regexp_extract_all" in x for x in lines)
    want = Counter()
    for r in docs.select("movie_id", "cate_id", TX.tokenize_words("summary").alias("w")).collect():
        want.update((r.movie_id, r.cate_id, w) for w in r.w or [])
    got = {(r.movie_id, r.cate_id, r.keyword): r.tf for r in TO.text_terms(docs).collect()}
    assert got == dict(want) and (2, None, "of") in got and (1, "a", "漢字") in got and (1, "a", "字漢") in got


def test_edges_are_counted_in_one_pass(spark):
    docs = spark.createDataFrame(TEXTS, DOC)
    edges = TO.textrank_edges(docs, span=3)
    assert "Union" not in plan(edges)
    want = Counter()
    for r in docs.collect():
        toks = docs.sparkSession.createDataFrame([(r.summary,)], "s string").select(TX.raw_tokens("s").alias("t"),
            F.transform(TX.raw_tokens("s"), lambda t: TX.keep_token(t) & (F.length(t) >= 2)).alias("k")).first()
        for i in range(len(toks.t or [])):
            for j in range(i + 1, min(i + 3, len(toks.t))):
                if toks.k[i] and toks.k[j]:
                    want[r.movie_id, r.cate_id, toks.t[i], toks.t[j]] += 1
                    want[r.movie_id, r.cate_id, toks.t[j], toks.t[i]] += 1
    assert want and {(r.movie_id, r.cate_id, r.a, r.b): r.w for r in edges.collect()} == dict(want)


def test_block_means():
    """Each word once for its block, slices of pairs summed; pairs without a vector count for nothing."""
    pairs = pd.DataFrame({"ia": [1, 2, 1, 3], "ib": [2, 1, 3, 9], "w": [1.0, 2.0, 3.0, 1.0]})
    vectors = pd.DataFrame({"id": [1, 2, 3], "vec": [np.array([1.0, 0.0]), np.array([0.0, 4.0]), np.array([4.0, 0.0])]})
    EM.SLICE_PAIRS, held = 1, EM.SLICE_PAIRS
    try:
        out = EM._means(pairs, vectors)
    finally:
        EM.SLICE_PAIRS = held
    assert {i: v.tolist() for i, v in zip(out["id"], out["_v"])} == {1: [3.0, 1.0], 2: [1.0, 0.0]}


def test_sample_is_the_rows_of_smallest_hash(spark, monkeypatch):
    monkeypatch.setattr(pq, "SAMPLE", 50)
    u = spark.range(6000).select(F.col("id").alias("movie_id"), F.array(F.col("id") + 0.5, F.lit(1.0)).alias("vec"))
    want = [list(r.vec) for r in u.orderBy(F.xxhash64("movie_id"), "movie_id").limit(50).collect()]
    assert pq.sample(u, 6000).tolist() == want
    same = spark.range(500).select(F.lit(7).cast("long").alias("movie_id"), F.array(F.lit(1.0)).alias("vec"))
    assert len(pq.sample(same, 500)) == 50                  # one id: its hash says nothing of how many there are


def test_edges_are_not_moved(spark):
    """Texts that share their keys meet before they are counted; no edge goes through an exchange."""
    docs = spark.createDataFrame(TEXTS + [(1, "a", "ring blue"), (2, None, "red ring"), (2, None, "ring red ring")], DOC).repartition(5)
    edges = TO.textrank_edges(docs, span=3)
    assert "Aggregate" not in plan(edges)
    got = {(r.movie_id, r.cate_id, r.a, r.b): r.w for r in edges.collect()}
    assert len(got) == edges.count()
    assert got[2, None, "red", "ring"] == 3.0 and got[1, "a", "ring", "blue"] == 1.0 and got[1, "a", "red", "ring"] == 3.0
