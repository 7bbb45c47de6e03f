"""Bounded title search: the same rows as counting every (query, title) pair, from fewer pairs."""

import random

import pytest
from pyspark.sql import functions as F

from reelcast.operators import search as SE


def tables(spark, seed, n=400):
    """Skewed tokens: a few in almost every title, many rare ones; ties at the cut; repeated ids; nulls."""
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    titles = [(i, rng.choices(names, weights, k=rng.randrange(0, 25))) for i in range(n)]
    titles += [(3, ["w1", "w50"]), (n, None), (n + 1, ["only"]), (n + 2, ["12", "34"])]
    queries = [(i, rng.choices(names, k=rng.randrange(1, 18))) for i in range(12)]
    queries += [(20, ["absent"]), (21, []), (22, None), (23, ["12", "w0"]), (24, ["12"])]
    t = spark.createDataFrame(titles, "tid long, words array<string>").repartition(4)
    q = spark.createDataFrame(queries, "qid long, words array<string>")
    return titles, queries, t, q


def brute(titles, queries, k):
    sets = {}
    for i, w in titles:
        sets.setdefault(i, set()).update(w or [])
    out = set()
    for qid, w in queries:
        hits = []
        for i, s in sets.items():
            both = sorted(s & set(w or []))
            if any("w" in t for t in both):
                hits.append((-len(both), i, " ".join(both)))
        out |= {(qid, i, -c, words, r) for r, (c, i, words) in enumerate(sorted(hits)[:k], 1)}
    return out


@pytest.mark.parametrize("seed,k", [(1, 5), (2, 1), (3, 50), (4, 1000)])
def test_equals_counting_every_pair(spark, seed, k):
    titles, queries, t, q = tables(spark, seed)
    got = {(r.query_id, r.movie_id, r.num, r.words, r.sort) for r in SE.title_search(q, t, "[a-z]", k).collect()}
    assert got == brute(titles, queries, k)


def test_bounds_leave_pairs_out(spark):
    titles, queries, t, q = tables(spark, 5, 3000)
    tokens = SE.query_tokens(q)
    short = SE.short_titles(t, tokens)
    rich = short.select(F.percentile_approx(F.size("tokens"), 0.98)).first()[0]
    bounds = SE.kth_counts(tokens, short.where(F.size("tokens") >= rich), "[a-z]", 5)
    assert bounds.count() > 8
    exact = SE.kth_counts(tokens, short, "[a-z]", 5)
    assert bounds.withColumnRenamed("bound", "low").join(exact, "query_id").where("low > bound").count() == 0
    pairs = short.select("movie_id", F.explode("tokens").alias("token")).join(tokens, "token").select(
        "query_id", "movie_id").distinct()
    candidates = SE.bounded_candidates(tokens, short, bounds)
    assert candidates.exceptAll(pairs).count() == 0
    assert candidates.count() < pairs.count() / 3


def test_empty_sides(spark):
    _, _, t, q = tables(spark, 6)
    assert SE.title_search(q.limit(0), t, "[a-z]").count() == 0
    assert SE.title_search(q, t.limit(0), "[a-z]").count() == 0
