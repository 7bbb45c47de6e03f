"""Size-bounded clusters, their cost, and exact neighbours that skip clusters."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from reelcast.operators import clusters as CL
from reelcast.operators import vectors as V
from reelcast.plans import star as S

SCHEMA = "cate_id string, movie_id long, vec array<double>"


def grouped(seed=1, centres=16, each=30, dim=16):
    """Two channels of tight groups, one of equal vectors, one of a single item; null and zero vectors, a null channel."""
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for ch in ("a", "b"):
        for c in rng.normal(size=(centres, dim)):
            for _ in range(each):
                rows.append((ch, i, (c * rng.uniform(0.5, 3) + rng.normal(size=dim) * 0.05).tolist()))
                i += 1
    rows += [("same", 10_000 + j, [1.0] * dim) for j in range(90)]
    rows += [("one", 20_000, [1.0] + [0.0] * (dim - 1)), ("a", 20_001, [0.0] * dim), ("a", 20_002, None),
             (None, 20_003, [1.0] * dim)]
    return rows


def brute(rows, k, digits=4):
    by = defaultdict(list)
    for ch, i, v in rows:
        if ch is not None and v is not None and any(v):
            by[ch].append((i, np.array(v)))
    out = set()
    for members in by.values():
        ids = np.array([i for i, _ in members])
        u = np.stack([v / np.linalg.norm(v) for _, v in members])
        s = np.round(u @ u.T, digits) + 0.0
        for at, i in enumerate(ids):
            order = [j for j in np.lexsort((ids, -s[at])) if j != at][:k]
            out |= {(int(i), int(ids[j]), float(s[at, j]), r) for r, j in enumerate(order, 1)}
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(grouped(), SCHEMA).repartition(5)


def test_clusters_are_bounded_and_cost_is_theirs(spark, frame):
    state = CL.split_clusters(frame, ["cate_id"], 40)
    rows = state.collect()
    assert sorted(r.movie_id for r in rows) == sorted(
        i for ch, i, v in grouped() if ch is not None and v is not None and any(v))
    sizes = Counter((r.cate_id, r.node) for r in rows)
    assert max(sizes.values()) <= 40
    members = defaultdict(list)
    for r in rows:
        members[r.cate_id, r.node].append(np.array(r.vec) / np.linalg.norm(r.vec))
    want = defaultdict(float)
    for (ch, _), m in members.items():
        want[ch] += float(((np.stack(m) - np.mean(m, axis=0)) ** 2).sum())
    got = {r.cate_id: r for r in CL.clustering_cost(state, ["cate_id"]).collect()}
    assert {c: r.clusters for c, r in got.items()} == Counter(ch for ch, _ in sizes)
    for ch, r in got.items():
        assert r.cost == pytest.approx(want[ch], abs=1e-3) and r.largest == max(n for (c, _), n in sizes.items() if c == ch)
    # tight groups are found: far below the cost of one cluster a channel
    whole = {r.cate_id: r.cost for r in CL.clustering_cost(state.withColumn("node", F.lit("")), ["cate_id"]).collect()}
    assert got["a"].cost < whole["a"] / 10
    again = CL.split_clusters(frame.repartition(2), ["cate_id"], 40).collect()
    assert {(r.movie_id, r.node) for r in again} == {(r.movie_id, r.node) for r in rows}      # no random start


@pytest.mark.parametrize("k,max_size", [(5, 40), (40, 24)])
def test_neighbours_equal_brute_force(spark, frame, k, max_size):
    got = CL.nearest_by_clusters(frame, ["cate_id"], k, max_size).collect()
    assert {(r.movie_id, r.movie_id2, r.cos_sim + 0.0, r.sort_num) for r in got} == brute(grouped(), k)


def test_clusters_are_skipped(spark, frame):
    visits = []
    CL.nearest_by_clusters(frame, ["cate_id"], 5, 40, visits=visits).count()
    state = CL.split_clusters(frame, ["cate_id"], 40)
    n = {r.cate_id: (r.n, r.c) for r in state.groupBy("cate_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("node").alias("c")).collect()}
    seen = {r.cate_id: r["count"] for r in visits[0].groupBy("cate_id").count().collect()}
    for ch in ("a", "b"):
        assert seen.get(ch, 0) < n[ch][0] * n[ch][1] / 8           # all pairs would be items x clusters


def test_empty_vectors(spark, frame):
    assert CL.nearest_by_clusters(frame.limit(0), ["cate_id"], 5).count() == 0
    assert CL.clustering_cost(CL.split_clusters(frame.limit(0), ["cate_id"]), ["cate_id"]).count() == 0


def test_recall_from_own_vectors(spark):
    """The chain's neighbours are those of its own clusters, and recall returns only them."""
    chain = S.vector_chain(spark, SF001)
    items = chain["vectors"].collect()
    assert items and {len(r.vec) for r in items} == {100}
    state = chain["clusters"].collect()
    label = {r.movie_id: (r.cate_id, r.node) for r in state}
    want = brute([("/".join(label[r.movie_id]), r.movie_id, list(r.vec)) for r in items if r.movie_id in label], 100)
    got = {(r.movie_id, r.movie_id2, r.cos_sim + 0.0, r.sort_num) for r in chain["neighbours"].collect()}
    assert got == want
    pairs = {(a, b) for a, b, _, _ in want}
    final = chain["final"].collect()
    assert all((r.movie_id, r.movie_id2) in pairs for r in final)


def test_item_vectors_are_weighted_means(spark):
    """item_vector by hand: the mean of the distinct weighted word vectors, words without a vector left out."""
    tw = spark.createDataFrame([(1, "a", "x", 2.0), (1, "a", "y", 1.0), (1, "a", "z", 1.0), (1, "a", "none", 9.0),
                                (2, "b", "x", 0.5)], "movie_id long, cate_id string, topic string, weight double")
    wv = spark.createDataFrame([("x", [1.0, 2.0]), ("y", [2.0, 4.0]), ("z", [0.0, 3.0])], "word string, vec array<double>")
    got = {r.movie_id: (r.cate_id, list(r.vec)) for r in V.item_vector(tw, wv).collect()}
    # x twice and y once are the same vector and count once
    assert got == {1: ("a", [1.0, 3.5]), 2: ("b", [0.5, 1.0])}


@pytest.mark.parametrize("threshold", [0.3, 1.2, 50.0])
def test_within_distance_misses_none(spark, threshold):
    rows = [(i, v) for ch, i, v in grouped(seed=7, centres=12, each=12, dim=6) if v is not None]
    df = spark.createDataFrame(rows, "movie_id long, vec array<double>").repartition(3)
    got = {(r.movie_id, r.movie_id2, r.sort_num) for r in V.within_distance(
        df.union(spark.createDataFrame([(99_999, None)], df.schema)), threshold, k=4).collect()}
    ids = np.array([i for i, _ in rows])
    m = np.array([v for _, v in rows])
    d2 = np.round(np.maximum((m * m).sum(1)[:, None] + (m * m).sum(1)[None] - 2 * m @ m.T, 0), 4)
    want = set()
    for at, i in enumerate(ids):
        order = [j for j in np.lexsort((ids, d2[at])) if j != at and d2[at, j] <= round(threshold ** 2, 4)][:4]
        want |= {(int(i), int(ids[j]), r) for r, j in enumerate(order, 1)}
    assert got == want and want
    assert V.within_distance(df.limit(0), threshold).count() == 0
