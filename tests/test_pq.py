"""Product-quantised neighbours: codes, tables, and recall against the exact search."""

import numpy as np
import pytest

from conftest import SF001
from reelcast.operators import pq
from reelcast.operators import vectors as V
from reelcast.plans import star as S
from reelcast.session import stage_table

SCHEMA = "movie_id long, vec array<double>"


@pytest.fixture(scope="module")
def units(spark):
    return stage_table(pq.unit_vectors(S.item_vectors(spark, SF001)))


@pytest.mark.parametrize("kind", ["given", "grouped"])
def test_recall_is_at_least_nine_in_ten(spark, units, kind):
    if kind == "given":
        v = units
    else:
        rng = np.random.default_rng(3)
        centres = rng.normal(size=(12, 24))
        x = centres[rng.integers(0, 12, 900)] + rng.normal(size=(900, 24)) * 0.3
        v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], SCHEMA).repartition(3)
    found = stage_table(pq.pq_neighbours(v, k=10))
    truth = stage_table(V.block_topk(v, v, [], 10, "cosine"))
    assert pq.recall_at(found, truth) >= 0.9
    scores = {(r.movie_id, r.movie_id2): r.score for r in truth.collect()}
    for r in found.collect():                              # candidates are scored exactly
        if (r.movie_id, r.movie_id2) in scores:
            assert r.cos_sim == pytest.approx(scores[r.movie_id, r.movie_id2], abs=1.1e-4)


def test_codes_are_short_and_tables_add_up(spark, units):
    books = pq.fit_books(units)
    assert books.bytes_per_vector == 16
    index = pq.encode(units, books).collect()
    assert len(index) == units.count() and {len(r.vec) for r in index} == {16}
    vec = {r.movie_id: np.array(r.vec) for r in units.collect()}
    whole = {r.movie_id: np.concatenate([b[c] for b, c in zip(books.codes, r.vec)]) for r in index}
    some = sorted(vec)[:6]
    lists = spark.createDataFrame([(0, i, vec[i].tolist()) for i in some], "list_id int, movie_id long, vec array<double>")
    stored = spark.createDataFrame([(0, r.movie_id, bytes(r.vec)) for r in index], "list_id int, movie_id long, vec binary")
    near = V.block_topk(lists, stored, ["list_id"], 5, "cosine", scorer=pq._table_scorer(books, 5)).collect()
    assert len(near) == 30
    for r in near:
        assert r.score == pytest.approx(float(vec[r.movie_id] @ whole[r.movie_id2]))
    for i in some:
        best = sorted((-float(vec[i] @ w), j) for j, w in whole.items() if j != i)[:5]
        assert sorted(r.movie_id2 for r in near if r.movie_id == i) == sorted(j for _, j in best)


def test_same_seed_gives_the_same_result(spark, units):
    a, b = (sorted(map(tuple, pq.pq_neighbours(units.repartition(n), k=3).collect())) for n in (2, 5))
    assert a == b


def test_odd_tables(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [0.0, 2.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.movie_id, r.movie_id2, r.cos_sim) for r in pq.pq_neighbours(df, k=2).collect()}
    assert got == {(1, 2, 1.0), (2, 1, 1.0), (1, 5, 0.0), (2, 5, 0.0), (5, 1, 0.0), (5, 2, 0.0)}
    assert pq.pq_neighbours(df.limit(0), k=2).count() == 0


def test_a_query_and_its_candidates_leave_once_a_shelf(spark, units, monkeypatch):
    """Rows that leave a search grow with queries x shelves, not with queries x lists x candidates."""
    books = pq.fit_books(units, lists=20)
    index = stage_table(pq.encode(units, books))
    n = units.count()
    assert pq._search(units, index, books, 20, 50, 3).count() == 3 * n            # 20 lists, one shelf
    truth = {(r.movie_id, r.movie_id2) for r in V.block_topk(units, units, [], 3, "cosine").collect()}
    monkeypatch.setattr(pq, "SHELF", 60)                                          # many shelves, some lists on several
    got = pq.nearest(units, index, books, 20, 60, 3).collect()
    assert {(r.movie_id, r.movie_id2) for r in got} == truth                      # all lists, all candidates: exact


def test_shelves_hold_every_list():
    first, parts = pq._shelves({0: 3, 1: 4, 2: 25, 3: 2, 5: 9}, 6, 10)
    assert first.tolist() == [0, 0, 1, 4, 4, 5] and parts.tolist() == [1, 1, 3, 1, 1, 1]


def test_unit_takes_the_length_once(spark):
    """The length is no part of the lambda, which runs for every number of the vector."""
    from reelcast.operators.clusters import unit
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None)], SCHEMA).select("movie_id", unit("vec").alias("u"))
    assert {r.movie_id: r.u for r in df.collect()} == {1: [0.6, 0.8], 2: None, 3: None}
    text = df._jdf.queryExecution().analyzed().toString()
    assert "transform(" not in text and "array_repeat(" in text
