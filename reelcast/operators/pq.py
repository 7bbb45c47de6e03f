"""Approximate neighbours by product quantisation: short codes, table look-ups, exact re-ranking.

Unit vectors are cut into ``parts`` pieces, each coded by the nearest of at most 256 centres of its own codebook, so a
stored vector is ``parts`` bytes (16 for the default) beside its id, instead of 8 bytes a dimension.  Items are stored
in the nearest of ``lists`` coarse lists.  A query visits its ``probes`` nearest lists; there the dot product with a
code is a sum of ``parts`` table entries.  The best ``rerank`` candidates are scored exactly.

Codebooks and coarse centres are fitted on at most ``SAMPLE`` rows (the documented bound, by hash of the id); every
row is coded and searched.  ``tune`` measures on a bounded number of queries how many lists and candidates a wanted
recall takes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcast import config as C
from reelcast.operators import vectors as V
from reelcast.operators.clusters import unit
from reelcast.operators.ranking import top_k
from reelcast.session import stage_table

SAMPLE = 20_000
PARTS, CODES = 16, 256
MAX_LISTS = 65_536
ROUNDS = 12
TUNE_QUERIES = 200
SHELF = 32_768              # stored items that one task searches
TASK_CELLS = 8_000_000      # table sums of one task, about
FRAME_ROWS = 20_000         # rows with vectors that are held beside their table at once
DIGITS = 4


@dataclass(frozen=True)
class Books:
    """``centres``: lists x dim; ``codes``: one array (centres x piece) for each part."""

    centres: np.ndarray
    codes: list[np.ndarray]

    @property
    def bytes_per_vector(self) -> int:
        return len(self.codes)

    def pieces(self, x: np.ndarray) -> list[np.ndarray]:
        return np.split(x, np.cumsum([b.shape[1] for b in self.codes])[:-1], axis=1)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of the nearest centre of each row, block by block."""
    half = (centres * centres).sum(1) / 2
    return np.concatenate([np.argmax(x[i:i + 4096] @ centres.T - half, axis=1) for i in range(0, len(x), 4096)]
                          or [np.zeros(0, np.int64)])


def lloyd(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` centres of the rows of ``x`` after ``ROUNDS`` rounds; a centre without rows stays where it is."""
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(ROUNDS):
        near = _nearest(x, centres)
        n = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, weights=x[:, j], minlength=k) for j in range(x.shape[1])], axis=1)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(movie_id, vec) at length 1; null and zero vectors have no direction and are left out."""
    return vectors.select("movie_id", unit("vec").alias("vec")).where(F.col("vec").isNotNull())


def sample(units: DataFrame, n: int) -> np.ndarray:
    """The ``SAMPLE`` vectors of smallest hash (the documented bound) of ``n`` rows, by hash and id.  Only rows that can
    be among them are sorted, and they come to the driver as bytes of doubles, not as lists of Python numbers."""
    h = F.xxhash64("movie_id")
    share = min(1.0, (1.5 * SAMPLE + 1000) / max(n, 1))
    low = units.where(h <= F.lit(int(-(1 << 63) + share * (1 << 64)) - 1 if share < 1 else (1 << 63) - 1))
    if low.count() < min(SAMPLE, n):                        # ids that repeat can leave too few
        low = units
    rows = low.orderBy(h, "movie_id").limit(SAMPLE)

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"vec": [np.asarray(v, "float64").tobytes() for v in f["vec"]]})

    packed = rows.select("vec").mapInPandas(pack, "vec binary").collect()
    return np.stack([np.frombuffer(r["vec"], "float64") for r in packed])


def fit_books(units: DataFrame, lists: int | None = None, parts: int = PARTS, seed: int = C.SEED) -> Books | None:
    """Codebooks of unit vectors; None for an empty table.  Without ``lists`` their number is the root of the rows."""
    n = units.count()
    if not n:
        return None
    x = sample(units, n)
    rng = np.random.default_rng(seed)
    k = min(lists or math.ceil(math.sqrt(n)), len(x), MAX_LISTS)
    widths = [len(p) for p in np.array_split(np.arange(x.shape[1]), min(parts, x.shape[1]))]
    pieces = np.split(x, np.cumsum(widths)[:-1], axis=1)
    return Books(lloyd(x, k, rng), [lloyd(p, min(CODES, len(x)), rng) for p in pieces])


def encode(units: DataFrame, books: Books) -> DataFrame:
    """(list_id, movie_id, vec binary, unit): every row's coarse list and its code, beside the vector itself."""
    shared = units.sparkSession.sparkContext.broadcast(books)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b = shared.value
        for f in frames:
            x = np.stack(f["vec"].to_numpy()) if len(f) else np.zeros((0, b.centres.shape[1]))
            code = np.stack([_nearest(p, c) for p, c in zip(b.pieces(x), b.codes)], axis=1).astype(np.uint8)
            yield pd.DataFrame({"list_id": _nearest(x, b.centres).astype("int32"), "movie_id": f["movie_id"],
                                "vec": [row.tobytes() for row in code], "unit": f["vec"]})

    return units.select("movie_id", "vec").mapInPandas(run, "list_id int, movie_id long, vec binary, unit array<double>")


def _nearest_lists(x: np.ndarray, centres: np.ndarray, probes: int) -> np.ndarray:
    """The numbers of the ``probes`` nearest lists of each row, nearest first."""
    return np.argsort((centres * centres).sum(1) / 2 - x @ centres.T, axis=1, kind="stable")[:, :probes]


def probe(units: DataFrame, books: Books, probes: int) -> DataFrame:
    """(list_id, movie_id, rank): each query's ``probes`` nearest lists."""
    shared = units.sparkSession.sparkContext.broadcast(books.centres)
    p = min(probes, len(books.centres))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            x = np.stack(f["vec"].to_numpy()) if len(f) else np.zeros((0, shared.value.shape[1]))
            near = _nearest_lists(x, shared.value, p)
            yield pd.DataFrame({"list_id": near.reshape(-1).astype("int32"), "movie_id": np.repeat(f["movie_id"].to_numpy(), p),
                                "rank": np.tile(np.arange(p, dtype="int32"), len(f))})

    return units.select("movie_id", "vec").mapInPandas(run, "list_id int, movie_id long, rank int")


def _table_sums(books: Books, x: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Dot products of whole queries with codes: one table of query pieces times centres per part, entries summed."""
    total = np.zeros((len(x), len(code)))
    for j, (piece, book) in enumerate(zip(books.pieces(x), books.codes)):
        total += (piece @ book.T)[:, code[:, j]]
    return total


def _table_scorer(books: Books, k: int):
    """The ``k`` best table sums of each query in one list."""
    def score(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"list_id": pd.Series(dtype="int32"), "movie_id": pd.Series(dtype="int64"),
                                 "movie_id2": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        code = np.frombuffer(b"".join(c["vec"]), np.uint8).reshape(len(c), -1)
        qid, cid = q["movie_id"].to_numpy(), c["movie_id"].to_numpy()
        x, kk, found = np.stack(q["vec"].to_numpy()), min(k, len(cid)), []
        step = max(1, V.SLICE_CELLS // len(cid))
        for at in range(0, len(qid), step):
            cut = slice(at, at + step)
            total = _table_sums(books, x[cut], code)
            key = np.where(qid[cut, None] == cid[None, :], np.inf, -total)
            picked = np.argpartition(key, kk - 1, axis=1)[:, :kk].reshape(-1)
            rows = np.repeat(np.arange(len(key)), kk)
            keep = np.isfinite(key[rows, picked])
            found.append((qid[cut][rows][keep], cid[picked][keep], total[rows, picked][keep]))
        ids, near, scores = (np.concatenate(x) for x in zip(*found))
        return pd.DataFrame({"list_id": q["list_id"].iloc[0], "movie_id": ids, "movie_id2": near, "score": scores})
    return score


def _shelves(counts: dict[int, int], lists: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, parts) of each list: lists are laid side by side on shelves of about ``size`` items; a longer list has
    as many shelves of its own as it takes."""
    first, parts = np.zeros(lists, np.int64), np.ones(lists, np.int64)
    shelf, held = 0, 0
    for i in range(lists):
        n = counts.get(i, 0)
        if held and held + n > size:
            shelf, held = shelf + 1, 0
        first[i], parts[i], held = shelf, max(1, math.ceil(n / size)), held + n
        if parts[i] > 1:
            shelf, held = shelf + parts[i], 0
    return first, parts


def _visits(shared, probes: int, first: np.ndarray, parts: np.ndarray):
    """A query leaves once for each shelf that has one of its lists, whatever the number of lists."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if f.empty:
                continue
            near = _nearest_lists(np.stack(f["vec"].to_numpy()), shared.value.centres, probes)
            goes = np.zeros((len(f), int((first + parts).max())), bool)
            for more in range(int(parts.max())):
                row, at = np.nonzero(parts[near] > more)
                goes[row, first[near[row, at]] + more] = True
            row, shelf = np.nonzero(goes)
            for at in range(0, len(row), FRAME_ROWS):
                cut = slice(at, at + FRAME_ROWS)
                yield pd.DataFrame({"shelf": shelf[cut], "movie_id": f["movie_id"].to_numpy()[row[cut]],
                                    "vec": f["vec"].to_numpy()[row[cut]]})
    return run


def _shelf_scorer(shared, probes: int, rerank: int, k: int | None):
    """The ``rerank`` best table sums of each query on one shelf; with ``k`` the best of them by their exact cosine."""
    def score(key, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        books, found = shared.value, []
        if not (q.empty or c.empty):
            c = c.sort_values(["list_id", "movie_id"])
            x, exact = np.stack(q["vec"].to_numpy()), np.stack(c["vec"].to_numpy())
            code = np.frombuffer(b"".join(c["code"]), np.uint8).reshape(len(c), -1)
            qid, cid, cl = q["movie_id"].to_numpy(), c["movie_id"].to_numpy(), c["list_id"].to_numpy()
            near = _nearest_lists(x, books.centres, probes)
            order = np.argsort(near[:, 0], kind="stable")       # queries of one list visit much the same lists
            step = max(1, V.SLICE_CELLS // len(cid))
            for lo in range(0, len(order), step):
                mine = order[lo:lo + step]
                goes = np.zeros((len(mine), len(books.centres)), bool)
                goes[np.arange(len(mine))[:, None], near[mine]] = True
                some = np.flatnonzero(goes.any(axis=0)[cl])
                if not len(some):
                    continue
                sums = _table_sums(books, x[mine], code[some])
                sums = np.where(goes[:, cl[some]] & (qid[mine, None] != cid[some][None, :]), -sums, np.inf)
                row, at = V._best(sums, cid[some], rerank)
                value = -sums[row, at]
                if k:
                    value = np.concatenate([np.einsum("ij,ij->i", x[mine[row[i:i + FRAME_ROWS]]], exact[some[at[i:i + FRAME_ROWS]]])
                                            for i in range(0, len(row), FRAME_ROWS)] or [value])
                    rounded = np.round(value, DIGITS)
                    by = np.lexsort((cid[some[at]], -rounded, row))
                    by = by[np.arange(len(by)) - np.searchsorted(row[by], row[by]) < k]
                    row, at, value = row[by], at[by], rounded[by]
                found.append((qid[mine[row]], cid[some[at]], value))
        ids, other, scores = (np.concatenate(x) for x in zip(*found)) if found else ([], [], [])
        return pd.DataFrame({"movie_id": np.asarray(ids, "int64"), "movie_id2": np.asarray(other, "int64"),
                             "score": np.asarray(scores, "float64")})
    return score


def _search(queries: DataFrame, index: DataFrame, books: Books, probes: int, rerank: int, k: int | None) -> DataFrame:
    """(movie_id, movie_id2, score) of the best rows of each query and shelf.

    The codes lie beside their exact vectors on shelves of about ``SHELF`` items; a query's vector goes once to each
    shelf, so what is moved grows with queries x shelves, not with queries x lists or queries x candidates."""
    spark, lists = queries.sparkSession, len(books.centres)
    probes = min(probes, lists)
    counts = {r["list_id"]: r["count"] for r in index.groupBy("list_id").count().collect()}     # a row a list
    first, parts = _shelves(counts, lists, SHELF)
    shelves, n = int((first + parts).max()), queries.count()
    places = F.broadcast(spark.createDataFrame([(i, int(first[i]), int(parts[i])) for i in range(lists)],
                                               "list_id int, _first long, _parts long"))
    shared = spark.sparkContext.broadcast(books)
    # blocks of queries: bounded rows, and tasks enough for the work that there is
    work = math.ceil(n * sum(counts.values()) / shelves / TASK_CELLS)
    blocks = max(math.ceil(n / SHELF), min(work, math.ceil(int(spark.conf.get("spark.sql.shuffle.partitions")) / shelves)), 1)
    q = queries.where("movie_id IS NOT NULL").select("movie_id", "vec").mapInPandas(
        _visits(shared, probes, first, parts), "shelf long, movie_id long, vec array<double>")
    q = q.withColumn("block", F.pmod(F.xxhash64("movie_id"), F.lit(blocks)))
    c = index.where("movie_id IS NOT NULL").join(places, "list_id").withColumn(
        "shelf", F.col("_first") + F.pmod(F.xxhash64("movie_id"), F.col("_parts")))
    c = c.select("shelf", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"),
                 "list_id", "movie_id", F.col("vec").alias("code"), F.col("unit").alias("vec"))
    return q.groupBy("shelf", "block").cogroup(c.groupBy("shelf", "block")).applyInPandas(
        _shelf_scorer(shared, probes, rerank, k), "movie_id long, movie_id2 long, score double")


def candidates(queries: DataFrame, index: DataFrame, books: Books, probes: int, rerank: int) -> DataFrame:
    """(movie_id, movie_id2, sort_num): the ``rerank`` best of each query by its codes' table sums."""
    near = _search(queries, index, books, probes, rerank, None)
    return top_k(near, ["movie_id"], [F.desc("score"), F.asc("movie_id2")], rerank).select("movie_id", "movie_id2", "sort_num")


def nearest(units: DataFrame, index: DataFrame, books: Books, probes: int, rerank: int, k: int) -> DataFrame:
    """(movie_id, movie_id2, cos_sim, sort_num): the ``k`` best of each query by the true cosine among the ``rerank``
    best table sums of every shelf it visits."""
    order = [F.desc("cos_sim"), F.asc("movie_id2")]
    best = top_k(_search(units, index, books, probes, rerank, k).withColumnRenamed("score", "cos_sim"),
                 ["movie_id"], order, k)
    again = units.groupBy("movie_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = stage_table(again.where("movie_id IS NOT NULL"))
    if again.isEmpty():
        return best
    # ids that come more than once: a pair's cosine stands once for each row of either id
    other = again.select(F.col("movie_id").alias("movie_id2"), F.col("_n").alias("_m"))
    times = F.coalesce("_n", F.lit(1)) * F.coalesce("_m", F.lit(1))
    rows = best.drop("sort_num").join(again, "movie_id", "left").join(other, "movie_id2", "left").select(
        "movie_id", "movie_id2", "cos_sim", F.explode(F.array_repeat(F.lit(0), times.cast("int"))).alias("_")).drop("_")
    return top_k(rows, ["movie_id"], order, k)


def tune(units: DataFrame, index: DataFrame, books: Books, k: int, recall: float, queries: int = TUNE_QUERIES) -> tuple[int, int]:
    """(probes, rerank) at which ``recall`` of the true ``k`` neighbours of ``queries`` items are met; lists and codes may
    each lose a quarter of what may be missed."""
    asked = stage_table(units.orderBy(F.xxhash64("movie_id", F.lit(1)), "movie_id").limit(queries))
    wanted = 1 - (1 - recall) / 4
    truth = stage_table(V.block_topk(asked, units, [], k, "cosine").select("movie_id", "movie_id2"))
    lists = len(books.centres)
    place = probe(asked, books, lists)
    ranks = truth.join(index.select(F.col("movie_id").alias("movie_id2"), "list_id"), "movie_id2").join(
        place, ["movie_id", "list_id"])
    need = ranks.agg(F.percentile("rank", wanted)).first()[0]
    probes = 1 if need is None else min(lists, int(math.ceil(need)) + 1)
    order = truth.join(candidates(asked, index, books, probes, 100 * k), ["movie_id", "movie_id2"])
    found = order.agg(F.percentile("sort_num", wanted)).first()[0]
    return probes, max(k, int(math.ceil(found or k)))


def pq_neighbours(vectors: DataFrame, k: int = C.NEIGHBOURS_K, recall: float = 0.9, lists: int | None = None,
                  parts: int = PARTS, seed: int = C.SEED) -> DataFrame:
    """(movie_id, movie_id2, cos_sim, sort_num): about ``recall`` or more of the true ``k`` nearest others of every item,
    with exact cosines.  Null and zero vectors have no neighbours; an empty table gives an empty result."""
    units = stage_table(unit_vectors(vectors))
    books = fit_books(units, lists, parts, seed)
    if books is None:
        return units.sparkSession.createDataFrame([], "movie_id long, movie_id2 long, cos_sim double, sort_num long")
    index = stage_table(encode(units, books))
    probes, rerank = tune(units, index, books, k, recall)
    return nearest(units, index, books, probes, rerank, k)


def recall_at(found: DataFrame, truth: DataFrame) -> float:
    """Share of the true pairs (movie_id, movie_id2) that were found."""
    hits = truth.select("movie_id", "movie_id2").join(found.select("movie_id", "movie_id2"), ["movie_id", "movie_id2"])
    return hits.count() / max(truth.count(), 1)
