"""Item vectors and nearest neighbours.

Exact neighbour search never materialises all pairs of a group.  Each group
(cluster, channel, IVF list or LSH bucket) is cut into blocks of at most
``block_size`` items; every (query block, candidate block) pair is scored in
one task with numpy, a slice of queries at a time, and only the top-K rows per
query leave it.  A final top-K per query merges the blocks.  Work and memory of
a task are bounded by ``block_size``, whatever the size of the largest group.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from reelcast import config as C
from reelcast.functions import columns as X
from reelcast.operators.ranking import top_k
from reelcast.session import stage_table


# rows of a block: every row is sent once for each block of the other side and each block pair returns K rows a query,
# so what is shuffled falls with the block's size
BLOCK = 16_384
SLICE_CELLS = 4_000_000     # scores that are held at once while a block pair is scored


def _best(key: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` smallest finite keys of each row, smaller id first on ties, row by row."""
    k = min(k, key.shape[1])
    # what is larger than the k-th smallest can't be chosen; ties with it are all kept for the id to decide
    kth = np.partition(key, k - 1, axis=1)[:, k - 1]
    row, at = np.nonzero((key <= kth[:, None]) & np.isfinite(key))
    order = np.lexsort((ids[at], key[row, at], row))
    row, at = row[order], at[order]
    first = np.searchsorted(row, row, side="left")
    keep = np.arange(len(row)) - first < k
    return row[keep], at[keep]


def _block_scorer(metric: str, k: int, exclude_self: bool, digits: int, keys: list[str]):
    def score(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        cols = keys + ["movie_id", "movie_id2", "score"]
        if q.empty or c.empty:
            return pd.DataFrame({k_: pd.Series(dtype="float64" if k_ == "score" else "int64") for k_ in cols})
        Q = np.stack(q["vec"].to_numpy()).astype("float64")
        Cm = np.stack(c["vec"].to_numpy()).astype("float64")
        qid = q["movie_id"].to_numpy()
        cid = c["movie_id"].to_numpy()
        qq, cc = (Q * Q).sum(axis=1), (Cm * Cm).sum(axis=1)
        found = []
        step = max(1, SLICE_CELLS // len(cid))
        for at in range(0, len(qid), step):
            cut = slice(at, at + step)
            if metric == "cosine":
                with np.errstate(divide="ignore", invalid="ignore"):
                    s = (Q[cut] @ Cm.T) / np.outer(np.sqrt(qq[cut]), np.sqrt(cc))
                s = np.round(s, digits)
                order_key = -s
            else:  # squared euclidean, smaller is nearer
                s = qq[cut, None] + cc[None, :] - 2.0 * (Q[cut] @ Cm.T)
                s = np.round(np.maximum(s, 0.0), digits)
                order_key = s.copy()
            order_key[np.isnan(order_key)] = np.inf
            if exclude_self:
                order_key[qid[cut, None] == cid[None, :]] = np.inf
            row, picked = _best(order_key, cid, k)
            found.append((qid[cut][row], cid[picked], s[row, picked]))
        ids, near, scores = (np.concatenate(x) for x in zip(*found))
        out = pd.DataFrame({"movie_id": ids, "movie_id2": near, "score": scores})
        for k_ in keys:
            out.insert(0, k_, q[k_].iloc[0])
        return out[cols]
    return score


def block_topk(queries: DataFrame, cands: DataFrame, group: list[str], k: int, metric: str = "cosine",
               block_size: int = BLOCK, exclude_self: bool = True, digits: int = 4,
               final_topk: bool = True, scorer=None) -> DataFrame:
    """Exact top-K candidates per query within the same group.

    queries / cands: (group..., movie_id, vec array<double>).  Returns
    (movie_id, movie_id2, score, sort_num); score is the cosine similarity
    (larger first) or the squared L2 distance (smaller first).  ``scorer`` may replace the scoring of one block pair
    (two pandas frames in, the group's best rows out)."""
    # fresh attribute ids on both sides: queries and candidates are often the
    # same DataFrame (self search)
    fresh = lambda df: df.select(*[F.col(x).alias(x) for x in df.columns])
    queries, cands = fresh(queries), fresh(cands)
    # block counts per group, sized separately for the query and the
    # candidate side (an IVF list can be probed by many more queries than it
    # stores); each side is replicated over the other side's blocks
    if group:
        qn = queries.groupBy(*group).agg(F.count(F.lit(1)).alias("_nq"))
        cn = cands.groupBy(*group).agg(F.count(F.lit(1)).alias("_nc"))
        sizes = fresh(qn.join(cn, group))
        qs, cs = queries.join(sizes, group), cands.join(sizes, group)
        nq, nc = F.col("_nq"), F.col("_nc")
    else:   # one global group: the two counts are scalar subqueries
        qs, cs = queries, cands
        nq, nc = queries.select(F.count(F.lit(1))).scalar(), cands.select(F.count(F.lit(1))).scalar()
    nbq = F.greatest(F.ceil(nq / F.lit(block_size)), F.lit(1)).cast("bigint")
    nbc = F.greatest(F.ceil(nc / F.lit(block_size)), F.lit(1)).cast("bigint")
    q = (qs.withColumn("_qb", F.pmod(F.xxhash64("movie_id"), nbq))
         .withColumn("_cb", F.explode(F.sequence(F.lit(0).cast("bigint"), nbc - 1)))
         .select(*group, "_qb", "_cb", "movie_id", "vec"))
    c = (cs.withColumn("_cb", F.pmod(F.xxhash64("movie_id"), nbc))
         .withColumn("_qb", F.explode(F.sequence(F.lit(0).cast("bigint"), nbq - 1)))
         .select(*group, "_qb", "_cb", "movie_id", "vec"))
    gkeys = [*group, "_qb", "_cb"]
    schema = T.StructType([queries.schema[g] for g in group]
                          + [T.StructField("movie_id", queries.schema["movie_id"].dataType),
                             T.StructField("movie_id2", cands.schema["movie_id"].dataType),
                             T.StructField("score", T.DoubleType())])
    q, c = fresh(q), fresh(c)
    scored = (q.groupBy(*gkeys).cogroup(c.groupBy(*gkeys))
              .applyInPandas(scorer or _block_scorer(metric, k, exclude_self, digits, list(group)), schema))
    scored = scored.drop(*group)
    if not final_topk:
        return scored
    order = [F.desc("score") if metric == "cosine" else F.asc("score"), F.asc("movie_id2")]
    return top_k(scored, ["movie_id"], order, k)


def cosine_in_cluster(vectors: DataFrame, cluster: str, k: int = C.NEIGHBOURS_K, block_size: int = BLOCK) -> DataFrame:
    """Cosine (4 decimals) between items of one cluster, top-K per item
    (the item itself excluded): (movie_id, movie_id2, cos_sim, sort_num)."""
    v = vectors.select(cluster, "movie_id", "vec")
    nb = block_topk(v, v, [cluster], k, "cosine", block_size)
    return nb.withColumnRenamed("score", "cos_sim")


def knn_exact_l2(queries: DataFrame, vectors: DataFrame, k: int = 10, block_size: int = BLOCK) -> DataFrame:
    """k nearest items by squared L2 for a stated table of queries, searched
    against all items in blocks (an item that is a query finds itself first)."""
    nb = block_topk(queries.select("movie_id", "vec"), vectors.select("movie_id", "vec"), [], k, "l2", block_size,
                    exclude_self=False)
    return nb.withColumnRenamed("score", "distance")


def _nearest_lists(centroids: np.ndarray, nprobe: int):
    def run(it):
        for pdf in it:
            if pdf.empty:
                yield pdf.assign(list_id=pd.Series(dtype="int32"), rank=pd.Series(dtype="int32"))
                continue
            X = np.stack(pdf["vec"].to_numpy()).astype("float64")
            d = (X * X).sum(1)[:, None] + (centroids * centroids).sum(1)[None, :] - 2 * X @ centroids.T
            p = min(nprobe, centroids.shape[0])
            near = np.argsort(d, axis=1, kind="stable")[:, :p]
            rep = pdf.loc[pdf.index.repeat(p)].reset_index(drop=True)
            rep["list_id"] = near.reshape(-1).astype("int32")
            rep["rank"] = np.tile(np.arange(p, dtype="int32"), len(pdf))
            yield rep
    return run


def ann_neighbours(vectors: DataFrame, k: int = C.NEIGHBOURS_K, nlist: int | None = None, nprobe: int = C.ANN_PROBES,
                   seed: int = C.SEED, block_size: int = BLOCK) -> DataFrame:
    """Inverted-file approximate neighbours: k-means coarse lists (MLlib),
    each item stored in its nearest list and searched in its ``nprobe``
    nearest lists with exact cosine inside the lists.  Without ``nlist`` the
    number of lists grows with the square root of the rows."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    v = stage_table(vectors.select("movie_id", "vec"))      # read once per k-means round
    nlist = nlist or max(1, math.ceil(math.sqrt(v.count())))
    km = KMeans(k=nlist, seed=seed, featuresCol="features").fit(v.withColumn("features", array_to_vector("vec")))
    cents = np.array([np.asarray(c, dtype="float64") for c in km.clusterCenters()])  # nlist x dim, a parameter
    schema = T.StructType(list(v.schema.fields) + [T.StructField("list_id", T.IntegerType()),
                                                   T.StructField("rank", T.IntegerType())])
    probes = v.mapInPandas(_nearest_lists(cents, nprobe), schema)
    stored = probes.where(F.col("rank") == 0).select("list_id", "movie_id", "vec")
    queries = probes.select("list_id", "movie_id", "vec")
    nb = block_topk(queries, stored, ["list_id"], k, "cosine", block_size)
    # an item probing several lists meets each stored item once (one list each)
    return nb.withColumnRenamed("score", "cos_sim")


PAIR_BLOCK = 2048           # rows of a block where every pair leaves the task
PAIR_ROWS = 2_000_000       # pairs of one partition of items, about


def _shared_bucket_scorer(tables: int):
    """All pairs of two blocks of a bucket, without those that share a bucket of an earlier table.  ``vec`` has the
    row's ``tables`` bucket numbers behind it."""
    def score(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        cols = ["tbl", "bucket", "movie_id", "movie_id2", "score"]
        if q.empty or c.empty:
            return pd.DataFrame({n: pd.Series(dtype="float64" if n == "score" else "int64") for n in cols})
        Q, Cm = (np.stack(x["vec"].to_numpy()).astype("float64") for x in (q, c))
        qh, ch, Q, Cm = Q[:, -tables:], Cm[:, -tables:], Q[:, :-tables], Cm[:, :-tables]
        qid, cid = q["movie_id"].to_numpy(), c["movie_id"].to_numpy()
        s = (Q * Q).sum(axis=1)[:, None] + (Cm * Cm).sum(axis=1)[None, :] - 2.0 * (Q @ Cm.T)
        keep = qid[:, None] != cid[None, :]
        for t in range(int(q["tbl"].iloc[0])):
            keep &= qh[:, t, None] != ch[None, :, t]
        row, at = np.nonzero(keep & ~np.isnan(s))
        return pd.DataFrame({"tbl": q["tbl"].iloc[0], "bucket": q["bucket"].iloc[0], "movie_id": qid[row],
                             "movie_id2": cid[at], "score": np.round(np.maximum(s[row, at], 0.0), 4)})[cols]
    return score


def lsh_pairs(vectors: DataFrame, bucket_length: float = 2.0, tables: int = 3, threshold: float | None = None,
              seed: int = C.SEED, block_size: int = PAIR_BLOCK) -> DataFrame:
    """Random-projection LSH as a similarity join: every pair of different items that share a bucket in any hash table,
    with its Euclidean distance, optionally within ``threshold``; ranked per item: (movie_id, movie_id2, distance,
    sort_num).

    No partner is left out, so rows grow with the square of a bucket's size.  A pair leaves the task once, in the
    first table whose bucket it shares; blocks bound a task, ranks are sorts that spill."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array
    v = vectors.select("movie_id", "vec").withColumn("features", array_to_vector("vec"))
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket_length,
                                        numHashTables=tables, seed=seed).fit(v)
    h = model.transform(v)
    numbers = F.array(*[vector_to_array(F.col("hashes")[t])[0] for t in range(tables)])
    h = stage_table(h.select("movie_id", F.concat("vec", numbers).alias("vec"), F.posexplode(numbers).alias("tbl", "bucket"))
                    .withColumn("tbl", F.col("tbl").cast("bigint")).withColumn("bucket", F.col("bucket").cast("bigint")))
    nb = block_topk(h, h, ["tbl", "bucket"], 0, "l2", block_size, final_topk=False, scorer=_shared_bucket_scorer(tables))
    rows = h.groupBy("tbl", "bucket").agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") * F.col("n"))).first()[0]
    n = max(int(h.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil((rows or 0) / PAIR_ROWS))
    # one exchange: the pairs of an item meet, those of ids that come more than once keep their least distance
    nb = nb.repartition(n, "movie_id").groupBy("movie_id", "movie_id2").agg(F.min("score").alias("dist2"))
    nb = nb.select("movie_id", "movie_id2", F.round(F.sqrt("dist2"), 4).alias("distance"))
    if threshold is not None:
        nb = nb.where(F.col("distance") <= threshold)
    rank = F.row_number().over(Window.partitionBy("movie_id").orderBy(F.asc("distance"), F.asc("movie_id2")))
    return nb.withColumn("sort_num", rank.cast("bigint"))


def within_distance(vectors: DataFrame, threshold: float, k: int = 10, projections: int = 3, digits: int = 4,
                    block_size: int = BLOCK) -> DataFrame:
    """(movie_id, movie_id2, distance, sort_num): the ``k`` nearest other items of each item at a Euclidean distance of
    at most ``threshold``; none is missed.

    Items are hashed to cells of width ``threshold`` along the ``projections`` axes of largest variance and searched
    in their own and all adjoining cells (multi-probe).  A projection on unit axes never lengthens a distance, so what
    is within the threshold is at most one cell away on every axis.  Null vectors have no neighbours; vectors have one
    length."""
    from itertools import product

    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector
    v = stage_table(vectors.select("movie_id", "vec").where(F.col("vec").isNotNull()))
    if v.isEmpty():
        return v.sparkSession.createDataFrame([], "movie_id long, movie_id2 long, distance double, sort_num long")
    m = min(projections, len(v.first()["vec"]))
    axes = PCA(k=m, inputCol="features", outputCol="p").fit(
        v.withColumn("features", array_to_vector("vec"))).pc.toArray().T            # m x dim, a parameter
    cells = [F.floor(X.dot("vec", F.array(*[F.lit(float(x)) for x in axis])) / threshold) for axis in axes]
    placed = v.select("movie_id", "vec", F.array(*cells).alias("at"))
    cell = lambda at: F.concat_ws(":", F.transform(at, lambda c: c.cast("string")))
    around = F.array(*[F.array(*[F.col("at")[i] + s for i, s in enumerate(step)]) for step in product((-1, 0, 1), repeat=m)])
    queries = placed.select("movie_id", "vec", F.explode(around).alias("at")).select(
        cell(F.col("at")).alias("cell"), "movie_id", "vec")
    near = block_topk(queries, placed.select(cell(F.col("at")).alias("cell"), "movie_id", "vec"), ["cell"], k, "l2",
                      block_size, digits=digits)
    return near.where(F.col("score") <= F.round(F.lit(threshold * threshold), digits)).select(
        "movie_id", "movie_id2", F.round(F.sqrt("score"), digits).alias("distance"), "sort_num")


# ---------------------------------------------------------------- models
def word2vec(dim: int = C.VECTOR_DIM, min_count: int = C.W2V_MIN_COUNT, seed: int = C.SEED,
             partitions: int = C.W2V_PARTITIONS):
    """Skip-gram word vectors over token lists (``words`` column), to be trained on ``partitions`` parts of the corpus
    or more (parts are bounded in size) whose vectors are averaged; no vocabulary on the driver."""
    from reelcast.operators.skipgram import SkipGram
    return SkipGram(dim, min_count, seed, partitions)


def fit_word2vec(words: DataFrame, dim: int = C.VECTOR_DIM, min_count: int = C.W2V_MIN_COUNT, seed: int = C.SEED,
                 partitions: int = C.W2V_PARTITIONS):
    return word2vec(dim, min_count, seed, partitions).fit(words)


def word_vectors(model) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    return model.getVectors().select(F.col("word"), vector_to_array("vector").alias("vec"))


def word_synonyms(model, word: str, n: int = 10) -> DataFrame:
    return model.findSynonyms(word, n)


def mean_of_distinct(weighted: DataFrame, key: str) -> DataFrame:
    """Mean of the distinct vectors per key (partial aggregation via
    ``Summarizer``): (key, vec)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    d = weighted.select(key, "vec").dropDuplicates([key, "vec"])
    m = d.groupBy(key).agg(Summarizer.mean(array_to_vector("vec")).alias("_m"))
    return m.select(key, vector_to_array("_m").alias("vec"))


def item_vector(topic_weights: DataFrame, wvecs: DataFrame) -> DataFrame:
    """weight x word vector for each topic word in the vocabulary, then the
    mean of the distinct weighted vectors per item."""
    j = topic_weights.select("movie_id", "cate_id", F.col("topic").alias("word"), "weight").join(wvecs, "word")
    j = j.select("movie_id", "cate_id", F.transform("vec", lambda x: x * F.col("weight")).alias("vec"))
    m = mean_of_distinct(j, "movie_id")
    cate = topic_weights.groupBy("movie_id").agg(F.min("cate_id").alias("cate_id"))
    return m.join(cate, "movie_id")


def cluster_items(vectors: DataFrame, k: int = C.CLUSTERS_K, min_size: float = C.MIN_CLUSTER_SIZE,
                  seed: int = C.SEED):
    """BisectingKMeans on item vectors; returns (assignments, model)."""
    from pyspark.ml.clustering import BisectingKMeans
    from pyspark.ml.functions import array_to_vector
    v = stage_table(vectors).withColumn("features", array_to_vector("vec"))
    model = BisectingKMeans(k=k, minDivisibleClusterSize=min_size, seed=seed, featuresCol="features",
                            predictionCol="group").fit(v)
    return model.transform(v).drop("features"), model
