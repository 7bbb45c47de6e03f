"""Skip-gram word vectors, trained on parts of the corpus side by side, with the vocabulary in partitions all the way.

MLlib's Word2Vec collects its vocabulary and keeps two arrays over it on the driver.  Here, as there, each part of the
corpus is trained from the same start and the parts' vectors of a word are averaged; but a part holds the vectors of
its own words only (the start is a hash of word and dimension, so nothing is sent), and the averages are taken by word.
The output side is negative sampling by the part's own word frequencies.  The same rows give the same vectors, however
they are partitioned.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcast.functions import columns as X
from reelcast.session import stage_table

WINDOW, NEGATIVES, RATE, LEAST_RATE = 5, 5, 0.025, 1e-4
SENTENCE = 1000             # words that a window does not reach beyond, counted from the start of each list
PART_TOKENS = 2_000_000     # words of one part, about: what a task trains on, and the vectors that it holds
STEP_TOKENS = 1000          # words whose pairs are trained together
SHARED = 64                 # negative words that the pairs of a step share
MOST = 16                   # a word's pairs in one step count as this many at most, so that a common word can't overshoot
AVERAGED_ROWS = 50_000      # vectors that one task averages, about
SLICE_WORDS = 10_000


def _start(hashes: np.ndarray, dim: int) -> np.ndarray:
    """Vectors of numbers within +-0.5 / dim, made of the words' hashes."""
    out = np.empty((len(hashes), dim), np.float32)
    step = np.arange(1, dim + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(hashes), SLICE_WORDS):
        x = hashes[at:at + SLICE_WORDS].view(np.uint64)[:, None] + step
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[at:at + SLICE_WORDS] = ((x >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24) - np.float32(0.5)) / dim
    return out


def _sentences(words: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number, sentence) of every word of the vocabulary that stands in the lists, one after the other."""
    lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    ids = pc.fill_null(pc.index_in(pc.list_flatten(words), value_set=vocabulary), -1).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lengths)), lengths)[ids >= 0]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return ids[ids >= 0].astype(np.int64), row * (len(row) // SENTENCE + 1) + place // SENTENCE


def _add(matrix: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Add each of ``rows`` to the row of ``matrix`` that ``at`` names."""
    order = np.argsort(at, kind="stable")
    some, first, count = np.unique(at[order], return_index=True, return_counts=True)
    matrix[some] += np.add.reduceat(rows[order], first, axis=0) * np.minimum(1.0, MOST / count).astype(np.float32)[:, None]


def _train(ids: np.ndarray, sentence: np.ndarray, counts: np.ndarray, vectors: np.ndarray, rng) -> None:
    """One pass over the words: ``vectors`` (in place) learn to tell the words around a word from others."""
    outside = np.zeros_like(vectors)
    reach = rng.integers(1, WINDOW + 1, len(ids))
    frequent = np.cumsum(counts.astype("float64") ** 0.75)
    for lo in range(0, len(ids), STEP_TOKENS):
        inner, centre = [], []
        for o in range(1, WINDOW + 1):
            i = np.arange(lo, min(lo + STEP_TOKENS, len(ids) - o))
            i = i[sentence[i] == sentence[i + o]]
            left, right = i[reach[i] >= o], i[reach[i + o] >= o]
            inner += [ids[left + o], ids[right]]
            centre += [ids[left], ids[right + o]]
        inner, centre = np.concatenate(inner), np.concatenate(centre)
        if not len(inner):
            continue
        rate = np.float32(max(RATE * (1 - lo / len(ids)), LEAST_RATE))
        v, u = vectors[inner], outside[centre]
        near = rate / (1 + np.exp(np.clip(np.einsum("ij,ij->i", v, u), -20, 20)))
        others = np.searchsorted(frequent, rng.random(SHARED) * frequent[-1], side="right").clip(max=len(counts) - 1)
        far = outside[others]
        g = -rate * np.float32(NEGATIVES / SHARED) / (1 + np.exp(-np.clip(v @ far.T, -20, 20)))
        _add(vectors, inner, near[:, None] * u + g @ far)
        _add(outside, centre, near[:, None] * v)
        np.add.at(outside, others, g.T @ v * np.float32(min(1.0, MOST * SHARED / len(inner))))


def _part_trainer(dim: int, seed: int):
    def run(texts: pa.Table, vocabulary: pa.Table) -> pa.Table:
        vocabulary = vocabulary.sort_by("word").combine_chunks()
        counts = vocabulary["n"].to_numpy()
        vectors = _start(vocabulary["h"].to_numpy(), dim)
        if len(counts) and texts.num_rows:
            known = vocabulary["word"].chunk(0)
            ids, sentence = _sentences(texts.sort_by("h")["words"].combine_chunks(), known)
            _train(ids, sentence, counts, vectors, np.random.default_rng([seed, vocabulary["part"][0].as_py()]))
        return pa.table({"word": vocabulary["word"], "part": vocabulary["part"], "n": vocabulary["n"],
                         "vec": pa.array([x.tobytes() for x in vectors], pa.binary())})
    return run


def _averager(dim: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("word", "ascending"), ("part", "ascending")]).combine_chunks()
        code = rows["word"].chunk(0).dictionary_encode()
        at = np.unique(code.indices.to_numpy(), return_index=True)[1]
        n = rows["n"].to_numpy().astype("float64")
        matrix = np.frombuffer(b"".join(rows["vec"].to_pylist()), np.float32).reshape(-1, dim) * n[:, None]
        mean = np.add.reduceat(matrix, at, axis=0) / np.add.reduceat(n, at)[:, None]
        ends = np.arange(len(mean) + 1, dtype=np.int32) * dim
        return pa.table({"word": code.dictionary, "vec": pa.ListArray.from_arrays(pa.array(ends), pa.array(mean.reshape(-1)))})
    return run


class SkipGram:
    """Estimator over token lists (column ``words``; null lists and null words are left out).  Other columns, if any,
    are the rows' key: they decide which part a row is trained in."""

    def __init__(self, dim: int, min_count: int, seed: int, partitions: int):
        self.dim, self.min_count, self.seed, self.partitions = dim, min_count, seed, partitions

    def fit(self, words: DataFrame) -> WordModel:
        key = [c for c in words.columns if c != "words"] or ["words"]
        texts = stage_table(words.select(F.xxhash64(*key).alias("h"), "words"))
        tokens = texts.agg(F.sum(F.greatest(F.size("words"), F.lit(0)))).first()[0] or 0
        parts = max(self.partitions, math.ceil(tokens / PART_TOKENS))
        texts = texts.withColumn("part", F.pmod("h", F.lit(parts)))
        counts = stage_table(texts.select("part", F.explode("words").alias("word")).where("word IS NOT NULL")
                             .groupBy("part", "word").agg(F.count(F.lit(1)).alias("n")))
        often = counts.groupBy("word").agg(F.sum("n").alias("_n")).where(F.col("_n") >= self.min_count).select("word")
        local = counts.join(often, "word", "left_semi").select(
            "part", "word", "n", F.xxhash64("word", F.lit(self.seed)).alias("h"))
        trained = texts.groupBy("part").cogroup(local.groupBy("part")).applyInArrow(
            _part_trainer(self.dim, self.seed), "word string, part long, n long, vec binary")
        buckets = max(1, math.ceil(counts.count() / AVERAGED_ROWS))
        return WordModel(stage_table(trained.groupBy(F.pmod(F.xxhash64("word"), F.lit(buckets))).applyInArrow(
            _averager(self.dim), "word string, vec array<double>")))


class WordModel:
    """Word vectors as a table (word, vec)."""

    def __init__(self, table: DataFrame):
        self.table = table

    def getVectors(self) -> DataFrame:
        from pyspark.ml.functions import array_to_vector
        return self.table.select("word", array_to_vector("vec").alias("vector"))

    def findSynonyms(self, word: str, num: int) -> DataFrame:
        """(word, similarity): the ``num`` words of highest cosine with ``word``, itself left out."""
        asked = self.table.where(F.col("word") == word).select(F.col("vec").alias("_q"))
        cosine = X.dot("vec", "_q") / (X.norm("vec") * X.norm("_q"))
        return (self.table.where(F.col("word") != word).join(F.broadcast(asked)).select("word", cosine.alias("similarity"))
                .orderBy(F.desc("similarity"), F.asc("word")).limit(num))

    def write(self) -> WordModel:
        return self

    def overwrite(self) -> WordModel:
        return self

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(f"{path}/vectors")
        about = json.dumps({"class": type(self).__name__, "columns": self.table.columns})
        self.table.sparkSession.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{path}/metadata")

    @classmethod
    def load(cls, path: str) -> WordModel:
        spark = SparkSession.getActiveSession()
        return cls(spark.read.schema("word string, vec array<double>").parquet(f"{path}/vectors"))
