"""Language identification by Bayesian fusion of four kinds of evidence.

* text: hashed byte-trigram likelihoods per language, counted over the whole corpus by declared language;
* declared markup language: how often each language's texts declare each language (grouped counts, smoothed);
* address suffix and host: priors by grouped aggregation, smoothed hierarchically (host towards its suffix, suffix
  towards the corpus), the document's own vote left out.

posterior(l) ~ prior(l | host) * P(declared | l) * P(text | l) ** TEMPER.

What is sent to every task has a fixed bound: FEATURES counters for each language code, and codes have two or three
letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcast.llm.common import SMALL_BLOCK, lean, sized_broadcast, small_batches, stage_table, sum_vectors, utf8_blocks

FEATURES = 1 << 15
TEMPER = 0.2                # neighbouring trigrams overlap: their joint evidence is scaled down
SMOOTHING = 0.5             # added to every trigram count
HOST_WEIGHT, SUFFIX_WEIGHT = 20.0, 50.0     # pseudo-documents of the level above
MIN_POSTERIOR = 0.5
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[c for c in range(128) if not chr(c).isalpha()]] = 32


def code_of(column):
    """Two- or three-letter primary code of a declared language; null where there is none."""
    code = F.regexp_extract(F.lower(F.trim(column)), "^([a-z]{2,3})(?:[-_].*)?$", 1)
    return F.when(code != "", code)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text) of every byte trigram that holds a letter and lies within one text."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = _FOLD[data]
    gram = low[:-2] << np.uint32(16) | low[1:-1] << np.uint32(8) | low[2:]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keep = (text[2:] == text[:-2]) & (gram != 0x202020)
    feature = (gram * np.uint32(0x9E3779B1)) >> np.uint32(17)
    return feature[keep].astype(np.int64), text[:-2][keep]


def _language_counts(rows: DataFrame) -> dict[str, np.ndarray]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            codes = batch.column(0).to_pylist()
            for lo, hi, data, offsets in utf8_blocks(batch.column(1), SMALL_BLOCK):
                feature, text = trigrams(data, offsets)
                names, number = np.unique(np.array(codes[lo:hi], dtype=object).astype(str), return_inverse=True)
                table = np.bincount(number[text] * FEATURES + feature, minlength=len(names) * FEATURES)
                for i, name in enumerate(names):
                    part = table[i * FEATURES:(i + 1) * FEATURES]
                    sums[name] = sums.get(name, 0) + part
        if sums:
            task = TaskContext.get().partitionId() % 64
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([task] * len(sums), pa.int32()),
                 pa.array([x.astype(np.int64).tobytes() for x in sums.values()], pa.binary())],
                names=["code", "task", "counts"])

    told = small_batches(rows.where("declared IS NOT NULL").select("declared", "text"))
    found = sum_vectors(told.mapInArrow(lean(count), "code string, task int, counts binary"), "code", "string").collect()
    return {r["code"]: np.frombuffer(r["counts"], np.int64) for r in sorted(found, key=lambda r: r["code"])}


def _scores(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """(id, declared, host, suffix, n_grams, ll): log likelihood of each text by language."""
    shared = rows.sparkSession.sparkContext.broadcast(table)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            for lo, hi, data, offsets in utf8_blocks(batch.column(4), SMALL_BLOCK):
                feature, text = trigrams(data, offsets)
                n = np.bincount(text, minlength=hi - lo)
                ll = np.stack([np.bincount(text, weights=w[feature], minlength=hi - lo) for w in weights], axis=1)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(hi - lo + 1) * ll.shape[1], pa.int32()), pa.array(ll.ravel(), pa.float64()))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(4)] + [pa.array(n, pa.int64()), lists],
                    names=["id", "declared", "host", "suffix", "n_grams", "ll"])

    kinds = dict(rows.dtypes)
    return rows.select("id", "declared", "host", "suffix", "text").mapInArrow(
        lean(score), f"id {kinds['id']}, declared string, host string, suffix string, n_grams long, ll array<double>")


def _counts_by(scored: DataFrame, keys: list[str], n: int, name: str) -> DataFrame:
    """Votes of the text evidence by language, as an array, for each value of ``keys``."""
    sums = [F.sum(F.when(F.col("vote") == i, 1).otherwise(0)) for i in range(n)]
    return scored.where("vote >= 0").groupBy(*keys).agg(F.array(*sums).alias(name))


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str | None = "lang",
             host_col: str | None = "source") -> DataFrame:
    """(id, lang, posterior, n_grams, declared, kept), one row per input row.

    A document is kept when its text has letters and the best language's posterior reaches ``MIN_POSTERIOR``;
    else its language is ``und``.  Null or empty text, or text without letters: not kept.  A null or malformed
    declaration is no evidence, a null host is one host of its own without suffix, ties go to the first code.  With
    no declared language in the whole table nothing can be learned and nothing is kept.  Other columns are not
    read; an empty table gives an empty result.
    """
    empty = F.lit(None).cast("string")
    host = F.coalesce(F.lower(F.col(host_col).cast("string")), F.lit("")) if host_col else F.lit("")
    rows = df.select(F.col(id_col).alias("id"), (code_of(F.col(declared_col)) if declared_col else empty).alias(
        "declared"), host.alias("host"), F.regexp_extract(host, r"\.([^.]+)$", 1).alias("suffix"),
        F.col(text_col).cast("string").alias("text"))
    counts = _language_counts(rows)
    codes = list(counts)
    n = len(codes)
    if not n:
        return rows.select(F.col("id").alias(id_col), F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("posterior"),
                           F.lit(0).cast("long").alias("n_grams"), "declared", F.lit(False).alias("kept"))
    grams = np.stack([np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * FEATURES)) for c in counts.values()])
    scored = _scores(rows, grams)
    best = F.array_position("ll", F.array_max("ll")) - 1
    scored = stage_table(scored.withColumn("vote", F.when(F.col("n_grams") > 0, best).otherwise(-1).cast("int")))

    zero = F.array(*[F.lit(0).cast("long")] * n)
    by_declared = {r["declared"]: r["v"] for r in _counts_by(
        scored.where("declared IS NOT NULL"), ["declared"], n, "v").collect()}
    votes = np.array([by_declared.get(c, [0] * n) for c in codes], float)       # declared x language
    told = np.log((votes + 1) / (votes.sum(axis=0) + n))
    total = (votes.sum(axis=0) + 1) / (votes.sum() + n)
    told_by = F.create_map(*[x for i, c in enumerate(codes)
                             for x in (F.lit(c), F.array(*[F.lit(float(v)) for v in told[i]]))])

    hosts = _counts_by(scored, ["host", "suffix"], n, "host_votes")
    suffixes = _counts_by(scored, ["suffix"], n, "suffix_votes")
    levels = stage_table(hosts.join(suffixes, "suffix"))
    joined = scored.join(levels.drop("suffix"), "host", "left").withColumns({
        "host_votes": F.coalesce("host_votes", zero), "suffix_votes": F.coalesce("suffix_votes", zero)})

    def parts(i: int):
        own = (F.col("vote") == i).cast("double")
        own_any = (F.col("vote") >= 0).cast("double")
        add = lambda name: F.aggregate(name, F.lit(0).cast("long"), lambda a, x: a + x)
        level2 = (F.col("suffix_votes")[i] - own + SUFFIX_WEIGHT * float(total[i])) / (
            add("suffix_votes") - own_any + SUFFIX_WEIGHT)
        prior = (F.col("host_votes")[i] - own + HOST_WEIGHT * level2) / (add("host_votes") - own_any + HOST_WEIGHT)
        declared = F.coalesce(told_by[F.col("declared")][i], F.lit(0.0))
        return F.log(prior) + declared + TEMPER * F.col("ll")[i]

    weights = joined.select("id", "declared", "n_grams", F.array(*[parts(i) for i in range(n)]).alias("w"))
    top = F.array_max("w")
    mass = F.aggregate("w", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    names = F.array(*[F.lit(c) for c in codes])
    judged = weights.select("id", "declared", "n_grams", (1 / mass).alias("posterior"),
                            F.element_at(names, F.array_position("w", top).cast("int")).alias("best"))
    accepted = (F.col("n_grams") > 0) & (F.col("posterior") >= MIN_POSTERIOR)
    return judged.select(F.col("id").alias(id_col), F.when(accepted, F.col("best")).otherwise(UNKNOWN).alias("lang"),
                         "posterior", "n_grams", "declared", accepted.alias("kept"))


def keep_identified(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str = "lang",
                    host_col: str = "source") -> DataFrame:
    """The rows of ``df`` whose language was named, all their columns unchanged."""
    out = sized_broadcast(stage_table(identify(df, id_col, text_col, declared_col, host_col).where("NOT kept").select(
        F.col(id_col).alias("_bad_id"))))
    return df.join(out, df[id_col].eqNullSafe(out["_bad_id"]), "left_anti")


def op2_language_evidence(spark, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def page_language(spark, sf_dir: str) -> DataFrame:
    """The same over raw web pages: declared by the markup's ``lang`` attribute, host and suffix from the address."""
    from reelcast.llm.url_automaton import split_url
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    body = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>|&[a-z]+;", " ")
    rows = pages.select("page_id", F.regexp_extract("html", r"""(?i)<html\b[^>]*\blang\s*=\s*["']?([A-Za-z-]+)""", 1)
                        .alias("declared"), split_url(F.col("url"))[0].alias("host"), body.alias("body"))
    return identify(rows, "page_id", "body", "declared", "host")
