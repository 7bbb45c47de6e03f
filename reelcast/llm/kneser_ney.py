"""Quality classifier: interpolated modified Kneser-Ney n-gram model trained on trusted text.

The unit is the byte of the text in UTF-8 (digits folded), the order ``ORDER``; an n-gram is packed into one integer,
so counts are exact.  Word n-grams would need a row per word and document in a shuffle, several times the input.

1. One pass over all documents: each task reduces its texts to distinct n-grams with their counts in trusted text
   (0 where only other documents have them); a grouped sum gives the corpus counts.
2. Lower orders count distinct left extensions.  Discounts come from counts of counts; each order's probabilities
   join that order's counts and context totals with the order below, over the distinct n-grams that documents ask for.
3. The evaluated n-grams are split by hash into shards of at most ``SHARD_ENTRIES``; each shard is sent to all tasks
   (a proven bound of 24 MB) and adds its part of every document's log probability; the parts are summed by document.
   Texts are never shuffled.
4. A document is kept when its perplexity, drawn towards its language's mean by ``SHRINK_UNITS`` units, is at most
   the ``QUANTILE`` of its language's trusted documents that the model has not been trained on.  By their number, mean
   and quantile of a language are smoothed: the mean towards that of all languages, the quantile towards the larger of
   that of all languages and the language's mean with the spread that documents of all languages have around theirs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcast.llm.common import i64, sized_broadcast, stage_table, utf8_blocks

ORDER = 5
BITS = 8
SHARD_ENTRIES = 2_000_000
QUANTILE = 0.99
SPREAD = 0.05               # a threshold is this share above the quantile: the quantile itself is a sample's
HELD_OUT = 5                # every fifth trusted document sets thresholds instead of training the model
SHRINK_UNITS = 64           # units at the language's mean that are added to a text, so that short texts vary less
MEAN_DOCS = 10              # held-out documents at which a language's own mean has half the weight
QUANTILE_DOCS = 100         # the same for its own quantile: fewer documents hold no 0.99 quantile
FLUSH = 1_000_000           # distinct n-grams a task holds before it sends them on

_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[0x30:0x3A] = 0x30
_START = np.uint64(0x02)    # stands before a text's first byte


def packed_ngrams(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram that ends at each byte, text of each byte); before a text's first byte stand start symbols."""
    unit = _FOLD[data]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    place = np.arange(len(data)) - offsets[:-1][text]
    out = unit.copy()
    for back in range(1, order):
        before = np.full(len(unit), _START)
        before[back:] = unit[:-back] if back < len(unit) else unit[:0]
        before[place < back] = _START
        out |= before << np.uint64(BITS * back)
    return out, text


def _gather(rows: DataFrame) -> DataFrame:
    """(g, c): every n-gram of every document with its count in trusted text."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            trusted = np.asarray(batch.column(1).fill_null(False)).astype(bool)
            for lo, hi, data, offsets in utf8_blocks(batch.column(0)):
                if not len(data):
                    continue
                g, text = packed_ngrams(data, offsets)
                flag = trusted[lo:hi][text]
                order = np.argsort(g, kind="stable")
                g, c = g[order], flag[order]
                first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
                new, n = g[first], np.add.reduceat(c.astype(np.int64), first)
                both = np.concatenate([grams, new])
                grams, where = np.unique(both, return_inverse=True)
                counts = np.bincount(where, weights=np.concatenate([counts, n]), minlength=len(grams)).astype(np.int64)
                if len(grams) > FLUSH:
                    yield pa.RecordBatch.from_arrays([i64(grams), i64(counts)], names=["g", "c"])
                    grams, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(grams):
            yield pa.RecordBatch.from_arrays([i64(grams), i64(counts)], names=["g", "c"])

    return stage_table(rows.select("text", "trusted").mapInArrow(count, "g long, c long")
                       .groupBy("g").agg(F.sum("c").alias("c")))


def discounts(counts_of_counts: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of n-grams seen once, twice, and more often; an order with too few counts has
    0.5, 0.75 and 0.9."""
    n1, n2, n3, n4 = (counts_of_counts.get(i, 0) for i in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), top) for d, top in zip(raw, (0.95, 1.95, 2.95)))


def probabilities(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(g, p) for every n-gram in ``counts`` (g, c): interpolated modified Kneser-Ney probability of its last unit,
    with c = 0 for n-grams that were only asked for."""
    low = lambda k: (1 << BITS * k) - 1
    seen = {order: counts.where("c > 0")}
    for k in range(order - 1, 0, -1):
        seen[k] = stage_table(seen[k + 1].groupBy(F.col("g").bitwiseAND(low(k)).alias("g")).agg(
            F.count(F.lit(1)).alias("c")))
    asked = {order: counts.select("g")}
    for k in range(order - 1, 0, -1):
        asked[k] = asked[k + 1].select(F.col("g").bitwiseAND(low(k)).alias("g")).distinct()
    p = None
    for k in range(1, order + 1):
        table = {r["c"]: r["n"] for r in seen[k].where("c <= 4").groupBy("c").agg(
            F.count(F.lit(1)).alias("n")).collect()}
        d1, d2, d3 = discounts(table)
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        grams = seen[k].select("g", "c", F.greatest(F.col("c") - cut, F.lit(0.0)).alias("rest"), cut.alias("cut"))
        context = grams.groupBy(F.shiftright("g", BITS).alias("h")).agg(
            F.sum("c").alias("total"), F.sum("cut").alias("freed"))
        have = asked[k].join(grams.select("g", "rest"), "g", "left").withColumn("h", F.shiftright("g", BITS))
        have = have.join(context, "h", "left")
        share = F.coalesce(F.col("rest") / F.col("total"), F.lit(0.0))
        back = F.coalesce(F.col("freed") / F.col("total"), F.lit(1.0))
        if p is None:
            below = F.lit(1.0 / (1 << BITS))
        else:
            have = have.withColumn("b", F.col("g").bitwiseAND(low(k - 1))).join(
                p.withColumnsRenamed({"g": "b", "p": "p_below"}), "b")
            below = F.col("p_below")
        p = stage_table(have.select("g", (share + back * below).alias("p")))
    return p


def _add_up(rows: DataFrame, grams: np.ndarray, logs: np.ndarray) -> DataFrame:
    """(key, id, lang, known, log_p, n) over the units whose n-gram is in this shard."""
    shared = rows.sparkSession.sparkContext.broadcast((grams, logs))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, value = shared.value
        for batch in batches:
            for lo, hi, data, offsets in utf8_blocks(batch.column(4)):
                g, text = packed_ngrams(data, offsets)
                at = np.minimum(np.searchsorted(table, g), max(len(table) - 1, 0))
                hit = table[at] == g if len(table) else np.zeros(len(g), bool)
                log_p = np.bincount(text[hit], weights=value[at[hit]], minlength=hi - lo)
                n = np.bincount(text[hit], minlength=hi - lo)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(4)] + [
                    pa.array(log_p, pa.float64()), pa.array(n, pa.int64())],
                    names=["key", "id", "lang", "known", "log_p", "n"])

    kind = dict(rows.dtypes)["id"]
    return rows.select("key", "id", "lang", "known", "text").mapInArrow(
        score, f"key long, id {kind}, lang string, known boolean, log_p double, n long")


def classify(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", quantile: float = QUANTILE, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """(id, lang, n_units, perplexity, shrunk, threshold, trusted, kept), one row per input row.

    ``trusted`` names the ids (column ``id_col``) of the text that trains the model and, every fifth by a hash of the
    id, sets the thresholds.  A language without trusted
    documents has the threshold of all trusted documents together; without any trusted text every unit is equally
    likely, there is no threshold, and every document with text is kept.  Null or empty texts have no perplexity and are
    not kept; a null language is a language of its own; of rows that share an id all are trusted or none; a row
    repeated whole counts and comes back as often as it stands there.  The result does not depend on ``shard_entries``.
    Other columns are not read; an empty table gives an empty result.
    """
    names = sized_broadcast(trusted.select(F.col(id_col).alias("t_id")).where("t_id IS NOT NULL").distinct())
    rows = df.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), F.col(id_col).alias("id"),
                     F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(names, F.col("id") == F.col("t_id"), "left").withColumn("known", F.col("t_id").isNotNull())
    held = F.pmod(F.xxhash64("id"), F.lit(HELD_OUT)) == 0
    rows = rows.withColumn("trusted", F.col("known") & ~held)
    model = stage_table(probabilities(_gather(rows)).select("g", F.log("p").cast("float").alias("l")))
    shards = max(1, -(-model.count() // shard_entries))
    scored = None
    for shard in range(shards):
        part = model.where(F.pmod(F.xxhash64("g"), F.lit(shards)) == shard).toArrow()
        grams = np.asarray(part["g"].combine_chunks(), np.int64).astype(np.uint64)
        order = np.argsort(grams)
        # multiples of 2**-20 add up exactly, so sums are equal in any order and for any number of shards
        logs = np.round(np.asarray(part["l"].combine_chunks(), np.float64)[order] * 2.0 ** 20) / 2.0 ** 20
        one = _add_up(rows, grams[order], logs)
        scored = one if scored is None else scored.union(one)
    if shards > 1:
        # rows repeated whole share a group: it holds ``copies`` rows of each shard, and gives ``copies`` rows again
        copies = (F.count(F.lit(1)) / shards).cast("long")
        scored = scored.groupBy("key", "id", "lang", "known").agg(
            F.sum("log_p").alias("log_p"), F.sum("n").alias("n"), copies.alias("copies")).select(
            "key", "id", "lang", "known", (F.col("log_p") / F.col("copies")).alias("log_p"),
            (F.col("n") / F.col("copies")).cast("long").alias("n"),
            F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("col")
    scored = stage_table(scored.withColumn("l_lang", F.coalesce("lang", F.lit(""))))
    sample = scored.where(F.col("known") & held & (F.col("n") > 0))
    mean = -F.sum("log_p") / F.sum("n")
    overall = sample.agg(mean.alias("m")).collect()[0]["m"]
    centre = (F.col("docs") * F.col("own_mean") + MEAN_DOCS * F.lit(overall).cast("double")) / (
        F.col("docs") + MEAN_DOCS)
    means = sized_broadcast(stage_table(sample.groupBy("l_lang").agg(mean.alias("own_mean"), F.count(F.lit(1)).alias(
        "docs")).withColumn("mean", centre)))

    def shrunk(frame: DataFrame) -> DataFrame:
        at = F.coalesce(F.col("mean"), F.lit(overall).cast("double"), F.lit(0.0))
        return frame.join(means, "l_lang", "left").withColumn("shrunk", F.when(F.col("n") > 0, F.exp(
            (-F.col("log_p") + SHRINK_UNITS * at) / (F.col("n") + SHRINK_UNITS)))).drop("mean")

    cut = lambda x: F.percentile_approx(x, quantile, 100_000)
    limits = stage_table(shrunk(sample))
    by_lang = sized_broadcast(stage_table(limits.groupBy("l_lang").agg(cut(F.col("shrunk")).alias("own"))))
    # the quantile over all languages, and how far it lies above a language's own mean
    every, above = limits.agg(cut(F.col("shrunk")), cut(F.col("shrunk") / F.exp("own_mean"))).collect()[0]
    every, above = F.lit(every).cast("double"), F.greatest(F.lit(above).cast("double"), F.lit(1.0))
    # a mean over few documents is uncertain itself: the spread of a new document around it is wider
    likely = F.greatest(every, F.exp("own_mean") * F.pow(above, F.sqrt(1 + 1 / F.col("docs"))))
    smoothed = (F.col("docs") * F.col("own") + QUANTILE_DOCS * likely) / (F.col("docs") + QUANTILE_DOCS)
    limit = F.coalesce(smoothed, every) * (1 + SPREAD)
    out = shrunk(scored).join(by_lang, "l_lang", "left").withColumn("threshold", limit)
    keep = F.coalesce(F.col("shrunk") <= F.coalesce("threshold", F.lit(float("inf"))), F.lit(False))
    return out.select(
        F.col("id").alias(id_col), "lang", F.col("n").alias("n_units"),
        F.when(F.col("n") > 0, F.exp(-F.col("log_p") / F.col("n"))).alias("perplexity"), "shrunk", "threshold",
        F.col("known").alias("trusted"), keep.alias("kept"))


def op1_kneser_ney(spark, sf_dir: str) -> DataFrame:
    """Trained on the documents that ``labels`` calls good and not toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1 AND toxic = 0")
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels.select("doc_id"))
