"""Benchmark decontamination by a distributed positional inverted index, in DataFrame functions only.

1. Every benchmark item is cut into windows of ``WINDOW`` consecutive words (a shorter item is one window).
2. The corpus counts of all benchmark words give each window's two rarest terms.
3. The index stores the postings (term, document, position) of those terms.
4. Each posting is moved back by its term's offset in the window; the lists of the two terms are intersected on
   (window, document, start).  Equal starts are phrase candidates, starts within ``SLOP`` are proximity matches.
5. Candidates are verified word by word against their document, so hashes and rare terms never decide a hit.

Only postings of the rarest terms are shuffled, so common words cost no data movement.  Every side that is broadcast
was counted before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelcast.llm.common import lower_ascii, settled, sized_broadcast, stage_table

WINDOW = 10
SLOP = 3
# everything that is no word character (fixed value): ASCII other than digits and lower-case letters
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), SEPARATORS), "")


def item_windows(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(item, phrase, size): every window of every item; the phrase is its words joined by spaces."""
    w = items.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - F.lit(width), F.lit(0)))
    out = w.withColumn("at", F.explode(starts))
    part = F.slice("w", F.col("at") + 1, F.lit(width))
    return out.select("item", F.array_join(part, " ").alias("phrase"), F.size(part).alias("size")).distinct()


def corpus_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row key, position, term): the row key hashes id and text, so rows that share an id are kept apart."""
    return docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"),
                       F.posexplode(words(F.col(text_col))).alias("pos", "term"))


def rarest_terms(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(phrase, size, n, term, offset): the two rarest distinct terms of every window (n = 1, 2) with the offset of
    their first occurrence; a window of one distinct term names it twice."""
    terms = windows.select("phrase", "size").distinct().select(
        "phrase", "size", F.posexplode(F.split("phrase", " ")).alias("offset", "term"))
    terms = terms.groupBy("phrase", "size", "term").agg(F.min("offset").alias("offset"))
    ranked = terms.join(sized_broadcast(counts), "term", "left").groupBy("phrase", "size").agg(F.slice(F.array_sort(
        F.collect_list(F.struct(F.coalesce("n_corpus", F.lit(0)).alias("n"), "term", "offset"))), 1, 2).alias("best"))
    pairs = F.array(F.col("best")[0], F.coalesce(F.get("best", F.lit(1)), F.col("best")[0]))
    return ranked.select("phrase", "size", F.posexplode(pairs).alias("n", "t")).select(
        "phrase", "size", "n", F.col("t.term").alias("term"), F.col("t.offset").alias("offset"))


def candidates(docs: DataFrame, windows: DataFrame, id_col: str, text_col: str, slop: int = SLOP) -> DataFrame:
    """(phrase, size, key, start, exact): starts at which both rarest terms of a window stand, exactly or within
    ``slop`` words of their places."""
    vocabulary = windows.select(F.explode(F.split("phrase", " ")).alias("term")).distinct()
    counts = stage_table(corpus_words(docs, id_col, text_col).join(sized_broadcast(vocabulary), "term")
                         .groupBy("term").agg(F.count(F.lit(1)).alias("n_corpus")))
    chosen = stage_table(rarest_terms(windows, counts))
    postings = corpus_words(docs, id_col, text_col).join(
        sized_broadcast(chosen.select("term").distinct()), "term", "left_semi")
    lists = stage_table(postings.join(sized_broadcast(chosen), "term").select(
        "phrase", "size", "key", "n", (F.col("pos") - F.col("offset")).alias("start")))
    first = lists.where("n = 0").select("phrase", "size", "key", "start",
                                        F.floor(F.col("start") / (slop + 1)).alias("cell"))
    second = lists.where("n = 1").select(
        "phrase", "key", F.col("start").alias("start2"),
        F.explode(F.array(*[F.floor(F.col("start") / (slop + 1)) + d for d in (-1, 0, 1)])).alias("cell"))
    both = first.join(second, ["phrase", "key", "cell"]).where(F.abs(F.col("start") - F.col("start2")) <= slop)
    return both.groupBy("phrase", "size", "key", "start").agg(
        F.max(F.col("start") == F.col("start2")).alias("exact"))


def covered(spans: Column) -> Column:
    """Number of positions in the union of (start, size) spans that are sorted by start."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))

    def step(acc, s):
        end = (s["start"] + s["size"]).cast("long")
        fresh = F.greatest(end - F.greatest(acc["to"], s["start"].cast("long")), F.lit(0).cast("long"))
        return F.struct((acc["n"] + fresh).alias("n"), F.greatest(acc["to"], end).alias("to"))

    return F.aggregate(spans, zero, step, lambda acc: acc["n"])


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", width: int = WINDOW,
                  slop: int = SLOP) -> DataFrame:
    """(id, n_words, n_hit, n_items, items, items_sha256, n_near, contaminated), one row per distinct input row.

    ``n_hit`` counts document words inside any exact occurrence of a window, ``n_items`` the items with an occurring
    window, ``n_near`` the items of which some window's two rarest terms stand within ``slop`` words of their places.
    Null or empty texts and texts without words have no words and no hits; items without words are never found; an
    empty benchmark hits nothing; null ids are ids like others; rows repeated whole give one row; other columns are
    not read.
    """
    windows = stage_table(item_windows(items, item_col, item_text_col, width))
    found = stage_table(candidates(docs, windows, id_col, text_col, slop))
    members = sized_broadcast(windows.select("phrase", "item"))
    texts = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), F.col(id_col).alias("id"),
                        F.col(text_col).alias("text"))
    base = texts.select("key", "id", F.size(words(F.col("text"))).cast("long").alias("n_words")).distinct()

    exact = found.where("exact").groupBy("key").agg(F.collect_list(F.struct("start", "size", "phrase")).alias("spans"))
    keys = sized_broadcast(exact.select(F.col("key").alias("hit_key")))
    hit_texts = texts.join(keys, F.col("key") == F.col("hit_key"), "left_semi")
    in_place = lambda s: F.array_join(F.slice("w", s["start"] + 1, s["size"]), " ") == s["phrase"]
    checked = stage_table(hit_texts.select("key", "id", words(F.col("text")).alias("w")).join(exact, "key").select(
        "key", "id", F.array_sort(F.filter("spans", lambda s: (s["start"] >= 0) & in_place(s))).alias("spans"))
        .where(F.size("spans") > 0).distinct())
    hits = checked.select("key", "id", covered(F.col("spans")).alias("n_hit"))
    named = (checked.select("key", "id", F.explode(F.array_distinct(F.transform("spans", lambda s: s["phrase"])))
                            .alias("phrase")).join(members, "phrase")
             .groupBy("key", "id").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items")))
    near = found.join(members, "phrase").groupBy("key").agg(F.countDistinct("item").alias("n_near"))

    def attach(left: DataFrame, right: DataFrame, by_id: bool = True) -> DataFrame:
        right = right.withColumnsRenamed({"key": "r_key", "id": "r_id"})
        on = left["key"] == right["r_key"]
        return left.join(right, on & left["id"].eqNullSafe(right["r_id"]) if by_id else on, "left").drop("r_key", "r_id")

    none = F.lit(0).cast("long")
    out = attach(attach(attach(base, hits), named), near, by_id=False).withColumns({
        "n_hit": F.coalesce("n_hit", none), "items": F.coalesce("items", F.array().cast("array<string>"))})
    return out.select(
        F.col("id").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), F.coalesce("n_near", none).alias("n_near"),
        (F.col("n_hit") > 0).alias("contaminated"))


def phrase_matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", width: int = WINDOW,
                   slop: int = SLOP) -> DataFrame:
    """(id, item, phrase, start, size, exact): every match of a window of an item, by word position in the document.

    ``exact`` matches are verified word by word.  The others are proximity matches: the window's two rarest terms
    stand within ``slop`` words of their places around ``start`` (which may lie before the text), and the window does
    not stand there itself.  Documents and items as in :func:`decontaminate`; a window of one distinct term has exact
    matches and, where that term is repeated nearby, proximity matches."""
    windows = stage_table(item_windows(items, item_col, item_text_col, width))
    found = stage_table(candidates(docs, windows, id_col, text_col, slop))
    keys = sized_broadcast(found.select("key").distinct())
    texts = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), F.col(id_col).alias("id"),
                        F.col(text_col).alias("text")).join(keys, "key", "left_semi")
    placed = found.join(texts.select("key", "id", words(F.col("text")).alias("w")).dropDuplicates(["key", "id"]), "key")
    here = F.when(F.col("start") >= 0, F.array_join(F.slice("w", F.col("start") + 1, F.col("size")), " "))
    return placed.withColumn("exact", F.coalesce(here == F.col("phrase"), F.lit(False))).join(
        sized_broadcast(windows.select("phrase", "item")), "phrase").select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "phrase", "start", "size", "exact")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any hit, all their columns unchanged."""
    bad = sized_broadcast(settled(docs.sparkSession, lambda: decontaminate(docs, items, id_col, text_col).where(
        "contaminated").select(F.col(id_col).alias("_bad_id"))))
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_bad_id"]), "left_anti")


def op7_positional_index(spark, sf_dir: str) -> DataFrame:
    return decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                         spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("items", "n_near")


ORACLE_SQL = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT item_id, least(len(w), {WINDOW}) AS size, unnest(range(0, greatest(len(w) - {WINDOW}, 0) + 1)) AS p0, w
  FROM i WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, size, array_to_string(w[p0 + 1: p0 + size], ' ') AS phrase FROM iw),
sizes AS (SELECT DISTINCT size FROM win),
dp AS (
  SELECT doc_id, size, w, unnest(range(0, len(w) - size + 1)) AS p0 FROM d, sizes WHERE len(w) >= size),
dw AS (SELECT doc_id, size, p0, array_to_string(w[p0 + 1: p0 + size], ' ') AS phrase FROM dp),
hit AS (SELECT dw.doc_id, dw.p0, dw.size, item_id FROM dw JOIN win USING (phrase, size)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(p0, p0 + size)) AS p FROM (SELECT DISTINCT doc_id, p0, size FROM hit)) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (
    SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
