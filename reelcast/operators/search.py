"""Title search: queries matched to titles by shared distinct tokens.

Titles are reduced to the tokens that some query has.  A lower bound of each query's K-th best count decides how many
of its commonest tokens can be left out of the candidate join; candidates are completed from their own tokens, and only
the best ``TOP_K`` titles of each query (a stated parameter) leave the operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelcast.functions import text as TX
from reelcast.operators.ranking import top_k
from reelcast.session import stage_table

# FIXED VALUE: a match must share at least one token with a CJK character
HAN_REQUIRED = "[一-龥]"
TOP_K = 100
SEED_SHARE = 0.02           # share of the titles, those with most query tokens, that is counted whole to get the bounds
EXTRA = 1                   # tokens that a candidate must share beyond the first before it is completed


def tokenize_queries(df: DataFrame, id_col: str, text_col: str, normalize: bool = True, tokenizer=None) -> DataFrame:
    """(id, distinct tokens) of each query; file-style names are normalised first."""
    tok = tokenizer or TX.tokenize_words
    t = TX.normalize_release_name(F.col(text_col)) if normalize else F.col(text_col)
    return df.select(F.col(id_col).alias("qid"), F.array_distinct(tok(t)).alias("words"))


def tokenize_targets(df: DataFrame, id_col: str, text_col: str, tokenizer=None) -> DataFrame:
    tok = tokenizer or TX.tokenize_words
    return df.select(F.col(id_col).alias("tid"), F.array_distinct(tok(F.col(text_col))).alias("words"))


def query_tokens(queries: DataFrame) -> DataFrame:
    """(query_id, token): the distinct tokens of each query."""
    return queries.select(F.col("qid").alias("query_id"), F.explode("words").alias("token")).distinct()


def short_titles(targets: DataFrame, tokens: DataFrame) -> DataFrame:
    """(movie_id, tokens): what a title shares with any query; titles that share nothing have no row."""
    rows = targets.select(F.col("tid").alias("movie_id"), F.explode("words").alias("token"))
    wanted = rows.join(tokens.select("token").distinct(), "token", "left_semi")
    return wanted.groupBy("movie_id").agg(F.collect_set("token").alias("tokens"))


def kth_counts(q: DataFrame, titles: DataFrame, required: str, k: int) -> DataFrame:
    """(query_id, bound): the ``k``-th best count among ``titles`` only, which the final ``k``-th count can't be below;
    queries that match fewer titles have no row."""
    pairs = titles.select("movie_id", F.explode("tokens").alias("token")).join(q, "token")
    counts = pairs.groupBy("query_id", "movie_id").agg(
        F.count(F.lit(1)).alias("num"), F.max(F.col("token").rlike(required)).alias("ok"))
    best = top_k(counts.where("ok"), ["query_id"], [F.desc("num"), F.asc("movie_id")], k, "sort")
    return best.where(F.col("sort") == k).select("query_id", F.col("num").alias("bound"))


def bounded_candidates(q: DataFrame, titles: DataFrame, bounds: DataFrame, extra: int = EXTRA) -> DataFrame:
    """(query_id, movie_id): all titles that can share ``bound`` tokens with a query.

    Of a query's ``n`` tokens, rarest first, such a title has at least ``1 + e`` of the first ``n - bound + 1 + e``, so
    the posting lists of the commoner ones aren't read and titles with fewer are left out; ``e`` is ``extra``, or what
    the bound allows."""
    postings = titles.select("movie_id", F.explode("tokens").alias("token"))
    found = q.join(postings.groupBy("token").agg(F.count(F.lit(1)).alias("titles")), "token")
    n = Window.partitionBy("query_id")                      # one query's distinct tokens
    bound = F.coalesce("bound", F.lit(1))
    ranked = found.withColumn("n", F.count(F.lit(1)).over(n)).withColumn(
        "place", F.row_number().over(n.orderBy("titles", "token"))).join(bounds, "query_id", "left").withColumn(
        "e", F.least(F.lit(extra), bound - 1))
    rare = ranked.where(F.col("place") <= F.col("n") - bound + 1 + F.col("e"))
    met = rare.select("query_id", "token", "e").join(postings, "token").groupBy("query_id", "movie_id").agg(
        F.count(F.lit(1)).alias("met"), F.max("e").alias("e"))
    return met.where(F.col("met") > F.col("e")).select("query_id", "movie_id")


def title_search(queries: DataFrame, targets: DataFrame, required: str = HAN_REQUIRED, k: int = TOP_K) -> DataFrame:
    """(query_id, movie_id, num, words, sort): the ``k`` titles of each query that share most distinct tokens (id
    ascending on ties); pairs whose shared tokens have no character of ``required`` are no match.

    Titles are tokenised once and kept as the tokens that some query has.  The ``k``-th best count among the titles
    that have most of them bounds each query's result from below; only titles that can reach it are completed, from
    their own tokens.  Titles that tie with the bound are completed too, so the result is that of counting every pair."""
    q = stage_table(query_tokens(queries))
    titles = stage_table(short_titles(targets, q))
    rich = titles.select(F.percentile_approx(F.size("tokens"), F.lit(1.0 - SEED_SHARE))).scalar()
    seed = titles.where(F.size("tokens") >= rich)
    bounds = stage_table(kth_counts(q, seed, required, k))
    words = q.groupBy("query_id").agg(F.collect_list("token").alias("wanted"))
    full = bounded_candidates(q, titles, bounds).join(titles, "movie_id").join(words, "query_id").select(
        "query_id", "movie_id", F.array_intersect("tokens", "wanted").alias("shared"))
    ok = F.exists("shared", lambda t: t.rlike(required))
    best = top_k(full.where(ok).select("query_id", "movie_id", F.size("shared").cast("bigint").alias("num"), "shared"),
                 ["query_id"], [F.desc("num"), F.asc("movie_id")], k, "sort")
    return best.select("query_id", "movie_id", "num", F.array_join(F.array_sort("shared"), " ").alias("words"), "sort")


def agg_token_hits(queries: DataFrame, targets: DataFrame, required: str = HAN_REQUIRED, k: int = TOP_K) -> DataFrame:
    """(query_id, movie_id, num, words) of the ``k`` best titles of each query."""
    return title_search(queries, targets, required, k).drop("sort")


def best_query_match(queries: DataFrame, targets: DataFrame, required: str = HAN_REQUIRED) -> DataFrame:
    """The single best title per query (the online form)."""
    return title_search(queries, targets, required, 1)


def rows_to_json(df: DataFrame, n: int | None = None) -> DataFrame:
    """Rows as JSON strings (``limit`` only when a count is asked for)."""
    out = df.select(F.to_json(F.struct(*df.columns)).alias("json"))
    return out.limit(n) if n else out
