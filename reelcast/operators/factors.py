"""Item factors: popularity, score, year, length, trailers, episode totals.

Global scalars (max play count, mean score) are scalar subqueries: partially
aggregated one-row results, no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelcast import config as C
from reelcast.functions import columns as X


def agg_hot_count(catalog: DataFrame, plays: DataFrame, as_of, days: int = C.HOT_DAYS) -> DataFrame:
    """Play count per catalogue item over the last ``days`` (date > yyyymmdd
    of as_of - days, strictly); items without plays get 0.

    catalog: (id, title, cid); plays: (aid, date yyyymmdd int, count)."""
    lo = X.yyyymmdd(as_of, days)
    counts = plays.where(F.col("date") > F.lit(lo)).groupBy("aid").agg(F.sum("count").alias("weight"))
    out = catalog.join(counts, catalog["id"] == counts["aid"], "left")
    return out.select(F.col("id").alias("aid"), "title", "cid",
                      F.coalesce(F.col("weight"), F.lit(0)).cast("bigint").alias("weight"))


def rank_in_channel(df: DataFrame, value: str, key="aid", channel="cid") -> DataFrame:
    """Rank per channel by ``value`` desc, id asc.  A channel can hold a large
    share of the catalogue, so the rank is the skew-safe one."""
    from reelcast.operators.ranking import rank_all
    return rank_all(df, [channel], [F.desc(value), F.asc(key)], "sort_num")


def hot_factor(hot_sort: DataFrame) -> DataFrame:
    """``1 / (ln(max - w + 1) + 1)`` with max over all channels, round 8."""
    out = hot_sort.withColumn("_mx", hot_sort.select(F.max("weight")).scalar())
    return out.select("aid", "title", "cid", F.col("weight").alias("play_num"),
                      F.round(X.log_decay(F.col("_mx") - F.col("weight")), 8).alias("factor"),
                      *(["sort_num"] if "sort_num" in hot_sort.columns else []))


def score_factor(catalog: DataFrame) -> DataFrame:
    """Null or zero score -> mean of positive scores; >= 7 log decay, else
    exponential decay; round 4.  The raw score is kept."""
    out = catalog.withColumn("_mean", catalog.where(F.col("score") > 0).select(F.avg("score")).scalar())
    s = F.when(F.col("score").isNull() | (F.col("score") == 0), F.col("_mean")).otherwise(F.col("score"))
    return out.select(F.col("id").alias("aid"), "title", "cid", "score", X.score_factor(s).alias("factor"))


def year_factor(catalog: DataFrame, now_year: int, cate_id=None, variety=C.VARIETY) -> DataFrame:
    """Unparsable / <=0 / future year -> now-5; variety (1971) log2 decay,
    others ``1/2^(delta/10)``; round 4; original year kept."""
    y = X.clean_year("year", now_year)
    if cate_id is not None:
        is_var = F.lit(cate_id == variety)
    else:
        is_var = F.coalesce(F.col("cid") == F.lit(variety), F.lit(False))
    return catalog.select(F.col("id").alias("movie_id"), "year", X.year_factor(y, now_year, is_var).alias("factor"))


def movie_length(source: DataFrame, item="aid", seconds=None, bound: int = C.ITEM_LENGTH_BOUND) -> DataFrame:
    """Item length in whole minutes: payload ``len`` seconds (or a seconds
    column), smallest per item (single episode), kept when < bound."""
    sec = X.json_long("extra", "$.len") if seconds is None else (F.col(seconds) if isinstance(seconds, str) else seconds)
    ln = (sec / F.lit(60)).cast("bigint")
    per = source.select(F.col(item).alias("movie_id"), ln.alias("movie_len")).na.drop()
    return per.groupBy("movie_id").agg(F.min("movie_len").alias("movie_len")).where(F.col("movie_len") < bound)


def trailer_ids(source: DataFrame) -> DataFrame:
    """Items with a trailer flag on an internal source (auth 1, source 12)."""
    cols = ["aid", "auth"] + (["title"] if "title" in source.columns else [])
    return (source.where((F.col("auth") == C.AUTH_TRAILER) & (F.col("source") == C.SOURCE_INTERNAL))
            .groupBy("aid").agg(*[F.min(c).alias(c) for c in cols if c != "aid"]))


def short_single_episode(source: DataFrame, seconds=None, minutes: int = 60) -> DataFrame:
    """Internal single-episode items shorter than ``minutes``."""
    sec = X.json_double("extra", "$.len") if seconds is None else (F.col(seconds) if isinstance(seconds, str) else seconds)
    return (source.where((F.col("source") == C.SOURCE_INTERNAL) & (F.col("eptotal") == 1)
                         & (sec / F.lit(60) < minutes))
            .groupBy(F.col("aid").alias("movie_id2")).agg(F.min("eptotal").alias("eptotal")))


def hot_watch_ratio(plays: DataFrame, as_of_epoch: int, days: int = C.HOT_RATIO_DAYS) -> DataFrame:
    """Older popularity: a play counts when > 6 min and (within the length and
    ratio > 0.5, or beyond the length and > 30 min); per (item, channel).

    plays: (aid, cid, totalTime, playtime, timestamp) with minutes."""
    lo = (as_of_epoch // 86400) * 86400 - days * 86400
    p, tot = F.col("playtime"), F.col("totalTime")
    good = (p > C.PLAY_SHORT_MIN) & (((p <= tot) & (p / F.when(tot > 0, tot) > 0.5)) | ((p > tot) & (p > 30)))
    return (plays.where(F.col("timestamp") > F.lit(lo)).groupBy("aid", "cid")
            .agg(F.sum(F.when(good, 1).otherwise(0)).cast("bigint").alias("weight")))


def match_ids(plays: DataFrame, source: DataFrame, catalog: DataFrame) -> DataFrame:
    """Cross-catalogue id match: internal source rows (sid, channel) matched
    to play rows (qid, cid).  Each side is first reduced to one row per id
    (smallest key, so the result is deterministic); one row per os_id with
    the smallest matching ys_id; rows without a match are dropped."""
    ys = (plays.groupBy(F.col("aid").alias("ys_id")).agg(F.min(F.struct("qid", "cid")).alias("_m"))
          .select("ys_id", "_m.qid", "_m.cid"))
    os_ = (source.where(F.col("source") == C.SOURCE_INTERNAL)
           .groupBy(F.col("aid").alias("os_id")).agg(F.min("sid").alias("sid")))
    os_ = os_.join(catalog.select(F.col("id").alias("os_id"), "title", F.col("cid").alias("os_cid")),
                   "os_id", "left")
    m = os_.join(ys, (os_["sid"] == ys["qid"]) & (os_["os_cid"] == ys["cid"]), "left")
    return (m.groupBy("os_id", "title", "os_cid").agg(F.min("ys_id").alias("ys_id"))
            .na.drop())


def item_source_stats(source: DataFrame, item="aid", total="eptotal", seconds=None) -> DataFrame:
    """Episode total (max) and single-episode length in minutes (min) of every
    item from one grouped pass over the source rows: (movie_id, total_num,
    movie_len); ``movie_len`` is null when unknown."""
    sec = X.json_long("extra", "$.len") if seconds is None else (F.col(seconds) if isinstance(seconds, str) else seconds)
    return source.groupBy(F.col(item).alias("movie_id")).agg(
        F.max(total).cast("bigint").alias("total_num"), F.min((sec / F.lit(60)).cast("bigint")).alias("movie_len"))
