"""User pipelines day by day: what a day's log says is kept by (user, item, day) and re-weighted when it is read.

The time decay is no product over days (``1 / (ln(days + 1) + 1)``), so yesterday's weights can't be scaled to today's.
What doesn't change is a day's own content: whether an item was clicked or marked, and the longest play of each
episode.  That is a row of the day's bucket; raw logs of old days aren't read again, only buckets.  Item lengths and
episode totals are applied on reading, so a catalogue that changes needs no rewrite either.

A bucket absorbs rows that come late or twice: flags are joined by "or", plays by the longest, so appending the same
rows again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcast import config as C
from reelcast.functions import columns as X
from reelcast.operators import actions as A
from reelcast.operators.ranking import rank_all
from reelcast.session import path_exists, stage_table
from reelcast.sources import sinks as SK

# a bucket row: plays are the longest report (ms) of each episode watched that day; ``datetime`` is the day's midnight
BUCKET = ("user_id long, movie_id long, cate_id string, click boolean, top boolean, "
          "plays array<struct<movie_num: long, play_time: long>>, datetime long")
KEYS = ["user_id", "movie_id", "cate_id", "datetime"]


def bucket_rows(log: DataFrame) -> DataFrame:
    """Buckets of a raw action log (user_id, movie_id, cate_id, datetime, action, movie_num, play_time in ms)."""
    one = A.dedupe_action_log(log)
    play = F.when(F.col("action") == "play", F.struct("movie_num", "play_time"))
    return one.groupBy(*KEYS).agg(
        F.max(F.col("action") == "click").alias("click"), F.max(F.col("action") == "top").alias("top"),
        F.array_sort(F.collect_list(play)).alias("plays")).select(*_names())


def _names() -> list[str]:
    return ["user_id", "movie_id", "cate_id", "click", "top", "plays", "datetime"]


def merge_buckets(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row per (user, item, channel, day): flags or-ed, the longest play of each episode."""
    both = a.select(*_names()).unionByName(b.select(*_names())).select(
        *KEYS, "click", "top", F.explode_outer("plays").alias("p"))
    episodes = both.groupBy(*KEYS, F.col("p").isNotNull().alias("is_play"), F.col("p.movie_num").alias("movie_num")).agg(
        F.max("click").alias("click"), F.max("top").alias("top"), F.max("p.play_time").alias("play_time"))
    play = F.when(F.col("is_play"), F.struct("movie_num", "play_time"))
    return episodes.groupBy(*KEYS).agg(
        F.max("click").alias("click"), F.max("top").alias("top"),
        F.array_sort(F.collect_list(play)).alias("plays")).select(*_names())


def append_days(spark: SparkSession, log: DataFrame, path: str) -> list[int]:
    """Add a log's rows to the buckets of their days and return those days.  Only these days' partitions are read and
    replaced; the merged rows are written aside first, so a run that is cut off can be repeated."""
    fresh = stage_table(bucket_rows(log))
    days = sorted(r["datetime"] for r in fresh.select("datetime").distinct().collect())
    if not days:
        return []
    rows = fresh
    if path_exists(spark, path):
        rows = stage_table(merge_buckets(read_buckets(spark, path).where(F.col("datetime").isin(*days)), fresh))
    SK.append_once(rows, path, "datetime")
    return days


def read_buckets(spark: SparkSession, path: str, since: int | None = None) -> DataFrame:
    """All buckets, or those of days after ``since`` (a partition filter)."""
    df = spark.read.schema(BUCKET).parquet(path)
    return df if since is None else df.where(F.col("datetime") > since)


def bucket_actions(buckets: DataFrame, totals: DataFrame, film_channel=C.FILM, lo=C.PLAY_RANGE[0],
                   hi=C.PLAY_RANGE[1]) -> DataFrame:
    """The one-hot merged actions that the buckets stand for: the rows of ``merge_action_log``."""
    plays = buckets.select(*KEYS, F.explode("plays").alias("p")).select(*KEYS, "p.movie_num", "p.play_time")
    play = A.onehot_actions(A.play_minutes_range(A.resolve_episode_total(plays, totals, film_channel), lo, hi), "play")
    flags = buckets.select(*KEYS, F.explode(F.filter(F.array(
        F.when(F.col("click"), F.lit("click")), F.when(F.col("top"), F.lit("top"))), lambda a: a.isNotNull())).alias("action"))
    missing = F.lit(C.MISSING).cast("bigint")
    other = flags.select(*KEYS, (F.col("action") == "click").alias("click"), (F.col("action") == "top").alias("top"),
                         missing.alias("play_time"), missing.alias("total_num"))
    return other.unionByName(play.select(*other.columns)).select(*A.ACTION_COLS).na.drop()


def daily_action_weight(buckets: DataFrame, lengths: DataFrame, totals: DataFrame, as_of_epoch: int,
                        film_channel=C.FILM) -> DataFrame:
    """Weight per (user, item) as of a day, every bucket weighted with the decay it has on that day."""
    acts = bucket_actions(buckets, totals, film_channel)
    return A.agg_action_weight(A.action_row_weights(acts, lengths, as_of_epoch))


def daily_history(buckets: DataFrame, totals: DataFrame, kind: str, titles: DataFrame | None = None,
                  film_channel=C.FILM) -> DataFrame:
    """History of one action kind: latest day per (user, item), ranked per (user, channel)."""
    h = A.history_items(bucket_actions(buckets, totals, film_channel), kind)
    if titles is not None:
        h = h.join(titles.select("movie_id", "title", "year"), "movie_id", "left")
    return rank_all(h, ["user_id", "cate_id"], [F.desc("datetime"), F.asc("movie_id")], "sort_time")


def recent_start(as_of: str | int, days: int = C.RECENT_DAYS) -> int:
    """Buckets after this epoch are the recent window."""
    return X.midnight_epoch(as_of, days)
