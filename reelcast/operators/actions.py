"""User action logs -> time-decayed user/item weights, history and statistics.

All functions are ``DataFrame -> DataFrame``; none collects to the driver.
Aggregations keyed by item or user use ``groupBy`` (map-side partial
aggregation) and join back instead of unbounded windows, so a hot item or user
does not end up as one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelcast import config as C
from reelcast.functions import columns as X

ACTION_COLS = ["user_id", "movie_id", "cate_id", "datetime", "click", "top", "play_time", "total_num"]


def _c(v, default_path, payload):
    if v is None:
        return X.json_long(payload, default_path)
    return F.col(v) if isinstance(v, str) else v


def parse_click_log(df: DataFrame, user="mac", payload="funitems", ts="ymd",
                    item: Column | str | None = None, cate: Column | str | None = None) -> DataFrame:
    """Click / favourite log rows -> (user_id, movie_id, cate_id, datetime);
    rows whose payload does not parse are dropped, as are empty users."""
    out = df.where(F.col(user).isNotNull() & (F.col(user).cast("string") != "")).select(
        F.col(user).alias("user_id"),
        _c(item, "$.aid", payload).alias("movie_id"),
        _c(cate, "$.cid", payload).alias("cate_id"),
        F.col(ts).cast("bigint").alias("datetime"))
    return out.na.drop()


def parse_play_log(df: DataFrame, user="mac", payload="funitems", ts="ymd",
                   item: Column | str | None = None, cate: Column | str | None = None,
                   play_ms: Column | str | None = None, ep_num: Column | str | None = None,
                   ep_default: int = 1) -> DataFrame:
    """Play log rows -> (user_id, movie_id, cate_id, play_time[ms], datetime, movie_num).
    Missing duration -> -10, missing episode -> ``ep_default``; unparsable -> dropped."""
    pm = (F.coalesce(X.json_long(payload, "$.play_duration"), F.lit(C.MISSING)) if play_ms is None
          else (F.col(play_ms) if isinstance(play_ms, str) else play_ms))
    ep = (F.coalesce(X.json_long(payload, "$.ep_num"), F.lit(ep_default)) if ep_num is None
          else (F.col(ep_num) if isinstance(ep_num, str) else ep_num))
    out = df.where(F.col(user).isNotNull() & (F.col(user).cast("string") != "")).select(
        F.col(user).alias("user_id"),
        _c(item, "$.aid", payload).alias("movie_id"),
        _c(cate, "$.cid", payload).alias("cate_id"),
        pm.cast("bigint").alias("play_time"),
        F.col(ts).cast("bigint").alias("datetime"),
        ep.cast("bigint").alias("movie_num"))
    return out.na.drop()


def agg_total_num(source: DataFrame, item="aid", total="eptotal") -> DataFrame:
    """Largest known episode total per item."""
    return source.groupBy(F.col(item).alias("movie_id")).agg(F.max(total).cast("bigint").alias("total_num"))


def resolve_episode_total(play: DataFrame, totals: DataFrame, film_channel=C.FILM) -> DataFrame:
    """Attach the episode total of each play row.

    missing -> 0; film channel -> 1; an item whose table total was 0 takes the
    largest episode watched; still 0 -> 1 (the three tests in this order).
    The per-item maximum is a grouped aggregate joined back (no window on a
    possibly hot item)."""
    t = play.join(totals, "movie_id", "left").withColumn("total_num", F.coalesce("total_num", F.lit(0)))
    max_num = (t.where(F.col("total_num") == 0).groupBy("movie_id")
               .agg(F.max("movie_num").alias("max_num")))
    t = t.join(max_num, "movie_id", "left")
    tn = F.col("total_num")
    if film_channel is not None:
        tn = F.when(F.col("cate_id") == F.lit(film_channel), F.lit(1)).otherwise(tn)
    tn = F.when(F.col("max_num").isNotNull() & (F.col("max_num") != 0), F.col("max_num")).otherwise(tn)
    tn = F.when(tn == 0, F.lit(1)).otherwise(tn)
    return t.withColumn("total_num", tn.cast("bigint")).drop("max_num")


def play_dedupe_max(play: DataFrame) -> DataFrame:
    """Repeated reports of the same user/item/day/episode keep the longest play."""
    return (play.groupBy("user_id", "movie_id", "cate_id", "datetime", "movie_num", "total_num")
            .agg(F.max("play_time").alias("play_time")))


def play_minutes_range(play: DataFrame, lo=C.PLAY_RANGE[0], hi=C.PLAY_RANGE[1]) -> DataFrame:
    """Milliseconds -> whole minutes, keep ``lo < minutes < hi``."""
    m = (F.col("play_time") / F.lit(60000)).cast("bigint")
    return play.withColumn("play_time", m).where((F.col("play_time") > lo) & (F.col("play_time") < hi))


def union_slices_distinct(*slices: DataFrame) -> DataFrame:
    """Union of log slices, one row per distinct action."""
    out = slices[0]
    for s in slices[1:]:
        out = out.unionByName(s)
    return out.dropDuplicates()


def onehot_actions(df: DataFrame, action: str) -> DataFrame:
    """Tag a merged log with its action: click/top booleans, play minutes and
    episode total, or -10 where the action has none."""
    is_play = action == "play"
    return df.select(
        "user_id", "movie_id", "cate_id", "datetime",
        F.lit(action == "click").alias("click"),
        F.lit(action == "top").alias("top"),
        (F.col("play_time").cast("bigint") if is_play else F.lit(C.MISSING).cast("bigint")).alias("play_time"),
        (F.col("total_num").cast("bigint") if is_play else F.lit(C.MISSING).cast("bigint")).alias("total_num"))


def merge_actions(click: DataFrame, top: DataFrame, play: DataFrame, start_time: int = 0) -> DataFrame:
    """One-hot union of the three merged logs, newer than ``start_time``."""
    out = (onehot_actions(click, "click").unionByName(onehot_actions(top, "top"))
           .unionByName(onehot_actions(play, "play")))
    return out.where(F.col("datetime") > F.lit(start_time)).na.drop()


def action_row_weights(actions: DataFrame, lengths: DataFrame | None, as_of_epoch: int) -> DataFrame:
    """Weight of every action row: decay(days) * (click*2 + top*4 + play points)."""
    a = actions
    if lengths is not None:
        a = a.join(lengths.select("movie_id", "movie_len"), "movie_id", "left")
    else:
        a = a.withColumn("movie_len", F.lit(None).cast("bigint"))
    a = a.withColumn("movie_len", F.coalesce("movie_len", F.lit(C.MISSING)))
    decay = X.time_decay(as_of_epoch, "datetime")
    w = X.action_weight(decay, "click", "top", X.play_score("play_time", "movie_len", "total_num"))
    return a.select("user_id", "movie_id", "cate_id", w.alias("weight"))


def agg_action_weight(row_weights: DataFrame) -> DataFrame:
    """Sum of row weights per (user, item), largest channel id."""
    return (row_weights.groupBy("user_id", "movie_id")
            .agg(F.round(F.sum("weight"), 4).alias("weight"), F.max("cate_id").alias("cate_id")))


def minmax_normalize(df: DataFrame, value="weight", digits=8, by: list[str] | None = None) -> DataFrame:
    """``(w - min) / (max - min)`` over the whole table (or per ``by`` group).

    Global bounds are scalar subqueries (partially aggregated, one row);
    per-group bounds are a grouped aggregate joined back.  A constant column
    gives 0.0."""
    keys = by or []
    if keys:
        stats = df.groupBy(*keys).agg(F.min(value).alias("_mn"), F.max(value).alias("_mx"))
        joined = df.join(stats, keys, "left")
    else:
        joined = df.withColumn("_mn", df.select(F.min(value)).scalar()).withColumn(
            "_mx", df.select(F.max(value)).scalar())
    span = F.col("_mx") - F.col("_mn")
    nv = F.when(span == 0, F.lit(0.0)).otherwise((F.col(value) - F.col("_mn")) / F.when(span != 0, span))
    return joined.withColumn(value, F.round(nv, digits)).drop("_mn", "_mx")


def topk_per_user(weights: DataFrame, k: int, part=("user_id",), order=None) -> DataFrame:
    """Top-K rows per key by weight desc, id asc (WindowGroupLimit plans a
    map-side partial top-K before the shuffle, so hot users are pre-cut)."""
    order = order or [F.desc("weight"), F.asc("movie_id")]
    w = Window.partitionBy(*part).orderBy(*order)
    return weights.withColumn("sort_num", F.row_number().over(w)).where(F.col("sort_num") <= k)


def history_items(actions: DataFrame, kind: str) -> DataFrame:
    """Latest time per (user, item) of one action kind (grouped, partial)."""
    if kind == "play":
        h = actions.where(F.col("play_time") > 0)
    else:
        h = actions.where(F.col(kind))
    return h.groupBy("user_id", "movie_id").agg(F.max("cate_id").alias("cate_id"),
                                                F.max("datetime").alias("datetime"))


def user_history(actions: DataFrame, kind: str, titles: DataFrame | None = None) -> DataFrame:
    """History of one action kind: latest time per (user, item), titled, and
    ranked per (user, channel) newest first (a user's whole history: the rank
    is skew-safe so one heavy user is not one task)."""
    from reelcast.operators.ranking import rank_all
    h = history_items(actions, kind)
    if titles is not None:
        h = h.join(titles.select("movie_id", "title", "year"), "movie_id", "left")
    return rank_all(h, ["user_id", "cate_id"], [F.desc("datetime"), F.asc("movie_id")], "sort_time")


def agg_action_stat(actions: DataFrame, zone: str = C.HOME_ZONE) -> DataFrame:
    """Per (user, channel): count and latest local date of click, top and play
    (play_time > 0) plus the total, in one grouped pass."""
    is_play = F.col("play_time") > 0
    g = actions.groupBy("user_id", "cate_id").agg(
        F.count_if(F.col("click")).alias("click_count"),
        F.max(F.when(F.col("click"), F.col("datetime"))).alias("_cl"),
        F.count_if(F.col("top")).alias("top_count"),
        F.max(F.when(F.col("top"), F.col("datetime"))).alias("_tl"),
        F.count_if(is_play).alias("play_count"),
        F.max(F.when(is_play, F.col("datetime"))).alias("_pl"))
    return g.select(
        "user_id", "cate_id",
        "click_count", X.local_date("_cl", zone).alias("click_latest"),
        "top_count", X.local_date("_tl", zone).alias("top_latest"),
        "play_count", X.local_date("_pl", zone).alias("play_latest"),
        (F.col("click_count") + F.col("top_count") + F.col("play_count")).alias("total_count"))


def scan_recent_actions(actions: DataFrame, as_of_epoch: int, days: int = C.RECENT_DAYS,
                        extra_history: DataFrame | None = None, full: bool = False) -> DataFrame:
    """Actions strictly newer than ``midnight(as_of) - days`` (all when full),
    plus an optional third-party history table of the same shape."""
    start = 0 if full else (as_of_epoch // 86400) * 86400 - days * 86400
    out = actions.where(F.col("datetime") > F.lit(start))
    if extra_history is not None:
        out = out.unionByName(extra_history.select(*ACTION_COLS).where(F.col("datetime") > F.lit(start)))
    return out


def device_map(*logs: DataFrame, device="deviceid", user="mac") -> DataFrame:
    """Distinct device -> user pairs across all action logs."""
    out = None
    for lg in logs:
        s = lg.select(F.col(device).alias("deviceid"), F.col(user).alias("mac"))
        out = s if out is None else out.unionByName(s)
    return out.where(F.col("deviceid").isNotNull() & F.col("mac").isNotNull()).dropDuplicates()


def dedupe_action_log(log: DataFrame) -> DataFrame:
    """The merged log: one grouped pass over a log carrying all three actions
    keeps one row per distinct click/top and the longest report per play key.

    log: (user_id, movie_id, cate_id, datetime, action in click/top/play,
    play_time in ms for plays, movie_num).  This is the stage to persist: the
    raw log is scanned once, every later branch reads the merged log."""
    keys = ["user_id", "movie_id", "cate_id", "datetime", "action", "movie_num"]
    return log.groupBy(*keys).agg(F.max("play_time").alias("play_time"))


def merge_action_log(merged_log: DataFrame, totals: DataFrame, start_time: int = 0, film_channel=C.FILM,
                     lo=C.PLAY_RANGE[0], hi=C.PLAY_RANGE[1]) -> DataFrame:
    """One-hot actions from the merged log: plays get their episode total and
    the minute range, clicks and favourites pass.  Same rows as
    ``merge_actions`` over the separately parsed logs."""
    play = merged_log.where(F.col("action") == "play").drop("action")
    play = play_minutes_range(resolve_episode_total(play, totals, film_channel), lo, hi)
    other = merged_log.where(F.col("action") != "play")
    one_hot_other = other.select(
        "user_id", "movie_id", "cate_id", "datetime",
        (F.col("action") == "click").alias("click"), (F.col("action") == "top").alias("top"),
        F.lit(C.MISSING).cast("bigint").alias("play_time"), F.lit(C.MISSING).cast("bigint").alias("total_num"))
    out = one_hot_other.unionByName(onehot_actions(play, "play"))
    return out.where(F.col("datetime") > F.lit(start_time)).na.drop()
