"""Recall: item->item lists, user->item by profile, user->item by similar items.

Candidate expansion is an equi-join on rows (never lists); merging the same
item recalled several times uses a skew-safe rank per user; version and
title de-duplication run on bounded groups (one item's or one user's top-K
candidates).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelcast import config as C
from reelcast.functions import columns as X
from reelcast.functions import text as TX
from reelcast.operators.ranking import rank_all, top_k
from reelcast.session import stage_table


# ---------------------------------------------------------------- shared
def anti_history(recall: DataFrame, history: DataFrame, user="user_id", item="movie_id") -> DataFrame:
    """Remove candidates the user already has in the history (anti join)."""
    h = history.select(F.col(user), F.col(item)).dropDuplicates()
    return recall.join(h, [user, item], "left_anti")


def tokenize_titles(df: DataFrame, ch: C.Channels, title="title", channel="cate_id", tokenizer=None) -> DataFrame:
    """Title tokens for the version filter: per-channel deny-listed titles and
    null titles dropped; titles longer than 2 are tokenised (empty -> the
    title itself), shorter ones are their own token."""
    tok = tokenizer or TX.tokenize_words
    t = F.col(title)
    deny = F.lit(False)
    for cid, titles in ((ch.film, C.TITLE_DENY[C.FILM]), (ch.series, C.TITLE_DENY[C.SERIES])):
        deny = deny | ((F.col(channel) == F.lit(cid)) & t.isin(*titles))
    ln = F.length(t)
    words = tok(t)
    words = F.when(ln > 2, F.when(F.size(words) == 0, F.array(t)).otherwise(words)).otherwise(F.array(t))
    out = df.where(t.isNotNull() & ~F.coalesce(deny, F.lit(False)))
    return out.withColumn("title_len", ln).withColumn("words", words).withColumn("words_len", F.size("words"))


def _version_filter(tok: DataFrame, owner: str, cand: str) -> DataFrame:
    """Per (owner, token) only the candidate with the shortest title keeps the
    token; a candidate survives when it kept all its tokens."""
    e = tok.withColumn("word", F.explode("words"))
    w = Window.partitionBy(owner, "word").orderBy(F.asc("title_len"), F.asc(cand))
    e = e.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
    kept = e.groupBy(owner, cand).agg(F.count(F.lit(1)).alias("_count"))
    return (tok.join(kept, [owner, cand]).where(F.col("_count") == F.col("words_len"))
            .drop("_count", "words", "words_len", "title_len"))


def dedupe_title_prefix(df: DataFrame, owner: str, prefix: str, cand: str, value="weight") -> DataFrame:
    """Per (owner, title prefix) keep the heaviest candidate."""
    w = Window.partitionBy(owner, prefix).orderBy(F.desc(value), F.asc(cand))
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r", prefix)


# ---------------------------------------------------------------- item -> item
def filter_versions_item(neigh: DataFrame, titles: DataFrame, ch: C.Channels, tokenizer=None,
                         title_max: int = C.VERSION_TITLE_MAX) -> DataFrame:
    """neigh: (movie_id, movie_id2, cos_sim, cate_id); titles: (id, title).
    Titles of variety and kids candidates are not length-limited."""
    t = titles.select(F.col("id").alias("movie_id2"), "title")
    r = neigh.join(t, "movie_id2", "left")
    tok = tokenize_titles(r, ch, tokenizer=tokenizer)
    unlimited = F.coalesce(F.col("cate_id").isin(ch.variety, ch.kids), F.lit(False))
    tok = tok.where(unlimited | (F.col("title_len") < title_max))
    return _version_filter(tok, "movie_id", "movie_id2")


def weight_by_factors_item(rec: DataFrame, catalog: DataFrame, score: DataFrame, hot: DataFrame,
                           year: DataFrame, year_variety: DataFrame, ch: C.Channels, digits=8) -> DataFrame:
    """cos_sim x score x hot x year factor of the candidate; source and
    candidate titles/years attached; rows with a missing factor dropped."""
    src = catalog.select(F.col("id").alias("movie_id"), "title", "year")
    cnd = catalog.select(F.col("id").alias("movie_id2"), F.col("title").alias("title2"), F.col("year").alias("year2"))
    sc = score.select(F.col("aid").alias("movie_id2"), "score", F.col("factor").alias("_sf"))
    ht = hot.select(F.col("aid").alias("movie_id2"), "play_num", F.col("factor").alias("_hf"))
    yr = year.select(F.col("movie_id").alias("movie_id2"), F.col("factor").alias("_yf"))
    yv = year_variety.select(F.col("movie_id").alias("movie_id2"), F.col("factor").alias("_yv"))
    j = (rec.drop("title").join(src, "movie_id", "left").join(cnd, "movie_id2", "left")
         .join(sc, "movie_id2", "left").join(ht, "movie_id2", "left")
         .join(yr, "movie_id2", "left").join(yv, "movie_id2", "left"))
    yf = F.when(F.col("cate_id") == F.lit(ch.variety), F.col("_yv")).otherwise(F.col("_yf"))
    w = F.round(F.col("cos_sim") * F.col("_sf") * F.col("_hf") * yf, digits)
    out = j.select("movie_id", "cate_id", "title", "year", "movie_id2", "title2", "year2", "score", "play_num",
                   w.alias("weight"))
    return out.na.drop()


def rules_item_final(rec: DataFrame, ch: C.Channels, labels: DataFrame | None = None,
                     short_single: DataFrame | None = None) -> DataFrame:
    """Per-channel title rules on lower/trim titles; adds ``title3`` (the
    prefix used for de-duplication: 2 chars for film/series, else 4)."""
    t, t2 = X.norm_title("title"), X.norm_title("title2")
    r = rec
    if labels is not None:
        r = r.join(labels.select(F.col("id").alias("movie_id2"), F.col("cate").alias("_label")), "movie_id2", "left")
    else:
        r = r.withColumn("_label", F.lit("x"))
    if short_single is not None:
        r = r.join(short_single.select("movie_id2", F.lit(1).alias("_short")), "movie_id2", "left")
    else:
        r = r.withColumn("_short", F.lit(None).cast("int"))
    cid = F.col("cate_id")
    same2 = F.substring(t, 1, 2) == F.substring(t2, 1, 2)
    same4 = F.substring(t, 1, 4) == F.substring(t2, 1, 4)
    film_drop = (X.last2(t2).isin(*C.FILM_SUFFIX_DENY_RECALL) | X.first_fourth(t2).isin(*C.CHAR_PAIR_DENY)
                 | t2.contains(C.BOOK_MARK) | same2)
    series_drop = X.last2(t2).isin(*C.SERIES_SUFFIX_DENY) | t2.contains(C.BOOK_MARK) | same2
    kids_drop = (F.coalesce(F.col("_label"), F.lit("")) == "") | F.col("_short").isNotNull() | same4 | (F.length(t2) > C.KIDS_TITLE_MAX)
    drop = (F.when(cid == F.lit(ch.film), film_drop).when(cid == F.lit(ch.series), series_drop)
            .when(cid == F.lit(ch.kids), kids_drop).otherwise(same4))
    prefix = F.when(cid.isin(ch.film, ch.series), F.substring(t2, 1, 2)).otherwise(F.substring(t2, 1, 4))
    r = r.where(F.col("title").isNotNull() & F.col("title2").isNotNull() & ~F.coalesce(drop, F.lit(False)))
    return r.withColumn("title3", prefix).drop("_label", "_short")


def item_recall_final(rec: DataFrame, trailers: DataFrame, sources: DataFrame, stamp: int,
                      k: int = C.NEIGHBOURS_K) -> DataFrame:
    """Rules output -> prefix de-dup -> no trailers -> internal online source
    only (semi join, no fan-out) -> rank per item -> top-K -> day stamp."""
    d = dedupe_title_prefix(rec, "movie_id", "title3", "movie_id2")
    d = d.join(trailers.select(F.col("aid").alias("movie_id2")), "movie_id2", "left_anti")
    online = sources.where((F.col("source") == C.SOURCE_INTERNAL) & (F.col("status") == C.STATUS_ONLINE))
    d = d.join(online.select(F.col("aid").alias("movie_id2")), "movie_id2", "left_semi")
    d = d.withColumn("source", F.lit(C.SOURCE_INTERNAL))
    d = top_k(d, ["movie_id"], [F.desc("weight"), F.asc("movie_id2")], k)
    return d.withColumn("timestamp", F.lit(stamp))


# ---------------------------------------------------------------- user by profile
# index rows up to which the lists of the profiles' topics are sent to every task (three numbers a row)
LIST_ROWS = 2_000_000
USER_ROWS = 1_000_000       # expanded rows of one partition of users, about


def expand_candidates(profile: DataFrame, inverted: DataFrame, digits=8, by_user: bool = False) -> DataFrame:
    """User topic weight x item topic weight for every item of the topic
    (equi-join on (channel, topic) rows; AQE splits hot topics).

    ``by_user`` lays the same rows out by user, for operators that group them by user: where the lists of the topics
    that profiles have are short enough to be sent to every task (they are counted first), the profiles are dealt out
    by user and no expanded row is moved; otherwise the expanded rows are dealt out by user once."""
    p = profile.select("user_id", "cate_id", "topic", F.col("weight").alias("_uw"))
    i = inverted.select("cate_id", "topic", "movie_id", F.col("weight").alias("_mw"))
    row = ["user_id", "cate_id", "movie_id", "topic", F.round(F.col("_uw") * F.col("_mw"), digits).alias("weight")]
    if not by_user:
        return p.join(i, ["cate_id", "topic"]).select(*row)
    topics = stage_table(p.groupBy("cate_id", "topic").agg(F.count(F.lit(1)).alias("_users")).withColumn(
        "_list", F.monotonically_increasing_id()))
    lists = stage_table(i.join(topics, ["cate_id", "topic"]).select("_list", "movie_id", "_mw"))
    n_rows, n_lists = lists.join(topics, "_list").agg(F.sum("_users"), F.count(F.lit(1))).first()
    n = max(int(p.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil((n_rows or 0) / USER_ROWS))
    p = p.join(topics.drop("_users"), ["cate_id", "topic"])
    if n_lists <= LIST_ROWS:
        return p.repartition(n, "user_id").join(F.broadcast(lists), "_list").select(*row)
    return p.join(lists, "_list").select(*row).repartition(n, "user_id")


def merge_same_item(cands: DataFrame, owner="user_id", item="movie_id", tie: str = "topic",
                    keys=("user_id", "cate_id", "movie_id"), digits=8) -> DataFrame:
    """Rank every candidate of a user (total_sort); the best row of an item
    keeps its weight, the others get ``w / (ln(total_sort - base_sort + 1) + 1)``;
    weights are then summed per item.

    Rank, best rank and sum all need a user's rows together, so rows that are laid out by user are not moved, others
    once.  A user has the lists of at most K topics a channel; the sorts spill, nothing is held by user."""
    rank = F.row_number().over(Window.partitionBy(owner).orderBy(F.desc("weight"), F.asc(item), F.asc(tie)))
    r = cands.withColumn("total_sort", rank.cast("bigint"))
    r = r.withColumn("base_sort", F.min("total_sort").over(Window.partitionBy(owner, item)))
    gap = F.col("total_sort") - F.col("base_sort")
    w = F.when(gap == 0, F.col("weight")).otherwise(F.col("weight") / (F.log(gap + 1) + 1))
    r = r.withColumn("weight", F.round(w, digits))
    return r.groupBy(*keys).agg(F.round(F.sum("weight"), digits).alias("weight"))


def filter_versions_user(recall: DataFrame, titles: DataFrame, ch: C.Channels, tokenizer=None,
                         title_max: int = C.VERSION_TITLE_MAX) -> DataFrame:
    """recall: (user_id, movie_id, cate_id, weight); titles: (id, cid, title)."""
    t = titles.select(F.col("id").alias("movie_id"), F.col("cid").alias("cate_id"), "title")
    r = recall.join(t, ["cate_id", "movie_id"], "left")
    tok = tokenize_titles(r, ch, tokenizer=tokenizer).where(F.col("title_len") < title_max)
    return _version_filter(tok, "user_id", "movie_id")


def weight_by_factors_user(recall: DataFrame, hot: DataFrame, score: DataFrame, year: DataFrame,
                           digits=8) -> DataFrame:
    """weight x hot x score x year factor; ranked per user (sort_num)."""
    ht = hot.select(F.col("aid").alias("movie_id"), "play_num", F.col("factor").alias("_hf"))
    sc = score.select(F.col("aid").alias("movie_id"), "score", F.col("factor").alias("_sf"))
    yr = year.select("movie_id", "year", F.col("factor").alias("_yf"))
    j = recall.join(ht, "movie_id", "left").join(sc, "movie_id", "left").join(yr, "movie_id", "left")
    w = F.round(F.col("weight") * F.col("_hf") * F.col("_sf") * F.col("_yf"), digits)
    out = j.select("user_id", "cate_id", "movie_id", "title", "year", "play_num", "score", w.alias("weight")).na.drop()
    return out.withColumn("sort_num", F.row_number().over(
        Window.partitionBy("user_id").orderBy(F.desc("weight"), F.asc("movie_id"))).cast("bigint"))


def rules_user_final(rec: DataFrame) -> DataFrame:
    """Drop titles ending in the user-path deny list or with the bracket /
    ordinal character pair; adds ``title2`` (first two characters)."""
    t = F.lower(F.col("title"))
    drop = X.last2(t).isin(*C.USER_SUFFIX_DENY) | X.first_fourth(t).isin(*C.CHAR_PAIR_DENY)
    return rec.where(~F.coalesce(drop, F.lit(False))).withColumn("title2", F.substring(t, 1, 2))


def profile_recall(profile: DataFrame, inverted: DataFrame, history: DataFrame, catalog: DataFrame,
                   hot: DataFrame, score: DataFrame, year: DataFrame, ch: C.Channels, stamp: int,
                   pre_k: int = C.USER_PRE_TOPK, final_k: int = C.USER_FINAL_TOPK,
                   merged: DataFrame | None = None) -> DataFrame:
    """expand -> merge -> top pre_k -> minus history -> version filter ->
    factors -> <= final_k -> title rules -> prefix de-dup -> rank -> stamp.
    ``merged`` may carry an already computed merge step."""
    m = merged if merged is not None else merge_same_item(expand_candidates(profile, inverted, by_user=True))
    top = top_k(m, ["user_id"], [F.desc("weight"), F.asc("movie_id")], pre_k).drop("sort_num")
    nh = anti_history(top, history)
    v = filter_versions_user(nh, catalog, ch)
    f = weight_by_factors_user(v, hot, score, year).where(F.col("sort_num") <= final_k).drop("sort_num")
    r = dedupe_title_prefix(rules_user_final(f), "user_id", "title2", "movie_id")
    r = r.withColumn("sort_num", F.row_number().over(
        Window.partitionBy("user_id").orderBy(F.desc("weight"), F.asc("movie_id"))).cast("bigint"))
    return r.withColumn("timestamp", F.lit(stamp))


# ---------------------------------------------------------------- user by similar items
def similar_recall_expand(action_weight: DataFrame, item_recall: DataFrame, digits=8) -> DataFrame:
    """user->item weight x item->item weight; total_sort per user."""
    a = action_weight.select("user_id", "movie_id", F.col("weight").alias("_aw"))
    r = item_recall.select("movie_id", "title", "year", "movie_id2", "title2", "year2", "score", "play_num",
                           F.col("weight").alias("_iw"))
    j = a.join(r, "movie_id").withColumn("weight", F.round(F.col("_aw") * F.col("_iw"), digits))
    j = j.drop("_aw", "_iw").na.drop()
    return rank_all(j, ["user_id"], [F.desc("weight"), F.asc("movie_id2"), F.asc("movie_id")], "total_sort")


def similar_recall_merge(expanded: DataFrame, digits=8) -> tuple[DataFrame, DataFrame]:
    """Same candidate from several history items: decayed weights summed.
    Returns (merged, explanations); explanations are rows (user_id,
    movie_id, base_movie, base_title, base_year) instead of one list per
    candidate, so a heavy user's explanation is not gathered in one row."""
    # best rank of each candidate: grouped min joined back (partial
    # aggregation; a heavy user's popular candidate is not one window group)
    base = expanded.groupBy("user_id", "movie_id2").agg(F.min("total_sort").alias("base_sort"))
    r = expanded.join(base, ["user_id", "movie_id2"])
    gap = F.col("total_sort") - F.col("base_sort")
    w = F.when(gap == 0, F.col("weight")).otherwise(F.col("weight") / (F.log(gap + 1) + 1))
    r = r.withColumn("weight", F.round(w, digits))
    merged = (r.groupBy("user_id", "movie_id2", "title2", "year2", "score", "play_num")
              .agg(F.round(F.sum("weight"), digits).alias("weight"))
              .withColumnRenamed("movie_id2", "movie_id").withColumnRenamed("title2", "title")
              .withColumnRenamed("year2", "year"))
    expl = r.select("user_id", F.col("movie_id2").alias("movie_id"), F.col("movie_id").alias("base_movie"),
                    F.col("title").alias("base_title"), F.col("year").alias("base_year"))
    return merged, expl


def explanation_list(expl: DataFrame) -> DataFrame:
    """Presentation form of the explanations: one string per candidate."""
    s = F.concat_ws(":", F.col("base_movie").cast("string"), F.col("base_title"), F.col("base_year"))
    return expl.groupBy("user_id", "movie_id").agg(F.array_join(F.array_sort(F.collect_list(s)), ",").alias("base_movie"))


def similar_recall(merged: DataFrame, history: DataFrame, sources: DataFrame, stamp: int,
                   k: int = C.USER_FINAL_TOPK) -> DataFrame:
    """Merged candidates (``similar_recall_merge``) -> minus history -> internal source -> rank -> <= k -> stamp."""
    nh = anti_history(merged, history)
    online = sources.where(F.col("source") == C.SOURCE_INTERNAL).select(F.col("aid").alias("movie_id"))
    nh = nh.join(online, "movie_id", "left_semi").withColumn("source", F.lit(C.SOURCE_INTERNAL))
    out = top_k(nh, ["user_id"], [F.desc("weight"), F.asc("movie_id")], k)
    return out.withColumn("timestamp", F.lit(stamp))


def recommend_lookup(keys: DataFrame, user_recall: DataFrame, item_recall: DataFrame,
                     key="key", user_key_min_len: int = 10) -> DataFrame:
    """Batch form of the point lookup: keys longer than ``user_key_min_len``
    characters are users (user recall), others items (item recall); returns
    the ordered candidate ids as one string per key (bounded by top-K)."""
    k = keys.select(F.col(key).cast("string").alias("key"))
    is_user = F.length("key") > user_key_min_len
    u = user_recall.select(F.col("user_id").cast("string").alias("key"), F.col("movie_id").alias("rec"), "sort_num")
    i = item_recall.select(F.col("movie_id").cast("string").alias("key"), F.col("movie_id2").alias("rec"), "sort_num")
    hits = (k.where(is_user).join(u, "key").unionByName(k.where(~is_user).join(i, "key")))
    return hits.groupBy("key").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sort_num", "rec"))),
                                 lambda s: s["rec"].cast("string")), ",").alias("movie_ids"))


def dedupe_keep_max(cands: DataFrame, owner="user_id", item="movie_id", tie: str = "topic",
                    keys=("user_id", "cate_id", "movie_id")) -> DataFrame:
    """Retired merge strategy: the same item recalled several times keeps only
    its heaviest row (grouped min over an order struct: partial aggregation)."""
    from reelcast.operators.generic import dedupe_keys
    best = dedupe_keys(cands, [owner, item], [-F.col("weight"), F.col(tie)])
    return best.select(*keys, "weight")
