"""Item keyword profiles, topic words and user topic profiles."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelcast import config as C
from reelcast.operators.actions import minmax_normalize
from reelcast.session import stage_table


# keys: the item first, then what is carried along (the channel, which may be null and takes no part in joins)
def _kw(textrank: DataFrame, keys):
    return textrank.withColumnRenamed("tag", "keyword").select(*keys, "keyword", "textrank")


def keyword_factors(textrank: DataFrame, tfidf: DataFrame, keys=("movie_id", "cate_id")) -> DataFrame:
    """Words present in both tables: (keys..., keyword, textrank, idf, tfidf), an inner join on (item, keyword).

    The rows of both tables are dealt out by item in one exchange and meet there, so that what ranks an item's words
    afterwards moves none; the exchange carries all factors, so both weights of one plan read the same one.  For plans
    that need both weights; one weight alone is joined with less CPU by its own function."""
    item, rest = keys[0], list(keys[1:])
    # whole rows as lists that are unpacked after they met: an item that is in two channels has a factor row in each,
    # and no plan cuts columns off the exchange that another one needs
    t = _kw(textrank, keys).select(item, "keyword", F.array(F.struct(*rest, "textrank")).alias("_t"))
    f = tfidf.select(item, "keyword", F.struct("idf", "tfidf").alias("_f"))
    both = t.unionByName(f, allowMissingColumns=True).where(F.col(item).isNotNull() & F.col("keyword").isNotNull())
    met = both.repartition(item).withColumn("_f", F.collect_list("_f").over(Window.partitionBy(item, "keyword")))
    pairs = met.select(item, "keyword", "_f", F.inline("_t")).select(item, *rest, "keyword", "textrank", F.inline("_f"))
    return pairs.select(*keys, "keyword", "textrank", "idf", "tfidf")


def _met(textrank: DataFrame, tfidf: DataFrame | None, keys, factor: str) -> DataFrame:
    if tfidf is None:
        return textrank
    return _kw(textrank, keys).join(tfidf.select(keys[0], "keyword", factor), [keys[0], "keyword"])


def idf_textrank(textrank: DataFrame, tfidf: DataFrame | None = None, keys=("movie_id", "cate_id"),
                 digits=8) -> DataFrame:
    """Keyword weight = textrank x idf (words present in both tables); without ``tfidf`` the first table is one of
    ``keyword_factors``."""
    j = _met(textrank, tfidf, keys, "idf")
    return j.select(*keys, "keyword", F.round(F.col("textrank") * F.col("idf"), digits).alias("weight"))


def tfidf_textrank(textrank: DataFrame, tfidf: DataFrame | None = None, keys=("movie_id", "cate_id"),
                   digits=8) -> DataFrame:
    """Keyword weight = (textrank + tfidf) / 2; without ``tfidf`` as in ``idf_textrank``."""
    j = _met(textrank, tfidf, keys, "tfidf")
    return j.select(*keys, "keyword", F.round((F.col("textrank") + F.col("tfidf")) / 2, digits).alias("weight"))


def topk_keywords(weights: DataFrame, k: int = C.KEYWORD_TOPK, key="movie_id") -> DataFrame:
    """K heaviest keywords per item (weight desc, keyword asc)."""
    w = Window.partitionBy(key).orderBy(F.desc("weight"), F.asc("keyword"))
    return weights.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def topic_words(top_a: DataFrame, top_b: DataFrame, keys=("movie_id", "cate_id")) -> DataFrame:
    """Words present in both top-K lists of an item."""
    both = top_a.select(*keys, "keyword").join(top_b.select(keys[0], "keyword"), [keys[0], "keyword"])
    return both.select(*keys, F.col("keyword").alias("topic"))


def agg_keyword_map(top: DataFrame, key="movie_id", channel="cate_id") -> DataFrame:
    """Per item: keyword -> weight map and the smallest channel id.  Bounded
    by K entries per item (input is a top-K list)."""
    return top.groupBy(key).agg(F.min(channel).alias(channel),
                                F.map_from_entries(F.collect_list(F.struct("keyword", "weight"))).alias("keywords"))


def agg_topic_list(topics: DataFrame, key="movie_id", channel="cate_id") -> DataFrame:
    """Per item: sorted list of topic words (bounded by K)."""
    return topics.groupBy(key, channel).agg(F.array_sort(F.collect_list("topic")).alias("topics"))


def item_profile(keyword_map: DataFrame, topic_list: DataFrame, key="movie_id", channel="cate_id") -> DataFrame:
    """Keyword map + topic list per item."""
    return keyword_map.join(topic_list.drop(channel), key)


def topic_weights(profile: DataFrame, stamp: int, key="movie_id", channel="cate_id") -> DataFrame:
    """Explode the keyword map, keep keywords that are topics, stamp the day."""
    e = profile.select(key, channel, "topics", F.explode("keywords").alias("topic", "weight"))
    return (e.where(F.array_contains("topics", F.col("topic")))
            .select(key, channel, "topic", "weight", F.lit(stamp).alias("timestamp")))


def topic_weights_direct(top_idf_tr: DataFrame, topics: DataFrame, stamp: int,
                         keys=("movie_id", "cate_id")) -> DataFrame:
    """Incremental form: join the topic words with their idf x textrank weight."""
    j = top_idf_tr.join(topics.select(keys[0], F.col("topic").alias("keyword")), [keys[0], "keyword"])
    return j.select(*keys, F.col("keyword").alias("topic"), "weight", F.lit(stamp).alias("timestamp"))


def topic_weights_normal(tw: DataFrame, titles: DataFrame | None = None, key="movie_id", channel="cate_id") -> DataFrame:
    """Min-max over the whole table (round 8) and the item title."""
    n = minmax_normalize(tw.select(key, channel, "topic", "weight"), "weight", 8)
    if titles is not None:
        n = n.join(titles.select(key, channel, "title"), [channel, key], "left")
    return n


def inverted_index(tw: DataFrame, key="movie_id", channel="cate_id") -> DataFrame:
    """Inverted index kept as rows: (channel, topic, item, weight, movie_count).

    The list-per-topic form would gather a hot topic into one row; the rows
    form joins the same way and stays distributed."""
    cnt = tw.groupBy(channel, "topic").agg(F.count(F.lit(1)).alias("movie_count"))
    return tw.select(channel, "topic", key, "weight").join(cnt, [channel, "topic"])


# topic rows up to which a table is sent to every task (counted first; a word and two numbers a row)
TOPIC_ROWS = 500_000
USER_ROWS = 1_000_000       # joined rows of one partition of users, about


def join_user_topics(action_weight: DataFrame, tw: DataFrame, key="movie_id") -> DataFrame:
    """user->item weight x item->topic weight (inner join on the item).

    Few items may have most actions, so where the topics of the items that have actions are few enough to be sent to
    every task (they are counted first), the actions are dealt out by user: no item's rows meet in one task, and what
    groups the joined rows by user moves none of them.  Otherwise both tables are dealt out by item."""
    a = action_weight.select("user_id", key, "cate_id", F.col("weight").alias("_aw"))
    t = tw.select(key, "topic", F.col("weight").alias("_tw"))
    row = [key, "user_id", "cate_id", "topic", (F.col("_aw") * F.col("_tw")).alias("weight")]
    items = stage_table(a.groupBy(key).agg(F.count(F.lit(1)).alias("_users")))
    lists = stage_table(t.join(items, key))
    n_rows, n_lists = lists.agg(F.sum("_users"), F.count(F.lit(1))).first()
    if n_lists > TOPIC_ROWS:
        return a.join(t, key).select(*row)
    n = max(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil((n_rows or 0) / USER_ROWS))
    return a.repartition(n, "user_id").join(F.broadcast(lists.drop("_users")), key).select(*row)


def user_topic_profile(action_topic: DataFrame, k: int | None = C.PROFILE_TOPK, digits=8) -> DataFrame:
    """Per (user, channel, topic): ``(w / (user_w + 1)) * (ln((users + 1) /
    (topic_users + 1)) + 1)``, ranked per (user, channel), top-K kept.

    The weights with their per-user sum are one stage table, written where the user's rows lie and read by the counts
    (per-channel distinct users, per-topic users: map-side partial aggregation) and by the ranking; the counts meet
    each other before they meet the weights, and are sent to every task where they are few."""
    ut = action_topic.groupBy("user_id", "cate_id", "topic").agg(F.sum("weight").alias("weight"))
    ut = stage_table(ut.withColumn("user_weight", F.sum("weight").over(Window.partitionBy("user_id", "cate_id"))))
    uc = ut.groupBy("cate_id").agg(F.countDistinct("user_id").alias("user_count"))
    tc = ut.groupBy("cate_id", "topic").agg(F.count("user_id").alias("topic_count"))
    counts = stage_table(tc.join(uc, "cate_id"))
    counts = F.broadcast(counts) if counts.count() <= TOPIC_ROWS else counts
    j = ut.where(F.col("user_id").isNotNull()).join(counts, ["cate_id", "topic"])
    w = (F.col("weight") / (F.col("user_weight") + 1)) * (
        F.log((F.col("user_count") + 1) / (F.col("topic_count") + 1)) + 1)
    out = j.select("user_id", "cate_id", "topic", F.round(w, digits).alias("weight"))
    win = Window.partitionBy("user_id", "cate_id").orderBy(F.desc("weight"), F.asc("topic"))
    out = out.withColumn("row_number", F.row_number().over(win))
    return out.where(F.col("row_number") <= k) if k else out


def log_topic_count(profile: DataFrame, digits=8) -> DataFrame:
    """Users per (channel, topic) and ``round(ln(count + 1), 8)``."""
    return (profile.groupBy("cate_id", "topic").agg(F.count("user_id").alias("user_count"))
            .withColumn("log_count", F.round(F.log(F.col("user_count") + 1), digits)))
