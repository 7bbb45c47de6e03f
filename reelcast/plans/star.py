"""Mapping of the recommendation domain onto the driver's star-schema tables.

* user action log   = ``events``: user_id; item = ``props.$.k``; ``click`` ->
  click, ``purchase`` -> favourite (top), ``view`` -> play of ``value``
  minutes; other event types are not actions.  The day of ``ts`` is the
  action time; the item's channel comes from the catalogue.
* catalogue         = ``part``: id = p_partkey, title = p_name, channel =
  p_type, score = p_size / 5, year = 2024 - p_size, label = p_brand.
* asset sources     = ``lineitem``: aid = l_partkey, sid = l_suppkey, episode
  total = l_linenumber, length = l_quantity * 300 s, internal source (12)
  unless returned, trailer flag on full-quantity full-discount lines.
* daily play counts = ``lineitem`` by l_partkey and ship day (count = quantity).
* large action log  = ``orders`` x ``lineitem`` (user = o_custkey, item =
  l_partkey, minutes = l_quantity, time = o_orderdate).
* text              = ``documents``: item doc_id takes the catalogue channel
  and title of the part with the same key; vectors = ``embeddings``
  (vec_id = item, cluster label as a channel).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcast import config as C
from reelcast.functions import columns as X
from reelcast.operators import actions as A
from reelcast.operators import factors as FA

AS_OF = "2024-01-31"            # events end on 2024-01-30
LINE_AS_OF = "2001-11-05"       # lineitem ships until 2001-11-04
NOW_YEAR = 2024
STAR_CHANNELS = C.Channels(film="STANDARD", series="MEDIUM", variety="PROMO", kids="SMALL")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


_STAGES: dict[tuple[str, str, str, str], object] = {}


def persisted(spark: SparkSession, d: str, name: str, build) -> DataFrame:
    """A chain's stage table in the shared folder, named by the version of the input folder: written when that
    version is first met, read afterwards.  A table that changes has another version, so nothing stale is read.
    ``reelcast.stages.run`` (a free text) starts stage tables of its own, as a cold run does."""
    from reelcast.session import input_version, shared_folder, stage_table
    run = spark.conf.get("reelcast.stages.run", "all")
    key = (shared_folder(spark), run, input_version(spark, d), name)
    path = f"{key[0]}/{run}-{key[2]}/{name}"
    if key not in _STAGES:
        _STAGES[key] = stage_table(build(), path).schema
    return spark.read.schema(_STAGES[key]).parquet(path)


def catalog(spark, d) -> DataFrame:
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_type").alias("cid"), F.col("p_name").alias("title"),
        (F.col("p_size") / F.lit(5.0)).alias("score"),
        (F.lit(NOW_YEAR) - F.col("p_size")).cast("string").alias("year"),
        F.col("p_brand").alias("cate"))


def asset_source(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_partkey").alias("aid"),
        F.when(F.col("l_returnflag") == "R", F.lit(11)).otherwise(F.lit(12)).alias("source"),
        F.col("l_suppkey").alias("sid"),
        F.when((F.col("l_quantity") == 50) & (F.col("l_discount") == 0.1), F.lit(1)).otherwise(F.lit(0)).alias("auth"),
        F.col("l_linenumber").cast("bigint").alias("eptotal"),
        F.lit(1).alias("status"),
        (F.col("l_quantity") * 300).cast("bigint").alias("len_s"))


def daily_plays(spark, d) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_partkey").alias("aid"), X.yyyymmdd_col("l_shipdate").alias("date"),
                     F.col("l_quantity").cast("bigint").alias("count"))


def event_logs(spark, d) -> DataFrame:
    """Action-bearing events with item id, channel and day epoch."""
    ev = table(spark, d, "events").where(F.col("event_type").isin("click", "view", "purchase"))
    ev = ev.select("user_id", "event_type", "value", X.json_long("props", "$.k").alias("aid"),
                   X.day_epoch("ts").alias("ymd"))
    cat = catalog(spark, d).select(F.col("id").alias("aid"), "cid")
    return ev.join(cat, "aid", "left")


def click_log(spark, d, kind="click") -> DataFrame:
    ev = event_logs(spark, d).where(F.col("event_type") == ("click" if kind == "click" else "purchase"))
    return A.parse_click_log(ev, user="user_id", ts="ymd", item="aid", cate="cid")


def play_log(spark, d) -> DataFrame:
    ev = event_logs(spark, d).where(F.col("event_type") == "view")
    return A.parse_play_log(ev, user="user_id", ts="ymd", item="aid", cate="cid",
                            play_ms=(F.col("value") * 60000).cast("bigint"), ep_num=F.lit(1))


def episode_totals(spark, d) -> DataFrame:
    return A.agg_total_num(asset_source(spark, d))


def item_lengths(spark, d) -> DataFrame:
    return FA.movie_length(asset_source(spark, d), seconds="len_s")


def source_stats(spark, d):
    """(totals, lengths) from one grouped pass over the sources (the shared
    aggregate is planned once and its exchange reused by both consumers)."""
    st = persisted(spark, d, "source_stats", lambda: FA.item_source_stats(asset_source(spark, d), seconds="len_s"))
    totals = st.select("movie_id", "total_num")
    lengths = st.where(F.col("movie_len").isNotNull() & (F.col("movie_len") < C.ITEM_LENGTH_BOUND)).select(
        "movie_id", "movie_len")
    return totals, lengths


def action_log(spark, d) -> DataFrame:
    """All three actions of ``events`` in one frame (one scan)."""
    ev = event_logs(spark, d)
    action = (F.when(F.col("event_type") == "click", "click").when(F.col("event_type") == "purchase", "top")
              .otherwise("play"))
    out = ev.select(F.col("user_id"), F.col("aid").alias("movie_id"), F.col("cid").alias("cate_id"),
                    F.col("ymd").alias("datetime"), action.alias("action"),
                    F.when(F.col("event_type") == "view", (F.col("value") * 60000).cast("bigint")).alias("play_time"),
                    F.lit(1).cast("bigint").alias("movie_num"))
    ok = (F.col("user_id").isNotNull() & F.col("movie_id").isNotNull() & F.col("cate_id").isNotNull()
          & F.col("datetime").isNotNull() & ((F.col("action") != "play") | F.col("play_time").isNotNull()))
    return out.where(ok)


def merged_logs(spark, d):
    """(click, top, play) merged logs: distinct rows, plays in minutes."""
    click = A.union_slices_distinct(click_log(spark, d, "click"))
    top = A.union_slices_distinct(click_log(spark, d, "top"))
    play = A.resolve_episode_total(play_log(spark, d), episode_totals(spark, d), film_channel=STAR_CHANNELS.film)
    play = A.union_slices_distinct(A.play_minutes_range(A.play_dedupe_max(play)))
    return click, top, play


def merged_actions(spark, d) -> DataFrame:
    """One-hot merged actions (single pass over the event log), kept as the
    ``merge_action`` stage table."""
    def build():
        totals, _ = source_stats(spark, d)
        log = persisted(spark, d, "merged_log", lambda: A.dedupe_action_log(action_log(spark, d)))
        return A.merge_action_log(log, totals, film_channel=STAR_CHANNELS.film)
    return persisted(spark, d, "merge_action", build)


def action_weights(spark, d) -> DataFrame:
    _, lengths = source_stats(spark, d)
    rows = A.action_row_weights(merged_actions(spark, d), lengths, X.as_epoch(AS_OF))
    return A.agg_action_weight(rows)


def order_actions(spark, d) -> DataFrame:
    """Large action log: every order line is a play of l_quantity minutes."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    cat = catalog(spark, d).select(F.col("id").alias("l_partkey"), F.col("cid"))
    j = j.join(cat, "l_partkey", "left")
    return j.select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("movie_id"),
                    F.col("cid").alias("cate_id"), X.epoch_of("o_orderdate").alias("datetime"),
                    F.lit(False).alias("click"), F.lit(False).alias("top"),
                    F.col("l_quantity").cast("bigint").alias("play_time"),
                    F.col("l_linenumber").cast("bigint").alias("total_num"))


def watch_log(spark, d) -> DataFrame:
    """Play log with item length: (aid, cid, totalTime, playtime, timestamp), minutes."""
    li = table(spark, d, "lineitem").select("l_partkey", "l_quantity", "l_shipdate")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_size")
    j = li.join(p, "l_partkey", "left")
    return j.select(F.col("l_partkey").alias("aid"), F.col("p_type").alias("cid"),
                    F.col("p_size").cast("double").alias("totalTime"),
                    F.col("l_quantity").alias("playtime"), X.epoch_of("l_shipdate").alias("timestamp"))


def order_plays(spark, d) -> DataFrame:
    """Third-party play rows: (qid = supplier, aid = order, cid = part type)."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    p = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    j = li.join(p, "l_partkey", "left")
    return j.select(F.col("l_suppkey").alias("qid"), F.col("l_orderkey").alias("aid"), F.col("p_type").alias("cid"))


def documents(spark, d) -> DataFrame:
    """Catalogue text: item = doc_id with the catalogue's channel and title.

    The text is dealt out by item once (``spark.sql.shuffle.partitions`` tasks), whatever the number of input
    splits: the per-row text work of the chain is heavy, and the channel's join needs the same layout."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("movie_id"), F.col("text").alias("summary"))
    cat = catalog(spark, d).select(F.col("id").alias("movie_id"), F.col("cid").alias("cate_id"), "title")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return docs.repartition(n, "movie_id").join(cat, "movie_id", "left").select(
        "movie_id", "cate_id", "title", "summary")


def documents_by_part(spark, d, parts: int) -> DataFrame:
    """``documents`` with their ``part``, all rows of a part in one task: texts and channels are dealt out by it."""
    from reelcast.operators import text as TO
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = TO.part_of("movie_id", parts)
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("movie_id"), F.col("text").alias("summary"))
    cat = catalog(spark, d).select(F.col("id").alias("movie_id"), F.col("cid").alias("cate_id"))
    docs, cat = (x.select("*", part).repartition(n, "part") for x in (docs, cat))
    return docs.join(cat, ["part", "movie_id"], "left")


STAMP = 20240130                    # yyyymmdd of the day before AS_OF


class Chain(dict):
    """Stage frames built on first access (persisted stages are built only
    when a query needs them)."""

    def __init__(self, builders: dict):
        super().__init__()
        self._builders = builders

    def __missing__(self, key):
        val = self._builders[key](self)
        self[key] = val
        return val


def text_chain(spark, d) -> Chain:
    """The item-profile chain over ``documents``."""
    from reelcast.operators import profiles as P
    from reelcast.operators import text as TO

    def document_factors(c, **kw):
        parts = TO.part_count(c["terms"])
        return TO.document_factors(documents_by_part(spark, d, parts), TO.part_words(c["terms"], c["idf"], parts), **kw)

    return Chain({
        "docs": lambda c: documents(spark, d),
        "words": lambda c: TO.cut_words(c["docs"], "summary"),
        "terms": lambda c: persisted(spark, d, "terms", lambda: TO.text_terms(c["docs"], "summary")),
        "vocabulary": lambda c: persisted(spark, d, "vocabulary", lambda: TO.fit_vocabulary(c["terms"])),
        "idf": lambda c: TO.fit_idf(c["terms"], vocabulary=c["vocabulary"]),
        "tfidf": lambda c: persisted(spark, d, "tfidf", lambda: TO.explode_tfidf(c["terms"], c["idf"])),
        # textrank and topic weights are the chain's persisted tables: reliable
        # checkpoints keep the Python stage from running once per plan branch
        "textrank": lambda c: persisted(spark, d, "textrank", lambda: TO.textrank_documents(c["docs"], "summary")),
        # both weights need a word's idf beside its rank: words go to the documents' parts, documents' rows stay
        "factors": lambda c: document_factors(c),
        "top_factors": lambda c: persisted(spark, d, "top_factors", lambda: document_factors(c, keep=C.KEYWORD_TOPK)),
        "idf_tr": lambda c: P.idf_textrank(c["factors"]),
        "tfidf_tr": lambda c: P.tfidf_textrank(c["factors"]),
        "top_idf_tr": lambda c: P.topk_keywords(P.idf_textrank(c["top_factors"]), C.KEYWORD_TOPK),
        "top_tfidf_tr": lambda c: P.topk_keywords(P.tfidf_textrank(c["top_factors"]), C.KEYWORD_TOPK),
        "topics": lambda c: P.topic_words(c["top_idf_tr"], c["top_tfidf_tr"]),
        "kw_map": lambda c: P.agg_keyword_map(c["top_idf_tr"]),
        "topic_list": lambda c: P.agg_topic_list(c["topics"]),
        "profile": lambda c: P.item_profile(c["kw_map"], c["topic_list"]),
        "topic_weights": lambda c: persisted(spark, d, "topic_weights", lambda: P.topic_weights(c["profile"], STAMP)),
    })


def word_vectors(spark, d) -> DataFrame:
    """Word vectors of ``documents``: the model is fitted once for a version of the input, its table read after."""
    from reelcast.operators import text as TO
    from reelcast.operators import vectors as V
    return persisted(spark, d, "word_vectors", lambda: V.word_vectors(V.fit_word2vec(
        TO.cut_words(documents(spark, d), "summary"), dim=C.VECTOR_DIM, min_count=C.W2V_MIN_COUNT)))


def factor_tables(spark, d) -> Chain:
    year = lambda c, **kw: FA.year_factor(c["catalog"], NOW_YEAR, variety=STAR_CHANNELS.variety, **kw)
    return Chain({
        "catalog": lambda c: catalog(spark, d),
        "hot": lambda c: persisted(spark, d, "movie_hot_factor", lambda: FA.hot_factor(
            FA.agg_hot_count(c["catalog"], daily_plays(spark, d), LINE_AS_OF, C.HOT_DAYS))),
        "score": lambda c: FA.score_factor(c["catalog"]),
        "year": lambda c: year(c),
        "year_variety": lambda c: year(c, cate_id=STAR_CHANNELS.variety),
    })


def history_pairs(spark, d) -> DataFrame:
    """Play and click history (user, item) used to exclude seen items."""
    acts = merged_actions(spark, d)
    play = A.history_items(acts, "play").select("user_id", "movie_id")
    click = A.history_items(acts, "click").select("user_id", "movie_id")
    return play.unionByName(click).dropDuplicates()


def profile_chain(spark, d) -> Chain:
    from reelcast.operators import profiles as P
    from reelcast.operators import recall as R
    from reelcast.operators.ranking import top_k
    return Chain({
        "text": lambda c: text_chain(spark, d),
        "factor_tables": lambda c: factor_tables(spark, d),
        "action_weight": lambda c: persisted(spark, d, "action_weight", lambda: action_weights(spark, d)),
        "action_weight_normal": lambda c: A.minmax_normalize(c["action_weight"], "weight", 8),
        "topic_weights_normal": lambda c: P.topic_weights_normal(c["text"]["topic_weights"]),
        "action_topic": lambda c: P.join_user_topics(c["action_weight_normal"], c["topic_weights_normal"]),
        "profile": lambda c: persisted(spark, d, "user_topic_profile",
                                       lambda: P.user_topic_profile(c["action_topic"], C.PROFILE_TOPK)),
        "inverted": lambda c: P.inverted_index(c["topic_weights_normal"]),
        "cands": lambda c: R.expand_candidates(c["profile"], c["inverted"]),
        "cands_by_user": lambda c: R.expand_candidates(c["profile"], c["inverted"], by_user=True),
        "merged": lambda c: persisted(spark, d, "merged", lambda: R.merge_same_item(c["cands_by_user"])),
        "pre": lambda c: top_k(c["merged"], ["user_id"], [F.desc("weight"), F.asc("movie_id")], C.USER_PRE_TOPK),
        "history": lambda c: history_pairs(spark, d),
        "nohist": lambda c: R.anti_history(c["pre"].drop("sort_num"), c["history"]),
        "versions": lambda c: R.filter_versions_user(c["nohist"], c["factor_tables"]["catalog"], STAR_CHANNELS),
        "factors": lambda c: R.weight_by_factors_user(c["versions"], c["factor_tables"]["hot"],
                                                      c["factor_tables"]["score"], c["factor_tables"]["year"]),
        "final": lambda c: R.profile_recall(
            c["profile"], c["inverted"], c["history"], c["factor_tables"]["catalog"], c["factor_tables"]["hot"],
            c["factor_tables"]["score"], c["factor_tables"]["year"], STAR_CHANNELS, STAMP, merged=c["merged"]),
    })


def item_vectors(spark, d) -> DataFrame:
    """embeddings as item vectors: (movie_id, label, vec array<double>, cate_id)."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("movie_id"), "label",
                                              F.col("embedding").cast("array<double>").alias("vec"))
    cat = catalog(spark, d).select(F.col("id").alias("movie_id"), F.col("cid").alias("cate_id"))
    return e.join(cat, "movie_id", "left")


def item_chain(spark, d) -> Chain:
    """Item -> item recall over channel-wise exact cosine neighbours."""
    from reelcast.operators import recall as R
    from reelcast.operators import vectors as V
    part = lambda c: c["vectors"].select("cate_id", "movie_id", "vec")
    return Chain({
        "vectors": lambda c: item_vectors(spark, d),
        "factor_tables": lambda c: factor_tables(spark, d),
        "sources": lambda c: asset_source(spark, d),
        "neighbours": lambda c: persisted(spark, d, "item_neighbours", lambda: V.block_topk(
            part(c), part(c), ["cate_id"], C.NEIGHBOURS_K, "cosine").withColumnRenamed("score", "cos_sim")),
        "candidates": lambda c: c["neighbours"].drop("sort_num").join(c["vectors"].select("movie_id", "cate_id"),
                                                                      "movie_id"),
        "versions": lambda c: R.filter_versions_item(c["candidates"], c["factor_tables"]["catalog"], STAR_CHANNELS),
        "factors": lambda c: R.weight_by_factors_item(
            c["versions"], c["factor_tables"]["catalog"], c["factor_tables"]["score"], c["factor_tables"]["hot"],
            c["factor_tables"]["year"], c["factor_tables"]["year_variety"], STAR_CHANNELS),
        "rules": lambda c: R.rules_item_final(
            c["factors"], STAR_CHANNELS, labels=c["factor_tables"]["catalog"],
            short_single=FA.short_single_episode(c["sources"], seconds="len_s")),
        "final": lambda c: R.item_recall_final(c["rules"], FA.trailer_ids(c["sources"]), c["sources"], STAMP,
                                               C.NEIGHBOURS_K),
    })


def item_recall(spark, d, neighbours: DataFrame, stamp: int = STAMP) -> DataFrame:
    """Item recall from given neighbours (movie_id, movie_id2, cos_sim, cate_id): the tail of :func:`item_chain`."""
    from reelcast.operators import recall as R
    chain = item_chain(spark, d)
    chain["candidates"] = neighbours.select("movie_id", "movie_id2", "cos_sim", "cate_id")
    return R.item_recall_final(chain["rules"], FA.trailer_ids(chain["sources"]), chain["sources"], stamp, C.NEIGHBOURS_K)


def vector_chain(spark, d) -> Chain:
    """Own item vectors -> size-bounded clusters per channel -> cosine inside the clusters -> item recall."""
    from reelcast.operators import clusters as CL
    from reelcast.operators import vectors as V
    key = F.concat_ws("/", "cate_id", "node")
    return Chain({
        "vectors": lambda c: persisted(spark, d, "item_vector", lambda: V.item_vector(
            text_chain(spark, d)["topic_weights"], word_vectors(spark, d))),
        "clusters": lambda c: persisted(spark, d, "item_clusters", lambda: CL.split_clusters(
            c["vectors"], ["cate_id"], C.MIN_CLUSTER_SIZE)),
        "neighbours": lambda c: persisted(spark, d, "cluster_neighbours", lambda: V.cosine_in_cluster(
            c["clusters"].select(key.alias("cluster"), "movie_id", "vec"), "cluster", C.NEIGHBOURS_K)),
        "final": lambda c: item_recall(spark, d, c["neighbours"].join(
            c["clusters"].select("movie_id", "cate_id"), "movie_id")),
    })


def similar_chain(spark, d) -> Chain:
    from reelcast.operators import recall as R
    return Chain({
        "weights": lambda c: A.minmax_normalize(action_weights(spark, d), "weight", 8),
        "item": lambda c: persisted(spark, d, "item_recall", lambda: item_chain(spark, d)["final"]),
        "expanded": lambda c: R.similar_recall_expand(c["weights"], c["item"]),
        "merge": lambda c: R.similar_recall_merge(c["expanded"]),
        "merged": lambda c: c["merge"][0],
        "explanations": lambda c: c["merge"][1],
        "final": lambda c: R.similar_recall(c["merged"], history_pairs(spark, d), asset_source(spark, d), STAMP,
                                            C.USER_FINAL_TOPK),
    })
