"""Registered queries: every operator of the inventory run over the star tables.

Each entry is ``fn(spark, sf_dir) -> DataFrame``; the matching DuckDB text is
in :mod:`reelcast.plans.oracle` under the same key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcast import config as C
from reelcast.functions import columns as X
from reelcast.operators import actions as A
from reelcast.plans import star as S

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- actions
@query("parse_click_log")
def q_parse_click_log(spark, d):
    return S.click_log(spark, d, "click")


@query("parse_play_log")
def q_parse_play_log(spark, d):
    return S.play_log(spark, d)


@query("resolve_episode_total")
def q_resolve_episode_total(spark, d):
    return A.resolve_episode_total(S.play_log(spark, d), S.episode_totals(spark, d),
                                   film_channel=S.STAR_CHANNELS.film)


@query("play_dedupe_max")
def q_play_dedupe_max(spark, d):
    return A.play_dedupe_max(q_resolve_episode_total(spark, d))


@query("union_slices_distinct")
def q_union_slices_distinct(spark, d):
    """Merged play log: minutes in range, distinct rows."""
    return S.merged_logs(spark, d)[2]


@query("merge_actions")
def q_merge_actions(spark, d):
    return S.merged_actions(spark, d)


@query("action_row_weight")
def q_action_row_weight(spark, d):
    return A.action_row_weights(S.merged_actions(spark, d), S.item_lengths(spark, d), X.as_epoch(S.AS_OF))


@query("agg_action_weight")
def q_agg_action_weight(spark, d):
    return S.action_weights(spark, d)


@query("minmax_normalize")
def q_minmax_normalize(spark, d):
    return A.minmax_normalize(S.action_weights(spark, d), "weight", 8)


@query("user_top_items")
def q_user_top_items(spark, d):
    """Flagship: five heaviest items per user."""
    return A.topk_per_user(S.action_weights(spark, d), 5).withColumn("sort_num", F.col("sort_num").cast("bigint"))


@query("order_action_weight")
def q_order_action_weight(spark, d):
    """Large action log (orders x lineitem) through the same weighting."""
    rows = A.action_row_weights(S.order_actions(spark, d), S.item_lengths(spark, d), X.as_epoch(S.LINE_AS_OF))
    return A.agg_action_weight(rows)


def _history(kind):
    def fn(spark, d):
        titles = S.catalog(spark, d).select(F.col("id").alias("movie_id"), "title", "year")
        h = A.user_history(S.merged_actions(spark, d), kind, titles)
        return h.withColumn("sort_time", F.col("sort_time").cast("bigint"))
    return fn


for _k in ("click", "top", "play"):
    REGISTRY[f"user_history_{_k}"] = _history(_k)


@query("agg_action_stat")
def q_agg_action_stat(spark, d):
    return A.agg_action_stat(S.merged_actions(spark, d))


@query("scan_recent_actions")
def q_scan_recent_actions(spark, d):
    return A.scan_recent_actions(S.merged_actions(spark, d), X.as_epoch(S.AS_OF), 7)


@query("slice_index")
def q_slice_index(spark, d):
    ev = S.table(spark, d, "events")
    return (ev.select(X.slice_index("ts", (2023, 12, 10)).alias("slice"))
            .groupBy("slice").agg(F.count(F.lit(1)).alias("n_events")))


# ---------------------------------------------------------------- factors
from reelcast.operators import factors as FA  # noqa: E402


def _hot_sort(spark, d):
    hot = FA.agg_hot_count(S.catalog(spark, d), S.daily_plays(spark, d), S.LINE_AS_OF, 30)
    return FA.rank_in_channel(hot, "weight")


@query("agg_hot_count")
def q_agg_hot_count(spark, d):
    return FA.agg_hot_count(S.catalog(spark, d), S.daily_plays(spark, d), S.LINE_AS_OF, 30)


@query("rank_hot")
def q_rank_hot(spark, d):
    return _hot_sort(spark, d)


@query("hot_factor")
def q_hot_factor(spark, d):
    return FA.hot_factor(_hot_sort(spark, d))


@query("score_factor")
def q_score_factor(spark, d):
    return FA.score_factor(S.catalog(spark, d))


@query("rank_score")
def q_rank_score(spark, d):
    sf = FA.rank_in_channel(FA.score_factor(S.catalog(spark, d)), "factor")
    return sf.withColumn("sort_num", F.col("sort_num").cast("bigint"))


@query("year_factor")
def q_year_factor(spark, d):
    return FA.year_factor(S.catalog(spark, d), S.NOW_YEAR, variety=S.STAR_CHANNELS.variety)


@query("movie_length")
def q_movie_length(spark, d):
    return S.item_lengths(spark, d)


@query("agg_total_num")
def q_agg_total_num(spark, d):
    return S.episode_totals(spark, d)


@query("trailer_ids")
def q_trailer_ids(spark, d):
    return FA.trailer_ids(S.asset_source(spark, d))


@query("short_single_episode")
def q_short_single_episode(spark, d):
    return FA.short_single_episode(S.asset_source(spark, d), seconds="len_s")


@query("hot_watch_ratio")
def q_hot_watch_ratio(spark, d):
    return FA.hot_watch_ratio(S.watch_log(spark, d), X.as_epoch(S.LINE_AS_OF), 90)


@query("match_ids")
def q_match_ids(spark, d):
    return FA.match_ids(S.order_plays(spark, d), S.asset_source(spark, d), S.catalog(spark, d))


# ---------------------------------------------------------------- text
from reelcast.functions import text as TX  # noqa: E402
from reelcast.operators import profiles as P  # noqa: E402
from reelcast.operators import text as TO  # noqa: E402


@query("clean_catalog")
def q_clean_catalog(spark, d):
    return TO.clean_catalog(S.catalog(spark, d), S.STAR_CHANNELS)


@query("build_summary")
def q_build_summary(spark, d):
    return TO.build_summary(S.catalog(spark, d), parts=("title", "cate", "year"))


@query("tokenize_chars")
def q_tokenize_chars(spark, d):
    p = S.catalog(spark, d)
    return p.select("id", F.array_join(TX.tokenize_chars("title"), "|").alias("tokens"))


@query("normalize_release_name")
def q_normalize_release_name(spark, d):
    pg = S.table(spark, d, "pages")
    return pg.select("page_id", TX.normalize_release_name(F.col("url")).alias("name"))


@query("tokenize_words")
def q_tokenize_words(spark, d):
    w = TO.cut_words(S.documents(spark, d), "summary")
    return w.select("movie_id", "cate_id", F.size("words").alias("n_words"),
                    TO.tokens_column(F.col("words")).alias("words"))


@query("fit_count_vectorizer")
def q_fit_count_vectorizer(spark, d):
    return S.text_chain(spark, d)["vocabulary"]


@query("bounded_vocabulary")
def q_bounded_vocabulary(spark, d):
    """The thousand most frequent terms that two documents have at least."""
    return TO.fit_vocabulary(S.text_chain(spark, d)["terms"], size=1000, min_df=2)


@query("fit_idf")
def q_fit_idf(spark, d):
    return S.text_chain(spark, d)["idf"].withColumn("idf", F.round("idf", 8))


@query("explode_tfidf")
def q_explode_tfidf(spark, d):
    return S.text_chain(spark, d)["tfidf"].withColumn("idf", F.round("idf", 8))


@query("topk_tfidf")
def q_topk_tfidf(spark, d):
    t = S.text_chain(spark, d)["tfidf"].select("movie_id", "cate_id", "keyword", "tfidf")
    return TO.topk_by(t, ["movie_id"], "tfidf", 30, "keyword").withColumn("sort_num", F.col("sort_num").cast("bigint"))


@query("textrank_keywords")
def q_textrank_keywords(spark, d):
    return S.text_chain(spark, d)["textrank"]


@query("idf_textrank")
def q_idf_textrank(spark, d):
    return S.text_chain(spark, d)["idf_tr"]


@query("tfidf_textrank")
def q_tfidf_textrank(spark, d):
    return S.text_chain(spark, d)["tfidf_tr"]


@query("topk_keyword_weight")
def q_topk_keyword_weight(spark, d):
    return S.text_chain(spark, d)["top_idf_tr"]


@query("topic_words")
def q_topic_words(spark, d):
    return S.text_chain(spark, d)["topics"]


@query("agg_topic_list")
def q_agg_topic_list(spark, d):
    t = S.text_chain(spark, d)["topic_list"]
    return t.select("movie_id", "cate_id", F.size("topics").alias("n_topics"),
                    F.array_join("topics", " ").alias("topics"))


@query("item_profile")
def q_item_profile(spark, d):
    p = S.text_chain(spark, d)["profile"]
    return p.select("movie_id", "cate_id", F.size("keywords").alias("n_keywords"),
                    F.array_join(F.array_sort(F.map_keys("keywords")), " ").alias("keywords"),
                    F.array_join("topics", " ").alias("topics"))


@query("topic_weights")
def q_topic_weights(spark, d):
    return S.text_chain(spark, d)["topic_weights"]


@query("topic_weights_normal")
def q_topic_weights_normal(spark, d):
    c = S.text_chain(spark, d)
    return P.topic_weights_normal(c["topic_weights"], c["docs"])


# ---------------------------------------------------------------- user profile recall
def _pc(name, post=None):
    def fn(spark, d):
        df = S.profile_chain(spark, d)[name]
        return post(df) if post else df
    return fn


REGISTRY["join_user_topics"] = _pc("action_topic", lambda df: df.withColumn("weight", F.round("weight", 8)))
REGISTRY["user_topic_profile"] = _pc("profile", lambda df: df.withColumn("row_number", F.col("row_number").cast("bigint")))
REGISTRY["agg_inverted_index"] = _pc("inverted")
REGISTRY["expand_candidates"] = _pc("cands")
REGISTRY["merge_same_item"] = _pc("merged")
REGISTRY["topk_prerecall"] = _pc("pre")
REGISTRY["anti_history"] = _pc("nohist")
REGISTRY["filter_versions_user"] = _pc("versions")
REGISTRY["weight_by_factors_user"] = _pc("factors")
REGISTRY["profile_recall"] = _pc("final")


@query("log_topic_count")
def q_log_topic_count(spark, d):
    return P.log_topic_count(S.profile_chain(spark, d)["profile"])


# ---------------------------------------------------------------- vectors
from reelcast.operators import recall as R  # noqa: E402
from reelcast.operators import vectors as V  # noqa: E402


@query("cosine_in_cluster")
def q_cosine_in_cluster(spark, d):
    v = S.item_vectors(spark, d).select("label", "movie_id", "vec")
    return V.cosine_in_cluster(v, "label", C.NEIGHBOURS_K)


@query("knn_exact_l2")
def q_knn_exact_l2(spark, d):
    """Queries: the items whose id is divisible by 100."""
    v = S.item_vectors(spark, d)
    return V.knn_exact_l2(v.where("movie_id % 100 = 0"), v, 10)


@query("topk_neighbours")
def q_topk_neighbours(spark, d):
    """Channel-wise top-100 cosine neighbours (input of the item recall)."""
    return S.item_chain(spark, d)["neighbours"]


@query("ann_neighbours")
def q_ann_neighbours(spark, d):
    return V.ann_neighbours(S.item_vectors(spark, d), k=10, nprobe=3)


@query("lsh_pairs")
def q_lsh_pairs(spark, d):
    """Every pair of items that share a bucket in any of three hash tables."""
    return V.lsh_pairs(S.item_vectors(spark, d), bucket_length=1.0, tables=3)


@query("agg_vector_mean")
def q_agg_vector_mean(spark, d):
    """Mean of the distinct action-weighted item vectors per user."""
    w = S.action_weights(spark, d).select("user_id", "movie_id", "weight")
    v = S.item_vectors(spark, d).select("movie_id", "vec")
    j = w.join(v, "movie_id").select("user_id", F.transform("vec", lambda x: x * F.col("weight")).alias("vec"))
    m = V.mean_of_distinct(j, "user_id")
    return m.select("user_id", F.posexplode("vec").alias("dim", "value")).select(
        "user_id", F.col("dim").cast("bigint").alias("dim"), F.round("value", 6).alias("value"))


@query("fit_word2vec")
def q_fit_word2vec(spark, d):
    return S.word_vectors(spark, d)


@query("item_vector")
def q_item_vector(spark, d):
    return V.item_vector(S.text_chain(spark, d)["topic_weights"], S.word_vectors(spark, d))


@query("cluster_items")
def q_cluster_items(spark, d):
    assigned, _ = V.cluster_items(S.item_vectors(spark, d), k=10, min_size=1.0)
    return assigned.select("movie_id", "cate_id", "group")


# ---------------------------------------------------------------- item and similar recall
def _ic(name, post=None):
    def fn(spark, d):
        df = S.item_chain(spark, d)[name]
        return post(df) if post else df
    return fn


def _sc(name):
    def fn(spark, d):
        return S.similar_chain(spark, d)[name]
    return fn


REGISTRY["filter_versions_item"] = _ic("versions")
REGISTRY["weight_by_factors_item"] = _ic("factors")
REGISTRY["rules_item_final"] = _ic("rules")
REGISTRY["item_recall_final"] = _ic("final")
REGISTRY["similar_recall_expand"] = _sc("expanded")
REGISTRY["similar_recall_merge"] = _sc("merged")
REGISTRY["similar_recall_explanations"] = _sc("explanations")
REGISTRY["similar_recall"] = _sc("final")


# ---------------------------------------------------------------- search
from reelcast.operators import search as SE  # noqa: E402

STAR_REQUIRED = "[a-z]"      # the star corpus is Latin-script: a match needs a letter token


def _search_inputs(spark, d):
    q = SE.tokenize_queries(S.table(spark, d, "benchmark"), "item_id", "text")
    t = SE.tokenize_targets(S.table(spark, d, "documents"), "doc_id", "text")
    return q, t


@query("agg_token_hits")
def q_agg_token_hits(spark, d):
    return SE.agg_token_hits(*_search_inputs(spark, d), required=STAR_REQUIRED)


@query("title_search")
def q_title_search(spark, d):
    return SE.title_search(*_search_inputs(spark, d), required=STAR_REQUIRED)


@query("best_query_match")
def q_best_query_match(spark, d):
    return SE.best_query_match(*_search_inputs(spark, d), required=STAR_REQUIRED)


# ---------------------------------------------------------------- sources, sinks, generic
from reelcast.operators import generic as G  # noqa: E402
from reelcast.sources import sinks as SK  # noqa: E402
from reelcast.sources import tables as TB  # noqa: E402


@query("scan_time_window")
def q_scan_time_window(spark, d):
    ev = S.table(spark, d, "events").select("event_id", "user_id", "event_type", X.epoch_of("ts").alias("create_time"))
    return TB.scan_time_window(ev, "create_time", S.AS_OF, days=1)


@query("scan_table")
def q_scan_table(spark, d):
    """Projection + channel filter pushed into the Parquet scan."""
    return TB.scan_table(spark, f"{d}/part.parquet", ["p_partkey", "p_name", "p_type"],
                         where=F.col("p_type") == S.STAR_CHANNELS.film)


@query("union_distinct")
def q_union_distinct(spark, d):
    return S.history_pairs(spark, d)


@query("dedupe_keys")
def q_dedupe_keys(spark, d):
    ev = S.table(spark, d, "events").select("user_id", "event_type", "event_id", "ts", "value")
    newest_first = -F.unix_micros(F.col("ts").cast("timestamp"))
    return G.dedupe_keys(ev, ["user_id", "event_type"], [newest_first, F.col("event_id")]).drop("ts")


@query("null_profile")
def q_null_profile(spark, d):
    return G.null_profile(S.table(spark, d, "labels").join(S.table(spark, d, "documents").select("doc_id", "lang"),
                                                           "doc_id", "right"))


@query("describe_columns")
def q_describe_columns(spark, d):
    return G.describe_columns(S.table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query("save_keyed_map")
def q_save_keyed_map(spark, d):
    """Item recall in the keyed-map layout, read back as (rowkey, qualifier, value)."""
    m = SK.keyed_map(S.item_chain(spark, d)["final"], "movie_id", "movie_id2", "weight", 4)
    return m.select(F.col("movie_id").alias("rowkey"), F.explode("cells").alias("qualifier", "value"))


@query("recommend_lookup")
def q_recommend_lookup(spark, d):
    """Every user key (12-char padded id) and every item key looked up."""
    from reelcast.session import stage_table
    users = stage_table(S.profile_chain(spark, d)["final"].withColumn(
        "user_id", F.lpad(F.col("user_id").cast("string"), 12, "0")))
    items = stage_table(S.item_chain(spark, d)["final"])
    keys = users.select(F.col("user_id").alias("key")).unionByName(
        items.select(F.col("movie_id").cast("string").alias("key"))).distinct()
    served = []
    for name, rows, key in (("users", users, "user_id"), ("items", items, "movie_id")):
        path = _place(spark, name)
        SK.save_lookup(rows, path, key, buckets=16)
        served.append(SK.read_lookup(keys.select(F.col("key").alias(key)), path, key, buckets=16))
    return R.recommend_lookup(keys, *served)


@query("rows_to_json")
def q_rows_to_json(spark, d):
    b = SE.best_query_match(*_search_inputs(spark, d), required=STAR_REQUIRED)
    return SE.rows_to_json(b.select("query_id", "movie_id", "num"))


@query("explanation_to_string")
def q_explanation_to_string(spark, d):
    return R.explanation_list(S.similar_chain(spark, d)["explanations"])


# ---------------------------------------------------------------- tables written and read back
def _place(spark, name):
    import uuid

    from reelcast.session import shared_folder
    return f"{shared_folder(spark)}/sink-{name}-{uuid.uuid4().hex}"


@query("append_once")
def q_append_once(spark, d):
    """The click log appended by day, the whole run twice: the second run replaces its days."""
    rows, path = S.click_log(spark, d, "click"), _place(spark, "append")
    for _ in range(2):
        SK.append_once(rows, path, "datetime")
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


@query("rotate_merge")
def q_rotate_merge(spark, d):
    """The merged click log by ten-day slice: everything until the middle of the month, then the slices that are still
    open (their old rows once more, and the new ones)."""
    rows, path = S.click_log(spark, d, "click"), _place(spark, "rotate")
    sliced = rows.withColumn("slice", X.slice_index(F.timestamp_seconds("datetime"), (2023, 12, 10)))
    SK.rotate_merge(sliced.where(F.col("datetime") < X.as_epoch("2024-01-16")), path)
    merged = SK.rotate_merge(sliced.where(F.col("datetime") >= X.as_epoch("2024-01-11")), path)
    return merged.select(*rows.columns)


@query("save_insert")
def q_save_insert(spark, d):
    """A full run over even ids, then the same increment of odd ids twice."""
    rows, path = q_agg_hot_count(spark, d), _place(spark, "insert")
    SK.save_insert(rows.where("aid % 2 = 0"), path, ["aid", "title", "weight"], full=True)
    for _ in range(2):
        SK.save_insert(rows.where("aid % 2 = 1"), path, ["aid", "title", "weight"], full=False)
    return spark.read.parquet(path).select("aid", "title", "weight")


@query("save_serving_slice")
def q_save_serving_slice(spark, d):
    """Narrow projection of the popularity table, one folder per channel."""
    rows, path = q_agg_hot_count(spark, d), _place(spark, "slice")
    SK.save_serving_slice(rows, ["aid", "weight"], path, "cid")
    return spark.read.schema("aid long, weight long, cid string").parquet(path)


@query("row_count_audit")
def q_row_count_audit(spark, d):
    """Two tables written twice on one day: one audit row each."""
    path, audit = _place(spark, "audited"), _place(spark, "audit")
    for _ in range(2):
        SK.row_count_audit(S.click_log(spark, d, "click"), "click", f"{path}/click", audit, S.STAMP)
        SK.row_count_audit(q_agg_hot_count(spark, d), "hot", f"{path}/hot", audit, S.STAMP)
    return spark.read.schema("rows long, table string, stamp int").parquet(audit)


@query("scan_action_slices")
def q_scan_action_slices(spark, d):
    """Clicks and favourites written into the slice table in one pass each; clicks read from slice 4 on."""
    ev, root = S.table(spark, d, "events"), _place(spark, "slices")
    for kind, event in (("click", "click"), ("top", "purchase")):
        TB.write_action_slices(ev.where(F.col("event_type") == event).select(
            F.col("user_id").cast("string").alias("mac"), "event_id", F.lit("focus").alias("funtype"),
            X.slice_index("ts", (2023, 12, 10)).alias("slice")), root, kind)
    return TB.scan_action_slices(spark, root, "click", start=4).select(
        "mac", "event_id", F.col("_slice").alias("slice"))


# ---------------------------------------------------------------- streaming
@query("stream_action_dedupe")
def q_stream_action_dedupe(spark, d):
    """Structured Streaming ingestion of ``events`` (one distinct action per
    user/item/day, late reports included)."""
    from reelcast.streaming.ingest import ingest_actions
    return ingest_actions(spark, d)


@query("textrank_edges")
def q_textrank_edges(spark, d):
    """Co-occurrence edge table of every document (window 10, both directions)."""
    return TO.textrank_edges(S.documents(spark, d), "summary")


@query("dedupe_keep_max")
def q_dedupe_keep_max(spark, d):
    return R.dedupe_keep_max(S.profile_chain(spark, d)["cands_by_user"])


@query("topic_weights_direct")
def q_topic_weights_direct(spark, d):
    """Incremental form: topic words joined with their idf x textrank weight."""
    c = S.text_chain(spark, d)
    return P.topic_weights_direct(c["top_idf_tr"], c["topics"], S.STAMP)


# ---------------------------------------------------------------- incremental runs
LATE_CHANNELS, LATE_MOD = ("STANDARD", "MEDIUM"), 10


def _first_day(rows):
    """The table as it is before the late items of some channels arrive."""
    late = (F.col("movie_id") % LATE_MOD == 0) & F.coalesce(F.col("cate_id").isin(*LATE_CHANNELS), F.lit(False))
    return rows.where(~late)


def _two_runs(spark, d, name, rows, update):
    """(tables, second run): a run before and one after the late items arrive."""
    from reelcast.plans import incremental as INC
    out = _place(spark, name)
    update(_first_day(rows), out)
    return INC.ChannelTables(spark, out), update(rows, out)


@query("change_marker")
def q_change_marker(spark, d):
    """Keys that the second run finds changed, by channel."""
    from reelcast.plans import incremental as INC
    rows = S.documents(spark, d)
    return INC.change_marker(INC.digests(_first_day(rows)), INC.digests(rows))


@query("incremental_items")
def q_incremental_items(spark, d):
    """Topic weights (idf by channel) after the table grew in some channels, and the run that wrote each row."""
    from reelcast.plans import incremental as INC
    tables, _ = _two_runs(spark, d, "items", S.documents(spark, d), lambda rows, out: INC.update_items(spark, rows, out))
    return tables.current(INC.item_stages(S.STAMP)[-1])


@query("incremental_recall")
def q_incremental_recall(spark, d):
    """Item recall after vectors of some channels arrived, and the run that wrote each row."""
    from reelcast.plans import incremental as INC
    rows = S.item_vectors(spark, d).select("movie_id", "cate_id", "vec")
    tables, _ = _two_runs(spark, d, "recall", rows, lambda v, out: INC.update_recall(spark, d, v, out))
    return tables.current(INC.recall_stages(spark, d, S.STAMP)[-1])


# ---------------------------------------------------------------- clusters
@query("cluster_neighbours")
def q_cluster_neighbours(spark, d):
    """Channel-wise exact neighbours that score only the clusters which can hold one."""
    from reelcast.operators import clusters as CL
    v = S.item_vectors(spark, d).select("cate_id", "movie_id", "vec")
    return CL.nearest_by_clusters(v, ["cate_id"], C.NEIGHBOURS_K, max_size=256)


@query("clustering_cost")
def q_clustering_cost(spark, d):
    """Clusters, largest cluster and cost of each channel's own item vectors."""
    from reelcast.operators import clusters as CL
    return CL.clustering_cost(S.vector_chain(spark, d)["clusters"], ["cate_id"])


@query("vector_recall")
def q_vector_recall(spark, d):
    """Item recall from the item vectors of this library instead of given embeddings."""
    return S.vector_chain(spark, d)["final"]


# ---------------------------------------------------------------- product quantisation
@query("pq_neighbours")
def q_pq_neighbours(spark, d):
    from reelcast.operators import pq
    return pq.pq_neighbours(S.item_vectors(spark, d), k=10)


@query("ann_recall")
def q_ann_recall(spark, d):
    """Quantised neighbours of all items against the exact ones: whether nine in ten are found, and the code's size."""
    from reelcast.operators import pq
    from reelcast.operators import vectors as V
    v = S.item_vectors(spark, d).select("movie_id", "vec")
    near = pq.pq_neighbours(v, k=10).select("movie_id", "movie_id2", F.lit(True).alias("hit"))
    both = V.block_topk(v, v, [], 10, "cosine").join(near, ["movie_id", "movie_id2"], "left")
    return both.agg(F.lit(10).alias("k"), F.lit(pq.PARTS).alias("bytes_per_vector"),
                    F.countDistinct("movie_id").alias("items"),
                    (F.count("hit") / F.count(F.lit(1)) >= 0.9).alias("recall_reached"))


# ---------------------------------------------------------------- day buckets
def _buckets_day_by_day(spark, d):
    """Buckets of the whole log: the first weeks at once, the last week day by day, the last day twice."""
    from reelcast.plans import daily as DY
    path, log, week = _place(spark, "days"), S.action_log(spark, d), DY.recent_start(S.AS_OF)
    DY.append_days(spark, log.where(F.col("datetime") <= week), path)
    for day in [*range(week + 86400, X.as_epoch(S.AS_OF) + 1, 86400), X.as_epoch(S.AS_OF) - 86400]:
        DY.append_days(spark, log.where(F.col("datetime") == day), path)
    return DY.read_buckets(spark, path)


@query("daily_action_weight")
def q_daily_action_weight(spark, d):
    """User-item weights from day buckets that were appended day by day."""
    from reelcast.plans import daily as DY
    totals, lengths = S.source_stats(spark, d)
    return DY.daily_action_weight(_buckets_day_by_day(spark, d), lengths, totals, X.as_epoch(S.AS_OF),
                                  S.STAR_CHANNELS.film)


@query("daily_history_play")
def q_daily_history_play(spark, d):
    """Play history from day buckets that were appended day by day."""
    from reelcast.plans import daily as DY
    titles = S.catalog(spark, d).select(F.col("id").alias("movie_id"), "title", "year")
    return DY.daily_history(_buckets_day_by_day(spark, d), S.source_stats(spark, d)[0], "play", titles,
                            S.STAR_CHANNELS.film)


@query("word_embeddings")
def q_word_embeddings(spark, d):
    """Word vectors from the co-occurrence table of all documents."""
    from reelcast.operators import embeddings as EM
    return EM.word_embeddings(EM.cooccurrence(S.documents(spark, d)), dim=C.VECTOR_DIM)


@query("within_distance")
def q_within_distance(spark, d):
    """The ten nearest items of every item within a distance of 1.15, by multi-probe hashing that misses none."""
    from reelcast.operators import vectors as V
    return V.within_distance(S.item_vectors(spark, d), 1.15, k=10)
