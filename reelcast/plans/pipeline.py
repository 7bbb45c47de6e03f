"""Daily job drivers: each stage writes its tables (with a row-count audit),
so later stages and the serving side read persisted results.

``full`` recomputes everything; the incremental forms keep state under
``out``: day buckets for user actions, marked channels for items and recall.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from reelcast import config as C
from reelcast.functions import columns as X
from reelcast.operators import actions as A
from reelcast.operators import clusters as CL
from reelcast.operators import factors as FA
from reelcast.operators import text as TO
from reelcast.operators import vectors as V
from reelcast.operators.skipgram import WordModel
from reelcast.plans import daily as DY
from reelcast.plans import incremental as INC
from reelcast.plans import star as S
from reelcast.sources import sinks as SK


def _save(df, out, name, stamp=S.STAMP):
    return SK.row_count_audit(df, name, os.path.join(out, name), os.path.join(out, "_audit"), stamp)


def factor_refresh(spark, d, out) -> dict:
    fx = S.factor_tables(spark, d)
    src = S.asset_source(spark, d)
    counts = {
        "movie_hot_factor": _save(fx["hot"], out, "movie_hot_factor"),
        "movie_score_factor": _save(FA.rank_in_channel(fx["score"], "factor"), out, "movie_score_factor"),
        "movie_year_factor": _save(fx["year"], out, "movie_year_factor"),
        "movie_year_factor_variety": _save(fx["year_variety"], out, "movie_year_factor_variety"),
        "movie_time": _save(S.item_lengths(spark, d), out, "movie_time"),
        "movie_auth": _save(FA.trailer_ids(src), out, "movie_auth"),
        "movie_total_num": _save(S.episode_totals(spark, d), out, "movie_total_num"),
    }
    return counts


def _buckets(spark, d, out, log):
    """Day buckets under ``out`` after ``log`` (the whole action log by default) was appended."""
    path = os.path.join(out, "action_days")
    DY.append_days(spark, S.action_log(spark, d) if log is None else log, path)
    return DY.read_buckets(spark, path)


def pipeline_history(spark, d, out, full: bool = True, log=None) -> dict:
    """Histories per action kind and the action statistics; the incremental form appends ``log`` to the day buckets
    and reads nothing else of the raw log."""
    titles = S.catalog(spark, d).select(F.col("id").alias("movie_id"), "title", "year")
    acts = S.merged_actions(spark, d) if full else DY.bucket_actions(
        _buckets(spark, d, out, log), S.source_stats(spark, d)[0], S.STAR_CHANNELS.film)
    counts = {"merge_action": _save(acts, out, "merge_action")}
    acts = spark.read.parquet(os.path.join(out, "merge_action"))
    for kind in ("click", "top", "play"):
        counts[f"user_history_{kind}"] = _save(A.user_history(acts, kind, titles), out, f"user_history_{kind}")
    counts["action_stat"] = _save(A.agg_action_stat(acts), out, "action_stat")
    return counts


def pipeline_user(spark, d, out, full: bool = True, log=None, as_of=S.AS_OF) -> dict:
    """User-item weights, plain and normalised.  The incremental form appends ``log`` to the day buckets and weights
    the buckets of the recent window as of today: old days' raw logs are not read, other days are not opened."""
    totals, lengths = S.source_stats(spark, d)
    if full:
        w = A.agg_action_weight(A.action_row_weights(S.merged_actions(spark, d), lengths, X.as_epoch(as_of)))
    else:
        recent = _buckets(spark, d, out, log).where(F.col("datetime") > DY.recent_start(as_of))
        w = DY.daily_action_weight(recent, lengths, totals, X.as_epoch(as_of), S.STAR_CHANNELS.film)
    counts = {"action_weight": _save(w, out, "action_weight")}
    w = spark.read.parquet(os.path.join(out, "action_weight"))
    counts["action_weight_normal"] = _save(A.minmax_normalize(w), out, "action_weight_normal")
    return counts


def pipeline_item(spark, d, out, full: bool = True) -> dict:
    """Item profiles.  The incremental form recomputes the channels that the marker names (none: nothing is written)."""
    if not full:
        run = INC.update_items(spark, S.documents(spark, d), os.path.join(out, "item_profile"))
        return {"run": run.number, "marked": run.marked}
    c = S.text_chain(spark, d)
    counts = {}
    for name in ("textrank", "tfidf", "top_idf_tr", "topics"):
        counts[name] = _save(c[name], out, name)
    SK.append_once(c["topic_weights"], os.path.join(out, "topic_weights"), "timestamp")
    counts["topic_weights"] = spark.read.parquet(os.path.join(out, "topic_weights")).count()
    return counts


def pipeline_vectors(spark, d, out, refit: bool) -> dict:
    """Word vectors, item vectors and their clusters; without ``refit`` (a weekly matter) the stored model is used."""
    words = TO.cut_words(S.documents(spark, d), "summary")
    model = SK.fit_or_load(V.word2vec(), WordModel, words, os.path.join(out, "word2vec_model"), refit)
    items = V.item_vector(S.text_chain(spark, d)["topic_weights"], V.word_vectors(model))
    counts = {"item_vector": _save(items, out, "item_vector")}
    items = spark.read.parquet(os.path.join(out, "item_vector"))
    counts["item_cluster"] = _save(CL.split_clusters(items, ["cate_id"], C.MIN_CLUSTER_SIZE), out, "item_cluster")
    return counts


def pipeline_recall(spark, d, out, full: bool = True) -> dict:
    """All recall lists.  The incremental form recomputes the item recall of channels whose vectors changed (none:
    nothing is written); user recall reads the current rows of all channels."""
    if not full:
        vectors = S.item_vectors(spark, d).select("movie_id", "cate_id", "vec")
        run = INC.update_recall(spark, d, vectors, os.path.join(out, "item_recall"))
        return {"run": run.number, "marked": run.marked}
    item = S.item_chain(spark, d)
    sim = S.similar_chain(spark, d)
    prof = S.profile_chain(spark, d)
    counts = {
        "movie_recall": _save(item["final"], out, "movie_recall"),
        "user_similar_expand": _save(sim["expanded"], out, "user_similar_expand"),
        "user_similar_merged": _save(sim["merged"], out, "user_similar_merged"),
        "user_similar_recall": _save(sim["final"], out, "user_similar_recall"),
        "user_profile_recall": _save(prof["final"], out, "user_profile_recall"),
    }
    SK.save_serving_slice(item["final"], ["movie_id", "title", "movie_id2", "title2", "sort_num", "timestamp"],
                          os.path.join(out, "serving_movie_recall"))
    SK.save_keyed_map(item["final"], os.path.join(out, "movie_recall_cells"), "movie_id", "movie_id2", "weight")
    return counts
