"""Day buckets: a week appended day by day equals a full recomputation; old days are neither read raw nor rewritten."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from reelcast.functions import columns as X
from reelcast.operators import actions as A
from reelcast.plans import daily as DY
from reelcast.plans import pipeline as PL
from reelcast.plans import star as S

DAY = 86400
LOG = "user_id long, movie_id long, cate_id string, datetime long, action string, play_time long, movie_num long"


def full_weights(spark, log, as_of):
    totals, lengths = S.source_stats(spark, SF001)
    acts = A.merge_action_log(A.dedupe_action_log(log), totals, film_channel=S.STAR_CHANNELS.film)
    return A.agg_action_weight(A.action_row_weights(acts, lengths, as_of))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def partitions(path):
    """{day: {file: modification time}} of the bucket table."""
    out = {}
    for name in os.listdir(path):
        if name.startswith("datetime="):
            folder = os.path.join(path, name)
            out[int(name.split("=")[1])] = {f: os.stat(os.path.join(folder, f)).st_mtime_ns
                                            for f in os.listdir(folder) if f.endswith(".parquet")}
    return out


def test_a_week_day_by_day_equals_the_full_run(spark, tmp_dir):
    path, log = os.path.join(tmp_dir, "days"), S.action_log(spark, SF001).cache()
    totals, lengths = S.source_stats(spark, SF001)
    last = X.as_epoch(S.AS_OF)
    DY.append_days(spark, log.where(F.col("datetime") <= last - 7 * DAY), path)
    for day in range(last - 6 * DAY, last + 1, DAY):
        before = partitions(path)
        seen = DY.append_days(spark, log.where(F.col("datetime") == day), path)
        assert seen in ([day], [])
        assert {d: f for d, f in partitions(path).items() if d != day} == {d: f for d, f in before.items() if d != day}
        if day in (last - 3 * DAY, last):                   # weights of any day come from the same buckets
            buckets = DY.read_buckets(spark, path)
            got = DY.daily_action_weight(buckets, lengths, totals, day, S.STAR_CHANNELS.film)
            assert rows(got) == rows(full_weights(spark, log.where(F.col("datetime") <= day), day))
    assert rows(DY.bucket_actions(DY.read_buckets(spark, path), totals, S.STAR_CHANNELS.film).select(*A.ACTION_COLS)) == rows(
        A.merge_action_log(A.dedupe_action_log(log), totals, film_channel=S.STAR_CHANNELS.film).select(*A.ACTION_COLS))


def test_late_and_repeated_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "days")
    day = 1_700_006_400

    def log(data):
        return spark.createDataFrame(data, LOG)

    first = [(1, 10, "a", day, "click", None, 1), (1, 10, "a", day, "play", 600_000, 1), (1, 10, "a", day, "play", 60, 2),
             (2, 10, "a", day + DAY, "top", None, 1)]
    late = [(1, 10, "a", day, "play", 900_000, 1), (1, 10, "a", day, "top", None, 1), (1, 10, "a", day, "click", None, 1),
            (3, 11, None, day, "play", 1, 7)]
    DY.append_days(spark, log(first), path)
    once = rows(DY.read_buckets(spark, path))
    assert DY.append_days(spark, log(first + first), path) == [day, day + DAY]
    assert rows(DY.read_buckets(spark, path)) == once
    untouched = partitions(path)[day + DAY]
    assert DY.append_days(spark, log(late), path) == [day]
    assert partitions(path)[day + DAY] == untouched
    got = {(r.user_id, r.movie_id): (r.click, r.top, [tuple(p) for p in r.plays]) for r in DY.read_buckets(spark, path).collect()}
    assert got == {(1, 10): (True, True, [(1, 900_000), (2, 60)]), (2, 10): (False, True, []), (3, 11): (False, False, [(7, 1)])}
    assert DY.append_days(spark, log([]), path) == []


def test_recent_window_opens_recent_days_only(spark, tmp_dir):
    path = os.path.join(tmp_dir, "days")
    DY.append_days(spark, S.action_log(spark, SF001), path)
    since = DY.recent_start(S.AS_OF)
    recent = DY.read_buckets(spark, path, since)
    assert {r.d for r in recent.select(F.col("datetime").alias("d")).distinct().collect()} == {
        d for d in partitions(path) if d > since}
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "datetime" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_incremental_pipelines(spark, tmp_dir):
    """User and history pipelines over appended logs equal the full ones; gated pipelines stop when nothing changed."""
    inc, full = os.path.join(tmp_dir, "inc"), os.path.join(tmp_dir, "full")
    log, cut = S.action_log(spark, SF001), X.as_epoch(S.AS_OF) - 3 * DAY
    PL.pipeline_history(spark, SF001, inc, full=False, log=log.where(F.col("datetime") <= cut))
    PL.pipeline_history(spark, SF001, inc, full=False, log=log.where(F.col("datetime") > cut))
    PL.pipeline_history(spark, SF001, full)
    for name in ("merge_action", "user_history_play", "user_history_click", "action_stat"):
        a, b = (spark.read.parquet(os.path.join(o, name)) for o in (inc, full))
        assert rows(a.select(*b.columns)) == rows(b) and b.count()
    PL.pipeline_user(spark, SF001, inc, full=False, log=log.limit(0))
    start = DY.recent_start(S.AS_OF)
    got = spark.read.parquet(os.path.join(inc, "action_weight"))
    assert rows(got) == rows(full_weights(spark, log.where(F.col("datetime") > start), X.as_epoch(S.AS_OF))) and got.count()
    first = PL.pipeline_item(spark, SF001, inc, full=False)
    assert first["run"] == 1 and first["marked"]
    assert PL.pipeline_item(spark, SF001, inc, full=False) == {"run": 1, "marked": []}
    assert PL.pipeline_recall(spark, SF001, inc, full=False)["run"] == 1
    assert PL.pipeline_recall(spark, SF001, inc, full=False)["marked"] == []


def test_model_is_reused_between_refits(spark, tmp_dir):
    counts = PL.pipeline_vectors(spark, SF001, tmp_dir, refit=True)
    stamp = os.stat(os.path.join(tmp_dir, "word2vec_model", "metadata")).st_mtime_ns
    before = rows(spark.read.parquet(os.path.join(tmp_dir, "item_vector")))
    assert PL.pipeline_vectors(spark, SF001, tmp_dir, refit=False) == counts and counts["item_cluster"] > 0
    assert os.stat(os.path.join(tmp_dir, "word2vec_model", "metadata")).st_mtime_ns == stamp
    after = rows(spark.read.parquet(os.path.join(tmp_dir, "item_vector")))
    assert [(r[0], r[2]) for r in after] == [(r[0], r[2]) for r in before]
    for a, b in zip(before, after):
        assert list(a[1]) == pytest.approx(list(b[1]))
