import math

from pyspark.sql import functions as F

from reelcast.functions import columns as X
from reelcast.operators import actions as A

AS_OF = 1706659200  # 2024-01-31


def test_play_tier_boundaries(spark):
    rows = [(6, 100), (7, 100), (30, 100), (60, 100), (29, -10), (30, -10), (59, -10), (60, -10),
            (150, 100), (-10, 100)]
    df = spark.createDataFrame(rows, "p long, l long")
    got = [r.t for r in df.select(X.play_tier("p", "l").alias("t")).collect()]
    # <=6 -> 1; ratio 0.07 -> 2; 0.3 -> 3; 0.6 -> 4; unknown length by minutes; longer than length by minutes
    assert got == [1, 2, 3, 4, 2, 3, 3, 4, 4, 0]


def test_time_decay(spark):
    df = spark.createDataFrame([(AS_OF - 10,), (AS_OF - 86400,), (AS_OF - 3 * 86400 - 5,), (AS_OF + 86400,)], "t long")
    got = [r.d for r in df.select(X.time_decay(AS_OF, "t").alias("d")).collect()]
    assert got[0] == 1.0
    assert math.isclose(got[1], 1 / (math.log(2) + 1))
    assert math.isclose(got[2], 1 / (math.log(4) + 1))
    assert got[3] == 1.0  # future actions clamp at day 0


def test_parse_play_log_defaults_and_drops(spark):
    rows = [("aa", '{"aid": "5", "cid": "1969", "play_duration": "120000", "ep_num": "2"}', 100),
            ("bb", '{"aid": "6", "cid": "1970"}', 100),
            ("", '{"aid": "7", "cid": "1970"}', 100),
            ("cc", '{"aid": "x7", "cid": "1970"}', 100),
            ("dd", "not json", 100)]
    df = spark.createDataFrame(rows, "mac string, funitems string, ymd long")
    out = {r.user_id: r for r in A.parse_play_log(df).collect()}
    assert set(out) == {"aa", "bb"}
    assert (out["aa"].play_time, out["aa"].movie_num) == (120000, 2)
    assert (out["bb"].play_time, out["bb"].movie_num) == (-10, 1)


def test_resolve_episode_total_order(spark):
    play = spark.createDataFrame(
        [("u", 1, 1969, 10, 1, 3), ("u", 2, 1970, 10, 1, 4), ("v", 2, 1970, 10, 1, 2),
         ("u", 3, 1970, 10, 1, 1), ("u", 4, 1970, 10, 1, 1)],
        "user_id string, movie_id long, cate_id long, play_time long, datetime long, movie_num long")
    totals = spark.createDataFrame([(1, 0), (2, 0), (3, 12)], "movie_id long, total_num long")
    got = {(r.user_id, r.movie_id): r.total_num for r in A.resolve_episode_total(play, totals).collect()}
    # film total 0 -> max watched episode (3) overrides the film rule; missing -> 0 -> max watched = 1
    assert got == {("u", 1): 3, ("u", 2): 4, ("v", 2): 4, ("u", 3): 12, ("u", 4): 1}


def test_play_minutes_range_bounds(spark):
    df = spark.createDataFrame([(m * 60000 + 30000,) for m in (1, 2, 199, 200)], "play_time long")
    got = [r.play_time for r in A.play_minutes_range(df).collect()]
    assert got == [2, 199]


def test_weights_on_fixture(spark):
    click = spark.createDataFrame([("u", 1, 7, AS_OF - 86400)], "user_id string, movie_id long, cate_id long, datetime long")
    top = spark.createDataFrame([("u", 1, 7, AS_OF - 86400)], "user_id string, movie_id long, cate_id long, datetime long")
    play = spark.createDataFrame([("u", 1, 7, AS_OF - 10, 1, 2, 45)],
                                 "user_id string, movie_id long, cate_id long, datetime long, movie_num long, "
                                 "total_num long, play_time long")
    lengths = spark.createDataFrame([(1, 100)], "movie_id long, movie_len long")
    acts = A.merge_actions(click, top, play)
    assert acts.count() == 3
    w = A.agg_action_weight(A.action_row_weights(acts, lengths, AS_OF)).collect()[0]
    decay1 = 1 / (math.log(2) + 1)
    expect = round(decay1 * 2, 4) + round(decay1 * 4, 4) + round(3 / 2, 4)   # 45/100 -> tier 3, 2 episodes
    assert math.isclose(w.weight, round(expect, 4))


def test_minmax_constant_column(spark):
    df = spark.createDataFrame([("a", 1.5), ("b", 1.5)], "k string, weight double")
    assert [r.weight for r in A.minmax_normalize(df).collect()] == [0.0, 0.0]
    df2 = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 2.0)], "k string, weight double")
    assert sorted(r.weight for r in A.minmax_normalize(df2).collect()) == [0.0, 0.5, 1.0]


def test_action_stat_and_local_date(spark):
    acts = spark.createDataFrame(
        [("u", 1, 7, 1706659199, True, False, -10, -10), ("u", 2, 7, 1706600000, False, False, 30, 1)],
        "user_id string, movie_id long, cate_id long, datetime long, click boolean, top boolean, "
        "play_time long, total_num long")
    r = A.agg_action_stat(acts).collect()[0]
    assert (r.click_count, r.top_count, r.play_count, r.total_count) == (1, 0, 1, 2)
    assert r.click_latest == "2024-01-31"   # 23:59:59 UTC is the next day in UTC+8
    assert r.top_latest == ""


def test_topk_is_window_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("user_id"), F.col("id").alias("movie_id"),
                                 (F.col("id") * 1.0).alias("weight"))
    out = A.topk_per_user(df, 5)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 15
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan
