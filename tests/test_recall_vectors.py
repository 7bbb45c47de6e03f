import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelcast import config as C
from reelcast.operators import recall as R
from reelcast.operators import search as SE
from reelcast.operators import vectors as V
from reelcast.operators.ranking import rank_all
from reelcast.plans import star as S
from conftest import SF001


def test_rank_all_matches_row_number_with_hot_key(spark):
    # user 0 holds a third of all rows
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("user_id"),
                                  F.col("id").alias("movie_id"), ((F.col("id") * 7919) % 101).cast("double").alias("weight"))
    order = [F.desc("weight"), F.asc("movie_id")]
    a = rank_all(df, ["user_id"], order, "r", partitions=7)
    b = df.withColumn("r", F.row_number().over(Window.partitionBy("user_id").orderBy(*order)).cast("bigint"))
    assert a.count() == 3000
    assert a.exceptAll(b).count() == 0


def test_rank_all_keeps_null_groups_and_column_order(spark):
    rows = [(None if i % 3 == 0 else i % 2, i, float(i % 5)) for i in range(60)] + [(None, 99, None)]
    df = spark.createDataFrame(rows, "cid int, aid long, weight double")
    order = [F.desc("weight"), F.asc("aid")]
    got = rank_all(df, ["cid"], order, "r", partitions=5)
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("cid").orderBy(*order)).cast("bigint"))
    assert got.columns == want.columns
    assert got.count() == 61 and got.exceptAll(want).count() == 0
    assert rank_all(df.limit(0), ["cid"], order, "r").count() == 0


def test_merge_same_item(spark):
    c = spark.createDataFrame([("u", "k", 1, "t1", 0.9), ("u", "k", 2, "t1", 0.8), ("u", "k", 1, "t2", 0.5)],
                              "user_id string, cate_id string, movie_id long, topic string, weight double")
    got = {r.movie_id: r.weight for r in R.merge_same_item(c).collect()}
    # ranks: (1,t1)=1, (2,t1)=2, (1,t2)=3; item 1 base 1 -> 0.9 + 0.5/(ln(3)+1)
    assert got[2] == 0.8
    assert abs(got[1] - round(0.9 + round(0.5 / (np.log(3) + 1), 8), 8)) < 1e-12


def test_version_filter_self_collision(spark):
    titles = spark.createDataFrame([(10, "k", "red red ring"), (11, "k", "red bolt"), (12, "k", "blue bolt long")],
                                   "id long, cid string, title string")
    rec = spark.createDataFrame([("u", 10, "k", 1.0), ("u", 11, "k", 0.5), ("u", 12, "k", 0.4)],
                                "user_id string, movie_id long, cate_id string, weight double")
    kept = {r.movie_id for r in R.filter_versions_user(rec, titles, C.Channels("F", "S", "V", "K")).collect()}
    # 'red red ring' keeps only one of its two 'red' rows -> dropped; 'red bolt' wins 'red' and 'bolt'
    assert kept == {11}


def test_anti_history(spark):
    rec = spark.createDataFrame([("u", 1), ("u", 2), ("v", 1)], "user_id string, movie_id long")
    hist = spark.createDataFrame([("u", 1), ("u", 1)], "user_id string, movie_id long")
    assert sorted(tuple(r) for r in R.anti_history(rec, hist).collect()) == [("u", 2), ("v", 1)]


def _brute(vecs, k, metric):
    ids = np.array(list(vecs))
    M = np.stack([vecs[i] for i in ids])
    out = {}
    for qi, q in zip(ids, M):
        if metric == "cosine":
            s = np.round(M @ q / (np.sqrt((M * M).sum(1)) * np.sqrt(q @ q)), 4)
            order = sorted((-s[j], ids[j]) for j in range(len(ids)) if ids[j] != qi)
        else:
            s = np.round(np.maximum((M * M).sum(1) + q @ q - 2 * M @ q, 0), 4)
            order = sorted((s[j], ids[j]) for j in range(len(ids)))
        out[qi] = [x[1] for x in order[:k]]
    return out


def test_block_topk_exact_against_brute_force(spark):
    v = S.item_vectors(spark, SF001).select("label", "movie_id", "vec")
    rows = v.collect()
    for metric in ("cosine", "l2"):
        grp = "label" if metric == "cosine" else None
        q = v if grp else v.drop("label")
        # block_size 7 forces many block pairs per group
        got = V.block_topk(q, q, ["label"] if grp else [], 5, metric, block_size=7,
                           exclude_self=(metric == "cosine"))
        got_map = {}
        for r in got.collect():
            got_map.setdefault(r.movie_id, []).append((r.sort_num, r.movie_id2))
        by_group = {}
        for r in rows:
            by_group.setdefault(r.label if grp else 0, {})[r.movie_id] = np.array(r.vec)
        for g, vecs in by_group.items():
            for qi, exp in _brute(vecs, 5, metric).items():
                assert [m for _, m in sorted(got_map.get(qi, []))] == exp


def test_ann_recall(spark):
    vec = S.item_vectors(spark, SF001)
    exact = V.cosine_in_cluster(vec.withColumn("all", F.lit(0)), "all", 10)
    ann = V.ann_neighbours(vec, k=10, nlist=8, nprobe=C.ANN_PROBES)
    hits = ann.join(exact, ["movie_id", "movie_id2"]).count()
    assert hits / exact.count() >= 0.8


def test_title_search_brute_force(spark):
    q = spark.createDataFrame([(1, "red ring show"), (2, "blue.bolt.film")], "item_id long, text string")
    t = spark.createDataFrame([(10, "red ring"), (11, "blue bolt"), (12, "green gear"), (13, "red bolt film")],
                              "doc_id long, text string")
    res = SE.title_search(SE.tokenize_queries(q, "item_id", "text"), SE.tokenize_targets(t, "doc_id", "text"),
                          required="[a-z]")
    got = {(r.query_id, r.movie_id): (r.num, r.sort) for r in res.collect()}
    assert got == {(1, 10): (2, 1), (1, 13): (1, 2), (2, 11): (2, 1), (2, 13): (2, 2)}


def test_exact_median_distributed_path(spark):
    import statistics
    from reelcast.operators.generic import exact_median
    vals = [float((i * 7919) % 1009) for i in range(2001)]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(5)
    assert df.select(exact_median(df, "x").alias("m")).first().m == statistics.median(vals)
    even = spark.createDataFrame([(v,) for v in vals[:2000]], "x double").repartition(3)
    assert even.select(exact_median(even, "x").alias("m")).first().m == statistics.median(vals[:2000])


def test_word2vec_synonyms_and_item_vectors(spark):
    from reelcast.operators import text as TO
    docs = S.documents(spark, SF001)
    model = V.fit_word2vec(TO.cut_words(docs, "summary"), dim=16, min_count=3)
    wv = V.word_vectors(model)
    word = wv.orderBy("word").first().word
    syn = V.word_synonyms(model, word, 5)
    assert syn.count() == 5 and word not in {r.word for r in syn.collect()}
    tw = spark.createDataFrame([(1, "k", word, 0.5), (1, "k", word, 0.5)], "movie_id long, cate_id string, topic string, weight double")
    iv = V.item_vector(tw, wv).collect()
    assert len(iv) == 1 and len(iv[0].vec) == 16       # duplicates of one weighted vector average to itself


def test_recommend_lookup_routes_keys(spark):
    users = spark.createDataFrame([("AA:BB:CC:DD:01", 7, 2), ("AA:BB:CC:DD:01", 5, 1)],
                                  "user_id string, movie_id long, sort_num long")
    items = spark.createDataFrame([(7, 9, 1), (7, 8, 2)], "movie_id long, movie_id2 long, sort_num long")
    keys = spark.createDataFrame([("AA:BB:CC:DD:01",), ("7",), ("unknown-key-x",)], "key string")
    got = {r.key: r.movie_ids for r in R.recommend_lookup(keys, users, items).collect()}
    assert got == {"AA:BB:CC:DD:01": "5,7", "7": "9,8"}


def test_rules_item_final_title_rules(spark):
    rows = [(1, 1969, "流浪地球", 2, "电影节直击"), (1, 1969, "流浪地球", 3, "【独家】花絮"), (1, 1969, "流浪地球", 4, "《红》"),
            (1, 1969, "流浪地球", 5, "流浪猫咪"), (1, 1969, "流浪地球", 6, "满江红"),
            (10, 1970, "繁花", 11, "好剧合集"), (10, 1970, "繁花", 12, "人世间"),
            (20, 1971, "奔跑吧兄弟", 21, "奔跑吧兄弟第二季"), (20, 1971, "奔跑吧兄弟", 22, "极限挑战")]
    rec = spark.createDataFrame([(a, c, t, b, t2, 1.0) for a, c, t, b, t2 in rows],
                                "movie_id long, cate_id long, title string, movie_id2 long, title2 string, weight double")
    out = {r.movie_id2: r.title3 for r in R.rules_item_final(rec, C.DEFAULT_CHANNELS).collect()}
    # film: deny suffix, 【】 pair, 《 and the same first two characters are dropped; series: 合集; others: same first 4
    assert out == {6: "满江", 12: "人世", 22: "极限挑战"}


def _moved_above_join(df):
    """Whether the plan has an exchange above its first join."""
    lines = df._jdf.queryExecution().sparkPlan().toString().splitlines()
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    assert any("Join" in x for x in lines)
    return any("Exchange" in x for x in plan[:next(i for i, x in enumerate(plan) if "Join" in x)])


def test_rows_expanded_by_user_are_the_same_and_merged_where_they_are(spark, monkeypatch):
    profile = spark.createDataFrame(
        [("u", "k", "a", 0.9), ("u", "k", "b", 0.4), ("v", "k", "a", 0.3), ("v", "m", "b", 0.7), ("v", "k", "a", 0.3),
         (None, "k", "b", 0.2), ("w", None, "a", 0.5), ("x", "k", "none", 0.5)],
        "user_id string, cate_id string, topic string, weight double")
    inverted = spark.createDataFrame(
        [("k", "a", 1, 0.5), ("k", "a", 2, 0.5), ("k", "b", 1, 0.8), ("m", "b", 1, 0.1), ("k", "b", 3, None),
         ("k", "a", 2, 0.5), ("k", "unread", 9, 0.5), (None, "a", 4, 0.5)],
        "cate_id string, topic string, movie_id long, weight double")
    key = lambda rows: sorted(map(str, rows.collect()))
    plain = R.expand_candidates(profile, inverted)
    sent = R.expand_candidates(profile, inverted, by_user=True)
    merged = key(R.merge_same_item(plain))
    assert key(sent) == key(plain) and key(R.merge_same_item(sent)) == merged
    assert not _moved_above_join(R.merge_same_item(sent))
    assert not _moved_above_join(R.dedupe_keep_max(sent))
    monkeypatch.setattr(R, "LIST_ROWS", 0)          # lists that are too long to be sent
    dealt = R.expand_candidates(profile, inverted, by_user=True)
    assert key(dealt) == key(plain) and key(R.merge_same_item(dealt)) == merged
    nothing = R.expand_candidates(profile.limit(0), inverted, by_user=True)
    assert R.merge_same_item(nothing).count() == 0


def test_word_vectors_follow_company_and_not_the_partitions(spark, tmp_path):
    import random
    from reelcast.operators import skipgram
    rng = random.Random(1)
    groups = [[f"{g}{i}" for i in range(40)] for g in "abcd"]
    rows = [(i, [rng.choice(groups[i % 4]) for _ in range(100)] + [None, f"once{i}"]) for i in range(800)]
    df = spark.createDataFrame([*rows, (800, None), (801, [])], "movie_id long, words array<string>")
    fits = [V.fit_word2vec(df.repartition(n), dim=16, min_count=3, partitions=2) for n in (3, 5)]
    vecs = [{r.word: list(r.vec) for r in V.word_vectors(m).collect()} for m in fits]
    assert vecs[0] == vecs[1] and set(vecs[0]) == {w for g in groups for w in g}
    near = [r.word for r in V.word_synonyms(fits[0], "a0", 5).collect()]
    assert len(near) == 5 and "a0" not in near and set(near) < set(groups[0])
    fits[0].write().overwrite().save(str(tmp_path / "m"))
    again = skipgram.WordModel.load(str(tmp_path / "m"))
    assert {r.word: list(r.vec) for r in V.word_vectors(again).collect()} == vecs[0]
    assert V.word_vectors(V.fit_word2vec(df.limit(0), dim=16)).count() == 0


def test_lsh_pairs_are_all_pairs_that_share_a_bucket(spark):
    """A bucket with more partners than ten keeps them all, once each, ranked by distance."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(60, 4)), 2)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "movie_id long, vec array<double>")
    f = df.withColumn("features", array_to_vector("vec"))
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=2.0, numHashTables=3,
                                        seed=C.SEED).fit(f)
    at = {r.movie_id: [h[0] for h in r.hashes] for r in model.transform(f).collect()}
    want = {(i, j): round(float(np.sqrt(round(float(((x[i] - x[j]) ** 2).sum()), 4))), 4) for i in at for j in at
            if i != j and any(a == b for a, b in zip(at[i], at[j]))}
    assert max(sum(1 for i, _ in want if i == q) for q in at) > 10
    for size in (7, 2048):
        rows = V.lsh_pairs(df, bucket_length=2.0, tables=3, block_size=size).collect()
        assert len(rows) == len(want)
        assert {(r.movie_id, r.movie_id2): r.distance for r in rows} == pytest.approx(want, abs=1.1e-4)
        for q in at:
            mine = sorted((r.sort_num, r.distance, r.movie_id2) for r in rows if r.movie_id == q)
            assert [r[0] for r in mine] == list(range(1, len(mine) + 1)) and [r[1:] for r in mine] == sorted(r[1:] for r in mine)
    near = V.lsh_pairs(df, bucket_length=2.0, tables=3, threshold=1.0).collect()
    assert near and all(r.distance <= 1.0 for r in near)
