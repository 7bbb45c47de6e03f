import math

from pyspark.sql import functions as F

from reelcast import config as C
from reelcast.functions import text as TX
from reelcast.operators import factors as FA
from reelcast.operators import text as TO
from reelcast.plans import star as S
from conftest import SF001


def test_score_factor(spark):
    cat = spark.createDataFrame([(1, "a", 1, 0.0), (2, "b", 1, None), (3, "c", 1, 7.0), (4, "d", 1, 6.99),
                                 (5, "e", 1, 10.0), (6, "f", 1, 8.0)], "id long, title string, cid long, score double")
    got = {r.aid: r.factor for r in FA.score_factor(cat).collect()}
    mean = (7.0 + 6.99 + 10.0 + 8.0) / 4
    assert got[1] == got[2] == round(1 / (math.log(10 - mean + 1) + 1), 4)
    assert got[3] == round(1 / (math.log(4) + 1), 4)
    assert got[4] == round(1 / 2 ** (10 - 6.99 - 1), 4)
    assert got[5] == 1.0


def test_year_factor(spark):
    cat = spark.createDataFrame([(1, "2024", 1969), (2, "0", 1969), (3, "abc", 1969), (4, "2030", 1969),
                                 (5, None, 1969), (6, "2014", 1971)], "id long, year string, cid long")
    got = {r.movie_id: r.factor for r in FA.year_factor(cat, 2024).collect()}
    assert got[1] == 1.0
    assert got[2] == got[3] == got[4] == got[5] == round(1 / 2 ** 0.5, 4)
    assert got[6] == round(1 / (math.log2(11) + 1), 4)


def test_movie_length_and_short(spark):
    src = spark.createDataFrame(
        [(1, '{"len": 3600}', 12, 1), (1, '{"len": 600}', 12, 1), (2, "bad", 12, 1), (3, '{"len": 12000}', 12, 1),
         (4, '{"len": 3540}', 12, 1), (5, '{"len": 3600}', 12, 1)], "aid long, extra string, source int, eptotal int")
    got = {r.movie_id: r.movie_len for r in FA.movie_length(src).collect()}
    assert got == {1: 10, 4: 59, 5: 60}
    short = {r.movie_id2 for r in FA.short_single_episode(src).collect()}
    assert short == {1, 4}   # 59 min single episode is short, 60 is not


def test_hot_factor(spark):
    hot = spark.createDataFrame([(1, "a", 1, 10), (2, "b", 2, 0)], "aid long, title string, cid long, weight long")
    got = {r.aid: r.factor for r in FA.hot_factor(hot).collect()}
    assert got == {1: 1.0, 2: round(1 / (math.log(11) + 1), 8)}


def test_tokenize_words_rules(spark):
    df = spark.createDataFrame([("The Quick brown fox, 42 is ab x 7",), ("ab",), ("中华人民共和国 abc",)], "s string")
    got = [r.w for r in df.select(TX.tokenize_words("s").alias("w")).collect()]
    assert got[0] == ["quick", "brown", "fox", "42", "7"]   # stop words, 2-letter and 1-letter words dropped
    assert got[1] == ["ab"]                                  # a sentence of length <= 2 is its own token
    assert got[2] == ["中华", "华人", "人民", "民共", "共和", "和国", "abc"]


def test_tokenize_chars(spark):
    df = spark.createDataFrame([("Ab 3x",)], "s string")
    assert df.select(TX.tokenize_chars("s").alias("t")).collect()[0].t == ["ab", " ", "3", "x"]


def test_clean_catalog(spark):
    rows = [(1, 1969, "颁奖礼金像奖", "x"), (2, 1969, "【独家】花絮", "x"), (3, 1969, "《好》", "x"),
            (4, 1969, "正常电影名字", None), (5, 1969, "正常名字", "x"), (6, 1970, "TEST剧", "x"),
            (7, 1970, "好剧合集", "x"), (8, 1973, "《少儿》", None)]
    df = spark.createDataFrame(rows, "id long, cid long, title string, actor string")
    kept = sorted(r.id for r in TO.clean_catalog(df, C.DEFAULT_CHANNELS).collect())
    assert kept == [5, 8]


def test_textrank_paths_agree(spark):
    docs = S.documents(spark, SF001).limit(50)
    a = TO.textrank_documents(docs, "summary")
    b = TO.textrank_keywords(TO.textrank_edges(docs, "summary"))
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_idf_formula(spark):
    words = spark.createDataFrame([(1, "c", ["a", "b", "a"]), (2, "c", ["a"])], "movie_id long, cate_id string, words array<string>")
    terms = words.select("movie_id", "cate_id", F.explode("words").alias("keyword")).groupBy(
        "movie_id", "cate_id", "keyword").agg(F.count(F.lit(1)).alias("tf"))
    idf = {r.keyword: r.idf for r in TO.fit_idf(terms).collect()}
    assert math.isclose(idf["a"], math.log(3 / 3)) and math.isclose(idf["b"], math.log(3 / 2))
    tf = {(r.movie_id, r.keyword): (r.tf, r.tfidf) for r in TO.explode_tfidf(terms, TO.fit_idf(terms)).collect()}
    assert tf[(1, "a")] == (2, 0.0) and tf[(1, "b")] == (1, round(math.log(1.5), 4))
