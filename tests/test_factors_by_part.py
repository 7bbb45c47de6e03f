"""Keyword factors where the documents are: the same rows as the two tables joined, few rows moved."""

import os

import numpy as np
from pyspark.sql import functions as F

from reelcast.operators import profiles as P
from reelcast.operators import text as TO
from reelcast.session import stage_table

DOC = "movie_id long, cate_id string, summary string"
TEXTS = [(1, "a", "red ring red 12 of the 漢字漢字 ring blue 5 5"), (2, None, "of"), (3, "b", "x"), (4, "b", None), (5, "b", ""),
         (1, "a", "red ring green"), (1, "b", "red blue blue ring"), (6, None, "漢字 漢 12a éa été blue red"), (7, "c", "漢字漢"),
         (None, "c", "red ring blue"), (8, "d", "red ring red ring"), (8, "d", "red ring red ring")]


def _both(docs, size=10_000, keep=None, parts=5):
    terms = stage_table(TO.text_terms(docs))
    idf = TO.fit_idf(terms, vocabulary=TO.fit_vocabulary(terms, size=size))
    there = TO.document_factors(docs.withColumn("part", TO.part_of("movie_id", parts)), TO.part_words(terms, idf, parts), keep=keep)
    return there, TO.textrank_documents(docs), TO.explode_tfidf(terms, idf)


def test_factors_are_those_of_the_joined_tables(spark):
    docs = spark.createDataFrame(TEXTS, DOC).repartition(3)
    for size in (10_000, 4):                                # a bounded vocabulary leaves words out after they are ranked
        there, tr, tfidf = _both(docs, size)
        for weight in (P.idf_textrank, P.tfidf_textrank):
            got, want = (sorted(map(str, x.collect())) for x in (weight(there), weight(tr, tfidf)))
            assert got == want and got
    none = docs.limit(0)
    assert _both(none)[0].count() == 0


def test_kept_rows_hold_both_top_lists(spark):
    rng = np.random.default_rng(2)
    words = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}word" for i in range(90)]
    rows = [(i, "c", " ".join(rng.choice(words, 200))) for i in range(12)]
    docs = spark.createDataFrame(rows, DOC).repartition(2)
    few, tr, tfidf = _both(docs, keep=5)
    few = stage_table(few)
    for weight in (P.idf_textrank, P.tfidf_textrank):
        got, want = (sorted(map(str, P.topk_keywords(x, 5).collect())) for x in (weight(few), weight(tr, tfidf)))
        assert got == want and len(got) == 60
    assert few.count() < tfidf.count() / 4


def test_no_document_row_is_moved_for_its_idf(spark):
    """Words travel once a part: the join with the idf table has a row for each different word of a part."""
    docs = spark.createDataFrame([(i, "c", "red ring blue green") for i in range(40)], DOC)
    terms = stage_table(TO.text_terms(docs))
    words = TO.part_words(terms, TO.fit_idf(terms), 4)
    assert terms.count() == 160 and words.count() <= 16


def test_a_stage_leaves_no_shuffle_files(spark):
    import time

    def held():
        root = spark.conf.get("spark.local.dir", None) or "/tmp"
        return {f"{a}/{x}" for a, _, n in os.walk(root) if "blockmgr" in a for x in n if x.startswith("shuffle_")}

    before, df = held(), spark.range(1000).repartition(3, "id").withColumn("x", F.rand(1))
    out = stage_table(df)
    until = time.time() + 20
    while held() - before and time.time() < until:
        time.sleep(0.2)
    assert not held() - before and out.count() == 1000
