"""What is moved between tasks: a step that can share an exchange does, with the rows it had before."""

import os

from reelcast.operators import profiles as P
from reelcast.plans import incremental as INC
from reelcast.plans import star as S

RANKS = "movie_id long, cate_id string, tag string, textrank double"
FACTORS = "movie_id long, cate_id string, keyword string, idf double, tfidf double"


def test_keyword_factors_are_the_join(spark):
    """Repeated rows, an item in two channels, words of one side and null ids: what the join of both tables gives."""
    ranks = spark.createDataFrame([(1, "a", "x", 0.5), (1, "a", "x", 0.25), (1, None, "y", 0.75), (2, "b", "x", 0.1),
                                   (3, "c", "z", 0.2), (None, "a", "x", 0.3)], RANKS)
    tfidf = spark.createDataFrame([(1, "a", "x", 2.0, 4.0), (1, "b", "x", 3.0, 6.0), (1, None, "y", 1.0, 1.0),
                                   (2, "b", "w", 5.0, 5.0), (None, "a", "x", 9.0, 9.0), (3, "c", "z", 0.5, None)], FACTORS)
    factors = P.keyword_factors(ranks, tfidf)
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert len(rows(factors)) == 6
    assert rows(P.idf_textrank(factors)) == rows(P.idf_textrank(ranks, tfidf))
    assert rows(P.tfidf_textrank(factors)) == rows(P.tfidf_textrank(ranks, tfidf))


def test_both_weights_of_a_channel_read_one_exchange(spark):
    """The words of all texts are dealt out by item once, whichever weight and list they are ranked for."""
    ranks = spark.createDataFrame([(i % 50, "a", f"w{i}", i / 900) for i in range(900)], RANKS)
    terms = spark.createDataFrame([(i % 50, "a", f"w{i}", 1 + i % 3) for i in range(900)],
                                  "movie_id long, cate_id string, keyword string, tf long")
    out = INC.channel_topic_weights(ranks, terms, S.STAMP)
    assert out.count() > 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    by_word = "Exchange hashpartitioning(movie_id#"
    dealt = [line for line in plan.splitlines() if by_word in line and "keyword#" in line.split("hashpartitioning(")[1].split("]")[0]]
    assert len(dealt) <= 4                      # the two small joins of top lists; no join of all words by (item, word)


def test_a_run_reads_the_source_for_its_digests_once(spark, tmp_dir, monkeypatch):
    asked = []
    monkeypatch.setattr(INC, "digests", lambda rows, f=INC.digests: asked.append(1) or f(rows))
    docs = spark.createDataFrame([(i, "ab"[i % 2], f"t{i}", f"river mountain harbour lantern number{i}") for i in range(8)],
                                 "movie_id long, cate_id string, title string, summary string")
    assert INC.update_items(spark, docs, os.path.join(tmp_dir, "once")).number == 1
    assert len(asked) == 1


def test_an_item_is_sent_once_to_a_block_of_clusters(spark, monkeypatch):
    """Random directions, where no cluster can be ruled out: a vector goes to each block, not to each cluster."""
    import numpy as np

    from reelcast.operators import clusters as CL
    from reelcast.operators import vectors as V
    rng, sent = np.random.default_rng(3), []
    frame = spark.createDataFrame([("a", i, rng.normal(size=24).tolist()) for i in range(300)],
                                  "cate_id string, movie_id long, vec array<double>")
    want = {(r.movie_id, r.movie_id2, r.cos_sim) for r in V.block_topk(
        frame, frame, ["cate_id"], 5).withColumnRenamed("score", "cos_sim").collect()}
    topk = V.block_topk
    monkeypatch.setattr(V, "block_topk", lambda q, *a, **b: sent.append(q) or topk(q, *a, **b))
    visits = []
    got = CL.nearest_by_clusters(frame, ["cate_id"], 5, 16, visits=visits)
    assert {(r.movie_id, r.movie_id2, r.cos_sim) for r in got.collect()} == want
    assert visits[0].count() > 300 * 10 and sent[-1].count() == 300


WEIGHTS = "user_id string, movie_id long, cate_id string, weight double"
TOPICS = "movie_id long, cate_id string, topic string, weight double"


def test_topics_join_where_a_users_actions_lie(spark, monkeypatch):
    """One item with most actions, null keys and repeated rows: the join's rows, and none is moved to be grouped by user."""
    actions = [(f"u{i % 40}", 1, "a", i / 80) for i in range(60)] + [
        ("u1", 2, "b", 0.5), (None, 2, "b", 0.25), ("u2", None, "a", 0.5), ("u3", 3, None, 0.5), ("u4", 9, "a", 1.0)]
    topics = [(1, "a", "x", 0.5), (1, "c", "x", 0.5), (1, "a", "y", None), (2, "b", None, 0.75), (3, "a", "x", 1.0),
              (None, "a", "x", 1.0), (8, "a", "z", 1.0)]
    want = sorted(((m, u, c, t, w * v if v is not None else None) for u, m, c, w in actions for n, _, t, v in topics
                   if m is not None and m == n), key=str)
    frames = spark.createDataFrame(actions, WEIGHTS), spark.createDataFrame(topics, TOPICS)
    joined = P.join_user_topics(*frames)
    assert sorted(map(tuple, joined.collect()), key=str) == want and len(want) == 183
    plan = joined.groupBy("user_id", "cate_id", "topic").count()._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "Join" in line)
    assert not any("Exchange" in line for line in plan[:at])
    monkeypatch.setattr(P, "TOPIC_ROWS", 0)         # too many to be sent
    assert sorted(map(tuple, P.join_user_topics(*frames).collect()), key=str) == want


def test_profiles_are_ranked_where_they_were_summed(spark, monkeypatch):
    """Null users, channels and topics count and drop out as in the joins of the counts; the weights are summed once."""
    from math import log
    rows = [(f"u{i % 6}", "ab"[i % 2], f"t{i % 5}", i / 60) for i in range(60)] + [
        (None, "a", "t1", 0.5), ("u1", None, "t1", 0.5), ("u0", "a", None, 2.0), ("u9", "a", None, 1.0), ("u9", "c", "t9", 0.0)]
    summed, own = {}, {}
    for u, c, t, w in rows:
        summed[u, c, t] = summed.get((u, c, t), 0) + w
        own[u, c] = own.get((u, c), 0) + w
    users = {c: len({u for u, d, _ in summed if d == c and u}) for _, c, _ in summed}
    holds = {(c, t): sum(1 for u, d, s in summed if u and (d, s) == (c, t)) for _, c, t in summed}
    want = {(u, c, t): round(w / (own[u, c] + 1) * (log((users[c] + 1) / (holds[c, t] + 1)) + 1), 8)
            for (u, c, t), w in summed.items() if u and c and t}
    frame = spark.createDataFrame(rows, "user_id string, cate_id string, topic string, weight double")
    staged = []
    monkeypatch.setattr(P, "stage_table", lambda df, f=P.stage_table: staged.append(df.columns) or f(df))
    for most in (P.TOPIC_ROWS, 0):
        monkeypatch.setattr(P, "TOPIC_ROWS", most)
        got = P.user_topic_profile(frame, None).collect()
        assert len(got) == len(want) and all(abs(r.weight - want[r.user_id, r.cate_id, r.topic]) < 2e-8 for r in got)
        top = P.user_topic_profile(frame, 2).collect()
        assert all(r.row_number <= 2 for r in top) and len(top) == sum(min(2, sum(1 for v in want if v[:2] == g)) for g in {v[:2] for v in want})
    assert staged.count(["user_id", "cate_id", "topic", "weight", "user_weight"]) == 4


def test_ranked_words_stay_in_arrow(spark, monkeypatch):
    """Word codes number as words do, null texts and repeated keys included, and a batch's result leaves in parts."""
    import numpy as np
    import pyarrow as pa

    from reelcast.operators import text as TO
    texts = [["b", None, "a", "b", "c", None, "a"], [], None, [None, None], ["a"], ["c", "d", "c", "e", "d", "b"]]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4, 5, 1]), pa.array(["k", None, "k", "k", "k", "k"]),
                                        pa.array(texts, pa.list_(pa.string()))], ["movie_id", "cate_id", "_k"])
    flat = batch.column("_k").values.dictionary_encode()
    codes, words = flat.indices.fill_null(-1).to_numpy(zero_copy_only=False), flat.dictionary.to_pylist()
    for at, toks in ((0, texts[0]), (7, texts[3]), (9, texts[4]), (10, texts[5])):
        ids, named = TO._numbered(toks)
        got, first = TO._numbered_codes(codes[at:at + len(toks)], np.empty(len(words), np.int64))
        assert got.tolist() == ids.tolist() and [words[c] for c in first] == list(named)
    run = TO._textrank_docs(3, 0.85, 10, ["movie_id", "cate_id"])
    whole = list(run(iter([batch.slice(0), batch.slice(1)])))
    monkeypatch.setattr(TO, "EDGE_ROWS", 1)
    parts = list(run(iter([batch.slice(0), batch.slice(1)])))
    assert [b.num_rows for b in parts] == [3, 4, 4] and [b.num_rows for b in whole] == [7, 4]
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches(whole).combine_chunks())
    assert whole[0].column("movie_id").to_pylist() == [1] * 7 and whole[0].column("tag").to_pylist()[3:] == ["c", "d", "e", "b"]
    docs = spark.createDataFrame([(1, "a", "river stone water river bridge water"), (2, None, "lamp oil lamp light oil"),
                                  (3, "b", None), (None, "b", "night light night bell")],
                                 "movie_id long, cate_id string, summary string")
    key = lambda df: sorted(map(str, df.collect()))
    assert key(TO.textrank_documents(docs)) == key(TO.textrank_keywords(TO.textrank_edges(docs)))
