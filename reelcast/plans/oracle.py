"""Independent DuckDB SQL for every registered query (same column names).

Written against the raw star tables (views ``part``, ``events``, ...), without
any of the library's code.  Shared CTEs are plain strings composed below.
"""

from __future__ import annotations

AS_OF_EPOCH = 1706659200          # 2024-01-31 00:00:00 UTC
LINE_AS_OF_EPOCH = 1004918400     # 2001-11-05 00:00:00 UTC

CAT = """
cat AS (SELECT p_partkey AS id, p_type AS cid, p_name AS title, p_size / 5.0 AS score,
               CAST(2024 - p_size AS VARCHAR) AS year, p_brand AS cate FROM part)"""

EVENTS = CAT + """,
ev AS (SELECT e.user_id, e.event_type, e.value,
              TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS aid,
              CAST(epoch(date_trunc('day', e.ts)) AS BIGINT) AS ymd
       FROM events e WHERE e.event_type IN ('click', 'view', 'purchase')),
evc AS (SELECT ev.*, cat.cid FROM ev LEFT JOIN cat ON ev.aid = cat.id),
click_log AS (SELECT user_id, aid AS movie_id, cid AS cate_id, ymd AS datetime FROM evc
              WHERE event_type = 'click' AND user_id IS NOT NULL AND aid IS NOT NULL
                AND cid IS NOT NULL AND ymd IS NOT NULL),
top_log AS (SELECT user_id, aid AS movie_id, cid AS cate_id, ymd AS datetime FROM evc
            WHERE event_type = 'purchase' AND user_id IS NOT NULL AND aid IS NOT NULL
              AND cid IS NOT NULL AND ymd IS NOT NULL),
play_log AS (SELECT user_id, aid AS movie_id, cid AS cate_id,
                    CAST(trunc(value * 60000) AS BIGINT) AS play_time, ymd AS datetime,
                    CAST(1 AS BIGINT) AS movie_num
             FROM evc WHERE event_type = 'view' AND user_id IS NOT NULL AND aid IS NOT NULL
               AND cid IS NOT NULL AND ymd IS NOT NULL AND value IS NOT NULL),
totals AS (SELECT l_partkey AS movie_id, CAST(MAX(l_linenumber) AS BIGINT) AS total_num
           FROM lineitem GROUP BY l_partkey),
play_t0 AS (SELECT p.*, COALESCE(t.total_num, 0) AS total_num
            FROM play_log p LEFT JOIN totals t ON p.movie_id = t.movie_id),
play_mx AS (SELECT movie_id, MAX(movie_num) AS max_num FROM play_t0 WHERE total_num = 0 GROUP BY movie_id),
play_f AS (SELECT p.*, m.max_num,
                  CASE WHEN p.cate_id = 'STANDARD' THEN 1 ELSE p.total_num END AS tn1
           FROM play_t0 p LEFT JOIN play_mx m ON p.movie_id = m.movie_id),
play_res AS (SELECT user_id, movie_id, cate_id, play_time, datetime, movie_num,
                    CAST(CASE WHEN max_num IS NOT NULL AND max_num <> 0 THEN max_num
                              WHEN tn1 = 0 THEN 1 ELSE tn1 END AS BIGINT) AS total_num
             FROM play_f),
play_dd AS (SELECT user_id, movie_id, cate_id, datetime, movie_num, total_num, MAX(play_time) AS play_time
            FROM play_res GROUP BY user_id, movie_id, cate_id, datetime, movie_num, total_num),
merge_play AS (SELECT DISTINCT user_id, movie_id, cate_id, datetime, movie_num, total_num,
                      CAST(trunc(play_time / 60000) AS BIGINT) AS play_time
               FROM play_dd WHERE trunc(play_time / 60000) > 1 AND trunc(play_time / 60000) < 200),
merge_click AS (SELECT DISTINCT * FROM click_log),
merge_top AS (SELECT DISTINCT * FROM top_log),
actions AS (
  SELECT * FROM (
    SELECT user_id, movie_id, cate_id, datetime, TRUE AS click, FALSE AS top,
           CAST(-10 AS BIGINT) AS play_time, CAST(-10 AS BIGINT) AS total_num FROM merge_click
    UNION ALL
    SELECT user_id, movie_id, cate_id, datetime, FALSE, TRUE, CAST(-10 AS BIGINT), CAST(-10 AS BIGINT) FROM merge_top
    UNION ALL
    SELECT user_id, movie_id, cate_id, datetime, FALSE, FALSE, play_time, total_num FROM merge_play)
  WHERE datetime > 0),
lengths AS (SELECT * FROM (
              SELECT l_partkey AS movie_id,
                     MIN(CAST(trunc(CAST(trunc(l_quantity * 300) AS BIGINT) / 60) AS BIGINT)) AS movie_len
              FROM lineitem GROUP BY l_partkey) WHERE movie_len < 200)"""


def tier(pt: str, ml: str) -> str:
    return f"""(CASE WHEN {pt} = -10 THEN 0 WHEN {pt} <= 6 THEN 1
         WHEN {pt} <= {ml} THEN (CASE WHEN {pt} / {ml} < 0.3 THEN 2 WHEN {pt} / {ml} < 0.6 THEN 3 ELSE 4 END)
         ELSE (CASE WHEN {pt} < 30 THEN 2 WHEN {pt} < 60 THEN 3 ELSE 4 END) END)"""


def row_weight_sql(actions: str, as_of: int) -> str:
    pt, ml, tn = "a.play_time", "COALESCE(l.movie_len, -10)", "a.total_num"
    score = f"(CASE WHEN {pt} = -10 THEN 0.0 ELSE {tier(pt, ml)} / (CASE WHEN {tn} <> 0 THEN {tn} ELSE 1 END) END)"
    decay = f"(1.0 / (ln(greatest(floor(({as_of} - a.datetime) / 86400), 0) + 1) + 1.0))"
    return f"""SELECT a.user_id, a.movie_id, a.cate_id,
       ROUND({decay} * (CAST(a.click AS INT) * 2 + CAST(a.top AS INT) * 4 + {score}), 4) AS weight
FROM {actions} a LEFT JOIN lengths l ON a.movie_id = l.movie_id"""


WEIGHTS = EVENTS + f""",
row_w AS ({row_weight_sql('actions', AS_OF_EPOCH)}),
weights AS (SELECT user_id, movie_id, ROUND(SUM(weight), 4) AS weight, MAX(cate_id) AS cate_id
            FROM row_w GROUP BY user_id, movie_id)"""


def history_sql(kind: str) -> str:
    cond = "play_time > 0" if kind == "play" else kind
    return "WITH " + EVENTS + f""",
h AS (SELECT user_id, movie_id, MAX(cate_id) AS cate_id, MAX(datetime) AS datetime
      FROM actions WHERE {cond} GROUP BY user_id, movie_id),
ht AS (SELECT h.*, c.title, c.year FROM h LEFT JOIN cat c ON h.movie_id = c.id)
SELECT movie_id, user_id, cate_id, datetime, title, year,
       row_number() OVER (PARTITION BY user_id, cate_id ORDER BY datetime DESC, movie_id) AS sort_time
FROM ht"""


def local_date(c: str) -> str:
    return f"COALESCE(strftime(timezone('Asia/Shanghai', to_timestamp({c})), '%Y-%m-%d'), '')"


SQL: dict[str, str] = {
    "parse_click_log": "WITH " + EVENTS + " SELECT * FROM click_log",
    "parse_play_log": "WITH " + EVENTS + " SELECT * FROM play_log",
    "resolve_episode_total": "WITH " + EVENTS + " SELECT * FROM play_res",
    "play_dedupe_max": "WITH " + EVENTS + " SELECT * FROM play_dd",
    "union_slices_distinct": "WITH " + EVENTS + " SELECT * FROM merge_play",
    "merge_actions": "WITH " + EVENTS + " SELECT * FROM actions",
    "action_row_weight": "WITH " + WEIGHTS + " SELECT * FROM row_w",
    "agg_action_weight": "WITH " + WEIGHTS + " SELECT * FROM weights",
    "minmax_normalize": "WITH " + WEIGHTS + """,
mm AS (SELECT MIN(weight) AS mn, MAX(weight) AS mx FROM weights)
SELECT w.user_id, w.movie_id, w.cate_id,
       ROUND(CASE WHEN mm.mx - mm.mn = 0 THEN 0.0 ELSE (w.weight - mm.mn) / (mm.mx - mm.mn) END, 8) AS weight
FROM weights w CROSS JOIN mm""",
    "user_top_items": "WITH " + WEIGHTS + """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY weight DESC, movie_id) AS sort_num
               FROM weights) WHERE sort_num <= 5""",
    "order_action_weight": "WITH " + CAT + """,
lengths AS (SELECT * FROM (
              SELECT l_partkey AS movie_id,
                     MIN(CAST(trunc(CAST(trunc(l_quantity * 300) AS BIGINT) / 60) AS BIGINT)) AS movie_len
              FROM lineitem GROUP BY l_partkey) WHERE movie_len < 200),
oa AS (SELECT o.o_custkey AS user_id, l.l_partkey AS movie_id, c.cid AS cate_id,
              CAST(epoch(o.o_orderdate) AS BIGINT) AS datetime, FALSE AS click, FALSE AS top,
              CAST(trunc(l.l_quantity) AS BIGINT) AS play_time, CAST(l.l_linenumber AS BIGINT) AS total_num
       FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey LEFT JOIN cat c ON l.l_partkey = c.id),
row_w AS (""" + row_weight_sql("oa", LINE_AS_OF_EPOCH) + """)
SELECT user_id, movie_id, ROUND(SUM(weight), 4) AS weight, MAX(cate_id) AS cate_id
FROM row_w GROUP BY user_id, movie_id""",
    "user_history_click": history_sql("click"),
    "user_history_top": history_sql("top"),
    "user_history_play": history_sql("play"),
    "agg_action_stat": "WITH " + EVENTS + f""",
g AS (SELECT user_id, cate_id,
             CAST(count(*) FILTER (WHERE click) AS BIGINT) AS click_count,
             MAX(CASE WHEN click THEN datetime END) AS cl,
             CAST(count(*) FILTER (WHERE top) AS BIGINT) AS top_count,
             MAX(CASE WHEN top THEN datetime END) AS tl,
             CAST(count(*) FILTER (WHERE play_time > 0) AS BIGINT) AS play_count,
             MAX(CASE WHEN play_time > 0 THEN datetime END) AS pl
      FROM actions GROUP BY user_id, cate_id)
SELECT user_id, cate_id, click_count, {local_date('cl')} AS click_latest,
       top_count, {local_date('tl')} AS top_latest, play_count, {local_date('pl')} AS play_latest,
       click_count + top_count + play_count AS total_count
FROM g""",
    "scan_recent_actions": "WITH " + EVENTS + f"""
SELECT * FROM actions WHERE datetime > {AS_OF_EPOCH - 7 * 86400}""",
    "slice_index": """
SELECT CAST((year(ts) - 2023) * 36 + (month(ts) - 12) * 3
            + floor(((CASE WHEN day(ts) <= 10 THEN 10 WHEN day(ts) <= 20 THEN 20 ELSE 30 END) - 10) / 10) AS INT) AS slice,
       count(*) AS n_events
FROM events GROUP BY 1""",
}


SRC = """
src AS (SELECT l_partkey AS aid, CASE WHEN l_returnflag = 'R' THEN 11 ELSE 12 END AS source,
               l_suppkey AS sid,
               CASE WHEN l_quantity = 50 AND l_discount = 0.1 THEN 1 ELSE 0 END AS auth,
               CAST(l_linenumber AS BIGINT) AS eptotal, 1 AS status,
               CAST(trunc(l_quantity * 300) AS BIGINT) AS len_s FROM lineitem)"""

HOT_BODY = """
plays AS (SELECT l_partkey AS aid, CAST(strftime(l_shipdate, '%Y%m%d') AS INT) AS date,
                 CAST(trunc(l_quantity) AS BIGINT) AS count FROM lineitem),
cnt AS (SELECT aid, SUM(count) AS weight FROM plays WHERE date > 20011006 GROUP BY aid),
hot AS (SELECT c.id AS aid, c.title, c.cid, CAST(COALESCE(n.weight, 0) AS BIGINT) AS weight
        FROM cat c LEFT JOIN cnt n ON c.id = n.aid),
hot_sort AS (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY weight DESC, aid) AS sort_num FROM hot)"""
HOT = CAT + "," + HOT_BODY

SCORE_BODY = """
mean AS (SELECT AVG(score) AS m FROM cat WHERE score > 0),
sc AS (SELECT c.id AS aid, c.title, c.cid, c.score,
              CASE WHEN c.score IS NULL OR c.score = 0 THEN mean.m ELSE c.score END AS s FROM cat c CROSS JOIN mean),
score_f AS (SELECT aid, title, cid, score,
                   ROUND(CASE WHEN s >= 7 THEN 1.0 / (ln(10.0 - s + 1) + 1) ELSE 1.0 / pow(2.0, 10.0 - s - 1) END, 4) AS factor
            FROM sc)"""
SCORE = CAT + "," + SCORE_BODY

SQL.update({
    "agg_hot_count": "WITH " + HOT + " SELECT aid, title, cid, weight FROM hot",
    "rank_hot": "WITH " + HOT + " SELECT * FROM hot_sort",
    "hot_factor": "WITH " + HOT + """
SELECT aid, title, cid, weight AS play_num,
       ROUND(1.0 / (ln((SELECT MAX(weight) FROM hot_sort) - weight + 1) + 1.0), 8) AS factor, sort_num
FROM hot_sort""",
    "score_factor": "WITH " + SCORE + " SELECT * FROM score_f",
    "rank_score": "WITH " + SCORE + """
SELECT *, row_number() OVER (PARTITION BY cid ORDER BY factor DESC, aid) AS sort_num FROM score_f""",
    "year_factor": "WITH " + CAT + """,
y AS (SELECT id, year, TRY_CAST(year AS INT) AS yi, cid FROM cat),
y2 AS (SELECT id, year, cid, CASE WHEN yi IS NULL OR yi <= 0 OR yi > 2024 THEN 2019 ELSE yi END AS yy FROM y)
SELECT id AS movie_id, year,
       ROUND(CASE WHEN COALESCE(cid = 'PROMO', FALSE) THEN 1.0 / (log2(2024 - yy + 1) + 1)
                  ELSE 1.0 / pow(2.0, (2024 - yy) / 10.0) END, 4) AS factor
FROM y2""",
    "movie_length": "WITH " + CAT + """,
lengths AS (SELECT * FROM (
              SELECT l_partkey AS movie_id,
                     MIN(CAST(trunc(CAST(trunc(l_quantity * 300) AS BIGINT) / 60) AS BIGINT)) AS movie_len
              FROM lineitem GROUP BY l_partkey) WHERE movie_len < 200)
SELECT * FROM lengths""",
    "agg_total_num": """
SELECT l_partkey AS movie_id, CAST(MAX(l_linenumber) AS BIGINT) AS total_num FROM lineitem GROUP BY l_partkey""",
    "trailer_ids": "WITH " + SRC + """
SELECT aid, MIN(auth) AS auth FROM src WHERE auth = 1 AND source = 12 GROUP BY aid""",
    "short_single_episode": "WITH " + SRC + """
SELECT aid AS movie_id2, MIN(eptotal) AS eptotal FROM src
WHERE source = 12 AND eptotal = 1 AND len_s / 60 < 60 GROUP BY aid""",
    "hot_watch_ratio": f"""
WITH w AS (SELECT l.l_partkey AS aid, p.p_type AS cid, CAST(p.p_size AS DOUBLE) AS tot, l.l_quantity AS pt,
                  CAST(epoch(l.l_shipdate) AS BIGINT) AS ts
           FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey)
SELECT aid, cid,
       CAST(SUM(CASE WHEN pt > 6 AND ((pt <= tot AND pt / (CASE WHEN tot > 0 THEN tot END) > 0.5)
                                      OR (pt > tot AND pt > 30)) THEN 1 ELSE 0 END) AS BIGINT) AS weight
FROM w WHERE ts > {LINE_AS_OF_EPOCH - 90 * 86400} GROUP BY aid, cid""",
    "match_ids": "WITH " + CAT + "," + SRC + """,
op AS (SELECT l.l_suppkey AS qid, l.l_orderkey AS aid, p.p_type AS cid
       FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey),
ys AS (SELECT ys_id, qid, cid FROM (
         SELECT aid AS ys_id, qid, cid,
                row_number() OVER (PARTITION BY aid ORDER BY qid, cid NULLS LAST) AS rn FROM op) WHERE rn = 1),
os AS (SELECT aid AS os_id, MIN(sid) AS sid FROM src WHERE source = 12 GROUP BY aid),
os2 AS (SELECT os.*, c.title, c.cid AS os_cid FROM os LEFT JOIN cat c ON os.os_id = c.id),
m AS (SELECT os2.os_id, os2.title, os2.os_cid, MIN(ys.ys_id) AS ys_id
      FROM os2 LEFT JOIN ys ON os2.sid = ys.qid AND os2.os_cid = ys.cid
      GROUP BY os2.os_id, os2.title, os2.os_cid)
SELECT * FROM m WHERE os_id IS NOT NULL AND title IS NOT NULL AND os_cid IS NOT NULL AND ys_id IS NOT NULL""",
})


# ---------------------------------------------------------------- text
def _stop_list() -> str:
    from reelcast.functions.text import default_stop_words
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in default_stop_words()) + "]"


HAN = r"regexp_full_match({t}, '\p{{Han}}+')"


def raw_tokens_sql(text: str) -> str:
    han = HAN.format(t="t")
    return (f"flatten(list_transform(regexp_extract_all(lower({text}), '\\p{{Han}}+|[^\\P{{L}}\\p{{Han}}]+|[0-9]+'), "
            f"lambda t: CASE WHEN {han} AND length(t) > 2 "
            f"THEN list_transform(range(1, length(t)), lambda i: substr(t, i, 2)) ELSE [t] END))")


def keep_sql(t: str) -> str:
    han = HAN.format(t=t)
    return (f"((regexp_full_match({t}, '[0-9]+') OR (length({t}) > 2 AND NOT {han}) "
            f"OR (length({t}) = 2 AND {han})) AND NOT list_contains(STOPS, {t}))")


def text_ctes(by_channel: bool = False) -> str:
    stops = _stop_list()
    idf = """
ndocs AS MATERIALIZED (SELECT count(DISTINCT movie_id) AS n FROM terms),
idf AS MATERIALIZED (SELECT keyword, count(DISTINCT movie_id) AS doc_freq,
               ln(((SELECT n FROM ndocs) + 1) / (count(DISTINCT movie_id) + 1)) AS idf
        FROM terms GROUP BY keyword),
tfidf AS MATERIALIZED (SELECT t.movie_id, t.cate_id, t.keyword, t.tf, i.idf, ROUND(t.tf * i.idf, 4) AS tfidf
          FROM terms t JOIN idf i ON t.keyword = i.keyword),""" if not by_channel else """
ndocs AS MATERIALIZED (SELECT cate_id, count(DISTINCT movie_id) AS n FROM terms GROUP BY cate_id),
idf AS MATERIALIZED (SELECT t.cate_id, keyword, ln((n + 1) / (count(DISTINCT movie_id) + 1)) AS idf
        FROM terms t JOIN ndocs d ON t.cate_id IS NOT DISTINCT FROM d.cate_id GROUP BY t.cate_id, keyword, n),
tfidf AS MATERIALIZED (SELECT t.movie_id, t.cate_id, t.keyword, t.tf, i.idf, ROUND(t.tf * i.idf, 4) AS tfidf
          FROM terms t JOIN idf i ON t.keyword = i.keyword AND t.cate_id IS NOT DISTINCT FROM i.cate_id),"""
    raw = raw_tokens_sql("text")
    words = f"CASE WHEN length(text) <= 2 THEN [text] ELSE list_filter({raw}, lambda t: {keep_sql('t')}) END"
    iters = []
    prev = "nodes"
    for i in range(1, 11):
        iters.append(f"""r{i} AS MATERIALIZED (SELECT c.movie_id, c.cate_id, c.a AS n, (1.0 - 0.85) + 0.85 * SUM(c.c * r.ws) AS ws
            FROM coef c JOIN {prev} r ON c.movie_id = r.movie_id AND c.b = r.n GROUP BY c.movie_id, c.cate_id, c.a)""")
        prev = f"r{i}"
    return f"""
docs AS MATERIALIZED (SELECT d.doc_id AS movie_id, p.p_type AS cate_id, p.p_name AS title, d.text
         FROM documents d LEFT JOIN part p ON d.doc_id = p.p_partkey),
words AS MATERIALIZED (SELECT movie_id, cate_id, {words} AS words FROM docs),
terms AS MATERIALIZED (SELECT movie_id, cate_id, keyword, count(*) AS tf
          FROM (SELECT movie_id, cate_id, UNNEST(words) AS keyword FROM words) GROUP BY movie_id, cate_id, keyword),
{idf}
tr_raw AS MATERIALIZED (SELECT movie_id, cate_id, {raw} AS toks FROM docs),
tr_pos AS (SELECT movie_id, cate_id, UNNEST(toks) AS t, generate_subscripts(toks, 1) AS pos FROM tr_raw),
tr_keep AS MATERIALIZED (SELECT * FROM tr_pos WHERE {keep_sql('t')} AND length(t) >= 2),
pairs AS (SELECT a.movie_id, a.cate_id, a.t AS a, b.t AS b
          FROM tr_keep a CROSS JOIN range(1, 10) r(o)
          JOIN tr_keep b ON b.movie_id = a.movie_id AND b.pos = a.pos + r.o),
edges AS MATERIALIZED (SELECT movie_id, cate_id, a, b, CAST(count(*) AS DOUBLE) AS w
          FROM (SELECT movie_id, cate_id, a, b FROM pairs UNION ALL SELECT movie_id, cate_id, b, a FROM pairs)
          GROUP BY movie_id, cate_id, a, b),
outs AS MATERIALIZED (SELECT movie_id, a AS n, SUM(w) AS o FROM edges GROUP BY movie_id, a),
coef AS MATERIALIZED (SELECT e.movie_id, e.cate_id, e.a, e.b, e.w / o.o AS c
         FROM edges e JOIN outs o ON e.movie_id = o.movie_id AND e.b = o.n),
nodes AS MATERIALIZED (SELECT movie_id, cate_id, n, 1.0 / count(*) OVER (PARTITION BY movie_id) AS ws
          FROM (SELECT DISTINCT movie_id, cate_id, a AS n FROM edges)),
{", ".join(iters)},
rng AS (SELECT movie_id, MIN(ws) AS mn, MAX(ws) AS mx FROM r10 GROUP BY movie_id),
textrank AS MATERIALIZED (SELECT r.movie_id, r.cate_id, r.n AS tag,
                    ROUND((r.ws - g.mn / 10.0) / (g.mx - g.mn / 10.0), 6) AS textrank
             FROM r10 r JOIN rng g ON r.movie_id = g.movie_id),
idf_tr AS MATERIALIZED (SELECT t.movie_id, t.cate_id, t.tag AS keyword, ROUND(t.textrank * f.idf, 8) AS weight
           FROM textrank t JOIN tfidf f ON t.movie_id = f.movie_id AND t.tag = f.keyword),
tfidf_tr AS MATERIALIZED (SELECT t.movie_id, t.cate_id, t.tag AS keyword, ROUND((t.textrank + f.tfidf) / 2, 8) AS weight
             FROM textrank t JOIN tfidf f ON t.movie_id = f.movie_id AND t.tag = f.keyword),
top_idf_tr AS MATERIALIZED (SELECT movie_id, cate_id, keyword, weight FROM (
                 SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY weight DESC, keyword) AS r FROM idf_tr)
               WHERE r <= 30),
top_tfidf_tr AS MATERIALIZED (SELECT movie_id, cate_id, keyword, weight FROM (
                   SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY weight DESC, keyword) AS r FROM tfidf_tr)
                 WHERE r <= 30),
topics AS MATERIALIZED (SELECT a.movie_id, a.cate_id, a.keyword AS topic FROM top_idf_tr a
           JOIN top_tfidf_tr b ON a.movie_id = b.movie_id AND a.keyword = b.keyword),
topic_weights AS MATERIALIZED (SELECT a.movie_id, a.cate_id, a.keyword AS topic, a.weight, 20240130 AS timestamp
                  FROM top_idf_tr a JOIN topics t ON a.movie_id = t.movie_id AND a.keyword = t.topic)""".replace(
        "STOPS", stops)


_VOCABULARY = """
SELECT keyword, count(DISTINCT movie_id) AS doc_freq, CAST(SUM(tf) AS BIGINT) AS term_count,
       row_number() OVER (ORDER BY SUM(tf) DESC, keyword) - 1 AS "index" FROM terms GROUP BY keyword"""


def text_sql(body: str, by_channel: bool = False) -> str:
    return "WITH " + text_ctes(by_channel) + "\n" + body


SQL.update({
    "clean_catalog": "WITH " + CAT + """
SELECT * FROM cat c WHERE NOT COALESCE(
    CASE WHEN cid = 'STANDARD' THEN (right(lower(trim(title)), 2) IN ('像奖', '指南', '影节', '斯卡', '直击', '鲜看', '剧集', '音乐', '纪念', '电影', '体验', '看版')
                                     OR substr(lower(trim(title)), 1, 1) || substr(lower(trim(title)), 4, 1) IN ('【】', '第届')
                                     OR contains(lower(trim(title)), '《'))
         WHEN cid = 'MEDIUM' THEN (right(lower(trim(title)), 2) IN ('映礼', '手记', '专访', '看版', '春晚', '老歌', '合集', '编版', '制版', '华版', '战队', '纪实', '回顾', '剧场', '大赏', 'og', '日常', '货版', '演唱', 'p版', '录片', '盛典', '速看', 'mv', '外篇', '视频', '唱会')
                                   OR contains(lower(trim(title)), '《') OR substr(lower(trim(title)), 1, 4) = 'test')
         ELSE FALSE END, FALSE)
  AND (NOT COALESCE(cid IN ('STANDARD', 'MEDIUM'), FALSE)
       OR (id IS NOT NULL AND cid IS NOT NULL AND title IS NOT NULL AND score IS NOT NULL
           AND year IS NOT NULL AND cate IS NOT NULL))""",
    "build_summary": "WITH " + CAT + """
SELECT id, cid, title, concat_ws(',', title, cate, year) AS summary FROM cat""",
    "tokenize_chars": """
SELECT p_partkey AS id, array_to_string(regexp_extract_all(lower(p_name), '([a-z]+|.)', 1), '|') AS tokens FROM part""",
    "normalize_release_name": """
SELECT page_id, regexp_replace(url, '\\.', ' ', 'g') AS name FROM pages""",
    "tokenize_words": text_sql("""
SELECT movie_id, cate_id, CAST(len(words) AS INT) AS n_words, array_to_string(words, ' ') AS words FROM words"""),
    "fit_count_vectorizer": text_sql(f"SELECT * FROM ({_VOCABULARY})"),
    "bounded_vocabulary": text_sql(f"""
SELECT keyword, doc_freq, term_count, row_number() OVER (ORDER BY "index") - 1 AS "index" FROM ({_VOCABULARY})
WHERE doc_freq >= 2 QUALIFY row_number() OVER (ORDER BY "index") <= 1000"""),
    "fit_idf": text_sql(f"""
SELECT keyword, "index", i.doc_freq, ROUND(idf, 8) AS idf FROM idf i JOIN ({_VOCABULARY}) v USING (keyword)"""),
    "explode_tfidf": text_sql(f"""
SELECT movie_id, cate_id, keyword, "index", tf, ROUND(idf, 8) AS idf, tfidf FROM tfidf JOIN ({_VOCABULARY}) v USING (keyword)"""),
    "topk_tfidf": text_sql("""
SELECT * FROM (SELECT movie_id, cate_id, keyword, tfidf,
                      row_number() OVER (PARTITION BY movie_id ORDER BY tfidf DESC, keyword) AS sort_num FROM tfidf)
WHERE sort_num <= 30"""),
    "textrank_keywords": text_sql("SELECT * FROM textrank"),
    "idf_textrank": text_sql("SELECT * FROM idf_tr"),
    "tfidf_textrank": text_sql("SELECT * FROM tfidf_tr"),
    "topk_keyword_weight": text_sql("SELECT * FROM top_idf_tr"),
    "topic_words": text_sql("SELECT * FROM topics"),
    "agg_topic_list": text_sql("""
SELECT movie_id, cate_id, CAST(count(*) AS INT) AS n_topics, array_to_string(list_sort(list(topic)), ' ') AS topics
FROM topics GROUP BY movie_id, cate_id"""),
    "item_profile": text_sql("""
, kw AS (SELECT movie_id, MIN(cate_id) AS cate_id, count(*) AS n_keywords,
               array_to_string(list_sort(list(keyword)), ' ') AS keywords FROM top_idf_tr GROUP BY movie_id),
tl AS (SELECT movie_id, array_to_string(list_sort(list(topic)), ' ') AS topics FROM topics GROUP BY movie_id)
SELECT kw.movie_id, kw.cate_id, CAST(kw.n_keywords AS INT) AS n_keywords, kw.keywords, tl.topics
FROM kw JOIN tl ON kw.movie_id = tl.movie_id"""),
    "topic_weights": text_sql("SELECT * FROM topic_weights"),
    "topic_weights_normal": text_sql("""
, mm AS (SELECT MIN(weight) AS mn, MAX(weight) AS mx FROM topic_weights)
SELECT t.movie_id, t.cate_id, t.topic,
       ROUND(CASE WHEN mm.mx - mm.mn = 0 THEN 0.0 ELSE (t.weight - mm.mn) / (mm.mx - mm.mn) END, 8) AS weight,
       d.title
FROM topic_weights t CROSS JOIN mm LEFT JOIN docs d ON t.cate_id = d.cate_id AND t.movie_id = d.movie_id"""),
})


# ---------------------------------------------------------------- user profile recall
def _deny(vals) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in vals) + ")"


def tokenize_words_sql(text: str) -> str:
    raw = raw_tokens_sql(text)
    return f"(CASE WHEN length({text}) <= 2 THEN [{text}] ELSE list_filter({raw}, lambda t: {keep_sql('t')}) END)"


def title_tokens_sql(title: str) -> str:
    tok = tokenize_words_sql(title)
    return f"(CASE WHEN length({title}) > 2 THEN (CASE WHEN len({tok}) = 0 THEN [{title}] ELSE {tok} END) ELSE [{title}] END)"


def title_deny_sql(title: str, cid: str) -> str:
    from reelcast import config as C
    return (f"COALESCE(({cid} = 'STANDARD' AND {title} IN {_deny(C.TITLE_DENY[C.FILM])}) "
            f"OR ({cid} = 'MEDIUM' AND {title} IN {_deny(C.TITLE_DENY[C.SERIES])}), FALSE)")


YEARF = """
y0 AS (SELECT id, year, TRY_CAST(year AS INT) AS yi, cid FROM cat),
y1 AS (SELECT id, year, cid, CASE WHEN yi IS NULL OR yi <= 0 OR yi > 2024 THEN 2019 ELSE yi END AS yy FROM y0),
yearf AS (SELECT id AS movie_id, year,
                 ROUND(CASE WHEN COALESCE(cid = 'PROMO', FALSE) THEN 1.0 / (log2(2024 - yy + 1) + 1)
                            ELSE 1.0 / pow(2.0, (2024 - yy) / 10.0) END, 4) AS factor FROM y1),
yearv AS (SELECT id AS movie_id, year, ROUND(1.0 / (log2(2024 - yy + 1) + 1), 4) AS factor FROM y1)"""

HOTF = """
hotf AS (SELECT aid, title, cid, weight AS play_num,
                ROUND(1.0 / (ln((SELECT MAX(weight) FROM hot_sort) - weight + 1) + 1.0), 8) AS factor, sort_num
         FROM hot_sort)"""


def profile_ctes() -> str:
    from reelcast import config as C
    return WEIGHTS + "," + text_ctes() + "," + HOT_BODY + "," + HOTF + "," + SCORE_BODY + "," + YEARF + f""",
awn AS (SELECT w.user_id, w.movie_id, w.cate_id,
               ROUND(CASE WHEN mm.mx - mm.mn = 0 THEN 0.0 ELSE (w.weight - mm.mn) / (mm.mx - mm.mn) END, 8) AS weight
        FROM weights w CROSS JOIN (SELECT MIN(weight) AS mn, MAX(weight) AS mx FROM weights) mm),
twn AS (SELECT t.movie_id, t.cate_id, t.topic,
               ROUND(CASE WHEN mm.mx - mm.mn = 0 THEN 0.0 ELSE (t.weight - mm.mn) / (mm.mx - mm.mn) END, 8) AS weight
        FROM topic_weights t CROSS JOIN (SELECT MIN(weight) AS mn, MAX(weight) AS mx FROM topic_weights) mm),
atw AS (SELECT a.movie_id, a.user_id, a.cate_id, t.topic, a.weight * t.weight AS weight
        FROM awn a JOIN twn t ON a.movie_id = t.movie_id),
ut AS (SELECT user_id, cate_id, topic, SUM(weight) AS weight FROM atw GROUP BY user_id, cate_id, topic),
uw AS (SELECT user_id, cate_id, SUM(weight) AS user_weight FROM ut GROUP BY user_id, cate_id),
uc AS (SELECT cate_id, count(DISTINCT user_id) AS user_count FROM ut GROUP BY cate_id),
tc AS (SELECT cate_id, topic, count(user_id) AS topic_count FROM ut GROUP BY cate_id, topic),
uprof_all AS (SELECT ut.user_id, ut.cate_id, ut.topic,
                     ROUND((ut.weight / (uw.user_weight + 1)) * (ln((uc.user_count + 1) / (tc.topic_count + 1)) + 1), 8) AS weight
              FROM ut JOIN uw ON ut.user_id = uw.user_id AND ut.cate_id = uw.cate_id
                      JOIN uc ON ut.cate_id = uc.cate_id
                      JOIN tc ON ut.cate_id = tc.cate_id AND ut.topic = tc.topic),
uprof AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, cate_id ORDER BY weight DESC, topic) AS row_number
                         FROM uprof_all) WHERE row_number <= 30),
inv AS (SELECT t.cate_id, t.topic, t.movie_id, t.weight, c.movie_count
        FROM twn t JOIN (SELECT cate_id, topic, count(*) AS movie_count FROM twn GROUP BY cate_id, topic) c
          ON t.cate_id = c.cate_id AND t.topic = c.topic),
cands AS (SELECT p.user_id, p.cate_id, i.movie_id, p.topic, ROUND(p.weight * i.weight, 8) AS weight
          FROM uprof p JOIN inv i ON p.cate_id = i.cate_id AND p.topic = i.topic),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY weight DESC, movie_id, topic) AS total_sort FROM cands),
based AS (SELECT *, MIN(total_sort) OVER (PARTITION BY user_id, movie_id) AS base_sort FROM ranked),
merged AS (SELECT user_id, cate_id, movie_id,
                  ROUND(SUM(ROUND(CASE WHEN total_sort = base_sort THEN weight
                                       ELSE weight / (ln(total_sort - base_sort + 1) + 1) END, 8)), 8) AS weight
           FROM based GROUP BY user_id, cate_id, movie_id),
pre AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY weight DESC, movie_id) AS sort_num
                       FROM merged) WHERE sort_num <= 1000),
hist AS (SELECT DISTINCT user_id, movie_id FROM actions WHERE click OR play_time > 0),
nohist AS (SELECT p.user_id, p.cate_id, p.movie_id, p.weight FROM pre p
           WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.user_id = p.user_id AND h.movie_id = p.movie_id)),
vt AS (SELECT n.*, c.title FROM nohist n LEFT JOIN cat c ON n.cate_id = c.cid AND n.movie_id = c.id),
vtok AS (SELECT *, length(title) AS title_len, {title_tokens_sql('title')} AS words
         FROM vt WHERE title IS NOT NULL AND NOT {title_deny_sql('title', 'cate_id')}),
vtok2 AS (SELECT *, len(words) AS words_len FROM vtok WHERE title_len < {C.VERSION_TITLE_MAX}),
vex AS (SELECT user_id, movie_id, title_len, UNNEST(words) AS word FROM vtok2),
vwin AS (SELECT user_id, movie_id FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id, word ORDER BY title_len, movie_id) AS r FROM vex) WHERE r = 1),
vcnt AS (SELECT user_id, movie_id, count(*) AS cnt FROM vwin GROUP BY user_id, movie_id),
vers AS (SELECT v.user_id, v.cate_id, v.movie_id, v.weight, v.title
         FROM vtok2 v JOIN vcnt c ON v.user_id = c.user_id AND v.movie_id = c.movie_id WHERE c.cnt = v.words_len),
fac AS (SELECT v.user_id, v.cate_id, v.movie_id, v.title, y.year, h.play_num, s.score,
               ROUND(v.weight * h.factor * s.factor * y.factor, 8) AS weight
        FROM vers v LEFT JOIN hotf h ON v.movie_id = h.aid LEFT JOIN score_f s ON v.movie_id = s.aid
                    LEFT JOIN yearf y ON v.movie_id = y.movie_id),
facr AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY weight DESC, movie_id) AS sort_num
         FROM fac WHERE user_id IS NOT NULL AND cate_id IS NOT NULL AND movie_id IS NOT NULL AND title IS NOT NULL
                    AND year IS NOT NULL AND play_num IS NOT NULL AND score IS NOT NULL AND weight IS NOT NULL),
fin1 AS (SELECT *, substr(lower(title), 1, 2) AS title2 FROM facr
         WHERE sort_num <= {C.USER_FINAL_TOPK}
           AND NOT COALESCE(right(lower(title), 2) IN {_deny(C.USER_SUFFIX_DENY)}
                            OR substr(lower(title), 1, 1) || substr(lower(title), 4, 1) IN {_deny(C.CHAR_PAIR_DENY)}, FALSE)),
fin2 AS (SELECT * EXCLUDE (r, title2, sort_num) FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id, title2 ORDER BY weight DESC, movie_id) AS r FROM fin1)
         WHERE r = 1),
final AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY weight DESC, movie_id) AS sort_num,
                 20240130 AS timestamp FROM fin2)""".replace("STOPS", _stop_list())


def profile_sql(body: str) -> str:
    return "WITH " + profile_ctes() + "\n" + body


SQL.update({
    "join_user_topics": profile_sql("SELECT movie_id, user_id, cate_id, topic, ROUND(weight, 8) AS weight FROM atw"),
    "user_topic_profile": profile_sql("SELECT * FROM uprof"),
    "agg_inverted_index": profile_sql("SELECT * FROM inv"),
    "expand_candidates": profile_sql("SELECT * FROM cands"),
    "merge_same_item": profile_sql("SELECT * FROM merged"),
    "topk_prerecall": profile_sql("SELECT * FROM pre"),
    "anti_history": profile_sql("SELECT * FROM nohist"),
    "filter_versions_user": profile_sql("SELECT * FROM vers"),
    "weight_by_factors_user": profile_sql("SELECT * FROM facr"),
    "profile_recall": profile_sql("SELECT * FROM final"),
    "log_topic_count": profile_sql("""
SELECT cate_id, topic, count(user_id) AS user_count, ROUND(ln(count(user_id) + 1), 8) AS log_count
FROM uprof GROUP BY cate_id, topic"""),
})


# ---------------------------------------------------------------- vectors and item / similar recall
def _cos(a: str, b: str) -> str:
    return (f"ROUND(list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * "
            f"sqrt(list_dot_product({b}, {b}))), 4)")


def item_ctes() -> str:
    from reelcast import config as C
    return profile_ctes() + "," + SRC + f""",
vec AS (SELECT e.vec_id AS movie_id, e.label, CAST(e.embedding AS DOUBLE[]) AS v, c.cid AS cate_id
        FROM embeddings e LEFT JOIN cat c ON e.vec_id = c.id),
npairs AS (SELECT a.movie_id, b.movie_id AS movie_id2, a.cate_id, {_cos('a.v', 'b.v')} AS cos_sim
           FROM vec a JOIN vec b ON a.cate_id = b.cate_id AND a.movie_id <> b.movie_id),
neigh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY cos_sim DESC, movie_id2) AS sort_num
                         FROM npairs) WHERE sort_num <= {C.NEIGHBOURS_K}),
iv0 AS (SELECT n.movie_id, n.movie_id2, n.cos_sim, n.cate_id, c.title FROM neigh n LEFT JOIN cat c ON n.movie_id2 = c.id),
ivt AS (SELECT *, length(title) AS title_len, {title_tokens_sql('title')} AS words
        FROM iv0 WHERE title IS NOT NULL AND NOT {title_deny_sql('title', 'cate_id')}),
ivt2 AS (SELECT *, len(words) AS words_len FROM ivt
         WHERE COALESCE(cate_id IN ('PROMO', 'SMALL'), FALSE) OR title_len < {C.VERSION_TITLE_MAX}),
ivx AS (SELECT movie_id, movie_id2, title_len, UNNEST(words) AS word FROM ivt2),
ivw AS (SELECT movie_id, movie_id2 FROM (
          SELECT *, row_number() OVER (PARTITION BY movie_id, word ORDER BY title_len, movie_id2) AS r FROM ivx) WHERE r = 1),
ivc AS (SELECT movie_id, movie_id2, count(*) AS cnt FROM ivw GROUP BY movie_id, movie_id2),
iversions AS (SELECT v.movie_id, v.movie_id2, v.cos_sim, v.cate_id, v.title
              FROM ivt2 v JOIN ivc c ON v.movie_id = c.movie_id AND v.movie_id2 = c.movie_id2 WHERE c.cnt = v.words_len),
ifac AS (SELECT v.movie_id, v.cate_id, s1.title, s1.year, v.movie_id2, s2.title AS title2, s2.year AS year2,
                sf.score, hf.play_num,
                ROUND(v.cos_sim * sf.factor * hf.factor
                      * (CASE WHEN v.cate_id = 'PROMO' THEN yv.factor ELSE yf.factor END), 8) + 0.0 AS weight
         FROM iversions v LEFT JOIN cat s1 ON v.movie_id = s1.id LEFT JOIN cat s2 ON v.movie_id2 = s2.id
              LEFT JOIN score_f sf ON v.movie_id2 = sf.aid LEFT JOIN hotf hf ON v.movie_id2 = hf.aid
              LEFT JOIN yearf yf ON v.movie_id2 = yf.movie_id LEFT JOIN yearv yv ON v.movie_id2 = yv.movie_id),
ifac2 AS (SELECT * FROM ifac WHERE movie_id IS NOT NULL AND cate_id IS NOT NULL AND title IS NOT NULL
            AND year IS NOT NULL AND movie_id2 IS NOT NULL AND title2 IS NOT NULL AND year2 IS NOT NULL
            AND score IS NOT NULL AND play_num IS NOT NULL AND weight IS NOT NULL),
sshort AS (SELECT DISTINCT aid AS movie_id2 FROM src WHERE source = 12 AND eptotal = 1 AND len_s / 60 < 60),
irules0 AS (SELECT f.*, lower(trim(f.title)) AS t, lower(trim(f.title2)) AS t2, lb.cate AS label, ss.movie_id2 AS short
            FROM ifac2 f LEFT JOIN cat lb ON f.movie_id2 = lb.id LEFT JOIN sshort ss ON f.movie_id2 = ss.movie_id2),
irules AS (SELECT movie_id, cate_id, title, year, movie_id2, title2, year2, score, play_num, weight,
                  CASE WHEN cate_id IN ('STANDARD', 'MEDIUM') THEN substr(t2, 1, 2) ELSE substr(t2, 1, 4) END AS title3
           FROM irules0
           WHERE title IS NOT NULL AND title2 IS NOT NULL AND NOT COALESCE(
             CASE WHEN cate_id = 'STANDARD' THEN (right(t2, 2) IN {_deny(C.FILM_SUFFIX_DENY_RECALL)}
                                                  OR substr(t2, 1, 1) || substr(t2, 4, 1) IN {_deny(C.CHAR_PAIR_DENY)}
                                                  OR contains(t2, '《') OR substr(t, 1, 2) = substr(t2, 1, 2))
                  WHEN cate_id = 'MEDIUM' THEN (right(t2, 2) IN {_deny(C.SERIES_SUFFIX_DENY)}
                                                OR contains(t2, '《') OR substr(t, 1, 2) = substr(t2, 1, 2))
                  WHEN cate_id = 'SMALL' THEN (COALESCE(label, '') = '' OR short IS NOT NULL
                                               OR substr(t, 1, 4) = substr(t2, 1, 4) OR length(t2) > 16)
                  ELSE substr(t, 1, 4) = substr(t2, 1, 4) END, FALSE)),
idd AS (SELECT * EXCLUDE (r, title3) FROM (
          SELECT *, row_number() OVER (PARTITION BY movie_id, title3 ORDER BY weight DESC, movie_id2) AS r FROM irules)
        WHERE r = 1),
ifinal AS (SELECT * FROM (
             SELECT *, 12 AS source, row_number() OVER (PARTITION BY movie_id ORDER BY weight DESC, movie_id2) AS sort_num
             FROM idd WHERE movie_id2 NOT IN (SELECT aid FROM src WHERE auth = 1 AND source = 12)
                        AND movie_id2 IN (SELECT aid FROM src WHERE source = 12 AND status = 1))
           WHERE sort_num <= {C.NEIGHBOURS_K}),
item_final AS (SELECT *, 20240130 AS timestamp FROM ifinal),
sexp0 AS (SELECT a.user_id, r.movie_id, r.title, r.year, r.movie_id2, r.title2, r.year2, r.score, r.play_num,
                 ROUND(a.weight * r.weight, 8) + 0.0 AS weight
          FROM awn a JOIN item_final r ON a.movie_id = r.movie_id),
sexp AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY weight DESC, movie_id2, movie_id) AS total_sort
         FROM sexp0 WHERE user_id IS NOT NULL AND movie_id IS NOT NULL AND title IS NOT NULL AND year IS NOT NULL
           AND movie_id2 IS NOT NULL AND title2 IS NOT NULL AND year2 IS NOT NULL AND score IS NOT NULL
           AND play_num IS NOT NULL AND weight IS NOT NULL),
sw AS (SELECT *, ROUND(CASE WHEN total_sort = base_sort THEN weight
                            ELSE weight / (ln(total_sort - base_sort + 1) + 1) END, 8) + 0.0 AS w2
       FROM (SELECT *, MIN(total_sort) OVER (PARTITION BY user_id, movie_id2) AS base_sort FROM sexp)),
smerged AS (SELECT user_id, movie_id2 AS movie_id, title2 AS title, year2 AS year, score, play_num,
                   ROUND(SUM(w2), 8) + 0.0 AS weight
            FROM sw GROUP BY user_id, movie_id2, title2, year2, score, play_num),
sexpl AS (SELECT user_id, movie_id2 AS movie_id, movie_id AS base_movie, title AS base_title, year AS base_year FROM sw),
sfinal AS (SELECT *, 20240130 AS timestamp FROM (
             SELECT m.*, 12 AS source, row_number() OVER (PARTITION BY user_id ORDER BY weight DESC, movie_id) AS sort_num
             FROM smerged m
             WHERE NOT EXISTS (SELECT 1 FROM hist h WHERE h.user_id = m.user_id AND h.movie_id = m.movie_id)
               AND m.movie_id IN (SELECT aid FROM src WHERE source = 12))
           WHERE sort_num <= {C.USER_FINAL_TOPK})""".replace("STOPS", _stop_list())


def item_sql(body: str) -> str:
    return "WITH " + item_ctes() + "\n" + body


SQL.update({
    "cosine_in_cluster": f"""
WITH vec AS (SELECT vec_id AS movie_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT a.movie_id, b.movie_id AS movie_id2, {_cos('a.v', 'b.v')} AS cos_sim
      FROM vec a JOIN vec b ON a.label = b.label AND a.movie_id <> b.movie_id)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY cos_sim DESC, movie_id2) AS sort_num FROM p)
WHERE sort_num <= 100""",
    "knn_exact_l2": """
WITH vec AS (SELECT vec_id AS movie_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT a.movie_id, b.movie_id AS movie_id2,
             ROUND(greatest(list_dot_product(a.v, a.v) + list_dot_product(b.v, b.v) - 2.0 * list_dot_product(a.v, b.v), 0.0), 4) AS distance
      FROM vec a, vec b WHERE a.movie_id % 100 = 0)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY distance, movie_id2) AS sort_num FROM p)
WHERE sort_num <= 10""",
    "agg_vector_mean": "WITH " + WEIGHTS + """,
wv AS (SELECT DISTINCT w.user_id, list_transform(CAST(e.embedding AS DOUBLE[]), lambda x: x * w.weight) AS v
       FROM weights w JOIN embeddings e ON w.movie_id = e.vec_id),
ex AS (SELECT user_id, UNNEST(v) AS x, generate_subscripts(v, 1) - 1 AS dim FROM wv)
SELECT user_id, CAST(dim AS BIGINT) AS dim, ROUND(AVG(x), 6) AS value FROM ex GROUP BY user_id, dim""",
    "topk_neighbours": item_sql("SELECT movie_id, movie_id2, cos_sim, sort_num FROM neigh"),
    "filter_versions_item": item_sql("SELECT * FROM iversions"),
    "weight_by_factors_item": item_sql("SELECT * FROM ifac2"),
    "rules_item_final": item_sql("SELECT * FROM irules"),
    "item_recall_final": item_sql("SELECT * FROM item_final"),
    "similar_recall_expand": item_sql("SELECT * FROM sexp"),
    "similar_recall_merge": item_sql("SELECT * FROM smerged"),
    "similar_recall_explanations": item_sql("SELECT * FROM sexpl"),
    "similar_recall": item_sql("SELECT * FROM sfinal"),
})


def search_ctes() -> str:
    tq = tokenize_words_sql("regexp_replace(text, '\\.', ' ', 'g')")
    tt = tokenize_words_sql("text")
    return f"""
qw AS (SELECT DISTINCT item_id AS qid, UNNEST({tq}) AS word FROM benchmark),
tw AS (SELECT DISTINCT doc_id AS tid, UNNEST({tt}) AS word FROM documents),
hits0 AS (SELECT q.qid AS query_id, t.tid AS movie_id, count(*) AS num,
                 array_to_string(list_sort(list(q.word)), ' ') AS words
          FROM qw q JOIN tw t ON q.word = t.word GROUP BY q.qid, t.tid),
hits AS (SELECT * FROM hits0 WHERE regexp_matches(words, '[a-z]'))""".replace("STOPS", _stop_list())


SQL.update({
    "agg_token_hits": "WITH " + search_ctes() + """
SELECT * EXCLUDE (sort) FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY num DESC, movie_id) AS sort FROM hits)
WHERE sort <= 100""",
    "title_search": "WITH " + search_ctes() + """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY num DESC, movie_id) AS sort FROM hits)
WHERE sort <= 100""",
    "best_query_match": "WITH " + search_ctes() + """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY num DESC, movie_id) AS sort FROM hits)
WHERE sort = 1""",
})


SQL.update({
    "scan_time_window": f"""
SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS create_time FROM events
WHERE floor(epoch(ts)) >= {AS_OF_EPOCH - 86400} AND floor(epoch(ts)) < {AS_OF_EPOCH}""",
    "scan_table": "SELECT p_partkey, p_name, p_type FROM part WHERE p_type = 'STANDARD'",
    "union_distinct": "WITH " + EVENTS + """
SELECT DISTINCT user_id, movie_id FROM actions WHERE click OR play_time > 0""",
    "dedupe_keys": """
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS r FROM events)
WHERE r = 1""",
    "null_profile": """
SELECT 1.0 - count(d.doc_id) / count(*) AS doc_id_missing, 1.0 - count(l.quality) / count(*) AS quality_missing,
       1.0 - count(l.toxic) / count(*) AS toxic_missing, 1.0 - count(d.lang) / count(*) AS lang_missing
FROM labels l RIGHT JOIN (SELECT doc_id, lang FROM documents) d ON l.doc_id = d.doc_id""",
    "describe_columns": " UNION ALL ".join(
        f"""SELECT '{c}' AS column, count({c}) AS count, ROUND(AVG({c}), 6) AS mean, ROUND(stddev_samp({c}), 6) AS std,
       MIN(CAST({c} AS DOUBLE)) AS min, MAX(CAST({c} AS DOUBLE)) AS max, ROUND(median(CAST({c} AS DOUBLE)), 6) AS median,
       (SELECT CAST({c} AS DOUBLE) FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS mode
FROM lineitem""" for c in ("l_quantity", "l_extendedprice", "l_discount")),
    "save_keyed_map": item_sql("""
SELECT movie_id AS rowkey, CAST(movie_id2 AS VARCHAR) AS qualifier, ROUND(weight, 4) + 0.0 AS value FROM item_final"""),
    "recommend_lookup": item_sql("""
, u AS (SELECT lpad(CAST(user_id AS VARCHAR), 12, '0') AS key, movie_id AS rec, sort_num FROM final),
i AS (SELECT CAST(movie_id AS VARCHAR) AS key, movie_id2 AS rec, sort_num FROM item_final),
keys AS (SELECT key FROM u UNION SELECT key FROM i),
hits AS (SELECT k.key, u.rec, u.sort_num FROM keys k JOIN u ON k.key = u.key WHERE length(k.key) > 10
         UNION ALL
         SELECT k.key, i.rec, i.sort_num FROM keys k JOIN i ON k.key = i.key WHERE length(k.key) <= 10)
SELECT key, string_agg(CAST(rec AS VARCHAR), ',' ORDER BY sort_num, rec) AS movie_ids FROM hits GROUP BY key"""),
    "rows_to_json": "WITH " + search_ctes() + """
SELECT to_json({'query_id': query_id, 'movie_id': movie_id, 'num': num}) AS json FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY num DESC, movie_id) AS sort FROM hits) WHERE sort = 1""",
    "explanation_to_string": item_sql("""
SELECT user_id, movie_id,
       array_to_string(list_sort(list(concat_ws(':', CAST(base_movie AS VARCHAR), base_title, base_year))), ',') AS base_movie
FROM sexpl GROUP BY user_id, movie_id"""),
})


SQL.update({
    "stream_action_dedupe": """
SELECT DISTINCT user_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS movie_id,
       CASE event_type WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'top' ELSE 'play' END AS action,
       CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS ymd
FROM events
WHERE event_type IN ('click', 'purchase', 'view') AND user_id IS NOT NULL
  AND TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) IS NOT NULL""",
})

SQL["textrank_edges"] = text_sql("SELECT * FROM edges")

SQL["dedupe_keep_max"] = profile_sql("""
SELECT user_id, cate_id, movie_id, weight FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, movie_id ORDER BY weight DESC, topic) AS r FROM cands) WHERE r = 1""")

SQL["topic_weights_direct"] = text_sql("SELECT * FROM topic_weights")

SQL["append_once"] = SQL["parse_click_log"]
SQL["rotate_merge"] = "SELECT DISTINCT * FROM (" + SQL["parse_click_log"] + ")"
SQL["save_insert"] = "SELECT aid, title, weight FROM (" + SQL["agg_hot_count"] + ")"
SQL["save_serving_slice"] = "SELECT aid, weight, cid FROM (" + SQL["agg_hot_count"] + ")"
SQL["row_count_audit"] = (
    "SELECT (SELECT count(*) FROM (" + SQL["parse_click_log"] + ")) AS rows, 'click' AS \"table\", 20240130 AS stamp "
    "UNION ALL SELECT (SELECT count(*) FROM (" + SQL["agg_hot_count"] + ")), 'hot', 20240130")
SQL["scan_action_slices"] = """
SELECT CAST(user_id AS VARCHAR) AS mac, event_id, slice FROM (
  SELECT *, CAST((year(ts) - 2023) * 36 + (month(ts) - 12) * 3
    + floor(((CASE WHEN day(ts) <= 10 THEN 10 WHEN day(ts) <= 20 THEN 20 ELSE 30 END) - 10) / 10) AS INT) AS slice
  FROM events WHERE event_type = 'click' AND user_id IS NOT NULL)
WHERE slice >= 4"""


# the channels of which some items come late (plans/queries.py: LATE_CHANNELS, LATE_MOD)
_LATE = "{id} % 10 = 0 AND cate_id IN ('STANDARD', 'MEDIUM')"
SQL.update({
    "change_marker": f"""
WITH docs AS (SELECT d.doc_id AS movie_id, p.p_type AS cate_id FROM documents d LEFT JOIN part p ON d.doc_id = p.p_partkey)
SELECT movie_id, cate_id, 'new' AS change FROM docs WHERE {_LATE.format(id="movie_id")}""",
    "incremental_items": text_sql(f"""
SELECT t.*, CASE WHEN cate_id IN (SELECT cate_id FROM docs WHERE {_LATE.format(id="movie_id")}) THEN 2 ELSE 1 END AS run
FROM topic_weights t""", by_channel=True),
    "incremental_recall": item_sql(f"""
SELECT i.*, CASE WHEN cate_id IN (SELECT cate_id FROM vec WHERE {_LATE.format(id="movie_id")}) THEN 2 ELSE 1 END AS run
FROM item_final i"""),
})

SQL["cluster_neighbours"] = item_sql("SELECT movie_id, movie_id2, cos_sim, sort_num FROM neigh")
SQL["ann_recall"] = """
SELECT 10 AS k, 16 AS bytes_per_vector, count(*) AS items, TRUE AS recall_reached FROM embeddings"""
SQL["daily_action_weight"] = SQL["agg_action_weight"]
SQL["daily_history_play"] = SQL["user_history_play"]
SQL["within_distance"] = """
WITH vec AS (SELECT vec_id AS movie_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT a.movie_id, b.movie_id AS movie_id2,
             ROUND(greatest(list_dot_product(a.v, a.v) + list_dot_product(b.v, b.v) - 2.0 * list_dot_product(a.v, b.v), 0.0), 4) AS d2
      FROM vec a JOIN vec b ON a.movie_id <> b.movie_id),
r AS (SELECT *, row_number() OVER (PARTITION BY movie_id ORDER BY d2, movie_id2) AS sort_num FROM p WHERE d2 <= 1.3225)
SELECT movie_id, movie_id2, ROUND(sqrt(d2), 4) AS distance, sort_num FROM r WHERE sort_num <= 10"""
