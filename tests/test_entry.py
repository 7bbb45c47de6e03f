import duckdb

import __spark_entry__ as E
from conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
SAMPLE = ["user_top_items", "agg_action_stat", "hot_factor", "year_factor", "explode_tfidf", "textrank_keywords",
          "profile_recall", "cosine_in_cluster", "item_recall_final", "similar_recall", "title_search"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"user_id", "movie_id", "cate_id", "weight", "sort_num"}
    assert df.count() > 0


def test_registry_and_oracles_cover_each_other():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 108                          # keys outside the optional subpackage: a lost module is seen


def test_sample_against_duckdb(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    q, s = E.queries(), E.oracle_sql()
    for name in SAMPLE:
        sp = q[name](spark, SF001).toPandas()
        dd = con.execute(s[name]).df()
        cols = sorted(sp.columns)
        assert cols == sorted(dd.columns), name
        a = sorted(map(tuple, sp[cols].astype(str).values.tolist()))
        b = sorted(map(tuple, dd[cols].astype(str).values.tolist()))
        assert a == b, name
