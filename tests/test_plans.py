import __spark_entry__ as E
from conftest import SF001

NO_CROSS = ["knn_exact_l2", "minmax_normalize", "hot_factor", "score_factor", "fit_idf", "agg_token_hits",
            "cosine_in_cluster", "user_top_items"]


def _plan(spark, key):
    return E.queries()[key](spark, SF001)._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop_joins(spark):
    for key in NO_CROSS:
        plan = _plan(spark, key)
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, key


def test_filters_and_projection_reach_the_scan(spark):
    plan = _plan(spark, "scan_table")
    assert "PushedFilters: [IsNotNull(p_type), EqualTo(p_type,STANDARD)]" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_type:string>" in plan
    plan = _plan(spark, "parse_click_log")
    assert "In(event_type" in plan or "EqualTo(event_type" in plan
    # the click path does not even read `value`
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in plan


def test_topk_uses_window_group_limit(spark):
    assert "WindowGroupLimit" in _plan(spark, "topk_tfidf")
