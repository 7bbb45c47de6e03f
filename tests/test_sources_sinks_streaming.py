import os

import pytest
from pyspark.sql import functions as F

from reelcast.sources import sinks as SK
from reelcast.sources import tables as TB
from reelcast.streaming import ingest as IN
from conftest import SF001


def test_append_once_is_idempotent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "tw")
    day1 = spark.createDataFrame([(1, "a", 20240130), (2, "b", 20240130)], "movie_id long, topic string, timestamp int")
    day2 = spark.createDataFrame([(3, "c", 20240131)], "movie_id long, topic string, timestamp int")
    SK.append_once(day1, path, "timestamp")
    SK.append_once(day2, path, "timestamp")
    SK.append_once(day2, path, "timestamp")          # re-run of the same day
    assert spark.read.parquet(path).count() == 3


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_rotate_merge_rewrites_open_slices_only(spark, tmp_dir):
    schema, path = "user_id string, movie_id long, datetime long, slice int", os.path.join(tmp_dir, "merged")
    first = [("u", 1, 10, 0), ("u", 1, 10, 0), ("u", 2, 20, 1), ("v", 3, 30, None)]
    SK.rotate_merge(spark.createDataFrame(first, schema), path)
    closed = {f: t for f, t in _files(path).items() if "slice=0" in f}
    new = [("u", 2, 20, 1), ("w", 9, 21, 1), ("x", 1, 40, 2), ("v", 3, 30, None)]
    out = SK.rotate_merge(spark.createDataFrame(new, schema), path)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(set(first) | set(new), key=str)
    assert closed and {f: t for f, t in _files(path).items() if "slice=0" in f} == closed
    again = _files(path)
    SK.rotate_merge(spark.createDataFrame(new[2:3], schema), path)
    assert {f: t for f, t in _files(path).items() if "slice=2" not in f} == {
        f: t for f, t in again.items() if "slice=2" not in f}
    assert SK.rotate_merge(spark.createDataFrame([], schema), path).count() == 5


def test_slice_table_is_pruned(spark, tmp_dir):
    schema = "mac string, event_id long, funtype string, slice int"
    rows = [("m1", 1, "focus", 0), ("", 2, "focus", 0), ("m2", 3, "other", 1), ("m3", 4, "focus", 2)]
    log = spark.createDataFrame(rows, schema)
    for kind in ("click", "top"):
        TB.write_action_slices(log, tmp_dir, kind)
    before = _files(tmp_dir)
    TB.write_action_slices(log.where("slice = 2"), tmp_dir, "click")          # one slice again: replaced, not doubled
    after = _files(tmp_dir)
    same = {f: t for f, t in before.items() if "kind=click/slice=2" not in f}
    assert {f: t for f, t in after.items() if "kind=click/slice=2" not in f} == same
    scan = TB.scan_action_slices(spark, tmp_dir, "click", start=1)
    assert sorted((r.mac, r._slice) for r in scan.collect()) == [("m2", 1), ("m3", 2)]
    assert sorted(r.event_id for r in TB.scan_action_slices(spark, tmp_dir, "top").collect()) == [1, 4]
    assert [r.event_id for r in TB.scan_action_slices(spark, tmp_dir, "click", index=0).collect()] == [1]
    part = scan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("], ")[0]
    assert "kind" in part and "slice" in part
    opened = {r.f.rsplit("/", 2)[1] for r in scan.select(F.input_file_name().alias("f")).collect()}
    assert opened == {"slice=1", "slice=2"}


def test_lookup_opens_the_keys_buckets_only(spark, tmp_dir):
    path = os.path.join(tmp_dir, "serving")
    rows = spark.range(0, 3000).selectExpr("id AS movie_id", "id * 2 AS movie_id2", "1 AS sort_num")
    SK.save_lookup(rows, path, "movie_id", buckets=64)
    assert len(_files(path)) == 64
    keys = spark.createDataFrame([(str(i),) for i in range(0, 2000, 200)] + [("none",), (None,)], "movie_id string")
    hits = SK.read_lookup(keys, path, "movie_id", buckets=64)
    assert sorted((r.movie_id, r.movie_id2) for r in hits.collect()) == sorted((str(i), 2 * i) for i in range(0, 2000, 200))
    scan = hits._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in scan.split("PartitionFilters: [")[1].split("]")[0]
    wanted = keys.select(F.pmod(F.xxhash64("movie_id"), F.lit(64)).alias("b")).where("movie_id IS NOT NULL").distinct().count()
    served = spark.read.parquet(path).where(F.col("bucket").isin(*[r.b for r in keys.where("movie_id IS NOT NULL").select(
        F.pmod(F.xxhash64("movie_id"), F.lit(64)).alias("b")).distinct().collect()]))
    assert served.select(F.input_file_name().alias("f")).distinct().count() <= wanted <= 11


def test_scan_action_slices(spark, tmp_dir):
    rows = [("m1", '{"aid": "1", "cid": "1969"}', 100, "focus", "d1"), ("", '{"aid": "2"}', 100, "focus", "d2"),
            ("m2", '{"aid": "3", "cid": "1970"}', 100, "other", "d3")]
    schema = "mac string, funitems string, ymd long, funtype string, deviceid string"
    for name in ("log_enter0", "log_enter1", "log_top0", "log_play0"):
        spark.createDataFrame(rows, schema).write.parquet(os.path.join(tmp_dir, name))
    assert TB.scan_action_slices(spark, tmp_dir, "click").count() == 4          # two slices, empty mac dropped
    assert TB.scan_action_slices(spark, tmp_dir, "click", index=1).count() == 2
    assert TB.scan_action_slices(spark, tmp_dir, "top").count() == 1            # focus only
    assert TB.scan_action_slices(spark, tmp_dir, "play").count() == 2


def test_scan_time_window_bounds(spark):
    df = spark.createDataFrame([(1706572800 - 1,), (1706572800,), (1706659199,), (1706659200,)], "create_time long")
    got = [r.create_time for r in TB.scan_time_window(df, "create_time", "2024-01-31").collect()]
    assert got == [1706572800, 1706659199]       # [yesterday 00:00, today 00:00)


def test_change_gate_and_audit(spark, tmp_dir):
    marker = spark.createDataFrame([(1969,)], "cate_id long")
    assert SK.change_gate(marker, "cate_id", 1969) and not SK.change_gate(marker, "cate_id", 1970)
    rows = SK.row_count_audit(spark.range(42), "t", os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "audit"), 20240131)
    assert rows == 42
    assert spark.read.parquet(os.path.join(tmp_dir, "audit")).collect()[0].rows == 42


def test_model_round_trip(spark, tmp_dir):
    from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
    df = spark.createDataFrame([(["a", "b"],), (["a"],)], "words array<string>")
    est = CountVectorizer(inputCol="words", outputCol="tf", vocabSize=100, minDF=1.0)
    path = os.path.join(tmp_dir, "cv")
    m1 = SK.fit_or_load(est, CountVectorizerModel, df, path, refit=True)
    m2 = SK.fit_or_load(est, CountVectorizerModel, df, path, refit=False)
    assert m1.vocabulary == m2.vocabulary


def test_keyed_map(spark):
    df = spark.createDataFrame([(1, 2, 0.123456), (1, 3, 0.5)], "movie_id long, movie_id2 long, weight double")
    r = SK.keyed_map(df, "movie_id", "movie_id2", "weight").collect()[0]
    assert r.cells == {"2": 0.1235, "3": 0.5}


def test_stream_ingest_dedupes_repeats(spark, tmp_dir):
    import pyarrow.parquet as pq
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    tbl = pq.read_table(f"{SF001}/events.parquet")
    pq.write_table(tbl, os.path.join(src, "events_a.parquet"))
    pq.write_table(tbl.slice(0, 100), os.path.join(src, "events_b.parquet"))    # repeated reports
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    out = IN.ingest_actions(spark, src, os.path.join(tmp_dir, "out"))
    expect = IN.parse_actions(ev).select("user_id", "movie_id", "action", "ymd").distinct()
    assert out.count() == expect.count()
    assert out.exceptAll(expect).count() == 0


def test_stream_ingest_keeps_late_rows(spark, tmp_dir):
    """Files out of order, one per trigger: the same rows as all files in one trigger."""
    import pyarrow.compute as pc
    import pyarrow.parquet as pq
    src = os.path.join(tmp_dir, "late")
    os.makedirs(src)
    tbl = pq.read_table(f"{SF001}/events.parquet")
    tbl = tbl.take(pc.sort_indices(tbl, [("ts", "descending")]))      # newest file first
    third = -(-tbl.num_rows // 3)
    for i in range(3):
        path = os.path.join(src, f"events_{i}.parquet")
        pq.write_table(tbl.slice(i * third, third), path)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    one = IN.ingest_actions(spark, src, os.path.join(tmp_dir, "one"))
    each = IN.ingest_actions(spark, src, os.path.join(tmp_dir, "each"), max_files=1)
    expect = IN.dedupe_actions(IN.parse_actions(spark.read.parquet(f"{SF001}/events.parquet")))
    assert each.count() == one.count() == expect.count()
    assert each.exceptAll(expect).count() == 0


def test_stage_tables_follow_the_input(spark, tmp_dir):
    """A table that grows between two calls gets a new answer; an unchanged one is read from its stage table."""
    import shutil

    import pyarrow.parquet as pq
    from reelcast.plans.queries import REGISTRY
    d = os.path.join(tmp_dir, "grow")
    os.makedirs(d)
    for name in os.listdir(SF001):                       # contents only: the test data may be read-only
        shutil.copyfile(os.path.join(SF001, name), os.path.join(d, name))
    full = pq.read_table(f"{SF001}/events.parquet")
    pq.write_table(full.slice(0, 100), f"{d}/events.parquet")
    small = REGISTRY["merge_actions"](spark, d).count()
    assert REGISTRY["merge_actions"](spark, d).count() == small
    pq.write_table(full, f"{d}/events.parquet")
    assert REGISTRY["merge_actions"](spark, d).count() > small


def test_pipelines_write_and_counts_shrink(spark, tmp_dir):
    from reelcast.plans import pipeline as PL
    f = PL.factor_refresh(spark, SF001, tmp_dir)
    h = PL.pipeline_history(spark, SF001, tmp_dir)
    u = PL.pipeline_user(spark, SF001, tmp_dir)
    r = PL.pipeline_recall(spark, SF001, tmp_dir)
    assert f["movie_hot_factor"] > 0 and h["merge_action"] > 0 and u["action_weight"] > 0
    # similar recall narrows monotonically: expanded >= merged >= final
    assert r["user_similar_expand"] >= r["user_similar_merged"] >= r["user_similar_recall"]
    audit = spark.read.parquet(os.path.join(tmp_dir, "_audit"))
    assert audit.count() >= 10


def test_scan_text_lines_and_inline_rows(spark, tmp_dir):
    p = os.path.join(tmp_dir, "stop.txt")
    with open(p, "w", encoding="utf-8") as fh:
        fh.write("  the \n\nund\n")
    assert [r.line for r in TB.scan_text_lines(spark, p).collect()] == ["the", "und"]
    df = TB.inline_rows(spark, [(1969, "film")], "cate_id long, name string")
    assert df.collect()[0].name == "film"


def test_mode_and_dedupe_keys(spark):
    from reelcast.operators import generic as G
    df = spark.createDataFrame([(1, 5), (1, 3), (2, 3), (2, 5)], "k long, v long")
    assert G.mode_of(df, "v").collect()[0]["mode"] == 3
    got = {r.k: r.v for r in G.dedupe_keys(df, ["k"], [-F.col("v")]).collect()}
    assert got == {1: 5, 2: 5}


def test_save_insert_and_device_map(spark, tmp_dir):
    from reelcast.operators import actions as A
    p = os.path.join(tmp_dir, "ins")
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    SK.save_insert(df, p, ["v", "id"], full=True)
    for _ in range(2):                                   # the same increment again replaces itself
        SK.save_insert(df, p, ["v", "id"], full=False)
    assert spark.read.parquet(p).columns == ["v", "id", "batch"] and spark.read.parquet(p).count() == 2
    SK.save_insert(df, p, ["v", "id"], full=True)
    assert spark.read.parquet(p).count() == 1
    logs = [spark.createDataFrame([("d1", "m1"), ("d1", "m1"), (None, "m2")], "deviceid string, mac string"),
            spark.createDataFrame([("d2", "m2")], "deviceid string, mac string")]
    assert sorted(tuple(r) for r in A.device_map(*logs).collect()) == [("d1", "m1"), ("d2", "m2")]


def test_foreach_batch_sink_is_per_batch(spark, tmp_dir):
    import pyarrow.parquet as pq
    src = os.path.join(tmp_dir, "in2")
    os.makedirs(src)
    pq.write_table(pq.read_table(f"{SF001}/events.parquet"), os.path.join(src, "events_a.parquet"))
    target = os.path.join(tmp_dir, "merged")
    stream = IN.parse_actions(IN.read_action_stream(spark, src))
    q = (stream.writeStream.foreachBatch(IN.foreach_batch_merge(target))
         .option("checkpointLocation", os.path.join(tmp_dir, "ck2")).trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(target)
    assert "batch" in out.columns
    assert out.count() == IN.parse_actions(spark.read.parquet(f"{SF001}/events.parquet")).count()


def test_settled_keeps_the_result_only(spark):
    """Stage tables written on the way are removed, those of an outer call's own steps only when it ends."""
    from reelcast.session import settled, shared_folder, stage_table
    folder = shared_folder(spark).replace("file:", "")
    tables = lambda: {f for f in os.listdir(folder) if f.startswith("stage-")}
    before = tables()

    def build():
        a = stage_table(spark.range(10))
        b = settled(spark, lambda: stage_table(a.where("id > 3")).withColumn("x", F.lit(1)))
        assert len(tables() - before) == 2
        return a.join(b, "id")

    out = settled(spark, build)
    assert len(tables() - before) == 1 and out.count() == 6

    def broken():
        stage_table(spark.range(3))
        raise RuntimeError("lost")

    left = tables()
    with pytest.raises(RuntimeError):
        settled(spark, broken)
    assert tables() == left


def test_stages_need_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from reelcast.session import shared_folder
    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(ValueError):
        shared_folder(SimpleNamespace(sparkContext=sc, conf=conf))
