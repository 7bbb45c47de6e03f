"""Incremental runs: equal to a full run over the grown table, only marked channels touched, a rerun changes nothing."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from reelcast.plans import incremental as INC
from reelcast.plans import star as S

DOCS = "movie_id long, cate_id string, title string, summary string"


def text(i):
    pool = ["river", "mountain", "harbour", "lantern", "orchard", "thunder", "velvet", "winter", "cannon", "meadow"]
    return " ".join(pool[(i * k + k) % 10] + ("" if k % 3 else str(i % 4)) for k in range(1, 25))


def day_one():
    rows = [(i, ["a", "b", "c", None][i % 4], f"t{i}", text(i)) for i in range(40)]
    return rows + [(100, "a", "twice", text(7)), (100, "a", "twice", text(8)), (None, "a", "no id", "x y z")]


def day_two():
    rows = [r for r in day_one() if r[0] not in (5, 9)]                  # channel b loses an item ...
    rows = [(9, "c", r[2], r[3]) if r[0] == 13 else r for r in rows]     # ... and another one; 9 now is in c
    rows = [(i, c, t, s + " glacier") if i == 2 else (i, c, t, s) for i, c, t, s in rows]   # changed in c
    return rows + [(200, "d", "new channel", text(3)), (201, "c", "new", None)]


def files(out):
    """{file: modification time} of all data files, without what Spark writes beside them."""
    found = {}
    for folder, _, names in os.walk(out):
        for n in names:
            if n.endswith(".parquet"):
                found[os.path.join(folder, n)] = os.stat(os.path.join(folder, n)).st_mtime_ns
    return found


def rows_of(df, drop=("run",)):
    return sorted((tuple(r) for r in df.drop(*drop).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_second_run_touches_marked_channels_only(spark, tmp_dir):
    out, full = os.path.join(tmp_dir, "inc"), os.path.join(tmp_dir, "full")
    stages = INC.item_stages(S.STAMP)
    tables = INC.ChannelTables(spark, out)
    first = INC.update_items(spark, frame(spark, day_one()), out)
    assert first == INC.Run(1, [None, "a", "b", "c"])
    before = files(out)
    second = INC.update_items(spark, frame(spark, day_two()), out)
    assert second == INC.Run(2, ["b", "c", "d"])
    after = files(out)
    assert {f: t for f, t in after.items() if f in before} == before               # nothing is rewritten in place
    fresh = [f for f in after if f not in before and "/manifest/" not in f and "/marker/" not in f]
    assert fresh and all("/run=2/cate_id=" in f for f in fresh)
    assert {f.split("cate_id=")[1].split("/")[0] for f in fresh} == {"b", "c", "d"}
    marker = {(r.movie_id, r.cate_id, r.change) for r in tables.marker(2).collect()}
    assert marker == {(5, "b", "gone"), (9, "b", "gone"), (13, "b", "gone"), (9, "c", "new"), (2, "c", "changed"),
                      (200, "d", "new"), (201, "c", "new")}
    INC.update_items(spark, frame(spark, day_two()), full)
    for stage in stages:
        got, want = (rows_of(INC.ChannelTables(spark, o).current(stage)) for o in (out, full))
        assert got == want and got
    assert {(r.cate_id, r.run) for r in tables.current(stages[0]).select("cate_id", "run").distinct().collect()} == {
        (None, 1), ("a", 1), ("b", 2), ("c", 2), ("d", 2)}
    assert INC.update_items(spark, frame(spark, day_two()), out) == INC.Run(2)       # a rerun
    assert files(out) == after


def test_unmarked_items_are_not_computed_again(spark, tmp_dir):
    """An item stage gets the marked items only; a run that fails before its commit leaves the last state."""
    seen = []

    def build(s):
        seen.append(sorted(r.movie_id for r in s["source"].select("movie_id").collect()))
        return s["source"].select("movie_id", F.length("summary").cast("long").alias("n"), "cate_id")

    def broken(s):
        raise RuntimeError("lost")

    tables = INC.ChannelTables(spark, tmp_dir)
    stage = INC.Stage("lengths", "movie_id long, n long", build, by_item=True)
    tables.update(frame(spark, day_one()), [stage])
    state = rows_of(tables.current(stage))
    with pytest.raises(RuntimeError):
        tables.update(frame(spark, day_two()), [stage, INC.Stage("next", "movie_id long", broken)])
    assert tables.manifest()[0] == 1 and rows_of(tables.current(stage)) == state
    run = tables.update(frame(spark, day_two()), [stage])
    assert run.number == 2 and seen[1] == seen[2] == [2, 9, 200, 201]
    want = sorted(((i, len(s) if s else None, c) for i, c, _, s in day_two() if i is not None), key=str)
    assert rows_of(tables.current(stage)) == want


def test_everything_gone_and_empty_tables(spark, tmp_dir):
    tables = INC.ChannelTables(spark, tmp_dir)
    stage = INC.item_stages(S.STAMP)[-1]
    assert INC.update_items(spark, frame(spark, []), tmp_dir) == INC.Run(0)
    INC.update_items(spark, frame(spark, day_one()), tmp_dir)
    assert INC.update_items(spark, frame(spark, []), tmp_dir).number == 2
    assert tables.current(stage).count() == 0
    assert INC.update_items(spark, frame(spark, []), tmp_dir) == INC.Run(2)


def test_reads_open_the_current_folders_only(spark, tmp_dir):
    tables = INC.ChannelTables(spark, tmp_dir)
    INC.update_items(spark, frame(spark, day_one()), tmp_dir)
    INC.update_items(spark, frame(spark, day_two()), tmp_dir)
    plan = tables.current(INC.item_stages(S.STAMP)[1])._jdf.queryExecution().executedPlan().toString()
    part = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "run" in part and "cate_id" in part
    rows = tables.current(INC.item_stages(S.STAMP)[1]).select(F.input_file_name().alias("f")).distinct()
    opened = {r.f.split("/terms/")[1].rsplit("/", 1)[0] for r in rows.collect()}
    assert opened == {"run=1/cate_id=a", "run=1/cate_id=__HIVE_DEFAULT_PARTITION__", "run=2/cate_id=b",
                      "run=2/cate_id=c", "run=2/cate_id=d"}


def test_recall_follows_vectors(spark, tmp_dir):
    vectors = S.item_vectors(spark, SF001).select("movie_id", "cate_id", "vec")
    late = (F.col("movie_id") % 3 == 0) & F.coalesce(F.col("cate_id") == "STANDARD", F.lit(False))
    inc, full = os.path.join(tmp_dir, "inc"), os.path.join(tmp_dir, "full")
    INC.update_recall(spark, SF001, vectors.where(~late), inc)
    assert INC.update_recall(spark, SF001, vectors, inc).marked == ["STANDARD"]
    INC.update_recall(spark, SF001, vectors, full)
    stage = INC.recall_stages(spark, SF001, S.STAMP)[-1]
    got, want = (rows_of(INC.ChannelTables(spark, o).current(stage)) for o in (inc, full))
    assert got == want
