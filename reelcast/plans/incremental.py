"""Incremental runs behind a marker table of changed keys.

A run compares the source with what was processed last and writes the difference as marker rows (channel, item,
new / changed / gone).  The marker gates and scopes everything after it:

* no marker row: the run ends, nothing is written;
* a channel without marker rows is not read, computed or written by any stage;
* an item stage computes only the marked items of a marked channel, its other items' rows are carried over;
* a channel stage computes a marked channel from its own stage rows (never from raw text again).

Tables under the output folder, all immutable: ``<stage>/run=<r>/<channel>=<c>`` holds a marked channel's rows of run
``r``, ``marker/run=<r>`` the run's changed keys, ``manifest/run=<r>`` names for every channel the run whose rows are
current.  The manifest is written last and is the commit: a run that fails half-way is overwritten by the next one,
readers see the last manifest only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelcast import config as C
from reelcast.operators import profiles as P
from reelcast.operators import text as TO
from reelcast.plans import star as S
from reelcast.session import path_exists, stage_table

KEY, CHANNEL = "movie_id", "cate_id"
# channels are a fixed list of the catalogue; a source with more distinct values has the wrong channel column
MAX_CHANNELS = 10_000
ITEMS = "items"


@dataclass(frozen=True)
class Stage:
    """``build`` gets {"source": rows, <earlier stage>: rows} and returns ``schema`` plus the channel.  An item stage
    gets the source rows of marked items only, a channel stage all rows of marked channels."""

    name: str
    schema: str
    build: Callable[[dict[str, DataFrame]], DataFrame]
    by_item: bool = False


@dataclass(frozen=True)
class Run:
    """What a run did: its number (that of the last run with a change) and the channels it recomputed."""

    number: int
    marked: list = field(default_factory=list)


def _same(left: DataFrame, right: DataFrame) -> Column:
    return (left[KEY] == right[KEY]) & left[CHANNEL].eqNullSafe(right[CHANNEL])


def _in_channels(channels: list) -> Column:
    named = [c for c in channels if c is not None]
    hit = F.coalesce(F.col(CHANNEL).isin(*named), F.lit(False)) if named else F.lit(False)
    return hit | F.col(CHANNEL).isNull() if None in channels else hit


def digests(source: DataFrame) -> DataFrame:
    """(item, channel, digest) of the source: rows of one item and channel count as a set with repeats, in any order;
    rows without an item are no items."""
    h = F.xxhash64(*[c for c in source.columns if c not in (KEY, CHANNEL)])
    rows = source.where(F.col(KEY).isNotNull()).select(KEY, CHANNEL, h.alias("h")).groupBy(KEY, CHANNEL).agg(
        F.bit_xor("h").alias("x"), F.sum(F.pmod("h", F.lit(1 << 31))).alias("s"), F.count(F.lit(1)).alias("n"))
    return rows.select(KEY, CHANNEL, F.xxhash64("x", "s", "n").alias("digest"))


def change_marker(before: DataFrame, now: DataFrame) -> DataFrame:
    """(item, channel, change): keys that are new, changed or gone; an item that moved is gone in one channel and new
    in the other."""
    b, n = before.alias("b"), now.alias("n")
    j = b.join(n, (F.col(f"b.{KEY}") == F.col(f"n.{KEY}")) & F.col(f"b.{CHANNEL}").eqNullSafe(F.col(f"n.{CHANNEL}")),
               "full")
    gone, new = F.col(f"n.{KEY}").isNull(), F.col(f"b.{KEY}").isNull()
    change = F.when(new, "new").when(gone, "gone").when(F.col("b.digest") != F.col("n.digest"), "changed")
    return j.select(F.coalesce(f"n.{KEY}", f"b.{KEY}").alias(KEY),
                    F.when(gone, F.col(f"b.{CHANNEL}")).otherwise(F.col(f"n.{CHANNEL}")).alias(CHANNEL),
                    change.alias("change")).where(F.col("change").isNotNull())


class ChannelTables:
    """The tables of one incremental pipeline under ``out``."""

    def __init__(self, spark: SparkSession, out: str, channel_type: str = "string"):
        self.spark, self.out, self.channel_type = spark, out.rstrip("/"), channel_type

    def manifest(self) -> tuple[int, list[tuple]]:
        """(last committed run, [(channel, run that holds its rows)]); (0, []) before the first run."""
        path = f"{self.out}/manifest"
        if not path_exists(self.spark, path):
            return 0, []
        rows = self.spark.read.schema(f"{CHANNEL} {self.channel_type}, at int, run int").parquet(path)
        last = rows.agg(F.max("run")).first()[0]
        if last is None:
            return 0, []
        return last, [(r[CHANNEL], r["at"]) for r in rows.where((F.col("run") == last) & (F.col("at") > 0)).collect()]

    def commit(self, run: int, channels: list[tuple]) -> None:
        rows = [*channels, (None, 0)]                       # one row at least, so that the run can be seen
        self.spark.createDataFrame(rows, f"{CHANNEL} {self.channel_type}, at int").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.out}/manifest/run={run}")

    def read(self, stage: str, schema: str, places: list[tuple]) -> DataFrame:
        """Rows of ``stage`` for the given (channel, run) pairs; run and channel are partitions, so only their folders
        are opened."""
        names = [c.split()[0] for c in schema.split(", ")]
        full = f"{schema}, run int, {CHANNEL} {self.channel_type}"
        runs: dict[int, list] = {}
        for channel, at in places:
            runs.setdefault(at, []).append(channel)
        path = f"{self.out}/{stage}"
        if not runs or not path_exists(self.spark, path):
            return self.spark.createDataFrame([], full).select(*names, CHANNEL, "run")
        wanted = F.lit(False)
        for at, channels in sorted(runs.items()):
            wanted = wanted | ((F.col("run") == at) & _in_channels(channels))
        return self.spark.read.schema(full).parquet(path).where(wanted).select(*names, CHANNEL, "run")

    def write(self, stage: str, run: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").partitionBy(CHANNEL).parquet(f"{self.out}/{stage}/run={run}")

    def current(self, stage: Stage) -> DataFrame:
        """All current rows of a stage with the run that wrote them."""
        return self.read(stage.name, stage.schema, self.manifest()[1])

    def marker(self, run: int) -> DataFrame:
        return self.spark.read.schema(f"{KEY} long, {CHANNEL} {self.channel_type}, change string").parquet(
            f"{self.out}/marker/run={run}")

    def update(self, source: DataFrame, stages: list[Stage]) -> Run:
        """Bring all stages up to date with ``source`` (item, channel, content columns)."""
        last, places = self.manifest()
        # the source is read for its digests once: the marker and the item stage take them from here
        now = stage_table(digests(source))
        items = Stage(ITEMS, f"{KEY} long, digest long", lambda s: now.join(alive, _same(now, alive), "left_semi"),
                      by_item=True)
        before = self.read(items.name, items.schema, places).drop("run")
        marker = stage_table(change_marker(before, now))
        marked = [r[CHANNEL] for r in marker.select(CHANNEL).distinct().limit(MAX_CHANNELS + 1).collect()]
        if not marked:
            return Run(last)
        if len(marked) > MAX_CHANNELS:
            raise ValueError(f"more than {MAX_CHANNELS} channels in {CHANNEL}")
        run = last + 1
        marker.write.mode("overwrite").parquet(f"{self.out}/marker/run={run}")
        marker = self.marker(run)
        old = [(c, at) for c, at in places if c in marked]
        here = [(c, run) for c in marked]
        scoped = source.where(_in_channels(marked))
        alive = marker.where("change <> 'gone'")
        fresh = scoped.join(alive, _same(scoped, alive), "left_semi")
        done: dict[str, DataFrame] = {"source": scoped}
        for stage in [items, *stages]:
            if stage.by_item:
                kept = self.read(stage.name, stage.schema, old).drop("run")
                kept = kept.join(marker, _same(kept, marker), "left_anti")
                rows = kept.unionByName(stage.build({"source": fresh}).select(*kept.columns))
            else:
                rows = stage.build(done)
            self.write(stage.name, run, rows)
            done[stage.name] = self.read(stage.name, stage.schema, here).drop("run")
        self.commit(run, [(c, at) for c, at in places if c not in marked] + here)
        return Run(run, sorted(marked, key=lambda c: (c is not None, c)))


# ---------------------------------------------------------------- item profile
def channel_topic_weights(textrank: DataFrame, terms: DataFrame, stamp: int) -> DataFrame:
    """Topic words with their weights; the idf of a word counts the documents of the channel only."""
    tfidf = TO.explode_tfidf_by(terms, TO.fit_idf_by(terms, CHANNEL), CHANNEL)
    factors = P.keyword_factors(textrank, tfidf)
    by_idf = P.topk_keywords(P.idf_textrank(factors), C.KEYWORD_TOPK)
    by_tfidf = P.topk_keywords(P.tfidf_textrank(factors), C.KEYWORD_TOPK)
    return P.topic_weights_direct(by_idf, P.topic_words(by_idf, by_tfidf), stamp)


def item_stages(stamp: int) -> list[Stage]:
    return [
        Stage("textrank", f"{KEY} long, tag string, textrank double",
              lambda s: TO.textrank_documents(s["source"], "summary"), by_item=True),
        Stage("terms", f"{KEY} long, keyword string, tf long",
              lambda s: TO.text_terms(s["source"], "summary"), by_item=True),
        Stage("topic_weights", f"{KEY} long, topic string, weight double, timestamp int",
              lambda s: channel_topic_weights(s["textrank"], s["terms"], stamp).select(
                  KEY, "topic", "weight", "timestamp", CHANNEL)),
    ]


def update_items(spark: SparkSession, docs: DataFrame, out: str, stamp: int = S.STAMP) -> Run:
    """Item profiles (``docs``: item, channel, title, summary) after the marked channels' texts changed."""
    return ChannelTables(spark, out).update(docs, item_stages(stamp))


# ---------------------------------------------------------------- item recall
RECALL = ("movie_id long, title string, year string, movie_id2 long, title2 string, year2 string, score double, "
          "play_num long, weight double, source int, sort_num long, timestamp int")


def recall_stages(spark: SparkSession, d: str, stamp: int) -> list[Stage]:
    """Neighbours and item recall by channel; factors, catalogue and sources are read as they are at the run."""
    def neighbours(s):
        from reelcast.operators import vectors as V
        near = V.block_topk(s["source"], s["source"], [CHANNEL], C.NEIGHBOURS_K, "cosine")
        return near.join(s["source"].select(KEY, CHANNEL), KEY).select(
            KEY, "movie_id2", F.col("score").alias("cos_sim"), CHANNEL)

    def recall(s):
        return S.item_recall(spark, d, s["neighbours"], stamp)

    return [Stage("neighbours", f"{KEY} long, movie_id2 long, cos_sim double", neighbours),
            Stage("movie_recall", RECALL, recall)]


def update_recall(spark: SparkSession, d: str, vectors: DataFrame, out: str, stamp: int = S.STAMP) -> Run:
    """Item recall (``vectors``: item, channel, vec) after the marked channels' vectors changed."""
    return ChannelTables(spark, out).update(vectors, recall_stages(spark, d, stamp))
