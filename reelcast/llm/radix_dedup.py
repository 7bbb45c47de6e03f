"""Repeated 100-byte windows by a depth-limited radix sort of suffixes.

Suffixes are ordered only through ``DEPTH`` bytes, one digit per pass, and a suffix that stands alone after a pass is
dropped.  Visiting the bytes of a window left to right would move every byte start of the corpus; instead the most
significant digit is the window's *anchor*, the k-gram of smallest hash in it (leftmost on ties).  Equal windows have
equal anchors at equal places, and some 35 neighbouring windows share one, so the first pass moves one row per run of
windows.  Passes:

1. digit = the anchor's k-gram: runs whose k-gram occurs once are dropped;
2. digit = all bytes of the run's windows: of equal runs, each but the first is repeated as a whole;
3. first runs whose k-gram still has company are cut into classes of ``STEP`` neighbouring windows; digit = the core,
   the ``DEPTH - STEP + 1`` or so bytes that all windows of a class have, and what stands alone is dropped; digit = all
   bytes of the class: of equal classes, each but the first is repeated as a whole;
4. for first classes whose core still has company, digit = the full ``DEPTH`` bytes: each window by itself.

Equal groups of the last digit are exactly the repeated windows; in each group all but the smallest (document, start)
are removed.  Digits are compared by 64-bit hashes, two independent ones where they decide a removal.  Runs and
windows that a batch already holds are resolved before the shuffle, so a passage in a third of all documents sends a
row per batch, not per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelcast.llm.common import RollingHash, i64, mix64, sized_broadcast, stage_table, utf8_blocks

DEPTH = 100
KGRAM = 32
STEP = 14                   # windows of a run whose anchor stands in so many neighbouring places are one class
_HASHERS: list[RollingHash] = []
_LOW = np.uint64(0xFFFFFFFF)


def _hashers() -> list[RollingHash]:
    if not _HASHERS:
        _HASHERS.extend((RollingHash(seed=77001), RollingHash(seed=77002)))
    return _HASHERS


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every window of ``width`` values."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[:len(out) - (width - have)], out[width - have:])
    return out


def _anchors(prefix: np.ndarray, depth: int, kgram: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every k-gram, position of the anchor of the window at each start)."""
    grams = _hashers()[0].windows(prefix, kgram)
    packed = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    return grams, (_window_min(packed, depth - kgram + 1) & _LOW).astype(np.int64)


def window_runs(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH, kgram: int = KGRAM):
    """(text, first start, number of starts, k-gram hash, hash of all bytes of the run) of every run of
    neighbouring windows that share an anchor; texts below ``depth`` bytes have none."""
    empty = np.zeros(0, np.int64)
    n = len(data)
    sizes = np.diff(offsets)
    if n < depth or sizes.max(initial=0) < depth:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    h = _hashers()[0]
    prefix = h.prefix(data)
    grams, anchor = _anchors(prefix, depth, kgram)
    starts = np.arange(len(anchor))
    text = np.repeat(np.arange(len(sizes)), sizes)[:len(anchor)]
    keep = starts + depth <= offsets[1:][text]
    starts, text, anchor = starts[keep], text[keep], anchor[:len(keep)][keep]
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.append(first, len(starts)))
    begin, anchor, text = starts[first], anchor[first], text[first]
    whole = h.spans(prefix, begin, begin + count - 1 + depth)
    whole = mix64(whole + (anchor - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return text, begin - offsets[text], count, grams[anchor], whole


def _first_of(keys: list[np.ndarray], doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """True where (doc, at) is the smallest of its key."""
    order = np.lexsort((at, doc, *reversed(keys)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    group = np.cumsum(new) - 1
    lead = order[new][group]
    out = np.zeros(len(order), bool)
    out[order] = (doc[order] == doc[lead]) & (at[order] == at[lead])
    return out


def _rows(first: np.ndarray, key: np.ndarray, ctx: np.ndarray, doc: np.ndarray, at: np.ndarray,
          n: np.ndarray) -> pa.RecordBatch:
    """First runs with their digits; the others as resolved stretches (n below zero), neighbouring ones joined."""
    done = np.flatnonzero(~first)
    done = done[np.lexsort((at[done], doc[done]))]
    d, a, b = doc[done], at[done], at[done] + n[done]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (a[1:] > b[:-1])]) if len(done) else done
    begin = np.flatnonzero(new)
    d0, a0 = d[begin], a[begin]
    span = np.maximum.reduceat(b, begin) - a0 if len(begin) else a0
    spread = mix64(d0.astype(np.uint64) * np.uint64(31) + a0.astype(np.uint64))
    return pa.RecordBatch.from_arrays(
        [i64(np.concatenate([key[first], spread])), i64(np.concatenate([ctx[first], np.zeros(len(d0), np.uint64)])),
         i64(np.concatenate([doc[first], d0])), i64(np.concatenate([at[first], a0])),
         pa.array(np.concatenate([n[first], -span]).astype(np.int32))], names=["key", "ctx", "doc", "at", "n"])


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of each batch: the first of equal ones with its digits, the others as resolved."""
    for batch in batches:
        ids = np.asarray(batch.column(0), np.int64)
        parts = []
        for lo, _, data, offsets in utf8_blocks(batch.column(1)):
            text, at, count, key, ctx = window_runs(data, offsets)
            parts.append((key, ctx, ids[lo + text], at, count))
        if parts:
            key, ctx, doc, at, n = (np.concatenate(x) for x in zip(*parts))
            yield _rows(_first_of([key, ctx], doc, at), key, ctx, doc, at, n)


def _listed(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(ids, bytes, offsets, text, first start, number of starts) of the runs listed beside each text, by block."""
    ids = np.asarray(batch.column(0), np.int64)
    runs = batch.column(2)
    for lo, hi, data, offsets in utf8_blocks(batch.column(1)):
        flat = runs.slice(lo, hi - lo).flatten()
        per = np.fromiter((len(x) for x in runs.slice(lo, hi - lo)), np.int64, hi - lo)
        text = np.repeat(np.arange(hi - lo), per)
        at, n = np.asarray(flat.field("at"), np.int64), np.asarray(flat.field("n"), np.int64)
        inside = at + n - 1 + DEPTH <= np.diff(offsets)[text]       # the stretch may be another text's of the same id
        yield ids[lo:hi], data, offsets, text[inside], at[inside], n[inside]


def run_classes(begin: np.ndarray, count: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, ...]:
    """(run, class, first start, number of starts) of every class that a run has windows of.  A window's class is its
    anchor's place in it over ``STEP``, the last class holding the rest."""
    far, near = anchor - begin, anchor - begin - count + 1          # places of the anchor in the first and last window
    parts = []
    classes = (DEPTH - KGRAM + STEP) // STEP
    for c in range(classes):
        top = (c + 1) * STEP - 1 if c < classes - 1 else DEPTH - KGRAM
        hi, lo = np.minimum(far, top), np.maximum(near, c * STEP)
        run = np.flatnonzero(hi >= lo)
        parts.append((run, np.full(len(run), c), anchor[run] - hi[run], hi[run] - lo[run] + 1))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _class_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes of the listed runs: key = core, ctx = all bytes; of classes equal within a batch all but the first are
    resolved."""
    h = _hashers()[0]
    for batch in batches:
        parts = []
        for ids, data, offsets, text, begin, count in _listed(batch):
            if not len(text):
                continue
            prefix = h.prefix(data)
            start = begin + offsets[text]
            anchor = _anchors(prefix, DEPTH, KGRAM)[1][start]
            run, cls, at, n = run_classes(start, count, anchor)
            first = anchor[run] - cls * STEP                        # every window of the class reaches back so far
            last = np.minimum((cls + 1) * STEP - 1, DEPTH - KGRAM)  # ... and so far ahead
            mark = (cls + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            key = mix64(h.spans(prefix, first, anchor[run] - last + DEPTH) + mark)
            ctx = mix64(h.spans(prefix, at, at + n - 1 + DEPTH) + (anchor[run] - at).astype(np.uint64) * mark)
            parts.append((key, ctx, ids[text[run]], at - offsets[text[run]], n))
        if parts:
            key, ctx, doc, at, n = (np.concatenate(x) for x in zip(*parts))
            yield _rows(_first_of([key, ctx], doc, at), key, ctx, doc, at, n)


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the listed runs with 96 bits of two hashes; of windows equal within a block all but the first
    are resolved."""
    for batch in batches:
        for ids, data, offsets, text, begin, count in _listed(batch):
            ends = np.cumsum(count)
            start = np.repeat(begin - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)
            text = np.repeat(text, count)
            at = start + offsets[text]
            a, b = (h.spans(p, at, at + DEPTH) for h in _hashers() for p in [h.prefix(data)])
            doc = ids[text]
            b &= _LOW
            yield _rows(_first_of([a, b], doc, start), a, b, doc, start, np.ones(len(a), np.int64))


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows whose key is shared, and the resolved ones: one shuffle, singles go no further."""
    by_key = Window.partitionBy("key")
    return stage_table(rows.withColumn("c", F.count(F.lit(1)).over(by_key)).where("c > 1 OR n < 0").drop("c"))


def _firsts(rows: DataFrame) -> DataFrame:
    return rows.where("n > 0").groupBy("key", "ctx").agg(F.min(F.struct("doc", "at", "n")).alias("f"))


def _later(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """(doc, lo, hi): bytes of all rows that an equal row precedes."""
    done = rows.where("n < 0").select("doc", "at", F.abs("n").alias("n"))
    found = rows.where("n > 0").join(firsts, ["key", "ctx"]).where(
        (F.col("doc") != F.col("f.doc")) | (F.col("at") != F.col("f.at"))).select("doc", "at", "n")
    return done.union(found).select("doc", F.col("at").alias("lo"), (F.col("at") + F.col("n") - 1 + DEPTH).alias("hi"))


def _order_id(id_col: str):
    """The id, a null one behind all others."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, lo, hi): byte spans of repeated windows, overlapping ones not joined."""
    docs = df.select(_order_id(id_col).alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
                     ).where(F.octet_length("text") >= DEPTH)
    schema = "key long, ctx long, doc long, at long, n int"
    runs = _grouped(docs.mapInArrow(_anchor_rows, schema))
    firsts = stage_table(_firsts(runs))
    classes = _grouped(_with_company(docs, firsts).mapInArrow(_class_rows, schema))
    class_firsts = stage_table(_firsts(classes))
    windows = _grouped(_with_company(docs, class_firsts).mapInArrow(_window_rows, schema))
    return _later(runs, firsts).union(_later(classes, class_firsts)).union(_later(windows, _firsts(windows)))


def _with_company(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(doc, text, runs): the texts of first rows whose key others share, with the stretches in question."""
    shared = firsts.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    left = stage_table(firsts.join(shared, "key").groupBy(F.col("f.doc").alias("doc")).agg(
        F.collect_set(F.struct(F.col("f.at").alias("at"), F.col("f.n").alias("n"))).alias("runs")))
    texts = docs.join(sized_broadcast(left.select("doc")), "doc", "left_semi").join(left, "doc")
    return texts.select("doc", "text", "runs")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for batch in batches:
        rows = []
        for lo, hi, data, offsets in utf8_blocks(batch.column(1)):
            for row in range(lo, hi):
                text = data[offsets[row - lo]:offsets[row - lo + 1]]
                spans = batch.column(2)[row].values
                a = np.minimum(np.asarray(spans.field("lo"), np.int64), len(text))
                b = np.minimum(np.asarray(spans.field("hi"), np.int64), len(text))
                depth = np.bincount(a, minlength=len(text) + 1) - np.bincount(b, minlength=len(text) + 1)
                gone = np.cumsum(depth[:len(text)]) > 0
                edges = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                rows.append((len(text), int(gone.sum()), edges, hashlib.sha256(text[~gone].tobytes()).hexdigest()))
        columns = list(zip(*rows)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]),
                                          pa.array(columns[3], pa.string())], names=names)


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256), one row per input row.

    Null counts as empty; texts below ``DEPTH`` bytes lose nothing.  A null id is one that sorts last.  Rows
    repeated with the same id and text are one document; of rows that share an id but not a text, each loses the
    positions found repeated in any of them.  Ids are integers.  Other columns are not read; an empty table gives an
    empty result.
    """
    spans = stage_table(repeated_spans(df, id_col, text_col).groupBy("doc").agg(
        F.collect_set(F.struct("lo", "hi")).alias("spans")))
    rows = df.select(F.col(id_col).alias("id"), _order_id(id_col).alias("place"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    named = sized_broadcast(spans.select("doc"))
    touched = rows.join(named, F.col("place") == F.col("doc"), "left_semi").join(spans, F.col("place") == F.col("doc"))
    cut = touched.select("id", "text", "spans").mapInArrow(
        _cut, f"id {dict(df.dtypes)[id_col]}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    whole = rows.join(named, F.col("place") == F.col("doc"), "left_anti").select(
        "id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"))
    return cut.unionByName(whole).withColumnRenamed("id", id_col)


def op9_radix_suffixes(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
