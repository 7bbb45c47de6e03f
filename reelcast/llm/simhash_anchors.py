"""SimHash near-dedup by anchor-point covering.

Fingerprints link at ``MAX_BITS`` = 3 or fewer differing bits, so one of their two halves differs in at most one bit.
Anchors of a half are the 2**26 codewords of the perfect Hamming code of length 31 (the half's top bit is no part of
it): every value lies within the covering radius 1 of exactly one anchor, its home.  A fingerprint is replicated to
every anchor within covering radius plus threshold, 1 + 1, of each half: 16 anchors, or 1 where the value is an anchor.
If x and y differ in at most one bit of a half, y reaches x's home, so comparing, anchor by anchor, the fingerprints at
home with those replicated to it finds every link.

1. Fingerprints are computed where the texts are; only (id, fingerprint) leaves the scan.  Equal fingerprints are one
   class before anything is replicated.
2. Anchors with more than ``BLOCK_ROWS`` rows are split into blocks of home rows times replicated rows, so a group of
   near copies never meets in one task.
3. A block emits a spanning forest of its links instead of all pairs; components follow from all forests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcast.llm.common import sized_broadcast, small_batches, stage_table
from reelcast.llm.components import connected_components

WIDTH = 3
SEED = 42
MAX_BITS = 3
CODE_BITS = 31              # length of the Hamming code; its positions count from 1
BLOCK_ROWS = 1 << 14
PIECE_BYTES = 1 << 22       # a longer text is cut at white space and taken piece by piece

_ONE = np.uint64(1)
_CODE = np.uint64((1 << CODE_BITS) - 1)
_HALF = np.uint64(32)
_CHECKS = [np.uint64(sum(1 << (p - 1) for p in range(1, CODE_BITS + 1) if p >> b & 1)) for b in range(5)]


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in pieces; every piece but the first begins with the last words of the one before."""
    at, tail = 0, []
    while at < len(data):
        end = at + PIECE_BYTES
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        words = tail + data[at:end].lower().split()
        yield words
        tail, at = words[-(WIDTH - 1):], end


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of every ``WIDTH``-word shingle."""
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    line, h = b" ".join(words), xxhash.xxh64_intdigest
    return np.array([h(line[a:b], SEED) for a, b in zip(starts, ends[WIDTH - 1:].tolist())], np.uint64)


def fingerprint(data: bytes) -> int:
    """A bit is set if it is set in over half of the hashes; 0 without words."""
    n, counts, short = 0, np.zeros(64, np.int64), []
    for words in _pieces(data):
        if len(words) < WIDTH:
            short = words
            continue
        hashes = shingle_hashes(words)
        n += len(hashes)
        for lo in range(0, len(hashes), 1 << 16):
            raw = hashes[lo:lo + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    if not n:
        return xxhash.xxh64_intdigest(b" ".join(short), SEED) if short else 0
    return int((_ONE << np.arange(64, dtype=np.uint64))[2 * counts > n].sum(dtype=np.uint64))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the 64-bit fingerprint (as a signed integer) of every row; null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).cast(pa.large_binary())
            fps = np.array([fingerprint(t.as_py() or b"") for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    kind = df.schema[id_col].dataType.simpleString()
    return small_batches(df).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {kind}, fp long")


def syndromes(values: np.ndarray) -> np.ndarray:
    """Position (1 to 31) of the bit that separates each value from its home anchor, 0 if it is an anchor."""
    return sum((np.bitwise_count(values & mask).astype(np.int64) & 1) << b for b, mask in enumerate(_CHECKS))


def home_anchors(values: np.ndarray) -> np.ndarray:
    s = syndromes(values)
    return values ^ np.where(s > 0, _ONE << np.maximum(s - 1, 0).astype(np.uint64), np.uint64(0))


def near_anchors(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the value, anchor): every anchor within two bits of each value."""
    s = syndromes(values)
    rows, anchors = [np.arange(len(values))], [home_anchors(values)]
    for p in range(1, CODE_BITS + 1):
        q = s ^ p                            # flipping positions p and q cancels the syndrome
        hit = np.flatnonzero((s > 0) & (q > p))
        rows.append(hit)
        anchors.append(values[hit] ^ (_ONE << np.uint64(p - 1)) ^ (_ONE << (q[hit] - 1).astype(np.uint64)))
    return np.concatenate(rows), np.concatenate(anchors)


def _halves(fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(mark of the half, its bits that the code covers)."""
    for half in (0, 1):
        yield np.uint64(half) << _HALF, (fps >> (_HALF * np.uint64(half))) & _CODE


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for mark, values in _halves(fps):
            rows, anchors = near_anchors(values)
            for at, found, home in ((np.arange(len(fps)), home_anchors(values), True), (rows, anchors, False)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array((found | mark).view(np.int64)), pa.array(np.full(len(at), not home)),
                     pa.array(fps[at].view(np.int64))], names=["anchor", "copy", "fp"])


def forest(home: np.ndarray, copies: np.ndarray, bits: int = MAX_BITS) -> tuple[list[int], list[int]]:
    """Edges of a spanning forest of the links between two sets of fingerprints: breadth-first, every step compares
    one fingerprint with those of the other side that are not reached yet."""
    u, v = [], []
    waiting = [home, copies]
    while len(waiting[0]) and len(waiting[1]):
        queue = [(0, waiting[0][0])]
        waiting[0] = waiting[0][1:]
        while queue:
            side, x = queue.pop()
            other = waiting[1 - side]
            near = np.bitwise_count(other ^ x) <= bits
            if near.any():
                found = other[near]
                waiting[1 - side] = other[~near]
                queue.extend((1 - side, y) for y in found)
                new = found[found != x]
                u.extend([x] * len(new))
                v.extend(new)
    return u, v


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (anchor, block, copy): groups are cut at the keys, the last one of a batch goes on."""
    held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.uint64)]

    def groups(cols: list[np.ndarray], last: bool) -> tuple[list[np.ndarray], list, list]:
        key, block, copy, fps = cols
        cut = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
        bounds = np.concatenate([[0], cut, [len(key)]]) if len(key) else np.zeros(1, np.int64)
        done = len(bounds) - 1 if last else len(bounds) - 2
        before = np.concatenate([[0], np.cumsum(copy)])
        u, v = [], []
        for g in range(done):
            a, b = bounds[g], bounds[g + 1]
            n_copies = before[b] - before[a]
            if n_copies == b - a or n_copies < 2 and b - a < 3 and fps[a] == fps[b - 1]:
                continue                    # nobody at home, or nobody but itself
            more_u, more_v = forest(fps[a:b - n_copies], fps[b - n_copies:b])
            u += more_u
            v += more_v
        rest = bounds[done] if done >= 0 else 0
        return [c[rest:] for c in cols], u, v

    def out(u: list, v: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (u, v)],
                                          names=["u", "v"])

    for batch in batches:
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        cols[3] = cols[3].view(np.uint64)
        held, u, v = groups([np.concatenate(x) for x in zip(held, cols)], False)
        if u:
            yield out(u, v)
    _, u, v = groups(held, True)
    if u:
        yield out(u, v)


def links(classes: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(u, v): enough links between the distinct fingerprints in ``fp`` to connect what links connect."""
    placed = classes.select("fp").mapInArrow(_spread, "anchor long, copy boolean, fp long")
    sizes = placed.groupBy("anchor").agg(F.count_if(~F.col("copy")).alias("n_home"), F.count_if("copy").alias("n_copy"))
    blocks = lambda n: F.ceil(F.col(n) / block_rows).cast("int")
    hot = stage_table(sizes.where((F.col("n_home") > 0) & (F.greatest("n_home", "n_copy") > block_rows)).select(
        F.col("anchor").alias("hot"), blocks("n_home").alias("b_home"), blocks("n_copy").alias("b_copy")))
    rows = placed.join(sized_broadcast(hot), F.col("anchor") == F.col("hot"), "left").withColumns({
        "b_home": F.coalesce("b_home", F.lit(1)), "b_copy": F.coalesce("b_copy", F.lit(1))})
    mine = lambda n: F.pmod(F.xxhash64("fp"), F.col(n)).cast("int")
    # a home row meets every block of copies, a copy every block of home rows
    block = F.when(F.col("copy"), F.transform(F.sequence(F.lit(0), F.col("b_home") - 1),
                                              lambda i: i * F.col("b_copy") + mine("b_copy"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("b_copy") - 1), lambda j: mine("b_home") * F.col("b_copy") + j))
    one = (F.col("b_home") == 1) & (F.col("b_copy") == 1)
    dealt = rows.select("anchor", "copy", "fp", F.explode(F.when(one, F.array(F.lit(0))).otherwise(block)).alias("block"))
    key = ["anchor", "block"]
    met = dealt.select(*key, "copy", "fp").repartition(*key).sortWithinPartitions(*key, "copy")
    return met.mapInArrow(_compare, "u long, v long")


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, fingerprint, component_id), one row per input row.

    Null, empty and blank texts have the fingerprint zero and are linked like any other; a text of fewer words than a
    shingle is one shingle.  Rows that share an id each keep their fingerprint; a null id takes part, its component
    is the smallest id that it reaches, null if there is none.  Other columns are not read; an empty table gives an
    empty result.
    """
    rows = stage_table(fingerprints(df, id_col, text_col))
    classes = stage_table(rows.groupBy("fp").agg(F.min("id").alias("rep")))
    edges = stage_table(links(classes, block_rows))
    labels = connected_components(edges).select(F.col("node").alias("fp"), "label")
    linked = labels.join(classes, "fp")
    low = linked.groupBy("label").agg(F.min("rep").alias("component"))
    named = linked.join(low, "label").select(F.col("fp").alias("l_fp"), "component")
    by_class = classes.join(named, F.col("fp") == F.col("l_fp"), "left").select(
        F.col("fp").alias("c_fp"), F.coalesce("component", "rep").alias("component_id"))
    return rows.join(by_class, F.col("fp") == F.col("c_fp")).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op12_simhash_anchors(spark, sf_dir: str) -> DataFrame:
    return simhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
