"""Ranked lexical search by Block-Max MaxScore over index shards.

1. One pass counts documents and terms (N, L).
2. One pass builds the index without a shuffle: each task cuts its documents into shards of at most ``SHARD_DOCS``;
   a shard holds, for every term that some query has, a posting list in blocks of ``BLOCK`` postings, packed as
   variable-length integers, with each block's last document and largest term score.  Document frequencies are sums
   over the lists.
3. In a shard a query's lists are ordered by their largest score.  Lists whose bounds add up to less than the K-th
   best score so far are non-essential: no document that is only in them can enter.  Candidates come from the
   essential lists, window by window; the block maxima of the non-essential lists reject them before any of those
   blocks is unpacked, and what is left is completed list by list, with the bound falling at each step.
4. Some shards (about the square root of their number) are searched first; the K-th score of their merged heaps is a
   bound that all other shards start with.  The shard heaps are merged by a top-K by item.

Queries are sent to all tasks in batches of at most ``QUERY_BYTES``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelcast.llm.common import small_batches, stage_table, utf8_blocks
from reelcast.operators.ranking import top_k

TOP = 50
SHARD_DOCS = 8192
SHARD_HITS = 4_000_000      # a shard also ends when it has seen so many query words
BLOCK = 64
WINDOW = 2048
QUERY_BYTES = 32 << 20
PIECE_BYTES = 1 << 22

# fixed values: word characters are digits, letters and everything outside ASCII; A-Z are lowered
_TABLE = bytearray(b" " * 128 + bytes(range(128, 256)))
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _TABLE[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _TABLE[_c] = _c + 32
_TABLE = bytes(_TABLE)
_WORD = np.frombuffer(_TABLE, np.uint8) != 32
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def terms_of(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a long one piece by piece."""
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + PIECE_BYTES)
        end = gap.end() if gap else len(data)
        yield data[at:end].translate(_TABLE).split()
        at = end


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, all terms with repeats) of ``text``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_terms = 0
        for batch in batches:
            for _, _, data, offsets in utf8_blocks(batch.column(0)):
                if not len(data):
                    continue
                word = _WORD[data]
                start = word.copy()
                start[1:] &= ~word[:-1]
                inside = offsets[(offsets > 0) & (offsets < len(data))]
                start[inside] = word[inside]                # a text's first character is no continuation
                own = np.diff(np.concatenate([[0], np.cumsum(start)])[offsets])
                n_docs += int((own > 0).sum())
                n_terms += int(own.sum())
        yield pa.RecordBatch.from_arrays([pa.array([n_docs]), pa.array([n_terms])], names=["n_docs", "n_terms"])

    row = small_batches(docs).select("text").mapInArrow(count, "n_docs long, n_terms long").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_terms").alias("n_terms")).first()
    return row["n_docs"] or 0, row["n_terms"] or 0


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, end of each value): seven bits a byte, low ones first, the high bit set where more follow."""
    size = np.ones(len(values), np.int64)
    for bits in range(7, 63, 7):
        size += values >= 1 << bits
    ends = np.cumsum(size)
    out = np.zeros(ends[-1] if len(ends) else 0, np.uint8)
    for k in range(int(size.max(initial=0))):
        more = size > k
        out[ends[more] - size[more] + k] = (values[more] >> 7 * k & 127) | np.where(size[more] > k + 1, 128, 0)
    return out, ends


def unpack(data: np.ndarray) -> np.ndarray:
    last = data < 128
    if last.all():
        return data.astype(np.int64)
    ends = np.flatnonzero(last)
    starts = np.concatenate([[0], ends[:-1] + 1])
    out = np.zeros(len(ends), np.int64)
    for k in range(int((ends - starts).max()) + 1):
        more = starts + k <= ends
        out[more] |= (data[starts[more] + k].astype(np.int64) & 127) << 7 * k
    return out


def norms(n: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    return 50 + 50 * n * size[0] // max(size[1], 1)


def term_scores(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 20 * norm)


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value per end (in elements of ``data``)."""
    offsets = (np.concatenate([[0], ends]) * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


INDEX = "shard long, term int, n_post int, last binary, peak binary, ends binary, payload binary"


def shard_rows(shard: int, ids: list, n: np.ndarray, hits: np.ndarray, size: tuple[int, int]) -> pa.RecordBatch:
    """The lists of one shard.  ``hits`` holds term << 32 | document for every occurrence.  Term 0 is the table of the
    shard's documents: their ids, which of them are null, and their norms."""
    norm = norms(n, size)
    key, tf = np.unique(hits, return_counts=True)
    term, doc = key >> 32, key & 0xFFFFFFFF
    first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(key) else np.zeros(0, np.int64)
    list_end = np.concatenate([first[1:], [len(key)]]) if len(key) else first
    lengths = list_end - first
    place = np.arange(len(key)) - np.repeat(first, lengths)
    block_at = np.flatnonzero(place % BLOCK == 0)
    block_end = np.concatenate([block_at[1:], [len(key)]]) if len(key) else block_at
    before = np.concatenate([[0], doc[:-1]])
    before[first] = 0
    both = np.empty(2 * len(key), np.int64)
    both[0::2], both[1::2] = doc - before, tf
    payload, ends = pack(both)
    byte_end = ends[2 * block_end - 1] if len(key) else block_end
    list_byte_end = ends[2 * list_end - 1] if len(key) else list_end
    blocks = np.cumsum(-(-lengths // BLOCK))
    start_of = np.repeat(np.concatenate([[0], list_byte_end[:-1]]), -(-lengths // BLOCK)) if len(key) else byte_end
    peak = np.maximum.reduceat(term_scores(tf, norm[doc]), block_at) if len(key) else block_at
    null = np.array([i is None for i in ids], np.uint8)
    own = np.array([0 if i is None else i for i in ids], np.int64)
    lists = pa.RecordBatch.from_arrays([
        pa.array(np.full(len(first), shard, np.int64)), pa.array(term[first].astype(np.int32)),
        pa.array(lengths.astype(np.int32)), _binary((doc[block_end - 1] if len(key) else doc).astype(np.int32), blocks),
        _binary(peak.astype(np.int32), blocks), _binary((byte_end - start_of).astype(np.int32), blocks),
        _binary(payload, list_byte_end)], names=[c.split()[0] for c in INDEX.split(", ")])
    table = pa.RecordBatch.from_arrays([
        pa.array([shard], pa.int64()), pa.array([0], pa.int32()), pa.array([len(ids)], pa.int32()),
        pa.array([own.tobytes()], pa.binary()), pa.array([null.tobytes()], pa.binary()), pa.array([b""], pa.binary()),
        pa.array([norm.astype(np.int64).tobytes()], pa.binary())], names=lists.schema.names)
    return pa.Table.from_batches([table, lists]).combine_chunks().to_batches()[0]


def build_index(docs: DataFrame, vocabulary, size: tuple[int, int], shard_docs: int) -> DataFrame:
    """Index rows of (id, text); ``vocabulary`` is a broadcast map from term to its number (from 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number, shard = vocabulary.value.get, TaskContext.get().partitionId() << 32
        ids, n, hits, seen = [], [], [], 0
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).cast(pa.large_binary())
            for i, text in zip(batch.column(0).to_pylist(), texts):
                count, here = 0, []
                for words in terms_of(text.as_py() or b""):
                    count += len(words)
                    here += [t for t in map(number, words) if t]
                if not count:
                    continue
                if here:
                    hits.append(np.array(here, np.int64) << 32 | len(ids))
                    seen += len(here)
                ids.append(i)
                n.append(count)
                if len(ids) >= shard_docs or seen >= SHARD_HITS:
                    yield shard_rows(shard, ids, np.array(n), np.concatenate(hits or [np.zeros(0, np.int64)]), size)
                    ids, n, hits, seen, shard = [], [], [], 0, shard + 1
        if ids:
            yield shard_rows(shard, ids, np.array(n), np.concatenate(hits or [np.zeros(0, np.int64)]), size)

    return docs.select("id", "text").mapInArrow(run, INDEX)


class Postings:
    """One list of a shard: bounds at hand, blocks unpacked when asked for and kept."""

    def __init__(self, last: bytes, peak: bytes, ends: bytes, payload: bytes, norm: np.ndarray):
        self.last, self.peak = np.frombuffer(last, np.int32), np.frombuffer(peak, np.int32).astype(np.int64)
        self.ends, self.payload, self.norm = np.frombuffer(ends, np.int32), np.frombuffer(payload, np.uint8), norm
        self.top = int(self.peak.max())
        self.kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.all: tuple[np.ndarray, np.ndarray] | None = None
        self.unpacked = 0

    def _read(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        values = unpack(self.payload[self.ends[lo - 1] if lo else 0:self.ends[hi - 1]])
        docs = np.cumsum(values[0::2]) + (self.last[lo - 1] if lo else 0)
        self.unpacked += hi - lo
        return docs, term_scores(values[1::2], self.norm[docs])

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        if self.all is None:
            self.all = self._read(0, len(self.last))
        return self.all

    def bounds(self, docs: np.ndarray) -> np.ndarray:
        """Largest score that each document can have in the list, by its block."""
        return np.append(self.peak, 0)[np.searchsorted(self.last, docs)]

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """Score of each of the ascending ``docs``; unpacks the blocks that can hold them."""
        if self.all is None:
            needed = np.unique(np.searchsorted(self.last, docs))
            parts = []
            for b in needed[needed < len(self.last)].tolist():
                if b not in self.kept:
                    self.kept[b] = self._read(b, b + 1)
                parts.append(self.kept[b])
            if not parts:
                return np.zeros(len(docs), np.int64)
            have, score = (np.concatenate(x) for x in zip(*parts))
        else:
            have, score = self.all
        at = np.minimum(np.searchsorted(have, docs), len(have) - 1)
        return np.where(have[at] == docs, score[at], 0)


def search_shard(lists: list[tuple[int, Postings]], n_docs: int, top: int, floor: int, order: np.ndarray,
                 window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores): the ``top`` best documents with a score of at least ``floor`` and above 0, best first,
    equal scores by ``order``.  ``lists`` are (weight, postings) of the query's terms."""
    lists = sorted(lists, key=lambda x: x[0] * x[1].top)
    bound = np.cumsum([w * p.top for w, p in lists])
    best, best_scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    theta = max(floor, 1)
    for lo in range(0, n_docs, window):
        hi = min(lo + window, n_docs)
        idle = int(np.searchsorted(bound, theta))           # so many lists are non-essential: their sum is below theta
        if idle == len(lists):
            break
        total = np.zeros(hi - lo, np.int64)
        for w, p in lists[idle:]:
            docs, score = p.whole()
            a, b = np.searchsorted(docs, (lo, hi))
            total[docs[a:b] - lo] += w * score[a:b]
        at = np.flatnonzero(total)
        if idle:
            at = at[total[at] + bound[idle - 1] >= theta]
        docs, score = at + lo, total[at]
        if idle and len(docs):
            rest = [w * p.bounds(docs) for w, p in lists[:idle]]
            hope = score + sum(rest)
            for k in range(idle - 1, -1, -1):
                keep = hope >= theta
                docs, score, hope, rest = docs[keep], score[keep], hope[keep], [r[keep] for r in rest[:k + 1]]
                if not len(docs):
                    break
                true = np.zeros(len(docs), np.int64)
                some = rest[k] > 0
                true[some] = lists[k][0] * lists[k][1].scores(docs[some])
                score, hope = score + true, hope + true - rest[k]
        keep = score >= theta
        best, best_scores = np.concatenate([best, docs[keep]]), np.concatenate([best_scores, score[keep]])
        first = np.lexsort((order[best], -best_scores))[:top]
        best, best_scores = best[first], best_scores[first]
        if len(best) == top:
            theta = max(theta, int(best_scores[-1]))
    return best, best_scores


def _search(queries, weights, floors, top: int):
    def run(table: pa.Table) -> pa.Table:
        rows = {t: i for i, t in enumerate(table["term"].to_pylist())}
        cell = lambda name, i: table[name][i].as_py()
        ids, null = np.frombuffer(cell("last", rows[0]), np.int64), np.frombuffer(cell("peak", rows[0]), np.uint8)
        norm = np.frombuffer(cell("payload", rows[0]), np.int64)
        order = np.empty(len(ids), np.int64)
        order[np.lexsort((ids, null))] = np.arange(len(ids))
        weight, open_lists = weights.value, {}

        def postings(term: int) -> Postings:
            if term not in open_lists:
                i = rows[term]
                open_lists[term] = Postings(*(cell(c, i) for c in ("last", "peak", "ends", "payload")), norm)
            return open_lists[term]

        found = []
        for q, (_, terms) in enumerate(queries.value):
            lists = [(weight[t], postings(t)) for t in terms if t in rows and weight.get(t)]
            if lists:
                docs, scores = search_shard(lists, len(ids), top, floors.value.get(q, 0), order)
                found.append((np.full(len(docs), q), docs, scores))
        q, docs, scores = (np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in zip(*found)) if found \
            else (np.zeros(0, np.int64),) * 3
        return pa.table({"q": q, "doc": pa.array(ids[docs], mask=null[docs].astype(bool)), "score": scores})
    return run


def _query_batches(items: DataFrame, id_col: str, text_col: str,
                   limit: int) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Lists of (item id, distinct terms): each list is gathered on the driver and holds at most ``limit`` bytes of
    terms, or one item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_string()).cast(pa.large_binary())
            terms = [sorted({w for words in terms_of(t.as_py() or b"") for w in words}) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([sum(map(len, t)) + 16 * len(t) for t in terms], pa.int64()),
                 pa.array(terms, pa.list_(pa.binary()))], names=["item", "bytes", "terms"])

    kind = items.schema[id_col].dataType.simpleString()
    rows = items.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text")).distinct()
    found = stage_table(rows.mapInArrow(run, f"item {kind}, bytes long, terms array<binary>").where("bytes > 0"))
    n = max(1, -(-(found.agg(F.sum("bytes")).first()[0] or 0) // limit))
    while True:
        dealt = found.withColumn("batch", F.pmod(F.xxhash64("item", "terms"), F.lit(n)))
        largest = dealt.groupBy("batch").agg(F.sum("bytes").alias("b"), F.countDistinct("item", "terms").alias("c")).agg(
            F.max(F.when(F.col("c") > 1, F.col("b")))).first()[0] or 0
        if largest <= limit:
            break
        n *= 2
    for b in range(n):
        yield [(r["item"], [bytes(t) for t in r["terms"]])
               for r in dealt.where(F.col("batch") == b).select("item", "terms").collect()]


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", top: int = TOP, shard_docs: int = SHARD_DOCS,
                  query_bytes: int = QUERY_BYTES) -> DataFrame:
    """(item, rank, id, score): the ``top`` best documents of each item with a score above 0, equal scores by
    ascending id.

    Null or empty texts have no terms: such documents are not counted or found, such items find nothing.  Ids of
    documents are integers; null ids come last among equal scores.  Each row of ``docs`` is a document, so rows that
    share an id or are repeated whole are ranked on their own; rows of ``items`` that are repeated whole are one item,
    rows that share an id but not a text are ranked on their own.  Other columns are not read; empty tables give an
    empty result.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    size = corpus_size(rows)
    kind = items.schema[item_col].dataType
    results = []
    for batch in _query_batches(items, item_col, item_text_col, query_bytes):
        number = {t: i + 1 for i, t in enumerate(sorted({t for _, terms in batch for t in terms}))}
        queries = sc.broadcast([(item, [number[t] for t in terms]) for item, terms in batch])
        index = stage_table(build_index(rows, sc.broadcast(number), size, shard_docs))
        counted = index.where("term > 0").groupBy("term").agg(F.sum("n_post").alias("df")).withColumn(
            "w", F.floor(1000 * F.log((F.lit(2.0) * size[0] + 2) / (2 * F.col("df") + 1))))
        weights = sc.broadcast({r["term"]: r["w"] for r in counted.select("term", "w").collect()})   # batch's terms
        n_shards = index.where("term = 0").count()
        dealt = index.repartition(max(1, min(n_shards, 20_000)), "shard")
        seed = F.pmod(F.xxhash64("shard"), F.lit(max(n_shards, 1))) < int(np.ceil(np.sqrt(n_shards)))
        heap = "q long, doc long, score long"
        early = stage_table(dealt.where(seed).groupBy("shard").applyInArrow(
            _search(queries, weights, sc.broadcast({}), top), heap))
        order = [F.desc("score"), F.asc_nulls_last("doc")]
        floors = top_k(early, ["q"], order, top, "rank").where(F.col("rank") == top).select("q", "score").collect()
        late = dealt.where(~seed).groupBy("shard").applyInArrow(
            _search(queries, weights, sc.broadcast({r["q"]: r["score"] for r in floors}), top), heap)
        best = top_k(early.unionByName(late), ["q"], order, top, "rank")
        names = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(batch)],
                                      f"q long, item {kind.simpleString()}")
        results.append(best.join(F.broadcast(names), "q").select(
            F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(id_col), "score"))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def op13_block_max_search(spark, sf_dir: str) -> DataFrame:
    return ranked_search(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                         spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, {_TERMS} AS t FROM documents WHERE text IS NOT NULL),
size AS (SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
tf AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY doc_id, n, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, size GROUP BY term, n_docs),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms)))))
    AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), size GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id,
    score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= {TOP}
"""
