"""Catalogue text -> tokens -> TF-IDF and TextRank keyword weights.

Vocabulary and IDF are plain grouped aggregates over exploded tokens (the
SQL twin of CountVectorizer/IDF).  TextRank counts every document's
co-occurrence pairs and runs the fixed number of PageRank iterations on its
graph (bounded by the document's own length) in a ``mapInArrow``; the edge
table alone is counted the same way.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelcast import config as C
from reelcast.functions import columns as X
from reelcast.functions import text as TX


# ---------------------------------------------------------------- catalogue
def clean_catalog(df: DataFrame, ch: C.Channels = C.DEFAULT_CHANNELS, title="title", channel="cid",
                  required: list[str] | None = None) -> DataFrame:
    """Per-channel title rules on ``lower(trim(title))``; film and series rows
    with any null in the kept columns are dropped, other channels pass."""
    t = X.norm_title(title)
    film_drop = (X.last2(t).isin(*C.FILM_SUFFIX_DENY_CATALOG) | X.first_fourth(t).isin(*C.CHAR_PAIR_DENY)
                 | t.contains(C.BOOK_MARK))
    series_drop = (X.last2(t).isin(*C.SERIES_SUFFIX_DENY) | t.contains(C.BOOK_MARK)
                   | (F.substring(t, 1, 4) == C.TEST_PREFIX))
    cid = F.col(channel)
    is_film, is_series = cid == F.lit(ch.film), cid == F.lit(ch.series)
    drop = F.when(is_film, film_drop).when(is_series, series_drop).otherwise(F.lit(False))
    cols = required or df.columns
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(c).isNotNull()
    ruled = F.coalesce(is_film | is_series, F.lit(False))
    return df.where(~F.coalesce(drop, F.lit(False)) & (~ruled | complete))


def build_summary(df: DataFrame, parts=("title", "cate", "actor", "director", "area", "desc"),
                  keep=("id", "cid", "title", "create_time")) -> DataFrame:
    """``concat_ws(',', ...)`` of the descriptive columns (nulls skipped)."""
    have = [p for p in parts if p in df.columns]
    return df.select(*[k for k in keep if k in df.columns], F.concat_ws(",", *have).alias("summary"))


# ---------------------------------------------------------------- tokens
def cut_words(docs: DataFrame, text="summary", tokenizer=None, keep=("movie_id", "cate_id")) -> DataFrame:
    """Add ``words`` (filtered tokens of the whole text)."""
    tok = tokenizer or (lambda c: TX.tokenize_words(c))
    return docs.select(*keep, tok(F.col(text)).alias("words"))


def text_terms(docs: DataFrame, text="summary", keys=("movie_id", "cate_id"), stop_words=None) -> DataFrame:
    """Term counts straight from the text (same tokens as ``cut_words``):
    one explode of all tokens, the token rules as a filter on rows, then a
    grouped count per (document, keyword).  The outer explode keeps Spark from tokenising every text a second time in
    a filter on the array's size."""
    d = docs.select(*keys, (F.length(text) <= 2).alias("_short"), TX.token_source(text).alias("_t"))
    e = d.select(*keys, "_short", F.explode_outer("_t").alias("keyword")).where(
        TX.keep_row(F.col("_short"), F.col("keyword"), stop_words))
    return e.groupBy(*keys, "keyword").agg(F.count(F.lit(1)).alias("tf"))


def term_vocabulary(terms: DataFrame, key="movie_id") -> DataFrame:
    """CountVectorizer twin: (keyword, doc_freq, term_count) over all documents."""
    # terms hold one row per (document, keyword): a plain count is the document frequency
    return terms.groupBy("keyword").agg(F.count(F.lit(1)).alias("doc_freq"),
                                        F.sum("tf").alias("term_count"))


def fit_vocabulary(terms: DataFrame, size: int = C.VOCABULARY_SIZE, min_df: int = 1) -> DataFrame:
    """Term dictionary (keyword, doc_freq, term_count, index): the ``size`` most frequent terms that at least
    ``min_df`` documents have.  ``index`` counts from 0 by falling term count (keyword on ties); the rank is taken
    over range partitions, so no task or driver holds the dictionary."""
    from reelcast.operators.ranking import rank_all
    counts = term_vocabulary(terms).where(F.col("doc_freq") >= min_df)
    ranked = rank_all(counts, [], [F.desc("term_count"), F.asc("keyword")], "_place").where(F.col("_place") <= size)
    return ranked.select("keyword", "doc_freq", "term_count", (F.col("_place") - 1).alias("index"))


def fit_idf(terms: DataFrame, key="movie_id", vocabulary: DataFrame | None = None) -> DataFrame:
    """``idf = ln((N + 1) / (df + 1))`` (Spark ML's formula) per keyword; with a ``vocabulary`` for its terms only,
    and with their ``index``."""
    n_docs = terms.select(F.countDistinct(key)).scalar()
    # terms hold one row per (document, keyword)
    df_ = vocabulary if vocabulary is not None else terms.groupBy("keyword").agg(F.count(F.lit(1)).alias("doc_freq"))
    out = df_.withColumn("_n", n_docs)
    return out.select("keyword", *(["index"] if vocabulary is not None else []), "doc_freq",
                      F.log((F.col("_n") + 1) / (F.col("doc_freq") + 1)).alias("idf"))


def explode_tfidf(terms: DataFrame, idf: DataFrame) -> DataFrame:
    """Per document and distinct term: raw count, idf, ``round(tf*idf, 4)``, and the term's index if the idf table
    has one; terms outside the idf table's vocabulary are dropped.  The table (one row per term) is joined by key; AQE
    splits partitions of very common terms."""
    j = terms.join(idf.drop("doc_freq"), "keyword")
    return j.withColumn("tfidf", F.round(F.col("tf") * F.col("idf"), 4))


def fit_idf_by(terms: DataFrame, by: str, key="movie_id") -> DataFrame:
    """``fit_idf`` within each value of ``by`` (null is a value): a word's idf counts that group's documents only."""
    n = terms.groupBy(F.col(by).alias("_by")).agg(F.countDistinct(key).alias("_n"))
    df_ = terms.groupBy(by, "keyword").agg(F.count(F.lit(1)).alias("doc_freq"))
    return df_.join(n, df_[by].eqNullSafe(n["_by"])).select(
        by, "keyword", "doc_freq", F.log((F.col("_n") + 1) / (F.col("doc_freq") + 1)).alias("idf"))


def explode_tfidf_by(terms: DataFrame, idf: DataFrame, by: str) -> DataFrame:
    """``explode_tfidf`` with an idf table per value of ``by``."""
    i = idf.select(F.col(by).alias("_by"), F.col("keyword").alias("_kw"), "idf")
    j = terms.join(i, (terms["keyword"] == i["_kw"]) & terms[by].eqNullSafe(i["_by"])).drop("_by", "_kw")
    return j.withColumn("tfidf", F.round(F.col("tf") * F.col("idf"), 4))


# ---------------------------------------------------------------- textrank
def textrank_edges(docs: DataFrame, text="summary", keys=("movie_id", "cate_id"), span=C.TEXTRANK_SPAN,
                   min_len=C.TEXTRANK_MIN_LEN, stop_words=None) -> DataFrame:
    """Undirected co-occurrence edges of every document.

    Pairs are taken within ``span`` positions of the raw token sequence;
    both words must pass the token rules and be at least ``min_len`` long.
    Each pair occurrence adds weight 1 in both directions."""
    key_names = list(keys)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # rows that share their keys count as one document: texts that do are brought together, no edge is moved
    met = docs.select(*key_names, text).repartition(n, *key_names).sortWithinPartitions(*key_names)
    d = met.select(*key_names, _kept_tokens(text, min_len, stop_words).alias("_k"))
    schema = T.StructType([T.StructField(k, docs.schema[k].dataType) for k in key_names]
                          + [T.StructField("a", T.StringType()), T.StructField("b", T.StringType()),
                             T.StructField("w", T.DoubleType())])
    return d.mapInArrow(_edge_docs(span, key_names), schema)


def _kept_tokens(text, min_len: int, stop_words) -> Column:
    """Token sequence with the positions that no edge may use as nulls, so that distances follow the raw text."""
    return F.transform(TX.raw_tokens(F.col(text)),
                       lambda t: F.when(TX.keep_token(t, stop_words) & (F.length(t) >= min_len), t))


def _numbered(toks) -> tuple[np.ndarray, np.ndarray]:
    """(number of each position's word or -1, words in order of first appearance)."""
    number: dict = {None: -1}
    ids = np.array([number.setdefault(t, len(number) - 1) for t in toks], np.int64)
    del number[None]
    return ids, np.array(list(number), dtype=object)


def _pair_counts(ids: np.ndarray, n: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, count) of one document's pairs of ``n`` words within ``span`` positions, both directions, by a and b."""
    parts = [np.empty(0, np.int64)]
    for o in range(1, min(span, len(ids))):
        a, b = ids[:-o], ids[o:]
        m = (a >= 0) & (b >= 0)
        parts += [a[m] * n + b[m], b[m] * n + a[m]]
    key, w = np.unique(np.concatenate(parts), return_counts=True)
    return key // max(n, 1), key % max(n, 1), w.astype("float64")


EDGE_ROWS = 200_000         # edges that leave the task in one frame


def _edge_docs(span: int, key_names: list[str]):
    """Edges of every document of a partition that is sorted by the keys, in frames of about ``EDGE_ROWS``."""
    def edges(keys, rows):
        coded = pa.concat_arrays(rows).dictionary_encode()
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        place, n = np.empty(len(coded.dictionary), np.int64), len(coded.dictionary)
        ids, words = _numbered_codes(codes, place)
        if len(rows) > 1:                                   # no pair reaches from one text into the next
            ends = np.cumsum([len(r) for r in rows])[:-1]
            ids = np.insert(ids, np.repeat(ends, span), -1)
        a, b, w = _pair_counts(ids, len(words), span)
        words = coded.dictionary.take(pa.array(words))
        for at in range(0, len(w), EDGE_ROWS):
            cut = slice(at, at + EDGE_ROWS)
            yield keys, words.take(pa.array(a[cut])), words.take(pa.array(b[cut])), pa.array(w[cut])

    def frame(held):
        key = [pa.concat_arrays([pa.concat_arrays([k[i]]).take(pa.array(np.zeros(len(w), np.int64))) for k, _, _, w in held])
               for i in range(len(key_names))]
        return pa.RecordBatch.from_arrays([*key, *(pa.concat_arrays([h[i] for h in held]) for i in (1, 2, 3))],
                                          [*key_names, "a", "b", "w"])

    def documents(it):
        """(keys as arrays of one value, tokens of each of the document's texts)."""
        now, held, rows = None, None, []
        for batch in it:
            tokens, cols = batch.column("_k"), [batch.column(k) for k in key_names]
            values = list(zip(*(c.to_pylist() for c in cols)))
            for i, value in enumerate(values):
                if held is None or value != now:
                    if rows:
                        yield held, rows
                    now, held, rows = value, [c.slice(i, 1) for c in cols], []
                if tokens[i].is_valid:
                    rows.append(tokens[i].values)
        if rows:
            yield held, rows

    def run(it):
        held, n = [], 0
        for keys, rows in documents(it):
            for some in edges(keys, rows):
                held.append(some)
                n += len(some[3])
                if n >= EDGE_ROWS:
                    yield frame(held)
                    held, n = [], 0
        if held:
            yield frame(held)
    return run


SUMMED_TOKENS = 1_000_000   # tokens whose pairs are counted together, about


def pair_counts(docs: DataFrame, text="summary", span=C.TEXTRANK_SPAN, min_len=C.TEXTRANK_MIN_LEN, stop_words=None) -> DataFrame:
    """(a, b, w) with a < b: the edges of :func:`textrank_edges` summed over the documents of each frame, so that what
    is summed over all documents afterwards has fewer rows than documents have edges."""
    def count(flat, row):
        coded = flat.dictionary_encode()
        words = coded.dictionary
        by = pc.array_sort_indices(words).to_numpy()            # strings are ordered by their bytes, as Spark does
        place = np.empty(len(by) + 1, np.int64)
        place[by], place[-1] = np.arange(len(by)), -1
        ids = place[coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)]
        keys, n = [np.empty(0, np.int64)], max(len(by), 1)
        for o in range(1, min(span, len(ids))):
            x, y = ids[:-o], ids[o:]
            m = (x >= 0) & (y >= 0) & (x != y) & (row[:-o] == row[o:])
            keys.append(np.minimum(x[m], y[m]) * n + np.maximum(x[m], y[m]))
        key, w = np.unique(np.concatenate(keys), return_counts=True)
        words = words.take(pa.array(by))
        for at in range(0, len(key), EDGE_ROWS):
            cut = slice(at, at + EDGE_ROWS)
            yield pa.RecordBatch.from_arrays([words.take(pa.array(key[cut] // n)), words.take(pa.array(key[cut] % n)),
                                              pa.array(w[cut].astype("float64"))], ["a", "b", "w"])

    def run(it):
        held, n = [], 0
        for batch in it:
            tokens = batch.column("_k")
            lengths = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat, row = tokens.flatten(), np.repeat(np.arange(len(lengths)), lengths)
            held.append((flat, row))
            n += len(flat)
            if n >= SUMMED_TOKENS:
                yield from frame(held)
                held, n = [], 0
        if n:
            yield from frame(held)

    def frame(held):
        rows, before = [], 0
        for _, row in held:
            rows.append(row + before)
            before += row.max(initial=-1) + 1
        return count(pa.concat_arrays([flat for flat, _ in held]), np.concatenate(rows))

    d = docs.select(_kept_tokens(text, min_len, stop_words).alias("_k"))
    return d.mapInArrow(run, "a string, b string, w double")


def _pagerank_group(damping: float, iterations: int, key_names: list[str]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a_idx, words = pd.factorize(pdf["a"])
        b_idx = pd.Index(words).get_indexer(pdf["b"])
        w = pdf["w"].to_numpy(dtype="float64")
        n = len(words)
        out = np.bincount(a_idx, weights=w, minlength=n)
        coef = w / out[b_idx]
        ws = np.full(n, 1.0 / n)
        for _ in range(iterations):
            ws = (1.0 - damping) + damping * np.bincount(a_idx, weights=coef * ws[b_idx], minlength=n)
        lo, hi = ws.min(), ws.max()
        ws = (ws - lo / 10.0) / (hi - lo / 10.0)
        res = pd.DataFrame({"tag": np.asarray(words, dtype=object), "textrank": ws})
        for k in key_names:
            res.insert(0, k, pdf[k].iloc[0])
        return res
    return run


def _numbered_codes(codes: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each position's word or -1, codes in order of first appearance) of word codes (-1: no word).  ``place`` has room for every code and is overwritten."""
    at = np.flatnonzero(codes >= 0)
    c, i = codes[at], np.arange(len(at))
    place[c[::-1]] = i[::-1]                # of a word's places the first is written last
    first = place[c]
    new = first == i
    ids = np.full(len(codes), -1, np.int64)
    ids[at] = (np.cumsum(new) - 1)[first]
    return ids, c[new]


def _ranker(span: int, damping: float, iterations: int):
    """Scaled TextRank of one document: (numbers of the words that have edges, their ranks)."""
    def one(ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        a_idx, b_idx, w = _pair_counts(ids, n, span)
        if not len(w):
            return np.empty(0, np.int64), np.empty(0)
        nodes = np.unique(a_idx)
        out = np.bincount(a_idx, weights=w, minlength=n)
        coef = w / out[b_idx]
        ws = np.zeros(n)
        ws[nodes] = 1.0 / len(nodes)
        for _ in range(iterations):
            ws = (1.0 - damping) + damping * np.bincount(a_idx, weights=coef * ws[b_idx], minlength=n)
        ws = ws[nodes]
        lo, hi = ws.min(), ws.max()
        return nodes, (ws - lo / 10.0) / (hi - lo / 10.0)
    return one


def _textrank_docs(span: int, damping: float, iterations: int, key_names: list[str]):
    one = _ranker(span, damping, iterations)

    def table(batch, words, held):
        rows = pa.array(np.repeat([i for i, *_ in held], [len(ws) for *_, ws in held]))
        tags = words.take(pa.array(np.concatenate([codes for _, codes, _ in held])))
        ranks = pa.array(np.concatenate([ws for *_, ws in held]))
        return pa.RecordBatch.from_arrays([*(batch.column(k).take(rows) for k in key_names), tags, ranks],
                                          [*key_names, "tag", "textrank"])

    def run(it):
        for batch in it:
            tokens = batch.column("_k")
            coded = tokens.values.dictionary_encode()
            codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            place, ends = np.empty(len(coded.dictionary), np.int64), tokens.offsets.to_numpy()
            held, rows = [], 0
            for i, has in enumerate(tokens.is_valid().to_pylist()):
                if not has:
                    continue
                ids, words = _numbered_codes(codes[ends[i]:ends[i + 1]], place)
                nodes, ws = one(ids, len(words))
                if len(ws):
                    held.append((i, words[nodes], ws))
                    rows += len(ws)
                if rows >= EDGE_ROWS:
                    yield table(batch, coded.dictionary, held)
                    held, rows = [], 0
            if held:
                yield table(batch, coded.dictionary, held)
    return run


def textrank_documents(docs: DataFrame, text="summary", keys=("movie_id", "cate_id"), span=C.TEXTRANK_SPAN,
                       min_len=C.TEXTRANK_MIN_LEN, damping=C.TEXTRANK_DAMPING, iterations=C.TEXTRANK_ITERATIONS,
                       stop_words=None, digits=6) -> DataFrame:
    """TextRank per document without a shuffle.

    Tokens and the keep rules are evaluated in the JVM; every document's
    token array (non-kept positions null, so distances follow the raw
    sequence) goes through one ``mapInArrow`` that counts the
    co-occurrence pairs within ``span`` (both directions) and runs the
    weighted PageRank; words stay Arrow's, the loop has their codes; same
    numbers as :func:`textrank_edges` + :func:`textrank_keywords`."""
    key_names = list(keys)
    d = docs.select(*key_names, _kept_tokens(text, min_len, stop_words).alias("_k"))
    schema = T.StructType([T.StructField(k, docs.schema[k].dataType) for k in key_names]
                          + [T.StructField("tag", T.StringType()), T.StructField("textrank", T.DoubleType())])
    out = d.mapInArrow(_textrank_docs(span, damping, iterations, key_names), schema)
    return out.withColumn("textrank", F.round("textrank", digits))


# ---------------------------------------------------------------- both factors at once
PART_TERMS = 1_000_000      # (document, word) rows of one part, about


def part_count(terms: DataFrame) -> int:
    """Number of parts the documents are dealt out in: a multiple of ``spark.sql.shuffle.partitions``, so that terms
    which were laid out by item lie part by part already."""
    n = int(terms.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return n * max(1, -(-terms.count() // (n * PART_TERMS)))


def part_of(key: str, parts: int) -> Column:
    return F.pmod(F.hash(key), F.lit(parts)).alias("part")


def part_words(terms: DataFrame, idf: DataFrame, parts: int, key="movie_id") -> DataFrame:
    """(part, keyword, idf): the words that the documents of a part have, once a part instead of once a document."""
    return terms.select(part_of(key, parts), "keyword").distinct().join(idf.select("keyword", "idf"), "keyword").select(
        "part", "keyword", "idf")


def _near_top(item: np.ndarray, weight: np.ndarray, k: int, margin: float) -> np.ndarray:
    """Whether a row can be among the ``k`` heaviest of its item when weights are off by half of ``margin``."""
    order = np.lexsort((-weight, item))
    sorted_items = item[order]
    last = np.arange(len(order)) - np.searchsorted(sorted_items, sorted_items) == k - 1
    least = np.full(item.max(initial=-1) + 1, -np.inf)
    least[sorted_items[last]] = weight[order][last]
    return weight >= least[item] - margin


def _numbers(values: pa.ChunkedArray) -> np.ndarray:
    """A number for each different value, -1 for null."""
    return values.combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def _one_array(values: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], values.type)


def _part_factors(span: int, damping: float, iterations: int, min_len: int, keys: list[str], keep: int | None):
    one = _ranker(span, damping, iterations)

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        tokens, words = _one_array(docs["_k"]), _one_array(known["keyword"])
        lengths = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        coded = tokens.flatten().dictionary_encode()
        codes = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        n = max(len(coded.dictionary), 1)
        long_enough = np.append(pc.greater_equal(pc.utf8_length(coded.dictionary), min_len).to_numpy(zero_copy_only=False), False)
        ranked = np.where(long_enough[codes], codes, -1)
        ends, place, held = np.concatenate([[0], np.cumsum(lengths)]), np.empty(n, np.int64), []
        for i in range(len(lengths)):
            ids, at = _numbered_codes(ranked[ends[i]:ends[i + 1]], place)
            nodes, ws = one(ids, len(at))
            held.append((np.full(len(ws), i), at[nodes], ws))
        row, code, rank = (np.concatenate(x) for x in zip(*held)) if held else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        # rows that share all their keys count as one document; one that shares the item only meets all of the item's
        item = _numbers(docs[keys[0]])
        each = np.stack([item, *(_numbers(docs[k]) for k in keys[1:])], axis=1)
        group, group_of = np.unique(each, axis=0, return_inverse=True) if len(each) else (each, np.empty(0, np.int64))
        seen = codes >= 0
        pairs, tf = np.unique(np.repeat(group_of.reshape(-1), lengths)[seen] * n + codes[seen], return_counts=True)
        first = np.searchsorted(group[:, 0], item[row])
        many = np.searchsorted(group[:, 0], item[row], side="right") - first
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        wanted = (np.repeat(first, many) + nth) * n + np.repeat(code, many)
        row, code, rank = np.repeat(row, many), np.repeat(code, many), np.repeat(rank, many)
        at = np.searchsorted(pairs, wanted).clip(max=max(len(pairs) - 1, 0))
        known_at = pc.index_in(coded.dictionary, value_set=words).fill_null(-1).to_numpy(zero_copy_only=False)
        known_at = np.append(known_at, -1)[code]
        met = (known_at >= 0) & (item[row] >= 0)
        met[met] &= pairs[at[met]] == wanted[met]
        row, code, rank, known_at, count = row[met], code[met], rank[met], known_at[met], tf[at[met]]
        idf = known["idf"].to_numpy()[known_at] if len(words) else np.empty(0)
        if keep and len(row):
            # ranks are rounded later on, so rows a little below the last place stay as well
            some = (_near_top(item[row], rank * idf, keep, 1e-3)
                    | _near_top(item[row], (rank + count * idf) / 2, keep, 1e-3))
            row, code, rank, idf, count = row[some], code[some], rank[some], idf[some], count[some]
        out = {k: _one_array(docs[k]).take(pa.array(row, pa.int64())) for k in keys}
        return pa.table(out | {"keyword": coded.dictionary.take(pa.array(code, pa.int64())), "textrank": pa.array(rank, pa.float64()),
                               "tf": pa.array(count, pa.int64()), "idf": pa.array(idf, pa.float64())})
    return run


def document_factors(docs: DataFrame, words: DataFrame, text="summary", keys=("movie_id", "cate_id"),
                     span=C.TEXTRANK_SPAN, min_len=C.TEXTRANK_MIN_LEN, damping=C.TEXTRANK_DAMPING,
                     iterations=C.TEXTRANK_ITERATIONS, stop_words=None, digits=6, keep: int | None = None) -> DataFrame:
    """(keys..., keyword, textrank, idf, tfidf): :func:`textrank_documents` met with :func:`explode_tfidf` on (item,
    keyword), where the document is.

    ``docs`` have their ``part``; ``words`` are those of :func:`part_words`.  A document's words get their idf in the
    task that counts and ranks them, so only texts and a part's different words are moved, no (document, word) row.
    With ``keep`` rows that can't be among the item's ``keep`` heaviest by either keyword weight stay in the task."""
    s = F.col(text)
    kept = F.when(F.length(s) <= 2, F.array(s)).otherwise(
        F.transform(TX.raw_tokens(s), lambda t: F.when(TX.keep_token(t, stop_words), t)))
    d = docs.select(*keys, "part", kept.alias("_k"))
    schema = T.StructType([T.StructField(k, docs.schema[k].dataType) for k in keys] + [
        T.StructField("keyword", T.StringType()), T.StructField("textrank", T.DoubleType()),
        T.StructField("tf", T.LongType()), T.StructField("idf", T.DoubleType())])
    met = d.groupBy("part").cogroup(words.groupBy("part")).applyInArrow(
        _part_factors(span, damping, iterations, min_len, list(keys), keep), schema)
    return met.select(*keys, "keyword", F.round("textrank", digits).alias("textrank"), "idf",
                      F.round(F.col("tf") * F.col("idf"), 4).alias("tfidf"))


def textrank_keywords(edges: DataFrame, keys=("movie_id", "cate_id"), damping=C.TEXTRANK_DAMPING,
                      iterations=C.TEXTRANK_ITERATIONS, digits=6) -> DataFrame:
    """Weighted PageRank on each document's word graph, scaled per document
    by ``(w - min/10) / (max - min/10)``; (keys..., tag, textrank)."""
    key_names = list(keys)
    fields = [edges.schema[k] for k in key_names]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields]
                          + [T.StructField("tag", T.StringType()), T.StructField("textrank", T.DoubleType())])
    ranked = edges.groupBy(*key_names).applyInPandas(_pagerank_group(damping, iterations, key_names), schema)
    return ranked.withColumn("textrank", F.round("textrank", digits))


def topk_by(df: DataFrame, part: list[str], value: str, k: int, tie: str, name="sort_num") -> DataFrame:
    """Top-K per group by ``value`` desc, ``tie`` asc (planned as WindowGroupLimit)."""
    from pyspark.sql.window import Window
    w = Window.partitionBy(*part).orderBy(F.desc(value), F.asc(tie))
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def tokens_column(words: Column) -> Column:
    """Tokens as one space-joined string (flat column for comparisons)."""
    return F.array_join(words, " ")
