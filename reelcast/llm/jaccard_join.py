"""N-gram Jaccard join with adaptive multi-match prefixes, and the components of its links.

Order all shingles by corpus frequency (a fixed-size count sketch over every document), rarest first.  If two sets
reach the threshold, the first ``n - ceil(t * n) + k`` shingles of both share at least k.  Each document chooses its
own k: a longer prefix costs more postings, but a pair must then share more of it before it is verified; the choice
minimises (shingles sent) + (postings read) + (expected candidates) x (set size), with the sketch's counts as
estimates.  A pair is a candidate when it shares ``min(k_x, k_y)`` prefix shingles and the shared part plus the longer
rest can still reach the threshold.  What a pair must share is known from both sizes, so only the first shingles of
each prefix are looked up, as many as a pair that shares less cannot do without; and a pair that has one of its first
``len(HEADS)`` open shingles in common is taken there only, not again at each of its later common shingles.

Documents with equal sets are one class before the join.  Large groups of near copies are not expanded into all
pairs: some rounds link each class only to one class of each posting list (the busiest first) and merge what links; then every
candidate pair between *different* components is verified, so no link between components is missed.
``jaccard_links`` and ``jaccard_join`` verify the candidate pairs inside components too and return every link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelcast.llm.common import i64, lean, settled, sized_broadcast, small_batches, stage_table, sum_vectors
from reelcast.llm.components import connected_components
from reelcast.llm.shingles import text_shingles

NUM, DEN = 75, 100              # threshold as a fraction: links have NUM * union <= DEN * intersection
SKETCH_BITS = 19                # counters of the frequency sketch: a fixed 4 MB, however many shingles there are
SKETCH_PART = 1 << 13
MAX_MATCHES = 8                 # largest k
POSTING_COST, VERIFY_COST = 1.0, 0.05
HUB_ROUNDS = 2
HEADS = ["h0", "h1", "h2"]      # first open shingles of a class, kept beside each of its postings


def _sketch(docs: DataFrame) -> np.ndarray:
    """Counts of all shingles of all documents, by the low bits of their hash."""
    size, parts = 1 << SKETCH_BITS, (1 << SKETCH_BITS) // SKETCH_PART

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for _, hashes in text_shingles(batch.column(0)):
                if len(hashes):
                    np.add.at(counts, (hashes & np.uint64(size - 1)).astype(np.int64), 1)
        if counts.any():
            task = TaskContext.get().partitionId() % 64
            rows = [counts[i * SKETCH_PART:(i + 1) * SKETCH_PART].tobytes() for i in range(parts)]
            yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array([task] * parts, pa.int32()),
                                              pa.array(rows, pa.binary())], names=["part", "task", "counts"])

    counted = small_batches(docs.select("text")).mapInArrow(lean(count), "part int, task int, counts binary")
    rows = sum_vectors(counted, "part", "int").collect()       # a fixed number of rows, 4 MB in all
    out = np.zeros(size, np.int64)
    for r in rows:
        out[r["part"] * SKETCH_PART:(r["part"] + 1) * SKETCH_PART] = np.frombuffer(r["counts"], np.int64)
    return out


def choose_prefix(estimates: np.ndarray, n: int) -> tuple[int, int]:
    """(k, prefix length) of a set of ``n`` shingles whose estimated frequencies come in ascending order."""
    base = n - -(-NUM * n // DEN) + 1
    most = min(MAX_MATCHES, n - base + 1)
    lengths = base + np.arange(most)
    lists = np.cumsum(estimates[:lengths[-1]])[lengths - 1]
    k = np.arange(1, most + 1)
    best = int(np.argmin(lists * (POSTING_COST + VERIFY_COST * n / k) + lengths))
    return best + 1, int(lengths[best])


def _prefixes(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """(id, n, s1, s2, k, prefix): set size, signature of the set, and the chosen prefix of every document."""
    spark = docs.sparkSession
    mean = counts.mean()
    shared = spark.sparkContext.broadcast(np.maximum(counts - mean - 3 * np.sqrt(mean) - 1, 0).astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        estimate = shared.value
        low = np.uint64(len(estimate) - 1)
        for batch in batches:
            n, s1, s2, ks, prefixes = [], [], [], [], []
            for _, h in text_shingles(batch.column(1)):
                n.append(len(h))
                s1.append(int(h.sum(dtype=np.uint64).view(np.int64)))
                s2.append(int(np.bitwise_xor.reduce(h * h | np.uint64(1)).view(np.int64)) if len(h) else 0)
                if not len(h):
                    ks.append(0)
                    prefixes.append(h)
                    continue
                e = estimate[(h & low).astype(np.int64)]
                order = np.argsort(e, kind="stable")       # ties by hash: one order for all documents
                k, length = choose_prefix(e[order], len(h))
                ks.append(k)
                prefixes.append(h[order[:length]])
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            flat = i64(np.concatenate(prefixes) if prefixes else np.zeros(0, np.uint64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 pa.array(ks, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), flat)],
                names=["id", "n", "s1", "s2", "k", "prefix"])

    return small_batches(docs.select("id", "text")).mapInArrow(
        lean(run), "id long, n long, s1 long, s2 long, k int, prefix array<long>")


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(rep, set) of the documents named in ``ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [h.tobytes() for _, h in text_shingles(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.large_binary()).cast(pa.binary())],
                                             names=["rep", "set"])

    chosen = docs.join(sized_broadcast(ids.select(F.col("rep").alias("id"))), "id", "left_semi")
    return chosen.select("id", "text").mapInArrow(lean(run), "rep long, set binary").dropDuplicates(["rep"])


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column(2), batch.column(3)
        common = [len(np.intersect1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64),
                                     assume_unique=True)) for x, y in zip(a, b)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(common, pa.int64())],
                                         names=["u", "v", "common"])


def _verify(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (u, v, n_u, n_v) that reach the threshold on their whole sets."""
    ids = pairs.select(F.col("u").alias("rep")).union(pairs.select(F.col("v").alias("rep"))).distinct()
    sets = stage_table(_sets(docs, ids))
    with_u = pairs.select("u", "v").join(sets.withColumnsRenamed({"rep": "u", "set": "set_u"}), "u")
    with_v = with_u.join(sets.withColumnsRenamed({"rep": "v", "set": "set_v"}), "v")
    counted = with_v.select("u", "v", "set_u", "set_v").mapInArrow(lean(_common), "u long, v long, common long")
    sizes = sets.select("rep", (F.octet_length("set") / 8).cast("long").alias("n"))
    out = (counted.join(sizes.withColumnsRenamed({"rep": "u", "n": "n_u"}), "u")
           .join(sizes.withColumnsRenamed({"rep": "v", "n": "n_v"}), "v"))
    return out.where(F.lit(DEN) * F.col("common") >= F.lit(NUM) * (F.col("n_u") + F.col("n_v") - F.col("common")))


def _rest(n: str, k: str):
    """Shingles behind the prefix."""
    return F.ceil(F.col(n) * NUM / F.lit(float(DEN))) - F.col(k)


def _needed():
    """Shingles two sets of n_u and n_v must share to reach the threshold."""
    return F.ceil((F.col("n_u") + F.col("n_v")) * NUM / F.lit(float(NUM + DEN)) - 1e-9)


def _share():
    """Open prefix shingles that the pair must share at least (open: some other component has the shingle too)."""
    return F.greatest(_needed() - F.greatest(_rest("n_u", "k_u"), _rest("n_v", "k_v")), F.least("k_u", "k_v"))


def _hopeful():
    """Conditions on one common shingle.  A pair that must share s of its open prefix shingles has one of them among
    the first ``open - s + 1`` of both, so only those are hits; sizes and the places at which the shingle stands in
    the prefixes (what precedes it, itself, the shorter rest) must also leave room for the threshold."""
    by_place = F.least("pos_u", "pos_v") + F.least(F.col("n_u") - F.col("pos_u"), F.col("n_v") - F.col("pos_v"))
    room = F.least(F.col("open_u") - F.col("at_u"), F.col("open_v") - F.col("at_v"))
    return ((F.least("n_u", "n_v") * DEN >= F.greatest("n_u", "n_v") * NUM) & (room >= _share())
            & (by_place >= _needed()))


def _candidates(hits: DataFrame, here: DataFrame) -> DataFrame:
    """Pairs that share enough open prefix shingles."""
    pairs = stage_table(hits.select("u", "v", "n_u", "n_v", "k_u", "k_v").distinct())
    # nearly every class with open shingles is in some pair: no class is filtered out before
    tokens = here.groupBy("rep").agg(F.collect_list("token").alias("tokens"))
    both = (pairs.join(tokens.withColumnsRenamed({"rep": "u", "tokens": "tokens_u"}), "u")
            .join(tokens.withColumnsRenamed({"rep": "v", "tokens": "tokens_v"}), "v"))
    return both.where(F.size(F.array_intersect("tokens_u", "tokens_v")) >= _share()).select("u", "v")


def _index(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """(texts, sizes, members, classes, postings) of the prefix shingles that several classes have."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = rows.where("id IS NOT NULL")
    found = stage_table(_prefixes(rows, _sketch(rows)))
    named = found.where("id IS NOT NULL AND n > 0")
    classes = named.groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"))
    heads = named.groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"), F.first("k").alias("k"),
                                               F.first("prefix").alias("prefix"))
    # one number for size (31 bits), place in the prefix (28 bits) and k (4 bits)
    postings = heads.select("rep", "n", "k", F.posexplode("prefix").alias("pos", "token")).select(
        "token", "rep", (F.shiftleft("n", 32) + F.shiftleft(F.col("pos").cast("long"), 4) + F.col("k")).alias("meta"))
    repeated = postings.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
    lists = stage_table(postings.join(repeated, "token"))
    unpacked = lists.select("token", "rep", F.shiftright("meta", 32).alias("n"),
                            F.shiftright("meta", 4).bitwiseAND((1 << 28) - 1).alias("pos"),
                            F.col("meta").bitwiseAND(15).alias("k"))
    return docs, found, named, classes, unpacked


def _placed(here: DataFrame, heads: bool = False) -> DataFrame:
    """Every posting with the number of its class's open shingles and its place among them, and with ``heads`` the
    first of them."""
    by_rep = Window.partitionBy("rep")
    out = here.withColumn("open", F.count(F.lit(1)).over(by_rep)).withColumn(
        "at", F.row_number().over(by_rep.orderBy("pos")) - 1)
    if heads:
        out = out.withColumns({h: F.max(F.when(F.col("at") == i, F.col("token"))).over(by_rep)
                               for i, h in enumerate(HEADS)})
    return stage_table(out)


def _first_meeting():
    """False where a pair's common shingle comes after one that stands in both heads.  That one precedes it in both
    prefixes (all sets have one order), so it satisfies :func:`_hopeful` wherever a linking pair's later ones do."""
    met = F.lit(False)
    for a in HEADS:
        for b in HEADS:
            met = met | F.coalesce(F.col(f"{a}_u") == F.col(f"{b}_v"), F.lit(False))
    inside = (F.col("at_u") < len(HEADS)) & (F.col("at_v") < len(HEADS))
    return inside | ~met


def _sided(here: DataFrame, side: str) -> DataFrame:
    return here.withColumnsRenamed({x: side if x == "rep" else f"{x}_{side}" for x in here.columns if x != "token"})


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id), one row per input row.

    Null or empty texts have no shingles and are components of their own; a text of fewer words than a shingle is one
    shingle.  Rows that share an id share a component; a null id has a null component.  Ids are integers.  Other
    columns are not read; an empty table gives an empty result.
    """
    docs, found, named, classes, unpacked = _index(df, id_col, text_col)
    labels = None
    links = None
    for turn in range(HUB_ROUNDS + 1):
        here = unpacked.withColumn("label", F.col("rep")) if labels is None else unpacked.join(
            labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
            "label", F.coalesce("label", "rep"))
        open_tokens = here.groupBy("token").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).where(
            "l0 <> l1").select("token")
        here = here.join(open_tokens, "token")
        last = turn == HUB_ROUNDS
        here = _placed(here, heads=last)
        names = ["rep", "n", "k", "pos", "open", "at", "label", *(HEADS if last else [])]
        left = here.withColumnsRenamed({x: "u" if x == "rep" else f"{x}_u" for x in names})
        if not last:
            rank = F.struct((F.col("open") if turn == 0 else F.xxhash64("rep", F.lit(turn))).alias("first_"), *names)
            hubs = here.groupBy("token").agg(F.max(rank).alias("h"))
            right = hubs.select("token", *[F.col(f"h.{x}").alias("v" if x == "rep" else f"{x}_v") for x in names])
            apart = F.col("label_u") != F.col("label_v")
        else:
            right = here.withColumnsRenamed({x: "v" if x == "rep" else f"{x}_v" for x in names})
            apart = (F.col("label_u") < F.col("label_v")) & _first_meeting()
        hits = left.join(right, "token").where(apart & _hopeful())
        linked = settled(df.sparkSession, lambda: _verify(stage_table(_candidates(hits, here)), docs).select("u", "v"))
        links = linked if links is None else stage_table(links.union(linked))
        labels = connected_components(links)

    member = named.select("id", "n", "s1", "s2").join(classes, ["n", "s1", "s2"]).select("id", "rep").distinct()
    member = member.join(labels.withColumnRenamed("node", "rep"), "rep", "left").groupBy("id").agg(
        F.min(F.coalesce("label", "rep")).alias("component"))
    out = found.select("id", "n").join(member, "id", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.coalesce("component", "id").alias("component_id"))


def jaccard_links(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(u, v): every link between different shingle sets, also inside a component, u < v being the smallest ids with
    these sets.  Of a group of n near copies that all link there are n (n - 1) / 2."""
    docs, _, _, _, postings = _index(df, id_col, text_col)
    return _links(docs, postings)


def _links(docs: DataFrame, postings: DataFrame) -> DataFrame:
    here = _placed(postings, heads=True)
    hits = _sided(here, "u").join(_sided(here, "v"), "token").where(
        (F.col("u") < F.col("v")) & _first_meeting() & _hopeful())
    return stage_table(_verify(stage_table(_candidates(hits, here)), docs).select("u", "v"))


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, class_id, n_links), one row per input row.

    ``class_id`` is the smallest id with the same shingle set, ``n_links`` the number of other classes whose sets reach
    the threshold with it (all of them verified).  A text without shingles is a class of its own without links; a null
    id has a null class and no links."""
    docs, found, named, classes, postings = _index(df, id_col, text_col)
    links = _links(docs, postings)
    counts = links.union(links.select("v", "u")).groupBy(F.col("u").alias("rep")).agg(
        F.count(F.lit(1)).alias("n_links"))
    member = named.select("id", "n", "s1", "s2").join(classes, ["n", "s1", "s2"]).groupBy("id").agg(
        F.min("rep").alias("rep")).join(counts, "rep", "left")
    out = found.select("id", "n").join(member, "id", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.coalesce("rep", "id").alias("class_id"),
                      F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` whose id is the smallest of its component, all their columns unchanged; rows with a null id
    stay."""
    drop = sized_broadcast(settled(df.sparkSession, lambda: jaccard_components(df, id_col, text_col).where(
        F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("_drop_id"))))
    return df.join(drop, df[id_col].cast("long") == drop["_drop_id"], "left_anti")


def op4_adaptive_prefix_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
