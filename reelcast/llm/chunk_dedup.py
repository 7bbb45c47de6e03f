"""Exact dedup by content-defined chunk recipes, in DataFrame functions only.

1. Each normalised text is cut into chunks at content-defined borders; only chunk digests leave the scan.
2. Chunks are deduplicated to verified identifiers: the 64-bit hash is the identifier where every chunk that has it
   agrees on SHA-256 and length, else the full digest is.
3. A document is its ordered list of identifiers (its recipe); documents with equal lists are equal texts.  Long
   texts are never shuffled, only some 50 bytes per chunk.

Groups are aggregated before the shuffle; copies meet their group's row in a join, which adaptive execution splits
where one recipe holds a large share of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelcast.llm.common import settled, sized_broadcast, stage_table

# characters that equality ignores (fixed values): space and U+0009 to U+000D
SPACES = " \t\n\x0b\x0c\r"
# a chunk ends after the first rare letter pair past MIN_CHUNK characters, or at MAX_CHUNK
MIN_CHUNK, MAX_CHUNK = 256, 8192
BORDER = r"[^a-z][aehlrt]"
CHUNK = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 2}}}?{BORDER}|.{{1,{MAX_CHUNK}}}"


def normalise(text: Column) -> Column:
    out = F.coalesce(text.cast("string"), F.lit(""))
    for ch in SPACES:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def chunk_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per chunk (position, 64-bit hash, SHA-256, length), plus the text's own figures on its first row."""
    texts = df.select(F.col(id_col).alias("id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("chars"),
                      normalise(F.col(text_col)).alias("norm"))
    cut = texts.select("id", "chars", F.unhex(F.sha2("norm", 256)).alias("text_digest"),
                       F.posexplode_outer(F.regexp_extract_all("norm", F.lit(CHUNK), F.lit(0))).alias("pos", "chunk"))
    return cut.select(
        "id", "chars", "text_digest", F.coalesce("pos", F.lit(0)).alias("pos"),
        F.xxhash64("chunk").alias("h64"), F.unhex(F.sha2("chunk", 256)).alias("digest"),
        F.coalesce(F.length("chunk"), F.lit(0)).alias("size"))


def verified_ids(chunks: DataFrame) -> DataFrame:
    """Chunk rows with ``chunk_id``: the 8-byte hash where it stands for one content only, else the digest."""
    clashing = (chunks.where(F.col("size") > 0).groupBy("h64")
                .agg(F.min("digest").alias("d0"), F.max("digest").alias("d1"),
                     F.min("size").alias("s0"), F.max("size").alias("s1"))
                .where((F.col("d0") != F.col("d1")) | (F.col("s0") != F.col("s1")))
                .select("h64", F.lit(True).alias("clash")))
    return chunks.join(clashing, "h64", "left").withColumn(
        "chunk_id", F.when(F.col("size") == 0, F.lit(None).cast("binary"))
        .when(F.col("clash"), F.col("digest")).otherwise(F.unhex(F.lpad(F.hex("h64"), 16, "0"))))


def recipes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_digest, chars, copies, recipe): ordered list of verified chunk identifiers, one row per document;
    ``copies`` counts the rows of it."""
    ids = verified_ids(chunk_rows(df, id_col, text_col))
    parts = F.array_sort(F.collect_set(F.when(F.col("chunk_id").isNotNull(), F.struct("pos", "chunk_id"))))
    return ids.groupBy("id", "text_digest", "chars").agg(
        parts.alias("parts"), F.count_if(F.col("pos") == 0).alias("copies")).select(
        "id", "text_digest", "chars", "copies", F.transform("parts", lambda p: p["chunk_id"]).alias("recipe"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256, n_chunks), one row per document, dropped ones too.

    Texts are equal when identical without the characters of ``SPACES``; the row with the most code points in the
    original text stays, then the smallest id.  Null, empty and blank texts are all equal to each other; rows
    repeated with the same id, text and length count once; of rows that share an id but not a text each has its own
    row; a null id is an id that sorts last.  Other columns are not read; an empty table gives an empty result.
    """
    rows = stage_table(recipes(df, id_col, text_col))
    first = F.min(F.struct(-F.col("chars"), F.col("id").isNull(), F.col("id"))).alias("first")
    groups = rows.groupBy("recipe").agg(first, F.count(F.lit(1)).alias("group_size"))
    groups = groups.select("recipe", F.col("first.id").alias("keep_id"), F.col("first.col1").alias("keep_chars"),
                           "group_size")
    out = rows.join(groups, "recipe")
    return out.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (-F.col("chars") == F.col("keep_chars"))).alias("kept"),
        F.lower(F.hex("text_digest")).alias("text_sha256"), F.size("recipe").cast("long").alias("n_chunks"))


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``df`` for each set of equal texts, all its columns unchanged.

    The row that stays is that of :func:`exact_dedup`: the most code points, then the smallest id (null last).  Of
    several rows with the same id and an equal text of the same length (a row repeated whole, say) one stays; rows
    that share an id but not a text are decided on their own.  What goes is named by (id, text digest, length); while
    its number allows a broadcast, texts are not shuffled, but for those of rows that are repeated."""
    order = F.struct(-F.col("chars"), F.col("id").isNull(), F.col("id"))

    def decided() -> DataFrame:
        rows = stage_table(recipes(df, id_col, text_col))
        first = rows.groupBy("recipe").agg(F.min(order).alias("first"))
        ranked = rows.join(first, "recipe").select(
            "id", "text_digest", "chars", "copies", (order > F.col("first")).alias("later"))
        return ranked.where("later OR copies > 1")

    ranked = settled(df.sparkSession, decided)
    mark = lambda t: t.select(*[F.col(c).alias(f"_{c}") for c in ("id", "text_digest", "chars")])
    text = F.col(text_col).cast("string")
    keyed = df.withColumns({"_chars_": F.length(F.coalesce(text, F.lit(""))),
                            "_digest_": F.unhex(F.sha2(normalise(F.col(text_col)), 256))})

    def same(t: DataFrame) -> Column:
        return (keyed["_digest_"] == t["_text_digest"]) & (keyed["_chars_"] == t["_chars"]) & (
            keyed[id_col].eqNullSafe(t["_id"]))

    gone = sized_broadcast(mark(ranked.where("later")))
    twice = mark(ranked.where("NOT later AND copies > 1"))
    left = keyed.join(gone, same(gone), "left_anti")
    if twice.limit(1).count():
        twice = sized_broadcast(twice)
        once = keyed.join(twice, same(twice), "left_semi").dropDuplicates([id_col, "_digest_", "_chars_"])
        left = left.join(twice, same(twice), "left_anti").unionByName(once)
    return left.select(*df.columns)


def op3_chunk_recipes(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("n_chunks")


ORACLE_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
"""
