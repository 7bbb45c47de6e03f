"""Merkle dataset manifest as a persistent path-copying tree.

1. Every row becomes a leaf digest; only digests leave the scan, texts are never shuffled.
2. Leaves are numbered within their tree by range partitions (a hot tree spans many tasks) and cut into aligned
   blocks of ``BLOCK`` leaves; one task folds one block, so a group never exceeds ``BLOCK`` digests.
3. Block roots are the leaves of the next round, until one node per tree is left (its subroot); the subroots are one
   more tree.  Each round also gives every child the siblings on its way up through its block.
4. A tampered leaf creates a version: only its ancestors are copied, first inside its block, where all versions share
   the base nodes, then along the block's way up, which all versions of the block share.  The last copy is the
   version's root.  An untampered leaf's version is the base version itself.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelcast.llm.common import lower_ascii, sized_broadcast, stage_table
from reelcast.operators.ranking import rank_all

FANOUT = 8
BLOCK_LEVELS = 3
BLOCK = FANOUT ** BLOCK_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MOD = 3
# rows of way-up siblings (some 4 KB each at most) that are broadcast after they were counted
PATH_ROWS = 4096


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(df: DataFrame, id_col: str = "doc_id", tree_col: str = "lang", text_col: str = "text",
           fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(id, tree, leaf, tampered): ``tampered`` is the leaf with the text's A-Z lowered, null where the row isn't
    tampered with or its text doesn't change.  ``tree`` is ``n`` for a null, else ``v`` and the value."""
    plain = [field(F.col(c)) for c in fields]
    lowered = [field(lower_ascii(F.col(c))) if c == text_col else field(F.col(c)) for c in fields]
    hit = F.crc32(F.col(id_col).cast("string")) % TAMPER_MOD == 0
    out = df.select(
        F.col(id_col).alias("id"), F.coalesce(F.concat(F.lit("v"), F.col(tree_col).cast("string")), F.lit("n"))
        .alias("tree"), F.sha2(F.concat(*plain), 256).alias("leaf"),
        F.when(hit & F.col(text_col).isNotNull(), F.sha2(F.concat(*lowered), 256)).alias("changed"))
    return out.select("id", "tree", "leaf", F.when(F.col("changed") != F.col("leaf"), F.col("changed")).alias("tampered"))


def block_tree(digests: list[str], n: int) -> list[list[str]]:
    """The levels of one block of a tree that has ``n`` nodes on the block's lowest level."""
    rows = [digests]
    while n > 1 and len(rows) <= BLOCK_LEVELS:
        low = rows[-1]
        rows.append([digest("".join(low[i:i + FANOUT])) for i in range(0, len(low), FANOUT)])
        n = -(-n // FANOUT)
    return rows


def way_up(rows: list[list[str]], at: int) -> list[tuple[str, str]]:
    """(siblings to the left, to the right) of a node and its ancestors below the top of the block."""
    out = []
    for low in rows[:-1]:
        start = at - at % FANOUT
        run = low[start:start + FANOUT]
        out.append(("".join(run[:at - start]), "".join(run[at - start + 1:])))
        at //= FANOUT
    return out


def copies(leaf: str, way: list[tuple[str, str]]) -> list[str]:
    """The version's own nodes: the leaf and a copy of each ancestor; everything else is shared."""
    out = [leaf]
    for left, right in way:
        out.append(digest(left + out[-1] + right))
    return out


def _block_roots(table: pa.Table) -> pa.Table:
    table = table.sort_by("pos")
    n = table["n"][0].as_py()
    top = block_tree(table["leaf"].to_pylist(), n)[-1][0]
    return pa.table({"tree": table["tree"][:1], "pos": table["block"][:1], "digest": pa.array([top]),
                     "n": pa.array([-(-n // BLOCK)], pa.int64())})


def _child_ways(table: pa.Table) -> pa.Table:
    table = table.sort_by("pos")
    n, base = table["n"][0].as_py(), table["pos"][0].as_py()
    rows = block_tree(table["digest"].to_pylist(), n)
    ways = [way_up(rows, p - base) for p in table["pos"].to_pylist()]
    strings = pa.list_(pa.string())
    return pa.table({
        "tree": table["tree"], "pos": table["pos"], "block": table["block"], "digest": table["digest"],
        "top": pa.array([rows[-1][0]] * len(ways)), "n_up": pa.array([-(-n // BLOCK)] * len(ways), pa.int64()),
        "lefts": pa.array([[x for x, _ in w] for w in ways], strings),
        "rights": pa.array([[x for _, x in w] for w in ways], strings)})


def _rounds(nodes: DataFrame) -> DataFrame:
    """(tree, pos, lefts, rights, top): the way of every node of ``nodes`` (tree, pos, digest, n) to its tree's root.
    Every round divides the number of nodes by ``BLOCK``."""
    done, cur = [], nodes
    while (cur.agg(F.max("n")).first()[0] or 0) > 1:
        rows = stage_table(cur.withColumn("block", F.floor(F.col("pos") / BLOCK)).groupBy("tree", "block").applyInArrow(
            _child_ways, "tree string, pos long, block long, digest string, top string, n_up long, "
                         "lefts array<string>, rights array<string>"))
        done.append(rows)
        cur = rows.where(F.col("pos") % BLOCK == 0).select(
            "tree", F.col("block").alias("pos"), F.col("top").alias("digest"), F.col("n_up").alias("n"))
    none = F.array().cast("array<string>")
    ways = cur.select("tree", "pos", none.alias("lefts"), none.alias("rights"), F.col("digest").alias("top"))
    for rows in reversed(done):
        up = ways.withColumnsRenamed({"pos": "block", "lefts": "up_lefts", "rights": "up_rights"})
        ways = rows.drop("top").join(up, ["tree", "block"]).select(
            "tree", "pos", F.concat("lefts", "up_lefts").alias("lefts"), F.concat("rights", "up_rights").alias("rights"),
            "top")
    return ways


def numbered(rows: DataFrame) -> DataFrame:
    """(id, tree, leaf, tampered, pos, n, block) of ``leaves``: place in the tree by ascending id (null first), then
    leaf; ``n`` is the tree's number of leaves."""
    order = [F.col("id").asc_nulls_first(), F.col("leaf").asc()]
    rows = stage_table(rows)                    # texts are digested once; the ranges are found on the digests
    placed = stage_table(rank_all(rows, ["tree"], order, "pos").withColumn("pos", F.col("pos") - 1))
    sizes = sized_broadcast(stage_table(placed.groupBy("tree").agg((F.max("pos") + 1).alias("n"))))
    return placed.join(sizes, "tree").withColumn("block", F.floor(F.col("pos") / BLOCK))


def block_ways(placed: DataFrame) -> DataFrame:
    """(tree, block, lefts, rights, subroot, root): the way of every block's root to the root of all trees."""
    cols = ["tree", "block", "pos", "n", "leaf"]
    roots = stage_table(placed.select(*cols).groupBy("tree", "block").applyInArrow(
        _block_roots, "tree string, pos long, digest string, n long"))
    ways = stage_table(_rounds(roots))
    tops = ways.where("pos = 0").select(F.col("tree").alias("sub"), F.col("top").alias("digest"))
    ranked = stage_table(rank_all(tops, [], [F.asc("sub")], "pos"))
    n = ranked.count()
    upper = _rounds(ranked.select(F.lit("").alias("tree"), (F.col("pos") - 1).alias("pos"), "digest",
                                  F.lit(n).cast("long").alias("n")))
    named = ranked.select("sub", "digest", (F.col("pos") - 1).alias("top_pos")).join(
        upper.select(F.col("pos").alias("top_pos"), F.col("lefts").alias("up_lefts"),
                     F.col("rights").alias("up_rights"), F.col("top").alias("root")), "top_pos")
    return ways.join(sized_broadcast(stage_table(named)), F.col("tree") == F.col("sub")).select(
        "tree", F.col("pos").alias("block"), F.concat("lefts", "up_lefts").alias("lefts"),
        F.concat("rights", "up_rights").alias("rights"), F.col("digest").alias("subroot"), "root",
        F.size("lefts").alias("own_levels"))


def _fold(id_type: pa.DataType):
    def run(rows: pa.Table, way: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        up = list(zip(way["lefts"][0].as_py(), way["rights"][0].as_py()))
        up_text = "".join(a + b for a, b in up)
        subroot, root = way["subroot"][0].as_py(), way["root"][0].as_py()
        leaf = rows["leaf"].to_pylist()
        tree = block_tree(leaf, rows["n"][0].as_py())
        proofs, folded = [], []
        for at, other in enumerate(rows["tampered"].to_pylist()):
            inside = way_up(tree, at)
            proofs.append(digest("".join(a + b for a, b in inside) + up_text))
            folded.append(copies(other, inside + up)[-1] if other else root)
        return pa.table({
            "id": rows["id"].cast(id_type), "leaf": rows["leaf"], "subroot": pa.array([subroot] * len(leaf)),
            "root": pa.array([root] * len(leaf)), "proof_sha256": pa.array(proofs), "folded_root": pa.array(folded),
            "verified": pa.array([f == root for f in folded])})
    return run


def _copied(id_type: pa.DataType):
    def run(rows: pa.Table, way: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        up = list(zip(way["lefts"][0].as_py(), way["rights"][0].as_py()))
        tree = block_tree(rows["leaf"].to_pylist(), rows["n"][0].as_py())
        ids, levels, places, digests = [], [], [], []
        own = len(tree) - 1 + way["own_levels"][0].as_py()      # levels up to the subroot; the rest is the upper tree
        for at, (i, pos, other) in enumerate(zip(*(rows[c].to_pylist() for c in ("id", "pos", "tampered")))):
            for level, node in enumerate(copies(other, way_up(tree, at) + up) if other else []):
                ids.append(i)
                levels.append(level)
                places.append(pos // FANOUT ** level if level <= own else None)
                digests.append(node)
        return pa.table({"id": pa.array(ids, id_type), "tree": pa.array([rows["tree"][0].as_py()] * len(ids), pa.string()),
                         "level": pa.array(levels, pa.int32()), "pos": pa.array(places, pa.int64()),
                         "digest": pa.array(digests, pa.string())})
    return run


def _by_block(df: DataFrame, make, schema: str, id_col: str, tree_col: str, text_col: str,
              fields: tuple[str, ...]) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_type
    placed = numbered(leaves(df, id_col, tree_col, text_col, fields))
    ways = stage_table(block_ways(placed))
    kind = df.schema[id_col].dataType
    return placed.groupBy("tree", "block").cogroup(ways.groupBy("tree", "block")).applyInArrow(
        make(to_arrow_type(kind)), f"id {kind.simpleString()}, {schema}")


def manifest(df: DataFrame, id_col: str = "doc_id", tree_col: str = "lang", text_col: str = "text",
             fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per input row.

    Null fields are ``-``; a null tree value is a tree of its own that comes first; empty and very long texts are
    texts like others.  Null ids come first in their tree and are never tampered with; rows that share an id follow
    by leaf digest, rows repeated whole are leaves of their own with the same leaf and their own proofs.  A tree of
    one row has that leaf as its subroot; of a single tree the subroot is the root.  Columns outside ``fields`` are
    not read; an empty table gives an empty result.
    """
    out = _by_block(df, _fold, "leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                               "verified boolean", id_col, tree_col, text_col, fields)
    return out.withColumnRenamed("id", id_col)


def version_nodes(df: DataFrame, id_col: str = "doc_id", tree_col: str = "lang", text_col: str = "text",
                  fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(id, tree, level, pos, digest): the nodes that each tampered leaf's version owns, from the leaf (level 0) to
    the version's root.  ``pos`` is the place on that level of the row's tree, null above the subroot.  All other
    nodes of a version are those of the base version.  Rows as in :func:`manifest`."""
    return _by_block(df, _copied, "tree string, level int, pos long, digest string", id_col, tree_col, text_col,
                     fields).withColumnRenamed("id", id_col)


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    return manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _value(name: str) -> str:
    return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR), '-')"


_LOWERED = ("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

ORACLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, sha256(concat({", ".join(_value(c) for c in FIELDS)})) AS leaf,
    sha256(concat({", ".join(_value(_LOWERED if c == "text" else c) for c in FIELDS)})) AS lowered,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos FROM documents),
crc AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 1 AS k, 4294967295::BIGINT AS c FROM documents
  UNION ALL
  SELECT doc_id, s, k + 1, list_reduce(list_prepend(xor(c, ascii(s[k])::BIGINT), range(8)),
    lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) FROM crc WHERE k <= length(s)),
tampered AS (SELECT doc_id FROM crc WHERE k = length(s) + 1 AND xor(c, 4294967295::BIGINT) % 3 = 0),
nodes AS (
  SELECT lang, 0 AS lvl, pos, leaf AS digest FROM d
  UNION ALL
  SELECT lang, lvl + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS c FROM nodes) WHERE c > 1 GROUP BY lang, lvl, pos // 8),
subroots AS (SELECT lang, arg_max(digest, lvl) AS subroot, max(lvl) AS top FROM nodes GROUP BY lang),
placed AS (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM subroots),
upper AS (
  SELECT 0 AS lvl, place AS pos, subroot AS digest FROM placed
  UNION ALL
  SELECT lvl + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS c FROM upper) WHERE c > 1 GROUP BY lvl, pos // 8),
roots AS (SELECT arg_max(digest, lvl) AS root, max(lvl) AS top FROM upper),
sides AS (
  SELECT n.lang, lvl, pos,
    coalesce(string_agg(digest, '') OVER (PARTITION BY n.lang, lvl, pos // 8 ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER (PARTITION BY n.lang, lvl, pos // 8 ORDER BY pos
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM nodes n JOIN subroots s ON n.lang IS NOT DISTINCT FROM s.lang WHERE lvl < top),
upper_sides AS (
  SELECT lvl, pos,
    coalesce(string_agg(digest, '') OVER (PARTITION BY lvl, pos // 8 ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER (PARTITION BY lvl, pos // 8 ORDER BY pos
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM upper, roots WHERE lvl < top),
ways AS (
  SELECT doc_id, lvl, l, r FROM d JOIN sides s ON d.lang IS NOT DISTINCT FROM s.lang
    AND s.pos = d.pos >> CAST(3 * lvl AS BIGINT)
  UNION ALL
  SELECT doc_id, p.top + lvl, l, r FROM d JOIN placed p ON d.lang IS NOT DISTINCT FROM p.lang
    JOIN upper_sides u ON u.pos = place >> CAST(3 * lvl AS BIGINT)),
proofs AS (SELECT doc_id, sha256(string_agg(l || r, '' ORDER BY lvl)) AS proof FROM ways GROUP BY doc_id),
folds AS (
  SELECT doc_id, 0 AS lvl, CASE WHEN t.doc_id IS NULL THEN leaf ELSE lowered END AS digest
  FROM d LEFT JOIN tampered t USING (doc_id)
  UNION ALL
  SELECT f.doc_id, f.lvl + 1, sha256(l || digest || r) FROM folds f JOIN ways w ON f.doc_id = w.doc_id AND f.lvl = w.lvl),
folded AS (SELECT doc_id, arg_max(digest, lvl) AS folded_root FROM folds GROUP BY doc_id)
SELECT d.doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root,
  folded_root = root AS verified
FROM d JOIN subroots s ON d.lang IS NOT DISTINCT FROM s.lang CROSS JOIN roots LEFT JOIN proofs USING (doc_id)
JOIN folded USING (doc_id)
"""
