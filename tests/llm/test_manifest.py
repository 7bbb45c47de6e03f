"""Merkle manifest and its versions against trees built whole in memory."""

import hashlib
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from llm_fixtures import docs, empty
from reelcast.llm import merkle_manifest as M

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    def value(name):
        v = row[name]
        v = v.translate(LOWER) if lower and name == "text" and v is not None else v
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*[value(c) for c in M.FIELDS])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def sides(tree, at):
    out = []
    for low in tree[:-1]:
        lo = at // 8 * 8
        out.append(("".join(low[lo:at]), "".join(low[at + 1:lo + 8])))
        at //= 8
    return out


def brute(rows):
    """{index of row: (leaf, subroot, root, proof, folded root)} and the trees."""
    by = defaultdict(list)
    for i, r in enumerate(rows):
        by[b"" if r["lang"] is None else b"v" + r["lang"].encode()].append(i)
    for members in by.values():
        members.sort(key=lambda i: (rows[i]["doc_id"] is not None, rows[i]["doc_id"] or 0, leaf(rows[i])))
    trees = {k: levels([leaf(rows[i]) for i in m]) for k, m in by.items()}
    top = levels([trees[k][-1][0] for k in sorted(trees)])
    out = {}
    for place, k in enumerate(sorted(by)):
        for at, i in enumerate(by[k]):
            way = sides(trees[k], at) + sides(top, place)
            r = rows[i]
            node = leaf(r, r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0)
            for a, b in way:
                node = h(a, node, b)
            out[i] = (r["doc_id"], leaf(r), trees[k][-1][0], top[-1][0], h(*[a + b for a, b in way]), node)
    return out, by, trees, top


def check(df):
    rows = [r.asDict() for r in df.select(*M.FIELDS).collect()]
    want, _, _, top = brute(rows)
    got = M.manifest(df).collect()
    fields = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")
    key = lambda t: tuple("" if x is None else str(x) for x in t)
    assert sorted((tuple(r[c] for c in fields) for r in got), key=key) == sorted(want.values(), key=key)
    assert all(r.verified == (r.folded_root == top[-1][0]) for r in got)
    return rows, got


def test_manifest_matches_brute_force(spark):
    """Null ids, trees and texts, empty and long texts, repeated rows, clashing columns."""
    df = docs(spark).withColumn("text", F.when(F.col("doc_id") % 2 == 0, F.initcap("text")).otherwise(F.col("text")))
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    df = df.union(df.where("doc_id = 4").withColumn("doc_id", F.lit(None).cast("long")))
    _, got = check(df)
    assert 0 < sum(not r.verified for r in got) < len(got)


def test_trees_of_several_rounds(spark):
    """More leaves than a block in one tree, and border sizes: 1, 8, 9, 512, 513 leaves."""
    sizes = {"a": 1, "b": 8, "c": 9, "d": 512, "e": 513, "f": 5000, None: 64}
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((i * 7 % 100003, f"Text {i}", lang, f"s{i % 3}", i))
            i += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    check(df)
    copied = M.version_nodes(df).where("doc_id IN (7, 98, 700, 2800)").collect()
    plain, got = [r.asDict() for r in df.collect()], defaultdict(dict)
    for r in copied:
        got[r.doc_id][(r.level, r.pos)] = r.digest
    want, by, trees, top = brute(plain)
    assert got
    for doc_id, own in got.items():
        changed = [dict(r, text=r["text"].translate(LOWER)) if r["doc_id"] == doc_id else r for r in plain]
        lang = next(r["lang"] for r in plain if r["doc_id"] == doc_id)
        key = b"" if lang is None else b"v" + lang.encode()
        _, _, after, top_after = brute(changed)
        differ = {(level, pos): new for level, (old, now) in enumerate(zip(trees[key], after[key]))
                  for pos, (a, new) in enumerate(zip(old, now)) if a != new}
        assert {k: v for k, v in own.items() if k[1] is not None} == differ          # all others are shared
        assert own[max(own, key=lambda k: k[0])] == top_after[-1][0]


def test_single_row_and_empty_table(spark):
    one = docs(spark, [(3, "Abc", None, None)], repeat=False).withColumn("n_chars", F.lit(None).cast("long"))
    rows, got = check(one)
    assert got[0].root == got[0].leaf and got[0].proof_sha256 == h("")
    assert M.manifest(empty(spark).withColumn("n_chars", F.lit(1).cast("long"))).count() == 0
