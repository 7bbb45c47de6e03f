"""Language model, language identification, tokenizer and the pipeline against brute force or held-out accuracy."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from llm_fixtures import corpus, docs, empty, words
from reelcast.llm import bpe_backtrack, kneser_ney, language_evidence
from test_copies import brute_components

SF = "/root/testdata/sf0.001"


def brute_kneser_ney(counts, order):
    """Interpolated modified Kneser-Ney over tuples; counts of the highest order."""
    tables = {order: dict(counts)}
    for k in range(order - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    cuts = {k: kneser_ney.discounts(Counter(t.values())) for k, t in tables.items()}
    contexts = {k: defaultdict(list) for k in tables}
    for k, t in tables.items():
        for g, c in t.items():
            contexts[k][g[:-1]].append(c)

    def p(g):
        k = len(g)
        if not k:
            return 1 / 256
        below, seen = p(g[1:]), contexts[k].get(g[:-1])
        if not seen:
            return below
        cut = lambda c: cuts[k][min(c, 3) - 1]
        c = tables[k].get(g, 0)
        return (max(c - cut(c), 0) if c else 0) / sum(seen) + sum(map(cut, seen)) / sum(seen) * below

    return p


def test_probabilities_match_brute_force_and_sum_to_one(spark):
    rng = random.Random(4)
    text = [rng.choice(b"abcab ") for _ in range(400)]
    grams = Counter(tuple(text[i:i + 3]) for i in range(398))
    p = brute_kneser_ney(grams, 3)
    pack = lambda g: sum(x << 8 * i for i, x in enumerate(reversed(g)))
    asked = {(97, 98, x): 0 for x in range(256)} | {(1, 2, 3): 0, (97, 2, 98): 0} | dict(grams)
    df = spark.createDataFrame([(pack(g), c) for g, c in asked.items()], "g long, c long").repartition(3)
    got = {r.g: r.p for r in kneser_ney.probabilities(df, order=3).collect()}
    assert len(got) == len(asked)
    for g in asked:
        assert math.isclose(got[pack(g)], p(g), rel_tol=1e-9), g
    assert math.isclose(sum(got[pack((97, 98, x))] for x in range(256)), 1, rel_tol=1e-9)


def test_classifier_keeps_clean_text_and_drops_junk(spark):
    rng = random.Random(1)
    rows = [(i, words(rng, 60), "en", None) for i in range(120)]
    rows += [(200 + i, "".join(chr(rng.randint(33, 126)) for _ in range(300)), "en", None) for i in range(10)]
    rows += [(300, None, "en", None), (301, "", None, None), (302, words(rng, 50), "zz", None)]
    trusted = spark.range(0, 60).toDF("doc_id")
    df = docs(spark, rows, repeat=False)
    one = {r.doc_id: r for r in kneser_ney.classify(df, trusted).collect()}
    many = {r.doc_id: r for r in kneser_ney.classify(df, trusted, shard_entries=100).collect()}
    assert len(one) == len(rows) == len(many)
    assert all(one[i].kept for i in [*range(120), 302]) and not any(one[200 + i].kept for i in range(10))
    assert not one[300].kept and one[300].perplexity is None and not one[301].kept
    for i in one:
        if one[i].perplexity is not None:
            assert math.isclose(one[i].perplexity, many[i].perplexity, rel_tol=1e-6)
    assert kneser_ney.classify(empty(spark), trusted).count() == 0
    no_trust = kneser_ney.classify(df.limit(20), trusted.limit(0)).collect()
    assert all(r.kept == (r.perplexity is not None) for r in no_trust)


def test_toxic_labels_are_not_trusted(spark, tmp_dir):
    """Documents called good but toxic neither train the model nor set a threshold: such text is dropped."""
    rng = random.Random(11)
    slurs = lambda: " ".join(rng.choice(["zjqx", "vkwz", "qqxv", "xzkj"]) + str(rng.random()) for _ in range(40))
    rows = [(i, words(rng, 60), "en", None) for i in range(100)] + [(100 + i, slurs(), "en", None) for i in range(25)]
    docs(spark, rows, repeat=False).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i >= 100)) for i in [*range(100), *range(100, 120)]],
                          "doc_id long, quality long, toxic long").write.parquet(f"{tmp_dir}/labels.parquet")
    out = {r.doc_id: r for r in kneser_ney.op1_kneser_ney(spark, tmp_dir).collect()}
    assert all(out[i].trusted and out[i].kept for i in range(100))
    assert not any(out[i].trusted or out[i].kept for i in range(100, 125))


def test_repeated_rows_score_alike_for_any_number_of_shards(spark):
    rng = random.Random(6)
    rows = [(i, words(rng, 8 + i % 20), "en", None) for i in range(40)] + [(50, None, None, None)]
    df = docs(spark, rows, repeat=False)
    df = df.union(df.where("doc_id % 5 = 0")).union(df.where("doc_id % 10 = 0"))
    trusted = spark.range(0, 30).toDF("doc_id")
    result = lambda size: sorted(map(tuple, kneser_ney.classify(df, trusted, shard_entries=size).collect()),
                                 key=str)
    one = result(kneser_ney.SHARD_ENTRIES)
    assert len(one) == 41 + 9 + 5 and {r[0]: r[2] for r in one}[10] == len(rows[10][1])
    assert result(400) == one


def test_one_held_out_document_does_not_set_a_language_threshold(spark):
    """Clean text of a language with five trusted documents, of which one is held out, is kept; junk in it is not."""
    from pyspark.sql import functions as F
    rng = random.Random(9)
    held = [r.id for r in spark.range(5000).where(F.pmod(F.xxhash64("id"), F.lit(5)) == 0).collect()]
    trained = sorted(set(range(5000)) - set(held))
    rare = [held[500], *trained[2000:2004]]
    foreign = lambda n: " ".join(rng.choice(["und", "der", "nicht", "ist"]) + rng.choice(["", "e", "en"])
                                 for _ in range(n))
    rows = [(i, words(rng, 60), "en", None) for i in range(150)]
    rows += [(i, "und der " * 40, "de", None) for i in rare[:2]] + [(i, foreign(60), "de", None) for i in rare[2:]]
    rows += [(6000 + i, foreign(20 + 2 * i), "de", None) for i in range(20)]
    rows += [(7000, "".join(chr(rng.randint(33, 126)) for _ in range(300)), "de", None)]
    trusted = spark.createDataFrame([(i,) for i in [*range(150), *rare]], "doc_id long")
    out = {r.doc_id: r for r in kneser_ney.classify(docs(spark, rows, repeat=False), trusted).collect()}
    assert sorted(i for i in out if not out[i].kept) == [7000]


def test_language_without_declaration_on_held_out_documents(spark):
    """Text evidence alone names the language of documents whose declaration is hidden."""
    from pyspark.sql import functions as F
    full = spark.read.parquet(f"{SF}/documents.parquet")
    hidden = full.withColumn("lang", F.when(F.col("doc_id") % 3 != 0, F.col("lang")))
    out = {r.doc_id: r for r in language_evidence.identify(hidden).collect()}
    truth = {r.doc_id: r.lang for r in full.select("doc_id", "lang").collect()}
    asked = [i for i in truth if i % 3 == 0]
    assert sum(out[i].lang == truth[i] for i in asked) / len(asked) > 0.95


def test_language_edge_cases(spark):
    out = {r.doc_id: r for r in language_evidence.identify(docs(spark)).collect()}
    assert len(out) == len(corpus())
    for i in (36, 37, 38):
        assert not out[i].kept and out[i].lang == "und"
    assert out[38].declared == "xx" and out[37].declared is None
    assert language_evidence.identify(empty(spark)).count() == 0
    assert language_evidence.keep_identified(docs(spark)).columns == docs(spark).columns


def test_host_prior_decides_where_text_is_silent(spark):
    rng = random.Random(7)
    rows = [(i, words(rng, 30), "en", "a.org") for i in range(30)] + [
        (100 + i, " ".join(rng.choice(["und", "der", "die", "das", "ist", "nicht"]) for _ in range(30)), "de", "b.de")
        for i in range(30)] + [(500, "qqq", None, "b.de"), (501, "qqq", None, "a.org"), (502, "qqq", None, "new.de")]
    out = {r.doc_id: r.lang for r in language_evidence.identify(docs(spark, rows, repeat=False)).collect()}
    assert out[500] == "de" and out[501] == "en" and out[502] == "de"


TEXTS = [None, "", " ", "a", "  a  b\n\n c\t", "it's I'll we've 'S", "x<|endoftext|>y", "<|endoftext|>", "é文字🙂²Ⅷ\x85\x1c z",
         "a" * 3000, " " * 300, "ab " * 500, "\n", "end \n next", "<|endoftext"]


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe_backtrack.default_vocabulary())


def test_bpe_matches_the_library(spark):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("ab eé\n'0 .,tion<|") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS id")
    t = library()
    got = {r.doc_id: r for r in bpe_backtrack.decode(bpe_backtrack.encode(df.repartition(3))).collect()}
    sums = {r.doc_id: r for r in bpe_backtrack.digests(df).collect()}
    for i, text in enumerate(texts):
        ids = t.encode(text or "", add_special_tokens=False).ids
        assert list(got[i].ids) == ids, text
        assert got[i].decoded == t.decode(ids, skip_special_tokens=False) == (text or "")
        assert (sums[i].n_tokens, sums[i].ids_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    assert bpe_backtrack.digests(df.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [65, None, 10**6, 66])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe_backtrack.decode(odd).collect()} == {1: "", 2: t.decode([65, 66])}


def test_bpe_survives_full_tables(monkeypatch):
    monkeypatch.setattr(bpe_backtrack, "TABLE_BYTES", 9000)
    monkeypatch.setattr(bpe_backtrack, "WORD_BYTES", 9000)
    e, t = bpe_backtrack.Encoder(bpe_backtrack.default_vocabulary()), library()
    rng = random.Random(8)
    for _ in range(5):
        texts = [words(rng, 40) for _ in range(20)]
        ids, offsets = e.encode(texts)
        for i, text in enumerate(texts):
            assert ids[offsets[i]:offsets[i + 1]].tolist() == t.encode(text, add_special_tokens=False).ids
        assert e.vocabulary.decode(ids.astype(np.int64), offsets) == texts


def test_texts_with_double_white_space_leave_nothing_behind():
    e, t = bpe_backtrack.Encoder(bpe_backtrack.default_vocabulary()), library()
    rng = random.Random(9)
    plain = [words(rng, 30) for _ in range(5)]
    e.encode(plain)
    kept = len(e.flat), len(e.ends), len(e.table)
    special = next(iter(e.vocabulary.special))
    for _ in range(3):
        texts = [words(rng, 2000) + "\n\n", plain[0], f"a  b{special}c", "", "x " * 500 + " y"]
        ids, offsets = e.encode(texts)
        for i, text in enumerate(texts):
            assert ids[offsets[i]:offsets[i + 1]].tolist() == t.encode(text, add_special_tokens=False).ids
    assert len(e.table) == kept[2] and len(e.flat) < kept[0] + 200 and len(e.ends) < kept[1] + 10


def test_pair_table_agrees_with_merging():
    v, t = bpe_backtrack.Vocabulary(bpe_backtrack.default_vocabulary()), library()
    rng = random.Random(2)
    letters = [i for i, b in enumerate(v.bytes) if b.isalpha() and b.isascii()]
    for _ in range(3000):
        a, b = rng.choice(letters), rng.choice(letters)
        whole = t.encode((v.bytes[a] + v.bytes[b]).decode(), add_special_tokens=False).ids
        assert v.compatible(a, b) == (whole == [a, b])


def test_pipeline_matches_brute_force(spark):
    """Every stage by plain Python over the smallest table."""
    import re

    import pyarrow.parquet as pq
    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    items = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "bpe"]
    left = {r["doc_id"]: r["text"] or "" for r in rows}
    left = {i: t for i, t in left.items() if any(c.isalpha() for c in t)}      # every declared text is accepted
    groups = defaultdict(list)
    for i, t in left.items():
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), i))
    left = {i: left[i] for i in (min(g)[1] for g in groups.values())}
    component = brute_components(list(left.items()))
    left = {i: t for i, t in left.items() if component[i][1] == i}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    windows = set()
    for r in items:
        w = word.findall((r["text"] or "").translate(low))
        windows |= {tuple(w[s:s + 10]) for s in range(max(len(w) - 10, 0) + 1) if w}
    sizes = {len(w) for w in windows}

    def leaks(t):
        w = word.findall(t.translate(low))
        return any(tuple(w[s:s + n]) in windows for n in sizes for s in range(len(w) - n + 1))

    left = {i: t for i, t in left.items() if not leaks(t)}
    t = library()
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(out) == set(left)
    for i, text in left.items():
        ids = t.encode(text, add_special_tokens=False).ids
        assert out[i].n_tokens == len(ids)
        assert out[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("stage", range(4))
def test_stages_return_the_columns_of_documents(spark, stage):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert corpus_pipeline.STAGES[stage][1](spark, df, SF).columns == df.columns


def test_page_language_uses_markup_host_and_text(spark):
    """Every page has one row; the language found agrees with the markup where the page has text enough."""
    from conftest import SF001
    out = language_evidence.page_language(spark, SF001).collect()
    assert len(out) == spark.read.parquet(f"{SF001}/pages.parquet").count() == len({r.page_id for r in out})
    told = [r for r in out if r.declared and r.kept and r.n_grams > 200]
    assert told and sum(r.lang == r.declared[:2].lower() for r in told) / len(told) >= 0.9
    assert all(r.kept == (r.lang != "und") and (r.n_grams > 0 or not r.kept) for r in out)


def test_a_worker_drops_what_it_kept_for_another_operator():
    from reelcast.llm import bpe_backtrack, common
    common._KEPT.clear()
    class File:
        def __init__(self, path):
            self.path = path
    held = bpe_backtrack._loaded(File, "a")
    assert list(common.lean(iter, bpe_backtrack.OPERATOR)([1, 2])) == [1, 2]
    assert bpe_backtrack._loaded(File, "a") is held          # its own next task finds it again
    assert list(common.lean(iter)([3])) == [3]               # the next stage of a pipeline runs in the same worker
    assert not common._KEPT
