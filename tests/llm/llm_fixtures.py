"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing extra columns."""

import random


def words(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "zeta", "eta", "the"])
                    + rng.choice(["", "s", "ed", "ing", "x", "y"]) for _ in range(n))


def corpus(seed=5):
    """(doc_id, text, lang, source): plain texts, copies, near copies, a long text, and the odd cases."""
    rng = random.Random(seed)
    rows = []
    for i in range(24):
        rows.append((i, words(rng, 40 + 5 * i), ["en", "de", "fr"][i % 3], f"host{i % 4}.example.org"))
    base = rows[3][1].split(" ")
    for i in range(24, 34):                               # near copies of document 3: one word changed
        w = list(base)
        w[(i * 7) % len(w)] = f"changed{i}"
        rows.append((i, " ".join(w), "en", "host1"))
    rows.append((34, rows[5][1].replace(" ", "\n"), "en", "host1"))        # copy without regard to white space
    rows.append((35, rows[5][1] + "  ", "en", "host1"))                    # longer original of the same text
    rows.append((36, None, "en", "host1"))
    rows.append((37, "", None, None))
    rows.append((38, " \t\n ", "xx-bad-code!", "host1"))
    rows.append((39, "one two three", "en", ""))
    rows.append((40, "One two three", "en", "host1"))
    rows.append((41, words(rng, 6000), "en", "host2"))                     # long
    rows.append((42, "ein Wort 文字 🙂 é", "de", "host2"))
    rows.append((43, "a" * 5000, "en", "host2"))                           # one very long word
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


def docs(spark, rows=None, repeat=True):
    """The corpus with two rows repeated whole, extra columns of clashing names, over several partitions."""
    from pyspark.sql import functions as F
    rows = corpus() if rows is None else rows
    df = spark.createDataFrame(rows, SCHEMA)
    if repeat and rows:
        df = df.union(df.where("doc_id IN (2, 36)"))
    return df.repartition(5).withColumns({c: F.lit("clash") for c in (
        "id", "key", "kept", "keep_id", "spans", "words", "component", "rep", "n", "host", "rule", "label")})


def empty(spark):
    return docs(spark, [], repeat=False)
