"""Personal data by candidate gradient boosting.

1. High-recall generators propose overlapping candidate spans in each whole text (Arrow batches): everything shaped
   like a mail address (also spelled out), a dotted number, a card number or a phone number (also without ``+``).
2. Strict formats with their checks (ranges, digit counts, Luhn) mark the base spans, which always stay.
3. Boosted trees learn base spans against candidates that fail the checks, from format and context features that do
   not contain the checks, on a bounded sample of candidates.
4. Every kind has a threshold calibrated on all held-out candidates: the lowest score from which on at least
   ``PRECISION`` of them are right.  Candidates beyond the base spans that reach it are added.

Offsets count code points, end exclusive.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelcast.llm.common import stage_table

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS = 20_000        # candidates the trees are fitted on at most
PRECISION = 0.95
LEAST_HELD_OUT = 20         # a kind with fewer held-out candidates above a score has no threshold there
TREES, DEPTH = 10, 3
FEATURES = ("length", "digits", "groups", "spaces", "dashes", "dots", "brackets", "plus", "distinct", "zero_first",
            "longest_group", "letters", "before_alnum", "after_alnum", "cue_mail", "cue_phone", "cue_card", "cue_net",
            "line_start", "line_end")

_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]{1,63}){1,4}")
_CUES = [re.compile(x, re.I) for x in (r"mail|contact|write", r"tel|phone|call|fax|mobil", r"card|visa|pay|iban",
                                       r"\bip\b|host|server|addr")]
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping mail addresses, in one pass over the ``@`` signs."""
    last = 0                            # nothing before this can begin a match
    at = text.find("@")
    while at >= 0:
        begin = last + len(text[last:at].rstrip(_LOCAL))
        end = _DOMAIN.match(text, at + 1) if begin < at else None
        last = end.end() if end else at + 1
        if end:
            yield begin, last
        at = text.find("@", max(last, at + 1))


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, passes the strict format) of every proposal; proposals may overlap."""
    out = []
    if "@" in text:
        out.extend(("email", a, b, True) for a, b in mails(text))
    if "at)" in text or "at]" in text:
        out.extend(("email", m.start(), m.end(), False) for m in _SPELLED.finditer(text))
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        out.append(("ip", m.start(), m.end(), all(len(p) <= 3 and int(p) <= 255 for p in parts)))
    for m in _DIGITS.finditer(text):
        if m.end() - m.start() < 7:
            continue
        digits = _NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19:
            out.append(("card", m.start(), m.end(), luhn(digits)))
        elif 12 <= len(digits) <= 22:
            out.append(("card", m.start(), m.end(), False))
        if 7 <= len(digits) <= 13 and len(digits) < m.end() - m.start():
            out.append(("phone", m.start(), m.end(), False))
    if "+" in text:
        for m in _PHONE.finditer(text):
            out.append(("phone", m.start(), m.end(), 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15))
    return out


def features(text: str, start: int, end: int) -> list[float]:
    """Format and context of a span, in the order of ``FEATURES``."""
    span, before = text[start:end], text[max(0, start - 24):start]
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    return [float(x) for x in (
        end - start, len(digits), len(groups), span.count(" "), span.count("-"), span.count("."),
        span.count("(") + span.count("["), span.startswith("+"), len(set(digits)), digits.startswith("0"),
        max(map(len, groups), default=0), sum(c.isalpha() for c in span), before[-1:].isalnum(),
        text[end:end + 1].isalnum(), *(bool(c.search(before)) for c in _CUES),
        before[-1:] in ("", "\n"), text[end:end + 1] in ("", "\n"))]


SPAN = "struct<start:int,ord:int,kind:string,end:int>"


def propose(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, id, base, more): base spans and, with label and features, every proposal of each text.  ``label`` is 1
    for base spans, 0 for proposals that overlap no base span of their kind."""
    rows = df.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), F.col(id_col).alias("id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    spans = pa.list_(pa.struct([("start", pa.int32()), ("ord", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))
    full = pa.list_(pa.struct([("start", pa.int32()), ("ord", pa.int32()), ("kind", pa.string()), ("end", pa.int32()),
                               ("label", pa.int32()), ("x", pa.list_(pa.float64()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, more = [], []
            for value in batch.column(2):
                text = value.as_py()
                found = candidates(text)
                strict = [(k, a, b) for k, a, b, ok in found if ok]
                own, rest = [], []
                for kind, a, b, ok in found:
                    span = {"start": a, "ord": KINDS.index(kind), "kind": kind, "end": b}
                    if ok:
                        own.append(span)
                    elif any(k == kind and x < b and a < y for k, x, y in strict):
                        continue
                    rest.append(span | {"label": int(ok), "x": features(text, a, b)})
                base.append(sorted(own, key=lambda s: (s["start"], s["ord"])))
                more.append(rest)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(base, spans),
                                              pa.array(more, full)], names=["key", "id", "base", "more"])

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(run, f"key long, id {kind}, base array<{SPAN}>, more array<struct<start:int,ord:int,"
                                "kind:string,end:int,label:int,x:array<double>>>")


def _assembled(rows: DataFrame) -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    kinds = F.array(*[(F.col("kind") == k).cast("double") for k in KINDS])
    return rows.withColumn("features", array_to_vector(F.concat("x", kinds)))


def fit(proposals: DataFrame):
    """(model, threshold by kind) from the proposals, or (None, {}) where one class is missing."""
    from pyspark.ml.classification import GBTClassifier
    rows = proposals.select("key", "start", "kind", F.col("label").cast("double").alias("label"), "x").withColumn(
        "h", F.xxhash64("key", "start", "kind"))
    held = F.pmod("h", F.lit(5)) == 0
    train = stage_table(rows.where(~held).orderBy("h", "key", "start").limit(SAMPLE_ROWS))
    if train.select("label").distinct().count() < 2:
        return None, {}
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7).fit(_assembled(train))
    # the trees give few distinct scores, so the cumulated rows are few, however many candidates there are
    scores = _score(model, rows.where(held)).groupBy("kind", "score").agg(
        F.sum("label").alias("right"), F.count(F.lit(1)).alias("n"))
    from_top = Window.partitionBy("kind").orderBy(F.desc("score"))
    reached = stage_table(scores).select("kind", "score", F.sum("right").over(from_top).alias("right"),
                                         F.sum("n").over(from_top).alias("n"))
    good = reached.where((F.col("n") >= LEAST_HELD_OUT) & (F.col("right") / F.col("n") >= PRECISION))
    limits = {r["kind"]: r["score"] for r in good.groupBy("kind").agg(F.min("score").alias("score")).collect()}
    return model, limits


def _score(model, rows: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    return model.transform(_assembled(rows)).withColumn("score", vector_to_array("probability")[1])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, found), one row per distinct input row; ``found`` is
    the array of all spans (start, ord, kind, end).

    Null or empty texts have no spans; equal starts come in the order of ``KINDS``; a null id is an id like others;
    rows repeated whole give one row; other columns are not read; an empty table, or one whose candidates are all of
    one class, adds nothing to the base spans.
    """
    rows = stage_table(propose(df, id_col, text_col))
    proposals = rows.select("key", F.explode("more").alias("m")).select("key", "m.*")
    model, limits = fit(proposals)
    none = F.array().cast(f"array<{SPAN}>")
    out = rows.select("key", "id", "base").dropDuplicates(["key", "id"])
    if limits:
        limit = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(float(v)))])
        added = _score(model, proposals.where("label = 0")).where(F.col("score") >= limit[F.col("kind")])
        added = added.groupBy("key").agg(F.collect_set(F.struct("start", "ord", "kind", "end")).alias("added"))
        out = out.join(added, "key", "left").withColumn("found", F.concat("base", F.coalesce("added", none)))
    else:
        out = out.withColumn("found", F.col("base"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return out.select(F.col("id").alias(id_col), *[count(k).alias(f"n_{k}") for k in KINDS],
                      F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"),
                      F.array_sort("found").alias("found"))


def redact(text: str, spans) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, last = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], s["ord"])):
        if s["start"] >= last:
            out.extend((text[last:s["start"]], f"[{s['kind']}]"))
        last = max(last, s["end"])
    return "".join(out) + text[last:]


def op8_pii_boosting(spark, sf_dir: str) -> DataFrame:
    return find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("found")
