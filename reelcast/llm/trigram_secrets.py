"""Secret scans over a trigram inverted index, in DataFrame functions only.

1. From every rule's regular expression a Boolean trigram query is derived: a conjunction of clauses, each an OR of
   trigram sets, one of which must be wholly present (letters in lower case).
2. The index holds the postings (trigram, document) of the trigrams that occur in queries.
3. Postings are intersected per (document, rule, clause, alternative); documents that satisfy every clause of a rule
   are its candidates.
4. Candidates are verified with the regular expression on the whole text.  A rule without mandatory trigrams is
   verified on every text.

Positions come from the pieces between matches (``split``) and the matches themselves, so they count code points.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelcast.llm.common import lower_ascii, sized_broadcast, stage_table


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0          # the group whose length counts
    least: int = 1          # code points that group must have
    base: bool = False


KEYWORDS = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" \
    + _either_case("api") + "_?" + _either_case("key")
# the contract's rules (fixed values), in the order in which kinds are listed
BASE_RULES = (
    Rule("assign", rf"""({KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]+", 0, 24, True),
)
# the method's own rules: public formats of issued credentials
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
)
MAX_STRINGS = 64            # literal alternatives that are followed side by side before a clause is closed


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Clauses that every match satisfies: for each clause one of its trigram sets lies wholly in the text.  No
    clause: the pattern has no mandatory trigrams."""
    clauses: list[list[frozenset[str]]] = []

    def close(strings: set[str]) -> None:
        sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
        if sets and all(sets):
            clauses.append(sorted((x for x in sets if not any(y < x for y in sets)), key=sorted))

    def follow(items, strings: set[str], nested: bool) -> set[str] | None:
        """Strings with which a match of ``items`` may end, after ``strings``; below a choice or an option no clause
        can be closed, so what has too many strings there is None."""
        for op, arg in items:
            name, options = str(op), None
            if name == "LITERAL":
                options = {chr(arg).lower()}
            elif name == "AT":
                options = {""}
            elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
                options = {chr(v).lower() for _, v in arg}
            elif name == "SUBPATTERN":
                strings = follow(arg[-1], strings, nested)
                if strings is None:
                    return None
                continue
            elif name == "BRANCH":
                ends = [follow(branch, {""}, True) for branch in arg[1]]
                options = None if None in ends else set().union(*ends)
            elif name == "MAX_REPEAT" and arg[0] == arg[1] <= 4 or name == "MAX_REPEAT" and arg[:2] == (0, 1):
                options = follow(list(arg[2]) * arg[1], {""}, True)
                if options is not None and arg[0] == 0:
                    options = options | {""}
            if options is None or len(strings) * len(options) > MAX_STRINGS:
                if nested:
                    return None
                close(strings)
                strings = {""} if options is None or len(options) > MAX_STRINGS else options
                continue
            strings = {s + o for s in strings for o in options}
        return strings

    close(follow(re._parser.parse(pattern), {""}, False))
    return clauses


def _query_terms(rules) -> list[tuple[str, int, int, str, int]]:
    """(rule, clause, alternative, trigram, trigrams of the alternative)."""
    return [(r.kind, c, a, t, len(need)) for r in rules for c, clause in enumerate(trigram_query(r.pattern))
            for a, need in enumerate(clause) for t in sorted(need)]


def postings(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, key) of the query trigrams that stand in each text."""
    low = lower_ascii(F.col("text"))
    present = F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in trigrams])
    return rows.select("key", low.alias("low")).select("key", F.explode(F.array_compact(present)).alias("trigram"))


def candidate_rules(rows: DataFrame, rules) -> DataFrame:
    """(key, kinds): the rules whose Boolean query each text satisfies."""
    spark = rows.sparkSession
    terms = _query_terms(rules)
    table = F.broadcast(spark.createDataFrame(terms, "kind string, clause int, alt int, trigram string, need int"))
    n_clauses = F.create_map(*[F.lit(x) for r in rules for x in (r.kind, len(trigram_query(r.pattern)))])
    full = (postings(rows, sorted({t[3] for t in terms})).join(table, "trigram")
            .groupBy("key", "kind", "clause", "alt", "need").agg(F.count_distinct("trigram").alias("have"))
            .where("have = need"))
    return (full.groupBy("key", "kind").agg(F.count_distinct("clause").alias("met"))
            .where(F.col("met") == n_clauses[F.col("kind")])
            .groupBy("key").agg(F.collect_set("kind").alias("kinds")))


def matches(text: Column, rule: Rule) -> Column:
    """Array of (start, order, kind, end) of the rule's leftmost non-overlapping matches, short ones dropped."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    gaps = F.split(text, rule.pattern)
    pieces = F.arrays_zip(found.alias("m"), counted.alias("g"), gaps.alias("gap"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc, p):
        begin = acc["at"] + F.length(p["gap"])
        end = begin + F.coalesce(F.length(p["m"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"))
        # only what is long enough is appended: an append copies the array, and short pieces may be many
        return F.struct(end.alias("at"), F.when(F.length(p["g"]) >= rule.least, F.concat(acc["out"], F.array(span)))
                        .otherwise(acc["out"]).alias("out"))

    return F.aggregate(pieces, start, step, lambda acc: acc["out"])


def _tagged(text: Column, rule: Rule, order: int) -> Column:
    return F.transform(matches(text, rule), lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"), s["end"].alias("end")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


SPAN = "array<struct<start:int,ord:int,kind:string,end:int>>"


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=BASE_RULES + MORE_RULES) -> DataFrame:
    """(id, one count n_<kind> per base rule, base_sha256, spans, found), one row per distinct input row.

    ``found`` is the array of spans (start, ord, kind, end) in code points, end exclusive.  Null or empty texts have
    no spans; equal starts come in the rules' order; a null id is an id like others; rows repeated whole give one
    row; other columns are not read; an empty table gives an empty result.
    """
    rows = df.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), F.col(id_col).alias("id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = {r.kind: i for i, r in enumerate(rules)}
    indexed = [r for r in rules if trigram_query(r.pattern)]
    scanned = [r for r in rules if not trigram_query(r.pattern)]
    none = F.array().cast(SPAN)
    # cheap test first: few texts have a long enough run, and the pieces are only cut for those
    everywhere = F.concat(none, *[F.when(F.col("text").rlike(_run_of(r)), _tagged(F.col("text"), r, order[r.kind]))
                                  .otherwise(none) for r in scanned])
    full = rows.select("key", "id", everywhere.alias("spans"))
    found = rows.join(sized_broadcast(stage_table(candidate_rules(rows, indexed))), "key")
    verified = found.select("key", "id", F.concat(none, *[
        F.when(F.array_contains("kinds", r.kind), _tagged(F.col("text"), r, order[r.kind])).otherwise(none)
        for r in indexed]).alias("spans")).where(F.size("spans") > 0)
    spans = full.union(verified).groupBy("key", "id").agg(
        F.array_distinct(F.flatten(F.collect_list("spans"))).alias("found"))
    base = [r.kind for r in rules if r.base]
    of = lambda kinds: F.filter("found", lambda s: s["kind"].isin(kinds))
    return spans.select(
        F.col("id").alias(id_col), *[F.size(of([k])).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(_joined(of(base)), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"),
        F.array_sort("found").alias("found"))


def _run_of(rule: Rule) -> str:
    """A pattern that a text must match to have a match long enough: a class followed by ``+`` must run on."""
    single = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    return rf"{single[1]}{{{rule.least},}}" if single else rule.pattern


def op5_trigram_secrets(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("found")


def _sql() -> str:
    """The same result in DuckDB: pieces between matches, running sums of lengths."""
    parts = []
    for i, r in enumerate(BASE_RULES + MORE_RULES):
        pattern = r.pattern.replace("'", "''")
        parts.append(f"""
  SELECT doc_id, {i} AS ord, '{r.kind}' AS kind, {r.base} AS base, {r.least} AS least,
    regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {r.group}) AS g,
    string_split_regex(t, '{pattern}') AS gap FROM d""")
    union = " UNION ALL ".join(parts)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({union}),
one AS (SELECT doc_id, ord, kind, base, least, m, g, gap, unnest(range(1, len(m) + 1)) AS i FROM found WHERE len(m) > 0),
pos AS (
  SELECT doc_id, ord, kind, base, length(g[i]) >= least AS ok,
    list_sum(list_transform(gap[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s, length(m[i]) AS n
  FROM one),
agg AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, ord)
      FILTER (base) AS b,
    string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, ord) AS a
  FROM pos WHERE ok GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM d LEFT JOIN agg USING (doc_id)
"""


ORACLE_SQL = _sql()
