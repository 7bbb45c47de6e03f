"""Tokenisers as Column -> Column expressions.

The dictionary segmenter of the original system is not available; the rules
that do not depend on it are kept (length rules, digits, case, stop words) and
Han runs are cut into overlapping character bigrams.  Every operator that
tokenises takes the tokenizer as an argument, so another Column expression
can replace it.
"""

from __future__ import annotations

import os
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelcast.functions.columns import col

# Han run | letter run without Han | ASCII digit run  (Java regex)
TOKEN_PATTERN = r"\p{IsHan}+|[^\P{L}\p{IsHan}]+|[0-9]+"
HAN_RUN = r"^\p{IsHan}+$"
DIGITS = r"^[0-9]+$"
# strings are compared by their UTF-8 bytes: what begins with a digit is below ":", what begins with a Han character is
# not below the first one (U+2E80); the comparison spares most tokens the regular expression
AFTER_DIGITS, FIRST_HAN = ":", "\u2e80"


STOPWORDS_FILE = os.path.join(os.path.dirname(os.path.dirname(__file__)), "resources", "stopwords.txt")


@lru_cache(maxsize=1)
def default_stop_words() -> tuple[str, ...]:
    """Spark ML's bundled stop-word lists (english, french, german, spanish),
    lower-cased and merged into one file shipped with the package."""
    with open(STOPWORDS_FILE, encoding="utf-8") as fh:
        return tuple(w.strip() for w in fh if w.strip())


def is_digits(t: Column) -> Column:
    return (t < AFTER_DIGITS) & t.rlike(DIGITS)


def is_han(t: Column) -> Column:
    return (t >= FIRST_HAN) & t.rlike(HAN_RUN)


def raw_tokens(text) -> Column:
    """Lower-cased token sequence; Han runs longer than 2 become bigrams."""
    lower = F.lower(col(text))
    toks = F.regexp_extract_all(lower, F.lit(TOKEN_PATTERN), 0)
    return F.when(lower.rlike(r"\p{IsHan}{3}"), F.flatten(F.transform(toks, lambda t: F.when(
        is_han(t) & (F.length(t) > 2),
        F.transform(F.sequence(F.lit(1), F.length(t) - 1), lambda i: F.substring(t, i, 2)),
    ).otherwise(F.array(t))))).otherwise(toks)


def keep_token(t: Column, stop_words=None) -> Column:
    """Digits always; 1-char tokens never; Latin tokens only when > 2 chars;
    Han bigrams kept; stop words removed."""
    stops = default_stop_words() if stop_words is None else tuple(stop_words)
    ok = (is_digits(t)
          | ((F.length(t) > 2) & ~is_han(t))
          | ((F.length(t) == 2) & is_han(t)))
    if stops:
        ok = ok & ~t.isin(*stops)
    return ok


def tokenize_words(text, stop_words=None) -> Column:
    """Sentence -> filtered tokens; a sentence of length <= 2 is its own token."""
    s = col(text)
    return F.when(F.length(s) <= 2, F.array(s)).otherwise(
        F.filter(raw_tokens(s), lambda t: keep_token(t, stop_words)))


def tokenize_chars(text) -> Column:
    """Runs of a-z stay together, every other character is a token."""
    return F.regexp_extract_all(F.lower(col(text)), F.lit("([a-z]+|.)"), 1)


def normalize_release_name(text) -> Column:
    """File-style release names: dots become spaces."""
    return F.regexp_replace(col(text), r"\.", " ")


def token_source(text) -> Column:
    """The tokens before the token rules (a text of length <= 2 is its own token); the rules of :func:`tokenize_words`
    are then a filter on rows, see :func:`keep_row`."""
    s = col(text)
    return F.when(F.length(s) <= 2, F.array(s)).otherwise(raw_tokens(s))


def keep_row(short: Column, token: Column, stop_words=None) -> Column:
    """Whether an exploded token of :func:`token_source` stays; ``short``: its text has length <= 2.  As a filter on
    rows this is compiled; inside a generator every call is interpreted."""
    return token.isNotNull() & (short | keep_token(token, stop_words))
