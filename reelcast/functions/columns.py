"""Column-level building blocks (pure Catalyst expressions, no Python UDFs)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelcast import config as C


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- time
def epoch_of(ts) -> Column:
    """Epoch seconds of a timestamp / timestamp_ntz column (session zone UTC)."""
    return F.unix_seconds(col(ts).cast("timestamp"))


def day_epoch(ts) -> Column:
    """Epoch seconds of the UTC midnight of a timestamp."""
    return epoch_of(F.date_trunc("day", col(ts).cast("timestamp")))


def as_epoch(as_of) -> int:
    """Accept epoch seconds, a date/datetime or an ISO string."""
    if isinstance(as_of, (int, float)):
        return int(as_of)
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    if isinstance(as_of, _dt.date) and not isinstance(as_of, _dt.datetime):
        as_of = _dt.datetime(as_of.year, as_of.month, as_of.day)
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=_dt.timezone.utc)
    return int(as_of.timestamp())


def midnight_epoch(as_of, days_back: int = 0) -> int:
    """Midnight (UTC) of ``as_of`` minus ``days_back`` days, as epoch seconds."""
    e = as_epoch(as_of)
    return (e // 86400 - days_back) * 86400


def yyyymmdd(as_of, days_back: int = 0) -> int:
    d = _dt.datetime.fromtimestamp(midnight_epoch(as_of, days_back), _dt.timezone.utc)
    return int(d.strftime("%Y%m%d"))


def yyyymmdd_col(ts) -> Column:
    return F.date_format(col(ts), "yyyyMMdd").cast("int")


def whole_days(as_of_epoch: int, epoch_col) -> Column:
    """Whole elapsed days between an action and ``as_of`` (clamped at 0)."""
    return F.greatest(F.floor((F.lit(as_of_epoch) - col(epoch_col)) / F.lit(86400)), F.lit(0))


def time_decay(as_of_epoch: int, epoch_col) -> Column:
    """``1 / (ln(days + 1) + 1)``."""
    return F.lit(1.0) / (F.log(whole_days(as_of_epoch, epoch_col) + F.lit(1)) + F.lit(1.0))


def local_date(epoch_col, zone: str = C.HOME_ZONE) -> Column:
    """Epoch seconds -> ``yyyy-MM-dd`` in a named zone; null -> ''."""
    ts = F.from_utc_timestamp(F.timestamp_seconds(col(epoch_col)), zone)
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd"), F.lit(""))


def slice_index(ts, epoch=C.SLICE_EPOCH) -> Column:
    """Number of the 10-day log slice (3 per month) a timestamp falls in."""
    y0, m0, d0 = epoch
    b0 = 10 if d0 <= 10 else (20 if d0 <= 20 else 30)
    d = F.dayofmonth(col(ts))
    bucket = F.when(d <= 10, 10).when(d <= 20, 20).otherwise(30)
    return ((F.year(col(ts)) - y0) * 36 + (F.month(col(ts)) - m0) * 3
            + F.floor((bucket - F.lit(b0)) / F.lit(10)).cast("int"))


# ---------------------------------------------------------------- json
def json_long(payload, path: str) -> Column:
    return F.get_json_object(col(payload), path).try_cast("bigint")


def json_double(payload, path: str) -> Column:
    return F.get_json_object(col(payload), path).try_cast("double")


# ---------------------------------------------------------------- weights
def play_tier(play_min, movie_len) -> Column:
    """Points of one play: <=6 min -> 1; within the known length by ratio
    (<0.3 -> 2, <0.6 -> 3, else 4); longer than the length or length unknown
    (-10) by absolute minutes (<30 -> 2, <60 -> 3, else 4).  No play -> 0."""
    p, ln = col(play_min), col(movie_len)
    r_lo, r_hi = C.PLAY_RATIO_BOUNDS
    m_lo, m_hi = C.PLAY_MINUTE_BOUNDS
    p1, p2, p3, p4 = C.POINTS_PLAY
    ratio = p / F.when(ln > 0, ln)
    return (F.when(p == C.MISSING, F.lit(0))
            .when(p <= C.PLAY_SHORT_MIN, F.lit(p1))
            .when(p <= ln, F.when(ratio < r_lo, p2).when(ratio < r_hi, p3).otherwise(p4))
            .otherwise(F.when(p < m_lo, p2).when(p < m_hi, p3).otherwise(p4)))


def play_score(play_min, movie_len, total_num) -> Column:
    """Tier points divided by the number of episodes."""
    tier = play_tier(play_min, movie_len)
    return F.when(col(play_min) == C.MISSING, F.lit(0.0)).otherwise(
        tier / F.when(col(total_num) != 0, col(total_num)).otherwise(F.lit(1)))


def action_weight(decay: Column, click, top, play_points: Column) -> Column:
    """``round(decay * (click*2 + top*4 + play), 4)``."""
    return F.round(decay * (col(click).cast("int") * C.POINTS_CLICK
                            + col(top).cast("int") * C.POINTS_TOP + play_points), 4)


def log_decay(x) -> Column:
    """``1 / (ln(x + 1) + 1)`` used by hot factor and rank decay."""
    return F.lit(1.0) / (F.log(col(x) + F.lit(1)) + F.lit(1.0))


def score_factor(score) -> Column:
    d = F.lit(float(C.SCORE_MAX)) - col(score)
    return F.round(F.when(col(score) >= C.SCORE_PIVOT, F.lit(1.0) / (F.log(d + 1) + 1))
                   .otherwise(F.lit(1.0) / F.pow(F.lit(2.0), d - 1)), 4)


def year_factor(year_int, now_year: int, variety: Column | bool) -> Column:
    delta = F.lit(now_year) - col(year_int)
    log_form = F.lit(1.0) / (F.log2(delta + 1) + 1)
    exp_form = F.lit(1.0) / F.pow(F.lit(2.0), delta / F.lit(10.0))
    v = variety if isinstance(variety, Column) else F.lit(bool(variety))
    return F.round(F.when(v, log_form).otherwise(exp_form), 4)


def clean_year(year, now_year: int) -> Column:
    y = col(year).cast("string").try_cast("int")
    return F.when(y.isNull() | (y <= 0) | (y > now_year), F.lit(now_year - 5)).otherwise(y)


# ---------------------------------------------------------------- vectors
def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def norm_title(title) -> Column:
    return F.lower(F.trim(col(title)))


def last2(t: Column) -> Column:
    return F.substring(t, -2, 2)


def first_fourth(t: Column) -> Column:
    """First character + fourth character (empty when missing)."""
    return F.concat(F.substring(t, 1, 1), F.substring(t, 4, 1))
