"""Scalar column expressions: clock times, keys, flags, hashing, scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Col = Column | str


def as_col(c: Col) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- clock times -------------------------------------------------------------

def padded_hhmm(clock: Col) -> Column:
    """Four-digit text of an HHMM number that lost its leading zeros (5 -> '0005')."""
    return F.lpad(as_col(clock).cast("string"), 4, "0")


def hour_text(clock: Col) -> Column:
    """Two-digit hour of an HHMM number."""
    return F.substring(padded_hhmm(clock), 1, 2)


def hour_of(clock: Col) -> Column:
    """Hour of an HHMM number as an integer."""
    return F.floor(as_col(clock).cast("int") / 100).cast("int")


def minute_of_day(clock: Col) -> Column:
    """Minutes since midnight of an HHMM number; differences are real minutes."""
    number = as_col(clock).cast("int")
    return (F.floor(number / 100) * 60 + number % 100).cast("int")


def day_of(date_text: Col) -> Column:
    """Date from text that starts with yyyy-MM-dd; null when it does not parse."""
    return F.try_to_date(F.substring(as_col(date_text), 1, 10), "yyyy-MM-dd")


def scheduled_hour(date_text: Col, clock: Col) -> Column:
    """Timestamp (no zone) of the hour in which an HHMM time falls; null past 23:59."""
    hour = hour_of(clock)
    start = day_of(date_text).cast("timestamp_ntz")
    return F.when(hour < 24, start + F.make_dt_interval(F.lit(0), hour))


def hour_floor(ts: Col) -> Column:
    """Start of the hour of a zone-less timestamp, free of the session zone."""
    ts = as_col(ts)
    return F.to_date(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def shift_hours(ts: Col, hours: int) -> Column:
    return as_col(ts) + F.expr(f"INTERVAL '{hours}' HOUR")


def to_utc(ts: Col, zone: Col) -> Column:
    """UTC reading of a local clock time in the row's own IANA zone, free of the session zone."""
    return F.convert_timezone(as_col(zone), F.lit("UTC"), as_col(ts).cast("timestamp_ntz"))


def slash_date(text: Col) -> Column:
    """Date from month/day/year text; two-digit years belong to the 2000s."""
    parts = F.split(as_col(text), "/")
    month, day, year = (F.get(parts, F.lit(i)) for i in range(3))
    full_year = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
    dash = F.lit("-")
    return F.try_to_date(F.concat(full_year, dash, month, dash, day), "yyyy-M-d")


# -- keys and flags ----------------------------------------------------------

def composite_id(*parts: Col, sep: str = "-") -> Column:
    """Parts joined by ``sep``; null as soon as one part is null."""
    pieces: list[Column] = []
    for position, part in enumerate(parts):
        if position:
            pieces.append(F.lit(sep))
        pieces.append(as_col(part).cast("string"))
    return F.concat(*pieces)


def prefixed(prefix: str, c: Col) -> Column:
    return F.concat(F.lit(prefix), as_col(c).cast("string"))


def contains_flag(text: Col, needle: str) -> Column:
    """1 where the text contains the needle, else 0 (also for null text)."""
    return F.coalesce(F.contains(as_col(text), F.lit(needle)).cast("int"), F.lit(0))


def code_flags(text: Col, flags: Mapping[str, str]) -> dict[str, Column]:
    return {name: contains_flag(text, needle) for name, needle in flags.items()}


def clamp_low(c: Col, low: float = 0.0) -> Column:
    """Value, but never below ``low``; null stays null."""
    c = as_col(c)
    return F.when(c < low, F.lit(low)).otherwise(c)


# -- reproducible randomness -------------------------------------------------

def unit_hash(*keys: Col, salt: str = "") -> Column:
    """Number in [0, 1) fixed by the key alone, so a re-run or retried task draws it again."""
    text = F.concat_ws("|", *[as_col(k).cast("string") for k in keys])
    if salt:
        text = F.concat(F.lit(salt), text)
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


# -- scores ------------------------------------------------------------------

def ratio(numerator: Col, denominator: Col) -> Column:
    """Quotient, 0 where the denominator is 0."""
    numerator, denominator = as_col(numerator), as_col(denominator)
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def f_beta(beta: float, precision: Col, recall: Col) -> Column:
    """F-beta score, 0 where precision and recall are both 0."""
    p, r = as_col(precision), as_col(recall)
    return F.when(p + r == 0, F.lit(0.0)).otherwise(
        (1 + beta * beta) * (p * r) / ((beta * beta) * p + r)
    )


def add_up(columns: Sequence[Col]) -> Column:
    return reduce(lambda a, b: a + b, [as_col(c) for c in columns])
