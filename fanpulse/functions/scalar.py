"""Column helpers (all JVM-side built-ins; no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num: ColumnOrName, den: ColumnOrName) -> Column:
    """NULL on a zero or NULL denominator (ANSI ``/`` would raise)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def whole_minutes(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole minutes from start to end, truncated toward zero (30m59s -> 30)."""
    return F.timestamp_diff("MINUTE", col(start), col(end))


def whole_seconds(start: ColumnOrName, end: ColumnOrName) -> Column:
    return F.timestamp_diff("SECOND", col(start), col(end))


def count_if(cond: Column) -> Column:
    """COUNTIF: rows where cond is true; NULL counts as false; 0 on empty input."""
    return F.count(F.when(cond, F.lit(1)))


def min_if(cond: Column, value: ColumnOrName) -> Column:
    return F.min(F.when(cond, col(value)))


def first_by_time(value: ColumnOrName, ts: ColumnOrName, tiebreak: ColumnOrName) -> Column:
    """Value of the earliest row, ties broken by ``tiebreak`` (tie-safe ANY_VALUE HAVING MIN)."""
    return F.min_by(col(value), F.struct(col(ts), col(tiebreak)))


def campaign_key(channel: ColumnOrName, day: ColumnOrName, paid: tuple[str, ...]) -> Column:
    """``{channel}_{yyyyMMdd}`` for paid channels, NULL otherwise."""
    channel = col(channel)
    return F.when(
        channel.isin(*paid), F.concat_ws("_", channel, F.date_format(col(day), "yyyyMMdd"))
    )


def calendar_columns(day: ColumnOrName) -> dict[str, Column]:
    """Calendar attributes of a date (ISO week, Monday = 1)."""
    d = col(day)
    dow = F.weekday(d) + 1
    return {
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "iso_week": F.weekofyear(d),
        "day_of_week": dow,
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": dow >= 6,
    }


def add_minutes(ts: ColumnOrName, minutes: int | Column) -> Column:
    m = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), m)


def bin_of(ts: ColumnOrName, seconds: int) -> Column:
    """Fixed-width time bin index of a timestamp (UTC epoch based)."""
    return F.floor(F.unix_micros(col(ts).cast("timestamp")) / F.lit(seconds * 1_000_000)).cast("long")
