"""Clock-free date and time helpers.

Timestamps are zone-less. Several Spark functions return zoned timestamps for
zone-less input, so results are cast back; jobs run with the session clock on UTC.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

_SECONDS = {"second": 1, "minute": 60, "hour": 3600}


def at(moment: datetime | str) -> Column:
    """Literal zone-less timestamp; folds to a constant, so Parquet filters can use it."""
    if isinstance(moment, datetime):
        if moment.tzinfo is not None:
            moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
        moment = moment.isoformat(sep=" ")
    return F.lit(moment).cast("timestamp_ntz")


def on(day: date | str) -> Column:
    return F.lit(str(day)).cast("date")


def unix_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def datediff_boundary(unit: str, start: Column, end: Column) -> Column:
    """Number of ``unit`` boundaries crossed between two moments.

    Elapsed-time functions truncate towards zero instead: 00:00:00.9 to 00:00:02.1
    crosses two second boundaries although only 1.2 s elapse.
    """
    if unit in _SECONDS:
        size = _SECONDS[unit]
        first, last = unix_seconds(start), unix_seconds(end)
        if size == 1:
            return last - first
        return F.floor(last / size) - F.floor(first / size)
    if unit == "day":
        return F.datediff(end, start)
    if unit == "month":
        return (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))
    if unit == "year":
        return F.year(end) - F.year(start)
    raise ValueError(f"unsupported unit {unit!r}")


def trunc_ts(unit: str, ts: Column) -> Column:
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def trunc_date(unit: str, day: Column) -> Column:
    return F.trunc(day, unit)


def dateadd(unit: str, amount: Column | int, ts: Column) -> Column:
    count = F.lit(amount) if isinstance(amount, int) else amount
    if unit == "second":
        return ts + F.make_dt_interval(secs=count)
    if unit == "minute":
        return ts + F.make_dt_interval(mins=count)
    if unit == "hour":
        return ts + F.make_dt_interval(hours=count)
    if unit == "day":
        return ts + F.make_dt_interval(days=count)
    if unit == "month":
        return ts + F.make_ym_interval(months=count)
    if unit == "year":
        return ts + F.make_ym_interval(years=count)
    raise ValueError(f"unsupported unit {unit!r}")


def date_part(part: str, ts: Column) -> Column:
    return F.date_part(F.lit(part), ts)


def timestamp_text(ts: Column) -> Column:
    """Fixed text form, so hashes over it do not depend on session formats."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def to_timestamp(text: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Zone-less timestamp of a text; NULL if it does not follow the pattern."""
    return F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
