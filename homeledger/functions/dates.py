"""Dates as native column expressions. ``published_at`` is a timestamp without zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F, types as T

from homeledger.functions.numbers import try_number
from homeledger.functions.text import strip_edges

_DMY = r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})"
_MDY = r"^(0?[1-9]|1[0-2])[/.-](\d{1,2})[/.-](\d{4})"
_MONTH_THEN_LATE_DAY = r"^(\d{1,2})[/.-](1[3-9]|[23]\d)[/.-](\d{4})"
_YMD = r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})"


def parse_published_at(c: Column, day_first: bool = False, strict_format: str | None = None) -> Column:
    """Text to timestamp, each row on its own; what is no date becomes null.

    Slashed dates are rewritten to year-month-day by pattern, then cast, so that a bad
    value costs no parser exception. ``day_first`` settles 5/6/2025; a number above 12
    cannot be a month and settles itself.
    """
    if strict_format is not None:
        return F.try_to_timestamp(c, F.lit(strict_format)).cast("timestamp_ntz")
    t = F.regexp_replace(strip_edges(c), _YMD, "$1-$2-$3")
    if day_first:
        t = F.regexp_replace(t, _MONTH_THEN_LATE_DAY, "$3-$1-$2")
    else:
        t = F.regexp_replace(t, _MDY, "$3-$1-$2")
    t = F.regexp_replace(t, _DMY, "$3-$2-$1")
    return t.try_cast("timestamp_ntz")


def published_at_of(c: Column, dtype: T.DataType, day_first: bool = False,
                    strict_format: str | None = None) -> Column:
    """``parse_published_at`` for text, a cast for a column that is already a time."""
    if isinstance(dtype, T.StringType):
        return parse_published_at(c, day_first, strict_format)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp_ntz")
    return F.lit(None).cast("timestamp_ntz")


def date_parts(c: Column) -> dict[str, Column]:
    """Year, month, day and weekday (0 is Monday)."""
    return {
        "posted_year": F.year(c),
        "posted_month": F.month(c),
        "posted_day": F.dayofmonth(c),
        "posted_dayofweek": F.weekday(c),
    }


def month_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def day_label(c: Column) -> Column:
    return F.to_date(c)


def end_of_day(day: str) -> Column:
    """Last whole second of a day; a fraction after it is outside."""
    end = dt.datetime.fromisoformat(day) + dt.timedelta(days=1) - dt.timedelta(seconds=1)
    return F.lit(end.isoformat(sep=" ")).cast("timestamp_ntz")


def start_of_day(day: str) -> Column:
    return F.lit(dt.datetime.fromisoformat(day).isoformat(sep=" ")).cast("timestamp_ntz")


def epoch_to_timestamp(c: Column, zone: str | None = None) -> Column:
    """Epoch number, or numeric text, to local ``yyyy-MM-dd HH:mm:ss`` text.

    Above 1e10 the number counts milliseconds. ``zone`` defaults to the session's.
    """
    v = try_number(c)
    seconds = F.floor(F.when(v > 10_000_000_000, v / 1000).otherwise(v))
    # years 1 to 9999, what a date can hold
    held = F.when(seconds.between(-62_135_596_800, 253_402_300_799), seconds)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = epoch + F.make_dt_interval(secs=held.cast("decimal(18,6)"))
    target = F.current_timezone() if zone is None else F.lit(zone)
    return F.date_format(F.convert_timezone(F.lit("UTC"), target, utc), "yyyy-MM-dd HH:mm:ss")
