"""Time expressions. Times are without zone and mean UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from devsignals import params


def moment(value: dt.datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def day(value: dt.date) -> Column:
    return F.lit(value.isoformat()).cast("date")


def from_epoch_seconds(seconds: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds)


def to_epoch_seconds(value: dt.datetime | dt.date) -> int:
    """Seconds since 1970 of a time without zone (UTC), or of the begin of a day."""
    moment_ = value if isinstance(value, dt.datetime) else dt.datetime(value.year, value.month, value.day)
    return (moment_ - dt.datetime(1970, 1, 1)) // dt.timedelta(seconds=1)


def micros_between(start: Column, end: Column) -> Column:
    """Whole microseconds from start to end, independent of the session time zone."""
    gap = end - start
    seconds = (
        F.extract(F.lit("DAY"), gap).cast("bigint") * 86400
        + F.extract(F.lit("HOUR"), gap).cast("bigint") * 3600
        + F.extract(F.lit("MINUTE"), gap).cast("bigint") * 60
    )
    return seconds * 1000000 + (F.extract(F.lit("SECOND"), gap) * 1000000).cast("bigint")


def minutes_between(start: Column, end: Column) -> Column:
    return micros_between(start, end).cast("double") / F.lit(60e6)


def hours_between(start: Column, end: Column) -> Column:
    """Hours with one decimal, half away from zero."""
    from devsignals.functions.numeric import rounded_ratio

    return rounded_ratio(micros_between(start, end), F.lit(3_600_000_000), 1)


def duration_text(start: Column, end: Column) -> Column:
    """`1h 18m` or `18m`; negative gaps count as zero, NULL gives 'Unknown'."""
    seconds = F.greatest(F.call_function("div", micros_between(start, end), F.lit(1_000_000)), F.lit(0))
    hours = F.call_function("div", seconds, F.lit(3600))
    minutes = F.call_function("div", seconds % 3600, F.lit(60))
    return (
        F.when(start.isNull(), F.lit(params.UNKNOWN_TEXT))
        .when(hours > 0, F.format_string("%dh %dm", hours, minutes))
        .otherwise(F.format_string("%dm", minutes))
    )


def week_start(date: Column) -> Column:
    """Monday of the week."""
    return F.trunc(date, "week")


def freshness_label(age_hours: Column) -> Column:
    return (
        F.when(age_hours.isNull(), "unknown")
        .when(age_hours <= params.FRESH_HOURS, "fresh")
        .when(age_hours <= params.STALE_HOURS, "stale")
        .otherwise("error")
    )


def date_window(end: dt.date, days: int = params.DEFAULT_WINDOW_DAYS) -> tuple[dt.date, dt.date]:
    """The look-back range ending at `end`."""
    return checked_range(end - dt.timedelta(days=days), end)


def checked_range(start: dt.date, end: dt.date) -> tuple[dt.date, dt.date]:
    if start > end:
        raise ValueError(f"start {start} lies after end {end}")
    return start, end
