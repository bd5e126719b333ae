"""Timestamp and date expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WINDOWS = ("hour", "day", "week", "month")


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def millis_to_timestamp(millis: Column) -> Column:
    """Epoch milliseconds held in a string; anything that is not a number gives null."""
    return F.timestamp_millis(millis.try_cast("bigint"))


def parse_date(text: Column, pattern: str) -> Column:
    """Date in the given pattern, null when it does not match.

    A day may have one or two digits and a month name may be short or full, whichever the
    pattern names.
    """
    lenient = pattern.replace("dd", "d")
    patterns = [pattern, lenient]
    if "MMM" in pattern and "MMMM" not in pattern:
        patterns.append(lenient.replace("MMM", "MMMM"))
    parsed = [F.try_to_timestamp(F.trim(text), F.lit(p)) for p in dict.fromkeys(patterns)]
    return F.coalesce(*parsed).cast("date")


def date_parts(ts: Column) -> dict[str, Column]:
    """The bucket columns of an event: date and its parts as zero-padded strings."""
    patterns = {"date": "yyyy-MM-dd", "year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return {name: F.date_format(ts, pattern) for name, pattern in patterns.items()}


def closest_weekday(day: Column) -> Column:
    """The date itself, or the Friday before for a Saturday or Sunday."""
    weekday = F.dayofweek(day)  # 1 is Sunday, 7 is Saturday
    return F.when(weekday == 1, F.date_sub(day, 2)).when(weekday == 7, F.date_sub(day, 1)).otherwise(day)


def bucket_start(ts: Column, window: str, week_mode: str = "calendar") -> Column:
    """Start of the tumbling bucket a timestamp falls in.

    ``week_mode="calendar"`` starts weeks on Monday, ``"epoch"`` on Thursday: seven-day windows
    counted from 1970-01-01.
    """
    if window not in WINDOWS:
        raise ValueError(f"window must be one of {WINDOWS}, not {window!r}")
    if week_mode not in ("calendar", "epoch"):
        raise ValueError("week_mode must be 'calendar' or 'epoch'")
    if window in ("hour", "day") or (window == "week" and week_mode == "epoch"):
        return F.window(ts, f"1 {window}").getField("start")
    return F.date_trunc(window, ts)


def loose_timestamp(text: Column) -> Column:
    """A timestamp in one of the layouts mail providers send, else null."""
    bare = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", "")
    patterns = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss", "yyyy/MM/dd HH:mm:ss")
    return F.coalesce(
        F.try_to_timestamp(bare), *[F.try_to_timestamp(bare, F.lit(p)) for p in patterns]
    )
