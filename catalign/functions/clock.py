"""Daily processing slots."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalign.functions import fixed


def _slot_starts(ts: Column, day_shift: int = 0) -> list[Column]:
    day = F.date_add(ts.cast("date"), day_shift).cast("timestamp_ntz")
    starts = []
    for slot in fixed.SLOTS:
        hour, minute = map(int, slot.split(":"))
        starts.append(day + F.make_dt_interval(F.lit(0), F.lit(hour), F.lit(minute)))
    return starts


def next_window(ts: Column) -> Column:
    """Start of the next slot after ``ts``, else tomorrow's first slot."""
    arms = [F.when(start > ts, start) for start in _slot_starts(ts)]
    return F.coalesce(*arms, _slot_starts(ts, 1)[0])


def next_window_name(ts: Column) -> Column:
    arms = [F.when(start > ts, F.lit(name)) for start, name in zip(_slot_starts(ts), fixed.SLOTS)]
    return F.coalesce(*arms, F.lit(f"{fixed.SLOTS[0]} (next day)"))


def active_window(ts: Column) -> Column:
    """Name of the slot that is open at ``ts`` (both ends count), else null."""
    length = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(fixed.SLOT_MINUTES))
    return F.coalesce(*[F.when((start <= ts) & (ts <= start + length), F.lit(name))
                        for start, name in zip(_slot_starts(ts), fixed.SLOTS)])


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a wall-clock time, whatever the session's time zone."""
    whole = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return whole * 1000000 + (F.extract(F.lit("SECOND"), ts) * 1000000).cast("long")


def utc_instant(ts: Column) -> Column:
    """A wall-clock time read as UTC, for event time in streams."""
    return F.timestamp_micros(micros(ts))


def utc_wall(instant: Column) -> Column:
    """The UTC wall-clock time of an instant."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def minutes_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / 60000000.0


def minutes_left(ts: Column) -> Column:
    length = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(fixed.SLOT_MINUTES))
    return F.coalesce(*[F.when((start <= ts) & (ts <= start + length), minutes_between(ts, start + length))
                        for start in _slot_starts(ts)])


def expected_completion(upload: Column) -> Column:
    return next_window(upload) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(fixed.SLOT_MINUTES))
