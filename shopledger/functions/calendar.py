"""Date and time expressions on zone-free timestamps.

All of them go through ``date`` or interval arithmetic and never through a zoned
timestamp, so a session in a zone with daylight saving gives the same answers.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopledger.params import Period

# English short names in calendar order.
WEEKDAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def ntz(moment: datetime) -> Column:
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def within(ts: Column, period: Period) -> Column:
    return ts.between(ntz(period.start), ntz(period.end))


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "MM").cast("timestamp_ntz")


def iso_weekday(ts: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(ts) + F.lit(1)


def _pick(names: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def weekday_name(day_number: Column) -> Column:
    return _pick(WEEKDAY_NAMES, day_number)


def month_name(ts: Column) -> Column:
    return _pick(MONTH_NAMES, F.month(ts))


def iso_text(ts: Column) -> Column:
    """``2024-03-01T00:00:00`` for a timestamp with whole seconds."""
    return F.translate(ts.cast("string"), " ", "T")


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with their fraction, as an exact decimal."""
    return (end - start).cast("interval second").cast("decimal(18,6)")
