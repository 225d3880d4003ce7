"""Report days and epoch conversions with an explicit zone.

Everything here is independent of ``spark.sql.session.timeZone``: epoch values
become TIMESTAMP_NTZ wall clocks through integer arithmetic, and zone shifts go
through ``convert_timezone`` with a named zone. Day filters are half-open ranges
on the raw epoch column, computed in Python, so they reach the scan as
``PushedFilters`` instead of wrapping the column in a function.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = dt.timedelta(days=1)
MS_PER_DAY = 86_400_000
# period comparison used by every daily report: previous day and same weekday a week before
BASELINES: Mapping[str, int] = {"Day": 1, "Week": 7}


def as_day(value: str | dt.date | dt.datetime) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def report_days(report_day, baselines: Mapping[str, int] = BASELINES) -> dict[str, dt.date]:
    """``{"": day0, "Day": day0-1, "Week": day0-7}`` for a report date."""
    d0 = as_day(report_day)
    out = {"": d0}
    out.update({name: d0 - dt.timedelta(days=n) for name, n in baselines.items()})
    return out


def iso(day) -> str:
    return as_day(day).isoformat()


def date_key(day) -> int:
    """``yyyyMMdd`` integer of a day (the report ``date`` column)."""
    return int(as_day(day).strftime("%Y%m%d"))


def epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


#: Epoch seconds of the first and last instant of a TIMESTAMP_NTZ (years 1 to 9999).
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def epoch_count(raw: str | Column, unit: str = "SECOND") -> Column:
    """An epoch count (``unit`` SECOND or MILLISECOND) from a number or its text, fraction cut off.

    What is no number, or lies outside the years 1 to 9999, is NULL instead of an error.
    """
    col = F.col(raw) if isinstance(raw, str) else raw
    scale = 1000 if unit == "MILLISECOND" else 1
    number = col.cast("string").try_cast("decimal(38,9)")
    inside = (number >= F.lit(FIRST_SECOND * scale)) & (number < F.lit((LAST_SECOND + 1) * scale))
    return F.when(inside, number).try_cast("bigint")


def wall_clock(epoch: str | Column, unit: str = "MILLISECOND", tz: str = "UTC") -> Column:
    """Local wall-clock TIMESTAMP_NTZ of an epoch count (``unit`` MILLISECOND or SECOND)."""
    col = F.col(epoch) if isinstance(epoch, str) else epoch
    utc = F.timestamp_add(unit, col, epoch_ntz())
    if tz.upper() in ("UTC", "Z", "GMT"):
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def local_day(epoch: str | Column, unit: str = "MILLISECOND", tz: str = "UTC") -> Column:
    return F.to_date(wall_clock(epoch, unit, tz))


def _day_and_seconds(col: Column) -> tuple[Column, Column]:
    # date and field extraction on TIMESTAMP_NTZ are zone-free; timestamp_diff is
    # not (it casts NTZ to the session-zone TIMESTAMP), so it is not used here
    days = F.unix_date(F.to_date(col)).cast("bigint")
    secs = (F.hour(col) * 3600 + F.minute(col) * 60).cast("bigint")
    return days, secs


def epoch_millis(ntz: str | Column) -> Column:
    """Epoch milliseconds (truncated) of a UTC wall-clock TIMESTAMP_NTZ column."""
    col = F.col(ntz) if isinstance(ntz, str) else ntz
    days, secs = _day_and_seconds(col)
    frac_ms = F.floor(F.date_part(F.lit("SECOND"), col) * F.lit(1000)).cast("bigint")
    return days * F.lit(MS_PER_DAY) + secs * F.lit(1000) + frac_ms


def epoch_seconds(ntz: str | Column) -> Column:
    """Epoch seconds (truncated) of a UTC wall-clock TIMESTAMP_NTZ column."""
    col = F.col(ntz) if isinstance(ntz, str) else ntz
    days, secs = _day_and_seconds(col)
    return days * F.lit(86_400) + secs + F.second(col).cast("bigint")


def day_bounds_ms(day, tz: str = "UTC") -> tuple[int, int]:
    """Epoch ms of local midnight starting ``day`` and the next day in ``tz``."""
    d = as_day(day)
    zone = ZoneInfo(tz)
    lo = dt.datetime(d.year, d.month, d.day, tzinfo=zone)
    nxt = d + DAY
    hi = dt.datetime(nxt.year, nxt.month, nxt.day, tzinfo=zone)
    return int(lo.timestamp() * 1000), int(hi.timestamp() * 1000)


def on_days_ms(epoch_ms: str | Column, days: Iterable, tz: str = "UTC") -> Column:
    """``epoch_ms`` falls on one of ``days`` (local): an OR of half-open ranges."""
    col = F.col(epoch_ms) if isinstance(epoch_ms, str) else epoch_ms
    cond = None
    for day in sorted({as_day(d) for d in days}):
        lo, hi = day_bounds_ms(day, tz)
        part = (col >= F.lit(lo)) & (col < F.lit(hi))
        cond = part if cond is None else cond | part
    return cond


def until_day_ms(epoch_ms: str | Column, day, tz: str = "UTC") -> Column:
    """``epoch_ms`` falls on ``day`` or earlier (inclusive day upper bound)."""
    col = F.col(epoch_ms) if isinstance(epoch_ms, str) else epoch_ms
    return col < F.lit(day_bounds_ms(day, tz)[1])


def until_day_ntz(ntz: str | Column, day) -> Column:
    """A UTC wall-clock column falls on ``day`` or earlier: a literal range (pushable)."""
    col = F.col(ntz) if isinstance(ntz, str) else ntz
    return col < F.lit(f"{(as_day(day) + DAY).isoformat()} 00:00:00").cast("timestamp_ntz")


def on_days_ntz(ntz: str | Column, days: Iterable) -> Column:
    """A UTC wall-clock column falls on one of ``days``: OR of literal ranges (pushable)."""
    col = F.col(ntz) if isinstance(ntz, str) else ntz
    cond = None
    for day in sorted({as_day(d) for d in days}):
        # string -> TIMESTAMP_NTZ casts ignore the session zone
        lo = F.lit(f"{day.isoformat()} 00:00:00").cast("timestamp_ntz")
        hi = F.lit(f"{(day + DAY).isoformat()} 00:00:00").cast("timestamp_ntz")
        part = (col >= lo) & (col < hi)
        cond = part if cond is None else cond | part
    return cond
