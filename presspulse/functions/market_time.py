"""Trading-calendar expressions.

The calendar is expressed over a date column instead of a calendar table: whether a day
trades depends only on its weekday and on the holiday list, so the news window of an
article is a narrow projection. No join, no shuffle and no date range to outgrow.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from presspulse import config as C


def _dates(holidays: Sequence[str]) -> list[date]:
    return [date.fromisoformat(h) for h in holidays]


def is_weekend(d: Column) -> Column:
    return F.weekday(d) >= 5


def is_holiday(d: Column, holidays: Sequence[str] = tuple(C.HOLIDAYS)) -> Column:
    return d.isin(_dates(holidays)) if holidays else F.lit(False)


def is_trading_day(d: Column, holidays: Sequence[str] = tuple(C.HOLIDAYS)) -> Column:
    return ~is_weekend(d) & ~is_holiday(d, holidays)


def _around_holidays(holidays: Sequence[str], step: int) -> dict[date, date]:
    """Closed days whose nearest trading day is not simply across the weekend, with that day.

    These are the holidays and the closed days leading into one, so there are a few per holiday.
    """
    closed = set(_dates(holidays))
    shut = lambda d: d.weekday() >= 5 or d in closed
    move = timedelta(days=step)
    out: dict[date, date] = {}
    for holiday in closed:
        target = holiday
        while shut(target):
            target += move
        day = holiday
        while shut(day):
            out[day] = target
            day -= move
    return out


def _nearest(d: Column, step: int, holidays: Sequence[str]) -> Column:
    """First trading day among d, d+step, d+2*step, ... Weekend arithmetic, except around holidays."""
    w = F.weekday(d)
    shift = (F.when(w == 5, 2).when(w == 6, 1) if step > 0 else F.when(w == 5, -1).when(w == 6, -2)).otherwise(0)
    plain = F.date_add(d, shift)
    special = _around_holidays(holidays, step)
    if not special:
        return plain
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in sorted(special.items())))
    return F.when(d.isin(list(special)), F.try_element_at(table, d)).otherwise(plain)


def on_or_after(d: Column, holidays: Sequence[str] = tuple(C.HOLIDAYS)) -> Column:
    return _nearest(d, 1, holidays)


def previous_trading_day(d: Column, holidays: Sequence[str] = tuple(C.HOLIDAYS)) -> Column:
    return _nearest(F.date_sub(d, 1), -1, holidays)


def to_ist(ts_utc: Column) -> Column:
    return ts_utc + F.make_dt_interval(mins=F.lit(C.IST_OFFSET_MINUTES))


def window_start(ref: Column, holidays: Sequence[str] = tuple(C.HOLIDAYS),
                 hour: int = C.WINDOW_START_HOUR, minute: int = C.WINDOW_START_MINUTE) -> Column:
    opened = previous_trading_day(ref, holidays).cast("timestamp_ntz")
    return opened + F.make_dt_interval(hours=F.lit(hour), mins=F.lit(minute))


def window_end(ref: Column, hour: int = C.WINDOW_START_HOUR, minute: int = C.WINDOW_START_MINUTE) -> Column:
    """One second before the start time of day, on the reference date."""
    return ref.cast("timestamp_ntz") + F.make_dt_interval(
        hours=F.lit(hour), mins=F.lit(minute - 1), secs=F.lit(59).cast("decimal(18,6)")
    )


def news_date(ts_ist: Column, holidays: Sequence[str] = tuple(C.HOLIDAYS),
              hour: int = C.WINDOW_START_HOUR, minute: int = C.WINDOW_START_MINUTE) -> Column:
    """Trading day whose news window contains the time, NULL in the sub-second gap between windows.

    Shifting the clock back by the start time turns windows into whole days: the window that
    contains the time closes on the first trading day after the shifted date.
    """
    shifted = F.to_date(ts_ist - F.make_dt_interval(hours=F.lit(hour), mins=F.lit(minute)))
    ref = on_or_after(F.date_add(shifted, 1), holidays)
    # only the last second of the day can lie after the window's end
    second = F.make_dt_interval(secs=F.lit(1).cast("decimal(18,6)"))
    past_end = ts_ist + second - F.make_dt_interval(hours=F.lit(hour), mins=F.lit(minute))
    return F.when((F.to_date(past_end) == shifted) | (ts_ist <= window_end(ref, hour, minute)), ref)


def within_window(ts_ist: Column, ref: Column, holidays: Sequence[str] = tuple(C.HOLIDAYS)) -> Column:
    """Both ends inclusive; NULL times are rejected."""
    return F.coalesce(ts_ist.between(window_start(ref, holidays), window_end(ref)), F.lit(False))


def hours_between(earlier: Column, later: Column) -> Column:
    """Signed hours between two wall-clock times, independent of the session time zone."""
    micros = (later - earlier).cast("interval second").cast("decimal(20,6)") * F.lit(1_000_000)
    return micros.cast("bigint").cast("double") / F.lit(3.6e9)


def cyclical(value: Column, period: int) -> tuple[Column, Column]:
    angle = F.lit(2.0) * F.pi() * (value.cast("double") / F.lit(float(period)))
    return F.sin(angle), F.cos(angle)
