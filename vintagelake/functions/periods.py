"""Calendar arithmetic on year/month columns and reporting windows.

Periods are either (year, month) integer pairs or the YYYYMM integer
``year*100+month``.  Month offsets are always computed from the pair, never
from YYYYMM differences.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = Column | str


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def yyyymm(year: ColLike, month: ColLike) -> Column:
    """``year*100+month``."""
    return _c(year) * 100 + _c(month)


def month_offset(y1: ColLike, m1: ColLike, y2: ColLike, m2: ColLike) -> Column:
    """whole months from (y1, m1) to (y2, m2): ``(y2-y1)*12+(m2-m1)``."""
    return (_c(y2) - _c(y1)) * 12 + (_c(m2) - _c(m1))


def month_start(d: ColLike) -> Column:
    """first day of the month as a DATE (``trunc``, not ``date_trunc``)."""
    return F.trunc(_c(d), "MM")


def month_end(d: ColLike) -> Column:
    """last day of the month."""
    return F.last_day(_c(d))


def calendar_years(later: ColLike, earlier: ColLike) -> Column:
    """number of calendar-year boundaries crossed, ``year(a)-year(b)``."""
    return F.year(_c(later)) - F.year(_c(earlier))


def age_from_yyyymm(obs_yyyymm: ColLike, birth_yyyymm: ColLike) -> Column:
    """``floor((obs-birth)/100)`` clamped at 0; NULL stays NULL."""
    raw = F.floor((_c(obs_yyyymm) - _c(birth_yyyymm)) / F.lit(100))
    return F.when(raw.isNull(), F.lit(None)).when(raw < 0, F.lit(0)).otherwise(raw)


def parse_yyyymmdd(s: ColLike) -> Column:
    """F8: ``PARSE_DATE('%Y%m%d', s)``; unparsable text gives NULL."""
    return F.try_to_date(_c(s), "yyyyMMdd")


def closed_month_filter(date_col: ColLike, run_date: _dt.date) -> Column:
    """Rows of the month before ``run_date``, as a sargable half-open range
    on the raw column so the bound reaches the parquet scan."""
    start, end = previous_month(run_date)
    return (_c(date_col) >= F.lit(start)) & (_c(date_col) < F.lit(end + _dt.timedelta(days=1)))


def previous_month(run_date: _dt.date) -> tuple[_dt.date, _dt.date]:
    """First and last day of the month before ``run_date``."""
    first_this = run_date.replace(day=1)
    last_prev = first_this - _dt.timedelta(days=1)
    return last_prev.replace(day=1), last_prev


def _last_day(d: _dt.date) -> _dt.date:
    nxt = (d.replace(day=28) + _dt.timedelta(days=4)).replace(day=1)
    return nxt - _dt.timedelta(days=1)


def period_window(run_date: _dt.date, history: bool,
                  history_start: _dt.date = _dt.date(2017, 1, 1)) -> tuple[_dt.date, _dt.date]:
    """K2 on the driver: the [start, end] reporting window for a run date.

    On day 1 the window closes the previous month (from ``history_start`` when
    rebuilding history, else from the previous month's first day); on any
    other day it is the current month to date's month end.  Computed once as
    literals so the bounds prune partitions statically.
    """
    if run_date.day == 1:
        prev_last = run_date - _dt.timedelta(days=1)
        start = history_start if history else prev_last.replace(day=1)
        return start, prev_last
    return run_date.replace(day=1), _last_day(run_date)


def period_window_cols(run_date: ColLike, history: bool,
                       history_start: _dt.date = _dt.date(2017, 1, 1)) -> tuple[Column, Column]:
    """K2 as column expressions (when the run date is data, e.g. per batch)."""
    rd = _c(run_date)
    is_first = F.dayofmonth(rd) == 1
    prev = F.date_add(rd, -1)
    start_day1 = F.lit(history_start) if history else F.trunc(prev, "MM")
    start = F.when(is_first, start_day1).otherwise(F.trunc(rd, "MM"))
    end = F.when(is_first, F.last_day(prev)).otherwise(F.last_day(rd))
    return start, end


def horizon_bucket(offset: ColLike, years: int = 4, other: str = "OTRO") -> Column:
    """Y1..Yn from a month offset (<=12 -> Y1, <=24 -> Y2, ...), else ``other``.

    NULL offsets fall to ``other`` like the reference's ELSE branch.
    """
    o = _c(offset)
    expr = None
    for y in range(1, years + 1):
        cond = o <= 12 * y
        expr = F.when(cond, F.lit(f"Y{y}")) if expr is None else expr.when(cond, F.lit(f"Y{y}"))
    return expr.otherwise(F.lit(other))


def today_in(tz: str, instant: Column | None = None) -> Column:
    """CURRENT_DATE(tz) -- the calendar date in a time zone, now or at an instant."""
    return F.to_date(F.from_utc_timestamp(F.current_timestamp() if instant is None else instant, tz))


def time_of_day_in(tz: str, instant: Column | None = None) -> Column:
    """EXTRACT(TIME FROM CURRENT_DATETIME(tz)) as HH:mm:ss text, now or at an instant."""
    return F.date_format(F.from_utc_timestamp(F.current_timestamp() if instant is None else instant, tz), "HH:mm:ss")
