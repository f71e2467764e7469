"""The calendar of sessions of the New York exchanges, from its rules."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Closings without a rule.
AD_HOC = (date(2025, 1, 9),)
ZONE = "America/New_York"


def _nth(year: int, month: int, weekday: int, n: int) -> date:
    """The n-th such weekday of a month; from the end for a negative n."""
    if n > 0:
        first = date(year, month, 1)
        return first + timedelta((weekday - first.weekday()) % 7 + 7 * (n - 1))
    last = date(year + month // 12, month % 12 + 1, 1) - timedelta(1)
    return last - timedelta((last.weekday() - weekday) % 7 + 7 * (-n - 1))


def _easter(year: int) -> date:
    """Easter Sunday by the Gregorian computus."""
    golden, century, rest = year % 19, year // 100, year % 100
    epact = (19 * golden + century - century // 4 - (century - (century + 8) // 25 + 1) // 3 + 15) % 30
    week = (32 + 2 * (century % 4) + 2 * (rest // 4) - epact - rest % 4) % 7
    late = (golden + 11 * epact + 22 * week) // 451
    month, day = divmod(epact + week - 7 * late + 114, 31)
    return date(year, month, day + 1)


def _observed(day: date) -> date:
    """A Saturday's holiday is kept on Friday, a Sunday's on Monday."""
    return day + timedelta({5: -1, 6: 1}.get(day.weekday(), 0))


def holidays(year: int) -> set[date]:
    out = {
        _nth(year, 1, 0, 3),
        _nth(year, 2, 0, 3),
        _easter(year) - timedelta(2),
        _nth(year, 5, 0, -1),
        _observed(date(year, 7, 4)),
        _nth(year, 9, 0, 1),
        _nth(year, 11, 3, 4),
        _observed(date(year, 12, 25)),
    }
    new_year = date(year, 1, 1)
    if new_year.weekday() != 5:  # on a Saturday it isn't kept
        out.add(_observed(new_year))
    if year >= 2022:
        out.add(_observed(date(year, 6, 19)))
    return out | {d for d in AD_HOC if d.year == year}


def session_days(start: date, end: date) -> list[date]:
    """The sessions from start to end, both included; early closings are sessions."""
    closed = set().union(*(holidays(y) for y in range(start.year, end.year + 1))) if start <= end else set()
    days = (start + timedelta(i) for i in range((end - start).days + 1))
    return [d for d in days if d.weekday() < 5 and d not in closed]


def sessions(spark: SparkSession, start: date, end: date) -> DataFrame:
    """``trade_date`` of the sessions from start to end."""
    return spark.createDataFrame([(d,) for d in session_days(start, end)], "trade_date date")


def last_completed_session(today: date) -> date:
    """The last session strictly before today."""
    return session_days(today - timedelta(14), today - timedelta(1))[-1]


def default_range(today: date, years: int = 5) -> tuple[date, date]:
    """The years up to the last completed session; 29 February becomes 28 where there is none."""
    end = last_completed_session(today)
    try:
        return end.replace(year=end.year - years), end
    except ValueError:
        return end.replace(year=end.year - years, day=28), end


def day_bounds(first: Column, last: Column) -> tuple[Column, Column]:
    """Instants of the first and the last second of a range of New York dates."""
    begin = F.to_utc_timestamp(first.cast("timestamp"), ZONE)
    after = F.to_utc_timestamp(F.date_add(last, 1).cast("timestamp"), ZONE)
    return begin, after - F.expr("INTERVAL 1 SECOND")
