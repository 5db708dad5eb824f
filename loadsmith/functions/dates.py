"""Date rules with one fixed meaning each.

* Year and month differences count calendar boundaries crossed
  (2020-12-31 → 2021-01-01 is one year), not complete units.
* Day differences count midnights crossed (dates, not elapsed hours).
* Day truncation of a timestamp_ntz stays timestamp_ntz; of a date gives
  timestamp_ntz at midnight.  No session time zone is involved.
* Day of week counts Sunday as 0.
* Integer results are ``long``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadsmith.functions._util import as_col


def _as_of_text(as_of) -> str | None:
    if as_of is None:
        return None
    if isinstance(as_of, _dt.datetime):
        return as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(as_of, _dt.date):
        return as_of.isoformat() + " 00:00:00"
    return str(as_of)


def run_timestamp(as_of=None) -> Column:
    """The run clock as a timestamp_ntz literal; one value for the whole run.

    ``None`` falls back to the query's ``current_timestamp``.
    """
    text = _as_of_text(as_of)
    if text is None:
        return F.localtimestamp()
    return F.lit(text).cast("timestamp_ntz")


def run_date(as_of=None) -> Column:
    return run_timestamp(as_of).cast("date")


def trunc_day(c) -> Column:
    return as_col(c).cast("date").cast("timestamp_ntz")


def year_diff(start, end) -> Column:
    return (F.year(as_col(end)) - F.year(as_col(start))).cast("long")


def month_diff(start, end) -> Column:
    s, e = as_col(start), as_col(end)
    return ((F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))).cast("long")


def day_diff(start, end) -> Column:
    return F.datediff(as_col(end).cast("date"), as_col(start).cast("date")).cast("long")


def add_years(c, n: int) -> Column:
    """Calendar years added to a date; Feb 29 → Feb 28 when needed."""
    return F.add_months(as_col(c).cast("date"), 12 * n)


def dow_sunday0(c) -> Column:
    return (F.dayofweek(as_col(c)) - 1).cast("long")


def date_part(part: str, c) -> Column:
    fn = {"year": F.year, "quarter": F.quarter, "month": F.month, "day": F.dayofmonth}[part]
    return fn(as_col(c)).cast("long")


def elapsed_years(days) -> Column:
    """Whole elapsed years from a day count (365.25-day years)."""
    return F.floor(as_col(days) / F.lit(365.25)).cast("long")
