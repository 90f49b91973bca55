"""Date functions of the cleaning step.

Dates arrive as strings in one of two layouts, chosen by content: a string with a
``/`` is ``MM/dd/yyyy``, anything else ``yyyyMMdd``. Parsing follows the strict
pattern widths of the reference (two-digit month and day, four-digit year) but is
lenient about impossible days the way the JDK's default resolver is:
``02/30/2010`` becomes 2010-02-28 and ``04/31/2011`` becomes 2011-04-30. Spark's
own ``to_date`` would raise or return NULL there, so the parts are split out and
rebuilt with ``make_date`` and a clamp to the month's last day.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two accepted layouts and the placeholder birth date.
SLASH_LAYOUT = r"^[0-9]{2}/[0-9]{2}/[0-9]{4}\z"   # MM/dd/yyyy
COMPACT_LAYOUT = r"^[0-9]{8}\z"                     # yyyyMMdd
PLACEHOLDER_DOB = _dt.date(1900, 1, 1)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_local_date(s) -> Column:
    """String -> DATE, NULL when the string is not a valid date in either layout."""
    s = _col(s)
    slash = s.contains("/")
    shaped = F.when(slash, s.rlike(SLASH_LAYOUT)).otherwise(s.rlike(COMPACT_LAYOUT))
    y = F.when(slash, F.substring(s, 7, 4)).otherwise(F.substring(s, 1, 4)).try_cast("int")
    m = F.when(slash, F.substring(s, 1, 2)).otherwise(F.substring(s, 5, 2)).try_cast("int")
    d = F.when(slash, F.substring(s, 4, 2)).otherwise(F.substring(s, 7, 2)).try_cast("int")
    ok = shaped & (y >= 1) & m.between(1, 12) & d.between(1, 31)
    first = F.make_date(F.when(ok, y), F.when(ok, m), F.lit(1))
    return F.least(F.date_add(first, d - 1), F.last_day(first))


def require_date(parsed: Column, raw, what: str) -> Column:
    """Fail the job on an unparseable date, like the reference does."""
    raw = _col(raw)
    msg = F.concat(F.lit(f"cannot parse {what}: "), F.coalesce(raw, F.lit("NULL")))
    return F.when(parsed.isNull(), F.raise_error(msg)).otherwise(parsed)


def clean_dob(dob, default_dob: str, as_of: _dt.date, failfast: bool = True) -> Column:
    """Date of birth repair: on/after ``as_of`` or the 1900-01-01 placeholder -> default."""
    parsed = parse_local_date(dob)
    if failfast:
        parsed = require_date(parsed, dob, "dob")
    default = parse_local_date(F.lit(default_dob))
    if failfast:
        default = require_date(default, F.lit(default_dob), "default dob")
    return (
        F.when(parsed < F.lit(as_of),
               F.when(parsed == F.lit(PLACEHOLDER_DOB), default).otherwise(parsed))
        .when(parsed.isNotNull(), default)
    )


def age_years(dob, as_of) -> Column:
    """Whole years from ``dob`` to ``as_of`` (calendar-period semantics).

    Month difference minus one when the day of month has not been reached yet;
    ``floor(months_between/12)`` differs on month-end dates (2000-02-29 -> 2001-02-28
    is 0 years, not 1).
    """
    a = _col(dob)
    b = F.lit(as_of) if isinstance(as_of, (_dt.date,)) else _col(as_of)
    tm = (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
    da, db = F.dayofmonth(a), F.dayofmonth(b)
    tm = (F.when((tm > 0) & (db < da), tm - 1)
          .when((tm < 0) & (db > da), tm + 1)
          .otherwise(tm))
    # integral division truncating toward zero, as the calendar period does
    return F.when(tm >= 0, F.floor(tm / 12)).otherwise(F.ceil(tm / 12)).cast("int")


def date_parts(d, prefix: str) -> list[Column]:
    """Year, month, ISO day of week (Monday = 1) and day of month of a DATE."""
    d = _col(d)
    return [
        F.year(d).alias(f"{prefix}_year"),
        F.month(d).alias(f"{prefix}_month"),
        (F.weekday(d) + 1).alias(f"{prefix}_day_of_week"),
        F.dayofmonth(d).alias(f"{prefix}_day_of_month"),
    ]


def time_suffix(ts=None) -> Column:
    """``yyyyMMdd_HHmmss`` rendering of a timestamp (session time zone, UTC)."""
    ts = F.current_timestamp() if ts is None else _col(ts)
    return F.date_format(ts, "yyyyMMdd_HHmmss")
