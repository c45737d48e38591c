"""Date helpers with the warehouse dialect's meaning.

``DATEDIFF(MONTH|YEAR, a, b)`` counts calendar boundaries crossed, not whole
periods, so Jan 31 -> Feb 1 is one month.  Spark's ``months_between`` and
``datediff(month, ...)`` count whole months, hence these helpers.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_diff(start, end) -> Column:
    """DATEDIFF(DAY, start, end)."""
    return F.datediff(_c(end), _c(start))


def month_diff(start, end) -> Column:
    """DATEDIFF(MONTH, start, end): month boundaries between the two dates."""
    s, e = _c(start), _c(end)
    return (F.year(e) * 12 + F.month(e)) - (F.year(s) * 12 + F.month(s))


def year_diff(start, end) -> Column:
    """DATEDIFF(YEAR, start, end): year boundaries between the two dates."""
    return F.year(_c(end)) - F.year(_c(start))


def parse_yyyymmdd(c) -> Column:
    """An 8-character ``yyyyMMdd`` text to a date, anything else to NULL.

    Trailing spaces are ignored, as LEN and the date cast do.  Eight digits (a number
    of eight places, in eight characters) are cast as ``yyyy-MM-dd``; the format
    pattern, which builds an exception for every text that is no date, is left for
    other texts, such as years before 1000."""
    raw = _c(c)
    c = F.rtrim(raw)
    year, month, day = [F.substr(raw, F.lit(at), F.lit(n)) for at, n in ((1, 4), (5, 2), (7, 2))]
    iso = F.concat(year, F.lit("-"), month, F.lit("-"), day).try_cast("date")
    return F.when(F.length(c) == 8, F.when(raw.try_cast("int") >= 10_000_000, iso).otherwise(F.try_to_date(c, "yyyyMMdd")))


def as_date_lit(as_of) -> Column:
    """The ``as_of`` parameter that stands for GETDATE() (M14) as a literal."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    return F.lit(as_of)
