"""Text helpers with the warehouse dialect's meaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_nullsafe(*cols) -> Column:
    """CONCAT(a, b, ...): NULL parts count as empty text."""
    return F.concat(*[F.coalesce(_c(c), F.lit("")) for c in cols])


def concat_plus(*cols) -> Column:
    """a + b + ...: NULL when any part is NULL (plain ``concat`` does this)."""
    return F.concat(*[_c(c) for c in cols])


def full_name(first, last, nullsafe: bool = False) -> Column:
    """first + ' ' + last, in either NULL flavour."""
    if nullsafe:
        return concat_nullsafe(first, F.lit(" "), last)
    return concat_plus(first, F.lit(" "), last)


def sql_len(c) -> Column:
    """LEN(c): length without trailing spaces."""
    return F.length(F.rtrim(_c(c)))


def norm(c) -> Column:
    """The value the default collation compares: upper case, no outer spaces."""
    return F.upper(F.trim(_c(c)))


#: The comparison of the warehouse's text keys and groups: blind to case and to trailing spaces.
COLLATION = "UTF8_LCASE_RTRIM"


def folded(c) -> Column:
    """The value that stands for a text key in joins, groups and windows (M4).

    Two texts have the same folded value when ``COLLATION`` calls them equal.  Spark can only
    sort-merge and sort-aggregate a column that is collated itself; over the
    folded value it plans hash joins, broadcasts and hash aggregates as for any text.
    """
    return F.lower(F.rtrim(_c(c)))


def same_text(a, b) -> Column:
    """a = b under ``COLLATION``; NULL when either is NULL."""
    return folded(a) == folded(b)


def untrimmed(c) -> Column:
    """True when the text has outer spaces (c != TRIM(c), compared by bytes)."""
    c = _c(c)
    return c != F.trim(c)
