"""Exact money arithmetic.

Sums stay in decimal; means and ratios are decimal divisions rounded half-up
to a fixed number of places, so results do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_SUM = "decimal(38,2)"
PLACES = 4


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a, b, places: int = PLACES) -> Column:
    """a / b in decimal, rounded half-up to ``places``; NULL when b is 0 or NULL.

    Operands are money or counts (at most 2 decimals, below 10^26)."""
    a, b = _c(a), _c(b)
    # narrow operands keep 10+ digits in the quotient (no double rounding)
    q = a.cast("decimal(28,2)") / b.cast("decimal(28,2)")
    return F.when(b != 0, F.round(q, places)).cast(f"decimal(38,{places})")


def mean(c, places: int = PLACES) -> Column:
    """AVG(c) as sum / count in decimal, rounded to ``places``."""
    c = _c(c)
    return ratio(F.sum(c), F.count(c), places)


def money_sum(c) -> Column:
    return F.sum(_c(c)).cast(MONEY_SUM)
