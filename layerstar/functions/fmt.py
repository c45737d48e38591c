"""Display formats: FORMAT(x,'C'), 'N0', 'N2', 'MMM'.

FORMAT rounds half away from zero; ``format_number`` rounds half to even, so the
value is rounded first (``round`` is half-up) and ``format_number`` only adds
the separators.  These are a last step: queries keep numbers, reports may add
text columns with these.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """FORMAT(x, 'C', 'en-US'): $1,234.57, and ($1,234.57) below zero."""
    x = F.round(_c(c), 2)
    body = F.concat(F.lit("$"), F.format_number(F.abs(x), 2))
    return F.when(x.isNull(), None).when(x < 0, F.concat(F.lit("("), body, F.lit(")"))).otherwise(body)


def n0(c) -> Column:
    """FORMAT(x, 'N0')."""
    return F.format_number(F.round(_c(c), 0), 0)


def n2(c) -> Column:
    """FORMAT(x, 'N2')."""
    return F.format_number(F.round(_c(c), 2), 2)


def month_abbr(c) -> Column:
    """FORMAT(date, 'MMM'): Jan, Feb, ..."""
    return F.date_format(_c(c), "MMM")
