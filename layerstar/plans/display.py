"""The reference's display formats as a last step over a query result.

Queries return numbers so that they can be ordered, compared and tested; the
reference shows money as FORMAT(x, 'C') text, counts as 'N0' and shares as
'N2' + '%'.  ``display(qid, df)`` applies those formats to the columns the
reference formats, leaving the others as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerstar.functions import fmt

# Which columns the reference formats, per query id: (money, percent).
FORMATS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "E5": (("total_sales",), ()),
    "E7": (("avg_price",), ()),
    "E15": (("avg_cost",), ()),
    "E16": (("total_revenue",), ()),
    "E17": (("total_revenue",), ()),
    "E19": (("total_revenue",), ()),
    "E20": (("total_revenue",), ()),
    "A1": (("total_sales",), ()),
    "A2": (("total_sales",), ()),
    "A3": (("total_sales", "running_total_sales"), ()),
    "A4": (("avg_price", "moving_avg_price"), ()),
    "A5": (("sales", "prev_sales", "yoy_change"), ()),
    "A6": (("sales", "avg_sales", "variance"), ()),
    "A7": (("total_sales", "grand_total"), ("sales_percentage",)),
}


def display(qid: str, df: DataFrame) -> DataFrame:
    money, pct = FORMATS.get(qid, ((), ()))
    cols = []
    for c in df.columns:
        if c in money:
            cols.append(fmt.money(c).alias(c))
        elif c in pct:
            cols.append(F.concat(fmt.n2(c), F.lit("%")).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)
