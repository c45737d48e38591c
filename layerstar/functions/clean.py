"""Cleansing steps that work row by row.

Each is a Column expression or a DataFrame -> DataFrame function so it can be
tested alone; the silver table loads only compose them.  The DataFrame-wide
steps (T3, T10, T14) live in ``layerstar.operators.rows``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerstar.functions.dates import as_date_lit, parse_yyyymmdd  # noqa: F401  (T11)
from layerstar.functions.text import norm

MONEY = "decimal(18,2)"

# Code tables of the silver load.
MARITAL_CODES = {"M": "Married", "S": "Single"}
GENDER_CODES = {"M": "Male", "F": "Female"}
PRODUCT_LINES = {"M": "Mountain", "R": "Road", "T": "Touring", "S": "Other sales"}
GENDER_WORDS = {"Female": ("F", "FEMALE"), "Male": ("M", "MALE")}
COUNTRY_CODES = {"Germany": ("DE",), "United States": ("USA", "US")}
UNKNOWN = "Unknown"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """TRIM on the listed text columns, other columns untouched."""
    cols = set(cols)
    return df.select(*[F.trim(F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def map_codes(c, mapping: Mapping[str, str], default: str = UNKNOWN) -> Column:
    """CASE UPPER(c) WHEN code THEN label ... ELSE default END."""
    u = F.upper(_c(c))
    out = None
    for code, label in mapping.items():
        out = (F.when(u == code, label) if out is None else out.when(u == code, label))
    return out.otherwise(default) if out is not None else F.lit(default)


def drop_null_keys(df: DataFrame, keys) -> DataFrame:
    """T4: keep rows whose key columns are all set."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.where(cond)


def category_id(c) -> Column:
    """T5: first five characters of the product key, '-' -> '_'."""
    return F.replace(F.substr(_c(c), F.lit(1), F.lit(5)), F.lit("-"), F.lit("_"))


def product_number(c) -> Column:
    """The product key from character 7 on, '-' -> '_'."""
    return F.replace(F.substr(_c(c), F.lit(7)), F.lit("-"), F.lit("_"))


def normalise_key(c) -> Column:
    """Sales product key in the form of T6: trimmed, '-' -> '_'."""
    return F.replace(F.trim(_c(c)), F.lit("-"), F.lit("_"))


def clean_cost(c) -> Column:
    """Cost text -> decimal(18,2); NULL -> 0, negative -> positive."""
    return F.abs(F.coalesce(F.trim(_c(c)).cast(MONEY), F.lit(0).cast(MONEY)))


def product_line(c) -> Column:
    """Product line code -> label, else 'Unknown' (case-blind)."""
    return map_codes(c, PRODUCT_LINES)


def abs_decimal(c) -> Column:
    """Text -> decimal(18,2), absolute value.  A bad text stops the load
    (ANSI cast), as the warehouse's CAST does."""
    return F.abs(_c(c).cast(MONEY))


def abs_int(c) -> Column:
    """Text -> int, absolute value."""
    return F.abs(_c(c).cast("int"))


def zero_to_null(c) -> Column:
    """NULLIF(c, 0)."""
    return F.nullif(_c(c), F.lit(0))


def repair_sales(s, q, p) -> Column:
    """Sales := quantity * price when sales is NULL or differs from it.

    A NULL quantity or price makes the comparison UNKNOWN, so the known sales
    value is kept (SURVEY §2.2 table)."""
    s, q, p = _c(s), _c(q), _c(p)
    return F.when(s.isNull() | (s != q * p), (q * p).cast(MONEY)).otherwise(s)


def repair_price(s, q, p) -> Column:
    """Price := sales / quantity as decimal(18,2) when price is NULL.

    ``s`` is the sales value before T15, as in the warehouse load."""
    s, q, p = _c(s), _c(q), _c(p)
    return F.when(p.isNull(), (s / q).cast(MONEY)).otherwise(p)


def strip_prefix(c, prefix: str = "NAS") -> Column:
    """Drop a leading prefix (matched case-blind, like LIKE 'NAS%')."""
    c = _c(c)
    return F.when(F.upper(c).startswith(prefix.upper()),
                  F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


def null_future(c, as_of) -> Column:
    """The text date as a date, NULL when after ``as_of``."""
    d = _c(c).cast("date")
    return F.when(d > as_date_lit(as_of), None).otherwise(d)


def map_gender(c) -> Column:
    """F/FEMALE -> Female, M/MALE -> Male, else Unknown (trimmed, case-blind)."""
    u = norm(c)
    out = None
    for label, words in GENDER_WORDS.items():
        cond = u.isin(*words)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(UNKNOWN)


def strip_hyphen(c) -> Column:
    """Remove every '-'."""
    return F.replace(_c(c), F.lit("-"), F.lit(""))


def map_country(c) -> Column:
    """DE -> Germany, US/USA -> United States, blank/NULL -> Unknown, else trimmed."""
    c = _c(c)
    u = norm(c)
    out = None
    for label, codes in COUNTRY_CODES.items():
        cond = u.isin(*codes)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.when(c.isNull() | (F.trim(c) == ""), UNKNOWN).otherwise(F.trim(c))


def load_categories(df: DataFrame) -> DataFrame:
    """The category table passes through unchanged."""
    return df.select("id", "cat", "subcat", "maintenance")


def with_load_time(df: DataFrame, now: _dt.datetime | None = None) -> DataFrame:
    """Stamp every row with the load time (``dwh_create_dt``).

    A wall-clock time without zone, like the warehouse's DATETIME, so the value
    does not move with the session time zone."""
    # from text: a datetime literal would pass through a zoned instant first
    ts = (F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz") if now is not None
          else F.localtimestamp())
    return df.withColumn("dwh_create_dt", ts)
