"""Roll-ups of the sales fact, stored after each gold load, that queries read instead of the fact
where they suffice.

``by_product`` holds the sums of a product and month, ``by_customer`` those of a customer with its
first and last order date: sums, counts and extremes, which add up to those of any coarser group.
``customer_bits`` and ``product_bits`` hold the keys with sales in a month as bitmaps, one row per
month and run of 32,768 keys (G4 numbers the keys 1..n without gaps, so a run is dense).  The distinct
keys of several months are the bits of their union: a distinct count without the fact and without
expanding its rows.

Order numbers are in none of them: what counts orders (E8, E11, R1, R2) reads the fact.  Distinct counts
per customer or product stay on the fact too: a single customer's products would be one bit or two in each
bitmap of 4 KB.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLLUPS = ("by_product", "by_customer", "customer_bits", "product_bits")


@dataclass(frozen=True)
class Rollups:
    """The stored roll-ups of one gold load."""

    by_product: DataFrame
    by_customer: DataFrame
    customer_bits: DataFrame
    product_bits: DataFrame


def order_month() -> Column:
    """The first day of the order's month; NULL without an order date."""
    return F.trunc("order_date", "month").alias("order_month")


def by_product(f: DataFrame) -> DataFrame:
    """Sums per product and month (a NULL product and a NULL month are groups like others)."""
    return f.groupBy("product_key", order_month()).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("sales_amount").alias("sales_amount"),
        F.sum("quantity").alias("quantity"), F.sum("price").alias("price_sum"),
        F.count("price").alias("price_count"))


def by_customer(f: DataFrame) -> DataFrame:
    """Sums per customer with the first and last order date."""
    return f.groupBy("customer_key").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("sales_amount").alias("sales_amount"),
        F.sum("quantity").alias("quantity"), F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"))


def key_bits(f: DataFrame, key: str) -> DataFrame:
    """The keys with sales in each month, as (order_month, bucket, bits); NULL keys have no bit.

    Rows are first made distinct with a map-side combine, so a key with a third of all sales is one
    row per task and month.  The distinct rows are then brought together by (month, bucket), at most
    32,768 each, and a bitmap is built where they are: none is shuffled."""
    places = f.where(F.col(key).isNotNull()).select(
        order_month(), F.bitmap_bucket_number(key).alias("bucket"), F.bitmap_bit_position(key).alias("place"))
    return places.distinct().repartition("order_month", "bucket").groupBy("order_month", "bucket") \
                 .agg(F.bitmap_construct_agg("place").alias("bits"))


def distinct_keys(bits: DataFrame, by: Column | None = None, name: str = "n") -> DataFrame:
    """Distinct keys per group of months ``by`` (one row over all months without it)."""
    group = [] if by is None else [by.alias("__by")]
    united = bits.groupBy(*group, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counted = united.groupBy(*([] if by is None else ["__by"])).agg(F.sum(F.bitmap_count("bits")).alias("__n"))
    return counted.select(*([] if by is None else ["__by"]), F.coalesce("__n", F.lit(0).cast("bigint")).alias(name))


def with_distinct_keys(groups: DataFrame, by: str, bits: DataFrame, of_month: Column, name: str) -> DataFrame:
    """``groups`` (a row per value of ``by``) with the distinct keys of each group's months as ``name``."""
    counts = distinct_keys(bits, of_month, "__keys")
    return groups.join(counts, F.col(by).eqNullSafe(F.col("__by")), "left") \
                 .withColumn(name, F.coalesce("__keys", F.lit(0).cast("bigint"))).drop("__by", "__keys")


def month_of(f: DataFrame) -> Column:
    """A date in the month of the row's sales, of the fact or of its roll-up by month."""
    return F.col("order_date" if "order_date" in f.columns else "order_month")


def price_parts(f: DataFrame) -> tuple[Column, Column]:
    """(sum, count) of the price, over the fact or its roll-up."""
    if "price" in f.columns:
        return F.sum("price"), F.count("price")
    return F.sum("price_sum").cast("decimal(28,2)"), F.sum("price_count")


def order_span(f: DataFrame) -> tuple[Column, Column]:
    """(first, last) order date, over the fact or its roll-up by customer."""
    if "order_date" in f.columns:
        return F.min("order_date"), F.max("order_date")
    return F.min("first_order_date"), F.max("last_order_date")


def rollup_steps(fact: Callable[[], DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """How each roll-up is built from the stored fact."""
    return {"by_product": lambda: by_product(fact()), "by_customer": lambda: by_customer(fact()),
            "customer_bits": lambda: key_bits(fact(), "customer_key"),
            "product_bits": lambda: key_bits(fact(), "product_key")}
