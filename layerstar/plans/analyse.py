"""Trends, cumulative and performance analysis, part-to-whole and
segmentation over the star schema.

``f`` is the fact or, for all but distinct counts, its roll-up (by product and month for A1-A7, by
customer for A9); A1 and A2 over a roll-up take the distinct customers from the bitmaps of its months.

Windows here run over aggregated rows only: at most one row per year or per
calendar month (A2-A4, unpartitioned but bounded), or per (product, year) and
partitioned by product (A5, A6).  The grand total of A7 is a one-row aggregate
used as a scalar subquery, not an empty OVER ().
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerstar.functions.dates import month_diff
from layerstar.functions.fmt import month_abbr
from layerstar.functions.num import MONEY_SUM, PLACES, money_sum, ratio
from layerstar.functions.text import folded
from layerstar.operators.rows import group_text, merged, with_grand_total
from layerstar.plans.rollup import month_of, order_span, price_parts, with_distinct_keys

# Trend marks.
UP, DOWN, FLAT = "\U0001F7E2", "\U0001F534", "\U0001F7E1"


def _with_customers(f: DataFrame, by: list, key: str, period, customer_bits: DataFrame | None) -> DataFrame:
    """Sums and distinct customers per group ``by``; ``period`` gives the group ``key`` of a date."""
    sums = {"total_sales": money_sum("sales_amount"), "total_quantity": F.sum("quantity").cast("bigint")}
    if customer_bits is None:
        sums["total_customers"] = F.countDistinct("customer_key")
    g = f.groupBy(*by).agg(*[c.alias(n) for n, c in sums.items()])
    if customer_bits is None:
        return g
    return with_distinct_keys(g, key, customer_bits, period("order_month"), "total_customers")


def sales_by_year(f: DataFrame, customer_bits: DataFrame | None = None) -> DataFrame:
    """A1"""
    g = _with_customers(f, [F.year(month_of(f)).alias("order_year")], "order_year", F.year, customer_bits)
    return g.select("order_year", "total_sales", "total_customers", "total_quantity").orderBy("order_year")


def sales_by_month(f: DataFrame, customer_bits: DataFrame | None = None) -> DataFrame:
    """A2: calendar months with all years pooled, ranked by sales."""
    day = month_of(f)
    g = _with_customers(f, [F.month(day).alias("m"), month_abbr(day).alias("order_month")], "m", F.month,
                        customer_bits)
    w = Window.orderBy(F.col("total_sales").desc_nulls_last(), F.col("m").asc_nulls_first())
    return g.select("order_month", "total_sales", "total_customers", "total_quantity",
                    F.row_number().over(w).alias("sales_rank"), "m").orderBy("m").drop("m")


def _by_year(f: DataFrame) -> DataFrame:
    price, prices = price_parts(f)
    return f.groupBy(F.year(month_of(f)).alias("order_year")).agg(
        money_sum("sales_amount").alias("total_sales"), price.alias("__ps"), prices.alias("__pn"))


def running_sales(f: DataFrame) -> DataFrame:
    """A3: running total of yearly sales (one row per year)."""
    w = Window.orderBy(F.col("order_year").asc_nulls_first()) \
              .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _by_year(f).select("order_year", "total_sales",
                              F.sum("total_sales").over(w).cast(MONEY_SUM)
                              .alias("running_total_sales")).orderBy("order_year")


def cumulative_price(f: DataFrame) -> DataFrame:
    """A4: yearly mean price and the running mean of those means (unweighted)."""
    y = _by_year(f).withColumn("__avg", F.col("__ps") / F.col("__pn"))
    w = Window.orderBy(F.col("order_year").asc_nulls_first()) \
              .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return y.select("order_year", ratio("__ps", "__pn").alias("avg_price"),
                    F.round(F.avg("__avg").over(w), PLACES).cast(f"decimal(38,{PLACES})")
                    .alias("moving_avg_price")).orderBy("order_year")


def _product_years(f: DataFrame, p: DataFrame) -> DataFrame:
    """Sales per (product name, year), SUM(ISNULL(sales, 0)); pre-aggregated on
    (product key, year) before the dimension join."""
    pre = f.groupBy("product_key", F.year(month_of(f)).alias("order_year")) \
           .agg(F.sum(F.coalesce("sales_amount", F.lit(0))).alias("__s"))
    d = p.select(F.col("product_key").alias("__pk"), "product_name")
    j = pre.join(merged(d), pre["product_key"] == d["__pk"], "left")
    years = group_text(j.withColumnRenamed("product_name", "product"), ["product", "order_year"], sales=F.sum("__s"))
    return years.withColumn("sales", F.col("sales").cast(MONEY_SUM))


def _trend(diff) -> F.Column:
    return F.when(diff > 0, UP).when(diff < 0, DOWN).otherwise(FLAT)


def product_yoy(f: DataFrame, p: DataFrame) -> DataFrame:
    """A5: each product's yearly sales against its previous row (the year
    before it has sales in)."""
    w = Window.partitionBy(folded("product")).orderBy(F.col("order_year").asc_nulls_first())
    y = _product_years(f, p).withColumn("prev_sales", F.lag("sales").over(w))
    diff = F.col("sales") - F.col("prev_sales")
    return y.select("order_year", "product", "sales", "prev_sales",
                    diff.cast(MONEY_SUM).alias("yoy_change"), _trend(diff).alias("yoy_trend")) \
            .orderBy("product", "order_year")


def product_vs_average(f: DataFrame, p: DataFrame) -> DataFrame:
    """Each product's yearly sales against the product's mean year."""
    w = Window.partitionBy(folded("product"))
    y = _product_years(f, p).withColumn("__s", F.sum("sales").over(w)) \
                            .withColumn("__n", F.count("sales").over(w))
    gap = F.col("sales") * F.col("__n") - F.col("__s")   # n * (sales - mean), exact
    avg = ratio("__s", "__n")
    return y.select("order_year", "product", "sales", avg.alias("avg_sales"),
                    ratio(gap, "__n").alias("variance"),
                    _trend(gap).alias("performance_trend")).orderBy("product", "order_year")


def category_share(f: DataFrame, p: DataFrame) -> DataFrame:
    """Share of each category in all sales, in percent (2 places)."""
    from layerstar.plans.explore import pre_aggregate_join
    g = pre_aggregate_join(f, p, "product_key", {"total_sales": "sales_amount"}, ["category"])
    g = g.withColumn("total_sales", F.col("total_sales").cast(MONEY_SUM))
    # the total over the grouped rows: its fact side is the same exchange, run once
    g = with_grand_total(g, "total_sales")
    return g.select("category", "total_sales", F.col("grand_total").cast(MONEY_SUM),
                    ratio(F.col("total_sales") * 100, "grand_total", 2).alias("sales_percentage"))


def cost_range_label(cost, edges=(100, 500, 1000)) -> F.Column:
    """A8 buckets: below e1; e1-e2 and e2-e3 inclusive (first match wins); else
    above e3 (also for NULL)."""
    e1, e2, e3 = edges
    c = F.col(cost) if isinstance(cost, str) else cost
    return (F.when(c < e1, f"Below {e1}").when(c.between(e1, e2), f"{e1}-{e2}")
             .when(c.between(e2, e3), f"{e2}-{e3}").otherwise(f"Above {e3}"))


def products_by_cost_range(p: DataFrame, edges=(100, 500, 1000)) -> DataFrame:
    """A8"""
    return p.groupBy(cost_range_label("cost", edges).alias("cost_range")) \
            .agg(F.count("product_key").alias("total_products")) \
            .orderBy(F.desc("total_products"), F.asc("cost_range"))


def customer_segment(lifespan, sales, months: int = 12, spend: float = 5000) -> F.Column:
    """VIP, Regular or New."""
    ls = F.col(lifespan) if isinstance(lifespan, str) else lifespan
    s = F.col(sales) if isinstance(sales, str) else sales
    return (F.when((ls >= months) & (s > spend), "VIP")
             .when((ls >= months) & (s <= spend), "Regular").otherwise("New"))


def customers_by_segment(f: DataFrame, months: int = 12, spend: float = 5000) -> DataFrame:
    """Customers per segment by history length and total spend."""
    per = f.groupBy("customer_key").agg(
        month_diff(*order_span(f)).alias("lifespan"),
        F.sum("sales_amount").alias("spend"))
    return per.groupBy(customer_segment("lifespan", "spend", months, spend)
                       .alias("customer_segment")) \
              .agg(F.count("customer_key").alias("total_customers")) \
              .orderBy(F.desc("total_customers"), F.asc("customer_segment"))
