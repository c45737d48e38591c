"""Exploration queries over the star schema.

Results come in the reference's order (ORDER BY ... with NULL lowest, ties
broken by the group), a distributed sort over the small aggregated result.

Text groups (country, category, name, ...) are equal under the warehouse's
collation (M4); of the spellings of a group the least is shown.

``f``, ``c``, ``p`` are fact_sales, dim_customers, dim_products.  Sums, means and extremes give the same
over a roll-up in place of the fact (by product: E5-E7, E16, E19, E20; by customer: E3, E17, E18).  Amounts stay
numbers (decimal sums, means rounded to 4 places); ``fmt.money`` etc. turn them
into the display text as a last step (E11 does so, as its result is a sheet).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerstar.functions import fmt
from layerstar.functions.dates import as_date_lit, month_diff, year_diff
from layerstar.functions.num import money_sum, ratio
from layerstar.functions.text import full_name
from layerstar.operators.rows import group_text
from layerstar.plans.rollup import Rollups, distinct_keys, order_span, price_parts


def distinct_countries(c: DataFrame) -> DataFrame:
    """E1"""
    return group_text(c, ["country"])


def distinct_categories(p: DataFrame) -> DataFrame:
    """E2"""
    return group_text(p, ["category", "subcategory"])


def order_date_range(f: DataFrame) -> DataFrame:
    """First and last order, and the range in years and months (boundaries)."""
    first, last = order_span(f)
    a = f.agg(first.alias("first_order"), last.alias("last_order"))
    return a.select("first_order", "last_order",
                    year_diff("first_order", "last_order").alias("order_range_years"),
                    month_diff("first_order", "last_order").alias("order_range_months"))


def age_extremes(c: DataFrame, as_of) -> DataFrame:
    """The oldest and the youngest customer (TOP 1 each; ties by key)."""
    base = c.where(F.col("birthdate").isNotNull()).select(
        full_name("firstname", "lastname").alias("customer"), "birthdate", "customer_key",
        year_diff("birthdate", as_date_lit(as_of)).alias("age"))
    oldest = base.orderBy(F.col("birthdate").asc(), F.col("customer_key").asc()).limit(1) \
                 .withColumn("label", F.lit("Oldest Customer"))
    youngest = base.orderBy(F.col("birthdate").desc(), F.col("customer_key").asc()).limit(1) \
                   .withColumn("label", F.lit("Youngest Customer"))
    cols = ["customer", "label", "birthdate", "age"]
    return oldest.select(*cols).unionByName(youngest.select(*cols))


def total_sales(f: DataFrame) -> DataFrame:
    """E5"""
    return f.agg(money_sum("sales_amount").alias("total_sales"))


def total_quantity(f: DataFrame) -> DataFrame:
    """E6"""
    return f.agg(F.sum("quantity").cast("bigint").alias("total_quantity"))


def average_price(f: DataFrame) -> DataFrame:
    """E7"""
    return f.agg(ratio(*price_parts(f)).alias("avg_price"))


def order_counts(f: DataFrame) -> DataFrame:
    """Order lines and distinct orders."""
    return f.agg(F.count("order_number").alias("total_orders"),
                 F.countDistinct("order_number").alias("distinct_total_orders"))


def _keys_in(f: DataFrame, key: str, bits: DataFrame | None) -> Column:
    """Distinct keys of the fact, from the bitmaps of its keys where they are given."""
    return (f.agg(F.countDistinct(key)) if bits is None else distinct_keys(bits)).scalar()


def product_counts(f: DataFrame, p: DataFrame, product_bits: DataFrame | None = None) -> DataFrame:
    """Products in the dimension and products sold (one row)."""
    sold = _keys_in(f, "product_key", product_bits)
    return p.agg(F.count("product_key").alias("total_products")) \
            .withColumn("sold_products", sold)


def customer_counts(f: DataFrame, c: DataFrame, customer_bits: DataFrame | None = None) -> DataFrame:
    """Customers in the dimension and customers with orders (one row)."""
    with_orders = _keys_in(f, "customer_key", customer_bits)
    return c.agg(F.count("customer_key").alias("total_customers")) \
            .withColumn("customers_with_orders", with_orders)


def key_metrics(f: DataFrame, c: DataFrame, p: DataFrame, rollups: Rollups | None = None) -> DataFrame:
    """Eight measures as (measure_name, measure_value) rows.

    One aggregate for the sums, and each distinct count as a scalar subquery
    over its own column: together in one aggregate the counts would expand
    every fact row once per counted column.  With ``rollups`` only the order
    numbers come from the fact.  ``stack`` turns the single row into eight."""
    def distinct(c):
        return f.select(c).where(F.col(c).isNotNull()).distinct().agg(F.count(F.lit(1))).scalar()
    sums = rollups.by_product if rollups else f
    price, prices = price_parts(sums)
    fa = sums.agg(money_sum("sales_amount").alias("ts"), ratio(price, prices, 2).alias("ap"),
                  F.sum("quantity").alias("tq"))
    keys = {"ps": ("product_key", rollups and rollups.product_bits), "cw": ("customer_key", rollups and rollups.customer_bits)}
    fa = fa.withColumns({"to": distinct("order_number"),
                         **{n: distinct(k) if bits is None else distinct_keys(bits).scalar() for n, (k, bits) in keys.items()}})
    row = fa.select(
        fmt.money("ts").alias("v1"), fmt.money("ap").alias("v2"), fmt.n0("tq").alias("v3"),
        fmt.n0("to").alias("v4"),
        fmt.n0(p.agg(F.count("product_key")).scalar()).alias("v5"),
        fmt.n0("ps").alias("v6"),
        fmt.n0(c.agg(F.count("customer_key")).scalar()).alias("v7"),
        fmt.n0("cw").alias("v8"))
    return row.select(F.expr(
        "stack(8, 'Total Sales', v1, 'Average Price', v2, 'Total Quantity Sold', v3, "
        "'Total Orders', v4, 'Total Products', v5, 'Product Variety Sold', v6, "
        "'Total Customers', v7, 'Customers with Orders', v8) AS (measure_name, measure_value)"))


def customers_by_country(c: DataFrame) -> DataFrame:
    """E12"""
    return group_text(c, ["country"], total_customers=F.count("customer_key")) \
            .orderBy(F.desc("total_customers"), F.asc("country"))


def customers_by_gender(c: DataFrame) -> DataFrame:
    """E13"""
    return group_text(c, ["gender"], total_customers=F.count("customer_key")) \
            .orderBy(F.desc("total_customers"), F.asc("gender"))


def products_by_category(p: DataFrame) -> DataFrame:
    """E14"""
    return group_text(p, ["category"], total_products=F.count("product_id")) \
            .orderBy(F.desc("total_products"), F.asc("category"))


def cost_by_category(p: DataFrame) -> DataFrame:
    """Mean cost per category."""
    g = group_text(p, ["category"], s=F.sum("cost"), n=F.count("cost"))
    return g.select("category", ratio("s", "n").alias("avg_cost")) \
            .orderBy(F.desc("avg_cost"), F.asc("category"))


def pre_aggregate_join(f: DataFrame, dim: DataFrame, key: str, sums: dict[str, str],
                       by: list[str]) -> DataFrame:
    """Sum fact columns per dimension attribute(s) ``by``, joined on ``key``.

    Same result as ``f LEFT JOIN dim ON key GROUP BY by`` with SUM, but the fact
    is first aggregated on the join key (sums decompose exactly): the fact is
    shuffled once, already combined on the map side, the join sees one row per
    key instead of one per sale, and it reuses the key partitioning when the
    dimension is too large to broadcast.  Unmatched keys fall into the NULL
    group, as in the left join."""
    pre = f.groupBy(key).agg(*[F.sum(c).alias(f"__{n}") for n, c in sums.items()])
    d = dim.select(F.col(key).alias("__dk"), *by)
    j = pre.join(d, pre[key] == d["__dk"], "left")
    return group_text(j, by, **{n: F.sum(f"__{n}") for n in sums})


def revenue_by_category(f: DataFrame, p: DataFrame) -> DataFrame:
    """E16"""
    g = pre_aggregate_join(f, p, "product_key", {"total_revenue": "sales_amount"}, ["category"])
    return g.select("category", F.col("total_revenue").cast("decimal(38,2)")) \
            .orderBy(F.desc("total_revenue"), F.asc("category"))


def revenue_by_customer(f: DataFrame, c: DataFrame) -> DataFrame:
    """Per customer key and name; the name by ``+`` (NULL if a part is)."""
    cd = c.withColumnRenamed("customer_key", "ck").withColumn("customer_key", F.col("ck"))
    g = pre_aggregate_join(f, cd, "customer_key", {"total_revenue": "sales_amount"},
                           ["ck", "firstname", "lastname"])
    return g.select(full_name("firstname", "lastname").alias("customer"),
                    F.col("ck").alias("customer_key"),
                    F.col("total_revenue").cast("decimal(38,2)")) \
            .orderBy(F.desc("total_revenue"), F.asc("customer_key"))


def items_by_country(f: DataFrame, c: DataFrame) -> DataFrame:
    """E18"""
    g = pre_aggregate_join(f, c, "customer_key", {"sold_items_distribution": "quantity"},
                           ["country"])
    return g.select("country", F.col("sold_items_distribution").cast("bigint")) \
            .orderBy(F.desc("sold_items_distribution"), F.asc("country"))


def _revenue_by_product_name(f: DataFrame, p: DataFrame) -> DataFrame:
    g = pre_aggregate_join(f, p, "product_key", {"total_revenue": "sales_amount"},
                           ["product_name"])
    return g.select("product_name", F.col("total_revenue").cast("decimal(38,2)"))


def top_products(f: DataFrame, p: DataFrame, n: int = 5) -> DataFrame:
    """The n product names with the most revenue (ties by name)."""
    g = _revenue_by_product_name(f, p)
    return g.orderBy(F.col("total_revenue").desc_nulls_last(),
                     F.col("product_name").asc_nulls_first()).limit(n)


def bottom_products(f: DataFrame, p: DataFrame, n: int = 5) -> DataFrame:
    """The n product names with the least revenue (ties by name)."""
    g = _revenue_by_product_name(f, p)
    return g.orderBy(F.col("total_revenue").asc_nulls_first(),
                     F.col("product_name").asc_nulls_first()).limit(n)
