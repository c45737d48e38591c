"""The star schema (two dimensions, one fact).

Joins are all left joins in the written order.  Customers, products and their
ERP rows grow with the data, so they are shuffled and merged at any size
(``merged``); the planner broadcasts the categories when their files are under
``spark.sql.autoBroadcastJoinThreshold``.  A hot fact key is split by AQE's skew
join.  Text keys are equal under the warehouse's collation (M4).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerstar.functions.clean import UNKNOWN
from layerstar.functions.text import same_text
from layerstar.operators.rows import merged, surrogate_key

CUSTOMER_ORDER = ["customer_id"]
PRODUCT_ORDER = ["start_date", "product_id"]


def merge_master(primary, fallback, unknown: str = UNKNOWN) -> Column:
    """The primary value unless it is ``unknown``, then the fallback, then
    ``unknown``."""
    p = F.col(primary) if isinstance(primary, str) else primary
    f = F.col(fallback) if isinstance(fallback, str) else fallback
    return F.when(p != unknown, p).otherwise(F.coalesce(f, F.lit(unknown)))


def customers_joined(cust: DataFrame, az12: DataFrame, loc: DataFrame) -> DataFrame:
    """G1 without the key: customers, left join birth/gender, left join location."""
    ci, ca, la = cust.alias("ci"), merged(az12).alias("ca"), merged(loc).alias("la")
    j = (ci.join(ca, same_text("ci.cst_key", "ca.cid"), "left")
           .join(la, same_text("ci.cst_key", "la.cid"), "left"))
    return j.select(
        F.col("ci.cst_id").alias("customer_id"),
        F.col("ci.cst_key").alias("customer_number"),
        F.col("ci.cst_firstname").alias("firstname"),
        F.col("ci.cst_lastname").alias("lastname"),
        F.col("la.cntry").alias("country"),
        merge_master(F.col("ci.cst_gndr"), F.col("ca.gen")).alias("gender"),
        F.col("ci.cst_marital_status").alias("marital_status"),
        F.col("ca.bdate").alias("birthdate"),
        F.col("ci.cst_create_date").alias("create_date"))


def products_joined(prd: DataFrame, cat: DataFrame) -> DataFrame:
    """G3 without the key: current products (no end date), left join category."""
    pi, pc = prd.where(F.col("prd_end_dt").isNull()).alias("pi"), cat.alias("pc")
    j = pi.join(pc, same_text("pi.cat_id", "pc.id"), "left")
    return j.select(
        F.col("pi.prd_id").alias("product_id"), F.col("pi.prd_key").alias("product_number"),
        F.col("pi.prd_nm").alias("product_name"), F.col("pi.cat_id").alias("category_id"),
        F.col("pc.cat").alias("category"), F.col("pc.subcat").alias("subcategory"),
        F.col("pc.maintenance").alias("maintenance"), F.col("pi.prd_cost").alias("cost"),
        F.col("pi.prd_line").alias("product_line"), F.col("pi.prd_start_dt").alias("start_date"))


def add_customer_key(joined: DataFrame, path: str | None = None) -> DataFrame:
    """G4 for customers: customer_key = row number by id, first column.  The
    joined rows are stored at ``path`` on the way (see ``surrogate_key``)."""
    df = surrogate_key(joined, CUSTOMER_ORDER, "customer_key", path)
    return df.select("customer_key", *[c for c in df.columns if c != "customer_key"])


def add_product_key(joined: DataFrame, path: str | None = None) -> DataFrame:
    """G4 for products: product_key = row number by (start date, id), first column."""
    df = surrogate_key(joined, PRODUCT_ORDER, "product_key", path)
    return df.select("product_key", *[c for c in df.columns if c != "product_key"])


def dim_customers(cust: DataFrame, az12: DataFrame, loc: DataFrame, path: str | None = None) -> DataFrame:
    """G1 + G4: customer dimension."""
    return add_customer_key(customers_joined(cust, az12, loc), path)


def dim_products(prd: DataFrame, cat: DataFrame, path: str | None = None) -> DataFrame:
    """G3 + G4: product dimension."""
    return add_product_key(products_joined(prd, cat), path)


def fact_sales(sales: DataFrame, dim_c: DataFrame, dim_p: DataFrame) -> DataFrame:
    """Sales lines with both surrogate keys; an unmatched key stays NULL."""
    sd = sales.alias("sd")
    cv = dim_c.select(F.col("customer_id").alias("cv_id"), "customer_key")
    pv = dim_p.select(F.col("product_number").alias("pv_number"), "product_key")
    j = (sd.join(merged(cv), F.col("sd.sls_cust_id") == F.col("cv_id"), "left")
           .join(merged(pv), same_text("sd.sls_prd_key", "pv_number"), "left"))
    return j.select(
        F.col("sd.sls_ord_num").alias("order_number"), "product_key", "customer_key",
        F.col("sd.sls_order_dt").alias("order_date"),
        F.col("sd.sls_ship_dt").alias("shipping_date"),
        F.col("sd.sls_due_dt").alias("due_date"),
        F.col("sd.sls_sales").alias("sales_amount"),
        F.col("sd.sls_quantity").alias("quantity"),
        F.col("sd.sls_price").alias("price"))
