"""The six silver table loads, each a composition of cleansing steps."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerstar.functions import clean as C
from layerstar.functions.dates import parse_yyyymmdd
from layerstar.operators.rows import derive_end_date, impute_order_date, latest_per_key

CUST_TEXT = ["cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr"]


def load_cust_info(b: DataFrame, now: _dt.datetime | None = None) -> DataFrame:
    """L1: T1 trim, T4 drop NULL ids, T3 newest row per id, T2 code labels, T23."""
    t = C.trim_columns(b, CUST_TEXT)
    t = C.drop_null_keys(t, "cst_id")
    t = latest_per_key(t, "cst_id", "cst_create_date", tie=CUST_TEXT)
    out = t.select(
        "cst_id", "cst_key", "cst_firstname", "cst_lastname",
        C.map_codes("cst_marital_status", C.MARITAL_CODES).alias("cst_marital_status"),
        C.map_codes("cst_gndr", C.GENDER_CODES).alias("cst_gndr"),
        "cst_create_date")
    return C.with_load_time(out, now)


def load_prd_info(b: DataFrame, now: _dt.datetime | None = None) -> DataFrame:
    """L2: T4, T1, T10 on the trimmed original key, T5, T6, T8, T9, T23.

    The source end date is not used: T10 derives it."""
    t = C.drop_null_keys(b, "prd_id").select(
        "prd_id", F.trim("prd_key").alias("prd_key"), F.trim("prd_nm").alias("prd_nm"),
        F.trim("prd_cost").alias("prd_cost"), F.trim("prd_line").alias("prd_line"),
        "prd_start_dt")
    t = derive_end_date(t, "prd_key", "prd_start_dt", "prd_end_dt", "prd_id")
    out = t.select(
        "prd_id", C.category_id("prd_key").alias("cat_id"),
        C.product_number("prd_key").alias("prd_key"), "prd_nm",
        C.clean_cost("prd_cost").alias("prd_cost"),
        C.product_line("prd_line").alias("prd_line"), "prd_start_dt", "prd_end_dt")
    return C.with_load_time(out, now)


def load_sales_details(b: DataFrame, now: _dt.datetime | None = None) -> DataFrame:
    """L3: T7, T11, T12, T14, T13, T15, T16, T23."""
    s = b.select(
        "sls_ord_num", C.normalise_key("sls_prd_key").alias("sls_prd_key"), "sls_cust_id",
        parse_yyyymmdd("sls_order_dt").alias("sls_order_dt"),
        parse_yyyymmdd("sls_ship_dt").alias("sls_ship_dt"),
        parse_yyyymmdd("sls_due_dt").alias("sls_due_dt"),
        C.abs_decimal("sls_sales").alias("sls_sales"),
        C.abs_int("sls_quantity").alias("sls_quantity"),
        C.abs_decimal("sls_price").alias("sls_price"))
    s = impute_order_date(s, "sls_order_dt", "sls_ship_dt")
    s = s.select("sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt", "sls_ship_dt",
                 "sls_due_dt", C.zero_to_null("sls_sales").alias("s"),
                 C.zero_to_null("sls_quantity").alias("q"), C.zero_to_null("sls_price").alias("p"))
    out = s.select(
        "sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt", "sls_ship_dt", "sls_due_dt",
        C.repair_sales("s", "q", "p").cast(C.MONEY).alias("sls_sales"),
        F.col("q").cast("int").alias("sls_quantity"),
        C.repair_price("s", "q", "p").cast(C.MONEY).alias("sls_price"))
    return C.with_load_time(out, now)


MEASURES = {"sls_sales": C.MONEY, "sls_quantity": "int", "sls_price": C.MONEY}


def split_bad_measures(b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quarantine option: (rows whose measures parse, rows with a
    measure text that does not parse, with the reason).

    By default the sales load stops on such a row, as the warehouse's CAST
    does; with ``quarantine=True`` the rows are kept aside in their own table
    instead of stopping the load.  No row is dropped either way."""
    bad = {c: F.col(c).isNotNull() & F.trim(F.col(c)).try_cast(t).isNull() for c, t in MEASURES.items()}
    any_bad = bad["sls_sales"] | bad["sls_quantity"] | bad["sls_price"]
    reason = F.concat_ws(", ", *[F.when(cond, F.lit(f"{c} does not parse")) for c, cond in bad.items()])
    return b.where(~any_bad), b.where(any_bad).withColumn("reason", reason)


def load_cust_az12(b: DataFrame, as_of, now: _dt.datetime | None = None) -> DataFrame:
    """L4: T17, T18, T19, T23."""
    out = b.select(C.strip_prefix("cid", "NAS").alias("cid"),
                   C.null_future("bdate", as_of).alias("bdate"),
                   C.map_gender("gen").alias("gen"))
    return C.with_load_time(out, now)


def load_loc_a101(b: DataFrame, now: _dt.datetime | None = None) -> DataFrame:
    """T20, T21, T23."""
    out = b.select(C.strip_hyphen("cid").alias("cid"), C.map_country("cntry").alias("cntry"))
    return C.with_load_time(out, now)


def load_px_cat(b: DataFrame, now: _dt.datetime | None = None) -> DataFrame:
    """T22, T23."""
    return C.with_load_time(C.load_categories(b), now)


def silver_steps(bronze: Mapping[str, DataFrame], as_of, now=None, quarantine: bool = False):
    """The six loads as lazy builders, in load order.  With ``quarantine`` the
    sales rows whose measures do not parse go to ``crm_sales_details_quarantine``
    instead of stopping the load."""
    if quarantine:
        good, bad = split_bad_measures(bronze["crm_sales_details"])
        bronze = {**bronze, "crm_sales_details": good}
    steps = {
        "crm_cust_info": lambda: load_cust_info(bronze["crm_cust_info"], now),
        "crm_prd_info": lambda: load_prd_info(bronze["crm_prd_info"], now),
        "crm_sales_details": lambda: load_sales_details(bronze["crm_sales_details"], now),
        "erp_cust_az12": lambda: load_cust_az12(bronze["erp_cust_az12"], as_of, now),
        "erp_loc_a101": lambda: load_loc_a101(bronze["erp_loc_a101"], now),
        "erp_px_cat_g1v2": lambda: load_px_cat(bronze["erp_px_cat_g1v2"], now),
    }
    if quarantine:
        steps["crm_sales_details_quarantine"] = lambda: C.with_load_time(bad, now)
    return steps
