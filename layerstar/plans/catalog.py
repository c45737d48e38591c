"""Every SURVEY §2 operator as a query over the driver tables in ``sf_dir``.

Each entry takes (spark, sf_dir) and returns a lazy DataFrame.  The warehouse
(extracts -> bronze -> silver -> gold) is built once per session and reused;
T steps run on bronze, L loads are the silver tables, G/E/A/R run on gold,
Q checks on the layer the check names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from layerstar.functions import clean as C
from layerstar.functions.dates import parse_yyyymmdd
from layerstar.functions.text import same_text
from layerstar.operators import quality as Q
from layerstar.operators.rows import derive_end_date, impute_order_date, latest_per_key, merged
from layerstar.plans import analyse as A
from layerstar.plans import explore as E
from layerstar.plans import gold as G
from layerstar.plans import reports as R
from layerstar.plans.checks import run_layer_checks
from layerstar.plans.display import display
from layerstar.plans.silver import CUST_TEXT
from layerstar.plans.warehouse import AS_OF, LOAD_TIME, Warehouse, describe, register_views, warehouse_for
from layerstar.sources.io import Layers, load_tables, new_run_id
from layerstar.sources.schemas import BRONZE, MAX_LENGTH, SILVER

# Parameters for the driver tables: thresholds near the spread
# of the data, so that every segment can occur.
CUSTOMER_MONTHS, CUSTOMER_SPEND = 60, 2_000_000
PRODUCT_HIGH, PRODUCT_MID = 1_900_000, 1_400_000
COST_EDGES = (925, 950, 975)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir, fn=fn: fn(warehouse_for(spark, sf_dir))
        return fn
    return deco


def _b(wh, t):
    return wh.bronze(t)


def _s(wh, t):
    return wh.silver(t)


def _fcp(wh):
    return wh.gold("fact_sales"), wh.gold("dim_customers"), wh.gold("dim_products")


def _products(wh):
    """What sums by product and month read: the roll-up, or the fact of a run that has none."""
    r = wh.rollups()
    return wh.gold("fact_sales") if r is None else r.by_product


def _customers(wh):
    r = wh.rollups()
    return wh.gold("fact_sales") if r is None else r.by_customer


def _bits(wh, which):
    r = wh.rollups()
    return None if r is None else r.customer_bits if which == "customer" else r.product_bits


# ---------------------------------------------------------------- S
@query("S8")
def s8(wh):
    from layerstar.sources.io import preview
    return preview(wh.gold("dim_customers"), 10, order_by="customer_key")


# ---------------------------------------------------------------- T steps
@query("T1")
def t1(wh):
    return C.trim_columns(_b(wh, "crm_cust_info"), CUST_TEXT)


@query("T2")
def t2(wh):
    b = _b(wh, "crm_cust_info")
    return b.select("cst_id", "cst_marital_status",
                    C.map_codes(F.trim("cst_marital_status"), C.MARITAL_CODES).alias("marital_label"),
                    "cst_gndr", C.map_codes(F.trim("cst_gndr"), C.GENDER_CODES).alias("gender_label"))


@query("T3")
def t3(wh):
    return latest_per_key(C.trim_columns(_b(wh, "crm_cust_info"), CUST_TEXT), "cst_id",
                          "cst_create_date", tie=CUST_TEXT)


@query("T4")
def t4(wh):
    return C.drop_null_keys(_b(wh, "crm_cust_info"), "cst_id")


def _prd_trimmed(wh):
    return _b(wh, "crm_prd_info").select("prd_id", F.trim("prd_key").alias("prd_key"),
                                         "prd_cost", "prd_line", "prd_start_dt")


@query("T5")
def t5(wh):
    return _prd_trimmed(wh).select("prd_id", "prd_key", C.category_id("prd_key").alias("cat_id"))


@query("T6")
def t6(wh):
    return _prd_trimmed(wh).select("prd_id", "prd_key",
                                   C.product_number("prd_key").alias("product_number"))


@query("T7")
def t7(wh):
    return _b(wh, "crm_sales_details").select(
        "sls_ord_num", "sls_prd_key", C.normalise_key("sls_prd_key").alias("normalised_key"))


@query("T8")
def t8(wh):
    return _b(wh, "crm_prd_info").select("prd_id", "prd_cost",
                                         C.clean_cost("prd_cost").alias("clean_cost"))


@query("T9")
def t9(wh):
    return _b(wh, "crm_prd_info").select(
        "prd_id", "prd_line", C.product_line(F.trim("prd_line")).alias("line_label"))


@query("T10")
def t10(wh):
    t = C.drop_null_keys(_prd_trimmed(wh), "prd_id").select("prd_id", "prd_key", "prd_start_dt")
    return derive_end_date(t, "prd_key", "prd_start_dt", "prd_end_dt", "prd_id")


def _sales_parsed(wh):
    b = _b(wh, "crm_sales_details")
    return b.select("sls_ord_num",
                    parse_yyyymmdd("sls_order_dt").alias("sls_order_dt"),
                    parse_yyyymmdd("sls_ship_dt").alias("sls_ship_dt"),
                    parse_yyyymmdd("sls_due_dt").alias("sls_due_dt"),
                    C.abs_decimal("sls_sales").alias("sls_sales"),
                    C.abs_int("sls_quantity").alias("sls_quantity"),
                    C.abs_decimal("sls_price").alias("sls_price"))


def _sales_nulled(wh):
    s = _sales_parsed(wh)
    return s.select("sls_ord_num", "sls_order_dt", "sls_ship_dt",
                    C.zero_to_null("sls_sales").alias("s"), C.zero_to_null("sls_quantity").alias("q"),
                    C.zero_to_null("sls_price").alias("p"))


@query("T11")
def t11(wh):
    return _sales_parsed(wh).select("sls_ord_num", "sls_order_dt", "sls_ship_dt", "sls_due_dt")


@query("T12")
def t12(wh):
    return _sales_parsed(wh).select("sls_ord_num", "sls_sales", "sls_quantity", "sls_price")


@query("T13")
def t13(wh):
    return _sales_nulled(wh).select("sls_ord_num", F.col("s").alias("sls_sales"),
                                    F.col("q").alias("sls_quantity"), F.col("p").alias("sls_price"))


@query("T14")
def t14(wh):
    s = _sales_parsed(wh).select("sls_ord_num", "sls_order_dt", "sls_ship_dt")
    return impute_order_date(s, "sls_order_dt", "sls_ship_dt")


@query("T15")
def t15(wh):
    return _sales_nulled(wh).select("sls_ord_num", C.repair_sales("s", "q", "p").alias("sls_sales"))


@query("T16")
def t16(wh):
    return _sales_nulled(wh).select("sls_ord_num", C.repair_price("s", "q", "p").alias("sls_price"))


@query("T17")
def t17(wh):
    return _b(wh, "erp_cust_az12").select("cid", C.strip_prefix("cid", "NAS").alias("clean_cid"))


@query("T18")
def t18(wh):
    return _b(wh, "erp_cust_az12").select("cid", "bdate",
                                          C.null_future("bdate", AS_OF).alias("clean_bdate"))


@query("T19")
def t19(wh):
    return _b(wh, "erp_cust_az12").select("cid", "gen", C.map_gender("gen").alias("clean_gen"))


@query("T20")
def t20(wh):
    return _b(wh, "erp_loc_a101").select("cid", C.strip_hyphen("cid").alias("clean_cid"))


@query("T21")
def t21(wh):
    return _b(wh, "erp_loc_a101").select("cid", "cntry", C.map_country("cntry").alias("clean_cntry"))


@query("T22")
def t22(wh):
    return C.load_categories(_b(wh, "erp_px_cat_g1v2"))


@query("T23")
def t23(wh):
    return C.with_load_time(C.load_categories(_b(wh, "erp_px_cat_g1v2")), LOAD_TIME)


# ---------------------------------------------------------------- L loads
for _i, _t in enumerate(["crm_cust_info", "crm_prd_info", "crm_sales_details", "erp_cust_az12",
                         "erp_loc_a101", "erp_px_cat_g1v2"], start=1):
    query(f"L{_i}")(lambda wh, t=_t: wh.silver(t))


# ---------------------------------------------------------------- G star
@query("G1")
def g1(wh):
    return G.customers_joined(_s(wh, "crm_cust_info"), _s(wh, "erp_cust_az12"),
                              _s(wh, "erp_loc_a101"))


@query("G2")
def g2(wh):
    ci = _s(wh, "crm_cust_info").alias("ci")
    ca = _s(wh, "erp_cust_az12").alias("ca")
    j = ci.join(ca, same_text("ci.cst_key", "ca.cid"), "left")
    return j.select(F.col("ci.cst_id").alias("customer_id"), F.col("ci.cst_gndr").alias("crm_gender"),
                    F.col("ca.gen").alias("erp_gender"),
                    G.merge_master(F.col("ci.cst_gndr"), F.col("ca.gen")).alias("gender"))


@query("G3")
def g3(wh):
    return G.products_joined(_s(wh, "crm_prd_info"), _s(wh, "erp_px_cat_g1v2"))


@query("G4")
def g4(wh):
    return wh.gold("dim_products").select("product_key", "product_id", "start_date")


@query("G4_customers")
def g4c(wh):
    return wh.gold("dim_customers").select("customer_key", "customer_id")


@query("G5")
def g5(wh):
    return wh.gold("fact_sales")


# ---------------------------------------------------------------- E
@query("E1")
def e1(wh):
    return E.distinct_countries(wh.gold("dim_customers"))


@query("E2")
def e2(wh):
    return E.distinct_categories(wh.gold("dim_products"))


@query("E3")
def e3(wh):
    return E.order_date_range(wh.gold("fact_sales"))


@query("E4")
def e4(wh):
    return E.age_extremes(wh.gold("dim_customers"), AS_OF)


@query("E5")
def e5(wh):
    return E.total_sales(wh.gold("fact_sales"))


@query("E6")
def e6(wh):
    return E.total_quantity(wh.gold("fact_sales"))


@query("E7")
def e7(wh):
    return E.average_price(wh.gold("fact_sales"))


@query("E8")
def e8(wh):
    return E.order_counts(wh.gold("fact_sales"))


@query("E9")
def e9(wh):
    f, c, p = _fcp(wh)
    return E.product_counts(f, p, _bits(wh, "product"))


@query("E10")
def e10(wh):
    f, c, p = _fcp(wh)
    return E.customer_counts(f, c, _bits(wh, "customer"))


@query("E11")
def e11(wh):
    return E.key_metrics(*_fcp(wh), wh.rollups())


@query("E12")
def e12(wh):
    return E.customers_by_country(wh.gold("dim_customers"))


@query("E13")
def e13(wh):
    return E.customers_by_gender(wh.gold("dim_customers"))


@query("E14")
def e14(wh):
    return E.products_by_category(wh.gold("dim_products"))


@query("E15")
def e15(wh):
    return E.cost_by_category(wh.gold("dim_products"))


@query("E16")
def e16(wh):
    return E.revenue_by_category(_products(wh), wh.gold("dim_products"))


@query("E17")
def e17(wh):
    return E.revenue_by_customer(_customers(wh), wh.gold("dim_customers"))


@query("E18")
def e18(wh):
    return E.items_by_country(_customers(wh), wh.gold("dim_customers"))


@query("E19")
def e19(wh):
    return E.top_products(_products(wh), wh.gold("dim_products"), 5)


@query("E20")
def e20(wh):
    return E.bottom_products(_products(wh), wh.gold("dim_products"), 5)


# ---------------------------------------------------------------- A
@query("A1")
def a1(wh):
    return A.sales_by_year(_products(wh), _bits(wh, "customer"))


@query("A2")
def a2(wh):
    return A.sales_by_month(_products(wh), _bits(wh, "customer"))


@query("A3")
def a3(wh):
    return A.running_sales(_products(wh))


@query("A4")
def a4(wh):
    return A.cumulative_price(_products(wh))


@query("A5")
def a5(wh):
    return A.product_yoy(_products(wh), wh.gold("dim_products"))


@query("A6")
def a6(wh):
    return A.product_vs_average(_products(wh), wh.gold("dim_products"))


@query("A7")
def a7(wh):
    return A.category_share(_products(wh), wh.gold("dim_products"))


@query("A8")
def a8(wh):
    return A.products_by_cost_range(wh.gold("dim_products"), COST_EDGES)


@query("A9")
def a9(wh):
    return A.customers_by_segment(_customers(wh), CUSTOMER_MONTHS, CUSTOMER_SPEND)


# ---------------------------------------------------------------- R
@query("R1")
def r1(wh):
    f, c, p = _fcp(wh)
    # gold fact keys are looked up in these same dimensions (G5): NULL or present
    return R.report_customers(f, c, AS_OF, CUSTOMER_MONTHS, CUSTOMER_SPEND, keys_from_dim=True)


@query("R2")
def r2(wh):
    f, c, p = _fcp(wh)
    r = wh.rollups()
    return R.report_products(f, p, AS_OF, PRODUCT_HIGH, PRODUCT_MID, keys_from_dim=True,
                             by_product=r and r.by_product)


# ---------------------------------------------------------------- Q checks
@query("Q1")
def q1(wh):
    return Q.duplicate_or_null_key(_b(wh, "crm_cust_info"), "cst_id")


@query("Q2")
def q2(wh):
    return Q.rows_with_bad_key(_b(wh, "crm_cust_info"), "cst_id")


@query("Q3")
def q3(wh):
    return Q.untrimmed(_b(wh, "crm_cust_info"), ["cst_firstname", "cst_gndr"])


@query("Q4")
def q4(wh):
    return Q.domain_values(_b(wh, "crm_cust_info"), "cst_marital_status")


@query("Q4_silver")
def q4s(wh):
    return Q.domain_values(_s(wh, "crm_cust_info"), "cst_gndr", ["Male", "Female", "Unknown"])


@query("Q5")
def q5(wh):
    return Q.null_or_negative(_b(wh, "crm_prd_info"), "prd_cost")


@query("Q6")
def q6(wh):
    return Q.reversed_range(_b(wh, "crm_prd_info"), "prd_start_dt", "prd_end_dt", "prd_key")


@query("Q7")
def q7(wh):
    return Q.null_any(_b(wh, "crm_prd_info"), ["prd_start_dt", "prd_end_dt"])


@query("Q8")
def q8(wh):
    return Q.null_any(_b(wh, "crm_sales_details"), ["sls_cust_id", "sls_prd_key", "sls_ord_num"])


@query("Q9")
def q9(wh):
    return Q.repeated_key(_b(wh, "crm_sales_details"), "sls_ord_num")


@query("Q10")
def q10(wh):
    return Q.orphans(_s(wh, "crm_sales_details"), "sls_cust_id", _s(wh, "crm_cust_info"), "cst_id")


@query("Q11")
def q11(wh):
    prd = _s(wh, "crm_prd_info").select("prd_id", "prd_key", "cat_id")
    return Q.not_in(prd, "cat_id", _b(wh, "erp_px_cat_g1v2"), "id", skip_null=True)


@query("Q12")
def q12(wh):
    return Q.if_parent_empty(_b(wh, "crm_sales_details"), _s(wh, "crm_prd_info"))


@query("Q13")
def q13(wh):
    return Q.unparsable_dates(_b(wh, "crm_sales_details"),
                              ["sls_order_dt", "sls_ship_dt", "sls_due_dt"])


@query("Q14")
def q14(wh):
    return Q.dates_out_of_order(_b(wh, "crm_sales_details"), "sls_order_dt", "sls_ship_dt",
                                "sls_due_dt")


@query("Q15")
def q15(wh):
    return Q.dates_out_of_bounds(_b(wh, "crm_sales_details"),
                                 ["sls_ship_dt", "sls_due_dt", "sls_order_dt"], AS_OF)


@query("Q16")
def q16(wh):
    return Q.measure_mismatch(_b(wh, "crm_sales_details"), "sls_sales", "sls_quantity", "sls_price")


@query("Q16_silver")
def q16s(wh):
    return Q.measure_mismatch(_s(wh, "crm_sales_details"), "sls_sales", "sls_quantity",
                              "sls_price", negatives=True)


@query("Q17")
def q17(wh):
    return Q.length_histogram(_b(wh, "erp_cust_az12"), "cid")


@query("Q18")
def q18(wh):
    return Q.birthdate_bounds(_b(wh, "erp_cust_az12"), "bdate", AS_OF)


@query("Q19")
def q19(wh):
    return Q.standardisation_map(_b(wh, "erp_cust_az12"), "gen", C.map_gender)


@query("Q20")
def q20(wh):
    return Q.bad_pattern(_b(wh, "erp_px_cat_g1v2"), "id")


@query("Q21")
def q21(wh):
    b = C.drop_null_keys(_b(wh, "crm_cust_info"), "cst_id").select("cst_id").distinct()
    return Q.row_count_parity(b, _s(wh, "crm_cust_info"))


@query("Q22")
def q22(wh):
    return Q.is_populated(_s(wh, "crm_cust_info"))


@query("Q23")
def q23(wh):
    ci = _s(wh, "crm_cust_info").alias("ci")
    ca = merged(_s(wh, "erp_cust_az12")).alias("ca")
    la = merged(_s(wh, "erp_loc_a101")).alias("la")
    j = (ci.join(ca, same_text("ci.cst_key", "ca.cid"), "left")
           .join(la, same_text("ci.cst_key", "la.cid"), "left")
           .select(F.col("ci.cst_id").alias("cst_id")))
    return Q.join_fan_out(j, "cst_id")


@query("Q24")
def q24(wh):
    return Q.unmatched(_s(wh, "crm_prd_info"), "cat_id", _s(wh, "erp_px_cat_g1v2"), "id")


@query("Q25")
def q25(wh):
    return Q.fact_key_integrity(*_fcp(wh))


@query("Q26")
def q26(wh):
    s = _s(wh, "crm_sales_details")
    return Q.schema_mismatch(s.sparkSession, s, SILVER["crm_sales_details"],
                             MAX_LENGTH["silver"]["crm_sales_details"])


@query("Q27")
def q27(wh):
    return Q.distinct_pairs(_b(wh, "erp_px_cat_g1v2"), "cat", "subcat")


@query("Q28")
def q28(wh):
    return Q.master_merge_audit(_s(wh, "crm_cust_info"), _s(wh, "erp_cust_az12"),
                                _s(wh, "erp_loc_a101"))


@query("Q29")
def q29(wh):
    return Q.rows_per_value(wh.gold("dim_customers"), "gender")


@query("Q30")
def q30(wh):
    return Q.with_parent(_s(wh, "crm_sales_details"), "sls_prd_key", _s(wh, "crm_prd_info"),
                         "prd_key")


@query("Q31")
def q31(wh):
    b = _b(wh, "crm_prd_info").select("prd_id", "prd_key", "prd_cost", "prd_start_dt", "prd_end_dt")
    return Q.history_of(b, "prd_key", "prd_start_dt", "prd_id")


# ---------------------------------------------------------------- second instances
# (the same checks on the other tables of the layer check scripts)
@query("Q1_silver")
def q1s(wh):
    return Q.duplicate_or_null_key(_s(wh, "crm_cust_info"), "cst_id")


@query("Q3_silver")
def q3s(wh):
    return Q.untrimmed(_s(wh, "crm_cust_info"), CUST_TEXT)


@query("Q10_loc")
def q10l(wh):
    loc = _b(wh, "erp_loc_a101").select(C.strip_hyphen("cid").alias("cid"))
    return Q.orphans(loc, "cid", _s(wh, "erp_cust_az12"), "cid")


@query("Q11_loc")
def q11l(wh):
    return Q.not_in(_s(wh, "erp_loc_a101"), "cid", _s(wh, "erp_cust_az12"), "cid")


@query("Q13_bdate")
def q13b(wh):
    return Q.unparsable_dates(_b(wh, "erp_cust_az12"), "bdate", fmt=None)


@query("Q17_silver")
def q17s(wh):
    return Q.length_histogram(_s(wh, "erp_cust_az12"), "cid")


@query("Q21_sales")
def q21s(wh):
    return Q.row_count_parity(_b(wh, "crm_sales_details"), _s(wh, "crm_sales_details"))


@query("Q23_products")
def q23p(wh):
    prd, cat = _s(wh, "crm_prd_info"), _s(wh, "erp_px_cat_g1v2")
    pj = prd.where(F.col("prd_end_dt").isNull()).alias("pi") \
            .join(cat.alias("pc"), same_text("pi.cat_id", "pc.id"), "left") \
            .select(F.col("pi.prd_key").alias("prd_key"))
    return Q.join_fan_out(pj, "prd_key")


@query("Q4_allowed")
def q4a(wh):
    return Q.domain_values(_b(wh, "crm_cust_info"), "cst_gndr", ["M", "F"])


@query("Q11_null_list")
def q11n(wh):
    """Both flavours of NOT IN against a list that holds a NULL."""
    sales, cust = _s(wh, "crm_sales_details"), _b(wh, "crm_cust_info")

    def counted(flavour, skip_null):
        found = Q.not_in(sales, "sls_cust_id", cust, "cst_id", skip_null=skip_null)
        return found.agg(F.count(F.lit(1)).alias("found")).select(F.lit(flavour).alias("flavour"), "found")
    return counted("plain", False).unionByName(counted("NULLs skipped", True))


@query("Q12_empty")
def q12e(wh):
    prd = _s(wh, "crm_prd_info")
    return Q.if_parent_empty(_b(wh, "crm_prd_info"), prd.where(F.col("prd_cost") < 0))


@query("Q20_keys")
def q20k(wh):
    return Q.bad_pattern(_b(wh, "crm_cust_info"), "cst_key", r"^AW[0-9]{8}$")


@query("Q23_bronze")
def q23b(wh):
    ci, ca = _b(wh, "crm_cust_info").alias("ci"), _s(wh, "erp_cust_az12").alias("ca")
    j = ci.join(ca, same_text(F.trim("ci.cst_key"), "ca.cid"), "left").select(F.col("ci.cst_id").alias("cst_id"))
    return Q.join_fan_out(j, "cst_id")


@query("Q26_types")
def q26t(wh):
    """Bronze products held against the silver declaration."""
    b = _b(wh, "crm_prd_info")
    return Q.schema_mismatch(b.sparkSession, b, SILVER["crm_prd_info"], MAX_LENGTH["silver"]["crm_prd_info"])


@query("Q26_nulls")
def q26n(wh):
    """Bronze products held against a declaration that wants some columns without NULL."""
    b = _b(wh, "crm_prd_info")
    wanted = StructType([StructField(f.name, f.dataType, f.name not in ("prd_id", "prd_cost", "prd_line", "prd_end_dt"))
                         for f in BRONZE["crm_prd_info"].fields])
    return Q.schema_mismatch(b.sparkSession, b, wanted, MAX_LENGTH["bronze"]["crm_prd_info"])


# ---------------------------------------------------------------- the check lists of the layers
for _layer in ("bronze", "silver", "gold"):
    query(f"checks_{_layer}")(lambda wh, layer=_layer: run_layer_checks(wh, layer))


# ---------------------------------------------------------------- load services
@query("S3")
def s3(wh):
    """A failed second load leaves the first one visible."""
    layers = Layers(f"{wh.layers.root}/s3-{new_run_id()}")
    cats = C.with_load_time(C.load_categories(_b(wh, "erp_px_cat_g1v2")), LOAD_TIME)
    load_tables(wh.spark, layers, "silver", {"erp_px_cat_g1v2": lambda: cats})
    broken = {"erp_px_cat_g1v2": lambda: cats.limit(1),
              "erp_loc_a101": lambda: cats.select(F.raise_error(F.lit("a bad row")).alias("cid"))}
    load_tables(wh.spark, layers, "silver", broken, raise_errors=False)
    return layers.table(wh.spark, "silver", "erp_px_cat_g1v2")


@query("S4")
def s4(wh):
    """The stored audit of this refresh."""
    runs = [wh.runs[layer] for layer in ("bronze", "silver", "gold")]
    audit = wh.spark.read.parquet(wh.layers.audit_path)
    return audit.where(F.col("run_id").isin(runs)).select("layer", "table", "rows", "status")


def _report_views(wh):
    register_views(wh, reports={"report_customers": r1(wh), "report_products": r2(wh)})


@query("S6_customers")
def s6c(wh):
    _report_views(wh)
    return wh.spark.sql("SELECT * FROM gold_report_customers")


@query("S6_products")
def s6p(wh):
    _report_views(wh)
    return wh.spark.sql("SELECT * FROM gold_report_products")


@query("S9_tables")
def s9t(wh):
    return describe(wh, measured=True)[0]


@query("S9_columns")
def s9c(wh):
    return describe(wh, measured=True)[1]


# ---------------------------------------------------------------- display forms
@query("A5_display")
def a5_display(wh):
    return display("A5", a5(wh))


@query("A7_display")
def a7_display(wh):
    return display("A7", a7(wh))


def queries() -> dict[str, Query]:
    return dict(QUERIES)
