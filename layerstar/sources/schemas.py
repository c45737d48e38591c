"""The declared schema of every bronze and silver table.

Types follow the warehouse DDL with one change: the integer business keys
(cst_id, prd_id, sls_cust_id) are ``bigint`` because the input keys are.
``max_length`` holds the declared NVARCHAR lengths for the Q26 check.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I = T.StringType(), T.DateType(), T.LongType(), T.IntegerType()
MONEY = T.DecimalType(18, 2)
TS = T.TimestampNTZType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


BRONZE = {
    "crm_cust_info": _schema(
        ("cst_id", L), ("cst_key", S), ("cst_firstname", S), ("cst_lastname", S),
        ("cst_marital_status", S), ("cst_gndr", S), ("cst_create_date", D)),
    "crm_prd_info": _schema(
        ("prd_id", L), ("prd_key", S), ("prd_nm", S), ("prd_cost", S), ("prd_line", S),
        ("prd_start_dt", D), ("prd_end_dt", D)),
    "crm_sales_details": _schema(
        ("sls_ord_num", S), ("sls_prd_key", S), ("sls_cust_id", L), ("sls_order_dt", S),
        ("sls_ship_dt", S), ("sls_due_dt", S), ("sls_sales", S), ("sls_quantity", S),
        ("sls_price", S)),
    "erp_cust_az12": _schema(("cid", S), ("bdate", S), ("gen", S)),
    "erp_loc_a101": _schema(("cid", S), ("cntry", S)),
    "erp_px_cat_g1v2": _schema(("id", S), ("cat", S), ("subcat", S), ("maintenance", S)),
}

SILVER = {
    "crm_cust_info": _schema(
        ("cst_id", L), ("cst_key", S), ("cst_firstname", S), ("cst_lastname", S),
        ("cst_marital_status", S), ("cst_gndr", S), ("cst_create_date", D),
        ("dwh_create_dt", TS)),
    "crm_prd_info": _schema(
        ("prd_id", L), ("cat_id", S), ("prd_key", S), ("prd_nm", S), ("prd_cost", MONEY),
        ("prd_line", S), ("prd_start_dt", D), ("prd_end_dt", D), ("dwh_create_dt", TS)),
    "crm_sales_details": _schema(
        ("sls_ord_num", S), ("sls_prd_key", S), ("sls_cust_id", L), ("sls_order_dt", D),
        ("sls_ship_dt", D), ("sls_due_dt", D), ("sls_sales", MONEY), ("sls_quantity", I),
        ("sls_price", MONEY), ("dwh_create_dt", TS)),
    "erp_cust_az12": _schema(("cid", S), ("bdate", D), ("gen", S), ("dwh_create_dt", TS)),
    "erp_loc_a101": _schema(("cid", S), ("cntry", S), ("dwh_create_dt", TS)),
    "erp_px_cat_g1v2": _schema(
        ("id", S), ("cat", S), ("subcat", S), ("maintenance", S), ("dwh_create_dt", TS)),
}

# Declared NVARCHAR lengths (fixed values of the warehouse DDL).
MAX_LENGTH = {
    "bronze": {
        "crm_cust_info": {"cst_key": 50, "cst_firstname": 50, "cst_lastname": 50,
                          "cst_marital_status": 50, "cst_gndr": 50},
        "crm_prd_info": {"prd_key": 100, "prd_nm": 255, "prd_cost": 50, "prd_line": 10},
        "crm_sales_details": {"sls_ord_num": 50, "sls_prd_key": 100, "sls_order_dt": 20,
                              "sls_ship_dt": 20, "sls_due_dt": 20, "sls_sales": 50,
                              "sls_quantity": 50, "sls_price": 50},
        "erp_cust_az12": {"cid": 50, "bdate": 20, "gen": 10},
        "erp_loc_a101": {"cid": 50, "cntry": 50},
        "erp_px_cat_g1v2": {"id": 50, "cat": 50, "subcat": 100, "maintenance": 10},
    },
    "silver": {
        "crm_cust_info": {"cst_key": 50, "cst_firstname": 50, "cst_lastname": 50,
                          "cst_marital_status": 20, "cst_gndr": 10},
        "crm_prd_info": {"cat_id": 50, "prd_key": 50, "prd_nm": 100, "prd_line": 50},
        "crm_sales_details": {"sls_ord_num": 50, "sls_prd_key": 50},
        "erp_cust_az12": {"cid": 50, "gen": 10},
        "erp_loc_a101": {"cid": 50, "cntry": 50},
        "erp_px_cat_g1v2": {"id": 50, "cat": 50, "subcat": 100, "maintenance": 10},
    },
}

SCHEMAS = {"bronze": BRONZE, "silver": SILVER}

TABLES = list(BRONZE)
