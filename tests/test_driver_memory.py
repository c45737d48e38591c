"""Sides of a join that grow with the data are never collected by the driver, however small their files."""

import datetime as dt
from types import SimpleNamespace

import pytest

from layerstar.operators import quality as Q
from layerstar.operators.rows import derive_end_date
from layerstar.plans import analyse as A
from layerstar.plans import catalog
from layerstar.plans import gold as G
from layerstar.plans import reports as R
from layerstar.sources.extracts import crm_sales_details

DAY = dt.date(2000, 1, 1)


@pytest.fixture
def stored(spark, tmp_path):
    """Rows as a table in files, which the planner weighs by their bytes."""
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))
    return put


def rows_without_broadcast(df):
    got = sorted(map(tuple, df.collect()), key=str)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    return got


def customers(stored):
    return {"crm_cust_info": stored("cust", [(1, "A1", "x", "y", "Single", "Male", DAY), (2, "A2 ", "x", "y", "Single", "Unknown", DAY),
                                             (3, None, "x", "y", "Single", "Unknown", None)],
                                    "cst_id long, cst_key string, cst_firstname string, cst_lastname string, "
                                    "cst_marital_status string, cst_gndr string, cst_create_date date"),
            "erp_cust_az12": stored("az", [("a1", DAY, "Male"), ("A2", None, "Female"), ("A2", DAY, "Male"), (None, DAY, "Male")],
                                    "cid string, bdate date, gen string"),
            "erp_loc_a101": stored("loc", [("A1", "Peru"), ("a2", None), ("A9", "Chad"), (None, "Oman")], "cid string, cntry string")}


def products(stored):
    return stored("products", [(1, "P1", "Bike", "c", "s", 5), (2, "p_2", "bike ", "c", "s", None), (3, None, None, None, None, 1)],
                  "product_key long, product_number string, product_name string, category string, subcategory string, cost int")


def facts(stored):
    return stored("facts", [("SO1", 1, 1, DAY, 10, 1), ("SO1", 2, 1, DAY, 20, 2), ("SO2", 1, None, dt.date(2001, 2, 1), 30, 3),
                            ("SO3", None, 2, DAY, 5, 1), ("SO4", 9, 2, DAY, None, 1), ("SO5", 1, 1, None, 7, 1)],
                  "order_number string, product_key long, customer_key long, order_date date, amount int, quantity int") \
        .selectExpr("* except (amount)", "cast(amount as decimal(18,2)) as sales_amount", "cast(1 as decimal(18,2)) as price")


def test_refresh_joins_orders_keys_and_dates_without_a_broadcast(spark, stored):
    lines = stored("lines", [(1, 7, 1, 2.0, 10.0, dt.datetime(2000, 1, 5)), (1, 8, 2, 1.0, 5.0, dt.datetime(2000, 1, 6)),
                             (2, 7, 1, 1.0, 4.0, dt.datetime(2000, 1, 7))],
                   "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp")
    orders = stored("orders", [(1, 5, dt.datetime(2000, 1, 1)), (3, 6, dt.datetime(2000, 1, 2))],
                    "o_orderkey long, o_custkey long, o_orderdate timestamp")
    got = rows_without_broadcast(crm_sales_details(lines, orders).select("sls_ord_num", "sls_prd_key", "sls_cust_id", "sls_order_dt"))
    assert got == [("SO1", " PK-8 ", "5", "20000101"), ("SO1", "PK-7", "5", "20000101"), ("SO2", " PK-7 ", None, None)]

    prd = stored("prd", [(1, "k", DAY), (2, "K ", dt.date(2001, 1, 1)), (3, None, None), (4, "k", DAY)],
                 "prd_id long, prd_key string, prd_start_dt date")
    ends = {r[0]: r[-1] for r in rows_without_broadcast(derive_end_date(prd, "prd_key", "prd_start_dt"))}
    assert ends == {1: dt.date(1999, 12, 31), 2: None, 3: None, 4: dt.date(2000, 12, 31)}

    c = customers(stored)
    joined = G.customers_joined(*c.values()).select("customer_id", "country", "gender", "birthdate")
    assert rows_without_broadcast(joined) == [(1, "Peru", "Male", DAY), (2, None, "Female", None), (2, None, "Male", DAY),
                                              (3, None, "Unknown", None)]

    sales = stored("sales", [("SO1", "P1", 1), ("SO2", "P_2 ", 4), ("SO3", None, None), ("SO4", "zz", 1)],
                   "sls_ord_num string, sls_prd_key string, sls_cust_id long") \
        .selectExpr("*", "date'2000-01-01' as sls_order_dt", "date'2000-01-02' as sls_ship_dt", "date'2000-01-03' as sls_due_dt",
                    "1 as sls_sales", "1 as sls_quantity", "1 as sls_price")
    dim = stored("dim", [(11, 1), (12, None)], "customer_key long, customer_id long")
    fact = G.fact_sales(sales, dim, products(stored)).select("order_number", "product_key", "customer_key")
    assert rows_without_broadcast(fact) == [("SO1", 1, 11), ("SO2", 2, None), ("SO3", None, None), ("SO4", None, 11)]


def test_fan_out_of_the_customer_joins(stored):
    c = customers(stored)
    assert rows_without_broadcast(catalog.q23(SimpleNamespace(silver=c.get))) == [(2, 2)]


def test_orphans(stored):
    c = customers(stored)
    assert rows_without_broadcast(Q.orphans(c["erp_loc_a101"], "cid", c["erp_cust_az12"], "cid")) == [("A9", "Chad"), (None, "Oman")]


def test_products_by_year(stored):
    years = A.product_yoy(facts(stored), products(stored)).selectExpr("order_year", "product", "int(sales)", "int(prev_sales)")
    want = [(2000, "Bike", 30, 7), (2000, None, 5, None), (2001, "Bike", 30, 30), (None, "Bike", 7, None)]
    assert rows_without_broadcast(years) == sorted(want, key=str)


def test_product_report(stored):
    rep = R.report_products(facts(stored), products(stored), DAY, keys_from_dim=True)
    got = {r.product_key: (r.product_name, r.total_orders, r.total_customers) for r in rep.collect()}
    assert got == {1: ("Bike", 2, 1), 2: ("bike ", 1, 1), None: (None, 1, 1), 9: (None, 1, 1)}
    rows_without_broadcast(rep)
