"""Golden values: a small fixture with every kind of dirt of the real files, and
the two public files themselves where they are at hand (SURVEY §5.2)."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from conftest import REF_DATASETS
from pyspark.sql import functions as F

from layerstar.operators import quality as Q
from layerstar.plans import analyse as A
from layerstar.plans import explore as E
from layerstar.plans import gold as G
from layerstar.plans.silver import load_prd_info, load_px_cat
from layerstar.sources.io import read_csv
from layerstar.sources.schemas import BRONZE

HERE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
LOADED = dt.datetime(2001, 9, 1)


@pytest.fixture(scope="module")
def prd(spark):
    return read_csv(spark, f"{HERE}/prd_info.csv", BRONZE["crm_prd_info"]).cache()


@pytest.fixture(scope="module")
def cat(spark):
    return read_csv(spark, f"{HERE}/px_cat.csv", BRONZE["erp_px_cat_g1v2"]).cache()


@pytest.fixture(scope="module")
def silver_prd(prd):
    return load_prd_info(prd, LOADED).cache()


def test_fixture_bronze(prd, cat):
    assert prd.count() == 12 and cat.count() == 6
    assert prd.where("prd_cost IS NULL").count() == 1 and prd.where("prd_nm = ' Mountain Pedal '").count() == 1
    assert {r.prd_line for r in prd.collect()} == {"R ", "M ", "S ", "T ", "t", None}
    assert {r.maintenance for r in cat.collect()} == {"Yes", "No"}          # the line ends are CR LF
    assert sorted(r.prd_id for r in Q.reversed_range(prd, "prd_start_dt", "prd_end_dt").collect()) == [11, 12, 31, 51]
    assert Q.bad_pattern(cat, "id").count() == 0


def test_fixture_silver(silver_prd):
    rows = {r.prd_id: r for r in silver_prd.collect()}
    assert len(rows) == 11
    day = dt.date
    ends = {i: r.prd_end_dt for i, r in rows.items() if r.prd_end_dt}
    # 31 and 32, 51 and 52 share key and start: the lower id closes the day before that start
    assert ends == {11: day(2012, 6, 30), 12: day(2013, 6, 30), 31: day(2011, 6, 30), 32: day(2013, 6, 30), 51: day(2012, 6, 30)}
    assert {i: r.prd_cost for i, r in rows.items() if i in (21, 22, 41)} == {21: Decimal("0.00"), 22: Decimal("18.00"), 41: Decimal("4.00")}
    assert {i: r.prd_line for i, r in rows.items()} == {
        11: "Road", 12: "Road", 13: "Road", 21: "Mountain", 22: "Road", 31: "Other sales", 32: "Other sales", 33: "Other sales",
        41: "Unknown", 51: "Touring", 52: "Touring"}
    assert (rows[21].cat_id, rows[21].prd_key, rows[21].prd_nm) == ("CO_PD", "PD_M282", "Mountain Pedal")


def test_fixture_dimension(spark, silver_prd, cat):
    dim = G.dim_products(silver_prd, load_px_cat(cat))
    assert [(r.product_key, r.product_id, r.category) for r in dim.orderBy("product_key").collect()] == [
        (1, 52, "Clothing"), (2, 13, "Bikes"), (3, 21, "Components"), (4, 22, None), (5, 33, "Accessories"), (6, 41, "Accessories")]
    assert {r.cat_id for r in Q.unmatched(silver_prd, "cat_id", cat, "id").collect()} == {"CO_PE"}
    assert {r.id for r in Q.orphans(cat, "id", silver_prd, "cat_id").collect()} == {"CO_XX"}
    sales = spark.createDataFrame([(f"SO{i}", k) for i, k in enumerate(["SO_B909", "HL_U509", "HL_U509", "none"])],
                                  "sls_ord_num string, sls_prd_key string")
    sales = sales.selectExpr("*", "1L AS sls_cust_id", "DATE'2013-01-01' AS sls_order_dt", "DATE'2013-01-02' AS sls_ship_dt",
                             "DATE'2013-01-03' AS sls_due_dt", "1.00 AS sls_sales", "1 AS sls_quantity", "1.00 AS sls_price")
    nobody = spark.createDataFrame([], "customer_id long, customer_key long")
    fact = G.fact_sales(sales, nobody, dim)
    assert sorted((r.order_number, r.product_key) for r in fact.collect()) == [("SO0", 1), ("SO1", 5), ("SO2", 5), ("SO3", None)]


if os.path.isdir(REF_DATASETS):
    @pytest.fixture(scope="module")
    def public_prd(spark):
        return read_csv(spark, f"{REF_DATASETS}/prd_info.csv", BRONZE["crm_prd_info"]).cache()


    @pytest.fixture(scope="module")
    def public_cat(spark):
        return read_csv(spark, f"{REF_DATASETS}/PX_CAT_G1V2.csv", BRONZE["erp_px_cat_g1v2"]).cache()


    @pytest.fixture(scope="module")
    def public_silver(public_prd):
        return load_prd_info(public_prd, dt.datetime(2001, 9, 1)).cache()


    @pytest.fixture(scope="module")
    def public_dim(public_silver, public_cat):
        return G.dim_products(public_silver, load_px_cat(public_cat)).cache()


    def test_public_products(public_prd):
        assert public_prd.count() == 397
        assert public_prd.select("prd_key").distinct().count() == 295
        per_key = {r["count"]: r["n"] for r in public_prd.groupBy("prd_key").count()
                   .groupBy("count").agg(F.count(F.lit(1)).alias("n")).collect()}
        assert per_key == {1: 218, 2: 52, 3: 25}
        assert public_prd.where(F.col("prd_cost").isNull()).count() == 2
        lines = {r.prd_line: r["count"] for r in public_prd.groupBy("prd_line").count().collect()}
        assert lines == {"R ": 162, "M ": 112, "S ": 54, "T ": 52, None: 17}
        assert Q.reversed_range(public_prd, "prd_start_dt", "prd_end_dt").count() == 200


    def test_public_categories_crlf(public_cat):
        assert public_cat.count() == 37
        assert public_cat.select("id").distinct().count() == 37
        assert {r.maintenance for r in public_cat.collect()} == {"Yes", "No"}
        assert Q.bad_pattern(public_cat, "id").count() == 0


    def test_public_silver(public_silver):
        assert public_silver.count() == 397
        ends = {r.prd_end_dt: r["count"] for r in public_silver.groupBy("prd_end_dt").count().collect()}
        assert ends == {None: 295, dt.date(2012, 6, 30): 43, dt.date(2013, 6, 30): 59}
        lines = {r.prd_line: r["count"] for r in public_silver.groupBy("prd_line").count().collect()}
        assert lines == {"Road": 162, "Mountain": 112, "Other sales": 54, "Touring": 52, "Unknown": 17}
        assert Q.null_or_negative(public_silver, "prd_cost").count() == 0
        assert Q.reversed_range(public_silver, "prd_start_dt", "prd_end_dt").count() == 0


    def test_public_dimension(public_dim, public_silver, public_cat):
        assert public_dim.count() == 295
        assert public_dim.select("product_number").distinct().count() == 295
        first = [r.product_id for r in public_dim.where("product_key <= 3").orderBy("product_key").collect()]
        assert first == [210, 211, 218]
        missing = Q.unmatched(public_silver.where("prd_end_dt IS NULL"), "cat_id", public_cat, "id")
        assert missing.count() == 7 and {r.cat_id for r in missing.collect()} == {"CO_PE"}
        unused = Q.orphans(public_cat, "id", public_silver, "cat_id")
        assert [r.id for r in unused.collect()] == ["CO_PD"]


    def test_public_exploration(public_dim):
        by_cat = {r.category: r.total_products for r in E.products_by_category(public_dim).collect()}
        assert by_cat == {"Components": 127, "Bikes": 97, "Clothing": 35, "Accessories": 29, None: 7}
        cost = {r.category: r.avg_cost for r in E.cost_by_category(public_dim).collect()}
        assert cost == {"Bikes": Decimal("949.4433"), "Components": Decimal("264.7165"),
                        None: Decimal("28.5714"), "Clothing": Decimal("24.8000"),
                        "Accessories": Decimal("13.1724")}
        ranges = {r.cost_range: r.total_products for r in A.products_by_cost_range(public_dim).collect()}
        assert ranges == {"Below 100": 110, "100-500": 101, "500-1000": 45, "Above 1000": 39}


    def test_public_history(public_prd):
        h = Q.history_of(public_prd, "prd_key", "prd_start_dt", "prd_id", value="AC-HE-HL-U509-B")
        rows = sorted((r.prd_start_dt, r.derived_prd_end_dt) for r in h.collect())
        assert len(rows) == 3 and rows[-1][1] is None
        assert rows[0][1] == rows[1][0] - dt.timedelta(days=1)
        ids = spark_ids = sorted(r.prd_id for r in public_prd.where("prd_key = 'AC-HE-HL-U509-B'").collect())
        assert ids == spark_ids == [220, 221, 222]
