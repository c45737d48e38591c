"""Roll-ups of the fact: the same answers as from the fact, and read instead of it where they suffice."""

import datetime as dt
import os
import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from layerstar.plans import analyse as A
from layerstar.plans import explore as E
from layerstar.plans import rollup as U

FACT = ("order_number string, product_key long, customer_key long, order_date date, sales_amount decimal(18,2), "
        "quantity int, price decimal(18,2)")
DAY = dt.date(2020, 1, 31)
#: NULL keys, dates and amounts, repeated rows, keys on both sides of a bitmap's end, a year without customers.
ROWS = [("a", 1, 1, DAY, D("10.10"), 1, D("10.10")), ("a", 1, 1, DAY, D("10.10"), 1, D("10.10")),
        ("b", 2, 32768, dt.date(2020, 2, 1), None, None, None), ("c", 2, 32769, dt.date(2021, 2, 1), D("3"), 2, D("1.5")),
        ("d", None, None, None, D("5"), 5, D("1")), ("e", 3, 1, None, D("-2"), 0, None),
        ("f", 32769, 65536, dt.date(2021, 12, 31), D("0.01"), 1, D("0.01")), ("g", 1, None, dt.date(2022, 5, 5), D("7"), 1, D("7"))]


@pytest.fixture(params=["rows", "empty"])
def fact(spark, request):
    return spark.createDataFrame(ROWS if request.param == "rows" else [], FACT)


def rolled(f):
    return U.Rollups(U.by_product(f), U.by_customer(f), U.key_bits(f, "customer_key"), U.key_bits(f, "product_key"))


def test_same_answers_as_the_fact(spark, fact):
    r = rolled(fact)
    p = spark.createDataFrame([(1, "Bike", "Bikes"), (2, "bike ", "Bikes"), (3, "Cap", None)],
                              "product_key long, product_name string, category string")
    c = spark.createDataFrame([(1, "Ann", "Lee", "Peru"), (32768, "Bo", None, "peru")],
                              "customer_key long, firstname string, lastname string, country string")
    pairs = {
        "E3": (E.order_date_range(fact), E.order_date_range(r.by_customer)),
        "E5": (E.total_sales(fact), E.total_sales(r.by_product)),
        "E6": (E.total_quantity(fact), E.total_quantity(r.by_product)),
        "E7": (E.average_price(fact), E.average_price(r.by_product)),
        "E9": (E.product_counts(fact, p), E.product_counts(fact, p, r.product_bits)),
        "E10": (E.customer_counts(fact, c), E.customer_counts(fact, c, r.customer_bits)),
        "E11": (E.key_metrics(fact, c, p), E.key_metrics(fact, c, p, r)),
        "E16": (E.revenue_by_category(fact, p), E.revenue_by_category(r.by_product, p)),
        "E17": (E.revenue_by_customer(fact, c), E.revenue_by_customer(r.by_customer, c)),
        "E18": (E.items_by_country(fact, c), E.items_by_country(r.by_customer, c)),
        "E19": (E.top_products(fact, p), E.top_products(r.by_product, p)),
        "E20": (E.bottom_products(fact, p), E.bottom_products(r.by_product, p)),
        "A1": (A.sales_by_year(fact), A.sales_by_year(r.by_product, r.customer_bits)),
        "A2": (A.sales_by_month(fact), A.sales_by_month(r.by_product, r.customer_bits)),
        "A3": (A.running_sales(fact), A.running_sales(r.by_product)),
        "A4": (A.cumulative_price(fact), A.cumulative_price(r.by_product)),
        "A5": (A.product_yoy(fact, p), A.product_yoy(r.by_product, p)),
        "A6": (A.product_vs_average(fact, p), A.product_vs_average(r.by_product, p)),
        "A7": (A.category_share(fact, p), A.category_share(r.by_product, p)),
        "A9": (A.customers_by_segment(fact, 1, 5), A.customers_by_segment(r.by_customer, 1, 5)),
    }
    for name, (plain, from_rollup) in pairs.items():
        assert plain.columns == from_rollup.columns, name
        assert [f.dataType for f in plain.schema] == [f.dataType for f in from_rollup.schema], name
        assert sorted(map(str, plain.collect())) == sorted(map(str, from_rollup.collect())), name


def test_bits_hold_each_key_once(spark):
    f = spark.createDataFrame(ROWS, FACT)
    bits = U.key_bits(f, "customer_key").withColumn("n", F.bitmap_count("bits"))
    assert {(r.order_month, r.bucket): r.n for r in bits.collect()} == {
        (dt.date(2020, 1, 1), 1): 1, (dt.date(2020, 2, 1), 1): 1, (dt.date(2021, 2, 1), 2): 1,
        (None, 1): 1, (dt.date(2021, 12, 1), 2): 1}
    assert U.distinct_keys(bits).first().n == 4


def executed(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")      # whole paths
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_building_bits_shuffles_no_bitmap(spark):
    plan = executed(U.key_bits(spark.createDataFrame(ROWS * 50, FACT), "customer_key")).split("Initial Plan")[0]
    build = plan.index("bitmap_construct_agg")
    assert "Exchange" not in plan[:build]                        # the aggregates stand above both exchanges
    assert len(re.findall(r"Exchange hashpartitioning\(", plan)) == 2


needs_tables = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not available")


@needs_tables
def test_registered_queries_read_the_rollup_or_only_order_numbers(spark):
    from layerstar.plans.catalog import queries
    from layerstar.plans.warehouse import warehouse_for
    wh = warehouse_for(spark, SF_SMALL)
    assert wh.rollups() is not None
    for name in ("E9", "E10", "E16", "E17", "E18", "E19", "E20", "A1", "A2", "A3", "A4", "A5", "A6", "A7", "A9"):
        df = queries()[name](spark, SF_SMALL)
        plan = executed(df)
        assert "order_number" not in plan and "/fact_sales" not in plan and "/rollups/gold" in plan, name
        assert not any("/fact_sales/" in p for p in df.inputFiles()) and "Expand" not in plan, name
    plan = executed(queries()["E11"](spark, SF_SMALL))          # the fact for its order numbers alone
    assert "struct<order_number:string>" in plan and "Expand" not in plan
    assert all("order_number" not in s for s in re.findall(r"ReadSchema: (\S+)", plan) if s != "struct<order_number:string>")
    for name in ("E8", "R1", "R2"):                              # order numbers: the roll-ups do not suffice
        assert "order_number" in executed(queries()[name](spark, SF_SMALL)), name


@needs_tables
def test_rollups_belong_to_one_gold_run(spark, tmp_path):
    from layerstar.plans.warehouse import Warehouse, load_rollups, warehouse_for
    from layerstar.sources.io import Layers, load_tables
    wh = warehouse_for(spark, SF_SMALL)
    assert sum(r.lines for r in wh.rollups().by_product.collect()) == wh.gold("fact_sales").count()
    small = Warehouse(spark, Layers(str(tmp_path)))
    facts = [wh.gold("fact_sales").limit(100), wh.gold("fact_sales").limit(10)]
    runs = []
    for f, with_rollups in ((facts[0], True), (facts[1], False)):
        run, _ = load_tables(spark, small.layers, "gold", {"fact_sales": lambda f=f: f})
        runs.append(run)
        if with_rollups:
            load_rollups(small)
    assert small.rollups() is None                               # the newer gold run has none
    small.runs["gold"] = runs[0]
    assert sum(r.lines for r in small.rollups().by_customer.collect()) == 100
