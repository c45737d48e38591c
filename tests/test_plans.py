"""Plan properties that matter at scale, read from the executed physical plans."""

import os
import re

import pytest

from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not available")


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def qs(spark):
    from layerstar.plans.catalog import queries
    from layerstar.plans.warehouse import warehouse_for
    warehouse_for(spark, SF_SMALL)
    return queries()


def test_no_cartesian_or_nested_loop_anywhere(spark, qs):
    bad = {}
    for name, q in qs.items():
        plan = executed(q(spark, SF_SMALL))
        hits = re.findall(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
        if hits:
            bad[name] = hits
    assert not bad, bad


def test_fact_scan_is_pruned(spark, qs):
    plan = executed(qs["E5"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas == ["struct<sales_amount:decimal(18,2)>"], schemas


def test_filters_reach_the_scan(spark, qs):
    plan = executed(qs["R2"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(order_date)]" in plan
    plan = executed(qs["G3"](spark, SF_SMALL))
    assert "IsNull(prd_end_dt)" in plan


def test_whole_table_totals_are_subqueries_not_windows(spark, qs):
    for name in ("A7", "R2", "T14"):
        plan = executed(qs[name](spark, SF_SMALL))
        assert "Subquery" in plan or "subquery" in plan, name
        # no window over the whole input (an unpartitioned window with no order)
        assert not re.search(r"Window \[[^\]]*windowspecdefinition\(specifiedwindowframe", plan), name


def test_newest_row_per_key_is_an_aggregate(spark, qs):
    plan = executed(qs["T3"](spark, SF_SMALL))
    assert "Window" not in plan
    assert plan.count("Aggregate") >= 2          # partial (map side) + final


def test_refresh_plans_have_no_cartesian(spark, qs):
    from layerstar.plans import gold as G
    from layerstar.plans.silver import silver_steps
    from layerstar.plans.warehouse import LOAD_TIME, warehouse_for
    wh = warehouse_for(spark, SF_SMALL)
    builds = dict(silver_steps(wh.layer("bronze"), wh.as_of, LOAD_TIME))
    builds["numbering"] = lambda: G.dim_customers(wh.silver("crm_cust_info"), wh.silver("erp_cust_az12"),
                                                  wh.silver("erp_loc_a101"))
    builds["fact"] = lambda: G.fact_sales(wh.silver("crm_sales_details"), wh.gold("dim_customers"),
                                          wh.gold("dim_products"))
    for name, b in builds.items():
        plan = executed(b())
        assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan), name


def test_numbering_plan_has_no_single_partition_of_rows(spark):
    from pyspark.sql import functions as F
    from layerstar.operators.rows import surrogate_key
    df = spark.range(0, 5000).withColumn("x", F.col("id") % 3)
    plan = executed(surrogate_key(df, ["x", "id"], "k"))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    # one row per stored range meets in one task; the rows themselves never do
    single = re.findall(r"Exchange SinglePartition.*\n.*", plan)
    assert all("__part" in s and "count(1)" in s for s in single), single
    assert re.search(r"Exchange hashpartitioning\(__part", plan)


def test_category_share_reads_the_fact_once(spark, qs):
    df = qs["A7"](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final       # the total over the groups shares the fact's exchange


def test_pre_aggregation_shuffles_the_fact_once_without_broadcast(spark, qs):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        plan = executed(qs["E16"](spark, SF_SMALL))
        assert "SortMergeJoin" in plan
        # the fact side: partial sum -> one exchange on product_key -> final sum -> join
        assert len(re.findall(r"Exchange hashpartitioning\(product_key", plan)) == 1
        assert re.search(r"partial_sum\(sales_amount(#\d+)?\)", plan)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_checks_scan_each_table_once_for_all_row_filters(spark, qs):
    """checks_silver: the row filters and declared lengths of a table are one aggregate over one scan."""
    from layerstar.operators import quality as Q
    from layerstar.plans.checks import checks_for
    from layerstar.plans.warehouse import warehouse_for
    wh = warehouse_for(spark, SF_SMALL)
    for layer in ("bronze", "silver"):
        measured = [c for c in checks_for(wh, layer) if c.measure is not None]
        scans = {c.scan for c in measured}
        plan = executed(Q.run_checks(spark, measured))
        assert len(measured) > 12 and plan.count("FileScan parquet") == len(scans) <= 7


def test_row_checks_come_from_the_load_without_a_scan(spark, qs):
    """The counts taken on the load's write equal those of a scan, and reading them scans no table of a layer."""
    from layerstar.operators import quality as Q
    from layerstar.plans.checks import checks_for
    from layerstar.plans.warehouse import warehouse_for
    wh = warehouse_for(spark, SF_SMALL)
    for layer in ("bronze", "silver", "gold"):
        rows = [c for c in checks_for(wh, layer) if c.measure is not None]
        taken = Q.run_checks(spark, rows, measured=wh.measured())
        plan = executed(taken)
        assert set(re.findall(r"ReadSchema: (\S+)", plan)) <= {"struct<scan:string,check:string,found:bigint>"}
        assert plan.count("FileScan parquet") == (2 if rows else 0)
        assert sorted(taken.collect()) == sorted(Q.run_checks(spark, rows).collect())
        assert len({(c.scan, c.name) for c in rows}) == len(rows) and (len(rows) > 12 or layer == "gold")
        # a check that the load did not measure is scanned, and so is one with sample rows
        some = wh.measured().where("check not like 'Q3%'")
        assert sorted(Q.run_checks(spark, rows, measured=some).collect()) == sorted(taken.collect())
        shown = Q.run_checks(spark, rows, samples=True, measured=wh.measured())
        assert sorted(shown.drop("sample").collect()) == sorted(taken.collect())


def test_a_load_stores_what_it_measures_with_its_run(spark, tmp_path):
    from pyspark.sql import functions as F

    from layerstar.sources.io import Layers, load_tables, measured
    layers = Layers(str(tmp_path))
    steps = {"a": lambda: spark.range(10), "b": lambda: spark.range(0)}
    asked = lambda table, df: {"big": F.count_if(F.col("id") > 6), "most": F.max("id")}
    run, _ = load_tables(spark, layers, "bronze", steps, measures=asked)
    assert {(r.scan, r.check): r.found for r in measured(spark, layers, "bronze", run).collect()} == {
        ("bronze.a", "big"): 3, ("bronze.a", "most"): 9, ("bronze.b", "big"): 0, ("bronze.b", "most"): None}
    run, _ = load_tables(spark, layers, "bronze", steps)
    assert measured(spark, layers, "bronze") is None
