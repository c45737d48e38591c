"""M4: text keys and groups that differ in case or trailing spaces are equal."""

import datetime as dt
import re

from pyspark.sql import functions as F

from layerstar.functions.text import COLLATION, folded, same_text
from layerstar.operators import quality as Q
from layerstar.operators.rows import derive_end_date, group_text
from layerstar.plans import analyse as A
from layerstar.plans import explore as E
from layerstar.plans import gold as G

TEXTS = ["a", "A", "a ", " a", "A  ", "", " ", None, "Straße", "STRASSE", "É", "é ", "É\t", "e", "ä", "Ä", "a ", "ΑΣ", "ας"]


def test_folded_text_is_what_the_collation_calls_equal(spark):
    df = spark.createDataFrame([(x, y) for x in TEXTS for y in TEXTS], "x string, y string")
    got = df.select("x", "y", (F.collate("x", COLLATION) == F.collate("y", COLLATION)).alias("c"), same_text("x", "y").alias("f"))
    wrong = [(r.x, r.y) for r in got.collect() if r.c != r.f and "Σ" not in f"{r.x}{r.y}" and "ς" not in f"{r.x}{r.y}"]
    assert wrong == []


def test_groups_show_their_least_spelling(spark):
    df = spark.createDataFrame([("germany ", 1), ("Germany", 2), ("GERMANY", 3), (None, 4), (None, 5), ("France", 6), (" France", 7)],
                               "country string, customer_key long")
    got = {tuple(r) for r in E.customers_by_country(df).collect()}
    assert got == {("GERMANY", 3), (None, 2), ("France", 1), (" France", 1)}
    assert {r.country for r in E.distinct_countries(df).collect()} == {"GERMANY", None, "France", " France"}
    assert group_text(df.where("customer_key < 0"), ["country"], n=F.count("customer_key")).collect() == []


def test_dimension_joins_and_keys(spark):
    cust = spark.createDataFrame([(1, "AW1", "a", "b", "Single", "Unknown", dt.date(2020, 1, 1))],
                                 "cst_id long, cst_key string, cst_firstname string, cst_lastname string, "
                                 "cst_marital_status string, cst_gndr string, cst_create_date date")
    az = spark.createDataFrame([("aw1 ", dt.date(1980, 1, 1), "Male")], "cid string, bdate date, gen string")
    loc = spark.createDataFrame([("Aw1", "France")], "cid string, cntry string")
    (row,) = G.customers_joined(cust, az, loc).collect()
    assert (row.customer_number, row.country, row.gender) == ("AW1", "France", "Male")
    child = spark.createDataFrame([("pk_1 ",), ("PK_2",), (None,), ("PK_3",)], "k string")
    parent = spark.createDataFrame([("PK_1",), ("pk_2",)], "k string")
    assert [r.k for r in Q.with_parent(child, "k", parent, "k").orderBy("k").collect()] == ["PK_2", "pk_1 "]
    assert {r.k for r in Q.orphans(child, "k", parent, "k").collect()} == {None, "PK_3"}
    assert {r.k for r in Q.not_in(child, "k", parent, "k").collect()} == {"PK_3"}
    dup = spark.createDataFrame([("x",), ("X ",), ("y",), (None,)], "k string")
    assert {tuple(r) for r in Q.duplicate_or_null_key(dup, "k").collect()} == {("X ", 2), (None, 1)}
    assert {r.k for r in Q.rows_with_bad_key(dup, "k").collect()} == {"x", "X ", None}
    assert {r.k for r in Q.domain_values(dup, "k", ["X"]).collect()} == {"y", None}


def test_history_and_trends_follow_the_folded_key(spark):
    rows = [(1, "pk-1", dt.date(2011, 7, 1)), (2, "PK-1 ", dt.date(2012, 7, 1)), (3, "PK-2", dt.date(2011, 7, 1))]
    df = spark.createDataFrame(rows, "prd_id long, prd_key string, prd_start_dt date")
    ends = {r.prd_id: r.prd_end_dt for r in derive_end_date(df, "prd_key", "prd_start_dt").collect()}
    assert ends == {1: dt.date(2012, 6, 30), 2: None, 3: None}
    f = spark.createDataFrame([(1, dt.date(2011, 1, 1), 10), (2, dt.date(2012, 1, 1), 30)],
                              "product_key long, order_date date, sales_amount long") \
             .withColumn("sales_amount", F.col("sales_amount").cast("decimal(18,2)"))
    p = spark.createDataFrame([(1, "Bike"), (2, "bike ")], "product_key long, product_name string")
    got = {r.order_year: r.prev_sales for r in A.product_yoy(f, p).collect()}
    assert got[2011] is None and got[2012] == 10


def test_no_nested_loops_and_broadcasts_stay_possible(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50).select(F.format_string("K%d", "id").alias("k")).write.parquet(path)
    a = spark.read.parquet(path)
    plan = a.join(a.select(F.upper("k").alias("j")), same_text("k", "j"), "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and not re.search("NestedLoop|Cartesian", plan)
    groups = a.groupBy(folded("k")).count()._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in groups and "SortAggregate" not in groups


# ------------------------------------------------------- checks over keys
def _one(spark, check):
    (row,) = Q.run_checks(spark, [check], samples=True).collect()
    return row.found, row.sample


def test_key_checks_equal_their_operators(spark):
    child = spark.createDataFrame([("a",), ("A ",), ("b",), ("c",), ("c",), (None,), (None,)], "k string")
    parents = {"some": ["a", "B"], "null": ["a", None], "none": [], "only null": [None]}
    c = Q.side("bronze.child", child, "k")
    head = ("x", ["bronze"], "child", "report", "e")
    assert _one(spark, Q.key_check(*head, c, Q.REPEATS_OR_NULL))[0] == Q.duplicate_or_null_key(child, "k").count() == 3
    assert _one(spark, Q.key_check(*head, c, Q.REPEATS_OR_NULL, rows=True))[0] == Q.rows_with_bad_key(child, "k").count() == 6
    assert _one(spark, Q.key_check(*head, c, Q.REPEATS))[0] == Q.repeated_key(child, "k").count()
    assert _one(spark, Q.key_check(*head, c, Q.ANY))[0] == Q.domain_values(child, "k").count() == 4
    found, sample = _one(spark, Q.key_check(*head, c, Q.outside("A", "B ")))
    assert found == Q.domain_values(child, "k", ["A", "B "]).count() == 2 and '"rows":2' in sample
    for name, keys in parents.items():
        parent = spark.createDataFrame([(k,) for k in keys], "k string")
        p = Q.side(f"silver.{name}", parent, "k")
        assert _one(spark, Q.orphan_check(*head, c, p))[0] == Q.orphans(child, "k", parent, "k").count(), name
        assert _one(spark, Q.orphan_check(*head, c, p))[0] == Q.unmatched(child, "k", parent.withColumnRenamed("k", "j"), "j").count(), name
        assert _one(spark, Q.parent_check(*head, c, p))[0] == Q.with_parent(child, "k", parent, "k").count(), name
        assert _one(spark, Q.parent_empty_check(*head, c, p))[0] == Q.if_parent_empty(child, parent).count(), name
        for skip in (False, True):
            assert _one(spark, Q.not_in_check(*head, c, p, skip_null=skip))[0] == Q.not_in(child, "k", parent, "k", skip).count(), (name, skip)
    every = Q.side("silver.all", child, "rows", key="''")
    assert _one(spark, Q.parity_check(*head, every, every))[0] == 1
    assert _one(spark, Q.parity_check(*head, c, every))[0] == 2                  # rows without a key do not count
    distinct = Q.side("silver.three", spark.range(3).select(F.lit(None).cast("string").alias("k")), "rows", key="''")
    assert _one(spark, Q.parity_check(*head, c, distinct, distinct=True))[0] == 1


def test_key_checks_read_each_table_once_and_shuffle_once(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(100).selectExpr("cast(id AS STRING) AS k", "id % 7 AS v", "'x' AS unused").write.parquet(a)
    spark.range(50).selectExpr("cast(id AS STRING) AS k", "'x' AS unused").write.parquet(b)
    ta, tb = spark.read.parquet(a), spark.read.parquet(b)
    k, v, j = Q.side("s.a", ta, "k"), Q.side("s.a", ta, "v"), Q.side("s.b", tb, "k")
    checks = [Q.key_check("1", ["s"], "a", "report", "", k, Q.REPEATS), Q.key_check("2", ["s"], "a", "report", "", v, Q.ANY),
              Q.orphan_check("3", ["s"], "a", "report", "", k, j), Q.parent_check("4", ["s"], "a", "report", "", k, j),
              Q.not_in_check("5", ["s"], "a", "report", "", k, j)]
    df = Q.run_checks(spark, checks)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") + plan.count("Scan parquet") in (2, 4) and plan.count("hashpartitioning") == 1
    assert "unused" not in plan
    assert [r.found for r in df.orderBy("check").collect()] == [0, 7, 50, 50, 50]
