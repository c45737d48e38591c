"""The scalable forms equal the plain window forms."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from layerstar.operators.rows import (derive_end_date, impute_order_date, latest_per_key,
                                      surrogate_key, with_grand_total)


def test_surrogate_key_equals_row_number(spark):
    base = spark.range(0, 3000).select(
        F.col("id"), F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 7).cast("int")).alias("d"))
    base = base.union(spark.createDataFrame([(5000, None)], "id long, d date"))
    got = surrogate_key(base, ["d", "id"], "k")
    ref = base.withColumn("r", F.row_number().over(Window.orderBy(F.col("d").asc_nulls_first(), "id")))
    j = got.join(ref, "id")
    assert j.where("k != r").count() == 0
    assert got.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first() == (1, 3001, 3001)
    assert got.where("id = 5000").first().k == 1          # NULL sorts first


def test_surrogate_key_of_few_rows(spark):
    df = spark.range(0, 10).withColumn("x", F.lit(1))
    got = surrogate_key(df, ["id"], "k")
    assert [r.k for r in got.orderBy("id").collect()] == list(range(1, 11))


def test_latest_per_key_equals_row_number(spark):
    rows = [(1, dt.date(2020, 1, 1), "a"), (1, dt.date(2021, 1, 1), "b"), (1, None, "c"),
            (2, None, "z"), (2, None, "y"), (3, dt.date(2020, 1, 1), "p"), (3, dt.date(2020, 1, 1), "q"),
            (None, dt.date(2020, 1, 1), "n")]
    df = spark.createDataFrame(rows, "k long, d date, v string")
    got = {r.k: (r.d, r.v) for r in latest_per_key(df, "k", "d", tie=["v"]).collect()}
    w = Window.partitionBy("k").orderBy(F.col("d").desc_nulls_last(), F.col("v").desc_nulls_last())
    ref = {r.k: (r.d, r.v) for r in df.withColumn("rn", F.row_number().over(w)).where("rn = 1").collect()}
    assert got == ref
    assert got[1] == (dt.date(2021, 1, 1), "b")


def test_derive_end_date_equals_lead(spark):
    rows = [(1, "A", dt.date(2011, 7, 1)), (2, "A", dt.date(2012, 7, 1)), (3, "A", dt.date(2013, 7, 1)),
            (4, "A", dt.date(2012, 7, 1)), (5, "A", dt.date(2013, 7, 1)),      # repeated starts
            (6, "B", dt.date(2013, 1, 1)), (7, "B", None), (8, "B", None), (9, "C", dt.date(2011, 1, 1)),
            (10, None, dt.date(2011, 1, 1)), (11, None, dt.date(2011, 1, 1))]
    df = spark.createDataFrame(rows, "id long, k string, s date")
    got = sorted(tuple(map(str, r)) for r in derive_end_date(df, "k", "s", "e", "id").collect())
    w = Window.partitionBy("k").orderBy(F.col("s").asc_nulls_first(), "id")
    ref = sorted(tuple(map(str, r)) for r in df.withColumn("e", F.date_sub(F.lead("s").over(w), 1)).collect())
    assert got == ref


def test_impute_order_date_equals_window_mean(spark):
    rows = [(dt.date(2020, 1, 10), dt.date(2020, 1, 20)), (None, dt.date(2020, 1, 20)),
            (dt.date(2020, 1, 10), dt.date(2020, 1, 5)), (dt.date(2020, 1, 1), dt.date(2020, 1, 3))]
    df = spark.createDataFrame(rows, "o date, s date")
    got = [r.o for r in impute_order_date(df, "o", "s").collect()]
    # mean of 10, -5, 2 = 2.33 -> 2 days (integer mean, cut toward zero)
    assert got == [dt.date(2020, 1, 10), dt.date(2020, 1, 18), dt.date(2020, 1, 10), dt.date(2020, 1, 1)]
    neg = spark.createDataFrame([(dt.date(2020, 1, 10), dt.date(2020, 1, 5)), (None, dt.date(2020, 1, 20)),
                                 (dt.date(2020, 1, 10), dt.date(2020, 1, 8))], "o date, s date")
    # mean of -5 and -2 = -3.5 -> -3
    assert impute_order_date(neg, "o", "s").collect()[1].o == dt.date(2020, 1, 23)


def test_grand_total_equals_empty_over(spark):
    df = spark.range(0, 100).withColumn("g", F.col("id") % 3)
    got = with_grand_total(df, "id", "t").select("t").distinct().collect()
    assert [r.t for r in got] == [4950]
