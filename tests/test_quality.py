"""Each check finds planted dirt and passes on clean data."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from layerstar.functions import clean as C
from layerstar.operators import quality as Q
from layerstar.sources.schemas import SILVER

D = dt.date


def test_key_checks(spark):
    dirty = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "k long, v string")
    clean = spark.createDataFrame([(1, "a"), (2, "d")], "k long, v string")
    assert sorted((r.k, r.cnt) for r in Q.duplicate_or_null_key(dirty, "k").collect()
                  if r.k is not None) == [(1, 2)]
    assert Q.duplicate_or_null_key(dirty, "k").count() == 2
    assert Q.duplicate_or_null_key(clean, "k").count() == 0
    assert sorted(r.v for r in Q.rows_with_bad_key(dirty, "k").collect()) == ["a", "b", "c"]
    assert Q.repeated_key(dirty, "k").count() == 1


def test_text_checks(spark):
    df = spark.createDataFrame([(" a", "b"), ("a", "b "), ("a", "b")], "x string, y string")
    assert Q.untrimmed(df, ["x", "y"]).count() == 2
    assert Q.untrimmed(df.where("x = 'a' and y = 'b'"), ["x", "y"]).count() == 0
    vals = spark.createDataFrame([("Male",), ("Female",), ("x",), (None,)], "g string")
    assert sorted(str(r.g) for r in Q.domain_values(vals, "g", ["Male", "Female", "Unknown"]).collect()) == \
        ["None", "x"]
    assert Q.domain_values(vals, "g").count() == 4
    assert Q.length_histogram(spark.createDataFrame([("ab",), ("abc ",), ("xy",)], "c string"), "c").count() == 2
    ids = spark.createDataFrame([("AC_BR",), ("ACBR",), (None,), ("AC_BRX",)], "id string")
    assert Q.bad_pattern(ids, "id").count() == 3


def test_amount_and_date_checks(spark):
    p = spark.createDataFrame([("-1",), (None,), ("3",)], "c string")
    assert Q.null_or_negative(p, "c").count() == 2
    r = spark.createDataFrame([(D(2020, 1, 2), D(2020, 1, 1)), (D(2020, 1, 1), None)], "s date, e date")
    assert Q.reversed_range(r, "s", "e").count() == 1
    assert Q.null_any(r, ["s", "e"]).count() == 1
    s = spark.createDataFrame([("20101229", "20101230", "20110105"), ("0", "20101230", "20101201"),
                               ("20101399", "1999123", "20101201")], "o string, s string, d string")
    assert Q.unparsable_dates(s, ["o", "s", "d"]).count() == 2
    assert Q.dates_out_of_order(s, "o", "s", "d").count() == 2
    assert Q.dates_out_of_bounds(s, ["o", "s", "d"], D(2011, 2, 1)).count() == 0
    assert Q.dates_out_of_bounds(s, ["o", "s", "d"], D(2011, 1, 1)).count() == 1


def test_measure_check(spark):
    m = spark.createDataFrame([("10", "2", "5"), ("11", "2", "5"), ("0", "1", "1"), (None, "1", "1")],
                              "s string, q string, p string")
    assert Q.measure_mismatch(m, "s", "q", "p").count() == 3
    n = spark.createDataFrame([(Decimal("-10"), 2, Decimal("-5"))], "s decimal(18,2), q int, p decimal(18,2)")
    assert Q.measure_mismatch(n, "s", "q", "p").count() == 0
    assert Q.measure_mismatch(n, "s", "q", "p", negatives=True).count() == 1


def test_birthdate_and_standardisation(spark):
    b = spark.createDataFrame([("1920-01-01",), ("2030-01-01",), ("1970-01-01",)], "bdate string")
    got = sorted((r.bdate_old, r.validated_bdate) for r in Q.birthdate_bounds(b, "bdate", D(2001, 9, 1)).collect())
    assert got == [("1920-01-01", D(1920, 1, 1)), ("2030-01-01", None)]
    g = spark.createDataFrame([("F",), ("F",), ("male",)], "gen string")
    assert sorted(tuple(r) for r in Q.standardisation_map(g, "gen", C.map_gender).collect()) == \
        [("F", "Female"), ("male", "Male")]


def test_referential_checks(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    parent = spark.createDataFrame([(1,)], "id long")
    with_null = spark.createDataFrame([(1,), (None,)], "id long")
    empty = spark.createDataFrame([], "id long")
    assert [r.k for r in Q.orphans(child, "k", parent, "id").collect()].count(2) == 1
    assert Q.orphans(child, "k", parent, "id").count() == 2            # NULL never matches
    assert [r.k for r in Q.not_in(child, "k", parent, "id").collect()] == [2]
    assert Q.not_in(child, "k", with_null, "id").count() == 0          # one NULL empties it
    assert [r.k for r in Q.not_in(child, "k", with_null, "id", skip_null=True).collect()] == [2]
    assert Q.not_in(child, "k", empty, "id").count() == 3              # empty list keeps all
    assert Q.if_parent_empty(child, parent).count() == 0
    assert Q.if_parent_empty(child, empty).count() == 3
    assert [r.k for r in Q.with_parent(child, "k", parent, "id").collect()] == [1]
    assert Q.unmatched(child.where("k is not null"), "k", parent, "id").count() == 1


def test_not_in_matches_sql_semantics(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    for parent_rows in ([(1,)], [(1,), (None,)], []):
        parent = spark.createDataFrame(parent_rows, "id long")
        child.createOrReplaceTempView("c_v")
        parent.createOrReplaceTempView("p_v")
        ref = sorted(str(r.k) for r in spark.sql("SELECT * FROM c_v WHERE k NOT IN (SELECT id FROM p_v)").collect())
        got = sorted(str(r.k) for r in Q.not_in(child, "k", parent, "id").collect())
        assert got == ref


def test_counts_population_fanout(spark):
    b = spark.createDataFrame([(1,), (2,)], "k long")
    s = spark.createDataFrame([(1,)], "k long")
    assert {r.layer: r.row_num for r in Q.row_count_parity(b, s).collect()} == {"bronze": 2, "silver": 1}
    assert Q.is_populated(s).first().populated is True
    assert Q.is_populated(s.where("k > 5")).first().populated is False
    j = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    assert [r.k for r in Q.join_fan_out(j, "k").collect()] == [1]
    assert Q.rows_per_value(j, "k").count() == 2
    pairs = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y")], "a string, b string")
    assert Q.distinct_pairs(pairs, "a", "b").count() == 2


def test_fact_key_integrity(spark):
    f = spark.createDataFrame([(1, 1), (None, 1), (2, None)], "customer_key long, product_key long")
    c = spark.createDataFrame([(1, "AW1"), (2, "AW2")], "customer_key long, customer_number string")
    p = spark.createDataFrame([(1, "P1")], "product_key long, product_number string")
    assert Q.fact_key_integrity(f, c, p).count() == 2


def test_master_merge_audit(spark):
    cust = spark.createDataFrame([("A", "Male"), ("B", "Unknown"), ("C", "Unknown")], "cst_key string, cst_gndr string")
    az = spark.createDataFrame([("A", "Female"), ("B", "Female")], "cid string, gen string")
    loc = spark.createDataFrame([("A", "DE")], "cid string, cntry string")
    got = {(r.cst_gndr, r.gen): r.new_gen for r in Q.master_merge_audit(cust, az, loc).collect()}
    assert got == {("Male", "Female"): "Male", ("Unknown", "Female"): "Female", ("Unknown", None): "Unknown"}


def test_schema_mismatch(spark):
    good = spark.createDataFrame([("AW1", "x", 5)], "cid string, cntry string, extra int")
    exp = SILVER["erp_loc_a101"]
    got = {r.column_name: r.problem for r in
           Q.schema_mismatch(spark, good, exp, {"cid": 2, "cntry": 50}).collect()}
    assert got == {"cid": "too long", "dwh_create_dt": "missing", "extra": "not declared"}


def test_run_checks(spark):
    df = spark.createDataFrame([(1,), (1,)], "k long")
    checks = [Q.Check("dup", ("bronze",), "t", "no_rows", "no rows", Q.duplicate_or_null_key(df, "k")),
              Q.Check("len", ("silver",), "t", "one_row", "one row", Q.length_histogram(
                  df.select(F.col("k").cast("string").alias("k")), "k"))]
    got = {r.check: (r.found, r.passed) for r in Q.run_checks(spark, checks).collect()}
    assert got == {"dup": (1, False), "len": (1, True)}


def test_row_checks_share_a_scan_and_show_a_row(spark):
    df = spark.createDataFrame([(1, " a"), (None, "b"), (3, "c ")], "k long, t string")
    L = ("bronze",)
    checks = [Q.row_check("null", L, "t", "no_rows", "", df, Q.has_null("k")),
              Q.row_check("trim", L, "t", "no_rows", "", df, Q.is_untrimmed("t")),
              Q.row_check("neg", L, "t", "no_rows", "", df, Q.is_null_or_negative(df, "k") & F.col("k").isNotNull()),
              Q.Check("dup", L, "t", "no_rows", "", Q.duplicate_or_null_key(df, "k"))]
    got = {r.check: r for r in Q.run_checks(spark, checks, samples=True).collect()}
    assert {k: (r.found, r.passed) for k, r in got.items()} == {
        "null": (1, False), "trim": (2, False), "neg": (0, True), "dup": (1, False)}
    assert got["null"]["sample"] == '{"t":"b"}' and got["trim"]["sample"] == '{"k":1,"t":" a"}'
    assert got["neg"]["sample"] is None and got["dup"]["sample"] == '{"cnt":1}'
    one = Q.run_checks(spark, checks[:3])
    assert one._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    assert Q.run_checks(spark, [], samples=True).count() == 0
