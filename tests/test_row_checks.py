"""Faster forms of the date parse and of the row checks give the plain forms' rows."""

import datetime as dt

from pyspark.sql import functions as F

from layerstar.functions.dates import parse_yyyymmdd
from layerstar.operators import quality as Q


def test_dates_are_cast_and_equal_the_pattern(spark):
    texts = [None, "", "0", "20101231", "20101399", "20100229", "20000229", "2010123", "2010123 ", "20101231  ", " 2010123",
             "2010123\t", "2010123T", "+2010123", "-2010123", "09991231", "00000101", "2010-1-1", "abcdefgh", "20101231\n"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    c = F.rtrim("s")
    plain = F.when(F.length(c) == 8, F.try_to_date(c, "yyyyMMdd"))
    assert df.where(~parse_yyyymmdd("s").eqNullSafe(plain)).count() == 0
    assert "concat" in str(parse_yyyymmdd("s"))


def test_row_checks_equal_their_plain_conditions(spark):
    dates = [None, "20000101", "19991231", "20110301", "x"]
    d = spark.createDataFrame([(a, b, c) for a in dates for b in dates for c in dates], "a string, b string, c string")
    p = [parse_yyyymmdd(x) for x in "abc"]
    lo, hi = F.lit("2000-01-01").cast("date"), F.lit("2011-02-01").cast("date")
    assert d.where(Q.is_unparsable(list("abc"))).count() == d.where(p[0].isNull() | p[1].isNull() | p[2].isNull()).count()
    out = (p[0] < lo) | (p[0] > hi) | (p[1] < lo) | (p[1] > hi) | (p[2] < lo) | (p[2] > hi)
    assert d.where(Q.is_out_of_bounds(d, list("abc"), dt.date(2011, 2, 1))).count() == d.where(out).count()
    assert d.where(Q.is_out_of_bounds(d, ["a"], dt.date(2011, 2, 1))).count() == d.where((p[0] < lo) | (p[0] > hi)).count()
    nums = [None, -2, -1, 0, 1, 2, 4]
    m = spark.createDataFrame([(a, b, c) for a in nums for b in nums for c in nums], "s int, q int, p int") \
        .select(F.col("s").cast("decimal(18,2)").alias("s"), "q", F.col("p").cast("decimal(18,2)").alias("p"))
    for negatives in (False, True):
        cond = F.col("s") != F.col("q") * F.col("p")
        for v in "sqp":
            cond = cond | F.col(v).isNull() | (F.col(v) == 0) | ((F.col(v) < 0) if negatives else F.lit(False))
        assert Q.measure_mismatch(m, "s", "q", "p", negatives).count() == m.where(cond).count()
