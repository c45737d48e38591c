"""Unit tests for the column-level steps (T) and the dialect helpers (M)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from layerstar.functions import clean as C
from layerstar.functions import fmt
from layerstar.functions.dates import month_diff, parse_yyyymmdd, year_diff
from layerstar.functions.text import concat_nullsafe, concat_plus, sql_len


def one(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_month_and_year_diff_count_boundaries(spark):
    rows = [(dt.date(2001, 1, 31), dt.date(2001, 2, 1)), (dt.date(2000, 12, 31), dt.date(2001, 1, 1)),
            (dt.date(2001, 1, 1), dt.date(2001, 1, 31)), (dt.date(2001, 3, 15), dt.date(2000, 3, 16))]
    s = "a date, b date"
    assert one(spark, rows, s, month_diff("a", "b")) == [1, 1, 0, -12]
    assert one(spark, rows, s, year_diff("a", "b")) == [0, 1, 0, -1]


def test_parse_yyyymmdd(spark):
    rows = [("20101229",), ("0",), ("20101399",), ("2010122",), (None,), ("20101229  ",)]
    got = one(spark, rows, "c string", parse_yyyymmdd("c"))
    assert got == [dt.date(2010, 12, 29), None, None, None, None, dt.date(2010, 12, 29)]


def test_concat_flavours_and_len(spark):
    rows = [("Ann", None), ("Ann", "Lee")]
    assert one(spark, rows, "f string, l string", concat_plus("f", F.lit(" "), "l")) == [None, "Ann Lee"]
    assert one(spark, rows, "f string, l string", concat_nullsafe("f", F.lit(" "), "l")) == ["Ann ", "Ann Lee"]
    assert one(spark, [("ab  ",), (" ab",)], "c string", sql_len("c")) == [2, 3]


def test_money_rounds_half_away_from_zero(spark):
    rows = [(Decimal("0.125"),), (Decimal("1234567.005"),), (Decimal("-2.5"),), (None,)]
    got = one(spark, rows, "x decimal(18,3)", fmt.money("x"))
    assert got == ["$0.13", "$1,234,567.01", "($2.50)", None]
    assert one(spark, [(Decimal("1234.5"),)], "x decimal(18,2)", fmt.n0("x")) == ["1,235"]
    assert one(spark, [(dt.date(2001, 3, 1),)], "d date", fmt.month_abbr("d")) == ["Mar"]


def test_trim_and_codes(spark):
    df = spark.createDataFrame([(" a ", " m", 1)], "x string, y string, z int")
    r = C.trim_columns(df, ["x"]).first()
    assert (r.x, r.y, r.z) == ("a", " m", 1)
    rows = [("M",), ("s",), ("X",), (None,)]
    assert one(spark, rows, "c string", C.map_codes("c", C.MARITAL_CODES)) == \
        ["Married", "Single", "Unknown", "Unknown"]


def test_drop_null_keys(spark):
    df = spark.createDataFrame([(1,), (None,)], "k long")
    assert C.drop_null_keys(df, "k").count() == 1


def test_product_key_parts(spark):
    rows = [("CO-RF-FR-R92B-58",), ("AC-HE-HL-U509-R",)]
    assert one(spark, rows, "k string", C.category_id("k")) == ["CO_RF", "AC_HE"]
    assert one(spark, rows, "k string", C.product_number("k")) == ["FR_R92B_58", "HL_U509_R"]
    assert one(spark, [(" BK-R93R-62 ",)], "k string", C.normalise_key("k")) == ["BK_R93R_62"]


def test_clean_cost_and_lines(spark):
    rows = [(None,), ("-12",), (" 7.5 ",)]
    assert one(spark, rows, "c string", C.clean_cost("c")) == [Decimal("0.00"), Decimal("12.00"), Decimal("7.50")]
    rows = [("M",), ("r",), ("T",), ("S",), (None,), ("X",)]
    assert one(spark, rows, "c string", C.product_line("c")) == \
        ["Mountain", "Road", "Touring", "Other sales", "Unknown", "Unknown"]


def test_measures_abs_and_nullif(spark):
    rows = [("-10.5", "-2", "0")]
    df = spark.createDataFrame(rows, "s string, q string, p string")
    r = df.select(C.abs_decimal("s").alias("s"), C.abs_int("q").alias("q"),
                  C.zero_to_null(C.abs_decimal("p")).alias("p")).first()
    assert (r.s, r.q, r.p) == (Decimal("10.50"), 2, None)


def test_repair_sales_and_price_table(spark):
    """The s/q/p table of SURVEY §2.2 (after T12 and T13)."""
    D = Decimal
    rows = [  # s, q, p -> new s, new p
        (None, 2, D("5"), D("10"), D("5")),
        (D("10"), 2, D("5"), D("10"), D("5")),
        (D("11"), 2, D("5"), D("10"), D("5")),
        (D("10"), 3, None, D("10"), D("3.33")),
        (None, 2, None, None, None),
        (D("10"), None, D("5"), D("10"), D("5")),
        (D("10"), None, None, D("10"), None),
        (None, None, D("5"), None, D("5")),
    ]
    df = spark.createDataFrame([r[:3] for r in rows], "s decimal(18,2), q int, p decimal(18,2)")
    got = df.select(C.repair_sales("s", "q", "p").alias("s"), C.repair_price("s", "q", "p").alias("p")).collect()
    for r, g in zip(rows, got):
        assert (g.s, g.p) == (r[3], r[4]), r


def test_prefix_future_gender_country(spark):
    assert one(spark, [("NASAW1",), ("AW2",), ("nasAW3",)], "c string", C.strip_prefix("c")) == \
        ["AW1", "AW2", "AW3"]
    rows = [("2030-01-01",), ("1970-05-05",), (None,)]
    assert one(spark, rows, "c string", C.null_future("c", dt.date(2001, 9, 1))) == \
        [None, dt.date(1970, 5, 5), None]
    rows = [("F",), ("Female",), ("M ",), ("male",), ("",), (None,), ("x",)]
    assert one(spark, rows, "c string", C.map_gender("c")) == \
        ["Female", "Female", "Male", "Male", "Unknown", "Unknown", "Unknown"]
    assert one(spark, [("AW-1",)], "c string", C.strip_hyphen("c")) == ["AW1"]
    rows = [("DE",), (" us",), ("USA",), ("  ",), (None,), (" France ",)]
    assert one(spark, rows, "c string", C.map_country("c")) == \
        ["Germany", "United States", "United States", "Unknown", "Unknown", "France"]


def test_load_time_stamp(spark):
    df = spark.createDataFrame([("a", "b", "c", "d", 1)], "id string, cat string, subcat string, maintenance string, x int")
    out = C.with_load_time(C.load_categories(df), dt.datetime(2001, 9, 1))
    assert out.columns == ["id", "cat", "subcat", "maintenance", "dwh_create_dt"]
    assert out.first().dwh_create_dt == dt.datetime(2001, 9, 1)


def test_display_formats(spark):
    from decimal import Decimal as Dec
    from layerstar.plans.display import display
    df = spark.createDataFrame([("Bikes", Dec("1234.5"), Dec("2469"), Dec("50.00"))],
                               "category string, total_sales decimal(38,2), grand_total decimal(38,2), "
                               "sales_percentage decimal(38,2)")
    r = display("A7", df).first()
    assert (r.category, r.total_sales, r.grand_total, r.sales_percentage) == \
        ("Bikes", "$1,234.50", "$2,469.00", "50.00%")


def test_load_time_ignores_session_time_zone(spark):
    tz = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("a", "b", "c", "d")], "id string, cat string, subcat string, maintenance string")
        assert C.with_load_time(df, dt.datetime(2001, 9, 1)).first().dwh_create_dt == dt.datetime(2001, 9, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", tz)
