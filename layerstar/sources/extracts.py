"""Source extracts: the six CSV files the warehouse loads, derived by Spark from
the driver's relational tables (SURVEY §7.3).

The warehouse reads raw CSV extracts from a CRM and an ERP system.  Here those
extracts are made from the given tables, so that every load and query grows
with them: customers from ``customer`` (+ ``nation``), products and categories
from ``part``, sales lines from ``lineitem`` joined to ``orders``.

Dirt is planted by fixed rules on the keys so that the cleansing steps and the
quality checks have something to find.  The rules are listed once, as fixed
values, and the DuckDB oracle applies the same rules.  No row of the input is
dropped: dirt changes values or adds extra versions of a row.

All columns are text, as in a file; NULL is written as an empty field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerstar.operators.rows import merged

# The planted dirt, as (modulus, remainder) tests on the key.
CUST_OLDER_VERSION = 7        # k % 7 == 0: an older row of the same customer
CUST_TIED_VERSION = 11        # k % 11 == 0: a row with the same create date
CUST_UNDATED_VERSION = 13     # k % 13 == 0: a row without create date
CUST_NULL_ID = (97, 3)        # cst_id NULL
CUST_SPACED_KEY = (5, 1)      # cst_key with outer spaces
CUST_SPACED_NAME = (5, 0)     # first name with outer spaces
CUST_NO_LASTNAME = 23         # last name NULL
MARITAL_BY_K6 = ["M", "S", "m", " s", None, "D"]
GENDER_BY_K8 = ["M", "F", "f", " m ", None, "X", "M", "F"]
ERP_GENDER_BY_K9 = ["F", "Female", "M ", "male", " ", None, "M", "F", "f"]
BIRTH_NULL, BIRTH_FUTURE, BIRTH_ANCIENT = 47, 41, 43
LOC_NULL, LOC_BLANK = 53, 59
# other spellings that the warehouse's collation calls equal
ERP_LOWER_ID, LOC_LOWER_NAME = 17, 61
PRD_LOWER_KEY = (15, 6)        # the later versions of these products
SLS_LOWER_KEY = (12, 5)        # (orderkey + linenumber) % 12 == 5
CATEGORY_SPELT_OTHERWISE = "22"  # brand 22: id and category in lower case, a space after
PRD_SECOND_VERSION, PRD_THIRD_VERSION = 3, 9
PRD_REPEATED_START = (8, 5)   # a row more, with the start date of the last version
PRD_SPACED_KEY, PRD_SPACED_NAME = 37, 31
PRD_NO_COST, PRD_NEGATIVE_COST = 50, 43
LINE_BY_SIZE6 = ["R ", "M ", "S ", "T ", "r", None]
CATEGORY_WITHOUT_MATCH = "13"  # brand 13: the category table uses id XX_NA
SLS_UNKNOWN_PRODUCT = (19, 7)
SLS_SPACED_KEY = (10, 3)       # (orderkey + linenumber) % 10 == 3
SLS_NULL_CUSTOMER, SLS_UNKNOWN_CUSTOMER = 29, 31
SLS_ZERO_DATE, SLS_BAD_DATE, SLS_SHORT_DATE = 17, 41, 43
SLS_RAW_SALES = (3, 1)         # sales = extended price, often != qty * price
SLS_NULL_SALES, SLS_ZERO_SALES, SLS_NEG_SALES = 23, 37, 13
SLS_ZERO_QTY, SLS_NEG_QTY = 53, 59
SLS_NULL_PRICE, SLS_ZERO_PRICE, SLS_NEG_PRICE = 11, 47, 14

EXTRACTS = ["crm_cust_info", "crm_prd_info", "crm_sales_details",
            "erp_cust_az12", "erp_loc_a101", "erp_px_cat_g1v2"]


def _m(c: Column, mod: int, rem: int = 0) -> Column:
    return (c % mod) == rem


def _pick(c: Column, values: list) -> Column:
    """values[c % len(values)]"""
    k = c % len(values)
    out = None
    for i, v in enumerate(values):
        out = F.when(k == i, F.lit(v)) if out is None else out.when(k == i, F.lit(v))
    return out


def _aw(k: Column) -> Column:
    return F.format_string("AW%08d", k)


def _ymd(c: Column) -> Column:
    """Date as 'yyyyMMdd' text (years 1000-9999), from integer parts."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("string")


def _iso(c: Column) -> Column:
    """Date as 'yyyy-MM-dd' text."""
    return F.to_date(c).cast("string")


def _money_text(cents: Column) -> Column:
    """Whole cents (>= 0) as '123.45'."""
    return F.concat(F.floor(cents / 100).cast("string"), F.lit("."),
                    F.lpad((cents % 100).cast("string"), 2, "0"))


def _versions(*flags: Column) -> Column:
    """[0] plus version i for every flag i that holds; exploded into rows."""
    return F.explode(F.array_compact(F.array(
        F.lit(0), *[F.when(f, F.lit(i + 1)) for i, f in enumerate(flags)])))


def crm_cust_info(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    rows = customer.select("c_custkey", "c_name", _versions(
        _m(k, CUST_OLDER_VERSION), _m(k, CUST_TIED_VERSION), _m(k, CUST_UNDATED_VERSION)
    ).alias("v"))
    v = F.col("v")
    first = F.when(v == 2, F.lit("Client")).otherwise(F.substring_index("c_name", "#", 1))
    created = F.date_add(F.lit("2010-01-01").cast("date"), (k % 1000).cast("int"))
    created = F.when(v == 1, F.date_sub(created, 30)).when(v == 3, None).otherwise(created)
    return rows.select(
        F.when(_m(k, *CUST_NULL_ID), None).otherwise(k.cast("string")).alias("cst_id"),
        F.when(_m(k, *CUST_SPACED_KEY), F.concat(F.lit(" "), _aw(k), F.lit(" ")))
         .otherwise(_aw(k)).alias("cst_key"),
        F.when(_m(k, *CUST_SPACED_NAME), F.concat(F.lit("  "), first, F.lit(" ")))
         .otherwise(first).alias("cst_firstname"),
        F.when(_m(k, CUST_NO_LASTNAME), None)
         .otherwise(F.substring_index("c_name", "#", -1)).alias("cst_lastname"),
        F.when(v == 1, F.lit("S")).otherwise(_pick(k, MARITAL_BY_K6)).alias("cst_marital_status"),
        _pick(k, GENDER_BY_K8).alias("cst_gndr"),
        _iso(created).alias("cst_create_date"))


def crm_prd_info(part: DataFrame) -> DataFrame:
    pk = F.col("p_partkey")
    rows = part.select("*", _versions(_m(pk, PRD_SECOND_VERSION), _m(pk, PRD_THIRD_VERSION),
                                      _m(pk, *PRD_REPEATED_START)).alias("v"))
    v = F.col("v")
    last = F.when(_m(pk, PRD_THIRD_VERSION), 2).when(_m(pk, PRD_SECOND_VERSION), 1).otherwise(0)
    key = F.concat(F.substr("p_type", F.lit(1), F.lit(2)), F.lit("-"),
                   F.lpad(F.substring_index("p_brand", "#", -1), 2, "0"),
                   F.lit("-PK-"), pk.cast("string"))
    key = F.when(_m(pk, *PRD_LOWER_KEY) & (v >= 1), F.lower(key)).otherwise(key)
    cost = (F.col("p_retailprice").cast("decimal(18,2)") + v * 10).cast("string")
    return rows.select(
        (pk * 4 + v).cast("string").alias("prd_id"),
        F.when(_m(pk, PRD_SPACED_KEY), F.concat(F.lit(" "), key)).otherwise(key).alias("prd_key"),
        F.when(_m(pk, PRD_SPACED_NAME), F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")))
         .otherwise(F.col("p_name")).alias("prd_nm"),
        F.when(_m(pk, PRD_NO_COST), None)
         .when(_m(pk, PRD_NEGATIVE_COST), F.concat(F.lit("-"), cost)).otherwise(cost)
         .alias("prd_cost"),
        _pick(F.col("p_size"), LINE_BY_SIZE6).alias("prd_line"),
        _iso(F.make_date(2011 + F.least(v, last), F.lit(7), F.lit(1))).alias("prd_start_dt"),
        F.when(v == last, None).otherwise(_iso(F.make_date(2010 + v, F.lit(12), F.lit(28))))
         .alias("prd_end_dt"))


def erp_px_cat_g1v2(part: DataFrame) -> DataFrame:
    brand = F.lpad(F.substring_index("p_brand", "#", -1), 2, "0")
    suffix = F.when(brand == CATEGORY_WITHOUT_MATCH, F.lit("NA")).otherwise(brand)

    def spelt(c: Column) -> Column:
        return F.when(brand == CATEGORY_SPELT_OTHERWISE, F.concat(F.lower(c), F.lit(" "))).otherwise(c)
    cats = part.select(
        spelt(F.concat(F.substr("p_type", F.lit(1), F.lit(2)), F.lit("_"), suffix)).alias("id"),
        spelt(F.col("p_type")).alias("cat"), F.col("p_brand").alias("subcat"),
        F.when(brand.cast("int") % 2 == 0, F.lit("Yes")).otherwise(F.lit("No"))
         .alias("maintenance"))
    return cats.distinct()


def crm_sales_details(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                         "l_extendedprice", "l_shipdate")
    od = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(merged(od), li.l_orderkey == od.o_orderkey, "left")
    # first the shared parts, once per row (later CASE branches only pick them)
    qty = F.col("l_quantity").cast("int")
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("long")
    parts = j.select(
        "l_orderkey", "l_partkey", "l_linenumber", "o_custkey", "l_shipdate",
        qty.alias("qty"), cents.alias("cents"),
        (cents / qty).cast("long").alias("pc"),
        _ymd(F.col("o_orderdate")).alias("odt"),
        _ymd(F.date_add(F.to_date("o_orderdate"), 30)).alias("due"))
    ok, pk, qty = F.col("l_orderkey"), F.col("l_partkey"), F.col("qty")
    key = F.concat(F.when(_m(ok, *SLS_UNKNOWN_PRODUCT), F.lit("ZZ-")).otherwise(F.lit("PK-")),
                   pk.cast("string"))
    parts = parts.select(
        "*", key.alias("key"), _money_text(F.col("pc")).alias("price"),
        F.when(_m(ok, *SLS_RAW_SALES), _money_text(F.col("cents")))
         .otherwise(_money_text(F.col("pc") * qty)).alias("sales"))
    key, price, sales = F.col("key"), F.col("price"), F.col("sales")
    line = ok + F.col("l_linenumber")
    key = F.when((line % SLS_LOWER_KEY[0]) == SLS_LOWER_KEY[1], F.lower(key)).otherwise(key)
    odt = F.col("odt")
    return parts.select(
        F.concat(F.lit("SO"), ok.cast("string")).alias("sls_ord_num"),
        F.when(((ok + F.col("l_linenumber")) % SLS_SPACED_KEY[0]) == SLS_SPACED_KEY[1],
               F.concat(F.lit(" "), key, F.lit(" "))).otherwise(key).alias("sls_prd_key"),
        F.when(_m(ok, SLS_NULL_CUSTOMER), None)
         .when(_m(ok, SLS_UNKNOWN_CUSTOMER), (-(F.col("o_custkey") + 1)).cast("string"))
         .otherwise(F.col("o_custkey").cast("string")).alias("sls_cust_id"),
        F.when(_m(ok, SLS_ZERO_DATE), F.lit("0"))
         .when(_m(ok, SLS_BAD_DATE), F.lit("20101399"))
         .when(_m(ok, SLS_SHORT_DATE), F.substr(odt, F.lit(1), F.lit(7)))
         .otherwise(odt).alias("sls_order_dt"),
        _ymd(F.col("l_shipdate")).alias("sls_ship_dt"),
        F.col("due").alias("sls_due_dt"),
        F.when(_m(ok, SLS_NULL_SALES), None).when(_m(ok, SLS_ZERO_SALES), F.lit("0"))
         .when(_m(ok, SLS_NEG_SALES), F.concat(F.lit("-"), sales)).otherwise(sales)
         .alias("sls_sales"),
        F.when(_m(ok, SLS_ZERO_QTY), F.lit("0"))
         .when(_m(ok, SLS_NEG_QTY), F.concat(F.lit("-"), qty.cast("string")))
         .otherwise(qty.cast("string")).alias("sls_quantity"),
        F.when(_m(ok, SLS_NULL_PRICE), None).when(_m(ok, SLS_ZERO_PRICE), F.lit("0"))
         .when(_m(ok, SLS_NEG_PRICE), F.concat(F.lit("-"), price)).otherwise(price)
         .alias("sls_price"))


def erp_cust_az12(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    born = F.date_add(F.lit("1940-01-01").cast("date"), ((k * 37) % 20000).cast("int"))
    day = (k % 365).cast("int")
    bdate = F.when(_m(k, BIRTH_NULL), None) \
             .when(_m(k, BIRTH_FUTURE), _iso(F.date_add(F.lit("2030-01-01").cast("date"), day))) \
             .when(_m(k, BIRTH_ANCIENT), _iso(F.date_add(F.lit("1915-01-01").cast("date"), day))) \
             .otherwise(_iso(born))
    cid = F.when(_m(k, ERP_LOWER_ID), F.lower(_aw(k))).otherwise(_aw(k))
    return customer.select(
        F.when(_m(k, 2), F.concat(F.lit("NAS"), cid)).otherwise(cid).alias("cid"),
        bdate.alias("bdate"),
        _pick(k, ERP_GENDER_BY_K9).alias("gen"))


def erp_loc_a101(customer: DataFrame, nation: DataFrame) -> DataFrame:
    c = customer.select("c_custkey", "c_nationkey")
    j = c.join(nation.select("n_nationkey", "n_name"), c.c_nationkey == nation.n_nationkey, "left")
    k, nk = F.col("c_custkey"), F.col("c_nationkey")
    cntry = F.when(_m(k, LOC_NULL), None).when(_m(k, LOC_BLANK), F.lit("  ")) \
             .when(nk == 0, F.lit("DE")) \
             .when(nk == 1, F.when(_m(k, 2), F.lit("US")).otherwise(F.lit("USA"))) \
             .when(nk == 2, F.concat(F.lit(" "), F.col("n_name"), F.lit(" "))) \
             .when(_m(k, LOC_LOWER_NAME), F.lower("n_name")) \
             .otherwise(F.col("n_name"))
    return j.select(F.concat(F.lit("AW-"), F.format_string("%08d", k)).alias("cid"),
                    cntry.alias("cntry"))


def build_extracts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six extracts as lazy DataFrames over the driver tables in ``sf_dir``."""
    t = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
         for n in ("customer", "nation", "part", "orders", "lineitem")}
    return {
        "crm_cust_info": crm_cust_info(t["customer"]),
        "crm_prd_info": crm_prd_info(t["part"]),
        "crm_sales_details": crm_sales_details(t["lineitem"], t["orders"]),
        "erp_cust_az12": erp_cust_az12(t["customer"]),
        "erp_loc_a101": erp_loc_a101(t["customer"], t["nation"]),
        "erp_px_cat_g1v2": erp_px_cat_g1v2(t["part"]),
    }
