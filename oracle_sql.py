"""DuckDB oracle: for every query in ``layerstar.plans.catalog`` the same answer
written as one ANSI SQL text over the driver tables (region nation customer
supplier part orders lineitem ...), independently of the Spark code.

The SQL rebuilds the whole chain as CTEs: the source extracts with the same
planted dirt (the rules of ``layerstar.sources.extracts``), bronze typing,
the silver loads, and the star schema with ROW_NUMBER keys.

Rules that keep both engines comparable (SURVEY §7.3):
* every window names NULLS FIRST / NULLS LAST (the dialect sorts NULL lowest);
* every limit and row number has a tie-break;
* DuckDB divides decimals in DOUBLE, so means and ratios of money are rounded
  half-up exactly in integer arithmetic (``xratio``);
* result types are cast to what Spark returns (INTEGER years and month
  differences, BIGINT counts and quantities, DECIMAL(38,2) money sums).
"""

from __future__ import annotations

AS_OF = "DATE '2001-09-01'"
LOAD_TS = "TIMESTAMP '2001-09-01 00:00:00'"
MONTHS, SPEND = 60, 2000000
HIGH, MID = 1900000, 1400000
E1, E2, E3 = 925, 950, 975


def _pick(k: str, values: list) -> str:
    items = ", ".join("NULL" if v is None else "'" + v + "'" for v in values)
    return f"[{items}][({k}) % {len(values)} + 1]"


def _money_text(x: str) -> str:
    return f"(CAST(({x}) // 100 AS VARCHAR) || '.' || lpad(CAST(({x}) % 100 AS VARCHAR), 2, '0'))"


def xratio(a: str, b: str, a_scale: int = 2, b_scale: int = 0, places: int = 4) -> str:
    """round_half_up(a / b, places) exactly; NULL when b is 0 or either is NULL.
    ``a`` and ``b`` are exact numbers with at most ``a_scale``/``b_scale`` decimals."""
    A = f"CAST(({a}) * {10 ** a_scale} AS HUGEINT)"
    B = f"CAST(({b}) * {10 ** b_scale} AS HUGEINT)"
    num = f"(abs({A}) * {10 ** (b_scale + places)})"
    den = f"(abs({B}) * {10 ** a_scale})"
    q = f"((2 * {num} + {den}) // (2 * {den}))"
    unit = "CAST('0." + "0" * (places - 1) + f"1' AS DECIMAL({places + 1},{places}))"
    return (f"(CASE WHEN ({b}) = 0 OR ({b}) IS NULL OR ({a}) IS NULL THEN NULL ELSE "
            f"CAST(CAST(sign({A}) * sign({B}) * {q} AS DECIMAL(30,0)) * {unit} "
            f"AS DECIMAL(38,{places})) END)")


def _pd(c: str) -> str:
    return f"(CASE WHEN length(rtrim({c})) = 8 THEN CAST(try_strptime(rtrim({c}), '%Y%m%d') AS DATE) END)"


def _versions(*conds: str) -> str:
    items = ", ".join(["0"] + [f"CASE WHEN {c} THEN {i + 1} END" for i, c in enumerate(conds)])
    return f"unnest(list_filter([{items}], lambda x: x IS NOT NULL))"


def _norm_case(c: str, mapping: list[tuple[str, str]]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping)
    return f"(CASE upper({c}) {whens} ELSE 'Unknown' END)"


MARITAL = [("M", "Married"), ("S", "Single")]
GENDER = [("M", "Male"), ("F", "Female")]
LINES = [("M", "Mountain"), ("R", "Road"), ("T", "Touring"), ("S", "Other sales")]


def _gen(c: str) -> str:
    return (f"(CASE WHEN upper(trim({c})) IN ('F','FEMALE') THEN 'Female' "
            f"WHEN upper(trim({c})) IN ('M','MALE') THEN 'Male' ELSE 'Unknown' END)")


def _cntry(c: str) -> str:
    return (f"(CASE WHEN upper(trim({c})) = 'DE' THEN 'Germany' "
            f"WHEN upper(trim({c})) IN ('USA','US') THEN 'United States' "
            f"WHEN {c} IS NULL OR trim({c}) = '' THEN 'Unknown' ELSE trim({c}) END)")


def _aw(k: str) -> str:
    return f"printf('AW%08d', {k})"


def same(a: str, b: str) -> str:
    """Text equality that ignores case and trailing spaces."""
    return f"lower(rtrim({a})) = lower(rtrim({b}))"


CTE: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTE[name] = (body, deps)


# ------------------------------------------------------------------ bronze
cte("b_cust", [], f"""
SELECT CAST(CASE WHEN k % 97 = 3 THEN NULL ELSE k END AS BIGINT) AS cst_id,
  CASE WHEN k % 5 = 1 THEN ' ' || {_aw('k')} || ' ' ELSE {_aw('k')} END AS cst_key,
  CASE WHEN k % 5 = 0 THEN '  ' || fn || ' ' ELSE fn END AS cst_firstname,
  CASE WHEN k % 23 = 0 THEN NULL ELSE split_part(c_name, '#', 2) END AS cst_lastname,
  CASE WHEN v = 1 THEN 'S' ELSE {_pick('k', ['M', 'S', 'm', ' s', None, 'D'])} END AS cst_marital_status,
  {_pick('k', ['M', 'F', 'f', ' m ', None, 'X', 'M', 'F'])} AS cst_gndr,
  CASE WHEN v = 1 THEN d - 30 WHEN v = 3 THEN NULL ELSE d END AS cst_create_date
FROM (SELECT k, c_name, v,
        CASE WHEN v = 2 THEN 'Client' ELSE split_part(c_name, '#', 1) END AS fn,
        DATE '2010-01-01' + CAST(k % 1000 AS INTEGER) AS d
      FROM (SELECT c_custkey AS k, c_name,
              {_versions('c_custkey % 7 = 0', 'c_custkey % 11 = 0', 'c_custkey % 13 = 0')} AS v
            FROM customer))""")

cte("b_prd", [], f"""
SELECT CAST(pk * 4 + v AS BIGINT) AS prd_id,
  CASE WHEN pk % 37 = 0 THEN ' ' ELSE '' END || CASE WHEN pk % 15 = 6 AND v >= 1 THEN lower(key) ELSE key END AS prd_key,
  CASE WHEN pk % 31 = 0 THEN ' ' || p_name || ' ' ELSE p_name END AS prd_nm,
  CASE WHEN pk % 50 = 0 THEN NULL WHEN pk % 43 = 0 THEN '-' || cost ELSE cost END AS prd_cost,
  {_pick('p_size', ['R ', 'M ', 'S ', 'T ', 'r', None])} AS prd_line,
  make_date(2011 + least(v, lastv), 7, 1) AS prd_start_dt,
  CASE WHEN v = lastv THEN NULL ELSE make_date(2010 + v, 12, 28) END AS prd_end_dt
FROM (SELECT p_partkey AS pk, p_name, p_size, v,
        substring(p_type, 1, 2) || '-' || lpad(split_part(p_brand, '#', 2), 2, '0') || '-PK-'
          || CAST(p_partkey AS VARCHAR) AS key,
        CAST(CAST(p_retailprice AS DECIMAL(18,2)) + v * 10 AS VARCHAR) AS cost,
        CASE WHEN p_partkey % 9 = 0 THEN 2 WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS lastv
      FROM (SELECT *, {_versions('p_partkey % 3 = 0', 'p_partkey % 9 = 0', 'p_partkey % 8 = 5')} AS v FROM part))""")

cte("b_cat", [], """
SELECT DISTINCT CASE WHEN b2 = '22' THEN lower(substring(p_type, 1, 2)) || '_22 '
    ELSE substring(p_type, 1, 2) || '_' || CASE WHEN b2 = '13' THEN 'NA' ELSE b2 END END AS id,
  CASE WHEN b2 = '22' THEN lower(p_type) || ' ' ELSE p_type END AS cat, p_brand AS subcat,
  CASE WHEN CAST(b2 AS INTEGER) % 2 = 0 THEN 'Yes' ELSE 'No' END AS maintenance
FROM (SELECT p_type, p_brand, lpad(split_part(p_brand, '#', 2), 2, '0') AS b2 FROM part)""")

cte("b_sales", [], f"""
SELECT 'SO' || CAST(ok AS VARCHAR) AS sls_ord_num,
  CASE WHEN (ok + ln) % 10 = 3 THEN ' ' || spelt || ' ' ELSE spelt END AS sls_prd_key,
  CAST(CASE WHEN ok % 29 = 0 THEN NULL WHEN ok % 31 = 0 THEN -(o_custkey + 1) ELSE o_custkey END
       AS BIGINT) AS sls_cust_id,
  CASE WHEN ok % 17 = 0 THEN '0' WHEN ok % 41 = 0 THEN '20101399'
       WHEN ok % 43 = 0 THEN substring(odt, 1, 7) ELSE odt END AS sls_order_dt,
  strftime(l_shipdate, '%Y%m%d') AS sls_ship_dt,
  strftime(CAST(o_orderdate AS DATE) + 30, '%Y%m%d') AS sls_due_dt,
  CASE WHEN ok % 23 = 0 THEN NULL WHEN ok % 37 = 0 THEN '0' WHEN ok % 13 = 0 THEN '-' || sales
       ELSE sales END AS sls_sales,
  CASE WHEN ok % 53 = 0 THEN '0' WHEN ok % 59 = 0 THEN '-' || CAST(qty AS VARCHAR)
       ELSE CAST(qty AS VARCHAR) END AS sls_quantity,
  CASE WHEN ok % 11 = 0 THEN NULL WHEN ok % 47 = 0 THEN '0' WHEN ok % 14 = 0 THEN '-' || price
       ELSE price END AS sls_price
FROM (SELECT *, CASE WHEN (ok + ln) % 12 = 5 THEN lower(key) ELSE key END AS spelt FROM (SELECT *,
        CASE WHEN ok % 19 = 7 THEN 'ZZ-' ELSE 'PK-' END || CAST(l_partkey AS VARCHAR) AS key,
        strftime(o_orderdate, '%Y%m%d') AS odt,
        {_money_text('pc')} AS price,
        CASE WHEN ok % 3 = 1 THEN {_money_text('cents')} ELSE {_money_text('pc * qty')} END AS sales
      FROM (SELECT l.l_orderkey AS ok, l.l_linenumber AS ln, l.l_partkey, l.l_shipdate,
              o.o_custkey, o.o_orderdate, CAST(l.l_quantity AS INTEGER) AS qty,
              CAST(floor(l.l_extendedprice * 100 + 0.5) AS BIGINT) AS cents,
              CAST(floor(l.l_extendedprice * 100 + 0.5) AS BIGINT) // CAST(l.l_quantity AS INTEGER) AS pc
            FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey)))""")

cte("b_az12", [], f"""
SELECT CASE WHEN k % 2 = 0 THEN 'NAS' ELSE '' END || CASE WHEN k % 17 = 0 THEN lower({_aw('k')}) ELSE {_aw('k')} END AS cid,
  CASE WHEN k % 47 = 0 THEN NULL
       WHEN k % 41 = 0 THEN strftime(DATE '2030-01-01' + CAST(k % 365 AS INTEGER), '%Y-%m-%d')
       WHEN k % 43 = 0 THEN strftime(DATE '1915-01-01' + CAST(k % 365 AS INTEGER), '%Y-%m-%d')
       ELSE strftime(DATE '1940-01-01' + CAST((k * 37) % 20000 AS INTEGER), '%Y-%m-%d') END AS bdate,
  {_pick('k', ['F', 'Female', 'M ', 'male', ' ', None, 'M', 'F', 'f'])} AS gen
FROM (SELECT c_custkey AS k FROM customer)""")

cte("b_loc", [], """
SELECT 'AW-' || printf('%08d', c_custkey) AS cid,
  CASE WHEN c_custkey % 53 = 0 THEN NULL WHEN c_custkey % 59 = 0 THEN '  '
       WHEN c_nationkey = 0 THEN 'DE'
       WHEN c_nationkey = 1 THEN CASE WHEN c_custkey % 2 = 0 THEN 'US' ELSE 'USA' END
       WHEN c_nationkey = 2 THEN ' ' || n_name || ' '
       WHEN c_custkey % 61 = 0 THEN lower(n_name)
       ELSE n_name END AS cntry
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")

# ------------------------------------------------------------------ silver
CUST_ORDER = ("cst_create_date DESC NULLS LAST, cst_key DESC NULLS LAST, "
              "cst_firstname DESC NULLS LAST, cst_lastname DESC NULLS LAST, "
              "cst_marital_status DESC NULLS LAST, cst_gndr DESC NULLS LAST")

cte("c_trim", ["b_cust"], """
SELECT cst_id, trim(cst_key) AS cst_key, trim(cst_firstname) AS cst_firstname,
  trim(cst_lastname) AS cst_lastname, trim(cst_marital_status) AS cst_marital_status,
  trim(cst_gndr) AS cst_gndr, cst_create_date FROM b_cust""")

cte("c_latest", ["c_trim"], f"""
SELECT cst_id, cst_key, cst_firstname, cst_lastname, cst_marital_status, cst_gndr, cst_create_date
FROM (SELECT *, row_number() OVER (PARTITION BY cst_id ORDER BY {CUST_ORDER}) AS rn FROM c_trim)
WHERE rn = 1""")

cte("s_cust", ["c_latest"], f"""
SELECT cst_id, cst_key, cst_firstname, cst_lastname,
  {_norm_case('cst_marital_status', MARITAL)} AS cst_marital_status,
  {_norm_case('cst_gndr', GENDER)} AS cst_gndr, cst_create_date, {LOAD_TS} AS dwh_create_dt
FROM c_latest WHERE cst_id IS NOT NULL""")

cte("p_trim", ["b_prd"], """
SELECT prd_id, trim(prd_key) AS prd_key, trim(prd_nm) AS prd_nm, trim(prd_cost) AS prd_cost,
  trim(prd_line) AS prd_line, prd_start_dt FROM b_prd WHERE prd_id IS NOT NULL""")

cte("p_hist", ["p_trim"], """
SELECT *, CAST(lead(prd_start_dt) OVER (PARTITION BY lower(rtrim(prd_key)) ORDER BY prd_start_dt NULLS FIRST, prd_id) - 1 AS DATE)
  AS prd_end_dt FROM p_trim""")

cte("s_prd", ["p_hist"], f"""
SELECT prd_id, replace(substring(prd_key, 1, 5), '-', '_') AS cat_id,
  replace(substring(prd_key, 7), '-', '_') AS prd_key, prd_nm,
  abs(coalesce(CAST(prd_cost AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)))) AS prd_cost,
  CASE WHEN upper(prd_line) = 'M' THEN 'Mountain' WHEN upper(prd_line) = 'R' THEN 'Road'
       WHEN upper(prd_line) = 'T' THEN 'Touring' WHEN upper(prd_line) = 'S' THEN 'Other sales'
       ELSE 'Unknown' END AS prd_line,
  prd_start_dt, prd_end_dt, {LOAD_TS} AS dwh_create_dt
FROM p_hist""")

cte("ss1", ["b_sales"], f"""
SELECT sls_ord_num, replace(trim(sls_prd_key), '-', '_') AS sls_prd_key, sls_cust_id,
  {_pd('sls_order_dt')} AS sls_order_dt, {_pd('sls_ship_dt')} AS sls_ship_dt,
  {_pd('sls_due_dt')} AS sls_due_dt,
  abs(CAST(sls_sales AS DECIMAL(18,2))) AS sls_sales,
  abs(CAST(sls_quantity AS INTEGER)) AS sls_quantity,
  abs(CAST(sls_price AS DECIMAL(18,2))) AS sls_price
FROM b_sales""")

cte("ss_avg", ["ss1"], """
SELECT CASE WHEN count(d) > 0 THEN CAST(sum(d) // count(d) AS INTEGER) END AS avg_days
FROM (SELECT date_diff('day', sls_order_dt, sls_ship_dt) AS d FROM ss1)""")

cte("ss2", ["ss1", "ss_avg"], """
SELECT sls_ord_num, sls_prd_key, sls_cust_id,
  coalesce(sls_order_dt, CAST(sls_ship_dt - (SELECT avg_days FROM ss_avg) AS DATE)) AS sls_order_dt,
  sls_order_dt AS parsed_order_dt, sls_ship_dt, sls_due_dt,
  NULLIF(sls_sales, 0) AS s, NULLIF(sls_quantity, 0) AS q, NULLIF(sls_price, 0) AS p
FROM ss1""")

REPAIR_SALES = "CAST(CASE WHEN s IS NULL OR s != q * p THEN q * p ELSE s END AS DECIMAL(18,2))"
REPAIR_PRICE = ("CAST(CASE WHEN p IS NULL THEN "
                "CAST(CAST((2 * CAST(s * 100 AS HUGEINT) + q) // (2 * q) AS DECIMAL(30,0)) "
                "* CAST('0.01' AS DECIMAL(3,2)) AS DECIMAL(18,2)) ELSE p END AS DECIMAL(18,2))")

cte("s_sales", ["ss2"], f"""
SELECT sls_ord_num, sls_prd_key, sls_cust_id, sls_order_dt, sls_ship_dt, sls_due_dt,
  {REPAIR_SALES} AS sls_sales, q AS sls_quantity, {REPAIR_PRICE} AS sls_price,
  {LOAD_TS} AS dwh_create_dt
FROM ss2""")

cte("s_az12", ["b_az12"], f"""
SELECT CASE WHEN upper(cid) LIKE 'NAS%' THEN substring(cid, 4) ELSE cid END AS cid,
  CASE WHEN CAST(bdate AS DATE) > {AS_OF} THEN NULL ELSE CAST(bdate AS DATE) END AS bdate,
  {_gen('gen')} AS gen, {LOAD_TS} AS dwh_create_dt
FROM b_az12""")

cte("s_loc", ["b_loc"], f"""
SELECT replace(cid, '-', '') AS cid, {_cntry('cntry')} AS cntry, {LOAD_TS} AS dwh_create_dt
FROM b_loc""")

cte("s_cat", ["b_cat"], f"SELECT id, cat, subcat, maintenance, {LOAD_TS} AS dwh_create_dt FROM b_cat")

# ------------------------------------------------------------------ gold
GENDER_MERGE = "CASE WHEN ci.cst_gndr != 'Unknown' THEN ci.cst_gndr ELSE coalesce(ca.gen, 'Unknown') END"

cte("g_cust_j", ["s_cust", "s_az12", "s_loc"], f"""
SELECT ci.cst_id AS customer_id, ci.cst_key AS customer_number, ci.cst_firstname AS firstname,
  ci.cst_lastname AS lastname, la.cntry AS country, {GENDER_MERGE} AS gender,
  ci.cst_marital_status AS marital_status, ca.bdate AS birthdate, ci.cst_create_date AS create_date
FROM s_cust ci LEFT JOIN s_az12 ca ON {same('ci.cst_key', 'ca.cid')} LEFT JOIN s_loc la ON {same('ci.cst_key', 'la.cid')}""")

cte("g_cust", ["g_cust_j"], """
SELECT CAST(row_number() OVER (ORDER BY customer_id NULLS FIRST) AS BIGINT) AS customer_key, *
FROM g_cust_j""")

cte("g_prd_j", ["s_prd", "s_cat"], f"""
SELECT pi.prd_id AS product_id, pi.prd_key AS product_number, pi.prd_nm AS product_name,
  pi.cat_id AS category_id, pc.cat AS category, pc.subcat AS subcategory,
  pc.maintenance AS maintenance, pi.prd_cost AS cost, pi.prd_line AS product_line,
  pi.prd_start_dt AS start_date
FROM s_prd pi LEFT JOIN s_cat pc ON {same('pi.cat_id', 'pc.id')} WHERE pi.prd_end_dt IS NULL""")

cte("g_prd", ["g_prd_j"], """
SELECT CAST(row_number() OVER (ORDER BY start_date NULLS FIRST, product_id NULLS FIRST) AS BIGINT)
  AS product_key, * FROM g_prd_j""")

cte("g_fact", ["s_sales", "g_cust", "g_prd"], f"""
SELECT sd.sls_ord_num AS order_number, pv.product_key, cv.customer_key,
  sd.sls_order_dt AS order_date, sd.sls_ship_dt AS shipping_date, sd.sls_due_dt AS due_date,
  sd.sls_sales AS sales_amount, sd.sls_quantity AS quantity, sd.sls_price AS price
FROM s_sales sd LEFT JOIN g_cust cv ON sd.sls_cust_id = cv.customer_id
LEFT JOIN g_prd pv ON {same('sd.sls_prd_key', 'pv.product_number')}""")

cte("f_year", ["g_fact"], """
SELECT CAST(year(order_date) AS INTEGER) AS order_year,
  CAST(sum(sales_amount) AS DECIMAL(38,2)) AS total_sales, sum(price) AS ps, count(price) AS pn
FROM g_fact GROUP BY 1""")

cte("f_prod_year", ["g_fact", "g_prd"], """
SELECT min(p.product_name) AS product, CAST(year(f.order_date) AS INTEGER) AS order_year,
  CAST(sum(coalesce(f.sales_amount, 0)) AS DECIMAL(38,2)) AS sales
FROM g_fact f LEFT JOIN g_prd p ON f.product_key = p.product_key
GROUP BY lower(rtrim(p.product_name)), 2""")

cte("f_cat", ["g_fact", "g_prd"], """
SELECT min(p.category) AS category, CAST(sum(f.sales_amount) AS DECIMAL(38,2)) AS total_sales
FROM g_fact f LEFT JOIN g_prd p ON f.product_key = p.product_key GROUP BY lower(rtrim(p.category))""")

cte("f_prod_name", ["g_fact", "g_prd"], """
SELECT min(p.product_name) AS product_name, CAST(sum(f.sales_amount) AS DECIMAL(38,2)) AS total_revenue
FROM g_fact f LEFT JOIN g_prd p ON f.product_key = p.product_key GROUP BY lower(rtrim(p.product_name))""")


def sql(body: str, needs: list[str]) -> str:
    """Prefix ``body`` with the CTEs it needs, in dependency order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTE[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    withs = ",\n".join(f"{n} AS ({CTE[n][0]}\n)" for n in order)
    return f"WITH {withs}\n{body}" if order else body


def _money(x: str) -> str:
    return f"format('${{:,.2f}}', {x})"


def _n0(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


AGE = f"CAST(date_diff('year', birthdate, {AS_OF}) AS INTEGER)"
SALES_CASE = ("CASE WHEN sales - prev_sales > 0 THEN '\U0001F7E2' WHEN sales - prev_sales < 0 "
              "THEN '\U0001F534' ELSE '\U0001F7E1' END")

Q: dict[str, str] = {}

# ---------------------------------------------------------------- S
Q["S8"] = sql("SELECT * FROM g_cust ORDER BY customer_key LIMIT 10", ["g_cust"])

# ---------------------------------------------------------------- T
Q["T1"] = sql("SELECT * FROM c_trim", ["c_trim"])
Q["T2"] = sql(f"""SELECT cst_id, cst_marital_status,
  {_norm_case('trim(cst_marital_status)', MARITAL)} AS marital_label, cst_gndr,
  {_norm_case('trim(cst_gndr)', GENDER)} AS gender_label FROM b_cust""", ["b_cust"])
Q["T3"] = sql("SELECT * FROM c_latest", ["c_latest"])
Q["T4"] = sql("SELECT * FROM b_cust WHERE cst_id IS NOT NULL", ["b_cust"])
Q["T5"] = sql("""SELECT prd_id, trim(prd_key) AS prd_key,
  replace(substring(trim(prd_key), 1, 5), '-', '_') AS cat_id FROM b_prd""", ["b_prd"])
Q["T6"] = sql("""SELECT prd_id, trim(prd_key) AS prd_key,
  replace(substring(trim(prd_key), 7), '-', '_') AS product_number FROM b_prd""", ["b_prd"])
Q["T7"] = sql("""SELECT sls_ord_num, sls_prd_key,
  replace(trim(sls_prd_key), '-', '_') AS normalised_key FROM b_sales""", ["b_sales"])
Q["T8"] = sql("""SELECT prd_id, prd_cost,
  abs(coalesce(CAST(trim(prd_cost) AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2)))) AS clean_cost
  FROM b_prd""", ["b_prd"])
Q["T9"] = sql(f"""SELECT prd_id, prd_line,
  {_norm_case('trim(prd_line)', LINES)} AS line_label FROM b_prd""", ["b_prd"])
Q["T10"] = sql("SELECT prd_id, prd_key, prd_start_dt, prd_end_dt FROM p_hist", ["p_hist"])
Q["T11"] = sql("SELECT sls_ord_num, sls_order_dt, sls_ship_dt, sls_due_dt FROM ss1", ["ss1"])
Q["T12"] = sql("SELECT sls_ord_num, sls_sales, sls_quantity, sls_price FROM ss1", ["ss1"])
Q["T13"] = sql("""SELECT sls_ord_num, s AS sls_sales, q AS sls_quantity, p AS sls_price
  FROM ss2""", ["ss2"])
Q["T14"] = sql("SELECT sls_ord_num, sls_order_dt, sls_ship_dt FROM ss2", ["ss2"])
Q["T15"] = sql(f"SELECT sls_ord_num, {REPAIR_SALES} AS sls_sales FROM ss2", ["ss2"])
Q["T16"] = sql(f"SELECT sls_ord_num, {REPAIR_PRICE} AS sls_price FROM ss2", ["ss2"])
Q["T17"] = sql("""SELECT cid, CASE WHEN upper(cid) LIKE 'NAS%' THEN substring(cid, 4) ELSE cid END
  AS clean_cid FROM b_az12""", ["b_az12"])
Q["T18"] = sql(f"""SELECT cid, bdate, CASE WHEN CAST(bdate AS DATE) > {AS_OF} THEN NULL
  ELSE CAST(bdate AS DATE) END AS clean_bdate FROM b_az12""", ["b_az12"])
Q["T19"] = sql(f"SELECT cid, gen, {_gen('gen')} AS clean_gen FROM b_az12", ["b_az12"])
Q["T20"] = sql("SELECT cid, replace(cid, '-', '') AS clean_cid FROM b_loc", ["b_loc"])
Q["T21"] = sql(f"SELECT cid, cntry, {_cntry('cntry')} AS clean_cntry FROM b_loc", ["b_loc"])
Q["T22"] = sql("SELECT id, cat, subcat, maintenance FROM b_cat", ["b_cat"])
Q["T23"] = sql(f"SELECT id, cat, subcat, maintenance, {LOAD_TS} AS dwh_create_dt FROM b_cat",
               ["b_cat"])

# ---------------------------------------------------------------- L
for _i, _t in enumerate(["s_cust", "s_prd", "s_sales", "s_az12", "s_loc", "s_cat"], start=1):
    Q[f"L{_i}"] = sql(f"SELECT * FROM {_t}", [_t])

# ---------------------------------------------------------------- G
Q["G1"] = sql("SELECT * FROM g_cust_j", ["g_cust_j"])
Q["G2"] = sql(f"""SELECT ci.cst_id AS customer_id, ci.cst_gndr AS crm_gender, ca.gen AS erp_gender,
  {GENDER_MERGE} AS gender FROM s_cust ci LEFT JOIN s_az12 ca ON {same('ci.cst_key', 'ca.cid')}""",
              ["s_cust", "s_az12"])
Q["G3"] = sql("SELECT * FROM g_prd_j", ["g_prd_j"])
Q["G4"] = sql("SELECT product_key, product_id, start_date FROM g_prd", ["g_prd"])
Q["G4_customers"] = sql("SELECT customer_key, customer_id FROM g_cust", ["g_cust"])
Q["G5"] = sql("SELECT * FROM g_fact", ["g_fact"])

# ---------------------------------------------------------------- E
Q["E1"] = sql("SELECT min(country) AS country FROM g_cust GROUP BY lower(rtrim(country))", ["g_cust"])
Q["E2"] = sql("""SELECT min(category) AS category, min(subcategory) AS subcategory FROM g_prd
  GROUP BY lower(rtrim(category)), lower(rtrim(subcategory))""", ["g_prd"])
Q["E3"] = sql("""SELECT min(order_date) AS first_order, max(order_date) AS last_order,
  CAST(date_diff('year', min(order_date), max(order_date)) AS INTEGER) AS order_range_years,
  CAST(date_diff('month', min(order_date), max(order_date)) AS INTEGER) AS order_range_months
  FROM g_fact""", ["g_fact"])
Q["E4"] = sql(f"""
(SELECT firstname || ' ' || lastname AS customer, 'Oldest Customer' AS label, birthdate, {AGE} AS age
 FROM g_cust WHERE birthdate IS NOT NULL ORDER BY birthdate ASC, customer_key ASC LIMIT 1)
UNION ALL
(SELECT firstname || ' ' || lastname AS customer, 'Youngest Customer' AS label, birthdate, {AGE} AS age
 FROM g_cust WHERE birthdate IS NOT NULL ORDER BY birthdate DESC, customer_key ASC LIMIT 1)""",
              ["g_cust"])
Q["E5"] = sql("SELECT CAST(sum(sales_amount) AS DECIMAL(38,2)) AS total_sales FROM g_fact", ["g_fact"])
Q["E6"] = sql("SELECT CAST(sum(quantity) AS BIGINT) AS total_quantity FROM g_fact", ["g_fact"])
Q["E7"] = sql(f"SELECT {xratio('sum(price)', 'count(price)')} AS avg_price FROM g_fact", ["g_fact"])
Q["E8"] = sql("""SELECT count(order_number) AS total_orders,
  count(DISTINCT order_number) AS distinct_total_orders FROM g_fact""", ["g_fact"])
Q["E9"] = sql("""SELECT (SELECT count(product_key) FROM g_prd) AS total_products,
  (SELECT count(DISTINCT product_key) FROM g_fact) AS sold_products""", ["g_prd", "g_fact"])
Q["E10"] = sql("""SELECT (SELECT count(customer_key) FROM g_cust) AS total_customers,
  (SELECT count(DISTINCT customer_key) FROM g_fact) AS customers_with_orders""", ["g_cust", "g_fact"])
Q["E11"] = sql(f"""
SELECT 'Total Sales' AS measure_name, {_money('CAST(sum(sales_amount) AS DECIMAL(38,2))')} AS measure_value FROM g_fact
UNION ALL SELECT 'Average Price', {_money(xratio('sum(price)', 'count(price)', places=2))} FROM g_fact
UNION ALL SELECT 'Total Quantity Sold', {_n0('sum(quantity)')} FROM g_fact
UNION ALL SELECT 'Total Orders', {_n0('count(DISTINCT order_number)')} FROM g_fact
UNION ALL SELECT 'Total Products', {_n0('count(product_key)')} FROM g_prd
UNION ALL SELECT 'Product Variety Sold', {_n0('count(DISTINCT product_key)')} FROM g_fact
UNION ALL SELECT 'Total Customers', {_n0('count(customer_key)')} FROM g_cust
UNION ALL SELECT 'Customers with Orders', {_n0('count(DISTINCT customer_key)')} FROM g_fact""",
               ["g_fact", "g_prd", "g_cust"])
Q["E12"] = sql("""SELECT min(country) AS country, count(customer_key) AS total_customers FROM g_cust
  GROUP BY lower(rtrim(country))""",
               ["g_cust"])
Q["E13"] = sql("""SELECT min(gender) AS gender, count(customer_key) AS total_customers FROM g_cust
  GROUP BY lower(rtrim(gender))""",
               ["g_cust"])
Q["E14"] = sql("""SELECT min(category) AS category, count(product_id) AS total_products FROM g_prd
  GROUP BY lower(rtrim(category))""",
               ["g_prd"])
Q["E15"] = sql(f"""SELECT min(category) AS category, {xratio('sum(cost)', 'count(cost)')} AS avg_cost
  FROM g_prd GROUP BY lower(rtrim(category))""", ["g_prd"])
Q["E16"] = sql("SELECT category, total_sales AS total_revenue FROM f_cat", ["f_cat"])
Q["E17"] = sql("""SELECT c.firstname || ' ' || c.lastname AS customer, c.customer_key,
  CAST(sum(f.sales_amount) AS DECIMAL(38,2)) AS total_revenue
  FROM g_fact f LEFT JOIN g_cust c ON f.customer_key = c.customer_key
  GROUP BY c.customer_key, c.firstname, c.lastname""", ["g_fact", "g_cust"])
Q["E18"] = sql("""SELECT min(c.country) AS country, CAST(sum(f.quantity) AS BIGINT) AS sold_items_distribution
  FROM g_fact f LEFT JOIN g_cust c ON f.customer_key = c.customer_key GROUP BY lower(rtrim(c.country))""",
               ["g_fact", "g_cust"])
Q["E19"] = sql("""SELECT product_name, total_revenue FROM f_prod_name
  ORDER BY total_revenue DESC NULLS LAST, product_name ASC NULLS FIRST LIMIT 5""", ["f_prod_name"])
Q["E20"] = sql("""SELECT product_name, total_revenue FROM f_prod_name
  ORDER BY total_revenue ASC NULLS FIRST, product_name ASC NULLS FIRST LIMIT 5""", ["f_prod_name"])

# ---------------------------------------------------------------- A
Q["A1"] = sql("""SELECT CAST(year(order_date) AS INTEGER) AS order_year,
  CAST(sum(sales_amount) AS DECIMAL(38,2)) AS total_sales,
  count(DISTINCT customer_key) AS total_customers, CAST(sum(quantity) AS BIGINT) AS total_quantity
  FROM g_fact GROUP BY 1""", ["g_fact"])
Q["A2"] = sql("""SELECT order_month, total_sales, total_customers, total_quantity,
  CAST(row_number() OVER (ORDER BY total_sales DESC NULLS LAST, m ASC NULLS FIRST) AS INTEGER)
    AS sales_rank
  FROM (SELECT month(order_date) AS m, strftime(order_date, '%b') AS order_month,
          CAST(sum(sales_amount) AS DECIMAL(38,2)) AS total_sales,
          count(DISTINCT customer_key) AS total_customers,
          CAST(sum(quantity) AS BIGINT) AS total_quantity
        FROM g_fact GROUP BY 1, 2)""", ["g_fact"])
Q["A3"] = sql("""SELECT order_year, total_sales,
  CAST(sum(total_sales) OVER (ORDER BY order_year NULLS FIRST
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS running_total_sales
  FROM f_year""", ["f_year"])
Q["A4"] = sql(f"""SELECT order_year, {xratio('ps', 'pn')} AS avg_price,
  CAST(round(avg(CAST(ps AS DOUBLE) / pn) OVER (ORDER BY order_year NULLS FIRST
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS DECIMAL(38,4)) AS moving_avg_price
  FROM f_year""", ["f_year"])
Q["A5"] = sql(f"""SELECT order_year, product, sales, prev_sales,
  CAST(sales - prev_sales AS DECIMAL(38,2)) AS yoy_change, {SALES_CASE} AS yoy_trend
  FROM (SELECT *, lag(sales) OVER (PARTITION BY lower(rtrim(product)) ORDER BY order_year NULLS FIRST) AS prev_sales
        FROM f_prod_year)""", ["f_prod_year"])
Q["A6"] = sql(f"""SELECT order_year, product, sales, {xratio('s', 'n')} AS avg_sales,
  {xratio('sales * n - s', 'n')} AS variance,
  CASE WHEN sales * n - s > 0 THEN '\U0001F7E2' WHEN sales * n - s < 0 THEN '\U0001F534'
       ELSE '\U0001F7E1' END AS performance_trend
  FROM (SELECT *, sum(sales) OVER (PARTITION BY lower(rtrim(product))) AS s,
          count(sales) OVER (PARTITION BY lower(rtrim(product))) AS n FROM f_prod_year)""", ["f_prod_year"])
Q["A7"] = sql(f"""SELECT category, total_sales, grand_total,
  {xratio('total_sales * 100', 'grand_total', 2, 2, 2)} AS sales_percentage
  FROM (SELECT *, CAST((SELECT sum(total_sales) FROM f_cat) AS DECIMAL(38,2)) AS grand_total
        FROM f_cat)""", ["f_cat"])
Q["A8"] = sql(f"""SELECT CASE WHEN cost < {E1} THEN 'Below {E1}'
  WHEN cost BETWEEN {E1} AND {E2} THEN '{E1}-{E2}' WHEN cost BETWEEN {E2} AND {E3} THEN '{E2}-{E3}'
  ELSE 'Above {E3}' END AS cost_range, count(product_key) AS total_products
  FROM g_prd GROUP BY 1""", ["g_prd"])
Q["A9"] = sql(f"""SELECT CASE WHEN lifespan >= {MONTHS} AND spend > {SPEND} THEN 'VIP'
  WHEN lifespan >= {MONTHS} AND spend <= {SPEND} THEN 'Regular' ELSE 'New' END AS customer_segment,
  count(customer_key) AS total_customers
  FROM (SELECT customer_key,
          CAST(date_diff('month', min(order_date), max(order_date)) AS INTEGER) AS lifespan,
          sum(sales_amount) AS spend FROM g_fact GROUP BY customer_key)
  GROUP BY 1""", ["g_fact"])

# ---------------------------------------------------------------- R
Q["R1"] = sql(f"""
SELECT customer_key, customer_number, customer_name, age,
  CASE WHEN age < 18 THEN 'Under 18' WHEN age BETWEEN 18 AND 25 THEN '18-25'
       WHEN age BETWEEN 26 AND 35 THEN '26-35' WHEN age BETWEEN 36 AND 45 THEN '36-45'
       WHEN age BETWEEN 46 AND 60 THEN '46-60' ELSE '60+' END AS age_group,
  CASE WHEN lifespan_months >= {MONTHS} AND total_sales > {SPEND} THEN 'VIP'
       WHEN lifespan_months >= {MONTHS} AND total_sales <= {SPEND} THEN 'Regular'
       ELSE 'New' END AS customer_segment,
  total_orders, total_sales, total_quantity, total_products, last_order_date, lifespan_months,
  recency_months,
  CASE WHEN recency_months <= 1 THEN 'Active' WHEN recency_months BETWEEN 2 AND 6 THEN 'At Risk'
       ELSE 'Inactive' END AS customer_activity_status,
  CASE WHEN total_sales = 0 OR total_orders = 0 THEN CAST(0 AS DECIMAL(38,4))
       ELSE {xratio('total_sales', 'total_orders')} END AS avg_order_value,
  CASE WHEN lifespan_months = 0 THEN CAST(total_sales AS DECIMAL(38,4))
       ELSE {xratio('total_sales', 'lifespan_months')} END AS avg_monthly_spend
FROM (
  SELECT customer_key, customer_number, customer_name, age,
    count(DISTINCT order_number) AS total_orders,
    CAST(sum(sales_amount) AS DECIMAL(38,2)) AS total_sales,
    CAST(sum(quantity) AS BIGINT) AS total_quantity,
    count(DISTINCT product_key) AS total_products, max(order_date) AS last_order_date,
    CAST(date_diff('month', min(order_date), max(order_date)) AS INTEGER) AS lifespan_months,
    CAST(date_diff('month', max(order_date), {AS_OF}) AS INTEGER) AS recency_months
  FROM (SELECT f.order_number, f.product_key, f.order_date, f.sales_amount, f.quantity,
          d.customer_key, d.customer_number,
          concat(coalesce(d.firstname, ''), ' ', coalesce(d.lastname, '')) AS customer_name,
          CAST(date_diff('year', d.birthdate, {AS_OF}) AS INTEGER) AS age
        FROM g_fact f LEFT JOIN g_cust d ON f.customer_key = d.customer_key)
  GROUP BY customer_key, customer_number, customer_name, age)""", ["g_fact", "g_cust"])

cte("r2_agg", ["g_fact", "g_prd"], f"""
  SELECT product_key, product_name, category, subcategory, cost,
    CAST(date_diff('month', min(order_date), max(order_date)) AS INTEGER) AS lifespan,
    max(order_date) AS last_sale_date, count(DISTINCT order_number) AS total_orders,
    count(DISTINCT customer_key) AS total_customers,
    CAST(sum(sales_amount) AS DECIMAL(38,2)) AS total_sales,
    CAST(sum(quantity) AS BIGINT) AS total_quantity,
    {xratio('sum(r)', 'CAST(count(r) AS HUGEINT) * 10000000000000', 0, 0, 1)} AS avg_selling_price
  FROM (SELECT f.*, CASE WHEN NULLIF(f.quantity, 0) IS NOT NULL THEN
          (2 * CAST(f.sales_amount * 100 AS HUGEINT) * 100000000000 + f.quantity) // (2 * f.quantity)
          END AS r FROM (SELECT f.order_number, f.order_date, f.customer_key, f.sales_amount, f.quantity,
          p.product_key, p.product_name, p.category, p.subcategory, p.cost
        FROM g_fact f LEFT JOIN g_prd p ON f.product_key = p.product_key
        WHERE f.order_date IS NOT NULL) f)
  GROUP BY product_key, product_name, category, subcategory, cost""")
Q["R2"] = sql(f"""
SELECT product_key, product_name, category, subcategory, cost, last_sale_date,
  CAST(date_diff('month', last_sale_date, {AS_OF}) AS INTEGER) AS recency_in_months,
  CASE WHEN total_sales > {HIGH} THEN 'High-Performer' WHEN total_sales >= {MID} THEN 'Mid-Range'
       ELSE 'Low-Performer' END AS product_segment,
  lifespan, total_orders, total_sales, total_quantity, total_customers, avg_selling_price,
  CASE WHEN total_orders = 0 THEN CAST(0 AS DECIMAL(38,4))
       ELSE {xratio('total_sales', 'total_orders')} END AS avg_order_revenue,
  CASE WHEN lifespan = 0 THEN CAST(total_sales AS DECIMAL(38,4))
       ELSE {xratio('total_sales', 'lifespan')} END AS avg_monthly_revenue,
  CASE WHEN t = 0 THEN CAST(0 AS DECIMAL(38,6))
       ELSE {xratio('total_sales', 't', 2, 2, 6)} END AS revenue_contribution
FROM (SELECT *, (SELECT CAST(sum(total_sales) AS DECIMAL(38,2)) FROM r2_agg) AS t FROM r2_agg)""",
              ["r2_agg"])

# ---------------------------------------------------------------- Q
Q["Q1"] = sql("""SELECT cst_id, count(*) AS cnt FROM b_cust GROUP BY cst_id
  HAVING count(*) > 1 OR cst_id IS NULL""", ["b_cust"])
Q["Q2"] = sql("""SELECT * FROM b_cust WHERE cst_id IN
  (SELECT cst_id FROM b_cust GROUP BY cst_id HAVING count(*) > 1) OR cst_id IS NULL""", ["b_cust"])
Q["Q3"] = sql("""SELECT cst_firstname, cst_gndr FROM b_cust
  WHERE cst_firstname != trim(cst_firstname) OR cst_gndr != trim(cst_gndr)""", ["b_cust"])
Q["Q4"] = sql("SELECT min(cst_marital_status) AS cst_marital_status FROM b_cust GROUP BY lower(rtrim(cst_marital_status))", ["b_cust"])
Q["Q4_silver"] = sql("""SELECT min(cst_gndr) AS cst_gndr FROM s_cust
  WHERE lower(rtrim(cst_gndr)) NOT IN ('male', 'female', 'unknown') OR cst_gndr IS NULL GROUP BY lower(rtrim(cst_gndr))""", ["s_cust"])
Q["Q5"] = sql("""SELECT prd_cost FROM b_prd WHERE CAST(prd_cost AS DECIMAL(18,2)) IS NULL
  OR CAST(prd_cost AS DECIMAL(18,2)) < 0""", ["b_prd"])
Q["Q6"] = sql("SELECT * FROM b_prd WHERE prd_end_dt < prd_start_dt", ["b_prd"])
Q["Q7"] = sql("SELECT * FROM b_prd WHERE prd_start_dt IS NULL OR prd_end_dt IS NULL", ["b_prd"])
Q["Q8"] = sql("""SELECT * FROM b_sales WHERE sls_cust_id IS NULL OR sls_prd_key IS NULL
  OR sls_ord_num IS NULL""", ["b_sales"])
Q["Q9"] = sql("""SELECT min(sls_ord_num) AS sls_ord_num, count(*) AS cnt FROM b_sales GROUP BY lower(rtrim(sls_ord_num))
  HAVING count(*) > 1""", ["b_sales"])
Q["Q10"] = sql("""SELECT * FROM s_sales s WHERE NOT EXISTS
  (SELECT 1 FROM s_cust i WHERE s.sls_cust_id = i.cst_id)""", ["s_sales", "s_cust"])
Q["Q11"] = sql("""SELECT prd_id, prd_key, cat_id FROM s_prd
  WHERE lower(rtrim(cat_id)) NOT IN (SELECT lower(rtrim(id)) FROM b_cat WHERE id IS NOT NULL)""", ["s_prd", "b_cat"])
Q["Q12"] = sql("SELECT * FROM b_sales WHERE NOT EXISTS (SELECT 1 FROM s_prd)", ["b_sales", "s_prd"])
Q["Q13"] = sql(f"""SELECT * FROM b_sales WHERE {_pd('sls_order_dt')} IS NULL
  OR {_pd('sls_ship_dt')} IS NULL OR {_pd('sls_due_dt')} IS NULL""", ["b_sales"])
Q["Q14"] = sql("""SELECT * FROM b_sales WHERE sls_ship_dt < sls_order_dt
  OR sls_due_dt < sls_order_dt OR sls_due_dt < sls_ship_dt""", ["b_sales"])
_b15 = " OR ".join(f"{_pd(c)} < DATE '2000-01-01' OR {_pd(c)} > {AS_OF}"
                   for c in ("sls_ship_dt", "sls_due_dt", "sls_order_dt"))
Q["Q15"] = sql(f"SELECT * FROM b_sales WHERE {_b15}", ["b_sales"])
_s, _q, _p = ("CAST(sls_sales AS DECIMAL(18,2))", "CAST(sls_quantity AS DECIMAL(18,2))",
              "CAST(sls_price AS DECIMAL(18,2))")
Q["Q16"] = sql(f"""SELECT * FROM b_sales WHERE {_s} != {_q} * {_p}
  OR {_s} IS NULL OR {_s} = 0 OR {_q} IS NULL OR {_q} = 0 OR {_p} IS NULL OR {_p} = 0""",
               ["b_sales"])
Q["Q16_silver"] = sql("""SELECT * FROM s_sales WHERE sls_sales != sls_quantity * sls_price
  OR sls_sales IS NULL OR sls_sales = 0 OR sls_sales < 0
  OR sls_quantity IS NULL OR sls_quantity = 0 OR sls_quantity < 0
  OR sls_price IS NULL OR sls_price = 0 OR sls_price < 0""", ["s_sales"])
Q["Q17"] = sql("""SELECT CAST(length(rtrim(cid)) AS INTEGER) AS len, count(*) AS occurrence
  FROM b_az12 GROUP BY 1""", ["b_az12"])
Q["Q18"] = sql(f"""SELECT bdate AS bdate_old,
  CASE WHEN CAST(bdate AS DATE) > {AS_OF} THEN NULL ELSE CAST(bdate AS DATE) END AS validated_bdate
  FROM b_az12 WHERE CAST(bdate AS DATE) < DATE '1925-01-01' OR CAST(bdate AS DATE) > {AS_OF}""",
               ["b_az12"])
Q["Q19"] = sql(f"SELECT DISTINCT gen AS raw, {_gen('gen')} AS standard FROM b_az12", ["b_az12"])
Q["Q20"] = sql("""SELECT * FROM b_cat WHERE id IS NULL
  OR NOT regexp_matches(id, '^.{2}_.{2}$')""", ["b_cat"])
Q["Q21"] = sql("""SELECT 'bronze' AS layer, count(*) AS row_num
  FROM (SELECT DISTINCT cst_id FROM b_cust WHERE cst_id IS NOT NULL)
  UNION ALL SELECT 'silver' AS layer, count(*) AS row_num FROM s_cust""", ["b_cust", "s_cust"])
Q["Q22"] = sql("SELECT count(*) = 1 AS populated FROM (SELECT 1 FROM s_cust LIMIT 1)", ["s_cust"])
Q["Q23"] = sql(f"""SELECT ci.cst_id, count(*) AS cnt FROM s_cust ci
  LEFT JOIN s_az12 ca ON {same('ci.cst_key', 'ca.cid')} LEFT JOIN s_loc la ON {same('ci.cst_key', 'la.cid')}
  GROUP BY ci.cst_id HAVING count(*) > 1""", ["s_cust", "s_az12", "s_loc"])
Q["Q24"] = sql(f"""SELECT p.cat_id, c.id FROM s_prd p LEFT JOIN s_cat c ON {same('p.cat_id', 'c.id')}
  WHERE c.id IS NULL""", ["s_prd", "s_cat"])
Q["Q25"] = sql("""SELECT f.*, c.customer_key AS dim_customer_key, c.* EXCLUDE (customer_key),
  p.product_key AS dim_product_key, p.* EXCLUDE (product_key)
  FROM g_fact f LEFT JOIN g_cust c ON f.customer_key = c.customer_key
  LEFT JOIN g_prd p ON f.product_key = p.product_key
  WHERE f.customer_key IS NULL OR f.product_key IS NULL""", ["g_fact", "g_cust", "g_prd"])
_len = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, 'string' AS expected_type, 'string' AS actual_type, "
    f"{n} AS declared_length, CAST(max(length(rtrim({c}))) AS INTEGER) AS max_length, "
    f"true AS declared_nullable, count(*) FILTER ({c} IS NULL) AS null_count FROM s_sales"
    for c, n in (("sls_ord_num", 50), ("sls_prd_key", 50)))
Q["Q26"] = sql(f"""SELECT *, 'too long' AS problem FROM ({_len}) WHERE max_length > declared_length""",
               ["s_sales"])
Q["Q27"] = sql("""SELECT min(cat) AS cat, min(subcat) AS subcat FROM b_cat
  GROUP BY lower(rtrim(cat)), lower(rtrim(subcat))""", ["b_cat"])
Q["Q28"] = sql(f"""SELECT min(ci.cst_gndr) AS cst_gndr, min(ca.gen) AS gen, min({GENDER_MERGE}) AS new_gen
  FROM s_cust ci LEFT JOIN s_az12 ca ON {same('ci.cst_key', 'ca.cid')} LEFT JOIN s_loc la ON {same('ci.cst_key', 'la.cid')}
  GROUP BY lower(rtrim(ci.cst_gndr)), lower(rtrim(ca.gen)), lower(rtrim({GENDER_MERGE}))""",
               ["s_cust", "s_az12", "s_loc"])
Q["Q29"] = sql("SELECT min(gender) AS gender, count(*) AS count FROM g_cust GROUP BY lower(rtrim(gender))", ["g_cust"])
Q["Q30"] = sql(f"""SELECT * FROM s_sales s WHERE EXISTS
  (SELECT 1 FROM s_prd p WHERE {same('s.sls_prd_key', 'p.prd_key')})""", ["s_sales", "s_prd"])
Q["Q31"] = sql("""
SELECT prd_id, prd_key, prd_cost, prd_start_dt, prd_end_dt,
  CAST(lead(prd_start_dt) OVER (PARTITION BY lower(rtrim(prd_key)) ORDER BY prd_start_dt NULLS FIRST, prd_id) - 1 AS DATE)
    AS derived_prd_end_dt
FROM b_prd""", ["b_prd"])

# second instances of the checks
Q["Q1_silver"] = sql("""SELECT cst_id, count(*) AS cnt FROM s_cust GROUP BY cst_id
  HAVING count(*) > 1 OR cst_id IS NULL""", ["s_cust"])
Q["Q3_silver"] = sql("""SELECT cst_key, cst_firstname, cst_lastname, cst_marital_status, cst_gndr
  FROM s_cust WHERE cst_key != trim(cst_key) OR cst_firstname != trim(cst_firstname)
  OR cst_lastname != trim(cst_lastname) OR cst_marital_status != trim(cst_marital_status)
  OR cst_gndr != trim(cst_gndr)""", ["s_cust"])
Q["Q10_loc"] = sql(f"""SELECT c.cid FROM (SELECT replace(cid, '-', '') AS cid FROM b_loc) c
  WHERE NOT EXISTS (SELECT 1 FROM s_az12 s WHERE {same('s.cid', 'c.cid')})""", ["b_loc", "s_az12"])
Q["Q11_loc"] = sql("""SELECT * FROM s_loc WHERE lower(rtrim(cid)) NOT IN (SELECT lower(rtrim(cid)) FROM s_az12)""",
                   ["s_loc", "s_az12"])
Q["Q13_bdate"] = sql("SELECT * FROM b_az12 WHERE TRY_CAST(bdate AS DATE) IS NULL", ["b_az12"])
Q["Q17_silver"] = sql("""SELECT CAST(length(rtrim(cid)) AS INTEGER) AS len, count(*) AS occurrence
  FROM s_az12 GROUP BY 1""", ["s_az12"])
Q["Q21_sales"] = sql("""SELECT 'bronze' AS layer, count(*) AS row_num FROM b_sales
  UNION ALL SELECT 'silver' AS layer, count(*) AS row_num FROM s_sales""", ["b_sales", "s_sales"])
Q["Q23_products"] = sql(f"""SELECT min(pi.prd_key) AS prd_key, count(*) AS cnt FROM s_prd pi
  LEFT JOIN s_cat pc ON {same('pi.cat_id', 'pc.id')} WHERE pi.prd_end_dt IS NULL
  GROUP BY lower(rtrim(pi.prd_key)) HAVING count(*) > 1""", ["s_prd", "s_cat"])


def oracle_sql() -> dict[str, str]:
    return dict(Q)
