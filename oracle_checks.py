"""DuckDB SQL for the layer check lists, the load services and the display forms.

Every check of the three layers is counted by a statement of its own over the
CTEs of ``oracle_sql``; the Spark side takes many of them in one pass.
"""

from __future__ import annotations

from oracle_sql import AS_OF, _cntry, _gen, _pd, Q, sql

_dates = ("sls_order_dt", "sls_ship_dt", "sls_due_dt")
_money = {c: f"CAST({c} AS DECIMAL(18,2))" for c in ("sls_sales", "sls_quantity", "sls_price")}
_s, _q, _p = _money.values()


def _rows(table: str, where: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {where}"


def _distinct(table: str, cols: str, where: str = "true") -> str:
    return f"SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {table} WHERE {where})"


def _groups(table: str, *cols: str, where: str = "true") -> str:
    """Distinct values of text that ignore case and trailing spaces."""
    return _distinct(table, ", ".join(f"lower(rtrim({c})) AS {c}" for c in cols), where)


def _bad_keys(table: str, key: str) -> str:
    return f"SELECT count(*) FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1 OR {key} IS NULL)"


def _untrimmed(table: str, *cols: str) -> str:
    return _rows(table, " OR ".join(f"{c} != trim({c})" for c in cols))


def _null(table: str, *cols: str) -> str:
    return _rows(table, " OR ".join(f"{c} IS NULL" for c in cols))


def _lengths(table: str, col: str) -> str:
    return _distinct(table, f"length(rtrim({col}))")


def _same_count(a: str, b: str) -> str:
    return f"SELECT CASE WHEN ({a}) = ({b}) THEN 1 ELSE 2 END"


def _outside(table: str, col: str, *allowed: str) -> str:
    names = ", ".join(f"'{a.lower()}'" for a in allowed)
    return _groups(table, col, where=f"lower(rtrim({col})) NOT IN ({names}) OR {col} IS NULL")


NO, ALLOWED, EQUAL, ONE, REPORT = "no_rows", "allowed_values", "equal_counts", "one_row", "report"
TABLES = ["crm_cust_info", "crm_prd_info", "crm_sales_details", "erp_cust_az12", "erp_loc_a101", "erp_px_cat_g1v2"]
_short = dict(zip(TABLES, ["cust", "prd", "sales", "az12", "loc", "cat"], strict=True))
CUST, PRD, SALES, AZ, LOC, CAT = TABLES
_some = "SELECT count(*) FROM {} WHERE NOT EXISTS (SELECT 1 FROM {})"
_exists = "SELECT count(*) FROM {} a WHERE {}EXISTS (SELECT 1 FROM {} b WHERE a.{} = b.{})"
_exists_text = _exists.replace("a.{} = b.{}", "lower(rtrim(a.{})) = lower(rtrim(b.{}))")

# no text of the driver tables is longer than declared, and the stored types are the declared ones
_declared = {
    "bronze": {CUST: dict(cst_key=50, cst_firstname=50, cst_lastname=50, cst_marital_status=50, cst_gndr=50),
               PRD: dict(prd_key=100, prd_nm=255, prd_cost=50, prd_line=10),
               SALES: dict(sls_ord_num=50, sls_prd_key=100, sls_order_dt=20, sls_ship_dt=20, sls_due_dt=20, sls_sales=50,
                           sls_quantity=50, sls_price=50),
               AZ: dict(cid=50, bdate=20, gen=10), LOC: dict(cid=50, cntry=50),
               CAT: dict(id=50, cat=50, subcat=100, maintenance=10)},
    "silver": {CUST: dict(cst_key=50, cst_firstname=50, cst_lastname=50, cst_marital_status=20, cst_gndr=10),
               PRD: dict(cat_id=50, prd_key=50, prd_nm=100, prd_line=50), SALES: dict(sls_ord_num=50, sls_prd_key=50),
               AZ: dict(cid=50, gen=10), LOC: dict(cid=50, cntry=50),
               CAT: dict(id=50, cat=50, subcat=100, maintenance=10)}}


def _schema(layer: str) -> list[tuple]:
    out = []
    for t in TABLES:
        longer = " + ".join(f"CAST(coalesce(max(length(rtrim({c}))) > {n}, false) AS INTEGER)"
                            for c, n in _declared[layer][t].items())
        out.append((f"Q26 {t}", layer, t, NO, "declared schema", f"SELECT {longer} FROM {layer[0]}_{_short[t]}"))
    return out


BRONZE = _schema("bronze") + [
    ("Q1 cst_id", "bronze", CUST, NO, "unique, not NULL", _bad_keys("b_cust", "cst_id")),
    ("Q2 cst_id rows", "bronze", CUST, REPORT, "rows behind Q1", _rows(
        "b_cust", "cst_id IN (SELECT cst_id FROM b_cust GROUP BY cst_id HAVING count(*) > 1) OR cst_id IS NULL")),
    ("Q3 cst_firstname", "bronze", CUST, NO, "trimmed", _untrimmed("b_cust", "cst_firstname")),
    ("Q3 cst_gndr", "bronze", CUST, NO, "trimmed", _untrimmed("b_cust", "cst_gndr")),
    ("Q4 cst_gndr", "bronze", CUST, REPORT, "codes", _groups("b_cust", "cst_gndr")),
    ("Q4 cst_marital_status", "bronze", CUST, REPORT, "codes", _groups("b_cust", "cst_marital_status")),
    ("Q1 prd_id", "bronze", PRD, NO, "unique, not NULL", _bad_keys("b_prd", "prd_id")),
    ("Q5 prd_cost", "bronze", PRD, NO, "set, not negative", _rows(
        "b_prd", "prd_cost IS NULL OR CAST(prd_cost AS DECIMAL(18,2)) < 0")),
    ("Q4 prd_line", "bronze", PRD, REPORT, "codes", _groups("b_prd", "prd_line")),
    ("Q6 prd dates", "bronze", PRD, NO, "end not before start", _rows("b_prd", "prd_end_dt < prd_start_dt")),
    ("Q7 prd dates", "bronze", PRD, NO, "dates set", _null("b_prd", "prd_start_dt", "prd_end_dt")),
    ("Q31 prd history", "bronze", PRD, REPORT, "derived end dates", "SELECT count(*) FROM b_prd"),
    ("Q9 sls_ord_num", "bronze", SALES, REPORT, "lines per order",
     "SELECT count(*) FROM (SELECT lower(rtrim(sls_ord_num)) FROM b_sales GROUP BY 1 HAVING count(*) > 1)"),
    ("Q8 sales keys", "bronze", SALES, NO, "keys set", _null("b_sales", "sls_cust_id", "sls_prd_key", "sls_ord_num")),
    ("Q3 sls_prd_key", "bronze", SALES, NO, "trimmed", _untrimmed("b_sales", "sls_prd_key")),
    ("Q12 products loaded", "bronze,silver", SALES, NO, "parent not empty", _some.format("b_sales", "s_prd")),
    ("Q12 customers loaded", "bronze,silver", SALES, NO, "parent not empty", _some.format("b_sales", "s_cust")),
    ("Q13 sales dates", "bronze", SALES, NO, "dates parse", _rows("b_sales", " OR ".join(f"{_pd(c)} IS NULL" for c in _dates))),
    ("Q7 sales dates", "bronze", SALES, NO, "dates set", _null("b_sales", *_dates)),
    ("Q14 sales dates", "bronze", SALES, NO, "order <= ship <= due", _rows(
        "b_sales", "sls_ship_dt < sls_order_dt OR sls_due_dt < sls_order_dt OR sls_due_dt < sls_ship_dt")),
    ("Q15 sales dates", "bronze", SALES, NO, "2000-01-01 .. as_of", _rows(
        "b_sales", " OR ".join(f"{_pd(c)} < DATE '2000-01-01' OR {_pd(c)} > {AS_OF}" for c in _dates))),
    ("Q16 sales measures", "bronze", SALES, NO, "sales = quantity * price, all set", _rows(
        "b_sales", f"{_s} != {_q} * {_p} OR " + " OR ".join(f"{x} IS NULL OR {x} = 0" for x in (_s, _q, _p)))),
    ("Q17 az12 cid", "bronze", AZ, REPORT, "id lengths", _lengths("b_az12", "cid")),
    ("Q13 bdate", "bronze", AZ, NO, "dates parse", _rows("b_az12", "TRY_CAST(bdate AS DATE) IS NULL")),
    ("Q18 bdate", "bronze", AZ, REPORT, "1925-01-01 .. as_of", _rows(
        "b_az12", f"CAST(bdate AS DATE) < DATE '1925-01-01' OR CAST(bdate AS DATE) > {AS_OF}")),
    ("Q19 gen", "bronze", AZ, REPORT, "standard values", _distinct("b_az12", f"gen, {_gen('gen')} AS g")),
    ("Q17 loc cid", "bronze", LOC, REPORT, "id lengths", _lengths("b_loc", "cid")),
    ("Q10 loc cid", "bronze,silver", LOC, NO, "customer exists", _rows(
        "b_loc l", "NOT EXISTS (SELECT 1 FROM s_az12 s WHERE lower(rtrim(s.cid)) = lower(rtrim(replace(l.cid, '-', ''))))")),
    ("Q19 cntry", "bronze", LOC, REPORT, "standard values", _distinct("b_loc", f"cntry, {_cntry('cntry')} AS c")),
    ("Q11 cat id", "bronze,silver", CAT, REPORT, "used by a product", _rows("b_cat", "lower(rtrim(id)) NOT IN (SELECT lower(rtrim(cat_id)) FROM s_prd)")),
    ("Q20 cat id", "bronze", CAT, NO, "form XX_YY", _rows("b_cat", "id IS NULL OR NOT regexp_matches(id, '^.{2}_.{2}$')")),
    ("Q3 cat text", "bronze", CAT, NO, "trimmed", _untrimmed("b_cat", "cat", "subcat", "maintenance")),
    ("Q27 cat pairs", "bronze", CAT, REPORT, "pairs", _groups("b_cat", "cat", "subcat")),
    ("Q4 maintenance", "bronze", CAT, REPORT, "codes", _groups("b_cat", "maintenance")),
]

_bronze_rows = {CUST: _distinct("b_cust", "cst_id", "cst_id IS NOT NULL"), PRD: _rows("b_prd", "prd_id IS NOT NULL")}

SILVER = _schema("silver") + [
    (f"Q21 {t}", "bronze,silver", t, EQUAL, "bronze rows = silver rows", _same_count(
        _bronze_rows.get(t, f"SELECT count(*) FROM b_{_short[t]}"), f"SELECT count(*) FROM s_{_short[t]}")) for t in TABLES
] + [
    ("Q22 crm_cust_info", "silver", CUST, ONE, "populated", "SELECT 1"),
    ("Q1 cst_id", "silver", CUST, NO, "unique, not NULL", _bad_keys("s_cust", "cst_id")),
    ("Q3 cst text", "silver", CUST, NO, "trimmed", _untrimmed(
        "s_cust", "cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr")),
    ("Q4 cst_gndr", "silver", CUST, ALLOWED, "Male, Female, Unknown", _outside("s_cust", "cst_gndr", "Male", "Female", "Unknown")),
    ("Q4 cst_marital_status", "silver", CUST, ALLOWED, "Single, Married, Unknown",
     _outside("s_cust", "cst_marital_status", "Single", "Married", "Unknown")),
    ("Q7 bronze marital", "bronze", CUST, REPORT, "NULL codes in the source", _null("b_cust", "cst_marital_status")),
    ("Q1 prd_id", "silver", PRD, NO, "unique, not NULL", _bad_keys("s_prd", "prd_id")),
    ("Q3 prd text", "silver", PRD, NO, "trimmed", _untrimmed("s_prd", "prd_key", "prd_nm")),
    ("Q4 prd_line", "silver", PRD, ALLOWED, "Mountain, Road, Touring, Other sales, Unknown",
     _outside("s_prd", "prd_line", "Mountain", "Road", "Touring", "Other sales", "Unknown")),
    ("Q11 cat_id", "bronze,silver", PRD, REPORT, "category exists", _rows(
        "s_prd", "lower(rtrim(cat_id)) NOT IN (SELECT lower(rtrim(id)) FROM b_cat WHERE id IS NOT NULL)")),
    ("Q10 cat_id", "bronze,silver", PRD, REPORT, "category exists", _exists_text.format("s_prd", "NOT ", "b_cat", "cat_id", "id")),
    ("Q5 prd_cost", "silver", PRD, NO, "set, not negative", _rows("s_prd", "prd_cost IS NULL OR prd_cost < 0")),
    ("Q6 prd dates", "silver", PRD, NO, "end not before start", _rows("s_prd", "prd_end_dt < prd_start_dt")),
    ("Q30 sls_prd_key", "silver", SALES, REPORT, "product exists", _exists_text.format("s_sales", "", "s_prd", "sls_prd_key", "prd_key")),
    ("Q10 sls_prd_key", "silver", SALES, NO, "product exists", _exists_text.format("s_sales", "NOT ", "s_prd", "sls_prd_key", "prd_key")),
    ("Q10 sls_cust_id", "silver", SALES, NO, "customer exists", _exists.format("s_sales", "NOT ", "s_cust", "sls_cust_id", "cst_id")),
    ("Q14 sales dates", "silver", SALES, NO, "order <= ship <= due", _rows(
        "s_sales", "sls_ship_dt < sls_order_dt OR sls_due_dt < sls_order_dt OR sls_due_dt < sls_ship_dt")),
    ("Q16 sales measures", "silver", SALES, NO, "sales = quantity * price, all positive", _rows(
        "s_sales", "sls_sales != sls_quantity * sls_price OR " + " OR ".join(
            f"{c} IS NULL OR {c} <= 0" for c in ("sls_sales", "sls_quantity", "sls_price")))),
    ("Q17 az12 cid", "silver", AZ, ONE, "one id length", _lengths("s_az12", "cid")),
    ("Q18 bdate", "silver", AZ, NO, "not in the future", _rows("s_az12", f"bdate > {AS_OF}")),
    ("Q4 gen", "silver", AZ, ALLOWED, "Male, Female, Unknown", _outside("s_az12", "gen", "Male", "Female", "Unknown")),
    ("Q17 loc cid", "silver", LOC, ONE, "one id length", _lengths("s_loc", "cid")),
    ("Q11 loc cid", "silver", LOC, REPORT, "customer exists", _rows("s_loc", "lower(rtrim(cid)) NOT IN (SELECT lower(rtrim(cid)) FROM s_az12)")),
    ("Q4 cntry", "silver", LOC, REPORT, "countries", _groups("s_loc", "cntry")),
    ("Q11 cat id", "silver", CAT, REPORT, "used by a product", _rows("s_cat", "lower(rtrim(id)) NOT IN (SELECT lower(rtrim(cat_id)) FROM s_prd)")),
    ("Q4 cat", "bronze", CAT, REPORT, "values", _groups("b_cat", "cat")),
    ("Q4 subcat", "bronze", CAT, REPORT, "values", _groups("b_cat", "subcat")),
    ("Q4 maintenance", "bronze", CAT, REPORT, "values", _groups("b_cat", "maintenance")),
]

GOLD = [
    ("Q23 customers", "silver", "dim_customers", NO, "no key repeats after the joins",
     "SELECT count(*) FROM (SELECT customer_id FROM g_cust_j GROUP BY 1 HAVING count(*) > 1)"),
    ("Q28 gender merge", "silver", "dim_customers", REPORT, "CRM first, then ERP, else Unknown",
     "SELECT count(*) FROM (SELECT DISTINCT ci.cst_gndr, ca.gen FROM s_cust ci LEFT JOIN s_az12 ca ON lower(rtrim(ci.cst_key)) = lower(rtrim(ca.cid)))"),
    ("Q29 gender", "gold", "dim_customers", REPORT, "three values", _groups("g_cust", "gender")),
    ("Q24 cat_id", "silver", "dim_products", REPORT, "categories without a match",
     _exists_text.format("s_prd", "NOT ", "s_cat", "cat_id", "id")),
    ("Q23 products", "silver", "dim_products", NO, "no key repeats after the join",
     "SELECT count(*) FROM (SELECT lower(rtrim(product_number)) FROM g_prd_j GROUP BY 1 HAVING count(*) > 1)"),
    ("Q25 fact keys", "gold", "fact_sales", NO, "every fact row has both keys", _null("g_fact", "customer_key", "product_key")),
]

_B = [f"b_{x}" for x in _short.values()]
_S = [f"s_{x}" for x in _short.values()]


def _checks(rows: list[tuple], needs: list[str]) -> str:
    one = " UNION ALL ".join(
        f"""SELECT '{name}' AS "check", '{layers}' AS layers, '{table}' AS "table", '{kind}' AS kind,
        '{expectation}' AS expectation, CAST(({count}) AS BIGINT) AS found"""
        for name, layers, table, kind, expectation, count in rows)
    return sql(f"""SELECT *, CASE WHEN kind IN ('no_rows', 'allowed_values') THEN found = 0
      WHEN kind IN ('one_row', 'equal_counts') THEN found = 1 ELSE true END AS passed FROM ({one})""", needs)


Q["checks_bronze"] = _checks(BRONZE, [*_B, "s_prd", "s_cust", "s_az12"])
Q["checks_silver"] = _checks(SILVER, [*_B, *_S])
Q["checks_gold"] = _checks(GOLD, ["g_cust", "g_cust_j", "g_prd_j", "g_fact", "s_cust", "s_az12", "s_prd", "s_cat"])

# ------------------------------------------------- checks that find something
Q["Q4_allowed"] = sql("""SELECT min(cst_gndr) AS cst_gndr FROM b_cust
  WHERE lower(rtrim(cst_gndr)) NOT IN ('m', 'f') OR cst_gndr IS NULL GROUP BY lower(rtrim(cst_gndr))""", ["b_cust"])
Q["Q11_null_list"] = sql("""
SELECT 'plain' AS flavour, count(*) AS found FROM s_sales WHERE sls_cust_id NOT IN (SELECT cst_id FROM b_cust)
UNION ALL SELECT 'NULLs skipped', count(*) FROM s_sales
  WHERE sls_cust_id NOT IN (SELECT cst_id FROM b_cust WHERE cst_id IS NOT NULL)""", ["s_sales", "b_cust"])
Q["Q12_empty"] = sql("""SELECT * FROM b_prd
  WHERE NOT EXISTS (SELECT 1 FROM s_prd WHERE prd_cost < 0)""", ["b_prd", "s_prd"])
Q["Q20_keys"] = sql("""SELECT * FROM b_cust WHERE cst_key IS NULL
  OR NOT regexp_matches(cst_key, '^AW[0-9]{8}$')""", ["b_cust"])
Q["Q23_bronze"] = sql("""SELECT ci.cst_id, count(*) AS cnt FROM b_cust ci LEFT JOIN s_az12 ca ON lower(trim(ci.cst_key)) = lower(rtrim(ca.cid))
  GROUP BY ci.cst_id HAVING count(*) > 1""", ["b_cust", "s_az12"])
Q["Q26_types"] = sql("""
SELECT 'cat_id' AS column_name, 'string' AS expected_type, NULL::VARCHAR AS actual_type, 50 AS declared_length,
  NULL::INTEGER AS max_length, true AS declared_nullable, NULL::BIGINT AS null_count, 'missing' AS problem
UNION ALL SELECT 'prd_cost', 'decimal(18,2)', 'string', NULL, CAST((SELECT max(length(rtrim(prd_cost))) FROM b_prd) AS INTEGER),
  true, (SELECT count(*) FROM b_prd WHERE prd_cost IS NULL), 'type'
UNION ALL SELECT 'dwh_create_dt', 'timestamp_ntz', NULL, NULL, NULL, true, NULL, 'missing'""", ["b_prd"])
Q["Q26_nulls"] = sql("""
SELECT * FROM (
  SELECT 'prd_id' AS column_name, 'bigint' AS expected_type, 'bigint' AS actual_type, NULL::INTEGER AS declared_length,
    NULL::INTEGER AS max_length, false AS declared_nullable, count(*) FILTER (prd_id IS NULL) AS null_count, 'NULLs' AS problem FROM b_prd
  UNION ALL SELECT 'prd_cost', 'string', 'string', 50, CAST(max(length(rtrim(prd_cost))) AS INTEGER), false,
    count(*) FILTER (prd_cost IS NULL), 'NULLs' FROM b_prd
  UNION ALL SELECT 'prd_line', 'string', 'string', 10, CAST(max(length(rtrim(prd_line))) AS INTEGER), false,
    count(*) FILTER (prd_line IS NULL), 'NULLs' FROM b_prd
  UNION ALL SELECT 'prd_end_dt', 'date', 'date', NULL, NULL, false, count(*) FILTER (prd_end_dt IS NULL), 'NULLs' FROM b_prd)
WHERE null_count > 0""", ["b_prd"])

# ------------------------------------------------------------- load services
Q["S3"] = sql("SELECT * FROM s_cat", ["s_cat"])
_loaded = ([("bronze", t, f"b_{_short[t]}") for t in TABLES] + [("silver", t, f"s_{_short[t]}") for t in TABLES]
           + [("gold", "dim_customers", "g_cust"), ("gold", "dim_products", "g_prd"), ("gold", "fact_sales", "g_fact")])
_audit = " UNION ALL ".join(f"SELECT '{lay}' AS layer, '{t}' AS \"table\", count(*) AS rows FROM {cte}" for lay, t, cte in _loaded)
Q["S4"] = sql(f"""SELECT layer, "table", rows, 'ok' AS status FROM ({_audit})
  UNION ALL SELECT layer, '*', CAST(sum(rows) AS BIGINT), 'ok' FROM ({_audit}) GROUP BY layer""",
              [*_B, *_S, "g_cust", "g_prd", "g_fact"])
Q["S6_customers"], Q["S6_products"] = Q["R1"], Q["R2"]
_columns = {
    "bronze": {CUST: "cst_id bigint, cst_key string, cst_firstname string, cst_lastname string, cst_marital_status string, "
                     "cst_gndr string, cst_create_date date",
               PRD: "prd_id bigint, prd_key string, prd_nm string, prd_cost string, prd_line string, prd_start_dt date, prd_end_dt date",
               SALES: "sls_ord_num string, sls_prd_key string, sls_cust_id bigint, sls_order_dt string, sls_ship_dt string, "
                      "sls_due_dt string, sls_sales string, sls_quantity string, sls_price string",
               AZ: "cid string, bdate string, gen string", LOC: "cid string, cntry string",
               CAT: "id string, cat string, subcat string, maintenance string"},
    "silver": {CUST: "cst_id bigint, cst_key string, cst_firstname string, cst_lastname string, cst_marital_status string, "
                     "cst_gndr string, cst_create_date date, dwh_create_dt timestamp_ntz",
               PRD: "prd_id bigint, cat_id string, prd_key string, prd_nm string, prd_cost decimal(18;2), prd_line string, "
                    "prd_start_dt date, prd_end_dt date, dwh_create_dt timestamp_ntz",
               SALES: "sls_ord_num string, sls_prd_key string, sls_cust_id bigint, sls_order_dt date, sls_ship_dt date, "
                      "sls_due_dt date, sls_sales decimal(18;2), sls_quantity int, sls_price decimal(18;2), dwh_create_dt timestamp_ntz",
               AZ: "cid string, bdate date, gen string, dwh_create_dt timestamp_ntz",
               LOC: "cid string, cntry string, dwh_create_dt timestamp_ntz",
               CAT: "id string, cat string, subcat string, maintenance string, dwh_create_dt timestamp_ntz"},
    "gold": {"dim_customers": "customer_key bigint, customer_id bigint, customer_number string, firstname string, lastname string, "
                              "country string, gender string, marital_status string, birthdate date, create_date date",
             "dim_products": "product_key bigint, product_id bigint, product_number string, product_name string, category_id string, "
                             "category string, subcategory string, maintenance string, cost decimal(18;2), product_line string, "
                             "start_date date",
             "fact_sales": "order_number string, product_key bigint, customer_key bigint, order_date date, shipping_date date, "
                           "due_date date, sales_amount decimal(18;2), quantity int, price decimal(18;2)"}}
_listed = [(lay, t, i, *c.split()) for lay, ts in _columns.items() for t, cols in ts.items()
           for i, c in enumerate(cols.split(", "), start=1)]
_cte_of = {(lay, t): cte for lay, t, cte in _loaded}
_values = ", ".join(f"('{lay}', '{t}', {i}, '{c}', '{kind.replace(';', ',')}', {_declared.get(lay, {}).get(t, {}).get(c, 'NULL')})"
                    for lay, t, i, c, kind in _listed)
_found = " UNION ALL ".join(
    f"SELECT '{lay}' AS table_schema, '{t}' AS table_name, unnest([" + ", ".join(
        f"{{'c': '{c}', 'n': count(*) FILTER ({c} IS NULL), 'l': "
        + (f"CAST(max(length(rtrim({c}))) AS INTEGER)" if kind == "string" else "CAST(NULL AS INTEGER)") + "}"
        for lay_, t_, _, c, kind in _listed if (lay_, t_) == (lay, t)) + f"]) AS f FROM {cte}"
    for (lay, t), cte in _cte_of.items())
Q["S9_columns"] = sql(f"""SELECT v.*, true AS is_nullable, m.f.n AS null_count, m.f.l AS longest
  FROM (VALUES {_values}) v(table_schema, table_name, ordinal_position, column_name, data_type, character_maximum_length)
  JOIN ({_found}) m ON v.table_schema = m.table_schema AND v.table_name = m.table_name AND v.column_name = m.f.c""",
                      [*_B, *_S, "g_cust", "g_prd", "g_fact"])
Q["S9_tables"] = sql(" UNION ALL ".join(
    f"SELECT '{lay}' AS table_schema, '{t}' AS table_name, '{'VIEW' if lay == 'gold' else 'BASE TABLE'}' AS table_type, "
    f"count(*) AS row_count FROM {cte}" for (lay, t), cte in _cte_of.items()), [*_B, *_S, "g_cust", "g_prd", "g_fact"])


# -------------------------------------------------------------- display forms
def _currency(x: str) -> str:
    """FORMAT(x, 'C', 'en-US'): a negative amount in parentheses."""
    body = f"'$' || format('{{:,.2f}}', abs(round({x}, 2))::DOUBLE)"
    return f"(CASE WHEN {x} IS NULL THEN NULL WHEN round({x}, 2) < 0 THEN '(' || {body} || ')' ELSE {body} END)"


Q["A5_display"] = f"""SELECT order_year, product, yoy_trend, {_currency('sales')} AS sales,
  {_currency('prev_sales')} AS prev_sales, {_currency('yoy_change')} AS yoy_change FROM ({Q['A5']})"""
Q["A7_display"] = f"""SELECT category, {_currency('total_sales')} AS total_sales, {_currency('grand_total')} AS grand_total,
  format('{{:,.2f}}', sales_percentage::DOUBLE) || '%' AS sales_percentage FROM ({Q['A7']})"""


def oracle_sql() -> dict[str, str]:
    return dict(Q)
