"""Entry point 3: the quality checks of each layer as one list.

``checks_for(wh, layer)`` returns the checks of the bronze, silver or gold
check script, each tagged with the layers it reads (the bronze checks also read
silver tables) and with what is expected; ``run_checks`` then gives one row per
check.  The checks are the Q operators of ``layerstar.operators.quality``.
"""

from __future__ import annotations

from functools import lru_cache, partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerstar.functions import clean as C
from layerstar.functions.text import folded, same_text
from layerstar.operators import quality as Q
from layerstar.plans.silver import CUST_TEXT
from layerstar.sources.schemas import BRONZE, MAX_LENGTH, SILVER

NO, ALLOWED, EQUAL, ONE, REPORT = "no_rows", "allowed_values", "equal_counts", "one_row", "report"


def _c(name, layers, table, kind, expectation, df: DataFrame) -> Q.Check:
    return Q.Check(name, tuple(layers), table, kind, expectation, df)


def _r(name, layers, table, kind, expectation, source: DataFrame, where: Column) -> Q.Check:
    return Q.row_check(name, tuple(layers), table, kind, expectation, source, where)


def _schema(layer: str, table: str, df: DataFrame, declared) -> Q.Check:
    return Q.Check(f"Q26 {table}", (layer,), table, NO, "declared schema", source=df, scan=f"{layer}.{table}",
                   measure=Q.schema_mismatch_count(df, declared[table], MAX_LENGTH[layer][table]))


CUST, PRD, SALES, AZ, LOC, CAT = SILVER


def _tables(wh):
    """(layer, table) -> its frame, opened once for all checks of a list."""
    return lru_cache(maxsize=None)(lambda layer, table: wh._t(layer, table))


def _sides(home: str, t):
    """How the key checks name their keys: of a column (of ``home`` unless said otherwise), of all rows,
    of text lengths, of raw values (by bytes) and of pairs."""
    def k(table, col, layer=home):
        return Q.side(f"{layer}.{table}", t(layer, table), col)

    def every(layer, table):
        return Q.side(f"{layer}.{table}", t(layer, table), "rows", key="''")

    def length(layer, table, col):
        return Q.side(f"{layer}.{table}", t(layer, table), f"length of {col}", key=f"cast(length(rtrim(`{col}`)) AS STRING)")

    def mapped(layer, table, col, fn):
        return Q.side(f"{layer}.{table}", t(layer, table), f"{col} mapped", key=F.to_json(F.array(F.col(col), fn(F.col(col)))))

    def pair(layer, table, *cols):
        return Q.side(f"{layer}.{table}", t(layer, table), *cols)
    return k, every, length, mapped, pair


def row_checks(layer: str, table: str, df: DataFrame, as_of) -> list[Q.Check]:
    """The checks of one table that look at single rows (and its declared schema, Q26).  ``df`` is the
    stored table, or the rows about to be written to it."""
    declared = BRONZE if layer == "bronze" else SILVER
    r = lambda name, kind, expectation, where: _r(name, [layer], table, kind, expectation, df, where)
    dates = ["sls_order_dt", "sls_ship_dt", "sls_due_dt"]
    rows = {
        ("bronze", CUST): lambda: [
            r("Q3 cst_firstname", NO, "trimmed", Q.is_untrimmed("cst_firstname")),
            r("Q3 cst_gndr", NO, "trimmed", Q.is_untrimmed("cst_gndr"))],
        ("bronze", PRD): lambda: [
            r("Q5 prd_cost", NO, "set, not negative", Q.is_null_or_negative(df, "prd_cost")),
            r("Q6 prd dates", NO, "end not before start", Q.is_reversed("prd_start_dt", "prd_end_dt")),
            r("Q7 prd dates", NO, "dates set", Q.has_null(["prd_start_dt", "prd_end_dt"]))],
        ("bronze", SALES): lambda: [
            r("Q8 sales keys", NO, "keys set", Q.has_null(["sls_cust_id", "sls_prd_key", "sls_ord_num"])),
            r("Q3 sls_prd_key", NO, "trimmed", Q.is_untrimmed("sls_prd_key")),
            r("Q13 sales dates", NO, "dates parse", Q.is_unparsable(dates)),
            r("Q7 sales dates", NO, "dates set", Q.has_null(dates)),
            r("Q14 sales dates", NO, "order <= ship <= due", Q.is_out_of_order(*dates)),
            r("Q15 sales dates", NO, "2000-01-01 .. as_of", Q.is_out_of_bounds(df, dates, as_of)),
            r("Q16 sales measures", NO, "sales = quantity * price, all set",
              Q.is_mismatch(df, "sls_sales", "sls_quantity", "sls_price"))],
        ("bronze", AZ): lambda: [
            r("Q13 bdate", NO, "dates parse", Q.is_unparsable("bdate", fmt=None)),
            r("Q18 bdate", REPORT, "1925-01-01 .. as_of", Q.is_unlikely_birthdate("bdate", as_of))],
        ("bronze", CAT): lambda: [
            r("Q20 cat id", NO, "form XX_YY", Q.is_not_like("id")),
            r("Q3 cat text", NO, "trimmed", Q.is_untrimmed(["cat", "subcat", "maintenance"]))],
        ("silver", CUST): lambda: [
            Q.Check("Q22 crm_cust_info", ("silver",), CUST, ONE, "populated", source=df, scan=f"silver.{CUST}",
                    measure=F.least(F.count(F.lit(1)), F.lit(1))),
            r("Q3 cst text", NO, "trimmed", Q.is_untrimmed(CUST_TEXT))],
        ("silver", PRD): lambda: [
            r("Q3 prd text", NO, "trimmed", Q.is_untrimmed(["prd_key", "prd_nm"])),
            r("Q5 prd_cost", NO, "set, not negative", Q.is_null_or_negative(df, "prd_cost")),
            r("Q6 prd dates", NO, "end not before start", Q.is_reversed("prd_start_dt", "prd_end_dt"))],
        ("silver", SALES): lambda: [
            r("Q14 sales dates", NO, "order <= ship <= due", Q.is_out_of_order(*dates)),
            r("Q16 sales measures", NO, "sales = quantity * price, all positive",
              Q.is_mismatch(df, "sls_sales", "sls_quantity", "sls_price", negatives=True))],
        ("silver", AZ): lambda: [r("Q18 bdate", NO, "not in the future", F.col("bdate") > F.lit(as_of))],
    }
    return [_schema(layer, table, df, declared), *rows.get((layer, table), list)()]


def source_codes(df: DataFrame) -> Q.Check:
    """Q7 of the silver list, which looks at the bronze customers."""
    return _r("Q7 bronze marital", ["bronze"], CUST, REPORT, "NULL codes in the source", df, Q.has_null("cst_marital_status"))


def row_measures(layer: str, table: str, df: DataFrame, as_of) -> dict[str, Column]:
    """What a load of ``table`` measures on its write: the counts of its row checks, by their names."""
    if table not in SILVER:
        return {}
    checks = row_checks(layer, table, df, as_of)
    if (layer, table) == ("bronze", CUST):
        checks.append(source_codes(df))
    return {c.name: c.measure for c in checks}


def bronze_checks(wh) -> list[Q.Check]:
    t = _tables(wh)
    b = partial(t, "bronze")
    prd, loc = b("crm_prd_info"), b("erp_loc_a101")
    k, every, length, mapped, pair = _sides("bronze", t)
    out = [c for name in BRONZE for c in row_checks("bronze", name, b(name), wh.as_of)]
    B, BS = ["bronze"], ["bronze", "silver"]
    out += [
        Q.key_check("Q1 cst_id", B, CUST, NO, "unique, not NULL", k(CUST, "cst_id"), Q.REPEATS_OR_NULL),
        Q.key_check("Q2 cst_id rows", B, CUST, REPORT, "rows behind Q1", k(CUST, "cst_id"), Q.REPEATS_OR_NULL, rows=True),
        Q.key_check("Q4 cst_gndr", B, CUST, REPORT, "codes", k(CUST, "cst_gndr"), Q.ANY),
        Q.key_check("Q4 cst_marital_status", B, CUST, REPORT, "codes", k(CUST, "cst_marital_status"), Q.ANY),
        Q.key_check("Q1 prd_id", B, PRD, NO, "unique, not NULL", k(PRD, "prd_id"), Q.REPEATS_OR_NULL),
        Q.key_check("Q4 prd_line", B, PRD, REPORT, "codes", k(PRD, "prd_line"), Q.ANY),
        _c("Q31 prd history", B, "crm_prd_info", REPORT, "derived end dates",
           Q.history_of(prd.select("prd_id", "prd_key", "prd_cost", "prd_start_dt", "prd_end_dt"),
                        "prd_key", "prd_start_dt", "prd_id")),
        Q.key_check("Q9 sls_ord_num", B, SALES, REPORT, "lines per order", k(SALES, "sls_ord_num"), Q.REPEATS),
        Q.parent_empty_check("Q12 products loaded", BS, SALES, NO, "parent not empty", every("bronze", SALES), every("silver", PRD)),
        Q.parent_empty_check("Q12 customers loaded", BS, SALES, NO, "parent not empty", every("bronze", SALES), every("silver", CUST)),
        Q.key_check("Q17 az12 cid", B, AZ, REPORT, "id lengths", length("bronze", AZ, "cid"), Q.ANY),
        Q.key_check("Q19 gen", B, AZ, REPORT, "standard values", mapped("bronze", AZ, "gen", C.map_gender), Q.ANY),
        Q.key_check("Q17 loc cid", B, LOC, REPORT, "id lengths", length("bronze", LOC, "cid"), Q.ANY),
        Q.orphan_check("Q10 loc cid", BS, LOC, NO, "customer exists",
                       Q.side("bronze.erp_loc_a101", loc, "cid without hyphen", key=folded(C.strip_hyphen("cid"))), k(AZ, "cid", "silver")),
        Q.key_check("Q19 cntry", B, LOC, REPORT, "standard values", mapped("bronze", LOC, "cntry", C.map_country), Q.ANY),
        Q.not_in_check("Q11 cat id", BS, CAT, REPORT, "used by a product", k(CAT, "id"), k(PRD, "cat_id", "silver")),
        Q.key_check("Q27 cat pairs", B, CAT, REPORT, "pairs", pair("bronze", CAT, "cat", "subcat"), Q.ANY),
        Q.key_check("Q4 maintenance", B, CAT, REPORT, "codes", k(CAT, "maintenance"), Q.ANY),
    ]
    return out


def silver_checks(wh) -> list[Q.Check]:
    t = _tables(wh)
    b, s = partial(t, "bronze"), partial(t, "silver")
    S, BS = ["silver"], ["bronze", "silver"]
    k, every, length, _, _ = _sides("silver", t)
    out = [c for name in SILVER for c in row_checks("silver", name, s(name), wh.as_of)]
    out.append(source_codes(b(CUST)))
    for name in SILVER:
        ids = {CUST: "cst_id", PRD: "prd_id"}.get(name)         # the loads leave out rows without these
        first = k(name, ids, "bronze") if name == CUST else Q.side(
            f"bronze.{name}", b(name), "rows with id" if ids else "rows", key=f"CASE WHEN `{ids}` IS NOT NULL THEN '' END" if ids else "''")
        second = k(name, ids, "silver") if name == CUST else every("silver", name)
        out.append(Q.parity_check(f"Q21 {name}", BS, name, EQUAL, "bronze rows = silver rows", first, second, distinct=name == CUST))
    out += [
        Q.key_check("Q1 cst_id", S, CUST, NO, "unique, not NULL", k(CUST, "cst_id"), Q.REPEATS_OR_NULL),
        Q.key_check("Q4 cst_gndr", S, CUST, ALLOWED, "Male, Female, Unknown", k(CUST, "cst_gndr"),
                    Q.outside("Male", "Female", "Unknown")),
        Q.key_check("Q4 cst_marital_status", S, CUST, ALLOWED, "Single, Married, Unknown", k(CUST, "cst_marital_status"),
                    Q.outside("Single", "Married", "Unknown")),
        Q.key_check("Q1 prd_id", S, PRD, NO, "unique, not NULL", k(PRD, "prd_id"), Q.REPEATS_OR_NULL),
        Q.key_check("Q4 prd_line", S, PRD, ALLOWED, "Mountain, Road, Touring, Other sales, Unknown", k(PRD, "prd_line"),
                    Q.outside("Mountain", "Road", "Touring", "Other sales", "Unknown")),
        Q.not_in_check("Q11 cat_id", BS, PRD, REPORT, "category exists", k(PRD, "cat_id"), k(CAT, "id", "bronze"), skip_null=True),
        Q.orphan_check("Q10 cat_id", BS, PRD, REPORT, "category exists", k(PRD, "cat_id"), k(CAT, "id", "bronze")),
        Q.parent_check("Q30 sls_prd_key", S, SALES, REPORT, "product exists", k(SALES, "sls_prd_key"), k(PRD, "prd_key")),
        Q.orphan_check("Q10 sls_prd_key", S, SALES, NO, "product exists", k(SALES, "sls_prd_key"), k(PRD, "prd_key")),
        Q.orphan_check("Q10 sls_cust_id", S, SALES, NO, "customer exists", k(SALES, "sls_cust_id"), k(CUST, "cst_id")),
        Q.key_check("Q17 az12 cid", S, AZ, ONE, "one id length", length("silver", AZ, "cid"), Q.ANY),
        Q.key_check("Q4 gen", S, AZ, ALLOWED, "Male, Female, Unknown", k(AZ, "gen"), Q.outside("Male", "Female", "Unknown")),
        Q.key_check("Q17 loc cid", S, LOC, ONE, "one id length", length("silver", LOC, "cid"), Q.ANY),
        Q.not_in_check("Q11 loc cid", S, LOC, REPORT, "customer exists", k(LOC, "cid"), k(AZ, "cid")),
        Q.key_check("Q4 cntry", S, LOC, REPORT, "countries", k(LOC, "cntry"), Q.ANY),
        Q.not_in_check("Q11 cat id", S, CAT, REPORT, "used by a product", k(CAT, "id"), k(PRD, "cat_id")),
        Q.key_check("Q4 cat", ["bronze"], CAT, REPORT, "values", k(CAT, "cat", "bronze"), Q.ANY),
        Q.key_check("Q4 subcat", ["bronze"], CAT, REPORT, "values", k(CAT, "subcat", "bronze"), Q.ANY),
        Q.key_check("Q4 maintenance", ["bronze"], CAT, REPORT, "values", k(CAT, "maintenance", "bronze"), Q.ANY),
    ]
    return out


def gold_checks(wh) -> list[Q.Check]:
    s, g = wh.silver, wh.gold
    cust, az, loc = s("crm_cust_info"), s("erp_cust_az12"), s("erp_loc_a101")
    prd, cat = s("crm_prd_info"), s("erp_px_cat_g1v2")
    ci, ca, la = cust.alias("ci"), az.alias("ca"), loc.alias("la")
    joined = (ci.join(ca, same_text("ci.cst_key", "ca.cid"), "left")
                .join(la, same_text("ci.cst_key", "la.cid"), "left")
                .select(F.col("ci.cst_id").alias("cst_id")))
    cur = prd.where(F.col("prd_end_dt").isNull())
    pj = cur.alias("pi").join(cat.alias("pc"), same_text("pi.cat_id", "pc.id"), "left") \
            .select(F.col("pi.prd_key").alias("prd_key"))
    SG, G = ["silver"], ["gold"]
    return [
        _c("Q23 customers", SG, "dim_customers", NO, "no key repeats after the joins",
           Q.join_fan_out(joined, "cst_id")),
        _c("Q28 gender merge", SG, "dim_customers", REPORT, "CRM first, then ERP, else Unknown",
           Q.master_merge_audit(cust, az, loc)),
        Q.key_check("Q29 gender", G, "dim_customers", REPORT, "three values",
                    Q.side("gold.dim_customers", g("dim_customers"), "gender"), Q.ANY),
        Q.orphan_check("Q24 cat_id", SG, "dim_products", REPORT, "categories without a match",
                       Q.side("silver.crm_prd_info", prd, "cat_id"), Q.side("silver.erp_px_cat_g1v2", cat, "id")),
        _c("Q23 products", SG, "dim_products", NO, "no key repeats after the join",
           Q.join_fan_out(pj, "prd_key")),
        _c("Q25 fact keys", G, "fact_sales", NO, "every fact row has both keys",
           Q.fact_key_integrity(g("fact_sales"), g("dim_customers"), g("dim_products"))),
    ]


CHECKS = {"bronze": bronze_checks, "silver": silver_checks, "gold": gold_checks}


def checks_for(wh, layer: str) -> list[Q.Check]:
    return CHECKS[layer](wh)


def run_layer_checks(wh, layer: str | None = None, samples: bool = False) -> DataFrame:
    """One row per check of one layer (or of all three); with ``samples`` also a violating row
    of each.  Counts of single rows come from the load, which took them on its write."""
    layers = [layer] if layer else list(CHECKS)
    checks = [c for lay in layers for c in checks_for(wh, lay)]
    return Q.run_checks(wh.spark, checks, samples, wh.measured())
