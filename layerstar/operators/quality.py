"""Q1-Q31: data-quality checks for each layer, and ``run_checks``.

A check is a DataFrame of violating (or reported) rows.  ``Check`` adds its
name, the layers it reads, the table, the kind of expectation, and
``run_checks`` returns one row per check with the number of rows found.
Kinds: ``no_rows``, ``allowed_values``, ``equal_counts``, ``one_row``,
``report`` (nothing expected).  Text keys and groups are equal under the
warehouse's collation (M4); of a group's spellings the least is shown.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerstar.functions.dates import as_date_lit, parse_yyyymmdd
from layerstar.functions.text import folded, same_text, sql_len, untrimmed as _untrimmed
from layerstar.operators.rows import derive_end_date, group_text, key_of, merged


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _any(conds: Iterable[Column]) -> Column:
    out = None
    for c in conds:
        out = c if out is None else (out | c)
    return out


def _as_money(df: DataFrame, col: str) -> Column:
    c = F.col(col)
    return c.cast("decimal(18,2)") if isinstance(df.schema[col].dataType, T.StringType) else c


def duplicate_or_null_key(df: DataFrame, key: str) -> DataFrame:
    """Q1: keys that repeat or are NULL, with their row count."""
    return group_text(df, [key], cnt=F.count(F.lit(1))).where((F.col("cnt") > 1) | F.col(key).isNull())


def rows_with_bad_key(df: DataFrame, key: str) -> DataFrame:
    """Q2: the full rows behind Q1 (key IN repeated keys, OR key IS NULL)."""
    keyed = df.withColumn("__k", key_of(df, key))
    dups = keyed.groupBy("__k").count().where(F.col("count") > 1).select("__k")
    return keyed.join(dups, "__k", "left_semi").drop("__k").unionByName(df.where(F.col(key).isNull()))


def is_untrimmed(cols) -> Column:
    return _any(_untrimmed(c) for c in _names(cols))


def untrimmed(df: DataFrame, cols) -> DataFrame:
    """Q3: rows whose text has outer spaces in any of ``cols``."""
    return df.where(is_untrimmed(cols)).select(*_names(cols))


def domain_values(df: DataFrame, col: str, allowed: Sequence[str] | None = None) -> DataFrame:
    """Q4: distinct values of a column; with ``allowed``, only values outside it
    (NULL included)."""
    d = group_text(df, [col])
    if allowed is None:
        return d
    known = [folded(F.lit(a)) if isinstance(a, str) else a for a in allowed]
    return d.where(~key_of(df, col).isin(*known) | F.col(col).isNull())


def is_null_or_negative(df: DataFrame, col: str) -> Column:
    v = _as_money(df, col)
    return v.isNull() | (v < 0)


def null_or_negative(df: DataFrame, col: str) -> DataFrame:
    """Q5: amount NULL or below zero (text is read as decimal(18,2))."""
    return df.where(is_null_or_negative(df, col)).select(col)


def is_reversed(start: str, end: str) -> Column:
    return F.col(end) < F.col(start)


def reversed_range(df: DataFrame, start: str, end: str, order_by: str | None = None) -> DataFrame:
    """Q6: rows whose end date is before the start date."""
    out = df.where(is_reversed(start, end))
    return out.orderBy(order_by) if order_by else out


def has_null(cols) -> Column:
    return _any(F.col(c).isNull() for c in _names(cols))


def null_any(df: DataFrame, cols) -> DataFrame:
    """Q7, Q8: rows with a NULL in any of ``cols``."""
    return df.where(has_null(cols))


def repeated_key(df: DataFrame, key: str) -> DataFrame:
    """Q9: keys on more than one row, with their count (a report)."""
    return group_text(df, [key], cnt=F.count(F.lit(1))).where(F.col("cnt") > 1)


def orphans(child: DataFrame, ck: str, parent: DataFrame, pk: str) -> DataFrame:
    """Q10: child rows with no parent (correlated NOT EXISTS = left anti join)."""
    p = parent.select(key_of(parent, pk).alias("__pk"))
    return child.join(merged(p), key_of(child, ck) == F.col("__pk"), "left_anti")


def not_in(child: DataFrame, ck: str, parent: DataFrame, pk: str,
           skip_null: bool = False) -> DataFrame:
    """Q11: ``ck NOT IN (SELECT pk FROM parent [WHERE pk IS NOT NULL])``.

    Same rows as the null-aware anti join (one NULL in the list empties the
    result; an empty list keeps every row, NULL keys too), built from two
    EXISTS subqueries and a hash anti join, so it never falls back to a
    nested-loop join when the parent is large."""
    p = parent.select(key_of(parent, pk).alias("__pk"))
    if skip_null:
        p = p.where(F.col("__pk").isNotNull())
    empty = ~p.exists()
    has_null = p.where(F.col("__pk").isNull()).exists()
    keep = empty | (~has_null & F.col(ck).isNotNull())
    return child.where(keep).join(p, key_of(child, ck) == F.col("__pk"), "left_anti")


def if_parent_empty(child: DataFrame, parent: DataFrame) -> DataFrame:
    """Q12: every child row when the parent table is empty, else none
    (uncorrelated NOT EXISTS)."""
    return child.where(~parent.select(F.lit(1).alias("one")).exists())


def is_unparsable(cols, fmt: str | None = "yyyyMMdd") -> Column:
    def parsed(c):
        return parse_yyyymmdd(c) if fmt == "yyyyMMdd" else F.try_to_date(F.col(c))
    # compared without a short cut: checks of one scan then share the parsed dates
    known = [parsed(c).isNotNull() for c in _names(cols)]
    return ~(known[0] if len(known) == 1 else F.least(*known))


def unparsable_dates(df: DataFrame, cols, fmt: str | None = "yyyyMMdd") -> DataFrame:
    """Q13: rows where any date text does not parse (ISDATE = 0; NULL too)."""
    return df.where(is_unparsable(cols, fmt))


def is_out_of_order(order: str, ship: str, due: str) -> Column:
    o, s, d = F.col(order), F.col(ship), F.col(due)
    return (s < o) | (d < o) | (d < s)


def dates_out_of_order(df: DataFrame, order: str, ship: str, due: str) -> DataFrame:
    """Q14: ship before order, due before order, or due before ship."""
    return df.where(is_out_of_order(order, ship, due))


def is_out_of_bounds(df: DataFrame, cols, as_of, low: str = "2000-01-01") -> Column:
    lo, hi = F.lit(low).cast("date"), as_date_lit(as_of)
    d = [parse_yyyymmdd(c) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c) for c in _names(cols)]
    # the earliest and the latest of the dates that are set
    first, last = (d[0], d[0]) if len(d) == 1 else (F.least(*d), F.greatest(*d))
    return (first < lo) | (last > hi)


def dates_out_of_bounds(df: DataFrame, cols, as_of, low: str = "2000-01-01") -> DataFrame:
    """Q15: any parsed date before ``low`` or after ``as_of``."""
    return df.where(is_out_of_bounds(df, cols, as_of, low))


def is_mismatch(df: DataFrame, s: str, q: str, p: str, negatives: bool = False) -> Column:
    """Each text is read as an amount once: a sales value other than 0 that equals the product has
    both factors set and other than 0; if one factor is above 0 besides, so is the other."""
    sv, qv, pv = _as_money(df, s), _as_money(df, q), _as_money(df, p)
    right = F.nullif(sv, F.lit(0)) == qv * pv
    if negatives:
        right = right & (sv > 0) & (qv > 0)
    return ~F.coalesce(right, F.lit(False))


def measure_mismatch(df: DataFrame, s: str, q: str, p: str, negatives: bool = False) -> DataFrame:
    """Q16: sales != quantity * price, or a measure NULL or 0 (or < 0)."""
    return df.where(is_mismatch(df, s, q, p, negatives))


def length_histogram(df: DataFrame, col: str) -> DataFrame:
    """Q17: rows per text length (LEN); one row expected once cleansed."""
    return df.groupBy(sql_len(col).alias("len")).agg(F.count(F.lit(1)).alias("occurrence"))


def is_unlikely_birthdate(col: str, as_of, low: str = "1925-01-01") -> Column:
    d = F.col(col).cast("date")
    return (d < F.lit(low).cast("date")) | (d > as_date_lit(as_of))


def birthdate_bounds(df: DataFrame, col: str, as_of, low: str = "1925-01-01") -> DataFrame:
    """Q18: birth dates before ``low`` or after ``as_of``: old and validated value."""
    d, hi = F.col(col).cast("date"), as_date_lit(as_of)
    return df.where(is_unlikely_birthdate(col, as_of, low)).select(
        F.col(col).alias("bdate_old"),
        F.when(d > hi, None).otherwise(d).alias("validated_bdate")).orderBy("bdate_old")


def standardisation_map(df: DataFrame, col: str, fn: Callable[[Column], Column]) -> DataFrame:
    """Q19: each distinct raw value next to its standardised value."""
    return df.select(F.col(col).alias("raw"), fn(F.col(col)).alias("standard")).distinct()


def is_not_like(col: str, regex: str = r"^.{2}_.{2}$") -> Column:
    return F.col(col).isNull() | ~F.col(col).rlike(regex)


def bad_pattern(df: DataFrame, col: str, regex: str = r"^.{2}_.{2}$") -> DataFrame:
    """Q20: values not of the pattern (two characters, '_', two), or NULL."""
    return df.where(is_not_like(col, regex))


def row_count_parity(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Q21: row counts of both layers side by side (expected equal).  Pass the
    bronze frame with the same filter the load applies."""
    return bronze.agg(F.count(F.lit(1)).alias("row_num")).select(F.lit("bronze").alias("layer"), "row_num") \
        .unionByName(silver.agg(F.count(F.lit(1)).alias("row_num"))
                     .select(F.lit("silver").alias("layer"), "row_num"))


def is_populated(df: DataFrame) -> DataFrame:
    """Q22: one row: does the table hold any row (reads at most one)."""
    return df.limit(1).agg((F.count(F.lit(1)) == 1).alias("populated"))


def join_fan_out(df: DataFrame, key: str) -> DataFrame:
    """Q23: keys that repeat after the dimension joins (pass the joined frame)."""
    return group_text(df, [key], cnt=F.count(F.lit(1))).where(F.col("cnt") > 1)


def unmatched(df: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Q24: rows whose key finds no dimension row: (key, dim key)."""
    d = dim.select(key_of(dim, dim_key).alias("__dk"))
    return df.join(d, key_of(df, key) == F.col("__dk"), "left").where(F.col("__dk").isNull()) \
             .select(key, F.col("__dk").alias(dim_key))


def fact_key_integrity(f: DataFrame, c: DataFrame, p: DataFrame) -> DataFrame:
    """Q25: fact rows with a NULL customer or product key, next to the whole
    dimension rows they join to (their keys as ``dim_customer_key`` and
    ``dim_product_key``)."""
    cd = c.withColumnRenamed("customer_key", "dim_customer_key")
    pd = p.withColumnRenamed("product_key", "dim_product_key")
    j = (f.join(cd, f["customer_key"] == cd["dim_customer_key"], "left")
          .join(pd, f["product_key"] == pd["dim_product_key"], "left"))
    return j.where(f["customer_key"].isNull() | f["product_key"].isNull())


def schema_mismatch(spark: SparkSession, df: DataFrame, expected: T.StructType,
                    max_length: dict[str, int] | None = None) -> DataFrame:
    """Q26: columns whose presence, type, text length or nullability differs from
    the declaration: (column_name, expected_type, actual_type, declared_length,
    max_length, declared_nullable, null_count, problem).  One aggregate gives every
    column's NULLs and every text column's longest value (LEN); the schemas
    themselves are metadata."""
    max_length = max_length or {}
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f for f in expected.fields}
    names = list(dict.fromkeys(list(want) + list(actual)))
    meta = spark.createDataFrame(
        [(n, want[n].dataType.simpleString() if n in want else None, actual.get(n), max_length.get(n),
          want[n].nullable if n in want else None) for n in names],
        "column_name string, expected_type string, actual_type string, declared_length int, declared_nullable boolean")
    cells = [f"named_struct('column_name', '{n}', 'max_length', "
             + (f"max(length(rtrim(`{n}`)))" if kind == "string" else "CAST(NULL AS INT)")
             + f", 'null_count', count_if(`{n}` IS NULL))" for n, kind in actual.items()]
    found = df.agg(F.expr(f"array({', '.join(cells)})").alias("c")).select(F.inline("c"))
    problem = (F.when(F.col("expected_type").isNull(), "not declared")
                .when(F.col("actual_type").isNull(), "missing")
                .when(F.col("expected_type") != F.col("actual_type"), "type")
                .when(F.col("max_length") > F.col("declared_length"), "too long")
                .when(~F.col("declared_nullable") & (F.col("null_count") > 0), "NULLs"))
    return meta.join(found, "column_name", "left").withColumn("problem", problem).where(F.col("problem").isNotNull()) \
        .select("column_name", "expected_type", "actual_type", "declared_length", "max_length", "declared_nullable",
                "null_count", "problem")


def schema_mismatch_count(df: DataFrame, expected: T.StructType,
                          max_length: dict[str, int] | None = None) -> Column:
    """Q26 as an aggregate over ``df``: the number of columns that differ."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f for f in expected.fields}
    differ = {n for n in {**actual, **want} if n not in want or actual.get(n) != want[n].dataType}
    bad = []
    for n in want:
        conds = []
        if n in (max_length or {}) and isinstance(actual.get(n), T.StringType):
            conds.append(f"coalesce(max(length(rtrim(`{n}`))) > {max_length[n]}, false)")
        if not want[n].nullable:
            conds.append(f"count_if(`{n}` IS NULL) > 0")
        if n not in differ and conds:
            bad.append(f"CAST({' OR '.join(conds)} AS BIGINT)")
    return F.expr(" + ".join([f"CAST({len(differ)} AS BIGINT)", *bad]))


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Q27: the (a, b) pairs that occur (GROUP BY a, b)."""
    return group_text(df, [a, b])


def master_merge_audit(cust: DataFrame, az12: DataFrame, loc: DataFrame) -> DataFrame:
    """Q28: each combination of CRM gender, ERP gender and the merged value."""
    from layerstar.plans.gold import merge_master
    ci, ca, la = cust.alias("ci"), az12.alias("ca"), loc.alias("la")
    j = (ci.join(ca, same_text("ci.cst_key", "ca.cid"), "left")
           .join(la, same_text("ci.cst_key", "la.cid"), "left"))
    merged = j.select(F.col("ci.cst_gndr").alias("cst_gndr"), F.col("ca.gen").alias("gen"),
                      merge_master(F.col("ci.cst_gndr"), F.col("ca.gen")).alias("new_gen"))
    return group_text(merged, ["cst_gndr", "gen", "new_gen"]) \
        .orderBy(F.col("cst_gndr").asc_nulls_first(), F.col("gen").asc_nulls_first())


def rows_per_value(df: DataFrame, col: str) -> DataFrame:
    """Q29: rows per value of a column."""
    return group_text(df, [col], count=F.count(F.lit(1)))


def with_parent(child: DataFrame, ck: str, parent: DataFrame, pk: str) -> DataFrame:
    """Q30: child rows whose key exists in the parent (EXISTS = left semi join)."""
    p = parent.select(key_of(parent, pk).alias("__pk"))
    return child.join(p, key_of(child, ck) == F.col("__pk"), "left_semi")


def history_of(df: DataFrame, key: str, start: str, id_col: str, value: str | None = None,
               out: str = "derived_prd_end_dt") -> DataFrame:
    """Q31: product rows through time with the end date T10 derives.  With
    ``value`` only that key's history is shown; without it, every key's."""
    base = df if value is None else df.where(key_of(df, key) == folded(F.lit(value)))
    return derive_end_date(base, key, start, out, id_col)


# --------------------------------------------------------------------------
@dataclass(frozen=True)
class Side:
    """The keys of one table that a check counts: ``key``, a text expression, of every row of ``source``.

    ``scan`` names the table and ``name`` the key, so that sides which several
    checks use are read once."""

    scan: str
    name: str
    source: DataFrame
    key: str | Column


def side(scan: str, df: DataFrame, *cols: str, key: str | Column | None = None) -> Side:
    """The side of one column, or of several as one key; text is compared under the collation."""
    if key is None:
        text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
        keys = [f"lower(rtrim(`{c}`))" if c in text else f"cast(`{c}` AS STRING)" for c in cols]
        key = keys[0] if len(keys) == 1 else f"to_json(array({', '.join(keys)}))"
    return Side(scan, ",".join(cols), df, key)


@dataclass(frozen=True)
class Keys:
    """The grouped keys of one check: a row per key ``k``, with the number of its rows on each side, ``c0``
    and ``c1``.  Conditions and results are SQL, since a list of checks has hundreds of them."""

    number: int

    def groups(self, where: str) -> str:
        """The number of keys that fulfil ``where``."""
        return f"count_if(d = {self.number} AND ({where}))"

    def rows(self, where: str = "true", side: int = 0) -> str:
        """The number of a side's rows whose keys fulfil ``where``."""
        return f"coalesce(sum(CASE WHEN d = {self.number} AND ({where}) THEN c{side} END), 0)"


@dataclass
class Check:
    """A check of one table in one of three forms: its ``violations``; a
    ``measure`` (an aggregate over ``source``, such as the count of rows that
    fulfil ``where``); or ``found`` over the grouped keys of its ``sides``, with
    ``bad`` for the keys to show.  Measures of one ``scan`` (layer and table) are
    taken in one pass, and the keys of all checks in another one."""

    name: str
    layers: tuple[str, ...]
    table: str
    kind: str
    expectation: str
    violations: DataFrame | None = None
    source: DataFrame | None = None
    measure: Column | None = None
    where: Column | None = None
    scan: str = ""
    sides: tuple[Side, ...] = ()
    found: Callable[[Keys], str] | None = None
    bad: str = "true"


def row_check(name: str, layers: tuple[str, ...], table: str, kind: str, expectation: str,
              source: DataFrame, where: Column) -> Check:
    """A check that counts the rows of ``source`` that fulfil ``where``."""
    return Check(name, layers, table, kind, expectation, source=source, measure=F.count_if(where),
                 where=where, scan=f"{layers[0]}.{table}")


def _keyed(name, layers, table, kind, expectation, sides, found, bad) -> Check:
    return Check(name, tuple(layers), table, kind, expectation, sides=tuple(sides), found=found, bad=bad)


#: Which keys a check counts.  Q4, Q17, Q19, Q27, Q29: every one; Q9; Q1 and Q2.
ANY, REPEATS, REPEATS_OR_NULL = "c0 > 0", "c0 > 1", "c0 > 1 OR k IS NULL"
_WITHOUT_PARENT = "c0 > 0 AND k IS NOT NULL AND c1 = 0"


def outside(*allowed: str) -> str:
    """Q4 with a list: NULL and the values that are not in it."""
    names = ", ".join("'" + a.lower().rstrip(" ").replace("'", "\\'") + "'" for a in allowed)
    return f"k IS NULL OR k NOT IN ({names})"


def key_check(name, layers, table, kind, expectation, of: Side, bad: str, rows: bool = False) -> Check:
    """A check that counts the keys that are ``bad``, or their rows (Q1, Q2, Q4, Q9, Q17, Q19, Q27, Q29)."""
    return _keyed(name, layers, table, kind, expectation, [of], lambda g: g.rows(bad) if rows else g.groups(bad), bad)


def orphan_check(name, layers, table, kind, expectation, child: Side, parent: Side) -> Check:
    """Q10, Q24: child rows without a parent, NULL keys among them."""
    bad = "c0 > 0 AND (k IS NULL OR c1 = 0)"
    return _keyed(name, layers, table, kind, expectation, [child, parent], lambda g: g.rows(bad), bad)


def parent_check(name, layers, table, kind, expectation, child: Side, parent: Side) -> Check:
    """Q30: child rows with a parent."""
    bad = "c0 > 0 AND k IS NOT NULL AND c1 > 0"
    return _keyed(name, layers, table, kind, expectation, [child, parent], lambda g: g.rows(bad), bad)


def not_in_check(name, layers, table, kind, expectation, child: Side, parent: Side, skip_null: bool = False) -> Check:
    """Q11: child rows whose key is NOT IN the parent's, with the rules of ``not_in`` for NULL and the empty list."""
    def found(g: Keys) -> str:
        listed = g.rows("k IS NOT NULL" if skip_null else "true", side=1)
        holds_null = "false" if skip_null else g.rows("k IS NULL", side=1) + " > 0"
        return f"CASE WHEN {listed} = 0 THEN {g.rows()} WHEN {holds_null} THEN 0 ELSE {g.rows(_WITHOUT_PARENT)} END"
    return _keyed(name, layers, table, kind, expectation, [child, parent], found, _WITHOUT_PARENT)


def parent_empty_check(name, layers, table, kind, expectation, child: Side, parent: Side) -> Check:
    """Q12: every child row if the parent has none."""
    return _keyed(name, layers, table, kind, expectation, [child, parent],
                  lambda g: f"CASE WHEN {g.rows(side=1)} = 0 THEN {g.rows()} ELSE 0 END", "c0 > 0")


def parity_check(name, layers, table, kind, expectation, a: Side, b: Side, distinct: bool = False) -> Check:
    """Q21: 1 when the first side has as many rows with a key (``distinct``: as many keys) as the second has rows, else 2."""
    def found(g: Keys) -> str:
        first = g.groups("c0 > 0 AND k IS NOT NULL") if distinct else g.rows("k IS NOT NULL")
        return f"CASE WHEN {first} = {g.rows(side=1)} THEN 1 ELSE 2 END"
    return _keyed(name, layers, table, kind, expectation, [a, b], found, "c0 <> c1")


RESULT = ("check string, layers string, table string, kind string, expectation string, found long")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _described(ch: Check, found: str, sample: str | None) -> str:
    """The check's row as a struct, in SQL."""
    cells = {"check": _quoted(ch.name), "layers": _quoted(",".join(ch.layers)), "table": _quoted(ch.table), "kind": _quoted(ch.kind),
             "expectation": _quoted(ch.expectation), "found": f"cast({found} AS BIGINT)", **({"sample": sample} if sample else {})}
    return "named_struct(" + ", ".join(f"'{n}', {v}" for n, v in cells.items()) + ")"


def _rows_of(df: DataFrame, checks: Sequence[Check], samples: bool) -> DataFrame:
    """The one row of ``found_i`` (and ``sample_i``) as a row per check."""
    rows = [_described(ch, f"found_{i}", f"sample_{i}" if samples else None) for i, ch in enumerate(checks)]
    return df.select(F.expr(f"explode(array({', '.join(rows)})) AS r")).select("r.*")


def _one_pass(checks: Sequence[Check], samples: bool) -> DataFrame:
    """All measures of one table as one aggregate, a row per check."""
    source = checks[0].source
    aggs = [ch.measure.alias(f"found_{i}") for i, ch in enumerate(checks)]
    if samples:
        whole = F.to_json(F.struct(*source.columns))
        aggs += [F.min(F.when(ch.where if ch.where is not None else F.lit(False), whole)).alias(f"sample_{i}")
                 for i, ch in enumerate(checks)]
    return _rows_of(source.agg(*aggs), checks, samples)


def _key_pass(checks: Sequence[Check], samples: bool) -> DataFrame:
    """All keyed checks: one scan of each table, one shuffle of (check, key) pairs, a row per check.

    The pairs are counted before the shuffle.  A check of two tables sees, for
    every key, its rows on both sides: members, orphans and empty parents alike.
    """
    numbers: dict[tuple, int] = {}
    number = [numbers.setdefault(tuple((s.scan, s.name) for s in ch.sides), len(numbers)) for ch in checks]
    scans: dict[str, tuple[DataFrame, dict[tuple, Column]]] = {}
    for ch, n in zip(checks, number, strict=True):
        for place, s in enumerate(ch.sides):
            entries = scans.setdefault(s.scan, (s.source, {}))[1]
            if (n, place) not in entries:
                entries[n, place] = (F.expr(f"named_struct('d', {n}, 's', {place}, 'k', {s.key})") if isinstance(s.key, str)
                                     else F.struct(F.lit(n).alias("d"), F.lit(place).alias("s"), s.key.alias("k")))
    pairs = None
    for source, entries in scans.values():
        part = source.select(F.inline(F.array(*entries.values())))
        pairs = part if pairs is None else pairs.unionByName(part)
    keys = pairs.groupBy("d", "k").agg(*[F.expr(f"count_if(s = {i}) AS c{i}") for i in (0, 1)])
    aggs = []
    for i, (ch, n) in enumerate(zip(checks, number, strict=True)):
        found = ch.found(Keys(n))
        aggs.append(F.expr(f"{found} AS found_{i}"))
        if samples:
            shown = f"min(CASE WHEN d = {n} AND ({ch.bad}) THEN to_json(named_struct('key', k, 'rows', c0)) END)"
            aggs.append(F.expr(f"CASE WHEN {found} > 0 THEN {shown} END AS sample_{i}"))
    return _rows_of(keys.agg(*aggs), checks, samples)


def _from_load(spark: SparkSession, checks: Sequence[Check], measured: DataFrame) -> DataFrame:
    """The rows of checks whose measures the load took: joined to the stored values, without a scan."""
    listed = spark.createDataFrame([(ch.scan, ch.name, ",".join(ch.layers), ch.table, ch.kind, ch.expectation) for ch in checks],
                                   "scan string, check string, layers string, table string, kind string, expectation string")
    return listed.join(measured, ["scan", "check"]).select("check", "layers", "table", "kind", "expectation", "found")


def run_checks(spark: SparkSession, checks: Sequence[Check], samples: bool = False,
               measured: DataFrame | None = None) -> DataFrame:
    """One row per check: its metadata, the number of rows it found, and whether
    the expectation holds.  ``equal_counts`` checks compare the row counts they
    list (``found`` is then the number of distinct counts); ``report`` checks
    always pass.  Checks that only look at single rows of a table share one scan
    of it, and those that look at keys another one.  With ``samples`` each check
    shows one violating row (or key, with its rows) as JSON, the first in text
    order.  ``measured`` (scan, check, found) holds measures taken before, on the
    load's write: checks in it need no scan, unless a sample row is asked for."""
    taken = {(r.scan, r.check) for r in measured.select("scan", "check").collect()} if measured is not None and not samples else set()
    known: list[Check] = []
    scans: dict[str, list[Check]] = {}
    keyed: list[Check] = []
    parts = []
    for ch in checks:
        if ch.found is not None:
            keyed.append(ch)
            continue
        if (ch.scan, ch.name) in taken:
            known.append(ch)
            continue
        if ch.measure is not None:
            scans.setdefault(ch.scan, []).append(ch)
            continue
        found = F.countDistinct("row_num") if ch.kind == "equal_counts" else F.count(F.lit(1))
        aggs = [found.alias("found")]
        if samples:
            aggs.append(F.min(F.to_json(F.struct(*ch.violations.columns))).alias("sample"))
        parts.append(ch.violations.agg(*aggs).select(
            F.expr(_described(ch, "found", "sample" if samples else None) + " AS r")).select("r.*"))
    if known:
        parts.append(_from_load(spark, known, measured))
    parts = [_one_pass(group, samples) for group in scans.values()] + ([_key_pass(keyed, samples)] if keyed else []) + parts
    if not parts:
        return spark.createDataFrame([], RESULT + (", sample string" if samples else "") + ", passed boolean")
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    passed = (F.when(F.col("kind").isin("no_rows", "allowed_values"), F.col("found") == 0)
               .when(F.col("kind").isin("one_row", "equal_counts"), F.col("found") == 1)
               .otherwise(F.lit(True)))
    return rows.withColumn("passed", passed)
