"""Operators over whole tables, written so that no step needs one task for all
rows or for one hot key (SURVEY §4.3).

* T3  ``latest_per_key``: an aggregate (map-side combined), not a window.
* T10 ``derive_end_date``: the window runs over grouped (key, start) pairs.
* T14 ``impute_order_date``: one-row aggregate, used as a scalar subquery.
* G4  ``surrogate_key``: dense 1..n numbers from stored ranges + offsets.
* ``merged``: the side of a join that the driver must never collect.
* ``with_grand_total``: a total for part-to-whole ratios, as a scalar subquery.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerstar.functions.dates import day_diff
from layerstar.functions.text import folded
from layerstar.session import work_root


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def merged(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is shuffled and sort-merged at any size.

    Spark weighs a side by the bytes of its files and keeps to a broadcast it has planned by them.
    Files of keys pack so well that a few MB of them are hundreds of MB of rows, which the
    driver would collect and hash.  For every side that grows with the data."""
    return df.hint("merge")


def latest_per_key(df: DataFrame, keys, order_col: str, tie: Sequence[str] | None = None,
                   newest: bool = True) -> DataFrame:
    """One row per key, the one with the highest ``order_col``.

    Same rows as ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_col DESC,
    tie DESC) = 1`` with NULL as the lowest value, but computed as
    ``max(struct(order, tie, row))``: partial aggregation folds a hot key on the
    map side, so no task ever holds all rows of one key.  ``tie`` should name
    every other column so that the pick is total; without it the remaining
    columns decide (in column order).  ``newest=False`` keeps the lowest.
    """
    keys = _names(keys)
    tie = list(tie or [])
    rest = [c for c in df.columns if c not in keys]
    order = [order_col] + [c for c in tie if c != order_col]
    order += [c for c in rest if c not in order]
    packed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    agg = F.max(packed) if newest else F.min(packed)
    out = df.groupBy(*keys).agg(agg.alias("__pick"))
    return out.select(*[F.col(k) for k in keys],
                      *[F.col(f"__pick.o{order.index(c)}").alias(c) for c in rest]) \
              .select(*df.columns)


def key_of(df: DataFrame, col: str) -> Column:
    """What ``col`` is compared by: the folded text of a text column, the value of any other."""
    return folded(col) if isinstance(df.schema[col].dataType, T.StringType) else F.col(col)


def group_text(df: DataFrame, cols: Sequence[str], **sums: Column) -> DataFrame:
    """``GROUP BY cols`` with text compared under the warehouse's collation.

    Of the spellings of a group the least one (by bytes) is shown.  Rows are
    grouped by spelling first, which hash-aggregates on the map side; the few
    spellings are folded after.  ``sums`` are aggregates that add up over the
    spellings (sums and counts), by the name of their column.
    """
    aggs = [agg.alias(name) for name, agg in sums.items()]
    spelt = df.groupBy(*cols).agg(*aggs) if aggs else df.select(*cols).distinct()
    keys = [key_of(spelt, c).alias(f"__{i}") for i, c in enumerate(cols)]
    shown = [F.min(c).alias(c) for c in cols]
    return spelt.groupBy(*keys).agg(*shown, *[F.sum(n).alias(n) for n in sums]).select(*cols, *sums)


def derive_end_date(df: DataFrame, key: str, start: str, out: str = "prd_end_dt",
                    id_col: str = "prd_id") -> DataFrame:
    """Validity end = next start date of the same key minus one day.

    Same rows as ``LEAD(start) OVER (PARTITION BY key ORDER BY start, id) - 1``:
    the last version of a key stays open (NULL), and of the rows that share key
    and start only the one with the greatest id looks beyond that start; the
    others end the day before it.  ``LEAD`` runs over the grouped (key, start)
    pairs, so a key's window holds at most one row per distinct date however
    many rows the key has.  The pairs are joined back null-safely.  ``id_col``
    must tell apart the rows of one pair.  Text keys are equal under the
    warehouse's collation.
    """
    same = key_of(df, key)
    pairs = df.groupBy(same.alias("__k"), F.col(start).alias("__s")).agg(F.max(id_col).alias("__last"))
    w = Window.partitionBy("__k").orderBy(F.col("__s").asc_nulls_first())
    ends = pairs.select("__k", "__s", "__last", F.date_sub(F.lead("__s").over(w), 1).alias("__next"))
    cond = same.eqNullSafe(F.col("__k")) & F.col(start).eqNullSafe(F.col("__s"))
    base = df.drop(out) if out in df.columns else df
    is_last = F.col(id_col).eqNullSafe(F.col("__last"))
    end = F.when(is_last, F.col("__next")).otherwise(F.date_sub(F.col(start), 1))
    return base.join(merged(ends), cond, "left").withColumn(out, end).drop("__k", "__s", "__last", "__next")


def mean_ship_days(df: DataFrame, order: str, ship: str) -> Column:
    """T14 helper: AVG(DATEDIFF(DAY, order, ship)) over all rows as an integer
    mean cut toward zero (integer AVG), as a scalar subquery column."""
    d = day_diff(order, ship)
    one = df.agg(F.sum(d).alias("s"), F.count(d).alias("n")) \
            .select(F.expr("CASE WHEN n > 0 THEN s div n END").cast("int").alias("avg_days"))
    return one.scalar()


def impute_order_date(df: DataFrame, order: str = "sls_order_dt",
                      ship: str = "sls_ship_dt") -> DataFrame:
    """A missing order date := ship date - mean order-to-ship days.

    The mean is one global aggregate (partial sums per task, one row out) used
    as a scalar subquery; no window over the whole table."""
    avg_days = mean_ship_days(df, order, ship)
    return df.withColumn(order, F.coalesce(F.col(order), F.date_add(F.col(ship), -avg_days)))


def with_grand_total(df: DataFrame, col: str, name: str = "grand_total") -> DataFrame:
    """Attach SUM(col) over the whole input (``SUM(x) OVER ()``) as a column.

    Computed once as a one-row aggregate and used as a scalar subquery, so the
    rows never move to a single partition."""
    total = df.agg(F.sum(col).alias(name)).scalar()
    return df.withColumn(name, total)


def surrogate_key(df: DataFrame, order_cols: Sequence[str], name: str,
                  path: str | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order_cols)`` without a single task.

    1. The rows are range-partitioned by the order columns and stored at
       ``path`` (default: a folder of its own under the shared work folder)
       together with the number of the partition they are in.
    2. Rows per stored partition -> running offsets, one row per partition.
    3. key = offset of the partition + row_number within the partition.

    There is one way for any number of rows: one exchange of the rows by range,
    and nothing but the range sample, which Spark draws itself, reaches the
    driver.  The partition number is read back from the stored rows, so a
    repeated task cannot number them otherwise.  The numbers equal the global
    row number when ``order_cols`` is a total order (end it with a unique
    column).  NULLs sort first, as in the warehouse.
    """
    spark = df.sparkSession
    path = path or f"{work_root(spark)}/keys/{name}-{uuid.uuid4().hex}"
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    ranged = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order) \
               .withColumn("__part", F.spark_partition_id())
    ranged.write.mode("overwrite").parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")) \
                  .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    w = Window.partitionBy("__part").orderBy(*order)
    return (rows.join(offsets, "__part")
                .withColumn(name, (F.col("__offset") + F.row_number().over(w)).cast("bigint"))
                .drop("__part", "__offset"))
