"""The fact's file layout: row groups are skipped, shown by what the scan puts out."""

import datetime as dt
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from layerstar.sources.io import FileLayout, Layers, load_tables


def scanned(df) -> int:
    """Rows that the scan of ``df`` puts out, before its filter."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    assert leaves.size() == 1
    return leaves.apply(0).metrics().apply("numOutputRows").value()


@pytest.fixture(autouse=True)
def many_files(spark):
    """Small tables in several files, as large ones are."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def stored(spark, root, layout, n=40_000):
    """Rows in an order that has nothing to do with their date or key, half of them of one date."""
    rows = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, F.lit(dt.date(2020, 6, 1)))
         .otherwise(F.date_add(F.lit(dt.date(2020, 1, 1)), F.expr("cast(id * 7919 % 300 as int)"))).alias("day"),
        (F.col("id") * 104729 % n * 3).alias("key"), F.lit("x").alias("clash"))
    run, audit = load_tables(spark, Layers(root), "gold", {"t": lambda: rows}, layouts={"t": layout} if layout else None)
    assert audit.where("table = 't'").first().rows == n                # ranging does not count rows twice
    return Layers(root).table(spark, "gold", "t", run)


def test_ranges_and_blooms_skip_row_groups(spark, tmp_path):
    layout = FileLayout(("day", "key"), ("key",))
    spark.conf.set("parquet.enable.dictionary", "false")               # as where a row group holds too many keys for one
    try:
        plain, laid = stored(spark, str(tmp_path / "a"), None), stored(spark, str(tmp_path / "b"), layout)
    finally:
        spark.conf.unset("parquet.enable.dictionary")
    assert sorted(plain.collect()) == sorted(laid.collect())
    n = plain.count()
    day = F.col("day") == F.lit(dt.date(2020, 9, 10))
    assert scanned(plain.where(day)) == n
    assert scanned(laid.where(day)) < n / 2                            # its file alone
    # a hot date is spread over files by the next column
    sizes = [r["count"] for r in laid.where("day = '2020-06-01'").groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.7 * sum(sizes)
    # a key between the least and the greatest of every row group, that none holds
    absent = F.col("key") == 60_001
    assert scanned(plain.where(absent)) == n and scanned(laid.where(absent)) < n / 20
    one = laid.where(F.col("key") == 60_000)
    assert one.count() == 1 and scanned(one) < n


def test_an_empty_table_and_nulls_are_laid_out(spark, tmp_path):
    layout = FileLayout(("day",), ("day",))
    empty = spark.createDataFrame([], "day date, v int")
    some = spark.createDataFrame([(None, 1), (None, 1), (dt.date(2020, 1, 1), None)], "day date, v int")
    for i, df in enumerate((empty, some)):
        lay = Layers(str(tmp_path / str(i)))
        load_tables(spark, lay, "gold", {"t": lambda df=df: df}, layouts={"t": layout})
        assert sorted(map(str, lay.table(spark, "gold", "t").collect())) == sorted(map(str, df.collect()))


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not available")
def test_the_fact_lies_by_date(spark, tmp_path):
    from layerstar.plans.warehouse import FACT_LAYOUT, warehouse_for
    fact = warehouse_for(spark, SF_SMALL).gold("fact_sales")
    lay = Layers(str(tmp_path))
    load_tables(spark, lay, "gold", {"fact_sales": lambda: fact}, layouts={"fact_sales": FACT_LAYOUT})
    f = lay.table(spark, "gold", "fact_sales")
    assert f.exceptAll(fact).count() == 0 and fact.exceptAll(f).count() == 0
    quarter = F.col("order_date").between(dt.date(1995, 1, 1), dt.date(1995, 3, 31))
    assert 0 < f.where(quarter).count() <= scanned(f.where(quarter)) <= f.count() / 2
    for files in (f, fact):                                            # the load's own files are ranged as well
        spans = []
        for path in files.inputFiles():
            meta = pq.ParquetFile(path.removeprefix("file://").removeprefix("file:")).metadata
            col = next(i for i in range(meta.num_columns) if meta.schema.column(i).name == "order_date")
            stats = [meta.row_group(g).column(col).statistics for g in range(meta.num_row_groups)]
            spans += [(x.min, x.max) for x in stats if x.has_min_max]
        spans.sort()
        assert spans and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
