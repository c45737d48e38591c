"""Reading tables, staging intermediate results, and global ranks."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerstar.session import work_root


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: The folder that ``stage`` writes to, below the shared one.
_area: ContextVar[str] = ContextVar("area", default="llm")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The stored table cuts the lineage: a lost executor costs a read of it, not
    the work that made it.  The folder is the one of ``spark.checkpoint.dir``.
    The tables stay, since the result of an operator may read them at any time;
    inside ``staging_area`` they go at its end.
    """
    spark = df.sparkSession
    path = f"{work_root(spark)}/{_area.get()}/{name}-{uuid.uuid4().hex}"
    with shuffles_cleaned(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Spark's setting by which the shuffle files of a query go when it has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files: what they store is all that is read later."""
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_UP, before)


@contextmanager
def staging_area(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is deleted at the end: store the result before."""
    area = f"llm/area-{uuid.uuid4().hex}"
    token = _area.set(area)
    try:
        yield
    finally:
        _area.reset(token)
        delete(spark, f"{work_root(spark)}/{area}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, whichever that is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: Bytes of an Arrow batch between Spark and Python.  Batches are counted in rows alone
#: otherwise, and thousands of long texts at once are more than a small executor holds.
BATCH_BYTES = 4 << 20

_shipped: set[str] = set()


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package sent to the executors, once per application,
    and with batches of bounded size."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        scratch = tempfile.mkdtemp(prefix="layerstar-code-")    # on the driver; Spark sends the file out
        spark.sparkContext.addPyFile(shutil.make_archive(
            os.path.join(scratch, "layerstar"), "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(app)
    return df.mapInArrow(fn, schema)


def reshuffled(df: DataFrame, key: str) -> DataFrame:
    """``df``, grouped by the long ``key``, for a join on it whose other side may have a hot key.

    Spark joins a grouped table where its groups lie and then cannot split the
    other side's hot partition.  The no-op on the key makes it shuffle the (small)
    grouped side once more, and the skew join is free to split.
    """
    return df.withColumn(key, F.col(key).bitwiseXOR(F.lit(0).cast("long")))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(df: DataFrame, order: Sequence[str], weight: str | None = None,
                group: str | None = None, name: str = "ranks") -> DataFrame:
    """Global running sums without a global sort in one task.

    Adds ``_rank`` (0-based position of the row in its ``group``, or in the
    whole table) and, with ``weight``, ``_before`` (sum of the weights of the
    rows before it) and ``_total``.  The rows are range-partitioned by
    (group, order), stored with their partition number, and each partition's
    totals are turned into offsets; within a partition a window counts on.
    Rows equal in every order column are told apart by their scan position, so
    even one value holding most rows is cut into many partitions.  ``group``
    must not be NULL.
    """
    spark = df.sparkSession
    n = shuffle_partitions(spark)
    keys = ([group] if group else []) + list(order) + ["_scan"]
    w = F.col(weight) if weight else F.lit(0)
    rows = stage(
        df.withColumn("_scan", F.monotonically_increasing_id())
          .repartitionByRange(n, *[F.col(k).asc_nulls_first() for k in keys])
          .withColumn("_part", F.spark_partition_id()), name)
    by = ["_part"] + ([group] if group else [])
    totals = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"),
                                   F.sum(w.cast("long")).alias("_w"))
    # one row per stored partition (and group in it): bounded by the partition count
    over = Window.partitionBy(group) if group else Window.partitionBy(F.lit(0))
    earlier = over.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_w0"),
        F.sum("_w").over(over).alias("_total"))
    inside = Window.partitionBy(*by).orderBy(*[F.col(k).asc_nulls_first() for k in [*order, "_scan"]])
    out = rows.join(offsets, by).withColumn("_rank", F.col("_n0") + F.row_number().over(inside) - 1)
    if weight:
        running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = out.withColumn("_before", F.col("_w0") + F.sum(F.col(weight)).over(running) - F.col(weight))
    else:
        out = out.drop("_total")
    return out.drop("_n0", "_w0", "_scan")


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def one_text(rows: DataFrame, *keys: str, text_col: str = "_text") -> DataFrame:
    """One row per key with its text of least hash.  A task holds one text at a time, and of a key on
    many rows each task sends one."""
    least = F.min(F.struct(F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text")))
    return rows.groupBy(*keys).agg(least.alias("_least")).select(*keys, F.col("_least.text").alias(text_col))
