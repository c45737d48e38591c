"""Reading source files, writing layers, publishing a load as a
whole, the load audit, and schema listings.

Layout (S5): ``<root>/<layer>/runs/<run_id>/<table>`` holds the data of one
load; ``<root>/<layer>/_published`` holds one small numbered file per finished
load, with its run id.  Readers take the run of the highest number, so a load
that fails half way is never seen (S3), and the order of loads is that of their
numbers, whatever the drivers' clocks say.  ``<root>/_audit`` collects one row per table and
per batch (S4).
"""

from __future__ import annotations

import datetime as _dt
import threading
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerstar.session import work_root

CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": "",                       # quotes are plain text (SURVEY M20)
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "",                   # an empty field is NULL
    "dateFormat": "yyyy-MM-dd",
}

AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("layer", T.StringType()),
    T.StructField("table", T.StringType()), T.StructField("rows", T.LongType()),
    T.StructField("started", T.TimestampType()), T.StructField("ended", T.TimestampType()),
    T.StructField("seconds", T.DoubleType()), T.StructField("status", T.StringType()),
    T.StructField("message", T.StringType()),
])


#: Where a permissive read keeps the text of a line that does not fit the schema.
BAD_LINE = "__bad_line"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One CSV source into a declared schema: header skipped, comma, no
    quoting, empty -> NULL, malformed lines stop the load."""
    return (spark.read.schema(schema).options(**CSV_OPTIONS)
            .option("mode", "FAILFAST").csv(path))


def split_csv(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """S1 that goes on at bad lines: (rows of the lines that fit the schema, the other lines).

    A line is bad when it has too few or too many fields or a field that does not
    parse as its type.  Bad lines come whole, as ``line``, with the ``file`` they
    stand in and with those fields that did parse.
    """
    kept = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    lines = (spark.read.schema(kept).options(**CSV_OPTIONS).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", BAD_LINE).option("columnPruning", "false").csv(path))
    good = lines.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE)
    # all columns are kept: the reader only looks at fields that are asked for
    bad = lines.where(F.col(BAD_LINE).isNotNull()).withColumn("file", F.input_file_name()).withColumnRenamed(BAD_LINE, "line")
    return good, bad


#: Lines of a file of an extract: a compressed file is read by one task.
CSV_LINES = 1_000_000


def write_csv(df: DataFrame, path: str) -> None:
    """Write a source extract the way S1 reads it (no quoting, spaces kept): LZ4
    files of ``CSV_LINES`` lines at most."""
    (df.write.mode("overwrite").options(**CSV_OPTIONS).option("quote", "\u0000")
       .option("emptyValue", "").option("compression", "lz4")
       .option("maxRecordsPerFile", CSV_LINES).csv(path))


@dataclass(frozen=True)
class FileLayout:
    """How a table's rows lie in its files, so that readers skip row groups.

    ``range_by``: files hold ranges of these columns and are sorted by them, so the least and greatest
    value of a row group are close.  Later columns split the rows of a hot first value over files.
    ``bloom``: columns with a Bloom filter per row group, sized by their distinct values, for lookups of
    one key; a row group that holds a column by dictionary is skipped by the dictionary instead."""

    range_by: tuple[str, ...]
    bloom: tuple[str, ...] = ()

    def arrange(self, df: DataFrame) -> DataFrame:
        return df.repartitionByRange(*self.range_by).sortWithinPartitions(*self.range_by)

    def options(self) -> dict[str, str]:
        if not self.bloom:
            return {}
        return {"parquet.bloom.filter.adaptive.enabled": "true",
                **{f"parquet.bloom.filter.enabled#{c}": "true" for c in self.bloom}}


def write_full(df: DataFrame, path: str, **options: str) -> None:
    """Full refresh of one table (replace all rows), zstd-compressed whatever the session's codec."""
    df.write.mode("overwrite").options(**{"compression": "zstd", **options}).parquet(path)


@dataclass(frozen=True)
class Layers:
    """The layer layout under one root folder."""

    root: str

    @classmethod
    def under(cls, spark: SparkSession, name: str = "warehouse") -> "Layers":
        return cls(f"{work_root(spark)}/{name}")

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    def run_path(self, layer: str, run_id: str, table: str) -> str:
        return f"{self.root}/{layer}/runs/{run_id}/{table}"

    def log_path(self, layer: str) -> str:
        return f"{self.root}/{layer}/_published"

    @property
    def audit_path(self) -> str:
        return f"{self.root}/_audit"

    def current_run(self, spark: SparkSession, layer: str) -> str:
        """The newest published run of a layer (S3 pointer)."""
        numbers = _pointers(spark, self.log_path(layer))
        if not numbers:
            raise LookupError(f"no published {layer} load under {self.root}")
        return _pointed(spark, self.log_path(layer), numbers[-1])

    def table(self, spark: SparkSession, layer: str, table: str,
              run_id: str | None = None) -> DataFrame:
        run_id = run_id or self.current_run(spark, layer)
        return spark.read.parquet(self.run_path(layer, run_id, table))


def publish(spark: SparkSession, layers: Layers, layer: str, run_id: str) -> None:
    """S3: make a finished run visible.  Called only after every table of the
    run is written.

    The commit point is the creation of the next numbered file, which fails if
    another load has created it meanwhile; this load then takes the number after.
    So any number of loads that race leave one order, and none is lost.  The file
    system must create a file for one caller only, as HDFS and stores with
    conditional writes do; a local folder does within one driver.
    """
    log = layers.log_path(layer)
    while True:
        number = (_pointers(spark, log) or [0])[-1] + 1
        if _create(spark, f"{log}/{number:012d}", run_id):
            return


_CREATE = threading.Lock()


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new small file; False if there is one already."""
    fs, target = _file_system(spark, path)
    with _CREATE:
        try:
            out = fs.create(target, False)
        except Py4JJavaError as exc:
            if exc.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException" or fs.exists(target):
                return False
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
    return True


def _pointers(spark: SparkSession, log: str) -> list[int]:
    """The numbers of the published loads, ascending."""
    fs, folder = _file_system(spark, log)
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def _pointed(spark: SparkSession, log: str, number: int) -> str:
    fs, path = _file_system(spark, f"{log}/{number:012d}")
    while True:                 # a file just created may still be empty: its load is about to fill it
        stream = fs.open(path)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        if text:
            return text
        time.sleep(0.05)


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system and path object of ``path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def published_runs(spark: SparkSession, layers: Layers, layer: str) -> list[str]:
    """The published runs of a layer, oldest first."""
    log = layers.log_path(layer)
    return [_pointed(spark, log, n) for n in _pointers(spark, log)]


def old_runs(spark: SparkSession, layers: Layers, layer: str, keep: int = 2,
             log_layer: str | None = None) -> list[str]:
    """Published runs of a layer that are older than its ``keep`` newest ones and
    still on disk, oldest first.  ``log_layer`` is the layer whose log publishes
    them (for staging tables).

    Run ids begin with their UTC start time.  A run that is not in the log is
    never listed: it may be a load that has yet to finish."""
    if keep < 1:
        raise ValueError("the newest published run is always kept")
    published = published_runs(spark, layers, log_layer or layer)[::-1]
    fs, runs = _file_system(spark, f"{layers.root}/{layer}/runs")
    there = {f.getPath().getName() for f in fs.listStatus(runs)} if fs.exists(runs) else set()
    return [r for r in reversed(published[keep:]) if r in there]


def remove_runs(spark: SparkSession, layers: Layers, layer: str, run_ids: list[str], keep: int = 2,
                log_layer: str | None = None) -> list[str]:
    """Delete the data of runs that ``old_runs`` lists; the truncate-and-reload of
    a layer keeps one copy, this keeps ``keep`` of them.

    Only on request and only the runs named: whoever asks knows that no reader
    holds them.  A run that is not in the list is an error, and then none is
    deleted.  The log and the audit keep their rows."""
    old = old_runs(spark, layers, layer, keep, log_layer)
    if wrong := [r for r in run_ids if r not in old]:
        raise ValueError(f"not an old run of {layer}: {', '.join(wrong)}")
    for run_id in run_ids:
        fs, path = _file_system(spark, f"{layers.root}/{layer}/runs/{run_id}")
        fs.delete(path, True)
    return run_ids


def new_run_id() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]


def _write_one(spark, layers, layer, run_id, table, build, measures, layout):
    started, s0 = _dt.datetime.now(), time.perf_counter()
    try:
        obs = Observation(f"rows_{layer}_{table}_{uuid.uuid4().hex[:6]}")
        df = build()
        if layout:                  # before the observation: ranging looks at its input twice
            df = layout.arrange(df)
        asked = measures(table, df) if measures else {}
        cells = [m.cast("long").alias(f"m{i}") for i, m in enumerate(asked.values())]
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"), *cells)
        write_full(df, layers.run_path(layer, run_id, table), **(layout.options() if layout else {}))
        got = obs.get
        taken = [(f"{layer}.{table}", name, got[f"m{i}"]) for i, name in enumerate(asked)]
        return (run_id, layer, table, int(got.get("rows", 0)), started, _dt.datetime.now(),
                time.perf_counter() - s0, "ok", None), None, taken
    except Exception as exc:  # noqa: BLE001 - recorded, then raised again
        return (run_id, layer, table, None, started, _dt.datetime.now(),
                time.perf_counter() - s0, "failed", str(exc)), exc, []


#: The table of a run that holds what was measured while its tables were written.
MEASURES = "check_measures"
MEASURES_SCHEMA = "scan string, check string, found long"


def measured(spark: SparkSession, layers: Layers, layer: str, run_id: str | None = None) -> DataFrame | None:
    """What the load of a run measured on its writes, (scan, check, found); None if it measured nothing."""
    path = layers.run_path(layer, run_id or layers.current_run(spark, layer), MEASURES)
    fs, folder = _file_system(spark, path)
    return spark.read.schema(MEASURES_SCHEMA).parquet(path) if fs.exists(folder) else None


def load_tables(spark: SparkSession, layers: Layers, layer: str,
                steps: Mapping[str, Callable[[], DataFrame]], run_id: str | None = None,
                raise_errors: bool = True, groups: list[list[str]] | None = None,
                parallel: int = 4, accept: Callable[[dict[str, int]], None] | None = None,
                measures: Callable[[str, DataFrame], dict[str, Column]] | None = None,
                layouts: Mapping[str, FileLayout] | None = None) -> tuple[str, DataFrame]:
    """Run one load: for every table build its DataFrame, write it (S2) and time
    it; then publish the run (S3) and append the audit rows (S4).

    ``groups`` orders the tables: the groups run one after another, the tables
    of a group are independent and are written by up to ``parallel`` concurrent
    Spark jobs (small tables then share the cluster with a big one instead of
    waiting for it).  By default all tables form one group.  Rows are counted by
    an observation on the write itself, no extra scan.  On an error the audit
    rows are written first, then the error is raised again; nothing of the
    failed run is published.  ``accept`` sees the rows of every table before the
    run is published and raises an error to refuse it.  ``measures`` gives the
    aggregates to take of a table (by its name and the rows about to be written): they ride on
    the same observation, in the stage that writes, and are stored with the run, where
    ``measured`` finds them.  ``layouts`` gives the file layout of tables that have one.
    """
    from concurrent.futures import ThreadPoolExecutor

    run_id = run_id or new_run_id()
    groups = groups or [list(steps)]
    audit: list[tuple] = []
    taken: list[tuple] = []
    batch_start = _dt.datetime.now()
    t0 = time.perf_counter()
    error: BaseException | None = None
    for group in groups:
        workers = max(1, min(parallel, len(group)))
        with ThreadPoolExecutor(max_workers=workers) as pool:
            done = list(pool.map(lambda t: _write_one(spark, layers, layer, run_id, t, steps[t], measures,
                                                          (layouts or {}).get(t)),
                                 group))
        for row, exc, found in done:
            audit.append(row)
            taken += found
            if exc is not None and error is None:
                error = exc
        if error is not None:
            break
    if error is None and accept is not None:
        try:
            accept({a[2]: a[3] for a in audit})
        except Exception as exc:  # noqa: BLE001 - recorded, then raised again
            error = exc
    status = "ok" if error is None else "failed"
    audit.append((run_id, layer, "*", sum(a[3] or 0 for a in audit), batch_start,
                  _dt.datetime.now(), time.perf_counter() - t0, status,
                  None if error is None else str(error)))
    audit_df = spark.createDataFrame(audit, AUDIT_SCHEMA)
    audit_df.coalesce(1).write.mode("append").parquet(layers.audit_path)
    if error is not None:
        if raise_errors:
            raise error
        return run_id, audit_df
    if taken:
        spark.createDataFrame(taken, MEASURES_SCHEMA).coalesce(1).write.parquet(layers.run_path(layer, run_id, MEASURES))
    publish(spark, layers, layer, run_id)
    return run_id, audit_df


def register_views(spark: SparkSession, frames: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Gold objects and reports as re-creatable temporary views."""
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)


def preview(df: DataFrame, n: int = 10, order_by=None) -> DataFrame:
    """The first ``n`` rows (TOP (n) *); with ``order_by`` the first by that
    order (a top-n: each task keeps its n best, one small merge)."""
    if order_by is not None:
        cols = [order_by] if isinstance(order_by, str) else list(order_by)
        return df.orderBy(*cols).limit(n)
    return df.limit(n)


def describe_columns(spark: SparkSession, frames: Mapping[str, DataFrame],
                     table: str | None = None, layer: str | None = None,
                     max_length: Mapping[str, Mapping[str, int]] | None = None,
                     measured: bool = False) -> DataFrame:
    """One row per column: table, position, name, type, declared text
    length (when ``max_length`` knows it), nullability.

    Schemas live on the driver already (no data is read).  ``measured`` adds what
    the stored rows hold: the number of NULLs and the longest text (LEN), from one
    aggregate per table."""
    rows = []
    for name, df in frames.items():
        if table is not None and name != table:
            continue
        lengths = (max_length or {}).get(name, {})
        for i, f in enumerate(df.schema.fields, start=1):
            rows.append((layer, name, i, f.name, f.dataType.simpleString(), lengths.get(f.name),
                         f.nullable))
    listed = spark.createDataFrame(
        rows, "table_schema string, table_name string, ordinal_position int, "
              "column_name string, data_type string, character_maximum_length int, "
              "is_nullable boolean")
    if not measured:
        return listed
    found = None
    for name in dict.fromkeys(r[1] for r in rows):
        cells = []
        for f in frames[name].schema.fields:
            longest = f"max(length(rtrim(`{f.name}`)))" if isinstance(f.dataType, T.StringType) else "CAST(NULL AS INT)"
            cells.append(f"named_struct('table_name', '{name}', 'column_name', '{f.name}', "
                         f"'null_count', count_if(`{f.name}` IS NULL), 'longest', {longest})")
        one = frames[name].agg(F.expr(f"array({', '.join(cells)})").alias("c")).select(F.inline("c"))
        found = one if found is None else found.unionByName(one)
    return listed if found is None else listed.join(found, ["table_name", "column_name"], "left").select(
        *listed.columns, "null_count", "longest")


def describe_tables(spark: SparkSession, layered: Mapping[str, Mapping[str, DataFrame]], measured: bool = False) -> DataFrame:
    """One row per table of each layer; ``measured`` adds the number of its stored rows."""
    rows = [(layer, name, "BASE TABLE" if layer in ("bronze", "silver") else "VIEW")
            for layer, frames in layered.items() for name in frames]
    listed = spark.createDataFrame(rows, "table_schema string, table_name string, table_type string")
    found = None
    for layer, name, _ in rows if measured else []:
        one = layered[layer][name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("table_schema"), F.lit(name).alias("table_name"), "row_count")
        found = one if found is None else found.unionByName(one)
    return listed if found is None else listed.join(found, ["table_schema", "table_name"]).select(*listed.columns, "row_count")
