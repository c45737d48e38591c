"""The refresh: extracts -> bronze -> silver -> gold, each layer
written once per load and published as a whole.

Gold is materialised too (§3.2): the surrogate keys are numbered once per
refresh and every query reads the same numbers back.
"""

from __future__ import annotations

import datetime as _dt
import os
import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from layerstar.plans import gold as G
from layerstar.plans.rollup import ROLLUPS, Rollups, rollup_steps
from layerstar.plans.silver import silver_steps
from layerstar.sources.extracts import EXTRACTS, build_extracts
from layerstar.sources.io import (FileLayout, Layers, load_tables, measured, new_run_id, published_runs, read_csv, split_csv,
                                  write_csv)
from layerstar.sources.schemas import BRONZE

# Fixed parameters for the driver tables: the day that stands for
# GETDATE(), and the load time stamped on silver rows.
AS_OF = _dt.date(2001, 9, 1)
LOAD_TIME = _dt.datetime(2001, 9, 1, 0, 0, 0)

#: Sales lie by date, those of a date by product and customer; NULL dates come first, in row groups of their own.
FACT_LAYOUT = FileLayout(("order_date", "product_key", "customer_key", "order_number"),
                         ("product_key", "customer_key", "order_number"))
GOLD_TABLES = ["dim_customers", "dim_products", "fact_sales"]


@dataclass
class Warehouse:
    spark: SparkSession
    layers: Layers
    runs: dict[str, str] = field(default_factory=dict)
    as_of: _dt.date = AS_OF
    audits: list[DataFrame] = field(default_factory=list)
    _rollups: dict[str, Rollups] = field(default_factory=dict, repr=False)

    def _t(self, layer: str, table: str) -> DataFrame:
        return self.layers.table(self.spark, layer, table, self.runs.get(layer))

    def source(self, table: str) -> DataFrame:
        return read_csv(self.spark, self.source_path(table), BRONZE[table])

    def source_path(self, table: str) -> str:
        return self.layers.run_path("source", self.runs["source"], table)

    def bronze(self, table: str) -> DataFrame:
        return self._t("bronze", table)

    def silver(self, table: str) -> DataFrame:
        return self._t("silver", table)

    def gold(self, table: str) -> DataFrame:
        return self._t("gold", table)

    def measures(self, layer: str):
        """The measures of a layer's row checks, for its load to take on the write (``load_tables``)."""
        from layerstar.plans.checks import row_measures
        return lambda table, df: row_measures(layer, table, df, self.as_of)

    def measured(self) -> DataFrame | None:
        """What the current loads measured on their writes."""
        out = None
        for layer in ("bronze", "silver"):
            one = measured(self.spark, self.layers, layer, self.runs.get(layer))
            out = one if out is None else out if one is None else out.unionByName(one)
        return out

    @property
    def rollup_layers(self) -> Layers:
        """Where roll-ups are loaded, with a log and an audit of their own."""
        return Layers(f"{self.layers.root}/rollups")

    def rollups(self) -> Rollups | None:
        """The roll-ups of the gold run that is read; None if that run has none (yet)."""
        run = self.runs.get("gold") or self.layers.current_run(self.spark, "gold")
        if run not in self._rollups:                   # a published run never changes
            if run not in published_runs(self.spark, self.rollup_layers, "gold"):
                return None
            self._rollups[run] = Rollups(*[self.rollup_layers.table(self.spark, "gold", t, run) for t in ROLLUPS])
        return self._rollups[run]

    def layer(self, layer: str) -> dict[str, DataFrame]:
        names = GOLD_TABLES if layer == "gold" else EXTRACTS
        return {n: self._t(layer, n) for n in names}


def write_extracts(spark: SparkSession, sf_dir: str, layers: Layers, run_id: str,
                   parallel: int = 4) -> None:
    """The source systems' files, as CSV (what the bronze load reads); the six
    files are independent and written by concurrent jobs."""
    from concurrent.futures import ThreadPoolExecutor
    ex = build_extracts(spark, sf_dir)
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        list(pool.map(lambda n: write_csv(ex[n], layers.run_path("source", run_id, n)), ex))


class TooManyBadLines(ValueError):
    """More lines of a source do not fit its schema than the load allows; nothing was published."""


def load_bronze(wh: Warehouse, bad_lines: int | None = None) -> str:
    """Entry point 1, bronze: each CSV into its declared schema (S1 -> S2).

    By default the first line that does not fit stops the load.  With
    ``bad_lines`` a source may have up to so many: they are stored whole in
    ``<table>_rejects`` of the same run, and the other lines are loaded.  Over
    that budget nothing is published."""
    if bad_lines is None:
        steps, accept = {t: (lambda t=t: wh.source(t)) for t in EXTRACTS}, None
    else:
        steps = {}
        for t in EXTRACTS:
            good, bad = split_csv(wh.spark, wh.source_path(t), BRONZE[t])
            steps |= {t: (lambda df=good: df), f"{t}_rejects": (lambda df=bad: df)}

        def accept(rows: dict[str, int]) -> None:
            over = {t: rows[f"{t}_rejects"] for t in EXTRACTS if rows[f"{t}_rejects"] > bad_lines}
            if over:
                raise TooManyBadLines(f"over {bad_lines} bad lines: " + ", ".join(f"{t} {n}" for t, n in over.items()))
    run_id, audit = load_tables(wh.spark, wh.layers, "bronze", steps, accept=accept, measures=wh.measures("bronze"))
    wh.audits.append(audit)
    wh.runs["bronze"] = run_id
    return run_id


def load_silver(wh: Warehouse, now: _dt.datetime | None = LOAD_TIME,
                quarantine: bool = False) -> str:
    """Entry point 1, silver: L1-L6 over the published bronze load.  By default
    a sales row whose amounts do not parse stops the load; ``quarantine=True``
    writes such rows to ``crm_sales_details_quarantine`` instead."""
    bronze = wh.layer("bronze")
    run_id, audit = load_tables(wh.spark, wh.layers, "silver",
                                silver_steps(bronze, wh.as_of, now, quarantine),
                                measures=wh.measures("silver"))
    wh.audits.append(audit)
    wh.runs["silver"] = run_id
    return run_id


def load_gold(wh: Warehouse) -> str:
    """Gold: both dimensions, then the fact against the written dimensions.

    The joined dimension rows are stored once, by ranges of their order, as
    staging tables of the run; the surrogate keys are numbered from those."""
    s = wh.layer("silver")
    run_id = new_run_id()
    sp, lay = wh.spark, wh.layers

    def stage(name):
        return lay.run_path("gold_stage", run_id, name)
    steps = {
        "dim_customers": lambda: G.dim_customers(s["crm_cust_info"], s["erp_cust_az12"],
                                                 s["erp_loc_a101"], stage("customers")),
        "dim_products": lambda: G.dim_products(s["crm_prd_info"], s["erp_px_cat_g1v2"],
                                               stage("products")),
        "fact_sales": lambda: G.fact_sales(
            s["crm_sales_details"], lay.table(sp, "gold", "dim_customers", run_id),
            lay.table(sp, "gold", "dim_products", run_id)),
    }
    run_id, audit = load_tables(sp, lay, "gold", steps, run_id=run_id,
                                groups=[["dim_customers", "dim_products"], ["fact_sales"]],
                                layouts={"fact_sales": FACT_LAYOUT})
    wh.audits.append(audit)
    wh.runs["gold"] = run_id
    return run_id


def load_rollups(wh: Warehouse) -> str:
    """The roll-ups of the current gold run, from its stored fact, under the same run id.

    A load of its own, after gold is published: readers see gold at once and take the fact until the
    roll-ups are there, and roll-ups of an older gold run are never read beside a newer fact."""
    run_id = wh.runs.get("gold") or wh.layers.current_run(wh.spark, "gold")
    load_tables(wh.spark, wh.rollup_layers, "gold", rollup_steps(lambda: wh.gold("fact_sales")), run_id=run_id)
    return run_id


def build_warehouse(spark: SparkSession, sf_dir: str, as_of: _dt.date = AS_OF,
                    now: _dt.datetime | None = LOAD_TIME, layers: Layers | None = None) -> Warehouse:
    """Run the whole refresh over the driver tables in ``sf_dir``."""
    layers = layers or Layers.under(spark, f"warehouse-{new_run_id()}")
    wh = Warehouse(spark, layers, as_of=as_of)
    run_id = new_run_id()
    write_extracts(spark, sf_dir, layers, run_id)
    wh.runs["source"] = run_id
    load_bronze(wh)
    load_silver(wh, now)
    load_gold(wh)
    load_rollups(wh)
    return wh


_CACHE: dict[tuple, Warehouse] = {}
_LOCK = threading.Lock()


def warehouse_for(spark: SparkSession, sf_dir: str, as_of: _dt.date = AS_OF) -> Warehouse:
    """The warehouse of ``sf_dir`` built once per session and reused."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), as_of)
    with _LOCK:
        wh = _CACHE.get(key)
        if wh is None:
            wh = build_warehouse(spark, sf_dir, as_of)
            _CACHE[key] = wh
        return wh


def register_views(wh: Warehouse, as_of: _dt.date | None = None,
                   reports: dict[str, DataFrame] | None = None) -> list[str]:
    """Gold tables and both reports as temporary views (gold_dim_customers,
    gold_dim_products, gold_fact_sales, gold_report_customers,
    gold_report_products).  ``reports`` replaces the reports with default
    thresholds by others of the same names."""
    from layerstar.plans import reports as R
    from layerstar.sources.io import register_views as _register
    f, c, p = wh.gold("fact_sales"), wh.gold("dim_customers"), wh.gold("dim_products")
    as_of = as_of or wh.as_of
    frames = {"dim_customers": c, "dim_products": p, "fact_sales": f,
              "report_customers": R.report_customers(f, c, as_of),
              "report_products": R.report_products(f, p, as_of), **(reports or {})}
    _register(wh.spark, frames, prefix="gold_")
    return ["gold_" + n for n in frames]


def describe(wh: Warehouse, table: str | None = None, measured: bool = False) -> tuple[DataFrame, DataFrame]:
    """S9 over the warehouse: (tables, columns) listings for all three layers."""
    from layerstar.sources.io import describe_columns, describe_tables
    from layerstar.sources.schemas import MAX_LENGTH
    layered = {lay: wh.layer(lay) for lay in ("bronze", "silver", "gold")}
    cols = None
    for lay, frames in layered.items():
        d = describe_columns(wh.spark, frames, table, lay, MAX_LENGTH.get(lay), measured)
        cols = d if cols is None else cols.unionByName(d)
    return describe_tables(wh.spark, layered, measured), cols
