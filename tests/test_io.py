"""Reading, full refresh, publish-as-a-whole, audit, listings."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from layerstar.sources.io import (Layers, describe_columns, describe_tables, load_tables, old_runs, preview,
                                  read_csv, remove_runs, register_views, write_csv, write_full)
from layerstar.sources.schemas import BRONZE


def test_csv_round_trip_keeps_spaces_and_nulls(spark):
    d = tempfile.mkdtemp(prefix="csv-", dir=spark.conf.get("spark.checkpoint.dir"))
    df = spark.createDataFrame([(" AW1 ", None, "x"), ("AW2", "F", "y")], "cid string, bdate string, gen string")
    write_csv(df, f"{d}/az")
    back = read_csv(spark, f"{d}/az", BRONZE["erp_cust_az12"])
    assert sorted(tuple(map(str, r)) for r in back.collect()) == [(" AW1 ", "None", "x"), ("AW2", "F", "y")]


def test_read_csv_fails_fast_on_bad_rows(spark):
    d = tempfile.mkdtemp(prefix="bad-", dir=spark.conf.get("spark.checkpoint.dir"))
    with open(os.path.join(d, "c.csv"), "w") as fh:
        fh.write("cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date\n")
        fh.write("notanumber,AW1,A,B,M,F,2020-01-01\n")
    with pytest.raises(Exception):
        read_csv(spark, d, BRONZE["crm_cust_info"]).collect()


def test_publish_and_audit(spark):
    layers = Layers.under(spark, f"t-{dt.datetime.now().timestamp()}")
    ok = {"a": lambda: spark.range(5).toDF("x"), "b": lambda: spark.range(3).toDF("x")}
    run1, audit = load_tables(spark, layers, "bronze", ok)
    assert layers.current_run(spark, "bronze") == run1
    rows = {r.table: (r.rows, r.status) for r in audit.collect()}
    assert rows == {"a": (5, "ok"), "b": (3, "ok"), "*": (8, "ok")}

    def boom():
        return spark.range(1).select(F.raise_error(F.lit("bad row")).alias("x"))
    bad = {"a": lambda: spark.range(7).toDF("x"), "b": boom}
    with pytest.raises(Exception):
        load_tables(spark, layers, "bronze", bad)
    # the failed run is not visible: readers still get the first run
    assert layers.current_run(spark, "bronze") == run1
    assert layers.table(spark, "bronze", "a").count() == 5
    log = spark.read.parquet(layers.audit_path)
    assert log.where("status = 'failed'").count() == 2          # the table and the batch


def test_write_full_replaces(spark):
    d = tempfile.mkdtemp(prefix="wf-", dir=spark.conf.get("spark.checkpoint.dir"))
    write_full(spark.range(10), f"{d}/t")
    write_full(spark.range(3), f"{d}/t")
    assert spark.read.parquet(f"{d}/t").count() == 3


def test_views_preview_listings(spark):
    frames = {"dim_x": spark.range(20).toDF("k"), "fact_y": spark.createDataFrame([(1, "a")], "k long, v string")}
    register_views(spark, frames, prefix="gold_")
    assert spark.sql("SELECT count(*) AS n FROM gold_dim_x").first().n == 20
    assert preview(frames["dim_x"]).count() == 10
    cols = describe_columns(spark, frames, table="fact_y", layer="gold").collect()
    assert [(c.column_name, c.data_type) for c in cols] == [("k", "bigint"), ("v", "string")]
    assert describe_tables(spark, {"gold": frames}).count() == 2


def test_bad_amounts_stop_the_load_or_go_to_quarantine(spark):
    import datetime as _dt
    from layerstar.plans.silver import load_sales_details, silver_steps
    rows = [("SO1", "PK-1", 1, "20100101", "20100105", "20100110", "10.00", "2", "5.00"),
            ("SO2", "PK-2", 2, "20100101", "20100105", "20100110", "ten", "2", "5.00")]
    b = spark.createDataFrame(rows, BRONZE["crm_sales_details"])
    with pytest.raises(Exception):
        load_sales_details(b).collect()
    empty = {t: spark.createDataFrame([], s) for t, s in BRONZE.items()}
    steps = silver_steps({**empty, "crm_sales_details": b}, _dt.date(2001, 9, 1), quarantine=True)
    assert [r.sls_ord_num for r in steps["crm_sales_details"]().collect()] == ["SO1"]
    q = steps["crm_sales_details_quarantine"]().collect()
    assert [(r.sls_ord_num, r.reason) for r in q] == [("SO2", "sls_sales does not parse")]


def test_old_runs_go_on_request_only(spark):
    layers = Layers.under(spark, f"r-{dt.datetime.now().timestamp()}")
    ids = [load_tables(spark, layers, "bronze", {"a": lambda n=n: spark.range(n)})[0] for n in (1, 2, 3)]
    with pytest.raises(Exception):          # a run that fails is never published, nor old
        load_tables(spark, layers, "bronze", {"a": lambda: spark.range(1).select(F.raise_error(F.lit("x")))})
    assert old_runs(spark, layers, "bronze", keep=3) == []
    assert old_runs(spark, layers, "bronze", keep=2) == ids[:1]
    assert old_runs(spark, layers, "bronze", keep=1) == ids[:2]
    with pytest.raises(ValueError):
        remove_runs(spark, layers, "bronze", [ids[0], ids[2]], keep=1)
    with pytest.raises(ValueError):
        old_runs(spark, layers, "bronze", keep=0)
    assert layers.table(spark, "bronze", "a", ids[0]).count() == 1
    remove_runs(spark, layers, "bronze", ids[:1])
    assert old_runs(spark, layers, "bronze", keep=1) == ids[1:2]
    assert layers.table(spark, "bronze", "a").count() == 3
    assert layers.table(spark, "bronze", "a", ids[1]).count() == 2
    with pytest.raises(Exception):
        layers.table(spark, "bronze", "a", ids[0]).count()


def test_whole_error_text_is_stored(spark):
    layers = Layers.under(spark, f"e-{dt.datetime.now().timestamp()}")
    long = "why " * 2000 + "the cause"

    def fail():
        raise RuntimeError(long)
    load_tables(spark, layers, "bronze", {"a": fail}, raise_errors=False)
    messages = {r.message for r in spark.read.parquet(layers.audit_path).collect()}
    assert messages == {long}


def test_a_cluster_needs_a_shared_folder():
    from layerstar.session import is_local, local_root
    assert is_local("local") and is_local("local[4]") and is_local("local[*]")
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://x"):
        assert not is_local(master)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            local_root(master)
    assert os.path.isdir(local_root("local[2]"))


def test_racing_loads_leave_one_order(spark):
    from concurrent.futures import ThreadPoolExecutor

    from layerstar.sources import io
    layers = Layers.under(spark, f"race-{dt.datetime.now().timestamp()}")
    with pytest.raises(LookupError):
        layers.current_run(spark, "bronze")
    names = [f"run-{i:02d}" for i in range(12)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda n: io.publish(spark, layers, "bronze", n), names))
    log = layers.log_path("bronze")
    numbers = io._pointers(spark, log)
    assert numbers == list(range(1, 13)) and sorted(io._pointed(spark, log, n) for n in numbers) == names
    assert layers.current_run(spark, "bronze") == io._pointed(spark, log, 12)
    assert not io._create(spark, f"{log}/{12:012d}", "late") and io._pointed(spark, log, 12) != "late"
    io.publish(spark, layers, "bronze", "20000101T000000-slow-clock")       # the later load counts, not the later clock
    assert layers.current_run(spark, "bronze") == "20000101T000000-slow-clock"


def test_bad_lines_go_to_rejects_within_the_budget(spark):
    from layerstar.plans import warehouse as W
    from layerstar.sources.extracts import EXTRACTS
    from layerstar.sources.io import new_run_id
    wh = W.Warehouse(spark, Layers.under(spark, f"bad-{new_run_id()}"))
    wh.runs["source"] = new_run_id()
    for t in EXTRACTS:
        folder = wh.source_path(t).removeprefix("file://")
        os.makedirs(folder)
        lines = [",".join(BRONZE[t].fieldNames())]
        if t == "crm_cust_info":
            lines += ["1,AW1,a,b,M,F,2020-01-01", "x,AW2,a,b,M,F,2020-01-01", "3,AW3,a,b,M,F,2020-13-01", "4,AW4", "5,AW5,a,b,M,F,2020-01-01,more",
                      "6,AW6,,,,,"]
        with open(f"{folder}/part.csv", "w") as f:
            f.write("\n".join(lines) + "\n")
    with pytest.raises(Exception):
        W.load_bronze(wh)
    with pytest.raises(W.TooManyBadLines, match="crm_cust_info 4"):
        W.load_bronze(wh, bad_lines=3)
    with pytest.raises(LookupError):
        wh.layers.current_run(spark, "bronze")                                # nothing was published
    W.load_bronze(wh, bad_lines=4)
    assert {r.cst_id for r in wh.bronze("crm_cust_info").collect()} == {1, 6}
    rejects = wh._t("bronze", "crm_cust_info_rejects").collect()
    assert sorted(r.line for r in rejects) == ["3,AW3,a,b,M,F,2020-13-01", "4,AW4", "5,AW5,a,b,M,F,2020-01-01,more", "x,AW2,a,b,M,F,2020-01-01"]
    assert all(r.file.endswith("part.csv") for r in rejects)
    assert wh._t("bronze", "erp_loc_a101_rejects").count() == 0
    status = [r.status for r in spark.read.parquet(wh.layers.audit_path).where("`table` = '*'").orderBy("started").collect()]
    assert status == ["failed", "failed", "ok"]
