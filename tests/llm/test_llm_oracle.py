"""The registered queries against their DuckDB SQL."""

import os
import re

import pytest

from layerstar.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not available")
def test_queries_match_their_sql(spark):
    import tools_compare
    names = list(registry.oracle_sql())
    assert set(names) <= set(registry.queries())
    found = tools_compare.compare(spark, SF, names)
    assert {n: r[0] for n, r in found.items()} == dict.fromkeys(names, "ok")


def test_unseen_hosts_ports_and_wide_suffixes_match_the_sql(spark, tmp_path):
    """op1 and its SQL on hosts with and without outcomes, at every level of the hierarchy."""
    import tools_compare
    rates = {"a.bad.co.uk": (300, 290), "b.bad.co.uk:801": (200, 190), "good.co.uk": (400, 4), "x.one.spam": (300, 290),
             "u:p@y.two.spam.": (300, 297), "10.0.0.1:80": (90, 88), "10.0.0.2": (90, 1), "b.org": (50, 1), "[::1]:8": (9, 9)}
    urls = [(f"http://{h}/{k}", int(k >= bad)) for h, (n, bad) in rates.items() for k in range(n)]
    fresh = ["c.bad.co.uk", "bad.co.uk:8080", "other.co.uk", "co.uk", "new.three.spam", "x.one.spam:81", "10.0.0.1", "10.0.0.3",
             "nowhere.else", "", "b.org.", "a\nb.org", "d.b.org@e.spam"]
    urls += [(f"https://{h}/p?q", None) for h in fresh] + [(None, None), ("no url", 1), ("ftp://a.net/fr/1", 0)]
    spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id long, url string").toPandas().to_parquet(
        tmp_path / "pages.parquet")
    spark.createDataFrame([(i, q) for i, (_, q) in enumerate(urls)], "doc_id long, quality int").toPandas().astype(
        {"quality": "Int64"}).to_parquet(tmp_path / "labels.parquet")
    assert tools_compare.compare(spark, str(tmp_path), ["op1_url_filter"])["op1_url_filter"] == ("ok", len(urls), len(urls))
    got = {r.host: r.verdict for r in registry.op1_url_filter(spark, str(tmp_path)).collect()}
    assert [got[h] for h in ("c.bad.co.uk", "bad.co.uk:8080", "other.co.uk", "new.three.spam", "10.0.0.1", "b.org.")] == [
        "block", "block", "allow", "block", "block", "allow"]


def test_one_query_per_operator():
    assert [n.split("_")[0] for n in registry.queries()] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not available")
def test_sharding_is_native_and_reads_no_column_in_vain(spark):
    plan = registry.op2_sharding(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow|CartesianProduct|NestedLoop", plan)
    assert "text" not in plan.split("ReadSchema")[1]       # ranks come from the stored sizes
