"""Command line: run the refresh, the checks of a layer, or one query.

    python -m layerstar refresh  --sf /root/testdata/sf0.01
    python -m layerstar checks   --sf /root/testdata/sf0.01 --layer silver
    python -m layerstar query A7 --sf /root/testdata/sf0.01 [--rows 20] [--display]
"""

from __future__ import annotations

import argparse


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="layerstar")
    ap.add_argument("command", choices=["refresh", "checks", "query"])
    ap.add_argument("name", nargs="?")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--layer", choices=["bronze", "silver", "gold"])
    ap.add_argument("--rows", type=int, default=20)
    ap.add_argument("--master", default=None)
    ap.add_argument("--display", action="store_true", help="money and percent as text")
    a = ap.parse_args(argv)

    from layerstar.session import get_session
    from layerstar.plans.warehouse import warehouse_for
    spark = get_session(a.master)
    wh = warehouse_for(spark, a.sf)
    if a.command == "refresh":
        for audit in wh.audits:
            audit.orderBy("started").show(50, truncate=False)
        print("root:", wh.layers.root, "runs:", wh.runs)
    elif a.command == "checks":
        from layerstar.plans.checks import run_layer_checks
        run_layer_checks(wh, a.layer).show(200, truncate=False)
    else:
        from layerstar.plans.catalog import queries
        from layerstar.plans.display import display
        df = queries()[a.name](spark, a.sf)
        (display(a.name, df) if a.display else df).show(a.rows, truncate=False)


if __name__ == "__main__":
    main()
