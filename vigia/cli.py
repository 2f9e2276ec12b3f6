"""Command line: build a warehouse from notification CSV files, add files to
it, delete notifications from it, export it in its declared types, or report on it.

    python -m vigia.cli etl --csv 'in/*.csv' --out /shared/warehouse [--active-only] [--seed dim_tipos_testes=types.parquet]
    python -m vigia.cli etl --append --load 2021-05 --csv 'may/*.csv' --out /shared/warehouse
    python -m vigia.cli delete --warehouse /shared/warehouse --ids excluded.parquet
    python -m vigia.cli export --warehouse /shared/warehouse --out /shared/declared
    python -m vigia.cli report --warehouse /shared/warehouse [--state PA] [--municipality Belém]

``etl`` prints the observed row counts; ``report`` prints the headline
indicators and the top lists (only these few result rows reach the driver).
"""

from __future__ import annotations

import argparse
import json
from datetime import datetime


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="vigia")
    sub = ap.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("etl", help="CSV files -> published warehouse")
    e.add_argument("--csv", required=True, help="file, folder or glob of notification CSV files")
    e.add_argument("--out", required=True, help="warehouse folder (shared storage on a cluster)")
    e.add_argument("--active-only", action="store_true", help="drop rows flagged as excluded")
    e.add_argument("--multi-line", action="store_true", help="quoted fields may hold newlines")
    e.add_argument("--date-format", action="append", default=None, metavar="PATTERN",
                   help="date pattern to try, in order (default: day-first and ISO)")
    e.add_argument("--allow-bad-cells", action="store_true",
                   help="load even if cells of required columns can't be typed")
    e.add_argument("--gate", choices=["fail", "report", "quarantine", "off"], default="fail")
    e.add_argument("--seed", action="append", default=[], metavar="TABLE=PARQUET",
                   help="rows of dim_tipos_testes or dim_fabricantes (a Parquet path each)")
    e.add_argument("--append", action="store_true",
                   help="add to the published warehouse: ids follow the largest one, known dimension ids stay")
    e.add_argument("--load", default=None, metavar="NAME",
                   help="with --append: name of the load; a load that is already there is not added again")
    d = sub.add_parser("delete", help="delete notifications and what refers to them (a new version)")
    d.add_argument("--warehouse", required=True)
    d.add_argument("--ids", required=True, help="Parquet with a column id_notificacao")
    x = sub.add_parser("export", help="the tables of a published warehouse in their declared columns and types")
    x.add_argument("--warehouse", required=True)
    x.add_argument("--out", required=True, help="new folder, a Parquet table below it for each")
    r = sub.add_parser("report", help="indicators and top lists of a published warehouse")
    r.add_argument("--warehouse", required=True)
    r.add_argument("--state", default=None)
    r.add_argument("--municipality", default=None)
    r.add_argument("--top", type=int, default=10)
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from .session import build_session

    spark = build_session(args.master) if args.master else SparkSession.builder.getOrCreate()
    if args.cmd == "etl":
        from .plans.etl import SEEDS, build_warehouse
        from .sources.csv import read_notifications

        seeds = dict(s.split("=", 1) for s in args.seed if "=" in s)
        if len(seeds) < len(args.seed) or not set(seeds) <= set(SEEDS):
            ap.error(f"--seed names one of {', '.join(SEEDS)} and a path, as in {SEEDS[0]}=/shared/types.parquet")
        if args.append and (args.gate != "fail" or args.seed):
            ap.error("--append takes no --seed, and its gate always fails the load")
        if args.load is not None and not args.append:
            ap.error("--load goes with --append")
        raw = read_notifications(spark, args.csv, multi_line=args.multi_line, active_only=args.active_only,
                                 date_formats=args.date_format, check=not args.allow_bad_cells)
        if args.append:
            from .plans.versions import append_notifications, load_warehouse

            wh = append_notifications(spark, load_warehouse(spark, args.out), raw, load=args.load, renumber=True)
        else:
            wh = build_warehouse(spark, raw, root=args.out, gate=args.gate, seeds=seeds)
        print(json.dumps({"warehouse": wh.root, "rows": wh.rows, "seconds": {k: round(v, 2) for k, v in wh.seconds.items()}}))
    elif args.cmd == "delete":
        from .plans.versions import changed_folders, delete_notifications, load_warehouse

        old = load_warehouse(spark, args.warehouse)
        new = delete_notifications(spark, old, spark.read.parquet(args.ids))
        print(json.dumps({"version": new.version, "folders": {n: dict(zip(("kept", "written"), c))
                                                              for n, c in changed_folders(old, new).items()}}))
    elif args.cmd == "export":
        from .operators.declared import write_declared
        from .plans.etl import load_warehouse

        print(json.dumps({"rows": write_declared(load_warehouse(spark, args.warehouse).tables, args.out)}))
    else:
        from .plans import indicators as K
        from .plans.etl import load_warehouse
        from .plans.session_cache import dashboard_views

        tables = load_warehouse(spark, args.warehouse).tables
        f = {"state": args.state, "municipality": args.municipality}
        with dashboard_views(tables) as views:  # each view is computed once for all indicators
            t = tables | views
            rows = lambda df: [r.asDict() for r in df.collect()]
            out = {
                "updated_at": datetime.now().strftime("%d/%m/%Y %H:%M"),
                "kpi": K.kpi_summary(t, with_text=True, **f).first().asDict(),
                "confirmed_by_state": rows(K.confirmed_by_state(t, **f)),
                "cases_by_sex": rows(K.cases_by_sex(t, **f)),
                "confirmed_by_age": rows(K.confirmed_by_age(t, **f)),
                "vaccine_outcome": rows(K.vaccine_outcome(t, **f)),
                "top_symptoms": rows(K.top_symptoms(t, n=args.top, **f)),
                "top_municipalities": rows(K.top_municipalities(t, n=args.top, **f)),
                "top_laboratory": K.top_laboratory(t, **f).first().asDict(),
                "top_laboratories": rows(K.top_laboratories(t, n=args.top, **f)),
            }
        print(json.dumps(out, default=str, ensure_ascii=False, indent=1))


if __name__ == "__main__":
    main()
