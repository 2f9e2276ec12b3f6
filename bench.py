"""Benchmark: build the warehouse and run every registered query.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is timed to completion through the ``noop`` sink (full
evaluation, no collect to the driver).  The ETL is timed per table.  A warm-up
pass over the smallest tables runs first so JVM start-up and code generation
are not charged to the first query.  Prints ONE JSON line on stdout.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
WARMUP_SF = os.environ.get("BENCH_WARMUP_SF_DIR", "/root/testdata/sf0.01")


RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def _best(times: dict[str, float], key: str, sec: float) -> None:
    times[key] = min(sec, times.get(key, float("inf")))


def _sf_label(path: str) -> str:
    base = os.path.basename(path.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


def main() -> None:
    from vigia.plans.catalog import queries
    from vigia.plans.etl import build_warehouse, use_warehouse, warehouse_for
    from vigia.session import build_session
    from vigia.sources.fixture import raw_notifications

    spark = build_session(f"local[{CPUS}]", shuffle_partitions=max(8, CPUS * 2), app_name="vigia-bench")
    qs = queries()

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    # warm-up on the smallest tables (not reported)
    if os.path.isdir(WARMUP_SF) and os.path.abspath(WARMUP_SF) != os.path.abspath(SF_DIR):
        warehouse_for(spark, WARMUP_SF)
        for fn in qs.values():
            run(fn(spark, WARMUP_SF))

    times: dict[str, float] = {}
    for _ in range(RUNS):
        t0 = time.perf_counter()
        wh = build_warehouse(spark, raw_notifications(spark, SF_DIR))
        _best(times, "etl_total", time.perf_counter() - t0)
        for step, sec in wh.seconds.items():
            _best(times, f"etl.{step}", sec)
        # later queries read this warehouse
        use_warehouse(spark, SF_DIR, wh)
        for name, fn in qs.items():
            t1 = time.perf_counter()
            run(fn(spark, SF_DIR))
            _best(times, name, time.perf_counter() - t1)

    total = times["etl_total"] + sum(v for k, v in times.items() if not k.startswith("etl"))
    print(json.dumps({"metric": "total_wall_sec", "value": round(total, 3), "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in times.items()}, "sf": _sf_label(SF_DIR),
                      "cpus": CPUS, "runs": RUNS, "spark": spark.version}))


if __name__ == "__main__":
    main()
