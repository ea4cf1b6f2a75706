"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion through Spark's ``noop`` sink (the whole
result is computed, nothing is collected to the driver): one warm-up pass,
then the best of ``$BENCH_REPEAT`` timed passes. Prints ONE JSON line.
``$BENCH_DUCKDB=1`` adds the DuckDB oracle timings on the same files.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from closebook.plans.catalog import QUERIES, forget  # noqa: E402
from closebook.session import build_session  # noqa: E402

HEADLINE = [
    "sales_mart", "pnl_monthly", "pnl_mix_share", "kpi_mart", "headline_kpis",
    "budget_variance", "budget_variance_monthly", "pvm_effects", "pvm_mix_by_sku",
    "collections_mart", "dso_moving_avg", "dso_alerts", "charge_zscores", "charge_alerts_top20",
    "control_channel_mix", "control_growth", "running_cutoff", "purchase_costing",
    "budget_union", "surrogate_keys", "pnl_operating", "revenue_zscores",
]


def run_spark(spark, sf_dir: str, keys, repeat: int) -> dict[str, float]:
    out = {}
    for k in keys:
        QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        best = None
        for _ in range(repeat):
            forget()  # file listing and plan construction are part of the time
            t0 = time.perf_counter()
            QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        out[k] = round(best, 3)
    return out


def run_duckdb(sf_dir: str, keys, repeat: int) -> dict[str, float]:
    import duckdb

    from closebook.plans.oracle import SQL
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    out = {}
    for k in keys:
        run = f"CREATE OR REPLACE TEMP TABLE result AS {SQL[k]}"  # nothing is fetched into Python
        con.execute(run)
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            con.execute(run)
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        out[k] = round(best, 3)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    times = run_spark(spark, sf_dir, keys, repeat)
    spark.stop()
    sf = sf_dir.rsplit("sf", 1)[-1]
    result = {"metric": "headline_queries_total_wall", "value": round(sum(times.values()), 3),
              "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
              "cpus": int(cpus), "repeat": repeat}
    if os.environ.get("BENCH_DUCKDB") == "1":
        d = run_duckdb(sf_dir, keys, repeat)
        result["duckdb_total"] = round(sum(d.values()), 3)
        result["duckdb_queries"] = d
    print(json.dumps(result))


if __name__ == "__main__":
    main()
