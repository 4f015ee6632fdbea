"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Each query is forced to completion with the `noop` sink (every row computed, nothing
collected), after one warm-up pass over the same queries on the same session.

With BENCH_MATERIALIZE=1 (default) the item fact is first built once from the source
tables and written partitioned by month (`KPI.materialize`, the way a KPI service at
scale serves many questions from one snapshot); that build is timed as its own entry
(`materialize_fact`) and is part of the total. BENCH_MATERIALIZE=0 builds the fact
from the source tables inside every query. The segment cube is built and timed the same way
(`segment_cube`); the frozen truth the graders read is what `truth_document` times.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "fact_items", "monthly_kpis", "monthly_core_sql", "revenue_by_dim", "decompose", "mom_zscore",
    "contribution_all", "find_drivers", "find_drivers_net", "change_report", "change_report_thorough",
    "sessions_from_events", "funnel_by_source", "leakage_by_dim", "leakage_alert", "price_quantiles",
    "referential_integrity", "recon_monthly", "identities", "outcomes",
    "truth_document", "driver_diff", "sample_exact", "text_norm",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    materialize = os.environ.get("BENCH_MATERIALIZE", "1") != "0"
    from kpilens.session import get_spark
    from kpilens.plans.registry import kpi, periods, queries
    spark = get_spark("kpilens-bench", cpus, shuffle_partitions=int(cpus) * 2)
    qs = queries()
    names = [n for n in HEADLINE if n in qs]

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    t0 = time.perf_counter()
    periods(spark, sf_dir)                 # the month list, resolved once (cold: the session's first job)
    month_list = round(time.perf_counter() - t0, 3)
    for n in names:                        # warm-up: JIT, codegen caches, file listing
        run(n)
    times = {"month_list_cold": month_list}
    if materialize:
        t0 = time.perf_counter()
        kpi(spark, sf_dir).materialize()
        times["materialize_fact"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    kpi(spark, sf_dir).__dict__.pop("cube", None)
    kpi(spark, sf_dir).cube.count()        # built anew: what the monthly series, drivers and reports read
    times["segment_cube"] = round(time.perf_counter() - t0, 3)
    kpi(spark, sf_dir).__dict__.pop("monthly", None)
    times.update({n: round(run(n), 3) for n in names})
    sf = Path(sf_dir).name.replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "materialized_fact": materialize}))
    spark.stop()


if __name__ == "__main__":
    main()
