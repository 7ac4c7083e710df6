"""Benchmark: build the marts once, then time the headline queries.

Mirrors how the source system is used: the pipeline materialises the star
schema and dashboard tables, and dashboards / benchmark queries read the
stored tables.  Prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from surveywave import build_session  # noqa: E402
from surveywave.plans.registry import QUERIES  # noqa: E402
from surveywave.plans.questions import store_wide_rollups, wide  # noqa: E402
from surveywave.plans.warehouse import CORE_MODELS, DASHBOARD_MODELS, Warehouse  # noqa: E402
from surveywave.sources import open_source  # noqa: E402

HEADLINE = [
    "idx_q1_label_counts", "idx_q2_indicator_compare", "idx_q3_dimension_filter",
    "idx_q4_dimension_avg", "idx_q5_label_followup", "idx_q6_followup_label",
    "distinct_dropdown", "bench_hub_raw", "bench_hub_marts", "bench_hub_dashboard",
    "chart_sankey", "metric_query", "bq15_kpis_by_round", "pct_point_change",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    out_root = tempfile.mkdtemp(prefix="surveywave-bench-")
    times: dict[str, float] = {}

    wh = Warehouse(spark, open_source(spark, sf_dir))
    wide(wh)  # register the wide follow-up mart as a model
    t0 = time.perf_counter()
    wh.materialize(out_root, CORE_MODELS + DASHBOARD_MODELS + ["mart_indicators_wide"])
    store_wide_rollups(wh, f"{out_root}/rollups")
    times["build_marts"] = time.perf_counter() - t0

    for key in HEADLINE:
        best = None
        for _ in range(2):
            t = time.perf_counter()
            QUERIES[key].build(wh).collect()
            el = time.perf_counter() - t
            best = el if best is None else min(best, el)
        times[key] = best

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    total = sum(times.values())
    print(json.dumps({"metric": "build_marts_plus_headline_queries", "value": round(total, 3),
                      "unit": "sec", "queries": {k: round(v, 3) for k, v in times.items()},
                      "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
