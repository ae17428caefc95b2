"""Time the headline queries: one JSON line on stdout.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. ``build_marts`` runs raw
records to written marts in full, and ``marts_of_written_raw`` the same from raw records
that lie written, as a warehouse would load them; the standing questions read the written marts, as they
would in a warehouse. ``index_of_corpus`` makes and stores the search index; the searches read
it as stored. The large given tables are spread over the cores as they are read, as a landing
zone of many files would be (``sources/bind.py``). Each query is run to completion twice and the faster run is kept.
"""

from __future__ import annotations

import json
import os
import sys
import time

from clearplate.operators.retrieval import build_index, write_index
from clearplate.plans.build import build_marts
from clearplate.registry import QUERIES
from clearplate.session import fresh_path, local_session, written
from clearplate.sources.bind import raw_inspections, search_corpus

HEADLINE = [
    "build_marts", "stg_inspections", "fct_inspections", "fct_violations", "dq_report",
    "v01_grade_distribution", "v02_grade_a_rate", "v03_top_critical", "v04_critical_by_cuisine", "v05_closure_rate", "v06_re_inspection_rate",
    "v07_monthly_trend", "v08_quarterly_critical", "v09_zip_hotspots", "v10_highest_risk", "v11_repeat_closures", "v12_weekday",
    "sv_drill_across", "sv_median_by_cuisine", "sv_all_inspection_metrics", "sv_citations_by_grade",
    "o01_daily_usage", "o02_nested_credits", "o14_negative_gaps", "o16_cost_quality",
    "g1_within_radius", "g2_nearby_critical", "g3_per_restaurant",
    "d1_page_text", "d2_forward_fill", "d4_codes", "d8_chunks",
    "r2_bm25", "r3_cosine_topk", "r4_hybrid", "r9_explain_codes",
    "s5_upsert", "u6_capture", "u8_fold", "u9_recall",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    QUERIES["v02_grade_a_rate"](spark, sf_dir).collect()  # builds the marts and warms the engine
    times = {}
    timed = dict(QUERIES)
    if not sys.argv[1:]:
        raw = written(raw_inspections(spark, sf_dir), "bench-raw")
        timed["marts_of_written_raw"] = lambda s, _: build_marts(raw, fresh_path(s, "bench-build")).dim_date
        timed["index_of_corpus"] = lambda s, d: write_index(build_index(search_corpus(s, d)), fresh_path(s, "bench-index")).totals
        names = [*names, "marts_of_written_raw", "index_of_corpus"]
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            timed[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
        print(name, [round(r, 2) for r in runs], file=sys.stderr)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
