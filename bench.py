"""Time the headline queries: one JSON line on stdout.

`BENCH_SF_DIR` names the data (default sf0.1), `BENCH_CPUS` the local cores. Every query runs to the end of its plan
(noop sink). Before timing, the platform deliveries that the loads read are written once: they are input, not work.
"""

from __future__ import annotations

import json
import os
import sys
import time

from spendmill.plans.catalog import REPORTS
from spendmill.session import build_session
from spendmill.verify.landing import fact_accounts, landed_dimension, landed_fact
from spendmill.verify.registry import queries

HEADLINE = (
    "q01_flatten_cast",
    "q04_exclude_accounts",
    "q09_nested_sum",
    "q14_keep_first",
    "q15_keep_first_composite",
    "q17_slice_replace",
    "q18_slice_replace_vanishing_date",
    "q19_full_refresh",
    "q26_roas",
    "q27_pacing",
    "q28_yoy",
    "q29_ytd",
    "q30_enriched",
    "q31_cross_channel",
    "q32_weighted_ratio",
    "scan_google_ads_geo",
    "scan_meta_ads_performance",
    "scan_meta_ads_creative_dim",
    "load_google_ads_geo",
    "load_meta_ads_performance",
    "load_meta_ads_creative_dim",
    "flagship_restated_cost",
)
DELIVERED = (
    "google_ads_performance",
    "google_ads_budget_pacing",
    "google_ads_geo",
    "meta_ads_performance",
    "meta_ads_ad_dim",
    "meta_ads_creative_dim",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()

    def run(name: str) -> float:
        began = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3)

    for name, spec in REPORTS.items():
        if name in DELIVERED:
            land = landed_fact if spec.is_fact else landed_dimension
            land(spark, sf_dir, spec)
            fact_accounts(spark, sf_dir, spec.platform)
            if spec.is_fact:
                landed_fact(spark, sf_dir, spec, restated=True)
    chosen = sys.argv[1:] or HEADLINE
    seconds = {name: run(name) for name in chosen}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
