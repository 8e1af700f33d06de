"""Benchmark: wall-clock seconds of the headline queries, as one JSON line.

Each query is planned and run to the end with its rows thrown away, so sinks do
not count. BENCH_QUERIES (names with commas, or ``all``) picks others.
"""

from __future__ import annotations

import json
import os
import time

from stewardry.queries.catalog import QUERIES
from stewardry.session import local_session

HEADLINE = [
    "scan_concepts",
    "glossary_resolve",
    "owner_resolve",
    "asset_resolve",
    "terms_dedup",
    "terms_sorted",
    "term_hierarchy",
    "term_levels",
    "html_strip",
    "fqn_path_parts",
    "asset_records",
    "plan_domains",
    "plan_terms",
    "plan_products",
    "plan_okrs",
    "cde_upsert",
    "edges_cde",
    "edges_asset",
    "policy_merge",
    "classify_outcomes",
    "load_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session("stewardry-bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    seconds = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
