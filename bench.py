"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is written to Spark's ``noop`` sink (full execution, no output
I/O). One warm-up pass runs every query first; the reported time is the
median of ``$BENCH_REPEAT`` (default 3) timed runs. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from blendwise.plans import registry  # noqa: E402
from blendwise.plans.operator_queries import lineitem_rollup  # noqa: E402
from blendwise.session import local_session  # noqa: E402

HEADLINE = [
    "campaign_web_store",
    "attributed_campaign_blend",
    "actual_vs_forecast",
    "crm_lead_funnel",
    "granularity_rollup_lineitem",
    "full_outer_blend_chain",
    "attribute_measures",
    "campaign_dimension",
    "allocate_fee",
    "touch_orders",
    "crm_funnel",
    "order_counts_distinct",
    "regional_paid_spend",
    "app_blend",
    "split_account_channels",
]


def run(df) -> float:
    df.sparkSession.catalog.clearCache()
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=cpus)
    qs = registry.queries()
    builders = {n: (lambda n=n: qs[n](spark, sf_dir)) for n in HEADLINE}
    for strategy in ("union", "lattice", "cascade", "cascade_union", "explode"):
        builders[f"rollup_lineitem_{strategy}"] = (
            lambda s=strategy: lineitem_rollup(spark, sf_dir, strategy=s))
    for build in builders.values():  # warm-up: JIT, file listing, caches
        run(build())
    times = {}
    for name, build in builders.items():
        times[name] = round(statistics.median(run(build()) for _ in range(repeat)), 3)
    headline_total = round(sum(times[n] for n in HEADLINE), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": headline_total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
