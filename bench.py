"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with a no-op sink (every row is produced,
nothing is collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fanpulse.plans.registry import all_queries  # noqa: E402
from fanpulse.session import get_session  # noqa: E402

# all registered queries are timed; the marts and reports come first
ORDER_FIRST = (
    "mart_sessions", "mart_product_daily", "mart_retention_cohort", "mart_conversion_funnel",
    "mart_sports_engagement", "mart_football_team_match", "mart_key_moment_engagement",
    "mart_marketing_economics", "mart_ab_test_match_center_v2", "mart_data_quality",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:]]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g"),
                               "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    qs = all_queries()
    names = [n for n in ORDER_FIRST] + sorted(n for n in qs if n not in ORDER_FIRST)
    names = [n for n in names if not only or n in only]
    # warm-up: JVM and codegen only (touches no test table)
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "all_queries_total_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
