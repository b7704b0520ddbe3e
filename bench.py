"""Seconds per query at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

A query is timed from building its plan (which includes its own small jobs) to the end
of a full run into the no-op sink, after one untimed run of a small query as warm-up. The median of
$BENCH_RUNS runs (3) counts.
"""

from __future__ import annotations

import json
import os
import re
import time
from statistics import median

from roadfeat.session import build_session
from workload.queries import QUERIES

HEADLINE = [
    "r2_road_summary",
    "r4_road_points",
    "f1_base_points",
    "f2_accident_risk",
    "f3_speed_limit",
    "f4_business_counts",
    "f5_population",
    "f6_welfare",
    "f7_market_presence",
    "f8_bus_stops",
    "f9_bus_passengers",
    "f10_subway",
    "f11_streetlights",
    "f12_cctv",
    "f13_speed_bumps",
    "f14_intersections",
    "f15_crosswalks",
    "f16_crosswalk_warnings",
    "f17_signals",
    "f18_priority_roads",
    "f19_parking",
    "f20_protection_zones",
    "p2_accidents_by_year",
    "p3_incremental",
    "p5_all_features",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["f14_intersections"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(median(runs), 3)
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(match.group(1)) if match else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
