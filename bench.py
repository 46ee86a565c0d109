"""Time the headline queries on one machine and print one JSON line.

Environment: BENCH_SF_DIR (default sf0.1 tables), BENCH_CPUS (default all cores), BENCH_RUNS (default 2).
Each query is built and fully computed without collecting it; its time is the best of the runs.
The planning tables that the star-schema files do not hold are derived before the timing starts,
and that time is reported on its own.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spotgrid import catalog  # noqa: E402
from spotgrid.sources.tables import BoundTables  # noqa: E402

HEADLINE = [
    "quarterly_projects", "quarterly_future_units", "quarterly_capacity", "quarterly_episodes", "weekly_projects", "weekly_future_units",
    "daily_projects", "daily_episodes", "project_popup_grid", "plan_grid_for_edit", "episodes_optimised", "episodes_saved",
    "project_eligibility", "segment_selection", "reach_guide", "reach_estimates", "distribute_carry", "upsert_plan_projects", "upsert_spots",
    "measurement_window_episodes", "backfill_episodes", "daily_cap_check", "explode_capacity_json",
]
STORED = ("cal_period", "outlet_demo", "segment", "segment_component", "daypart", "spots_per_hour", "plan", "plan_version", "plan_project",
          "plan_project_episode", "plan_project_spots", "plan_project_spots_episode", "plan_project_spots_episode_map", "campaign_goal_episode",
          "reach_header", "reach_detail", "reach_request", "stg_spots", "stg_episode_map", "episode_detail", "blackout", "model_param")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("spotgrid-bench").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", os.environ.get("BENCH_PARTITIONS", "8")).config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    t0 = time.perf_counter()
    tables = BoundTables(spark, sf_dir)
    for name in STORED:
        getattr(tables, name)
    bind = time.perf_counter() - t0

    queries, seconds = catalog.queries(), {}
    for name in names:
        taken = []
        for _ in range(runs):
            t0 = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - t0)
        seconds[name] = round(min(taken), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "sum of best query seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "bind_seconds": round(bind, 3), "runs": runs, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
