"""Times the headline queries and prints one JSON line.

Each query runs to its last row into a sink that discards them, so nothing is pruned away and no rows reach
the driver. Job queries that write files include the writes.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from seatgrid.plans.queries import QUERIES  # noqa: E402
from seatgrid.session import build_session  # noqa: E402

HEADLINE = [
    "explode_sections",
    "home_away_teams",
    "resolve_events",
    "dedup_team_day",
    "join_event_inner",
    "join_all",
    "join_coverage",
    "ordered_listings",
    "label_frequencies",
    "label_index",
    "one_hot_slots",
    "price_through_time",
    "price_through_time_v1",
    "split_by_event_parquet",
    "structure_all",
    "structure_all_files",
]


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "bench", f"local[{cpus}]",
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.sql.session.timeZone": "UTC",
            "spark.checkpoint.dir": scratch,
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["distinct_events"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the executor
    timings = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {timings[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
