"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the scale directory, BENCH_CPUS the local cores. Load queries start from the
given tables, the file-based ones from text files written beforehand. Report queries read a processed table with a station for
every supplier, so that it grows with the scale; building it is timed as ``processed_table``. Every run plans afresh and writes all rows to the no-op sink. A
query counts with the best of BENCH_RUNS runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from fixtures.adapters import Inputs
from fixtures.registry import MAKERS
from stationhour.session import build_session

LOAD = ["clean", "station_hour_summary", "enrich_meta", "meta_gate", "month_pipeline", "backfill",
        "manifest_flatten", "manifest_pipeline", "retention", "page_embedded_json", "stream_upsert", "stream_window"]
REPORT = ["filter_selection", "kpis_global", "kpis_selection", "route_month_oneway", "route_month_twoway",
          "route_month_perlane", "station_map_global", "speed_by_hour_pivot", "heatmap_hour_month",
          "top_routes_box", "occupancy_hist", "systematic_sample", "data_summary"]


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = set(sys.argv[1:])
    spark = build_session("bench", f"local[{cpus}]", partitions=cpus, **{
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"), "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def measure(name: str, run) -> None:
        taken = [timed(run) for _ in range(runs + 1)]
        seconds[name] = round(min(taken[1:]), 3)
        print(f"{name}: {seconds[name]} (first {taken[0]:.2f})", file=sys.stderr, flush=True)

    landed = Inputs(spark, sf_dir)
    folders = {"landed_l": landed.landed_l, "landed_e": landed.landed_e}

    def fresh() -> Inputs:
        """Inputs planned anew, except that the raw text files are already there."""
        inputs = Inputs(spark, sf_dir)
        vars(inputs).update(folders)
        return inputs

    for name in LOAD:
        if not chosen or name in chosen:
            measure(name, lambda: MAKERS[name](fresh()))
    measure("processed_table", lambda: Inputs(spark, sf_dir, wide=True).processed)
    shared = Inputs(spark, sf_dir, wide=True)
    for name in REPORT:
        if not chosen or name in chosen:
            measure(name, lambda: MAKERS[name](shared))
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
