"""Write the report frames of one selection as Parquet folders.

usage: write_report.py TABLE OUTPUT [--year Y ...] [--month M ...] [--hours LOW HIGH]
                       [--route ROUTE[:TYPE[:DIRECTION[:LOW-HIGH[:STATION,...]]]] ...] [--exploratory]
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stationhour.plans.reports import dashboard, exploratory_report  # noqa: E402
from stationhour.schemas import RouteChoice, Selection  # noqa: E402
from stationhour.session import build_session  # noqa: E402
from stationhour.sources.tables import export_csv, scan_processed  # noqa: E402


def route_choice(text: str) -> RouteChoice:
    route, lane_type, direction, segment, stations = (text.split(":") + [""] * 4)[:5]
    low, _, high = segment.partition("-")
    return RouteChoice(int(route), lane_type or None, direction or None, (float(low), float(high)) if segment else None,
                       tuple(int(s) for s in stations.split(",") if s))


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("table")
    parser.add_argument("output")
    parser.add_argument("--year", type=int, nargs="*", default=[])
    parser.add_argument("--month", type=int, nargs="*", default=[])
    parser.add_argument("--hours", type=int, nargs=2, default=[0, 23])
    parser.add_argument("--route", type=route_choice, nargs="*", default=[])
    parser.add_argument("--exploratory", action="store_true")
    args = parser.parse_args()
    spark = build_session("write-report")
    table = scan_processed(spark, args.table)
    selection = Selection(tuple(args.year), tuple(args.month), tuple(args.hours), tuple(args.route))
    frames = exploratory_report(table) if args.exploratory else dashboard(table, selection)
    for name, frame in frames.items():
        if name == "download":
            export_csv(frame, f"{args.output}/{name}")
        else:
            frame.write.mode("overwrite").parquet(f"{args.output}/{name}")
    spark.stop()


if __name__ == "__main__":
    main()
