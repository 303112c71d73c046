"""Process all pending months of a folder of raw files.

usage: load_months.py RAW_FOLDER META_CSV TABLE [--keep-uncovered] [--latest-only] [--strict-file]
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stationhour.functions.periods import holiday_calendar  # noqa: E402
from stationhour.operators.files import year_status  # noqa: E402
from stationhour.plans.months import backfill  # noqa: E402
from stationhour.session import build_session  # noqa: E402
from stationhour.sources.tables import scan_meta  # noqa: E402


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("raw_folder")
    parser.add_argument("meta_csv")
    parser.add_argument("table")
    parser.add_argument("--keep-uncovered", action="store_true", help="keep months with unknown stations")
    parser.add_argument("--latest-only", action="store_true", help="use only the last file of a month")
    parser.add_argument("--strict-file", action="store_true", help="drop files that hold an unreadable row")
    parser.add_argument("--first-year", type=int, default=2019, help="first year of the holiday calendar")
    parser.add_argument("--last-year", type=int, default=2025)
    args = parser.parse_args()
    spark = build_session("load-months")
    calendar = holiday_calendar(spark, args.first_year, args.last_year)
    table = backfill(spark, args.raw_folder, args.table, scan_meta(spark, args.meta_csv), calendar,
                     on_missing="keep" if args.keep_uncovered else "drop_month",
                     latest_only=args.latest_only, strict_file=args.strict_file)
    year_status(table).orderBy("year").show(100, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
