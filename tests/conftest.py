from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stationhour.functions.periods import holiday_calendar  # noqa: E402
from stationhour.schemas import RAW_COLUMNS, RAW_SCHEMA  # noqa: E402
from stationhour.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", partitions=4, **{
        "spark.driver.memory": "4g", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def calendar(spark):
    return holiday_calendar(spark)


RAW_DEFAULTS = {"time_stamp_string": "01/03/2024 08:00:00", "station": 1, "district": 12, "route": 5,
                "direction": "N", "type": "ML", "length": 0.5, "samples": 100, "pct_obs": 100,
                "flow": 100.0, "occupancy": 0.1, "speed": 60.0, "flow_1": 50.0, "flow_2": 50.0}


@pytest.fixture(scope="session")
def raw_rows(spark):
    """Raw rows from dicts of the values that matter; days of one month can be given as a list."""
    def make(*rows: dict):
        full = []
        for row in rows:
            row = dict(row)
            for day in row.pop("days", [None]):
                one = {**RAW_DEFAULTS, **row}
                one["pct_obs"] = None if one["pct_obs"] is None else float(one["pct_obs"])
                if day is not None:
                    one["time_stamp_string"] = day
                full.append(tuple(one.get(c) for c in RAW_COLUMNS))
        return spark.createDataFrame(full, RAW_SCHEMA)
    return make


# Tuesdays to Thursdays of January 2024
JANUARY = [f"01/{d:02d}/2024 08:00:00" for d in (3, 4, 9, 10, 11, 16, 17)]
FEBRUARY = [f"02/{d:02d}/2024 08:00:00" for d in (6, 7, 8, 13, 14)]


@pytest.fixture(scope="session")
def write_raw(tmp_path_factory):
    """Write raw CSV text files by hand; returns their folder."""
    import gzip

    def line(values: dict) -> str:
        one = {**RAW_DEFAULTS, **values}
        return ",".join("" if one.get(c) is None else str(one[c]) for c in RAW_COLUMNS)

    def write(files: dict[str, list]) -> str:
        folder = tmp_path_factory.mktemp("raw")
        for name, rows in files.items():
            text = "\n".join(r if isinstance(r, str) else line(r) for r in rows) + "\n"
            data = text.encode()
            (folder / name).write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
        return str(folder)
    write.line = line
    return write
