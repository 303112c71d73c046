"""Column layouts and parameters shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LANES = range(1, 9)

_TEXT_RAW = {"time_stamp_string", "direction", "type"}

# Positional layout of a raw station-hour file (no header line).
RAW_COLUMNS = [
    "time_stamp_string", "station", "district", "route", "direction", "type",
    "length", "samples", "pct_obs", "flow", "occupancy", "speed",
    "delay_35", "delay_40", "delay_45", "delay_50", "delay_55", "delay_60",
] + [f"{name}_{lane}" for lane in LANES for name in ("flow", "occ", "speed")]


# whole numbers in the rows that operators see; as text they may read 1201.0
INT_RAW = ["station", "district", "route", "samples"]


def _raw_type(name: str) -> T.DataType:
    if name in _TEXT_RAW:
        return T.StringType()
    return T.DoubleType()


RAW_TEXT_SCHEMA = T.StructType([T.StructField(c, _raw_type(c)) for c in RAW_COLUMNS])
RAW_SCHEMA = T.StructType([T.StructField(c, T.IntegerType() if c in INT_RAW else _raw_type(c)) for c in RAW_COLUMNS])

META_SCHEMA = T.StructType([
    T.StructField("station", T.IntegerType()),
    T.StructField("route", T.IntegerType()),
    T.StructField("direction", T.StringType()),
    T.StructField("district", T.IntegerType()),
    T.StructField("county", T.IntegerType()),
    T.StructField("state_pm", T.StringType()),
    T.StructField("abs_pm", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])
# Names that files and tables carry.
META_KEYS = ["station", "route", "direction", "district"]
META_VALUES = ["county", "state_pm", "abs_pm", "latitude", "longitude"]

# Names that files and tables carry.
CLEAN_COLUMNS = [
    "date", "year", "month", "month_num", "day_of_week", "station", "district", "route",
    "direction", "type", "hour", "pct_obs", "length", "flow", "speed", "lanes", "occupancy",
]

# Names that files and tables carry.
SUMMARY_KEYS = [
    "station", "district", "route", "direction", "type", "hour", "year", "month",
    "month_num", "lanes", "length",
]
# measure column -> suffix of its three statistics
MEASURES = {"flow": "flow", "speed": "speed", "occupancy": "occup"}
STATISTICS = [f"{stat}_{suffix}" for suffix in MEASURES.values() for stat in ("median", "avg", "sd")]

PERIOD = ["year", "month_num"]

# the columns of cleaned rows that summaries read
CLEAN_TYPES = (
    [T.StructField(c, T.IntegerType()) for c in ("station", "district", "route", "hour", "year", "month_num", "lanes")]
    + [T.StructField(c, T.StringType()) for c in ("direction", "type")]
    + [T.StructField(c, T.DoubleType()) for c in ("length", "flow", "speed", "occupancy")])

PROCESSED_SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType()) for c in ("station", "district", "route")]
    + [T.StructField(c, T.StringType()) for c in ("direction", "type")]
    + [T.StructField("hour", T.IntegerType()), T.StructField("month", T.StringType()),
       T.StructField("lanes", T.IntegerType()), T.StructField("length", T.DoubleType())]
    + [T.StructField(c, T.DoubleType()) for c in STATISTICS]
    + [T.StructField("days_observed", T.LongType()),
       T.StructField("county", T.IntegerType()), T.StructField("state_pm", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in ("abs_pm", "latitude", "longitude")]
    + [T.StructField("year", T.IntegerType()), T.StructField("month_num", T.IntegerType())]
)

# Names that files and tables carry.
MANIFEST_SCHEMA = T.StructType([
    T.StructField("file_type", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("file_id", T.StringType()),
    T.StructField("megabites", T.DoubleType()),
    T.StructField("download_url", T.StringType()),
])

# Names that files and tables carry.
LISTING_SCHEMA = T.StructType([
    T.StructField("data", T.MapType(T.StringType(), T.ArrayType(T.StructType([
        T.StructField("file_name", T.StringType()),
        T.StructField("file_id", T.StringType()),
        T.StructField("bytes", T.StringType()),
        T.StructField("url", T.StringType()),
    ])))),
])

CATALOGUE_SCHEMA = T.StructType([
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("form_data", T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))),
])


@dataclass(frozen=True)
class Params:
    """Processing parameters of the batch and streaming summaries."""

    min_pct_obs: float = 80
    min_days: int = 4
    lane_rule: str = "first_gap"        # or "populated"
    # "buffered": the built-in median, a group's distinct values in one buffer; "split": from value counts spread over tasks, for
    # stations with many millions of rows an hour and month. Both are exact and give the same figures.
    medians: str = "buffered"


@dataclass(frozen=True)
class RouteChoice:
    """What is chosen for one route; ``None`` means the default of that control."""

    route: int
    lane_type: str | None = None
    direction: str | None = None        # N, S, E, W or "both"
    segment: tuple[float, float] | None = None
    stations: tuple[int, ...] = ()


@dataclass(frozen=True)
class Selection:
    """Filter state of one report; empty years or months mean no filter on them.

    A selection may be bounded: with ``max_years`` or ``max_routes`` a longer one is refused, never cut.
    """

    years: tuple[int, ...] = ()
    months: tuple[int, ...] = ()
    hours: tuple[int, int] = (0, 23)
    routes: tuple[RouteChoice, ...] = field(default=())
    max_years: int | None = None
    max_routes: int | None = None

    def __post_init__(self):
        for name, limit in (("years", self.max_years), ("routes", self.max_routes)):
            if limit is not None and len(getattr(self, name)) > limit:
                raise ValueError(f"{len(getattr(self, name))} {name} chosen, at most {limit} are allowed")
