"""Scalar column expressions of the cleaning and reporting steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two labels that reports show.
PEAK_LABEL = "Peak (7-9, 16-18)"
OFF_PEAK_LABEL = "Off-peak"

# Fixed value: month/day/year with one or two digits, then the time of day.
_LOCAL_STAMP = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}:\d{1,2}:\d{1,2})$"


def local_timestamp(text: Column) -> Column:
    """Local ``MM/dd/yyyy HH:mm:ss`` text as TIMESTAMP_NTZ; anything else is null.

    No session time zone is involved, so the hour stays as written on the day clocks change. Text
    that does not match keeps its slashes and so does not cast.
    """
    iso = F.regexp_replace(text, _LOCAL_STAMP, "$3-$1-$2 $4")
    return F.when(F.contains(text, F.lit("/")), iso.try_cast("timestamp_ntz"))


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column so that it is evaluated once per row.

    A projected expression is copied into every filter above it that uses the column; a generated
    one is not. The array has exactly one element.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def nan_to_null(df: DataFrame, keep: list[str] | tuple = ()) -> DataFrame:
    """Replace NaN by null in every floating-point column but those in ``keep``."""
    floats = [f.name for f in df.schema if f.dataType.typeName() in ("double", "float") and f.name not in keep]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def lane_count(rule: str = "first_gap") -> Column:
    """Lanes from the first null among ``flow_1`` .. ``flow_7``, else 8.

    ``first_gap`` gives the number of that gap, ``populated`` the filled lanes before it (then
    ``flow_8`` counts as well).
    """
    if rule == "first_gap":
        gaps = [F.when(F.col(f"flow_{i}").isNull(), F.lit(i)) for i in range(1, 8)]
    elif rule == "populated":
        gaps = [F.when(F.col(f"flow_{i}").isNull(), F.lit(i - 1)) for i in range(1, 9)]
    else:
        raise ValueError(f"unknown lane rule: {rule}")
    return F.coalesce(*gaps, F.lit(8))


def flow_per_lane(columns: list[str], flow: str = "avg_flow") -> Column:
    if "lanes" not in columns:
        return F.lit(None).cast("double")
    lanes = F.col("lanes").cast("double")
    return F.when(lanes > 0, F.col(flow).cast("double") / lanes)


def to_number(value: Column, kind: str = "double") -> Column:
    """Numeric coercion: text that is not a number becomes null instead of an error."""
    return value.try_cast(kind)


def upper_type(column: str = "type") -> Column:
    return F.upper(F.col(column))


def direction_letter(column: str = "direction") -> Column:
    return F.substring(F.upper(F.col(column)), 1, 1)


def peak_bucket(hour: Column) -> Column:
    peak = hour.between(7, 9) | hour.between(16, 18)
    return F.when(peak, PEAK_LABEL).otherwise(OFF_PEAK_LABEL)


def round_half_even(value: Column, digits: int = 1) -> Column:
    """Round with ties to the even digit, computed on the binary value."""
    scale = 10.0 ** digits
    return F.rint(value * scale) / scale


def megabites(size_text: Column) -> Column:
    """Size text with thousands separators as megabytes with one decimal."""
    size = F.regexp_replace(F.trim(size_text), ",", "").try_cast("double")
    return round_half_even(size / 1e6)


def select_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    present = set(df.columns)
    return df.select(*[c for c in columns if c in present])
