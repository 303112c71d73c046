"""Joining station metadata to the summary.

The joins carry no broadcast hint: Spark broadcasts metadata below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, splitting skewed stations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationhour.schemas import META_KEYS, META_VALUES, PERIOD


def add_metadata(summary: DataFrame, meta: DataFrame) -> DataFrame:
    """Left join on station, route, direction and district; unmatched rows keep null metadata."""
    present = set(meta.columns)
    values = [c for c in META_VALUES if c in present]
    return summary.join(meta.select(*META_KEYS, *values), META_KEYS, "left")


def missing_stations(summary: DataFrame, meta: DataFrame) -> DataFrame:
    """Summary rows whose station has no metadata at all."""
    return summary.join(meta.select("station").distinct(), "station", "left_anti")


SCOPE = [*PERIOD, "district"]   # what one file holds


def uncovered_months(summary: DataFrame, meta: DataFrame) -> DataFrame:
    """Periods and districts with at least one station that metadata does not know."""
    stations = summary.select(*SCOPE, "station").distinct()
    return missing_stations(stations, meta).select(*SCOPE).distinct()


def drop_uncovered_months(summary: DataFrame, meta: DataFrame) -> DataFrame:
    """Keep only months of a district whose stations are all known. At most twelve periods a year and district (of which
    there are a dozen) are broadcast."""
    return summary.join(F.broadcast(uncovered_months(summary, meta)), SCOPE, "left_anti")


def enrich(summary: DataFrame, meta: DataFrame, on_missing: str = "drop_month") -> DataFrame:
    if on_missing == "drop_month":
        summary = drop_uncovered_months(summary, meta)
    elif on_missing != "keep":
        raise ValueError(f"unknown on_missing: {on_missing}")
    return add_metadata(summary, meta)
