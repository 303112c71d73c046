"""Whole reports as sets of DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stationhour.operators import exploration, metrics, options
from stationhour.operators.selection import BOTH, filter_selection
from stationhour.schemas import Selection
from stationhour.session import write_shared


def filter_options(df: DataFrame) -> dict[str, DataFrame]:
    return {"years": options.years(df), "months": options.months(df), "hours": options.hours(df),
            "routes": options.routes(df), "lane_types": options.lane_types(df),
            "directions": options.directions(df), "stations": options.stations(df),
            "post_mile_bounds": options.post_mile_bounds(df)}


def dashboard(df: DataFrame, selection: Selection = Selection()) -> dict[str, DataFrame]:
    """Key figures, map and charts of one selection; without routes only the global overview.

    The selected rows are written once to the shared folder and the charts read that table: key figures, bars and speed by hour through one
    aggregate over all of them, which is written too.
    """
    if not selection.routes:
        points = metrics.station_map_global(df, selection)
        return {"kpis": metrics.kpis_global(df, selection), "map": points, "map_domain": metrics.map_domain(points)}
    rows = write_shared(filter_selection(df, selection), "selected-rows")
    sums = write_shared(metrics.chart_sums(rows), "chart-sums")
    points = metrics.station_map(rows)
    two_way = [c.route for c in selection.routes if c.direction == BOTH]
    one_way = [c.route for c in selection.routes if c.direction != BOTH]
    charts = {"kpis": metrics.kpis_of_sums(sums), "map": points, "map_domain": metrics.map_domain(points),
              "year_index": options.year_index(rows), "line": metrics.route_month_line(rows),
              "speed_by_hour": metrics.speed_by_hour_of_sums(sums), "download": rows}
    # rows of other charts have no route, or one that was chosen
    if two_way:
        charts["bars_two_way"] = metrics.route_month_two_way_of_sums(sums.where(sums.route.isin(*two_way)))
    if one_way:
        charts["bars_one_way"] = metrics.route_month_one_way_of_sums(sums.where(sums.route.isin(*one_way)))
    return charts


def exploratory_report(df: DataFrame) -> dict[str, DataFrame]:
    """The exploratory figures over a year or several years of the summary."""
    return {"heatmap": exploration.heatmap_hour_month(df), "speed_box": exploration.top_routes_box(df),
            "flow_speed_sample": exploration.systematic_sample(df).select("median_flow", "median_speed", "lanes"),
            "direction_flow": exploration.hour_direction_flow(df),
            "occupancy": exploration.occupancy_histogram(df), "summary": exploration.data_summary(df),
            "monthly_trend": exploration.monthly_trend(df), "peak": exploration.peak_off_peak(df)}
