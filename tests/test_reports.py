from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationhour.operators import exploration, metrics, options, selection
from stationhour.plans.reports import dashboard, exploratory_report, filter_options
from stationhour.schemas import PROCESSED_SCHEMA, RouteChoice, Selection
from stationhour.functions.periods import MONTHS
from stationhour.sources.tables import with_expected_columns

COLUMNS = ("station INT, route INT, direction STRING, type STRING, hour INT, year INT, month_num INT, lanes INT, "
           "avg_flow DOUBLE, avg_speed DOUBLE, abs_pm DOUBLE")


def table(spark, *rows):
    """(station, route, direction, type, hour, year, month_num, lanes, flow, speed, post mile)"""
    df = spark.createDataFrame(rows, COLUMNS).withColumns({
        "month": F.get(F.array(*[F.lit(m) for m in MONTHS]), F.col("month_num") - 1),
        "median_flow": F.col("avg_flow"), "median_speed": F.col("avg_speed"), "median_occup": F.col("avg_flow") / 100,
        "latitude": 33 + F.col("station") / 10, "longitude": -118.0 + F.col("station") / 10,
        "district": F.lit(12), "length": F.lit(0.5)})
    return with_expected_columns(df).select(*[f.name for f in PROCESSED_SCHEMA])


@pytest.fixture(scope="module")
def small(spark):
    return table(
        spark,
        (1, 5, "N", "ML", 7, 2024, 1, 2, 100.0, 60.0, 1.0), (1, 5, "N", "ML", 8, 2024, 2, 2, 200.0, 61.0, 1.0),
        (2, 5, "S", "ML", 7, 2024, 1, 4, 40.0, 50.0, 9.0), (3, 5, "N", "HV", 7, 2024, 1, 1, 10.0, 70.0, 2.0),
        (4, 22, "E", "OR", 7, 2024, 1, 1, 11.0, 71.0, None), (5, 22, "W", "HV", 7, 2023, 3, 0, 12.0, 72.0, None),
        (6, 55, None, None, 9, 2023, 3, None, 13.0, None, 4.0))


def stations(df):
    return sorted({r.station for r in df.collect()})


def pick(df, *routes, **more):
    return stations(selection.filter_selection(df, Selection(routes=routes, **more)))


def test_selection_rules(small):
    assert pick(small) == []                                              # no route, no rows
    assert pick(small, RouteChoice(5)) == [1]                             # ML and North by default
    assert pick(small, RouteChoice(5, direction="S")) == [2]
    assert pick(small, RouteChoice(5, direction="both")) == [1, 2]
    assert pick(small, RouteChoice(5, direction="E")) == [1]              # not on this axis: default
    assert pick(small, RouteChoice(5, lane_type="hv")) == [3]
    assert pick(small, RouteChoice(5, lane_type="OR")) == []
    assert pick(small, RouteChoice(5, direction="both", segment=(1.0, 1.0))) == [1]
    assert pick(small, RouteChoice(5, direction="both", segment=(3.0, 4.0))) == [1, 2]     # no station left: all
    assert pick(small, RouteChoice(5, direction="both", stations=(2,))) == [2]
    assert pick(small, RouteChoice(5, direction="both", segment=(0.0, 5.0), stations=(2,))) == [1, 2]
    assert pick(small, RouteChoice(22)) == []                             # HV by default, which has no East row
    assert pick(small, RouteChoice(22, direction="both")) == [5]
    assert pick(small, RouteChoice(22, lane_type="OR")) == [4]            # no post miles on this route
    assert pick(small, RouteChoice(55)) == [6]                            # neither type nor direction
    assert pick(small, RouteChoice(5), RouteChoice(55)) == [1, 6]
    assert pick(small, RouteChoice(99), RouteChoice(98), RouteChoice(97), RouteChoice(5), RouteChoice(55)) == [1, 6]
    assert pick(small, RouteChoice(5), hours=(8, 9), months=(2,)) == [1]
    assert pick(small, RouteChoice(5), hours=(9, 10)) == []
    assert pick(small, RouteChoice(5), years=(2018, 2019, 2020, 2021, 2022, 2024)) == [1]
    with pytest.raises(ValueError):
        Selection(years=(2018, 2019, 2020), max_years=2)
    with pytest.raises(ValueError):
        Selection(routes=(RouteChoice(5), RouteChoice(22)), max_routes=1)


def test_selection_plan_is_lazy(small, spark, tmp_path):
    small.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    spark.sparkContext.setJobGroup("selection", "planning")
    found = selection.filter_selection(df, Selection(routes=(RouteChoice(5),)))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("selection")
    assert stations(found) == [1]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 and "Cartesian" not in plan


def test_map_plan_has_one_shuffle(small):
    plan = metrics.station_map_global(small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_station_keeps_rows_without_post_mile_if_another_has_one(spark):
    df = table(spark, (1, 5, "N", "ML", 7, 2024, 1, 2, 1.0, 1.0, 1.0), (1, 5, "N", "ML", 7, 2024, 2, 2, 1.0, 1.0, None),
               (2, 5, "N", "ML", 7, 2024, 2, 2, 1.0, 1.0, None))
    found = selection.filter_selection(df, Selection(routes=(RouteChoice(5),)))
    assert stations(found) == [1] and found.count() == 2
    assert selection.filter_segment(df, 0.0, 2.0).count() == 1


def test_options(small):
    got = {k: v.collect() for k, v in filter_options(small).items()}
    assert [r.year for r in got["years"]] == [2023, 2024]
    assert [r.month for r in got["months"]] == ["January", "February", "March"]
    assert tuple(got["hours"][0]) == (7, 9) and [r.route for r in got["routes"]] == [5, 22, 55]
    assert [(r.route, r.lane_type, r.is_default) for r in got["lane_types"]] == [
        (5, "ML", True), (5, "HV", False), (22, "HV", True), (22, "OR", False)]
    assert [(r.route, r.axis, r.default_direction) for r in got["directions"]] == [(5, "NS", "N"), (22, "EW", "E")]
    assert [r.station for r in got["stations"]] == [1, 3, 6, 2]
    assert tuple(options.hours(small.where("false")).first()) == (0, 23)
    unlocated = options.stations(small.withColumn("abs_pm", F.lit(None).cast("double"))).collect()
    assert [(r.station, r.abs_pm) for r in unlocated] == [(i, None) for i in range(1, 7)]
    assert options.year_index(small).orderBy("year").collect()[1].color_index == 1


def test_kpis(small):
    assert tuple(metrics.kpis_global(small).first()) == (2, 1, pytest.approx(171 / 3), pytest.approx(340 / 3))
    # without ML rows all rows count; hours do not matter
    march = metrics.kpis_global(small, Selection(years=(2023,), hours=(0, 0))).first()
    assert tuple(march) == (2, 2, 72.0, 12.5)
    assert tuple(metrics.kpis_global(small, Selection(years=(1999,))).first()) == (0, 0, None, None)
    assert tuple(metrics.kpis(small.where("route = 22")).first()) == (2, 1, 71.5, 11.5)


def months_of(df, value="bar_value"):
    return {(r.route, r.year, r.month_num): r[value] for r in df.collect()}


def test_two_way_and_one_way_months(small):
    two = months_of(metrics.route_month_two_way(small))
    assert len(two) == 4 * 12
    assert two[5, 2024, 1] == pytest.approx((100 + 10) / 2 + 40) and two[5, 2024, 2] == 200 and two[5, 2024, 7] == 0.0
    assert two[22, 2024, 1] == 11 and two[22, 2023, 3] == 12
    assert two[55, 2023, 3] == 0.0                              # no letters: E and W are both missing
    one = months_of(metrics.route_month_one_way(small))
    assert one[5, 2024, 1] == 50 and one[5, 2024, 7] is None and len(one) == 4 * 12
    assert metrics.route_month_one_way(small, dense=False).count() == 5


def test_line_falls_back_per_route(small):
    line = {(r.route, r.year, r.month_num): (r.per_lane, r.line_value) for r in metrics.route_month_line(small).collect()}
    assert line[5, 2024, 1] == (True, 10.0) and line[5, 2024, 3] == (True, None)
    assert line[22, 2024, 1] == (True, 11.0)
    assert line[55, 2023, 3] == (False, 13.0)
    later = small.unionByName(small.where("route = 5 AND station = 2").withColumns({"year": F.lit(2025), "lanes": F.lit(None).cast("int")}))
    line_later = {(r.route, r.year, r.month_num): (r.per_lane, r.line_value) for r in metrics.route_month_line(later).collect()}
    assert all(line_later[5, 2025, m] == (True, None) for m in range(1, 13))     # a year without lane counts stays, empty
    without = metrics.route_month_line(small.drop("lanes"))
    assert months_of(without, "line_value")[5, 2024, 1] == 40.0
    assert (55, 2023, 3) not in months_of(metrics.route_month_per_lane(small), "line_value")


def test_map_domain(spark, small):
    points = metrics.station_map(small)
    assert points.count() == 6
    domain = metrics.map_domain(points).first()
    assert (domain.color_min, domain.color_max) == (10.0, 150.0)
    one = metrics.map_domain(points.where("station = 2")).first()
    assert (one.color_min, one.color_max) == (38.0, 42.0)
    zero = metrics.map_domain(points.where("station = 2").withColumn("avg_flow_sel", F.lit(0.0))).first()
    assert (zero.color_min, zero.color_max) == (-1.0, 1.0)
    none = metrics.map_domain(points.withColumn("avg_flow_sel", F.lit(None).cast("double"))).first()
    assert (none.color_min, none.color_max) == (0.0, 1.0)
    assert "district" not in metrics.station_year_month(small.drop("district")).columns


def test_histogram_against_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"type": rng.choice(["ML", "HV", "OR"], 2000), "median_occup": rng.integers(0, 101, 2000) / 100})
    frame = pd.concat([frame, pd.DataFrame({"type": ["XX"] * 2, "median_occup": [0.5, 0.5]})])
    found = exploration.occupancy_histogram(spark.createDataFrame(frame), lane_types=("ML", "HV", "XX")).toPandas()
    for kind in ("ML", "HV", "XX"):
        n, edges = np.histogram(frame[frame.type == kind].median_occup, bins=50)
        mine = found[found.type == kind].sort_values("bin")
        assert mine.n.tolist() == n.tolist()
        np.testing.assert_allclose(mine.bin_start, edges[:-1])
        assert (mine.density * (edges[1] - edges[0])).sum() == pytest.approx(1)


def test_exploration(small):
    assert [(r.route, r.row_count) for r in exploration.top_routes(small, 2).collect()] == [(5, 4), (22, 2)]
    assert exploration.systematic_sample(small, 3).count() == 3
    assert 0 <= exploration.hashed_sample(small, 2).count() <= 7
    row = exploration.data_summary(small).first()
    assert (row.total_stations, row.average_flow, row.average_speed, row.top_routes) == (
        6, "55 vehicles/hour", "64.0 mph", "5, 22, 55")
    assert exploration.stations_on_routes(small, [5, 22, 91]).first().stations == 5
    part = exploration.head_tail(small, 2).collect()
    assert [r.year for r in part if r.part == "head"] == [2023, 2023] and len(part) == 4
    box = exploration.top_routes_box(small, 1).first()
    assert (box.q1, box.median, box.q3) == (57.5, 60.5, 63.25)
    far = small.limit(1).drop("median_speed").crossJoin(small.sparkSession.createDataFrame([(0.0,), (0.0,), (0.0,), (100.0,)], "median_speed DOUBLE"))
    box = exploration.top_routes_box(far).first()
    assert (box.whisker_low, box.q1, box.median, box.q3, box.whisker_high) == (0.0, 0.0, 0.0, 25.0, 25.0)


def test_whole_reports(small):
    every = dashboard(small, Selection(routes=(RouteChoice(5, direction="both"), RouteChoice(22))))
    assert every["kpis"].first().stations == 2 and every["bars_two_way"].count() == 12 and every["bars_one_way"].count() >= 0
    assert {"line", "speed_by_hour", "download", "map", "map_domain", "year_index"} <= set(every)
    assert set(dashboard(small)) == {"kpis", "map", "map_domain"}
    report = exploratory_report(small)
    assert report["heatmap"].columns == ["hour", *MONTHS] and report["peak"].count() == 1
    assert [r.month for r in report["monthly_trend"].collect()] == ["January", "February", "March"]


def test_no_python_in_any_plan(small):
    frames = {**dashboard(small, Selection(routes=(RouteChoice(5),))), **exploratory_report(small)}
    for name, frame in frames.items():
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Cartesian" not in plan and "BroadcastNestedLoop" not in plan, name


def test_charts_of_one_aggregate_equal_the_single_ones(spark, small):
    odd = small.limit(20).withColumns({"route": F.lit(None).cast("int"), "avg_flow": F.lit(None).cast("double")})
    odd = odd.unionByName(small.limit(20).withColumns({"year": F.lit(None).cast("int"), "avg_speed": F.lit(float("nan"))}))
    odd = odd.unionByName(small.where("route = 22").withColumns({"direction": F.lit("N"), "avg_flow": F.lit(None).cast("double")}).limit(3))
    every = small.unionByName(odd.select(*small.columns))
    sums = metrics.chart_sums(every)
    pairs = [(metrics.kpis, metrics.kpis_of_sums), (metrics.speed_by_hour, metrics.speed_by_hour_of_sums),
             (metrics.route_month_one_way, metrics.route_month_one_way_of_sums), (metrics.route_month_two_way, metrics.route_month_two_way_of_sums)]
    for plain, merged in pairs:
        a, b = plain(every), merged(sums)
        assert a.columns == b.columns
        keys = [c for c in a.columns if c not in ("avg_speed", "avg_flow", "bar_value")]
        left, right = ({tuple(r[k] for k in keys): r for r in df.collect()} for df in (a, b))
        assert set(left) == set(right) and left
        for key, r in left.items():
            for c in set(a.columns) - set(keys):
                assert right[key][c] == (pytest.approx(r[c], rel=1e-12, nan_ok=True) if r[c] is not None else None)
    scans = sums._jdf.queryExecution().executedPlan().toString()
    assert scans.count("Expand") == 1
