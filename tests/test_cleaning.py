from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import JANUARY
from stationhour.functions import periods, scalar
from stationhour.operators.cleaning import add_date_parts, clean
from stationhour.schemas import CLEAN_COLUMNS, Params


@pytest.mark.parametrize("filled, first_gap, populated", [(2, 3, 2), (7, 8, 7), (8, 8, 8), (0, 1, 0)])
def test_lane_count(raw_rows, filled, first_gap, populated):
    flows = {f"flow_{i}": (1.0 if i <= filled else None) for i in range(1, 9)}
    row = raw_rows(flows).select(scalar.lane_count().alias("a"), scalar.lane_count("populated").alias("b")).first()
    assert (row.a, row.b) == (first_gap, populated)


def test_lane_count_refuses_unknown_rule():
    with pytest.raises(ValueError):
        scalar.lane_count("widest")


@pytest.mark.parametrize("text, expected", [
    ("03/10/2024 02:30:00", dt.datetime(2024, 3, 10, 2, 30)),
    ("3/1/2024 2:3:4", dt.datetime(2024, 3, 1, 2, 3, 4)),
    ("13/01/2024 00:00:00", None), ("2024-03-01 00:00:00", None), ("02/30/2024 00:00:00", None),
    ("03/01/2024", None), ("bad", None), ("", None), (None, None), ("03/01/2024 00:00:00Z", None),
])
def test_local_timestamp(spark, text, expected):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        frame = spark.createDataFrame([(text,)], "s STRING")
        assert frame.select(scalar.local_timestamp(F.col("s"))).first()[0] == expected
        if expected:
            assert add_date_parts(frame, "s").first().hour == expected.hour
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_clean_keeps_only_good_midweek_days(raw_rows, calendar):
    rows = raw_rows(
        {"days": JANUARY}, {"station": 2, "pct_obs": 79}, {"station": 3, "pct_obs": None},
        {"station": 4, "time_stamp_string": "01/05/2024 08:00:00"},     # Friday
        {"station": 5, "time_stamp_string": "07/04/2024 08:00:00"},     # holiday
        {"station": 6, "time_stamp_string": "bad"}, {"station": 7, "time_stamp_string": "bad", "pct_obs": 10})
    found = clean(rows, calendar)
    assert found.columns == CLEAN_COLUMNS
    assert {r.station for r in found.collect()} == {1} and found.count() == len(JANUARY)
    one = found.where("date = DATE'2024-01-03'").first()
    assert (one.month, one.day_of_week, one.hour, one.year, one.month_num) == ("January", "Wednesday", 8, 2024, 1)
    assert clean(rows, calendar, Params(min_pct_obs=0)).count() == len(JANUARY) + 1


def test_clean_plan_is_one_stage_with_pushdown(spark, raw_rows, calendar, tmp_path):
    path = str(tmp_path / "raw")
    raw_rows({"days": JANUARY}).write.parquet(path)
    plan = clean(spark.read.parquet(path), calendar)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(pct_obs,80.0)" in plan
    read = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "delay_35" not in read and "occ_1" not in read and "flow_8" not in read and "samples" not in read
    assert "BroadcastHashJoin LeftAnti" in plan and "Exchange hashpartitioning" not in plan and "Python" not in plan
    assert plan.count("regexp_replace") == 1


def _nth(year, month, weekday, n):
    days = [d for d in (dt.date(year, month, 1) + dt.timedelta(i) for i in range(31)) if d.month == month and d.weekday() == weekday]
    return days[n]


def test_calendar_against_brute_force(calendar):
    found = {r["date"] for r in calendar.collect()}
    expected = set()
    for year in range(2019, 2026):
        fixed = [dt.date(year, *md) for md in ((1, 1), (3, 31), (7, 4), (11, 11), (12, 25))]
        fixed += [dt.date(year, 6, 19)] if year >= 2021 else []
        for day in fixed:
            expected.add(day)
            shift = {5: -1, 6: 1}.get(day.weekday())
            if shift:
                expected.add(day + dt.timedelta(shift))
        thanksgiving = _nth(year, 11, 3, 3)
        expected |= {_nth(year, 1, 0, 2), _nth(year, 2, 0, 2), _nth(year, 5, 0, -1), _nth(year, 9, 0, 0),
                     _nth(year, 10, 0, 1), thanksgiving, thanksgiving + dt.timedelta(1)}
    assert found == expected


@pytest.mark.parametrize("name, expected", [
    ("d12_text_station_hour_2025_07.txt.gz", (2025, 7, "July")), ("2024_09_d12_station_hour.txt.gz", (2024, 9, "September")),
    ("x_2025_13.txt.gz", (None, None, None)), ("x_2025_00.txt", (None, None, None)), ("none.txt", (None, None, None)),
    ("a_2020_13_2021_05.txt", (None, None, None))])
def test_period_from_file_name(spark, name, expected):
    row = periods.with_name_period(spark.createDataFrame([(name,)], "file_name STRING")).first()
    assert (row.year, row.month_num, row.month) == expected


@pytest.mark.parametrize("day, year, month", [("2025-01-15", 2024, "December"), ("2024-03-31", 2024, "February"),
                                              ("2024-12-01", 2024, "November")])
def test_previous_month(spark, day, year, month):
    y, m = periods.previous_month(F.lit(day).cast("date"))
    assert tuple(spark.range(1).select(y, m).first()) == (year, month)


def test_scalars(spark):
    df = spark.createDataFrame([("1,234,567", "7", 6.0, 2), ("x", "1x", 6.0, 0), (None, None, 6.0, None)],
                               "size STRING, n STRING, avg_flow DOUBLE, lanes INT")
    got = df.select(scalar.megabites(F.col("size")), scalar.to_number(F.col("n"), "int"),
                    scalar.flow_per_lane(df.columns)).collect()
    assert [tuple(r) for r in got] == [(1.2, 7, 3.0), (None, None, None), (None, None, None)]
    assert df.select(scalar.flow_per_lane(["avg_flow"]).alias("f")).first().f is None
    hours = spark.range(24).select("id", scalar.peak_bucket(F.col("id")).alias("p")).where("p LIKE 'Peak%'")
    assert sorted(r.id for r in hours.collect()) == [7, 8, 9, 16, 17, 18]
    ties = spark.createDataFrame([(40.25,), (40.35,), (-0.25,)], "x DOUBLE")
    assert [r[0] for r in ties.select(scalar.round_half_even(F.col("x"))).collect()] == [40.2, 40.4, -0.2]
