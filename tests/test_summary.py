from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import FEBRUARY, JANUARY
from stationhour.functions.numbering import number_rows
from stationhour.functions.quantiles import grouped_quantiles, quantiles_of_counts, refined_quantiles, value_bucket, value_counts
from stationhour.functions.scalar import nan_to_null
from stationhour.operators import enrichment
from stationhour.operators.cleaning import clean
from stationhour.operators.partials import STATE_SCHEMA, file_states, summary_of_states
from stationhour.operators.summary import station_hour_summary
from stationhour.plans.months import month_pipeline
from stationhour.sources.tables import scan_meta
from stationhour.schemas import META_SCHEMA, STATISTICS, SUMMARY_KEYS, Params

PLAIN = Params()
SPLIT = Params(medians="split")


def by_station(df):
    return {r.station: r for r in df.collect()}


def test_null_rules(raw_rows, calendar):
    rows = raw_rows(
        {"station": 1, "days": JANUARY[:4], "flow": None}, {"station": 1, "time_stamp_string": JANUARY[4], "flow": 7.0},
        {"station": 2, "days": JANUARY[:3]},                      # too few days
        {"station": 3, "days": JANUARY[:5], "length": None},      # null key
        {"station": 4, "days": JANUARY[:4], "speed": None},
        {"station": 5, "days": JANUARY[:4], "flow": float("nan")})
    for params in (PLAIN, SPLIT):
        found = by_station(station_hour_summary(clean(nan_to_null(rows), calendar), params))
        assert set(found) == {1, 4, 5}
        assert (found[1].days_observed, found[1].median_flow, found[1].avg_flow, found[1].sd_flow) == (5, 7.0, 7.0, None)
        assert found[4].median_speed is None and found[4].avg_speed is None and found[4].median_flow == 100.0
        assert found[5].median_flow is None and found[5].days_observed == 4


@pytest.fixture(scope="module")
def random_rows(spark, raw_rows):
    rng = np.random.default_rng(7)
    n = 4000
    day = rng.integers(1, 29, n)
    frame = pd.DataFrame({
        # one station holds more than a third of all rows
        "station": np.where(rng.random(n) < 0.4, 1, rng.integers(2, 9, n)).astype("int32"),
        "month": rng.integers(1, 4, n), "hour": rng.integers(7, 9, n), "day": day,
        "flow": np.where(rng.random(n) < 0.1, np.nan, rng.lognormal(5, 2, n).round(3)),
        "speed": rng.normal(0, 30, n).round(1), "occupancy": rng.random(n)})
    rows = spark.createDataFrame(frame)
    stamp = F.format_string("%02d/%02d/2024 %02d:00:00", "month", "day", "hour")
    base = raw_rows({}).drop("station", "flow", "speed", "occupancy", "time_stamp_string")
    full = rows.withColumn("time_stamp_string", stamp).select("station", "flow", "speed", "occupancy", "time_stamp_string")
    one = base.withColumn("k", F.lit(1))
    return nan_to_null(full.withColumn("k", F.lit(1)).join(F.broadcast(one), "k").drop("k"))


def test_split_medians_equal_built_in_and_pandas(random_rows, calendar):
    rows = clean(random_rows, calendar)
    keys = ["station", "hour", "month_num"]
    plain = station_hour_summary(rows, PLAIN).toPandas().sort_values(keys).reset_index(drop=True)
    split = station_hour_summary(rows, SPLIT).toPandas().sort_values(keys).reset_index(drop=True)
    pd.testing.assert_frame_equal(plain, split)
    values = {k: part for k, part in rows.toPandas().groupby(keys) if len(part) >= 4}
    assert set(values) == set(plain[keys].itertuples(index=False, name=None))
    for row in plain.itertuples():
        part = values[row.station, row.hour, row.month_num]
        assert row.days_observed == len(part)
        for column, suffix in (("flow", "flow"), ("speed", "speed"), ("occupancy", "occup")):
            known = part[column].dropna().to_numpy()
            np.testing.assert_allclose(getattr(row, f"median_{suffix}"), np.median(known))
            np.testing.assert_allclose(getattr(row, f"avg_{suffix}"), np.mean(known))
            np.testing.assert_allclose(getattr(row, f"sd_{suffix}"), np.std(known, ddof=1))


def test_both_medians_treat_nan_as_null(spark, raw_rows, calendar):
    rows = raw_rows(*[{"time_stamp_string": t, "flow": f} for t, f in zip(JANUARY, (1.0, 2.0, 4.0, float("nan")))])
    for params in (PLAIN, SPLIT):
        found = station_hour_summary(clean(rows, calendar, params), params).first()
        assert (found.median_flow, found.days_observed) == (2.0, 4) and found.avg_flow == pytest.approx(7 / 3)
    with pytest.raises(ValueError):
        station_hour_summary(clean(rows, calendar), Params(medians="guess"))


def test_gate_judges_each_district(raw_rows, calendar, meta):
    rows = raw_rows({"station": 1, "days": JANUARY}, {"station": 9, "district": 7, "days": JANUARY})
    assert [r.station for r in month_pipeline(rows, meta, calendar).collect()] == [1]


@pytest.mark.parametrize("fractions", [(0.25, 0.5, 0.75), (0.0, 0.9, 1.0)])
def test_quantiles_against_numpy(spark, fractions):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"g": rng.integers(0, 3, 3000), "x": rng.lognormal(0, 3, 3000) * rng.choice([-1, 1], 3000)})
    frame.loc[frame.g == 2, "x"] = 5.0
    frame.loc[0, "x"] = 1e12
    got = grouped_quantiles(spark.createDataFrame(frame), ["g"], {"x": F.col("x")},
                            {f"q{i}": ("x", f) for i, f in enumerate(fractions)}).toPandas().set_index("g").sort_index()
    for g, part in frame.groupby("g"):
        np.testing.assert_allclose(got.loc[g].to_numpy(), np.quantile(part.x, fractions), rtol=1e-12)


def test_value_bucket_is_monotone(spark):
    values = np.sort(np.concatenate([np.random.default_rng(1).normal(0, 1000, 2000), [-1e300, -1, -1e-9, 0.0, 1e-9, 1, 1e300]]))
    got = spark.createDataFrame(pd.DataFrame({"i": range(len(values)), "x": values})).withColumn(
        "b", value_bucket(F.col("x"))).orderBy("i").toPandas().b
    assert got.is_monotonic_increasing


def test_number_rows(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("a"), F.reverse(F.col("id").cast("string")).alias("b"))
    got = number_rows(frame, ["a", "b"]).toPandas().sort_values("row_number").reset_index(drop=True)
    want = frame.toPandas().sort_values(["a", "b"]).reset_index(drop=True)
    assert got.row_number.tolist() == list(range(1000))
    pd.testing.assert_frame_equal(got[["a", "b"]], want)


@pytest.fixture(scope="module")
def meta(spark):
    return spark.createDataFrame(
        [(1, 5, "N", 12, 59, "R1", 10.5, 33.0, -118.0), (2, 5, "S", 12, 59, "R2", None, 33.1, -118.1)], META_SCHEMA)


def test_unknown_station_drops_only_its_month(raw_rows, calendar, meta):
    rows = raw_rows({"station": 1, "days": JANUARY + FEBRUARY}, {"station": 9, "days": FEBRUARY},
                    {"station": 2, "days": JANUARY})
    found = month_pipeline(rows, meta, calendar).collect()
    assert {(r.station, r.month) for r in found} == {(1, "January"), (2, "January")}
    # a known station with another direction keeps its row without metadata
    assert {r.station: r.abs_pm for r in found} == {1: 10.5, 2: None}
    assert next(r for r in found if r.station == 2).county is None
    kept = month_pipeline(rows, meta, calendar, on_missing="keep")
    assert kept.count() == 4
    summary = station_hour_summary(clean(rows, calendar))
    assert [(r.station, r.month) for r in enrichment.missing_stations(summary, meta).collect()] == [(9, "February")]
    with pytest.raises(ValueError):
        enrichment.enrich(summary, meta, "guess")


def test_duplicate_metadata_fans_out(raw_rows, calendar, meta):
    summary = station_hour_summary(clean(raw_rows({"station": 1, "days": JANUARY}), calendar))
    assert enrichment.add_metadata(summary, meta.unionByName(meta)).count() == 2


def test_summary_plan(spark, random_rows, calendar, meta, tmp_path):
    random_rows.write.parquet(f"{tmp_path}/rows")
    meta.write.option("header", True).csv(f"{tmp_path}/meta")
    rows = clean(spark.read.parquet(f"{tmp_path}/rows"), calendar)
    plan = enrichment.add_metadata(station_hour_summary(rows, PLAIN), scan_meta(spark, f"{tmp_path}/meta"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and text.count("FileScan parquet") == 1 and "partial_percentile" in text
    assert "BroadcastHashJoin" in text and "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text


# ---------------------------------------------------------------- narrowed ranges and merged states

QUARTILES = {"low": ("flow", 0.25), "mid": ("flow", 0.5), "high": ("speed", 0.9), "least": ("speed", 0.0), "most": ("flow", 1.0)}


@pytest.mark.parametrize("buckets, bound", [(2, 1), (7, 3), (1024, 4096)])
def test_refined_quantiles_match_numpy(spark, buckets, bound):
    rng = np.random.default_rng(2)
    rows = [(g, float(v), s) for g in range(4) for v, s in zip(
        [rng.normal(60, 1e-9, 50), rng.lognormal(0, 30, 50), np.repeat([1.0, -5.0], 25), rng.integers(-3, 3, 50) * 1e300][g], rng.random(50).tolist(), strict=True)]
    rows += [(9, 5.0, None), (8, None, None), (None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g INT, flow DOUBLE, speed DOUBLE")
    counts = value_counts(df, ["g"], {"flow": F.col("flow"), "speed": F.col("speed")})
    got = {r.g: r for r in refined_quantiles(counts, ["g"], QUARTILES, buckets=buckets, bound=bound).collect()}
    plain = {r.g: r for r in quantiles_of_counts(counts, ["g"], QUARTILES).collect()}
    assert set(got) == set(plain) == {0, 1, 2, 3, 9}
    for g, row in got.items():
        for name, (column, fraction) in QUARTILES.items():
            values = sorted(v for v in ((r[1] if column == "flow" else r[2]) for r in rows if r[0] == g) if v is not None)
            if not values:
                assert row[name] is None
                continue
            at = fraction * (len(values) - 1)
            a, b = values[int(np.floor(at))], values[int(np.ceil(at))]
            want = a if a == b else a * (1 - (at - np.floor(at))) + b * (at - np.floor(at))
            assert row[name] == want == plain[g][name]


def test_crowded_values_are_not_ordered_in_one_task(spark):
    """Many distinct values near 60: the last step orders no more than the bound."""
    values = spark.range(300_000).select(F.lit(1).alias("g"), (60 + F.col("id") * 1e-12).alias("value"), F.lit("speed").alias("measure"), F.lit(1).cast("long").alias("n"))
    got = refined_quantiles(values, ["g"], {"m": ("speed", 0.5)}, buckets=64, bound=100)
    assert got.first().m == pytest.approx(60 + 149_999.5e-12, abs=1e-12)
    ordered = value_counts(values.withColumn("v", F.col("value")), ["g"], {"speed": F.col("v")}).groupBy("g", value_bucket(F.col("value"))).count()
    assert ordered.count() == 1  # one bucket of the plain way has them all


@pytest.mark.parametrize("params", [PLAIN, SPLIT])
def test_merged_states_equal_the_summary(spark, random_rows, calendar, params):
    rows = clean(random_rows, calendar).withColumn("file", F.concat(F.lit("f"), F.pmod(F.xxhash64("date", "flow"), F.lit(5)).cast("string")))
    want = {tuple(r[k] for k in SUMMARY_KEYS): r for r in station_hour_summary(rows, params).collect()}
    states = file_states(rows, params)
    got = {tuple(r[k] for k in SUMMARY_KEYS): r for r in summary_of_states(states, params).collect()}
    assert set(got) == set(want) and len(got) > 20
    for key, r in got.items():
        assert r.days_observed == want[key].days_observed
        for name in STATISTICS:
            assert r[name] == (pytest.approx(want[key][name], rel=1e-9, abs=1e-9) if want[key][name] is not None else None)
    assert states.schema.names == STATE_SCHEMA.names


def test_states_of_large_values_close_together(spark, calendar, raw_rows):
    """Squared deviations are merged pair by pair, not from sums of squares."""
    rows = raw_rows(*[{"station": 1, "time_stamp_string": t, "flow": 1e9 + i} for i, t in enumerate(JANUARY)])
    parts = clean(rows, calendar).withColumn("file", F.col("flow").cast("string"))
    found = summary_of_states(file_states(parts)).first()
    assert found.sd_flow == pytest.approx(np.std(np.arange(len(JANUARY)), ddof=1), rel=1e-12) and found.median_flow == 1e9 + (len(JANUARY) - 1) / 2
    nothing = summary_of_states(file_states(parts.withColumn("flow", F.lit(None).cast("double")))).first()
    assert (nothing.avg_flow, nothing.sd_flow, nothing.median_flow, nothing.days_observed) == (None, None, None, len(JANUARY))
