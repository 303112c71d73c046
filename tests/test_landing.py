from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import JANUARY
from fixtures.landing import land_raw
from stationhour.operators.cleaning import clean
from stationhour.operators.partials import file_states
from stationhour.plans import months
from stationhour.sources import raw


@pytest.fixture
def split(spark):
    """Partitions of more than a few KB are split."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "8k")
    yield
    spark.conf.unset(key)


def test_months_in_several_files_keep_their_name(spark, raw_rows, split):
    """A month too large for a file has several of one name; no row is lost, and no task sorts its rows to write them."""
    one = raw_rows({"days": JANUARY, "station": 3, "district": 7}, {"days": JANUARY, "district": 12, "length": None, "flow": 1e7})
    rows = one.crossJoin(spark.range(0, 3000, 1, 8).select(F.xxhash64("id").cast("string").alias("x"))).withColumn("direction", F.col("x")).drop("x")
    pattern = land_raw(rows)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    plans = spark._jsparkSession.sharedState().statusStore().executionsList()
    assert "Sort" not in plans.last().physicalPlanDescription()
    files = sorted(Path(pattern.removesuffix("/*").removeprefix("file:")).rglob("*.gz"))
    assert len(files) > 2 and {f.name for f in files} == {"d07_text_station_hour_2024_01.txt.gz", "d12_text_station_hour_2024_01.txt.gz"}
    found = raw.discover_files(spark, pattern)
    assert found.count() == found.select("file").distinct().count() == len(files)
    landed = raw.scan_raw(spark, pattern)
    wanted = rows.select(*landed.columns).withColumns({c: F.col(c).cast(t) for c, t in landed.dtypes})
    assert landed.exceptAll(wanted).isEmpty() and wanted.exceptAll(landed).isEmpty()


def test_file_names_are_read_once_a_state(spark, write_raw, calendar):
    """What depends on a row's file and month alone is computed above the aggregation of its rows, and foreign rows leave no state."""
    folder = write_raw({"d12_text_station_hour_2024_01.txt": [{"time_stamp_string": d} for d in (*JANUARY, "02/06/2024 08:00:00")]})
    rows = clean(raw.scan_raw(spark, folder, origin=True), calendar).withColumn("file", F.col("file_path"))
    states = months._own_states(file_states(rows), raw.root_of(spark, folder))
    above, below = states._jdf.queryExecution().optimizedPlan().toString().split("Aggregate", 1)
    assert "regexp_extract(" in above and "regexp_extract(" not in below and "decode" not in below.lower()
    assert [(r.file, r.month_num, r.rows) for r in states.collect()] == [("d12_text_station_hour_2024_01.txt", 1, len(JANUARY))]
