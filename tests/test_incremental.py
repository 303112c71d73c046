from __future__ import annotations

import os
import pathlib
import shutil

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import FEBRUARY, JANUARY
from stationhour.operators import files
from stationhour.plans.manifest import list_new_files, record_fetched
from stationhour.plans.monthly import monthly_round
from stationhour.plans import months
from stationhour.plans.delivery import deliver
from stationhour.plans.months import backfill, known_files, month_pipeline
from stationhour.schemas import MANIFEST_SCHEMA, META_SCHEMA, PROCESSED_SCHEMA
from stationhour.sources import documents, raw, tables, versions
from stationhour.streaming import ingest


@pytest.fixture(scope="module")
def meta(spark):
    return spark.createDataFrame([(s, 5, "N", 12, 59, "R1", float(s), 33.0, -118.0) for s in (1, 2)], META_SCHEMA)


def days(station, stamps, **more):
    return [{"station": station, "time_stamp_string": t, **more} for t in stamps]


def rows_of(df):
    return sorted((r.station, r.year, r.month_num, r.days_observed, r.avg_flow, r.abs_pm) for r in df.collect())


def test_scan_reads_text_and_gzip(spark, write_raw):
    folder = write_raw({
        "a_2024_01.txt": [{"station": 1}, {"station": 2, "flow": "NaN", "length": None}],
        "b_2024_02.txt.gz": [{"station": 3}, ",".join(write_raw.line({"station": 4}).split(",")[:13])],
        "c_2024_03.csv": [{"station": 5}]})
    found = {r.station: r for r in raw.scan_raw(spark, folder, origin=True).collect()}
    assert set(found) == {1, 2, 3, 4}
    assert found[2].flow is None and found[2].length is None and found[4].flow_1 is None and found[4].speed == 60.0
    assert (found[3].file_name, found[3].file_year, found[3].file_month_num) == ("b_2024_02.txt.gz", 2024, 2)


def test_discovery_and_latest(spark, write_raw):
    folder = write_raw({n: [{}] for n in ("d07_2024_01.txt", "d12_2024_01.txt.gz", "x_2025_13.txt.gz", "none.txt", "z_2024_02.gz")})
    found = raw.discover_files(spark, folder)
    assert [r.file_name for r in found.collect()] == ["d07_2024_01.txt", "d12_2024_01.txt.gz", "z_2024_02.gz"]
    assert sorted(r.file_name for r in raw.latest_files(found).collect()) == ["d12_2024_01.txt.gz", "z_2024_02.gz"]


def test_backfill_is_incremental_and_idempotent(spark, write_raw, calendar, meta, tmp_path):
    table = str(tmp_path / "table")
    one = {"d12_2024_01.txt.gz": days(1, JANUARY) + days(9, ["bad"], pct_obs=10),
           "d07_2024_01.txt": days(2, JANUARY[:4], flow=10.0)}
    folder = write_raw(one)
    first = rows_of(backfill(spark, folder, table, meta, calendar))
    assert first == [(1, 2024, 1, 7, 100.0, 1.0), (2, 2024, 1, 4, 10.0, 2.0)]
    assert rows_of(backfill(spark, folder, table, meta, calendar)) == first
    # a new month is added; a row of another month in its file replaces nothing
    both = write_raw({**one, "d12_2024_02.txt": days(1, FEBRUARY) + days(1, JANUARY[:5], flow=1.0),
                      "d12_2024_03.txt": days(77, ["03/05/2024 08:00:00"] * 4)})
    second = rows_of(backfill(spark, both, table, meta, calendar))
    assert second == [(1, 2024, 1, 7, 100.0, 1.0), (1, 2024, 2, 5, 100.0, 1.0), (2, 2024, 1, 4, 10.0, 2.0)]
    status = {r.year: r for r in files.year_status(tables.scan_processed(spark, table)).collect()}
    assert status[2024].processed_months == ["February", "January"] and status[2024].missing_months[0] == "March"


def test_backfill_options(spark, write_raw, calendar, meta, tmp_path):
    too_long = write_raw.line({"station": 2}) + ",1,2,3"
    folder = write_raw({"a_2024_01.txt": days(2, JANUARY), "b_2024_01.txt": days(1, JANUARY),
                        "c_2024_02.txt": days(1, FEBRUARY) + [too_long]})
    latest = rows_of(backfill(spark, folder, str(tmp_path / "l"), meta, calendar, latest_only=True))
    assert [r[:3] for r in latest] == [(1, 2024, 1), (1, 2024, 2)]
    strict = rows_of(backfill(spark, folder, str(tmp_path / "s"), meta, calendar, strict_file=True))
    assert [r[:3] for r in strict] == [(1, 2024, 1), (2, 2024, 1)]


def test_quarantine(spark, write_raw):
    folder = write_raw({"a_2024_01.txt": [
        {}, write_raw.line({}) + ",1", {"flow": "abc"}, {"time_stamp_string": "bad"},
        {"time_stamp_string": "bad", "pct_obs": 10}, ",".join(write_raw.line({}).split(",")[:20])]})
    assert sorted(r.reason for r in raw.quarantine(spark, folder).collect()) == [
        "too many fields", "unreadable time stamp", "unreadable value"]
    more = write_raw({"a_2024_01.txt": [{"station": 1201.0, "pct_obs": 87.5}, {"station": 1.5}, {"time_stamp_string": FEBRUARY[0]}, {"district": "NaN"}],
                      "none.txt": [{"time_stamp_string": FEBRUARY[0]}]})
    assert sorted((r.reason, r.file_name) for r in raw.quarantine(spark, more).collect()) == [
        ("another month", "a_2024_01.txt"), ("unreadable value", "a_2024_01.txt"), ("unreadable value", "a_2024_01.txt")]
    kept = raw.scan_raw(spark, more).where("pct_obs = 87.5").first()
    assert kept.station == 1201


def test_whole_numbers_in_metadata(spark, tmp_path):
    (tmp_path / "meta.csv").write_text("station,route,direction,district,county,abs_pm\n1,5.0,N,12,59.0,1.5\n2,5,N,12,,2\n3,5,N,12,x,2\n")
    found = {r.station: (r.route, r.county) for r in tables.scan_meta(spark, str(tmp_path / "meta.csv")).collect()}
    assert found == {1: (5, 59), 2: (5, None), 3: (5, None)}


def test_writing_a_month_replaces_only_that_month(spark, tmp_path):
    table = str(tmp_path / "t")
    empty = tables.scan_processed(spark, table)
    assert empty.count() == 0 and empty.schema == PROCESSED_SCHEMA

    tables.write_months(processed(spark, (1, 2024, 1), (2, 2024, 2), (3, 2023, 1)), table)
    tables.write_months(processed(spark, (9, 2024, 1)), table)
    got = tables.scan_processed(spark, table)
    assert sorted((r.station, r.year, r.month_num) for r in got.collect()) == [(2, 2024, 2), (3, 2023, 1), (9, 2024, 1)]
    plan = got.where("year = 2024 AND month_num = 1 AND hour = 7").select("avg_flow")._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters: [isnotnull(year" in plan and "EqualTo(hour,7)" in plan and "ReadSchema: struct<hour:int,avg_flow:double>" in plan


def test_yearly_files_of_the_older_layout(spark, tmp_path):
    pd.DataFrame({"station": [1], "month": ["May"], "avg_flow": [2.0]}).to_parquet(tmp_path / "2021_station_hour_processed.parquet")
    pd.DataFrame({"station": [2], "lanes": [3], "year": [2019]}).to_parquet(tmp_path / "2022_station_hour_processed.parquet")
    pd.DataFrame({"station": [3.0], "county": [59.0], "year": [2020.0]}).to_parquet(tmp_path / "2020_station_hour_processed.parquet")
    pd.DataFrame({"station": [4], "county": [7]}).to_parquet(tmp_path / "2018_station_hour_processed.parquet")
    (tmp_path / "2017_station_hour_processed.parquet").write_text("not a table")
    (tmp_path / "notes.parquet").write_text("not a table")
    found = {r.station: r for r in tables.scan_yearly_files(spark, str(tmp_path)).collect()}
    assert (found[1].year, found[2].year, found[3].year, found[4].year) == (2021, 2019, 2020, 2018)
    assert (found[3].county, found[4].county) == (59, 7)
    assert tables.scan_yearly_files(spark, str(tmp_path)).schema == PROCESSED_SCHEMA
    assert found[1].lanes is None and found[2].month is None and found[1].latitude is None
    assert tables.scan_yearly_files(spark, str(tmp_path / "none")).count() == 0


def test_export_and_union(spark, tmp_path):
    a = spark.createDataFrame([(1, "N")], "station INT, direction STRING")
    b = spark.createDataFrame([(2, 3.5)], "station INT, abs_pm DOUBLE")
    both = tables.union_by_name(a, b)
    tables.export_csv(both, str(tmp_path / "csv"))
    back = spark.read.option("header", True).schema(both.schema).csv(str(tmp_path / "csv"))
    assert sorted(map(str, back.collect())) == sorted(map(str, both.collect()))


def test_new_files_go_by_id(spark, tmp_path):
    def manifest(*ids):
        return spark.createDataFrame([("station_hour", "12", "2024", "May", i, i, 1.0, "/") for i in ids], MANIFEST_SCHEMA)
    # same file_type at the same row, other id: still new; known id at another row: not new
    found = files.new_files(manifest("b", "a"), manifest("a", "z"))
    assert [r.file_id for r in found.collect()] == ["b"]
    nameless = manifest("a", "c").withColumn("file_id", F.lit(None).cast("string"))
    assert [r.file_name for r in files.new_files(nameless, nameless.where("file_name = 'a'")).collect()] == ["c"]
    path = str(tmp_path / "ledger")
    assert tables.scan_ledger(spark, path).count() == 0
    responses = spark.createDataFrame([("station_hour", "12", "2024", '{"data": {"May": [{"file_name": "f", "file_id": "1", "bytes": "49,512,345", "url": "/u"}], "June": []}}'),
                                       ("station_hour", "12", "2023", '{"data": {}}'), ("other", "12", "2024", "broken")],
                                      "file_type STRING, district STRING, year STRING, json STRING")
    requests = files.request_grid(spark.createDataFrame([(["station_hour", "other"], ["12"], 2023, 2024)],
                                  "file_types ARRAY<STRING>, districts ARRAY<STRING>, start_year INT, end_year INT"), "https://h.example")
    assert requests.count() == 4 and "https://h.example/?srq=clearinghouse&district_id=12&yy=2023&type=other&returnformat=text" in {
        r.url for r in requests.collect()}
    first = list_new_files(responses, requests, path)
    assert [(r.file_id, r.megabites, r.month) for r in first.collect()] == [("1", 49.5, "May")]
    # what has not been fetched stays pending; reports that come twice are recorded once
    assert record_fetched(spark, first.withColumn("ok", F.lit(False)), path).count() == 0
    assert record_fetched(spark, first.withColumn("ok", F.lit(None).cast("boolean")), path).count() == 0
    assert list_new_files(responses, requests, path).count() == 1
    assert record_fetched(spark, first.unionByName(first), path).count() == 1 and record_fetched(spark, first, path).count() == 0
    assert list_new_files(responses, requests, path).count() == 0 and tables.scan_ledger(spark, path).count() == 1
    assert documents.flatten_listing(responses, ["June"]).count() == 0


def test_monthly_round(spark, tmp_path):
    listing = '{"data": {"May": [{"file_name": "d12_2024_05", "file_id": "1", "bytes": "1,000", "url": "/u"}], "June": [{"file_name": "d12_2024_06", "file_id": "2", "bytes": "1", "url": "/v"}]}}'
    responses = spark.createDataFrame([("station_hour", "12", "2024", listing)], "file_type STRING, district STRING, year STRING, json STRING")
    scopes = spark.createDataFrame([(["station_hour"], ["12"])], "file_types ARRAY<STRING>, districts ARRAY<STRING>")
    held = spark.createDataFrame([("raw", "old", "2020", "May"), ("processed", "p", "2024", "May")], "kind STRING, file_name STRING, year STRING, month STRING")
    found, decided = monthly_round(responses, scopes, "https://h.example", str(tmp_path / "ledger"), held, "2024-06-15")
    assert [r.file_id for r in found.collect()] == ["1"]
    assert {r.file_name: r.action for r in decided.collect()} == {"old": "skip", "p": "upload", "d12_2024_05": "upload"}
    again, _ = monthly_round(responses, scopes, "https://h.example", str(tmp_path / "ledger"), held, "2024-06-15")
    assert again.count() == 1
    record_fetched(spark, again, str(tmp_path / "ledger"))
    last, _ = monthly_round(responses, scopes, "https://h.example", str(tmp_path / "ledger"), held, "2024-06-15")
    assert last.count() == 0


def test_page_catalogue(spark):
    page = """<html><script>var a = 1;</script><SCRIPT type="text/javascript">
      YAHOO.bts.Data = {labels: {station_hour: "Station Hour"},
        form_data: { reid_raw: {all: "all"}, station_hour: {12: "d12", 3: "d3"}}}
    </SCRIPT><p>YAHOO.bts.Data = {no: "script"}</p></html>"""
    pages = spark.createDataFrame([(1, page), (2, "<p>nothing</p>"), (3, None)], "id INT, html STRING")
    found = documents.page_catalogues(pages)
    got = {r.id: r for r in found.collect()}
    assert got[1].labels == {"station_hour": "Station Hour"} and got[1].form_data["station_hour"] == {"12": "d12", "3": "d3"}
    assert got[2].form_data is None and got[3].form_data is None
    assert sorted(r.file_type for r in documents.file_types(found).collect()) == ["reid_raw", "station_hour"]
    assert [r.district for r in documents.districts(found).collect()] == [*documents.DISTRICTS, "3", "12"]


def test_catalogues_of_any_depth(spark):
    texts = [(1, '{"a": {"b": {"c": {"d": 1, "e": [1, {"x": 2}]}}}, "f": null, "g": {}, "h": true}'), (2, "not json"), (3, None), (4, "7"), (5, '{"a.b": {"c d": "t"}}')]
    rows = spark.createDataFrame(texts, "id INT, text STRING").select("id", F.try_parse_json("text").alias("catalogue"))
    got = sorted((r.id, tuple(r.path), r.value) for r in documents.variant_leaves(rows).collect() if r.value is not None)
    assert got == [(1, ("a", "b", "c", "d"), "1"), (1, ("a", "b", "c", "e"), '[1,{"x":2}]'), (1, ("h",), "true"), (4, (), "7"), (5, ("a.b", "c d"), "t")]
    page = "<script>\nYAHOO.bts.Data = {labels: {a: {b: {c: 1}}}}\n</script>"
    pages = documents.page_variants(spark.createDataFrame([(1, page), (2, page.replace("1", "'")), (3, None)], "id INT, html STRING"))
    assert [r.id for r in pages.where("catalogue IS NOT NULL").collect()] == [1]
    assert documents.variant_leaves(pages.where("id = 3")).count() == 0


@pytest.mark.parametrize("kind, year, month, expected", [
    ("processed", "2024", "September", ("upload", "processed/2024/f", False, False)),
    ("processed", None, None, ("upload", "processed/2025/f", False, False)),
    ("raw", "2025", "July", ("upload", "raw-rolling/2025-07/f", True, False)),
    ("raw", "2023", "January", ("skip", None, True, True)),
    ("raw", "2026", "January", ("upload", "raw-rolling/2026-01/f", False, False)),
    ("raw", "2024", "Smarch", ("invalid", None, False, False)), ("raw", None, "May", ("invalid", None, False, False)),
    ("csv", "2024", "May", ("unknown", None, False, False))])
def test_retention(spark, kind, year, month, expected):
    one = spark.createDataFrame([(kind, "f", year, month)], "kind STRING, file_name STRING, year STRING, month STRING")
    row = files.retention(one, "2025-10-15").first()
    assert (row.action, row.key, row.delete_local, row.lost) == expected
    off = files.retention(one, "2025-10-15", upload_enabled=False).first()
    assert (off.action, off.key, off.delete_local) == ("disabled", None, False)
    if kind == "raw":
        assert files.retention(one, "2025-10-15", upload_raw=False).first().action == "disabled"


@pytest.mark.parametrize("as_of, action, delete", [
    ("2024-07-24", "upload", True),      # 389 days after 2023-07-01: twelve whole months
    ("2024-07-25", "skip", True), ("2023-08-29", "upload", False), ("2023-08-30", "upload", True)])
def test_retention_limits(spark, as_of, action, delete):
    one = spark.createDataFrame([("raw", "f", "2023", "July")], "kind STRING, file_name STRING, year STRING, month STRING")
    row = files.retention(one, as_of).first()
    assert (row.action, row.delete_local) == (action, delete)


def test_prefix(spark):
    keys = spark.createDataFrame([("processed/2024/a",), ("raw-rolling/2024-01/b",)], "key STRING")
    assert files.with_prefix(keys, "processed/2024/").count() == 1 and files.with_prefix(keys, "").count() == 2


def test_stream_equals_batch(spark, write_raw, calendar, meta, tmp_path):
    content = {"d12_2024_01.txt.gz": days(1, JANUARY), "d07_2024_01.txt": days(2, JANUARY[:4]) + days(1, JANUARY[:2]),
               "d12_2024_02.txt": days(2, FEBRUARY)}
    folder = write_raw(content)
    seen = []

    def hook(periods, batch_id):
        seen.append((batch_id, sorted(tuple(r) for r in periods.collect())))
        raise RuntimeError("a failing hook does not stop the stream")

    paths = [str(tmp_path / n) for n in ("table", "mark")]
    names = []

    def run():
        failures = ingest.upsert_stream(spark, folder, *paths, meta, calendar, files_per_batch=1, after_batch=hook, after_file=lambda f: names.append(f.file_name))
        return rows_of(tables.scan_processed(spark, paths[0])), failures

    batch = rows_of(month_pipeline(raw.scan_raw(spark, folder), meta, calendar))
    assert run() == (batch, 3) and len(seen) == 3 and sorted(names) == sorted(content)
    assert run() == (batch, 0) and len(seen) == 3      # nothing new
    extra = pathlib.Path(folder) / "d03_2024_02.txt"
    extra.write_text("\n".join(write_raw.line(r) for r in days(1, FEBRUARY)) + "\n")
    assert run() == (rows_of(month_pipeline(raw.scan_raw(spark, folder), meta, calendar)), 1) and len(seen) == 4
    assert seen[-1][1] == [(2024, 2)]


def stream(spark, folder, table, mark, meta, calendar):
    ingest.upsert_stream(spark, folder, table, mark, meta, calendar, files_per_batch=1)
    return rows_of(tables.scan_processed(spark, table))


def test_stream_over_a_backfilled_table_keeps_it(spark, write_raw, calendar, meta, tmp_path):
    table = str(tmp_path / "table")
    first = {"d12_2024_01.txt": days(1, JANUARY)}
    backfill(spark, write_raw(first), table, meta, calendar)
    late = {"d07_2024_01.txt": days(2, JANUARY, district=12)}
    both = [(1, 2024, 1, 7, 100.0, 1.0), (2, 2024, 1, 7, 100.0, 2.0)]
    assert stream(spark, write_raw(late), table, str(tmp_path / "mark"), meta, calendar) == both
    assert rows_of(backfill(spark, write_raw({**first, **late}), table, meta, calendar)) == both


def test_late_and_grown_files_are_loaded(spark, write_raw, calendar, meta, tmp_path):
    table = str(tmp_path / "table")
    one = {"d12_2024_01.txt": days(1, JANUARY[:4])}
    assert [r[3] for r in rows_of(backfill(spark, write_raw(one), table, meta, calendar))] == [4]
    grown = {"d12_2024_01.txt": days(1, JANUARY), "d07_2024_01.txt": days(2, JANUARY)}
    assert [r[:4] for r in rows_of(backfill(spark, write_raw(grown), table, meta, calendar))] == [(1, 2024, 1, 7), (2, 2024, 1, 7)]


def test_a_month_that_becomes_uncovered_goes(spark, write_raw, calendar, meta, tmp_path):
    table, other = str(tmp_path / "table"), str(tmp_path / "other")
    content = {"d12_2024_01.txt": days(1, JANUARY), "d12_2024_02.txt": days(1, FEBRUARY)}
    late = {"e12_2024_01.txt": days(9, JANUARY)}
    folder = write_raw(content)
    backfill(spark, folder, table, meta, calendar)
    backfill(spark, folder, other, meta, calendar)
    left = [(1, 2024, 2, 5, 100.0, 1.0)]
    assert rows_of(backfill(spark, write_raw({**content, **late}), table, meta, calendar)) == left
    assert stream(spark, write_raw(late), other, str(tmp_path / "mark"), meta, calendar) == left


# ---------------------------------------------------------------- published tables and changing files

def processed(spark, *rows):
    return tables.with_expected_columns(spark.createDataFrame(rows, "station INT, year INT, month_num INT"))


def stations(df):
    return sorted((r.station, r.year, r.month_num) for r in df.collect())


def test_a_reader_sees_the_old_or_the_new_month(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    tables.write_months(processed(spark, (1, 2024, 1), (2, 2024, 2)), table)
    before = tables.scan_processed(spark, table)
    seen = []
    real = versions.Folder.create

    def between(self, *args):  # rows are written, the snapshot is not
        seen.append(stations(tables.scan_processed(spark, table)))
        return real(self, *args)
    monkeypatch.setattr(versions.Folder, "create", between)
    tables.replace_months(processed(spark, (9, 2024, 1)), table, [(2024, 1), (2024, 2)])
    assert seen == [[(1, 2024, 1), (2, 2024, 2)]]
    assert stations(tables.scan_processed(spark, table)) == [(9, 2024, 1)]
    assert stations(before) == [(1, 2024, 1), (2, 2024, 2)]  # planned before, read after


def test_a_run_that_breaks_off_leaves_the_old_table(spark, write_raw, calendar, meta, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    content = {"d12_2024_01.txt": days(1, JANUARY)}
    first = rows_of(backfill(spark, write_raw(content), table, meta, calendar))
    late = {**content, "d07_2024_01.txt": days(2, JANUARY), "d12_2024_02.txt": days(1, FEBRUARY)}
    folder = write_raw(late)

    def fail(*_, **__):
        raise OSError("the executor's rack burns")
    for name in ("write_version", "publish"):  # before the rows are complete; between rows and snapshot
        with monkeypatch.context() as broken:
            broken.setattr(versions, name, fail)
            with pytest.raises(OSError):
                backfill(spark, folder, table, meta, calendar)
        assert rows_of(tables.scan_processed(spark, table)) == first
    fresh = rows_of(backfill(spark, folder, str(tmp_path / "fresh"), meta, calendar))
    assert rows_of(backfill(spark, folder, table, meta, calendar)) == fresh and len(fresh) == 3


def test_two_publications_at_once(spark, write_raw, calendar, meta, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    tables.write_months(processed(spark, (1, 2024, 1)), table)
    real, met = versions.Folder.create, []

    def overtaken(self, *args):  # another run takes the number first
        if not met:
            met.append(1)
            tables.write_months(processed(spark, (2, 2024, 2)), table)
        return real(self, *args)
    with monkeypatch.context() as m:
        m.setattr(versions.Folder, "create", overtaken)
        tables.write_months(processed(spark, (3, 2024, 3)), table)
    assert stations(tables.scan_processed(spark, table)) == [(1, 2024, 1), (2, 2024, 2), (3, 2024, 3)]
    met.clear()
    load = str(tmp_path / "load")
    backfill(spark, write_raw({"d12_2024_01.txt": days(1, JANUARY)}), load, meta, calendar)

    def other(self, *args):
        if not met:
            met.append(1)
            tables.write_months(processed(spark, (2, 2020, 2)), load)
        return real(self, *args)
    folder = write_raw({"d12_2024_02.txt": days(1, FEBRUARY)})
    with monkeypatch.context() as m:  # a load rests on what it has read and does not pass over another run
        m.setattr(versions.Folder, "create", other)
        with pytest.raises(versions.Conflict):
            backfill(spark, folder, load, meta, calendar)
    assert sorted(r[1:3] for r in rows_of(backfill(spark, folder, load, meta, calendar))) == [(2020, 2), (2024, 1), (2024, 2)]


def test_plain_tables_are_taken_over(spark, tmp_path):
    table = str(tmp_path / "t")
    processed(spark, (1, 2024, 1), (2, 2024, 2)).write.partitionBy("year", "month_num").parquet(table)
    assert stations(tables.scan_processed(spark, table)) == [(1, 2024, 1), (2, 2024, 2)]
    tables.write_months(processed(spark, (3, 2024, 2)), table)
    assert stations(tables.scan_processed(spark, table)) == [(1, 2024, 1), (3, 2024, 2)]
    tables.remove_months(spark, table, [(2024, 1)])
    assert stations(tables.scan_processed(spark, table)) == [(3, 2024, 2)]
    assert [tuple(r) for r in versions.periods(spark, table).collect()] == [(2024, 2)]


def test_expired_versions_go(spark, write_raw, calendar, meta, tmp_path):
    table = str(tmp_path / "t")
    for station in (1, 2, 3):
        tables.write_months(processed(spark, (station, 2024, 1), (station, 2020 + station, 2)), table)
    assert versions.expire(spark, table, keep=1, hours=24) == 0  # too young
    tables.write_months(processed(spark, (4, 2024, 1)), table)
    now = stations(tables.scan_processed(spark, table))
    versions.write_version(processed(spark, (7, 2024, 1)), table)  # a run that broke off
    assert versions.expire(spark, table, keep=1, hours=-1) == 4
    assert stations(tables.scan_processed(spark, table)) == now == [(1, 2021, 2), (2, 2022, 2), (3, 2023, 2), (4, 2024, 1)]
    changing = str(tmp_path / "c")
    for flow in (1.0, 2.0):
        backfill(spark, write_raw({"d12_2024_01.txt": days(1, JANUARY, flow=flow)}), changing, meta, calendar)
    versions.expire(spark, changing, keep=1, hours=-1)
    assert [r[4] for r in rows_of(backfill(spark, write_raw({"d12_2024_02.txt": days(1, FEBRUARY)}), changing, meta, calendar))] == [2.0, 100.0]


def test_periods_come_without_opening_files(spark, tmp_path):
    table = str(tmp_path / "t")
    tables.write_months(processed(spark, (1, 2024, 1), (2, 2023, 12)), table)
    found = versions.periods(spark, table)
    assert "FileScan" not in found._jdf.queryExecution().toString()
    assert {r.year: r.processed_months for r in files.year_status(found).collect()} == {2024: ["January"], 2023: ["December"]}
    available = spark.createDataFrame([(2024, 1, "January"), (2024, 2, "February")], "year INT, month_num INT, month STRING")
    assert [r.month_num for r in files.pending_months(available, found).collect()] == [2]


def test_no_month_is_lost_to_a_foreign_row(spark, write_raw, calendar, meta, tmp_path):
    """A file's rows of another month neither replace nor remove that month."""
    for load in ("stream", "backfill"):
        table = str(tmp_path / load)
        tables.write_months(processed(spark, (1, 2024, 1)), table)
        folder = write_raw({"d12_2024_02.txt": days(2, FEBRUARY) + days(2, JANUARY[:1])})
        got = (stream(spark, folder, table, str(tmp_path / "mark"), meta, calendar) if load == "stream"
               else rows_of(backfill(spark, folder, table, meta, calendar)))
        assert [r[:3] for r in got] == [(1, 2024, 1), (2, 2024, 2)]


def test_a_month_without_its_files_is_not_replaced_by_a_part(spark, write_raw, calendar, meta, tmp_path):
    late = {"d07_2024_01.txt": days(2, JANUARY, district=12)}
    for kind in ("published", "plain"):
        table = str(tmp_path / kind)
        if kind == "published":
            tables.write_months(processed(spark, (1, 2024, 1)), table)
        else:
            processed(spark, (1, 2024, 1)).write.partitionBy("year", "month_num").parquet(table)
        with pytest.raises(ValueError, match="written without their files"):
            backfill(spark, write_raw(late), table, meta, calendar)
        with pytest.raises(Exception, match="written without their files"):
            stream(spark, write_raw(late), table, str(tmp_path / f"mark-{kind}"), meta, calendar)
        assert stations(tables.scan_processed(spark, table)) == [(1, 2024, 1)]


def _touch(folder, name, lines, write_raw, seconds=5):
    """Write a file anew, with another time stamp."""
    path = pathlib.Path(folder) / name
    path.write_text("\n".join(write_raw.line(r) for r in lines) + "\n" if lines else "")
    stat = path.stat()
    os.utime(path, (stat.st_atime, stat.st_mtime + seconds))


def test_corrected_emptied_and_resent_files(spark, write_raw, calendar, meta, tmp_path):
    """Stream, backfill and a fresh load agree after every change; a file of equal size is read again, an equal one is not."""
    content = {"d12_2024_01.txt": days(1, JANUARY, flow=100.0), "d07_2024_01.txt": days(2, JANUARY, district=12), "d12_2024_02.txt": days(1, FEBRUARY)}
    folder = write_raw(content)
    by_stream, by_backfill, mark = str(tmp_path / "s"), str(tmp_path / "b"), str(tmp_path / "mark")
    changes = [
        None,
        ("d12_2024_01.txt", days(1, JANUARY, flow=200.0)),                      # same size
        ("d12_2024_01.txt", days(1, JANUARY, flow=200.0)),                      # the same again
        ("d07_2024_01.txt", days(2, JANUARY, district=12, pct_obs=9)),          # no clean row left
        ("d12_2024_02.txt", []),                                                # nothing left
        ("d12_2024_02.txt", days(1, FEBRUARY) + days(2, FEBRUARY))]
    loads = []
    for step, change in enumerate(changes):
        if change:
            _touch(folder, *change, write_raw, seconds=5 * step)
        fresh = rows_of(backfill(spark, folder, str(tmp_path / f"fresh{step}"), meta, calendar))
        assert rows_of(backfill(spark, folder, by_backfill, meta, calendar)) == fresh
        assert stream(spark, folder, by_stream, mark, meta, calendar) == fresh
        known = {r.file: (r.rows, r.load) for r in known_files(spark, by_backfill).collect()}
        assert len(known) == 3
        loads.append(known)
    assert loads[1] == loads[2] and loads[0]["d12_2024_01.txt"] != loads[1]["d12_2024_01.txt"]
    assert loads[3]["d07_2024_01.txt"][0] == 0 and loads[4]["d12_2024_02.txt"][0] == 0
    assert [r[:3] for r in rows_of(tables.scan_processed(spark, by_stream))] == [(1, 2024, 1), (1, 2024, 2), (2, 2024, 2)]


def test_verify_reads_files_of_unchanged_size_and_time(spark, write_raw, calendar, meta, tmp_path):
    folder, table = write_raw({"d12_2024_01.txt": days(1, JANUARY, flow=100.0)}), str(tmp_path / "t")
    backfill(spark, folder, table, meta, calendar)
    path = pathlib.Path(folder) / "d12_2024_01.txt"
    stat = path.stat()
    path.write_text(path.read_text().replace("100.0", "300.0"))
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert rows_of(backfill(spark, folder, table, meta, calendar))[0][4] == 100.0
    assert rows_of(backfill(spark, folder, table, meta, calendar, verify=True))[0][4] == 300.0


def test_files_of_one_name_in_two_folders(spark, write_raw, calendar, meta, tmp_path):
    root = tmp_path / "raw"
    for name, station in (("north", 1), ("south +%20", 2)):
        shutil.copytree(write_raw({"d12_2024_01.txt": days(station, JANUARY)}), root / name)
    got = rows_of(backfill(spark, f"{root}/*", str(tmp_path / "t"), meta, calendar))
    assert [r[0] for r in got] == [1, 2]
    assert sorted(r.file for r in known_files(spark, str(tmp_path / "t")).collect()) == ["north/d12_2024_01.txt", "south +%20/d12_2024_01.txt"]
    assert pathlib.Path(raw.root_of(spark, f"{root}/*")) == root


def test_lists_of_files_are_put_together(spark, write_raw, calendar, meta, tmp_path, monkeypatch):
    monkeypatch.setattr(months, "LISTS", 2)
    table = str(tmp_path / "t")
    for m in range(1, 6):
        backfill(spark, write_raw({f"d12_2024_{m:02d}.txt": days(1, [f"{m:02d}/{d:02d}/2024 08:00:00" for d in range(5, 20)])}), table, meta, calendar)
    assert len(versions.latest(spark, table).ledgers) <= 2
    assert known_files(spark, table).count() == 5 and len(rows_of(tables.scan_processed(spark, table))) == 5


def test_a_late_file_needs_no_other_file_and_no_other_month(spark, write_raw, calendar, meta, tmp_path):
    table = str(tmp_path / "t")
    first = {"d12_2024_01.txt": days(1, JANUARY) + days(2, JANUARY[:3]), "d12_2024_02.txt": days(1, FEBRUARY)}
    folder = write_raw(first)
    backfill(spark, folder, table, meta, calendar)
    shutil.rmtree(folder)  # a folder of this test
    late = {"d07_2024_01.txt": days(2, JANUARY[3:], flow=30.0) + days(2, JANUARY[3:4], flow=None)}
    merged = rows_of(backfill(spark, write_raw(late), table, meta, calendar))
    assert merged == rows_of(backfill(spark, write_raw({**first, **late}), str(tmp_path / "fresh"), meta, calendar))
    found = months.states_of(spark, table, known_files(spark, table), [(2024, 1)])
    read = [f for f in found.inputFiles() if "/_files/" not in f]
    assert len(read) >= 2 and all("/_states/" in f and "month_num=1/" in f for f in read)
    assert "date" not in found.columns and found.count() == 3  # a state for each group and file, not a row for each day


def test_the_hook_gets_every_file_in_the_end(spark, write_raw, calendar, meta, tmp_path):
    table, mark = str(tmp_path / "t"), str(tmp_path / "mark")
    folder = write_raw({"d12_2024_02.txt": days(1, FEBRUARY), "d12_2024_01.txt": days(1, JANUARY), "d07_2024_01.txt": []})
    tries, taken = {}, []

    def hook(file):
        tries[file.file] = tries.get(file.file, 0) + 1
        if file.file == "d12_2024_01.txt" and tries[file.file] < 3:
            raise OSError("not now")
        taken.append((file.file, file.rows, file.bytes > 1))

    run = lambda: ingest.upsert_stream(spark, folder, table, mark, meta, calendar, after_file=hook)
    assert run() == 1 and taken == [("d07_2024_01.txt", 0, False), ("d12_2024_02.txt", 5, True)]
    assert run() == 1 and len(taken) == 2
    assert deliver(spark, table, hook) == (1, 0) and taken[2:] == [("d12_2024_01.txt", 7, True)]
    assert run() == 0 and deliver(spark, table, hook) == (0, 0) and len(taken) == 3
    _touch(folder, "d12_2024_02.txt", days(1, FEBRUARY, flow=1.0), write_raw)
    assert run() == 0 and taken[3:] == [("d12_2024_02.txt", 5, True)]  # a new version


@pytest.mark.parametrize("ok, expected", [(True, True), (False, False), (None, False), ("unreported", False)])
def test_a_failed_upload_keeps_the_file(spark, ok, expected):
    held = spark.createDataFrame([("raw", "f", "2025", "July"), ("raw", "old", "2020", "May")], "kind STRING, file_name STRING, year STRING, month STRING")
    outcomes = spark.createDataFrame([] if ok == "unreported" else [("raw-rolling/2025-07/f", ok), ("raw-rolling/2025-07/f", False), (None, True)], "key STRING, ok BOOLEAN")
    got = {r.file_name: (r.action, r.delete_local, r.lost) for r in files.retention(held, "2025-10-15", outcomes=outcomes).collect()}
    assert got == {"f": ("upload", expected, False), "old": ("skip", True, True)}


def test_one_pass_gives_rows_and_rejected_lines(spark, write_raw):
    folder = write_raw({
        "a_2024_01.txt.gz": [{}, write_raw.line({}) + ",1", {"flow": "abc"}, {"time_stamp_string": "bad"}, {"station": 1201.0, "pct_obs": 87.5}, {"station": 1.5},
                             {"speed": "NaN", "length": None, "type": None}, {"time_stamp_string": FEBRUARY[0]}, ",".join(write_raw.line({}).split(",")[:20]), ""],
        "none.txt": [{"district": "NaN", "flow": " 7 "}]})
    rows, rejected = raw.scan_checked(spark, folder)
    columns = sorted(rows.columns)
    plain = raw.scan_raw(spark, folder, origin=True)
    assert sorted(plain.columns) == columns and {f.name: f.dataType for f in plain.schema} == {f.name: f.dataType for f in rows.schema}
    text = lambda df: sorted(str([r[c] for c in columns]) for r in df.collect())
    assert text(rows) == text(plain)
    assert sorted(map(str, rejected.collect())) == sorted(map(str, raw.quarantine(spark, folder).collect())) and rejected.count() == 6
    for df in (rows, rejected):  # the text was read for the written lines alone
        plan = df._jdf.queryExecution().toString()
        assert "parquet" in plan and "Format: Text" not in plan and "Format: CSV" not in plan
