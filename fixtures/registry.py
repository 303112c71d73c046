
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.adapters import AS_OF, BASE_URL, Inputs
from fixtures.landing import land_raw, land_yearly
from fixtures.sql import with_inputs
from stationhour.functions import periods, scalar
from stationhour.operators import cleaning, enrichment, exploration, files, metrics, options, partials, selection
from stationhour.operators.summary import station_hour_summary
from stationhour.plans.manifest import list_new_files, pending_files, record_fetched
from stationhour.plans.monthly import monthly_round
from stationhour.plans.months import backfill, month_pipeline
from stationhour.schemas import RouteChoice, Selection
from stationhour.session import shared_path
from stationhour.sources import documents, raw, tables, versions
from stationhour.streaming import ingest, windows

MAKERS: dict[str, Callable[[Inputs], DataFrame]] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SD = ["sd_flow", "sd_speed", "sd_occup"]
SELECTION = Selection(
    years=tuple(range(2019, 2026)), hours=(7, 11),
    routes=(RouteChoice(39), RouteChoice(22, direction="both", segment=(1.0, 5.0)),
            RouteChoice(56, stations=(3, 8)), RouteChoice(73)))
PERIODS_ONLY = Selection(years=(2020, 2021, 2024), months=(1, 3, 5, 7, 8, 10, 12))
ALL_YEARS = list(range(2019, 2026))


def query(name: str, sql: str | None = None):
    def register(make: Callable[[Inputs], DataFrame]):
        MAKERS[name] = make
        QUERIES[name] = lambda spark, sf_dir: make(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_inputs(sql)
        return make
    return register


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _rounded_sql(source: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'round({c}, 4) AS {c}' for c in SD)}) FROM {source}"


# ---------------------------------------------------------------- scans, sinks, files

_RAW_SQL = """SELECT strftime(date, '%m/%d/%Y') || ' ' || lpad(CAST(hour AS VARCHAR), 2, '0') || ':00:00' AS time_stamp_string,
  station, district, route, direction, type, length, pct_obs, flow, occupancy, speed, {lanes}, CAST(NULL AS DOUBLE) AS flow_8
  FROM raw_l""".format(lanes=", ".join(f"CASE WHEN gap > {i} THEN 1.0::DOUBLE END AS flow_{i}" for i in range(1, 8)))


@query("scan_raw", _RAW_SQL)
def _(i: Inputs) -> DataFrame:
    return raw.scan_raw(i.spark, i.landed_l).select(
        "time_stamp_string", "station", "district", "route", "direction", "type", "length", "pct_obs",
        "flow", "occupancy", "speed", *[f"flow_{n}" for n in range(1, 9)])


_DISCOVERED = """(SELECT 'd' || lpad(CAST(district AS VARCHAR), 2, '0') || '_text_station_hour_' || strftime(date, '%Y_%m') || '.txt.gz' AS file_name,
  CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month_num, strftime(date, '%B') AS month FROM raw_l GROUP BY ALL)"""


@query("file_discovery", f"SELECT * FROM {_DISCOVERED}")
def _(i: Inputs) -> DataFrame:
    return raw.discover_files(i.spark, i.landed_l).select("file_name", "year", "month_num", "month")


@query("latest_file", f"SELECT year, month_num, max(file_name) AS file_name FROM {_DISCOVERED} GROUP BY ALL")
def _(i: Inputs) -> DataFrame:
    return raw.latest_files(raw.discover_files(i.spark, i.landed_l)).drop("file_path")


@query("filename_period", "SELECT file_name, CAST(year AS INT) AS year, month_num, month FROM files")
def _(i: Inputs) -> DataFrame:
    return periods.with_name_period(i.manifest.select("file_name"))


@query("scan_meta", "SELECT * FROM meta")
def _(i: Inputs) -> DataFrame:
    path = shared_path(i.spark, "meta")
    i.meta.withColumn("name", F.lit("unused")).write.option("header", True).csv(path)
    return tables.scan_meta(i.spark, path)


def _processed(i: Inputs) -> str:
    path = shared_path(i.spark, "processed")
    tables.write_months(i.enriched, path)
    return path


@query("scan_year", _rounded_sql("enriched WHERE year = 2024"))
def _(i: Inputs) -> DataFrame:
    return rounded(tables.scan_processed(i.spark, _processed(i)).where("year = 2024"), *SD)


@query("scan_all_years", f"SELECT * EXCLUDE (latitude, longitude), CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude FROM ({_rounded_sql('enriched')})")
def _(i: Inputs) -> DataFrame:
    folder = land_yearly(i.enriched.drop("latitude", "longitude"))
    return rounded(tables.scan_yearly_files(i.spark, folder), *SD)


_ORDER = "year, month_num, station, hour, district, route, direction, type, lanes, length"


@query("head_tail", f"""SELECT {_ORDER}, median_flow, 'head' AS part FROM (SELECT * FROM summ WHERE year = 2022 ORDER BY {_ORDER} LIMIT 5)
  UNION ALL SELECT {_ORDER}, median_flow, 'tail' AS part FROM (SELECT * FROM summ WHERE year = 2022
  ORDER BY {', '.join(c + ' DESC' for c in _ORDER.split(', '))} LIMIT 5)""")
def _(i: Inputs) -> DataFrame:
    return exploration.head_tail(i.summary.where("year = 2022").select(*_ORDER.split(", "), "median_flow"))


@query("union_years", "SELECT station, hour, year, month_num, lanes, median_flow, CASE WHEN year >= 2023 THEN abs_pm END AS abs_pm FROM enriched")
def _(i: Inputs) -> DataFrame:
    columns = ["station", "hour", "year", "month_num", "lanes", "median_flow"]
    return tables.union_by_name(i.enriched.where("year < 2023").select(*columns),
                                i.enriched.where("year >= 2023").select(*columns, "abs_pm"))


@query("upsert_year", _rounded_sql("enriched"))
def _(i: Inputs) -> DataFrame:
    path = _processed(i)
    # a second load of one year replaces its months
    tables.write_months(i.enriched.where("year = 2021"), path)
    return rounded(tables.scan_processed(i.spark, path), *SD)


@query("export_csv", "SELECT station, hour, year, month_num, avg_flow, county, abs_pm FROM enriched")
def _(i: Inputs) -> DataFrame:
    path = shared_path(i.spark, "export")
    columns = ["station", "hour", "year", "month_num", "avg_flow", "county", "abs_pm"]
    picked = i.enriched.select(*columns)
    tables.export_csv(picked, path)
    return i.spark.read.schema(picked.schema).option("header", True).csv(path)


_MANIFEST = "SELECT file_type, district, year, month, file_name, file_id, megabites, download_url FROM files"
_LEDGER = "SELECT file_type, district, year, month, file_name, file_id, 0.0::DOUBLE AS megabites, download_url FROM files WHERE CAST(year AS INT) <= 2022"


def _ledger_path(i: Inputs) -> str:
    path = shared_path(i.spark, "ledger")
    tables.append_ledger(i.ledger, path)
    return path


@query("ledger_scan", "SELECT file_type, district, year, month, file_name, file_id, 0.0::DOUBLE AS megabites, download_url FROM files")
def _(i: Inputs) -> DataFrame:
    path = shared_path(i.spark, "ledger")
    tables.append_ledger(i.whole_ledger, path)
    return tables.scan_ledger(i.spark, path)


@query("ledger_append", f"{_LEDGER} UNION ALL {_MANIFEST} WHERE CAST(year AS INT) > 2022")
def _(i: Inputs) -> DataFrame:
    path = _ledger_path(i)
    fresh = files.new_files(documents.flatten_listing(i.responses), tables.scan_ledger(i.spark, path))
    tables.append_ledger(fresh, path)
    return tables.scan_ledger(i.spark, path)


@query("manifest_flatten", f"{_MANIFEST} WHERE month IN ('January', 'June', 'July', 'December')")
def _(i: Inputs) -> DataFrame:
    return documents.flatten_listing(i.responses, ["January", "June", "July", "December"])


@query("manifest_totals", "SELECT count(*) AS files, round_even(sum(megabites) * 10, 0) / 10 AS megabites FROM files")
def _(i: Inputs) -> DataFrame:
    return files.manifest_totals(documents.flatten_listing(i.responses))


@query("new_files", f"{_MANIFEST} WHERE CAST(year AS INT) > 2022")
def _(i: Inputs) -> DataFrame:
    return files.new_files(documents.flatten_listing(i.responses), i.ledger)


def _requests(i: Inputs) -> DataFrame:
    scope = i.manifest.agg(
        F.array_sort(F.collect_set("file_type")).alias("file_types"), F.collect_set("district").alias("districts"),
        F.min(F.col("year").cast("int")).alias("start_year"), F.max(F.col("year").cast("int")).alias("end_year"))
    return files.request_grid(scope, BASE_URL)


@query("request_grid", f"""SELECT file_type, district, CAST(y AS VARCHAR) AS year,
  '{BASE_URL}/?srq=clearinghouse&district_id=' || district || '&yy=' || y || '&type=' || file_type || '&returnformat=text' AS url
  FROM (SELECT DISTINCT file_type FROM files) CROSS JOIN (SELECT DISTINCT district FROM files)
  CROSS JOIN (SELECT unnest(range(min(CAST(year AS BIGINT)), max(CAST(year AS BIGINT)) + 1)) AS y FROM files)""")
def _(i: Inputs) -> DataFrame:
    return _requests(i)


@query("manifest_pipeline", f"{_MANIFEST} WHERE CAST(year AS INT) > 2022")
def _(i: Inputs) -> DataFrame:
    path = _ledger_path(i)
    found = list_new_files(i.responses, _requests(i), path)
    record_fetched(i.spark, found, path)
    again = pending_files(i.responses, _requests(i), tables.scan_ledger(i.spark, path))
    # nothing is pending once it has been recorded
    return found.unionByName(again)


@query("manifest_confirmed", f"""{_MANIFEST.replace('SELECT', 'SELECT 1 AS round,')} WHERE CAST(year AS INT) > 2022
  UNION ALL {_MANIFEST.replace('SELECT', 'SELECT 2 AS round,')} WHERE CAST(year AS INT) > 2022 AND file_type = 'station_day'""")
def _(i: Inputs) -> DataFrame:
    path = _ledger_path(i)
    first = list_new_files(i.responses, _requests(i), path)
    # daily files fail to come, the others are reported twice
    fetched = first.withColumn("ok", F.col("file_type") != "station_day")
    record_fetched(i.spark, fetched.unionByName(fetched), path)
    second = list_new_files(i.responses, _requests(i), path)
    return first.withColumn("round", F.lit(1)).unionByName(second.withColumn("round", F.lit(2)))


@query("monthly_round", f"{_MANIFEST} WHERE year = '2025' AND month = 'May'")
def _(i: Inputs) -> DataFrame:
    scopes = i.manifest.agg(F.collect_set("file_type").alias("file_types"), F.collect_set("district").alias("districts"))
    held = i.manifest.select(F.lit("raw").alias("kind"), "file_name", "year", "month")
    return monthly_round(i.responses, scopes, BASE_URL, _ledger_path(i), held, AS_OF)[0]


@query("monthly_round_retention", f"""SELECT kind, file_name, year, month, file_date, months_ago, action, key,
    months_ago > 1 AND (action = 'skip' OR uploaded) AS delete_local, action = 'skip' AS lost
  FROM (SELECT *, CASE WHEN action = 'upload' THEN 'raw-rolling/' || strftime(file_date, '%Y-%m') || '/' || file_name END AS key
        FROM (SELECT *, CASE WHEN months_ago <= 12 THEN 'upload' ELSE 'skip' END AS action
              FROM (SELECT 'raw' AS kind, file_name, year, month, make_date(CAST(year AS INT), month_num, 1) AS file_date, district <> '7' AS uploaded,
                      CAST(floor(date_diff('day', make_date(CAST(year AS INT), month_num, 1), DATE '{AS_OF}') / 30.0) AS INT) AS months_ago FROM files)))""")
def _(i: Inputs) -> DataFrame:
    # the files of May 2025 are still to be fetched; uploads from district 7 fail
    scopes = i.manifest.agg(F.collect_set("file_type").alias("file_types"), F.collect_set("district").alias("districts"))
    every = i.manifest.select(F.lit("raw").alias("kind"), "file_name", "year", "month", "district")
    held = every.where("NOT (year = '2025' AND month = 'May')")
    tried = files.retention(every, AS_OF).where("key IS NOT NULL").select("key", (F.col("district") != "7").alias("ok"))
    return monthly_round(i.responses, scopes, BASE_URL, _ledger_path(i), held, AS_OF, outcomes=tried)[1]


_KINDS = "CASE file_type WHEN 'station_hour' THEN 'raw' WHEN 'station_5min' THEN 'processed' ELSE 'other' END"
_RETENTION = f"""(SELECT kind, file_name, year, month, day AS file_date, months_ago, action,
    CASE WHEN action = 'upload' AND kind = 'raw' THEN 'raw-rolling/' || strftime(day, '%Y-%m') || '/' || file_name
         WHEN action = 'upload' THEN 'processed/' || year || '/' || file_name END AS key,
    kind = 'raw' AND months_ago > 1 AS delete_local, kind = 'raw' AND action = 'skip' AS lost
  FROM (SELECT *, CASE WHEN kind = 'processed' OR (kind = 'raw' AND months_ago <= 12) THEN 'upload'
                       WHEN kind = 'raw' THEN 'skip' ELSE 'unknown' END AS action
        FROM (SELECT {_KINDS} AS kind, file_name, year, month, make_date(CAST(year AS INT), month_num, 1) AS day,
                     CAST(floor(date_diff('day', make_date(CAST(year AS INT), month_num, 1), DATE '{AS_OF}') / 30.0) AS INT) AS months_ago
              FROM files)))"""


def _retention(i: Inputs) -> DataFrame:
    kind = (F.when(F.col("file_type") == "station_hour", "raw")
            .when(F.col("file_type") == "station_5min", "processed").otherwise("other"))
    return files.retention(i.manifest.select(kind.alias("kind"), "file_name", "year", "month"), AS_OF)


@query("retention", f"SELECT * FROM {_RETENTION}")
def _(i: Inputs) -> DataFrame:
    return _retention(i)


@query("object_keys", f"SELECT kind, file_name, key FROM {_RETENTION} WHERE key IS NOT NULL")
def _(i: Inputs) -> DataFrame:
    return _retention(i).where("key IS NOT NULL").select("kind", "file_name", "key")


@query("prefix_list", f"SELECT key FROM {_RETENTION} WHERE starts_with(key, 'raw-rolling/2025')")
def _(i: Inputs) -> DataFrame:
    return files.with_prefix(_retention(i), "raw-rolling/2025").select("key")


@query("file_period_date", """SELECT file_name, CASE WHEN file_type <> 'station_day' THEN make_date(CAST(year AS INT), month_num, 1) END AS file_date FROM files""")
def _(i: Inputs) -> DataFrame:
    # upper-case month names are not periods
    month = F.when(F.col("file_type") == "station_day", F.upper("month")).otherwise(F.col("month"))
    return i.manifest.select("file_name", periods.period_date(F.col("year"), month).alias("file_date"))


@query("previous_month", """SELECT CAST(o_orderdate AS DATE) AS day,
  CAST(year(date_trunc('month', o_orderdate) - INTERVAL 1 DAY) AS INT) AS previous_year,
  strftime(date_trunc('month', o_orderdate) - INTERVAL 1 DAY, '%B') AS previous_month, count(*) AS orders FROM orders GROUP BY ALL""")
def _(i: Inputs) -> DataFrame:
    days = i.table("orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    year, month = periods.previous_month(F.col("day"))
    return days.select("day", year.alias("previous_year"), month.alias("previous_month"), "orders")


# ---------------------------------------------------------------- catalogues in pages

def _pages(i: Inputs) -> DataFrame:
    """Pages with a script that assigns a form catalogue derived from the page number."""
    number = F.col("page_id")
    literal = F.format_string(
        '\n<script type="text/javascript">\n  YAHOO.bts.Data = {labels: {p%d: "page", site: "freeway"},\n'
        '   form_data: {reid_raw: {all: "all"}, ft_%d: {%d: "first", %d: "second"}}}\n</script>\n',
        number, number % 5, 1 + number % 12, 13 + number % 7)
    return i.table("pages").select("page_id", F.concat("html", literal).alias("html"))


@query("page_embedded_json", """SELECT page_id, 'freeway' AS site, 'p' || page_id || ',site' AS label_keys, 'all' AS reid_all,
  'first' AS first_value, (1 + page_id % 12) || ',' || (13 + page_id % 7) AS district_keys FROM pages""")
def _(i: Inputs) -> DataFrame:
    found = documents.page_catalogues(_pages(i))
    own = F.col("form_data")[F.concat(F.lit("ft_"), (F.col("page_id") % 5).cast("string"))]
    return found.select(
        "page_id", F.col("labels")["site"].alias("site"), F.array_join(F.map_keys("labels"), ",").alias("label_keys"),
        F.col("form_data")["reid_raw"]["all"].alias("reid_all"), F.get(F.map_values(own), F.lit(0)).alias("first_value"),
        F.array_join(F.map_keys(own), ",").alias("district_keys"))


@query("page_leaves", """SELECT page_id, unnest(['labels,p' || page_id, 'labels,site', 'form_data,reid_raw,all',
    'form_data,ft_' || (page_id % 5) || ',' || (1 + page_id % 12) || ',name', 'form_data,ft_' || (page_id % 5) || ',' || (1 + page_id % 12) || ',open']) AS path,
  unnest(['page', 'freeway', 'all', 'first', CASE WHEN page_id % 2 = 0 THEN 'true' ELSE 'false' END]) AS value FROM pages WHERE page_id % 7 <> 0""")
def _(i: Inputs) -> DataFrame:
    """Catalogues with a level more than the fixed layout has; every seventh is not JSON."""
    number = F.col("page_id")
    literal = F.format_string(
        '\n<script type="text/javascript">\n  YAHOO.bts.Data = {labels: {p%d: "page", site: "freeway"},\n'
        '   form_data: {reid_raw: {all: "all"}, ft_%d: {%d: {name: "first", open: %s%s}}}}\n</script>\n',
        number, number % 5, 1 + number % 12, F.when(number % 2 == 0, "true").otherwise("false"), F.when(number % 7 == 0, ' "').otherwise(""))
    pages = i.table("pages").select("page_id", F.concat("html", literal).alias("html"))
    leaves = documents.variant_leaves(documents.page_variants(pages).drop("html"))
    return leaves.select("page_id", F.array_join("path", ",").alias("path"), "value")


@query("file_type_options", "SELECT DISTINCT 'ft_' || (page_id % 5) AS file_type FROM pages UNION SELECT 'reid_raw' FROM pages")
def _(i: Inputs) -> DataFrame:
    return documents.file_types(documents.page_catalogues(_pages(i)))


@query("district_options", """SELECT DISTINCT 'ft_' || (page_id % 5) AS file_type, CAST(unnest([1 + page_id % 12, 13 + page_id % 7]) AS VARCHAR) AS district FROM pages
  UNION SELECT 'reid_raw', CAST(unnest(range(1, 13)) AS VARCHAR) FROM pages""")
def _(i: Inputs) -> DataFrame:
    return documents.districts(documents.page_catalogues(_pages(i)))


# ---------------------------------------------------------------- scalars and cleaning

@query("parse_ts", """SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS date,
  CASE WHEN event_type <> 'error' THEN CAST(hour(ts) AS INT) END AS hour,
  CASE WHEN event_type <> 'error' THEN CAST(minute(ts) AS INT) END AS minute FROM events""")
def _(i: Inputs) -> DataFrame:
    ts = F.col("ts")
    text = (F.when(F.col("event_type") == "view", F.date_format(ts, "M/d/yyyy H:m:s"))
            .when(F.col("event_type") == "error", F.date_format(ts, "dd.MM.yyyy HH:mm:ss"))
            .otherwise(F.date_format(ts, "MM/dd/yyyy HH:mm:ss")))
    parsed = i.table("events").select("event_id", scalar.local_timestamp(text).alias("local_ts"))
    return parsed.select("event_id", F.to_date("local_ts").alias("date"), F.hour("local_ts").alias("hour"),
                         F.minute("local_ts").alias("minute"))


@query("date_parts", """SELECT date, CAST(year(date) AS INT) AS year, strftime(date, '%B') AS month, CAST(month(date) AS INT) AS month_num,
  hour, strftime(date, '%A') AS day_of_week, count(*) AS n FROM raw_l GROUP BY ALL""")
def _(i: Inputs) -> DataFrame:
    parts = cleaning.add_date_parts(i.raw_l)
    return parts.groupBy("date", "year", "month", "month_num", "hour", "day_of_week").agg(F.count(F.lit(1)).alias("n"))


@query("lane_count", "SELECT station, gap AS lanes, CAST(gap - 1 AS INT) AS populated, count(*) AS n FROM raw_l GROUP BY ALL")
def _(i: Inputs) -> DataFrame:
    return i.raw_l.groupBy("station", scalar.lane_count().alias("lanes"), scalar.lane_count("populated").alias("populated")).agg(
        F.count(F.lit(1)).alias("n"))


@query("flow_per_lane", "SELECT station, hour, year, month_num, CASE WHEN station <> 6 AND lanes > 2 THEN round(avg_flow / lanes, 6) END AS per_lane FROM summ")
def _(i: Inputs) -> DataFrame:
    # no lane count on station 6, and none that is positive below three lanes
    rows = i.summary.withColumn("lanes", F.when(F.col("station") != 6, F.when(F.col("lanes") > 2, F.col("lanes")).otherwise(0)))
    return rows.select("station", "hour", "year", "month_num", F.round(scalar.flow_per_lane(rows.columns), 6).alias("per_lane"))


@query("coerce_numeric", """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS number,
  CASE WHEN event_type <> 'view' THEN CAST(user_id AS INT) END AS whole FROM events""")
def _(i: Inputs) -> DataFrame:
    kind, value, user = F.col("event_type"), F.col("value").cast("string"), F.col("user_id").cast("string")
    return i.table("events").select(
        "event_id",
        scalar.to_number(F.when(kind == "error", F.concat(F.lit("err "), value)).otherwise(value)).alias("number"),
        scalar.to_number(F.when(kind == "view", F.lit("n/a")).otherwise(user), "int").alias("whole"))


_ROW = ["station", "district", "route", "direction", "type", "length", "pct_obs", "flow", "speed", "occupancy"]


@query("filter_quality", f"SELECT {', '.join(_ROW)} FROM raw_l WHERE pct_obs >= 80")
def _(i: Inputs) -> DataFrame:
    return cleaning.keep_observed(i.raw_l).select(*_ROW)


@query("filter_midweek", f"SELECT {', '.join(_ROW)}, date, hour FROM raw_l WHERE dayofweek(date) IN (2, 3, 4)")
def _(i: Inputs) -> DataFrame:
    return cleaning.keep_midweek(cleaning.add_date_parts(i.raw_l)).select(*_ROW, "date", "hour")


@query("filter_holidays", f"SELECT {', '.join(_ROW)}, date, hour FROM raw_l WHERE dayofweek(date) IN (2, 3, 4) AND date NOT IN (SELECT date FROM cal)")
def _(i: Inputs) -> DataFrame:
    dated = cleaning.keep_midweek(cleaning.add_date_parts(i.raw_l))
    return cleaning.drop_holidays(dated, i.calendar).select(*_ROW, "date", "hour")


_CLEAN = ("date, year, month, month_num, day_of_week, station, district, route, direction, type, hour, pct_obs, "
          "length, flow, speed, lanes, occupancy")


@query("clean", f"SELECT {_CLEAN} FROM clean")
def _(i: Inputs) -> DataFrame:
    return i.clean


# ---------------------------------------------------------------- summary, metadata, months

@query("station_hour_summary", _rounded_sql("summ"))
def _(i: Inputs) -> DataFrame:
    return rounded(i.summary, *SD)


@query("enrich_meta", _rounded_sql("enriched"))
def _(i: Inputs) -> DataFrame:
    return rounded(i.enriched, *SD)


@query("meta_gate", """SELECT s.station, s.hour, s.year, s.month_num, s.lanes, s.median_flow, s.days_observed FROM summ s
  WHERE NOT EXISTS (SELECT 1 FROM summ b WHERE b.year = s.year AND b.month_num = s.month_num AND b.district = s.district
                    AND b.station NOT IN (SELECT station FROM meta_gap))""")
def _(i: Inputs) -> DataFrame:
    return enrichment.drop_uncovered_months(i.summary, i.meta_gap).select(
        "station", "hour", "year", "month_num", "lanes", "median_flow", "days_observed")


@query("missing_stations", """SELECT station, hour, year, month_num, lanes, median_flow FROM summ
  WHERE station NOT IN (SELECT station FROM meta_gap)""")
def _(i: Inputs) -> DataFrame:
    return enrichment.missing_stations(i.summary, i.meta_gap).select(
        "station", "hour", "year", "month_num", "lanes", "median_flow")


@query("month_pipeline", _rounded_sql("enriched_e"))
def _(i: Inputs) -> DataFrame:
    return rounded(month_pipeline(i.raw_e, i.meta, i.calendar), *SD)


@query("backfill", _rounded_sql("enriched"))
def _(i: Inputs) -> DataFrame:
    table = shared_path(i.spark, "backfill")
    folder = i.landed_l
    backfill(i.spark, folder, table, i.meta, i.calendar)
    # a second run finds only months that yield no rows
    return rounded(backfill(i.spark, folder, table, i.meta, i.calendar), *SD)


@query("changed_files", _rounded_sql("enriched WHERE year <> 2020"))
def _(i: Inputs) -> DataFrame:
    """A stream loads files with wrong flows, a backfill the same files corrected, those of 2020 without usable rows; each holds rows of another month."""
    table, mark = (shared_path(i.spark, n) for n in ("changed-table", "changed-mark"))
    stamp = F.to_date(F.substring("time_stamp_string", 1, 10), "MM/dd/yyyy")
    filed_as = F.when(F.col("samples") > 0, F.date_format(F.add_months(stamp, F.col("samples")), "yyyy_MM"))
    # those without a first lane are also filed a month too late
    every = i.raw_l.withColumn("samples", F.explode(F.when(F.col("flow_1").isNull(), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    wrong = every.withColumn("flow", F.col("flow") + 1)
    right = every.withColumn("pct_obs", F.when(F.substring("time_stamp_string", 7, 4) == "2020", 10.0).otherwise(F.col("pct_obs")))
    ingest.upsert_stream(i.spark, land_raw(wrong, filed_as), table, mark, i.meta, i.calendar)
    return rounded(backfill(i.spark, land_raw(right, filed_as), table, i.meta, i.calendar), *SD)


@query("merged_states", _rounded_sql("summ"))
def _(i: Inputs) -> DataFrame:
    """Summaries of thirteen parts of the rows, merged."""
    parts = i.clean.withColumn("file", F.pmod(F.xxhash64(*i.clean.columns), F.lit(13)).cast("string"))
    return rounded(partials.summary_of_states(partials.file_states(parts), i.params), *SD)


@query("published_periods", "SELECT DISTINCT year, month_num FROM enriched WHERE year <> 2021")
def _(i: Inputs) -> DataFrame:
    path = _processed(i)
    tables.remove_months(i.spark, path, [(2021, m) for m in range(1, 13)])
    return versions.periods(i.spark, path)


@query("year_status", """SELECT y.year, array_to_string(list_sort(list(m.month) FILTER (WHERE p.month_num IS NOT NULL)), ',') AS processed,
  coalesce(array_to_string(list(m.month ORDER BY m.month_num) FILTER (WHERE p.month_num IS NULL), ','), '') AS missing
  FROM (SELECT DISTINCT year FROM summ) y CROSS JOIN mon m
  LEFT JOIN (SELECT DISTINCT year, month_num FROM summ) p ON p.year = y.year AND p.month_num = m.month_num GROUP BY y.year""")
def _(i: Inputs) -> DataFrame:
    return files.year_status(i.summary).select("year", F.array_join("processed_months", ",").alias("processed"),
                                               F.array_join("missing_months", ",").alias("missing"))


@query("pending_months", """SELECT DISTINCT CAST(year AS INT) AS year, month_num, month FROM files f
  WHERE NOT EXISTS (SELECT 1 FROM summ_e s WHERE s.year = CAST(f.year AS INT) AND s.month_num = f.month_num)""")
def _(i: Inputs) -> DataFrame:
    available = periods.with_name_period(i.manifest.select("file_name"))
    return files.pending_months(available, month_pipeline(i.raw_e, i.meta, i.calendar))


# ---------------------------------------------------------------- selections and options

_PICK = "station, hour, year, month_num, lanes, route, type, direction, avg_flow"
_PICK_COLUMNS = _PICK.split(", ")
_BASE = "year BETWEEN 2019 AND 2025 AND hour BETWEEN 7 AND 11"
_CHOSEN = f"""(SELECT * FROM enriched WHERE {_BASE} AND (
  (route = 39 AND type = 'ML' AND direction = 'N' AND abs_pm IS NOT NULL)
  OR (route = 22 AND type = 'ML' AND abs_pm BETWEEN 1 AND 5)
  OR (route = 56 AND type = 'ML' AND direction = 'E' AND station IN (3, 8)) OR (route = 73 AND type = 'ML' AND direction = 'N')))"""


def _chosen(i: Inputs) -> DataFrame:
    return selection.filter_selection(i.processed, SELECTION)


@query("filter_base", f"SELECT {_PICK} FROM enriched WHERE {_BASE}")
def _(i: Inputs) -> DataFrame:
    return selection.filter_base(i.processed, SELECTION).select(*_PICK_COLUMNS)


@query("filter_routes", f"SELECT {_PICK} FROM enriched WHERE route IN (39, 22, 56, 73)")
def _(i: Inputs) -> DataFrame:
    return selection.filter_routes(i.processed, SELECTION).select(*_PICK_COLUMNS)


@query("filter_lane_type", f"SELECT {_PICK} FROM enriched WHERE {_BASE} AND type = 'ML' AND route IN (39, 22, 56, 73)")
def _(i: Inputs) -> DataFrame:
    return selection.filter_lane_type(i.processed, SELECTION).select(*_PICK_COLUMNS)


@query("filter_direction", f"""SELECT {_PICK} FROM enriched WHERE {_BASE} AND type = 'ML'
  AND ((route = 39 AND direction = 'N') OR route = 22 OR (route = 56 AND direction = 'E') OR (route = 73 AND direction = 'N'))""")
def _(i: Inputs) -> DataFrame:
    return selection.filter_route_choices(i.processed, SELECTION).select(*_PICK_COLUMNS)


@query("filter_segment", f"SELECT {_PICK}, abs_pm FROM enriched WHERE abs_pm BETWEEN 2 AND 12")
def _(i: Inputs) -> DataFrame:
    return selection.filter_segment(i.processed, 2.0, 12.0).select(*_PICK_COLUMNS, "abs_pm")


@query("filter_stations", f"SELECT {_PICK} FROM enriched WHERE station IN (1, 2, 8)")
def _(i: Inputs) -> DataFrame:
    return selection.filter_stations(i.processed, (1, 2, 8)).select(*_PICK_COLUMNS)


@query("filter_selection", f"SELECT {_PICK} FROM {_CHOSEN}")
def _(i: Inputs) -> DataFrame:
    return _chosen(i).select(*_PICK_COLUMNS)


@query("option_years", "SELECT DISTINCT year FROM enriched")
def _(i: Inputs) -> DataFrame:
    return options.years(i.processed)


@query("option_months", "SELECT DISTINCT month_num, month FROM enriched")
def _(i: Inputs) -> DataFrame:
    return options.months(i.processed)


@query("option_hours", "SELECT coalesce(min(hour), 0) AS min_hour, coalesce(max(hour), 23) AS max_hour FROM enriched")
def _(i: Inputs) -> DataFrame:
    return options.hours(i.processed)


@query("option_routes", "SELECT DISTINCT route FROM enriched")
def _(i: Inputs) -> DataFrame:
    return options.routes(i.processed)


@query("lane_type_options", """SELECT route, CAST(row_number() OVER w - 1 AS INT) AS position, lane_type, row_number() OVER w = 1 AS is_default
  FROM (SELECT DISTINCT route, upper(type) AS lane_type FROM enriched)
  WINDOW w AS (PARTITION BY route ORDER BY CASE lane_type WHEN 'ML' THEN 0 WHEN 'HV' THEN 1 ELSE 2 END, lane_type)""")
def _(i: Inputs) -> DataFrame:
    return options.lane_types(i.processed)


@query("direction_options", """SELECT route, string_agg(l, ',' ORDER BY l) AS letters,
  CASE WHEN bool_or(l IN ('N', 'S')) THEN 'NS' WHEN bool_or(l IN ('E', 'W')) THEN 'EW' END AS axis,
  CASE WHEN bool_or(l IN ('N', 'S')) THEN 'N' WHEN bool_or(l IN ('E', 'W')) THEN 'E' END AS default_direction
  FROM (SELECT DISTINCT route, upper(substr(direction, 1, 1)) AS l FROM enriched) GROUP BY route""")
def _(i: Inputs) -> DataFrame:
    return options.directions(i.processed)


@query("station_options", "SELECT DISTINCT station, abs_pm FROM enriched WHERE abs_pm IS NOT NULL")
def _(i: Inputs) -> DataFrame:
    return options.stations(i.processed)


@query("abs_pm_bounds", """SELECT route, direction AS letter, min(abs_pm) AS min_pm, max(abs_pm) AS max_pm, floor(min(abs_pm)) AS low, ceil(max(abs_pm)) AS high
  FROM enriched WHERE abs_pm IS NOT NULL GROUP BY ALL""")
def _(i: Inputs) -> DataFrame:
    return options.post_mile_bounds(i.processed)


@query("year_index", "SELECT year, CAST((dense_rank() OVER (ORDER BY year) - 1) % 10 AS INT) AS color_index FROM (SELECT DISTINCT year FROM enriched)")
def _(i: Inputs) -> DataFrame:
    return options.year_index(i.processed)


# ---------------------------------------------------------------- report metrics

@query("kpis_selection", f"""SELECT count(DISTINCT station) AS stations, count(DISTINCT route) AS routes,
  round(avg(avg_speed), 4) AS avg_speed, round(avg(avg_flow), 4) AS avg_flow FROM {_CHOSEN}""")
def _(i: Inputs) -> DataFrame:
    return rounded(metrics.kpis(_chosen(i)), "avg_speed", "avg_flow")


_PERIODS = "year IN (2020, 2021, 2024) AND month_num IN (1, 3, 5, 7, 8, 10, 12)"


@query("kpis_global", f"""SELECT count(DISTINCT station) AS stations, count(DISTINCT route) AS routes,
  round(avg(avg_speed), 4) AS avg_speed, round(avg(avg_flow), 4) AS avg_flow
  FROM (SELECT *, bool_or(upper(type) = 'ML') OVER () AS has_ml FROM enriched WHERE {_PERIODS}) WHERE NOT has_ml OR upper(type) = 'ML'""")
def _(i: Inputs) -> DataFrame:
    return rounded(metrics.kpis_global(i.processed, PERIODS_ONLY), "avg_speed", "avg_flow")


_DENSE = """FROM (SELECT DISTINCT route, year FROM v) y CROSS JOIN mon m
  LEFT JOIN v ON v.route = y.route AND v.year = y.year AND v.month_num = m.month_num"""


@query("route_month_oneway", f"""SELECT y.route, y.year, m.month_num, m.month, v.bar_value FROM (SELECT * FROM mon) m CROSS JOIN
  (SELECT DISTINCT route, year FROM enriched WHERE avg_flow IS NOT NULL) y LEFT JOIN (
  SELECT route, year, month_num, round(avg(avg_flow), 4) AS bar_value FROM enriched WHERE avg_flow IS NOT NULL GROUP BY ALL) v
  ON v.route = y.route AND v.year = y.year AND v.month_num = m.month_num""")
def _(i: Inputs) -> DataFrame:
    return rounded(metrics.route_month_one_way(i.processed), "bar_value")


@query("route_month_twoway", f"""SELECT y.route, y.year, m.month_num, m.month, round(coalesce(v.bar_value, 0), 4) AS bar_value FROM mon m CROSS JOIN
  (SELECT DISTINCT route, year FROM enriched WHERE avg_flow IS NOT NULL) y LEFT JOIN (
  SELECT route, year, month_num, sum(mean) AS bar_value FROM (
    SELECT e.route, year, month_num, direction, avg(avg_flow) AS mean FROM enriched e
    JOIN (SELECT route, bool_or(direction IN ('N', 'S')) AS ns FROM enriched GROUP BY route) r ON r.route = e.route
    WHERE avg_flow IS NOT NULL AND (CASE WHEN ns THEN direction IN ('N', 'S') ELSE direction IN ('E', 'W') END)
    GROUP BY e.route, year, month_num, direction) GROUP BY ALL) v
  ON v.route = y.route AND v.year = y.year AND v.month_num = m.month_num""")
def _(i: Inputs) -> DataFrame:
    return rounded(metrics.route_month_two_way(i.processed), "bar_value")


@query("route_month_perlane", """SELECT y.route, y.year, m.month_num, m.month, v.line_value FROM mon m CROSS JOIN
  (SELECT DISTINCT route, year FROM enriched WHERE avg_flow IS NOT NULL) y LEFT JOIN (
  SELECT route, year, month_num, round(median(avg_flow / lanes), 4) AS line_value FROM enriched WHERE avg_flow IS NOT NULL GROUP BY ALL) v
  ON v.route = y.route AND v.year = y.year AND v.month_num = m.month_num""")
def _(i: Inputs) -> DataFrame:
    return rounded(metrics.route_month_per_lane(i.processed), "line_value")


@query("route_month_perlane_gaps", """SELECT y.route, y.year, m.month_num, m.month, v.line_value FROM mon m CROSS JOIN
  (SELECT DISTINCT route, year FROM enriched WHERE avg_flow IS NOT NULL) y LEFT JOIN (
  SELECT route, year, month_num, round(median(avg_flow / lanes), 4) AS line_value FROM enriched
  WHERE avg_flow IS NOT NULL AND NOT (route = 22 AND year = 2021) GROUP BY ALL) v
  ON v.route = y.route AND v.year = y.year AND v.month_num = m.month_num""")
def _(i: Inputs) -> DataFrame:
    # no lane counts on route 22 in 2021; its months stay
    rows = i.processed.withColumn("lanes", F.when(~((F.col("route") == 22) & (F.col("year") == 2021)), F.col("lanes")))
    return rounded(metrics.route_month_per_lane(rows), "line_value")


@query("route_month_median_flow", """SELECT y.route, y.year, m.month_num, m.month, y.route <> 22 AS per_lane, v.line_value FROM mon m CROSS JOIN
  (SELECT DISTINCT route, year FROM enriched WHERE avg_flow IS NOT NULL) y LEFT JOIN (
  SELECT route, year, month_num, round(median(CASE WHEN route = 22 THEN avg_flow ELSE avg_flow / lanes END), 4) AS line_value
  FROM enriched WHERE avg_flow IS NOT NULL GROUP BY route, year, month_num) v
  ON v.route = y.route AND v.year = y.year AND v.month_num = m.month_num""")
def _(i: Inputs) -> DataFrame:
    # route 22 reports no lane counts, so its line falls back to flow
    rows = i.processed.withColumn("lanes", F.when(F.col("route") != 22, F.col("lanes")))
    return rounded(metrics.route_month_line(rows), "line_value")


def _points(source: str, keys: str, mean: str, more: str = "") -> str:
    return f"""SELECT {keys}, round(avg(avg_flow), 4) AS {mean}{more}, median(latitude) AS latitude, median(longitude) AS longitude
  FROM {source} AND latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY {keys}"""


@query("station_map", _points(f"{_CHOSEN} WHERE true", "station", "avg_flow_sel"))
def _(i: Inputs) -> DataFrame:
    return rounded(metrics.station_map(_chosen(i)), "avg_flow_sel")


@query("station_map_global", _points(f"enriched WHERE {_PERIODS}", "station", "avg_flow_sel"))
def _(i: Inputs) -> DataFrame:
    return rounded(metrics.station_map_global(i.processed, PERIODS_ONLY), "avg_flow_sel")


@query("station_year_month", _points(f"enriched WHERE {_PERIODS}", "station, year, month_num, month", "avg_flow_ym", ", min(district) AS district"))
def _(i: Inputs) -> DataFrame:
    return rounded(metrics.station_year_month(i.processed, PERIODS_ONLY), "avg_flow_ym")


@query("map_domain", f"""SELECT round(avg(latitude), 6) AS center_lat, round(avg(longitude), 6) AS center_lon,
  coalesce(round(min(avg_flow_sel), 4), 0) AS color_min, coalesce(round(max(avg_flow_sel), 4), 1) AS color_max FROM (
  SELECT station, median(latitude) AS latitude, median(longitude) AS longitude, avg(avg_flow) AS avg_flow_sel
  FROM enriched WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY station)""")
def _(i: Inputs) -> DataFrame:
    domain = metrics.map_domain(metrics.station_map_global(i.processed))
    return rounded(rounded(domain, "center_lat", "center_lon", digits=6), "color_min", "color_max")


@query("speed_by_hour", "SELECT hour, year, round(avg(avg_speed), 4) AS avg_speed FROM enriched GROUP BY ALL")
def _(i: Inputs) -> DataFrame:
    return rounded(metrics.speed_by_hour(i.processed), "avg_speed")


def _pivot(column: str, values: list, names: list[str], value: str, source: str) -> str:
    cells = ", ".join(f"round(avg({value}) FILTER (WHERE {column} = {v}), 4) AS \"{n}\"" for v, n in zip(values, names))
    return f"SELECT hour, {cells} FROM {source} GROUP BY hour"


@query("speed_by_hour_pivot", _pivot("year", ALL_YEARS, [str(y) for y in ALL_YEARS], "avg_speed", "enriched"))
def _(i: Inputs) -> DataFrame:
    return rounded(metrics.speed_by_hour_pivot(i.processed, ALL_YEARS), *[str(y) for y in ALL_YEARS])


# ---------------------------------------------------------------- exploration

@query("heatmap_hour_month", _pivot("month", [f"'{m}'" for m in periods.MONTHS], periods.MONTHS, "median_flow", "summ"))
def _(i: Inputs) -> DataFrame:
    return rounded(exploration.heatmap_hour_month(i.processed), *periods.MONTHS)


_TOP = "(SELECT route, count(*) AS row_count FROM summ GROUP BY route ORDER BY row_count DESC, route LIMIT {k})"


@query("top_routes", f"SELECT * FROM {_TOP.format(k=5)}")
def _(i: Inputs) -> DataFrame:
    return exploration.top_routes(i.processed)


@query("top_routes_box", f"""SELECT b.route, least(min(s.median_speed), q1) AS whisker_low, q1, b.median, q3, greatest(max(s.median_speed), q3) AS whisker_high
  FROM (SELECT route, quantile_cont(median_speed, 0.25) AS q1, quantile_cont(median_speed, 0.5) AS median, quantile_cont(median_speed, 0.75) AS q3
        FROM summ WHERE route IN (SELECT route FROM {_TOP.format(k=5)}) GROUP BY route) b
  JOIN summ s ON s.route = b.route AND s.median_speed BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
  GROUP BY b.route, q1, b.median, q3""")
def _(i: Inputs) -> DataFrame:
    return exploration.top_routes_box(i.processed)


@query("systematic_sample", f"""SELECT {_ORDER}, median_flow, median_speed FROM (
  SELECT *, row_number() OVER (ORDER BY {_ORDER}) AS rn FROM summ) WHERE (rn - 1) % 10 = 0""")
def _(i: Inputs) -> DataFrame:
    columns = [*_ORDER.split(", "), "median_flow", "median_speed"]
    return exploration.systematic_sample(i.processed.select(*columns)).select(*columns)


@query("hour_direction_flow", "SELECT hour, direction, round(avg(median_flow), 4) AS avg_median_flow FROM summ WHERE direction IN ('N', 'S', 'E', 'W') GROUP BY ALL")
def _(i: Inputs) -> DataFrame:
    return rounded(exploration.hour_direction_flow(i.processed), "avg_median_flow")


@query("occupancy_hist", """SELECT t.type, CAST(b.bin AS INT) AS bin, round(low + b.bin * w, 6) AS bin_start, coalesce(n, 0) AS n, round(coalesce(n, 0) / (total * w), 6) AS density
  FROM (SELECT type, min(median_occup) AS low, (max(median_occup) - min(median_occup)) / 50 AS w, count(*) AS total FROM summ WHERE type IN ('ML', 'HV') GROUP BY type) t
  CROSS JOIN (SELECT unnest(range(0, 50)) AS bin) b
  LEFT JOIN (SELECT s.type, least(CAST(floor((s.median_occup - l.low) / l.w) AS INT), 49) AS bin, count(*) AS n FROM summ s
    JOIN (SELECT type, min(median_occup) AS low, (max(median_occup) - min(median_occup)) / 50 AS w FROM summ GROUP BY type) l ON l.type = s.type
    GROUP BY ALL) c ON c.type = t.type AND c.bin = b.bin""")
def _(i: Inputs) -> DataFrame:
    return rounded(exploration.occupancy_histogram(i.processed), "bin_start", "density", digits=6)


@query("monthly_trend", "SELECT month_num, month, round(avg(median_flow), 4) AS avg_median_flow FROM summ GROUP BY ALL")
def _(i: Inputs) -> DataFrame:
    return rounded(exploration.monthly_trend(i.processed), "avg_median_flow")


@query("peak_offpeak", """SELECT CASE WHEN hour BETWEEN 7 AND 9 OR hour BETWEEN 16 AND 18 THEN 'Peak (7-9, 16-18)' ELSE 'Off-peak' END AS period,
  round(avg(median_speed), 4) AS avg_median_speed FROM summ GROUP BY 1""")
def _(i: Inputs) -> DataFrame:
    return rounded(exploration.peak_off_peak(i.processed), "avg_median_speed")


@query("data_summary", f"""SELECT count(DISTINCT station) AS total_stations, printf('%.0f vehicles/hour', avg(median_flow)) AS average_flow,
  printf('%.1f mph', avg(median_speed)) AS average_speed,
  coalesce((SELECT string_agg(route, ', ' ORDER BY row_count DESC, route) FROM {_TOP.format(k=5)}), '') AS top_routes FROM summ""")
def _(i: Inputs) -> DataFrame:
    return exploration.data_summary(i.processed)


@query("stations_on_routes", "SELECT count(DISTINCT station) AS stations FROM summ WHERE route IN (5, 22, 91)")
def _(i: Inputs) -> DataFrame:
    return exploration.stations_on_routes(i.processed, [5, 22, 91])


@query("metric_domain", "SELECT min(median_flow) AS color_min, max(median_flow) AS color_max FROM summ")
def _(i: Inputs) -> DataFrame:
    return exploration.metric_domain(i.processed)


# ---------------------------------------------------------------- streaming

def _streamed_clean(i: Inputs) -> DataFrame:
    rows = ingest.read_raw_stream(i.spark, i.landed_e, files_per_batch=1)
    return ingest.clean_stream(rows, i.calendar)


@query("stream_ingest", """SELECT 'd' || lpad(CAST(district AS VARCHAR), 2, '0') || '_text_station_hour_' || strftime(date, '%Y_%m') || '.txt.gz' AS file_name,
  station, hour, pct_obs, flow, speed FROM (SELECT * FROM raw_e)""")
def _(i: Inputs) -> DataFrame:
    table, mark = shared_path(i.spark, "stream-raw"), shared_path(i.spark, "stream-mark")
    rows = ingest.read_raw_stream(i.spark, i.landed_e, files_per_batch=1).select(
        "file_name", "time_stamp_string", "station", "pct_obs", "flow", "speed")
    ingest.append_stream(rows, table, mark)
    ingest.append_stream(rows, table, mark)   # a second run finds no new file
    landed = i.spark.read.schema(rows.schema).parquet(table)
    return landed.withColumn("hour", F.hour(scalar.local_timestamp(F.col("time_stamp_string")))).drop("time_stamp_string")


@query("stream_clean", f"SELECT {_CLEAN} FROM clean_e")
def _(i: Inputs) -> DataFrame:
    table = shared_path(i.spark, "stream-clean")
    rows = _streamed_clean(i).select(*_CLEAN.split(", "))
    ingest.append_stream(rows, table, shared_path(i.spark, "stream-mark"))
    return i.spark.read.schema(rows.schema).parquet(table)


@query("stream_upsert", _rounded_sql("enriched_e"))
def _(i: Inputs) -> DataFrame:
    table, mark = (shared_path(i.spark, n) for n in ("stream-table", "stream-mark"))
    ingest.upsert_stream(i.spark, i.landed_e, table, mark, i.meta, i.calendar, files_per_batch=1)
    return rounded(tables.scan_processed(i.spark, table), *SD)


@query("stream_window", """SELECT window_start, event_type, count(*) AS rows, avg(value) AS mean_value, median(value) AS median_value
  FROM (SELECT date_trunc('hour', ts) AS window_start, event_type, CAST(CAST(round(value * 100) AS INT) AS DOUBLE) AS value FROM events) GROUP BY window_start, event_type""")
def _(i: Inputs) -> DataFrame:
    events = (i.spark.readStream.schema(i.table("events").schema).option("pathGlobFilter", "events.parquet")
              .parquet(i.sf_dir))
    cents = events.withColumn("value", F.round(F.col("value") * 100).cast("int"))
    counts = windows.windowed_value_counts(cents, "ts", ["event_type"], "value")
    table = shared_path(i.spark, "stream-counts")
    windows.upsert_counts(counts, table, shared_path(i.spark, "stream-mark"))
    whole = windows.current_counts(i.spark, table, counts.schema)
    return windows.window_summary(whole, ["event_type"]).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "rows", "mean_value", "median_value")
