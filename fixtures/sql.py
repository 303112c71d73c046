"""The same inputs as common table expressions for the SQL oracle (DuckDB dialect)."""

from __future__ import annotations

# order matters: each expression may use those before it
_CTE = {
    "raw_l": """
  SELECT st AS station, 7 + 5 * (st % 2) AS district, 5 + 17 * (st % 5) AS route,
         CASE WHEN (st % 5) % 2 = 0 THEN CASE WHEN st < 5 THEN 'N' ELSE 'S' END
              ELSE CASE WHEN st < 5 THEN 'E' ELSE 'W' END END AS direction,
         CASE WHEN st % 5 = 0 THEN 'HV' WHEN st = 7 THEN 'OR' ELSE 'ML' END AS type,
         CASE WHEN st = 9 THEN NULL ELSE CAST(0.25 AS DOUBLE) * (1 + st) END AS length,
         CAST(100 - 3 * CAST(ROUND(l_discount * 100) AS INT) AS DOUBLE) AS pct_obs,
         CASE WHEN l_orderkey % 37 = 0 THEN NULL ELSE CAST(CAST(ROUND(l_extendedprice / 100) AS INT) AS DOUBLE) END AS flow,
         CAST(80 - l_quantity AS DOUBLE) AS speed,
         CAST(CAST(ROUND(l_tax * 100) AS INT) AS DOUBLE) AS occupancy,
         CAST(l_shipdate + INTERVAL '24' YEAR AS DATE) AS date,
         5 + l_linenumber AS hour, 1 + st % 8 AS gap
  FROM (SELECT *, CAST(l_suppkey % 10 AS INT) AS st FROM lineitem)""",
    "raw_e": """
  SELECT st AS station, 7 + 5 * (st % 2) AS district, 5 + 17 * (st % 5) AS route,
         CASE WHEN st % 2 = 0 THEN 'N' ELSE 'E' END AS direction,
         CASE WHEN st = 0 THEN 'HV' ELSE 'ML' END AS type,
         CAST(0.25 AS DOUBLE) * (1 + st) AS length,
         CAST(100 - 3 * (event_id % 9) AS DOUBLE) AS pct_obs,
         CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(CAST(ROUND(value * 10) AS INT) AS DOUBLE) END AS flow,
         CAST(30 + event_id % 50 AS DOUBLE) AS speed,
         CAST(event_id % 40 AS DOUBLE) AS occupancy,
         CAST(ts AS DATE) AS date, CAST(hour(ts) AS INT) AS hour, 1 + st % 8 AS gap
  FROM (SELECT *, CAST(user_id % 5 AS INT) AS st FROM events)""",
    "meta": """
  SELECT st AS station, 7 + 5 * (st % 2) AS district, 5 + 17 * (st % 5) AS route,
         CASE WHEN st = 3 THEN 'X' WHEN (st % 5) % 2 = 0 THEN CASE WHEN st < 5 THEN 'N' ELSE 'S' END
              ELSE CASE WHEN st < 5 THEN 'E' ELSE 'W' END END AS direction,
         CAST(1 + nation AS INT) AS county, 'R' || CAST(st AS VARCHAR) AS state_pm,
         CASE WHEN st = 4 THEN NULL ELSE CAST(2 * st AS DOUBLE) END AS abs_pm,
         CAST(33.5 AS DOUBLE) + CAST(st AS DOUBLE) / 16 AS latitude,
         CAST(-118 AS DOUBLE) + CAST(st AS DOUBLE) / 16 AS longitude
  FROM (SELECT CAST(s_suppkey % 10 AS INT) AS st, min(s_nationkey) AS nation FROM supplier GROUP BY 1) AS x""",
    "meta_gap": "SELECT * FROM meta WHERE abs_pm IS NULL OR abs_pm <= 15",
    # Tuesday to Thursday holidays of 2019-2025
    "cal": """
  SELECT CAST(d AS DATE) AS date FROM (VALUES
    ('2019-01-01'),('2019-07-04'),('2019-11-28'),('2019-12-25'),('2020-01-01'),('2020-03-31'),
    ('2020-11-11'),('2020-11-26'),('2021-03-31'),('2021-11-11'),('2021-11-25'),('2022-03-31'),
    ('2022-11-24'),('2023-07-04'),('2023-11-23'),('2024-06-19'),('2024-07-04'),('2024-11-28'),
    ('2024-12-25'),('2025-01-01'),('2025-06-19'),('2025-11-11'),('2025-11-27'),('2025-12-25')) AS t(d)""",
    "mon": """
  SELECT CAST(i AS INT) AS month_num, strftime(make_date(2000, CAST(i AS INT), 1), '%B') AS month
  FROM range(1, 13) AS r(i)""",
    "clean": """
  SELECT r.*, CAST(year(r.date) AS INT) AS year, CAST(month(r.date) AS INT) AS month_num,
         strftime(r.date, '%B') AS month, strftime(r.date, '%A') AS day_of_week, gap AS lanes
  FROM raw_l r
  WHERE pct_obs >= 80 AND dayofweek(r.date) IN (2, 3, 4)
    AND NOT EXISTS (SELECT 1 FROM cal c WHERE c.date = r.date)""",
    "clean_e": """
  SELECT r.*, CAST(year(r.date) AS INT) AS year, CAST(month(r.date) AS INT) AS month_num,
         strftime(r.date, '%B') AS month, strftime(r.date, '%A') AS day_of_week, gap AS lanes
  FROM raw_e r
  WHERE pct_obs >= 80 AND dayofweek(r.date) IN (2, 3, 4)
    AND NOT EXISTS (SELECT 1 FROM cal c WHERE c.date = r.date)""",
    "manifest": """
  SELECT CASE o_orderstatus WHEN 'F' THEN 'station_hour' WHEN 'O' THEN 'station_5min' ELSE 'station_day' END AS file_type,
         CAST(1 + o_custkey % 12 AS VARCHAR) AS district,
         CAST(year(o_orderdate) + 24 AS VARCHAR) AS year, CAST(month(o_orderdate) AS INT) AS month_num,
         strftime(o_orderdate, '%B') AS month, count(*) AS orders
  FROM orders GROUP BY ALL""",
    "files": """
  SELECT file_type, district, year, month_num, month,
         'd' || district || '_text_' || file_type || '_' || year || '_' || lpad(CAST(month_num AS VARCHAR), 2, '0') || '.txt.gz' AS file_name,
         file_type || '-' || district || '-f-' || year || '_' || lpad(CAST(month_num AS VARCHAR), 2, '0') AS file_id,
         round_even((40000000 + 110000 * orders) / CAST(100000 AS DOUBLE), 0) / 10 AS megabites,
         '/?download=' || year || '_' || lpad(CAST(month_num AS VARCHAR), 2, '0') || '&d=' || district AS download_url
  FROM manifest""",
}


def _summary(source: str) -> str:
    return f"""
  SELECT station, district, route, direction, type, hour, year, month, month_num, lanes, length,
         median(flow) AS median_flow, avg(flow) AS avg_flow, stddev_samp(flow) AS sd_flow,
         median(speed) AS median_speed, avg(speed) AS avg_speed, stddev_samp(speed) AS sd_speed,
         median(occupancy) AS median_occup, avg(occupancy) AS avg_occup, stddev_samp(occupancy) AS sd_occup,
         count(*) AS days_observed
  FROM {source} WHERE length IS NOT NULL GROUP BY ALL HAVING count(*) >= 4"""


def _enriched(source: str) -> str:
    return f"""
  SELECT s.*, m.county, m.state_pm, m.abs_pm, m.latitude, m.longitude
  FROM {source} s LEFT JOIN meta m
    ON s.station = m.station AND s.route = m.route AND s.direction = m.direction AND s.district = m.district"""


_CTE["summ"] = _summary("clean")
_CTE["summ_e"] = _summary("clean_e")
_CTE["enriched"] = _enriched("summ")
_CTE["enriched_e"] = _enriched("summ_e")


def with_inputs(body: str) -> str:
    """Prefix ``body`` with the expressions; DuckDB evaluates only those it refers to."""
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in _CTE.items()) + "\n" + body
