"""DuckDB SQL that computes every registered query independently of Spark.

Used by ``__spark_entry__.oracle_sql`` (the driver's correctness gate) and
by ``tests/test_oracle.py``.  The raw incident rows come from the same SQL
text as the Spark side (``RAW_INCIDENTS_SQL``); every later step --
renaming, dedup, NULL handling, title case, date/hour parsing, casts and
each query -- is written here in DuckDB's own dialect.
"""

from __future__ import annotations

from mishap.sources.fixture import RAW_INCIDENTS_SQL
from mishap.plans.registry import DASHBOARD_TABLES, FILTER_CITIES, FILTER_DATES, FILTER_SEVERITIES, REPORTS


def _tt(x: str) -> str:
    """Title case as Spark's initcap (DuckDB has none): lower, capitalise after blanks."""
    return (f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def _q(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


FIX = RAW_INCIDENTS_SQL.replace("{events}", "events")

_DATE = ("CAST(coalesce(try_strptime(date, '%Y-%m-%d'), try_strptime(date, '%m/%d/%Y'), "
         "try_strptime(date, '%d-%m-%Y'), try_strptime(date, '%Y/%m/%d')) AS DATE)")

CTES = f"""
raw AS ({FIX}),
std AS (SELECT id, accident_location AS city, accident_date AS date, accident_time AS time,
               accident_severity AS severity, weather AS weather_condition, road_type AS road_condition,
               vehicles_involved AS num_vehicles, lat AS latitude, lon AS longitude FROM raw),
dd AS (SELECT DISTINCT * FROM std),
nn AS (SELECT * FROM dd WHERE city IS NOT NULL AND date IS NOT NULL AND severity IS NOT NULL),
fl AS (SELECT id, city, date, time, severity, coalesce(weather_condition, 'Unknown') AS weather_condition,
              coalesce(road_condition, 'Unknown') AS road_condition, coalesce(num_vehicles, '1') AS num_vehicles,
              latitude, longitude FROM nn),
nz AS (SELECT id, {_tt('city')} AS city, date, time, {_tt('severity')} AS severity,
              {_tt('weather_condition')} AS weather_condition, {_tt('road_condition')} AS road_condition,
              num_vehicles, latitude, longitude FROM fl),
pd AS (SELECT id, city, {_DATE} AS date, time, severity, weather_condition, road_condition,
              num_vehicles, latitude, longitude FROM nz),
ph AS (SELECT *, try_cast(split_part(time, ':', 1) AS INTEGER) AS hour FROM pd),
cf AS (SELECT *, CAST(extract(dow FROM date) + 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month,
              CAST(year(date) AS INTEGER) AS year, strftime(date, '%Y-%m') AS month_year FROM ph),
clean AS (SELECT id, city, date, time, severity, weather_condition, road_condition,
                 CAST(trunc(try_cast(num_vehicles AS DOUBLE)) AS INTEGER) AS num_vehicles, CAST(latitude AS FLOAT) AS latitude,
                 CAST(longitude AS FLOAT) AS longitude, hour, day_of_week, month, year, month_year FROM cf),
serving AS (SELECT * REPLACE (coalesce(num_vehicles, 1) AS num_vehicles, coalesce(hour, 0) AS hour) FROM clean),
dv AS (SELECT * FROM serving WHERE date IS NOT NULL AND city IN
         (SELECT DISTINCT city FROM serving WHERE city IS NOT NULL ORDER BY city LIMIT 5)),
flt AS (SELECT * FROM serving WHERE city IN ({_q(FILTER_CITIES)}) AND severity IN ({_q(FILTER_SEVERITIES)})
          AND date BETWEEN DATE '{FILTER_DATES[0]}' AND DATE '{FILTER_DATES[1]}'
          AND year BETWEEN {FILTER_DATES[0][:4]} AND {FILTER_DATES[1][:4]})
"""


def _w(body: str, extra: str = "") -> str:
    return f"WITH {CTES}{extra}\n{body}"


_CLEAN_COLS = ["id", "city", "date", "time", "severity", "weather_condition", "road_condition",
               "num_vehicles", "latitude", "longitude", "hour", "day_of_week", "month", "year", "month_year"]
_CLEAN_TYPES = ["bigint", "string", "date", "string", "string", "string", "string",
                "int", "float", "float", "int", "int", "int", "int", "string"]

_PROFILE = "\nUNION ALL\n".join(
    f"SELECT {i + 1} AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null, "
    f"count(*) AS \"rows\" FROM clean"
    for i, (c, t) in enumerate(zip(_CLEAN_COLS, _CLEAN_TYPES)))

_RAW_COLS = ["id", "accident_location", "accident_date", "accident_time", "accident_severity", "weather", "road_type",
             "vehicles_involved", "lat", "lon"]
_RAW_TYPES = ["bigint", *["string"] * 7, "double", "double"]
_RAW_PROFILE = "\nUNION ALL\n".join(
    f"SELECT {i + 1} AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null, "
    f"count(*) AS \"rows\" FROM raw"
    for i, (c, t) in enumerate(zip(_RAW_COLS, _RAW_TYPES)))


def _counts(src: str, key: str, name: str = "count", where: str = "") -> str:
    return f"SELECT {key}, count(*) AS {name} FROM {src} {where} GROUP BY {key}"


def _share(src: str, key: str) -> str:
    return _w(f"SELECT {key}, count, round(count / (SELECT sum(count) FROM c) * 100, 2) AS percentage FROM c",
              f", c AS ({_counts(src, key)})")


_DAY = "CASE WHEN hour >= 6 AND hour < 18 THEN '{d}' ELSE '{n}' END"


def _mode(src: str, key: str) -> str:
    return (f"SELECT {key} AS k, count(*) AS n FROM {src} WHERE {key} IS NOT NULL "
            f"GROUP BY {key} ORDER BY n DESC, {key} LIMIT 1")


def _summary(src: str) -> str:
    return f""",
cc AS ({_mode(src, 'city')}), wc AS ({_mode(src, 'weather_condition')}),
rc AS ({_mode(src, 'road_condition')}), hc AS ({_mode(src, 'hour')}),
yc AS (SELECT year, count(*) AS n FROM {src} WHERE year IS NOT NULL GROUP BY year),
s AS (SELECT
  (SELECT count(*) FROM {src}) AS total,
  (SELECT count(*) FILTER (WHERE severity = 'High') FROM {src}) AS high,
  (SELECT count(*) FILTER (WHERE NOT coalesce(hour >= 6 AND hour < 18, false)) FROM {src}) AS night,
  (SELECT k FROM cc) AS top_city, coalesce((SELECT n FROM cc), 0) AS top_city_count,
  (SELECT k FROM wc) AS top_weather, coalesce((SELECT n FROM wc), 0) AS top_weather_count,
  (SELECT k FROM rc) AS top_road, coalesce((SELECT n FROM rc), 0) AS top_road_count,
  CAST(coalesce((SELECT k FROM hc), 0) AS INTEGER) AS peak_hour,
  (SELECT count(*) FROM yc) AS n_years,
  (SELECT n FROM yc ORDER BY year LIMIT 1) AS first_n,
  (SELECT n FROM yc ORDER BY year DESC LIMIT 1) AS last_n,
  (SELECT round(avg(num_vehicles), 1) FROM {src}) AS avg_vehicles)"""


_PCT = "coalesce(round({p} / nullif(total, 0) * 100, 1), 0.0)"

_INSIGHTS = "\nUNION ALL ".join([
    "SELECT 'most_accident_prone_city' AS insight, top_city AS subject, CAST(top_city_count AS DOUBLE) AS value FROM s",
    f"SELECT 'high_severity_share', 'High', {_PCT.format(p='high')} FROM s",
    "SELECT 'top_weather', top_weather, CAST(top_weather_count AS DOUBLE) FROM s",
    "SELECT 'peak_hour', printf('%02d:00', peak_hour), CAST(peak_hour AS DOUBLE) FROM s",
    f"SELECT 'night_share', 'Night', {_PCT.format(p='night')} FROM s",
    "SELECT 'top_road_condition', top_road, CAST(top_road_count AS DOUBLE) FROM s",
    "SELECT 'trend', CASE WHEN n_years >= 2 AND last_n > first_n THEN 'increasing' ELSE 'stable or decreasing' END, "
    "CAST(last_n - first_n AS DOUBLE) FROM s",
    "SELECT 'avg_vehicles', NULL, avg_vehicles FROM s",
])


def _grid(src: str, step: str) -> str:
    step = f"CAST({step} AS DOUBLE)"
    return _w(f"""SELECT cell_lat, cell_lon, count(*) AS incidents,
                    count(*) FILTER (WHERE severity = 'High') AS high_incidents,
                    (cell_lat + 0.5) * {step} AS lat_center, (cell_lon + 0.5) * {step} AS lon_center
                  FROM (SELECT *, CAST(floor(latitude / {step}) AS BIGINT) AS cell_lat,
                                  CAST(floor(longitude / {step}) AS BIGINT) AS cell_lon
                        FROM {src} WHERE latitude IS NOT NULL AND longitude IS NOT NULL)
                  GROUP BY cell_lat, cell_lon""")


_REPORT = """
SELECT CASE WHEN grouping(city) = 0 THEN 'city_severity' WHEN grouping(hour) = 0 THEN 'hour'
            WHEN grouping(weather_condition) = 0 THEN 'weather_severity' WHEN grouping(road_condition) = 0 THEN 'road'
            WHEN grouping(month_year) = 0 THEN 'month_severity' WHEN grouping(year) = 0 THEN 'year' END AS grouping_set,
       city, severity, hour, weather_condition, road_condition, month_year, year,
       count(*) AS accidents, count(*) FILTER (WHERE severity = 'High') AS high_count,
       CAST(sum(num_vehicles) AS BIGINT) AS vehicles_sum, count(num_vehicles) AS vehicles_n
FROM clean
GROUP BY GROUPING SETS ((city, severity), (hour), (weather_condition, severity), (road_condition),
                        (month_year, severity), (year))
"""

ORACLE: dict[str, str] = {
    "profile": _w(_PROFILE),
    "standardized": _w("SELECT * FROM std"),
    "deduplicated": _w("SELECT * FROM dd"),
    "dropped_critical": _w("SELECT * FROM nn"),
    "filled_nulls": _w("SELECT * FROM fl"),
    "normalized": _w("SELECT * FROM nz"),
    "parsed_dates": _w("SELECT * FROM pd"),
    "parsed_hours": _w("SELECT * FROM ph"),
    "calendar_fields": _w("SELECT * FROM cf"),
    "cast_numerics": _w("SELECT * FROM clean"),
    "clean": _w("SELECT * FROM clean"),
    "serving_frame": _w("SELECT * FROM serving"),
    "filtered": _w("SELECT * FROM flt"),
    "filter_options": _w("SELECT DISTINCT 'city' AS field, city AS value FROM clean WHERE city IS NOT NULL "
                         "UNION SELECT DISTINCT 'severity', severity FROM clean WHERE severity IS NOT NULL"),
    "dataset_info": _w("SELECT count(*) AS total_records, count(DISTINCT city) AS cities, "
                       "min(date) AS min_date, max(date) AS max_date FROM clean"),
    "default_view": _w("SELECT * FROM dv"),
    "explorer": _w("SELECT city, date, time, severity, weather_condition, road_condition, num_vehicles, hour FROM flt"),
    "by_city": _w(_counts("clean", "city", "accident_count") + " ORDER BY accident_count DESC, city LIMIT 15"),
    "city_top12": _w(_counts("dv", "city", "accident_count", "WHERE city IS NOT NULL")
                     + " ORDER BY accident_count DESC, city LIMIT 12"),
    "top_areas": _w("SELECT city, count(*) FILTER (WHERE severity = 'High') AS \"High\", "
                    "count(*) FILTER (WHERE severity = 'Low') AS \"Low\", "
                    "count(*) FILTER (WHERE severity = 'Medium') AS \"Medium\", "
                    "count(*) FILTER (WHERE severity NOT IN ('High', 'Low', 'Medium')) AS \"Other\", count(*) AS total "
                    "FROM clean GROUP BY city ORDER BY total DESC, city LIMIT 5"),
    "by_hour": _w(_counts("clean", "hour", "accident_count")),
    "hourly_peaks": _w("SELECT hour, count(*) AS accident_count, hour IN (7, 8, 17, 18, 19) AS is_peak "
                       "FROM dv WHERE hour IS NOT NULL GROUP BY hour"),
    "day_night": _w(f"SELECT {_DAY.format(d='Day', n='Night')} AS period, count(*) AS count FROM clean GROUP BY 1"),
    "day_night_dashboard": _w(f"SELECT {_DAY.format(d='Day (6AM–6PM)', n='Night (6PM–6AM)')} AS period, "
                              "count(*) AS count FROM dv GROUP BY 1"),
    "by_weather": _share("clean", "weather_condition"),
    "by_weather_filtered": _w(_counts("dv", "weather_condition", where="WHERE weather_condition IS NOT NULL")),
    "severity_distribution": _share("clean", "severity"),
    "severity_filtered": _w(_counts("dv", "severity", where="WHERE severity IS NOT NULL")),
    "monthly_trend": _w("SELECT CAST(date_trunc('month', date) AS DATE) AS month_start, count(*) AS accident_count "
                        "FROM clean GROUP BY 1"),
    "monthly_trend_filtered": _w("SELECT CAST(date_trunc('month', date) AS DATE) AS month_start, "
                                 "count(*) AS accident_count FROM dv WHERE date IS NOT NULL GROUP BY 1"),
    "peak_hours": _w(_counts("clean", "hour") + " ORDER BY count DESC, hour NULLS FIRST LIMIT 5"),
    "by_road": _w(_counts("clean", "road_condition")),
    "by_road_filtered": _w(_counts("dv", "road_condition", where="WHERE road_condition IS NOT NULL")),
    "yearly": _w("SELECT year, count(*) AS total_accidents, avg(num_vehicles) AS avg_vehicles FROM clean GROUP BY year"),
    "report_grouping_sets": _w(_REPORT),
    "high_severity_by_city": _w("SELECT city, count(*) AS high_severity_count FROM clean WHERE severity = 'High' "
                                "GROUP BY city ORDER BY high_severity_count DESC, city LIMIT 10"),
    "weather_severity_cross": _w("SELECT weather_condition, severity, count(*) AS count FROM clean GROUP BY 1, 2"),
    "monthly_high": _w("SELECT month_year, count(*) AS accidents, "
                       "count(*) FILTER (WHERE severity = 'High') AS high_count FROM clean GROUP BY 1"),
    "kpis": _w(f"SELECT total, top_city, top_city_count, top_weather, {_PCT.format(p='high')} AS high_pct, "
               "peak_hour, printf('%02d:00', peak_hour) AS peak_hour_label FROM s", _summary("dv")),
    "insights": _w(_INSIGHTS, _summary("dv")),
    "hotspot_grid": _grid("dv", "0.5"),
    "hotspot_points": _w("""SELECT latitude, longitude, severity, city, date, weather_condition FROM (
                              SELECT *, md5(concat_ws('|', '42', coalesce(CAST(id AS VARCHAR), ''), coalesce(city, ''),
                                       coalesce(time, ''), coalesce(severity, ''),
                                       coalesce(weather_condition, ''), coalesce(road_condition, ''),
                                       coalesce(CAST(num_vehicles AS VARCHAR), ''))) AS key
                              FROM dv WHERE latitude IS NOT NULL AND longitude IS NOT NULL)
                            ORDER BY key, latitude, longitude LIMIT 2000"""),
    "csv_round_trip": _w("SELECT * FROM clean"),
    "raw_profile": _w(_RAW_PROFILE),
    "view_sql": _w("SELECT severity, min(date) AS first_date, count(DISTINCT city) AS cities FROM clean GROUP BY severity"),
    "open_range": _w(f"SELECT * FROM serving WHERE date <= DATE '{FILTER_DATES[0]}'"),
    "first_rows": _w("SELECT * FROM clean ORDER BY id NULLS FIRST, date NULLS FIRST, time NULLS FIRST LIMIT 5"),
}

# A selection without rows: the same texts over an empty ``none``.
_NONE = ",\nnone AS (SELECT * FROM serving WHERE city = 'No Such City')"
ORACLE["kpis_empty"] = _w(ORACLE["kpis"].rpartition("\n")[2], _NONE + _summary("none"))
ORACLE["insights_empty"] = _w(_INSIGHTS, _NONE + _summary("none"))

# Figures merged from loads, and asked of stored sketches, equal those of the rows.
ORACLE |= {
    "merged_report": ORACLE["report_grouping_sets"],
    "merged_kpis": _w(ORACLE["kpis"].rpartition("\n")[2], _summary("clean")),
    "merged_dataset_info": ORACLE["dataset_info"],
    "sketched_points": ORACLE["hotspot_points"],
    "pyramid_grid": _grid("serving", "0.5"),
    "pyramid_grid_coarse": _grid("serving", "16"),
    "sketched_cities": _w(f"SELECT count(*) AS total_records, count(DISTINCT city) AS cities, min(date) AS min_date, "
                          f"max(date) AS max_date FROM clean WHERE date BETWEEN DATE '{FILTER_DATES[0]}' AND DATE '{FILTER_DATES[1]}'"),
}

# The fused report, the summary tables and the fused dashboard give the operators' results.
ORACLE |= {f"report_{name}": ORACLE[name] for name in REPORTS}
ORACLE |= {f"dashboard_{name}": ORACLE[name] for name in DASHBOARD_TABLES}
ORACLE |= {f"sidebar_{name}": ORACLE[name] for name in ("filter_options", "dataset_info")}
ORACLE |= {
    "summary_accidents_by_city": _w(_counts("clean", "city") + " ORDER BY count DESC, city LIMIT 15"),
    "summary_hourly_distribution": _w(_counts("clean", "hour")),
    "summary_monthly_trend": _w(_counts("clean", "month_year")),
    "summary_road_conditions": _w(_counts("clean", "road_condition")),
    "summary_severity_distribution": _w(_counts("clean", "severity")),
    "summary_weather_breakdown": _w(_counts("clean", "weather_condition")),
}
