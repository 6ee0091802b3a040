"""Raw incident rows derived from the driver's ``events`` table.

``events`` is the only given table with a time of day, so the raw incident
table is derived from it row for row (plus a copy of every 50th id, to give
the dedup real duplicates).  The text below is plain SQL that runs unchanged
in Spark and in DuckDB, so both engines start from identical raw rows.  It
deliberately uses alias headers, mixed case, blanks, four date formats, bad
dates and times, blank places, a fourth severity, counts with a decimal
part, non-numeric counts and NULLs.  The whole table is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ``{events}`` is the events table (a DataFrame argument in Spark, a view in DuckDB).
RAW_INCIDENTS_SQL = """
WITH base AS (
  SELECT event_id, user_id, event_type,
         substr(cast(ts AS string), 12, 8) AS hms,
         2021 + user_id % 3 AS y, 1 + (event_id * 7 + user_id) % 12 AS m, 1 + event_id % 28 AS d,
         'city ' || cast(user_id % 20 AS string) AS c
  FROM {events}),
one AS (
SELECT event_id AS id,
  CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 401 = 0 THEN '  ' WHEN event_id % 3 = 0 THEN '  ' || c || ' ' WHEN event_id % 3 = 1 THEN upper(c) ELSE c END AS accident_location,
  CASE WHEN event_id % 211 = 0 THEN 'not a date'
       WHEN event_id % 5 = 1 THEN lpad(cast(m AS string),2,'0') || '/' || lpad(cast(d AS string),2,'0') || '/' || cast(y AS string)
       WHEN event_id % 5 = 2 THEN lpad(cast(d AS string),2,'0') || '-' || lpad(cast(m AS string),2,'0') || '-' || cast(y AS string)
       WHEN event_id % 5 = 3 THEN cast(y AS string) || '/' || lpad(cast(m AS string),2,'0') || '/' || lpad(cast(d AS string),2,'0')
       ELSE cast(y AS string) || '-' || lpad(cast(m AS string),2,'0') || '-' || lpad(cast(d AS string),2,'0') END AS accident_date,
  CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 'noon' WHEN event_id % 7 = 0 THEN hms ELSE substr(hms,1,5) END AS accident_time,
  CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 307 = 0 THEN 'fatal' WHEN event_type = 'error' THEN 'HIGH' WHEN event_type IN ('click','view') THEN 'low' ELSE ' medium ' END AS accident_severity,
  CASE (event_id * 13 + user_id) % 11 WHEN 0 THEN NULL WHEN 1 THEN 'rain' WHEN 2 THEN 'RAIN' WHEN 3 THEN 'fog' WHEN 4 THEN 'snow' WHEN 5 THEN 'cloudy' WHEN 6 THEN 'hail' WHEN 7 THEN 'windy' ELSE 'clear' END AS weather,
  CASE (event_id + user_id) % 9 WHEN 0 THEN NULL WHEN 1 THEN 'wet' WHEN 2 THEN 'wet ' WHEN 3 THEN 'icy' WHEN 4 THEN 'slippery' WHEN 5 THEN 'under construction' ELSE 'dry' END AS road_type,
  CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 59 = 0 THEN 'two' WHEN event_id % 47 = 0 THEN '2.0' ELSE cast(1 + user_id % 4 AS string) END AS vehicles_involved,
  CASE WHEN event_id % 61 = 0 THEN NULL ELSE 25 + (user_id % 20) * 1.25E0 END AS lat,
  CASE WHEN event_id % 67 = 0 THEN NULL ELSE -120 + (user_id % 20) * 2.5E0 END AS lon
FROM base)
SELECT * FROM one UNION ALL SELECT * FROM one WHERE id % 50 = 0
"""


def raw_incidents_from_events(events: DataFrame) -> DataFrame:
    """Raw (dirty, alias-headed) incident rows derived from an events frame."""
    return events.sparkSession.sql(RAW_INCIDENTS_SQL, events=events)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw incident rows for a test-data folder (reads the whole events table)."""
    return raw_incidents_from_events(read_events(spark, sf_dir))
