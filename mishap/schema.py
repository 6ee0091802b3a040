"""Schemas of the incident table: what the cleaned frame looks like."""

from __future__ import annotations

from pyspark.sql import types as T

CLEAN_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("city", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("time", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("weather_condition", T.StringType()),
    T.StructField("road_condition", T.StringType()),
    T.StructField("num_vehicles", T.IntegerType()),
    T.StructField("latitude", T.FloatType()),
    T.StructField("longitude", T.FloatType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month_year", T.StringType()),
])

# Target types applied by the numeric cast step (C11); ``id`` is typed there too.
NUMERIC_TARGETS: dict[str, T.DataType] = {
    "id": T.LongType(),
    "num_vehicles": T.IntegerType(),
    "latitude": T.FloatType(),
    "longitude": T.FloatType(),
}

DERIVED_COLUMNS: tuple[str, ...] = ("hour", "day_of_week", "month", "year", "month_year")
