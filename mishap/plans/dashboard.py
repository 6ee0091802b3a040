"""The dashboard's data (everything but drawing), as lazy DataFrames.

Serving frame (C14) -> selection (F1, or the opening view F4) -> headline
figures, insights, the dashboard counts, the map sample and grid, and the
explorer projection.  Nothing is collected: the caller shows or writes each
frame.

``fused=True`` (default) computes every count of the selection in ONE
grouping-sets pass (city, severity, month, hour, weather, road and year),
stores that table once in the shared folder and rolls each dashboard table
up from it.  The sidebar (filter options, dataset info) and the opening
view's cities come from one more pass over the unfiltered table, stored
first.  The map sample (a row-level top-k), the map grid and the explorer
(the rows themselves) read the selection again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mishap.constants import DASHBOARD_DAY, DASHBOARD_NIGHT, DEFAULT_VIEW_CITIES, PEAK_HOURS, TOP_CITIES_DASHBOARD
from mishap.functions.columns import period
from mishap.operators import aggregates as A
from mishap.operators.cleaning import serving_frame
from mishap.operators.filters import apply_filters, default_view, explorer, filter_options
from mishap.operators.hotspots import hotspot_grid, hotspot_points
from mishap.operators.summary import (
    SUMMARY_SETS, dataset_info, dimension_counts, insights, insights_from_summary, kpis,
    kpis_from_summary, summary_from_counts,
)
from mishap.plans.materialize import store_result

DASHBOARD_SETS = SUMMARY_SETS + (
    ("severity", ("severity",)),
    ("month_start", ("month_start",)),
)


def selection(clean_df: DataFrame, cities: Sequence[str] | None = None,
              severities: Sequence[str] | None = None, date_range=None,
              first_view: bool = False, year_folders: bool = False) -> DataFrame:
    """The filtered serving frame; ``first_view`` gives the dashboard's opening selection."""
    frame = serving_frame(clean_df)
    if first_view:
        return default_view(frame)
    return apply_filters(frame, cities, severities, date_range, year_folders)


def opening_view(clean_df: DataFrame, overview: DataFrame) -> DataFrame:
    """The opening selection with its city names taken from the stored overview.

    At most ``DEFAULT_VIEW_CITIES`` names reach the driver; as a literal ``IN``
    list they are a pushed Parquet filter for every scan of the selection.
    """
    first = overview.where((F.col("dim") == "city") & F.col("city").isNotNull()).select("city")
    names = [r["city"] for r in first.orderBy("city").limit(DEFAULT_VIEW_CITIES).collect()]
    return serving_frame(clean_df).where(F.col("date").isNotNull() & F.col("city").isin(names))


def dashboard_counts(view: DataFrame) -> DataFrame:
    """Every dashboard count of a selection but the map's, one grouping-sets pass.

    Each selected row enters the map-side aggregate once for each of the seven
    sets; map cells, of which there may be many, have an aggregate of their own.
    """
    return dimension_counts(view.withColumn("month_start", F.trunc("date", "month")), DASHBOARD_SETS)


def _counts(c: DataFrame, dim: str, key: str, name: str = "count") -> DataFrame:
    return c.where((F.col("dim") == dim) & F.col(key).isNotNull()).select(key, F.col("n").alias(name))


def dashboard_from_counts(c: DataFrame, gathered: bool = False) -> dict[str, DataFrame]:
    """The count-based dashboard tables rolled up from ``dashboard_counts`` (``gathered``: one partition)."""
    sort_small = partial(A.sort_small, gathered=gathered)
    s = summary_from_counts(c)
    hours = _counts(c, "hour", "hour", "accident_count")
    day_night = (c.where(F.col("dim") == "hour")
                  .groupBy(period("hour", DASHBOARD_DAY, DASHBOARD_NIGHT).alias("period"))
                  .agg(F.sum("n").alias("count")))
    return {
        "kpis": kpis_from_summary(s),
        "insights": insights_from_summary(s),
        "city_top12": A.top_k(_counts(c, "city", "city", "accident_count"), TOP_CITIES_DASHBOARD,
                              "accident_count", "city"),
        "severity_filtered": _counts(c, "severity", "severity").orderBy(F.col("count").desc(), "severity"),
        "monthly_trend_filtered": sort_small(
            _counts(c, "month_start", "month_start", "accident_count"), "month_start"),
        "hourly_peaks": sort_small(hours.withColumn("is_peak", F.col("hour").isin(list(PEAK_HOURS))), "hour"),
        "by_weather_filtered": _counts(c, "weather_condition", "weather_condition").orderBy(
            F.col("count").desc(), "weather_condition"),
        "by_road_filtered": _counts(c, "road_condition", "road_condition").orderBy(
            F.col("count").desc(), "road_condition"),
        "day_night_dashboard": sort_small(day_night, "period"),
    }


def table_overview(clean_df: DataFrame) -> DataFrame:
    """One pass over the unfiltered table for the sidebar: rows, first and
    last date per city and per severity (sets ``city`` and ``severity``).
    A row per place and level."""
    dim = F.when(F.grouping("city") == 0, F.lit("city")).otherwise(F.lit("severity"))
    return (clean_df.groupingSets([["city"], ["severity"]], "city", "severity")
            .agg(dim.alias("dim"), F.count(F.lit(1)).alias("n"),
                 F.min("date").alias("min_date"), F.max("date").alias("max_date")))


def sidebar_from_overview(o: DataFrame) -> dict[str, DataFrame]:
    """F2 options and K6 dataset info rolled up from ``table_overview``."""
    cities = o.where(F.col("dim") == "city")
    levels = o.where(F.col("dim") == "severity")
    options = (cities.select(F.lit("city").alias("field"), F.col("city").alias("value"))
               .unionByName(levels.select(F.lit("severity").alias("field"), F.col("severity").alias("value")))
               .where(F.col("value").isNotNull()))
    info = cities.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_records"),
                      F.count("city").alias("cities"), F.min("min_date").alias("min_date"),
                      F.max("max_date").alias("max_date"))
    return {"filter_options": options.orderBy("field", "value"), "dataset_info": info}


def dashboard(clean_df: DataFrame, fused: bool = True, step: float = 0.5,
              **selection_args) -> dict[str, DataFrame]:
    """Every dashboard table for one selection of the clean frame."""
    first = not selection_args or bool(selection_args.get("first_view"))
    overview = store_result(table_overview(clean_df), "overview")[0] if fused else None
    if first:
        view = opening_view(clean_df, overview) if fused else selection(clean_df, first_view=True)
    else:
        view = selection(clean_df, **selection_args)
    rows = {"hotspot_points": hotspot_points(view), "hotspot_grid": hotspot_grid(view, step), "explorer": explorer(view)}
    if fused:
        counts = store_result(dashboard_counts(view), "dashboard")
        return {**sidebar_from_overview(overview), **rows, **dashboard_from_counts(*counts)}
    return {
        "filter_options": filter_options(clean_df),
        "dataset_info": dataset_info(clean_df),
        **rows,
        "kpis": kpis(view),
        "insights": insights(view),
        "city_top12": A.city_top12(view),
        "severity_filtered": A.value_counts(view, "severity"),
        "monthly_trend_filtered": A.monthly_trend_filtered(view),
        "hourly_peaks": A.hourly_peaks(view),
        "by_weather_filtered": A.value_counts(view, "weather_condition"),
        "by_road_filtered": A.value_counts(view, "road_condition"),
        "day_night_dashboard": A.day_night_dashboard(view),
    }
