"""The analysis report (A11): every aggregate of the clean frame.

``run_report`` returns the same results as the single operators.  With
``fused=True`` all of them come from ONE grouping-sets aggregate over the
clean frame (one scan, one shuffle of partial aggregates); the fused table
has a row per group of each set, stored once in the shared folder, and each report
is a roll-up of it.  Coarser figures roll up from counts and sums,
never from averages.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mishap.constants import HIGH, SEVERITY_LEVELS, TOP_AREAS, TOP_CITIES, TOP_HIGH_SEVERITY_CITIES, TOP_PEAK_HOURS
from mishap.functions.columns import period
from mishap.operators import aggregates as A
from mishap.plans import sql as Q
from mishap.plans.materialize import store_result

REPORT_KEYS = ("city", "severity", "hour", "weather_condition", "road_condition", "month_year", "year")
# (label, grouped columns) of the fused aggregate
REPORT_SETS = (
    ("city_severity", ("city", "severity")),
    ("hour", ("hour",)),
    ("weather_severity", ("weather_condition", "severity")),
    ("road", ("road_condition",)),
    ("month_severity", ("month_year", "severity")),
    ("year", ("year",)),
)


def report_grouping_sets(clean_df: DataFrame) -> DataFrame:
    """Fused single-pass aggregate: one row per group of every report set.

    Every input row enters the map-side aggregate once for each of the six sets
    (Expand), the price of one scan.  Columns: grouping_set, the seven keys (NULL where not grouped), accidents,
    high_count, vehicles_sum, vehicles_n.
    """
    label = F.lit(None).cast("string")
    for name, cols in reversed(REPORT_SETS):
        label = F.when(F.grouping(cols[0]) == 0, F.lit(name)).otherwise(label)
    grouped = clean_df.groupingSets([list(c) for _, c in REPORT_SETS], *REPORT_KEYS)
    return grouped.agg(
        label.alias("grouping_set"),
        F.count(F.lit(1)).alias("accidents"),
        F.count_if(F.col("severity") == HIGH).alias("high_count"),
        F.sum("num_vehicles").cast("bigint").alias("vehicles_sum"),
        F.count("num_vehicles").alias("vehicles_n"),
    )



def _set(fused: DataFrame, name: str) -> DataFrame:
    return fused.where(F.col("grouping_set") == name)


def _roll(fused: DataFrame, name: str, key, alias: str = "count") -> DataFrame:
    return _set(fused, name).groupBy(key).agg(F.sum("accidents").alias(alias))


def report_from_fused(fused: DataFrame, gathered: bool = False) -> dict[str, DataFrame]:
    """Every report as a roll-up of the fused table (same results as the operators);
    ``gathered``: the table is read as one partition."""
    sort_small = partial(A.sort_small, gathered=gathered)
    cs = _set(fused, "city_severity")
    by_city = cs.groupBy("city").agg(F.sum("accidents").alias("accident_count"))
    areas = A.with_other(cs.groupBy("city").agg(
        *[F.sum(F.when(F.col("severity") == lvl, F.col("accidents")).otherwise(0)).alias(lvl)
          for lvl in SEVERITY_LEVELS],
        F.sum("accidents").alias("total")))
    hours = _set(fused, "hour")
    by_hour = hours.select("hour", F.col("accidents").alias("accident_count"))
    months = _roll(fused, "month_severity", "month_year", "accident_count")
    high_city = (cs.where(F.col("severity") == HIGH)
                   .select("city", F.col("accidents").alias("high_severity_count")))
    ms = _set(fused, "month_severity").groupBy("month_year").agg(
        F.sum("accidents").alias("accidents"), F.sum("high_count").alias("high_count"))
    yearly = _set(fused, "year").select(
        "year", F.col("accidents").alias("total_accidents"),
        F.try_divide(F.col("vehicles_sum").cast("double"), F.col("vehicles_n")).alias("avg_vehicles"))
    return {
        "by_city": A.top_k(by_city, TOP_CITIES, "accident_count", "city"),
        "top_areas": A.top_k(areas, TOP_AREAS, "total", "city"),
        "by_hour": sort_small(by_hour, F.col("hour").asc_nulls_first()),
        "day_night": sort_small(hours.groupBy(period("hour").alias("period"))
                                  .agg(F.sum("accidents").alias("count")), "period"),
        "by_weather": A.with_share(_roll(fused, "weather_severity", "weather_condition")).orderBy(
            F.col("count").desc(), F.col("weather_condition").asc_nulls_first()),
        "severity_distribution": A.with_share(_roll(fused, "weather_severity", "severity")).orderBy(
            F.col("count").desc(), F.col("severity").asc_nulls_first()),
        "monthly_trend": sort_small(months.select(F.try_to_date("month_year", "yyyy-MM").alias("month_start"),
                                                    "accident_count"), F.col("month_start").asc_nulls_first()),
        "peak_hours": A.top_k(hours.select("hour", F.col("accidents").alias("count")),
                              TOP_PEAK_HOURS, "count", "hour"),
        "by_road": _set(fused, "road").select("road_condition", F.col("accidents").alias("count")).orderBy(
            F.col("count").desc(), F.col("road_condition").asc_nulls_first()),
        "yearly": sort_small(yearly, F.col("year").asc_nulls_first()),
        "high_severity_by_city": A.top_k(high_city, TOP_HIGH_SEVERITY_CITIES, "high_severity_count", "city"),
        "weather_severity_cross": _set(fused, "weather_severity").select(
            "weather_condition", "severity", F.col("accidents").alias("count")).orderBy(
            F.col("weather_condition").asc_nulls_first(), F.col("severity").asc_nulls_first()),
        "monthly_high": sort_small(ms, F.col("month_year").asc_nulls_first()),
    }


def run_report(clean_df: DataFrame, fused: bool = False) -> dict[str, DataFrame]:
    """All analysis results as a dict of lazy DataFrames.

    ``fused=False``: each result is its own plan over ``clean_df`` (store or
    persist the clean frame first).  ``fused=True``: one grouping-sets pass,
    stored in the shared folder, and every result rolled up from it.
    """
    if fused:
        return report_from_fused(*store_result(report_grouping_sets(clean_df), "report"))
    return {
        "by_city": A.accidents_by_city(clean_df),
        "top_areas": A.top_accident_prone_areas(clean_df),
        "by_hour": A.accidents_by_hour(clean_df),
        "day_night": A.accidents_day_night(clean_df),
        "by_weather": A.accidents_by_weather(clean_df),
        "severity_distribution": A.severity_distribution(clean_df),
        "monthly_trend": A.monthly_trend(clean_df),
        "peak_hours": A.peak_accident_hours(clean_df),
        "by_road": A.accidents_by_road_condition(clean_df),
        "yearly": A.yearly_summary(clean_df),
        "high_severity_by_city": Q.high_severity_by_city(clean_df),
        "weather_severity_cross": Q.weather_severity_cross(clean_df),
        "monthly_high": Q.monthly_high(clean_df),
    }


# --- fixed values: names and key columns of the six published summary tables ---
SUMMARY_TABLES: dict[str, tuple[str, str, str]] = {
    # table name: (report key, key column, count column in the report)
    "accidents_by_city": ("by_city", "city", "accident_count"),
    "hourly_distribution": ("by_hour", "hour", "accident_count"),
    "monthly_trend": ("monthly_high", "month_year", "accidents"),
    "road_conditions": ("by_road", "road_condition", "count"),
    "severity_distribution": ("severity_distribution", "severity", "count"),
    "weather_breakdown": ("by_weather", "weather_condition", "count"),
}


def summary_tables(report: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The six published summary tables, (key, count) each, from a report."""
    return {name: report[key].select(col, F.col(cnt).alias("count"))
            for name, (key, col, cnt) in SUMMARY_TABLES.items()}
