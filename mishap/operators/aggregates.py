"""Grouped counts over the incident frame (A1-A10 and dashboard variants).

Every operator is one hash aggregate (partial on the map side, final after
one shuffle on the group key), so a hot key -- one city holding a third of
all rows -- is combined map-side and never lands whole in one task.  Top-k
results use ``orderBy(...).limit(k)``, which Spark plans as a bounded
``TakeOrderedAndProject``; ties break on the group key so results are
deterministic.  Shares divide by the sum of the aggregate itself (a scalar
subquery reusing the aggregate's exchange), so the source is scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mishap.constants import (
    DASHBOARD_DAY, DASHBOARD_NIGHT, DAY, NIGHT, OTHER_LEVEL, PEAK_HOURS, SEVERITY_LEVELS,
    TOP_AREAS, TOP_CITIES, TOP_CITIES_DASHBOARD, TOP_PEAK_HOURS,
)
from mishap.functions.columns import period, share


def rows() -> Column:
    """count(*)"""
    return F.count(F.lit(1))


def sort_small(df: DataFrame, *order, gathered: bool = False) -> DataFrame:
    """Total order for a result keyed by hour, period, month or year: gather it
    (unless it is one partition already) and sort there, without the sampling
    job of ``orderBy``.

    Only for keys that the calendar bounds; results keyed by free text (place,
    weather, road, severity) or grid cell use ``orderBy``.
    """
    return (df if gathered else df.repartition(1)).orderBy(*order)


def top_k(counts: DataFrame, k: int, by: str, key: str | list[str]) -> DataFrame:
    """Largest ``by`` first, ties to the smallest key; Spark plans TakeOrderedAndProject."""
    keys = [key] if isinstance(key, str) else list(key)
    return counts.orderBy(F.col(by).desc(), *[F.col(c).asc_nulls_first() for c in keys]).limit(k)


def count_by(df: DataFrame, key: str | Column, name: str = "count") -> DataFrame:
    """Rows per value of ``key`` (NULL is a group of its own)."""
    return df.groupBy(key).agg(rows().alias(name))


def with_share(counts: DataFrame, count_col: str = "count", name: str = "percentage",
               digits: int = 2) -> DataFrame:
    """Add ``count / total * 100`` where total is the sum of the (small) aggregate.

    The total is a scalar subquery over the aggregate itself: computed once,
    and its plan reuses the aggregate's exchange, so the source is scanned
    once.
    """
    total = counts.agg(F.sum(count_col)).scalar()
    return counts.withColumn(name, share(count_col, total, digits))


def accidents_by_city(df: DataFrame, top_n: int = TOP_CITIES) -> DataFrame:
    """A1: accidents per city, top ``top_n``."""
    return top_k(count_by(df, "city", "accident_count"), top_n, "accident_count", "city")


def city_top12(df: DataFrame, top_n: int = TOP_CITIES_DASHBOARD) -> DataFrame:
    """The dashboard's city bar (top 12 of the filtered frame, NULL city left out)."""
    return accidents_by_city(df.where(F.col("city").isNotNull()), top_n)


def top_accident_prone_areas(df: DataFrame, n: int = TOP_AREAS,
                             levels: tuple[str, ...] = SEVERITY_LEVELS) -> DataFrame:
    """A2: per city one count per severity level (a pivot), ``Other`` for all
    further levels, ``total`` of all rows, top n.

    The pivot is expressed as conditional counts in a single aggregate: one
    pass, fixed output schema, no second pivot stage, no level lost.
    """
    aggs = [F.count_if(F.col("severity") == lvl).alias(lvl) for lvl in levels]
    return top_k(with_other(df.groupBy("city").agg(*aggs, rows().alias("total")), levels), n, "total", "city")


def with_other(areas: DataFrame, levels: tuple[str, ...] = SEVERITY_LEVELS) -> DataFrame:
    """Add the rows of all levels that have no column of their own."""
    rest = F.col("total")
    for lvl in levels:
        rest = rest - F.col(lvl)
    return areas.select("city", *levels, rest.alias(OTHER_LEVEL), "total")


def accidents_by_hour(df: DataFrame) -> DataFrame:
    """A3: accidents per hour, in hour order (NULL hour is a group)."""
    return sort_small(count_by(df, "hour", "accident_count"), F.col("hour").asc_nulls_first())


def hourly_peaks(df: DataFrame, peak_hours: tuple[int, ...] = PEAK_HOURS) -> DataFrame:
    """Accidents per hour with the rush-hour flag (on the serving frame)."""
    counts = count_by(df.where(F.col("hour").isNotNull()), "hour", "accident_count")
    return sort_small(counts.withColumn("is_peak", F.col("hour").isin(list(peak_hours))), "hour")


def accidents_day_night(df: DataFrame, day: str = DAY, night: str = NIGHT) -> DataFrame:
    """Day (6 <= hour < 18) vs Night counts; labels are a parameter."""
    return sort_small(count_by(df, period("hour", day, night).alias("period")), "period")


def day_night_dashboard(df: DataFrame) -> DataFrame:
    """The dashboard labels."""
    return accidents_day_night(df, DASHBOARD_DAY, DASHBOARD_NIGHT)


def accidents_by_weather(df: DataFrame) -> DataFrame:
    """A5: count and share (%) per weather condition, largest first."""
    counts = with_share(count_by(df, "weather_condition"))
    return counts.orderBy(F.col("count").desc(), F.col("weather_condition").asc_nulls_first())


def severity_distribution(df: DataFrame) -> DataFrame:
    """Count and share (%) per severity, largest first."""
    counts = with_share(count_by(df, "severity"))
    return counts.orderBy(F.col("count").desc(), F.col("severity").asc_nulls_first())


def monthly_trend(df: DataFrame) -> DataFrame:
    """Accidents per calendar month (first day of the month), in time order."""
    counts = count_by(df, F.trunc("date", "month").alias("month_start"), "accident_count")
    return sort_small(counts, F.col("month_start").asc_nulls_first())


def monthly_trend_filtered(df: DataFrame) -> DataFrame:
    """The dashboard variant: rows without a month are left out."""
    return monthly_trend(df.where(F.col("date").isNotNull()))


def peak_accident_hours(df: DataFrame, top_n: int = TOP_PEAK_HOURS) -> DataFrame:
    """The ``top_n`` busiest hours."""
    return top_k(count_by(df, "hour"), top_n, "count", "hour")


def accidents_by_road_condition(df: DataFrame) -> DataFrame:
    """Accidents per road condition, largest first."""
    return count_by(df, "road_condition").orderBy(F.col("count").desc(), F.col("road_condition").asc_nulls_first())


def yearly_summary(df: DataFrame) -> DataFrame:
    """A10: per year: accidents and mean vehicles involved."""
    counts = df.groupBy("year").agg(rows().alias("total_accidents"), F.avg("num_vehicles").alias("avg_vehicles"))
    return sort_small(counts, F.col("year").asc_nulls_first())


def value_counts(df: DataFrame, key: str) -> DataFrame:
    """Dashboard counts of one column, NULL left out, largest first."""
    counts = count_by(df.where(F.col(key).isNotNull()), key)
    return counts.orderBy(F.col("count").desc(), F.col(key))
