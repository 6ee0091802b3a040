"""Headline figures (K1-K7) and insights (I1-I8) in one pass.

One GROUPING SETS aggregate over the frame gives the per-city, per-weather,
per-hour, per-road and per-year counts (a few hundred rows at most); every
figure is then an aggregate of that small table: modes come from group
counts (``mode_of``), never from collecting values.  On an empty frame the
result is still one row: zero totals and shares, NULL modes, hour 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mishap.constants import HIGH, NIGHT, TREND_FLAT, TREND_UP
from mishap.functions.columns import hour_label, mode_of, period, share

# (label, grouped columns): the sets the headline figures need.
SUMMARY_SETS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("city", ("city",)),
    ("weather_condition", ("weather_condition",)),
    ("hour", ("hour",)),
    ("road_condition", ("road_condition",)),
    ("year", ("year",)),
)
SUMMARY_KEYS = ("city", "weather_condition", "hour", "road_condition", "year")


def dimension_counts(frame: DataFrame,
                     sets: Sequence[tuple[str, Sequence[str]]] = SUMMARY_SETS) -> DataFrame:
    """Counts per group of each set, in ONE grouping-sets aggregate.

    Columns: dim (the set's label), every key column (NULL where not
    grouped), n, n_high, vehicles_sum, vehicles_n.  ``dim`` tells the sets
    apart, so a real NULL key stays a group of its own.  Sets whose columns
    are absent from ``frame`` are skipped (their figures come out NULL).
    """
    present = [(name, tuple(cols)) for name, cols in sets if all(c in frame.columns for c in cols)]
    keys: list[str] = []
    for _, cols in present:
        keys += [c for c in cols if c not in keys]
    dim = F.lit(None).cast("string")
    for name, cols in reversed(present):
        dim = F.when(F.grouping(cols[0]) == 0, F.lit(name)).otherwise(dim)
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(F.col("severity") == HIGH).alias("n_high")]
    if "num_vehicles" in frame.columns:
        aggs += [F.sum("num_vehicles").cast("bigint").alias("vehicles_sum"),
                 F.count("num_vehicles").alias("vehicles_n")]
    counts = frame.groupingSets([list(c) for _, c in present], *keys).agg(dim.alias("dim"), *aggs)
    all_keys = {c for _, cols in sets for c in cols}
    missing = {k: F.lit(None) for k in sorted(all_keys - set(keys))}
    if "num_vehicles" not in frame.columns:
        missing.update(vehicles_sum=F.lit(None).cast("bigint"), vehicles_n=F.lit(0).cast("bigint"))
    return counts.withColumns(missing) if missing else counts


def _in(dim: str) -> Column:
    return F.col("dim") == dim


def _top_count(dim: str) -> Column:
    return F.coalesce(F.max(F.when(_in(dim) & F.col(dim).isNotNull(), F.col("n"))), F.lit(0)).cast("bigint")


def summary_from_counts(c: DataFrame) -> DataFrame:
    """One row with every headline figure and insight value, from ``dimension_counts``."""
    total = F.coalesce(F.sum(F.when(_in("city"), F.col("n"))), F.lit(0)).cast("bigint")
    high = F.coalesce(F.sum(F.when(_in("city"), F.col("n_high"))), F.lit(0)).cast("bigint")
    night = F.coalesce(F.sum(F.when(_in("hour") & (period("hour") == NIGHT), F.col("n"))), F.lit(0))
    years = _in("year") & F.col("year").isNotNull()
    one = c.agg(
        total.alias("total"), high.alias("high"), night.alias("night"),
        mode_of("city", "n", _in("city")).alias("top_city"), _top_count("city").alias("top_city_count"),
        mode_of("weather_condition", "n", _in("weather_condition")).alias("top_weather"),
        _top_count("weather_condition").alias("top_weather_count"),
        mode_of("road_condition", "n", _in("road_condition")).alias("top_road"),
        _top_count("road_condition").alias("top_road_count"),
        F.coalesce(mode_of("hour", "n", _in("hour")), F.lit(0)).alias("peak_hour"),
        F.count(F.when(years, F.col("year"))).alias("n_years"),
        F.min_by("n", F.when(years, F.col("year"))).alias("first_year_count"),
        F.max_by("n", F.when(years, F.col("year"))).alias("last_year_count"),
        F.sum(F.when(_in("city"), F.col("vehicles_sum"))).alias("vehicles_sum"),
        F.sum(F.when(_in("city"), F.col("vehicles_n"))).alias("vehicles_n"),
    )
    return one.select(
        "total", "high", "night", "top_city", "top_city_count", "top_weather", "top_weather_count",
        "top_road", "top_road_count", "peak_hour",
        F.coalesce(share("high", "total", 1), F.lit(0.0)).alias("high_pct"),
        F.coalesce(share("night", "total", 1), F.lit(0.0)).alias("night_pct"),
        F.when((F.col("n_years") >= 2) & (F.col("last_year_count") > F.col("first_year_count")),
               F.lit(TREND_UP)).otherwise(F.lit(TREND_FLAT)).alias("trend"),
        (F.col("last_year_count") - F.col("first_year_count")).cast("double").alias("trend_change"),
        F.round(F.try_divide("vehicles_sum", "vehicles_n"), 1).alias("avg_vehicles"),
    )


def summary(frame: DataFrame) -> DataFrame:
    """One row with every headline figure and insight value of ``frame``."""
    return summary_from_counts(dimension_counts(frame))


def kpis_from_summary(s: DataFrame) -> DataFrame:
    return s.select("total", "top_city", "top_city_count", "top_weather", "high_pct",
                    "peak_hour", hour_label("peak_hour").alias("peak_hour_label"))


def insights_from_summary(s: DataFrame) -> DataFrame:
    def row(name: str, subject: Column, value: Column) -> Column:
        return F.struct(F.lit(name).alias("insight"), subject.cast("string").alias("subject"),
                        value.cast("double").alias("value"))
    rows = F.array(
        row("most_accident_prone_city", F.col("top_city"), F.col("top_city_count")),
        row("high_severity_share", F.lit(HIGH), F.col("high_pct")),
        row("top_weather", F.col("top_weather"), F.col("top_weather_count")),
        row("peak_hour", hour_label("peak_hour"), F.col("peak_hour")),
        row("night_share", F.lit(NIGHT), F.col("night_pct")),
        row("top_road_condition", F.col("top_road"), F.col("top_road_count")),
        row("trend", F.col("trend"), F.col("trend_change")),
        row("avg_vehicles", F.lit(None), F.col("avg_vehicles")),
    )
    return s.select(F.inline(rows))


def kpis(frame: DataFrame) -> DataFrame:
    """K1-K5, K7: total, most dangerous city (+count), commonest weather,
    High share (%, 1 decimal), peak hour (+ ``HH:00`` label).  Always one row."""
    return kpis_from_summary(summary(frame))


def insights(frame: DataFrame) -> DataFrame:
    """I1-I8 as eight (insight, subject, value) rows; sentences are the caller's."""
    return insights_from_summary(summary(frame))


def dataset_info(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, distinct cities, first and last date of the unfiltered frame."""
    distinct = (F.approx_count_distinct("city") if approximate else F.count_distinct("city"))
    return df.agg(F.count(F.lit(1)).alias("total_records"), distinct.alias("cities"),
                  F.min("date").alias("min_date"), F.max("date").alias("max_date"))


HLL_LOG_SIZE = 14
"""Registers of a distinct-count sketch: 2^14, a standard error of 0.8 %."""


def city_sketches(df: DataFrame) -> DataFrame:
    """Per date its rows and a HyperLogLog sketch of its cities; small, stored once, mergeable over dates and loads."""
    named = F.concat(F.lit("="), "city")                 # sketches leave out empty texts, but a blank city is a city
    return df.groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(named, F.lit(HLL_LOG_SIZE)).alias("cities"))


def merge_city_sketches(sketches: DataFrame) -> DataFrame:
    """One sketch a date from those of several loads of distinct rows."""
    return sketches.groupBy("date").agg(F.sum("n").alias("n"), F.hll_union_agg("cities").alias("cities"))


def cities_between(sketches: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows and distinct cities of any date range (open at either end), from the sketches alone.

    The number of cities is an estimate (exact forms: ``dataset_info``); no
    date in the range gives zeros and NULL dates.
    """
    found = sketches
    if first is not None:
        found = found.where(F.col("date") >= F.lit(first).cast("date"))
    if last is not None:
        found = found.where(F.col("date") <= F.lit(last).cast("date"))
    return found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
                     F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("cities")), F.lit(0)).alias("cities"),
                     F.min("date").alias("min_date"), F.max("date").alias("max_date"))
