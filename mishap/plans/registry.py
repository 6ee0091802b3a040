"""Named queries over a test-data folder: raw events -> clean -> operator.

Every query reads the whole ``events`` table of ``sf_dir`` (through the raw
incident derivation), so its work grows with the data.  Building a query
runs no job: operator queries run on the clean table that ``prepare`` has
stored for the folder, or else on the lazy cleaning plan itself (only the CSV
round trip, a sink, writes when it is built).  Filters below are the F1
feature's own parameters, not row caps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mishap.operators import aggregates as A
from mishap.operators import cleaning as C
from mishap.operators import filters as Fl
from mishap.operators.hotspots import (
    grid_from_pyramid, grid_pyramid, hotspot_grid, hotspot_points, points_from_sketch, points_sketch,
)
from mishap.operators.profile import head, profile
from mishap.operators.summary import (
    cities_between, city_sketches, dataset_info, insights, kpis, kpis_from_summary, summary_from_counts,
)
from mishap.plans import sql as Q
from mishap.plans.dashboard import dashboard_counts, dashboard_from_counts, sidebar_from_overview, table_overview
from mishap.plans.ledger import counts_from_report, fingerprints, merged_overview, merged_report, partials, unseen
from mishap.plans.materialize import drop, listing, load, new_path, store_clean_path
from mishap.plans.report import SUMMARY_TABLES, report_from_fused, report_grouping_sets, summary_tables
from mishap.session import ensure_shared_dir
from mishap.sinks.writers import write_clean, write_csv
from mishap.sources.csv import read_clean, read_incidents_csv
from mishap.sources.fixture import raw_incidents

# Parameters of the registered F1 selection (a dashboard user's choice).
FILTER_CITIES = ("City 1", "City 12", "City 7")
FILTER_SEVERITIES = ("High", "Low")
FILTER_DATES = ("2022-03-01", "2023-06-30")

Query = Callable[[SparkSession, str], DataFrame]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_incidents(spark, sf_dir)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaning chain over the raw rows, as one lazy plan."""
    return C.clean(raw(spark, sf_dir))


_STORED: dict[tuple, tuple[str, list[str]]] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple:
    return ensure_shared_dir(spark), listing(spark, f"{sf_dir.rstrip('/')}/events.parquet")


def prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store the clean table of ``sf_dir`` in the shared folder for the queries to use.

    This is how the operators are meant to run: clean once, query the stored
    table.  Known by the source files' names, sizes and times, so a changed
    source is not answered from an old table; ``forget`` removes it.
    """
    key = _key(spark, sf_dir)
    if key not in _STORED:
        source = raw(spark, sf_dir)
        df = C.clean(source)
        _STORED[key] = (store_clean_path(df, source=source), df.columns)
    return load(spark, *_STORED[key])


def forget(spark: SparkSession, sf_dir: str) -> None:
    """Remove the table that ``prepare`` stored for the folder, if any."""
    found = _STORED.pop(_key(spark, sf_dir), None)
    if found:
        drop(spark, found[0])


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prepared clean table, or the lazy cleaning plan."""
    found = _STORED.get(_key(spark, sf_dir)) if _STORED else None
    return load(spark, *found) if found else clean(spark, sf_dir)


def serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.serving_frame(clean(spark, sf_dir))


def prepared_serving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.serving_frame(clean_table(spark, sf_dir))


def first_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard's opening selection of the serving frame."""
    return Fl.default_view(prepared_serving(spark, sf_dir))


def filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Fl.apply_filters(prepared_serving(spark, sf_dir), FILTER_CITIES, FILTER_SEVERITIES, FILTER_DATES,
                            year_folders=True)


def open_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range with no first date (F1)."""
    return Fl.apply_filters(prepared_serving(spark, sf_dir), date_range=(None, FILTER_DATES[0]))


def nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A selection without rows (K7)."""
    return Fl.apply_filters(prepared_serving(spark, sf_dir), ["No Such City"])


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with a note of two quoted lines, written as CSV under headers with spaces and capitals, read back
    record by record, cleaned, exported and read again (C1, S2, W1, W3); the files are in the shared folder.
    A row whose note did not come back as it was written is left out."""
    frame = raw(spark, sf_dir).withColumn("note", _note("accident_severity", "accident_location"))
    headers = [c.replace("_", " ").title() for c in frame.columns]
    source = write_csv(frame.toDF(*headers), new_path(spark, "raw-csv"))
    back = read_incidents_csv(spark, source)
    whole = back.where(F.col("Note").eqNullSafe(_note("Accident Severity", "Accident Location"))).drop("Note")
    return read_clean(spark, write_clean(C.clean(whole), new_path(spark, "clean-export")))


def _note(severity: str, place: str) -> Column:
    return F.concat(F.lit('seen, "'), F.col(severity), F.lit('"\nat '), F.col(place))


def raw_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shape of the raw frame, before any cleaning (S3)."""
    return profile(raw(spark, sf_dir))


def _two_loads(name: str) -> Query:
    """The partial aggregates of two overlapping loads that hold the whole table together."""
    def both(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = raw(spark, sf_dir)
        first, second = source.where("id % 3 <> 0"), source.where("id % 3 <> 1")
        new = unseen(second, fingerprints(first))
        return partials(C.clean(first))[name].unionByName(partials(C.clean(new))[name])
    return both


def merged_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headline figures of the whole table from two loads' partial aggregates."""
    fused = merged_report(_two_loads("report")(spark, sf_dir))
    return kpis_from_summary(summary_from_counts(counts_from_report(fused)))


def view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-form SQL over the registered view (Q0)."""
    name = Q.register_view(clean_table(spark, sf_dir))
    return spark.sql(f"SELECT severity, min(date) AS first_date, count(DISTINCT city) AS cities FROM {name} GROUP BY severity")


def _report(name: str) -> Query:
    return lambda spark, sf_dir: report_from_fused(report_grouping_sets(clean_table(spark, sf_dir)))[name]


def _summary(name: str) -> Query:
    return lambda spark, sf_dir: summary_tables(report_from_fused(report_grouping_sets(clean_table(spark, sf_dir))))[name]


def _dashboard(name: str) -> Query:
    return lambda spark, sf_dir: dashboard_from_counts(dashboard_counts(first_view(spark, sf_dir)))[name]


def _sidebar(name: str) -> Query:
    return lambda spark, sf_dir: sidebar_from_overview(table_overview(clean_table(spark, sf_dir)))[name]


def _stage(name: str) -> Query:
    return lambda spark, sf_dir: C.stage(raw(spark, sf_dir), name)


def _on_clean(fn) -> Query:
    return lambda spark, sf_dir: fn(clean_table(spark, sf_dir))


def _on_view(fn) -> Query:
    return lambda spark, sf_dir: fn(first_view(spark, sf_dir))


REPORTS = ("by_city", "top_areas", "by_hour", "day_night", "by_weather", "severity_distribution", "monthly_trend",
           "peak_hours", "by_road", "yearly", "high_severity_by_city", "weather_severity_cross", "monthly_high")
DASHBOARD_TABLES = ("kpis", "insights", "city_top12", "severity_filtered", "monthly_trend_filtered", "hourly_peaks",
                    "by_weather_filtered", "by_road_filtered", "day_night_dashboard")

QUERIES: dict[str, Query] = {
    # sources / cleaning
    "profile": _on_clean(profile),
    "standardized": _stage("standardized"),
    "deduplicated": _stage("deduplicated"),
    "dropped_critical": _stage("dropped_critical"),
    "filled_nulls": _stage("filled_nulls"),
    "normalized": _stage("normalized"),
    "parsed_dates": _stage("parsed_dates"),
    "parsed_hours": _stage("parsed_hours"),
    "calendar_fields": _stage("calendar_fields"),
    "cast_numerics": _stage("cast_numerics"),
    "clean": clean,
    "serving_frame": serving,
    # filters (F1-F8)
    "filtered": filtered,
    "filter_options": _on_clean(Fl.filter_options),
    "dataset_info": _on_clean(dataset_info),
    "default_view": first_view,
    "explorer": lambda spark, sf_dir: Fl.explorer(filtered(spark, sf_dir)),
    # aggregations (A1-A10) and their dashboard variants
    "by_city": _on_clean(A.accidents_by_city),
    "city_top12": _on_view(A.city_top12),
    "top_areas": _on_clean(A.top_accident_prone_areas),
    "by_hour": _on_clean(A.accidents_by_hour),
    "hourly_peaks": _on_view(A.hourly_peaks),
    "day_night": _on_clean(A.accidents_day_night),
    "day_night_dashboard": _on_view(A.day_night_dashboard),
    "by_weather": _on_clean(A.accidents_by_weather),
    "by_weather_filtered": _on_view(lambda v: A.value_counts(v, "weather_condition")),
    "severity_distribution": _on_clean(A.severity_distribution),
    "severity_filtered": _on_view(lambda v: A.value_counts(v, "severity")),
    "monthly_trend": _on_clean(A.monthly_trend),
    "monthly_trend_filtered": _on_view(A.monthly_trend_filtered),
    "peak_hours": _on_clean(A.peak_accident_hours),
    "by_road": _on_clean(A.accidents_by_road_condition),
    "by_road_filtered": _on_view(lambda v: A.value_counts(v, "road_condition")),
    "yearly": _on_clean(A.yearly_summary),
    "report_grouping_sets": _on_clean(report_grouping_sets),
    # SQL (Q1-Q3)
    "high_severity_by_city": _on_clean(Q.high_severity_by_city),
    "weather_severity_cross": _on_clean(Q.weather_severity_cross),
    "monthly_high": _on_clean(Q.monthly_high),
    # headline figures and insights
    "kpis": _on_view(kpis),
    "insights": _on_view(insights),
    # map (M1-M3)
    "hotspot_points": _on_view(hotspot_points),
    "hotspot_grid": _on_view(hotspot_grid),
    # what users call: files, SQL view, empty selection, first rows, fused report and dashboard
    "csv_round_trip": csv_round_trip,
    "raw_profile": raw_profile,
    "view_sql": view_sql,
    "open_range": open_range,
    "kpis_empty": lambda spark, sf_dir: kpis(nothing(spark, sf_dir)),
    "insights_empty": lambda spark, sf_dir: insights(nothing(spark, sf_dir)),
    "first_rows": _on_clean(lambda c: head(c, 5, "id", "date", "time")),
    **{f"report_{name}": _report(name) for name in REPORTS},
    **{f"summary_{name}": _summary(name) for name in SUMMARY_TABLES},
    **{f"dashboard_{name}": _dashboard(name) for name in DASHBOARD_TABLES},
    # figures kept up to date as loads arrive
    "merged_report": lambda spark, sf_dir: merged_report(_two_loads("report")(spark, sf_dir)),
    "merged_kpis": merged_kpis,
    "merged_dataset_info": lambda spark, sf_dir: sidebar_from_overview(
        merged_overview(_two_loads("overview")(spark, sf_dir)))["dataset_info"],
    # a stored sample and stored sketches, asked instead of the rows
    "sketched_points": lambda spark, sf_dir: points_from_sketch(
        Fl.default_view(points_sketch(prepared_serving(spark, sf_dir)))),
    "pyramid_grid": lambda spark, sf_dir: grid_from_pyramid(grid_pyramid(prepared_serving(spark, sf_dir)), 0.5),
    "pyramid_grid_coarse": lambda spark, sf_dir: grid_from_pyramid(grid_pyramid(prepared_serving(spark, sf_dir)), 16.0),
    "sketched_cities": lambda spark, sf_dir: cities_between(city_sketches(clean_table(spark, sf_dir)), *FILTER_DATES),
    "sidebar_filter_options": _sidebar("filter_options"),
    "sidebar_dataset_info": _sidebar("dataset_info"),
}
