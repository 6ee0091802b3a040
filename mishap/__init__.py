"""mishap: Spark-native analytics for flat incident tables.

Raw files with inconsistent headers -> a typed clean table -> grouped
counts, shares, top-k lists, headline figures, insights, map samples and
grids, as lazy DataFrames.  Every operator takes and returns a DataFrame and
runs no job of its own; the caller collects or writes.
"""

from mishap.operators.aggregates import (  # noqa: F401
    accidents_by_city, accidents_by_hour, accidents_by_road_condition, accidents_by_weather,
    accidents_day_night, city_top12, day_night_dashboard, hourly_peaks, monthly_trend,
    monthly_trend_filtered, peak_accident_hours, severity_distribution, top_accident_prone_areas,
    value_counts, yearly_summary,
)
from mishap.operators.cleaning import clean, clean_observed, serving_frame, standardize_column_names  # noqa: F401
from mishap.operators.filters import apply_filters, default_view, explorer, filter_options  # noqa: F401
from mishap.operators.hotspots import hotspot_grid, hotspot_points  # noqa: F401
from mishap.operators.profile import profile  # noqa: F401
from mishap.operators.summary import dataset_info, insights, kpis  # noqa: F401
from mishap.plans.dashboard import dashboard, selection  # noqa: F401
from mishap.plans.materialize import store, store_clean  # noqa: F401
from mishap.plans.report import report_grouping_sets, run_report  # noqa: F401
from mishap.plans.sql import high_severity_by_city, monthly_high, register_view, weather_severity_cross  # noqa: F401
from mishap.sinks.writers import write_clean, write_csv, write_filtered_csv, write_report  # noqa: F401
from mishap.sources.csv import read_clean, read_incidents_csv  # noqa: F401
