"""Fixed values of the incident model.

Everything in this module is a FIXED VALUE: it must stay equal to the
behaviour being rebuilt (header aliases, date formats, label texts, peak
hours, sample size and seed), so results match.  Nothing here is logic.
"""

from __future__ import annotations

# --- fixed values: raw header alias -> standard column name (first alias wins) ---
COLUMN_ALIASES: dict[str, str] = {
    "location": "city",
    "accident_location": "city",
    "place": "city",
    "accident_date": "date",
    "accident_time": "time",
    "accident_severity": "severity",
    "weather": "weather_condition",
    "road_type": "road_condition",
    "vehicles_involved": "num_vehicles",
    "vehicle_count": "num_vehicles",
    "lat": "latitude",
    "lon": "longitude",
    "lng": "longitude",
}

# --- fixed values: column contract ---
REQUIRED_COLUMNS: tuple[str, ...] = (
    "city", "date", "time", "severity", "weather_condition", "road_condition", "num_vehicles",
)
CRITICAL_COLUMNS: tuple[str, ...] = ("city", "date", "severity")
CATEGORICAL_FILL_COLUMNS: tuple[str, ...] = ("weather_condition", "road_condition")
CATEGORICAL_COLUMNS: tuple[str, ...] = ("city", "severity", "weather_condition", "road_condition")
COORDINATE_COLUMNS: tuple[str, ...] = ("latitude", "longitude")
UNKNOWN = "Unknown"
DEFAULT_VEHICLES = 1

# --- fixed values: date formats, tried in this order on the original text ---
DATE_FORMATS: tuple[str, ...] = ("yyyy-MM-dd", "MM/dd/yyyy", "dd-MM-yyyy", "yyyy/MM/dd")
MONTH_FORMAT = "yyyy-MM"

# --- fixed values: severities and periods ---
HIGH = "High"
SEVERITY_LEVELS: tuple[str, ...] = ("High", "Low", "Medium")
OTHER_LEVEL = "Other"
DAY_START_HOUR = 6
NIGHT_START_HOUR = 18
DAY, NIGHT = "Day", "Night"
DASHBOARD_DAY, DASHBOARD_NIGHT = "Day (6AM–6PM)", "Night (6PM–6AM)"
PEAK_HOURS: tuple[int, ...] = (7, 8, 17, 18, 19)

# --- fixed values: top-k sizes, map sample and trend labels ---
TOP_CITIES = 15
TOP_CITIES_DASHBOARD = 12
TOP_AREAS = 5
TOP_PEAK_HOURS = 5
TOP_HIGH_SEVERITY_CITIES = 10
TOP_INSIGHT_CITIES = 5
DEFAULT_VIEW_CITIES = 5
MAP_SAMPLE_SIZE = 2000
MAP_SAMPLE_SEED = 42
TREND_UP = "increasing"
TREND_FLAT = "stable or decreasing"

# --- fixed values: explorer / export projection ---
EXPLORER_COLUMNS: tuple[str, ...] = (
    "city", "date", "time", "severity", "weather_condition", "road_condition", "num_vehicles", "hour",
)
HOTSPOT_COLUMNS: tuple[str, ...] = ("latitude", "longitude", "severity", "city", "date", "weather_condition")
