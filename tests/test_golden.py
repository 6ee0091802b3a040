"""Golden values: marginal tables published with the original 7,500-row dataset.

The counts below are FIXED VALUES (the six published summary tables).  Each
marginal is expanded back into rows (``sequence`` + ``explode``) and run
through the operators; the expected figures are the survey's roll-ups.
"""

import pytest
from pyspark.sql import functions as F

from mishap.operators import aggregates as A
from mishap.operators.summary import insights

# --- fixed values: published marginal counts (value, count) ---
CITY = [("New York", 1137), ("Los Angeles", 1012), ("Chicago", 719), ("Houston", 614), ("Dallas", 550),
        ("Phoenix", 450), ("Philadelphia", 397), ("Indianapolis", 381), ("San Antonio", 369),
        ("San Diego", 355), ("Austin", 311), ("Charlotte", 309), ("Columbus", 309), ("San Jose", 302),
        ("Jacksonville", 285)]
HOUR = [(0, 84), (1, 59), (2, 78), (3, 80), (4, 68), (5, 152), (6, 318), (7, 465), (8, 437), (9, 358),
        (10, 353), (11, 400), (12, 512), (13, 421), (14, 285), (15, 330), (16, 415), (17, 487), (18, 545),
        (19, 527), (20, 378), (21, 352), (22, 234), (23, 162)]
MONTH = [("2021-01", 192), ("2021-02", 188), ("2021-03", 238), ("2021-04", 208), ("2021-05", 209),
         ("2021-06", 228), ("2021-07", 196), ("2021-08", 214), ("2021-09", 197), ("2021-10", 221),
         ("2021-11", 215), ("2021-12", 207), ("2022-01", 218), ("2022-02", 190), ("2022-03", 188),
         ("2022-04", 216), ("2022-05", 226), ("2022-06", 210), ("2022-07", 215), ("2022-08", 201),
         ("2022-09", 199), ("2022-10", 209), ("2022-11", 191), ("2022-12", 191), ("2023-01", 218),
         ("2023-02", 212), ("2023-03", 210), ("2023-04", 208), ("2023-05", 226), ("2023-06", 226),
         ("2023-07", 198), ("2023-08", 216), ("2023-09", 199), ("2023-10", 211), ("2023-11", 208),
         ("2023-12", 201)]
ROAD = [("Dry", 3721), ("Wet", 1871), ("Slippery", 773), ("Icy", 751), ("Under Construction", 384)]
SEVERITY = [("Low", 3039), ("Medium", 2984), ("High", 1477)]
WEATHER = [("Clear", 3385), ("Rain", 1891), ("Fog", 739), ("Snow", 602), ("Cloudy", 513), ("Hail", 227),
           ("Windy", 143)]


def expand(spark, pairs, col, dtype="string"):
    df = spark.createDataFrame(pairs, f"{col} {dtype}, n int")
    return df.select(col, F.explode(F.sequence(F.lit(1), F.col("n"))).alias("_i")).drop("_i")


@pytest.mark.parametrize("pairs", [CITY, HOUR, MONTH, ROAD, SEVERITY, WEATHER])
def test_each_table_totals_7500(pairs):
    assert sum(n for _, n in pairs) == 7500


def test_severity_shares(spark):
    out = {r.severity: (r["count"], r.percentage) for r in A.severity_distribution(expand(spark, SEVERITY, "severity")).collect()}
    assert out == {"Low": (3039, 40.52), "Medium": (2984, 39.79), "High": (1477, 19.69)}


def test_hours_day_night_and_peaks(spark):
    df = expand(spark, HOUR, "hour", "int")
    assert {r.hour: r.accident_count for r in A.accidents_by_hour(df).collect()} == dict(HOUR)
    assert {r.period: r["count"] for r in A.accidents_day_night(df).collect()} == {"Day": 4781, "Night": 2719}
    assert [r.hour for r in A.peak_accident_hours(df).collect()] == [18, 19, 12, 17, 7]
    peaks = {r.hour for r in A.hourly_peaks(df).collect() if r.is_peak}
    assert peaks == {7, 8, 17, 18, 19}


def test_city_top_k_tie_breaks_on_name(spark):
    df = expand(spark, CITY, "city")
    top12 = [r.city for r in A.accidents_by_city(df, 12).collect()]
    assert top12[0] == "New York" and top12[-1] == "Charlotte" and "Columbus" not in top12
    assert [r.accident_count for r in A.accidents_by_city(df).collect()] == sorted([n for _, n in CITY], reverse=True)


def test_years_and_trend(spark):
    df = (expand(spark, MONTH, "month_year")
          .withColumns({"year": F.substring("month_year", 1, 4).cast("int"), "city": F.lit("X"),
                        "severity": F.lit("Low"), "hour": F.lit(12), "weather_condition": F.lit("Clear"),
                        "road_condition": F.lit("Dry"), "num_vehicles": F.lit(2)}))
    years = {r.year: r.total_accidents for r in A.yearly_summary(df).collect()}
    assert years == {2021: 2513, 2022: 2454, 2023: 2533}
    trend = {r.insight: (r.subject, r.value) for r in insights(df).collect()}["trend"]
    assert trend == ("increasing", 20.0)


def test_weather_and_road(spark):
    w = A.accidents_by_weather(expand(spark, WEATHER, "weather_condition")).collect()
    assert [(r.weather_condition, r["count"]) for r in w] == WEATHER
    assert abs(sum(r.percentage for r in w) - 100) < 0.05
    road = A.accidents_by_road_condition(expand(spark, ROAD, "road_condition")).collect()
    assert [(r.road_condition, r["count"]) for r in road] == ROAD
