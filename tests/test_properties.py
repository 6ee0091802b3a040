"""Invariants of the operators on the fixture."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mishap.operators import aggregates as A
from mishap.operators.cleaning import serving_frame
from mishap.operators.filters import apply_filters, default_view, filter_options
from mishap.operators.hotspots import hotspot_grid, hotspot_points, sample_key
from mishap.operators.summary import insights, kpis
from mishap.plans import sql as Q
from mishap.plans.report import report_from_fused, report_grouping_sets, run_report
from scripts.check_oracle import rows_of


def _same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    ra, rb = [tuple(r) for r in a.collect()], [tuple(r) for r in b.select(*a.columns).collect()]
    assert rows_of(a.columns, ra) == rows_of(a.columns, rb)


@pytest.mark.parametrize("fn,col", [
    (A.accidents_by_hour, "accident_count"), (A.accidents_day_night, "count"),
    (A.accidents_by_weather, "count"), (A.severity_distribution, "count"), (A.monthly_trend, "accident_count"),
    (A.accidents_by_road_condition, "count"), (A.yearly_summary, "total_accidents"),
    (Q.weather_severity_cross, "count"), (Q.monthly_high, "accidents")])
def test_group_counts_sum_to_rows(clean_small, fn, col):
    total = clean_small.count()
    assert fn(clean_small).agg(F.sum(col)).first()[0] == total


def test_shares_sum_to_100(clean_small):
    for fn in (A.accidents_by_weather, A.severity_distribution):
        assert abs(fn(clean_small).agg(F.sum("percentage")).first()[0] - 100) < 0.1


def test_top_areas_total(clean_small):
    for r in A.top_accident_prone_areas(clean_small).collect():
        assert r.total == r.High + r.Low + r.Medium + r.Other


def test_fused_report_equals_operators(clean_small):
    fused = report_from_fused(report_grouping_sets(clean_small))
    separate = run_report(clean_small)
    assert set(fused) == set(separate)
    for name in separate:
        _same(separate[name], fused[name])


def test_fused_report_via_shared_folder(clean_small):
    stored = run_report(clean_small, fused=True)
    _same(run_report(clean_small)["top_areas"], stored["top_areas"])


def test_filters_commute(clean_small):
    cities, sevs = ["City 1", "City 3"], ["High"]
    rng = (dt.date(2021, 6, 1), "2022-06-30")
    one = apply_filters(clean_small, cities, sevs, rng)
    chained = apply_filters(apply_filters(apply_filters(clean_small, date_range=rng), severities=sevs), cities)
    _same(one, chained)
    assert apply_filters(clean_small, [], [], None) is clean_small
    assert apply_filters(clean_small, date_range=(None, None)) is clean_small


def test_open_ranges_and_a_foreign_year_column(clean_small):
    since = apply_filters(clean_small, date_range=("2022-01-01", None))
    until = apply_filters(clean_small, date_range=("", "2021-12-31"))
    dated = clean_small.where(F.col("date").isNotNull()).count()
    assert 0 < since.count() < dated and since.count() + until.count() == dated
    other = clean_small.withColumn("year", F.lit(1999))          # not the date's year: no row may go for it
    assert apply_filters(other, date_range=("2022-01-01", None)).count() == since.count()


def test_default_view(clean_small):
    view = default_view(serving_frame(clean_small))
    firsts = [r.value for r in filter_options(clean_small).where("field = 'city'").orderBy("value").collect()][:5]
    assert {r.city for r in view.select("city").distinct().collect()} == set(firsts)
    assert view.where(F.col("date").isNull()).count() == 0
    assert view.columns == clean_small.columns


def test_kpis_on_empty_frame(clean_small):
    empty = serving_frame(clean_small).where(F.lit(False))
    k = kpis(empty).collect()
    assert len(k) == 1
    assert k[0].asDict() == {"total": 0, "top_city": None, "top_city_count": 0, "top_weather": None,
                             "high_pct": 0.0, "peak_hour": 0, "peak_hour_label": "00:00"}
    assert insights(empty).count() == 8


def test_kpis_mode_ties_break_on_key(spark):
    df = spark.createDataFrame(
        [("B", "Rain", 5, "High"), ("A", "Rain", 5, "Low"), ("B", "Fog", 7, "Low"), ("A", "Fog", 7, "Low")],
        "city string, weather_condition string, hour int, severity string")
    k = kpis(df).first()
    assert (k.top_city, k.top_city_count, k.top_weather, k.peak_hour, k.high_pct) == ("A", 2, "Fog", 5, 25.0)


def test_hotspot_sample_is_partitioning_independent(clean_small):
    view = default_view(serving_frame(clean_small))
    a = hotspot_points(view.repartition(1), n=100)
    b = hotspot_points(view.repartition(16), n=100)
    assert a.count() == 100
    _same(a, b)


def test_hotspot_sample_matches_brute_force(clean_small):
    pts = clean_small.dropna(subset=["latitude", "longitude"])
    n = 37
    got = hotspot_points(clean_small, n=n, columns=clean_small.columns)
    keyed = pts.withColumn("_k", sample_key(pts)).toPandas()
    want = keyed.sort_values(["_k", "id"]).head(n).drop(columns="_k")
    assert sorted(r.id for r in got.collect()) == sorted(want["id"].tolist())


def test_hotspot_sample_smaller_than_n(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, "Low", "a", None, "Clear")],
                               "id long, latitude float, longitude float, severity string, city string, date date, weather_condition string")
    assert hotspot_points(df).count() == 1
    no_coords = df.drop("latitude")
    assert hotspot_points(no_coords).count() == 0


def test_hotspot_grid_counts_points(clean_small):
    pts = clean_small.dropna(subset=["latitude", "longitude"]).count()
    assert hotspot_grid(clean_small).agg(F.sum("incidents")).first()[0] == pts


@pytest.mark.parametrize("selection", [
    {"first_view": True},
    {"cities": ["City 1", "City 7"], "severities": ["High", "Medium"], "date_range": ("2021-05-01", "2023-02-28")},
])
def test_fused_dashboard_equals_operators(clean_small, selection):
    from mishap.plans.dashboard import dashboard
    fused = dashboard(clean_small, fused=True, **selection)
    separate = dashboard(clean_small, fused=False, **selection)
    assert set(fused) == set(separate)
    for name in separate:
        _same(separate[name], fused[name])


def test_dashboard_on_an_empty_selection(clean_small):
    from mishap.plans.dashboard import dashboard
    board = dashboard(clean_small, cities=["Nowhere"])
    k = board["kpis"].collect()
    assert len(k) == 1 and k[0].total == 0 and k[0].top_city is None and k[0].peak_hour_label == "00:00"
    assert board["insights"].count() == 8
    for name in ("city_top12", "hourly_peaks", "hotspot_points", "hotspot_grid", "explorer", "monthly_trend_filtered"):
        assert board[name].count() == 0, name
    assert board["filter_options"].count() > 0  # options come from the unfiltered table


def test_published_summary_tables(clean_small):
    from mishap.plans.report import summary_tables
    tables = summary_tables(run_report(clean_small))
    assert set(tables) == {"accidents_by_city", "hourly_distribution", "monthly_trend", "road_conditions",
                           "severity_distribution", "weather_breakdown"}
    total = clean_small.count()
    for name, df in tables.items():
        assert len(df.columns) == 2 and df.columns[1] == "count"
        if name != "accidents_by_city":  # a top-15 list
            assert df.agg(F.sum("count")).first()[0] == total, name


def test_shares_round_half_up(spark):
    # Spark's round is HALF_UP on the decimal form; Python's round(6.25, 1) would give 6.2.
    from mishap.functions.columns import share
    r = spark.range(1).select(share(F.lit(1), F.lit(16), 1).alias("a"), share(F.lit(1), F.lit(8), 2).alias("b"),
                              share(F.lit(1), F.lit(0), 2).alias("c")).first()
    assert (r.a, r.b, r.c) == (6.3, 12.5, None)


def test_pivot_levels_are_fixed(spark):
    # A severity outside High/Low/Medium counts as Other; absent levels are 0 columns.
    df = spark.createDataFrame([("A", "High"), ("A", "Critical"), ("A", "Critical"), ("B", "Low")],
                               "city string, severity string")
    rows = {r.city: r.asDict() for r in A.top_accident_prone_areas(df).collect()}
    assert rows["A"] == {"city": "A", "High": 1, "Low": 0, "Medium": 0, "Other": 2, "total": 3}
    assert rows["B"] == {"city": "B", "High": 0, "Low": 1, "Medium": 0, "Other": 0, "total": 1}


def test_dataset_info_exact_and_approximate(clean_small):
    from mishap.operators.summary import dataset_info
    exact = dataset_info(clean_small).first()
    approx = dataset_info(clean_small, approximate=True).first()
    assert exact.total_records == clean_small.count() == approx.total_records
    assert exact.cities == clean_small.select("city").distinct().count()
    assert abs(approx.cities - exact.cities) <= max(1, exact.cities // 20)   # HLL, 5 % default error
    assert (approx.min_date, approx.max_date) == (exact.min_date, exact.max_date)
