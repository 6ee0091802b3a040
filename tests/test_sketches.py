"""Stored sketches answer as the rows do: the map sample exactly, distinct counts within their error."""

import pytest
from pyspark.sql import functions as F

from mishap.operators.cleaning import serving_frame
from mishap.operators.filters import apply_filters, default_view
from mishap.operators.hotspots import grid_from_pyramid, grid_pyramid, hotspot_grid, hotspot_points, merge_sketches, points_from_sketch, points_sketch
from mishap.operators.summary import cities_between, city_sketches, merge_city_sketches
from mishap.plans.materialize import store


def rows(frame):
    return sorted(map(repr, map(tuple, frame.collect())))


def test_sample_of_selections(spark, stored_clean):
    frame = serving_frame(stored_clean)
    for n in (5, 300):
        sketch = store(points_sketch(frame, n), "points-sketch")
        assert sketch.groupBy("city", "severity", "year", "month").count().agg(F.max("count")).first()[0] <= n
        for chosen in (lambda df: df, default_view, lambda df: apply_filters(df, ["City 1", "City 7"], ["High"]),
                       lambda df: df.where("year = 2022 and month in (3, 4)"), lambda df: df.where("city = 'none'")):
            got = points_from_sketch(chosen(sketch), n)
            assert rows(got) == rows(hotspot_points(chosen(frame), n))
            assert all("points-sketch" in f for f in got.inputFiles())        # no row of the table is read


def test_sketches_of_loads_merge(spark, stored_clean):
    frame = serving_frame(stored_clean)
    parts = [points_sketch(frame.where(f"id % 3 = {k}"), 40) for k in range(3)]
    merged = merge_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]), 40)
    assert rows(merged) == rows(points_sketch(frame, 40))


def test_a_hot_group_is_cut_into_parts(spark):
    hot = spark.range(20000).select(
        "id", F.lit("hot").alias("city"), F.lit("High").alias("severity"), F.lit(2022).alias("year"), F.lit(1).alias("month"),
        F.to_date(F.lit("2022-01-01")).alias("date"), F.lit(1.0).cast("float").alias("latitude"),
        F.lit(2.0).cast("float").alias("longitude"), F.lit("Clear").alias("weather_condition"))
    sketch = points_sketch(hot, 50)
    assert sketch.count() == 50 and rows(points_from_sketch(sketch, 50)) == rows(hotspot_points(hot, 50))
    assert rows(sketch.select("id")) == rows(points_sketch(hot.repartition(7), 50).select("id"))


def test_distinct_cities_of_date_ranges(spark, stored_clean):
    sketches = store(city_sketches(stored_clean), "city-sketches")
    for first, last in ((None, None), ("2022-03-01", None), (None, "2022-02-01"), ("2022-03-01", "2022-03-04"), ("1999-01-01", "1999-02-01")):
        chosen = stored_clean.where(F.col("date") >= F.lit(first or "0001-01-01").cast("date")).where(
            F.col("date") <= F.lit(last or "9999-01-01").cast("date")) if first or last else stored_clean
        want = chosen.agg(F.count("*"), F.count_distinct("city"), F.min("date"), F.max("date")).first()
        assert tuple(cities_between(sketches, first, last).first()) == tuple(want)


def test_error_and_merging_of_many_cities(spark):
    many = spark.range(200_000).select(F.concat(F.lit("c"), F.col("id") % 60_000).alias("city"),
                                       F.expr("date_add(date'2022-01-01', cast(id % 50 as int))").alias("date"))
    halves = [city_sketches(many.where(f"id % 2 = {k}")) for k in (0, 1)]
    one = cities_between(city_sketches(many)).first()
    two = cities_between(merge_city_sketches(halves[0].unionByName(halves[1]))).first()
    for found in (one, two):
        assert found.total_records == 200_000 and abs(found.cities - 60_000) < 0.02 * 60_000


def test_one_pyramid_gives_every_zoom(spark, stored_clean):
    pyramid = store(grid_pyramid(stored_clean), "pyramid")
    for step in (1 / 128, 1 / 16, 0.5, 1.0, 8.0, 64.0, 1024.0):
        got = grid_from_pyramid(pyramid, step)
        want = hotspot_grid(stored_clean, step)
        assert got.columns == want.columns and rows(got) == rows(want)
    with pytest.raises(ValueError):
        grid_from_pyramid(pyramid, 0.3)


def test_pyramid_of_odd_coordinates(spark):
    points = [(0.0, 0.0), (-0.001, 0.001), (89.9, -180.0), (-90.0, 180.0), (-0.0078125, 0.0078125), (1e12, 5.0), (3.0, None)]
    frame = spark.createDataFrame([(a, b, "High") for a, b in points], "latitude float, longitude float, severity string")
    pyramid = grid_pyramid(frame)
    assert pyramid.where("cell is null").first().incidents == 1 and pyramid.agg(F.sum("incidents")).first()[0] == 6
    usual = frame.where("latitude < 1000")
    for step in (1 / 128, 0.25, 32.0):
        assert rows(grid_from_pyramid(pyramid, step)) == rows(hotspot_grid(usual, step))
