"""The stored table's layout from bounds drawn below the dedup: one reduce pass, narrow files, hot places cut."""

import bisect
import datetime as dt

import pytest
from pyspark.sql import functions as F

from mishap.operators.cleaning import clean
from mishap.plans import materialize
from mishap.plans.materialize import laid_out_by, range_bounds, range_number, store_clean
from mishap.plans.registry import raw

from conftest import SF_MID


@pytest.fixture()
def always(monkeypatch):
    monkeypatch.setattr(materialize, "ONE_PASS_BYTES", 0)


def ranges(spark, frame):
    """(smallest, largest) city of each file, from its rows."""
    found = frame.groupBy(F.input_file_name().alias("file")).agg(F.min("city").alias("low"), F.max("city").alias("high"))
    return [(r.low, r.high) for r in found.collect()]


def test_range_number_is_a_bisection(spark):
    for size in (1, 2, 3, 7, 16, 33):
        bounds = [10 * k for k in range(1, size)]
        constant = F.from_json(F.lit(str(bounds)), "array<int>")
        got = spark.range(-5, 10 * size + 5).select("id", range_number(F.col("id").cast("int"), constant, size).alias("n")).collect()
        assert all(r.n == bisect.bisect_right(bounds, r.id) for r in got)


def test_the_dedup_is_reduced_once(spark):
    source = raw(spark, SF_MID)
    plan = laid_out_by(clean(source), source, 16)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "shufflepartitionidpassthrough" in plan
    assert "from_json" not in plan                             # the bounds are a constant
    assert plan.count("Exchange hashpartitioning") == 1


def test_stages_of_a_load(spark, always):
    source = raw(spark, SF_MID)
    context = spark.sparkContext
    context.setJobGroup("one-pass", "one-pass")
    store_clean(clean(source), "one-pass", source)
    context.setJobGroup("two-passes", "two-passes")
    store_clean(clean(source), "two-passes")
    context.setJobGroup("other", "other")
    tracker = context.statusTracker()

    def ran(group):                                            # finished stages by number of tasks over one
        found = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
        return sum(1 for s in found if (info := tracker.getStageInfo(s)) and info.numCompletedTasks)
    assert len(tracker.getJobIdsForGroup("one-pass")) <= len(tracker.getJobIdsForGroup("two-passes")) + 2
    assert ran("one-pass") > 0


def test_same_rows_and_narrow_files(spark, always):
    source = raw(spark, SF_MID)
    df = clean(source)
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        stored = store_clean(df, "narrow", source)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert stored.columns == df.columns
    assert stored.exceptAll(df).count() == 0 and df.exceptAll(stored).count() == 0
    found = [r for r in ranges(spark, stored) if r[0] is not None]
    assert len(found) >= 20 and sum(low <= "City 12" <= high for low, high in found) <= len(found) / 4


def test_hot_city_and_copies(spark):
    """A city with two thirds of the rows is cut; a row copied many times is drawn as one."""
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.concat(F.lit("c"), "id")).otherwise("hot").alias("city"),
        F.lit("2022-01-01").alias("date"), F.lit("High").alias("severity"))
    copies = rows.where("id = 7").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20000)))).drop("n")
    source = rows.unionByName(copies)
    dealt = laid_out_by(clean(source), source, 16)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 3000 and len(sizes) >= 12 and max(sizes) < 600


def test_null_keys_few_rows_and_none(spark, always):
    schema = "id long, city string, date string, severity string"
    rows = [(None, "a", "2022-01-01", "High"), (1, "b", "bad", "Low"), (1, "b", "bad", "Low"), (2, "c", "2021-05-05", "Low")]
    source = spark.createDataFrame(rows, schema)
    stored = store_clean(clean(source), "few", source)
    assert sorted((r.city, r.id, r.date) for r in stored.collect()) == [
        ("A", None, dt.date(2022, 1, 1)), ("B", 1, None), ("C", 2, dt.date(2021, 5, 5))]
    empty = spark.createDataFrame([], schema)
    assert range_bounds(empty, 8, ["year", "city", "date", "id"]) is None
    assert store_clean(clean(empty), "none", empty).count() == 0


def rows_read(frame):
    """Rows that the scan under a filter gave up."""
    frame.collect()
    scan = frame._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return scan.metrics().apply("numOutputRows").value()


def test_point_filters_skip_row_groups(spark):
    """Every row group spans nearly all ids and cities; Bloom filters tell which hold a value, ranges can't."""
    from mishap.plans.materialize import load, point_filters, store_path
    rows = spark.range(0, 200_000, 2).select(
        "id", F.concat(F.lit("Place "), F.pmod(F.xxhash64("id"), F.lit(50_000))).alias("city"), F.to_date(F.lit("2022-01-01")).alias("date"))
    dealt = rows.repartition(8, "id")
    plain, filtered = (load(spark, store_path(dealt, name, options=options))
                       for name, options in (("plain", None), ("bloom", point_filters(rows))))
    absent, there = F.col("id") == 100_001, F.col("id") == 100_000
    assert rows_read(plain.where(absent)) == 100_000 and rows_read(filtered.where(absent)) <= 25_000
    assert rows_read(filtered.where(there)) <= 40_000 and filtered.where(there).count() == 1
    place = F.col("city") == "Place 17"
    assert filtered.where(place).count() == plain.where(place).count()
    assert rows_read(filtered.where(place)) < rows_read(plain.where(place))
