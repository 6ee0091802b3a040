"""Skew: one city holding a third of all rows, one raw row repeated many times.

Results must stay whole and exact; the plans must combine map-side (partial
aggregation) so no hot key gathers in one task before the shuffle.
"""

import pytest
from pyspark.sql import functions as F

from mishap.operators import aggregates as A
from mishap.operators.cleaning import clean, serving_frame
from mishap.operators.hotspots import hotspot_grid, hotspot_points
from mishap.operators.summary import kpis
from mishap.plans.registry import raw
from mishap.plans.report import report_from_fused, report_grouping_sets

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def skewed_raw(spark):
    base = raw(spark, SF_SMALL)
    n = base.count()
    # one exact raw row repeated as many times as half the table ...
    dup = (base.where(F.col("id") == 7).limit(1)
               .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(n // 2)))).select(*base.columns))
    # ... and a third of all distinct rows moved to one city
    hot = base.select(*[F.lit("  hot city ").alias(c) if c == "accident_location" else
                        (F.col("id") + 10_000_000).alias(c) if c == "id" else F.col(c) for c in base.columns])
    return base.unionByName(dup).unionByName(hot.limit(n // 2))


def test_hot_duplicate_collapses_and_hot_city_counts(spark, skewed_raw):
    df = clean(skewed_raw).cache()
    base = clean(raw(spark, SF_SMALL))
    hot_rows = df.where(F.col("city") == "Hot City").count()
    assert df.count() == base.count() + hot_rows  # the repeated row left exactly one copy
    top = A.accidents_by_city(df, 1).first()
    assert (top.city, top.accident_count) == ("Hot City", hot_rows)
    assert hot_rows >= df.count() / 3


def test_partial_aggregation_before_every_shuffle(skewed_raw):
    df = clean(skewed_raw)
    for out, partial in ((A.accidents_by_city(df), "partial_count"), (report_grouping_sets(df), "partial_count"),
                         (hotspot_grid(df), "partial_count"), (df, "functions=[]")):
        below = None
        for line in out._jdf.queryExecution().executedPlan().toString().splitlines():
            if below:                                  # the node right under a hash exchange
                assert "HashAggregate(" in line and partial in line, (below, line)
                partial = "functions=[]"               # further down is the dedup's own map-side step
            below = line if "Exchange hashpartitioning" in line else None


def test_hot_city_is_cut_into_many_ranges(spark):
    from mishap.plans.materialize import laid_out
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.concat(F.lit("c"), "id")).otherwise("hot").alias("city"),
                                    F.to_date(F.lit("2022-01-01")).alias("date"), F.lit(2022).alias("year"))
    sizes = [r["count"] for r in laid_out(rows, 16).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 600


def test_fused_report_and_kpis_under_skew(skewed_raw):
    df = clean(skewed_raw).cache()
    fused = report_from_fused(report_grouping_sets(df))
    direct = {r.city: r.accident_count for r in A.accidents_by_city(df).collect()}
    assert {r.city: r.accident_count for r in fused["by_city"].collect()} == direct
    k = kpis(serving_frame(df)).first()
    assert k.top_city == "Hot City" and k.total == df.count()


def test_sample_under_skew(skewed_raw):
    df = clean(skewed_raw)
    with_coords = df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).count()
    assert hotspot_points(df).count() == min(2000, with_coords)
    small = hotspot_points(df, n=300)
    assert small.count() == 300 and small.where(F.col("city") == "Hot City").count() > 0
