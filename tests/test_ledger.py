"""Loads added one after the other equal one load of everything."""

import pytest
from pyspark.sql import functions as F

from mishap.operators.cleaning import clean
from mishap.operators.summary import dataset_info, kpis, insights, kpis_from_summary, insights_from_summary, summary_from_counts
from mishap.plans.dashboard import sidebar_from_overview
from mishap.plans.ledger import Ledger, counts_from_report, fingerprints, unseen
from mishap.plans.registry import raw
from mishap.plans.report import report_from_fused, report_grouping_sets, run_report
from mishap.operators.filters import filter_options

from conftest import SF_SMALL


def rows(frame):
    return sorted(map(repr, map(tuple, frame.select(*sorted(frame.columns)).collect())))


@pytest.fixture(scope="module")
def ledger(spark):
    """Three loads that overlap: rows of the second are in the first and third too."""
    found, source = Ledger.create(spark), raw(spark, SF_SMALL)
    found.add(source.where("id % 3 <> 0"))
    found.add(source.where("id % 3 <> 1"))
    found.add(source.where("id % 2 = 0").select(*reversed(source.columns)))
    return found


def test_every_report_equals_one_load(spark, ledger):
    whole = run_report(clean(raw(spark, SF_SMALL)))
    for name, frame in report_from_fused(ledger.report()).items():
        assert rows(frame) == rows(whole[name]), name
    assert rows(ledger.report()) == rows(report_grouping_sets(clean(raw(spark, SF_SMALL))))


def test_headline_figures_and_sidebar(spark, ledger):
    df = clean(raw(spark, SF_SMALL))
    summary = summary_from_counts(counts_from_report(ledger.report()))
    assert rows(kpis_from_summary(summary)) == rows(kpis(df)) and rows(insights_from_summary(summary)) == rows(insights(df))
    sidebar = sidebar_from_overview(ledger.overview())
    assert rows(sidebar["dataset_info"]) == rows(dataset_info(df)) and rows(sidebar["filter_options"]) == rows(filter_options(df))


def test_only_the_new_rows_are_read(spark, ledger):
    """Results read no row of any load; a load of known rows adds none."""
    for frame in (ledger.report(), ledger.overview()):
        assert all("/clean/" not in f and "events.parquet" not in f for f in frame.inputFiles())
    seen = ledger.table("seen", fingerprints(raw(spark, SF_SMALL)).schema)
    assert unseen(raw(spark, SF_SMALL), seen).where("city is not null and date is not null and severity is not null").count() == 0


def test_a_broken_load_does_not_count(spark):
    found = Ledger.create(spark)
    source = raw(spark, SF_SMALL)
    found.add(source.where("id < 100"))
    before = rows(found.report())
    clean(source).write.parquet(f"{found.path}/report/broken")            # a load that broke off
    assert rows(found.report()) == before and len(found.loads()) == 1


def test_nulls_are_told_apart_and_an_empty_ledger(spark):
    found = Ledger.create(spark)
    assert found.report().count() == 0 and found.overview().count() == 0
    schema = "id long, city string, date string, severity string, weather string, road_type string, time string, vehicle_count int"
    one, other = (1, "a", "2022-01-01", "High", None, "x", "08:00", 1), (1, "a", "2022-01-01", "High", "x", None, "08:00", 1)
    found.add(spark.createDataFrame([one], schema))
    found.add(spark.createDataFrame([other, one], schema))
    assert found.overview().where("dim = 'city'").agg(F.sum("n")).first()[0] == 2
