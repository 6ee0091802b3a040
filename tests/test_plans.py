"""Physical-plan checks: no Python in the plans, pushdown, pruning, top-k, one scan."""

import os
import re

import pytest

from mishap.operators import aggregates as A
from mishap.operators.cleaning import serving_frame
from mishap.operators.filters import apply_filters
from mishap.plans.registry import QUERIES
from mishap.plans.report import report_grouping_sets

from conftest import SF_MID, SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "PythonUDF", "MapInArrow")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_worker(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert not any(node in text for node in PYTHON_NODES), name


def test_filters_reach_the_parquet_scan(stored_clean):
    df = apply_filters(serving_frame(stored_clean), ["City 1", "City 2"], ["High"], ("2022-01-01", "2022-12-31"),
                       year_folders=True)
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = re.search(r"PushedFilters: \[(.*?)\]\n", text)[1]
    for one in ("In(city, [City 1,City 2])", "EqualTo(severity,High)", "GreaterThanOrEqual(date,2022-01-01)",
                "LessThanOrEqual(date,2022-12-31)"):
        assert one in pushed, one


def test_date_range_prunes_year_partitions(stored_clean):
    df = apply_filters(stored_clean, date_range=("2022-01-01", "2022-12-31"), year_folders=True)
    assert {r.year for r in df.select("year").distinct().collect()} == {2022}
    folders = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan(df))[1]
    assert ">= 2022)" in folders and "<= 2022)" in folders


def test_projection_is_pruned(stored_clean):
    text = plan(A.accidents_by_road_condition(stored_clean))
    assert "ReadSchema: struct<road_condition:string>" in text


def test_top_k_is_take_ordered(stored_clean):
    assert "TakeOrderedAndProject" in plan(A.accidents_by_city(stored_clean))


def test_share_scans_once(stored_clean):
    df = A.accidents_by_weather(stored_clean)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    # Every "Initial Plan" section (main query and the total's subquery) lists
    # one scan; the final plans run one scan and reuse its exchange.
    assert text.count("FileScan parquet") - text.count("== Initial Plan ==") == 1
    assert "ReusedExchange" in text


def test_fused_report_is_one_scan(stored_clean):
    text = plan(report_grouping_sets(stored_clean))
    assert "Expand" in text and text.count("Scan parquet") == 1


def test_prepare_stores_clean_once_and_forget_removes_it(spark):
    from mishap.plans import registry as R
    a = R.prepare(spark, SF_SMALL)
    b = R.prepare(spark, SF_SMALL)
    assert a.inputFiles() == b.inputFiles()
    assert a.columns == R.clean(spark, SF_SMALL).columns
    assert a.count() == R.clean(spark, SF_SMALL).count()
    assert R.clean_table(spark, SF_SMALL).inputFiles() == a.inputFiles()
    folder = a.inputFiles()[0].replace("file://", "").split("/year=")[0]
    assert os.path.isdir(folder)
    R.forget(spark, SF_SMALL)
    assert not os.path.exists(folder) and "events.parquet" in R.clean_table(spark, SF_SMALL).inputFiles()[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"csv_round_trip"}))
def test_building_a_query_runs_no_job(spark, name):
    group = f"build-{name}"
    spark.sparkContext.setJobGroup(group, group)
    QUERIES[name](spark, SF_SMALL)
    # Spark itself lists and reads one footer to learn the schema of a Parquet table
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= 1


def test_stored_clean_files_cover_few_places(spark):
    import pyarrow.parquet as pq
    from mishap.plans.materialize import CLEAN_PARTITIONS, laid_out, store
    from mishap.plans.registry import clean
    stored = store(laid_out(clean(spark, SF_MID), 24), "layout-test", CLEAN_PARTITIONS)
    ranges = []
    for path in stored.inputFiles():
        meta = pq.ParquetFile(path.replace("file://", "")).metadata
        for g in range(meta.num_row_groups):
            column = next(c for c in map(meta.row_group(g).column, range(meta.num_columns)) if c.path_in_schema == "city")
            ranges.append((column.statistics.min, column.statistics.max))
    admit = [r for r in ranges if r[0] is not None and r[0] <= "City 12" <= r[1]]
    assert len(ranges) >= 20 and len(admit) <= len(ranges) / 4
    assert stored.count() == clean(spark, SF_MID).count()


def test_null_filter_sits_below_the_dedup_with_metrics(spark, tmp_path):
    from mishap.operators.cleaning import clean_observed
    from mishap.sources.fixture import raw_incidents
    path = str(tmp_path / "raw")
    raw_incidents(spark, SF_SMALL).write.parquet(path)
    df, metrics = clean_observed(spark.read.parquet(path))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Aggregate") < text.index("Filter")          # printed root first
    n = df.count()
    counts = metrics.as_dict(n)
    assert counts["raw_rows"] == counts["incomplete_rows"] + counts["duplicates_removed"] + n


def test_sample_has_no_join_and_no_window(stored_clean):
    from mishap.operators.hotspots import hotspot_points
    text = plan(hotspot_points(serving_frame(stored_clean)))
    assert "Join" not in text and "Window" not in text and "TakeOrderedAndProject" in text


def test_load_width(spark):
    from mishap.plans.registry import raw
    from mishap.plans.sizing import SPLIT, load_width, partitions_for, plan_bytes, split_bytes_for
    assert partitions_for(100 * 2**40, 8) == 51_200          # 100 TiB at 2 GiB per partition
    assert split_bytes_for(100 * 2**40) > 2**31 and split_bytes_for(10**9) == 128 * 2**20
    assert partitions_for(10, 8) == 8
    df = raw(spark, SF_SMALL)
    assert plan_bytes(df) > 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with load_width(df) as width:                    # small input: explicit width kept
        assert width == max(int(before), spark.sparkContext.defaultParallelism)
    with load_width(df, target=1024) as width:       # tiny target: widened inside the block only
        assert width > int(before) and spark.conf.get("spark.sql.shuffle.partitions") == str(width)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before and spark.conf.get(SPLIT)
