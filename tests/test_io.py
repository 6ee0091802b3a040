"""Sources and sinks: CSV in, CSV/Parquet out, round trips."""

import os
import tempfile

import pytest
from pyspark.errors import AnalysisException

from mishap.operators.cleaning import clean
from mishap.operators.filters import explorer
from mishap.plans.report import run_report
from mishap.sinks.writers import write_clean, write_csv, write_filtered_csv, write_report
from mishap.sources.csv import read_clean, read_incidents_csv

CSV = """ID,Location,Accident_Date,accident_time,Accident_Severity,Weather,Road_Type,Vehicle_Count,Lat,Lng
1," new york ",2021-01-05,08:30,high,rain,wet,2,40.7,-74.0
1," new york ",2021-01-05,08:30,high,rain,wet,2,40.7,-74.0
2,"Austin, TX",01/06/2021,17:45,Low,,dry,,30.2,-97.7
3,chicago,06-01-2021,bad,medium,fog,,x,,
"""


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="mishap-io-")


def test_csv_source_and_clean(spark, tmp):
    path = os.path.join(tmp, "raw.csv")
    with open(path, "w") as fh:
        fh.write(CSV)
    raw = read_incidents_csv(spark, path)
    assert all(t == "string" for _, t in raw.dtypes)
    out = {r.id: r for r in clean(raw).collect()}
    assert set(out) == {1, 2, 3}
    assert out[1].city == "New York" and out[1].hour == 8 and out[1].num_vehicles == 2
    assert out[2].city == "Austin, Tx" and out[2].weather_condition == "Unknown" and out[2].num_vehicles == 1
    assert str(out[3].date) == "2021-01-06" and out[3].hour is None and out[3].num_vehicles is None


def test_missing_path_raises(spark, tmp):
    with pytest.raises(AnalysisException):
        read_incidents_csv(spark, os.path.join(tmp, "nope.csv")).collect()


def test_csv_round_trip(clean_small, tmp):
    view = explorer(clean_small)
    path = write_filtered_csv(clean_small, os.path.join(tmp, "filtered"))
    back = read_incidents_csv(clean_small.sparkSession, path)
    assert back.columns == view.columns and back.count() == view.count()
    one = write_csv(view.limit(10), os.path.join(tmp, "one"), single_file=True)
    assert len([f for f in os.listdir(one) if f.endswith(".csv")]) == 1


def test_clean_table_round_trip(clean_small, tmp):
    path = write_clean(clean_small, os.path.join(tmp, "clean"))
    assert any(d.startswith("year=") for d in os.listdir(path))
    back = read_clean(clean_small.sparkSession, path).select(*clean_small.columns)
    assert back.exceptAll(clean_small).count() == 0 and clean_small.exceptAll(back).count() == 0


def test_write_report(clean_small, tmp):
    report = run_report(clean_small)
    paths = write_report(report, os.path.join(tmp, "report"))
    assert set(paths) == set(report)
    back = read_incidents_csv(clean_small.sparkSession, paths["by_road"], infer_schema=True)
    assert back.count() == report["by_road"].count()


OTHER_LAYOUT = """accident_severity,place,date,time,weather_condition,road_condition,num_vehicles,id
LOW,boston,2022-02-02,09:15,snow,icy,3,10
"""


def test_mixed_header_layouts(spark, tmp):
    from mishap.sources.csv import read_incident_layouts
    a, b = os.path.join(tmp, "a"), os.path.join(tmp, "b")
    os.makedirs(a), os.makedirs(b)
    with open(os.path.join(a, "1.csv"), "w") as fh:
        fh.write(CSV)
    with open(os.path.join(b, "2.csv"), "w") as fh:
        fh.write(OTHER_LAYOUT)
    # One read over both layouts fails instead of misaligning columns.
    with pytest.raises(Exception):
        read_incidents_csv(spark, [os.path.join(a, "1.csv"), os.path.join(b, "2.csv")]).collect()
    both = clean(read_incident_layouts(spark, [a, b]))
    out = {r.id: r for r in both.collect()}
    assert set(out) == {1, 2, 3, 10}
    assert (out[10].city, out[10].severity, out[10].hour, out[10].latitude) == ("Boston", "Low", 9, None)


def test_command_line_report(spark, tmp):
    from mishap.__main__ import main
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as fh:
        fh.write(CSV)
    summary = main(["report", "--input", src, "--output", os.path.join(tmp, "out")])
    assert summary["rows"] == {"raw_rows": 4, "incomplete_rows": 0, "duplicates_removed": 1, "clean_rows": 3,
                               "malformed_rows": 0}
    back = read_incidents_csv(spark, summary["tables"]["top_areas"], infer_schema=True)
    assert back.count() == 3 and set(back.columns) == {"city", "High", "Low", "Medium", "Other", "total"}
    sev = read_incidents_csv(spark, summary["tables"]["summaries/severity_distribution"], infer_schema=True)
    assert sorted((r.severity, r["count"]) for r in sev.collect()) == [("High", 1), ("Low", 1), ("Medium", 1)]
    dash = main(["dashboard", "--input", src, "--output", os.path.join(tmp, "dash"), "--severity", "High",
                 "--export-clean"])
    exported = read_clean(spark, os.path.join(tmp, "dash", "clean"))
    assert exported.count() == 3 and "year" in exported.columns
    kp = read_incidents_csv(spark, dash["tables"]["kpis"], infer_schema=True).first()
    assert kp.total == 1 and kp.top_city == "New York"


def test_free_form_sql_on_registered_view(clean_small):
    from mishap.plans.sql import register_view
    name = register_view(clean_small, "accidents_test")
    got = clean_small.sparkSession.sql(f"SELECT count(*) AS n FROM {name} WHERE severity = 'High'").first().n
    assert got == clean_small.where("severity = 'High'").count()


BROKEN = """id,city,date,time,severity,weather_condition,road_condition,num_vehicles
1,"two
lines",2022-01-05,08:30,High,rain,wet,2.0
2,Plain,2022-01-06,09:30,Low,fog,dry,3
3,Extra,2022-01-07,10:30,Low,fog,dry,1,surplus
"""


def test_quoted_line_breaks_and_malformed_rows(spark, tmp, capsys):
    from mishap.__main__ import main
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as fh:
        fh.write(BROKEN)
    plain = main(["report", "--cut-lines", "--input", src, "--output", os.path.join(tmp, "plain")])["rows"]
    assert plain["malformed_rows"] == 3                    # the cut record's two halves and the surplus field
    assert "--multi-line" in capsys.readouterr().err
    for k, flag in enumerate(([], ["--multi-line"])):      # line breaks are found without a flag
        whole = main(["report", *flag, "--input", src, "--output", os.path.join(tmp, f"whole{k}")])["rows"]
        assert whole["malformed_rows"] == 1 and whole["clean_rows"] == 3


def test_filters_apply_to_the_report(spark, tmp):
    from mishap.__main__ import main
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as fh:
        fh.write(CSV)
    summary = main(["report", "--input", src, "--output", os.path.join(tmp, "out"), "--start", "2021-01-06"])
    back = read_incidents_csv(spark, summary["tables"]["by_city"], infer_schema=True)
    assert {r.city for r in back.collect()} == {"Austin, Tx", "Chicago"}


@pytest.mark.parametrize("infer", [False, True])
def test_whole_numbers_with_a_decimal_part(spark, tmp, infer):
    path = os.path.join(tmp, "n.csv")
    with open(path, "w") as fh:
        fh.write("id,city,date,severity,num_vehicles\n1,a,2022-01-01,High,2.0\n2,b,2022-01-01,High,3\n3.0,c,2022-01-01,Low,4.0\n")
    out = {r.city: (r.id, r.num_vehicles) for r in clean(read_incidents_csv(spark, path, infer_schema=infer)).collect()}
    assert out == {"A": (1, 2), "B": (2, 3), "C": (3, 4)}


def test_many_places_and_fine_cells_are_not_gathered(spark, tmp):
    from pyspark.sql import functions as F
    from mishap.operators.filters import filter_options
    from mishap.operators.hotspots import hotspot_grid
    from mishap.plans.dashboard import dashboard_counts, dashboard_from_counts
    rows = spark.range(200_000).select(
        F.col("id"), F.concat(F.lit("Place "), "id").alias("city"), F.to_date(F.lit("2022-01-01")).alias("date"),
        F.lit("High").alias("severity"), F.concat(F.lit("w"), "id").alias("weather_condition"),
        F.lit("Dry").alias("road_condition"), F.lit(1).alias("num_vehicles"), F.lit(2022).alias("year"),
        (F.col("id") / 3000).cast("float").alias("latitude"), (F.col("id") % 170).cast("float").alias("longitude"),
        F.lit(5).alias("hour"))
    board = dashboard_from_counts(dashboard_counts(rows))
    for frame in (filter_options(rows), board["by_weather_filtered"], hotspot_grid(rows, 0.001)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange SinglePartition" not in plan and "RoundRobinPartitioning(1)" not in plan
    assert filter_options(rows).count() == 200_001 and hotspot_grid(rows, 0.001).count() > 100_000
    paths = write_report({"options": filter_options(rows)}, os.path.join(tmp, "many"))
    assert read_incidents_csv(spark, paths["options"]).count() == 200_001
