"""Cleaning steps on hand-written rows (decisions D1-D13 of the survey)."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from mishap.operators import cleaning as C

from conftest import rows

RAW = T.StructType([T.StructField(n, T.StringType()) for n in (
    "id", "City", "accident_date", "accident_time", "accident_severity", "weather", "road_type",
    "vehicles_involved", "lat", "lng")])


def raw(spark, data, schema=RAW):
    return spark.createDataFrame(data, schema)


def test_standardize_headers_and_aliases(spark):
    df = spark.createDataFrame([(1, "a", "b", "c")], [" City ", "Weather Condition", "place", "lon"])
    out = C.standardize_column_names(df)
    # 'place' stays: 'city' already present; 'Weather Condition' normalises itself
    assert out.columns == ["city", "weather_condition", "place", "longitude"]


def test_first_alias_wins(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["lng", "lon", "id"])
    assert C.standardize_column_names(df).columns == ["lng", "longitude", "id"]


def test_header_clash_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], ["City", "city "])
    with pytest.raises(ValueError):
        C.standardize_column_names(df)


def test_require_columns(spark):
    df = spark.createDataFrame([(1,)], ["city"])
    with pytest.raises(ValueError, match="missing required"):
        C.require_columns(df)


def test_dates_all_formats_first_match_and_plain_cast(spark):
    data = [("1", "x", d, "08:30", "low", None, None, None, None, None) for d in (
        "2021-03-05", "03/05/2021", "05-03-2021", "2021/03/05", "2021-3-5", "bad", "13/40/2021")]
    out = rows(C.clean(raw(spark, data)), order=["date"])
    dates = sorted([r["date"] for r in out], key=lambda d: (d is None, d))
    assert dates[:5] == [dt.date(2021, 3, 5)] * 5
    assert dates[5:] == [None, None]
    assert all(r["month_year"] == "2021-03" for r in out if r["date"])
    assert {r["day_of_week"] for r in out if r["date"]} == {6}  # 2021-03-05 is a Friday; Sunday = 1


def test_hours(spark):
    times = ["08:30", "8:30", "23:59:59", "noon", None, "25:00"]
    data = [(str(i), "x", "2021-01-01", t, "low", None, None, None, None, None) for i, t in enumerate(times)]
    out = {r["time"]: r["hour"] for r in rows(C.clean(raw(spark, data)))}
    assert out == {"08:30": 8, "8:30": 8, "23:59:59": 23, "noon": None, None: None, "25:00": 25}


def test_nulls_fill_and_dedup_before_normalise(spark):
    data = [
        ("1", "  new york ", "2021-01-01", "10:00", "HIGH", None, "wet ", None, "1.5", "2.5"),
        ("1", "  new york ", "2021-01-01", "10:00", "HIGH", None, "wet ", None, "1.5", "2.5"),
        ("1", "New York", "2021-01-01", "10:00", "High", None, "wet ", None, "1.5", "2.5"),  # D6
        ("2", None, "2021-01-01", "10:00", "low", "fog", "dry", "two", "x", None),           # no city
        ("3", "   ", "2021-01-01", "10:00", "low", "fog", "dry", "two", "x", None),          # D5 blank city
        ("4", "b", None, "10:00", "low", "fog", "dry", "3", None, None),                     # no date
        ("5", "b", "2021-01-01", "10:00", None, "fog", "dry", "3", None, None),              # no severity
    ]
    out = rows(C.clean(raw(spark, data)), order=["id", "city"])
    assert [(r["id"], r["city"]) for r in out] == [(1, "New York"), (1, "New York"), (3, "")]
    first = out[0]
    assert (first["severity"], first["weather_condition"], first["road_condition"]) == ("High", "Unknown", "Wet")
    assert first["num_vehicles"] == 1 and first["latitude"] == 1.5 and first["longitude"] == 2.5
    blank = out[2]
    assert blank["num_vehicles"] is None and blank["latitude"] is None  # D4: 'two' -> NULL


def test_initcap_after_blanks_only(spark):
    data = [("1", "o'fallon wilkes-barre", "2021-01-01", "1:00", "low", "cLEAR", "under construction",
             "1", None, None)]
    r = rows(C.clean(raw(spark, data)))[0]
    assert r["city"] == "O'fallon Wilkes-barre"  # D13
    assert r["road_condition"] == "Under Construction"
    assert r["weather_condition"] == "Clear"


def test_clean_schema(spark):
    from mishap.schema import CLEAN_SCHEMA
    data = [("1", "a", "2021-01-01", "1:00", "low", "x", "y", "1", "1", "2")]
    out = C.clean(raw(spark, data))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in CLEAN_SCHEMA]


def test_typed_inputs_pass_through(spark):
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("city", T.StringType()),
        T.StructField("date", T.DateType()), T.StructField("time", T.TimestampNTZType()),
        T.StructField("severity", T.StringType()), T.StructField("num_vehicles", T.DoubleType()),
    ])
    data = [(1, "a", dt.date(2022, 5, 1), dt.datetime(2022, 5, 1, 17, 5), "low", float("nan")),
            (2, "a", dt.date(2022, 5, 2), None, "low", None)]
    out = rows(C.clean(spark.createDataFrame(data, schema)), order=["id"])
    assert [r["hour"] for r in out] == [17, None]
    assert [r["num_vehicles"] for r in out] == [1, 1]  # NaN and NULL filled, then int
    assert out[0]["date"] == dt.date(2022, 5, 1)


def test_empty_input(spark):
    out = C.clean(raw(spark, []))
    assert out.count() == 0


def test_clean_is_idempotent_on_complete_rows(clean_small):
    # A second pass drops rows whose date did not parse (D2) and fills the
    # count that did not parse (D4); on rows without those NULLs it is a no-op.
    full = clean_small.dropna(subset=["date", "num_vehicles"])
    again = C.clean(full)
    assert again.columns == full.columns
    assert again.exceptAll(full).count() == 0 and full.exceptAll(again).count() == 0


def test_serving_frame(spark):
    data = [("1", "a", "2021-01-01", "noon", "low", None, None, "two", None, None)]
    r = rows(C.serving_frame(C.clean(raw(spark, data))))[0]
    assert r["hour"] == 0 and r["num_vehicles"] == 1


def test_observed_counts_without_extra_jobs(spark):
    from mishap.plans.registry import raw as raw_rows
    df, metrics = C.clean_observed(raw_rows(spark, "/root/testdata/sf0.001"))
    n = df.count()
    m = metrics.as_dict(n)
    assert m["raw_rows"] == 1020 and m["clean_rows"] == 981
    assert m["incomplete_rows"] == raw_rows(spark, "/root/testdata/sf0.001").where(
        "accident_location IS NULL OR accident_date IS NULL OR accident_severity IS NULL").count()
    assert m["duplicates_removed"] == 1020 - m["incomplete_rows"] - 981
    assert n == 981


def test_stage_names(spark):
    with pytest.raises(KeyError):
        C.stage(raw(spark, []), "nope")


def test_strict_contract(spark):
    df = spark.createDataFrame([("a", "2021-01-01", "low")], ["city", "date", "severity"])
    assert C.clean(df).count() == 1  # optional columns absent: steps skipped
    with pytest.raises(ValueError, match="missing required"):
        C.clean(df, strict=True)


def test_present_matches_dropna(spark):
    from mishap.functions.columns import present
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c"), (2.0, None)], "x double, s string")
    assert sorted(df.where(present(df, "x", "s")).collect()) == sorted(df.dropna(subset=["x", "s"]).collect())


def _strings():
    import random
    rnd = random.Random(7)
    alphabet = "0123456789-/: +.aT"
    hand = ["2021-03-05", "03/05/2021", "05-03-2021", "2021/03/05", "2021-3-5", "3/5/2021", "+12021-03-05",
            "12021-03-05", "2021-02-30", "2021-13-01", " 2021-03-05", "2021-03-05 ", "", "-", "--", "//", "2021-03-05T10:00",
            "05-03-21", "0005-03-2021", "99/99/9999", "2021/3/05", "08:30", "8:30", "24:00", "23:59:59", "noon",
            ":30", "08:", " 08:30", "+8:30", "-1:00", "08.30", "0830", "12:75", "1:2:3"]
    rand = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    return hand + rand


def test_guarded_date_parse_equals_unguarded(spark):
    from pyspark.sql import functions as F
    from mishap.constants import DATE_FORMATS
    from mishap.functions.columns import parse_date
    df = spark.createDataFrame([(s,) for s in _strings()], "s string")
    plain = F.coalesce(*[F.try_to_date(F.col("s"), f) for f in DATE_FORMATS], F.col("s").try_cast("date"))
    diff = df.where(~parse_date("s").eqNullSafe(plain)).collect()
    assert diff == []
    assert df.where(plain.isNotNull()).count() > 20


def test_hour_rule_equals_strict_then_loose(spark):
    from pyspark.sql import functions as F
    from mishap.functions.columns import parse_hour
    df = spark.createDataFrame([(s,) for s in _strings()], "s string")
    two_rules = F.coalesce(F.hour(F.try_to_timestamp(F.col("s"), F.lit("HH:mm"))),
                           F.split(F.col("s"), ":").getItem(0).try_cast("int"))
    assert df.where(~parse_hour("s").eqNullSafe(two_rules)).collect() == []
    assert df.where(two_rules.isNotNull()).count() > 20
