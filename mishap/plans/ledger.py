"""Results kept up to date as files arrive.

Every figure of the report, the headline figures of the whole table and the
sidebar come from counts, sums and extremes, so they add up over loads: a
load stores its own partial aggregates, and results are rolled up from the
partials of all loads.  A new file is the only thing that is read.

A raw row counts once however many loads hold it (C3): each load also stores
128-bit fingerprints of its raw rows, and the next one drops the rows that an
earlier load has, by an anti-join on fingerprints (the earlier rows
themselves are not read).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mishap.functions.columns import free_name
from mishap.operators.cleaning import clean, drop_critical_nulls, standardize_column_names
from mishap.operators.summary import SUMMARY_SETS
from mishap.plans.dashboard import table_overview
from mishap.plans.materialize import new_path
from mishap.plans.report import REPORT_KEYS, REPORT_SETS, report_grouping_sets

MARK = "mark"
SEEN = T.StructType([T.StructField(MARK, T.BinaryType())])


def _mark(df: DataFrame) -> F.Column:
    """A 128-bit fingerprint of the raw row: its columns by name, as text; NULL told from any text."""
    return F.unhex(F.md5(F.to_json(F.struct(*[F.col(f"`{name}`").cast("string") for name in sorted(df.columns)]))))


def fingerprints(raw: DataFrame) -> DataFrame:
    """One row for each distinct raw row that cleaning can keep."""
    found = drop_critical_nulls(standardize_column_names(raw))
    return found.select(_mark(found).alias(MARK)).distinct()


def unseen(raw: DataFrame, seen: DataFrame) -> DataFrame:
    """Raw rows whose fingerprint no earlier load has (columns standardised)."""
    found = standardize_column_names(raw)
    name = free_name(MARK, found.columns)
    known = seen.select(F.col(MARK).alias(name))
    return found.withColumn(name, _mark(found)).join(known, name, "left_anti").select(*[f"`{c}`" for c in found.columns])


def partials(clean_rows: DataFrame) -> dict[str, DataFrame]:
    """What a load adds: the fused report's groups and the sidebar's."""
    return {"report": report_grouping_sets(clean_rows), "overview": table_overview(clean_rows)}


def merged_report(reports: DataFrame) -> DataFrame:
    """The fused report table of all loads from the rows of their own ones: counts and sums add up."""
    sums = ("accidents", "high_count", "vehicles_sum", "vehicles_n")
    return reports.groupBy("grouping_set", *REPORT_KEYS).agg(*[F.sum(c).alias(c) for c in sums])


def merged_overview(overviews: DataFrame) -> DataFrame:
    """The sidebar's table of all loads: counts add up, first and last dates are the extremes."""
    return overviews.groupBy("dim", "city", "severity").agg(
        F.sum("n").alias("n"), F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"))


def counts_from_report(fused: DataFrame) -> DataFrame:
    """The headline figures' counts of the whole table (``summary.dimension_counts``) from its fused report."""
    home = {keys[0]: name for name, keys in reversed(REPORT_SETS)}
    frames = []
    for dim, (key, *_) in SUMMARY_SETS:
        own = fused.where(F.col("grouping_set") == home[key]).groupBy(key).agg(
            F.sum("accidents").alias("n"), F.sum("high_count").alias("n_high"),
            F.sum("vehicles_sum").alias("vehicles_sum"), F.sum("vehicles_n").alias("vehicles_n"))
        frames.append(own.withColumn("dim", F.lit(dim)))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


@dataclass
class Ledger:
    """The tables of all loads in one folder: ``clean``, ``report``, ``overview``, ``seen`` and ``loads``.

    A load counts once its row is in ``loads``, which is written last: a load
    that breaks off leaves folders that nothing reads, and can be repeated.
    Loads are added one after the other.
    """
    spark: SparkSession
    path: str

    @classmethod
    def create(cls, spark: SparkSession, path: str | None = None) -> Ledger:
        """A new ledger at ``path``, or under the shared folder."""
        found = cls(spark, (path or new_path(spark, "ledger")).rstrip("/"))
        spark.createDataFrame([], "load string").write.mode("append").parquet(f"{found.path}/loads")
        return found

    def loads(self) -> list[str]:
        """Names of the loads that are complete (one small row each)."""
        return sorted(r[0] for r in self.spark.read.schema("load string").parquet(f"{self.path}/loads").collect())

    def table(self, name: str, schema: T.StructType) -> DataFrame:
        """Rows of one table of all complete loads."""
        paths = [f"{self.path}/{name}/{load}" for load in self.loads()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def add(self, raw: DataFrame) -> str:
        """Add the raw rows of new files; returns the load's name.  Only ``raw`` and the fingerprints are read."""
        load = uuid.uuid4().hex
        new = unseen(raw, self.table("seen", SEEN))
        rows = clean(new)
        rows.write.parquet(f"{self.path}/clean/{load}")
        stored = self.spark.read.schema(rows.schema).parquet(f"{self.path}/clean/{load}")
        for name, frame in {**partials(stored), "seen": fingerprints(new)}.items():
            frame.write.parquet(f"{self.path}/{name}/{load}")
        self.spark.createDataFrame([(load,)], "load string").coalesce(1).write.mode("append").parquet(f"{self.path}/loads")
        return load

    def report(self) -> DataFrame:
        """The fused report table of all loads (``report.report_from_fused`` gives the results)."""
        return merged_report(self.table("report", _report_schema(self.spark)))

    def overview(self) -> DataFrame:
        """The sidebar's table of all loads (``dashboard.sidebar_from_overview`` gives the results)."""
        return merged_overview(self.table("overview", _overview_schema(self.spark)))


_CLEAN = "city string, severity string, hour int, weather_condition string, road_condition string, month_year string, " \
         "year int, num_vehicles int, date date"


def _report_schema(spark: SparkSession) -> T.StructType:
    return report_grouping_sets(spark.createDataFrame([], _CLEAN)).schema


def _overview_schema(spark: SparkSession) -> T.StructType:
    return table_overview(spark.createDataFrame([], _CLEAN)).schema
