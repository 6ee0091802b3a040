"""Filters of the dashboard.

Conditions are plain column predicates on stored columns, so on a Parquet
clean table they reach the scan as pushed filters; a date range also adds
the implied ``year`` range if asked, which prunes ``year=`` partitions of a table
written by ``sinks.write_clean``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mishap.constants import DEFAULT_VIEW_CITIES, EXPLORER_COLUMNS
from mishap.functions.columns import present

DateLike = str | dt.date


def _as_date(value: DateLike) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


def apply_filters(df: DataFrame, cities: Sequence[str] | None = None,
                  severities: Sequence[str] | None = None,
                  date_range: Sequence[DateLike | None] | None = None,
                  year_folders: bool = False) -> DataFrame:
    """AND of city in list, severity in list, start <= date <= end.

    An empty or missing list is no condition.  A range may be open at either
    end; with any end, rows without a date fall out.  ``year_folders`` says
    that ``year`` is the stored clean table's partition column, so the range's
    years may prune its folders (on other frames a column of that name may
    mean something else and is left alone).
    """
    start, end = ([d if d not in ("", None) else None for d in date_range] if date_range else (None, None))
    tests = []
    if cities:
        tests.append(F.col("city").isin(list(cities)))
    if severities:
        tests.append(F.col("severity").isin(list(severities)))
    if start is not None:
        tests.append(F.col("date") >= F.lit(_as_date(start)))
        if year_folders:
            tests.append(F.col("year") >= _as_date(start).year)
    if end is not None:
        tests.append(F.col("date") <= F.lit(_as_date(end)))
        if year_folders:
            tests.append(F.col("year") <= _as_date(end).year)
    for test in tests:
        df = df.where(test)
    return df


def filter_options(df: DataFrame) -> DataFrame:
    """the sorted distinct non-NULL cities and severities, as (field, value) rows.

    Two grouping sets of one scan, combined map-side; sorted as a distributed
    result, since names are free text.
    """
    field = F.when(F.grouping("city") == 0, F.lit("city")).otherwise(F.lit("severity"))
    options = (df.groupingSets([["city"], ["severity"]], "city", "severity")
               .agg(field.alias("field"), F.coalesce("city", "severity").alias("value")))
    return options.select("field", "value").where(F.col("value").isNotNull()).orderBy("field", "value")


def default_cities(df: DataFrame, n: int = DEFAULT_VIEW_CITIES) -> DataFrame:
    """The first ``n`` city names in sort order (at most n rows)."""
    return (df.select("city").where(F.col("city").isNotNull()).distinct()
              .orderBy("city").limit(n))


def default_view(df: DataFrame, n: int = DEFAULT_VIEW_CITIES) -> DataFrame:
    """the dashboard's first selection: first n cities by name, every
    severity, the full date range (rows without a date drop out).

    The city list is at most ``n`` rows, so broadcasting it is bounded.
    """
    firsts = default_cities(df, n)
    return (df.where(F.col("date").isNotNull())
              .join(F.broadcast(firsts), on="city", how="left_semi")
              .select(*df.columns))


def with_coordinates(df: DataFrame) -> DataFrame:
    """rows with both coordinates (NULL checks pushed to the scan)."""
    return df.where(present(df, "latitude", "longitude"))


def explorer(df: DataFrame, columns: Sequence[str] = EXPLORER_COLUMNS) -> DataFrame:
    """F8: the explorer/export projection (the listed columns that exist)."""
    return df.select(*[c for c in columns if c in df.columns])
