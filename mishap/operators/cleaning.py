"""Cleaning: raw incident frame -> typed clean frame.

All steps are lazy DataFrame -> DataFrame transforms.  The only wide step is
the whole-row dedup; it aggregates map-side first, so a hot duplicate row
collapses before the shuffle.  Column-presence guards are resolved when the
plan is built (``df.columns``), never by running a job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mishap.constants import (
    CATEGORICAL_COLUMNS, CATEGORICAL_FILL_COLUMNS, COLUMN_ALIASES, CRITICAL_COLUMNS,
    DEFAULT_VEHICLES, MONTH_FORMAT, REQUIRED_COLUMNS, UNKNOWN,
)
from mishap.functions.columns import parse_date, parse_hour, present, title_case
from mishap.schema import NUMERIC_TARGETS


def _normal_name(name: str) -> str:
    return name.lower().strip().replace(" ", "_")


def standardize_column_names(df: DataFrame) -> DataFrame:
    """C1+C2: lower-case/strip/underscore every header, then map known aliases.

    An alias is renamed only when its standard name is not present yet; the
    first alias (in alias-table order) wins.
    """
    names = [_normal_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"headers normalise to the same name: {clashes}")
    if names != df.columns:
        df = df.toDF(*names)
    present = list(names)
    renames: dict[str, str] = {}
    for alias, standard in COLUMN_ALIASES.items():
        if alias in present and standard not in present:
            renames[alias] = standard
            present[present.index(alias)] = standard
    return df.withColumnsRenamed(renames) if renames else df


def require_columns(df: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """Fail early, with one clear message, when contract columns are absent."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; have {df.columns}")
    return df


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Exact whole-row dedup (before any normalisation)."""
    return df.dropDuplicates()


def drop_critical_nulls(df: DataFrame) -> DataFrame:
    """C4: drop rows without city, date or severity."""
    missing = [c for c in CRITICAL_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"critical columns absent: {missing}")
    return df.where(present(df, *CRITICAL_COLUMNS))


def fill_defaults(df: DataFrame) -> DataFrame:
    """C5+C6: weather/road NULL -> 'Unknown'; num_vehicles NULL -> 1 (in the column's type)."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    fills = {}
    for c in CATEGORICAL_FILL_COLUMNS:
        if isinstance(types.get(c), T.StringType):
            fills[c] = F.coalesce(F.col(c), F.lit(UNKNOWN))
    if "num_vehicles" in types:
        t = types["num_vehicles"]
        value = F.col("num_vehicles")
        if isinstance(t, (T.DoubleType, T.FloatType)):
            value = F.nanvl(value, F.lit(None).cast(t))
        fills["num_vehicles"] = F.coalesce(value, F.lit(DEFAULT_VEHICLES).cast(t))
    return df.withColumns(fills) if fills else df


def handle_nulls(df: DataFrame) -> DataFrame:
    """C4-C6 together."""
    return fill_defaults(drop_critical_nulls(df))


def normalize_categoricals(df: DataFrame) -> DataFrame:
    """Trim + title case on city, severity, weather and road."""
    cols = {c: title_case(c) for c in CATEGORICAL_COLUMNS if c in df.columns}
    return df.withColumns(cols) if cols else df


def parse_dates(df: DataFrame) -> DataFrame:
    """``date`` from any of the four formats (see ``parse_date``)."""
    t = df.schema["date"].dataType
    return df.withColumn("date", parse_date("date", t))


def parse_hours(df: DataFrame) -> DataFrame:
    """``hour`` from ``time`` when a time column exists."""
    if "time" not in df.columns:
        return df
    return df.withColumn("hour", parse_hour("time", df.schema["time"].dataType))


def add_calendar_fields(df: DataFrame) -> DataFrame:
    """day_of_week (1 = Sunday), month, year, month_year (``yyyy-MM``)."""
    d = F.col("date")
    return df.withColumns({
        "day_of_week": F.dayofweek(d),
        "month": F.month(d),
        "year": F.year(d),
        "month_year": F.date_format(d, MONTH_FORMAT),
    })


def parse_datetime(df: DataFrame) -> DataFrame:
    """C8-C10 together."""
    return add_calendar_fields(parse_hours(parse_dates(df)))


def to_integer(c: str, source: T.DataType, target: T.DataType) -> Column:
    """A whole number of ``target`` type; text with a decimal part (``2.0``) loses it,
    as a number column's values do, whatever the reader made of the column."""
    value = F.col(c).try_cast(target)
    if isinstance(source, T.StringType):
        value = F.coalesce(value, F.col(c).try_cast("double").try_cast(target))
    return value


def cast_numerics(df: DataFrame) -> DataFrame:
    """C11: id -> bigint, num_vehicles -> int, latitude/longitude -> float (bad text -> NULL)."""
    casts = {}
    for c, t in NUMERIC_TARGETS.items():
        if c in df.columns and df.schema[c].dataType != t:
            whole = isinstance(t, (T.IntegerType, T.LongType))
            casts[c] = to_integer(c, df.schema[c].dataType, t) if whole else F.col(c).try_cast(t)
    return df.withColumns(casts) if casts else df


# The cleaning chain, in order, by the name of the stage each step ends.
STEPS: tuple[tuple[str, Callable[[DataFrame], DataFrame]], ...] = (
    ("standardized", standardize_column_names),
    ("deduplicated", drop_duplicates),
    ("dropped_critical", drop_critical_nulls),
    ("filled_nulls", fill_defaults),
    ("normalized", normalize_categoricals),
    ("parsed_dates", parse_dates),
    ("parsed_hours", parse_hours),
    ("calendar_fields", add_calendar_fields),
    ("cast_numerics", cast_numerics),
)


def stage(df: DataFrame, name: str) -> DataFrame:
    """The raw frame run through the cleaning chain up to and including ``name``."""
    names = [n for n, _ in STEPS]
    if name not in names:
        raise KeyError(f"unknown stage {name!r}; stages are {names}")
    for _, step in STEPS[:names.index(name) + 1]:
        df = step(df)
    return df


def clean(df: DataFrame, strict: bool = False) -> DataFrame:
    """The whole cleaning chain, lazily.

    Optional columns that are absent are skipped (as the original does);
    ``strict=True`` instead requires the whole column contract (C13).
    """
    if strict:
        require_columns(standardize_column_names(df))
    return stage(df, STEPS[-1][0])


def clean_rows(df: DataFrame) -> DataFrame:
    """The cleaning chain without the dedup: every step that looks at one row alone."""
    for name, step in STEPS:
        if name != "deduplicated":
            df = step(df)
    return df


@dataclass
class CleaningMetrics:
    """Row counts of a cleaning run, filled by the first action on the frame.

    Counted with ``DataFrame.observe`` below the dedup while the data flows: no extra job.
    """
    raw: Observation = field(default_factory=lambda: Observation("raw_rows"))
    complete: Observation = field(default_factory=lambda: Observation("complete_rows"))

    def as_dict(self, clean_rows: int) -> dict[str, int]:
        raw, complete = self.raw.get["rows"], self.complete.get["rows"]
        return {"raw_rows": raw, "incomplete_rows": raw - complete,
                "duplicates_removed": complete - clean_rows, "clean_rows": clean_rows}


def clean_observed(df: DataFrame) -> tuple[DataFrame, CleaningMetrics]:
    """``clean`` plus counts of raw and complete rows, gathered in the same job.

    A metrics node stops Catalyst from moving filters past it, so rows without
    a critical column are dropped first here: they are dropped as a whole, so
    the dedup gives the same rows either way, and the NULL tests reach the scan.
    """
    m = CleaningMetrics()
    rows = F.count(F.lit(1)).alias("rows")
    first, *rest = [step for _, step in STEPS]
    out = drop_critical_nulls(first(df).observe(m.raw, rows)).observe(m.complete, rows)
    for step in rest:
        out = step(out)
    return out, m


def serving_frame(clean_df: DataFrame) -> DataFrame:
    """C14: dashboard coercions: num_vehicles NULL -> 1, hour NULL -> 0."""
    cols = {}
    if "num_vehicles" in clean_df.columns:
        cols["num_vehicles"] = F.coalesce(F.col("num_vehicles"), F.lit(DEFAULT_VEHICLES))
    if "hour" in clean_df.columns:
        cols["hour"] = F.coalesce(F.col("hour"), F.lit(0))
    return clean_df.withColumns(cols) if cols else clean_df
