"""Raw incident CSV files.

Read as text with the header the files carry (names vary; the cleaning
step standardises them).  Schema inference is opt-in: it costs a full pass
and guesses types per file (a ``time`` column can become a timestamp of
today).  Quoted fields may hold line breaks: files that have any are read
record by record in parallel (``sources.records``), all others by Spark's
splittable reader.

Spark names the columns from the first file's header.  By default it then
ignores the headers of the other files, so a folder mixing header layouts
would be silently misaligned; here every file's header is checked against
those names and a mismatch fails the read.  Folders with several layouts go
through ``read_incident_layouts``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mishap.functions.columns import free_name
from mishap.operators.cleaning import standardize_column_names
from mishap.sources.records import csv_records, has_open_lines

MALFORMED = "_malformed_line"
_COUNTS: dict[str, Observation] = {}


def _path_key(path: str | list[str]) -> str:
    return "\n".join([path] if isinstance(path, str) else path)


def read_counts(path: str | list[str]) -> dict[str, int]:
    """``rows`` and ``malformed`` of the last read of ``path``, once an action has run on it."""
    found = _COUNTS[_path_key(path)].get
    return {"rows": found["rows"], "malformed": found["malformed"]}


def read_incidents_csv(spark: SparkSession, path: str | list[str], infer_schema: bool = False,
                       multi_line: bool | None = None, malformed: Observation | None = None, **options) -> DataFrame:
    """Raw incident rows from CSV (header line, ``"`` quoting and escaping).

    By default a job looks for quoted line breaks (it stops at the first);
    files that have any are read record by record, in as many tasks as they
    have splits.  ``multi_line`` False skips the search: a record with a line
    break is then cut into rows with too few fields; True reads record by
    record at once.  With schema inference or other separators such files are
    read by Spark's own ``multiLine``, one task a file.

    Rows, and those with too few or too many fields, are always counted while
    the data flow: ``malformed`` (an Observation: ``rows``, ``malformed``) or
    ``read_counts(path)``.  A missing path raises Spark's PATH_NOT_FOUND error
    (any file system).
    """
    reader = (spark.read.option("header", True).option("escape", '"')
              .option("inferSchema", infer_schema).option("enforceSchema", False))
    for key, value in options.items():
        reader = reader.option(key, value)
    own = not infer_schema and not {k.lower() for k in options} & {"sep", "delimiter", "quote", "escape", "header", "linesep", "comment"}
    if multi_line is None:
        multi_line = own and has_open_lines(spark, path)
    observed = malformed or Observation()
    _COUNTS[_path_key(path)] = observed
    found = reader.option("multiLine", multi_line).csv(path)
    mark = free_name(MALFORMED, found.columns)
    schema = T.StructType([*found.schema.fields, T.StructField(mark, T.StringType())])
    if multi_line and own:
        marked = _by_record(spark, path, found.columns, schema, mark, options)
    else:
        marked = reader.schema(schema).option("columnNameOfCorruptRecord", mark).csv(path)
    some = [F.count(F.col(f"`{name}`")).alias("filled") for name in found.columns[:1]]     # Spark won't read the mark alone
    return marked.observe(observed, F.count(F.lit(1)).alias("rows"), F.count(F.col(mark)).alias("malformed"), *some).drop(mark)


def _same_names(header: Column, names: Sequence[str]) -> Column:
    """Whether a header record has the names (upper and lower case are alike)."""
    raw = ", ".join(f"c{k} string" for k in range(len(names) + 1))
    cells = F.from_csv(header, raw, {"escape": '"'})
    same = F.coalesce(cells[f"c{len(names)}"], F.lit("")) == ""
    for k, name in enumerate(names):
        same = same & (F.lower(F.coalesce(cells[f"c{k}"], F.lit(f"_c{k}"))) == name.lower())
    return same


def _by_record(spark: SparkSession, path: str | list[str], names: Sequence[str], schema: T.StructType, mark: str,
               options: dict) -> DataFrame:
    records = csv_records(spark, path).withColumn("text", F.ltrim(F.col("text"), F.lit("﻿")))
    checked = F.assert_true(_same_names(F.col("text"), names), F.lit(f"a file's header differs from {', '.join(names)}"))
    rows = records.where(F.when(F.col("header"), checked.isNotNull()).otherwise(F.col("text") != ""))
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)
    parsed = F.from_csv("text", ddl, {"escape": '"', **{k: str(v) for k, v in options.items()}, "columnNameOfCorruptRecord": mark})
    return rows.select(parsed.alias("row")).select("row.*")


def read_incident_layouts(spark: SparkSession, layouts: Sequence[str | list[str]],
                          malformed: Sequence[Observation] | None = None, **options) -> DataFrame:
    """Files in several header layouts: one read per layout (files sharing a
    header), headers standardised, then a union by column name; a column a
    layout lacks is NULL there.  No data moves: the union is a plan node."""
    counters = malformed or [None] * len(layouts)
    frames = [standardize_column_names(read_incidents_csv(spark, paths, malformed=counter, **options))
              for paths, counter in zip(layouts, counters, strict=True)]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """A clean table written by ``sinks.write_clean`` (Parquet, year partitions)."""
    return spark.read.parquet(path)
