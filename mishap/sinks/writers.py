"""Sinks (W1-W3).  Every write is distributed: one file per task unless a
single file is asked for explicitly (which funnels the data through one
task and is meant for small exports only)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from mishap.operators.filters import explorer
from mishap.plans.materialize import dealt_out, point_filters
from mishap.plans.sizing import load_width


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> str:
    """CSV with a header line, values as they are (blanks kept).  ``single_file`` moves the finished rows to one
    task (``repartition(1)``: the plan producing them keeps its parallelism)."""
    out = df.repartition(1) if single_file else df
    (out.write.mode(mode).option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def write_filtered_csv(view: DataFrame, path: str, single_file: bool = False) -> str:
    """The explorer columns of a filtered frame as CSV."""
    return write_csv(explorer(view), path, single_file)


def write_report(report: Mapping[str, DataFrame], directory: str, fmt: str = "csv") -> dict[str, str]:
    """One folder per table, written by the tasks that made it (AQE merges small ones)."""
    paths = {}
    for name, frame in report.items():
        path = f"{directory.rstrip('/')}/{name}"
        if fmt == "csv":
            write_csv(frame, path)
        else:
            frame.write.mode("overwrite").format(fmt).save(path)
        paths[name] = path
    return paths


def write_clean(clean_df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = "year",
                mode: str = "overwrite", cluster_by: tuple[str, ...] = ("city", "date"), source: DataFrame | None = None) -> str:
    """The cleaned table, partitioned by year so date filters prune folders,
    each file covering a narrow range of places and dates (``laid_out``).  With the raw
    rows as ``source``, a large table is laid out in one pass (``laid_out_by``)."""
    folders = [partition_by] if partition_by and partition_by in clean_df.columns else []
    with load_width(clean_df) as width:
        writer = dealt_out(clean_df, source, width, folders, cluster_by).write.mode(mode)
        if folders:
            writer = writer.partitionBy(*folders)
        if fmt == "csv":
            writer = writer.option("header", True).option("escape", '"')
        elif fmt == "parquet":
            writer = writer.options(**point_filters(clean_df))
        writer.format(fmt).save(path)
    return path
